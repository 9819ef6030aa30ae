from __future__ import annotations

import json
import os

import pytest
from pyspark.sql import functions as F

from corpusloom.sources import pages, payloads, perfile, sinks
from corpusloom.streaming import harvest

RECORD = (
    '<record><header><identifier>oai:{i}</identifier></header><metadata><arXiv xmlns="http://arxiv.org/OAI/arXiv/"><id>2401.{i}</id><created>2024-01-02</created>'
    "<authors><author><keyname>Doe</keyname></author></authors><title>Title {i}</title><categories>cs.AI</categories><abstract>Text {i}.</abstract></arXiv></metadata></record>"
)
GONE = '<record><header status="deleted"><identifier>oai:x</identifier></header></record>'


def page(folder, token: str, ids: list[int], then: str = "") -> None:
    body = "".join(RECORD.format(i=i) for i in ids) + GONE
    named = f'<resumptionToken cursor="0">{then}</resumptionToken>' if then else ""
    folder.mkdir(parents=True, exist_ok=True)
    (folder / pages.page_name(token)).write_text(f'<?xml version="1.0"?><OAI-PMH xmlns="http://www.openarchives.org/OAI/2.0/"><ListRecords>{body}{named}</ListRecords></OAI-PMH>')


def store(tmp_path):
    page(tmp_path / "a", "", [1, 2], "t1")
    page(tmp_path / "a", "t1", [3], "t2")
    page(tmp_path / "b", "", [6], "u1")
    return tmp_path


def finish(folder) -> None:
    page(folder / "a", "t2", [4, 5])
    page(folder / "b", "u1", [7])


def titles(spark, path) -> list[str]:
    return sorted(r.title for r in harvest.read_store(spark, path).collect())


def test_offsets_name_the_page_to_come(tmp_path):
    reader = pages.PageReader(str(store(tmp_path)), ["a", "b"])
    start, end = reader.initialOffset(), reader.latestOffset()
    assert end == {"set_index": 0, "token": "t2"}
    assert [os.path.basename(p.path) for p in reader.partitions(start, end)] == ["first.xml", pages.page_name("t1")]
    finish(tmp_path)
    assert reader.latestOffset() == {"set_index": 2, "token": ""} == pages.PageReader(str(tmp_path), ["a", "b"]).latestOffset()
    rest = reader.partitions(end, reader.latestOffset())
    assert [(p.set_index, os.path.basename(p.path)) for p in rest] == [(0, pages.page_name("t2")), (1, "first.xml"), (1, pages.page_name("u1"))]
    assert reader.partitions(end, end) == [] and len(list(reader.read(rest[0]))) == 3
    with pytest.raises(ValueError):
        reader.partitions(end, {"set_index": 0, "token": "t1"})


def test_pages_that_fail_or_lead_back_are_errors(tmp_path):
    with pytest.raises(ValueError, match="badResumptionToken"):
        pages.page_records('<OAI-PMH><error code="badResumptionToken">too old</error></OAI-PMH>')
    page(tmp_path / "a", "", [1], "t")
    page(tmp_path / "a", "t", [2], "t")
    with pytest.raises(ValueError, match="leads back"):
        pages.PageReader(str(tmp_path), ["a"]).latestOffset()


def test_a_harvest_that_was_killed_gives_the_rows_of_one_pass(spark, tmp_path):
    folder, path, state = store(tmp_path / "pages"), str(tmp_path / "store"), str(tmp_path / "state")
    harvest.start_page_harvest(spark, str(folder), path, state, sets=["a", "b"]).awaitTermination()
    assert titles(spark, path) == ["Title 1", "Title 2", "Title 3"]
    finish(folder)

    def dies(batch, epoch):
        batch.count()
        raise RuntimeError("killed")

    stream = harvest.harvest_pages(spark, str(folder), ["a", "b"])
    with pytest.raises(Exception, match="killed"):
        stream.writeStream.foreachBatch(dies).option("checkpointLocation", state).trigger(availableNow=True).start().awaitTermination()
    harvest.start_page_harvest(spark, str(folder), path, state, sets=["a", "b"]).awaitTermination()
    assert titles(spark, path) == [f"Title {i}" for i in range(1, 8)]
    harvest.start_page_harvest(spark, str(folder), path, state, sets=["a", "b"]).awaitTermination()
    assert titles(spark, path) == [f"Title {i}" for i in range(1, 8)]
    once = payloads.read_oai(spark, f"{folder}/*/*.xml")
    assert sorted(r.title for r in once.collect()) == titles(spark, path)
    kept = harvest.read_store(spark, path).where("title = 'Title 4'").first()
    assert (kept.arxiv_id, kept.year, kept.abstract, kept.field) == ("2401.4", 2024, "Text 4.", "Computer Science / Artificial Intelligence")


def visible(folder) -> list[str]:
    return sorted(n for n in os.listdir(folder) if os.path.isfile(os.path.join(folder, n)))


def test_a_failed_write_shows_no_file(spark, tmp_path):
    spark.dataSource.register(perfile.FileSink)
    folder = tmp_path / "out"
    folder.mkdir()
    write = lambda rows: rows.write.format("per_file").option("path", str(folder)).mode("append").save()
    rows = spark.range(8).select(F.concat(F.lit("f"), "id", F.lit(".json")).alias("file"), F.col("id").cast("string").alias("content")).repartition(4)
    with pytest.raises(Exception):
        write(rows.withColumn("file", F.when(F.col("content") == "7", "../x").otherwise(F.col("file"))))
    assert visible(folder) == []
    write(rows)
    assert visible(folder) == [f"f{i}.json" for i in range(8)] and (folder / "f3.json").read_text() == "3"
    write(rows.withColumn("content", F.lit("again")))
    assert len(visible(folder)) == 8 and (folder / "f3.json").read_text() == "again"
    assert os.listdir(folder / "_staged") == []


def test_documents_are_files_of_their_own(spark, tmp_path):
    rows = spark.createDataFrame([("p/1", "T", "a", [], []), ("p2", "U", "b", [], ["title is empty"])], "paper_id string, title string, abstract string, references array<string>, errors array<string>")
    rows = rows.withColumns({c: F.lit("x") for c in ("introduction", "field", "venue", "method")}).withColumn("year", F.lit(None).cast("int"))
    sinks.write_files(rows, str(tmp_path))
    assert visible(tmp_path) == ["p_1.json"] and visible(tmp_path / "_rejected") == ["p2.json"]
    held = json.loads((tmp_path / "p_1.json").read_text())
    assert held["title"] == "T" and held["year"] is None and "errors" not in held
    sinks.write_files(rows.withColumn("errors", F.when(F.col("paper_id") == "p2", F.array().cast("array<string>")).otherwise(F.array(F.lit("late")))), str(tmp_path))
    assert visible(tmp_path) == ["p2.json"] and visible(tmp_path / "_rejected") == ["p_1.json"]
    assert perfile.quarantine(str(tmp_path), str(tmp_path / "aside"), ["p2.json", "none.json"]) == 1 and visible(tmp_path / "aside") == ["p2.json"]
