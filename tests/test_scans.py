from __future__ import annotations

import builtins
import json
import os

import pytest

from corpusloom.sources import edges, payloads, recorded


def years(tmp_path):
    for year in (2018, 2019, 2020, 2021):
        for source in ("a", "b"):
            folder = tmp_path / f"year={year}" / f"source={source}"
            folder.mkdir(parents=True)
            (folder / "p.jsonl").write_text("".join(json.dumps({"title": f"{year}{source}{i}", "year": year, "source": source}) + "\n" for i in range(2)))
    return tmp_path


def test_conditions_drop_files_before_they_are_opened(spark, tmp_path):
    spark.dataSource.register(recorded.RecordedSource)
    folder = years(tmp_path)
    assert spark.read.format("recorded").option("path", str(folder)).load().count() == 16
    rows = spark.read.format("recorded").option("path", str(folder)).option("prune", True).load()
    for year in (2018, 2021):
        for source in "ab":
            (folder / f"year={year}" / f"source={source}" / "p.jsonl").write_text("not to be read\n")
    (folder / "year=2019" / "source=b" / "p.jsonl").write_text("not to be read\n")
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    try:
        asked = payloads.search_filter(rows, 2019, 2020).where("source = 'a'")
        assert sorted(r.title for r in asked.collect()) == ["2019a0", "2019a1", "2020a0", "2020a1"]
        assert asked.rdd.getNumPartitions() == 2
        with pytest.raises(Exception):
            rows.where("year = 2018").collect()
        assert rows.where("year in (2019, 2020) and source = 'a' and title like '%1'").count() == 2
    finally:
        spark.conf.unset("spark.sql.python.filterPushdown.enabled")


def test_files_without_such_folders_are_all_read(spark, tmp_path):
    spark.dataSource.register(recorded.RecordedSource)
    (tmp_path / "x.jsonl").write_text(json.dumps({"title": "T", "year": 2019}) + "\n")
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    try:
        rows = spark.read.format("recorded").option("path", str(tmp_path)).option("prune", True).load()
        assert rows.where("year = 2019").count() == 1 and rows.where("year = 2018").count() == 0
    finally:
        spark.conf.unset("spark.sql.python.filterPushdown.enabled")


def pdfs(tmp_path):
    big = b"x" * (3 << 20)
    held = {"good": b"%PDF-1.5" + big + b"%%EOF\n", "cut": b"%PDF-1.5" + big, "page": b"<html>" + big + b"%%EOF", "early": b"%PDF%%EOF" + big, "small": b"%PDF%%EOF", "none": b""}
    for name, content in held.items():
        (tmp_path / f"{name}.pdf").write_bytes(content)
    (tmp_path / "other.txt").write_bytes(b"%PDF%%EOF")
    return held


def test_edges_tell_what_whole_files_tell(spark, tmp_path):
    held = pdfs(tmp_path)
    spark.dataSource.register(edges.EdgeSource)
    scan = spark.read.format("file_edges").option("path", str(tmp_path)).option("pattern", "*.pdf").option("files", 2).load()
    got = {r.paper_id: (r.ok, r.length) for r in scan.select("paper_id", "length", edges.is_pdf(scan["head"], scan["tail"]).alias("ok")).collect()}
    whole = payloads.read_files(spark, str(tmp_path), "*.pdf")
    want = {r.paper_id: (r.ok, r.length) for r in whole.select("paper_id", "length", payloads.is_pdf(whole.content).alias("ok")).collect()}
    assert len(held) == len(got) and got.pop("none") == (False, 0)  # the reader of whole files leaves empty ones out
    assert got == want and {n for n, (ok, _) in got.items() if ok} == {"good", "small"}
    assert scan.rdd.getNumPartitions() == 3


def test_edges_read_little(tmp_path, monkeypatch):
    total, read = sum(map(len, pdfs(tmp_path).values())), []
    plain = builtins.open

    class Counted:
        def __init__(self, f):
            self.f = f

        def __enter__(self):
            return self

        def __exit__(self, *error):
            self.f.close()

        def __getattr__(self, name):
            return getattr(self.f, name)

        def read(self, n=-1):
            read.append(len(found := self.f.read(n)))
            return found

    monkeypatch.setattr(builtins, "open", lambda *a, **k: Counted(plain(*a, **k)))
    reader = edges.EdgeReader({"path": str(tmp_path)})
    parts = reader.partitions()
    rows = [r for p in parts for r in reader.read(p)]
    assert len(rows) == 7 and sum(read) < total / 100
    assert os.path.basename(parts[0].paths[0]) == "cut.pdf"


def test_an_empty_folder_has_no_rows(spark, tmp_path):
    spark.dataSource.register(edges.EdgeSource)
    assert spark.read.format("file_edges").option("path", str(tmp_path)).load().collect() == []
