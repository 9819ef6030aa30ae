from __future__ import annotations

import json

from corpusloom.streaming import harvest


def lines(path, rows):
    path.write_text("".join(json.dumps(r) + "\n" for r in rows))


def test_replayed_batches_add_no_rows(spark, tmp_path):
    incoming, store, state = tmp_path / "in", str(tmp_path / "store"), str(tmp_path / "state")
    incoming.mkdir()
    lines(incoming / "1.json", [{"title": "A", "arxiv_id": "1"}, {"title": "A!", "arxiv_id": "2"}, {"title": "B", "arxiv_id": "1v2"}])
    harvest.start_harvest(spark, str(incoming), store, state).awaitTermination()
    assert sorted(r.title for r in harvest.read_store(spark, store).collect()) == ["A"]
    lines(incoming / "2.json", [{"title": "a", "arxiv_id": "9"}, {"title": "C", "arxiv_id": "3"}])
    harvest.start_harvest(spark, str(incoming), store, state).awaitTermination()
    assert sorted(r.title for r in harvest.read_store(spark, store).collect()) == ["A", "C"]
    batch = spark.read.schema(harvest.S.CANDIDATE).json(str(incoming / "2.json"))
    harvest.merge_batch(batch, store, 1)
    assert sorted(r.title for r in harvest.read_store(spark, store).collect()) == ["A", "C"]
