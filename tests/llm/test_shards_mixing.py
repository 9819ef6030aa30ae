from __future__ import annotations

import collections
import zlib

from corpusloom.llm import mixing, shards

from .data import docs, empty, rows


def words(t):
    return len((t or "").replace("\n", " ").replace("\t", " ").split(" ")) - (t or "").replace("\n", " ").replace("\t", " ").split(" ").count("")


def test_shards_match_the_mixture(spark):
    got = shards.assign_shards(docs(spark), 8, rows_per_bucket=4).collect()
    assert len(got) == len(rows())
    by = collections.defaultdict(list)
    for r in got:
        by[r.shard].append(r)
    sizes = [len(v) for v in by.values()]
    assert set(by) == set(range(8)) and max(sizes) - min(sizes) <= 1
    assert all(sorted(r.slot for r in v) == list(range(len(v))) for v in by.values())
    source = {r[0]: r[3] for r in rows()}
    hot = [sum(source.get(r.doc_id) == "hot" for r in v) for v in by.values()]
    assert max(hot) - min(hot) <= 2
    text = {(r[0], len((r[1] or "").encode()) + 1): zlib.crc32((r[1] or "").encode()) for r in rows()}
    assert all(text[r.doc_id, r["size"]] == r.text_crc32 for r in got)


def test_shards_do_not_depend_on_buckets_or_order(spark):
    key = lambda r: (str(r.doc_id), r["size"], r.text_crc32, r.shard, r.slot)
    one = sorted(map(key, shards.assign_shards(docs(spark), 3, rows_per_bucket=2).collect()))
    two = sorted(map(key, shards.assign_shards(docs(spark).repartition(5), 3, rows_per_bucket=10**6).collect()))
    assert one == two


def test_shards_of_few_rows(spark):
    assert shards.assign_shards(empty(spark)).count() == 0
    assert sorted((r.shard, r.slot) for r in shards.assign_shards(docs(spark).where("doc_id = 103"), 8).collect()) == [(7, 0)]


def test_written_shards_hold_whole_rows(spark, tmp_path):
    shards.write_shards(docs(spark), str(tmp_path / "s"), 4)
    back = spark.read.parquet(str(tmp_path / "s"))
    assert back.count() == len(rows()) and back.select("shard").distinct().count() == 4
    assert back.select("row.*").schema == docs(spark).schema
    key = lambda r: (str(r.doc_id), str(r.text))
    assert sorted(map(key, back.select("row.*").collect())) == sorted(map(key, docs(spark).collect()))
    assert sorted((r.shard, r.slot) for r in back.collect()) == sorted((r.shard, r.slot) for r in shards.assign_shards(docs(spark), 4).collect())


def repeated(spark):
    """A row that stands 150 times, one text under 150 null ids, and 150 others, in one source."""
    hot = [(7, "one hot row of eight words in all", "en", "s0")] * 150 + [(None, "no id at all but the same text", "en", "s0")] * 150
    return spark.createDataFrame(hot + [(1000 + i, "word " * (1 + i % 9), "de", "s0" if i % 2 else None) for i in range(150)], "doc_id long, text string, lang string, source string").repartition(6)


def test_rows_that_repeat_are_dealt_one_by_one(spark):
    got = shards.assign_shards(repeated(spark), 8).collect()
    for i in (7, None):
        held = collections.Counter(r.shard for r in got if r.doc_id == i)
        assert len(held) == 8 and max(held.values()) < 40
    mixed = mixing.mix(repeated(spark), budget=0.6).collect()
    for s in {r.source_size for r in mixed}:
        taken, target = sum(r.taken for r in mixed if r.source_size == s), next(r.target for r in mixed if r.source_size == s)
        assert abs(taken - target) <= 9
    copies = sorted((str(r.doc_id), r["size"], r.taken) for r in mixed)
    assert copies == sorted((str(r.doc_id), r["size"], r.taken) for r in mixing.mix(repeated(spark).coalesce(1), budget=0.6).collect())
    documents = mixing.mix_documents(repeated(spark), budget=0.6)
    assert documents.count() == sum(r.copies for r in mixed) and documents.where("doc_id = 7").count() == sum(r.copies for r in mixed if r.doc_id == 7)


def targets(sizes: dict, weights=(3, 1, 2), budget=1.5, cap=2.0) -> dict:
    """Share by weight; what is above a cap is shared again among the others."""
    names = sorted(sizes, key=lambda s: (s is None, s))
    weight = {s: weights[i % 3] for i, s in enumerate(names)}
    out, left, open_ = {}, budget * sum(sizes.values()), set(names)
    while open_:
        level = left / sum(weight[s] for s in open_)
        over = {s for s in open_ if level * weight[s] > cap * sizes[s]}
        if not over:
            return out | {s: level * weight[s] for s in open_}
        for s in over:
            out[s] = cap * sizes[s]
            left -= out[s]
        open_ -= over
    return out


def test_mix_meets_targets(spark):
    got = mixing.mix(docs(spark, 120)).collect()
    source = {(r[0], words(r[1])): r[3] for r in rows(n=120)}
    sizes, taken, biggest, target = collections.Counter(), collections.Counter(), collections.Counter(), {}
    for r in got:
        s = source[r.doc_id, r["size"]]
        sizes[s] += r["size"]
        taken[s] += r.taken
        biggest[s] = max(biggest[s], r["size"])
        target[s] = r.target
        assert r.taken in (0, r["size"], 2 * r["size"])
    assert all(r.source_size == sizes[source[r.doc_id, r["size"]]] for r in got)
    for s, t in targets(dict(sizes)).items():
        assert abs(target[s] - t) < 1e-6 * max(1, t)
        assert abs(taken[s] - t) <= 3 * biggest[s]


def test_mix_repeats_and_agrees_with_documents(spark):
    key = lambda r: (str(r.doc_id), r["size"], r.taken)
    assert sorted(map(key, mixing.mix(docs(spark)).collect())) == sorted(map(key, mixing.mix(docs(spark).repartition(3)).collect()))
    copies = sum(r.copies for r in mixing.mix(docs(spark)).collect())
    mixed = mixing.mix_documents(docs(spark))
    assert mixed.count() == copies and mixed.columns == docs(spark).columns


def test_mix_is_the_same_with_salted_thresholds(spark, monkeypatch):
    key = lambda r: (str(r.doc_id), r["size"], r.taken)
    before = sorted(map(key, mixing.mix(docs(spark)).collect()))
    monkeypatch.setattr(mixing, "BROADCAST_SOURCES", 0)
    assert sorted(map(key, mixing.mix(docs(spark)).collect())) == before


def test_mix_of_nothing(spark):
    assert mixing.mix(empty(spark)).count() == 0
    blank = docs(spark).where("doc_id in (100, 101, 102)")
    assert [(r.target, r.taken) for r in mixing.mix(blank).collect()] == [(0.0, 0)] * 3


def test_native_plans_have_no_python(spark):
    plan = mixing.mix(docs(spark))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
