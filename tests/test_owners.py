from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from corpusloom.operators import asof, identity, owners
from corpusloom.operators.skew import join_frequent

from .test_operators import papers


def in_order(rows: list[dict]) -> list[dict]:
    """The rule, one row after the other."""
    kept: list[dict] = []
    place: dict = {}
    keys = lambda p: [(k, p[k].lower()) for k in ("arxiv_id", "doi", "title") if p.get(k)]
    for row in rows:
        at = next((place[k] for k in keys(row) if k in place), None)
        if at is None:
            at = len(kept)
            kept.append(dict(row))
        else:
            for name, value in row.items():
                old = kept[at].get(name)
                if name == "seq" or value in (None, "", []):
                    continue
                if name == "venue":
                    open_ = (old or "") in ("", "Unknown", "arXiv preprint") or old.startswith("arXiv (")
                elif name == "field":
                    open_ = old in (None, "", "Unknown")
                else:
                    open_ = not old
                if open_:
                    kept[at][name] = value
        place.update(dict.fromkeys(keys(kept[at]), at))
    return kept


def random_rows(seed: int, n: int, names: int, hot: float) -> list[dict]:
    rng = random.Random(seed)
    pick = lambda p, values: rng.choice(values) if rng.random() < p else rng.choice([None, ""])
    return [
        {
            "seq": i,
            "title": "hot title" if rng.random() < hot else pick(0.8, [f"t{k}" for k in range(names)]),
            "arxiv_id": pick(0.5, [f"a{k}" for k in range(names)]),
            "doi": pick(0.5, [f"d{k}" for k in range(names)]),
            "venue": rng.choice([None, "", "Unknown", "arXiv preprint", "arXiv (x)", "ICML", "Nature"]),
            "field": rng.choice([None, "", "Unknown", "Bio", "Math"]),
            "year": rng.choice([None, 2001, 2002]),
            "citation_count": rng.choice([None, 0, 3, 4]),
            "keywords": rng.choice([None, [], ["k"], ["l", "m"]]),
        }
        for i in range(n)
    ]


@pytest.mark.parametrize("seed, n, names, hot", [(1, 60, 6, 0.0), (2, 90, 30, 0.0), (3, 80, 15, 0.9), (4, 40, 3, 0.3)])
def test_merging_equals_the_sequential_run(spark, seed, n, names, hot):
    rows = random_rows(seed, n, names, hot)
    columns = list(rows[0])
    got = identity.merge_duplicates(papers(spark, rows)).select(*columns).collect()
    assert sorted(map(tuple, got), key=lambda r: r[0]) == sorted((tuple(k[c] for c in columns) for k in in_order(rows)), key=lambda r: r[0])


def test_a_founder_that_joins_another_takes_its_rows_along(spark):
    rows = [{"seq": 0, "doi": "d", "title": "a"}, {"seq": 1, "doi": "d", "title": "b"}] + [{"seq": i, "title": "b"} for i in range(2, 9)]
    assert sorted(r.seq for r in identity.merge_duplicates(papers(spark, rows)).collect()) == [k["seq"] for k in in_order(rows)]


def test_estimated_sizes_do_not_multiply_over_rounds(spark, monkeypatch):
    digits = []
    looked_up = owners._looked_up
    size = lambda df: len(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    monkeypatch.setattr(owners, "_looked_up", lambda asked, claims: digits.append(size(claims)) or looked_up(asked, claims))
    identity.merge_duplicates(papers(spark, random_rows(2, 90, 30, 0.0))).collect()
    assert len(digits) > 3 and digits[-1] <= digits[1] + 10, digits


def test_a_round_is_few_jobs(spark, monkeypatch):
    """The driver keeps a plan of every query, so their number must not be dozens a round."""
    rounds = []
    looked_up = owners._looked_up
    monkeypatch.setattr(owners, "_looked_up", lambda *a: rounds.append(1) or looked_up(*a))
    rows = papers(spark, random_rows(2, 90, 30, 0.0)).localCheckpoint()
    spark.sparkContext.setJobGroup("merge", "merge")
    try:
        identity.merge_duplicates(rows).collect()
        jobs = len(spark.sparkContext.statusTracker().getJobIdsForGroup("merge"))
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert len(rounds) > 2 and jobs <= 25 * len(rounds) + 25, (jobs, len(rounds))


def test_rows_that_do_not_settle_are_an_error(spark, monkeypatch):
    monkeypatch.setattr(owners, "MOST_ROUNDS", 0)
    with pytest.raises(RuntimeError):
        identity.merge_duplicates(papers(spark, [{"seq": 0, "title": "a"}]))


def test_empty_tables_merge_to_nothing(spark):
    assert identity.merge_duplicates(papers(spark, [{"seq": 0, "title": "a"}]).limit(0)).collect() == []


def test_a_hot_title_is_no_single_task(spark):
    n = 4000
    rows = spark.range(n).select((F.col("id") % 10 == 0).alias("other"), F.col("id").alias("seq")).withColumn("key", F.when(F.col("other"), F.concat(F.lit("t"), F.col("seq"))).otherwise("hot"))
    spark.conf.set("spark.sql.shuffle.partitions", "40")
    try:
        found = asof.last_before(rows.withColumn("v", F.when(F.col("seq") == 1, 1)), ["key"], ["seq"], "v", "w")
        sizes = [r["count"] for r in found.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert max(sizes) <= 0.05 * n
    assert found.where("key = 'hot' and w is null").count() == 0 and found.where("key <> 'hot' and w is not null").count() == 0


@pytest.mark.parametrize("strict", [False, True])
def test_asof_join_equals_a_search(spark, strict):
    rng = random.Random(7)
    right = [(rng.choice(["a", "b", "c", None]), rng.choice([None, *range(30)]), rng.choice([None, *range(100)])) for _ in range(60)]
    left = [(i, rng.choice(["a", "a", "a", "b", "z", None]), rng.choice([None, *range(35)])) for i in range(200)]
    lf = spark.createDataFrame(left, "i int, k string, at int").repartition(7)
    rf = spark.createDataFrame(right, "k string, at int, v int")
    got = {r.i: r.found for r in asof.asof_join(lf, rf, "k", "at", "v", "found", strict=strict).collect()}
    assert len(got) == 200
    for i, k, at in left:
        held = [(p, v) for key, p, v in right if None not in (k, at, key, p, v) and key == k and (p < at if strict else p <= at)]
        assert got[i] == (max(held)[1] if held else None)


@pytest.mark.parametrize("share", [2, 1024])
def test_frequent_keys_are_joined_whole(spark, share):
    left = spark.createDataFrame([(i, "hot" if i % 3 else f"k{i}") for i in range(90)] + [(91, None)], "n int, k string")
    right = spark.createDataFrame([("hot", 1), ("k3", 2), ("none", 3)], "k string, v int")
    want = sorted([(i, 1) for i in range(90) if i % 3] + [(3, 2)])
    assert sorted((r.n, r.v) for r in join_frequent(left, right, "k", share).collect()) == want
    assert join_frequent(left, right, "k", share, how="left").count() == 91
