from __future__ import annotations

import itertools
import random
import re

import numpy as np
import pyarrow as pa
import pytest
import xxhash

from corpusloom.llm import linedup, shingles, simhash
from corpusloom.llm.graph import connected_components

from .data import LETTERS, docs, empty, rows, sentence


def plain_fingerprint(text: str | None, k: int = 4) -> int:
    lower = re.sub("[A-Z]+", lambda m: m.group().lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lower)
    shingles = [" ".join(words[i : i + k]) for i in range(max(1, len(words) - k + 1))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(fps: dict, bits: int = 4) -> dict:
    root = {i: i for i in fps}

    def find(i):
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    for i in fps:
        for j in fps:
            if i < j and (fps[i] ^ fps[j]).bit_count() <= bits:
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return {i: find(i) for i in fps}


def test_fingerprint_is_the_definition():
    for _, text, *_ in rows(n=20):
        assert simhash.fingerprint(text) == plain_fingerprint(text)
    assert simhash.fingerprint(None) == simhash.fingerprint(" \n") == 0
    assert simhash.fingerprint("A b") == xxhash.xxh64_intdigest("a b", 42)


@pytest.mark.parametrize("many", [simhash.MANY, 0])
def test_near_duplicates_match_brute_force(spark, monkeypatch, many):
    monkeypatch.setattr(simhash, "MANY", many)
    got = simhash.near_duplicates(docs(spark).where("doc_id is not null")).collect()
    texts = [r for r in rows() if r[0] is not None]
    assert len(got) == len(texts)
    nodes = {(r[0], n): plain_fingerprint(r[1]) for n, r in enumerate(texts)}
    roots = components(nodes)
    want = {}
    for node, root in roots.items():
        least = min(n[0] for n in nodes if roots[n] == root)
        want[node[0], nodes[node]] = least
    assert all(want[r.doc_id, r.fp % (1 << 64)] == r.component_id for r in got)


def cluster(seed: int, n: int) -> list[int]:
    rng = random.Random(seed)
    base = rng.getrandbits(64)
    out = {base}
    while len(out) < n:
        out.add(rng.choice(sorted(out)[:9]) ^ sum(1 << b for b in rng.sample(range(64), rng.randint(1, 4))))
    return sorted(out | {rng.getrandbits(64) for _ in range(n // 4)})


@pytest.mark.parametrize("segments, width", [(3, 1), (5, 2)])
@pytest.mark.parametrize("short, block", [(64, 1024), (2, 3)])
def test_links_connect_what_brute_force_connects(spark, monkeypatch, segments, width, short, block):
    fps = cluster(3, 60)
    frame = spark.createDataFrame([(int(np.uint64(f).astype(np.int64)),) for f in fps], "fp long")
    rdd_safe = simhash.links
    if short != 64:  # long runs, on the driver's and the workers' side
        monkeypatch.setattr(simhash, "SHORT_RUN", short)
        monkeypatch.setattr(simhash, "BLOCK", block)
        spread = sorted((r.tag, r.val, r.fp) for r in simhash._candidates(frame, simhash.key_masks(4, segments, width)).collect())
        import pyarrow as pa

        batches = [pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*spread[i : i + 50]), (pa.int32(), pa.int64(), pa.int64()))], ["tag", "val", "fp"]) for i in range(0, len(spread), 50)]
        found = [r for b in simhash._compare(4)(iter(batches)) for r in b.to_pylist()]
        todo = [pa.RecordBatch.from_arrays([pa.array([r["todo"] for r in found if r["todo"]], pa.binary())], ["todo"])]
        edges = [(r["u"], r["v"]) for r in found if r["todo"] is None] + [(r["u"], r["v"]) for b in simhash._block_pairs(4)(iter(todo)) for r in b.to_pylist()]
        assert any(r["todo"] for r in found)
    else:
        edges = [tuple(r) for r in rdd_safe(frame, 4, segments, width).collect()]
    want = components({f: f for f in fps})
    graph = {f: f for f in fps}

    def find(i):
        while graph[i] != i:
            i = graph[i]
        return i

    for u, v in edges:
        u, v = u % (1 << 64), v % (1 << 64)
        assert (u ^ v).bit_count() <= 4
        a, b = sorted((find(u), find(v)))
        graph[b] = a
    assert {f: find(f) for f in fps} == want


def test_key_masks_refuse_to_miss():
    with pytest.raises(ValueError):
        simhash.key_masks(4, 2, 1)
    assert len(simhash.key_masks(4, 5, 2)) == 10


def test_one_document_of_each_group_stays(spark):
    classes = {(r.doc_id, r.text_hash): r.component_id for r in simhash.near_duplicates(docs(spark)).collect()}
    kept = simhash.drop_near_duplicates(docs(spark))
    assert kept.columns == docs(spark).columns
    ids = [r.doc_id for r in kept.collect()]
    assert sorted(ids, key=str) == sorted((k[0] for k, c in classes.items() if k[0] == c), key=str)
    assert simhash.drop_near_duplicates(empty(spark)).count() == simhash.near_duplicates(empty(spark)).count() == 0


def plain_shingles(text: str | None, k: int = 5) -> frozenset:
    lower = re.sub("[A-Z]+", lambda m: m.group().lower(), text or "")
    own = re.findall(r"[^\x20\x09-\x0D]+", lower)
    return frozenset(tuple(own[i : i + k]) for i in range(max(1, len(own) - k + 1))) if own else frozenset()


def reworded(seed: int, n: int = 160) -> dict[int, str]:
    """Texts with copies that have a few words replaced, some of them copies of copies, and a common passage."""
    rng = random.Random(seed)
    passage, out = sentence(rng, 40), {}
    for i in range(n):
        words = out[rng.randrange(i)].split(" ") if i and rng.random() < 0.7 else (sentence(rng, rng.randint(1, 90)) + " " + passage).split(" ")
        for _ in range(rng.randint(0, 3)):
            words[rng.randrange(len(words))] = rng.choice(LETTERS) * 8
        out[i] = " ".join(words)
    return out


@pytest.mark.parametrize("seed, bits", [(1, 23), (2, 8), (3, 1)])
def test_one_of_each_group_of_similar_shingles_stays(spark, monkeypatch, seed, bits):
    monkeypatch.setattr(shingles, "TABLE_BITS", bits)
    texts = reworded(seed)
    sets = {i: plain_shingles(t) for i, t in texts.items()}
    root = {i: i for i in texts}
    far = 0
    for i, j in itertools.combinations(texts, 2):
        if 5 * len(sets[i] & sets[j]) >= 4 * len(sets[i] | sets[j]):
            far += (plain_fingerprint(texts[i]) ^ plain_fingerprint(texts[j])).bit_count() > 4
            a, b = sorted((root[i], root[j]))
            root = {k: a if r == b else r for k, r in root.items()}
    assert far > 20 and 20 < len(set(root.values())) < 140
    frame = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    kept = [r.doc_id for r in simhash.drop_near_duplicates(frame).collect()]
    assert sorted(kept) == sorted(set(root.values()))


def test_a_worker_holds_few_words_and_makes_sets_of_few_rows(monkeypatch):
    words = [str(i) for i in range(3 * shingles.MOST_WORDS)]
    shingles._known.clear()
    found = shingles.shingle_hashes(" ".join(words))
    assert len(shingles._known) <= shingles.MOST_WORDS <= 1 << 16
    assert (found[-3:] == shingles.shingle_hashes(" ".join(words[-7:]))).all()
    monkeypatch.setattr(shingles, "ROWS", 4)
    parts = list(shingles._slices([pa.record_batch({"x": list(range(n))}) for n in (9, 0, 4)]))
    assert [b.num_rows for b in parts] == [4, 4, 1, 4]
    assert [x for b in parts for x in b.column(0).to_pylist()] == [*range(9), *range(4)]


def test_one_stays_where_ids_repeat_or_are_null(spark):
    texts = [sentence(random.Random(seed), 90) for seed in range(2)]
    rows_ = [(i, t + end) for i, t in zip((5, None), texts) for end in ("", " one", " two")]
    kept = simhash.drop_near_duplicates(spark.createDataFrame(rows_, "doc_id long, text string")).collect()
    assert sorted((r.doc_id for r in kept), key=str) == [5, None]


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(50)] + [(100, x) for x in range(101, 140)] + [(5, 5), (200, 201), (201, 200)]
    got = {r.node: r.root for r in connected_components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {i: 0 for i in range(51)} | {i: 100 for i in range(100, 140)} | {200: 200, 201: 200}
    assert connected_components(spark.createDataFrame([], "u long, v long")).count() == 0


def words(line: str) -> int:
    return len(re.findall(r"[^\x20\x09-\x0D]+", line))


def plain_line_dedup(texts: dict, least: int) -> dict:
    """Every run with enough words that stands earlier goes, line by line."""
    lines = {i: t.split("\n") for i, t in texts.items()}
    first: dict[tuple, tuple] = {}
    for i in sorted(lines):
        for a in range(len(lines[i])):
            for z in range(a + 1, len(lines[i]) + 1):
                first.setdefault(tuple(lines[i][a:z]), (i, a))
    out = {}
    for i, own in lines.items():
        gone = set()
        for a in range(len(own)):
            for z in range(a + 1, len(own) + 1):
                if sum(map(words, own[a:z])) >= least and first[tuple(own[a:z])] < (i, a):
                    gone |= set(range(a, z))
        out[i] = "\n".join(x for n, x in enumerate(own) if n not in gone)
    return out


@pytest.mark.parametrize("seed", range(3))
def test_line_dedup_is_the_definition(spark, seed):
    rng = random.Random(seed)
    pool = [sentence(rng, n) for n in (1, 2, 3, 5, 8, 3)] + ["", " "]
    texts = {i: "\n".join(rng.choice(pool) for _ in range(rng.randint(1, 9))) for i in range(25)}
    frame = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    got = {r.doc_id: r.text for r in linedup.drop_repeated_lines(frame, min_words=9).collect()}
    assert got == plain_line_dedup(texts, 9)


def test_line_dedup_of_awkward_rows(spark):
    got = linedup.drop_repeated_lines(docs(spark), min_words=50)
    assert got.count() == len(rows())
    by = {(r.doc_id, r.n_lines): r for r in got.collect()}
    assert by[100, 0].text is None and by[101, 1].text == ""
    assert by[0, 2].n_deleted == 0 and by[3, 2].n_deleted == 2 and by[3, 2].text == ""
    kept = linedup.dedup_documents(docs(spark), min_words=50)
    assert kept.columns == docs(spark).columns
    ids = [r.doc_id for r in kept.collect()]
    long = words(rows()[7][1].replace("\n", " ")) >= 50
    assert 3 not in ids and {0, 100, 101, 102, 103, 104, 105} <= set(ids) and ids.count(7) == (2 if long else 4)
    assert linedup.drop_repeated_lines(empty(spark)).count() == 0


def test_line_dedup_of_rows_that_repeat(spark):
    rng = random.Random(4)
    long, short = sentence(rng, 30) + "\n" + sentence(rng, 30), sentence(rng, 20)
    data = [(1, long, "a"), (1, long, "b"), (1, long, "c"), (None, long, "d"), (None, long, "e"), (2, short, "f"), (2, short, "g"), (None, None, "h"), (None, None, "i")]
    got = linedup.drop_repeated_lines(spark.createDataFrame(data, "doc_id long, text string, _key string").repartition(4), min_words=50).collect()
    assert len(got) == len(data)
    # A null id comes first, so one of its rows keeps the text and every other copy loses it.
    assert sorted((r.doc_id, r.text, r.n_deleted) for r in got if r.doc_id is None and r.text is not None) == [(None, "", 2), (None, long, 0)]
    assert [(r.text, r.n_lines, r.n_deleted) for r in got if r.doc_id == 1] == [("", 2, 2)] * 3
    assert [(r.text, r.n_deleted) for r in got if r.doc_id == 2] == [(short, 0)] * 2
    assert [r.text for r in got if r.n_lines == 0] == [None, None]
    kept = linedup.dedup_documents(spark.createDataFrame(data, "doc_id long, text string, _key string"), min_words=50).collect()
    assert sum(r.text == long for r in kept) == 1 and len(kept) == 5


def test_line_dedup_plan_has_no_python(spark):
    plan = linedup.drop_repeated_lines(docs(spark))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
