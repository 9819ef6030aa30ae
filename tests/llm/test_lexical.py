from __future__ import annotations

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from corpusloom.llm import lexical

from .data import docs, empty, rows, sentence

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def plain_terms(text: str | None) -> list[str]:
    return TERM.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(table: list[tuple], items: list[tuple], k: int) -> list[tuple]:
    bags = [(i, Counter(plain_terms(t))) for i, t in table]
    bags = [(i, b) for i, b in bags if b]
    n, words = len(bags), sum(sum(b.values()) for _, b in bags)
    df = Counter(t for _, b in bags for t in b)
    out = []
    for item, text in items:
        found = []
        for doc, bag in bags:
            m = 75 + 25 * sum(bag.values()) * n // words
            score = 0
            for t in plain_terms(text):
                if t in bag:
                    score += math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (1_000_000_000 * bag[t] // (1000 * bag[t] + 12 * m))
            if score > 0:
                found.append((-score, doc is None, doc))
        out += [(item, r, d, -s) for r, (s, _, d) in enumerate(sorted(found, key=lambda x: (x[0], x[1], x[2] or 0))[:k], 1)]
    return out


def items() -> list[tuple]:
    rng = random.Random(5)
    texts = [r[1] for r in rows() if r[1]]
    out = [(i, " ".join(rng.choice(texts).split()[:12]) + " " + sentence(rng, 3)) for i in range(12)]
    return out + [(50, None), (51, "zzzz qqqq"), (52, "É ß 😀 long"), (None, "one two"), (3, "one long"), (3, "one long")]


@pytest.mark.parametrize("shard_bytes, block", [(1 << 24, 1 << 22), (3000, 400)])
def test_search_matches_brute_force(spark, monkeypatch, shard_bytes, block):
    monkeypatch.setattr(lexical, "BLOCK_BYTES", block)
    asked = spark.createDataFrame(items(), "item_id long, text string")
    got = lexical.search(docs(spark), asked, k=7, shard_bytes=shard_bytes).collect()
    want = brute([r[:2] for r in rows()], items(), 7)
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)


def test_sums_beyond_doubles_are_exact():
    exact, wanted = lexical.EXACT, [Counter({0: 3, 1: 1}), Counter({1: 2})]
    weights = np.array([7, 11])
    plain = lexical.Scorer(wanted, weights, 10, 100)
    try:
        lexical.EXACT = 0
        wide = lexical.Scorer(wanted, weights, 10, 100)
    finally:
        lexical.EXACT = exact
    assert plain.exact and not wide.exact
    assert plain([0, 1], [1, 2], 9).tolist() == wide([0, 1], [1, 2], 9).tolist()


def test_numbers_survive_packing():
    rng = np.random.default_rng(1)
    for numbers in (np.array([], np.int64), np.array([0, 1, 127, 128, 1 << 40, (1 << 62) + 5]), rng.integers(0, 1 << 20, 1000)):
        code, width = lexical.pack_numbers(numbers)
        assert lexical.unpack_numbers(code).tolist() == numbers.tolist() and width.sum() == len(code)


def test_postings_come_by_in_document_order():
    lists = {4: [(0, 2), (5, 1), (300, 9)], 9: [(5, 3)], 11: [(1, 1), (5, 1)]}
    codes = [lexical.pack_numbers(np.array([x for n, (d, tf) in enumerate(p) for x in (d - (p[n - 1][0] if n else 0), tf)]))[0] for p in lists.values()]
    starts = np.cumsum([0, *map(len, codes)])[:-1].tolist()
    import zstandard

    got = list(lexical.Postings(list(lists), starts, zstandard.compress(np.concatenate(codes).tobytes())).documents())
    assert got == [(0, [4], [2]), (1, [11], [1]), (5, [4, 9, 11], [1, 3, 1]), (300, [4], [9])]


def test_empty_tables(spark):
    asked = spark.createDataFrame(items(), "item_id long, text string")
    assert lexical.search(empty(spark), asked).collect() == []
    assert lexical.search(docs(spark), asked.limit(0)).collect() == []
