from __future__ import annotations

import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from corpusloom.llm import repeats

from .data import docs, empty, rows, sentence


def brute(texts: list[str | None], width: int) -> list[tuple]:
    """(n_bytes, n_removed, n_spans, kept_sha256) of each text, window by window."""
    raw = [(t or "").encode() for t in texts]
    seen = Counter(t[i : i + width] for t in raw for i in range(len(t) - width + 1))
    out = []
    for t in raw:
        gone = np.zeros(len(t) + 2, np.int64)
        for i in range(len(t) - width + 1):
            if seen[t[i : i + width]] > 1:
                gone[i] += 1
                gone[i + width] -= 1
        covered = np.cumsum(gone)[: len(t)] > 0
        kept = bytes(np.frombuffer(t, np.uint8)[~covered]) if t else b""
        spans = int(np.sum(np.diff(np.concatenate(([False], covered)).astype(int)) == 1))
        out.append((len(t), int(covered.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return out


@pytest.mark.parametrize("alphabet", [b"ab", b"abcdefgh"])
def test_transform_finds_what_counting_finds(alphabet):
    rng = random.Random(len(alphabet))
    for trial in range(80):
        width = rng.choice([3, 5, 8, 9, 13, 20])
        chunks = [bytes(rng.choice(alphabet) for _ in range(rng.randint(0, 60))) for _ in range(rng.randint(1, 8))]
        chunks += [chunks[0] + b"x", b"", b"aaaaaaaaaaaaaaaaaaaaaaaaaaaaaa"][: trial % 4]
        weights = [rng.choice([1, 1, 2]) for _ in chunks]
        seen: Counter = Counter()
        for c, m in zip(chunks, weights):
            for i in range(len(c) - width + 1):
                seen[c[i : i + width]] += m
        for c, found in zip(chunks, repeats.repeated_windows(chunks, weights, width)):
            assert [x for a, z in found for x in range(a, z + 1)] == [i for i in range(len(c) - width + 1) if seen[c[i : i + width]] > 1]


def test_prefixes_are_those_of_the_suffixes():
    rng = np.random.default_rng(3)
    s = rng.integers(97, 100, 300).astype(np.uint8)
    order, width, text = repeats.suffix_order(s, 12), 12, s.tobytes() + b"\xff" * 12
    assert [text[i : i + width] for i in order] == sorted(text[i : i + width] for i in range(300))
    marked = repeats.common_prefix_boundaries(s, order, width)
    inside = [i for i in range(1, 300) if max(order[i], order[i - 1]) <= 300 - width]
    assert [bool(marked[i]) for i in inside] == [text[order[i] : order[i] + width] != text[order[i - 1] : order[i - 1] + width] for i in inside]


def test_equal_windows_have_equal_minimizers(monkeypatch):
    monkeypatch.setattr(repeats, "BLOCK", 150)
    rng, width, gram = random.Random(2), 40, 8
    texts = [bytes(rng.choice(b"abc ") for _ in range(rng.randint(0, 700))) for _ in range(20)]
    texts.append(texts[3])
    seen, covered = {}, Counter()
    for block, ends, number, offset in repeats._blocks(enumerate(texts), width):
        for a, z, p, key in zip(*(x.tolist() for x in repeats.minimizers(block, ends, width, gram))):
            piece = int(np.searchsorted(ends, a, "right"))
            for i in range(a, z + 1):
                window = block[i : i + width].tobytes()
                assert seen.setdefault(window, (key, p - i)) == (key, p - i) and 0 <= p - i <= width - gram
                covered[int(number[piece]), i - int(ends[piece - 1] if piece else 0) + int(offset[piece])] += 1
    assert set(covered.values()) == {1}
    assert set(covered) == {(n, i) for n, t in enumerate(texts) for i in range(len(t) - width + 1)}


def awkward() -> list[str | None]:
    rng = random.Random(9)
    shared = [sentence(rng, n) for n in (30, 45, 60)]
    out: list[str | None] = [r[1] for r in rows(n=25)]
    out += [f"{sentence(rng, 5)} {rng.choice(shared)} {sentence(rng, rng.randint(1, 9))}" for _ in range(60)]
    out += [shared[0][:199], shared[0][:200], shared[0][1:201], "é" * 150, "é" * 100 + "x", "ab" * 400, shared[1] + shared[1]]
    return out


@pytest.mark.parametrize("hot, most, sparse", [(1 << 11, 900_000, 1 << 23), (3, 900_000, 0), (3, 700, 1 << 23), (1 << 11, 3000, 0)])
def test_removed_bytes_match_brute_force(spark, monkeypatch, hot, most, sparse):
    monkeypatch.setattr(repeats, "SPARSE", sparse)
    monkeypatch.setattr(repeats, "HOT", hot)
    monkeypatch.setattr(repeats, "GROUP_BYTES", most)
    monkeypatch.setattr(repeats, "CHUNKS", 20_000)
    texts = awkward()
    table = spark.createDataFrame([(i if i % 9 else None, t, 1, b"x") for i, t in enumerate(texts)], "doc_id long, text string, m int, h binary")
    outputs = ("n_removed", "n_spans", "kept_sha256")
    got = sorted(tuple(r)[1:] for r in repeats.remove_repeats(table.repartition(5), outputs=outputs).collect())
    assert got == sorted(brute(texts, 200))


def test_long_copies_in_blocks_of_their_own_count_once(spark):
    """Copies of a text of several pieces, among texts that shift where blocks end; its unique parts stay in the single one."""
    rng = random.Random(4)
    long_ = [sentence(rng, 40_000) + str(i) for i in range(2)]
    texts = [long_[0], sentence(rng, 300), long_[0], sentence(rng, 60_000), long_[1], sentence(rng, 500), long_[1][:300_000]]
    table = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string").coalesce(1)
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans) for r in repeats.remove_repeats(table, outputs=("n_removed", "n_spans")).collect()}
    sizes = [len(t) for t in texts]
    shared = min(300_000, sizes[4])
    assert got[0] == got[2] == (sizes[0], sizes[0], 1) and got[6] == (shared, shared, 1) and got[4] == (sizes[4], shared, 1 if shared else 0)
    assert all(got[i] == (sizes[i], 0, 0) for i in (1, 3, 5))


def test_spans_and_kept_bytes_fit_together(spark):
    got = repeats.remove_repeats(docs(spark)).collect()
    assert len(got) == len(rows())
    texts: dict = {}
    for i, t, *_ in rows():
        texts.setdefault(i, []).append((t or "").encode())
    for r in got:
        fits = []
        for t in texts[r.doc_id]:
            edges = [0, *(x for s in r.spans for x in s), len(t)]
            fits.append(b"".join(t[a:z] for a, z in zip(edges[::2], edges[1::2])) == bytes(r.kept))
        assert any(fits)


def test_empty_table_and_short_width(spark):
    assert repeats.remove_repeats(empty(spark)).collect() == []
    with pytest.raises(ValueError):
        repeats.remove_repeats(docs(spark), width=40)


def test_a_transform_holds_few_bytes_for_each_of_its_own():
    import tracemalloc

    rng = random.Random(5)
    words = ["".join(rng.choices("abcdefgh", k=rng.randint(2, 8))) for _ in range(300)]
    texts = [" ".join(rng.choices(words, k=60)).encode() for _ in range(700)]
    chunks = [*texts, *(t[:150] + t[155:] for t in texts[::2])]
    repeats.repeated_windows(chunks, [1] * len(chunks), 200)
    tracemalloc.start()
    repeats.repeated_windows(chunks, [1] * len(chunks), 200)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 65 * sum(map(len, chunks))
