"""Near copies by the exact Jaccard similarity of word-shingle sets.

Two texts link if the sets of their lower-cased word shingles have a Jaccard similarity of ``least`` or
more. A node is a distinct shingle set, so exact copies cost nothing. Candidates come from two sides:
the caller's own pairs of nodes (fingerprints that lie near one another), and an exact prefix filter:
with the shingles of every set in one common order, two linked sets share a shingle among the first
``n - ceil(least * n) + 1`` of each. Every candidate is verified on the sets themselves.

The common order puts frequent shingles last. Their frequencies are counted over all documents and
kept as one byte (a logarithm) for each of ``1 << TABLE_BITS`` hash buckets, so the table that is
broadcast has the same size for every input. Buckets shared by chance and counts that saturate in a
block change the order, and so the cost, never what is found.

In the run of one prefix shingle every node is first compared with the most typical node of the run, the
one whose shingles are the most frequent on average: of copies of one text that is the text itself, or
the copy with the fewest changes. That joins a large group by as many comparisons as it has members. Then
nodes of a run that still belong to different groups are compared with each other; a copy too far from
its original has that many shingles of its own in front of its first shared one, which mostly rules it
out. No link is lost. Only the sets of candidates are
shuffled: a bitmap of a fixed size picks their documents while the texts are read.

Defined cases: a text is taken whole; null, empty and blank texts have the empty set and are one node;
fewer words than a shingle form one shingle; an empty table gives no rows.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import durable
from .graph import connected_components

_WORD = re.compile(rb"[^\x20\x09-\x0D]+")
_LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))
#: Buckets of the frequency table (a byte each) and bits of the bitmap of candidates' documents.
TABLE_BITS, BITMAP_BITS = 23, 26
#: Shingles that are counted together, the most that one of them counts there, and the bits they keep.
BLOCK, MOST, KEPT_BITS = 1 << 20, 16, 40
#: Words whose hashes a Python worker holds (it outlives its tasks), and rows whose sets are in memory at once.
MOST_WORDS, ROWS = 1 << 15, 1024
_RUN = "key long, u long, ui long, v long, vi long"
_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)).reshape(256, 8).astype(np.int64)


def majority(hashes: np.ndarray) -> int:
    """The 64-bit number whose bits are set in over half of the ``hashes``; zero for none."""
    ones = np.zeros(64, np.int64)
    if len(hashes) < 512:
        ones += np.unpackbits(hashes.astype(">u8").view(np.uint8)).reshape(-1, 64).sum(axis=0, dtype=np.int64)
    else:  # a histogram of each of the 8 bytes gives the same sums
        column = hashes.astype(">u8").view(np.uint8).reshape(-1, 8)
        ones += np.concatenate([np.bincount(column[:, i], minlength=256) @ _BITS for i in range(8)])
    return int.from_bytes(np.packbits(2 * ones > len(hashes)).tobytes(), "big")


class _WordHashes(dict):
    """XXH64 of each word; forgotten when there are too many to hold."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= MOST_WORDS:
            self.clear()
        self[word] = found = xxhash.xxh64_intdigest(word, 42)
        return found


_known = _WordHashes()


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The same rows, at most ``ROWS`` at once: what is made of a row can be larger than the row."""
    for batch in batches:
        for start in range(0, batch.num_rows, ROWS):
            yield batch.slice(start, ROWS)


def shingle_hashes(text: str | None, words_per_shingle: int = 5) -> np.ndarray:
    """A 64-bit hash of every shingle of one whole text, in order, repeats included."""
    words = _WORD.findall((text or "").encode("utf-8", "surrogatepass").translate(_LOWER))
    each = np.fromiter(map(_known.__getitem__, words), np.uint64, len(words))
    width = min(words_per_shingle, len(words))
    n = len(words) - width + 1 if width else 0
    mixed = np.full(n, width, np.uint64)
    for j in range(width):
        mixed = (mixed ^ each[j : j + n]) * np.uint64(0x9E3779B97F4A7C15)
        mixed ^= mixed >> np.uint64(29)
    mixed *= np.uint64(0xBF58476D1CE4E5B9)
    return mixed ^ (mixed >> np.uint64(32))


def shingle_set(text: str | None, words_per_shingle: int = 5) -> np.ndarray:
    """The sorted distinct hashes of the shingles of one whole text."""
    return np.unique(shingle_hashes(text, words_per_shingle))


def prefix_length(n: int, least: float) -> int:
    """How many first shingles of ``n`` meet those of every set that is similar enough."""
    return n - math.ceil(least * n - 1e-9) + 1 if n else 0


def _node(own: np.ndarray) -> int:
    return xxhash.xxh64_intdigest(own.tobytes(), 42)


def _signed(values) -> pa.Array:
    return pa.array(np.array(values, np.uint64).view(np.int64))


def _pack(ascending: np.ndarray) -> bytes:
    """Steps between numbers, byte by byte, compressed."""
    steps = np.diff(ascending, prepend=np.uint64(0))
    return zstandard.compress(np.ascontiguousarray(steps.view(np.uint8).reshape(-1, 8).T).tobytes(), 1)


def _unpack(blob: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.decompress(blob), np.uint8).reshape(8, -1)
    return np.cumsum(np.ascontiguousarray(planes.T).view(np.uint64).ravel(), dtype=np.uint64)


def _first_bucket(part: int, parts: int, bits: int) -> int:
    return -(-(part << bits) // parts)


def _frequencies(docs: DataFrame, text: str, words: int) -> np.ndarray:
    """For every bucket four times the binary logarithm of how often its most frequent shingle stands in all documents."""
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    bits = TABLE_BITS
    starts = np.array([_first_bucket(p, parts, bits) for p in range(parts + 1)], np.uint64) << np.uint64(KEPT_BITS - bits)

    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def flush() -> Iterator[pa.RecordBatch]:
            key, n = np.unique(np.concatenate(held), return_counts=True)
            key = np.repeat(key, np.minimum(n, MOST))
            cuts = np.searchsorted(key, starts).tolist()
            some = [p for p in range(parts) if cuts[p] < cuts[p + 1]]
            yield pa.RecordBatch.from_arrays([pa.array(some, pa.int32()), pa.array([_pack(key[cuts[p] : cuts[p + 1]]) for p in some], pa.binary())], ["part", "blob"])

        for batch in batches:
            for t in batch.column(0):
                held.append(shingle_hashes(t.as_py(), words) >> np.uint64(64 - KEPT_BITS))
                size += len(held[-1])
                if size >= BLOCK:
                    yield from flush()
                    held, size = [], 0
        if size:
            yield from flush()

    def levels(table: pa.Table) -> pa.Table:
        part = table.column("part")[0].as_py()
        keys = np.sort(np.concatenate([_unpack(b) for b in table.column("blob").to_pylist()]))
        at = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
        n = np.diff(np.append(at, len(keys)))
        at, n = at[n > 1], n[n > 1]
        first, end = (_first_bucket(p, parts, bits) for p in (part, part + 1))
        out = np.zeros(end - first, np.uint8)
        np.maximum.at(out, (keys[at] >> np.uint64(KEPT_BITS - bits)).astype(np.int64) - first, np.rint(4 * np.log2(n)).astype(np.uint8))
        return pa.table({"part": pa.array([part], pa.int32()), "levels": pa.array([zstandard.compress(out.tobytes(), 3)], pa.binary())})

    table = np.zeros(1 << bits, np.uint8)
    blobs = docs.select(F.col(text).cast("string")).mapInArrow(listed, "part int, blob binary")
    for row in blobs.groupBy("part").applyInArrow(levels, "part int, levels binary").collect():  # 1 << bits bytes in all
        found = np.frombuffer(zstandard.decompress(row.levels), np.uint8)
        table[(low := _first_bucket(row.part, parts, bits)) : low + len(found)] = found
    return table


def prefixes(docs: DataFrame, key: str, text: str, words: int, least: float) -> DataFrame:
    """``doc_id, text_hash, rid, node, fp, n, rare, prefix``: the hash and size of the shingle set, its fingerprint and first shingles.

    ``rid`` stands for the row; rows that repeat id and text share it. ``rare`` falls as shingles are more frequent.
    """
    text_hash = F.xxhash64(text)
    rows = docs.select(F.col(key).alias("doc_id"), text_hash.alias("text_hash"), F.xxhash64(F.col(key), text_hash).alias("rid"), F.col(text).cast("string").alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    held = docs.sparkSession.sparkContext.broadcast(_frequencies(docs, text, words))  # 1 << TABLE_BITS bytes

    shift = 64 - TABLE_BITS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = held.value
        for batch in _slices(batches):
            node, fp, size, rare, prefix = [], [], [], [], []
            for t in batch.column(3):
                every = shingle_hashes(t.as_py(), words)
                own = np.unique(every)
                level = table[(own >> np.uint64(shift)).astype(np.int64)]
                node.append(_node(own))
                fp.append(majority(every))
                size.append(len(own))
                rare.append(-int(256 * level.mean()) if len(own) else 0)
                prefix.append(own[np.argsort(level, kind="stable")[: prefix_length(len(own), least)]])
            ends = np.cumsum([0, *map(len, prefix)])
            lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), _signed(np.concatenate([np.empty(0, np.uint64), *prefix])))
            cols = [*batch.columns[:3], _signed(node), _signed(fp), pa.array(size, pa.int32()), pa.array(rare, pa.int32()), lists]
            yield pa.RecordBatch.from_arrays(cols, ["doc_id", "text_hash", "rid", "node", "fp", "n", "rare", "prefix"])

    return rows.mapInArrow(run, f"doc_id {kind}, text_hash long, rid long, node long, fp long, n int, rare int, prefix array<long>")


def _beside_first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted ``key, node, info, rare`` rows to the first node of each run beside each other one."""
    before = [np.empty(0, np.int64)] * 3
    for batch in batches:
        if not batch.num_rows:
            continue
        key, node, info = (np.concatenate([b, c.to_numpy()]) for b, c in zip(before, batch.columns[:3]))
        starts = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
        first = np.repeat(starts, np.diff(np.append(starts, len(key))))
        rest = np.flatnonzero(np.arange(len(key)) != first)
        if len(rest):
            at = first[rest]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in (key[rest], node[at], info[at], node[rest], info[rest])], ["key", "u", "ui", "v", "vi"])
        before = [c[starts[-1] : starts[-1] + 1] for c in (key, node, info)]


def _can_link(least: float, u: str, v: str):
    """The sizes allow the similarity, and so do the shingles from a shared one on, if it is the first shared."""
    (un, ui), (vn, vi) = ((F.shiftright(x, 32), F.col(x).bitwiseAND(0xFFFFFFFF)) for x in (u, v))
    sizes = F.least(un, vn) >= least * F.greatest(un, vn) - 1e-9
    return sizes & (F.least(un - ui, vn - vi) >= least / (1 + least) * (un + vn) - 1e-9)


def _marked(rids: DataFrame) -> np.ndarray:
    """A bitmap with the last ``BITMAP_BITS`` bits of every ``rid``."""
    bit = F.col("rid").bitwiseAND((1 << BITMAP_BITS) - 1)
    words = rids.groupBy(F.shiftright(bit, 6).alias("w")).agg(F.bit_or(F.expr("shiftleft(1L, cast(rid & 63 as int))")).alias("b"))
    found = words.toArrow()  # 1 << (BITMAP_BITS - 6) rows at most
    out = np.zeros(1 << (BITMAP_BITS - 6), np.int64)
    out[found.column("w").to_numpy()] = found.column("b").to_numpy()
    return out


def _verified(pairs: DataFrame, reps: DataFrame, docs: DataFrame, key: str, text: str, words: int, least: float) -> DataFrame:
    """The ``u, v`` whose shingle sets are similar enough; only candidates' texts are made into sets again."""
    pairs = durable(pairs)
    wanted = pairs.select(F.col("u").alias("node")).unionByName(pairs.select(F.col("v").alias("node"))).distinct()
    marked = docs.sparkSession.sparkContext.broadcast(_marked(reps.join(wanted, "node").select("rid")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = marked.value
        for batch in _slices(batches):
            rid = batch.column(0).to_numpy()
            at = rid & ((1 << BITMAP_BITS) - 1)
            some = batch.filter(pa.array((bits[at >> 6] >> (at & 63)) & 1 == 1))
            sets = [shingle_set(t.as_py(), words) for t in some.column(1)]
            lists = pa.array([s.view(np.int64) for s in sets], pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([_signed([_node(s) for s in sets]), lists], ["node", "s"])

    texts = docs.select(F.xxhash64(F.col(key), F.xxhash64(text)), F.col(text).cast("string"))
    sets = durable(texts.mapInArrow(run, "node long, s array<long>").groupBy("node").agg(F.first("s").alias("s")))
    left, right = (sets.select(F.col("node").alias(x), F.col("s").alias(x + "s")) for x in "uv")
    both = pairs.join(left, "u").join(right, "v")
    shared = both.select("u", "v", F.size(F.array_intersect("us", "vs")).alias("m"), (F.size("us") + F.size("vs")).alias("n"))
    return durable(shared.where(F.col("m") >= least * (F.col("n") - F.col("m")) - 1e-9).select("u", "v"))


def near_copies(rows: DataFrame, docs: DataFrame, candidates: DataFrame, *, key: str, text: str, words: int, least: float) -> DataFrame:
    """``node, root`` of every node that links with another, from ``prefixes`` rows and candidate pairs ``u, v``."""
    reps = durable(rows.groupBy("node").agg(F.min("rid").alias("rid")))
    nodes = rows.groupBy("node").agg(F.first("n").cast("long").alias("n"), F.first("rare").alias("rare"), F.first("prefix").alias("prefix"))
    spread = nodes.select("node", "n", "rare", F.posexplode("prefix").alias("i", "key")).select("key", "node", (F.shiftleft("n", 32) + F.col("i")).alias("info"), "rare")
    runs = durable(spread.repartition("key").sortWithinPartitions("key", "rare", "node").mapInArrow(_beside_first, _RUN))
    beside = runs.where(_can_link(least, "ui", "vi")).select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v"))
    ordered = candidates.select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).where("u <> v")
    close = _verified(beside.unionByName(ordered).distinct(), reps, docs, key, text, words, least)
    roots = durable(connected_components(close))
    members = runs.select("key", "v", "vi").join(roots.withColumnRenamed("node", "v"), "v", "left").withColumn("root", F.coalesce("root", "v"))
    mixed = members.groupBy("key").agg(F.min("root").alias("_a"), F.max("root").alias("_z")).where("_a <> _z").select("key")
    members = durable(members.join(mixed, "key", "left_semi"))
    a, b = (members.select(F.col("key").alias(x + "key"), *[F.col(c).alias(x + c) for c in ("v", "vi", "root")]) for x in "ab")
    apart = a.join(b, (F.col("akey") == F.col("bkey")) & (F.col("av") < F.col("bv")) & (F.col("aroot") != F.col("broot")) & _can_link(least, "avi", "bvi"))
    more = _verified(apart.select(F.col("av").alias("u"), F.col("bv").alias("v")).distinct(), reps, docs, key, text, words, least)
    if more.isEmpty():
        return roots
    return durable(connected_components(roots.select(F.col("root").alias("u"), F.col("node").alias("v")).unionByName(more)))
