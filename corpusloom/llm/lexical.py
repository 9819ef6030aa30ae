"""Ranked lexical search: a document-at-a-time merge over compressed postings.

Documents are cut into shards of some MB as they are read. A shard sorts its documents by doc_id, numbers
them and keeps a posting list for every term that some item asks for: steps between numbers and term
frequencies as variable-length bytes, compressed. Shards are written once to the shared folder. The
counts of the formula (documents, terms, documents of a term) are sums over the shards.

A task then reads its shards one by one, from its own partition and without a shuffle. All items are
answered in one pass: a heap holds a cursor for each posting list, so documents come by in the order of
their ids, each with all its terms; the terms' parts of the score are added up by item, and a bounded heap
for each item, by score and then by doc_id, keeps the best of all shards of the task. The lists of the tasks are
merged by item, in two steps.

Items are a stated query set. They are dealt into blocks by the length of their texts, one pass over the
documents a block, so that what a task gets of them has a fixed size.

Defined cases: a null or empty text has no terms and is never found; a null doc_id comes last; repeated
rows are documents of their own; an item without terms, or of terms that no document has, has no rows;
repeated items are answered each; other columns are left out; empty tables give no rows.
"""

from __future__ import annotations

import heapq
import math
from collections import Counter
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.session import spread

from .common import durable

#: Text of a shard, and text of a block of items.
SHARD_BYTES, BLOCK_BYTES = 16 << 20, 4 << 20
#: ASCII other than letters and digits parts terms; A-Z are lower-cased. Bytes beyond ASCII belong to terms.
_TABLE = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or chr(c).isalnum() else 32 for c in range(256))
_LAST_ID = 1 << 63  # behind every long: stands for a null doc_id
EXACT = 1 << 53


def terms(text: str | None) -> list[bytes]:
    """The terms of one whole text, in order, repeats included."""
    return (text or "").encode("utf-8", "surrogatepass").translate(_TABLE).split()


def pack_numbers(numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, length of each number's code): seven bits a byte, lowest first; the last byte of a number is below 128."""
    n = numbers.astype(np.uint64)
    width = np.ones(len(n), np.int64)
    for shift in range(7, 64, 7):
        width += n >> np.uint64(shift) > 0
    ends = np.cumsum(width)
    place = np.arange(int(ends[-1]) if len(n) else 0) - np.repeat(ends - width, width)
    code = (np.repeat(n, width) >> (np.uint64(7) * place.astype(np.uint64))) & np.uint64(127)
    return (code + np.uint64(128) * (place < np.repeat(width, width) - 1)).astype(np.uint8), width


def unpack_numbers(code: np.ndarray) -> np.ndarray:
    """The numbers of ``pack_numbers``."""
    last = np.flatnonzero(code < 128)
    starts = np.concatenate(([0], last[:-1] + 1))[: len(last)]
    place = np.arange(len(code)) - np.repeat(starts, last - starts + 1)
    parts = (code & 127).astype(np.uint64) << (np.uint64(7) * place.astype(np.uint64))
    return np.add.reduceat(parts, starts).astype(np.int64) if len(starts) else np.empty(0, np.int64)


def _shards(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[tuple[list, list]]:
    """(ids, texts) in row order, until the texts have ``size`` characters."""
    ids, texts, used = [], [], 0
    for batch in batches:
        for i, t in zip(*(c.to_pylist() for c in batch.columns)):
            if t:
                ids.append(_LAST_ID if i is None else i)
                texts.append(t)
                used += len(t) + 64
            if used >= size:
                yield ids, texts
                ids, texts, used = [], [], 0
    if texts:
        yield ids, texts


def _index(vocabulary: dict[bytes, int], size: int):
    """A row a shard: its documents and their numbers of terms, posting lists one behind the other, and where each begins."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, texts in _shards(batches, size):
            order = sorted(range(len(ids)), key=ids.__getitem__)
            lengths, keys = np.zeros(len(order), np.int64), []
            for number, i in enumerate(order):
                found = terms(texts[i])
                lengths[number] = len(found)
                term = np.fromiter(map(vocabulary.get, found, repeat(-1)), np.int64, len(found))
                keys.append(term[term >= 0] * len(order) + number)
            key, tf = np.unique(np.concatenate(keys), return_counts=True)
            term, number = key // len(order), key % len(order)
            fresh = np.concatenate(([True], term[1:] != term[:-1]))[: len(term)]
            step = np.where(fresh, number, np.diff(number, prepend=0))
            code, width = pack_numbers(np.column_stack([step, tf]).ravel())
            starts = np.flatnonzero(fresh)
            bounds = np.concatenate(([0], np.cumsum(width)))[2 * starts].tolist()
            blob = zstandard.compress(code.tobytes(), 3)
            columns = [
                [[None if ids[i] == _LAST_ID else ids[i] for i in order]],
                [lengths.tolist()],
                [term[starts].tolist()],
                [np.diff(np.append(starts, len(term))).tolist()],
                [bounds],
            ]
            arrays = [pa.array(c, pa.list_(pa.int64())) for c in columns] + [pa.array([blob], pa.binary())]
            yield pa.RecordBatch.from_arrays(arrays, ["ids", "lengths", "terms", "dfs", "starts", "postings"])

    return run


_SHARD = "ids array<long>, lengths array<long>, terms array<long>, dfs array<long>, starts array<long>, postings binary"


class Postings:
    """The posting lists of one shard, merged document by document."""

    def __init__(self, terms: list[int], starts: list[int], blob: bytes):
        code = np.frombuffer(zstandard.decompress(blob), np.uint8)
        self.terms, self.lists = terms, [code[a:z] for a, z in zip(starts, [*starts[1:], len(code)])]

    def documents(self) -> Iterator[tuple[int, list[int], list[int]]]:
        """(number, its terms, their frequencies) by number: a heap merges one cursor for each list."""
        cursors, heap, width = [], [], len(self.lists)
        for k, code in enumerate(self.lists):
            pairs = unpack_numbers(code)
            at = iter(zip((np.cumsum(pairs[::2]) * width + k).tolist(), pairs[1::2].tolist()))
            cursors.append(at)
            heap.append((*next(at), k))
        heapq.heapify(heap)
        number, found, tfs = -1, [], []
        while heap:
            key, tf, k = heap[0]
            if key // width != number:
                if found:
                    yield number, found, tfs
                number, found, tfs = key // width, [], []
            found.append(self.terms[k])
            tfs.append(tf)
            following = next(cursors[k], None)
            if following:
                heapq.heapreplace(heap, (*following, k))
            else:
                heapq.heappop(heap)
        if found:
            yield number, found, tfs


class Scorer:
    """The items that ask for each term, and the weights: score parts are added up by item."""

    def __init__(self, wanted: list[Counter], weights: np.ndarray, documents: int, words: int):
        rows = sorted((term, item, times) for item, counts in enumerate(wanted) for term, times in counts.items())
        self.term, self.item, self.times = (np.array(c, np.int64) for c in zip(*rows)) if rows else (np.empty(0, np.int64),) * 3
        self.first = np.searchsorted(self.term, np.arange(len(weights) + 1))
        self.weights, self.documents, self.words, self.items = weights, documents, words, len(wanted)
        most = max((int(weights[list(c)] @ np.array(list(c.values()))) for c in wanted if c), default=0)
        self.exact = most * 1_000_000 < EXACT  # doubles then add up without rounding

    def __call__(self, found: list[int], tfs: list[int], length: int) -> np.ndarray:
        """The score of a document for every item."""
        term, tf = np.array(found), np.array(tfs, np.int64)
        m = 75 + 25 * length * self.documents // self.words
        part = self.weights[term] * (1_000_000_000 * tf // (1000 * tf + 12 * m))
        a, n = self.first[term], self.first[term + 1] - self.first[term]
        ends = np.cumsum(n)
        at = np.repeat(a - (ends - n), n) + np.arange(int(ends[-1]))
        parts = np.repeat(part, n) * self.times[at]
        if self.exact:
            return np.bincount(self.item[at], parts, self.items).astype(np.int64)
        out = np.zeros(self.items, np.int64)
        np.add.at(out, self.item[at], parts)
        return out


def _search(shared, k: int):
    """The ``k`` best documents for each item over all shards of a task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        score = Scorer(*shared.value)
        best: list[list[tuple[int, int]]] = [[] for _ in range(score.items)]
        least = np.ones(score.items, np.int64)
        for batch in batches:
            for ids, lengths, names, starts, blob in zip(*(batch.column(c).to_pylist() for c in ("ids", "lengths", "terms", "starts", "postings"))):
                for number, found, tfs in Postings(names, starts, blob).documents():
                    scores = score(found, tfs, lengths[number])
                    own = _LAST_ID if ids[number] is None else ids[number]
                    for item in np.flatnonzero(scores >= least).tolist():
                        entry = (int(scores[item]), -own)
                        if len(best[item]) < k:
                            heapq.heappush(best[item], entry)
                        else:
                            heapq.heappushpop(best[item], entry)
                        if len(best[item]) == k:
                            least[item] = best[item][0][0]
        rows = [(item, None if own == -_LAST_ID else -own, s) for item, heap in enumerate(best) for s, own in heap]
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows)], ["q", "doc_id", "score"])

    return run


def _blocks(items: DataFrame, key: str, text: str) -> Iterator[list[tuple]]:
    """The items in blocks whose texts have a bounded length; they pass the driver one block at a time."""
    block, used = [], 0
    for row in items.select(F.col(key), F.col(text).cast("string")).toLocalIterator():
        block.append((row[0], terms(row[1])))
        used += len(row[1] or "") + 64
        if used >= BLOCK_BYTES:
            yield block
            block, used = [], 0
    if block:
        yield block


def _answered(docs: DataFrame, block: list[tuple], k: int, shard_bytes: int) -> DataFrame:
    """``q, rank, doc_id, score`` for the items of one block, numbered by place."""
    spark = docs.sparkSession
    vocabulary = {t: i for i, t in enumerate(sorted({t for _, found in block for t in found}))}
    wanted = [Counter(vocabulary[t] for t in found) for _, found in block]
    index = durable(docs.mapInArrow(_index(vocabulary, shard_bytes), _SHARD))
    total = index.agg(F.sum(F.expr("size(filter(lengths, x -> x > 0))")), F.sum(F.expr("aggregate(lengths, 0L, (s, x) -> s + x)"))).first()
    pairs = index.select(F.explode(F.arrays_zip("terms", "dfs")).alias("x"))
    dfs = pairs.groupBy("x.terms").agg(F.sum("x.dfs").alias("df")).collect()  # at most the vocabulary of the block
    weights = np.zeros(len(vocabulary), np.int64)
    for term, df in dfs:
        weights[term] = math.floor(1000 * math.log((2 * total[0] + 2) / (2 * df + 1)))
    shared = spark.sparkContext.broadcast((wanted, weights, total[0] or 0, total[1] or 0))
    found = index.mapInArrow(_search(shared, k), "q long, doc_id long, score long").withColumn("_part", F.spark_partition_id())
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last()]
    some = Window.partitionBy("q", F.pmod("_part", F.lit(64))).orderBy(*order)
    half = found.withColumn("_n", F.row_number().over(some)).where(F.col("_n") <= k)
    return half.withColumn("rank", F.row_number().over(Window.partitionBy("q").orderBy(*order))).where(F.col("rank") <= k)


def search(docs: DataFrame, items: DataFrame, *, key: str = "doc_id", text: str = "text", item_key: str = "item_id", item_text: str = "text", k: int = 20, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """``item_id, rank, doc_id, score``: the ``k`` documents that score highest for each item, with scores above 0.

    ``doc_id`` is a long. Equal scores are ranked by ascending doc_id.
    """
    spark = docs.sparkSession
    rows = spread(docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text")))
    kind = items.schema[item_key].dataType.simpleString()
    out = None
    for block in _blocks(items, item_key, item_text):
        names = spark.createDataFrame([(q, i) for q, (i, _) in enumerate(block)], f"q long, item_id {kind}")
        found = _answered(rows, block, k, shard_bytes).join(F.broadcast(names), "q").select("item_id", "rank", "doc_id", "score")
        out = found if out is None else out.unionByName(found)
    return spark.createDataFrame([], f"item_id {kind}, rank int, doc_id long, score long") if out is None else out
