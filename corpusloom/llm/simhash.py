"""SimHash near-duplicates through deletion-variant signatures.

A document's fingerprint has a bit for every bit set in over half of the XXH64 (seed 42) of its word
shingles. Two fingerprints link at ``max_bits`` or fewer differing bits. They are found by equality:
the 64 bits are cut into so few segments that in one segment (or one union of ``width`` segments) two
linked fingerprints differ by at most one bit. Each fingerprint is indexed under every segment as it
is and under every segment with one bit masked out; equal keys are candidates, verified bit by bit.

Equal fingerprints are one node from the start, so copies cost nothing. Candidates are compared where
equal keys lie side by side after a sort; a long run of one key is cut into blocks whose pairs become
rows of their own, dealt over all tasks, and a long run yields a spanning forest instead of all its
pairs. No link is lost: every pair that shares a key is compared, whatever the length of its run.

Defined cases: a text is taken whole; null, empty or blank texts have fingerprint zero and link like
any other; fewer words than a shingle form one shingle; repeated rows each get a row; a null doc_id
never becomes a component id unless its component holds no other id; an empty table gives no rows.
"""

from __future__ import annotations

import itertools
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import durable
from .graph import connected_components
from .shingles import majority, near_copies, prefixes

_WORD = re.compile(rb"[^\x20\x09-\x0D]+")
_LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))
#: Runs up to this many fingerprints emit all verified pairs; blocks of longer runs have this many.
SHORT_RUN, BLOCK = 64, 1024
#: Distinct fingerprints from which longer keys cost less; tasks over which the rows of one component are dealt.
MANY, SALTS = 200_000_000, 16


def fingerprint(text: str | None, words_per_shingle: int = 4) -> int:
    """The unsigned 64-bit fingerprint of one whole text."""
    words = _WORD.findall((text or "").encode("utf-8", "surrogatepass").translate(_LOWER))
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    starts = np.concatenate(([0], ends[:-1]))
    n = max(1, len(words) - words_per_shingle + 1)
    first, last = starts[:n].tolist(), (ends[-n:] - 1).tolist()
    digest = xxhash.xxh64_intdigest
    return majority(np.fromiter((digest(joined[a:b], 42) for a, b in zip(first, last)), np.uint64, n))


def fingerprints(docs: DataFrame, *, key: str = "doc_id", text: str = "text", words_per_shingle: int = 4) -> DataFrame:
    """``doc_id, text_hash, fp`` with the fingerprint as a signed long; one row per input row."""
    rows = docs.select(F.col(key).alias("doc_id"), F.xxhash64(text).alias("text_hash"), F.col(text).cast("string").alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.fromiter((fingerprint(t.as_py(), words_per_shingle) for t in batch.column(2)), np.uint64, batch.num_rows)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(found.view(np.int64))], ["doc_id", "text_hash", "fp"])

    return rows.mapInArrow(run, f"doc_id {kind}, text_hash long, fp long")


def key_masks(max_bits: int = 4, segments: int = 3, width: int = 1) -> list[int]:
    """The unions of ``width`` segments; any two fingerprints within ``max_bits`` differ in one of them by one bit at most."""
    least = 2 * segments if width == 1 else 2 + segments - width
    if least <= max_bits:
        raise ValueError(f"{segments} segments in unions of {width} can miss links at {max_bits} bits")
    cuts = [64 * i // segments for i in range(segments + 1)]
    parts = [sum(1 << b for b in range(a, z)) for a, z in itertools.pairwise(cuts)]
    return [sum(c) for c in itertools.combinations(parts, width)]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _candidates(fps: DataFrame, masks: list[int]) -> DataFrame:
    """``tag, val, fp``: tag is 65 * mask + the masked-out bit, or + 64 for the segment as it is."""
    keys = [(65 * m + 64, mask) for m, mask in enumerate(masks)]
    keys += [(65 * m + b, mask & ~(1 << b)) for m, mask in enumerate(masks) for b in range(64) if mask >> b & 1]
    index = F.array(*[F.struct(F.lit(tag).alias("tag"), F.lit(_signed(keep)).alias("keep")) for tag, keep in keys])
    spread = fps.select("fp", F.explode(index).alias("k"))
    return spread.select(F.col("k.tag").alias("tag"), F.col("fp").bitwiseAND(F.col("k.keep")).alias("val"), "fp")


def _forest(fps: np.ndarray, max_bits: int) -> list[tuple[int, int]]:
    """Positions of linked pairs that connect what all links among ``fps`` connect."""
    left, edges = np.arange(len(fps)), []
    while len(left):
        front, left = left[:1], left[1:]
        while len(front) and len(left):
            near = np.bitwise_count(fps[front][:, None] ^ fps[left][None, :]) <= max_bits
            hit = near.any(axis=0)
            edges += zip(front[near[:, hit].argmax(axis=0)].tolist(), left[hit].tolist())
            front, left = left[hit], left[~hit]
    return edges


def _compare(max_bits: int):
    """Sorted ``tag, val, fp`` rows to edges, and to pairs of blocks where a run is long."""

    def pairs(tag: np.ndarray, fp: np.ndarray, run: np.ndarray, longest: int) -> Iterator[pa.RecordBatch]:
        bit = tag % 65
        need = np.where(bit == 64, np.uint64(0), np.uint64(1) << bit.astype(np.uint64) % np.uint64(64))
        for step in range(1, longest):
            same = np.flatnonzero(run[step:] == run[:-step])
            diff = fp[same] ^ fp[same + step]
            ok = same[(np.bitwise_count(diff) <= max_bits) & (diff & need[same] == need[same])]
            if len(ok):
                yield edges(fp[ok], fp[ok + step])

    def edges(u: np.ndarray, v: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(u.view(np.int64)), pa.array(v.view(np.int64)), pa.nulls(len(u), pa.binary())], ["u", "v", "todo"])

    def long_run(fp: np.ndarray) -> Iterator[pa.RecordBatch]:
        blocks = [fp[i : i + BLOCK] for i in range(0, len(fp), BLOCK)]
        for i, a in enumerate(blocks):
            todo = [(a if i == j else np.concatenate([a, blocks[j]])).tobytes() for j in range(i if len(blocks) == 1 else i + 1, len(blocks))]
            for part in range(0, len(todo), 64):
                some = todo[part : part + 64]
                yield pa.RecordBatch.from_arrays([pa.nulls(len(some), pa.int64()), pa.nulls(len(some), pa.int64()), pa.array(some, pa.binary())], ["u", "v", "todo"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, ...]] = []

        def flush(tag, val, fp):
            starts = np.flatnonzero(np.concatenate(([True], (tag[1:] != tag[:-1]) | (val[1:] != val[:-1]))))
            sizes = np.diff(np.append(starts, len(tag)))
            ids = np.repeat(np.arange(len(starts)), sizes)
            for r in np.flatnonzero(sizes > SHORT_RUN):
                yield from long_run(fp[starts[r] : starts[r] + sizes[r]])
            keep = np.repeat((sizes > 1) & (sizes <= SHORT_RUN), sizes)
            if keep.any():
                yield from pairs(tag[keep], fp[keep], ids[keep], int(sizes[sizes <= SHORT_RUN].max()))

        for batch in batches:
            if not batch.num_rows:
                continue
            held.append((batch.column(0).to_numpy(), batch.column(1).to_numpy(), batch.column(2).to_numpy().view(np.uint64)))
            tag, val, _ = held[-1]
            if tag[0] == tag[-1] and val[0] == val[-1]:
                continue  # may be the middle of a long run
            tag, val, fp = map(np.concatenate, zip(*held))
            cut = int(np.flatnonzero((tag[1:] != tag[:-1]) | (val[1:] != val[:-1]))[-1]) + 1
            yield from flush(tag[:cut], val[:cut], fp[:cut])
            held = [(tag[cut:], val[cut:], fp[cut:])]
        if held:
            yield from flush(*map(np.concatenate, zip(*held)))

    return run


def _block_pairs(max_bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for todo in batch.column(0):
                fp = np.frombuffer(todo.as_py(), np.uint64)
                if found := _forest(fp, max_bits):
                    u, v = (fp[list(x)].view(np.int64) for x in zip(*found))
                    yield pa.RecordBatch.from_arrays([pa.array(u), pa.array(v)], ["u", "v"])

    return run


def links(fps: DataFrame, max_bits: int = 4, segments: int = 3, width: int = 1) -> DataFrame:
    """``u, v``: linked distinct fingerprints whose components are those of all links."""
    parts = int(fps.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    distinct = fps.select("fp").distinct().repartition(parts)  # few bytes, but many keys each
    spread = _candidates(distinct, key_masks(max_bits, segments, width))
    beside = spread.repartition("tag", "val").sortWithinPartitions("tag", "val")
    found = durable(beside.mapInArrow(_compare(max_bits), "u long, v long, todo binary"))
    blocks = found.where("todo is not null").select("todo")
    if not blocks.isEmpty():
        more = blocks.repartition(parts).mapInArrow(_block_pairs(max_bits), "u long, v long")
        return found.where("todo is null").select("u", "v").unionByName(more)
    return found.select("u", "v")


def near_duplicates(docs: DataFrame, *, key: str = "doc_id", text: str = "text", words_per_shingle: int = 4, max_bits: int = 4, segments: int | None = None, width: int = 1) -> DataFrame:
    """``doc_id, text_hash, fp, component_id``: the component's smallest doc_id, itself included.

    ``segments=3, width=1`` indexes 67 keys of at least 20 bits; ``segments=5, width=2`` indexes 266
    keys of at least 24 bits, which costs less beyond ``MANY`` distinct fingerprints. Both are exact; without
    ``segments`` their number chooses.
    """
    rows = durable(fingerprints(docs, key=key, text=text, words_per_shingle=words_per_shingle))
    firsts = durable(rows.groupBy("fp").agg(F.min("doc_id").alias("component_id")))
    if segments is None:
        segments, width = (3, 1) if firsts.count() < MANY else (5, 2)
    roots = durable(connected_components(links(firsts, max_bits, segments, width)).withColumnRenamed("node", "fp"))
    # A component may hold very many fingerprints: its least id goes to SALTS tasks.
    linked = firsts.join(roots, "fp").withColumn("_salt", F.pmod(F.xxhash64("fp"), F.lit(SALTS)).cast("int"))
    least = linked.groupBy("root").agg(F.min("component_id").alias("component_id"))
    least = least.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    classes = linked.select("fp", "root", "_salt").join(least, ["root", "_salt"]).select("fp", "component_id")
    classes = classes.unionByName(firsts.join(roots, "fp", "left_anti"))
    return rows.join(classes, "fp").select("doc_id", "text_hash", "fp", "component_id")


def _node_pairs(rows: DataFrame, max_bits: int) -> DataFrame:
    """``u, v``: nodes of linked fingerprints, and of equal ones, joined through the least node of a fingerprint."""
    firsts = durable(rows.groupBy("fp").agg(F.min("node").alias("first")))
    edges = links(rows, max_bits)
    for side in "uv":
        edges = edges.join(firsts.toDF(side, side + "n"), side)
    same = rows.select("fp", "node").distinct().join(firsts, "fp").where("node <> first")
    return edges.select(F.col("un").alias("u"), F.col("vn").alias("v")).unionByName(same.select(F.col("first").alias("u"), F.col("node").alias("v")))


def drop_near_duplicates(docs: DataFrame, *, key: str = "doc_id", text: str = "text", words_per_shingle: int = 5, max_bits: int = 4, least: float = 0.8) -> DataFrame:
    """One document of each group: the least by doc_id, null last, and text hash, every column kept.

    Texts link if the Jaccard similarity of their shingle sets is ``least`` or more. Candidates are the
    links of the fingerprints, found by deletion variants, and, as two texts of similarity 0.8 lie some ten
    bits apart, which no selective segment survives, also those of the exact prefix filter in ``shingles``.
    All are verified on the sets. Rows that repeat both doc_id and text count as one document, of which
    one row stays.
    """
    rows = durable(prefixes(docs, key, text, words_per_shingle, least))
    roots = near_copies(rows, docs, _node_pairs(rows, max_bits), key=key, text=text, words=words_per_shingle, least=least)
    rows = rows.select("doc_id", "text_hash", "node").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    ids = rows.groupBy(F.col("doc_id").alias("_key"), F.col("text_hash").alias("_th"))
    order = F.struct(F.col("doc_id").isNull().alias("no_id"), F.col("doc_id").alias("id"), F.col("text_hash").alias("hash"))
    firsts = rows.groupBy("root").agg(F.min(order).alias("first"))
    kept = durable(firsts.select(F.col("first.id").alias("_id"), F.col("first.hash").alias("_hash")))
    own = [F.col(f"`{c}`") for c in docs.columns]
    rows = docs.select(F.struct(*own).alias("_row"), F.col(key).alias("_key"), F.xxhash64(text).alias("_th"))
    same = F.col("_key").eqNullSafe(F.col("_id")) & (F.col("_th") == F.col("_hash"))
    repeated = durable(kept.join(ids.count().where("count > 1"), same, "left_semi"))
    if repeated.isEmpty():
        return rows.join(kept, same, "left_semi").select("_row.*")
    single = rows.join(kept.exceptAll(repeated), same, "left_semi")
    first = Window.partitionBy("_key", "_th").orderBy(F.to_json("_row"))
    again = rows.join(repeated, same, "left_semi").withColumn("_i", F.row_number().over(first)).where("_i = 1")
    return single.select("_row.*").unionByName(again.select("_row.*"))
