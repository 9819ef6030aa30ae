"""Sharding by proportional stratified interleaving.

Rows are shuffled inside their source by a seeded hash, ranked there, and sorted by the fractional
rank ``(2 * rank - 1) / (2 * rows of the source)``. Every stretch of that order holds every source in
its proportion, so cutting it into equal stretches gives shards that all match the mixture, with row
counts at most one apart.

The hash is that of the id, text and source, and of the row's number among rows that agree in all three,
so rows that repeat an id, or a whole row, are dealt one by one.

No sort meets in one task. A rank is an offset from a histogram over hash buckets plus a row number
inside one bucket, and fractional ranks are spread evenly by construction, so both steps deal any
source, however large, over all tasks. Only keys, sizes and checksums are shuffled, never texts.

Defined cases: a null source is a source of its own; a null text has size 1 and checksum 0; repeated
rows are shuffled like others and each has a slot; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import durable, repeated_rows, row_hash, same_row, stratum_key

HASH_BITS = 60
_SAME = ("_same_id", "_same_text", "_same_source")


def _bucket_bits(rows: int, rows_per_bucket: int) -> int:
    return min(20, max(0, (max(rows, 1) // rows_per_bucket).bit_length()))


def assign_shards(
    docs: DataFrame,
    num_shards: int = 8,
    *,
    key: str = "doc_id",
    text: str = "text",
    stratum: str = "source",
    seed: int = 7,
    rows_per_bucket: int = 1024,
) -> DataFrame:
    """One row per input row: ``doc_id, size, text_crc32, shard, slot``, and the hidden ``_s`` and ``_h`` that name it."""
    if num_shards < 1:
        raise ValueError("num_shards must be at least 1")
    skeleton = durable(docs.select(
        F.col(key).alias("doc_id"),
        stratum_key(F.col(stratum)).alias("_s"),
        (F.coalesce(F.octet_length(F.col(text)), F.lit(0)) + 1).cast("long").alias("size"),
        F.crc32(F.coalesce(F.col(text), F.lit("")).cast("binary")).alias("text_crc32"),
        *[c.alias(n) for c, n in zip(same_row(F.col(key), F.col(text), stratum_key(F.col(stratum))), _SAME)],
    ))
    rows = skeleton.count()
    bits = _bucket_bits(rows, rows_per_bucket)
    same = tuple(map(F.col, _SAME))
    hashed = row_hash(skeleton, seed, same, repeated_rows(skeleton, same)).drop(*_SAME)
    base = hashed.withColumn("_b", F.shiftright("_h", HASH_BITS - bits))

    counts = base.groupBy("_s", "_b").agg(F.count("*").alias("_n"))
    source = Window.partitionBy("_s")
    offsets = counts.select(
        "_s",
        "_b",
        (F.sum("_n").over(source.orderBy("_b")) - F.col("_n")).alias("_before"),
        F.sum("_n").over(source).alias("_rows"),
    )
    inside = Window.partitionBy("_s", "_b").orderBy("_h", "doc_id", "text_crc32", "size")
    rank = F.col("_before") + F.row_number().over(inside)
    ranked = durable(
        base.join(offsets, ["_s", "_b"])
        .withColumn("_rank", rank)
        .withColumn("_frac", (2 * F.col("_rank") - 1).cast("double") / (2 * F.col("_rows")).cast("double"))
        .withColumn("_f", F.floor(F.col("_frac") * (1 << bits)))
        .select("doc_id", "_s", "_h", "size", "text_crc32", "_rank", "_frac", "_f")
    )
    # At most 2**20 rows, whatever the input: one for each bucket of the fractional rank.
    starts = ranked.groupBy("_f").agg(F.count("*").alias("_n"))
    starts = starts.select("_f", (F.sum("_n").over(Window.orderBy("_f")) - F.col("_n")).alias("_start"))
    place = F.row_number().over(Window.partitionBy("_f").orderBy("_frac", "_s", "_rank"))
    return (
        ranked.join(starts, "_f")
        .withColumn("_pos", F.col("_start") + place - 1)
        .withColumn("shard", F.expr(f"(({num_shards} * (_pos + 1)) - 1) div {max(rows, 1)}").cast("int"))
        .withColumn("slot", F.expr(f"_pos - (cast(shard as bigint) * {max(rows, 1)}) div {num_shards}"))
        .select("doc_id", "size", "text_crc32", "shard", "slot", "_s", "_h")
    )


def write_shards(docs: DataFrame, path: str, num_shards: int = 8, **options) -> None:
    """Write whole rows as a struct ``row`` under ``path/shard=N``, each shard in ``slot`` order."""
    key, text, stratum = (options.get(k, k2) for k, k2 in (("key", "doc_id"), ("text", "text"), ("stratum", "source")))
    placed = assign_shards(docs, num_shards, **options).select("_s", "_h", "shard", "slot")
    same = tuple(same_row(F.col(key), F.col(text), stratum_key(F.col(stratum))))
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    rows = docs.select(whole.alias("row"), stratum_key(F.col(stratum)).alias("_s"), *[c.alias(n) for c, n in zip(same, _SAME)])
    own = tuple(map(F.col, _SAME))
    hashed = row_hash(rows, options.get("seed", 7), own, repeated_rows(rows, own)).select("_s", "_h", "row")
    spread = hashed.join(placed, ["_s", "_h"]).select("shard", "slot", "row").repartitionByRange("shard", "slot")
    spread.sortWithinPartitions("shard", "slot").write.mode("overwrite").partitionBy("shard").parquet(path)
