"""Helpers shared by the training-data operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from corpusloom.operators.skew import join_frequent  # noqa: F401
from corpusloom.session import durable, remove_folder  # noqa: F401

#: ASCII white space as the contracts define it; everything else belongs to a word.
WORD = r"[^\x20\x09-\x0D]+"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def word_count(text: Column) -> Column:
    """Words of the whole text; 0 for a null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def stratum_key(column: Column) -> Column:
    """A never-null key for a nullable string that sorts as the string does, null last."""
    return F.when(column.isNull(), F.lit("1")).otherwise(F.concat(F.lit("0"), column.cast("string")))


def seeded_hash(seed: int, column: Column) -> Column:
    """60 bits of the MD5 of ``seed:value`` as a long; a null value hashes as the empty string."""
    value = F.coalesce(column.cast("string"), F.lit(""))
    return F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}:"), value)), 1, 15), 16, 10).cast("long")


def repeated_rows(rows: DataFrame, same: tuple[Column, ...]) -> DataFrame | None:
    """``_k`` of the rows that are equal in ``same`` to another one; None if there are none."""
    often = durable(rows.select(_row_key(same).alias("_k")).groupBy("_k").agg(F.count("*").alias("_n")).where("_n > 1").select("_k"))
    return None if often.isEmpty() else often


def _row_key(same: tuple[Column, ...]) -> Column:
    return F.md5(F.concat_ws(":", *same))


def row_hash(rows: DataFrame, seed: int, same: tuple[Column, ...], often: DataFrame | None) -> DataFrame:
    """``rows`` with ``_h``: 60 bits of the MD5 of ``seed``, the values ``same`` and the row's number among its equals.

    Rows equal in ``same`` (``often``: those that ``repeated_rows`` found) are numbered from 0, so that even a very
    frequent one is spread over all hashes; which of them has which number is open. Numbers are offsets of the
    parts that rows lie in, so no row's equals meet in one task. ``same`` holds never-null strings.
    """
    number = lambda n: F.conv(F.substring(F.md5(F.concat_ws(":", F.lit(str(seed)), "_k", n)), 1, 15), 16, 10).cast("long")
    keyed = rows.withColumn("_k", _row_key(same))
    if often is None:
        return keyed.withColumn("_h", number(F.lit("0"))).drop("_k")
    single = keyed.join(often, "_k", "left_anti").withColumn("_h", number(F.lit("0"))).drop("_k")
    parted = keyed.withColumns({"_part": F.spark_partition_id(), "_row_id": F.monotonically_increasing_id()})
    many = durable(parted.join(often, "_k", "left_semi"))
    sizes = many.groupBy("_k", "_part").agg(F.count("*").alias("_n"))
    before = sizes.withColumn("_before", F.sum("_n").over(Window.partitionBy("_k").orderBy("_part")) - F.col("_n")).drop("_n")
    inside = F.row_number().over(Window.partitionBy("_k", "_part").orderBy("_row_id")) - 1
    placed = many.withColumn("_i", inside).join(before, ["_k", "_part"])
    return single.unionByName(placed.withColumn("_h", number((F.col("_before") + F.col("_i")).cast("string"))).drop("_k", "_part", "_row_id", "_i", "_before"))


def same_row(key: Column, text: Column, stratum: Column) -> tuple[Column, Column, Column]:
    """What ``row_hash`` takes for rows with an id, a text and a stratum (a ``stratum_key``)."""
    return F.coalesce(key.cast("string"), F.lit("")), F.coalesce(F.md5(text.cast("string").cast("binary")), F.lit("")), stratum
