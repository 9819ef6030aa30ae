"""The last value at or before a place, for keys of any frequency, and joins of two tables by it.

Rows are dealt by range of (key, place), so the rows of one key may lie in many parts. Inside a part the last value
is a window; what parts hand on to later ones is a row for each: its first key, and the last value it holds with that
value's key and place. No key, however frequent, is one task's rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.session import durable


def last_before(rows: DataFrame, by: list[str], place: list[str], value: str, name: str) -> DataFrame:
    """Durable ``rows`` with ``name``: the last non-null ``value`` of the same key at an earlier place, or at the row's own.

    ``place`` orders the rows of a key; rows of equal places come in any order, so make them differ where it matters.
    Null keys are equal to one another; null places come first; without a value the result is null.
    """
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = rows.repartitionByRange(parts, *by, *place).withColumn("_part", F.spark_partition_id())
    placed = durable(dealt)
    key = F.struct(*by)
    held = F.when(F.col(value).isNotNull(), F.struct(key.alias("key"), F.struct(*place).alias("place"), F.col(value).alias("value")))
    edges = placed.groupBy("_part").agg(F.min(key).alias("_first"), F.max(held).alias("_held"))
    before = F.max("_held").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))  # a row for each part
    carried = edges.select("_part", "_first", F.when(before["key"].eqNullSafe(F.col("_first")), before["value"]).alias("_carried"))
    inside = F.last(value, ignorenulls=True).over(Window.partitionBy("_part", *by).orderBy(*place).rowsBetween(Window.unboundedPreceding, 0))
    found = placed.withColumn(name, inside).join(F.broadcast(carried), "_part")
    own = F.coalesce(F.col(name), F.when(key.eqNullSafe(F.col("_first")), F.col("_carried")))
    return found.withColumn(name, own).select(*rows.columns, name)


def asof_join(left: DataFrame, right: DataFrame, by: str, place: str, value: str, name: str, *, strict: bool = False) -> DataFrame:
    """``left`` with ``name``: the ``value`` of the right row of the same ``by`` with the greatest ``place`` that is not behind (``strict``: is before) the left row's.

    Of right rows with one place the greatest value counts; right rows without a place, key or value never do, and a
    left row without key or place finds nothing. Every left row stays once.
    """
    known = right.where(F.col(by).isNotNull() & F.col(place).isNotNull() & F.col(value).isNotNull())
    first, second = (1, 0) if strict else (0, 1)
    asked = left.select(F.col(by).alias("_by"), F.col(place).alias("_place"), F.lit(second).alias("_side"), F.lit(None).cast(right.schema[value].dataType).alias("_value"), F.struct(*left.columns).alias("_row"))
    told = known.groupBy(by, place).agg(F.max(value).alias("_value")).select(F.col(by).alias("_by"), F.col(place).alias("_place"), F.lit(first).alias("_side"), "_value", F.lit(None).cast(asked.schema["_row"].dataType).alias("_row"))
    found = last_before(told.unionByName(asked), ["_by"], ["_place", "_side"], "_value", "_found").where("_row is not null")
    known_key = F.col("_by").isNotNull() & F.col("_place").isNotNull()
    return found.select("_row.*", F.when(known_key, F.col("_found")).alias(name))
