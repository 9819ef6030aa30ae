"""Joins on keys of which some may hold a large part of all rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.session import durable


def join_frequent(left: DataFrame, right: DataFrame, on: str, share: int = 1024, how: str = "inner", keys: DataFrame | None = None) -> DataFrame:
    """The inner or left join of ``left`` with ``right``, whose keys are unique, where some keys may be very frequent in ``left``.

    A key that holds over 1/``share`` of the rows on the left is broadcast with its row on the right: there are fewer
    than ``share`` of those, whatever the input. All others meet in a shuffle, none of them a large part of it.
    ``left`` is read several times: a table, or something durable, or cheap. ``keys`` may name its keys more cheaply.
    """
    keys = left.select(on) if keys is None else keys
    counts = keys.groupBy(on).agg(F.count("*").alias("_n")).where(F.col("_n") * share > keys.count()).select(on)
    hot = durable(right.join(F.broadcast(counts), on, "left_semi"))
    if hot.isEmpty():
        return left.join(right, on, how)
    rest = left.join(F.broadcast(hot.select(on)), on, "left_anti")
    return rest.join(right, on, how).unionByName(left.join(F.broadcast(hot), on))
