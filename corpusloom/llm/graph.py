"""Connected components of an edge table by alternating large-star and small-star rounds.

A star is one exchange: edges are dealt and sorted by node, so a node's least neighbour comes first and the
others stream past it, however many they are.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import durable


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Large: every neighbour above a node is linked to the least of the node and its neighbours. Small
    (``v`` below ``u``): a node and its other neighbours are linked to the least neighbour."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = None  # the node of the row before, and what its rows are linked to
        for batch in batches:
            if not batch.num_rows:
                continue
            u, v = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            starts = np.flatnonzero(np.concatenate(([True], u[1:] != u[:-1])))
            least = np.minimum(u[starts], v[starts]) if large else v[starts].copy()
            known = last is not None and last[0] == u[0]
            if known:
                least[0] = last[1]
            last = (u[-1], least[-1])
            each = np.repeat(least, np.diff(np.append(starts, len(u))))
            keep = v > u if large else v != each
            x, m = v[keep], each[keep]
            if not large:
                own = starts[1:] if known else starts
                x, m = np.concatenate([x, u[own]]), np.concatenate([m, each[own]])
            yield pa.RecordBatch.from_arrays([pa.array(x), pa.array(m)], ["u", "v"])

    if large:
        edges = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    return edges.repartition("u").sortWithinPartitions("u", "v").mapInArrow(run, "u long, v long")


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def connected_components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """``node, root`` for every node of ``edges`` (``u``, ``v``: longs).

    The root is the least node of the component. Rounds grow with the logarithm of the longest chain;
    each is cut by a durable table. Nothing but a count and a checksum comes to the driver.
    """
    now = durable(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    state = _state(now)
    for _ in range(max_rounds):
        if not state[0]:
            break
        now = durable(_star(_star(now, True), False).distinct())
        before, state = state, _state(now)
        if before == state:
            break
    else:
        raise RuntimeError(f"no fixed point after {max_rounds} rounds")
    roots = now.groupBy("u").agg(F.min("v").alias("root")).withColumnRenamed("u", "node")
    tops = now.select(F.col("v").alias("node")).distinct().join(roots, "node", "left_anti")
    return roots.unionByName(tops.withColumn("root", F.col("node")))
