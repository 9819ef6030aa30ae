"""Groups of rows that share a key, directly or through other rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.session import durable


def components(links: DataFrame, max_rounds: int = 60) -> DataFrame:
    """``node, root`` for the nodes of ``links`` (``u``, ``v``: longs); the root is the least node.

    Every round points a node at the least root next to it and then jumps over its root's root, so
    rounds grow with the logarithm of the longest chain. Each round is a durable table.
    """
    both = durable(links.where("u <> v").unionByName(links.where("u <> v").select(F.col("v").alias("u"), F.col("u").alias("v"))).distinct())
    roots = durable(both.groupBy(F.col("u").alias("node")).agg(F.least(F.col("u"), F.min("v")).alias("root")))
    for _ in range(max_rounds):
        near = both.join(roots, both["v"] == roots["node"]).groupBy("u").agg(F.min("root").alias("_near"))
        met = roots.join(near, F.col("node") == F.col("u")).select("node", F.least("root", "_near").alias("_new"), "root")
        top = met.select(F.col("node").alias("_n"), F.col("_new").alias("_t"))
        jumped = met.join(top, F.col("_new") == F.col("_n"), "left").select("node", F.least(F.col("_new"), F.coalesce("_t", "_new")).alias("_root"), "root")
        jumped = durable(jumped)
        if jumped.where("_root <> root").isEmpty():
            return roots
        roots = jumped.select("node", F.col("_root").alias("root"))
    raise RuntimeError(f"no fixed point after {max_rounds} rounds")


def component_of_keys(rows: DataFrame, keys: list, seq: str = "seq") -> DataFrame:
    """``rows`` with ``component``: the least ``seq`` that is linked to the row by shared keys.

    ``keys`` are nullable columns; equal values of one key link rows, a null links nothing.
    """
    tagged = [F.when(k.isNotNull(), F.struct(F.lit(i).alias("i"), k.cast("string").alias("k"))) for i, k in enumerate(keys)]
    spread = rows.select(F.col(seq).alias("u"), F.explode(F.array_compact(F.array(*tagged))).alias("key")).select("u", "key.i", "key.k")
    # A star to the least row of each key: as many links as rows, however many share the key.
    first = spread.groupBy("i", "k").agg(F.min("u").alias("v"), F.count("*").alias("n")).where("n > 1").drop("n")
    links = spread.join(first, ["i", "k"]).where("u <> v").select("u", "v").distinct()
    roots = components(links)
    joined = rows.join(roots, rows[seq] == roots["node"], "left")
    return joined.withColumn("component", F.coalesce("root", F.col(seq))).drop("node", "root")
