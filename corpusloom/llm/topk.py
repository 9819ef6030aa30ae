"""Exact top-k search by inner product, in tiles.

Vectors are packed into blocks of some thousand rows, once as candidates and once, where they ask, as
queries. A grid deals them: its rows take blocks of queries, its columns blocks of candidates, and every
cell gets both by an equality of the cell's number. A task holds the queries of its cell, multiplies them
with one tile of candidates after the other, selects the best of each tile by partition (not by a full
sort) and keeps a running list for each query. The lists of all cells are merged by query in a tree of
fixed fan-in. Neither queries nor candidates pass through the driver, which only counts them. Components
are whole numbers, ``floor(scale * x)``, so products are exact.

Defined cases: ids or vectors that are null, and vectors that hold nulls, NaN or infinities, take no
part; only vectors of one length are compared; rows with the query's own id are left out; other
repeated rows each take a rank; equal scores go to the smaller id; scores beyond a long end at its
limits; fewer candidates than k give fewer ranks; without queries or candidates there are no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import durable

#: Rows of a block, so of a tile; a product of two takes 32 MB.
TILE_ROWS = 2048
#: Queries and candidates of a cell of the grid, about.
CELL_QUERIES, CELL_ROWS = 16_384, 1 << 20
FAN_IN = 16
#: Tile positions below this many bits share a 64-bit key with a score, so ties fall to the smaller id.
POSITION_BITS = 11
MOST = (1 << 63) - 1
NONE = np.iinfo(np.int64).min


def _usable(vectors: DataFrame, key: str, vector: str) -> DataFrame:
    rows = vectors.select(F.col(key).cast("long").alias("vec_id"), F.col(vector).cast("array<double>").alias("v"))
    bad = F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return rows.where(F.col("vec_id").isNotNull() & F.col("v").isNotNull() & ~bad)


def _exact(q: np.ndarray, c: np.ndarray) -> np.ndarray | None:
    """Products as int64, or None where they may not fit beside a position."""
    bound = np.abs(q).max(initial=0) * np.abs(c).max(initial=0) * q.shape[1]
    return (q @ c.T).astype(np.int64) if bound < 1 << (63 - POSITION_BITS - 1) else None


def _best_of_tile(qid: np.ndarray, q: np.ndarray, ids: np.ndarray, c: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(scores, ids) of the k best of a tile for each query; ``ids`` ascend; NONE marks no candidate."""
    scores = _exact(q, c)
    own = ids[None, :] == qid[:, None]
    if scores is None:
        return _best_by_integers(own, q, ids, c, k)
    order = (scores << POSITION_BITS) + (len(ids) - 1 - np.arange(len(ids)))
    order[own] = NONE
    if len(ids) > k:
        order = np.partition(order, len(ids) - k, axis=1)[:, -k:]
    gone = order == NONE
    place = len(ids) - 1 - (order & ((1 << POSITION_BITS) - 1))
    return np.where(gone, NONE, order >> POSITION_BITS), np.where(gone, 0, ids[np.clip(place, 0, len(ids) - 1)])


def _best_by_integers(own, q, ids, c, k):
    """The same with Python's integers, for components that are too large for the fast way."""
    exact = [[int(x) for x in row] for row in c]
    out_s, out_i = np.full((len(q), k), NONE), np.zeros((len(q), k), np.int64)
    for r, row in enumerate(q):
        mine = [int(x) for x in row]
        found = sorted((-sum(a * b for a, b in zip(mine, other)), int(ids[i])) for i, other in enumerate(exact) if not own[r, i])
        for j, (s, i) in enumerate(found[:k]):
            out_s[r, j], out_i[r, j] = max(-MOST, min(MOST, -s)), i
    return out_s, out_i


def _merge(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray], k: int) -> tuple[np.ndarray, np.ndarray]:
    scores, ids = np.hstack([a[0], b[0]]), np.hstack([a[1], b[1]])
    by = np.lexsort((ids, -np.maximum(scores, NONE + 1)), axis=1)[:, :k]
    return np.take_along_axis(scores, by, 1), np.take_along_axis(ids, by, 1)


_LIST = "block long, place int, query_id long, col long, top array<struct<minus:long,id:long>>"


def _blocks(scale: float, size: int):
    """Rows ``vec_id, v, asks`` to blocks of at most ``size`` candidates, and of queries, of one length."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[int, bool], list[tuple[np.ndarray, np.ndarray]]] = {}

        def packed(key: tuple[int, bool]) -> pa.RecordBatch:
            ids, rows = map(np.concatenate, zip(*held.pop(key)))
            by = np.argsort(ids, kind="stable")
            cols = [pa.array([key[0]], pa.int32()), pa.array([key[1]]), pa.array([ids[by].tobytes()], pa.binary()), pa.array([rows[by].tobytes()], pa.binary())]
            return pa.RecordBatch.from_arrays(cols, ["dim", "asks", "ids", "matrix"])

        for batch in batches:
            ids, asks = batch.column(0).to_numpy(), batch.column(2).to_numpy(zero_copy_only=False).astype(bool)
            lengths = np.diff(batch.column(1).offsets.to_numpy())
            flat = np.floor(scale * batch.column(1).flatten().to_numpy(zero_copy_only=False))
            starts = np.concatenate(([0], np.cumsum(lengths)))
            for dim in np.unique(lengths).tolist():
                for key, some in (((dim, False), lengths == dim), ((dim, True), (lengths == dim) & asks)):
                    at = np.flatnonzero(some)
                    for low in range(0, len(at), size):
                        part = at[low : low + size]
                        mine = held.setdefault(key, [])
                        if sum(len(i) for i, _ in mine) + len(part) > size:
                            yield packed(key)
                            mine = held.setdefault(key, [])
                        mine.append((ids[part], flat[starts[part][:, None] + np.arange(dim)]))
        for key in list(held):
            yield packed(key)

    return run


def _scan(k: int):
    """Sorted rows of cells, queries first, to a list for each query: sorted by score and id."""

    def lists(col: int, queries: list) -> Iterator[pa.RecordBatch]:
        for block, qid, _, best in queries:
            there = best[0] != NONE
            items = pa.StructArray.from_arrays([pa.array(-best[0][there]), pa.array(best[1][there])], ["minus", "id"])
            tops = pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(there.sum(axis=1)))).astype(np.int32)), items)
            n = len(qid)
            cols = [pa.array(np.full(n, block)), pa.array(np.arange(n, dtype=np.int32)), pa.array(qid), pa.array(np.full(n, col)), tops]
            yield pa.RecordBatch.from_arrays(cols, ["block", "place", "query_id", "col", "top"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cell, queries = None, []
        for batch in batches:
            for dim, row, col, asks, block, ids, matrix in zip(*(c.to_pylist() for c in batch.columns)):
                if (dim, row, col) != cell:
                    yield from lists(cell[2] if cell else 0, queries)
                    cell, queries = (dim, row, col), []
                ids = np.frombuffer(ids, np.int64)
                rows = np.frombuffer(matrix, np.float64).reshape(len(ids), dim)
                if asks:
                    queries.append([block, ids, rows, (np.full((len(ids), 0), NONE), np.zeros((len(ids), 0), np.int64))])
                    continue
                for mine in queries:
                    mine[3] = _merge(mine[3], _best_of_tile(mine[1], mine[2], ids, rows, k), k)
        yield from lists(cell[2] if cell else 0, queries)

    return run


def top_k(vectors: DataFrame, is_query: Column, k: int = 20, *, key: str = "vec_id", vector: str = "embedding", scale: float = 64.0) -> DataFrame:
    """``query_id, rank, vec_id, score`` for every row that ``is_query`` (a condition on ``vec_id``) takes."""
    usable = _usable(vectors, key, vector).select("vec_id", "v", F.coalesce(is_query, F.lit(False)).alias("asks"))
    packed = usable.mapInArrow(_blocks(scale, TILE_ROWS), "dim int, asks boolean, ids binary, matrix binary")
    packed = durable(packed.withColumn("block", F.monotonically_increasing_id()))
    size = F.octet_length("ids") / 8
    asked, rows = packed.agg(F.sum(F.when(F.col("asks"), size)), F.sum(F.when(~F.col("asks"), size))).first()
    tasks = int(vectors.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    down = max(1, -(-int(asked or 0) // CELL_QUERIES))
    across = max(1, -(-int(rows or 0) // CELL_ROWS), min(-(-tasks // down), -(-int(rows or 0) // TILE_ROWS)))
    dealt = lambda n: F.pmod(F.xxhash64("block"), F.lit(n))
    every = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long")))
    queries = packed.where("asks").select("dim", dealt(down).alias("row"), every(across).alias("col"), "asks", "block", "ids", "matrix")
    tiles = packed.where("not asks").select("dim", every(down).alias("row"), dealt(across).alias("col"), "asks", "block", "ids", "matrix")
    cells = queries.unionByName(tiles).repartition(tasks, "dim", "row", "col").sortWithinPartitions("dim", "row", "col", F.desc("asks"))
    lists = cells.mapInArrow(_scan(k), _LIST)
    best = F.slice(F.array_sort(F.flatten(F.collect_list("top"))), 1, k).alias("top")
    while across > FAN_IN:
        across = -(-across // FAN_IN)
        lists = lists.groupBy("block", "place", "query_id", F.floor(F.col("col") / FAN_IN).cast("long").alias("col")).agg(best)
    ranked = lists.groupBy("block", "place", "query_id").agg(best).select("query_id", F.posexplode("top").alias("_p", "_t"))
    return ranked.select("query_id", (F.col("_p") + 1).cast("int").alias("rank"), F.col("_t.id").alias("vec_id"), (-F.col("_t.minus")).alias("score"))
