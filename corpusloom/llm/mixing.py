"""Mixing sources to target weights with hash-threshold histograms, in DataFrame functions only.

Every row has a fixed seeded hash of its id, text and source, and of its number among rows that agree in
all three, so not even a row that is repeated very often is taken or left as one. Tokens are summed by source and hash bucket, the bucket that
holds a source's budget is found by a running sum over at most 4096 buckets, and only its rows are
summed again over 4096 finer buckets and then over single hashes. The result is one hash threshold a
source, so documents are chosen by a filter, without a sort, and a rerun chooses the same ones.
Growing a budget only raises the threshold: smaller mixes are nested in larger ones.

Targets: each source's weight share of ``budget`` times all tokens, at most ``cap`` times its own
tokens; what is above the cap is shared again by weight. A target above a source's own size takes
every document once and the documents under the threshold once more.

Defined cases: a null source is the last source; a null or blank text has size 0 and changes nothing;
rows that repeat an id or a whole row are taken or left one by one; an empty table gives no rows. The threshold
is the one whose taken tokens come nearest to the target, the smaller on a tie.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import durable, repeated_rows, row_hash, same_row, stratum_key, word_count

BUCKETS = 4096
#: Sources up to which the table of thresholds (a row of about 60 bytes each) is broadcast.
BROADCAST_SOURCES = 50_000
SALTS = 64


def _skeleton(docs: DataFrame, key: str, text: str, source: str) -> DataFrame:
    names = ("_same_id", "_same_text", "_same_source")
    same = same_row(F.col(key), F.col(text), stratum_key(F.col(source)))
    return docs.select(F.col(key).alias("doc_id"), stratum_key(F.col(source)).alias("_s"), word_count(F.col(text)).alias("size"), *[c.alias(n) for c, n in zip(same, names)])


def source_targets(base: DataFrame, weights: tuple[int, ...], budget: float, cap: float) -> DataFrame:
    """``_s, source_size, target`` from the sizes in ``base``; one row a source."""
    sizes = base.groupBy("_s").agg(F.sum("size").alias("source_size"))
    everything = Window.partitionBy()
    place = F.pmod(F.row_number().over(Window.orderBy("_s")) - 1, F.lit(len(weights)))
    ring = F.array(*[F.lit(float(w)) for w in weights])
    t = sizes.withColumn("_w", F.element_at(ring, (place + 1).cast("int")))
    t = t.withColumn("_cap", F.lit(cap) * F.col("source_size"))
    t = t.withColumn("_total", F.lit(budget) * F.sum("source_size").over(everything))
    # Sources reach their caps in the order of cap per weight; the level is what the others get per weight.
    filled = Window.orderBy(F.col("_cap") / F.col("_w"), "_s")
    before = F.sum("_cap").over(filled.rowsBetween(Window.unboundedPreceding, 0)) - F.col("_cap")
    rest = F.sum("_w").over(everything) - F.sum("_w").over(filled.rowsBetween(Window.unboundedPreceding, 0)) + F.col("_w")
    t = t.withColumn("_level", (F.col("_total") - before) / rest)
    holds = F.when(F.col("_cap") >= F.col("_level") * F.col("_w"), F.struct(F.col("_cap") / F.col("_w"), F.col("_s"), F.col("_level").alias("level")))
    t = t.withColumn("_level", F.min(holds).over(everything)["level"])
    return t.select("_s", "source_size", F.least(F.col("_cap"), F.col("_level") * F.col("_w")).alias("target"))


def _boundary(histogram: DataFrame, step: str) -> DataFrame:
    """The bucket of each source in which the running sum reaches the budget, and the sum before it."""
    running = F.sum("_n").over(Window.partitionBy("_s").orderBy(step)) + F.col("_base")
    reached = histogram.withColumn("_cum", running).withColumn("_before", F.col("_cum") - F.col("_n"))
    return reached.where((F.col("_before") < F.col("_need")) & (F.col("_cum") >= F.col("_need")))


def _small(df: DataFrame, sources: int) -> DataFrame:
    return F.broadcast(df) if sources <= BROADCAST_SOURCES else df


def mixing_plan(
    docs: DataFrame,
    *,
    key: str = "doc_id",
    text: str = "text",
    source: str = "source",
    weights: tuple[int, ...] = (3, 1, 2),
    budget: float = 1.5,
    cap: float = 2.0,
    seed: int = 11,
) -> tuple[DataFrame, DataFrame, int, DataFrame | None]:
    """(rows with size and hash, a threshold row per source, number of sources, the keys of repeated rows)."""
    rows = durable(_skeleton(docs, key, text, source))
    same = (F.col("_same_id"), F.col("_same_text"), F.col("_same_source"))
    often = repeated_rows(rows, same)
    base = durable(row_hash(rows, seed, same, often).select("doc_id", "_s", "size", "_h"))
    targets = durable(source_targets(base, weights, budget, cap))
    sources = targets.count()
    whole = F.col("target") >= F.col("source_size")
    plan = targets.withColumn("_whole", whole.cast("int"))
    plan = plan.withColumn("_need", F.col("target") - F.when(whole, F.col("source_size")).otherwise(0))

    first = base.groupBy("_s", F.shiftright("_h", 48).alias("_b1")).agg(F.sum("size").alias("_n"))
    first = first.join(_small(plan.select("_s", "_need"), sources), "_s").withColumn("_base", F.lit(0))
    edge1 = _boundary(first, "_b1").select("_s", "_b1", "_need", F.col("_before").alias("_base"))

    fine = base.withColumn("_b1", F.shiftright("_h", 48)).join(_small(edge1, sources), ["_s", "_b1"])
    fine = durable(fine.select("_s", "_h", "size", "_need", "_base"))
    second = fine.groupBy("_s", F.shiftright("_h", 36).alias("_b2")).agg(
        F.sum("size").alias("_n"), F.first("_need").alias("_need"), F.first("_base").alias("_base")
    )
    edge2 = _boundary(second, "_b2").select("_s", "_b2", F.col("_before").alias("_base"))

    last = fine.drop("_base").withColumn("_b2", F.shiftright("_h", 36)).join(_small(edge2, sources), ["_s", "_b2"])
    last = last.groupBy("_s", "_h").agg(F.sum("size").alias("_n"), F.first("_need").alias("_need"), F.first("_base").alias("_base"))
    over, under = F.col("_cum") - F.col("_need"), F.col("_need") - F.col("_before")
    edge3 = _boundary(last, "_h").select("_s", F.when(over < under, F.col("_h")).otherwise(F.col("_h") - 1).alias("_limit"))

    plan = plan.join(edge3, "_s", "left").withColumn("_limit", F.coalesce("_limit", F.lit(-1).cast("long")))
    return base, durable(plan.select("_s", "source_size", "target", "_whole", "_limit")), sources, often


def _with_plan(rows: DataFrame, plan: DataFrame, sources: int) -> DataFrame:
    if sources <= BROADCAST_SOURCES:
        joined = rows.join(F.broadcast(plan), "_s")
    else:  # a hot source is dealt over SALTS keys
        salted = plan.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        joined = rows.withColumn("_salt", (F.col("_h") % SALTS).cast("int")).join(salted, ["_s", "_salt"]).drop("_salt")
    return joined.withColumn("copies", F.col("_whole") + (F.col("_h") <= F.col("_limit")).cast("int"))


def mix(docs: DataFrame, **options) -> DataFrame:
    """``doc_id, size, source_size, target, copies, taken`` for every row."""
    base, plan, sources, _ = mixing_plan(docs, **options)
    out = _with_plan(base, plan, sources)
    return out.select("doc_id", "size", "source_size", "target", "copies", (F.col("size") * F.col("copies")).alias("taken"))


def mix_documents(docs: DataFrame, **options) -> DataFrame:
    """The documents of the mix, with the columns of ``docs``; one taken twice is there twice."""
    _, plan, sources, often = mixing_plan(docs, **options)
    key, text, source = (F.col(options.get(k, k2)) for k, k2 in (("key", "doc_id"), ("text", "text"), ("source", "source")))
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    same = same_row(key, text, stratum_key(source))
    rows = docs.select(whole.alias("_row"), stratum_key(source).alias("_s"), *[c.alias(f"_same{i}") for i, c in enumerate(same)])
    keyed = row_hash(rows, options.get("seed", 11), tuple(F.col(f"_same{i}") for i in range(3)), often)
    taken = _with_plan(keyed, plan, sources).where("copies > 0")
    return taken.select("_row", F.explode(F.array_repeat(F.lit(0), F.col("copies"))).alias("_copy")).select("_row.*")
