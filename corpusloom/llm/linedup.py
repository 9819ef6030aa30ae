"""Line dedup by a suffix array over line ids, in DataFrame functions only.

Texts are sequences of lines, split at newlines. A run of consecutive lines with at least
``min_words`` words that stands at two or more places is a repeated run; it is kept where it stands
first (by doc_id, then text hash, then line) and deleted everywhere else.

Suffixes are ranked by prefix doubling: level k ranks every position by its first 2**k lines, in the
order of a suffix array, from the pair of level k-1 ranks at the position and 2**(k-1) lines on. Only
positions whose prefix stands at two places or more go on, so unique lines leave the work at once.
Ranks are given to distinct pairs by a range-dealt sort with partition offsets; a line that is very
frequent is one pair, counted before the shuffle, and never one task's rows.

The suffixes that share their first n lines are one longest-common-prefix interval of depth n. It is
named by the ranks of its first and its last 2**k lines (k: the floor of log2 n). For each start the
shortest run with ``min_words`` words is looked up in its interval, and for each end as well; a longer
maximal run is the union of those. Levels end where the longest such run ends, so rounds grow with the
logarithm of its number of lines.

The first copy of every line always stays: what is deleted at one place stands at an earlier one.

Defined cases: null texts stay null and take no part; a text whose lines all go becomes empty; blank
lines count as lines without words; rows that repeat both doc_id and text stand one behind the other, so
all of a later one is a later copy: it loses every line if it has ``min_words`` words; which of them is the
first is open; a null doc_id comes before all others; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import durable, word_count

DOC = ["doc_id", "th"]


def dense_ranks(keys: DataFrame, columns: list[str]) -> DataFrame:
    """Distinct ``keys`` with their ``rank`` (from 0) in the order of ``columns``, dealt by range."""
    parts = int(keys.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = keys.select(*columns).repartitionByRange(parts, *columns)
    placed = durable(dealt.withColumn("_p", F.spark_partition_id()))
    sizes = placed.groupBy("_p").agg(F.count("*").alias("_n"))  # a row per partition
    offsets = sizes.select("_p", (F.sum("_n").over(Window.orderBy("_p")) - F.col("_n")).alias("_before"))
    inside = Window.partitionBy("_p").orderBy(*columns)
    rank = F.col("_before") + F.row_number().over(inside) - 1
    return placed.join(F.broadcast(offsets), "_p").select(*columns, rank.alias("rank"))


def _lines(docs: DataFrame) -> DataFrame:
    spread = docs.where("text is not null").select(*DOC, F.posexplode(F.split("text", "\n", -1)).alias("ln", "line"))
    return spread.select(*DOC, "ln", F.xxhash64("line").alias("h1"), F.xxhash64(F.lit(7), F.col("line")).alias("h2"), word_count(F.col("line")).alias("w"))


def _shortest_runs(repeated: DataFrame, min_words: int) -> DataFrame:
    """``doc_id, th, start, n``: the shortest runs of repeated lines with enough words, by start and by end."""
    by_line = Window.partitionBy(*DOC).orderBy("ln")
    islands = repeated.withColumn("_run", F.col("ln") - F.row_number().over(by_line))
    run = Window.partitionBy(*DOC, "_run")
    sums = islands.withColumn("_ce", F.sum("w").over(run.orderBy("ln")) - F.col("w")).withColumn("_end", F.max("ln").over(run))
    # One more row behind each island carries the sum of all its words.
    more = F.when(F.col("ln") == F.col("_end"), F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    edges = sums.withColumn("_x", F.explode(more)).select(
        *DOC, "_run", (F.col("ln") + F.col("_x")).alias("ln"), (F.col("_ce") + F.col("w") * F.col("_x")).alias("_ce"), (F.col("_x") == 1).alias("_last")
    )
    up = run.orderBy(F.col("_ce").asc()).rangeBetween(Window.unboundedPreceding, -min_words)
    down = run.orderBy(F.col("_ce").desc()).rangeBetween(Window.unboundedPreceding, -min_words)
    found = edges.withColumn("_from", F.max("ln").over(up)).withColumn("_to", F.min("ln").over(down))
    by_end = found.where("_from is not null").select(*DOC, F.col("_from").alias("start"), (F.col("ln") - F.col("_from")).alias("n"))
    by_start = found.where("_to is not null and not _last").select(*DOC, F.col("ln").alias("start"), (F.col("_to") - F.col("ln")).alias("n"))
    return by_end.unionByName(by_start).distinct()


def _later_copies(runs: DataFrame, ranks: DataFrame, level: int) -> DataFrame:
    """Of the runs of 2**level to 2**(level+1)-1 lines, those whose interval has an earlier start."""
    step = 1 << level
    mine = runs.where((F.col("n") >= step) & (F.col("n") < 2 * step)).withColumn("_tail", F.col("start") + F.col("n") - step)

    def join(left: DataFrame, at: str, name: str) -> DataFrame:
        right = ranks.select(F.col("doc_id").alias("_d"), F.col("th").alias("_t"), F.col("ln").alias("_l"), F.col("rank").alias(name))
        same = F.col("doc_id").eqNullSafe(F.col("_d")) & (F.col("th") == F.col("_t")) & (F.col(at) == F.col("_l"))
        return left.join(right, same).drop("_d", "_t", "_l")

    named = join(mine, "start", "_a")
    named = named.withColumn("_b", F.col("_a")) if step == 1 else join(named, "_tail", "_b")
    firsts = named.groupBy("n", "_a", "_b").agg(F.min(F.struct("doc_id", "th", "start")).alias("_f"))
    first = firsts.select("n", F.col("_f.doc_id").alias("_d"), F.col("_f.th").alias("_t"), F.col("_f.start").alias("_l"))
    # By place, not by interval: however many copies an interval has, no key of this join is frequent.
    itself = (named["n"] == first["n"]) & F.col("doc_id").eqNullSafe(F.col("_d")) & (F.col("th") == F.col("_t")) & (F.col("start") == F.col("_l"))
    return named.join(first, itself, "left_anti").select(*DOC, "start", "n")


def _double(ranks: DataFrame, level: int) -> DataFrame:
    """Ranks of twice as many lines, for the positions where those stand twice or more."""
    step = 1 << level
    ahead = Window.partitionBy(*DOC).orderBy("ln").rangeBetween(step, step)
    pairs = ranks.withColumn("_next", F.max("rank").over(ahead)).where("_next is not null")
    often = pairs.groupBy("rank", "_next").agg(F.count("*").alias("_n")).where("_n > 1")
    fresh = dense_ranks(often, ["rank", "_next"]).toDF("_r", "_s", "_new")
    joined = pairs.join(fresh, (F.col("rank") == F.col("_r")) & (F.col("_next") == F.col("_s")))
    return durable(joined.select(*DOC, "ln", F.col("_new").alias("rank")))


def deleted_lines(docs: DataFrame, *, key: str = "doc_id", text: str = "text", min_words: int = 50) -> DataFrame:
    """``doc_id, th, lines``: the numbers (from 0) of the lines to delete, for documents that lose any.

    Rows that repeat doc_id and text are one document here.
    """
    rows = docs.select(F.col(key).alias("doc_id"), F.xxhash64(text).alias("th"), F.col(text).cast("string").alias("text"))
    if not rows.groupBy(*DOC).count().where("count > 1").isEmpty():
        rows = rows.dropDuplicates(DOC)
    lines = _lines(rows)
    often = lines.groupBy("h1", "h2").agg(F.count("*").alias("_n")).where("_n > 1")
    ids = dense_ranks(often, ["h1", "h2"])
    repeated = durable(lines.join(ids, ["h1", "h2"]).select(*DOC, "ln", "w", "rank"))
    runs = durable(_shortest_runs(repeated, min_words))
    longest = runs.agg(F.max("n")).first()[0] or 0
    ranks, level, later = repeated.select(*DOC, "ln", "rank"), 0, None
    while (1 << level) <= longest:
        found = durable(_later_copies(runs, ranks, level))
        later = found if later is None else later.unionByName(found)
        level += 1
        if (1 << level) <= longest:
            ranks = _double(ranks, level - 1)
    later = runs.limit(0) if later is None else later
    covered = later.select(*DOC, F.explode(F.sequence("start", F.col("start") + F.col("n") - 1)).alias("ln"))
    return covered.groupBy(*DOC).agg(F.collect_set("ln").alias("lines"))


def _numbered(rows: DataFrame, min_words: int) -> DataFrame:
    """``rows`` with ``_again``: a row of equal id and text stands before it, and it has enough words to lose."""
    often = rows.where("_text is not null").groupBy("_key", "_hash").agg(F.count("*").alias("_n")).where("_n > 1")
    often = durable(often.select(F.col("_key").alias("_k"), F.col("_hash").alias("_h")))
    if often.isEmpty():
        return rows.withColumn("_again", F.lit(False))
    same = F.col("_key").eqNullSafe(F.col("_k")) & (F.col("_hash") == F.col("_h"))
    many = durable(rows.join(often, same, "left_semi").withColumn("_place", F.monotonically_increasing_id()))
    first = many.groupBy("_key", "_hash").agg(F.min("_place").alias("_first")).select("_first")
    # Joined by place, so a row that is repeated very often is no frequent key.
    placed = many.join(first, F.col("_place") == F.col("_first"), "left")
    again = F.col("_first").isNull() & (word_count(F.col("_text")) >= min_words)
    return rows.join(often, same, "left_anti").withColumn("_again", F.lit(False)).unionByName(placed.withColumn("_again", again).drop("_place", "_first"))


def _edited(docs: DataFrame, key: str, text: str, min_words: int) -> DataFrame:
    """``_row`` (the input row), ``_text`` (edited), ``_lines`` and ``_deleted`` (their numbers)."""
    gone = durable(deleted_lines(docs, key=key, text=text, min_words=min_words)).toDF("_id", "_th", "_gone")
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"), F.col(key).alias("_key"), F.col(text).cast("string").alias("_text"))
    rows = _numbered(rows.withColumn("_hash", F.xxhash64("_text")), min_words)
    joined = rows.join(gone, F.col("_key").eqNullSafe(F.col("_id")) & (F.col("_hash") == F.col("_th")), "left")
    lines = F.split("_text", "\n", -1)
    left = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col("_gone"))
    kept = F.array_join(F.transform(left, lambda i: F.get(lines, i)), "\n")
    return joined.select(
        "_row",
        F.when(F.col("_again"), "").when(F.col("_gone").isNull(), F.col("_text")).otherwise(kept).alias("_text"),
        F.when(F.col("_text").isNull(), 0).otherwise(F.size(lines)).alias("_lines"),
        F.when(F.col("_again"), F.size(lines)).when(F.col("_gone").isNull(), 0).otherwise(F.size("_gone")).alias("_deleted"),
    )


def drop_repeated_lines(docs: DataFrame, *, key: str = "doc_id", text: str = "text", min_words: int = 50) -> DataFrame:
    """``doc_id, text, n_lines, n_deleted``: one row per input row, texts edited."""
    found = _edited(docs, key, text, min_words)
    return found.select(F.col("_row")[key].alias("doc_id"), F.col("_text").alias("text"), F.col("_lines").alias("n_lines"), F.col("_deleted").alias("n_deleted"))


def dedup_documents(docs: DataFrame, *, key: str = "doc_id", text: str = "text", min_words: int = 50) -> DataFrame:
    """``docs`` with edited texts and all other columns as they are; documents that lose every line go."""
    found = _edited(docs, key, text, min_words).where("_deleted = 0 or _deleted < _lines")
    return found.select(*[F.col("_text").alias(c) if c == text else F.col("_row")[c].alias(c) for c in docs.columns])
