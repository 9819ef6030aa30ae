"""Ranks, shards, processed sets, task grids and run statistics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from corpusloom import constants as K
from corpusloom.functions import quality as Q
from corpusloom.functions import text as T
from corpusloom.session import durable


def global_rank(rows: DataFrame, order: list[Column], name: str = "rank") -> DataFrame:
    """``rows`` with their place (from 1) in a total ``order``, without a sort in one task.

    Rows are dealt by range, numbered inside each part, and moved up by the sizes of the parts before.
    """
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = durable(rows.repartitionByRange(parts, *order).withColumn("_part", F.spark_partition_id()))
    sizes = placed.groupBy("_part").agg(F.count("*").alias("_n"))  # a row per part
    before = sizes.select("_part", (F.sum("_n").over(Window.orderBy("_part")) - F.col("_n")).alias("_before"))
    inside = F.row_number().over(Window.partitionBy("_part").orderBy(*order))
    return placed.join(F.broadcast(before), "_part").withColumn(name, F.col("_before") + inside).drop("_part", "_before")


def legacy_venue(rows: DataFrame) -> DataFrame:
    """Venues of the form ``arXiv (label)`` become a field and ``arXiv preprint``; defaults fill gaps."""
    venue = T.strip(T.text_or_empty(F.col("venue")))
    old = venue.startswith("arXiv (")
    label = F.expr("substring(_venue, 8, greatest(length(_venue) - 8, 0))")
    primary = T.text_or_empty(F.get("keywords", F.lit(0)))
    named = (
        F.when(primary.startswith("cs."), F.concat(F.lit("Computer Science / "), label))
        .when(primary.startswith("q-bio."), F.concat(F.lit("Quantitative Biology / "), label))
        .otherwise(label)
    )
    field = F.when(F.col("_old") & (T.text_or_empty(F.col("field")) == ""), named).otherwise(F.col("field"))
    out = rows.withColumn("_venue", venue).withColumn("_old", old).withColumn("field", field)
    out = out.withColumn("venue", F.when(F.col("_old"), "arXiv preprint").otherwise(F.col("venue")))
    return out.withColumns({"field": T.first_filled(F.col("field"), F.lit("Unknown")), "venue": T.first_filled(F.col("venue"), F.lit("arXiv preprint"))}).drop("_venue", "_old")


def with_priority(rows: DataFrame) -> DataFrame:
    return rows.withColumns(
        {
            "tier": Q.venue_tier(F.col("venue"), F.col("doi")),
            "cites": F.coalesce(F.col("citation_count").cast("int"), F.lit(0)),
            "known_year": F.coalesce(F.col("year").cast("int"), F.lit(0)),
        }
    )


def rank_candidates(rows: DataFrame, seq: str = "seq") -> DataFrame:
    """Rank by tier, citations and year, all descending; ties keep their order."""
    return global_rank(with_priority(rows), [F.desc("tier"), F.desc("cites"), F.desc("known_year"), F.asc(seq)])


def shard_of(rank: Column, shards: int) -> Column:
    return F.pmod(rank - 1, F.lit(shards)).cast("int")


def unprocessed(rows: DataFrame, done: DataFrame) -> DataFrame:
    """Rows of which neither the archive id nor the title is in ``done`` (``processed_id``); null never matches."""
    ids = done.select("processed_id").distinct()
    left = rows.join(ids, rows["arxiv_id"] == ids["processed_id"], "left_anti")
    return left.join(ids, left["title"] == ids["processed_id"], "left_anti")


def processed_by_output(rows: DataFrame, stems: DataFrame) -> DataFrame:
    """``processed_id`` of the rows whose output stem is among ``stems`` (``stem``)."""
    mine = rows.withColumn("stem", T.output_stem(F.col("arxiv_id"), F.col("doi"), F.col("pmcid"), F.col("title")))
    found = mine.join(stems.select("stem").distinct(), "stem", "left_semi")
    return found.select(T.first_filled(F.col("arxiv_id"), F.col("title")).alias("processed_id")).distinct()


def unmatched_outputs(stems: DataFrame, rows: DataFrame) -> DataFrame:
    """Output stems that no candidate explains; an expansion must find none."""
    mine = rows.select(T.output_stem(F.col("arxiv_id"), F.col("doi"), F.col("pmcid"), F.col("title")).alias("stem"))
    return stems.select("stem").distinct().join(mine, "stem", "left_anti")


def prepare_expansion(rows: DataFrame, stems: DataFrame, first_shard: int, shards: int = 8) -> DataFrame:
    """Progress rows of the next shards: every shard starts from all processed ids."""
    missing = unmatched_outputs(stems, rows).orderBy("stem").limit(10).collect()
    if missing:
        raise ValueError("outputs without a candidate: " + ", ".join(r["stem"] for r in missing))
    spread = F.explode(F.sequence(F.lit(first_shard), F.lit(first_shard + shards - 1))).alias("shard")
    return processed_by_output(rows, stems).select("processed_id", spread, F.lit(K.RUN_VERSION).alias("pipeline_version"))


def first_successes(ranked: DataFrame, ok: Column, limit: int, already: int = 0) -> DataFrame:
    """Rows up to the ``limit``-th success by rank; ``already`` successes count before the first row."""
    good = global_rank(ranked.where(ok), [F.asc("rank")], "_nth").where(F.col("_nth") == max(limit - already, 0)).select(F.col("rank").alias("_last"))
    if limit - already <= 0:
        return ranked.limit(0)
    bounded = ranked.join(F.broadcast(good.agg(F.max("_last").alias("_last"))))  # one row
    return bounded.where(F.col("_last").isNull() | (F.col("rank") <= F.col("_last"))).drop("_last")


def pool_statistics(rows: DataFrame) -> DataFrame:
    """Counts by tier, years, DOIs and rows that a lookup by identifier could serve."""
    eligible = ((T.text_or_empty(F.col("doi")) != "") & ~T.is_archive_doi(F.col("doi"))) | (T.text_or_empty(F.col("publisher_url")) != "") | (T.text_or_empty(F.col("pmid")) != "")
    return with_priority(rows).agg(
        F.count("*").alias("n_rows"),
        F.count_if(F.col("tier") == 3).alias("n_top"),
        F.count_if(F.col("tier") == 2).alias("n_formal"),
        F.count_if(F.col("tier") < 2).alias("n_preprint"),
        F.min("year").alias("min_year"),
        F.max("year").alias("max_year"),
        F.count_if(T.text_or_empty(F.col("doi")) != "").alias("n_doi"),
        F.count_if(eligible).alias("n_eligible"),
    )


def source_counts(rows: DataFrame) -> DataFrame:
    return rows.groupBy(T.first_filled(F.col("source"), F.lit("unknown")).alias("source")).agg(F.count("*").alias("n"))


def search_tasks(spark: SparkSession) -> DataFrame:
    """The search grid in its order: ``pos, tag, cats, query, max, key``."""

    def names(values: tuple[str, ...]) -> DataFrame:
        return spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, name string")

    def years(span: tuple[int, int]) -> DataFrame:
        return spark.range(span[0], span[1] + 1).select(F.col("id").cast("int").alias("year"))

    def dated(values: tuple[str, ...], span: tuple[int, int], form: str, tag: str, group: int) -> DataFrame:
        window = F.format_string("submittedDate:[%d01010000 TO %d12312359]", "year", "year")
        grid = names(values).crossJoin(years(span))  # two fixed lists
        query = F.concat_ws(" AND ", F.format_string(form, "name"), window)
        return grid.select(F.lit(group).alias("g"), "i", F.col("year").alias("j"), F.lit(tag).alias("tag"), F.lit(None).cast("array<string>").alias("cats"), query.alias("query"))

    def topical(values: tuple[str, ...], cats: tuple[str, ...], size: int, tag: str, group: int) -> DataFrame:
        every = F.array(*[F.lit(c) for c in cats])
        chunks = F.transform(F.sequence(F.lit(1), F.lit(len(cats)), F.lit(size)), lambda k: F.slice(every, k, F.lit(size)))
        return names(values).select("i", "name", F.posexplode(chunks).alias("j", "cats")).select(F.lit(group).alias("g"), "i", "j", F.lit(tag).alias("tag"), "cats", F.col("name").alias("query"))

    parts = (
        dated(K.TOP_VENUES, K.VENUE_YEARS, 'jr:"%s"', "journal_venue", 0),
        dated(K.TOP_VENUES, K.VENUE_YEARS, 'co:"%s"', "comment_venue", 1),
        topical(K.COMPUTING_TOPICS, K.COMPUTING_CATEGORIES, 4, "cs_topic", 2),
        topical(K.BIOLOGY_TOPICS, K.BIOLOGY_CATEGORIES, 3, "bio_topic", 3),
        dated(K.SWEEP_TERMS, K.SWEEP_YEARS, "(%s)", "broad", 4),
    )
    grid = parts[0]
    for p in parts[1:]:
        grid = grid.unionByName(p)
    key = F.concat(F.col("tag"), F.lit(":"), F.coalesce(F.array_join("cats", ","), F.lit("")), F.lit(":"), F.col("query"))
    pos = F.row_number().over(Window.orderBy("g", "i", "j")) - 1  # some thousand rows of fixed lists
    return grid.select(pos.alias("pos"), "tag", "cats", "query", F.lit(K.ROWS_PER_SEARCH).alias("max"), key.alias("key"))


def pending_tasks(tasks: DataFrame, progress: DataFrame) -> DataFrame:
    """Tasks that no progress row of the current version lists in ``searches_done``."""
    done = progress.where(F.col("pipeline_version") == K.RUN_VERSION).select(F.explode("searches_done").alias("key")).distinct()
    return tasks.join(done, "key", "left_anti")


def harvest_tasks(spark: SparkSession, newest: str = "2026-07-01", oldest: str = "2015-01-01") -> DataFrame:
    """Months from newest to oldest by categories: ``pos, category, date_range``."""
    months = spark.sql(f"select posexplode(sequence(date'{newest}', date'{oldest}', interval -1 month)) as (i, month)")
    cats = spark.createDataFrame([(i, c) for i, c in enumerate(K.CATEGORIES)], "j int, category string")
    grid = months.crossJoin(cats)  # two fixed lists
    window = F.concat(F.lit("submittedDate:["), F.date_format("month", "yyyyMM"), F.lit("010000 TO "), F.date_format(F.last_day("month"), "yyyyMMdd"), F.lit("2359]"))
    return grid.select((F.col("i") * len(K.CATEGORIES) + F.col("j")).alias("pos"), "category", window.alias("date_range"))


def set_name(category: Column) -> Column:
    """Harvest set of a category: ``cs.AI`` is ``cs:cs:AI``."""
    return F.regexp_replace(category, r"^([^.]+)\.(.*)$", "$1:$1:$2")


def budgeted_union(sources: list[DataFrame], most: int, seq: str = "seq") -> DataFrame:
    """Sources in order, each row by ``seq``, up to ``most`` rows in all."""
    tagged = [s.withColumn("_source", F.lit(i)) for i, s in enumerate(sources)]
    rows = tagged[0]
    for t in tagged[1:]:
        rows = rows.unionByName(t)
    return rows.orderBy("_source", seq).limit(most).drop("_source")


def outcome_counts(outcomes: DataFrame) -> DataFrame:
    """``source, category, n`` from rows with ``source`` (null: failed) and ``errors``."""
    category = F.when(F.col("source").isNull(), Q.failure_category(F.col("errors")))
    return outcomes.groupBy("source", category.alias("category")).agg(F.count("*").alias("n"))


def discovery_must_stop(outcomes: DataFrame, failures: int = 3) -> bool:
    """True if no search brought rows or succeeded and the last ``failures`` all failed (``pos, ok, n``)."""
    total = outcomes.agg(F.count_if("ok").alias("good"), F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.count("*").alias("all")).first()
    return total["good"] == 0 and total["n"] == 0 and total["all"] >= failures


def batches(rows: DataFrame, size: int, order: list[Column]) -> DataFrame:
    """``rows`` with ``batch``: consecutive groups of ``size`` in a total order."""
    return global_rank(rows, order, "_rank").withColumn("batch", F.floor((F.col("_rank") - 1) / size).cast("int")).drop("_rank")
