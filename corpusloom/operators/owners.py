"""Merging rows in order, without running through them in order: owner rounds.

The rule to keep: rows come by their number; a row joins the record that owns its archive id, else its DOI, else its
title, and fills what that record has left open; else it founds a record. Behind it the record owns the keys of its
filled fields, whoever owned them before.

Which record a row joins follows from who owned its keys just before it. So a guess of all owners is turned into the table
of claims it implies (key, number, record), every row looks up the last claim before its own number, and what
it finds is the next guess. A guess that finds itself is the sequential result: the claims before a row are those of
earlier rows only, so by induction the first wrong row would have found another owner. Guesses start from the first row
of each key, follow a founder that has joined another record, and are right for a row once they are for those it depends on.

A record claims a key from the row that filled the field on, and again at each of its later rows. Keys are numbers from
the start, that of the first row with the key, so no text travels in the rounds. Keys are looked up by ``asof.last_before``,
which deals the rows of one key over many tasks, and records are put together by aggregates; where rows meet their record, both
sides are tables that a shuffle deals by record, so that adaptive execution splits a large one.

A checkpoint keeps the size that the planner has estimated for it, and the estimate of a join is the product of its sides. Over
rounds that is a number whose digits multiply: at a dozen rounds it took the driver's memory and time, whatever the input. So each
guess is written as Parquet and read again, with the size of its files. A round is few jobs, as the driver keeps each one's plan.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.session import durable, remove_folder, shared_folder

from .asof import last_before

#: Rounds after which rows are taken not to settle: a row then depends on a chain of as many others.
MOST_ROUNDS = 200


def _listed(kinds: int) -> Column:
    """``c, key`` of a row, one of each kind."""
    return F.array(*[F.struct(F.lit(c).alias("c"), F.col(f"_key{c}").alias("key")) for c in range(kinds)])


def _numbered(named: DataFrame, kinds: int) -> DataFrame:
    """``named`` with the number of the first row that has it in place of every key."""
    asked = named.select("_s", F.inline(_listed(kinds))).where("key is not null")
    first = durable(asked.groupBy("c", "key").agg(F.min("_s").alias("_first")))
    of_kind = [F.max(F.when(F.col("c") == c, F.col("_first"))).alias(f"_key{c}") for c in range(kinds)]
    numbers = asked.join(first, ["c", "key"]).groupBy("_s").agg(*of_kind)
    return durable(named.select("_s", *[f"_filled{c}" for c in range(kinds)]).join(numbers, "_s", "left"))


def _looked_up(asked: DataFrame, claims: DataFrame) -> DataFrame:
    """``_s, owner``: for each row with a key that is owned before it, the owner by its first such key."""
    queries = asked.select("c", "key", "_s", F.lit(None).cast("long").alias("owner"), F.lit(0).alias("_side"))
    both = queries.unionByName(claims.select("c", "key", "_s", "owner", F.lit(1).alias("_side")))
    found = last_before(both, ["c", "key"], ["_s", "_side"], "owner", "_found")
    return found.where("_side = 0 and _found is not null").groupBy("_s").agg(F.min_by("_found", "c").alias("owner"))


def _claims(members: DataFrame, kinds: int) -> DataFrame:
    """``c, key, _s, owner``: the keys that records own at each of their rows."""
    filled = [F.when(F.col(f"_filled{c}"), F.col("_s")) for c in range(kinds)]
    each = [F.struct(F.lit(c).alias("c"), F.min_by(f"_key{c}", filled[c]).alias("key"), F.min(filled[c]).alias("since")) for c in range(kinds)]
    records = durable(members.groupBy("owner").agg(F.array(*each).alias("k")))
    return members.select("owner", "_s").join(records, "owner").select("owner", "_s", F.inline("k")).where("key is not null and _s >= since")


def owners(rows: DataFrame, keys: list[Column], filled: list[Column], seq: str = "seq") -> DataFrame:
    """``seq, owner``: the number of the row that founded each row's record.

    ``keys`` come in the order of their precedence, null where there is none; ``filled`` says whether the field behind a key
    is filled, be it with something that gives no key. Numbers are unique. Rows without keys found records of their own.
    """
    kinds = len(keys)
    columns = [F.col(seq).cast("long").alias("_s")]
    columns += [k.alias(f"_key{c}") for c, k in enumerate(keys)] + [F.coalesce(f, F.lit(False)).alias(f"_filled{c}") for c, f in enumerate(filled)]
    known = _numbered(durable(rows.select(*columns)), kinds)
    earlier = [F.when(F.col(f"_key{c}") < F.col("_s"), F.col(f"_key{c}")) for c in range(kinds)]
    guess = known.withColumn("owner", F.coalesce(*earlier, "_s"))
    spark, base = rows.sparkSession, f"{shared_folder(rows.sparkSession).rstrip('/')}/owners-{uuid.uuid4().hex}"
    try:
        for number in range(MOST_ROUNDS):
            moved = guess.where("owner <> _s").select(F.col("_s").alias("owner"), F.col("owner").alias("_to"))
            # A founder that has joined another record: follow it.
            members = durable(guess.join(moved, "owner", "left").select(*known.columns, F.coalesce("_to", "owner").alias("owner")))
            found = _looked_up(members.select("_s", F.inline(_listed(kinds))).where("key is not null"), _claims(members, kinds))
            joined = members.withColumnRenamed("owner", "_was").join(found, "_s", "left")
            joined.select(*known.columns, "_was", F.coalesce("owner", "_s").alias("owner")).write.parquet(f"{base}/{number}")
            guess = spark.read.parquet(f"{base}/{number}")
            if number:
                remove_folder(spark, f"{base}/{number - 1}")
            if guess.where("owner <> _was").isEmpty():
                return durable(guess.select(F.col("_s").cast(rows.schema[seq].dataType).alias(seq), "owner"))
    finally:
        remove_folder(spark, base)
    raise RuntimeError(f"rows do not settle in {MOST_ROUNDS} rounds")
