"""Deduplication by rules that depend on the order of rows.

Rows can only influence one another through shared keys. Where a rule only keeps or drops rows, minima by key
decide in rounds; what those leave is run through in order, a connected component of rows and keys a task. Merging
rows finds the owner of every key at every row (``owners``) and puts the rows of a record together by aggregates.
"""

from __future__ import annotations

from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, NumericType, StringType

from corpusloom.functions import text as T
from corpusloom.schemas import CANDIDATE_COLUMNS
from corpusloom.session import durable

from .components import component_of_keys
from .owners import owners

#: Venues and fields that a later row may replace. Fixed values.
OPEN_VENUES = ("", "Unknown", "arXiv preprint")
OPEN_FIELDS = ("", "Unknown")
#: Rounds that decide rows by minima before the rest is run through in order, a component a task.
ROUNDS = 12


def _fold(rows: DataFrame, keys: dict[str, object], rule: Callable[[list[dict]], list[dict]], seq: str) -> DataFrame:
    columns = rows.columns
    keyed = rows.withColumns(keys)
    grouped = component_of_keys(keyed, [F.col(k) for k in keys], seq)
    schema = keyed.select(*columns).schema

    def run(table: pa.Table) -> pa.Table:
        kept = rule(sorted(table.to_pylist(), key=lambda r: r[seq]))
        wanted = table.select(columns).schema
        return pa.Table.from_pylist([{c: r[c] for c in columns} for r in kept], wanted)

    return grouped.groupBy("component").applyInArrow(run, schema)


def _identity_keys() -> list[Column]:
    """Archive id, DOI and title as keys, in the order of their precedence."""
    return [
        T.filled(F.lower(T.drop_version(F.col("arxiv_id")))),
        T.filled(T.strip(F.lower(T.text_or_empty(F.col("doi"))))),
        T.filled(T.plain_key(F.col("title"))),
    ]


def _is_filled(column: Column, kind: DataType) -> Column:
    """Neither null nor an empty string or list."""
    if isinstance(kind, StringType):
        return T.text_or_empty(column) != ""
    return F.coalesce(F.size(column) > 0, F.lit(False)) if isinstance(kind, ArrayType) else column.isNotNull()


def _is_settled(name: str, column: Column, kind: DataType) -> Column:
    """Whether a field's value stays, whatever later rows bring."""
    if name == "venue":
        return ~T.text_or_empty(column).isin(*OPEN_VENUES) & ~T.text_or_empty(column).startswith("arXiv (")
    if name == "field":
        return ~T.text_or_empty(column).isin(*OPEN_FIELDS)
    if isinstance(kind, NumericType):
        return F.coalesce(column != 0, F.lit(False))
    return _is_filled(column, kind)


def merge_duplicates(rows: DataFrame, seq: str = "seq") -> DataFrame:
    """One row per work: match by archive id, then DOI, then title; richer metadata fills gaps.

    A row joins the record that owns its first owned key (see ``owners``). A field is that of the first row with a value that
    settles it; without one the last filled value stands, else the founder's own. Other columns are the founder's.
    """
    filled = [_is_filled(F.col(c), rows.schema[c].dataType) for c in ("arxiv_id", "doi", "title")]
    joined = rows.join(owners(rows, _identity_keys(), filled, seq), seq)
    place = F.struct(F.col(seq))  # never null, so a founder's null is found as well
    out = []
    for c in rows.columns:
        own = F.min_by(F.struct(F.col(c)), place)[c]
        if c in CANDIDATE_COLUMNS:
            kind = rows.schema[c].dataType
            first = F.min_by(c, F.when(_is_settled(c, F.col(c), kind), F.col(seq)))
            last = F.max_by(c, F.when(_is_filled(F.col(c), kind), F.col(seq)))
            own = F.coalesce(first, last, own)
        out.append(own.alias(c))
    return joined.groupBy("owner").agg(*out).select(*rows.columns)


def _firsts(rows: DataFrame, key: str, seq: str) -> DataFrame:
    """The rows that are the first of their key, and those without one. Joined by place, so no key is frequent."""
    first = rows.where(F.col(key).isNotNull()).groupBy(key).agg(F.min(seq).alias("_first")).select("_first")
    return rows.where(F.col(key).isNotNull()).join(first, F.col(seq) == F.col("_first"), "left_semi").unionByName(rows.where(F.col(key).isNull()))


def keep_first(rows: DataFrame, seq: str = "seq") -> DataFrame:
    """The first row of each DOI and title stays, by lower case and without final full stops.

    A DOI stays claimed even if the title then fails, so the first row of a DOI claims it whatever follows, and
    a title is claimed by the first row that passed by its DOI: two minima instead of a run in order.
    """
    title = F.regexp_replace(T.strip(F.lower(T.text_or_empty(F.col("title")))), r"\.+$", "")
    keyed = durable(rows.select(seq, T.filled(F.lower(F.col("doi"))).alias("_doi"), title.alias("_title")))
    kept = _firsts(_firsts(keyed, "_doi", seq), "_title", seq)
    return rows.join(kept.select(F.col(seq).alias("_kept")), F.col(seq) == F.col("_kept"), "left_semi")


def _unseen_rule(rows: list[dict]) -> list[dict]:
    seen: set[tuple[str, str]] = set()
    kept = []
    for row in rows:
        mine = {(k, row[k]) for k in ("_id", "_title") if row[k] is not None}
        if not mine & seen:
            seen |= mine
            kept.append(row)
    return kept


def unseen_rows(cache: DataFrame, fresh: DataFrame, *, empty_is_key: bool, seq: str = "seq") -> DataFrame:
    """The rows of ``fresh`` whose id and title are both unseen in ``cache`` and in earlier fresh rows."""
    id_key, name_key = T.harvest_id(F.col("arxiv_id")), T.plain_key(F.col("title"))
    if not empty_is_key:
        id_key, name_key = T.filled(id_key), T.filled(name_key)
    old = cache.select(id_key.alias("_i"), name_key.alias("_t"))
    new = fresh.withColumns({"_id": id_key, "_title": name_key})
    new = new.join(old.select("_i").distinct(), F.col("_id") == F.col("_i"), "left_anti")
    new = new.join(old.select("_t").distinct(), F.col("_title") == F.col("_t"), "left_anti")
    open_ = durable(new.select(seq, "_id", "_title"))
    kept = None
    for _ in range(ROUNDS):
        # A row that is the first of both its keys is seen before every row it shares one with; those go.
        first = durable(_firsts(open_, "_id", seq).select(seq).intersect(_firsts(open_, "_title", seq).select(seq)).join(open_, seq))
        kept = first.select(seq) if kept is None else kept.unionByName(first.select(seq))
        rest = open_.join(first.select(seq), seq, "left_anti")
        for k in ("_id", "_title"):
            rest = rest.join(first.select(F.col(k).alias("_k")).where("_k is not null"), F.col(k) == F.col("_k"), "left_anti")
        open_ = durable(rest)
        if open_.isEmpty():
            break
    else:
        kept = kept.unionByName(_fold(open_, {"_id": F.col("_id"), "_title": F.col("_title")}, _unseen_rule, seq).select(seq))
    return fresh.join(kept.select(F.col(seq).alias("_kept")), F.col(seq) == F.col("_kept"), "left_semi")


def merge_harvest(cache: DataFrame, fresh: DataFrame, *, empty_is_key: bool, seq: str = "seq") -> DataFrame:
    """``cache`` and the unseen rows of ``fresh``.

    With ``empty_is_key`` an empty id or title counts as a value that can be seen; without, it never matches.
    """
    return cache.unionByName(unseen_rows(cache, fresh, empty_is_key=empty_is_key, seq=seq))
