"""Cited works to complete abstracts: indexes, lookups by priority, fuzzy titles, publications."""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.functions import quality as Q
from corpusloom.functions import text as T
from corpusloom.functions.kernels import similarity
from corpusloom.session import durable

from .ranking import batches

#: Most rows of one lookup request, by service. Fixed values.
BATCH_SIZES = {"papers": 500, "archive": 100, "pubmed": 200, "titles": 10}
ID_KEYS = ("arxiv_id", "doi", "pmid")
#: Buckets of the counts by which the pieces of a title are chosen.
GRAM_BITS = 20
#: The group of each byte of a title: letters are dealt to sixteen, frequent ones apart. Fixed values.
_GROUPS = np.array([{c: i % 16 for i, c in enumerate(" etaoinsrhldcumfpgwybvkxjqz0123456789")}.get(chr(b), b % 16) for b in range(256)])


def normalized_index(records: DataFrame, *, plain: bool = False) -> DataFrame:
    """Records with a title and a complete abstract, ids normalized (null where empty), in load order ``seq``.

    ``plain`` opens only the common entities and keeps the work in the JVM.
    """
    clean = T.clean_abstract_plain if plain else T.clean_abstract
    out = records.select(
        "seq",
        T.clean_space(F.col("title")).alias("title"),
        clean(F.col("abstract")).alias("abstract"),
        T.filled(T.archive_key(F.col("arxiv_id"))).alias("arxiv_id"),
        T.filled(T.doi_key(F.col("doi"))).alias("doi"),
        T.filled(T.pmid_key(F.col("pmid"))).alias("pmid"),
        F.coalesce("authors", F.array().cast("array<string>")).alias("authors"),
        T.text_or_empty(F.col("year")).alias("year"),
    )
    return out.where((F.col("title") != "") & Q.is_complete(F.col("abstract")))


_RECORD = ("title", "abstract", "arxiv_id", "doi", "pmid", "authors", "year", "seq")


def _keyed(*keys: Column) -> Column:
    """Rows of ``kind`` (by priority) and ``key`` for the keys that are not null."""
    return F.explode(F.array_compact(F.array(*[F.when(k.isNotNull(), F.struct(F.lit(i).alias("kind"), k.alias("key"))) for i, k in enumerate(keys)])))


def _lookups(index: DataFrame) -> DataFrame:
    """``kind, key, hit``: the last record of each id, and of each title whose records all have one identity."""
    best = T.best_identifier(F.col("arxiv_id"), F.col("doi"), F.col("pmid"), F.col("title"))
    spread = index.select("seq", best.alias("_b"), _keyed(*[F.col(k) for k in ID_KEYS], T.filled(T.title_key(F.col("title")))).alias("_k")).select("seq", "_b", "_k.*")
    last = spread.groupBy("kind", "key").agg(F.max("seq").alias("hit"), F.min("_b").alias("_a"), F.max("_b").alias("_z"))
    return last.where((F.col("kind") < len(ID_KEYS)) | (F.col("_a") == F.col("_z"))).select("kind", "key", "hit")


def ambiguous_titles(index: DataFrame) -> DataFrame:
    keyed = index.select(T.title_key(F.col("title")).alias("title_key"), T.best_identifier(F.col("arxiv_id"), F.col("doi"), F.col("pmid"), F.col("title")).alias("b"))
    return keyed.groupBy("title_key").agg(F.min("b").alias("_a"), F.max("b").alias("_z")).where("_a <> _z").select("title_key")


def match(candidates: DataFrame, index: DataFrame) -> DataFrame:
    """``candidates`` with ``record``: the index row by archive id, DOI, PMID or unambiguous title, in this order.

    Distinct sets of keys are looked up, not rows; a missing key is never shuffled, and records travel only
    once they are chosen. ``seq`` numbers the index rows without repeats.
    """
    index = durable(index)
    normal = [T.archive_key(F.col("arxiv_id")), T.doi_key(F.col("doi")), T.pmid_key(F.col("pmid")), T.title_key(F.col("title"))]
    keys = [T.filled(k) for k in normal]
    whole = F.when(F.coalesce(*keys).isNotNull(), F.concat_ws("\n", *[F.coalesce(k, F.lit("")) for k in keys]))
    asked = candidates.select(whole.alias("_keys"), *[k.alias(f"_{i}") for i, k in enumerate(keys)]).where("_keys is not null").distinct()
    spread = asked.select("_keys", _keyed(*[F.col(f"_{i}") for i in range(len(keys))]).alias("_k")).select("_keys", "_k.*")
    hits = spread.join(_lookups(index), ["kind", "key"]).groupBy("_keys").agg(F.min_by("hit", "kind").alias("_hit"))
    records = hits.join(index.select(F.col("seq").alias("_hit"), F.struct(*_RECORD).alias("record")), "_hit").drop("_hit")
    rows = candidates.withColumn("_keys", whole)
    found = rows.where("_keys is not null").join(records, "_keys", "left").drop("_keys")
    none = rows.where("_keys is null").drop("_keys").withColumn("record", F.lit(None).cast(found.schema["record"].dataType))
    return found.unionByName(none)


def finalize(matched: DataFrame) -> DataFrame:
    """``id, title, summary, citation_contexts`` beside the candidate's own keys, for matched rows."""
    r = F.col("record")
    identifier = T.first_filled(T.best_identifier(r["arxiv_id"], r["doi"], r["pmid"], r["title"]), F.col("id"))
    out = matched.where(r.isNotNull()).withColumns(
        {"resolved_id": identifier, "resolved_title": T.clean_space(T.first_filled(r["title"], F.col("title"))), "summary": r["abstract"]}
    )
    return out.where("resolved_id <> '' and resolved_title <> ''")


def pending(candidates: DataFrame, index: DataFrame, key: list[str]) -> DataFrame:
    """Candidates that the index does not resolve."""
    return candidates.join(finalize(match(candidates, index)).select(*key), key, "left_anti")


def title_lookups(unresolved: DataFrame, most: int = 30, group: str = "paper_id") -> DataFrame:
    """The usable titles worth a lookup: newest, then longest, at most ``most`` of each paper."""
    key = T.title_key(F.col("title"))
    known = (T.text_or_empty(F.col("authors")) != "") | (T.text_or_empty(F.col("year")) != "")
    usable = unresolved.where(Q.title_is_usable(F.col("title"), known)).withColumns({"_y": F.coalesce(T.year_of(F.col("year")), F.lit(0)), "_w": F.size(F.split(key, " "))})
    nth = F.row_number().over(Window.partitionBy(group).orderBy(F.desc("_y"), F.desc("_w"), F.asc("ord")))
    return usable.withColumn("lookup_rank", nth).where(F.col("lookup_rank") <= most).drop("_y", "_w")


def lookup_batches(values: DataFrame, known: DataFrame, column: str, size: int) -> DataFrame:
    """Distinct values (by first ``seq``) that ``known`` does not hold, in requests of ``size``."""
    distinct = values.where(T.text_or_empty(F.col(column)) != "").groupBy(column).agg(F.min("seq").alias("seq"))
    missing = distinct.join(known.select(column).distinct(), column, "left_anti")
    return batches(missing, size, [F.asc("seq"), F.asc(column)])


def _edits(n: int, least: float) -> int:
    """Most characters that a title of ``n`` and one of ratio ``least`` have outside their matching blocks."""
    return int(2 * n * (1 - least) / least + 1e-9)


def _piece(n: int, least: float) -> int:
    """The length of the pieces of a title of ``n``: one piece more than may be destroyed fits in."""
    return n // (_edits(n, least) + 1)


def _partners(n: int, least: float) -> tuple[int, int]:
    """The least and the greatest length of a title that can reach the ratio beside one of ``n``, rounded outwards."""
    reach = (2 - least) / least
    return max(1, int(n / reach)), int(n * reach) + 1


@lru_cache(maxsize=4096)
def _pieces(n: int, least: float) -> tuple[int, ...]:
    """The lengths of the pieces of all titles that one of ``n`` may meet."""
    low, high = _partners(n, least)
    return tuple(sorted({q for m in range(low, high + 1) if (q := _piece(m, least)) <= n}))


def _grams(title: str, q: int) -> np.ndarray:
    """A hash of every run of ``q`` characters of a normalized title."""
    c = np.frombuffer(title.encode(), np.uint8).astype(np.uint64)
    out = np.full(len(c) - q + 1, q, np.uint64)
    for j in range(q):
        out = (out ^ c[j : len(c) - q + 1 + j]) * np.uint64(0x9E3779B97F4A7C15)
        out ^= out >> np.uint64(29)
    return out


def _bucket(grams: np.ndarray, bits: int) -> np.ndarray:
    return ((grams * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - bits)).astype(np.int64)


def _rarest(cost: np.ndarray, q: int, k: int) -> np.ndarray:
    """The starts of ``k`` runs of ``q`` that do not overlap, of the least cost in all."""
    room = len(cost) + q - k * q  # each run may start in so many places, behind those before it
    at = np.arange(k)[:, None] * q + np.arange(room)
    best = cost[at].astype(np.float64)
    for j in range(1, k):
        best[j] += np.minimum.accumulate(best[j - 1])
    out, end = np.empty(k, np.int64), room
    for j in range(k - 1, -1, -1):
        end = int(best[j, :end].argmin()) + 1
        out[j] = j * q + end - 1
    return out


def _width(size: int, least: float) -> int:
    """The width of a cell for titles of ``2 ** size`` characters up to twice as many."""
    return max(1, 2 * _edits((3 << size) >> 1, least))


def _cells(grams: np.ndarray, size: int, length: int, place: np.ndarray) -> np.ndarray:
    cell = np.uint64((size << 56) ^ (length << 28)) ^ (place + (1 << 26)).astype(np.uint64)
    return (grams ^ (cell * np.uint64(0xD6E8FEB86659FD93))) * np.uint64(0xBF58476D1CE4E5B9)


def _asked_keys(title: str, least: float) -> np.ndarray:
    """Every run of a title with the cell of its place, for all lengths of pieces that it may meet."""
    n, found = len(title), []
    size = n.bit_length() - 1
    w = _width(size, least)
    for q in _pieces(n, least):
        g = _grams(title, q)
        found.append(_cells(g, size, (n - q) // w, (2 * np.arange(len(g)) - (n - q)) // w))
    return np.unique(np.concatenate(found))


def _known_keys(title: str, least: float, counts: np.ndarray) -> np.ndarray:
    """The rarest pieces of a title with all cells where they may stand in a title that reaches the ratio.

    A place is told by the characters before and behind it. Each of the two differs by no more than the unmatched
    characters on its side, so their sum and their difference differ by ``_edits`` at most.
    """
    n, d, q = len(title), _edits(len(title), least), _piece(len(title), least)
    g = _grams(title, q)
    start = _rarest(counts[_bucket(g, len(counts).bit_length() - 1)], q, d + 1)
    g, place, found = g[start], 2 * start - (n - q), []
    low, high = _partners(n, least)
    for size in range(low.bit_length() - 1, high.bit_length()):
        w = _width(size, least)
        first, last = (place - d) // w, (place + d) // w
        for step in range(int((last - first).max()) + 1):
            on = first + step <= last
            for length in range(max(0, n - q - d) // w, (n - q + d) // w + 1):
                found.append(_cells(g[on], size, length, first[on] + step))
    return np.unique(np.concatenate(found))


def _letters(title: str) -> list[int]:
    """How often the characters of each of sixteen groups stand in a title, a byte each, 255 at most."""
    c = np.frombuffer(title.encode(), np.uint8)
    return np.minimum(np.bincount(_GROUPS[c], minlength=16), 255).astype(np.uint8).view(np.int64).tolist()


def _letters_apart(a: Column, b: Column) -> Column:
    """The sum of the differences of two halves of ``_letters``: so many characters stand outside any matching blocks, or more."""
    count = lambda c, k: F.shiftrightunsigned(c, 8 * k).bitwiseAND(F.lit(255))
    return sum((F.abs(count(a, k) - count(b, k)) for k in range(1, 8)), F.abs(count(a, 0) - count(b, 0)))


def _title_pairs(left: DataFrame, right: DataFrame, least: float) -> DataFrame:
    """``a_t, b_t``: every pair of distinct titles whose matching-block ratio can reach ``least``.

    A character outside the blocks destroys one at most of the pieces of a right title that do not overlap, so of one piece
    more than there can be such characters, one stands whole in the left title, and near its own place. Pieces meet
    the runs of the left titles by equality of their characters and a cell of places. Which pieces are taken is chosen by the
    counts of runs in a fixed number of hash buckets. Pairs that share a piece by chance go where they meet, before
    they are shuffled, by the counts of their letters.
    """
    if 3 * least <= 2:
        raise ValueError(f"no exact filter for a ratio of {least}")

    bits = GRAM_BITS

    def counted(batches):
        for batch in batches:
            found = [_bucket(_grams(t, q), bits) for t in batch.column(0).to_pylist() for q in _pieces(len(t), least)]
            key, n = np.unique(np.concatenate([np.empty(0, np.int64), *found]), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(n)], ["bucket", "n"])

    low, high = left.agg(F.min(F.length("a_t")), F.max(F.length("a_t"))).first()
    if low is None:
        return left.join(right, F.lit(False)).select("a_t", "b_t")
    reach = (2 - least) / least
    right = right.where(F.length("b_t").between(int(low / reach), int(high * reach) + 1))  # no other length can match
    both = durable(left.select(F.col("a_t").alias("t"), F.lit(True).alias("asks")).distinct().unionByName(right.select(F.col("b_t").alias("t"), F.lit(False).alias("asks")).distinct()))
    sums = both.where("asks").select("t").mapInArrow(counted, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).toArrow()  # 1 << bits rows at most
    counts = np.zeros(1 << bits, np.int64)
    counts[sums.column("bucket").to_numpy()] = sums.column("n").to_numpy()
    held = both.sparkSession.sparkContext.broadcast(counts)

    def keys(asks):
        def run(batches):
            for batch in batches:
                titles = batch.column(0).to_pylist()
                own = [_asked_keys(t, least) if asks else _known_keys(t, least, held.value) for t in titles]
                at = pa.array(np.repeat(np.arange(len(own)), np.array([len(k) for k in own], np.int64)))
                key = np.concatenate([np.empty(0, np.uint64), *own]).view(np.int64)
                halves = np.array([_letters(t) for t in titles], np.int64).reshape(-1, 2)
                columns = [*batch.columns[1:], pa.array(halves[:, 0]), pa.array(halves[:, 1])]
                yield pa.RecordBatch.from_arrays([pa.array(key), *(c.take(at) for c in columns)], ["key", "h", "n", "c", "d"])

        return run

    keyed = both.select("t", F.xxhash64("t").alias("h"), F.length("t").alias("n"), "asks")
    # Keys are joined with the titles' hashes, lengths and letters, which are made on the way into the shuffle; the titles come back for the pairs.
    side = lambda x, asks: keyed.where(F.col("asks") == asks).drop("asks").mapInArrow(keys(asks), "key long, h long, n int, c long, d long").toDF("key", *[x + k for k in "hncd"])
    near = 2 * F.least("an", "bn") >= least * (F.col("an") + F.col("bn")) - 1e-9
    apart = _letters_apart(F.col("ac"), F.col("bc")) + _letters_apart(F.col("ad"), F.col("bd"))
    near = near & (apart <= (1 - least) * (F.col("an") + F.col("bn")) + 1e-9)
    pairs = side("a", True).join(side("b", False), "key").where(near).select("ah", "bh").distinct()
    named = both.select(F.xxhash64("t").alias("h"), "t", "asks")
    pairs = pairs.join(named.where("asks").select(F.col("h").alias("ah"), F.col("t").alias("a_t")), "ah")
    return pairs.join(named.where("not asks").select(F.col("h").alias("bh"), F.col("t").alias("b_t")), "bh").select("a_t", "b_t")


def fuzzy_match(candidates: DataFrame, records: DataFrame, least: float = 0.94) -> DataFrame:
    """``candidates`` (``cand_id``) with the best record by title similarity, year and first surname.

    Similarity is the matching-block ratio; no pair that reaches ``least`` is missed. Years may differ by 3.
    The score adds 0.03 for known years and 0.05 for known surnames; ties go to the first record. Rows that
    agree in title, year and surname are one until the end, so copies are not paired with copies.
    """
    prepare = lambda rows, authors, p: rows.withColumns({p + "t": T.title_key(F.col("title")), p + "y": T.year_of(F.col("year")), p + "s": authors})
    asked = prepare(candidates, T.surname_key(F.col("authors")), "a_")
    known = prepare(records, F.coalesce(T.first_surname(F.col("authors")), F.lit("")), "b_")
    left = durable(asked.where("a_t <> ''").select("a_t", "a_y", "a_s").distinct())
    right = durable(known.where("b_t <> ''").groupBy("b_t", "b_y", "b_s").agg(F.min("seq").alias("b_id")))
    pairs = _title_pairs(left, right, least)
    alike = durable(pairs.withColumn("_r", similarity(F.col("a_t"), F.col("b_t"))).where(F.col("_r") >= least))
    near = F.col("a_y").isNull() | F.col("b_y").isNull() | (F.abs(F.col("a_y") - F.col("b_y")) <= 3)
    near = near & ((F.col("a_s") == "") | (F.col("b_s") == "") | (F.col("a_s") == F.col("b_s")))
    bonus = F.when(F.col("a_y").isNotNull() & F.col("b_y").isNotNull(), 0.03).otherwise(0.0) + F.when((F.col("a_s") != "") & (F.col("b_s") != ""), 0.05).otherwise(0.0)
    scored = left.join(alike, "a_t").join(right, "b_t").where(near)
    best = scored.groupBy("a_t", "a_y", "a_s").agg(F.max_by("b_id", F.struct(F.col("_r") + bonus, -F.col("b_id"))).alias("record_seq"))
    best = best.toDF("_t", "_y", "_s", "record_seq")
    same = (F.col("a_t") == F.col("_t")) & F.col("a_y").eqNullSafe(F.col("_y")) & (F.col("a_s") == F.col("_s"))
    return asked.join(best, same, "left").drop("a_t", "a_y", "a_s", "_t", "_y", "_s")


def latest_publications(rows: DataFrame) -> DataFrame:
    """One row per normalized DOI; later rows overwrite earlier ones."""
    keyed = rows.select(T.doi_key(F.col("doi")).alias("doi_key"), F.struct("venue", "field").alias("p"), "seq").where("doi_key <> ''")
    return keyed.groupBy("doi_key").agg(F.max_by("p", "seq").alias("p")).select("doi_key", F.col("p.venue").alias("pub_venue"), F.col("p.field").alias("pub_field"))


def enrich(rows: DataFrame, publications: DataFrame) -> DataFrame:
    """Venue and field from publications, only where a row has none of its own; rows without a DOI are not shuffled."""
    keyed = rows.withColumn("doi_key", T.filled(T.doi_key(F.col("doi"))))
    joined = keyed.where("doi_key is not null").join(latest_publications(publications).withColumnRenamed("doi_key", "_k"), F.col("doi_key") == F.col("_k"), "left")
    venue = T.clean_space(F.col("venue"))
    open_venue = F.col("_k").isNotNull() & venue.isin("", "arXiv preprint")
    open_field = F.col("_k").isNotNull() & T.text_or_empty(F.col("field")).isin("", "Unknown") & (T.text_or_empty(F.col("pub_field")) != "")
    found = joined.withColumns(
        {
            "venue": F.when(open_venue, F.coalesce(T.filled(F.col("pub_venue")), venue)).otherwise(F.col("venue")),
            "field": F.when(open_field, F.col("pub_field")).otherwise(F.col("field")),
        }
    )
    return found.select(*rows.columns).unionByName(keyed.where("doi_key is null").select(*rows.columns))


def resolve_references(cited: DataFrame, index: DataFrame, fuzzy_records: DataFrame | None = None, most_lookups: int = 30) -> DataFrame:
    """``paper_id, ord, id, title, summary, citation_contexts`` of every cited work that resolves.

    ``cited``: ``paper_id, ord`` and the fields of a cited work. With ``fuzzy_records`` (recorded title
    lookups) unresolved usable titles are matched to them, and the matches join the index.
    """
    columns = ["paper_id", "ord", F.col("resolved_id").alias("id"), F.col("resolved_title").alias("title"), "summary", "citation_contexts"]
    found = finalize(match(cited, index)).select(*columns)
    if fuzzy_records is None:
        return found
    rest = cited.join(found.select("paper_id", "ord"), ["paper_id", "ord"], "left_anti")
    tried = title_lookups(rest, most_lookups).withColumn("cand_id", F.concat_ws("/", "paper_id", F.col("ord").cast("string")))
    extra = durable(normalized_index(fuzzy_records))
    hits = fuzzy_match(tried, extra).where("record_seq is not null")
    more = hits.join(extra.select(F.col("seq").alias("record_seq"), F.struct(*_RECORD).alias("record")), "record_seq")
    return found.unionByName(finalize(more).select(*columns))


