"""Parsing of whole documents in Arrow batches, and cited works with their contexts."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from corpusloom import schemas as S
from corpusloom.functions import quality as Q
from corpusloom.functions import text as T
from corpusloom.kernels import citing, structured
from corpusloom.session import durable, spread

from .resolution import resolve_references
from .sections import abstract_by_heading, clean_method, split_sections, union_sections

ROWS_PER_YIELD = 64


def _rows_to_batches(rows: Iterator[dict], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    held: list[dict] = []
    for row in rows:
        held.append(row)
        if len(held) == ROWS_PER_YIELD:
            yield pa.RecordBatch.from_pylist(held, schema)
            held = []
    if held:
        yield pa.RecordBatch.from_pylist(held, schema)


def _map_rows(rows: DataFrame, schema: str, one: Callable[[dict], Iterator[dict]]) -> DataFrame:
    """Each input row to any number of rows; batches stay small, so documents may be large."""
    arrow = to_arrow_schema(StructType.fromDDL(schema))
    rows = spread(rows)  # parsing is slow for its size

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pieces = (batch.slice(i, 1).to_pylist()[0] for i in range(batch.num_rows))
            yield from _rows_to_batches((out for row in pieces for out in one(row)), arrow)

    return rows.mapInArrow(run, schema)


def parse_documents(files: DataFrame, kind: str | Column = "tex") -> DataFrame:
    """``paper_id, content`` (bytes) to documents; a failure is a row with ``parse_error``.

    ``kind``: ``tex`` (bundle, gzip or plain source) or ``jats``, for all rows or by row.
    """
    column = F.lit(kind) if isinstance(kind, str) else kind

    def one(row: dict) -> Iterator[dict]:
        parser = {"tex": structured.parse_tex_bundle, "jats": structured.parse_jats}[row["kind"]]
        try:
            parsed = parser(bytes(row["content"] or b""))
            yield {"paper_id": row["paper_id"], **parsed, "sections": list(parsed["sections"].items()), "parse_error": None}
        except (ValueError, EOFError, OSError) as e:
            yield {"paper_id": row["paper_id"], "full_text": None, "sections": None, "references": None, "parse_error": str(e)}

    return _map_rows(files.select("paper_id", "content", column.alias("kind")), f"paper_id string, {S.DOCUMENT}", one)


def parse_cascade(sources: list[tuple[str, DataFrame, str]]) -> DataFrame:
    """Documents of the first source that parses: (name, files, kind) in the order of preference.

    A later source is only parsed for papers that earlier ones failed; ``errors`` keeps every failure.
    """
    done, failed = None, None
    for name, files, kind in sources:
        mine = files if done is None else files.join(done.select("paper_id"), "paper_id", "left_anti")
        parsed = durable(parse_documents(mine, kind).withColumn("source", F.lit(name)))
        good = parsed.where("parse_error is null")
        error = parsed.where("parse_error is not null").select("paper_id", F.concat(F.lit(f"{name}: "), F.col("parse_error")).alias("error"))
        done = good if done is None else done.unionByName(good)
        failed = error if failed is None else failed.unionByName(error)
    errors = failed.groupBy("paper_id").agg(F.sort_array(F.collect_list("error")).alias("errors"))
    return done.join(errors, "paper_id", "full_outer").drop("parse_error")


def cited_works(documents: DataFrame, limits: citing.Limits | None = None) -> DataFrame:
    """``paper_id`` and a row for every cited work; ``documents``: ``paper_id, full_text`` and, if known,
    ``references_text``, ``references`` (structured) and ``sections``."""
    limits = limits or citing.Limits()
    empty = {"references_text": "string", "references": f"array<{S.REFERENCE}>", "sections": "map<string,string>"}
    known = documents.select("paper_id", "full_text", *[F.col(c) if c in documents.columns else F.lit(None).cast(t).alias(c) for c, t in empty.items()])

    def one(row: dict) -> Iterator[dict]:
        for work in citing.cited_works(row["full_text"], row["references_text"], row["references"], dict(row["sections"] or ()), limits):
            yield {"paper_id": row["paper_id"], **work}

    return _map_rows(known, f"paper_id string, {_ddl_of_struct(S.CITED)}", one)


def _ddl_of_struct(struct: str) -> str:
    """``struct<a:int,...>`` as a list of columns."""
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in StructType.fromDDL(f"x {struct}")["x"].dataType)


def sentence_records(documents: DataFrame) -> DataFrame:
    """``paper_id, ord, text, start, end``: sentences with code-point offsets."""

    def one(row: dict) -> Iterator[dict]:
        for i, s in enumerate(citing.sentences(row["full_text"])):
            yield {"paper_id": row["paper_id"], "ord": i, "text": s.text, "start": s.start, "end": s.end}

    return _map_rows(documents.select("paper_id", "full_text"), "paper_id string, ord int, text string, start int, end int", one)


def bibliography_entries(documents: DataFrame) -> DataFrame:
    """``paper_id, ord`` and the fields of every entry of the references text."""

    def one(row: dict) -> Iterator[dict]:
        for i, raw in enumerate(citing.split_entries(citing.references_text(row["full_text"]))):
            if e := citing.parse_entry(raw):
                yield {"paper_id": row["paper_id"], "ord": i, "number": e.number, "id": e.identifier, "title": e.title, "raw": e.raw, "doi": e.doi, "arxiv_id": e.arxiv_id, "pmid": e.pmid, "authors": e.authors, "year": e.year}

    schema = "paper_id string, ord int, number int, id string, title string, raw string, doi string, arxiv_id string, pmid string, authors string, year string"
    return _map_rows(documents.select("paper_id", "full_text"), schema, one)


def bibtex_records(files: DataFrame) -> DataFrame:
    """``paper_id, ord`` and the entries of BibTeX texts (``content`` as a string)."""

    def one(row: dict) -> Iterator[dict]:
        for i, e in enumerate(structured.bibtex_entries(row["content"] or "")):
            yield {"paper_id": row["paper_id"], "ord": i, **e}

    schema = "paper_id string, ord int, key string, raw string, title string, authors string, year string, venue string, doi string, arxiv_id string, pmid string, url string"
    return _map_rows(files.select("paper_id", "content"), schema, one)


def marker_numbers(group: Column) -> Column:
    """Numbers of a citation marker such as ``1, 3-5``: an array, duplicates kept; ranges of at most 31."""
    parts = F.transform(F.split(group, "[,;]"), T.strip)

    def numbers(p: Column) -> Column:
        low = F.try_to_number(F.regexp_extract(p, r"^([0-9]{1,9})\s*[–—-]\s*[0-9]{1,9}$", 1), F.lit("999999999")).cast("int")
        high = F.try_to_number(F.regexp_extract(p, r"^[0-9]{1,9}\s*[–—-]\s*([0-9]{1,9})$", 1), F.lit("999999999")).cast("int")
        single = F.try_to_number(F.regexp_extract(p, r"^([0-9]{1,9})$", 1), F.lit("999999999")).cast("int")
        none = F.array().cast("array<int>")
        span = F.when((high - low).between(0, 30), F.sequence(low, F.greatest(low, high))).otherwise(none)
        return F.when(low.isNotNull(), span).when(single.isNotNull(), F.array(single)).otherwise(none)

    return F.flatten(F.transform(parts, numbers))


def section_at(starts: Column, offset: Column) -> Column:
    """As-of lookup in a sorted ``array<struct<off,name>>``: the last start at or before ``offset``."""
    return F.coalesce(F.try_element_at(F.filter(starts, lambda s: s["off"] <= offset), F.lit(-1))["name"], F.lit("unknown"))


def neighbours(rows: DataFrame, group: str, order: str, text: str, before: int = 1, after: int = 1) -> DataFrame:
    """``rows`` with ``context_before`` and ``context_after``: non-empty texts beside each row."""
    from pyspark.sql import Window

    by = Window.partitionBy(group).orderBy(order)
    kept = lambda w: F.filter(F.collect_list(text).over(w), lambda x: x != "")
    return rows.withColumns({"context_before": kept(by.rowsBetween(-before, -1)), "context_after": kept(by.rowsBetween(1, after))})


def build_outputs(documents: DataFrame, metadata: DataFrame, index: DataFrame, *, min_references: int = 1, limits: citing.Limits | None = None, fuzzy_records: DataFrame | None = None) -> DataFrame:
    """Documents (``paper_id`` and the columns of a parsed document) to output rows with ``errors``.

    ``metadata``: ``paper_id, title, abstract, field, venue, year``. Structured sections win over
    detected ones; a method that is short or contaminated becomes empty; noisy references go before
    they are counted.
    """
    detected = split_sections(F.col("full_text"))
    docs = spread(documents).withColumn("sections", union_sections(F.coalesce("sections", F.create_map().cast("map<string,string>")), detected))
    # Resolution reads the cited works for their keys and again for their rows: the kernel runs once.
    cited = durable(cited_works(docs.withColumn("references_text", F.try_element_at("sections", F.lit("references"))), limits))
    resolved = resolve_references(cited, index, fuzzy_records)
    good = resolved.where(~Q.reference_is_noisy(F.col("title"), F.col("summary")))
    grouped = good.groupBy("paper_id").agg(F.sort_array(F.collect_list(F.struct("ord", "id", "title", "summary", "citation_contexts"))).alias("_r"))
    refs = grouped.select("paper_id", F.transform("_r", lambda r: F.struct(r["id"].alias("id"), r["title"].alias("title"), r["summary"].alias("summary"), r["citation_contexts"].alias("citation_contexts"))).alias("references"))
    m = metadata.select("paper_id", *[F.col(c).alias(f"_{c}") for c in ("title", "abstract", "field", "venue", "year")])
    section = lambda name: F.try_element_at("sections", F.lit(name))
    joined = docs.drop("references").join(m, "paper_id").join(refs, "paper_id", "left")
    method = clean_method(section("method"))
    out = joined.select(
        "paper_id",
        T.clean_space(F.col("_title")).alias("title"),
        T.clean_space(T.first_filled(F.col("_abstract"), section("abstract"), abstract_by_heading(F.col("full_text")))).alias("abstract"),
        T.clean_space(section("introduction")).alias("introduction"),
        T.first_filled(T.clean_space(F.col("_field")), F.lit("Unknown")).alias("field"),
        T.first_filled(T.clean_space(F.col("_venue")), F.lit("Unknown")).alias("venue"),
        F.col("_year").cast("int").alias("year"),
        method.alias("method"),
        F.coalesce("references", F.array().cast(S.RESOLVED)).alias("references"),
    )
    bad = (F.length("method") < 200) | (F.size(Q.method_errors(F.col("method"))) > 0)
    out = out.withColumn("method", F.when(bad, "").otherwise(F.col("method")))
    return out.withColumn("errors", Q.document_errors(*[F.col(c) for c in ("title", "abstract", "introduction", "field", "venue", "method", "references")], min_references=min_references))
