"""Readers of recorded payloads: harvests, lookups, caches and files. Nothing here opens a connection.

Every reader takes a path that Spark can list (a file, a folder or a glob) and an explicit schema.
"""

from __future__ import annotations

import json

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom import schemas as S
from corpusloom.functions import text as T

_ATOM = """
id string, title string, summary string, published string, author array<struct<name:string>>,
category array<struct<_term:string>>, link array<struct<_href:string,_title:string>>,
primary_category struct<_term:string>, doi string, journal_ref string, comment string
"""
_OAI = """
header struct<_status:string>,
metadata struct<arXiv:struct<id:string,title:string,authors:struct<author:array<struct<keyname:string,forenames:string>>>,
categories:string,`journal-ref`:string,comments:string,created:string,doi:string,abstract:string>>
"""
_PUBMED = """
MedlineCitation struct<PMID:struct<_VALUE:string>,Article:struct<ArticleTitle:string,Abstract:struct<AbstractText:array<struct<_VALUE:string>>>>>,
PubmedData struct<ArticleIdList:struct<ArticleId:array<struct<_VALUE:string,_IdType:string>>>>
"""
_CROSSREF = """
message struct<title:array<string>,abstract:string,DOI:string,`container-title`:array<string>,publisher:string,subject:array<string>,
author:array<struct<given:string,family:string>>,issued:struct<`date-parts`:array<array<int>>>>
"""
_PAPER = "array<struct<title:string,abstract:string,year:string,authors:array<struct<name:string>>,externalIds:struct<ArXiv:string,DOI:string,PubMed:string>>>"


_XML = {"ignoreNamespace": "true", "attributePrefix": "_", "valueTag": "_VALUE", "mode": "PERMISSIVE"}


def _xml(spark: SparkSession, path: str, row: str, schema: str) -> DataFrame:
    return spark.read.format("xml").options(rowTag=row, **_XML).schema(schema).load(path)


def with_seq(rows: DataFrame, *order: str) -> DataFrame:
    """``rows`` with ``seq`` from 0 in the given total order, dealt by range."""
    from corpusloom.operators.ranking import global_rank

    return global_rank(rows, [F.col(c) for c in order], "seq").withColumn("seq", F.col("seq") - 1)


def read_atom(spark: SparkSession, path: str) -> DataFrame:
    """Entries of recorded Atom feeds as candidates."""
    e = _xml(spark, path, "entry", _ATOM)
    url = T.clean_space(F.col("id"))
    short = F.substring_index(F.regexp_replace(url, "/+$", ""), "/", -1)
    terms = F.filter(F.transform(F.coalesce("category", F.array().cast("array<struct<_term:string>>")), lambda c: c["_term"]), lambda t: T.text_or_empty(t) != "")
    primary = F.when(F.col("primary_category").isNotNull(), T.text_or_empty(F.col("primary_category._term"))).otherwise(F.coalesce(F.get(terms, F.lit(0)), F.lit("")))
    keywords = F.when(F.col("_primary") != "", F.array_distinct(F.concat(F.array("_primary"), "_terms"))).otherwise(F.array_distinct("_terms"))
    pdf = F.get(F.filter("link", lambda x: x["_title"] == "pdf"), F.lit(0))["_href"]
    names = F.filter(F.transform(F.coalesce("author", F.array().cast("array<struct<name:string>>")), lambda a: T.clean_space(a["name"])), lambda n: n != "")
    e = e.withColumns({"_url": url, "_short": short, "_terms": terms}).withColumn("_primary", primary)
    return e.select(
        T.clean_space(F.col("title")).alias("title"),
        names.alias("authors"),
        T.leading_year(T.clean_space(F.col("published"))).alias("year"),
        T.filled(T.clean_space(F.col("doi"))).alias("doi"),
        F.lit(None).cast("string").alias("pmid"),
        F.lit(None).cast("string").alias("pmcid"),
        F.col("_short").alias("arxiv_id"),
        T.category_field(F.col("_primary"), T.category_label(F.col("_primary"))).alias("field"),
        T.first_filled(T.clean_space(F.col("journal_ref")), T.comment_venue(T.clean_space(F.col("comment"))), F.lit("arXiv preprint")).alias("venue"),
        T.clean_space(F.col("summary")).alias("abstract"),
        F.col("_url").alias("url"),
        F.lit(None).cast("string").alias("publisher_url"),
        F.coalesce(pdf, F.concat(F.lit("https://arxiv.org/pdf/"), F.col("_short"))).alias("pdf_url"),
        F.lit("arxiv").alias("source"),
        keywords.alias("keywords"),
        F.lit(None).cast("int").alias("citation_count"),
    )


def read_oai(spark: SparkSession, path: str) -> DataFrame:
    """Harvested records as candidates; deleted ones and those without id or title are left out."""
    return oai_candidates(_xml(spark, path, "record", _OAI))


def streamed_records(pages: DataFrame) -> DataFrame:
    """``header, metadata`` of the records that a stream of pages hands out (see ``pages``)."""
    return pages.select(F.from_xml("record", _OAI, _XML).alias("r")).select("r.*")


def oai_candidates(records: DataFrame) -> DataFrame:
    """Candidates of harvested records (``header, metadata``); also of a stream."""
    r = records.where(F.col("header").isNotNull() & ~F.col("header._status").eqNullSafe("deleted") & F.col("metadata.arXiv").isNotNull())
    a = r.select("metadata.arXiv.*")
    ident, title = T.clean_space(F.col("id")), T.clean_space(F.col("title"))
    people = F.coalesce("authors.author", F.array().cast("array<struct<keyname:string,forenames:string>>"))
    names = F.filter(F.transform(people, lambda p: F.concat_ws(" ", T.filled(T.clean_space(p["forenames"])), T.filled(T.clean_space(p["keyname"])))), lambda n: n != "")
    cats = F.filter(F.split(T.clean_space(F.col("categories")), " "), lambda c: c != "")
    primary = F.coalesce(F.get("_cats", F.lit(0)), F.lit(""))
    a = a.withColumns({"_id": ident, "_title": title, "_cats": cats}).withColumn("_primary", primary).where("_id <> '' and _title <> ''")
    return a.select(
        F.col("_title").alias("title"),
        names.alias("authors"),
        T.filled(F.regexp_extract(T.text_or_empty(F.col("created")), r"((?:19|20)\d{2})", 1)).cast("int").alias("year"),
        T.filled(T.clean_space(F.col("doi"))).alias("doi"),
        F.lit(None).cast("string").alias("pmid"),
        F.lit(None).cast("string").alias("pmcid"),
        F.col("_id").alias("arxiv_id"),
        T.category_field(F.col("_primary"), T.category_label(F.col("_primary"))).alias("field"),
        T.first_filled(T.clean_space(F.col("`journal-ref`")), T.comment_venue(T.clean_space(F.col("comments"))), F.lit("arXiv preprint")).alias("venue"),
        T.clean_space(F.col("abstract")).alias("abstract"),
        F.concat(F.lit("https://arxiv.org/abs/"), F.col("_id")).alias("url"),
        F.lit(None).cast("string").alias("publisher_url"),
        F.concat(F.lit("https://arxiv.org/pdf/"), F.col("_id")).alias("pdf_url"),
        F.lit("arxiv").alias("source"),
        F.col("_cats").alias("keywords"),
        F.lit(0).alias("citation_count"),
    )


def resumption_tokens(spark: SparkSession, path: str) -> DataFrame:
    """``token`` of every recorded harvest page that names a next one."""
    pages = spark.read.text(path, wholetext=True)
    return pages.select(T.strip(F.regexp_extract("value", r"<resumptionToken[^>]*>([^<]*)<", 1)).alias("token")).where("token <> ''")


def atom_records(spark: SparkSession, path: str) -> DataFrame:
    """Recorded lookups by archive id as index records."""
    return read_atom(spark, path).select("title", "abstract", "arxiv_id", F.lit(None).cast("string").alias("doi"), F.lit(None).cast("string").alias("pmid"), "authors", F.col("year").cast("string").alias("year"))


def pubmed_records(spark: SparkSession, path: str) -> DataFrame:
    """Recorded PubMed articles as index records; of several DOIs the last counts."""
    m = _xml(spark, path, "PubmedArticle", _PUBMED)
    dois = F.filter("PubmedData.ArticleIdList.ArticleId", lambda i: i["_IdType"] == "doi")
    abstract = F.array_join(F.transform("MedlineCitation.Article.Abstract.AbstractText", lambda x: x["_VALUE"]), " ")
    return m.select(
        F.col("MedlineCitation.Article.ArticleTitle").alias("title"),
        abstract.alias("abstract"),
        F.lit(None).cast("string").alias("arxiv_id"),
        F.try_element_at(dois, F.lit(-1))["_VALUE"].alias("doi"),
        F.col("MedlineCitation.PMID._VALUE").alias("pmid"),
        F.array().cast("array<string>").alias("authors"),
        F.lit(None).cast("string").alias("year"),
    )


def _crossref(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(_CROSSREF).json(path).where("message is not null").select("message.*")


def crossref_records(spark: SparkSession, path: str) -> DataFrame:
    """Recorded works (one JSON answer a line) as index records."""
    return _crossref(spark, path).select(
        F.get("title", F.lit(0)).alias("title"),
        "abstract",
        F.lit(None).cast("string").alias("arxiv_id"),
        F.col("DOI").alias("doi"),
        F.lit(None).cast("string").alias("pmid"),
        F.transform(F.coalesce("author", F.array().cast("array<struct<given:string,family:string>>")), lambda a: F.concat_ws(" ", a["given"], a["family"])).alias("authors"),
        F.get(F.get("issued.date-parts", F.lit(0)), F.lit(0)).cast("string").alias("year"),
    )


def crossref_publications(spark: SparkSession, path: str) -> DataFrame:
    """``doi, venue, field`` of recorded works: first container or publisher, first subject."""
    c = _crossref(spark, path)
    venue = F.when(F.size("container-title") > 0, F.get("container-title", F.lit(0))).otherwise(F.col("publisher"))
    return c.select(T.doi_key(F.col("DOI")).alias("doi"), T.filled(T.clean_space(venue)).alias("venue"), T.filled(T.clean_space(F.get("subject", F.lit(0)))).alias("field"))


def paper_records(spark: SparkSession, path: str) -> DataFrame:
    """Recorded answers of batch paper lookups (JSON arrays that may hold nulls) as index records."""
    answers = spark.read.text(path, wholetext=True)  # one answer of at most 500 papers a file
    p = answers.select(F.explode(F.from_json("value", _PAPER)).alias("p")).where("p is not null").select("p.*")
    names = F.transform(F.coalesce("authors", F.array().cast("array<struct<name:string>>")), lambda a: T.text_or_empty(a["name"]))
    return p.select("title", "abstract", F.col("externalIds.ArXiv").alias("arxiv_id"), F.col("externalIds.DOI").alias("doi"), F.col("externalIds.PubMed").alias("pmid"), names.alias("authors"), "year")


def _or_empty(spark: SparkSession, schema: str, read) -> DataFrame:
    try:
        return read()
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return spark.createDataFrame([], schema)
        raise


def read_candidates(spark: SparkSession, path: str) -> DataFrame:
    """A candidate cache (a JSON array or a line each); a missing one is empty."""
    return _or_empty(spark, S.CANDIDATE, lambda: spark.read.schema(S.CANDIDATE).option("multiLine", not path.endswith(".jsonl")).json(path))


def read_progress(spark: SparkSession, path: str) -> DataFrame:
    """Run state with defaults for what is missing."""
    p = _or_empty(spark, S.PROGRESS, lambda: spark.read.schema(S.PROGRESS).option("multiLine", True).json(path))
    empty = F.array().cast("array<string>")
    return p.withColumns({"searches_done": F.coalesce("searches_done", empty), "processed_ids": F.coalesce("processed_ids", empty), "papers_processed": F.coalesce("papers_processed", F.lit(0)), "total_collected": F.coalesce("total_collected", F.lit(0))})


def read_processed(spark: SparkSession, path: str) -> DataFrame:
    """The ids that runs of a folder have tried; none before the first run."""
    return _or_empty(spark, S.PROCESSED, lambda: spark.read.schema(S.PROCESSED).parquet(path))


def read_index(spark: SparkSession, path: str) -> DataFrame:
    """Metadata records: ``.jsonl`` lines, a JSON array, or a JSON object whose values are records.

    A file that is missing is empty; one that does not parse is dropped whole.
    """
    if path.endswith(".jsonl"):
        return _or_empty(spark, S.INDEX, lambda: spark.read.schema(S.INDEX).option("mode", "DROPMALFORMED").json(path))
    text = _or_empty(spark, "value string", lambda: spark.read.text(path, wholetext=True))
    record = f"struct<{', '.join(c.replace(' ', ':', 1) for c in S.INDEX.split(', '))}>"
    listed = F.from_json("value", f"array<{record}>")
    named = F.map_values(F.from_json("value", f"map<string,{record}>"))
    values = F.when(F.ltrim("value").startswith("["), listed).otherwise(named)
    return text.select(F.explode(values).alias("r")).where("r is not null").select("r.*")


def read_config(path: str) -> dict:
    """A YAML or JSON configuration on the driver; YAML needs the optional ``yaml`` module."""
    with open(path, encoding="utf-8") as f:
        if path.endswith(".json"):
            return json.load(f)
        try:
            import yaml
        except ImportError as e:
            raise RuntimeError("reading YAML needs PyYAML") from e
        return yaml.safe_load(f)


def read_files(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """``paper_id`` (the file's stem), ``path``, ``content`` of binary files."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", True).load(path)
    name = F.substring_index(F.regexp_replace("path", "/+$", ""), "/", -1)
    return files.select(F.regexp_replace(name, r"\.[^.]*$", "").alias("paper_id"), "path", "length", "content")


def is_pdf(content: Column) -> Column:
    """``%PDF`` in front and an end mark in the last 2048 bytes."""
    tail = F.substring(content, -2048, 2048)
    return (F.hex(F.substring(content, 1, 4)) == "25504446") & F.hex(tail).contains("2525454F46")


def is_source(content: Column, prefix: bytes | None = None) -> Column:
    """At least 100 bytes, no HTML page, and the expected prefix."""
    head = F.lower(F.ltrim(F.decode(F.substring(content, 1, 200), "ISO-8859-1")))
    ok = (F.octet_length(content) >= 100) & ~head.startswith("<!doctype html") & ~head.startswith("<html")
    return ok & (F.hex(F.substring(content, 1, len(prefix))) == prefix.hex().upper()) if prefix else ok


def existing_ids(spark: SparkSession, path: str) -> DataFrame:
    """``archive_id`` of the outputs in a folder, from their stems."""
    return read_files(spark, path, "*.json").select(T.stem_id(F.col("paper_id")).alias("archive_id")).distinct()


def source_file(arxiv_id: Column) -> Column:
    """Name of the recorded TeX source of an id."""
    return F.concat(F.lit("arxiv_"), F.substring(F.sha1(arxiv_id), 1, 16), F.lit(".src"))


def id_variants(arxiv_id: Column) -> Column:
    """The id as it stands, then without its version."""
    return F.array_distinct(F.array(arxiv_id, F.regexp_replace(arxiv_id, r"(?i)v\d+$", "")))


def with_pmcid(rows: DataFrame, id_map: DataFrame) -> DataFrame:
    """``pmcid`` from its own column, else by PMID from ``id_map`` (``pmid, pmcid``)."""
    known = id_map.select(T.pmid_key(F.col("pmid")).alias("_p"), T.pmcid(F.col("pmcid")).alias("_c")).where("_p <> '' and _c is not null").dropDuplicates(["_p"])
    return rows.join(known, T.pmid_key(F.col("pmid")) == F.col("_p"), "left").withColumn("pmcid", F.coalesce(T.pmcid(F.col("pmcid")), "_c")).drop("_p", "_c")


def pdf_link(html: Column) -> Column:
    """The first PDF address of a page: of a frame, an embed, a button, then any link; null without one."""
    ladder = (
        r"""(?is)<iframe[^>]+src\s*=\s*["']([^"']+\.pdf[^"']*)["']""",
        r"""(?is)<embed[^>]+src\s*=\s*["']([^"']+\.pdf[^"']*)["']""",
        r"""(?is)onclick\s*=\s*["'][^"']*location\.href\s*=\s*\\?['"]([^'"\\]+\.pdf[^'"\\]*)""",
        r"""(?is)href\s*=\s*["']([^"']+\.pdf[^"']*)["']""",
    )
    return T.first_filled(*[F.regexp_extract(T.text_or_empty(html), p, 1) for p in ladder])


def search_filter(rows: DataFrame, year_from: int | None = None, year_to: int | None = None) -> DataFrame:
    """Rows of the years asked for; with a bound, a row without a year goes."""
    if year_from is not None:
        rows = rows.where(F.col("year") >= year_from)
    return rows if year_to is None else rows.where(F.col("year") <= year_to)


def search_query(query: str, categories: list[str] | None = None) -> str:
    cats = " OR ".join(f"cat:{c}" for c in categories or ())
    return f"({query}) AND ({cats})" if cats else query


def venue_query(venue: str, year: int | None = None) -> str:
    return f'"{venue}" AND {year}' if year else f'"{venue}"'


