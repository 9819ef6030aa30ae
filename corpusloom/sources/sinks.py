"""Sinks: documents, corpora, caches, quarantine. Spark's committer makes every write all or nothing."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom import schemas as S
from corpusloom.functions import text as T

from .perfile import FileSink


def write_json(rows: DataFrame, path: str, mode: str = "overwrite") -> None:
    rows.write.mode(mode).option("ignoreNullFields", False).json(path)


def append_jsonl(rows: DataFrame, path: str) -> None:
    write_json(rows, path, "append")


def write_documents(outputs: DataFrame, path: str) -> None:
    """Valid documents to ``path/documents``, those with errors to ``path/_rejected``, a line each."""
    stem = T.output_stem(F.col("paper_id"), F.col("title"))
    rows = outputs.withColumn("file", stem)
    write_json(rows.where(F.size("errors") == 0).select("file", *S.OUTPUT_COLUMNS), f"{path}/documents")
    write_json(rows.where(F.size("errors") > 0).select("file", *S.OUTPUT_COLUMNS, "errors"), f"{path}/_rejected")


def write_files(outputs: DataFrame, path: str) -> None:
    """One JSON file a document: valid ones in ``path``, those with errors in ``path/_rejected``; a name is in one of them.

    Every write is seen whole or not at all (see ``perfile``).
    """
    outputs.sparkSession.dataSource.register(FileSink)
    name = F.concat(T.output_stem(F.col("paper_id"), F.col("title")), F.lit(".json"))
    body = lambda *c: F.to_json(F.struct(*c), {"ignoreNullFields": "false"})
    rejected = f"{path}/_rejected"
    for rows, place, more in ((outputs.where(F.size("errors") == 0), path, {"quarantine": rejected}), (outputs.where(F.size("errors") > 0), rejected, {"quarantine": path})):
        columns = S.OUTPUT_COLUMNS if place == path else [*S.OUTPUT_COLUMNS, "errors"]
        rows.select(name.alias("file"), body(*columns).alias("content")).write.format("per_file").options(path=place, **more).mode("append").save()


def corpus_rows(results: DataFrame, sections: list[str] | None = None) -> DataFrame:
    """Title, authors, year, field, venue and the (named) sections of parsed papers."""
    kept = F.col("sections") if sections is None else F.map_filter("sections", lambda k, _: k.isin(*sections))
    return results.where("sections is not null").select("title", "authors", "year", "field", "venue", kept.alias("sections"))


def export_corpus(results: DataFrame, path: str, sections: list[str] | None = None) -> None:
    write_json(corpus_rows(results, sections), path)


def result_rows(results: DataFrame) -> DataFrame:
    """Parsed results with the file name that a paper's identity gives and the time of the run."""
    paper = F.struct("title", "authors", "year", "doi", "arxiv_id", "field", "venue", "abstract", "citation_count").alias("paper")
    stamp = F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("processed_at")
    return results.where("sections is not null").select(F.concat(T.paper_hash(F.col("doi"), F.col("title")), F.lit(".json")).alias("file"), paper, "sections", stamp)


def section_texts(results: DataFrame, name: str) -> DataFrame:
    return results.where(F.map_contains_key("sections", name)).select(F.try_element_at("sections", F.lit(name)).alias("text"))


def run_summary(results: DataFrame) -> DataFrame:
    """One row: total, downloaded (or later), parsed and failed."""
    return results.agg(
        F.count("*").alias("total"),
        F.count_if(F.col("status").isin("downloaded", "done")).alias("downloaded"),
        F.count_if(F.col("status") == "done").alias("parsed"),
        F.count_if(F.col("status") == "error").alias("errors"),
    )
