"""A training corpus from ``documents``: quality, line dedup, near-dedup, mixing, tokens.

``STAGES`` are (name, function) pairs; each function takes (spark, docs, sf_dir). ``run`` writes every
stage as Parquet in the shared checkpoint folder and reads it again as the next stage's documents.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from corpusloom.llm import bpe, linedup, mixing, quality, simhash
from corpusloom.llm.common import read_table
from corpusloom.llm.queries import VOCABULARY
from corpusloom.session import shared_folder


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts."""
    return quality.keep_quality(docs, read_table(spark, sf_dir, "labels"))


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later copies of repeated line runs go, and documents of which nothing is left."""
    return linedup.dedup_documents(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group stays."""
    return simhash.drop_near_duplicates(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources at their target weights; a document that is taken twice is there twice."""
    return mixing.mix_documents(docs)


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, with checksums of the ids and of their decoded text."""
    return bpe.encode(docs, VOCABULARY, outputs=("n_tokens", "ids", "ids_sha256", "decoded_sha256"))


STAGES = [
    ("quality", keep_good),
    ("line_dedup", drop_lines),
    ("near_dedup", drop_near_copies),
    ("mixing", mix_sources),
    ("bpe", tokenize),
]

#: Discriminant scores, fingerprints and token ids are not expressible in SQL.
ORACLE_SQL = None


def _remove(spark: SparkSession, path: str) -> None:
    """Delete a folder that this run has written, wherever Spark keeps it."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages in order over all of ``documents``; the rows of the last one.

    A stage's folder goes once the next stage is written; that of the last stays, as the result reads it.
    """
    base = f"{shared_folder(spark).rstrip('/')}/pipeline-{uuid.uuid4().hex}"
    docs, before = read_table(spark, sf_dir, "documents"), None
    for number, (name, stage) in enumerate(STAGES):
        path = f"{base}/{number}-{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        if before:
            _remove(spark, before)
        docs, before = spark.read.parquet(path), path
    return docs
