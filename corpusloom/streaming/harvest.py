"""Incremental harvest: new recorded candidates join a store once, whatever is replayed."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from corpusloom import schemas as S
from corpusloom.operators.identity import unseen_rows
from corpusloom.sources.pages import PageSource
from corpusloom.sources.payloads import oai_candidates, streamed_records, with_seq


def read_store(spark: SparkSession, path: str) -> DataFrame:
    """The store's candidates with ``seq`` and ``epoch``; a missing store is empty."""
    schema = f"seq bigint, {S.CANDIDATE}, epoch bigint"
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return spark.createDataFrame([], schema)
        raise


def merge_batch(batch: DataFrame, path: str, epoch: int, *, empty_is_key: bool = False) -> None:
    """Write the batch's rows that earlier epochs do not hold; a replayed epoch replaces itself."""
    seen = read_store(batch.sparkSession, path).where(F.col("epoch") < epoch)
    rows = with_seq(batch.select(*S.CANDIDATE_COLUMNS), "arxiv_id", "title", "doi")
    unseen_rows(seen, rows, empty_is_key=empty_is_key).write.mode("overwrite").parquet(f"{path}/epoch={epoch}")


def harvest_pages(spark: SparkSession, folder: str, sets: list[str] | None = None) -> DataFrame:
    """Candidates of a store of recorded pages as a stream whose offsets are sets and resumption tokens."""
    spark.dataSource.register(PageSource)
    options = {"path": folder} | ({"sets": ",".join(sets)} if sets else {})
    return oai_candidates(streamed_records(spark.readStream.format("harvest_pages").options(**options).load()))


def start_page_harvest(spark: SparkSession, folder: str, path: str, checkpoint: str, *, sets: list[str] | None = None, empty_is_key: bool = True, **trigger) -> StreamingQuery:
    """Follow a store of pages into the store of candidates; a run that is killed goes on at its token."""

    def merge(batch: DataFrame, epoch: int) -> None:
        merge_batch(batch, path, epoch, empty_is_key=empty_is_key)

    stream = harvest_pages(spark, folder, sets)
    return stream.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()


def start_harvest(spark: SparkSession, incoming: str, path: str, checkpoint: str, *, empty_is_key: bool = False, **trigger) -> StreamingQuery:
    """Follow a folder of candidate lines into the store; offsets and epochs live in ``checkpoint``."""
    stream = spark.readStream.schema(S.CANDIDATE).json(incoming)

    def merge(batch: DataFrame, epoch: int) -> None:
        merge_batch(batch, path, epoch, empty_is_key=empty_is_key)

    return stream.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()
