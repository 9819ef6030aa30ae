"""Session and durable tables."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import DataFrame, SparkSession

#: Whether the shuffle files of a query go when it ends, not when the driver happens to collect what refers to them.
SHUFFLES_GO = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def get_spark(app: str = "corpusloom", **config: str) -> SparkSession:
    """A session with adaptive execution; on a cluster the master and sizes come from spark-submit."""
    builder = SparkSession.builder.appName(app).config("spark.sql.adaptive.enabled", "true").config("spark.sql.session.timeZone", "UTC")
    if "SPARK_MASTER" in os.environ:
        builder = builder.master(os.environ["SPARK_MASTER"])
    for name, value in config.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share; a temporary one only where both are one process."""
    if named := spark.conf.get("spark.checkpoint.dir", None):
        return named
    master = spark.sparkContext.master
    if master != "local" and not master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return tempfile.mkdtemp(prefix="corpusloom-")


def durable(df: DataFrame) -> DataFrame:
    """Cut the lineage: write ``df`` to the shared checkpoint folder and read it from there.

    A lost executor costs nothing that is written here. What was shuffled on the way is not read again, so
    those files go at once; the session's own setting holds for everything else.
    """
    spark, context = df.sparkSession, df.sparkSession.sparkContext
    if context._jsc.sc().getCheckpointDir().isEmpty():
        context.setCheckpointDir(shared_folder(spark))
    before = spark.conf.get(SHUFFLES_GO, None)
    spark.conf.set(SHUFFLES_GO, "true")
    try:
        return df.select("*").checkpoint(eager=True)  # planned anew: the setting is read when a frame is made
    finally:
        spark.conf.unset(SHUFFLES_GO) if before is None else spark.conf.set(SHUFFLES_GO, before)


def remove_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder that this run has written, wherever Spark keeps it."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def spread(rows: DataFrame) -> DataFrame:
    """``rows`` over all cores where they are read in fewer parts than there are cores.

    A small table in one file is one task; work that is slow for its size would leave the other cores
    idle. Large inputs have splits enough and are left as they are, without a shuffle.
    """
    parallel = rows.sparkSession.sparkContext.defaultParallelism
    return rows.repartition(parallel) if rows.rdd.getNumPartitions() < parallel else rows
