"""Runs of a folder from a shell: ``python -m corpusloom run|statistics|expand FOLDER ...`` or ``spark-submit``.

The folder holds ``candidates.jsonl``; ``run`` keeps its documents and progress there (see ``operators.runs``).
"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.operators import ranking, resolution, runs
from corpusloom.session import get_spark
from corpusloom.sources import payloads
from corpusloom.sources.sinks import write_json


def _arguments(argv: list[str] | None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="corpusloom")
    commands = parser.add_subparsers(dest="command", required=True)
    run = commands.add_parser("run", help="parse, resolve and gate a shard of the candidates")
    run.add_argument("folder")
    run.add_argument("--source", action="append", required=True, metavar="NAME:KIND:PATH", help="recorded files by preference; kind is tex, jats or pdf")
    run.add_argument("--index", help="metadata records that references are resolved with; FOLDER/index.jsonl without it")
    run.add_argument("--limit", type=int, help="valid documents after which the shard stops")
    run.add_argument("--shard", type=int, default=0)
    run.add_argument("--shards", type=int, default=1)
    run.add_argument("--min-references", type=int, default=5)
    statistics = commands.add_parser("statistics", help="counts of the candidates by tier and identifier")
    statistics.add_argument("folder")
    expand = commands.add_parser("expand", help="progress of further shards from the outputs of earlier ones")
    expand.add_argument("folder")
    expand.add_argument("outputs", help="folder of documents, a line each")
    expand.add_argument("--first-shard", type=int, default=8)
    expand.add_argument("--shards", type=int, default=8)
    return parser.parse_args(argv)


def _candidates(spark: SparkSession, folder: str) -> DataFrame:
    return payloads.with_seq(payloads.read_candidates(spark, f"{folder}/candidates.jsonl"), "title", "arxiv_id", "doi")


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> list[tuple]:
    """Does what the arguments ask for and returns the few rows that it prints."""
    args, spark = _arguments(argv), spark or get_spark()
    if args.command == "run":
        sources = []
        for given in args.source:
            name, kind, path = given.split(":", 2)
            sources.append((name, payloads.read_files(spark, path).select("paper_id", "content"), kind))
        records = payloads.read_index(spark, args.index) if args.index else payloads.read_index(spark, f"{args.folder}/index.jsonl")
        index = resolution.normalized_index(payloads.with_seq(records, "title", "doi"))
        rows = runs.run_shard(spark, args.folder, sources, index, shard=args.shard, shards=args.shards, limit=args.limit, min_references=args.min_references)
    elif args.command == "statistics":
        rows = ranking.pool_statistics(_candidates(spark, args.folder))
    else:
        stems = spark.read.schema("file string").json(args.outputs).select(F.col("file").alias("stem"))
        progress = ranking.prepare_expansion(_candidates(spark, args.folder), stems, args.first_shard, args.shards)
        write_json(progress, f"{args.folder}/expansion")
        rows = spark.read.json(f"{args.folder}/expansion").groupBy("shard").agg(F.count("*").alias("n"))
    return [tuple(r) for r in rows.collect()]  # a row a source and category, a row in all, a row a shard


if __name__ == "__main__":
    for line in main(sys.argv[1:]):
        print(*line, sep="\t")
