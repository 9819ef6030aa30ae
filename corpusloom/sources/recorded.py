"""A Python data source over recorded JSON lines, partitioned by file, for connectors of one's own.

``spark.dataSource.register(RecordedSource)`` and ``spark.read.format("recorded").option("path", p)``.
Subclass ``RecordReader.rows`` to turn a payload into rows; the schema is an option. Paths must be
readable by ``open`` on the executors; for remote stores use the readers in ``payloads``.

A folder ``name=value`` says that every row below has that value in the column ``name``. With the option ``prune`` and
``spark.sql.python.filterPushdown.enabled`` (which Spark asks for) a condition on such a column (equal, one of, less, greater) drops the files it rules
out before any is opened; Spark applies the condition to the rows of the others all the same.
"""

from __future__ import annotations

import glob
import json
import os
import re
from collections.abc import Iterable

from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, In, InputPartition, LessThan, LessThanOrEqual
from pyspark.sql.types import StructType

from corpusloom import schemas as S


class FilePartition(InputPartition):
    def __init__(self, path: str):
        self.path = path


_TESTS = {
    EqualTo: lambda held, asked: held == asked,
    In: lambda held, asked: held in asked,
    GreaterThan: lambda held, asked: held > asked,
    GreaterThanOrEqual: lambda held, asked: held >= asked,
    LessThan: lambda held, asked: held < asked,
    LessThanOrEqual: lambda held, asked: held <= asked,
}


class RecordReader(DataSourceReader):
    def __init__(self, schema: StructType, options: dict):
        self.names, self.options, self.asked = schema.fieldNames(), options, []

    def partitions(self):
        path = self.options["path"]
        found = glob.glob(os.path.join(path, "**"), recursive=True) if os.path.isdir(path) else glob.glob(path)
        return [FilePartition(f) for f in sorted(found) if os.path.isfile(f) and self.can_hold(f)]

    def can_hold(self, path: str) -> bool:
        return True

    def rows(self, line: str):
        record = json.loads(line)
        yield tuple(record.get(n) for n in self.names)

    def read(self, partition: FilePartition):
        with open(partition.path, encoding="utf-8") as f:
            for line in f:
                if line.strip():
                    yield from self.rows(line)


class PruningReader(RecordReader):
    """Leaves files unopened that the conditions of a query rule out."""

    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:
        """Remembers what files can be told apart by; every condition is handed back, as rows are not looked at."""
        self.asked = [f for f in filters if type(f) in _TESTS and len(f.attribute) == 1 and f.value is not None]
        return filters

    def can_hold(self, path: str) -> bool:
        """Whether rows that meet the conditions can be in a file of this path."""
        told = dict(re.findall(r"([^/=]+)=([^/]*)/", os.path.relpath(path, self.options["path"]) if os.path.isdir(self.options["path"]) else path))
        for f in self.asked:
            if (held := told.get(f.attribute[0])) is None:
                continue
            asked = f.value[0] if isinstance(f, In) and f.value else f.value
            try:
                held = type(asked)(held)
            except (TypeError, ValueError):
                continue  # not comparable: Spark decides on the rows
            if not _TESTS[type(f)](held, f.value):
                return False
        return True


class RecordedSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "recorded"

    def schema(self) -> str:
        return self.options.get("schema", S.CANDIDATE)

    def reader(self, schema: StructType) -> DataSourceReader:
        pruned = self.options.get("prune", "false").lower() == "true"
        return (PruningReader if pruned else RecordReader)(schema, self.options)
