"""The first and last bytes of files: what tells a whole file from a broken one, without reading what lies between.

``spark.dataSource.register(EdgeSource)``, then ``spark.read.format("file_edges").option("path", folder).load()``. A task takes
files together, as many as bring ``bytes`` of size or ``files`` of number, and reads ``head`` bytes in front and ``tail``
behind of each. Paths must be readable by ``open`` on the executors.
"""

from __future__ import annotations

import fnmatch
import os
from collections.abc import Iterator

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.types import StructType

#: Bytes of a PDF that are looked at, in front and behind. Fixed values.
HEAD, TAIL = 4, 2048


class Files(InputPartition):
    def __init__(self, paths: list[str]):
        self.paths = paths


class EdgeReader(DataSourceReader):
    def __init__(self, options: dict):
        self.folder, self.pattern = options["path"], options.get("pattern", "*")
        self.head, self.tail = int(options.get("head", HEAD)), int(options.get("tail", TAIL))
        self.bytes, self.files = int(options.get("bytes", 1 << 30)), int(options.get("files", 1000))

    def partitions(self) -> list[Files]:
        """Files in the order of their paths, packed by size and number."""
        out, held, size = [], [], 0
        for folder, below, names in os.walk(self.folder):
            below.sort()
            for name in sorted(names):
                if not fnmatch.fnmatch(name, self.pattern):
                    continue
                path = os.path.join(folder, name)
                held.append(path)
                size += os.path.getsize(path)
                if size >= self.bytes or len(held) >= self.files:
                    out.append(Files(held))
                    held, size = [], 0
        return [*out, Files(held)] if held or not out else out

    def read(self, partition: Files) -> Iterator[tuple]:
        for path in partition.paths:
            with open(path, "rb") as f:
                length = os.fstat(f.fileno()).st_size
                head = f.read(self.head)
                f.seek(max(0, length - self.tail))
                yield os.path.splitext(os.path.basename(path))[0], path, length, head, f.read(self.tail)


class EdgeSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "file_edges"

    def schema(self) -> str:
        return "paper_id string, path string, length long, head binary, tail binary"

    def reader(self, schema: StructType) -> DataSourceReader:
        return EdgeReader(self.options)


def is_pdf(head: Column, tail: Column) -> Column:
    """``%PDF`` in front and an end mark behind, as ``payloads.is_pdf`` says of whole contents."""
    return (F.hex(F.substring(head, 1, 4)) == "25504446") & F.hex(F.substring(tail, -TAIL, TAIL)).contains("2525454F46")
