"""One file a document, written by the tasks and shown only when the whole write has succeeded.

``spark.dataSource.register(FileSink)``, then ``df.write.format("per_file").option("path", folder).mode("append").save()``
with the columns ``file`` and ``content``. A task writes its files below ``folder/_staged/<write>/<task attempt>`` and tells the
driver their names; the commit moves them into ``folder``, each by a rename, and an abort removes them. So a reader of the
folder never sees a part of a file, nor any file of a write that failed, and of attempts that ran twice only the
one that Spark has accepted counts. A file that is there already is replaced; of equal names in one write the last task's
stays. Moving is the driver's work, one rename a file. With the option ``quarantine`` names that stand there are moved out of it.
"""

from __future__ import annotations

import os
import shutil
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark import TaskContext
from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage
from pyspark.sql.types import StructType


@dataclass
class Staged(WriterCommitMessage):
    folder: str
    names: list[str]


class FileWriter(DataSourceWriter):
    def __init__(self, folder: str, quarantine: str | None):
        self.folder, self.quarantine = folder, quarantine
        self.staging = os.path.join(folder, "_staged", uuid.uuid4().hex)

    def write(self, iterator: Iterator) -> Staged:
        context = TaskContext.get()
        own = os.path.join(self.staging, f"{context.partitionId()}-{context.taskAttemptId()}")
        os.makedirs(own)
        names: dict[str, None] = {}
        for row in iterator:
            name, content = row["file"], row["content"]
            if not name or name in (".", "..") or "/" in name or name.startswith("_"):
                raise ValueError(f"not a file name: {name!r}")
            with open(os.path.join(own, name), "wb") as f:
                f.write(content.encode() if isinstance(content, str) else bytes(content or b""))
            names[name] = None
        return Staged(own, list(names))

    def commit(self, messages: list) -> None:
        for message in messages:
            for name in message.names if message else ():
                os.replace(os.path.join(message.folder, name), os.path.join(self.folder, name))
                if self.quarantine and os.path.exists(old := os.path.join(self.quarantine, name)):
                    os.remove(old)
        shutil.rmtree(self.staging, ignore_errors=True)

    def abort(self, messages: list) -> None:
        shutil.rmtree(self.staging, ignore_errors=True)


class FileSink(DataSource):
    @classmethod
    def name(cls) -> str:
        return "per_file"

    def schema(self) -> str:
        return "file string, content string"

    def writer(self, schema: StructType, overwrite: bool) -> DataSourceWriter:
        return FileWriter(self.options["path"], self.options.get("quarantine"))


def quarantine(folder: str, aside: str, names: list[str]) -> int:
    """Moves named files of ``folder`` to ``aside``, each by a rename; how many there were."""
    os.makedirs(aside, exist_ok=True)
    moved = 0
    for name in names:
        if os.path.exists(path := os.path.join(folder, name)):
            os.replace(path, os.path.join(aside, name))
            moved += 1
    return moved
