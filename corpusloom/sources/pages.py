"""A stream of recorded harvest pages whose offset is where a harvest stands: (set, resumption token).

A store of pages is a folder with a folder for each set, named by its place in the order of the harvest. The first page of a
set is ``first.xml``; the page that a resumption token asks for is named by the token's SHA-1. A page names the next
token near its end; a set without a further token is done and the next one begins. The stream hands out the records of
pages as they stand, one page a partition; ``payloads.oai_candidates`` makes candidates of them.

``spark.dataSource.register(PageSource)``, then ``spark.readStream.format("harvest_pages").option("path", folder).load()``.
Paths must be readable by ``open`` on the driver and the executors.

A harvest that waits for a page stops there and goes on when the page is recorded. Offsets only name places, so a query that
is killed and started again from its checkpoint reads every page of the chain once. A source that starts anew does not
know how far its query has come; its first offset is therefore the end of what is recorded, which no query can be behind.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Iterator, Sequence

from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition
from pyspark.sql.types import StructType

SCHEMA = "set_index int, page string, place int, record string"
#: How much of a page's end is read for its token.
TAIL = 4096
_TOKEN = re.compile(rb"<(?:\w+:)?resumptionToken[^>]*>([^<]*)</")
_RECORD = re.compile(r"<(?:\w+:)?record[\s>].*?</(?:\w+:)?record>", re.DOTALL)
_FAILED = re.compile(r"<(?:\w+:)?error[^>]*code=\"([^\"]*)\"[^>]*>([^<]*)<")


def page_name(token: str) -> str:
    """The file that holds the page of a token; the first page of a set has none."""
    return f"{hashlib.sha1(token.encode()).hexdigest()}.xml" if token else "first.xml"


def next_token(path: str) -> str:
    """The token that a page ends with; empty at the end of its set."""
    with open(path, "rb") as f:
        f.seek(max(0, os.path.getsize(path) - TAIL))
        found = _TOKEN.findall(f.read())
    return found[-1].decode().strip() if found else ""


def page_records(text: str) -> list[str]:
    """The records of a page as they stand; a page that tells of an error is one."""
    if failed := _FAILED.search(text):
        raise ValueError(f"harvest error {failed[1]}: {failed[2].strip()}")
    return _RECORD.findall(text)


class PagePartition(InputPartition):
    def __init__(self, set_index: int, path: str):
        self.set_index, self.path = set_index, path


class PageReader(DataSourceStreamReader):
    def __init__(self, folder: str, sets: list[str]):
        self.folder, self.sets, self.at = folder, sets, None

    def initialOffset(self) -> dict:
        return {"set_index": 0, "token": ""}

    def _walk(self, start: dict) -> Iterator[tuple[PagePartition, dict]]:
        """Recorded pages from an offset on, each with the offset behind it."""
        set_index, token, seen = start["set_index"], start["token"], set()
        while set_index < len(self.sets):
            path = os.path.join(self.folder, self.sets[set_index], page_name(token))
            if not os.path.exists(path):
                return
            if path in seen:
                raise ValueError(f"the token of {path} leads back to it")
            seen.add(path)
            page = PagePartition(set_index, path)
            token = next_token(path)
            set_index += not token
            yield page, {"set_index": set_index, "token": token}

    def latestOffset(self) -> dict:
        at = self.at or self.initialOffset()
        for _, at in self._walk(at):
            pass
        self.at = at
        return at

    def partitions(self, start: dict, end: dict) -> Sequence[InputPartition]:
        pages: list[InputPartition] = []
        if start == end:
            return pages
        for page, behind in self._walk(start):
            pages.append(page)
            if behind == end:
                return pages
        raise ValueError(f"pages between {start} and {end} are missing")

    def read(self, partition: PagePartition) -> Iterator[tuple]:
        with open(partition.path, encoding="utf-8") as f:
            text = f.read()
        for place, record in enumerate(page_records(text)):
            yield partition.set_index, os.path.basename(partition.path), place, record

    def commit(self, end: dict) -> None:
        """Nothing to do: the offsets of the query's checkpoint are the progress."""


class PageSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "harvest_pages"

    def schema(self) -> str:
        return SCHEMA

    def streamReader(self, schema: StructType) -> DataSourceStreamReader:
        folder = self.options["path"]
        named = self.options.get("sets")
        return PageReader(folder, named.split(",") if named else sorted(n for n in os.listdir(folder) if os.path.isdir(os.path.join(folder, n))))
