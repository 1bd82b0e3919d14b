"""Landed pages of capped listings as a Spark data source, batch and stream."""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from urllib.parse import unquote

from pyarrow import fs
from pyspark.sql import SparkSession
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

_PAGE = re.compile(r"slice=([^/]*)/page=(\d+)\.json$")


class Pages(InputPartition):
    """Some pages of a slice, from ``first`` to ``last``."""

    def __init__(self, slice_: str, first: int, last: int):
        super().__init__((slice_, first, last))
        self.slice, self.first, self.last = slice_, first, last


class _Landed:
    """The folder ``path``/slice=<name>/page=<n>.json; a page is an envelope with ``total`` and the records."""

    def __init__(self, options: dict, schema: T.StructType):
        self.options, self.fields = dict(options), [f.name for f in schema.fields]
        self.size, self.cap, self.records = int(options.get("size", 50)), int(options.get("cap", 9999)), options.get("records", "resultados")
        self.together = int(options.get("pagesTogether", 20))

    def _open(self) -> tuple[fs.FileSystem, str]:
        return fs.FileSystem.from_uri(self.options["path"])

    def landed(self) -> dict[str, int]:
        """By slice, how many pages have landed without a gap; pages beyond the listing's cap don't count."""
        system, base = self._open()
        pages: dict[str, set[int]] = {}
        for info in system.get_file_info(fs.FileSelector(base, allow_not_found=True, recursive=True)):
            if found := _PAGE.search(info.path):
                pages.setdefault(unquote(found[1]), set()).add(int(found[2]))
        out = {}
        for name, there in pages.items():
            n = 0
            while n + 1 in there and n * self.size < self.cap:
                n += 1
            out[name] = n
        return out

    def parts(self, start: dict[str, int], end: dict[str, int]) -> list[Pages]:
        return [Pages(s, at + 1, min(at + self.together, last)) for s, last in sorted(end.items()) for at in range(start.get(s, 0), last, self.together)]

    def rows(self, part: Pages | None) -> Iterator[tuple]:
        if part is None:  # what Spark reads where there are no partitions
            return
        system, base = self._open()
        names = {unquote(found[1]): info.path for info in system.get_file_info(fs.FileSelector(base)) if (found := re.search(r"slice=([^/]*)$", info.path))}
        for page in range(part.first, part.last + 1):
            with system.open_input_stream(f"{names[part.slice]}/page={page}.json") as f:
                envelope = json.loads(f.read())
            for record in envelope.get(self.records) or []:
                held = {**record, "slice": part.slice, "page": page}
                yield tuple(held.get(n) for n in self.fields)


class _Reader(_Landed, DataSourceReader):
    def partitions(self) -> list[Pages]:
        return self.parts({}, self.landed())

    def read(self, partition: Pages) -> Iterator[tuple]:
        return self.rows(partition)


class _StreamReader(_Landed, DataSourceStreamReader):
    def initialOffset(self) -> dict:
        return {}

    def latestOffset(self) -> dict:
        return self.landed()

    def partitions(self, start: dict, end: dict) -> list[Pages]:
        return self.parts(start, end)

    def read(self, partition: Pages) -> Iterator[tuple]:
        return self.rows(partition)

    def commit(self, end: dict) -> None:
        pass  # the stream's checkpoint is the ledger


class ListingSource(DataSource):
    """``spark.read.format("landed_listing")`` or ``readStream``: the records of landed pages, with ``slice`` and ``page``.

    Options: path, size (records a page, 50), cap (records that a listing shows, 9999), records (the envelope's field,
    ``resultados``), pagesTogether (pages a task, 20). A schema must be given; fields that a record lacks are null. A
    stream's offsets are the pages read of each slice, so a stream that was stopped goes on with what has landed since;
    a page counts once all before it have landed. An empty or missing folder has no rows.
    """

    @classmethod
    def name(cls) -> str:
        return "landed_listing"

    def schema(self) -> str:
        raise ValueError("a listing's records have no schema of their own: give one")

    def reader(self, schema: T.StructType) -> DataSourceReader:
        return _Reader(self.options, schema)

    def streamReader(self, schema: T.StructType) -> DataSourceStreamReader:
        return _StreamReader(self.options, schema)


def register(spark: SparkSession) -> None:
    spark.dataSource.register(ListingSource)
