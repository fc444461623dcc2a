"""Paginated REST sources as a Spark data source over recorded responses.

``spark.read.format("recorded_pages")`` reads the records of a folder as an API would give them,
page by page, one task per slice of the time range. A record is a JSON array whose first element,
or an object one of whose fields, is its time in milliseconds. Live clients can register a reader
of their own with the same options and use :func:`walk` for the paging.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator

from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

# Why paging ended.
RANGE_COVERED, SOURCE_EMPTY, CURSOR_EMPTY, PAGE_LIMIT_REACHED = "RANGE_COVERED", "SOURCE_EMPTY", "CURSOR_EMPTY", "PAGE_LIMIT_REACHED"
Page = Callable[[int, int, int, str | None], tuple[list[tuple[int, str]], str | None]]


def walk(page: Page, low: int, high: int, limit: int, mode: str = "backward", most_pages: int | None = None) -> tuple[list[tuple[int, str, int]], str]:
    """All records of the half-open range [low, high), once, in ascending order, with their page's number, and why paging ended.

    ``page(low, high, limit, cursor)`` gives records of the range and the next cursor. ``forward``
    goes on behind the last record of a page, ``backward`` before the oldest, ``cursor`` by the
    cursor. A record that comes twice counts once, where it first came; two different ones at
    one time are an error.
    """
    found: dict[int, tuple[str, int]] = {}
    number, cursor, reason = 0, None, RANGE_COVERED
    while low < high:
        if most_pages is not None and number >= most_pages:
            reason = PAGE_LIMIT_REACHED
            break
        number += 1
        got, cursor = page(low, high, limit, cursor)
        if not got:
            reason = SOURCE_EMPTY
            break
        for at, text in got:
            if found.setdefault(at, (text, number))[0] != text:
                raise ValueError(f"two different records at {at}")
        if mode == "forward":
            low = max(at for at, _ in got) + 1
        elif mode == "backward":
            high = min(at for at, _ in got)
        elif not cursor:
            reason = CURSOR_EMPTY
            break
    return sorted((at, text, n) for at, (text, n) in found.items()), reason


class _Range(InputPartition):
    def __init__(self, low: int, high: int):
        self.low, self.high = low, high


class _Reader(DataSourceReader):
    def __init__(self, options: dict):
        self.folder, self.slices, self.limit = options["path"], int(options.get("slices", "4")), int(options.get("limit", "1000"))
        self.low, self.high = int(options["start_ms"]), int(options["end_ms"])
        self.mode, self.field = options.get("mode", "backward"), options.get("time_field", "")
        self.most = int(options["max_pages"]) if "max_pages" in options else None
        if self.mode not in ("forward", "backward", "cursor"):
            raise ValueError(f"unknown mode {self.mode!r}")

    def partitions(self) -> list[_Range]:
        width = max(1, -(-(self.high - self.low) // self.slices))
        return [_Range(a, min(a + width, self.high)) for a in range(self.low, self.high, width)]

    def _records(self, low: int, high: int) -> list[tuple[int, str]]:
        """The recorded pages' records in [low, high), each page file read once a task."""
        from pyarrow import fs

        from marlstone.operators.compaction import file_system

        source, base = file_system(self.folder)
        found: dict[int, str] = {}
        for info in sorted(source.get_file_info(fs.FileSelector(base)), key=lambda i: i.path):
            if info.is_file and info.path.endswith(".json"):
                with source.open_input_stream(info.path, compression=None) as f:
                    for record in json.loads(f.read())["list"]:
                        at = int(record[self.field] if self.field else record[0])
                        text = json.dumps(record)
                        if low <= at < high and found.setdefault(at, text) != text:
                            raise ValueError(f"two different records at {at}")
        return sorted(found.items())

    def read(self, partition: _Range) -> Iterator[tuple]:
        records = self._records(partition.low, partition.high)

        def page(low: int, high: int, limit: int, cursor: str | None) -> tuple[list[tuple[int, str]], str | None]:
            inside = [r for r in records if low <= r[0] < high]
            if self.mode == "forward":
                return inside[:limit], None
            if self.mode == "backward":
                return inside[-limit:], None
            first = int(cursor or 0)
            return inside[first : first + limit], str(first + limit) if first + limit < len(inside) else None

        got, reason = walk(page, partition.low, partition.high, self.limit, self.mode, self.most)
        for at, text, number in got:
            yield at, text, number, reason


class RecordedPages(DataSource):
    """Options: path, start_ms, end_ms (exclusive), slices, limit, mode (forward, backward or cursor), time_field, max_pages. Rows: time_ms, record (JSON), page, and why the slice's paging ended."""

    @classmethod
    def name(cls) -> str:
        return "recorded_pages"

    def schema(self) -> str:
        return "time_ms bigint, record string, page bigint, ended string"

    def reader(self, schema) -> DataSourceReader:
        return _Reader(self.options)


def register(spark: SparkSession) -> None:
    spark.dataSource.register(RecordedPages)
