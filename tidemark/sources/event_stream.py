"""Event files as a source with offsets: a folder of JSON lines, read as a batch or as a stream.

Files land whole (written elsewhere and moved in) under names that ascend in the order they land, in the folder itself or
in folders one level down, such as one per day. An offset is the name of the last file taken, so a restart goes on after
it: nothing is lost or repeated. The driver keeps that one name, never the list; each task lists the folders
itself and takes the names that fall to it. Folders before the last committed one are not listed again.
Driver and executors must see the folder at the same path.
"""

from __future__ import annotations

import json
import os
import sys
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

FORMAT = "event_files"
SCHEMA = "id string, serial string, bad_text string, file string, line bigint"
ROWS_PER_BATCH = 10_000
ARROW = pa.schema(
    [("id", pa.string()), ("serial", pa.string()), ("bad_text", pa.string()), ("file", pa.string()), ("line", pa.int64())]
)


@dataclass
class Slice(InputPartition):
    """The files after ``after``, up to ``upto`` (None: no end), whose name falls to this one of ``parts`` slices."""

    after: str
    upto: str | None
    number: int
    parts: int


def _shown(entry: os.DirEntry) -> bool:
    return not entry.name.startswith(("_", "."))


def list_files(root: str, after: str = "", upto: str | None = None) -> Iterator[str]:
    """Names of the files after ``after`` and up to ``upto``, in no order; only folders between the two are opened."""
    try:
        top = os.scandir(root)
    except FileNotFoundError:
        return
    first, last = after.split("/")[0], None if upto is None else upto.split("/")[0]
    with top:
        for entry in filter(_shown, top):
            if entry.name < first or (last is not None and entry.name > last):
                continue
            if not entry.is_dir():
                names = [entry.name]
            else:
                names = (f"{entry.name}/{e.name}" for e in _files(entry.path))
            yield from (n for n in names if n > after and (upto is None or n <= upto))


def _files(folder: str) -> Iterator[os.DirEntry]:
    with os.scandir(folder) as inside:
        yield from (e for e in inside if _shown(e) and not e.is_dir())


def _text(value: object) -> str | None:
    return value if value is None or isinstance(value, str) else json.dumps(value, separators=(",", ":"))


def _event(line: str) -> tuple[str | None, str | None, str | None]:
    """(id, serial, None) of a line, or the line itself as ``bad_text`` if it is no JSON object."""
    try:
        found = json.loads(line)
    except (ValueError, RecursionError):
        return None, None, line
    if not isinstance(found, dict):
        return None, None, line
    return _text(found.get("id")), _text(found.get("serial")), None


def read_slice(root: str, part: Slice) -> Iterator[pa.RecordBatch]:
    rows: list[tuple] = []
    for name in list_files(root, part.after, part.upto):
        if zlib.crc32(name.encode()) % part.parts != part.number:
            continue
        with open(os.path.join(root, name), encoding="utf-8", errors="replace") as lines:
            for number, line in enumerate(lines):
                if not line.strip():
                    continue
                rows.append((*_event(line.rstrip("\r\n")), name, number))
                if len(rows) == ROWS_PER_BATCH:
                    yield _batch(rows)
                    rows = []
    if rows:
        yield _batch(rows)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), ARROW)], schema=ARROW)


class EventFiles(DataSource):
    """Options: ``path``, the folder, and ``parts``, the number of tasks that a batch is read by."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> DataSourceReader:
        return EventFileReader(self.options)

    def streamReader(self, schema) -> DataSourceStreamReader:
        return EventFileStream(self.options)


class EventFileReader(DataSourceReader):
    def __init__(self, options):
        self.root, self.parts = options["path"].removeprefix("file:"), int(options.get("parts", 8))

    def partitions(self) -> list[InputPartition]:
        return [Slice("", None, n, self.parts) for n in range(self.parts)]

    def read(self, partition: Slice) -> Iterator[pa.RecordBatch]:
        return read_slice(self.root, partition)


class EventFileStream(DataSourceStreamReader):
    def __init__(self, options):
        self.root, self.parts = options["path"].removeprefix("file:"), int(options.get("parts", 8))
        self.done = ""

    def initialOffset(self) -> dict:
        return {"file": ""}

    def latestOffset(self) -> dict:
        return {"file": max(list_files(self.root, self.done), default=self.done)}

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        # After a restart the first batch tells where to go on.
        self.done = max(self.done, start["file"])
        if start["file"] >= end["file"]:
            return []
        return [Slice(start["file"], end["file"], n, self.parts) for n in range(self.parts)]

    def commit(self, end: dict) -> None:
        self.done = max(self.done, end["file"])

    def read(self, partition: Slice) -> Iterator[pa.RecordBatch]:
        return read_slice(self.root, partition)


def register_event_files(spark: SparkSession) -> str:
    """Make the source known to the session; gives its format name. The code goes to the workers with the plan."""
    cloudpickle.register_pickle_by_value(sys.modules[__name__])
    spark.dataSource.register(EventFiles)
    return FORMAT
