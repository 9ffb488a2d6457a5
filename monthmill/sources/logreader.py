"""Log records as a data source of Spark: files are read once, in byte ranges, and cut where records begin.

``spark.dataSource.register(LogRecords)``, then ``spark.read`` or
``spark.readStream`` with format ``log_records``. ``log_records`` and
``arriving_records`` do both.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

# Fixed value: a line that begins with its time in square brackets opens a record.
OPENING = rb"\n\[2\d{3}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}"
#: Bytes of an opening with the line end before it.
OPENING_BYTES = 21
#: Bytes read at a time, bytes of records sent on at a time, and bytes of files per task.
BLOCK = 4 << 20
SENT = 4 << 20
SPLIT = 64 << 20
#: Seconds by which a file may be older than the newest and still be taken by a stream that has not seen it.
GRACE = 3600
#: Schemes of paths that can be opened here; files elsewhere are read by Spark's own text source.
SCHEMES = {"": "", "file": "file", "hdfs": "hdfs", "s3": "s3", "s3a": "s3", "gs": "gs", "abfs": "abfs", "abfss": "abfss"}
SHAPE = "file string, start long, record string"


def opened(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path and the path in it."""
    scheme, mark, rest = path.partition(":")
    if mark and "/" not in scheme:
        return fs.FileSystem.from_uri(f"{SCHEMES[scheme]}:{rest}" if rest.startswith("//") else f"{SCHEMES[scheme]}://{rest}")
    return fs.LocalFileSystem(), path


def can_open(path: str) -> bool:
    scheme, mark, _ = path.partition(":")
    return not mark or "/" in scheme or scheme in SCHEMES


def records(file, start: int, stop: int) -> Iterator[tuple[int, bytes]]:
    """(place, record) of the records of an open file whose first byte lies in [start, stop).

    The reader begins one byte early, to see whether a line begins at
    ``start``, and goes on behind ``stop`` up to the end of its last record.
    Lines before the first record of a file are records of their own. Only one
    record and one block are held.
    """
    held, base = (b"\n", -1) if start == 0 else (b"", start - 1)
    file.seek(max(start - 1, 0))
    begun: int | None = None  # where in ``held`` the present record begins
    leading, searched = start == 0, 0
    while True:
        block = file.read(BLOCK)
        held += block
        for match in re.compile(OPENING).finditer(held, searched):
            at = match.start()
            if begun is not None:
                yield base + begun, held[begun:at].rstrip(b"\n")
            elif leading:
                yield from _lines(held[1:at], base + 1)
            begun, leading = None, False
            if base + at + 1 >= stop:
                return
            begun = at + 1
            searched = at + 1
        if not block:
            break
        if begun is None and not leading and base + len(held) - OPENING_BYTES >= stop:
            return
        # An opening may be cut by the end of the block.
        searched = max(searched, len(held) - OPENING_BYTES + 1, 0)
        gone = begun if begun is not None else 0 if leading else searched
        if gone:
            held, base, searched = held[gone:], base + gone, searched - gone
            begun = None if begun is None else 0
    if begun is not None:
        yield base + begun, held[begun:].rstrip(b"\n")
    elif leading:
        yield from _lines(held[1:], base + 1)


def _lines(text: bytes, at: int) -> Iterator[tuple[int, bytes]]:
    for line in text.split(b"\n"):
        if line:
            yield at, line
        at += len(line) + 1


@dataclass
class Ranges(InputPartition):
    """Byte ranges of files, read by one task."""

    parts: list[tuple[str, int, int]]


def planned(files: list[tuple[str, int]], split: int) -> list[Ranges]:
    """Large files are cut into ranges of ``split`` bytes, small ones share a task."""
    out: list[Ranges] = []
    room = 0
    for path, size in files:
        for start in range(0, size, split):
            part = (path, start, min(start + split, size))
            if part[2] - part[1] > room:
                out.append(Ranges([]))
                room = split
            out[-1].parts.append(part)
            room -= part[2] - part[1]
    return out


class _Files:
    """What the batch and the stream reader share."""

    def __init__(self, options: dict):
        self.path = options["path"]
        self.split = int(options.get("split", SPLIT))

    def listed(self) -> list[fs.FileInfo]:
        """All files below the path, without hidden and empty ones."""
        system, path = opened(self.path)
        info = system.get_file_info(path)
        if info.type == fs.FileType.NotFound:
            raise FileNotFoundError(self.path)
        found = [info] if info.is_file else system.get_file_info(fs.FileSelector(path, recursive=True))
        inner = lambda f: f.path[len(path) :] if not info.is_file else ""
        return sorted((f for f in found if f.is_file and f.size and not re.search(r"(^|/)[._]", inner(f))), key=lambda f: f.path)

    def read(self, partition: Ranges) -> Iterator[pa.RecordBatch]:
        system, _ = opened(self.path)
        rows: list[tuple[str, int, str]] = []
        size = 0
        for path, start, stop in partition.parts:
            with system.open_input_file(path) as file:
                for at, record in records(file, start, stop):
                    rows.append((path, at, record.decode("utf-8", "replace")))
                    size += len(record) + 100
                    if size > SENT:
                        yield _batch(rows)
                        rows, size = [], 0
        if rows:
            yield _batch(rows)


def _batch(rows: list[tuple[str, int, str]]) -> pa.RecordBatch:
    files, starts, texts = zip(*rows)
    return pa.RecordBatch.from_arrays([pa.array(files), pa.array(starts, pa.int64()), pa.array(texts, pa.string())], ["file", "start", "record"])


class _Reader(_Files, DataSourceReader):
    def partitions(self) -> list[Ranges]:
        return planned([(f.path, f.size) for f in self.listed()], self.split)


class _StreamReader(_Files, DataSourceStreamReader):
    """Takes files as a whole once they are there, by their time of modification.

    The offset holds the newest time and the files within ``grace`` seconds of
    it, not all files ever seen.
    """

    def __init__(self, options: dict):
        super().__init__(options)
        self.grace = int(float(options.get("grace", GRACE)) * 1e9)

    def initialOffset(self) -> dict:
        return {"newest": 0, "seen": []}

    def latestOffset(self) -> dict:
        files = self.listed()
        newest = max((f.mtime_ns for f in files), default=0)
        return {"newest": newest, "seen": [f.path for f in files if f.mtime_ns >= newest - self.grace]}

    def partitions(self, start: dict, end: dict) -> list[Ranges]:
        """The files of a batch: not seen at its start, and there at its end."""
        before, seen, there = start["newest"] - self.grace, set(start["seen"]), set(end["seen"])
        late = end["newest"] - self.grace
        new = [f for f in self.listed() if f.path not in seen and f.mtime_ns >= before and f.mtime_ns <= end["newest"]]
        return planned([(f.path, f.size) for f in new if f.path in there or f.mtime_ns < late], self.split)

    def commit(self, end: dict) -> None:
        """Nothing is kept outside the stream's checkpoint."""


class LogRecords(DataSource):
    """Format ``log_records``: ``file, start, record``; options path, split (bytes), grace (seconds)."""

    @classmethod
    def name(cls) -> str:
        return "log_records"

    def schema(self) -> str:
        return SHAPE

    def reader(self, schema) -> DataSourceReader:
        return _Reader(dict(self.options))

    def streamReader(self, schema) -> DataSourceStreamReader:
        return _StreamReader(dict(self.options))


def _bytes(size: str) -> int:
    """A size such as 128m or 134217728b."""
    number, unit = re.fullmatch(r"(\d+)\s*([kmgt]?)b?", size.strip().lower()).groups()
    return int(number) << {"": 0, "k": 10, "m": 20, "g": 30, "t": 40}[unit]


def log_records(spark: SparkSession, path: str) -> DataFrame:
    """Whole records of all log files below ``path``: ``file, start, record``, every file read once."""
    spark.dataSource.register(LogRecords)
    split = min(SPLIT, _bytes(spark.conf.get("spark.sql.files.maxPartitionBytes")))
    return spark.read.format("log_records").option("split", split).load(path)


def arriving_records(spark: SparkSession, path: str, grace: float = GRACE) -> DataFrame:
    """A stream of the records of log files as they arrive: ``file, start, record``. Files are complete when they appear."""
    spark.dataSource.register(LogRecords)
    return spark.readStream.format("log_records").option("grace", str(grace)).load(path)
