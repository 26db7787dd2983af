"""``growing_lines``: follow text files that are still being written.

A streaming Python data source over the files of a folder. An offset holds, for every
file, the byte behind the last complete line that was handed out and a check sum of the
file's first bytes. A micro-batch is the bytes between two such offsets, cut into byte
ranges that tasks read by themselves; an unfinished last line waits for its line feed. A
file that got shorter, or begins with other bytes than before, was replaced and is read from
its start. Spark keeps the offsets in the query's checkpoint, so a restart goes on where
the last batch ended. Read as a batch (``spark.read``), the same lines come once, an
unfinished last line included.

Folders may be POSIX paths or any URI that ``pyarrow.fs`` opens (HDFS, object stores).
Options: ``path``; ``suffixes`` (comma-separated, default ``.jsonl,.json``); ``splitBytes``
(largest range of a task, default 16 MB).
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

from quire.sources.metrics import LINE_SCHEMA, METRIC_SCHEMA, normalize_log, run_key

SCHEMA = "path string, position long, value string"
HEAD, BLOCK, ROWS = 64, 1 << 16, 4096


@dataclass
class Range(InputPartition):
    """Lines that begin in ``[start, stop)`` of a file; ``origin`` is where the batch begins."""

    path: str
    origin: int
    start: int
    stop: int


class Files:
    """The files of a folder and what an offset says of them."""

    def __init__(self, options: dict):
        where = options["path"]
        self.fs, self.root = pafs.FileSystem.from_uri(where) if "://" in where else (pafs.LocalFileSystem(), where.removeprefix("file:"))
        self.suffixes = tuple(s for s in options.get("suffixes", ".jsonl,.json").split(",") if s)
        self.split = int(options.get("splitBytes", 16 << 20))

    def sizes(self) -> dict[str, int]:
        found = self.fs.get_file_info(pafs.FileSelector(self.root, recursive=True, allow_not_found=True))
        hidden = lambda p: any(x.startswith(("_", ".")) for x in p[len(self.root) :].strip("/").split("/"))
        return {f.path: f.size for f in found if f.type == pafs.FileType.File and f.path.endswith(self.suffixes) and not hidden(f.path)}

    def read(self, path: str, start: int, stop: int) -> bytes:
        with self.fs.open_input_file(path) as f:
            return f.read_at(stop - start, start) if stop > start else b""

    def last_line(self, path: str, least: int, size: int) -> int:
        """The place behind the last line feed at or after ``least``, else ``least``."""
        stop = size
        while stop > least:
            start = max(least, stop - BLOCK)
            at = self.read(path, start, stop).rfind(b"\n")
            if at >= 0:
                return start + at + 1
            stop = start
        return least

    def head(self, path: str, pos: int) -> int:
        return zlib.crc32(self.read(path, 0, min(HEAD, pos)))

    def same(self, path: str, seen: dict, size: int) -> bool:
        return size >= seen["pos"] and self.head(path, seen["pos"]) == seen["head"]

    def offset(self, before: dict) -> dict:
        """Where every file's complete lines end now; ``before`` saves reading them again."""
        out = {}
        for path, size in sorted(self.sizes().items()):
            seen = before.get(path)
            least = seen["pos"] if seen and self.same(path, seen, size) else 0
            pos = self.last_line(path, least, size)
            if pos:
                out[path] = {"pos": pos, "head": self.head(path, pos)}
        return out

    def ranges(self, path: str, start: int, stop: int) -> list[Range]:
        return [Range(path, start, at, min(stop, at + self.split)) for at in range(start, stop, self.split)]

    def lines(self, part: Range) -> Iterator[pa.RecordBatch]:
        """Lines that begin inside the range, read in blocks; one that begins in a range before
        belongs there."""
        rows: list[tuple[int, bytes]] = []
        with self.fs.open_input_file(part.path) as f:
            size = f.size()
            at, skip = (part.start, False) if part.start == part.origin else (part.start - 1, True)
            begin, kept = at, b""
            while begin < part.stop or kept:
                block = f.read_at(min(BLOCK, size - at), at) if at < size else b""
                at += len(block)
                kept += block
                while (end := kept.find(b"\n")) >= 0 or (not block and kept):
                    end = end if end >= 0 else len(kept)
                    if not skip and begin < part.stop and kept[:end].strip():
                        rows.append((begin, kept[:end]))
                    skip, begin, kept = False, begin + end + 1, kept[end + 1 :]
                    if begin >= part.stop:
                        break
                if len(rows) >= ROWS:
                    yield self._batch(part.path, rows)
                    rows = []
                if begin >= part.stop or not block:
                    break
        if rows:
            yield self._batch(part.path, rows)

    @staticmethod
    def _batch(path: str, rows: list[tuple[int, bytes]]) -> pa.RecordBatch:
        text = pa.array([v.decode("utf-8", "replace").rstrip("\r") for _, v in rows], pa.string())
        return pa.RecordBatch.from_arrays([pa.array([path] * len(rows), pa.string()), pa.array([p for p, _ in rows], pa.int64()), text], names=["path", "position", "value"])


class GrowingStream(DataSourceStreamReader):
    def __init__(self, options: dict):
        self.files, self.seen = Files(options), {}

    def initialOffset(self) -> dict:
        return {}

    def latestOffset(self) -> dict:
        return self.files.offset(self.seen)

    def partitions(self, start: dict, end: dict) -> list[Range]:
        out = []
        for path, now in end.items():
            seen = start.get(path)
            begin = seen["pos"] if seen and self.files.same(path, seen, now["pos"]) else 0
            out += self.files.ranges(path, begin, now["pos"])
        self.seen = end
        return out

    def read(self, partition: Range) -> Iterator[pa.RecordBatch]:
        return self.files.lines(partition)

    def commit(self, end: dict) -> None:
        self.seen = end


class GrowingBatch(DataSourceReader):
    def __init__(self, options: dict):
        self.files = Files(options)

    def partitions(self) -> list[Range]:
        return [r for path, size in sorted(self.files.sizes().items()) for r in self.files.ranges(path, 0, size)]

    def read(self, partition: Range | None) -> Iterator[pa.RecordBatch]:
        return self.files.lines(partition) if partition else iter(())


class GrowingLines(DataSource):
    @classmethod
    def name(cls) -> str:
        return "growing_lines"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> GrowingBatch:
        return GrowingBatch(dict(self.options))

    def streamReader(self, schema) -> GrowingStream:
        return GrowingStream(dict(self.options))


def parsed_metrics(lines: DataFrame) -> DataFrame:
    """``growing_lines`` rows → metric log rows; a line that isn't JSON gives nulls, as in
    ``read_metrics``."""
    row = F.from_json("value", LINE_SCHEMA, {"allowNonNumericNumbers": "true", "mode": "PERMISSIVE"})
    fields = [F.col("r").getField(f.name).alias(f.name) for f in METRIC_SCHEMA.fields]
    run = run_key(F.col("r").getField("run_id"), F.col("path")).alias("run_id")
    return normalize_log(lines.select(row.alias("r"), "path").select(*fields, run))


def read_growing_metrics_stream(spark: SparkSession, path: str, split_bytes: int = 16 << 20) -> DataFrame:
    """A stream over metric logs that grow in place."""
    spark.dataSource.register(GrowingLines)
    return parsed_metrics(spark.readStream.format("growing_lines").option("path", path).option("splitBytes", str(split_bytes)).load())


def read_growing_metrics(spark: SparkSession, path: str) -> DataFrame:
    spark.dataSource.register(GrowingLines)
    return parsed_metrics(spark.read.format("growing_lines").option("path", path).load())
