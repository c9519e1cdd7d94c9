"""Growing log files as a stream: whole lines, each once, with their place in the file."""

from __future__ import annotations

import fnmatch
import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

BLOCK_BYTES = 32 << 20
READ_BYTES = 1 << 20
SCHEMA = "path string, file_name string, position bigint, line string"


@dataclass
class Span(InputPartition):
    """Bytes of a file between two line starts; lines that start in ``[start, stop)`` belong to the task."""

    path: str
    name: str
    start: int
    stop: int
    since: int  # where the trigger's part of the file starts
    upto: int  # and where its last whole line ends


class LogTail(DataSource):
    """Source ``log_tail``: options ``path``, ``pattern`` and ``blockBytes``."""

    @classmethod
    def name(cls) -> str:
        return "log_tail"

    def schema(self) -> str:
        return SCHEMA

    def streamReader(self, schema) -> LogTailReader:
        return LogTailReader(self.options["path"], self.options.get("pattern", "*.log"), int(self.options.get("blockBytes", BLOCK_BYTES)))


class LogTailReader(DataSourceStreamReader):
    """Offsets are the bytes of each file up to its last whole line; they are kept in the query's checkpoint.

    A file that has become shorter than its offset was started anew and is read from its first byte. One that was
    replaced and has outgrown its offset since the last trigger cannot be told from one that grew.
    """

    def __init__(self, folder: str, pattern: str, block_bytes: int) -> None:
        self.folder, self.pattern, self.block_bytes = folder, pattern, block_bytes
        self.known: dict[str, tuple[int, int]] = {}  # size and last line end of each file as last seen

    def initialOffset(self) -> dict:
        return {}

    def latestOffset(self) -> dict:
        system, folder = fs.FileSystem.from_uri(self.folder)
        out = {}
        for file in system.get_file_info(fs.FileSelector(folder, allow_not_found=True)):
            if file.is_file and fnmatch.fnmatchcase(file.base_name, self.pattern):
                size, whole = self.known.get(file.base_name, (0, 0))
                if file.size != size:
                    whole = self._line_end(system, file.path, file.size, whole if file.size > size else 0)
                    self.known[file.base_name] = file.size, whole
                if whole:
                    out[file.base_name] = whole
        return out

    @staticmethod
    def _line_end(system: fs.FileSystem, path: str, size: int, least: int) -> int:
        """End of the last whole line, found from the end of the file."""
        with system.open_input_file(path) as file:
            while size > least:
                start = max(size - READ_BYTES, least)
                at = file.read_at(size - start, start).rfind(b"\n")
                if at >= 0:
                    return start + at + 1
                size = start
        return least

    def partitions(self, start: dict, end: dict) -> Sequence[Span]:
        _, folder = fs.FileSystem.from_uri(self.folder)
        out = []
        for name, upto in sorted(end.items()):
            since = start.get(name, 0)
            since = since if since <= upto else 0
            for at in range(since, upto, self.block_bytes):
                out.append(Span(f"{folder.rstrip('/')}/{name}", name, at, min(at + self.block_bytes, upto), since, upto))
        return out

    def read(self, partition: Span) -> Iterator[pa.RecordBatch]:
        system, _ = fs.FileSystem.from_uri(self.folder)
        with system.open_input_file(partition.path) as file:
            at = partition.start
            if at > partition.since:  # the line this block starts in is the block's before
                at = self._next_line(file, at - 1, partition.upto)
            while at < partition.stop:
                stop = min(at + READ_BYTES, partition.stop)
                stop = self._next_line(file, stop - 1, partition.upto)
                yield self._lines(partition, file.read_at(stop - at, at), at)
                at = stop

    @staticmethod
    def _next_line(file: pa.NativeFile, at: int, upto: int) -> int:
        """Start of the first line after byte ``at``."""
        while at < upto:
            found = file.read_at(min(READ_BYTES, upto - at), at).find(b"\n")
            if found >= 0:
                return at + found + 1
            at += READ_BYTES
        return upto

    @staticmethod
    def _lines(partition: Span, raw: bytes, at: int) -> pa.RecordBatch:
        ends = np.flatnonzero(np.frombuffer(raw, np.uint8) == 0x0A)
        starts = np.concatenate([[0], ends[:-1] + 1])
        lines = [raw[a:b].removesuffix(b"\r").decode("utf-8", "replace") for a, b in zip(starts.tolist(), ends.tolist())]
        same = lambda value: pa.array([value] * len(lines), pa.string())
        return pa.RecordBatch.from_arrays(
            [same(partition.path), same(partition.name), pa.array(starts + at, pa.int64()), pa.array(lines, pa.string())],
            names=["path", "file_name", "position", "line"],
        )


def tail_logs(spark: SparkSession, folder: str, pattern: str = "*.log", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Lines that were appended since the last trigger, ``(path, file_name, position, line)``, as a stream.

    ``position`` is the byte a line starts at, so it orders and names the lines of a file. A line without an end yet
    is held back until it has one. Bytes that are not UTF-8 become replacement characters. ``folder`` is a URI that
    Arrow's file systems reach from every executor; a file's new bytes are dealt out in blocks.
    """
    spark.dataSource.register(LogTail)
    local = re.sub("^file:/+", "/", folder)  # Hadoop writes such URIs with one slash
    reader = spark.readStream.format("log_tail").option("path", local).option("pattern", pattern)
    return reader.option("blockBytes", block_bytes).load()
