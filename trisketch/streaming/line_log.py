"""A replayable stream of the lines of a growing text log.

The log is a folder of files that are read in the order of their paths; a file only grows, and only
the last one does. An offset is a path and a number of bytes, so a restarted query goes on behind
the last committed line and a replayed batch reads the same bytes again. A last line without its
line end is left for a later batch. No port is opened, and the log may lie on any file system that
Arrow reads.
"""

from __future__ import annotations

import json
import sys
from collections.abc import Iterator, Mapping
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition
from pyspark.sql.types import StructType

# Executors need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

TASK_BYTES = 32 << 20
READ_BYTES = 1 << 20


@dataclass
class Range(InputPartition):
    """The lines that begin at a byte in [begin, stop) of a file."""

    path: str
    begin: int
    stop: int


class LineLogReader(DataSourceStreamReader):
    def __init__(self, options: Mapping[str, str]):
        self.uri, self.offered = options["path"], options.get("offered")
        self.landings = int(options.get("landingsPerBatch", 0))
        if self.landings and not self.offered:
            raise ValueError("landingsPerBatch needs the option `offered`, a file that the query keeps beside its checkpoint")
        self.task_bytes = int(options.get("taskBytes", TASK_BYTES))
        self.started = False

    def _files(self) -> list[tuple[str, int]]:
        """(relative path, bytes) in order; names that begin with `_` or `.` are not of the log."""
        store, top = fs.FileSystem.from_uri(self.uri)
        found = store.get_file_info(fs.FileSelector(top, recursive=True, allow_not_found=True))
        named = ((f.path[len(top.rstrip("/")) + 1 :], f.size) for f in found if f.is_file)
        return sorted((p, n) for p, n in named if not any(x[0] in "_." for x in p.split("/")))

    def _open(self, path: str) -> pa.NativeFile:
        store, top = fs.FileSystem.from_uri(self.uri)
        return store.open_input_file(f"{top.rstrip('/')}/{path}")

    def _whole_lines(self, path: str, size: int) -> int:
        """Bytes up to and with the last line end, read from the file's end."""
        with self._open(path) as file:
            end = size
            while end > 0:
                begin = max(0, end - READ_BYTES)
                file.seek(begin)
                at = file.read(end - begin).rfind(b"\n")
                if at >= 0:
                    return begin + at + 1
                end = begin
        return 0

    def _last(self, files: list[tuple[str, int]], open_end: bool) -> dict:
        path, size = files[-1]
        return {"file": path, "at": self._whole_lines(path, size) if open_end else size}

    def initialOffset(self) -> dict:
        return {"file": "", "at": 0}

    def latestOffset(self) -> dict:
        """The end of the log, or of the next `landingsPerBatch` landings, its folders and files at the top.

        With a limit, what was offered last is kept in a file. A restarted query is offered it once
        more before anything else, as it may have planned that batch already.
        """
        files = self._files()
        if not self.landings:
            return self._last(files, True) if files else self.initialOffset()
        offered = self._read_offered()
        if not self.started and offered:
            self.started = True
            return offered
        self.started = True
        at = offered or self.initialOffset()
        ahead = [(p, n) for p, n in files if (p, n) > (at["file"], at["at"])]
        tops = sorted({p.split("/")[0] for p, _ in ahead})[: self.landings]
        taken = [(p, n) for p, n in ahead if p.split("/")[0] in tops]
        if not taken:
            return at
        end = self._last(taken, taken[-1] == files[-1])
        self._write_offered(end)
        return end

    def _read_offered(self) -> dict | None:
        store, path = fs.FileSystem.from_uri(self.offered)
        if store.get_file_info(path).type == fs.FileType.NotFound:
            return None
        with store.open_input_file(path) as file:
            return json.loads(file.read())

    def _write_offered(self, offset: dict) -> None:
        store, path = fs.FileSystem.from_uri(self.offered)
        store.create_dir(path.rpartition("/")[0])
        with store.open_output_stream(f"{path}.new") as file:
            file.write(json.dumps(offset).encode())
        store.move(f"{path}.new", path)

    def partitions(self, start: dict, end: dict) -> list[Range]:
        out = []
        for path, size in self._files():
            if (path, size) <= (start["file"], start["at"]) or path > end["file"]:
                continue
            begin = start["at"] if path == start["file"] else 0
            stop = end["at"] if path == end["file"] else size
            out += [Range(path, at, min(stop, at + self.task_bytes)) for at in range(begin, stop, self.task_bytes)]
        return out

    def read(self, partition: Range) -> Iterator[pa.RecordBatch]:
        with self._open(partition.path) as file:
            at = partition.begin
            if at:  # a line that begins before is another task's
                file.seek(at - 1)
                at += len(_line(file)) - 1
            file.seek(at)
            while at < partition.stop:
                block = file.read(min(READ_BYTES, partition.stop - at))
                if not block:
                    return
                if not block.endswith(b"\n"):
                    block += _line(file)
                at += len(block)
                lines = block.removesuffix(b"\n").split(b"\n")
                yield pa.record_batch([pa.array(lines, pa.binary()).cast(pa.string())], ["value"])


def _line(file: pa.NativeFile) -> bytes:
    """The rest of a line, with its end."""
    parts, at = [], file.tell()
    while block := file.read(READ_BYTES):
        end = block.find(b"\n")
        if end >= 0:
            parts.append(block[: end + 1])
            break
        parts.append(block)
    line = b"".join(parts)
    file.seek(at + len(line))
    return line


class LineLog(DataSource):
    @classmethod
    def name(cls) -> str:
        return "line_log"

    def schema(self) -> str:
        return "value string"

    def streamReader(self, schema: StructType) -> LineLogReader:
        return LineLogReader(self.options)


def log_lines(spark: SparkSession, path: str, landings_per_batch: int | None = None, offered: str | None = None) -> DataFrame:
    """Lines of a log; with a limit, a batch takes so many landings, and `offered` is a file of the query's own."""
    spark.dataSource.register(LineLog)
    stream = spark.readStream.format("line_log").option("path", path)
    if landings_per_batch:
        stream = stream.option("landingsPerBatch", str(landings_per_batch)).option("offered", offered)
    return stream.load()


def write_log(lines: DataFrame, path: str, landing: str) -> None:
    """Play a producer: write (value, landing number) as one folder of the log for each landing, in one job."""
    named = lines.select("value", F.lpad(F.col(landing).cast("string"), 12, "0").alias("landing"))
    named.write.partitionBy("landing").text(path)
