"""Command logs as a stream: a Python data source whose offset is how many bytes of each file are read.

`spark.readStream.format("command_log").option("path", folder)` follows the files of a folder; programs append whole lines. A batch goes
to the last whole line that is there; its bytes are cut into ranges, and a line belongs to the range in which it begins, so tasks read
nothing twice and no task reads a file to find its place. Since an offset names bytes, any batch can be read again, and a stream can start from a
given offset (`startingOffset`: JSON of bytes by file, at beginnings of lines).

Defined cases: a line without its end waits for it; empty lines are lines; carriage returns before an end are dropped; bytes that aren't
UTF-8 are replaced; files whose names begin with . or _ are left out; files may only grow.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

SCHEMA = "file string, at long, text string"
#: Bytes of a range, and of a read.
RANGE, READ = 8 << 20, 1 << 16


@dataclass
class Lines(InputPartition):
    """Lines of a file that begin in [low, high); begins: a line begins at low."""

    file: str
    low: int
    high: int
    begins: bool

    def __post_init__(self) -> None:
        self.value = (self.file, self.low, self.high)


class _Folder:
    def __init__(self, path: str):
        self.path = path

    def _place(self):
        from pyarrow import fs

        return fs.FileSystem.from_uri(self.path) if "://" in self.path or self.path.startswith("file:") else (fs.LocalFileSystem(), self.path)

    def ends(self) -> dict[str, int]:
        """By file the bytes up to the end of its last whole line."""
        from pyarrow import fs

        system, path = self._place()
        out = {}
        for info in system.get_file_info(fs.FileSelector(path)):
            if info.type == fs.FileType.File and info.base_name[0] not in "._":
                with system.open_input_file(info.path) as f:
                    at = info.size
                    while at > 0:
                        low = max(0, at - READ)
                        f.seek(low)
                        found = f.read(at - low).rfind(b"\n")
                        if found >= 0:
                            out[info.base_name] = low + found + 1
                            break
                        at = low
        return out

    def ranges(self, start: dict[str, int], end: dict[str, int]) -> list[Lines]:
        return [Lines(f, low, min(low + RANGE, high), low == start.get(f, 0)) for f, high in sorted(end.items()) for low in range(start.get(f, 0), high, RANGE)]

    def read(self, part: Lines) -> Iterator[tuple[str, int, str]]:
        system, path = self._place()
        with system.open_input_file(f"{path}/{part.file}") as f:
            at = part.low if part.begins else part.low - 1  # the byte before tells whether a line begins here
            f.seek(at)
            held, skip = b"", not part.begins
            while True:
                end = held.find(b"\n")
                while end < 0:
                    more = f.read(READ)
                    if not more:
                        return
                    end = more.find(b"\n")
                    end = end + len(held) if end >= 0 else -1
                    held += more
                if not skip:
                    if at >= part.high:
                        return
                    yield part.file, at, held[:end].removesuffix(b"\r").decode("utf-8", "replace")
                skip = False
                at, held = at + end + 1, held[end + 1 :]


class LogStream(DataSourceStreamReader):
    def __init__(self, path: str, start: dict[str, int]):
        self.folder, self.start = _Folder(path), start

    def initialOffset(self) -> dict:
        return self.start

    def latestOffset(self) -> dict:
        return self.start | self.folder.ends()

    def partitions(self, start: dict, end: dict) -> list[Lines]:
        return self.folder.ranges(start, end)

    def read(self, partition: Lines) -> Iterator[tuple]:
        return self.folder.read(partition)

    def commit(self, end: dict) -> None:
        pass


class LogReader(DataSourceReader):
    def __init__(self, path: str, start: dict[str, int]):
        self.folder, self.start = _Folder(path), start

    def partitions(self) -> list[Lines]:
        return self.folder.ranges(self.start, self.folder.ends())

    def read(self, partition: Lines) -> Iterator[tuple]:
        return self.folder.read(partition)


class CommandLog(DataSource):
    @classmethod
    def name(cls) -> str:
        return "command_log"

    def schema(self) -> str:
        return SCHEMA

    def _options(self) -> tuple[str, dict[str, int]]:
        return self.options["path"], json.loads(self.options.get("startingOffset", "{}"))

    def reader(self, schema) -> LogReader:
        return LogReader(*self._options())

    def streamReader(self, schema) -> LogStream:
        return LogStream(*self._options())


def register(spark: SparkSession) -> None:
    spark.dataSource.register(CommandLog)
