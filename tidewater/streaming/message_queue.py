"""S9. A folder of message files as a queue: message offsets and a limit of messages per batch.

A Python data source. An offset is (file time, file, byte): files are taken in
the order of their time and name, messages are lines, and a batch is the
next ``maxMessages`` of them, wherever files begin and end. Planning reads the
lines of one batch on the driver, no more; tasks read their bytes again. Paths
may be in any store that Arrow's file systems reach.
"""

from __future__ import annotations

import io
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

from tidewater.session import ship_by_value

ship_by_value(__name__)

FORMAT = "message_queue"


@dataclass
class Piece(InputPartition):
    path: str
    start: int
    end: int


def _files(path: str) -> list[tuple[int, str, int]]:
    """(time, path, size) of the files below ``path`` in queue order."""
    from pyarrow import fs
    store, root = fs.FileSystem.from_uri(path)
    found = store.get_file_info(fs.FileSelector(root, recursive=True, allow_not_found=True))
    return sorted((f.mtime_ns or 0, f.path, f.size) for f in found
                  if f.type == fs.FileType.File and not f.base_name.startswith((".", "_")))


def _open(path: str, file: str) -> io.BufferedReader:
    from pyarrow import fs
    return io.BufferedReader(fs.FileSystem.from_uri(path)[0].open_input_file(file))


class QueueReader(DataSourceStreamReader):
    def __init__(self, options):
        self.path, self.most = options["path"], int(options.get("maxMessages", "5"))
        self.at: dict | None = None  # the end of the last planned batch

    def initialOffset(self) -> dict:
        return {"time": 0, "file": "", "byte": 0}

    def latestOffset(self) -> dict:
        """``maxMessages`` messages further than the last batch, or as far as there are any."""
        at, left = dict(self.at or self.initialOffset()), self.most
        for time, file, size in _files(self.path):
            begin = at["byte"] if (time, file) == (at["time"], at["file"]) else 0
            if (time, file) < (at["time"], at["file"]) or begin >= size:
                continue
            with _open(self.path, file) as f:
                f.seek(begin)
                while left and (line := f.readline()):
                    begin, left = begin + len(line), left - bool(line.strip())
            at = {"time": time, "file": file, "byte": begin}
            if not left:
                break
        self.at = at
        return at

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        if self.at is None:  # after a restart the last planned batch is planned again first
            self.at = end
        first, last = ((o["time"], o["file"]) for o in (start, end))
        return [Piece(file, start["byte"] if (time, file) == first else 0, end["byte"] if (time, file) == last else size)
                for time, file, size in _files(self.path) if first <= (time, file) <= last]

    def read(self, partition: Piece) -> Iterator[tuple]:
        with _open(self.path, partition.path) as f:
            f.seek(partition.start)
            while f.tell() < partition.end:
                line = f.readline().strip()
                if line:
                    yield (line.decode("utf-8", "replace"),)


class QueueSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return "value string"

    def streamReader(self, schema) -> QueueReader:
        return QueueReader(self.options)
