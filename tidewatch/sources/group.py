"""Reading an append-only stream as a member of a consumer group: bounded batches, and again what wasn't committed.

A stream is a folder of segments, files of JSON lines (stream_id, payload) that are only appended to, in the order of
their names.  An offset is a segment and a byte in it.  The query's checkpoint keeps the offsets of its batches, so a
batch that failed is read again as it was; what is committed is also written down for the group, and a query of that
group without a checkpoint begins there.
"""

from __future__ import annotations

import json
import time
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

from tidewatch.config import PipelineConfig
from tidewatch.schemas import STREAM_ENTRY

#: A task reads so many bytes, up to the end of a line.
PART_BYTES = 8 << 20
_PAUSE = 0.05
_BLOCK = 1 << 16


@dataclass
class Span(InputPartition):
    path: str
    low: int
    high: int


def _opened(folder: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(folder) if "://" in folder or folder.startswith("file:") else (fs.LocalFileSystem(), folder)


def lines_until(file, low: int, most: int) -> tuple[int, int]:
    """How many whole lines there are from ``low`` on, ``most`` at most, and where the last of them ends."""
    file.seek(low)
    found, end, at = 0, low, low
    while found < most and (block := file.read(_BLOCK)):
        cut = -1
        while found < most and (cut := block.find(b"\n", cut + 1)) >= 0:
            found, end = found + 1, at + cut + 1
        at += len(block)
    return found, end


class GroupReader(DataSourceStreamReader):
    def __init__(self, options: dict[str, str]):
        self.folder, self.group = options["path"].rstrip("/"), options.get("group", "default")
        self.count, self.block = int(options.get("count", 25)), int(options.get("block_ms", 5000)) / 1000
        self.at: dict | None = None

    def _segments(self) -> list[tuple[str, int]]:
        files, folder = _opened(self.folder)
        got = files.get_file_info(fs.FileSelector(folder, allow_not_found=True))
        return sorted((f.base_name, f.size) for f in got if f.is_file and not f.base_name.startswith(("_", ".")))

    def _mark(self) -> str:
        return f"_groups/{self.group}.json"

    def initialOffset(self) -> dict:
        files, folder = _opened(self.folder)
        path = f"{folder}/{self._mark()}"
        if files.get_file_info(path).type == fs.FileType.NotFound:
            return {"segment": "", "byte": 0}
        with files.open_input_stream(path) as f:
            return json.loads(f.read())

    def _forward(self, start: dict) -> dict:
        """The offset ``count`` whole lines behind ``start``, or as far as there are any."""
        files, folder = _opened(self.folder)
        left, end = self.count, start
        for name, size in self._segments():
            if name < start["segment"] or not left:
                continue
            low = start["byte"] if name == start["segment"] else 0
            if size > low:
                with files.open_input_file(f"{folder}/{name}") as f:
                    found, byte = lines_until(f, low, left)
                if found:
                    left, end = left - found, {"segment": name, "byte": byte}
        return end

    def latestOffset(self, start: dict | None = None, limit=None) -> dict:
        """Waits for entries as long as a read may block, and then says that there is nothing new."""
        begin = start if start is not None else self.at if self.at is not None else self.initialOffset()
        until = time.monotonic() + self.block
        while (end := self._forward(begin)) == begin and time.monotonic() < until:
            time.sleep(_PAUSE)
        self.at = end
        return end

    def partitions(self, start: dict, end: dict) -> Sequence[InputPartition]:
        self.at = end
        out = []
        for name, size in self._segments():
            if start["segment"] <= name <= end["segment"]:
                low, high = start["byte"] if name == start["segment"] else 0, end["byte"] if name == end["segment"] else size
                out += [Span(f"{self.folder}/{name}", a, min(a + PART_BYTES, high)) for a in range(low, high, PART_BYTES)]
        return out

    def read(self, partition: Span) -> Iterator[pa.RecordBatch]:
        """Lines that begin in the span."""
        files, path = _opened(partition.path)
        with files.open_input_file(path) as f:
            low = partition.low
            if low:
                f.seek(low - 1)
                low += len(_line(f, low - 1)) - 1  # to the end of a line that began before
            f.seek(low)
            raw = f.read(max(partition.high - low, 0))
            if raw and not raw.endswith(b"\n"):
                raw += _line(f, low + len(raw))
        rows = [json.loads(x) for x in raw.split(b"\n") if x.strip()]
        yield pa.RecordBatch.from_arrays([pa.array([r.get(c) for r in rows], pa.string()) for c in ("stream_id", "payload")], ["stream_id", "payload"])

    def commit(self, end: dict) -> None:
        files, folder = _opened(self.folder)
        files.create_dir(f"{folder}/_groups")
        with files.open_output_stream(f"{folder}/{self._mark()}.new") as f:
            f.write(json.dumps(end).encode())
        files.move(f"{folder}/{self._mark()}.new", f"{folder}/{self._mark()}")


def _line(file, low: int) -> bytes:
    """From ``low`` to the end of the line, that included."""
    file.seek(low)
    out = b""
    while block := file.read(_BLOCK):
        cut = block.find(b"\n")
        if cut >= 0:
            return out + block[: cut + 1]
        out += block
    return out


class EntryGroup(DataSource):
    """Options: path, group, count (entries of a batch at most) and block_ms (how long a read waits for any)."""

    @classmethod
    def name(cls) -> str:
        return "entry_group"

    def schema(self) -> str:
        return STREAM_ENTRY

    def streamReader(self, schema) -> DataSourceStreamReader:
        return GroupReader(dict(self.options))


def read_group(spark: SparkSession, folder: str, group: str, config: PipelineConfig = PipelineConfig()) -> DataFrame:
    """The entries that the group hasn't had, as a stream; the batch bound and the waiting time are the configuration's."""
    spark.dataSource.register(EntryGroup)
    return spark.readStream.format("entry_group").option("group", group).option("count", config.batch_count).option("block_ms", config.block_ms).load(folder)
