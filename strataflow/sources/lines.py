"""Lines of files, read by tasks from a table of byte ranges: once, or as a stream of batches of files.

The table names the files; neither their names nor their bytes pass through the driver, which sees the
parts of the table alone. A line belongs to the range it begins in and knows its byte, so rows
have their order in the file however it is cut. As a stream, the offset is the number of a batch of the table:
a batch is there once it is written whole, a restarted query goes on after the last batch it finished,
and a file that was overwritten is an entry of a later batch.

Lines end with a line feed, with or without a carriage return before it. A file that changed since
it was listed gives no lines; it is listed again with its new time.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from datetime import UTC, datetime

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

NAME = "file_lines"
SPLIT_BYTES, RANGES_PER_TASK, CHUNK_BYTES = 8 << 20, 16, 4 << 20
# Tasks that a table is dealt to before one of them takes more than one range.
LEAST_TASKS = 256
EARLIEST, LATEST = "earliest", "latest"

ENTRY = ("file_path", "file_time", "length", "database_identifier", "name", "upload_id")
LINES = "file_path string, file_time timestamp, database_identifier string, upload_id long, byte long, value binary"
_ARROW = pa.schema(
    [
        ("file_path", pa.string()),
        ("file_time", pa.timestamp("us", tz="UTC")),
        ("database_identifier", pa.string()),
        ("upload_id", pa.int64()),
        ("byte", pa.int64()),
        ("value", pa.binary()),
    ]
)


def byte_ranges(files: DataFrame, split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """Files as ranges of bytes, ``start`` to ``stop``; an empty file has one empty range."""
    starts = F.sequence(F.lit(0).cast("long"), F.greatest(F.col("length") - 1, F.lit(0)), F.lit(split_bytes).cast("long"))
    cut = files.select(*[c for c in ENTRY if c in files.columns], F.explode(starts).alias("start"))
    return cut.withColumn("stop", F.least(F.col("start") + split_bytes, "length"))


def read_range(file, start: int, stop: int) -> Iterator[tuple[np.ndarray, list[bytes]]]:
    """Lines that begin from ``start`` to before ``stop``, with their bytes, in lists of bounded size."""
    at, rest = start, b""
    if start > 0:
        # The line that crosses the start belongs to the range before.
        file.seek(start - 1)
        at = start - 1
        while data := file.read(CHUNK_BYTES):
            found = data.find(b"\n")
            if found >= 0:
                at, rest = at + found + 1, data[found + 1 :]
                break
            at += len(data)
        else:
            return
    while at < stop:
        data = file.read(CHUNK_BYTES)
        whole = rest + data
        end = whole.rfind(b"\n") + 1 if data else len(whole)
        if end:
            lines = whole[: end - whole.endswith(b"\n", 0, end)].split(b"\n")
            begins = at + np.concatenate([[0], np.cumsum([len(line) + 1 for line in lines[:-1]], dtype=np.int64)])
            own = int(np.searchsorted(begins, stop))
            yield begins[:own], [line.removesuffix(b"\r") for line in lines[:own]]
        if not data:
            return
        at, rest = at + end, whole[end:]


@dataclass(frozen=True)
class Part(InputPartition):
    """Entries of one file of the table."""

    path: str
    begin: int
    end: int

    def __reduce__(self):
        return Part, (self.path, self.begin, self.end)


def _parts(folder: str, per_task: int) -> list[Part]:
    """Parts of the table: a range each if there are few, else up to ``per_task`` of them."""
    system, path = fs.FileSystem.from_uri(folder)
    files = []
    for info in system.get_file_info(fs.FileSelector(path, recursive=True)):
        if info.type == fs.FileType.File and info.path.endswith(".parquet"):
            with system.open_input_file(info.path) as file:
                rows = pq.read_metadata(file).num_rows
            files.append((f"{folder.rstrip('/')}/{info.path[len(path.rstrip('/')) + 1 :]}", rows))
    taken = min(per_task, max(1, sum(rows for _, rows in files) // LEAST_TASKS))
    return [Part(name, i, min(i + taken, rows)) for name, rows in files for i in range(0, rows, taken)]


def _unchanged(info: fs.FileInfo, length: int, time: datetime) -> bool:
    there = info.type == fs.FileType.File and info.size == length
    return there and abs(info.mtime_ns / 1e9 - time.timestamp()) < 1


def _read(part: Part | None) -> Iterator[pa.RecordBatch]:
    if part is None:  # a table without parts is read as one without a name
        return
    system, path = fs.FileSystem.from_uri(part.path)
    with system.open_input_file(path) as table:
        entries = pq.read_table(table).slice(part.begin, part.end - part.begin).to_pylist()
    for e in entries:
        time = e["file_time"] if e["file_time"].tzinfo else e["file_time"].replace(tzinfo=UTC)
        source, name = fs.FileSystem.from_uri(e["file_path"])
        if not _unchanged(source.get_file_info(name), e["length"], time):
            continue
        with source.open_input_file(name) as file:
            for begins, lines in read_range(file, e["start"], e["stop"]):
                same = [pa.repeat(pa.scalar(v, f.type), len(lines)) for v, f in zip(
                    (e["file_path"], time, e["database_identifier"], e.get("upload_id")), _ARROW
                )]
                yield pa.RecordBatch.from_arrays([*same, pa.array(begins), pa.array(lines, pa.binary())], schema=_ARROW)


class _Reader(DataSourceReader):
    def __init__(self, folder: str, per_task: int):
        self.folder, self.per_task = folder, per_task

    def partitions(self) -> list[Part]:
        return _parts(self.folder, self.per_task)

    def read(self, partition: Part | None) -> Iterator[pa.RecordBatch]:
        yield from _read(partition)


class _StreamReader(DataSourceStreamReader):
    def __init__(self, folder: str, per_task: int, since: str):
        self.folder, self.per_task, self.since = folder.rstrip("/"), per_task, since

    def batches(self) -> list[int]:
        """Batches that are written whole."""
        system, path = fs.FileSystem.from_uri(self.folder)
        found = system.get_file_info(fs.FileSelector(path, recursive=True, allow_not_found=True))
        marks = [i.path.split("/")[-2] for i in found if i.path.endswith("/_SUCCESS")]
        return sorted(int(m.partition("=")[2]) for m in marks if m.startswith("batch_id="))

    def latestOffset(self) -> dict:
        return {"batch": max(self.batches(), default=0)}

    def initialOffset(self) -> dict:
        if self.since == EARLIEST:
            return {"batch": 0}
        return self.latestOffset() if self.since == LATEST else {"batch": int(self.since)}

    def partitions(self, start: dict, end: dict) -> list[Part]:
        own = [n for n in self.batches() if start["batch"] < n <= end["batch"]]
        return [p for n in own for p in _parts(f"{self.folder}/batch_id={n}", self.per_task)]

    def read(self, partition: Part | None) -> Iterator[pa.RecordBatch]:
        yield from _read(partition)


class FileLines(DataSource):
    """Options: ``path`` of the table of ranges; ``ranges_per_task``; ``since`` for streams."""

    @classmethod
    def name(cls) -> str:
        return NAME

    def schema(self) -> str:
        return LINES

    def _per_task(self) -> int:
        return int(self.options.get("ranges_per_task", RANGES_PER_TASK))

    def reader(self, schema) -> _Reader:
        return _Reader(self.options["path"], self._per_task())

    def streamReader(self, schema) -> _StreamReader:
        return _StreamReader(self.options["path"], self._per_task(), self.options.get("since", EARLIEST))


def read_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Lines of all ranges of a stored table."""
    spark.dataSource.register(FileLines)
    return spark.read.format(NAME).option("path", folder).load()


def stream_lines(spark: SparkSession, folder: str, since: str | int = EARLIEST) -> DataFrame:
    """Lines of the batches of ``folder/batch_id=N/``: all, those that come after the start, or those after a batch."""
    spark.dataSource.register(FileLines)
    return spark.readStream.format(NAME).option("path", folder).option("since", str(since)).load()
