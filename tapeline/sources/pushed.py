"""A stream that rows are appended to: a data source with a writer and a streaming reader.

A feed, or any job, appends rows; queries read what was appended since their last micro-batch. The
offset is the number of rows appended so far, so a batch that is run again gets exactly the rows it
had. An append is there whole or not at all: its tasks write files of Arrow batches, then one small log
entry, named after its first row, makes them part of the stream.

    <folder>/rows/<file>.arrow        rows, a file per writing task
    <folder>/log/<first row>.json     the files of an append, in order, with their numbers of rows

The folder has to be one that all executors share. One writer appends at a time; readers may be many.
"""

from __future__ import annotations

import json
import sys
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource,
    DataSourceArrowWriter,
    DataSourceReader,
    DataSourceStreamReader,
    InputPartition,
    WriterCommitMessage,
)
from pyspark.sql.types import StructType

from tapeline.functions.json_text import has_fields
from tapeline.operators.records import decoded_trades, observe_decode
from tapeline.schemas import TRADE

# Executors need not have this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

NAME = "tapeline_pushed"


class _Log:
    """The folder of a stream, by Arrow's file systems."""

    def __init__(self, path: str):
        scheme, colon, rest = path.partition(":")
        if not colon:
            path = f"file://{path}"
        elif scheme == "file":
            path = f"file:///{rest.lstrip('/')}"
        self.files, self.root = fs.FileSystem.from_uri(path)

    def entries(self) -> list[tuple[int, str]]:
        """First row and path of every append, in order."""
        found = self.files.get_file_info(fs.FileSelector(f"{self.root}/log", allow_not_found=True))
        return sorted((int(x.base_name[:-5]), x.path) for x in found if x.base_name[:-5].isdigit())

    def segments(self, path: str) -> list[tuple[str, int]]:
        with self.files.open_input_stream(path) as file:
            return [tuple(segment) for segment in json.loads(file.read())]

    def end(self) -> int:
        entries = self.entries()
        if not entries:
            return 0
        first, path = entries[-1]
        return first + sum(n for _, n in self.segments(path))

    def slices(self, start: int, end: int) -> list[Slice]:
        """Which rows of which files lie between two offsets."""
        entries = self.entries()
        found = []
        for i, (first, path) in enumerate(entries):
            following = entries[i + 1][0] if i + 1 < len(entries) else end
            if following <= start or first >= end:
                continue
            for name, n in self.segments(path):
                a, b = max(start, first), min(end, first + n)
                if a < b:
                    found.append(Slice(f"{self.root}/rows/{name}", a - first, b - a))
                first += n
        return found

    def append(self, segments: list[tuple[str, int]]) -> None:
        final = f"{self.root}/log/{self.end():020d}.json"
        self.files.create_dir(f"{self.root}/log", recursive=True)
        draft = f"{self.root}/log/draft-{uuid.uuid4().hex}"
        with self.files.open_output_stream(draft) as file:
            file.write(json.dumps(segments).encode())
        self.files.move(draft, final)

    def drop(self, upto: int) -> None:
        """Remove appends whose rows all come before an offset; the last stays, as it tells the end."""
        entries = self.entries()
        for (_, path), (following, _) in zip(entries, entries[1:], strict=False):
            if following <= upto:
                for name, _ in self.segments(path):
                    self.files.delete_file(f"{self.root}/rows/{name}")
                self.files.delete_file(path)

    def read(self, part: Slice) -> Iterator[pa.RecordBatch]:
        """Rows of a slice, a stored batch at a time."""
        skip, take = part.skip, part.take
        with self.files.open_input_file(part.path) as file:
            stored = pa.ipc.open_file(file)
            for i in range(stored.num_record_batches):
                batch = stored.get_batch(i)
                if skip >= batch.num_rows:
                    skip -= batch.num_rows
                    continue
                some = batch.slice(skip, take)
                skip, take = 0, take - some.num_rows
                yield some
                if not take:
                    return


@dataclass
class Slice(InputPartition):
    path: str
    skip: int
    take: int


@dataclass
class _Written(WriterCommitMessage):
    name: str | None
    n: int


class _Writer(DataSourceArrowWriter):
    def __init__(self, path: str):
        self.path = path

    def write(self, iterator: Iterator[pa.RecordBatch]) -> _Written:
        log, name, n, out, file = _Log(self.path), f"{uuid.uuid4().hex}.arrow", 0, None, None
        try:
            for batch in iterator:
                if out is None:
                    log.files.create_dir(f"{log.root}/rows", recursive=True)
                    file = log.files.open_output_stream(f"{log.root}/rows/{name}")
                    out = pa.ipc.new_file(file, batch.schema)
                out.write_batch(batch)
                n += batch.num_rows
        finally:
            if out is not None:
                out.close()
                file.close()
        return _Written(name if out is not None else None, n)

    def commit(self, messages: list) -> None:
        written = [(m.name, m.n) for m in messages if m is not None and m.n]
        if written:
            _Log(self.path).append(written)

    def abort(self, messages: list) -> None:
        log = _Log(self.path)
        for message in messages:
            if message is not None and message.name is not None:
                log.files.delete_file(f"{log.root}/rows/{message.name}")


class _Reader(DataSourceReader):
    def __init__(self, path: str):
        self.path = path

    def partitions(self) -> list[Slice]:
        log = _Log(self.path)
        return log.slices(0, log.end())

    def read(self, partition: Slice) -> Iterator[pa.RecordBatch]:
        return _Log(self.path).read(partition)


class _StreamReader(DataSourceStreamReader):
    def __init__(self, path: str, from_end: bool, drop: bool):
        self.path, self.from_end, self.drop = path, from_end, drop

    def initialOffset(self) -> dict:  # noqa: N802
        log = _Log(self.path)
        if self.from_end:
            return {"row": log.end()}
        entries = log.entries()
        return {"row": entries[0][0] if entries else 0}

    def latestOffset(self) -> dict:  # noqa: N802
        return {"row": _Log(self.path).end()}

    def partitions(self, start: dict, end: dict) -> list[Slice]:
        return _Log(self.path).slices(start["row"], end["row"])

    def read(self, partition: Slice) -> Iterator[pa.RecordBatch]:
        return _Log(self.path).read(partition)

    def commit(self, end: dict) -> None:
        if self.drop:
            _Log(self.path).drop(end["row"])


class PushedRows(DataSource):
    """Options: `path`; `startingOffsets`, `earliest` (default) or `latest`; `dropCommitted`, whether rows
    that the query is done with are removed: only for the one reader of a stream."""

    @classmethod
    def name(cls) -> str:
        return NAME

    def writer(self, schema: StructType, overwrite: bool) -> _Writer:
        if overwrite:
            raise ValueError("rows are only appended")
        return _Writer(self.options["path"])

    def reader(self, schema: StructType) -> _Reader:
        return _Reader(self.options["path"])

    def streamReader(self, schema: StructType) -> _StreamReader:  # noqa: N802
        from_end = self.options.get("startingOffsets", "earliest").lower() == "latest"
        drop = self.options.get("dropCommitted", "false").lower() == "true"
        return _StreamReader(self.options["path"], from_end, drop)


def push_rows(rows: DataFrame, folder: str) -> None:
    """Append rows to the stream of a folder, all at once: readers see all of them or none."""
    rows.sparkSession.dataSource.register(PushedRows)
    rows.write.format(NAME).mode("append").save(folder)


def read_pushed(
    spark: SparkSession, folder: str, schema: StructType, *, stream: bool = True, **options: str
) -> DataFrame:
    """The rows of a folder's stream; a micro-batch has all rows appended since the one before.

    A run with `once` is one micro-batch, which is the last one again if that did not end.
    """
    spark.dataSource.register(PushedRows)
    reader = spark.readStream if stream else spark.read
    return reader.format(NAME).schema(schema).options(**options).load(folder)


def pushed_trades(spark: SparkSession, folder: str, **options: str) -> DataFrame:
    """A stream of pushed trade rows, by the rule of all trade sources: all fields there and usable.

    Rows that are not are counted, as the query metric `rejected`, and left out.
    """
    rows = read_pushed(spark, folder, TRADE, **options)
    trade = F.when(has_fields(F.col, TRADE), F.struct(*TRADE.fieldNames()))
    return decoded_trades(observe_decode(rows.withColumn("trade", trade)))
