"""A folder of committed files as a source and sink of its own, for tables and streams.

``data/`` holds parquet files in one folder per write, ``commits/`` one small JSON file per commit that names the files it added; a file
that no commit names is never read. Tasks write files, the driver adds the commit when all of them are done, so a
failed, killed or repeated task shows nothing, and commit and abort delete what such tasks left. A commit of a stream carries the stream's name and batch id: a batch that
comes again is not added twice. A read has one partition per file and skips files by the least and largest value of
a column; a stream's offset is the number of commits it has read.

One writer at a time may commit; the name of a commit is taken exclusively, so a second one fails rather than
replacing it. An empty or missing folder is a table without rows. Nulls, empty texts and repeated rows are kept.

    committed.register(spark)
    df.write.format("committed").mode("append").save(path)
    spark.read.format("committed").schema(df.schema).load(path)
    spark.readStream.format("committed").schema(df.schema).option("commitsPerBatch", 4).load(path)
"""

from __future__ import annotations

import json
import operator
import os
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark.sql import SparkSession
from pyspark.sql.datasource import (
    DataSource, DataSourceArrowWriter, DataSourceReader, DataSourceStreamArrowWriter, DataSourceStreamReader, EqualTo,
    Filter, GreaterThan, GreaterThanOrEqual, InputPartition, LessThan, LessThanOrEqual, WriterCommitMessage,
)
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

DIGITS = 12
#: May a file with least value a and largest value b hold a row for which the filter holds?
MAY_HOLD = {
    EqualTo: lambda a, b, v: a <= v <= b,
    GreaterThan: lambda a, b, v: operator.gt(b, v),
    GreaterThanOrEqual: lambda a, b, v: operator.ge(b, v),
    LessThan: lambda a, b, v: operator.lt(a, v),
    LessThanOrEqual: lambda a, b, v: operator.le(a, v),
}


@dataclass
class Added(WriterCommitMessage):
    """A written file: name, rows, and least and largest value of its whole-number columns."""

    name: str
    rows: int
    ranges: dict


@dataclass
class File(InputPartition):
    name: str


class Folder:
    """The files of a path, local or of any file system that pyarrow can name by a URI."""

    def __init__(self, path: str):
        self.path = path

    def _at(self, *parts: str) -> tuple[pafs.FileSystem, str]:
        named = ":/" in self.path
        fs, base = pafs.FileSystem.from_uri(self.path) if named else (pafs.LocalFileSystem(), os.path.abspath(self.path))
        return fs, "/".join([base.rstrip("/"), *parts])

    def commits(self) -> list[str]:
        """Names of commits in their order: ``number.json``, or ``number-stream-batch.json``."""
        fs, folder = self._at("commits")
        found = fs.get_file_info(pafs.FileSelector(folder, allow_not_found=True))
        return sorted(f.base_name for f in found if f.base_name.endswith(".json"))

    def files(self, names: list[str]) -> list[Added]:
        out = []
        for name in names:
            fs, path = self._at("commits", name)
            with fs.open_input_stream(path) as f:
                out += [Added(**a) for a in json.loads(f.read())]
        return out

    def commit(self, job: str, added: list[Added], tag: str | None = None) -> None:
        """Add files of a write under the next number; with a ``tag``, once only."""
        known = self.commits()
        before = self.tagged(tag, known)
        if before is not None:
            self.drop(job, before)
            return
        self.drop(job, {a.name for a in added})
        number = int(known[-1][:DIGITS]) + 1 if known else 0
        fs, folder = self._at("commits")
        fs.create_dir(folder)
        body = json.dumps([a.__dict__ for a in added]).encode()
        name = f"{number:0{DIGITS}}" + (f"-{tag}" if tag is not None else "") + ".json"
        if isinstance(fs, pafs.LocalFileSystem):
            staged = f"{folder}/.{uuid.uuid4().hex}"
            with open(staged, "wb") as f:
                f.write(body)
            try:
                os.link(staged, f"{folder}/{name}")  # whole or not at all, and never over another one
            finally:
                os.unlink(staged)
            return
        if fs.get_file_info(f"{folder}/{name}").type != pafs.FileType.NotFound:
            raise FileExistsError(name)
        with fs.open_output_stream(f"{folder}/{name}") as f:
            f.write(body)

    def tagged(self, tag: str | None, known: list[str]) -> set[str] | None:
        """The files of the commit with this tag, none if there is no such commit."""
        of = [n for n in known if tag is not None and n[DIGITS:] == f"-{tag}.json"]
        return {a.name for a in self.files(of)} if of else None

    def write(self, job: str, batches: Iterator[pa.RecordBatch], schema: pa.Schema) -> Added:
        """The rows as one new file of a write, no file for no rows."""
        name = f"{job}/{uuid.uuid4().hex}.parquet"
        fs, path = self._at("data", name)
        writer, rows, ranges = None, 0, {}
        for batch in batches:
            if not batch.num_rows:
                continue
            batch = batch.cast(schema)
            if writer is None:
                fs.create_dir(path.rpartition("/")[0])
                writer = pq.ParquetWriter(path, schema, filesystem=fs)
            writer.write_batch(batch)
            rows += batch.num_rows
            for field in schema:
                if pa.types.is_integer(field.type):
                    found = pc.min_max(batch.column(field.name)).as_py()
                    if found["min"] is not None:
                        a, b = ranges.get(field.name, (found["min"], found["max"]))
                        ranges[field.name] = [min(a, found["min"]), max(b, found["max"])]
        if writer is not None:
            writer.close()
        return Added(name, rows, ranges)

    def drop(self, job: str, but: set[str] = frozenset()) -> None:
        """Delete the files of a write that are not in ``but``: also those of killed and repeated tasks."""
        fs, folder = self._at("data", job)
        for found in fs.get_file_info(pafs.FileSelector(folder, allow_not_found=True)):
            if f"{job}/{found.base_name}" not in but:
                fs.delete_file(found.path)
        if not but and fs.get_file_info(folder).type != pafs.FileType.NotFound:
            fs.delete_dir(folder)

    def read(self, name: str, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
        fs, path = self._at("data", name)
        with pq.ParquetFile(fs.open_input_file(path)) as file:
            for batch in file.iter_batches(columns=schema.names):
                yield batch.select(schema.names).cast(schema)


class CommittedFiles(DataSource):
    """Options: ``path``; ``commitsPerBatch`` bounds a micro-batch; ``stream`` names a writing stream, if several write."""

    @classmethod
    def name(cls) -> str:
        return "committed"

    def reader(self, schema: StructType) -> DataSourceReader:
        return Reader(Folder(self.options["path"]), schema)

    def streamReader(self, schema: StructType) -> DataSourceStreamReader:
        return StreamReader(Folder(self.options["path"]), schema, int(self.options.get("commitsPerBatch", 0)))

    def writer(self, schema: StructType, overwrite: bool) -> DataSourceArrowWriter:
        if overwrite:
            raise ValueError("commits are added, not replaced: use mode append")
        return Writer(Folder(self.options["path"]), schema)

    def streamWriter(self, schema: StructType, overwrite: bool) -> DataSourceStreamArrowWriter:
        if overwrite:
            raise ValueError("commits are added, not replaced: use output mode append")
        return StreamWriter(Folder(self.options["path"]), schema, self.options.get("stream", "stream"))


def register(spark: SparkSession) -> SparkSession:
    """Make the format ``committed`` known, with filters handed to it."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(CommittedFiles)
    return spark


class Reader(DataSourceReader):
    def __init__(self, folder: Folder, schema: StructType):
        self.folder, self.schema, self.tests = folder, to_arrow_schema(schema), []

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        """Comparisons of whole numbers skip files; rows are still tested by Spark."""
        for f in filters:
            if type(f) in MAY_HOLD and len(f.attribute) == 1 and isinstance(f.value, int):
                self.tests.append((f.attribute[0], type(f), f.value))
            yield f

    def _may_hold(self, file: Added) -> bool:
        for column, kind, value in self.tests:
            if column in self.schema.names and pa.types.is_integer(self.schema.field(column).type):
                if column not in file.ranges or not MAY_HOLD[kind](*file.ranges[column], value):
                    return False  # without a range all values are null, and no comparison holds
        return True

    def partitions(self) -> list[File]:
        return [File(a.name) for a in self.folder.files(self.folder.commits()) if self._may_hold(a)]

    def read(self, partition: File) -> Iterator[pa.RecordBatch]:
        # Spark plans one partition without a value where there is no file
        return iter(()) if partition is None else self.folder.read(partition.name, self.schema)


class StreamReader(DataSourceStreamReader):
    def __init__(self, folder: Folder, schema: StructType, most: int):
        self.folder, self.schema, self.most, self.seen = folder, to_arrow_schema(schema), most, 0

    def initialOffset(self) -> dict:
        return {"commits": 0}

    def latestOffset(self) -> dict:
        """The next ``commitsPerBatch`` commits behind those planned so far, all without that option."""
        there = len(self.folder.commits())
        self.seen = min(there, self.seen + self.most) if self.most else there
        return {"commits": self.seen}

    def partitions(self, start: dict, end: dict) -> list[File]:
        self.seen = max(self.seen, end["commits"])
        return [File(a.name) for a in self.folder.files(self.folder.commits()[start["commits"]:end["commits"]])]

    def read(self, partition: File) -> Iterator[pa.RecordBatch]:
        return self.folder.read(partition.name, self.schema)

    def commit(self, end: dict) -> None:
        pass


def written(messages: list[WriterCommitMessage | None]) -> list[Added]:
    """The files of tasks that ended well and had rows."""
    return [m for m in messages if m is not None and m.rows]


class Writer(DataSourceArrowWriter):
    def __init__(self, folder: Folder, schema: StructType):
        self.folder, self.schema, self.job = folder, to_arrow_schema(schema), uuid.uuid4().hex

    def write(self, iterator: Iterator[pa.RecordBatch]) -> WriterCommitMessage:
        return self.folder.write(self.job, iterator, self.schema)

    def commit(self, messages: list[WriterCommitMessage | None]) -> None:
        self.folder.commit(self.job, written(messages))

    def abort(self, messages: list[WriterCommitMessage | None]) -> None:
        self.folder.drop(self.job)


class StreamWriter(DataSourceStreamArrowWriter):
    """Each batch is a write of its own; one that comes again keeps the files of its commit."""

    def __init__(self, folder: Folder, schema: StructType, stream: str):
        self.folder, self.schema, self.stream = folder, to_arrow_schema(schema), stream

    def write(self, iterator: Iterator[pa.RecordBatch]) -> WriterCommitMessage:
        from pyspark import TaskContext

        batch = TaskContext.get().getLocalProperty("streaming.sql.batchId")
        return self.folder.write(f"{self.stream}-{batch}", iterator, self.schema)

    def commit(self, messages: list[WriterCommitMessage | None], batchId: int) -> None:
        tag = f"{self.stream}-{batchId}"
        self.folder.commit(tag, written(messages), tag)

    def abort(self, messages: list[WriterCommitMessage | None], batchId: int) -> None:
        tag = f"{self.stream}-{batchId}"
        self.folder.drop(tag, self.folder.tagged(tag, self.folder.commits()) or set())
