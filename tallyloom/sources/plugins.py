"""Sources and loaders as registered data sources: a store of Parquet files that only a commit makes visible.

    register_stores(spark)
    rows.write.format("committed").option("load", "2025-01-01").mode("append").save(folder)
    spark.read.format("committed").load(folder)

A task writes a file of its own. When all have ended, one small manifest names their files; readers know no others. So a load that
fails, loses tasks or is retried leaves nothing that anyone can read, and a load that is repeated under its name replaces itself.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import SparkSession
from pyspark.sql.datasource import (
    DataSource,
    DataSourceArrowWriter,
    DataSourceReader,
    InputPartition,
    WriterCommitMessage,
)
from pyspark.sql.types import StructType


class Folder:
    """A store's folder on any file system that Arrow can open."""

    def __init__(self, path: str):
        uri = path.replace("file:/", "file:///", 1) if path.startswith("file:/") and not path.startswith("file://") else path
        self._system, self._root = fs.FileSystem.from_uri(uri.rstrip("/"))

    def file(self, *parts: str) -> str:
        return "/".join([self._root, *parts])

    def create(self, path: str):
        self._system.create_dir(path.rsplit("/", 1)[0], recursive=True)
        return self._system.open_output_stream(path)

    def open(self, path: str):
        return self._system.open_input_file(path)

    def drop(self, path: str) -> None:
        self._system.delete_file(path)

    def publish(self, text: str, path: str) -> None:
        """Write beside the target, then switch: a reader sees the whole text or none of it."""
        beside = f"{path}.{uuid.uuid4().hex}.new"
        with self.create(beside) as out:
            out.write(text.encode())
        self._system.move(beside, path)

    def manifests(self) -> list[dict]:
        """What was committed, in the order of the commits' numbers."""
        found = self._system.get_file_info(fs.FileSelector(self.file("commits"), allow_not_found=True))
        texts = [self.open(info.path).readall() for info in found if info.path.endswith(".json")]
        return sorted(map(json.loads, texts), key=lambda manifest: (manifest["number"], manifest["load"]))

    def visible(self) -> list[dict]:
        """The manifests that count: those from the last overwriting one on."""
        manifests = self.manifests()
        first = max((i for i, manifest in enumerate(manifests) if manifest["overwrite"]), default=0)
        return manifests[first:]


@dataclass
class FilePart(InputPartition):
    """One committed file."""

    path: str
    name: str


class CommittedReader(DataSourceReader):
    """Reads the files that manifests name, a task each, in Arrow batches."""

    def __init__(self, path: str, schema: StructType):
        self._path, self._names = path, schema.fieldNames()

    def partitions(self) -> list[FilePart]:
        return [FilePart(self._path, name) for manifest in Folder(self._path).visible() for name in manifest["files"]]

    def read(self, partition: FilePart) -> Iterator[pa.RecordBatch]:
        folder = Folder(partition.path)
        with folder.open(folder.file("files", partition.name)) as file:
            yield from pq.ParquetFile(file).iter_batches(columns=self._names)


@dataclass
class FileWritten(WriterCommitMessage):
    """What a task wrote; nothing if it had no rows."""

    name: str | None
    rows: int


class CommittedWriter(DataSourceArrowWriter):
    """Writes a file a task; ``commit`` publishes them together, ``abort`` removes them."""

    def __init__(self, path: str, load: str, schema: StructType, overwrite: bool):
        self._path, self._load, self._schema, self._overwrite = path, load, schema.json(), overwrite

    def write(self, iterator: Iterator[pa.RecordBatch]) -> FileWritten:
        folder, writer, rows = Folder(self._path), None, 0
        name = f"{self._load}-{TaskContext.get().partitionId()}-{uuid.uuid4().hex}.parquet"
        try:
            for batch in iterator:
                if writer is None:
                    writer = pq.ParquetWriter(folder.create(folder.file("files", name)), batch.schema)
                writer.write_batch(batch)
                rows += batch.num_rows
        except BaseException:
            if writer is not None:
                writer.close()
                folder.drop(folder.file("files", name))
            raise
        if writer is None:
            return FileWritten(None, 0)
        writer.close()
        return FileWritten(name, rows)

    def commit(self, messages: list[FileWritten | None]) -> None:
        folder = Folder(self._path)
        before = [manifest["number"] for manifest in folder.manifests()]
        manifest = {
            "load": self._load,
            "number": max(before, default=0) + 1,
            "overwrite": self._overwrite,
            "rows": sum(message.rows for message in messages if message),
            "files": [message.name for message in messages if message and message.name],
            "schema": self._schema,
        }
        folder.publish(json.dumps(manifest), folder.file("commits", f"{self._load}.json"))

    def abort(self, messages: list[FileWritten | None]) -> None:
        folder = Folder(self._path)
        for message in messages:
            if message and message.name:
                folder.drop(folder.file("files", message.name))


class CommittedStore(DataSource):
    """Data source ``committed``: options ``path``, and ``load``, the name of a load (one of its own, if not given)."""

    @classmethod
    def name(cls) -> str:
        return "committed"

    def schema(self) -> StructType:
        manifests = Folder(self.options["path"]).visible()
        if not manifests:
            raise ValueError(f"nothing was committed in {self.options['path']}")
        return StructType.fromJson(json.loads(manifests[-1]["schema"]))

    def reader(self, schema: StructType) -> CommittedReader:
        return CommittedReader(self.options["path"], schema)

    def writer(self, schema: StructType, overwrite: bool) -> CommittedWriter:
        return CommittedWriter(self.options["path"], self.options.get("load") or uuid.uuid4().hex, schema, overwrite)


def register_stores(spark: SparkSession) -> None:
    """Make ``format("committed")`` known to the session."""
    spark.dataSource.register(CommittedStore)
