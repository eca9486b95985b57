"""File systems as tasks see them: local folders, and what Arrow reaches by URI (hdfs, s3, gs, abfs)."""

from __future__ import annotations

import io
import uuid
from collections.abc import Iterator
from fnmatch import fnmatch

from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession

PIECE = 1 << 20  # bytes read or copied at once


def opened(uri: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path or URI, and the path in it."""
    if uri.startswith("file:"):
        return fs.LocalFileSystem(), "/" + uri[5:].lstrip("/")
    if "://" in uri:
        return fs.FileSystem.from_uri(uri)
    return fs.LocalFileSystem(), uri


def files_below(uri: str, pattern: str = "*", hidden: bool = False) -> list[tuple[str, int]]:
    """URI and size of every file at or below a path, in order of path. Names starting with a dot or underscore are hidden."""
    system, path = opened(uri)
    info = system.get_file_info(path)
    if info.type == fs.FileType.NotFound:
        raise FileNotFoundError(uri)
    found = [info] if info.is_file else system.get_file_info(fs.FileSelector(path, recursive=True))
    prefix = uri[: len(uri) - len(path)] if uri.endswith(path) else "file://" if uri.startswith("file:") else ""
    shown = lambda p: hidden or not any(part[:1] in "._" for part in p[len(path) :].split("/") if part)
    return sorted((prefix + f.path, f.size) for f in found if f.is_file and fnmatch(f.base_name, pattern) and (info.is_file or shown(f.path)))


def pieces(handle, size: int | None = None) -> Iterator[bytes]:
    """What is left of an open file, or size bytes of it, in pieces."""
    while size is None or size > 0:
        data = handle.read(PIECE if size is None else min(PIECE, size))
        if not data:
            return
        yield data
        if size is not None:
            size -= len(data)


class Input(io.RawIOBase):
    """An open file for Python's own readers, which expect an OSError where a place is wrong."""

    def __init__(self, handle, size: int):
        self.handle, self.size = handle, size

    def readable(self) -> bool:
        return True

    def seekable(self) -> bool:
        return True

    def tell(self) -> int:
        return self.handle.tell()

    def seek(self, offset: int, whence: int = io.SEEK_SET) -> int:
        place = offset + {io.SEEK_SET: 0, io.SEEK_CUR: self.handle.tell(), io.SEEK_END: self.size}[whence]
        if place < 0:
            raise OSError("a place before the start")
        self.handle.seek(min(place, self.size))
        return self.handle.tell()

    def readinto(self, buffer) -> int:
        data = self.handle.read(len(buffer))
        buffer[: len(data)] = data
        return len(data)


def delete_folder(uri: str) -> None:
    system, path = opened(uri)
    if system.get_file_info(path).type == fs.FileType.Directory:
        system.delete_dir(path)


def replace(source: str, target: str) -> None:
    """Move a file over another, which may be there."""
    system, start = opened(source)
    _, end = opened(target)
    if not isinstance(system, fs.LocalFileSystem) and system.get_file_info(end).is_file:
        system.delete_file(end)  # where a move does not replace
    system.move(start, end)


def exists(spark: SparkSession, path: str) -> bool:
    """Whether there is a file or folder, as Spark's own readers see it."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place)


def shared_folder(spark: SparkSession) -> str:
    """A folder that the driver and all executors share: spark.checkpoint.dir, or else one in the warehouse."""
    return spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/scratch"


def kept(rows: DataFrame, tag: str) -> DataFrame:
    """rows as a table in the shared folder, for what is read several times and costs more than that."""
    path = f"{shared_folder(rows.sparkSession)}/{tag}-{uuid.uuid4().hex}"
    rows.write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def bound_batches(spark: SparkSession) -> None:
    """Smaller Arrow batches than Spark's default, so that contents of some kilobytes take few MB in each worker; another number stays."""
    if spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") == "10000":
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")
