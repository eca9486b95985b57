"""Packed archives as a data source: spark.read.format("archive").load(folder).

Rows: archive, archive_id (MD5 of the archive), path, part, content, error. A task streams the members of an archive and
holds one of them, so archives of any size are read where tasks run; zip files over splitBytes are dealt to several tasks
by where their members start. Filters on archive and path reach the reader: archives are left out before they are opened,
members before they are unpacked.

Options: splitBytes (256 MB), maxMemberBytes (512 MB: a larger member is an error row, unless partBytes is given),
partBytes (0: whole members; else members come in parts, numbered from 0), ids (true; false leaves archive_id null and
saves reading each archive once more for it), minBytes (1: smaller archives are error rows), password, pathGlobFilter,
hidden (false).

The same format writes: rows (archive, path, content), dealt by archive, become zip or tar.gz files by the archive's
ending; they appear together when all tasks are done, and not at all where one fails.
"""

from __future__ import annotations

import bz2
import gzip
import hashlib
import io
import lzma
import tarfile
import uuid
import zipfile
import zlib
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, EqualTo, Filter, In, InputPartition, StringContains, StringEndsWith, StringStartsWith, WriterCommitMessage
from pyspark.sql.types import StructType

from lodestone.sources.storage import PIECE, Input, bound_batches, delete_folder, files_below, opened, pieces, replace

# Endings of archives that are unpacked, by the way they are unpacked.
ZIPPED = (".zip", ".jar", ".aar", ".egg", ".war", ".whl", ".nupkg")
TARRED = (".tar.gz", ".tar.xz", ".tar.bz2", ".tgz", ".tar")
SINGLE = {".bz2": bz2.open, ".xz": lzma.open, ".gz": gzip.open}
GEM, GEM_DATA = ".gem", "data.tar.gz"  # a tar file, in which this member holds the files
UNSUPPORTED = (".7z", ".rar")

SCHEMA = "archive string, archive_id string, path string, part int, content binary, error string"
BATCH_BYTES = 4 << 20
BROKEN = (OSError, zipfile.BadZipFile, tarfile.TarError, lzma.LZMAError, EOFError, zlib.error, RuntimeError, NotImplementedError)


class Unreadable(Exception):
    pass


def wanted_always(path: str) -> bool:
    return True


def members(name: str, handle, wanted=wanted_always, password: str | None = None, start: int = 0, end: int | None = None) -> Iterator[tuple[str, int | None, io.BufferedIOBase]]:
    """Path, size (where it's known) and an open stream of each member, or of the file itself if it is no archive.

    Of a zip file, only members whose data start from start up to end. Unreadable where something can't be opened.
    """
    low = name.lower()
    if low.endswith(UNSUPPORTED):
        raise Unreadable("packed in a way that isn't supported")
    try:
        if low.endswith(ZIPPED):
            with zipfile.ZipFile(handle) as z:
                for i in z.infolist():
                    if not i.is_dir() and i.header_offset >= start and (end is None or i.header_offset < end) and wanted(i.filename):
                        with z.open(i, pwd=password.encode() if password else None) as stream:
                            yield i.filename, i.file_size, stream
        elif low.endswith(TARRED):
            with tarfile.open(fileobj=handle, mode="r|*", stream=True) as t:
                for m in t:
                    if m.isfile() and wanted(m.name):
                        yield m.name, m.size, t.extractfile(m)
        elif low.endswith(GEM):
            with tarfile.open(fileobj=handle, mode="r|") as outer:
                for data in outer:
                    if data.name == GEM_DATA:
                        yield from members(GEM_DATA, outer.extractfile(data), wanted)
        elif ending := next((e for e in SINGLE if low.endswith(e)), None):
            inner = name.rpartition("/")[2][: -len(ending)]
            if wanted(inner):
                with SINGLE[ending](handle) as stream:
                    yield inner, None, stream
        elif wanted(name.rpartition("/")[2]):
            yield name.rpartition("/")[2], None, handle
    except BROKEN as e:
        raise Unreadable(str(e) or type(e).__name__) from e  # RuntimeError: encrypted; NotImplementedError: an unknown compression


def matches(f: Filter, value: str) -> bool:
    if isinstance(f, EqualTo):
        return value == f.value
    if isinstance(f, In):
        return value in f.value
    if isinstance(f, StringStartsWith):
        return value.startswith(f.value)
    if isinstance(f, StringEndsWith):
        return value.endswith(f.value)
    return f.value in value


@dataclass
class Piece(InputPartition):
    """An archive, or of a zip file the members that start in a range of its bytes."""

    archive: str
    size: int
    start: int
    end: int | None


class ArchiveReader(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        known = {k.lower(): v for k, v in options.items()}
        self.root = known["path"]
        self.pattern, self.hidden = known.get("pathglobfilter", "*"), known.get("hidden", "false") == "true"
        self.split, self.largest = int(known.get("splitbytes", 256 << 20)), int(known.get("maxmemberbytes", 512 << 20))
        self.part, self.least = int(known.get("partbytes", 0)), int(known.get("minbytes", 1))
        self.ids, self.password = known.get("ids", "true") == "true", known.get("password")
        self.on_archive: list[Filter] = []
        self.on_path: list[Filter] = []

    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:
        for f in filters:
            place = {("archive",): self.on_archive, ("path",): self.on_path}.get(getattr(f, "attribute", None))
            if place is not None and isinstance(f, (EqualTo, In, StringStartsWith, StringEndsWith, StringContains)):
                place.append(f)
            else:
                yield f

    def partitions(self) -> Sequence[Piece]:
        out = []
        for archive, size in files_below(self.root, self.pattern, self.hidden):
            if all(matches(f, archive) for f in self.on_archive):
                n = max(1, -(-size // self.split)) if archive.lower().endswith(ZIPPED) else 1
                out += [Piece(archive, size, size * k // n, size * (k + 1) // n if k + 1 < n else None) for k in range(n)]
        return out

    def wanted(self, path: str) -> bool:
        return all(matches(f, path) for f in self.on_path)

    def rows(self, piece: Piece) -> Iterator[tuple]:
        """path, part, content, error."""
        # A row without a path passes no filter on paths, so errors are told only where there is none.
        failed = lambda path, text: [] if path is None and self.on_path else [(path, 0, None, text)]
        if piece.size < self.least:
            yield from failed(None, f"under {self.least} bytes")
            return
        system, path = opened(piece.archive)
        try:
            with system.open_input_file(path) as handle:
                for name, size, stream in members(piece.archive, io.BufferedReader(Input(handle, piece.size), PIECE), self.wanted, self.password, piece.start, piece.end):
                    if self.part:
                        k = 0
                        while (data := stream.read(self.part)) or k == 0:
                            yield name, k, data, None
                            k += 1
                    elif size is not None and size > self.largest:
                        yield from failed(name, f"{size} bytes, more than {self.largest}")
                    else:
                        data = stream.read(self.largest + 1)
                        yield from failed(name, f"more than {self.largest} bytes") if len(data) > self.largest else [(name, 0, data, None)]
        except (Unreadable, *BROKEN) as e:
            yield from failed(None, str(e) or type(e).__name__)

    def digest(self, archive: str) -> str:
        system, path = opened(archive)
        md5 = hashlib.md5()
        with system.open_input_stream(path) as handle:
            for data in pieces(handle):
                md5.update(data)
        return md5.hexdigest()

    def read(self, partition: Piece) -> Iterator[pa.RecordBatch]:
        types = [pa.string(), pa.string(), pa.string(), pa.int32(), pa.binary(), pa.string()]
        names = ["archive", "archive_id", "path", "part", "content", "error"]
        key, some, size = None, [], 0
        batch = lambda: pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*some), types)], names=names)  # noqa: B905, E731
        for row in self.rows(partition):
            if key is None and self.ids:
                key = self.digest(partition.archive)
            some.append((partition.archive, key, *row))
            size += len(row[2] or b"")
            if size > BATCH_BYTES or len(some) == 1000:
                yield batch()
                some, size = [], 0
        if some:
            yield batch()


@dataclass
class Written(WriterCommitMessage):
    archives: list[str]


class ArchiveWriter(DataSourceArrowWriter):
    def __init__(self, path: str, overwrite: bool):
        self.path, self.overwrite = path.rstrip("/"), overwrite
        self.temporary = f"{self.path}/_temporary-{uuid.uuid4().hex}"

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        system, folder = opened(self.temporary)
        system.create_dir(folder, recursive=True)
        task, done, now, packed, handle = TaskContext.get().taskAttemptId(), [], None, None, None
        for batch in iterator:
            for name, path, scalar in zip(batch.column("archive").to_pylist(), batch.column("path").to_pylist(), batch.column("content"), strict=True):
                content = scalar.as_py()  # one at a time beside Arrow's
                if name != now:
                    if packed is not None:
                        packed.close()
                        handle.close()
                    if name in done:
                        raise ValueError(f"rows of {name} are apart; deal and sort by archive")
                    if not name.endswith((".zip", ".tar.gz")):
                        raise ValueError(f"{name}: only .zip and .tar.gz are written")
                    now = name
                    done.append(name)
                    handle = system.open_output_stream(f"{folder}/{task}-{len(done) - 1}")
                    packed = zipfile.ZipFile(_Unseekable(handle), "w", zipfile.ZIP_DEFLATED) if name.endswith(".zip") else tarfile.open(fileobj=handle, mode="w|gz")
                if isinstance(packed, zipfile.ZipFile):
                    packed.writestr(zipfile.ZipInfo(path, (2000, 1, 1, 0, 0, 0)), content, zipfile.ZIP_DEFLATED)
                else:
                    info = tarfile.TarInfo(path)
                    info.size = len(content)
                    packed.addfile(info, io.BytesIO(content))
                    packed.members.clear()  # which tarfile would keep of every member
        if packed is not None:
            packed.close()
            handle.close()
        return Written([f"{task}-{k}/{name}" for k, name in enumerate(done)])

    def commit(self, messages: list[Written | None]) -> None:
        found = [entry.split("/", 1) for m in messages if m is not None for entry in m.archives]
        names = [name for _, name in found]
        if len(set(names)) < len(names):
            raise ValueError("rows of one archive were written by several tasks; deal them by archive")
        if self.overwrite:
            for old, _ in files_below(self.path) if names or messages else []:
                system, path = opened(old)
                system.delete_file(path)
        for made, name in found:
            replace(f"{self.temporary}/{made}", f"{self.path}/{name}")
        delete_folder(self.temporary)

    def abort(self, messages: list[Written | None]) -> None:
        delete_folder(self.temporary)


class _Unseekable(io.RawIOBase):
    """An output stream that zipfile writes to from front to end."""

    def __init__(self, handle):
        self.handle, self.at = handle, 0

    def writable(self) -> bool:
        return True

    def write(self, data) -> int:
        self.handle.write(data)
        self.at += len(data)
        return len(data)

    def seekable(self) -> bool:
        return False


class ArchiveSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "archive"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema: StructType) -> ArchiveReader:
        return ArchiveReader(dict(self.options))

    def writer(self, schema: StructType, overwrite: bool) -> ArchiveWriter:
        return ArchiveWriter(dict(self.options)["path"], overwrite)


def register(spark: SparkSession) -> None:
    """Make the format known, and let filters reach it."""
    spark.dataSource.register(ArchiveSource)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")


def read_archives(spark: SparkSession, path: str, **options) -> DataFrame:
    """archive, archive_id, path, part, content, error of the members of every archive at or below path."""
    register(spark)
    return spark.read.format("archive").options(**options).load(path)


def write_archives(files: DataFrame, path: str, mode: str = "append") -> None:
    """Pack files (archive, path, content: bytes) into archives of those names below path."""
    register(files.sparkSession)
    bound_batches(files.sparkSession)
    rows = files.select("archive", "path", files["content"].cast("binary").alias("content"))
    rows.repartition("archive").sortWithinPartitions("archive", "path").write.format("archive").mode(mode).save(path)
