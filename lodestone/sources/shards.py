"""The two binary layouts as data sources, in both directions.

wfp: shards xx.bin of 21-byte records (3 bytes of the fingerprint, whose first byte is in the name, 16 of the file's id, 2
of the line). mz: shards xxxx.mz of records (14 bytes of the id, which starts in the name, a length, zlib data). Readers
seek to ranges of wfp shards and go through mz shards a record at a time. Writers append to shards: each task writes whole
new shards beside the folder's files, commit puts them in place, and a failed job leaves the folder as it was.
"""

from __future__ import annotations

import hashlib
import struct
import uuid
import zlib
from collections.abc import Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition, WriterCommitMessage
from pyspark.sql.types import StructType

from lodestone.sources.storage import bound_batches, delete_folder, files_below, opened, pieces, replace

WFP_BYTES, MZ_HEAD = 21, 18  # of a record; of a record before its data
BATCH_BYTES = 4 << 20
MZ_FILES, MOVES = 256, 16  # small shards that one task reads at most; files moved at a time on commit
_HEX = np.frombuffer(b"0123456789abcdef", np.uint8)
WFP_SCHEMA = "wfp long, file_id string, line int"
MZ_SCHEMA = "file_id string, content binary, shard string, at long, error string"


@dataclass
class Range(InputPartition):
    file: str
    size: int
    start: int
    end: int


@dataclass
class Files(InputPartition):
    files: list[tuple[str, int]]


def hex_strings(raw: np.ndarray) -> pa.Array:
    """Each row of bytes in hexadecimal digits."""
    n, width = raw.shape
    digits = np.empty((n, width, 2), np.uint8)
    digits[:, :, 0], digits[:, :, 1] = _HEX[raw >> 4], _HEX[raw & 15]
    ends = np.arange(n + 1, dtype=np.int32) * (2 * width)
    return pa.StringArray.from_buffers(n, pa.py_buffer(ends), pa.py_buffer(digits))


def shard_name(file: str) -> str:
    return file.rpartition("/")[2].partition(".")[0]


class WfpReader(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        self.root, self.split = options["path"], int(options.get("splitbytes", 64 << 20))

    def partitions(self) -> Sequence[Range]:
        out, step = [], max(self.split // WFP_BYTES, 1) * WFP_BYTES
        for file, size in files_below(self.root, "*.bin"):
            if size % WFP_BYTES:
                raise ValueError(f"{file} is no table of {WFP_BYTES}-byte records")
            out += [Range(file, size, k, min(k + step, size)) for k in range(0, size, step)]
        return out

    def read(self, partition: Range) -> Iterator[pa.RecordBatch]:
        system, path = opened(partition.file)
        first, at = int(shard_name(path), 16), partition.start
        with system.open_input_file(path) as handle:
            while at < partition.end:
                handle.seek(at)
                data = handle.read(min(partition.end - at, BATCH_BYTES // WFP_BYTES * WFP_BYTES))
                at += len(data)
                raw = np.frombuffer(data, np.uint8).reshape(-1, WFP_BYTES)
                head, line = raw[:, :3].astype(np.int64), raw[:, 19:].astype(np.int32)
                wfp = (first << 24) | (head[:, 0] << 16) | (head[:, 1] << 8) | head[:, 2]
                yield pa.RecordBatch.from_arrays([pa.array(wfp), hex_strings(raw[:, 3:19]), pa.array(line[:, 0] | line[:, 1] << 8)], names=["wfp", "file_id", "line"])


def mz_records(system: fs.FileSystem, path: str, size: int) -> Iterator[tuple[str | None, bytes | None, int, str | None]]:
    """Id, content, place and error of each record.

    A record whose data can't be unpacked has no content. Where a record's length runs past the end, the next place whose
    record holds what its id says is looked for, and what lies between is reported without an id.
    """
    head = shard_name(path)
    with system.open_input_file(path) as handle:

        def record(at: int) -> tuple[str, int, bytes | None] | None:
            """Id, length and content at a place; None if it runs past the end."""
            handle.seek(at)
            start = handle.read(MZ_HEAD)
            if len(start) < MZ_HEAD:
                return None
            (n,) = struct.unpack_from("<I", start, 14)
            if at + MZ_HEAD + n > size:
                return None
            try:
                content = zlib.decompress(handle.read(n)).removesuffix(b"\0")
            except zlib.error:
                content = None
            return head + start[:14].hex(), n, content

        def resumed(at: int) -> int:
            """The next place from at on where a record is whole, or the end."""
            overlap = MZ_HEAD + 2
            while at + overlap <= size:
                handle.seek(at)
                data = np.frombuffer(handle.read(BATCH_BYTES), np.uint8).astype(np.int32)
                starts = np.flatnonzero((data[MZ_HEAD:-1] == 0x78) & ((data[MZ_HEAD:-1] * 256 + data[MZ_HEAD + 1 :]) % 31 == 0))
                for k in starts.tolist():
                    found = record(at + k)
                    if found and found[2] is not None and hashlib.md5(found[2]).hexdigest()[4:] == found[0][4:]:
                        return at + k
                at += max(len(data) - overlap + 1, 1)
            return size

        at = 0
        while at < size:
            found = record(at)
            if found is None:
                place = resumed(at + 1)
                handle.seek(at)
                start = handle.read(14)
                last = place == size and size - at >= MZ_HEAD
                yield head + start.hex() if last else None, None, at, "a record that is cut off" if last else f"{place - at} bytes that are no record"
                at = place
            else:
                file_id, n, content = found
                yield file_id, content, at, None if content is not None else "data that can't be unpacked"
                at += MZ_HEAD + n


class MzReader(DataSourceReader):
    """A task reads several shards, up to splitBytes or MZ_FILES of them, as there may be 65,536."""

    def __init__(self, options: dict[str, str]):
        self.root, self.split = options["path"], int(options.get("splitbytes", 16 << 20))

    def partitions(self) -> Sequence[Files]:
        out, room = [], 0
        for file, size in files_below(self.root, "*.mz"):
            if not out or size > room or len(out[-1].files) == MZ_FILES:
                out.append(Files([]))
                room = self.split
            out[-1].files.append((file, size))
            room -= size
        return out

    def read(self, partition: Files) -> Iterator[pa.RecordBatch]:
        names, types = ["file_id", "content", "shard", "at", "error"], [pa.string(), pa.binary(), pa.string(), pa.int64(), pa.string()]
        some, held = [], 0
        batch = lambda: pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*some), types)], names=names)  # noqa: B905, E731
        for file, size in partition.files:
            system, path = opened(file)
            for file_id, content, at, error in mz_records(system, path, size):
                some.append((file_id, content, shard_name(path), at, error))
                held += len(content or b"")
                if held > BATCH_BYTES or len(some) == 1000:
                    yield batch()
                    some, held = [], 0
        if some:
            yield batch()


@dataclass
class Shards(WriterCommitMessage):
    made: list[tuple[str, str, int]]  # temporary name, name, records


class ShardWriter(DataSourceArrowWriter):
    """Rows (shard, data), dealt by shard, to files shard + suffix. Appends unless overwrite."""

    def __init__(self, path: str, suffix: str, overwrite: bool):
        self.path, self.suffix, self.overwrite = path.rstrip("/"), suffix, overwrite
        self.temporary = f"{self.path}/_temporary-{uuid.uuid4().hex}"

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Shards:
        system, folder = opened(self.temporary)
        _, target = opened(self.path)
        system.create_dir(folder, recursive=True)
        task, made, handle = TaskContext.get().taskAttemptId(), [], None
        try:
            for batch in iterator:
                data = batch.column("data").cast(pa.large_binary())
                ends = np.frombuffer(data.buffers()[1], np.int64)[data.offset : data.offset + len(data) + 1] if len(data) else np.zeros(1, np.int64)
                runs, at = pc.run_end_encode(batch.column("shard")), 0  # rows of one shard lie together
                for shard, end in zip(runs.values.to_pylist(), runs.run_ends.to_pylist(), strict=True):
                    if not made or shard + self.suffix != made[-1][1]:
                        if handle is not None:
                            handle.close()
                        made.append((f"{task}-{len(made)}", shard + self.suffix, 0))
                        handle = system.open_output_stream(f"{folder}/{made[-1][0]}")
                        if not self.overwrite and system.get_file_info(f"{target}/{made[-1][1]}").is_file:
                            with system.open_input_stream(f"{target}/{made[-1][1]}") as old:
                                for piece in pieces(old):
                                    handle.write(piece)
                    handle.write(data.buffers()[2].slice(int(ends[at]), int(ends[end] - ends[at])))
                    made[-1] = (*made[-1][:2], made[-1][2] + end - at)
                    at = end
        finally:
            if handle is not None:
                handle.close()
        return Shards(made)

    def commit(self, messages: list[Shards | None]) -> None:
        made = [m for message in messages if message is not None for m in message.made]
        if len({name for _, name, _ in made}) < len(made):
            raise ValueError("rows of one shard are apart; deal and sort by shard")
        if self.overwrite:
            for old, _ in files_below(self.path, "*" + self.suffix):
                system, path = opened(old)
                system.delete_file(path)
        with ThreadPoolExecutor(MOVES) as pool:
            list(pool.map(lambda m: replace(f"{self.temporary}/{m[0]}", f"{self.path}/{m[1]}"), made))
        delete_folder(self.temporary)

    def abort(self, messages: list[Shards | None]) -> None:
        delete_folder(self.temporary)


class WfpSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "wfp"

    def schema(self) -> str:
        return WFP_SCHEMA

    def reader(self, schema: StructType) -> WfpReader:
        return WfpReader({k.lower(): v for k, v in self.options.items()})

    def writer(self, schema: StructType, overwrite: bool) -> ShardWriter:
        return ShardWriter(self.options["path"], ".bin", overwrite)


class MzSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "mz"

    def schema(self) -> str:
        return MZ_SCHEMA

    def reader(self, schema: StructType) -> MzReader:
        return MzReader({k.lower(): v for k, v in self.options.items()})

    def writer(self, schema: StructType, overwrite: bool) -> ShardWriter:
        return ShardWriter(self.options["path"], ".mz", overwrite)


def _format(spark: SparkSession, source: type[DataSource]) -> str:
    spark.dataSource.register(source)
    return source.name()


def read_wfp(spark: SparkSession, path: str, **options) -> DataFrame:
    """wfp, file_id, line of binary shards xx.bin."""
    return spark.read.format(_format(spark, WfpSource)).options(**options).load(path)


def read_mz(spark: SparkSession, path: str, report: bool = False, **options) -> DataFrame:
    """file_id, content of archive shards xxxx.mz; a damaged record has a null content, which archive.verdicts() calls corrupted.

    With report, shard, at and error too, and a row without an id for bytes that are no record.
    """
    rows = spark.read.format(_format(spark, MzSource)).options(**options).load(path)
    return rows if report else rows.where("file_id IS NOT NULL").select("file_id", "content")


def _write(rows: DataFrame, order: list[str], path: str, source: type[DataSource], mode: str) -> None:
    bound_batches(rows.sparkSession)
    dealt = rows.repartition("shard").sortWithinPartitions("shard", *order).select("shard", "data")
    dealt.write.format(_format(rows.sparkSession, source)).mode(mode).save(path)


def write_wfp(wfps: DataFrame, path: str, mode: str = "append") -> None:
    """Binary shards xx.bin of 21-byte records; those of one call are sorted."""
    two = F.unhex(F.substring(F.lpad(F.hex("line"), 4, "0"), -4, 4))
    low_first = F.concat(F.substring(two, 2, 1), F.substring(two, 1, 1))
    low = F.unhex(F.substring(F.lpad(F.hex("wfp"), 8, "0"), -6, 6))
    shard = F.lower(F.lpad(F.hex(F.shiftright("wfp", 24)), 2, "0"))
    rows = wfps.select(shard.alias("shard"), F.concat(low, F.unhex("file_id"), low_first).alias("data"), "wfp", "file_id", "line")
    _write(rows, ["wfp", "file_id", "line"], path, WfpSource, mode)


def write_mz(archive: DataFrame, path: str, mode: str = "append") -> None:
    """Archive shards xxxx.mz of compressed contents."""

    @F.arrow_udf("binary")
    def record(ids: pa.Array, contents: pa.Array) -> pa.Array:
        out = []
        for file_id, content in zip(ids, contents, strict=True):  # one content at a time beside Arrow's
            data = zlib.compress(content.as_py() + b"\0")
            out.append(bytes.fromhex(file_id.as_py())[2:] + struct.pack("<I", len(data)) + data)
        return pa.array(out, pa.binary())

    rows = archive.select(F.substring("file_id", 1, 4).alias("shard"), record("file_id", F.col("content").cast("binary")).alias("data"), "file_id")
    _write(rows, ["file_id"], path, MzSource, mode)
