"""What is wrong with a dataset's files, told from sizes, tails and record heads, without reading the files whole."""

from __future__ import annotations

from collections.abc import Iterator
from urllib.parse import unquote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestone.functions import values as V
from lodestone.sources.shards import WFP_BYTES, mz_records
from lodestone.sources.storage import opened

TAIL = 64 << 10  # bytes read at once, from a text's end backwards
REPORT = "file string, kind string, size long, records long, problem string, at long"


def listed(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """file (as _metadata.file_path has it) and size of the files at or below path; contents are not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).load(path)
    return files.select(F.col("_metadata.file_path").alias("file"), F.col("length").alias("size"))


def kind_of(file: str) -> str:
    ending = file.rpartition("/")[2].rpartition(".")[2]
    return ending if ending in ("bin", "mz", "json") else "text"


def torn_tail(file: str, size: int) -> bytes | None:
    """What follows the last line end of a text, None if nothing does. Read backwards, no further than that."""
    system, path = opened(unquote(file))
    with system.open_input_file(path) as handle:
        tail, at = b"", size
        while at > 0:
            start = max(at - TAIL if tail else at - 1, 0)
            handle.seek(start)
            tail, at = handle.read(at - start) + tail, start
            if (end := tail.rfind(b"\n")) >= 0:
                return tail[end + 1 :] or None
        return tail or None


def problems(file: str, size: int) -> Iterator[tuple]:
    """REPORT rows of a file: a row for each problem, or one without."""
    kind, found, records = kind_of(file), [], None
    if kind == "text" and (tail := torn_tail(file, size)) is not None:
        found = [("a last line without end", size - len(tail))]
        if len(tail) >= V.MAX_CSV_LINE:
            found.append(("a line too long", size - len(tail)))
    elif kind == "bin":
        records = size // WFP_BYTES
        found = [("a record that is cut off", records * WFP_BYTES)] if size % WFP_BYTES else []
        name = file.rpartition("/")[2][:-4]
        if len(name) != 2 or set(name) - set("0123456789abcdef"):
            found.append(("no shard's name", None))
    elif kind == "mz":
        system, path = opened(unquote(file))
        records = 0
        for file_id, _, at, error in mz_records(system, path, size):
            records += file_id is not None
            if error:
                found.append((error, at))
    for problem, at in found or [(None, None)]:
        yield file, kind, size, records, problem, at


def report(spark: SparkSession, path: str) -> DataFrame:
    """file, kind (text, bin, mz, json), size, records, problem, at: a row for each problem of each file, or one without.

    Empty files, which Spark does not list, have no row. Texts are judged by their ends, wfp shards by their sizes, mz shards record by record.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types = [pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.int64()]
        for batch in batches:
            rows = [row for file, size in zip(*(c.to_pylist() for c in batch.columns), strict=True) for row in problems(file, size)]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names=[x.split()[0] for x in REPORT.split(", ")])

    return listed(spark, path).mapInArrow(run, REPORT)


def torn(spark: SparkSession, path: str) -> DataFrame:
    """file, tail of the texts whose last line has no end."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            tails = [torn_tail(file, size) for file, size in zip(*(c.to_pylist() for c in batch.columns), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(tails, pa.binary())], names=["file", "tail"])

    return listed(spark, path).mapInArrow(run, "file string, tail binary").where("tail IS NOT NULL")
