"""Shared pieces of the corpus operators: table access, scratch tables, words."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lodestone.sources.storage import shared_folder

#: A word is a maximal run of anything but space and TAB..CR (bytes.split() splits there too).
WORD_PATTERN = r"[^\x20\x09-\x0D]+"


RUN_BYTES = 8 << 20  # of texts whose words are split at once

_BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch_root(spark: SparkSession) -> str:
    """The folder that the whole cluster shares: spark.checkpoint.dir, or where that is unset a folder in the warehouse."""
    return shared_folder(spark)


def materialize(df: DataFrame, tag: str) -> DataFrame:
    """Write df as Parquet in the shared folder and read it back.

    This cuts the lineage in a place every executor sees, so that a lost executor costs only its
    own tasks, and it makes the next shuffles independent of how df was partitioned.
    """
    spark = df.sparkSession
    path = f"{scratch_root(spark)}/{tag}-{uuid.uuid4().hex}"
    schema = T.StructType([T.StructField(f.name, f.dataType, True) for f in df.schema.fields])
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")  # what was shuffled for this table goes once it is written
    try:
        df.write.parquet(path)
    finally:
        spark.conf.unset(_CLEANUP) if before is None else spark.conf.set(_CLEANUP, before)
    out = spark.read.schema(schema).parquet(path)
    out._scratch_path = path
    _written.add(path)
    return out


def materialize_counted(df: DataFrame, tag: str, flag: str) -> tuple[DataFrame, int]:
    """The same, and in how many rows flag is true; counted while they are written."""
    seen = Observation()
    out = materialize(df.observe(seen, F.count_if(F.col(flag)).alias("n")), tag)
    return out, seen.get.get("n", 0)


def discard(*frames: DataFrame | None) -> None:
    """Delete scratch tables that nothing reads any more."""
    for df in frames:
        path = getattr(df, "_scratch_path", None)
        if path:
            _delete(df.sparkSession, path)


def materialize_alone(make: Callable[[], DataFrame], tag: str) -> DataFrame:
    """materialize() what make returns, then delete the scratch tables that it left for its result to be read from."""
    before = set(_written)
    out = materialize(make(), tag)
    for path in _written - before - {out._scratch_path}:
        _delete(out.sparkSession, path)
    return out


def _delete(spark: SparkSession, path: str) -> None:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)
    _written.discard(path)


_written: set[str] = set()  # scratch tables that exist


def bound_batches(spark: SparkSession) -> None:
    """Smaller Arrow batches than Spark's default, so that texts of some kilobytes take few MB in each worker; another number stays."""
    if spark.conf.get(_BATCH_ROWS) == "10000":
        spark.conf.set(_BATCH_ROWS, "1000")


def as_bytes(column: pa.Array | pa.ChunkedArray) -> list[bytes | None]:
    return column.cast(pa.binary()).to_pylist()


def split_words(texts: pa.Array, size: int = 500) -> Iterator[tuple[pa.Array, np.ndarray, np.ndarray]]:
    """The different words of each run of texts, the number among these of every word, and where each text's words end.

    A run is size texts or RUN_BYTES, so that a run of long texts takes no more memory than one of short ones.
    """
    for run in runs_of(texts, size):
        lists = pc.ascii_split_whitespace(pc.fill_null(run.cast(pa.large_string()), ""))
        coded = lists.flatten().dictionary_encode()
        yield coded.dictionary, coded.indices.to_numpy(), np.cumsum(pc.list_value_length(lists).to_numpy())
        if run.nbytes > RUN_BYTES // 2:  # else each worker holds on to what its largest run took
            del lists, coded
            pa.default_memory_pool().release_unused()


def runs_of(texts: pa.Array, size: int) -> Iterator[pa.Array]:
    """texts in runs of size rows at most; one of over RUN_BYTES is a single text."""
    total = np.concatenate([[0], np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy())])
    at = 0
    while at < len(texts):
        end = min(at + size, max(int(np.searchsorted(total, total[at] + RUN_BYTES, "right")) - 1, at + 1))
        yield texts.slice(at, end - at)
        at = end


def word_hashes(words: pa.Array) -> np.ndarray:
    """A 64-bit hash of each word's bytes, eight bytes of all words at a time; 0 for empty ones."""
    words = words.cast(pa.large_binary())
    _, offsets, data = words.buffers()
    at = np.frombuffer(offsets, np.int64, len(words) + 1, 8 * words.offset)
    start, left = at[:-1].copy(), np.diff(at)
    h = left.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    raw = np.concatenate([raw[: at[-1]], np.zeros(8, np.uint8)])
    eight = np.ndarray(len(raw) - 7, "<u8", raw, strides=(1,))  # the eight bytes from each place on
    here = np.flatnonzero(left > 0)
    start, left = start[here], left[here]
    while len(here):
        lane = eight[start] & _MASKS[np.minimum(left, 8)]
        x = (h[here] ^ lane) * np.uint64(0xD6E8FEB86659FD93)
        x ^= x >> np.uint64(32)
        x *= np.uint64(0xBF58476D1CE4E5B9)
        h[here] = x ^ (x >> np.uint64(29))
        more = left > 8
        here, start, left = here[more], start[more] + 8, left[more] - 8
    h |= np.uint64(1)
    h[np.diff(at) == 0] = 0
    return h


_MASKS = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)


def hashed_words(texts: pa.Array, normal: Callable[[pa.Array], pa.Array] | None = None) -> Iterator[np.ndarray]:
    """Each text's words as 64-bit hashes of their normal form; words without one are left out."""
    for words, coded, ends in split_words(texts):
        each = word_hashes(normal(words) if normal else words)
        h = each[coded]
        some_empty = not each.all()
        for some in np.split(h, ends[:-1]):
            yield some[some != 0] if some_empty else some


def map_rows(df: DataFrame, columns: list[str], schema: str, row: Callable[..., tuple], text: str | None = None) -> DataFrame:
    """Apply row(*values) -> tuple to every row, a batch of Arrow columns at a time.

    The column named by text reaches row as UTF-8 bytes.
    """
    bound_batches(df.sparkSession)
    target = T._parse_datatype_string(schema) if isinstance(schema, str) else schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        arrow = to_arrow_schema(target)
        for batch in batches:
            for start in range(0, batch.num_rows, 2000):
                part = batch.slice(start, 2000)
                values = [as_bytes(part.column(i)) if c == text else part.column(i).to_pylist() for i, c in enumerate(columns)]
                rows = [row(*v) for v in zip(*values, strict=True)]
                cols = list(zip(*rows, strict=True)) or [[] for _ in arrow]
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, arrow, strict=True)], schema=arrow)

    return df.select(*columns).mapInArrow(run, target)


def labelled_fold(doc_id: str = "doc_id"):
    """crc32 of the id's text modulo 3; rows with 1 are held out of every fit."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % 3
