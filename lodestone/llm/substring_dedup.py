"""Substring dedup with a log-structured fingerprint index.

The input comes in batches of ascending doc_id. Of each batch, window fingerprints go into a run: a
table of its different fingerprints, bucketed and sorted, never changed once written. A batch's own
run is merge-joined with the runs of history, bucket by bucket as they lie; what meets there (or twice
within the batch) is suspect. When FANOUT runs of a level have come together they are merged into one of
the next level, which later batches read instead. Runs live in a folder of the shared store and a snapshot
names those that count, so an index outlasts the session: remove_repeats() takes a new batch against all
batches before it, and reads of their texts only those with a suspect.

A window of WINDOW words is filed under its anchor, the GRAM-word run of least hash inside it: equal
windows have equal anchors, neighbours mostly share one, so the index holds one entry for some seven
words and misses no window. Suspect windows are then verified on hashes of all their words (128
bits) with their places, the first of each is found by a minimum, and every later one marks its words.

Texts equal as a whole are settled before, by a hash of their words: all of a later copy goes.

Defined results: null and empty texts have no words; texts shorter than a window lose nothing; rows of
a null doc_id are one document that comes before all others (in a later batch too, without what was given out
being revised), as do ids below -2^62 - 2^61; rows with equal ids are versions of one document, so a window at the same place in two of them counts once, and each version loses what its own
windows tell; empty tables give an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from functools import reduce
from itertools import compress

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from lodestone.llm.common import as_bytes, bound_batches, discard, hashed_words, materialize, scratch_root
from lodestone.llm.near_dedup import _C
from lodestone.operators import store

WINDOW, GRAM = 20, 8
BATCHES, FANOUT = 3, 2  # the third batch reads the compacted runs of the first two
ENTRY, KEY = "fp long, row long, twice boolean", "fp long, again boolean"
NULL_ROWS = -(2**63) + 2**61  # rows below stand for null ids
_LEVEL = "level-"
_ORDERED = "spark.sql.legacy.bucketedTableScan.outputOrdering"
SPAN = WINDOW - GRAM + 1  # anchors that a window can choose from


def _runs(words: np.ndarray, size: int, salt: int) -> np.ndarray:
    """A 64-bit hash of each run of size words."""
    n = len(words) - size + 1
    h = np.zeros(max(n, 0), np.uint64)
    for k in range(size if n > 0 else 0):
        h += words[k : k + n] * _C[k + salt]
    h ^= h >> np.uint64(32)
    h *= np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


def _sliding(x: np.ndarray, size: int, pick: np.ufunc) -> np.ndarray:
    """The least or largest of each run of size values, by doubling."""
    width = 1
    while 2 * width <= size:
        x, width = pick(x[:-width], x[width:]), 2 * width
    return pick(x[: len(x) - (size - width)], x[size - width :]) if width < size else x


def anchors(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The anchor hash of each window, and the hashes at all places that are an anchor of some window."""
    grams = _runs(words, GRAM, 0)
    if len(grams) < SPAN:
        return np.zeros(0, np.uint64), np.zeros(0, np.uint64)
    least = _sliding(grams, SPAN, np.minimum)
    around = np.concatenate([np.zeros(SPAN - 1, np.uint64), least, np.zeros(SPAN - 1, np.uint64)])
    return least, grams[_sliding(around, SPAN, np.maximum) == grams]


def _row_anchors(df: DataFrame) -> DataFrame:
    """fp, one row for each distinct fingerprint of each row, of df (row, text) with how often it occurs in it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps, rows, twice = [], [], []
            for row, words in zip(batch.column(0).to_pylist(), hashed_words(batch.column(1)), strict=True):
                _, placed = anchors(words)
                if len(placed):
                    fp, n = np.unique(placed, return_counts=True)
                    fps.append(fp)
                    rows.append(np.full(len(fp), row))
                    twice.append(n > 1)
            if fps:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(fps).view(np.int64)), pa.array(np.concatenate(rows), pa.int64()), pa.array(np.concatenate(twice))], names=["fp", "row", "twice"])

    return df.mapInArrow(run, ENTRY)


class FingerprintIndex:
    """Immutable sorted runs of fingerprints, by level, in a folder; adding a batch tells which of its fingerprints are suspect.

    A run holds each fingerprint of its batches once, dealt into buckets and sorted in them, so what a batch has in common
    with it is a merge of files that lie side by side, and so is the compaction of two runs: history is read, never shuffled or
    sorted again. The rows that hold a fingerprint are kept beside the runs as each batch brought them. A snapshot names the
    runs that count and is published after they are written, before others are deleted: a job that dies leaves the index
    as it was.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path
        self.seen = store.snapshot(spark, path)
        levels = [t for n, t in self.seen.tables.items() if n.startswith(_LEVEL)]
        self.buckets = levels[0].buckets if levels else store.buckets_for(spark)

    @property
    def runs(self) -> list[tuple[int, str]]:
        """Level and folder of each run: logarithmic in the number of batches."""
        return [(int(n.removeprefix(_LEVEL)), run) for n, t in self.seen.tables.items() if n.startswith(_LEVEL) for run in t.runs]

    def entries(self) -> DataFrame:
        """fp, row, twice of all batches."""
        return self._entries(self.seen.tables["entries"].runs)

    def _entries(self, folders: list[str]) -> DataFrame:
        return self.spark.read.schema(ENTRY).parquet(*[f"{self.path}/{n}" for n in folders])

    def _table(self, *runs: str) -> store.Table:
        return store.Table("fp", KEY, self.buckets, list(runs))

    def keys(self, run: str) -> DataFrame:
        """fp and again (more than once in the batch) of a run, in its buckets."""
        return store.scan(self.spark, self.path, self._table(run))

    def known(self, run: str) -> DataFrame:
        """The fingerprints of a new run that older ones hold, once for each of these."""
        found = [self.keys(run).select("fp").join(self.keys(old).select("fp"), "fp", "left_semi") for _, old in self.runs]
        return reduce(DataFrame.unionByName, found, self.keys(run).select("fp").where("false"))

    def _write(self, keys: DataFrame) -> str:
        """Write keys, which are dealt by fp already where the session has as many partitions as the index has buckets."""
        dealt = int(self.spark.conf.get("spark.sql.shuffle.partitions")) == self.buckets
        return store.write_run(keys.select("fp", "again"), self.path, "keys", "fp", self.buckets, dealt)

    def add(self, entries: DataFrame) -> DataFrame:
        """Suspect fingerprints (fp) of a batch's entries (fp, row, twice), which become a run.

        Rows must be above those of earlier batches, or stand for null ids.
        """
        batch, ids, real = f"entries/batch-{uuid.uuid4().hex}", Observation(), F.when(~_of_null("row"), F.col("row"))
        entries.observe(ids, F.min(real).alias("least"), F.max(real).alias("most")).write.parquet(f"{self.path}/{batch}")
        least, most, last = ids.get.get("least"), ids.get.get("most"), self.seen.version.get("last")
        if least is not None and last is not None and least <= int(last):
            self._delete(batch)
            raise ValueError(f"the index holds documents up to {last}; those of a later batch must be above, not from {least} on")
        again = (F.count("*") > 1) | F.max("twice")
        run = self._write(self._entries([batch]).groupBy("fp").agg(again.alias("again")))
        with in_file_order(self.spark):
            suspect = materialize(self.keys(run).where("again").select("fp").unionByName(self.known(run)).distinct(), "index-suspect")
            levels = {k: [r for at, r in self.runs if at == k] for k, _ in self.runs}
            levels[0], level = [*levels.get(0, []), run], 0
            while len(levels[level]) >= FANOUT:
                merged = reduce(lambda a, b: a.join(b, "fp", "full_outer"), [self.keys(r).select("fp") for r in levels[level]])
                levels[level + 1] = [*levels.get(level + 1, []), self._write(merged.withColumn("again", F.lit(False)))]
                levels[level], level = [], level + 1
        held = self.seen.tables.get("entries")
        tables = {f"{_LEVEL}{k}": self._table(*runs) for k, runs in levels.items()}
        tables["entries"] = store.Table("fp", ENTRY, self.buckets, [*(held.runs if held else []), batch])
        new = self.seen.next(tables, {"last": str(most)} if most is not None else None)
        store.publish(self.spark, self.path, new)
        self.seen = new
        store.vacuum(self.spark, self.path, keep=1)
        return suspect

    def _delete(self, name: str) -> None:
        at = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}")
        at.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(at, True)

    def drop(self) -> None:
        self._delete("")


@contextmanager
def in_file_order(spark: SparkSession) -> Iterator[None]:
    """What is planned within takes a bucket of a single sorted file as sorted."""
    before = spark.conf.get(_ORDERED)
    spark.conf.set(_ORDERED, "true")
    try:
        yield
    finally:
        spark.conf.set(_ORDERED, before)


def _windows(df: DataFrame) -> DataFrame:
    """w1, w2 (128 bits of a window's words), row, version, at, from rows (row, text, fps: its suspect fingerprints, gone: keys of texts to pass over)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list[np.ndarray]] = [[], [], [], [], []]
            lists, texts = batch.column(2), as_bytes(batch.column(1))
            for k, (row, gone, words) in enumerate(zip(batch.column(0).to_pylist(), batch.column(3).to_pylist(), hashed_words(batch.column(1)), strict=True)):
                if gone and _text_key(texts[k]) in gone:
                    continue
                h, _ = anchors(words)
                suspect = np.sort(lists[k].values.to_numpy().view(np.uint64))
                at = np.flatnonzero(suspect[np.minimum(np.searchsorted(suspect, h), len(suspect) - 1)] == h)
                out[0].append(_runs(words, WINDOW, 0)[at].view(np.int64))
                out[1].append(_runs(words, WINDOW, 24)[at].view(np.int64))
                out[2].append(np.full(len(at), row))
                out[3].append(np.full(len(at), _version(words)))
                out[4].append(at.astype(np.int32))
            if out[0]:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in out], names=["w1", "w2", "row", "version", "at"])

    return df.mapInArrow(run, "w1 long, w2 long, row long, version long, at int")


def _version(words: np.ndarray) -> int:
    """A hash that tells the versions of a document apart."""
    return int(np.uint64(xxhash.xxh3_64_intdigest(words.tobytes())).view(np.int64))


def _text_key(text: bytes | None) -> bytes | None:
    """128 bits of a text's words, whatever separates them; None for texts shorter than a window."""
    words = (text or b"").split()
    return xxhash.xxh3_128_digest(b" ".join(words)) if len(words) >= WINDOW else None


def _keys(df: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(map(_text_key, as_bytes(batch.column(1))), pa.binary())], names=["row", "key"])

    return df.mapInArrow(run, "row long, key binary")


def _rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """id, row (the id; each text of the null id has one of its own below NULL_ROWS, so that it is no hot key), text."""
    of_null = F.lit(-(2**63)) + F.xxhash64(text_col).bitwiseAND(F.lit(2**61 - 1))
    own = F.col(id_col).cast("long")
    return docs.select(own.alias("id"), F.coalesce(own, of_null).alias("row"), F.col(text_col).alias("text"))


def _of_null(row: str) -> Column:
    return F.col(row) < NULL_ROWS


def _place(row: str) -> Column:
    """The document's place in the order: one and the same for all of the null id."""
    return F.when(_of_null(row), F.lit(-(2**63))).otherwise(F.col(row))


def _marks(rows: DataFrame, met: DataFrame) -> DataFrame:
    """row, at (for each version, starts of windows that occur earlier), gone (keys of texts that are later copies as a whole).

    rows: row, text. met: fp, row, the suspects of each row.
    """
    keys = materialize(_keys(rows.select("row", "text")).where("key IS NOT NULL"), "repeat-keys")
    firsts = materialize(keys.groupBy("key").agg(F.min(_place("row")).alias("first"), F.max(_place("row")).alias("last")).where("first < last").select("key", "first"), "repeat-firsts")
    gone = materialize(keys.join(firsts, "key").where(_place("row") > F.col("first")).groupBy("row").agg(F.collect_set("key").alias("gone")), "repeat-gone")
    lists = met.groupBy("row").agg(F.collect_list("fp").alias("fps"))
    # Documents of a single text that is gone are settled; of others, the texts that aren't gone are judged.
    settled = keys.groupBy("row").agg(F.count_distinct("key").alias("n")).join(gone, "row").where(F.col("n") == F.size("gone")).select("row")
    lists = materialize(lists.join(settled, "row", "left_anti").join(gone, "row", "left"), "repeat-lists")
    windows = materialize(_windows(rows.join(lists, "row").select("row", "text", "fps", "gone")), "repeat-windows")
    discard(keys, firsts, lists)
    # Verified on 128 bits of all words: the first place of each sequence that has several.
    place = F.struct(_place("row").alias("row"), "at")
    least = materialize(windows.groupBy("w1", "w2").agg(F.min(place).alias("m"), F.max(place).alias("x")).where("m <> x").select("w1", "w2", "m"), "repeat-least")
    later = windows.join(least, ["w1", "w2"]).where(place != F.col("m")).groupBy("row", "version").agg(F.collect_set("at").alias("at"))
    later = later.groupBy("row").agg(F.collect_list(F.struct("version", "at")).alias("at"))
    marks = materialize(later.join(gone, "row", "full_outer").select("row", "at", "gone"), "repeat-marks")
    discard(windows, least, gone)
    return marks


def repeat_marks(docs: DataFrame, batches: int = BATCHES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The marks of a whole table: an index is made of it batch by batch, and dropped."""
    spark, rows = docs.sparkSession, _rows(docs, id_col, text_col)
    cuts = rows.agg(F.percentile_approx("row", [k / batches for k in range(1, batches)])).first()[0] or [] if batches > 1 else []
    edges = [None, *sorted(set(cuts)), None]
    index, suspects = FingerprintIndex(spark, f"{scratch_root(spark)}/index-{uuid.uuid4().hex}"), []
    for low, high in zip(edges, edges[1:]):
        some = rows
        if low is not None:
            some = some.where(F.col("row") > low)
        if high is not None:
            some = some.where(F.col("row") <= high)
        suspects.append(index.add(_row_anchors(some.select("row", "text"))))
    met = materialize(index.entries().join(reduce(DataFrame.unionByName, suspects).distinct(), "fp").select("row", "fp"), "repeat-met")
    discard(*suspects)
    index.drop()
    marks = _marks(rows, met)
    discard(met)
    return marks


def remove_repeats(batch: DataFrame, before: DataFrame, index: FingerprintIndex, texts: bool = False, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """substring_duplicates() of a batch whose ids are above all those of before, the texts that index holds; index takes the batch in."""
    rows = _rows(batch, id_col, text_col)
    suspects = index.add(_row_anchors(rows.select("row", "text")))
    met = materialize(index.entries().join(suspects, "fp").select("row", "fp"), "repeat-met")
    both = rows.unionByName(_rows(before, id_col, text_col).join(met.select("row").distinct(), "row", "left_semi"))
    marks = _marks(both, met)
    discard(suspects, met)
    return _applied(rows, marks, texts, id_col)


def _kept(words: list[bytes], at, gone: list[bytes] | None, key: bytes | None) -> list[bytes]:
    if gone and key in gone:
        return []
    if at is None or not len(at):
        return words
    cover = np.zeros(len(words) + 1, np.int64)
    at = at[at <= len(words) - WINDOW]
    cover[at] += 1  # places are distinct
    cover[at + WINDOW] -= 1
    return list(compress(words, (np.cumsum(cover[:-1]) == 0).tolist()))


def substring_duplicates(docs: DataFrame, batches: int = BATCHES, texts: bool = False, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_words, n_removed and kept_sha256 of every row; with texts, kept_text too."""
    bound_batches(docs.sparkSession)
    return _applied(_rows(docs, id_col, text_col), repeat_marks(docs, batches, id_col, text_col), texts, id_col)


def _applied(rows: DataFrame, marks: DataFrame, texts: bool, id_col: str) -> DataFrame:
    joined = rows.join(marks, "row", "left").select("id", "text", "at", "gone")

    def run(batches_: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches_:
            out: list[tuple] = []
            for own, text, hashes, at, gone in zip(batch.column(0).to_pylist(), as_bytes(batch.column(1)), hashed_words(batch.column(1)), batch.column(2), batch.column(3).to_pylist(), strict=True):
                words = (text or b"").split()
                mine = _version(hashes) if at.is_valid else None
                places = next((x["at"].values.to_numpy() for x in at.values if x["version"].as_py() == mine), None) if at.is_valid else None
                kept = _kept(words, places, gone, _text_key(text) if gone else None)
                plain = b" ".join(kept)
                out.append((own, len(words), len(words) - len(kept), hashlib.sha256(plain).hexdigest(), *([plain.decode()] if texts else [])))
            columns = list(zip(*out, strict=True)) or [()] * (4 + texts)
            types = [pa.int64()] * 3 + [pa.string()] * (1 + texts)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=[id_col, "n_words", "n_removed", "kept_sha256", "kept_text"][: 4 + texts])

    return joined.mapInArrow(run, f"{id_col} long, n_words long, n_removed long, kept_sha256 string" + ", kept_text string" * texts)
