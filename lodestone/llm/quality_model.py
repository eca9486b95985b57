"""Quality classifier: histogram gradient-boosted trees over document statistics.

Every text gives STATISTICS. Trees are grown on a bounded sample of labelled rows: statistics are
binned by the sample's quantiles, and each split comes from histograms of gradients over the bins. The
forest is flattened into arrays (statistic, threshold, children, leaf values), broadcast (its size is
set by trees and depth), and applied to whole Arrow batches: all rows step down a tree at once.

Defined results: null and empty texts have all-zero statistics and get a score too; null labels are
not learnt from; a null doc_id is held in; several labels of one id each count; with no labelled row,
or one class alone, scores are that class's share (0.5 without labels); other columns are ignored.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestone.llm.common import as_bytes, bound_batches, labelled_fold

STATISTICS = (
    "log_words", "word_length", "long_words", "short_words", "distinct_words", "top_word", "capital_letters", "digits",
    "letters", "marks_inside", "pipes", "exclamations", "symbols", "line_length", "distinct_lines", "stops", "repeat_run", "title_words",
)
MAX_TRAIN = 20_000  # labelled rows to fit on, those of least hash
BINS, TREES, DEPTH, RATE, LEAST = 64, 60, 4, 0.15, 8

_INSIDE = re.compile(rb"[A-Za-z]{2,}[^A-Za-z0-9\s\x80-\xff'-]{2,}")


def statistics(text: bytes | None) -> tuple[float, ...]:
    """STATISTICS of a text: shares of its words, characters and lines."""
    words = (text or b"").split()
    if not words:
        return (0.0,) * len(STATISTICS)
    n, counts = len(words), Counter(words)
    size = sum(map(len, words))
    lines = [x for x in text.split(b"\n") if x.strip()]
    plain = text.decode()
    letters = sum(map(str.isalpha, plain))
    run = best = 0
    for a, b in zip(words, words[1:]):
        run = run + 1 if a == b else 0
        best = max(best, run)
    share = lambda marks: sum(map(text.count, marks)) / size
    return (
        float(np.log1p(n)),
        size / n,
        sum(len(w) > 12 for w in words) / n,
        sum(len(w) < 4 for w in words) / n,
        len(counts) / n,
        max(counts.values()) / n,
        sum(map(str.isupper, plain)) / max(1, letters),
        share([b"%d" % d for d in range(10)]),
        letters / max(1, len(plain)),
        len(_INSIDE.findall(text)) / n,
        counts[b"|"] / n,
        share([b"!"]),
        share([b"#", b"*", b"$", b"%", b"&", b"<", b">", b"~", b"^"]),
        n / len(lines),
        len(set(lines)) / len(lines),
        share([b"."]),
        best / n,
        sum(w[:1].isupper() for w in words) / n,
    )


def table_of(texts: list[bytes | None]) -> np.ndarray:
    return np.array([statistics(t) for t in texts], np.float64).reshape(-1, len(STATISTICS))


@dataclass
class Forest:
    """Trees as arrays, TREES rows of 2^(DEPTH+1)-1 nodes; a node with feature -1 is a leaf."""

    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    start: float

    def predict(self, x: np.ndarray) -> np.ndarray:
        total, rows = np.full(len(x), self.start), np.arange(len(x))
        for feature, threshold, left, right, value in zip(self.feature, self.threshold, self.left, self.right, self.value, strict=True):
            node = np.zeros(len(x), np.int64)
            for _ in range(DEPTH):
                f = feature[node]
                below = x[rows, np.maximum(f, 0)] <= threshold[node]
                node = np.where(f < 0, node, np.where(below, left[node], right[node]))
            total += value[node]
        return 1 / (1 + np.exp(-np.clip(total, -30, 30)))


def fit(x: np.ndarray, y: np.ndarray) -> Forest:
    """Boost TREES trees on the logistic loss, splits found in histograms of BINS bins."""
    size = 2 ** (DEPTH + 1) - 1
    shape = (TREES, size)
    forest = Forest(np.full(shape, -1), np.zeros(shape), np.zeros(shape, np.int64), np.zeros(shape, np.int64), np.zeros(shape), 0.0)
    p = min(max(float(y.mean()), 1e-6), 1 - 1e-6) if len(y) else 0.5
    forest.start = float(np.log(p / (1 - p)))
    if len(y) == 0 or y.min() == y.max():
        return forest
    cuts = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, BINS + 1)[1:-1], method="lower")) for f in range(x.shape[1])]
    bins = np.stack([np.searchsorted(c, x[:, f], "left") for f, c in enumerate(cuts)], 1)
    raw = np.full(len(y), forest.start)
    for t in range(TREES):
        prob = 1 / (1 + np.exp(-raw))
        grad, hess = prob - y, prob * (1 - prob)
        level, made = [(0, np.arange(len(y)))], 1
        for depth in range(DEPTH + 1):
            below = []
            for node, rows in level:
                g, h = grad[rows].sum(), hess[rows].sum()
                forest.value[t, node] = -RATE * g / (h + 1)
                best = (1e-6, -1, 0)
                if depth < DEPTH and len(rows) >= 2 * LEAST:
                    for f, cut in enumerate(cuts):
                        if not len(cut):
                            continue
                        b = bins[rows, f]
                        gl, hl, nl = (np.cumsum(np.bincount(b, w, len(cut) + 1))[:-1] for w in (grad[rows], hess[rows], None))
                        gain = gl**2 / (hl + 1) + (g - gl) ** 2 / (h - hl + 1) - g**2 / (h + 1)
                        gain[(nl < LEAST) | (len(rows) - nl < LEAST)] = 0
                        k = int(gain.argmax())
                        best = max(best, (float(gain[k]), f, k))
                if best[1] >= 0:
                    _, f, k = best
                    forest.feature[t, node], forest.threshold[t, node] = f, cuts[f][k]
                    forest.left[t, node], forest.right[t, node] = made, made + 1
                    to_left = bins[rows, f] <= k
                    below += [(made, rows[to_left]), (made + 1, rows[~to_left])]
                    made += 2
                else:
                    raw[rows] += forest.value[t, node]
            level = below
    return forest


def train(docs: DataFrame, labels: DataFrame, label: str = "quality", max_train: int = MAX_TRAIN, id_col: str = "doc_id", text_col: str = "text") -> Forest:
    """Fit on the labelled rows outside the held-out fold, at most max_train of them."""
    bound_batches(docs.sparkSession)
    known = labels.where((labelled_fold(id_col) != 1) & F.col(label).isNotNull())
    known = known.select(F.col(id_col).alias("__id"), F.col(label).cast("int").alias("__y"))
    # max_train bounds what is broadcast here and what the driver collects below.
    some = known.orderBy(F.xxhash64(F.col("__id").cast("string")), "__id", "__y").limit(max_train)
    rows = docs.select(F.col(id_col).alias("__id"), F.col(text_col).alias("__text")).join(F.broadcast(some), "__id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = table_of(as_bytes(batch.column(2)))
            yield pa.RecordBatch.from_arrays([batch.column(0).cast(pa.string()), batch.column(1), pa.array(list(x), pa.list_(pa.float64()))], names=["id", "y", "x"])

    measured = rows.select("__id", "__y", "__text").mapInArrow(run, "id string, y int, x array<double>")
    got = measured.orderBy(F.xxhash64("id"), "id", "y", "x").limit(max_train).toPandas()
    x = np.array(got.x.tolist(), np.float64).reshape(-1, len(STATISTICS))
    return fit(x, got.y.to_numpy(np.float64))


def quality_scores(docs: DataFrame, forest: Forest, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, held_out, score and predicted of every whole text."""
    bound_batches(docs.sparkSession)
    spark, kind = docs.sparkSession, docs.schema[id_col].dataType.simpleString()
    shared = spark.sparkContext.broadcast(forest)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            score = shared.value.predict(table_of(as_bytes(batch.column(2))))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(score), pa.array((score >= 0.5).astype(np.int32))], names=[id_col, "held_out", "score", "predicted"])

    held = F.coalesce(labelled_fold(id_col) == 1, F.lit(False)).alias("held_out")
    return docs.select(id_col, held, text_col).mapInArrow(run, f"{id_col} {kind}, held_out boolean, score double, predicted int")
