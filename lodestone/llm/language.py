"""Language identification by error-correcting output codes.

Each language has a codeword. For each bit a binary classifier over hashed byte n-grams of the text's words, lower case
with their ends marked, tells the languages with a 1 there from those with a 0. A text's bits are real margins; each
codeword costs the logistic losses of its bits, weighted by how well a bit's classifier did on rows it was not fitted on,
and the nearest codeword wins. A text whose second best is nearly as near is flagged as ambiguous.

Counts of languages come from all learnable rows; classifiers are fitted on the driver on a bounded sample of MAX_TRAIN
texts, an equal share a language, each as a whole and as a short piece of it, so that short texts are learnt too. What is
collected and broadcast is bounded by MAX_TRAIN, WIDTH and BITS. Texts are told where they lie: nothing is shuffled.

Defined results: und and score 0 if the text is null or has no letter, or nothing can be learnt; one learnt language is
what every text with a letter is, with score 1; rows with a null lang or doc_id, and held-out ones, are not learnt from; a
null doc_id is held in; of more languages than MAX_LANGUAGES the most frequent are learnt (ties: the least name); repeated
rows count each; empty tables give no rows; other columns are ignored.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lodestone.llm.common import bound_batches, labelled_fold, runs_of

MAX_TRAIN, MAX_LANGUAGES = 2000, 250  # texts to fit on; languages to learn
WIDTH, GRAMS, BITS = 1 << 12, (1, 2, 3, 4), 63  # hashed n-grams, their lengths, most bits of a codeword
STEPS, RATE, DECAY, PIECE = 250, 0.5, 1e-4, 6  # of the fit; words of a piece
AMBIGUOUS = 0.2  # least lead of the best score over the second
NONE = "und"

_LETTERS = np.full(256, 32, np.uint8)
_LETTERS[128:] = np.arange(128, 256)
_LETTERS[97:123] = np.arange(97, 123)
_LETTERS[65:91] = np.arange(97, 123)


def grams(text: bytes) -> np.ndarray:
    """Counts of a text's n-grams by bucket; an n-gram has no blank but at its ends, runs of other bytes are one blank."""
    raw = _LETTERS[np.frombuffer(b" " + text + b" ", np.uint8)]
    blank = raw == 32
    raw = raw[~(blank & np.append(False, blank[:-1]))]
    blank = (raw == 32).astype(np.int8)
    out = np.zeros(WIDTH, np.int64)
    h = np.zeros(len(raw), np.uint32)
    for n in range(1, max(GRAMS) + 1):
        if len(raw) < n:
            break
        h = h[: len(raw) - n + 1] * np.uint32(0x01000193) ^ raw[n - 1 :]
        if n in GRAMS:
            # Blanks inside: neither the first nor the last byte; alone they are no n-gram.
            inside = np.cumsum(np.append(0, blank))
            bare = inside[n - 1 : len(raw)] - inside[1 : len(raw) - n + 2] if n > 1 else blank
            mixed = h[bare <= 0] * np.uint32(0x9E3779B1)
            out += np.bincount(mixed >> np.uint32(32 - 12), minlength=WIDTH)
    return out


def table_of(texts: list[bytes]) -> np.ndarray:
    """A row for each text: roots of the shares of its n-grams."""
    counts = np.array([grams(t) for t in texts], np.float32).reshape(-1, WIDTH)
    return np.sqrt(counts / np.maximum(counts.sum(1, keepdims=True), 1))


def codewords(k: int) -> np.ndarray:
    """k codewords of 1 and -1: all ways to part up to five languages, else of many random ones those furthest apart."""
    if k < 2:
        return np.zeros((k, 0), np.float32)
    if k <= 5:
        columns = [c for c in itertools.product((1, -1), repeat=k) if c[0] == 1 and -1 in c]
        return np.array(columns, np.float32).reshape(-1, k).T
    rng, best = np.random.default_rng(k), (-1, None)
    n = min(BITS, math.ceil(10 * math.log2(k)))
    for _ in range(100):
        code = rng.choice(np.array([1, -1], np.float32), (k, n))
        code[0, np.abs(code.sum(0)) == k] *= -1
        near = (n - code @ code.T) / 2 + n * np.eye(k)
        best = max(best, (float(near.min()), code), key=lambda x: x[0])
    return best[1]


@dataclass
class Model:
    languages: list[str]
    code: np.ndarray
    weights: np.ndarray  # WIDTH + 1 rows, the last of them the offsets
    trust: np.ndarray

    def scores(self, x: np.ndarray) -> np.ndarray:
        """A row's share of each language: its codeword's weighted loss against those of the others."""
        if not len(self.languages):
            return np.zeros((len(x), 0))
        if len(self.languages) == 1:
            return np.ones((len(x), 1))
        margin = (x @ self.weights[:-1] + self.weights[-1]).astype(np.float64)
        loss = np.logaddexp(0, -margin) @ ((self.code > 0) * self.trust).T + np.logaddexp(0, margin) @ ((self.code < 0) * self.trust).T
        share = np.exp(loss.min(1, keepdims=True) - loss)
        return share / share.sum(1, keepdims=True)


def fit(x: np.ndarray, y: np.ndarray, languages: list[str]) -> Model:
    """Logistic regression for all bits at once by accelerated gradient steps; every fifth row only weighs the bits."""
    code = codewords(len(languages))
    weights = np.zeros((WIDTH + 1, code.shape[1]), np.float32)
    if len(languages) < 2:
        return Model(languages, code, weights, np.ones(code.shape[1]))
    share = np.bincount(y, minlength=len(languages))
    weight = np.minimum(len(y) / (len(languages) * np.maximum(share, 1)), 10).astype(np.float32)[y][:, None]
    aside = np.arange(len(y)) % 5 == 4
    goal, learn = code[y], ~aside
    # Rows have length one; columns are scaled by their spread, so that rare n-grams are learnt as fast as frequent ones.
    scale = 1 / (x[learn].std(0) + 0.01)
    scaled, goals, part = x[learn] * scale, goal[learn], weight[learn]
    step = RATE * len(scaled) / max(float((scaled * scaled).sum()), 1.0)
    now, before = weights.copy(), weights.copy()
    for t in range(STEPS):
        ahead = now + (t / (t + 3)) * (now - before)
        slope = -goals * part / (1 + np.exp(np.clip(goals * (scaled @ ahead[:-1] + ahead[-1]), -30, 30)))
        gradient = np.vstack([scaled.T @ slope, slope.sum(0, keepdims=True)]) / len(scaled) + DECAY * ahead
        now, before = ahead - 4 * step * gradient, now
    weights[:-1], weights[-1] = now[:-1] * scale[:, None], now[-1]
    seen = aside if aside.any() else learn
    wrong = ((x[seen] @ weights[:-1] + weights[-1]) * goal[seen] <= 0).mean(0)
    trust = np.log((1 - wrong + 0.01) / (wrong + 0.01))
    return Model(languages, code, weights, np.maximum(trust, 0.01))


def piece(text: bytes, place: int) -> bytes:
    """PIECE words of a text from a place on that a number stands for."""
    words = text.split()
    at = place % max(1, len(words) - PIECE + 1)
    return b" ".join(words[at : at + PIECE])


def train(docs: DataFrame, max_train: int = MAX_TRAIN, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> Model:
    """Fit on at most max_train rows with a language outside the held-out fold, an equal share of them for each."""
    bound_batches(docs.sparkSession)
    known = docs.where((labelled_fold(id_col) != 1) & F.col(lang_col).isNotNull() & F.col(text_col).rlike(r"\p{L}"))
    known = known.select(F.col(lang_col).cast("string").alias("lang"), F.xxhash64(F.col(id_col).cast("string")).alias("hash"), F.col(text_col).alias("text"))
    counts = known.groupBy("lang").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "lang").limit(MAX_LANGUAGES).collect()
    if not counts:
        return fit(np.zeros((0, WIDTH), np.float32), np.zeros(0, np.int64), [])
    each = max(max_train // len(counts), 1)
    # Twice the share by hash first, then exactly the share: what is sorted and shuffled is about twice the sample.
    rate = F.create_map(*[v for r in counts for v in (F.lit(r.lang), F.lit(min(1.0, 2 * each / r.n)))])
    some = known.where(F.pmod("hash", F.lit(1 << 20)) < F.coalesce(F.try_element_at(rate, F.col("lang")), F.lit(0.0)) * (1 << 20))
    place = F.row_number().over(Window.partitionBy("lang").orderBy("hash", "text"))
    some = some.withColumn("place", place).where(F.col("place") <= each)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k, (text, h) in enumerate(zip(batch.column(1).cast(pa.binary()).to_pylist(), batch.column(2).to_pylist(), strict=True)):
                x = table_of([text, piece(text, h)])
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(k, 1), batch.column(2).slice(k, 1), pa.array([x.tobytes()])], names=["lang", "hash", "x"])

    got = some.select("lang", "text", "hash").mapInArrow(run, "lang string, hash long, x binary").collect()  # at most max_train rows
    got.sort(key=lambda r: (r.hash, r.lang, r.x))
    languages = sorted({r.lang for r in got})
    x = np.concatenate([np.frombuffer(r.x, np.float32).reshape(2, WIDTH) for r in got])
    return fit(x, np.repeat([languages.index(r.lang) for r in got], 2), languages)


def languages(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, held_out, lang_pred, score, second (the next best language) and ambiguous of every whole text."""
    bound_batches(docs.sparkSession)
    spark, kind = docs.sparkSession, docs.schema[id_col].dataType.simpleString()
    shared = spark.sparkContext.broadcast(model)  # WIDTH x BITS numbers at most

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        names = [*m.languages, None]
        for batch in batches:
            best, score, other, unsure = [], [], [], []
            for texts in runs_of(batch.column(2), 256):
                share = m.scores(table_of([t or b"" for t in texts.cast(pa.binary()).to_pylist()]))
                order = np.argsort(-share, 1, kind="stable")[:, :2]
                rows = np.arange(len(share))
                if share.shape[1] > 1:
                    first, second = share[rows, order[:, 0]], share[rows, order[:, 1]]
                    other += order[:, 1].tolist()
                    unsure += (first - second < AMBIGUOUS).tolist()
                else:
                    first = share[:, 0] if share.shape[1] else np.zeros(len(share))
                    other += [-1] * len(share)
                    unsure += [not share.shape[1]] * len(share)
                best += order[:, 0].tolist() if share.shape[1] else [-1] * len(share)
                score += first.tolist()
            lettered = pc.fill_null(batch.column(3), False)
            pick = lambda at: pa.array([names[k] for k in at], pa.string())
            pred = pc.fill_null(pc.if_else(lettered, pick(best), pa.scalar(None, pa.string())), NONE)
            columns = [pred, pc.if_else(lettered, pa.array(score, pa.float64()), 0.0), pc.if_else(lettered, pick(other), pa.scalar(None, pa.string())), pc.if_else(lettered, pa.array(unsure, pa.bool_()), True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *columns], names=[id_col, "held_out", "lang_pred", "score", "second", "ambiguous"])

    held = F.coalesce(labelled_fold(id_col) == 1, F.lit(False)).alias("held_out")
    rows = docs.select(id_col, held, text_col, F.col(text_col).rlike(r"\p{L}").alias("lettered"))
    return rows.mapInArrow(run, f"{id_col} {kind}, held_out boolean, lang_pred string, score double, second string, ambiguous boolean")
