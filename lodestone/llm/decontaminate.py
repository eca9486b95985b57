"""Benchmark decontamination by latent semantic retrieval and subsequence checks.

1. Document frequencies of hashed words are counted over all documents.
2. A randomised SVD of TF-IDF passages (fit on a bounded sample of documents, FIT_DOCS, and the
   benchmark) gives a latent space: a random test matrix is multiplied by A^T A in Spark, made orthonormal,
   multiplied again and rotated onto its singular vectors; directions are scaled to equal variance.
3. Every passage of every document (WINDOW words, a new one each STRIDE) is searched for every benchmark item: the
   query set, in blocks of BLOCK_BYTES of text, a pass over the documents each. Runs of texts are searched together, an
   item at a time. Pairs of a passage and an item are left out first, exactly, if so few words of the item are
   there or around that no accepted subsequence can be. The others are projected and compared by cosine with the
   item's windows. A passage may hold only a part of an item under WINDOW + STRIDE words, or much besides; these
   items are also searched by passages of NARROW words, a new one each NARROW_STRIDE, against their windows at
   every word.
4. A candidate counts if the longest common subsequence of the item and the words around the passage
   holds VERBATIM of the item, or PARAPHRASE of it and ANSWER of the answer's words. An item's answer is
   its last sentence.

Defined results: null and empty texts hold no passage and are clean; items without MIN_WORDS words
match nothing; repeated items and rows are judged each; a null doc_id stays null; an empty benchmark
leaves all clean; other columns are ignored or ride along.
"""

from __future__ import annotations

import math
import re
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestone.llm.common import bound_batches, discard, hashed_words, materialize

FEATURES, RANK = 1 << 14, 64
WINDOW, STRIDE, ITEM_STRIDE = 32, 16, 4
NARROW, NARROW_STRIDE = 16, 4
MIN_WORDS = 8
COSINE = 0.30
VERBATIM, PARAPHRASE, ANSWER = 0.75, 0.5, 0.6
FIT_DOCS = 4000  # documents of least hash that the latent space is fitted on; all are searched
FIT_TASKS, FIT_ITEMS = 8, 10_000  # tasks of a fit at least, and items for each further task
BLOCK_BYTES = 2 << 20  # text of the items searched for in one pass; their windows take some forty times as much
RUN_WORDS, RUN_TEXTS, RUN_FLAGS = 1 << 18, 1000, 1 << 25  # words and texts that are searched together, and flags of a word and text

_TRIM = ".,;:!?\"'()[]{}"


def _plain(words: pa.Array) -> pa.Array:
    return pc.utf8_lower(pc.utf8_trim(words, characters=_TRIM))


def words_of(texts: pa.Array) -> Iterator[np.ndarray]:
    """Each text's words as hashes, without case and outer punctuation."""
    return hashed_words(texts, _plain)


def features_of(words: np.ndarray) -> np.ndarray:
    return ((words >> np.uint64(20)) & np.uint64(FEATURES - 1)).astype(np.int64)


def document_frequencies(docs: DataFrame, text_col: str) -> tuple[np.ndarray, int]:
    """In how many documents each hashed word occurs, and the number of documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, n = np.zeros(FEATURES, np.int64), 0
        for batch in batches:
            for words in words_of(batch.column(0)):
                mark = np.zeros(FEATURES, bool)
                mark[features_of(words)] = True
                seen += mark
            n += batch.num_rows
        at = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(at, -1)), pa.array(np.append(seen[at], n))], names=["feature", "n"])

    rows = docs.select(text_col).mapInArrow(run, "feature long, n long").groupBy("feature").agg(F.sum("n").alias("n")).collect()  # FEATURES + 1 at most
    df = np.zeros(FEATURES, np.int64)
    for r in rows:
        if r.feature >= 0:
            df[r.feature] = r.n
    return df, next((r.n for r in rows if r.feature < 0), 0)


def passage_starts(n: int, stride: int = STRIDE, overlap: int = WINDOW - STRIDE) -> np.ndarray:
    """Starts of a text's passages; the last one may be shorter."""
    return np.arange(0, max(n - overlap, 1), stride)


def _passages(features: np.ndarray, starts: np.ndarray, width: int, matrix: np.ndarray) -> np.ndarray:
    """The vectors of the passages of width words at starts: sums of rows of matrix, scaled to unit length."""
    out = np.empty((len(starts), matrix.shape[1]), np.float32)
    for at in range(0, len(starts), 512):
        place = starts[at : at + 512, None] + np.arange(width)
        inside = place < len(features)
        rows = matrix[features[np.minimum(place, len(features) - 1)]]
        rows[~inside] = 0
        out[at : at + 512] = rows.sum(1)
    return _unit(out)


def _unit(x: np.ndarray) -> np.ndarray:
    return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-12)


def _gram_product(texts: DataFrame, idf: np.ndarray, test: np.ndarray) -> np.ndarray:
    """A^T A times test, A being the TF-IDF passages of texts (text), a row of unit length each."""
    spark = texts.sparkSession
    shared = spark.sparkContext.broadcast((idf, test))
    width, slabs = test.shape[1], 16

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weight, x = shared.value
        total = np.zeros_like(x)
        for batch in batches:
            for f in map(features_of, words_of(batch.column(0))):
                for at in passage_starts(len(f)) if len(f) >= MIN_WORDS else []:
                    word, tf = np.unique(f[at : at + WINDOW], return_counts=True)
                    a = tf * weight[word]
                    a = (a / max(np.linalg.norm(a), 1e-12)).astype(np.float32)
                    total[word] += np.outer(a, a @ x[word])
        for k, slab in enumerate(np.split(total, slabs)):
            yield pa.RecordBatch.from_arrays([pa.array([k]), pa.array([slab.tobytes()])], names=["slab", "value"])

    def summed(part: pa.Table) -> pa.Table:
        total = sum(np.frombuffer(v, np.float32) for v in part.column("value").to_pylist())
        return pa.table({"slab": part.column("slab")[:1], "value": pa.array([total.tobytes()])})

    # A row of each fitting task meets in each slab.
    rows = texts.mapInArrow(run, "slab long, value binary").groupBy("slab").applyInArrow(summed, "slab long, value binary").collect()
    got = {r.slab: np.frombuffer(r.value, np.float32) for r in rows}
    return np.concatenate([got.get(k, np.zeros(FEATURES // slabs * width, np.float32)) for k in range(slabs)]).reshape(FEATURES, width)


def latent_space(docs: DataFrame, benchmark: DataFrame, id_col: str, text_col: str, item_text: str, seed: int = 7) -> np.ndarray:
    """FEATURES x RANK: IDF weight times right singular vector over singular value."""
    df, n = document_frequencies(docs, text_col)
    idf = np.log((n + 1) / (df + 1)).astype(np.float32) + np.float32(0.1)
    ids = docs.select(F.col(id_col).alias("__id")).where("__id IS NOT NULL").distinct().orderBy(F.xxhash64(F.col("__id").cast("string"), F.lit(seed)), "__id").limit(FIT_DOCS)
    # FIT_DOCS bounds what is broadcast.
    some = docs.select(F.col(id_col).alias("__id"), F.col(text_col).alias("t")).join(F.broadcast(ids), "__id").select("t")
    some = some.unionByName(benchmark.select(F.col(item_text).alias("t"))).repartition(FIT_TASKS + benchmark.count() // FIT_ITEMS)
    test = np.random.default_rng(seed).standard_normal((FEATURES, RANK)).astype(np.float32)
    basis = np.linalg.qr(_gram_product(some, idf, test))[0].astype(np.float32)
    image = _gram_product(some, idf, basis)
    values, turn = np.linalg.eigh((basis.T @ image + image.T @ basis) / 2)
    scale = np.sqrt(np.maximum(values, values.max() * 1e-6 + 1e-12))
    return (idf[:, None] * (basis @ turn) / scale).astype(np.float32)


def common_subsequence(a: list[int], b: list[int]) -> int:
    """Length of the longest common subsequence, a bit for each word of a."""
    full, at = (1 << len(a)) - 1, {}
    for i, w in enumerate(a):
        at[w] = at.get(w, 0) | 1 << i
    row = full
    for w in b:
        if w in at:
            u = row & at[w]
            row = ((row + u) | (row - u)) & full
    return len(a) - row.bit_count()


def _ranges(first: np.ndarray, count: np.ndarray) -> np.ndarray:
    """The numbers of ranges of count from first on, one after another."""
    return np.repeat(first - (np.cumsum(count) - count), count) + np.arange(count.sum())


class Run:
    """Texts laid end to end, and their passages, numbered through all texts."""

    def __init__(self, texts: list[np.ndarray]):
        self.words, self.size = np.concatenate(texts), np.array(list(map(len, texts)), np.int64)
        self.start = np.cumsum(self.size) - self.size
        self.n_passages = -(-np.maximum(self.size - (NARROW - NARROW_STRIDE), 1) // STRIDE)
        self.first_passage = np.cumsum(self.n_passages) - self.n_passages

    def passages(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Each passage's text, and its start there."""
        text = np.searchsorted(self.first_passage, numbers, "right") - 1
        return text, (numbers - self.first_passage[text]) * STRIDE

    def vectors(self, numbers: np.ndarray, matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The unit vectors of passages, and of those of NARROW words in each; zeros for those that don't begin in their text.

        Words are added up in pieces of NARROW_STRIDE, as narrow passages overlap.
        """
        text, start = self.passages(numbers)
        features, matrix = features_of(self.words), np.concatenate([matrix, np.zeros((1, matrix.shape[1]), np.float32)])
        n_pieces, n_inner, per = WINDOW // NARROW_STRIDE, STRIDE // NARROW_STRIDE, NARROW // NARROW_STRIDE
        wide = np.empty((len(numbers), matrix.shape[1]), np.float32)
        narrow = np.empty((len(numbers), n_inner, matrix.shape[1]), np.float32)
        for at in range(0, len(numbers), 512):
            t, s = text[at : at + 512], start[at : at + 512]
            place = s[:, None] + np.arange(WINDOW)
            row = np.where(place < self.size[t, None], features[np.minimum(self.start[t, None] + place, len(features) - 1)], len(matrix) - 1)
            pieces = np.zeros((len(s), n_pieces, matrix.shape[1]), np.float32)
            for i in range(WINDOW):
                pieces[:, i // NARROW_STRIDE] += matrix[row[:, i]]
            wide[at : at + 512] = _unit(pieces.sum(1))
            for i in range(n_inner):
                narrow[at : at + 512, i] = _unit(pieces[:, i : i + per].sum(1))
        n = self.size[text]
        wide[(start >= n - (WINDOW - STRIDE)) & (start > 0)] = 0  # only narrow passages begin there
        inner = start[:, None] + np.arange(0, STRIDE, NARROW_STRIDE)
        narrow[(inner >= n[:, None] - (NARROW - NARROW_STRIDE)) & (inner > 0)] = 0
        return wide, narrow


class Items:
    """Benchmark items made ready for search: windows' vectors, words, answers."""

    def __init__(self, rows: list[tuple[int, str | None]], matrix: np.ndarray):
        self.ids, self.words, self.kinds, self.sorted_kinds, self.answers, vectors, short = [], [], [], [], [], [], []
        self.matrix = matrix
        for item_id, text in rows:
            words = next(words_of(pa.array([text], pa.string())))
            if len(words) < MIN_WORDS:
                continue
            last = [s for s in re.split(r"(?<=[.!?])\s+|\n+", (text or "").strip()) if s.strip()][-1]
            self.ids.append(item_id)
            self.words.append(words.tolist())
            self.answers.append(set(next(words_of(pa.array([last]))).tolist()))
            self.kinds.append(frozenset(self.words[-1]))
            self.sorted_kinds.append(np.unique(words))
            f = features_of(words)
            starts = np.arange(0, max(len(f) - WINDOW, 0) + 1, ITEM_STRIDE)
            vectors.append(_passages(f, np.append(starts, len(f) - WINDOW) if len(f) > WINDOW else starts, WINDOW, matrix))
            narrow = np.arange(max(len(f) - NARROW, 0) + 1 if len(f) < WINDOW + STRIDE else 0)
            short.append(_passages(f, narrow, NARROW, matrix))
        self.vectors, self.short = vectors, short
        self.sizes = np.array(list(map(len, self.words)), np.int64)
        # All items' different words: the sorted vocabulary, and each item's places in it, one item after another.
        self.n_kinds = np.array(list(map(len, self.kinds)), np.int64)
        flat = np.fromiter((w for kinds in self.kinds for w in kinds), np.uint64, int(self.n_kinds.sum()))
        self.vocabulary, self.places = np.unique(flat, return_inverse=True)
        heads = np.bincount((self.vocabulary >> np.uint64(48)).astype(np.int64), minlength=1 << 16)
        self.most_alike, self.by_head = int(heads.max()), np.minimum(np.cumsum(heads) - heads, max(len(self.vocabulary) - 1, 0)).astype(np.int32)
        self.first = np.cumsum(self.n_kinds) - self.n_kinds
        self.least = self.n_kinds - (1 - PARAPHRASE) * self.sizes

    def shared(self, words: np.ndarray, k: int) -> list[int]:
        """How many of the first 0, 1, 2... words are words of item k."""
        kinds = self.sorted_kinds[k]
        at = np.minimum(np.searchsorted(kinds, words), len(kinds) - 1)
        return np.concatenate([[0], np.cumsum(kinds[at] == words)]).tolist()

    def matches(self, words: np.ndarray, start: int, k: int, upto: list[int] | None = None) -> bool:
        """Whether the words around a passage hold item k; upto is shared()."""
        item, upto = self.words[k], upto or self.shared(words, k)
        n = len(item)
        first, end = max(0, start - n), min(start + WINDOW + n, len(words))
        if upto[end] - upto[first] < PARAPHRASE * n:
            return False
        # Two item lengths at a time, so that far-off words don't add up.
        for a in range(first, first + max(end - first - n // 2, 1), max(n // 2, 1)):
            b = min(a + n + n // 2, end)
            if upto[b] - upto[a] < PARAPHRASE * n:
                continue
            part = words[a:b].tolist()
            common = common_subsequence(item, part)
            if common >= VERBATIM * n:
                return True
            if common >= PARAPHRASE * n and len(self.answers[k] & set(part)) >= ANSWER * len(self.answers[k]):
                return True
        return False

    def holds(self, words: np.ndarray, k: int, starts: list[int]) -> bool:
        upto = self.shared(words, k)
        return any(self.matches(words, start, k, upto) for start in starts)

    def possible(self, words: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
        """Each item that may be in a text, with the passages (by number) around which it may be."""
        return self.possible_in(Run([words]))

    def possible_in(self, run: Run) -> Iterator[tuple[int, np.ndarray]]:
        """Each item that may be in a text of the run, with the run's passages (by number) around which it may be.

        An accepted subsequence holds PARAPHRASE of the item, so a text that lacks more of the item's different words
        can't hold it; nor can a passage if no stretch that matches() takes around it has so many words of the item, and
        that many different ones. These bounds are exact. Stretches are counted from each word of the item on. One
        item is met with all texts at once.
        """
        # Words are found by their first 16 bits, and then one word of the vocabulary further at a time.
        at = self.by_head.take(run.words >> np.uint64(48))
        for _ in range(self.most_alike - 1):
            at += self.vocabulary.take(at) < run.words
            np.minimum(at, len(self.vocabulary) - 1, at)
        place = np.flatnonzero(self.vocabulary.take(at) == run.words)
        column, text = at[place], np.repeat(np.arange(len(run.size)), run.size)[place]
        there = np.zeros((len(self.vocabulary), len(run.size)), bool)
        there[column, text] = True
        n_places = np.bincount(text, minlength=len(run.size))
        first_place = np.cumsum(n_places) - n_places
        kind = np.full(len(self.vocabulary), -1, np.int16 if self.n_kinds.max() < 1 << 15 else np.int32)  # of an item's words: their number
        for k, (n, first, count) in enumerate(zip(self.sizes.tolist(), self.first.tolist(), self.n_kinds.tolist(), strict=True)):
            own = self.places[first : first + count]
            texts = np.flatnonzero(there[own].sum(0, dtype=np.int32) >= self.least[k])
            if not len(texts):
                continue
            kind[own] = np.arange(count)
            hit = _ranges(first_place[texts], n_places[texts])
            which = kind.take(column.take(hit))
            kind[own] = -1
            held = np.flatnonzero(which >= 0)
            hit, which = hit.take(held), which.take(held)
            most, need = n + n // 2, math.ceil(PARAPHRASE * n)  # words of a stretch, and those of the item at least
            key = place[hit] + text[hit] * most  # no stretch spans two texts
            enough = key[need - 1 :] - key[: max(len(key) - need + 1, 0)] < most
            if not enough.any():
                continue
            live = np.zeros(len(run.size), bool)
            live[text[hit[: len(enough)][enough]]] = True
            some = np.flatnonzero(live[text[hit]])
            enough, key, which = np.append(enough, np.zeros(need - 1, bool))[some], key[some], which[some]
            order, before = np.argsort(which.astype(np.min_scalar_type(count)), kind="stable"), np.full(len(key), -1)
            again = np.flatnonzero(which[order[1:]] == which[order[:-1]])
            before[order[again + 1]] = order[again]
            # A word counts in the stretches that begin after the same word before it, up to itself.
            low = np.maximum(before + 1, np.searchsorted(key, key - most, "right"))
            different = np.cumsum(np.bincount(low, minlength=len(key))) - np.arange(len(key))
            full = np.flatnonzero(enough & (different >= self.least[k]))
            if not len(full):
                continue
            # matches() takes words from n before the passage to n after it: all that are needed must be there.
            owner = text[hit[some[full]]]
            begin, end = (place[hit[some[i]]] - run.start[owner] for i in (full, full + need - 1))
            low = np.maximum(-((WINDOW + n - 1 - end) // STRIDE), 0)
            high = np.minimum((begin + n) // STRIDE, run.n_passages[owner] - 1)
            yield k, np.unique(_ranges(run.first_passage[owner] + low, np.maximum(high - low + 1, 0)))

    def candidates(self, run: Run) -> Iterator[tuple[int, int, np.ndarray]]:
        """Item, text and the starts of its passages that are near the item by cosine."""
        pairs = list(self.possible_in(run))
        if not pairs:
            return
        all_ = np.unique(np.concatenate([p for _, p in pairs]))
        wide, narrow = run.vectors(all_, self.matrix)
        for k, passages in pairs:
            at = np.searchsorted(all_, passages)
            alike = (wide[at] @ self.vectors[k].T).max(1, initial=-1) >= COSINE
            if len(self.short[k]):
                alike |= (narrow[at] @ self.short[k].T).max((1, 2), initial=-1) >= COSINE
            text, start = run.passages(passages[alike])
            cuts = np.flatnonzero(np.diff(text)) + 1
            for some, starts in zip(np.split(text, cuts), np.split(start, cuts), strict=True):
                if len(some):
                    yield k, int(some[0]), starts

    def found_in(self, texts: pa.Array) -> list[list[int]]:
        """The ids of the items that each text holds."""
        out: list[list[int]] = [[] for _ in range(len(texts))]
        most = min(RUN_TEXTS, max(RUN_FLAGS // max(len(self.vocabulary), 1), 1))
        rows, some, size = [], [], 0
        for row, words in enumerate(words_of(texts)):
            if len(words) >= MIN_WORDS and len(self.ids):
                rows.append(row)
                some.append(words)
                size += len(words)
            if size >= RUN_WORDS or len(rows) == most:
                self._find(rows, some, out)
                rows, some, size = [], [], 0
        if rows:
            self._find(rows, some, out)
        return [sorted(ids) for ids in out]

    def _find(self, rows: list[int], some: list[np.ndarray], out: list[list[int]]) -> None:
        for k, text, starts in self.candidates(Run(some)):
            # The words that matches() may take.
            low, high = max(int(starts[0]) - len(self.words[k]), 0), int(starts[-1]) + WINDOW + len(self.words[k])
            if self.holds(some[text][low:high], k, (starts - low).tolist()):
                out[rows[text]].append(self.ids[k])


_ready: dict[str, Items] = {}


def ready_items(block_id: str, rows, matrix) -> Items:
    """A block's items, made once in each Python worker; the block before goes."""
    if block_id not in _ready:
        _ready.clear()
        _ready[block_id] = Items(rows.value, matrix.value)
    return _ready[block_id]


def _blocks(rows: Iterator[tuple[int, str | None]]) -> Iterator[list[tuple[int, str | None]]]:
    block, size = [], 0
    for item_id, text in rows:
        block.append((item_id, text))
        size += len(text or "")
        if size >= BLOCK_BYTES:
            yield block
            block, size = [], 0
    yield block


def with_items(docs: DataFrame, benchmark: DataFrame, name: str, id_col: str = "doc_id", text_col: str = "text", item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """docs with a column of the sorted ids of the items that each text holds."""
    spark = docs.sparkSession
    bound_batches(spark)
    shared = spark.sparkContext.broadcast(latent_space(docs, benchmark, id_col, text_col, item_text))
    items = benchmark.select(item_id, item_text).where(F.col(item_id).isNotNull()).orderBy(item_id).toLocalIterator()

    def column(rows: list[tuple[int, str | None]]):
        sent, block_id = spark.sparkContext.broadcast(rows), uuid.uuid4().hex

        @F.arrow_udf("array<long>")
        def found(texts: pa.Array) -> pa.Array:
            return pa.array(ready_items(block_id, sent, shared).found_in(texts), pa.list_(pa.int64()))

        return sent, found(F.col(f"`{text_col}`"))

    # The stated query set passes the driver block by block. Each block but the last is a pass of its own, written with
    # what was found so far, so that one block's items are in memory at a time.
    out, blocks = docs.withColumn(name, F.array().cast("array<long>")), _blocks((r[0], r[1]) for r in items)
    block, written = next(blocks), None
    for following in blocks:
        sent, found = column(block)
        more = materialize(out.withColumn(name, F.concat(name, found)), "leaked-items")
        sent.unpersist()
        discard(written)
        block, out, written = following, more, more
    return out.withColumn(name, F.array_sort(F.array_distinct(F.concat(name, column(block)[1]))))


def contamination(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, items (the benchmark items it holds), contaminated and kept of every row."""
    found = with_items(docs.select(id_col, text_col), benchmark, "items", id_col, text_col)
    return found.select(id_col, "items", (F.size("items") > 0).alias("contaminated"), (F.size("items") == 0).alias("kept"))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of docs whose texts hold no item, all columns as they were."""
    return with_items(docs, benchmark, "__items", id_col, text_col).where(F.size("__items") == 0).drop("__items")
