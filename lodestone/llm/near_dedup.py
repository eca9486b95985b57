"""MinHash near-duplicates: minima, banding, signature check, full-set check, components.

1. A text's set of word shingles becomes 64-bit hashes; PERMUTATIONS universal hashes
   ((a*h + b) mod 2^32) of it leave their minima as the signature. Texts with equal sets form
   a class; all that follows works on classes, so exact copies cost nothing further.
2. BANDS bands of ROWS minima put classes into buckets. At a similarity of 0.85 all bands miss with
   a probability below 1e-8, at 0.8 below 1e-5; texts that share a passage rarely meet (0.03 at 0.3).
3. Large groups of near copies shrink first, without forming pairs: each bucket's members are compared with
   one pivot, by signature and then by full set. A bucket whose classes are in one component then has
   nothing left to tell.
4. In a bucket that is still open only classes outside its largest component can bring a link. These are
   dealt into blocks, and so are all members; a task compares one block with another by signature, down to SLACK
   below the threshold, and names the classes that are near another one. Only their full sets are
   then brought to a second task for the same blocks, which takes the pairs by falling similarity and
   compares the sets, unless links found there have connected them already. A pair that shares
   several bands is left to the first of these. So no pairs are written or shuffled, a task gives one link at
   most for each of its classes, every pair that may be linked is compared or found connected, and no task grows
   with its bucket. (Open buckets of many classes cost block pairs; that is the price of losing no link.)

Defined results: null and empty texts have no shingles and are linked with nothing; texts of fewer
words than a shingle have the whole sequence as one; rows with equal ids are one document whose set is that
of each row's text (all rows are returned, links of any join its component); a null doc_id
gets a null component and is kept; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestone.llm.common import bound_batches, discard, hashed_words, materialize
from lodestone.llm.components import components, star_links

SHINGLE = 5
BANDS, ROWS = 40, 6
PERMUTATIONS = BANDS * ROWS
SLACK = 0.13  # five standard deviations of the estimate
BLOCK_CLASSES, BLOCK_BYTES = 1024, 16 << 20

_RNG = np.random.default_rng(20240501)
_A = _RNG.integers(0, 2**31, PERMUTATIONS, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
_B = _RNG.integers(0, 2**32, PERMUTATIONS, dtype=np.uint32)
_C = _RNG.integers(0, 2**63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def window_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """A 64-bit hash of each run of size words: a sum of multiples, mixed."""
    n = len(words) - size + 1
    h = np.zeros(max(n, 0), np.uint64)
    for k in range(size if n > 0 else 0):
        h += words[k : k + n] * _C[k]
    h ^= h >> np.uint64(31)
    h *= np.uint64(0x9E3779B97F4A7C15)
    return h ^ (h >> np.uint64(29))


def shingle_sets(texts: pa.Array, size: int = SHINGLE) -> Iterator[np.ndarray]:
    """Sorted distinct shingle hashes of each text, A-Z lower-cased."""
    for words in hashed_words(texts, pc.ascii_lower):
        yield np.unique(window_hashes(words, min(size, len(words)))) if len(words) else np.zeros(0, np.uint64)


def signature(shingles: np.ndarray) -> np.ndarray:
    """The least value of each universal hash over the set, as uint32."""
    short = (shingles >> np.uint64(16)).astype(np.uint32)
    out = np.full(PERMUTATIONS, 0xFFFFFFFF, np.uint32)
    for at in range(0, len(short), 256):
        some = short[at : at + 256, None] * _A
        some += _B
        np.minimum(out, some.min(0), out=out)
    return out


def bands_of(signatures: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each band (and its number) of each signature."""
    sig = signatures.reshape(-1, BANDS, ROWS).astype(np.uint64)
    h = np.broadcast_to(np.arange(BANDS, dtype=np.uint64) * _C[60], sig.shape[:2]).copy()
    for k in range(ROWS):
        h = (h ^ (sig[:, :, k] + _C[50 + k])) * np.uint64(0xBF58476D1CE4E5B9)
        h ^= h >> np.uint64(30)
    return h.view(np.int64)


def _signed(df: DataFrame, size: int) -> DataFrame:
    """id, n, class (of the set; null for an empty one), bands and sig (a byte for each minimum) of each row of df (id, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, keys, minima = [], [], []
            for s in shingle_sets(batch.column(1), size):
                n.append(len(s))
                keys.append(xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None)
                minima.append(signature(s))
            sig = np.stack(minima) if minima else np.zeros((0, PERMUTATIONS), np.uint32)
            bands = pa.ListArray.from_arrays(pa.array(np.arange(len(sig) + 1, dtype=np.int32) * BANDS), pa.array(bands_of(sig).ravel()))
            low = pa.FixedSizeBinaryArray.from_buffers(pa.binary(PERMUTATIONS), len(sig), [None, pa.py_buffer(sig.astype(np.uint8).tobytes())]).cast(pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), pa.array(keys, pa.binary()), bands, low], names=["id", "n", "class", "bands", "sig"])

    return df.mapInArrow(run, "id long, n long, class binary, bands array<long>, sig binary")


def _sets(texts: DataFrame, size: int) -> DataFrame:
    """rep, value (sorted 64-bit hashes) from rows (rep, class, text); a text of another class is passed over."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            reps, sets = [], []
            for rep, key, hashes in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), shingle_sets(batch.column(2), size), strict=True):
                s = hashes.tobytes()
                if xxhash.xxh3_128_digest(s) == key:
                    reps.append(rep)
                    sets.append(s)
            yield pa.RecordBatch.from_arrays([pa.array(reps, pa.int64()), pa.array(sets, pa.binary())], names=["rep", "value"])

    return texts.mapInArrow(run, "rep long, value binary").groupBy("rep").agg(F.first("value").alias("value"))


def _bytes_matrix(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(-1, PERMUTATIONS)


def _estimated(pairs: DataFrame, least: float) -> DataFrame:
    """Pairs (a, b, sa, sb: signatures) whose estimate isn't far below least."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = pa.array((_bytes_matrix(batch.column(2)) == _bytes_matrix(batch.column(3))).mean(1) >= least)
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(keep), batch.column(1).filter(keep)], names=["a", "b"])

    return pairs.mapInArrow(run, "a long, b long")


def _linked(x: np.ndarray, y: np.ndarray, percent: int) -> bool:
    """The exact test on two sorted sets."""
    if len(x) > len(y):
        x, y = y, x
    if 100 * len(x) < percent * len(y):
        return False
    at = np.searchsorted(y, x)
    both = int((y[np.minimum(at, len(y) - 1)] == x).sum())
    return 100 * both >= percent * (len(x) + len(y) - both)


def _confirmed(pairs: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b, sa, sb: full sets) with 100 * intersection >= percent * union."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                some = batch.slice(at, 500)
                sets = zip(some.column(2).to_pylist(), some.column(3).to_pylist(), strict=True)
                keep = pa.array([_linked(np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64), percent) for x, y in sets], pa.bool_())
                yield pa.RecordBatch.from_arrays([some.column(0).filter(keep), some.column(1).filter(keep)], names=["a", "b"])

    return pairs.mapInArrow(run, "a long, b long")


def _with(pairs: DataFrame, values: DataFrame, value: str, percent: int | None = None) -> DataFrame:
    """a, b, sa, sb: a value of both ends of each pair; with percent, ends too unlike in size n go first."""
    n = ["n"] if percent else []
    at_a = values.select(F.col("rep").alias("a"), F.col(value).alias("sa"), *[F.col(c).alias("na") for c in n])
    at_b = values.select(F.col("rep").alias("b"), F.col(value).alias("sb"), *[F.col(c).alias("nb") for c in n])
    both = pairs.join(at_a, "a").join(at_b, "b")
    if percent:
        both = both.where(F.least("na", "nb") * 100 >= F.greatest("na", "nb") * percent)
    return both.select("a", "b", "sa", "sb")


TASK = ("bucket", "i", "j")  # a pair of blocks of a bucket
LEFT, RIGHT = 1, 2


def _whole_tasks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Rows that are sorted by TASK (the first columns), in runs that end with a task."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        keys = [batch.column(k).to_numpy() for k in range(3)]
        last = np.logical_and.reduce([k == k[-1] for k in keys]) if batch.num_rows else np.zeros(0, bool)
        cut = int(last.argmax()) if batch.num_rows else 0
        if cut:
            yield pa.Table.from_batches([*held, batch.slice(0, cut)])
            held = []
        held.append(batch.slice(cut))
    if sum(b.num_rows for b in held):
        yield pa.Table.from_batches(held)


def _near(part: pa.Table, percent: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Rows x and y of part, and in how many minima they agree, of the pairs of a task that may be linked and are its own to judge."""
    keys = [part.column(k).to_numpy() for k in TASK]
    role, band, n, comp, rep, outside = (part.column(c).to_numpy() for c in ("role", "band", "n", "comp", "rep", "outside"))
    sig = _bytes_matrix(part.column("sig"))
    bands = part.column("bands").combine_chunks().flatten().to_numpy().reshape(-1, BANDS)
    new = np.ones(len(rep), bool)
    new[1:] = np.logical_or.reduce([k[1:] != k[:-1] for k in keys])
    group = np.cumsum(new) - 1
    left, right = np.flatnonzero(role & LEFT), np.flatnonzero(role & RIGHT)
    width = np.bincount(group[right], minlength=group[-1] + 1)
    first = np.cumsum(width) - width
    upto = np.cumsum(width[group[left]])
    at = 0
    while at < len(left):
        end = max(int(np.searchsorted(upto, (upto[at - 1] if at else 0) + (1 << 16), "right")), at + 1)
        rows, count = left[at:end], width[group[left[at:end]]]
        x = np.repeat(rows, count)
        y = right[np.arange(len(x)) - np.repeat(np.cumsum(count) - count, count) + np.repeat(first[group[rows]], count)]
        at = end
        keep = (comp[x] != comp[y]) & ~(outside[y] & (rep[x] > rep[y])) & (100 * np.minimum(n[x], n[y]) >= percent * np.maximum(n[x], n[y]))
        x, y = x[keep], y[keep]
        alike = (sig[x] == sig[y]).sum(1)
        keep = alike >= (percent / 100 - SLACK) * PERMUTATIONS
        x, y, alike = x[keep], y[keep], alike[keep]
        if len(x):
            own = (bands[x] == bands[y]).argmax(1) == band[x]
            yield x[own], y[own], alike[own]


MEMBER = "bucket long, i int, j int, role int, band int, rep long, n long, comp long, outside boolean, sig binary, bands array<long>"


def _named(members: DataFrame, percent: int) -> DataFrame:
    """The rows (MEMBER) that are near another one of their task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in _whole_tasks(batches):
            rows = [r for x, y, _ in _near(part, percent) for r in (x, y)]
            if rows:
                yield from part.take(pa.array(np.unique(np.concatenate(rows)))).combine_chunks().to_batches()

    return _dealt(members).mapInArrow(run, MEMBER)


def _links(members: DataFrame, percent: int) -> DataFrame:
    """a, b: links that connect what is linked within each task; members: rows of MEMBER with value, their full sets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in _whole_tasks(batches):
            found = list(_near(part, percent))
            x, y, alike = (np.concatenate(c) for c in zip(*found, strict=True)) if found else (np.zeros(0, int),) * 3
            comps, reps, values = part.column("comp").to_numpy(), part.column("rep").to_numpy(), part.column("value")
            root: dict[int, int] = {}

            def find(c: int) -> int:
                while (up := root.get(c, c)) != c:
                    root[c] = root.get(up, up)
                    c = up
                return c

            out: list[tuple[int, int]] = []
            for k in np.argsort(-alike, kind="stable").tolist():
                a, b = find(int(comps[x[k]])), find(int(comps[y[k]]))
                if a != b and _linked(np.frombuffer(values[int(x[k])].as_buffer(), np.uint64), np.frombuffer(values[int(y[k])].as_buffer(), np.uint64), percent):
                    root[a] = b
                    out.append((int(reps[x[k]]), int(reps[y[k]])))
            yield pa.RecordBatch.from_arrays([pa.array([p[0] for p in out], pa.int64()), pa.array([p[1] for p in out], pa.int64())], names=["a", "b"])

    return _dealt(members).mapInArrow(run, "a long, b long")


def _dealt(members: DataFrame) -> DataFrame:
    return members.repartition(*TASK).sortWithinPartitions(*TASK)


def _open(members: DataFrame, merged: DataFrame) -> DataFrame:
    """The members of buckets with several components, a row for each task (pair of blocks) that needs them.

    members: bucket, band, rep, n. Left blocks hold what is outside a bucket's largest component, right blocks all.
    """
    placed = members.join(merged, F.col("rep") == F.col("node"), "left").select("bucket", "band", "rep", "n", F.coalesce("component", "rep").alias("comp"))
    placed = materialize(placed, "near-placed")
    sizes = placed.groupBy("bucket", "comp").agg(F.count("*").alias("k"), F.sum("n").alias("n"))
    of = sizes.groupBy("bucket").agg(F.count("*").alias("comps"), F.sum("k").alias("k"), F.sum("n").alias("all_n"), F.max(F.struct("k", "n", "comp")).alias("top")).where("comps > 1")
    blocks = lambda k, n: F.greatest(F.ceil(k / BLOCK_CLASSES), F.ceil(n * 8 / BLOCK_BYTES)).cast("int")
    of = of.select("bucket", F.col("top.comp").alias("top"), blocks(F.col("k") - F.col("top.k"), F.col("all_n") - F.col("top.n")).alias("lefts"), blocks(F.col("k"), F.col("all_n")).alias("rights"))
    held = placed.join(materialize(of, "near-open"), "bucket").withColumn("outside", F.col("comp") != F.col("top"))
    side = lambda n: F.pmod(F.xxhash64("rep"), n).cast("int")
    task = lambda i, j, role: F.struct(i.cast("int").alias("i"), j.cast("int").alias("j"), role.cast("int").alias("role"))
    as_left = F.when(F.col("outside"), F.transform(F.sequence(F.lit(0), F.col("rights") - 1), lambda j: task(side(F.col("lefts")), j, F.lit(LEFT)))).otherwise(F.array())
    as_right = F.transform(F.sequence(F.lit(0), F.col("lefts") - 1), lambda i: task(i, side(F.col("rights")), F.lit(RIGHT)))
    alone = F.array(task(F.lit(0), F.lit(0), F.when(F.col("outside"), LEFT | RIGHT).otherwise(RIGHT)))
    tasks = F.when((F.col("lefts") == 1) & (F.col("rights") == 1), alone).otherwise(F.concat(as_left, as_right))
    return held.select("bucket", "band", "rep", "n", "comp", "outside", F.explode(tasks).alias("t")).select("bucket", "t.*", "band", "rep", "n", "comp", "outside")


def _merged(classes: DataFrame, rows: DataFrame, percent: int, size: int) -> DataFrame:
    """node, component of the classes that the threshold connects to others.

    classes: rep (the class's number), id (its least), class, n, bands, sig. rows: id, text.
    """
    placed = classes.select("rep", "n", F.posexplode("bands").alias("band", "bucket"))
    shared = placed.groupBy("bucket").agg(F.min("rep").alias("pivot"), F.max("rep").alias("last")).where("pivot < last").select("bucket", "pivot")
    members = materialize(placed.join(shared, "bucket"), "near-members")
    known = materialize(classes.join(members.select("rep").distinct(), "rep", "left_semi"), "near-known")
    sets = materialize(_sets(rows.join(known.select("id", "rep", "class"), "id").select("rep", "class", "text"), size), "near-sets")
    pairs = members.where("rep <> pivot").select(F.col("pivot").alias("a"), F.col("rep").alias("b")).distinct()
    likely = _estimated(_with(pairs, known, "sig", percent), percent / 100 - SLACK)
    by_pivot = materialize(_confirmed(_with(likely, sets, "value"), percent), "near-links")
    merged = components(by_pivot)
    tasks = _open(members.drop("pivot"), merged)
    columns = [c.split()[0] for c in MEMBER.split(", ")]
    named = materialize(_named(tasks.join(known.select("rep", "sig", "bands"), "rep").select(*columns), percent), "near-named")
    within = materialize(_links(named.join(sets, "rep").select(*columns, "value"), percent), "near-links")
    out = components(star_links(merged).unionByName(within))
    discard(members, known, sets, by_pivot, merged, named, within)
    return out


def near_duplicates(docs: DataFrame, percent: int = 80, size: int = SHINGLE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_shingles, component_id and kept of every row; rows of the component's least doc_id are kept."""
    bound_batches(docs.sparkSession)
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    signed = materialize(_signed(rows, size), "near-signed")
    real = signed.where("class IS NOT NULL AND id IS NOT NULL")
    classes = real.groupBy("class").agg(F.min("id").alias("id"), F.first("n").alias("n"), F.first("bands").alias("bands"), F.first("sig").alias("sig"))
    classes = materialize(classes.withColumn("rep", F.monotonically_increasing_id()), "near-classes")
    merged = _merged(classes, rows, percent, size)
    roots = classes.select("class", "rep", F.col("id").alias("least"))
    lowest = roots.join(merged, F.col("rep") == F.col("node")).groupBy("component").agg(F.min("least").alias("low"))
    roots = roots.join(merged.join(lowest, "component"), F.col("rep") == F.col("node"), "left").select("class", F.coalesce("low", "least").alias("least"))
    roots = materialize(roots.select("class", "least"), "near-roots")
    discard(classes, merged)
    lone = F.when(F.col("id").isNotNull(), F.coalesce("least", "id"))
    return signed.select("id", "n", "class").join(roots, "class", "left").select(
        F.col("id").alias(id_col), F.col("n").alias("n_shingles"), lone.alias("component_id"), F.coalesce(F.col("id") == lone, F.lit(True)).alias("kept")
    )


def drop_near_duplicates(docs: DataFrame, percent: int = 80, size: int = SHINGLE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of each near-duplicate group, all columns as they were."""
    verdicts = near_duplicates(docs, percent, size, id_col, text_col)
    counted = materialize(verdicts.groupBy(F.col(id_col).alias("__id")).agg(F.max("kept").alias("keep"), F.count("*").alias("n")), "near-kept")
    once = counted.where("keep AND (n = 1 OR __id IS NULL)").select("__id")
    out = docs.join(once, F.col(id_col).eqNullSafe(F.col("__id")), "left_semi")
    again = counted.where("keep AND n > 1 AND __id IS NOT NULL").select("__id")
    if again.isEmpty():
        return out
    return out.unionByName(docs.join(again, F.col(id_col) == F.col("__id"), "left_semi").dropDuplicates([id_col]))
