"""Centroid clustering: Lloyd's rounds by a walk over two trees.

Vectors are stored once as blocks of at most BLOCK, each a cover tree: a node covers its points within its radius, its
first child keeps its centre, and centres of children lie further apart than the children's scale. In each round the
centroids make a cover tree too. A task walks both trees of a block together, level by level: a pair of nodes goes when
its least distance is above what another centroid surely reaches, a node with one centroid left is given to it whole
(its sum comes from running sums), and points of the leaves left are compared exactly. Tasks send sums by centroid; the
driver gets k rows for each dimension, never vectors. Blocks lie in a table, so a lost executor costs only its tasks.

All numbers are whole and exact: blocks with components beyond LIMIT, and rounds with such centroids, use Python's
integers without trees, and sums travel as limbs of 32 bits.

Defined results: vectors that are null, of another width, or with a null or non-finite component are left out; a null
vec_id is clustered and starts a centroid only where there are fewer others than centroids; repeated rows are vectors
each, and of those with one vec_id the least vector comes first as a start; fewer vectors than centroids make as many
clusters; an empty table gives no rows; distances and inertias saturate at the largest long; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestone.llm.common import discard, materialize

BLOCK, LEAF, BASE = 1024, 16, 1.3
LIMIT = 1 << 20  # of components in floating point, in which all sums of products then are exact
MAX_CENTROIDS = 1 << 14  # that the driver holds and each task gets
LARGEST = 2**63 - 1


@dataclass
class CoverTree:
    """Nodes as arrays. A node's points are order[lo:hi], the first of them its centre; children are numbers kids[first:first + count]."""

    lo: np.ndarray
    hi: np.ndarray
    radius: np.ndarray
    first: np.ndarray
    count: np.ndarray
    kids: np.ndarray

    @staticmethod
    def of(lo: np.ndarray, hi: np.ndarray, radius: np.ndarray, parent: np.ndarray) -> CoverTree:
        kids = np.argsort(parent, kind="stable")[1:]  # the root, whose parent is -1, comes first
        count = np.bincount(parent[1:], minlength=len(parent)) if len(parent) > 1 else np.zeros(len(parent), np.int64)
        return CoverTree(lo, hi, radius, np.cumsum(count) - count, count, kids)


def grow(points: np.ndarray, leaf: int = LEAF) -> tuple[np.ndarray, tuple[np.ndarray, ...]]:
    """The order of points, and lo, hi, radius, parent of a cover tree's nodes."""
    squares = (points * points).sum(1)
    apart = np.sqrt(np.maximum(squares[:, None] + squares - 2 * points @ points.T, 0))
    order: list[int] = []
    lo, hi, radius, parent = [], [], [], []
    todo = [(0, np.arange(len(points)), -1)]
    while todo:
        centre, members, above = todo.pop()
        away = apart[centre, members]
        far = float(away.max())
        me = len(lo)
        lo.append(len(order))
        hi.append(len(order) + len(members))
        radius.append(far)
        parent.append(above)
        if far == 0 or len(members) <= leaf:
            order.extend([centre, *members[members != centre]])
            continue
        scale = BASE ** (math.ceil(math.log(far, BASE)) - 1)
        while scale >= far:
            scale /= BASE
        near = away <= scale
        parts, rest = [(centre, members[near], me)], members[~near]
        while len(rest):
            inside = apart[rest[0], rest] <= scale
            parts.append((int(rest[0]), rest[inside], me))
            rest = rest[~inside]
        todo.extend(reversed(parts))  # the part of this centre is the next one
    return np.array(order), (np.array(lo), np.array(hi), np.array(radius), np.array(parent))


class Centroids:
    """Centroids, their cover tree, and the least number at each of its leaves."""

    def __init__(self, values: list[list[int]]):
        self.values = values
        self.exact = max((abs(v) for c in values for v in c), default=0) > LIMIT
        if values and not self.exact:
            points = np.array(values, np.float64)
            order, nodes = grow(points, 1)
            self.tree, self.points = CoverTree.of(*nodes), points[order]
            self.squares = (self.points * self.points).sum(1)
            self.number = np.minimum.reduceat(order, self.tree.lo) if len(order) else order
            # reduceat ends at the next start; leaves, which alone are asked for, are disjoint and in order.
            leaves = np.flatnonzero(self.tree.count == 0)
            self.number[leaves] = [order[a:b].min() for a, b in zip(self.tree.lo[leaves], self.tree.hi[leaves], strict=True)]


def _grouped(q: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and sizes of the runs of equal values."""
    starts = np.flatnonzero(np.append(True, q[1:] != q[:-1]))
    return starts, np.diff(np.append(starts, len(q)))


def _each(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """starts[i], starts[i] + 1, ... of each run, one after the other."""
    ends = np.cumsum(sizes)
    return np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - sizes, sizes) + np.repeat(starts, sizes)


class Block:
    """A block's points in their tree's order, ready to be walked."""

    def __init__(self, points: np.ndarray, tree: CoverTree):
        self.points, self.tree = points.astype(np.float64), tree
        self.squares = (self.points * self.points).sum(1)
        self.compared = 0  # pairs of a point and a centroid, or of nodes, whose distance was taken

    def _apart(self, at: np.ndarray, c: Centroids, to: np.ndarray) -> np.ndarray:
        """Squared distances of points at and centroids to, pair by pair; at is sorted."""
        self.compared += len(at)
        starts, sizes = _grouped(at)
        if 4 * len(at) > len(starts) * len(c.points):
            row = at[starts]
            whole = self.squares[row, None] + c.squares - 2 * self.points[row] @ c.points.T
            return whole[np.repeat(np.arange(len(row)), sizes), to]
        return self.squares[at] + c.squares[to] - 2 * np.einsum("ij,ij->i", self.points[at], c.points[to])

    def nearest(self, c: Centroids) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """lo, hi, number: runs of points that are nearest to a centroid, of equally near ones the least number."""
        t, r_tree, out = self.tree, c.tree, []
        q, r = np.zeros(1, np.int64), np.zeros(1, np.int64)

        def closest(starts: np.ndarray, sizes: np.ndarray, far: np.ndarray, number: np.ndarray) -> np.ndarray:
            least = np.minimum.reduceat(far, starts)
            return np.minimum.reduceat(np.where(far == np.repeat(least, sizes), number, MAX_CENTROIDS), starts)

        while len(q):
            while True:
                far = self._apart(t.lo[q], c, r_tree.lo[r])
                root, own, theirs = np.sqrt(np.maximum(far, 0)), t.radius[q], r_tree.radius[r]
                starts, sizes = _grouped(q)
                surely = np.repeat(np.minimum.reduceat(root + own, starts), sizes)
                keep = root - own - theirs <= surely * (1 + 1e-9) + 1e-6
                q, r, far, own, theirs = q[keep], r[keep], far[keep], own[keep], theirs[keep]
                split = (theirs > 0) & ((theirs > own) | (t.count[q] == 0))
                if not split.any():
                    break
                n = np.where(split, r_tree.count[r], 1)
                begin = np.where(split, r_tree.first[r], len(r_tree.kids) + np.arange(len(r)))
                q, r = np.repeat(q, n), np.concatenate([r_tree.kids, r])[_each(begin, n)]
            starts, sizes = _grouped(q)
            node, number = q[starts], c.number[r]
            whole = (sizes == 1) & (theirs[starts] == 0)
            alike = ~whole & (t.radius[node] == 0)
            done = whole | alike
            if done.any():
                best = closest(starts, sizes, far, number)
                out.append((t.lo[node[done]], t.hi[node[done]], best[done]))
            leaf = ~done & (t.count[node] == 0)
            if leaf.any():
                spans = t.hi[node[leaf]] - t.lo[node[leaf]]
                at = _each(t.lo[node[leaf]], spans)
                n = np.repeat(sizes[leaf], spans)
                to = r[_each(np.repeat(starts[leaf], spans), n)]
                far = self._apart(np.repeat(at, n), c, r_tree.lo[to])
                out.append((at, at + 1, closest(np.cumsum(n) - n, n, far, c.number[to])))
            open_ = ~done & ~leaf
            counts = t.count[node[open_]]
            below = t.kids[_each(t.first[node[open_]], counts)]
            n = np.repeat(sizes[open_], counts)
            q, r = np.repeat(below, n), r[_each(np.repeat(starts[open_], counts), n)]
        lo, hi, number = (np.concatenate(x) for x in zip(*out, strict=True))
        return lo, hi, number


def whole_numbers(x: float) -> int:
    return int(x) * 256 if abs(x) >= 2.0**60 else math.floor(256 * x)


def _exact(points: list[list[int]], values: list[list[int]]) -> list[tuple[int, int]]:
    """Cluster and squared distance of each point, in Python's integers."""
    return [min((sum((a - b) * (a - b) for a, b in zip(p, c, strict=True)), k) for k, c in enumerate(values))[::-1] for p in points]


def blocks(vectors: DataFrame, id_col: str, vector_col: str, width: int) -> DataFrame:
    """Rows of up to BLOCK vectors: ids, exact, points (numbers times 256 as int32, or doubles where exact), nodes (lo, hi, parent), radius."""
    kind = vectors.schema[id_col].dataType.simpleString()

    def packed(ids: pa.Array, raw: np.ndarray) -> pa.RecordBatch:
        with np.errstate(over="ignore"):
            scaled = np.floor(256 * raw)
        exact = bool(np.abs(scaled).max() > LIMIT)
        if exact:
            order, points, nodes, radius = np.arange(len(raw)), raw, np.zeros(0, "<i4"), np.zeros(0)
        else:
            order, (lo, hi, radius, parent) = grow(scaled)
            points, nodes = scaled.astype("<i4"), np.stack([lo, hi, parent]).astype("<i4")
        ids = ids.take(pa.array(order))
        cells = [pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids), pa.array([exact]), *(pa.array([x.tobytes()], pa.binary()) for x in (points[order], nodes, radius))]
        return pa.RecordBatch.from_arrays(cells, names=["ids", "exact", "points", "nodes", "radius"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, raw, n = [], [], 0
        for batch in batches:
            at = 0
            while at < batch.num_rows:
                part = batch.slice(at, BLOCK - n)
                ids.append(part.column(0))
                raw.append(part.column(1).flatten().to_numpy(zero_copy_only=False).reshape(-1, width))
                n += part.num_rows
                at += part.num_rows
                if n == BLOCK:
                    yield packed(pa.concat_arrays(ids), np.concatenate(raw))
                    ids, raw, n = [], [], 0
        if n:
            yield packed(pa.concat_arrays(ids), np.concatenate(raw))

    return vectors.select(id_col, F.col(vector_col).cast("array<double>")).mapInArrow(run, f"ids array<{kind}>, exact boolean, points binary, nodes binary, radius binary")


def _unpacked(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[tuple[pa.Array, bool, np.ndarray | list, CoverTree | None]]:
    """ids, exact, points and tree of each block; points are lists of integers where exact."""
    for batch in batches:
        for k in range(batch.num_rows):
            ids, exact, points, nodes, radius = (column[k] for column in batch.columns)
            if exact.as_py():
                raw = np.frombuffer(points.as_py(), np.float64).reshape(-1, width)
                yield ids.values, True, [[whole_numbers(x) for x in row] for row in raw.tolist()], None
            else:
                lo, hi, parent = np.frombuffer(nodes.as_py(), "<i4").reshape(3, -1).astype(np.int64)
                yield ids.values, False, np.frombuffer(points.as_py(), "<i4").reshape(-1, width), CoverTree.of(lo, hi, np.frombuffer(radius.as_py(), np.float64), parent)


def _limbs(values: list[int]) -> Iterator[tuple[int, int, int]]:
    """place, limb, digit of each number in base 2^32; the last digit has the sign."""
    for place, v in enumerate(values):
        limb = 0
        while not -(2**32) < v < 2**32:
            v, digit = divmod(v, 2**32)
            yield place, limb, digit
            limb += 1
        yield place, limb, v


def _sums(trees: DataFrame, shared, width: int) -> dict[int, tuple[int, list[int]]]:
    """Count and sum of each centroid's vectors."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c, total = shared.value, {}
        for _, exact, points, tree in _unpacked(batches, width):
            if exact or c.exact:
                points = points if exact else points.tolist()
                found = [(k, [1, *p]) for (k, _), p in zip(_exact(points, c.values), points, strict=True)]
            else:
                lo, hi, number = Block(points, tree).nearest(c)
                running = np.zeros((len(points) + 1, width + 1), np.int64)
                np.cumsum(points, 0, out=running[1:, 1:])
                running[:, 0] = np.arange(len(points) + 1)
                order = np.argsort(number, kind="stable")
                starts, _ = _grouped(number[order])
                sums = np.add.reduceat((running[hi] - running[lo])[order], starts)
                found = zip(number[order][starts].tolist(), sums.tolist(), strict=True)
            for k, row in found:
                total[k] = [a + b for a, b in zip(total[k], row, strict=True)] if k in total else row
        rows = [(k, *x) for k, row in total.items() for x in _limbs(row)]
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in (zip(*rows, strict=True) if rows else [[]] * 4)], names=["cluster", "place", "limb", "digit"])

    parts = trees.mapInArrow(run, "cluster long, place long, limb long, digit long")
    out: dict[int, list[int]] = {}
    for r in parts.groupBy("cluster", "place", "limb").agg(F.sum("digit").alias("digit")).collect():  # k rows for each dimension
        out.setdefault(r.cluster, [0] * (width + 1))[r.place] += r.digit << 32 * r.limb
    return {k: (row[0], row[1:]) for k, row in out.items()}


def _assigned(trees: DataFrame, shared, width: int, id_col: str, kind: str) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = shared.value
        for ids, exact, points, tree in _unpacked(batches, width):
            if exact or c.exact:
                cluster, distance = zip(*((k, min(d, LARGEST)) for k, d in _exact(points if exact else points.tolist(), c.values)), strict=True)
            else:
                lo, hi, number = Block(points, tree).nearest(c)
                cluster = np.empty(len(points), np.int64)
                cluster[_each(lo, hi - lo)] = np.repeat(number, hi - lo)
                distance = ((points.astype(np.int64) - np.array(c.values)[cluster]) ** 2).sum(1)
            yield pa.RecordBatch.from_arrays([ids, pa.array(cluster, pa.int32()), pa.array(distance, pa.int64())], names=[id_col, "cluster", "distance"])

    return trees.mapInArrow(run, f"{id_col} {kind}, cluster int, distance long")


def clusters(vectors: DataFrame, k: int, rounds: int, width: int, seed: int = 2, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256 of every vector of width finite components.

    Centroids start as the k vectors with the least SHA-256 of 'seed:id'.
    """
    if k > MAX_CENTROIDS:
        raise ValueError(f"over {MAX_CENTROIDS} centroids")
    spark, kind = vectors.sparkSession, vectors.schema[id_col].dataType.simpleString()
    x = F.col(vector_col)
    finite = F.forall(x, lambda e: F.coalesce(~F.isnan(e) & (F.abs(e) < float("inf")), F.lit(False)))
    kept = vectors.where(x.isNotNull() & (F.size(x) == width) & finite).select(id_col, x.cast("array<double>").alias(vector_col))
    start = F.sha2(F.concat(F.lit(f"{seed}:"), F.col(id_col).cast("string")), 256)
    first = kept.select(vector_col, start.alias("start")).orderBy(F.asc_nulls_last("start"), vector_col).limit(k).collect()
    values = [[whole_numbers(e) for e in r[vector_col]] for r in first]
    trees = materialize(blocks(kept, id_col, vector_col, width), "cover-trees")
    for _ in range(rounds if values else 0):
        shared = spark.sparkContext.broadcast(Centroids(values))  # at most MAX_CENTROIDS
        sums = _sums(trees, shared, width)
        values = [[s // sums[c][0] for s in sums[c][1]] if c in sums else old for c, old in enumerate(values)]
        shared.unpersist()
    shared = spark.sparkContext.broadcast(Centroids(values))
    found = materialize(_assigned(trees, shared, width, id_col, kind), "clusters")
    discard(trees)
    shared.unpersist()
    exact = found.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("s")).collect()  # k rows
    whole = min(sum(int(r.s) for r in exact), LARGEST)
    digest = lambda c: hashlib.sha256(",".join(map(str, values[c])).encode()).hexdigest()
    rows = [(r.cluster, min(int(r.s), LARGEST), whole, digest(r.cluster)) for r in exact]
    about = spark.createDataFrame(rows, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return found.join(F.broadcast(about), "cluster").select(id_col, "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
