"""Clustering by two trees against Lloyd's rounds over all pairs in whole numbers."""

import hashlib
import math
from collections import defaultdict

import numpy as np
import pytest

from lodestone.llm import dual_tree, queries

SF = "/root/testdata/sf0.001"
SCHEMA = "vec_id long, embedding array<double>, label int, cluster string, start string, ids string"


def brute(data, k, rounds, width):
    kept = [(i, [int(v) * 256 if abs(v) > 2**60 else math.floor(256 * v) for v in x], x) for i, x in data if x is not None and len(x) == width and all(v is not None and math.isfinite(v) for v in x)]
    start = sorted(kept, key=lambda r: (r[0] is None, hashlib.sha256(f"2:{r[0]}".encode()).hexdigest() if r[0] is not None else "", r[2]))
    c = [list(x) for _, x, _ in start[:k]]
    near = lambda x: min((sum((a - b) ** 2 for a, b in zip(x, y)), n) for n, y in enumerate(c))
    for _ in range(rounds):
        groups = defaultdict(list)
        for _, x, _ in kept:
            groups[near(x)[1]].append(x)
        c = [[sum(col) // len(groups[n]) for col in zip(*groups[n])] if n in groups else y for n, y in enumerate(c)]
    found = [(i, *near(x)) for i, x, _ in kept]
    within = defaultdict(int)
    for _, d, n in found:
        within[n] += d
    top = lambda v: min(v, 2**63 - 1)
    digest = [hashlib.sha256(",".join(map(str, y)).encode()).hexdigest() for y in c]
    return sorted(((i, n, top(d), top(within[n]), top(sum(map(top, (x[1] for x in found)))), digest[n]) for i, d, n in found), key=repr)


def result(frame):
    return sorted(((r.vec_id, r.cluster, r.distance, r.cluster_inertia, r.inertia, r.centroid_sha256) for r in frame.collect()), key=repr)


def test_op12(spark):
    data = [(r.vec_id, [float(v) for v in r.embedding]) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    assert result(queries.op12_centroid_clustering(spark, SF)) == brute(data, 40, 5, 64)


def frame(spark, data):
    return spark.createDataFrame([(i, x, 1, "a", "b", "c") for i, x in data], SCHEMA).repartition(3)


@pytest.mark.parametrize("seed", range(3))
def test_op12_groups_copies_and_ties(spark, seed):
    rng = np.random.default_rng(seed)
    middles = rng.normal(0, 3, (6, 5))
    data = [(i, [float(v) for v in (np.round(middles[rng.integers(6)] + rng.normal(0, 0.2, 5), 1))]) for i in range(700)]
    data += [(1000 + i, data[3][1]) for i in range(500)]
    assert result(dual_tree.clusters(frame(spark, data), 9, 4, 5)) == brute(data, 9, 4, 5)


def test_op12_edge(spark):
    nan, inf = float("nan"), float("inf")
    good = [(1, [0.5, -0.25]), (2, [0.5, -0.25]), (2, [3.0, 1.0]), (2, [3.0, 1.0]), (None, [9.0, 9.0]), (None, [-9.0, 0.1]), (7, [1e-300, -1e-300])]
    bad = [(3, None), (4, []), (5, [1.0]), (6, [1.0, 2.0, 3.0]), (8, [1.0, None]), (9, [nan, 1.0]), (10, [1.0, inf]), (None, [-inf, 0.0])]
    for k in (1, 3, 40):
        assert result(dual_tree.clusters(frame(spark, good + bad), k, 3, 2)) == brute(good + bad, k, 3, 2)
    assert result(dual_tree.clusters(frame(spark, bad), 4, 3, 2)) == []
    assert result(dual_tree.clusters(frame(spark, []), 4, 3, 2)) == []


def test_op12_numbers_beyond_floating_point(spark):
    data = [(i, [float(i), 3e38 if i % 3 else -2.5e12]) for i in range(12)] + [(50, [1e308, -1e308])]
    assert result(dual_tree.clusters(frame(spark, data), 4, 3, 2)) == brute(data, 4, 3, 2)


def test_op12_nodes_cover_their_points_and_pairs_are_left_out():
    rng = np.random.default_rng(4)
    points = np.floor(256 * (rng.normal(0, 5, (8, 16))[rng.integers(0, 8, 900)] + rng.normal(0, 0.3, (900, 16))))
    order, (lo, hi, radius, parent) = dual_tree.grow(points)
    assert sorted(order) == list(range(900))
    x = points[order]
    for a, b, r in zip(lo, hi, radius):
        assert np.sqrt(((x[a:b] - x[a]) ** 2).sum(1)).max() <= r + 1e-6
    for me, above in enumerate(parent[1:], 1):
        assert lo[above] <= lo[me] and hi[me] <= hi[above]
    c = dual_tree.Centroids([[int(v) for v in p] for p in points[:40]])
    block = dual_tree.Block(x, dual_tree.CoverTree.of(lo, hi, radius, parent))
    got = {i: n for a, b, n in zip(*block.nearest(c)) for i in range(a, b)}
    assert [got[i] for i in range(900)] == ((x[:, None] - points[:40]) ** 2).sum(2).argmin(1).tolist()
    assert block.compared < 900 * 40 / 2
