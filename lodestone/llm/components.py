"""Connected components by alternating large-star and small-star steps, as joins and aggregations.

Defined results: links of a node with itself and repeated links tell nothing and are passed over; links with a
null end link nothing; without links there are no nodes. A node with any share of all links is a hot key
of joins alone, whose sides are plain shuffles that adaptive execution splits; minima are combined
before they are shuffled.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestone.llm.common import discard, materialize_counted


def _with_least(down: DataFrame, ends: DataFrame, key: str) -> DataFrame:
    """The rows of down with m, the least node that ends (node, other) has beside or at the node named by key."""
    least = ends.groupBy("node").agg(F.min("other").alias("m"))
    # Another expression than the node itself, so that the minima are shuffled for the join and it can be split.
    least = least.select(F.coalesce("node", F.lit(0)).alias("key"), "m")
    return down.join(least, F.col(key) == F.col("key")).select("a", "b", "m")


def _large_star(down: DataFrame) -> tuple[DataFrame, int]:
    """Each node's larger neighbours are linked with the least of it and its neighbours; how many links changed."""
    up = down.select(F.col("b").alias("node"), F.col("b").alias("other"))
    ends = down.select(F.col("a").alias("node"), F.col("b").alias("other")).unionByName(up)
    return materialize_counted(_with_least(down, ends, "b").select("a", F.col("m").alias("b"), (F.col("m") != F.col("b")).alias("changed")), "star-large", "changed")


def _small_star(down: DataFrame) -> tuple[DataFrame, int]:
    """Each node and its smaller neighbours are linked with the least of these; how many links changed."""
    ends = down.select(F.col("a").alias("node"), F.col("b").alias("other"))
    held = _with_least(down, ends, "a")
    aside = held.where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"), F.lit(True).alias("changed"))
    out = held.select("a", F.col("m").alias("b"), F.lit(False).alias("changed")).unionByName(aside)
    return materialize_counted(out.groupBy("a", "b").agg(F.max("changed").alias("changed")), "star-small", "changed")


def components(links: DataFrame) -> DataFrame:
    """node, component (the least node reachable) for every node of links (a, b: long).

    The two steps alternate until neither changes a link: then every node hangs on its component's
    least node alone. Links stay in tables; the driver learns only how many a step has changed.
    """
    current, before = links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")), None
    while True:
        large, moved = _large_star(current)
        small, joined = _small_star(large.select("a", "b"))
        discard(before, large)
        current, before = small.select("a", "b"), small
        if not moved + joined:
            break
    roots = current.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    out = current.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(roots)
    out._scratch_path = before._scratch_path
    return out


def star_links(merged: DataFrame) -> DataFrame:
    """a, b: the components again as links, fewer than nodes, to go on from with more links."""
    return merged.where("node <> component").select(F.col("node").alias("a"), F.col("component").alias("b"))
