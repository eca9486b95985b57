"""Mixing sources to target weights by temperature, as budgeted block permutations.

Source i with token share p_i gets the weight p_i^a / sum p_j^a. The exponent a in [0, 1] is the one
nearest to 1 (the natural mix) that reaches a target entropy, or the least (the flattest mix) under a
limit on repetitions; either is found by bisection. Without a budget the mix is just large enough
to hold every document once.

Each source's rows fall into BLOCKS blocks by hash. An epoch is a permutation of the blocks; a source
of r repetitions takes floor(r) whole epochs and a prefix of the next one: its first blocks, and in the
block where the budget runs out the rows of least hash. What decides about a row is one plan row per
source (copies by block, where it is cut), so rows are not shuffled or sorted by source, however
large one source is.

Defined results: null sources are one source; null and empty texts have 0 tokens and go with their
block; rows equal in id and text are one unit of the permutation; a source without tokens keeps
each row once; empty tables give an empty mix; other columns are ignored or ride along.
"""

from __future__ import annotations

from math import log

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestone.llm.common import WORD_PATTERN, discard, materialize

BLOCKS = 1024
CUT_BITS = 14  # a cut block has up to 2^14 parts, of which one is sorted
TRIED, ROUNDS = 32, 7  # exponents tried at once, and how often: an interval shrinks to 32^-7


def _rows(docs: DataFrame, id_col: str, text_col: str, source_col: str) -> DataFrame:
    h = F.xxhash64(F.col(id_col).cast("string"), F.col(text_col))
    tokens = F.coalesce(F.regexp_count(F.col(text_col), F.lit(WORD_PATTERN)), F.lit(0)).cast("long")
    return docs.select(F.col(source_col).alias("source"), h.alias("h"), F.pmod(h, F.lit(BLOCKS)).cast("int").alias("block"), tokens.alias("n_tokens"))


def _order(seed: int, source: str, epoch: str, block: str):
    """Sorting a source's blocks by this gives the permutation of one epoch."""
    return F.xxhash64(F.lit(seed), F.col(source), F.col(epoch), F.col(block))


def exponent(sources: DataFrame, entropy: float | None, max_repeats: float | None, budget: float | None) -> float:
    """The exponent for a target entropy (a share of the largest possible) or a repetition limit.

    sources: source and t (tokens), a row each. Only aggregates over all sources reach the driver.
    """
    total, most, n = sources.where("t > 0").agg(F.sum("t").cast("double"), F.max("t").cast("double"), F.count("*")).first()
    if not n:
        return 1.0
    low, high = 0.0, 1.0
    for _ in range(ROUNDS):
        tried = [low + (high - low) * k / (TRIED - 1) for k in range(TRIED)]
        p = F.col("t") / F.lit(total)
        sums = sources.where("t > 0").agg(*[F.sum(F.pow(p, F.lit(a))).alias(f"z{k}") for k, a in enumerate(tried)], *[F.sum(F.pow(p, F.lit(a)) * F.log(p)).alias(f"l{k}") for k, a in enumerate(tried)], F.min("t").cast("double").alias("least")).first()

        def flat_enough(k: int, a: float) -> bool:
            z = sums[f"z{k}"]
            if entropy is not None:  # H = log z - a * sum(w log p)
                return log(z) - a * sums[f"l{k}"] / z >= entropy * log(n) - 1e-12
            size = budget if budget is not None else most * z / (most / total) ** a
            return max((s / total) ** a / z * size / s for s in (sums["least"], most)) > max_repeats

        flat = [flat_enough(k, a) for k, a in enumerate(tried)]
        if entropy is not None:  # flat mixes come first; the last of them is nearest to the natural mix
            k = max((i for i, f in enumerate(flat) if f), default=0)
            low, high = tried[k], tried[min(k + 1, TRIED - 1)]
        else:  # mixes that repeat too much come first; the first that does not is the flattest
            k = min((i for i, f in enumerate(flat) if not f), default=TRIED - 1)
            low, high = tried[max(k - 1, 0)], tried[k]
    return low if entropy is not None else high


def mixing_plan(units: DataFrame, entropy: float | None = None, max_repeats: float | None = None, budget: float | None = None, seed: int = 1) -> DataFrame:
    """source, weight, repeats, epochs, blocks (copies of each), cut_block and cut_hash: a row for each source."""
    blocks = materialize(units.groupBy("source", "block").agg(F.sum("n_tokens").alias("b")), "mix-blocks")
    sources = materialize(blocks.groupBy("source").agg(F.sum("b").alias("t")), "mix-sources")
    a = exponent(sources, entropy, max_repeats, budget)
    total, most = sources.agg(F.sum("t").cast("double"), F.max("t").cast("double")).first()
    total, most = total or 1.0, most or 1.0
    z = sources.where("t > 0").agg(F.sum(F.pow(F.col("t") / F.lit(total), F.lit(a)))).first()[0] or 1.0
    size = budget if budget is not None else most * z / (most / total) ** a
    weight = F.when(F.col("t") > 0, F.pow(F.col("t") / F.lit(total), F.lit(a)) / F.lit(z)).otherwise(0.0)
    repeats = F.when(F.col("t") > 0, F.col("weight") * F.lit(float(size)) / F.col("t")).otherwise(1.0)
    plan = sources.withColumn("weight", weight).withColumn("repeats", repeats).withColumn("epochs", F.floor(F.col("repeats") + 1e-9).cast("int"))
    plan = plan.withColumn("quota", F.greatest(F.col("repeats") - F.col("epochs"), F.lit(0.0)) * F.col("t")).withColumn("quota", F.when(F.col("repeats") - F.col("epochs") < 1e-9, 0.0).otherwise(F.col("quota")))
    # A source has BLOCKS rows at most here, whatever it holds.
    near = plan.withColumnRenamed("source", "source_")
    placed = blocks.join(near, F.col("source").eqNullSafe(F.col("source_"))).withColumn("o", _order(seed, "source", "epochs", "block"))
    over = "(PARTITION BY source ORDER BY o, block ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
    placed = placed.withColumn("upto", F.expr(f"sum(b) OVER {over}")).withColumn("rank", F.expr("row_number() OVER (PARTITION BY source ORDER BY o, block)") - 1)
    whole = (F.col("upto") <= F.col("quota")) & (F.col("quota") > 0)
    cut = F.when((F.col("quota") > 0) & (F.col("upto") > F.col("quota")), F.struct("rank", "block", (F.col("quota") - F.col("upto") + F.col("b")).alias("rest")))
    entry = F.map_from_entries(F.collect_list(F.struct("block", (F.col("epochs") + whole.cast("int")).cast("int"))))
    by_source = placed.groupBy("source").agg(F.first("weight").alias("weight"), F.first("repeats").alias("repeats"), F.first("epochs").alias("epochs"), entry.alias("blocks"), F.min(cut).alias("cut"))
    by_source = materialize(by_source, "mix-plan")
    cuts = by_source.where("cut IS NOT NULL").select(F.col("source").alias("source_"), F.col("cut.block").alias("block_"), F.col("cut.rest").alias("rest"))
    hashes, inside = _cut_hashes(units, cuts)
    out = by_source.join(hashes, F.col("source").eqNullSafe(F.col("source_")), "left")
    full = materialize(out.select("source", "weight", "repeats", "epochs", "blocks", F.col("cut.block").alias("cut_block"), "cut_hash"), "mix-plan")
    discard(blocks, sources, by_source, inside)
    return full


def _cut_hashes(units: DataFrame, cuts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """source_ and cut_hash, the greatest hash that is still taken of each cut block; and the scratch table to discard.

    A cut block is a thousandth of its source, which may be large: it is summed by the leading CUT_BITS bits of the
    hash, and only the rows of the one part where the budget runs out are sorted.
    """
    rows = units.join(cuts, F.col("source").eqNullSafe(F.col("source_")) & (F.col("block") == F.col("block_")))
    part = F.call_function("shiftright", F.col("h"), F.lit(64 - CUT_BITS)).alias("part")
    inside = materialize(rows.groupBy("source", "rest", part, "h").agg(F.sum("n_tokens").alias("n")), "mix-cuts")
    parts = inside.groupBy("source", "rest", "part").agg(F.sum("n").alias("n"), F.max("h").alias("top"))
    parts = parts.withColumn("upto", F.expr("sum(n) OVER (PARTITION BY source ORDER BY part)"))
    fits = F.col("upto") <= F.col("rest")
    whole = parts.groupBy("source").agg(F.max(F.when(fits, F.col("top"))).alias("top"), F.min(F.when(~fits, F.struct("part", (F.col("upto") - F.col("n")).alias("before")))).alias("split"))
    # Sources and parts again, under other names: a row for each source.
    split = whole.where("split IS NOT NULL").select(F.col("source").alias("source_"), F.col("split.part").alias("part_"), F.col("split.before").alias("before"))
    last = inside.join(split, F.col("source").eqNullSafe(F.col("source_")) & (F.col("part") == F.col("part_"))).drop("source_")
    last = last.withColumn("upto", F.expr("before + sum(n) OVER (PARTITION BY source ORDER BY h)")).where("upto <= rest")
    last = last.groupBy(F.col("source").alias("source_")).agg(F.max("h").alias("last"))
    both = whole.join(last, F.col("source").eqNullSafe(F.col("source_")), "left")
    return both.select(F.col("source").alias("source_"), F.greatest("top", "last").alias("cut_hash")), inside


def in_order(mix: DataFrame) -> DataFrame:
    """The rows of mixed() in order of reading: by ranges of position, sorted within each, so that files written from it hold the permutation."""
    spark = mix.sparkSession
    # Maps have no hash of their own; their text stands for them.
    rest = [F.col(f"`{c}`").cast("string") if "map<" in kind else F.col(f"`{c}`") for c, kind in mix.dtypes if c != "__mix"]
    order = [F.col("__mix.position"), F.xxhash64("__mix.block", *rest)]
    return mix.repartitionByRange(int(spark.conf.get("spark.sql.shuffle.partitions")), *order).sortWithinPartitions(*order)


def mixed(docs: DataFrame, entropy: float | None = None, max_repeats: float | None = None, budget: float | None = None, seed: int = 1, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """The columns of docs, a row for each copy that the mix takes, and a struct __mix beside them.

    __mix: epoch, block, position (order of reading: sources interleave in proportion to their
    weights), weight and repeats of the source, n_tokens.
    """
    units = materialize(_rows(docs, id_col, text_col, source_col), "mix-rows")
    plan = mixing_plan(units, entropy, max_repeats, budget, seed)
    h = F.xxhash64(F.col(id_col).cast("string"), F.col(text_col))
    tokens = F.coalesce(F.regexp_count(F.col(text_col), F.lit(WORD_PATTERN)), F.lit(0)).cast("long")
    rows = docs.withColumn("__unit", F.struct(h.alias("h"), F.pmod(h, F.lit(BLOCKS)).cast("int").alias("block"), tokens.alias("n_tokens")))
    # A plan row per source: Spark broadcasts it while it is small, and splits hot sources otherwise.
    joined = rows.join(plan.select(F.struct("*").alias("__plan")), F.col(source_col).eqNullSafe(F.col("__plan.source")))
    in_cut = F.coalesce((F.col("__unit.block") == F.col("__plan.cut_block")) & (F.col("__unit.h") <= F.col("__plan.cut_hash")), F.lit(False))
    joined = joined.withColumn("__copies", F.element_at(F.col("__plan.blocks"), F.col("__unit.block")) + in_cut.cast("int")).where("__copies > 0")
    each = joined.withColumn("__epoch", F.explode(F.sequence(F.lit(0), F.col("__copies") - 1)))
    within = _order(seed, "__plan.source", "__epoch", "__unit.block") / F.lit(2.0**64) + 0.5
    position = (F.col("__epoch") + within) / F.col("__plan.repeats")
    mix = F.struct(F.col("__epoch").alias("epoch"), F.col("__unit.block").alias("block"), position.alias("position"), F.col("__plan.weight").alias("weight"), F.col("__plan.repeats").alias("repeats"), F.col("__unit.n_tokens").alias("n_tokens"))
    out = each.select(*[F.col(f"`{c}`") for c in docs.columns], mix.alias("__mix"))
    discard(units)
    return out
