"""Sharding by extendible hashing, in DataFrame operations alone.

A document's key hash is a row of bits. The directory starts with one bucket of no bits; a bucket
over the byte limit, and only such a bucket, is split on the next bit, until each one fits. The sizes of
all buckets of STEP bits come from one aggregation, summed up to every shorter prefix; the next
STEP bits are then looked at inside the buckets that are still too large, and nowhere else.

The first 60 bits come from the key. Rows of one key have them in common: where such a bucket is
still too large, 60 further bits of the row's place in the table part it, so equal keys (and equal
rows) may be any share of the input. A single row over the limit is a shard by itself, over size.

Defined results: null texts count 0 bytes; null keys hash as the empty string; an empty table has no
shards; other columns are ignored by assign_shards() and written by write_shards().
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestone.llm.common import discard, materialize

STEP = 15
KEY_BITS, ALL_BITS = 60, 120


def _word(text):
    """60 bits of md5."""
    return F.conv(F.substring(F.md5(text.cast("string").cast("binary")), 1, 15), 16, 10).cast("long")


def _prefix(bits):
    """The first bits (a column) of a row's 120: the leading part of h, then that of tie."""
    first = F.call_function("shiftright", F.col("h"), F.greatest(F.lit(KEY_BITS) - bits, F.lit(0)).cast("int"))
    rest = F.call_function("shiftright", F.col("tie"), F.least(F.greatest(F.lit(ALL_BITS) - bits, F.lit(0)), F.lit(KEY_BITS)).cast("int"))
    text = lambda x, n: F.when(n > 0, F.lpad(F.bin(x), n.cast("int"), "0")).otherwise("")
    return F.concat(text(first, F.least(bits, F.lit(KEY_BITS))), text(rest, F.greatest(bits - KEY_BITS, F.lit(0))))


def directory(rows: DataFrame, limit: int) -> DataFrame:
    """shard (its bits as text), depth, shard_bytes and shard_docs of every bucket that was kept."""
    out = None
    # Full prefixes of the step before stand for buckets that must be split further.
    active, base = rows, 0
    while base < ALL_BITS:
        upto = base + STEP
        last = upto >= ALL_BITS
        fine = active.groupBy(_prefix(F.lit(upto)).alias("bits")).agg(F.sum("n_bytes").alias("b"), F.count("*").alias("n"))
        depths = F.explode(F.sequence(F.lit(base), F.lit(upto))).alias("depth")
        sums = fine.select(depths, "bits", "b", "n").groupBy("depth", F.expr("substring(bits, 1, depth)").alias("shard")).agg(F.sum("b").alias("shard_bytes"), F.sum("n").alias("shard_docs"))
        sums = materialize(sums, "shard-sums")
        fits = (F.col("shard_bytes") <= limit) | (F.col("shard_docs") == 1)
        parents = sums.where(~fits).select((F.col("depth") + 1).alias("d"), F.col("shard").alias("p"))
        first = sums.where((F.col("depth") == base) & fits) if base == 0 else sums.limit(0)
        below = sums.where((F.col("depth") > base) & (fits | (F.lit(last) & (F.col("depth") == upto))))
        kept = below.join(parents, (F.col("depth") == F.col("d")) & (F.expr("substring(shard, 1, depth - 1)") == F.col("p")), "left_semi")
        found = first.unionByName(kept).select("shard", "depth", "shard_bytes", "shard_docs")
        out = found if out is None else out.unionByName(found)
        over = sums.where((F.col("depth") == upto) & ~fits).select(F.col("shard").alias("p"))
        if last or over.isEmpty():
            break
        active, base = rows.join(over, _prefix(F.lit(upto)) == F.col("p"), "left_semi"), upto
    return out


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """id, n_bytes and the 120 bits (h, tie) of every row, and the columns of docs as a struct doc."""
    size = F.coalesce(F.octet_length(text_col), F.lit(0)).cast("long")
    key = _word(F.coalesce(F.col(id_col).cast("string"), F.lit("")))
    return docs.select(F.col(id_col).alias("id"), size.alias("n_bytes"), key.alias("h"), _word(F.monotonically_increasing_id()).alias("tie"), F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"))


def assign_shards(docs: DataFrame, limit: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, shard, depth, n_bytes, shard_bytes and shard_docs of every row."""
    rows = materialize(_keyed(docs, id_col, text_col).select("id", "n_bytes", "h", "tie"), "shard-rows")
    leaves = materialize(directory(rows, limit), "shard-directory")
    depths = [r.depth for r in leaves.select("depth").distinct().collect()]  # 121 at most
    if not depths:
        return rows.select(F.col("id").alias(id_col), F.lit("").alias("shard"), F.lit(0).alias("depth"), "n_bytes", F.lit(0).cast("long").alias("shard_bytes"), F.lit(0).cast("long").alias("shard_docs"))
    # A row has one prefix in the directory; the rows of one bucket hold limit bytes at most, so no key is hot
    # but for tiny rows, which skew joins split.
    at = F.array(*[F.lit(d) for d in sorted(depths)])
    tried = rows.select("id", "n_bytes", F.explode(F.transform(at, lambda d: _prefix(d))).alias("shard"))
    return tried.join(leaves, "shard").select(F.col("id").alias(id_col), "shard", "depth", "n_bytes", "shard_bytes", "shard_docs")


def write_shards(docs: DataFrame, path: str, limit: int, id_col: str = "doc_id", text_col: str = "text", shard_col: str = "shard_bits") -> DataFrame:
    """Write all columns of docs below path, a folder for each shard; what was written: shard, depth, shard_bytes, shard_docs.

    A folder is named by the bits after a b (shard_bits=b0110), which readers find in the column shard_col. A shard is one
    file, or as many as spark.sql.files.maxRecordsPerFile makes. path must not exist yet, and docs have no column shard_col.
    """
    if shard_col.lower() in [c.lower() for c in docs.columns]:
        raise ValueError(f"documents have a column {shard_col}: name another for the shards")
    # Numbers of places hold for one reading of the table, so they are written with the rows.
    rows = materialize(_keyed(docs, id_col, text_col), "shard-texts")
    leaves = materialize(directory(rows.select("n_bytes", "h", "tie"), limit), "shard-directory")
    depths = sorted(r.depth for r in leaves.select("depth").distinct().collect())  # 121 at most
    # Keys find their shard without their texts, which then are dealt by shard: none is over the limit, so no task is large.
    tried = rows.select("h", "tie", F.explode(F.array(*[_prefix(F.lit(d)) for d in depths or [0]])).alias("shard"))
    placed = materialize(tried.join(leaves.select("shard"), "shard", "left_semi"), "shard-placed")
    out = rows.join(placed, ["h", "tie"]).select("doc.*", F.concat(F.lit("b"), "shard").alias(shard_col))
    out.repartition(shard_col).write.partitionBy(shard_col).parquet(path)
    discard(rows, placed)
    return leaves
