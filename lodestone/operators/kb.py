"""Loading, merging and laying out the knowledge base: text lines in, deduplicated tables out."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestone.functions import predicates as P
from lodestone.functions import values as V
from lodestone.functions.text import csv_fields, field


def sort_unique(lines: DataFrame, line: str = "line") -> DataFrame:
    """Distinct lines of a table, in byte order within partitions."""
    return lines.select(line).distinct().sortWithinPartitions(line)


def admissible(lines: DataFrame, n_fields: int, line: str = "line") -> DataFrame:
    """Lines of a possible length: an id, the commas and a line end at least, MAX_CSV_LINE bytes at most."""
    size = F.octet_length(line) + 1
    return lines.where((size >= 32 + n_fields + 1) & (size <= V.MAX_CSV_LINE))


def with_fields(lines: DataFrame, table: str, line: str = "line", keep: tuple[str, ...] = ()) -> DataFrame:
    """Lines that have a table's number of fields, split into its columns; columns to keep ride along."""
    names = V.TABLES[table]
    kept = lines.where(P.has_fields(F.col(line), len(names)))
    return kept.select(*[field(F.col(line), i + 1).alias(n) for i, n in enumerate(names)], *keep)


def decoded_key(key, shard=None):
    """A full id; a key of 30 digits takes its first byte from the shard's name."""
    return F.when((F.length(key) == 30) & F.lit(shard is not None), F.concat(shard if shard is not None else F.lit(""), key)).otherwise(key)


def load_files(lines: DataFrame, shard: str = "shard", line: str = "line") -> DataFrame:
    """file_id, url_id, path of a sharded file table.

    The least path of each (file, url) is taken first; it is judged afterwards, so that a rejected path
    takes its siblings with it.
    """
    return fit_files(least_paths(lines, shard, line))


def least_paths(lines: DataFrame, shard: str = "shard", line: str = "line") -> DataFrame:
    """file_id, url_id and the least path of the two, before it is judged."""
    known = lines.where((F.octet_length(line) <= V.MAX_CSV_LINE - 1) & (csv_fields(F.col(line)) >= 3))
    rest = F.regexp_extract(line, "^[^,]*,[^,]*,(.*)$", 1)
    rows = known.select(decoded_key(field(F.col(line), 1), F.col(shard)).alias("file_id"), field(F.col(line), 2).alias("url_id"), rest.alias("path"))
    return rows.groupBy("file_id", "url_id").agg(F.min("path").alias("path"))


def fit_files(least: DataFrame) -> DataFrame:
    """Rows of least_paths() whose id and path are admitted."""
    return least.where(P.valid_md5(F.col("file_id")) & ~P.reserved_id(F.col("file_id")) & ~F.contains("path", F.lit(",")) & ~P.ignored_ending(F.col("path")))


def load_pivot(lines: DataFrame, shard: str = "shard", line: str = "line") -> DataFrame:
    rows = lines.where(P.has_fields(F.col(line), 2)).select(decoded_key(field(F.col(line), 1), F.col(shard)).alias("url_id"), field(F.col(line), 2).alias("file_id"))
    return rows.distinct()


def load_purl(lines: DataFrame, line: str = "line") -> tuple[DataFrame, DataFrame]:
    """The two forms of the purl table: facts (seven fields) and relations (two)."""
    facts = with_fields(lines, "purl", line)
    related = lines.where(P.has_fields(F.col(line), 2)).select(field(F.col(line), 1).alias("purl_id"), field(F.col(line), 2).alias("related"))
    return facts, related


def grouped(table: DataFrame, key: str = "id") -> DataFrame:
    """Extension view: the records of each key. Meant for keys of few records; a hot key makes a long list."""
    rest = [c for c in table.columns if c != key]
    return table.groupBy(key).agg(F.sort_array(F.collect_list(F.struct(*rest))).alias("records"))


def merge(a: DataFrame, b: DataFrame) -> DataFrame:
    """The rows of both; their columns must agree."""
    if [(f.name, f.dataType) for f in a.schema] != [(f.name, f.dataType) for f in b.schema]:
        raise ValueError("tables of different columns can't be merged")
    return a.unionByName(b)


def write_table(table: DataFrame, path: str, key: str, overwrite: bool = False) -> None:
    """Write by the first byte of the key (256 folders), sorted by key; a folder gets as many tasks and files as there are shuffle partitions for it."""
    sharded = table.withColumn("p", F.substring(key, 1, 2))
    n = max(256, int(table.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    sharded.repartition(n, "p", F.pmod(F.xxhash64(key), F.lit(n // 256))).sortWithinPartitions("p", key).write.mode("overwrite" if overwrite else "append").partitionBy("p").parquet(path)


def shard_histogram(table: DataFrame, key: str) -> DataFrame:
    return table.groupBy(F.substring(key, 1, 2).alias("p")).agg(F.count("*").alias("n"))


def version(new: DataFrame, old: DataFrame) -> DataFrame:
    """monthly, daily: what new lacks comes from old; N/A stands for neither. A row each at most."""
    one = lambda df, tag: df.agg(F.max(F.nullif("monthly", F.lit("N/A"))).alias(f"{tag}m"), F.max(F.nullif("daily", F.lit("N/A"))).alias(f"{tag}d"))
    both = one(new, "n").withColumn("k", F.lit(1)).join(one(old, "o").withColumn("k", F.lit(1)), "k")
    return both.select(F.coalesce("nm", "om", F.lit("N/A")).alias("monthly"), F.coalesce("nd", "od", F.lit("N/A")).alias("daily"))


def validation(lines: DataFrame, table: str, line: str = "line") -> DataFrame:
    """problem, n: what is wrong with a table's lines, before they are loaded."""
    n = len(V.TABLES[table])
    problem = (
        F.when(F.octet_length(line) + 1 > V.MAX_CSV_LINE, "line too long")
        .when(~P.has_fields(F.col(line), n), "wrong number of fields")
        .when(~field(F.col(line), 1).rlike("^[0-9a-f]{30,32}$"), "no valid id")
        .when(P.reserved_id(field(F.col(line), 1)), "reserved id")
    )
    return lines.select(problem.alias("problem")).where("problem IS NOT NULL").groupBy("problem").agg(F.count("*").alias("n"))
