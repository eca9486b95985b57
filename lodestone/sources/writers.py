"""Writers of text tables, through Spark's own writer and committer; sources/shards.py has those of the binary layouts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestone.sources.shards import write_mz, write_wfp

__all__ = ["write_lines", "write_mz", "write_version", "write_wfp"]


def write_lines(table: DataFrame, path: str, shard_key: str | None = None) -> None:
    """Comma-separated lines without quoting; with shard_key, a folder for each first byte, which the lines leave out."""
    if shard_key is None:
        table.select(F.concat_ws(",", *[F.col(c).cast("string") for c in table.columns]).alias("line")).write.mode("append").text(path)
        return
    columns = [F.substring(c, 3, 30) if c == shard_key else F.col(c).cast("string") for c in table.columns]
    lines = table.select(F.concat_ws(",", *columns).alias("line"), F.substring(shard_key, 1, 2).alias("p"))
    lines.repartition("p").sortWithinPartitions("p", "line").write.mode("append").partitionBy("p").text(path)


def write_version(version: DataFrame, path: str) -> None:
    version.select(F.to_json(F.struct("monthly", "daily")).alias("value")).coalesce(1).write.mode("overwrite").text(path)
