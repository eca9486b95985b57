"""Extension: a stream of new components goes through the same detectors and is appended to the knowledge base."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestone.plans import mining

FILES = "url_id string, path string, text string, seen timestamp"


def stream_files(spark: SparkSession, path: str) -> DataFrame:
    return spark.readStream.schema(FILES).parquet(path)


def new_contents(files: DataFrame, delay: str = "1 day") -> DataFrame:
    """Each content once within the watermark's reach; state older than that is dropped."""
    marked = files.withColumn("file_id", F.md5("text")).withWatermark("seen", delay)
    return marked.dropDuplicatesWithinWatermark(["url_id", "file_id", "path"])


def ingest(spark: SparkSession, source: str, kb_path: str, checkpoint: str, components: DataFrame, only: list[str] | None = None, on_batch: Callable | None = None):
    """Start a query that mines each batch and loads its tables into a store, a snapshot each; returns the StreamingQuery.

    The checkpoint's folder names the stream, so a batch that is repeated after a failure is loaded once.
    """
    stream_name = checkpoint.rstrip("/").rpartition("/")[2]

    def batch(files: DataFrame, batch_id: int) -> None:
        tables = mining.mine(files.drop("file_id", "seen"), components, at=f"{kb_path}/_facts/{stream_name}")
        mining.save(tables, kb_path, only, batch=(stream_name, batch_id))  # a repeated batch is in the store already
        if on_batch:
            on_batch(batch_id)

    stream = new_contents(stream_files(spark, source)).writeStream.foreachBatch(batch)
    return stream.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
