"""A handler for the records of archive shards, as a table function: one record at a time, whatever a shard's size."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.functions import udtf

from lodestone.sources.integrity import listed
from lodestone.sources.shards import mz_records
from lodestone.sources.storage import opened

RECORD = "file_id string, content binary, at long, error string"


def record_function(handler: Callable[[str, bytes], Iterable[tuple]] | None = None, schema: str = RECORD):
    """A table function of a shard's path and size: its records, or the rows that handler makes of each intact one (id, content)."""

    class Records:
        def eval(self, path: str, size: int):
            system, place = opened(unquote(path))
            for file_id, content, at, error in mz_records(system, place, size):
                if handler is None:
                    yield file_id, content, at, error
                elif content is not None:
                    yield from handler(file_id, content)

    return udtf(Records, returnType=schema)


def register(spark: SparkSession, name: str = "mz_records", handler: Callable[[str, bytes], Iterable[tuple]] | None = None, schema: str = RECORD) -> None:
    """Make the function known to SQL: SELECT r.* FROM shards, LATERAL mz_records(file, size) r."""
    spark.udtf.register(name, record_function(handler, schema))


def handled(spark: SparkSession, path: str, handler: Callable[[str, bytes], Iterable[tuple]] | None = None, schema: str = RECORD, name: str = "mz_records") -> DataFrame:
    """What the handler makes of every record of the archive shards below path."""
    register(spark, name, handler, schema)
    return spark.sql(f"SELECT r.* FROM {{shards}} s, LATERAL {name}(s.file, s.size) r", shards=listed(spark, path, "*.mz"))
