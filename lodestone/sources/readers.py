"""Readers: folders of files, packed archives, text tables, and the two binary layouts."""

from __future__ import annotations

import io
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestone.functions import values as V
from lodestone.functions.text import basename
from lodestone.sources import integrity
from lodestone.sources.archives import Unreadable, members, read_archives
from lodestone.sources.shards import read_mz, read_wfp

__all__ = ["Unreadable", "decode_field", "expand", "read_archives", "read_folder", "read_lines", "read_mz", "read_version", "read_wfp"]

def read_folder(spark: SparkSession, path: str, hidden: bool = False) -> DataFrame:
    """path, length, content of every regular file below a folder."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    files = files.where(F.length("path") < V.MAX_PATH)
    return files.select("path", "length", "content") if hidden else files.where(~F.startswith(basename(F.col("path")), F.lit("."))).select("path", "length", "content")


def expand(files: DataFrame, password: str | None = None, report: bool = False) -> DataFrame:
    """archive, archive_id (MD5 of the archive), path, content of every member of files (path, content) at hand; read_archives() streams them.

    An archive gives the members before what can't be read in it. With report there is a column error, and a row
    without path and content for each such archive.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for path, key, content in zip(batch.path, batch.archive_id, batch.content, strict=True):
                one = lambda member, data, error=None: pd.DataFrame({"archive": [path], "archive_id": [key], "path": [member], "content": [data], "error": [error]})  # noqa: B023, E731
                try:
                    for member, _, stream in members(path, io.BytesIO(content), password=password):
                        yield one(member, stream.read())
                except Unreadable as e:
                    yield one(None, None, str(e))

    rows = files.select("path", F.md5("content").alias("archive_id"), "content")
    unpacked = rows.mapInPandas(run, "archive string, archive_id string, path string, content binary, error string")
    return unpacked if report else unpacked.where("error IS NULL").drop("error")


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """line, shard (the folder p=.. or else the file's name up to the first dot) of text tables.

    A last line without a line end was cut off while it was written; only ended lines are returned. Which files have
    one is told from their ends alone; texts are read once, unless there are such.
    """
    read = spark.read.option("recursiveFileLookup", "true").option("lineSep", "\n").text(path)
    lines = read.select(F.col("value").alias("line"), F.col("_metadata.file_path").alias("file"))
    torn = integrity.torn(spark, path)
    if not torn.isEmpty():
        # Of the lines of a torn file that are as its tail is, one is the tail itself.
        tails = torn.select("file", F.col("tail").cast("string").alias("line"))
        alike = lines.join(tails, ["file", "line"]).groupBy("file", "line").agg(F.count("*").alias("n"))
        more = alike.where("n > 1").select(F.explode(F.array_repeat("line", F.col("n").cast("int") - 1)).alias("line"), "file")
        lines = lines.join(tails, ["file", "line"], "left_anti").select("line", "file").unionByName(more)
    folder, name = F.regexp_extract("file", "/p=([0-9a-f]{2})/", 1), F.regexp_extract("file", r"([^/.]*)(\.[^/]*)?$", 1)
    return lines.select("line", F.when(folder != "", folder).otherwise(name).alias("shard"))


def decode_field(rows: DataFrame, column: str, decoder: Callable[[Column], Column] | None = None) -> DataFrame:
    """Rows of an encoded table: a column holds base64, or what decoder (a column expression) undoes."""
    return rows.withColumn(column, decoder(F.col(column)) if decoder else F.decode(F.unbase64(column), "UTF-8"))


def read_version(spark: SparkSession, path: str) -> DataFrame:
    text = spark.read.text(path, wholetext=True)
    return text.select(F.from_json("value", "monthly string, daily string").alias("v")).select("v.*")
