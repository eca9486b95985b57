"""Archive maintenance: rows (file_id, content: text) of stored files."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestone.functions import predicates as P
from lodestone.functions import values as V
from lodestone.functions.text import byte_view


def intact(file_id, content):
    """The last 14 bytes of the id are those of the content's MD5; a content that can't be read is none."""
    return F.coalesce(F.substring(F.md5(content.cast("binary")), 5, 28) == F.substring(file_id, 5, 28), F.lit(False))


def _first(archive: DataFrame) -> DataFrame:
    """The rows of archive with first: corrupted, small, square, header or null."""
    view = byte_view(F.col("content"))
    first = (
        F.when(~intact(F.col("file_id"), F.col("content")), "corrupted")
        .when(F.length(view) < V.MIN_FILE, "small")
        .when(P.too_square(view), "square")
        .when(P.unwanted_start(view), "header")
    )
    return archive.select("file_id", "content", first.alias("first"))


def verdicts(archive: DataFrame, excluded: DataFrame | None = None, known_files: DataFrame | None = None) -> DataFrame:
    """file_id, verdict of every row: corrupted, small, square, header, duplicate, excluded, orphan or keep.

    Only rows that pass the first four can be duplicates; one row of each id stays. One pass over the contents, of which
    none is shuffled: rows of one id and verdict are counted where they are read.
    """
    counted = _first(archive).groupBy("file_id", "first").agg(F.count("*").alias("n"))
    fate = F.lit("keep")
    if known_files is not None:
        counted = counted.join(known_files.select("file_id").distinct().withColumn("known", F.lit(True)), "file_id", "left")
        fate = F.when(F.col("known").isNull(), "orphan").otherwise(fate)
    if excluded is not None:
        counted = counted.join(excluded.select("file_id").distinct().withColumn("out", F.lit(True)), "file_id", "left")
        fate = F.when(F.col("out"), "excluded").otherwise(fate)
    each = counted.select("file_id", "first", fate.alias("fate"), F.explode(F.sequence(F.lit(1), F.col("n").cast("int"))).alias("k"))
    return each.select("file_id", F.coalesce("first", F.when(F.col("k") == 1, F.col("fate")).otherwise("duplicate")).alias("verdict"))


def report(judged: DataFrame) -> DataFrame:
    return judged.groupBy("verdict").agg(F.count("*").alias("n"))


def optimised(archive: DataFrame, excluded: DataFrame | None = None, known_files: DataFrame | None = None) -> DataFrame:
    """The rows that stay. Rows of one id have one content here, so any of them will do."""
    good = _first(archive).where("first IS NULL").select("file_id", "content")
    if known_files is not None:
        good = known(good, known_files)
    if excluded is not None:
        good = without(good, excluded)
    return good.dropDuplicates(["file_id"])


def unique(archive: DataFrame) -> DataFrame:
    """One row of each id, whatever it holds: the least content."""
    return archive.groupBy("file_id").agg(F.min("content").alias("content"))


def without(archive: DataFrame, keys: DataFrame) -> DataFrame:
    return archive.join(keys.select("file_id"), "file_id", "left_anti")


def known(archive: DataFrame, files: DataFrame) -> DataFrame:
    return archive.join(files.select("file_id"), "file_id", "left_semi")


def listing(archive: DataFrame) -> DataFrame:
    return archive.select("file_id", F.octet_length("content").alias("n_bytes"), intact(F.col("file_id"), F.col("content")).alias("intact"))


def keys(archive: DataFrame) -> DataFrame:
    return archive.select("file_id").distinct()


def extract(archive: DataFrame, asked: DataFrame | str) -> DataFrame:
    """What the archive holds under a key, or under each of the keys of a table (file_id), in either case."""
    if isinstance(asked, str):
        return archive.where(F.col("file_id") == asked.lower())
    return known(archive, asked.select(F.lower("file_id").alias("file_id")))
