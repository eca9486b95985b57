"""The knowledge base as a store of snapshots: tables of bucketed, sorted runs, and one manifest that says which belong.

A load writes a run for each table, dealt by a hash of the table's key into as many buckets as the table was made with, and
then publishes all of them at once: the manifest of the next snapshot is renamed into place, which fails if another load
was faster. A load that is killed before leaves folders that no manifest names; readers stay at the snapshot before.

A table is read as a bucketed table over its runs, so joins and aggregations on its key need no exchange on this side.
Rows that more than one run may hold are folded while they are read: the least path of each file and url, the least line of
each fingerprint and file, every other row once. compact() writes a table's runs as one, bucket by bucket.
"""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import asdict, dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestone.functions import values as V
from lodestone.operators import fingerprint, kb

#: The column that deals a table's rows; other tables are dealt by their first column.
KEYS = {"wfp": "wfp", "license": "id", "copyright": "id", "cryptography": "id", "quality": "id"}
#: Of rows that agree in the first columns, the least of the last one counts.
LEAST = {"file": (["file_id", "url_id"], "path"), "wfp": (["wfp", "file_id"], "line")}
#: Tables of contents, of which an id has one: rows whose id is stored are not added again.
CONTENTS = ("sources", "notices", "extra_sources")
MAX_RUNS = 8  # of a table, before a load compacts it


class SnapshotTaken(RuntimeError):
    """Another load has published since this one began; nothing of this one is seen, and it may be repeated."""


@dataclass
class Table:
    key: str
    schema: str
    buckets: int
    runs: list[str]


@dataclass
class Snapshot:
    number: int = 0
    tables: dict[str, Table] = field(default_factory=dict)
    version: dict[str, str] = field(default_factory=dict)
    batches: dict[str, int] = field(default_factory=dict)  # of each stream, the last batch that is in

    def next(self, tables: dict[str, Table], version: dict[str, str] | None = None, batches: dict[str, int] | None = None) -> Snapshot:
        return Snapshot(self.number + 1, self.tables | tables, version or self.version, self.batches | (batches or {}))


def key_of(name: str, columns: list[str]) -> str:
    return KEYS.get(name, columns[0])


# -- snapshots


def _files(spark: SparkSession, path: str):
    """The file system of a path, and a function that makes paths."""
    new = spark._jvm.org.apache.hadoop.fs.Path
    return new(path).getFileSystem(spark._jsc.hadoopConfiguration()), new


def snapshots(spark: SparkSession, path: str) -> list[int]:
    """Numbers of the published snapshots, in order."""
    fs, new = _files(spark, path)
    folder = new(f"{path}/_snapshots")
    found = fs.listStatus(folder) if fs.exists(folder) else []
    return sorted(int(n[:-5]) for n in (f.getPath().getName() for f in found) if n.endswith(".json"))


def snapshot(spark: SparkSession, path: str, number: int | None = None) -> Snapshot:
    """A snapshot, the last one by default; that of an empty store has number 0 and no tables."""
    if number is None:
        number = max(snapshots(spark, path), default=0)
    if number == 0:
        return Snapshot()
    fs, new = _files(spark, path)
    stream = fs.open(new(f"{path}/_snapshots/{number:010}.json"))
    try:
        read = json.loads(spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()
    return Snapshot(read["number"], {n: Table(**t) for n, t in read["tables"].items()}, read["version"], read["batches"])


def publish(spark: SparkSession, path: str, new: Snapshot) -> None:
    """Make a snapshot the last one. SnapshotTaken if its number is there already."""
    fs, make = _files(spark, path)
    fs.mkdirs(make(f"{path}/_snapshots"))
    temporary, final = make(f"{path}/_snapshots/.{uuid.uuid4().hex}"), make(f"{path}/_snapshots/{new.number:010}.json")
    stream = fs.create(temporary, False)
    try:
        stream.write(bytearray(json.dumps(asdict(new), indent=1).encode()))
    finally:
        stream.close()
    context = spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(final.toUri(), spark._jsc.hadoopConfiguration())
    plain = spark.sparkContext._gateway.new_array(spark._jvm.org.apache.hadoop.fs.Options.Rename, 0)
    try:
        context.rename(temporary, final, plain)  # fails where the target is there
    except Exception as e:
        fs.delete(temporary, False)
        if fs.exists(final):
            raise SnapshotTaken(f"snapshot {new.number} of {path} was published by another load") from e
        raise


# -- runs


@contextmanager
def _quiet_table(spark: SparkSession, name: str) -> Iterator[str]:
    try:
        yield name
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")  # of a table with a folder of its own, which stays


def buckets_for(spark: SparkSession) -> int:
    """As many as there are shuffle partitions, 8 at least: with fewer, joins would deal the table anew."""
    return max(8, int(spark.conf.get("spark.sql.shuffle.partitions")))


def write_run(rows: DataFrame, path: str, name: str, key: str, buckets: int, dealt: bool = False) -> str:
    """Write rows as a run of a table, a sorted file a bucket; its folder below path. dealt: rows are by bucket already."""
    run = f"{name}/run-{uuid.uuid4().hex}"
    rows = rows if dealt else rows.repartition(buckets, key)
    with _quiet_table(rows.sparkSession, f"lodestone_{uuid.uuid4().hex}") as table:
        rows.write.bucketBy(buckets, key).sortBy(key).option("path", f"{path}/{run}").saveAsTable(table)
    return run


def scan(spark: SparkSession, path: str, table: Table, *others: tuple[str, Table]) -> DataFrame:
    """The rows of a table's runs as they are, in its buckets; of others with the same columns and buckets too.

    The catalogue gets an entry for each set of runs, once: a bucketed table whose partitions are the runs' folders.
    """
    folders = [f"{p}/{run}" for p, t in ((path, table), *others) for run in t.runs]
    name = "lodestone_" + hashlib.md5("\n".join([table.key, table.schema, str(table.buckets), *folders]).encode()).hexdigest()
    if not spark.catalog.tableExists(name):
        spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({table.schema}, __run int) USING parquet PARTITIONED BY (__run) CLUSTERED BY ({table.key}) SORTED BY ({table.key}) INTO {table.buckets} BUCKETS LOCATION '{path}/_none'")
        places = " ".join(f"PARTITION (__run={k}) LOCATION '{folder}'" for k, folder in enumerate(folders))
        if places:
            spark.sql(f"ALTER TABLE {name} ADD IF NOT EXISTS {places}")
    return spark.table(name).drop("__run")


def _folded(rows: DataFrame, name: str) -> DataFrame:
    if name in LEAST:
        same, least = LEAST[name]
        return rows.groupBy(*same).agg(F.min(least).alias(least)).select(*rows.columns)
    return rows if name in CONTENTS else rows.dropDuplicates()


def stored(spark: SparkSession, path: str, table: Table, name: str) -> DataFrame:
    """Every row of a table once, before rows are judged."""
    rows = scan(spark, path, table)
    return _folded(rows, name) if len(table.runs) > 1 else rows


def open_table(spark: SparkSession, path: str, name: str, number: int | None = None) -> DataFrame:
    """A table of a snapshot, the last one by default. Files whose least path is rejected are left out here, whichever load brought it."""
    seen = snapshot(spark, path, number)
    if name not in seen.tables:
        raise KeyError(f"{path} has no table {name}")
    rows = stored(spark, path, seen.tables[name], name)
    return kb.fit_files(rows) if name == "file" else rows


def add(spark: SparkSession, path: str, seen: Snapshot, name: str, rows: DataFrame, overwrite: bool = False) -> Table:
    """Write rows as a run for a table of a snapshot to come; the table with it. Only a load's own repeats are folded."""
    key = key_of(name, rows.columns)
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema)
    old = None if overwrite else seen.tables.get(name)
    if old and old.schema != schema:
        raise ValueError(f"{name} has the columns {old.schema}, not {schema}")
    buckets = old.buckets if old else buckets_for(spark)
    if name in CONTENTS:
        # Texts move once, to their bucket; what is stored is read by key alone, where it lies.
        rows = rows.repartition(buckets, key).dropDuplicates([key])
        if old:
            rows = rows.join(scan(spark, path, old).select(key), key, "left_anti")
    else:
        rows = _folded(rows, name)
    run = write_run(rows, path, name, key, buckets)
    table = Table(key, schema, buckets, [*(old.runs if old else []), run])
    return compacted(spark, path, table, name) if len(table.runs) > MAX_RUNS else table


def compacted(spark: SparkSession, path: str, table: Table, name: str) -> Table:
    """The same rows as one run; each bucket is folded and sorted where it lies."""
    if len(table.runs) < 2:
        return table
    rows = stored(spark, path, table, name)
    return Table(table.key, table.schema, table.buckets, [write_run(rows, path, name, table.key, table.buckets, dealt=True)])


def compact(spark: SparkSession, path: str, names: list[str] | None = None) -> Snapshot:
    """Write the runs of tables as one each, as a snapshot of its own."""
    old = snapshot(spark, path)
    tables = {n: compacted(spark, path, t, n) if names is None or n in names else t for n, t in old.tables.items()}
    new = old.next(tables)
    publish(spark, path, new)
    return new


def vacuum(spark: SparkSession, path: str, keep: int = 2) -> list[str]:
    """Delete runs that none of the last snapshots names, and the manifests before these; the runs deleted.

    Not to be called while a load is under way, whose runs no manifest names yet.
    """
    numbers = snapshots(spark, path)
    named = {run for n in numbers[-keep:] for t in snapshot(spark, path, n).tables.values() for run in t.runs}
    fs, new = _files(spark, path)
    gone = []
    for table in fs.listStatus(new(path)):
        if table.isDirectory() and not table.getPath().getName().startswith("_"):
            for run in fs.listStatus(table.getPath()):
                name = f"{table.getPath().getName()}/{run.getPath().getName()}"
                if name not in named:
                    fs.delete(run.getPath(), True)
                    gone.append(name)
    for n in numbers[:-keep]:
        fs.delete(new(f"{path}/_snapshots/{n:010}.json"), False)
    return sorted(gone)


# -- questions to a store


def urls_of_files(spark: SparkSession, path: str, files: DataFrame) -> DataFrame:
    """file_id, and the row of every url that holds it, for the file_id in files. Files go to the store, not the store to them."""
    wanted = files.select("file_id").distinct()
    held = open_table(spark, path, "file").join(wanted, "file_id").select("file_id", "url_id").distinct()
    urls = open_table(spark, path, "url")
    return held.join(urls, "url_id").select("file_id", *urls.columns)


def snippet_matches(spark: SparkSession, path: str, queries: DataFrame) -> DataFrame:
    """query_id, file_id, hits: files of the store that share fingerprints with those of queries (file_id, wfp)."""
    return fingerprint.snippet_matches(queries, open_table(spark, path, "wfp"))


def facts_of_files(spark: SparkSession, path: str, name: str, files: DataFrame) -> DataFrame:
    """The rows of a fact table (license, copyright, cryptography, quality) for the file_id in files."""
    wanted = files.select(F.col("file_id").alias("id")).distinct()
    return open_table(spark, path, name).join(wanted, "id")


def merge(spark: SparkSession, source: str, target: str, out: str) -> Snapshot:
    """Two stores' tables as a third store: rows of either once, under the rules of loading.

    Everything is compared before anything is written: both must be stores, and different ones, out must be neither of
    them and empty, and tables must have the same columns. Tables with equal buckets are merged bucket by bucket.
    """
    fs, new = _files(spark, source)
    plain = [fs.makeQualified(new(p)).toString() for p in (source, target, out)]
    if len(set(plain)) < 3:
        raise ValueError("source, target and out must be three folders")
    sides = [(p, snapshot(spark, p)) for p in (source, target)]
    for p, side in sides:
        if not side.number:
            raise ValueError(f"{p} is no store")
    if snapshots(spark, out):
        raise ValueError(f"{out} is a store already")
    names = dict.fromkeys(n for _, side in sides for n in side.tables)
    for name in names:
        if len({side.tables[name].schema for _, side in sides if name in side.tables}) > 1:
            raise ValueError(f"{name}: tables of different columns can't be merged")
    tables = {}
    for name in names:
        both = [(p, side.tables[name]) for p, side in sides if name in side.tables]
        first, dealt = both[0][1], len({t.buckets for _, t in both}) == 1
        rows = scan(spark, *both[0], *(both[1:] if dealt else []))
        for other in [] if dealt else both[1:]:
            rows = kb.merge(rows, scan(spark, *other))
        rows = rows.dropDuplicates([first.key]) if name in CONTENTS else _folded(rows, name)
        tables[name] = Table(first.key, first.schema, first.buckets, [write_run(rows, out, name, first.key, first.buckets, dealt)])
    versions = [side.version for _, side in sides]
    known = lambda k: next((v[k] for v in versions if v.get(k, "N/A") != "N/A"), "N/A")
    merged = Snapshot(1, tables, {k: known(k) for k in V.VERSION} if any(versions) else {})
    publish(spark, out, merged)
    return merged
