"""Mining a component: from its files to one fact table for each question."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestone.functions import predicates as P
from lodestone.functions import values as V
from lodestone.functions.predicates import fingerprintable
from lodestone.functions.dictionaries import crypto_dictionary, license_dictionary
from lodestone.functions.text import basename, byte_view, field, purl_id, version_id
from lodestone.operators import detect, fingerprint, kb, store
from lodestone.operators.outcome import ARCHIVED, LISTED, MINED, outcome
from lodestone.sources import readers
from lodestone.sources.storage import exists


def component(spark: SparkSession, metadata: str, download_url: str = "", archive_id: str | None = None) -> DataFrame:
    """A component's row: metadata are six fields; a local folder's id is the MD5 of the metadata."""
    row = parsed_metadata(spark.createDataFrame([(metadata, download_url)], "metadata string, download_url string"))
    if metadata.count(",") != len(V.METADATA) - 1:
        raise ValueError(f"metadata needs {len(V.METADATA)} fields: {', '.join(V.METADATA)}")
    return with_ids(row.withColumn("url_id", F.lit(archive_id) if archive_id else F.md5("metadata")).drop("metadata"))


def parsed_metadata(rows: DataFrame, column: str = "metadata") -> DataFrame:
    """Rows whose metadata have as many fields as they must, with a column for each field."""
    names = V.METADATA
    return rows.where(P.has_fields(F.col(column), len(names))).withColumns({n: field(F.col(column), i + 1) for i, n in enumerate(names)})


def with_ids(components: DataFrame) -> DataFrame:
    return components.withColumns({"purl_id": purl_id(F.col("purl")), "version_id": version_id(F.col("purl"), F.col("version"))})


def judged(files: DataFrame, all_extensions: bool = False, keep_rejected: bool = False, least: int = V.MIN_FILE) -> DataFrame:
    """files (url_id, path, text) with file_id and outcome; a null text is an empty file."""
    empty = F.lit("").cast(files.schema["text"].dataType)
    marked = files.withColumn("text", F.coalesce("text", empty)).withColumn("file_id", F.md5(F.col("text").cast("binary")))
    return marked.withColumn("outcome", outcome(F.col("path"), byte_view(F.col("text")), F.col("file_id"), all_extensions, keep_rejected, least))


def facts(files: DataFrame, components: DataFrame, licenses: DataFrame | None = None, crypto: DataFrame | None = None, **options) -> DataFrame:
    """A row for each file with all that the detectors say of it, from one pass over the texts; nothing is shuffled.

    url_id, path, file_id, outcome, notice (an attribution notice of a known component), licenses, root_licenses (of a
    license file in the root), copyright, notice_copyright, algorithms, score, wfps.
    """
    spark = files.sparkSession
    licenses = license_dictionary(spark) if licenses is None else licenses
    crypto = crypto_dictionary(spark) if crypto is None else crypto
    rows = judged(files, **options).withColumn("bytes", F.col("text").cast("binary"))
    mined, archived = F.col("outcome").isin(*MINED), F.col("outcome").isin(*ARCHIVED)
    notice = P.is_notice(F.col("path")) & (F.octet_length("bytes") >= options.get("least", V.MIN_FILE))
    root = ~F.contains("path", F.lit("/")) & P.license_name(basename(F.col("path")))
    head = detect.start_of(F.col("bytes"), max(detect.HEAD, detect.LICENSE_HEAD))
    # What Python detectors get: the texts that they are for, and nulls for the others.
    seen = rows.withColumns({"mined": mined, "notice": notice, "root": root, "head": head, "fit": archived & fingerprintable(byte_view(F.col("bytes")))})
    only = lambda flag, column: F.when(F.col(flag), column)
    statement = detect.copyright_statement(F.col("head"))
    found = {
        "licenses": only("mined", detect.license_facts(F.col("head"), licenses)),
        "root_licenses": only("root", detect.license_facts(F.col("head"), licenses, license_file=True)),
        "statement": F.when(F.col("mined") | F.col("notice"), statement),
        "algorithms": detect.algorithm_finder(crypto)(only("mined", F.col("bytes"))),
        "score": only("mined", detect.quality_score(byte_view(F.col("bytes")))),
        "wfps": fingerprint.fingerprint_finder()(only("fit", F.col("bytes"))),
    }
    return seen.select("url_id", "path", "file_id", "outcome", "mined", "notice", *[c.alias(n) for n, c in found.items()])


def mine(files: DataFrame, components: DataFrame, licenses: DataFrame | None = None, crypto: DataFrame | None = None, at: str | None = None, **options) -> dict[str, DataFrame]:
    """Every table of the knowledge base, from files (url_id, path, text) and their components.

    text is a string or the bytes of a file. With at, a folder, the facts of all files are written there first, by one pass
    over the texts, and all tables but those of contents are read from them. Without, each table makes its pass when it is
    asked for. Facts are put together by file after they were found, as they are small and texts are not.
    """
    rows = facts(files, components, licenses, crypto, **options)
    if at:
        rows.write.mode("overwrite").parquet(at)
        rows = files.sparkSession.read.schema(rows.schema).parquet(at)
    texts = judged(files, **options)
    archived, extra = texts.where(F.col("outcome").isin(*ARCHIVED)), texts.where("outcome = 'extra'")
    listed, mined = rows.where(F.col("outcome").isin(*LISTED)), rows.where("mined")
    ids = components.select(F.col("url_id").alias("url_"), "purl_id", "version_id")
    notices = rows.where("notice").join(ids, F.col("url_id") == F.col("url_")).where("purl_id IS NOT NULL")
    root = rows.where("root_licenses IS NOT NULL").join(ids, F.col("url_id") == F.col("url_")).where("version_id IS NOT NULL")
    licenses_of = lambda df, key, column: df.select(F.col(key).alias("id"), F.explode(column).alias("x")).select("id", "x.source", "x.spdx_id")
    said = lambda df, key, source: df.where("statement IS NOT NULL").select(F.col(key).alias("id"), F.lit(source).alias("source"), "statement")
    contents = lambda df: df.select("file_id", F.col("text").alias("content")).dropDuplicates(["file_id"])
    noticed = texts.where(P.is_notice(F.col("path")) & (F.octet_length("text") >= options.get("least", V.MIN_FILE))).join(ids.where("purl_id IS NOT NULL"), F.col("url_id") == F.col("url_"), "left_semi")
    return {
        "url": components.select(*V.TABLES["url"]),
        "file": listed.select("file_id", "url_id", P.first_comma_replaced(F.col("path")).alias("path")),
        "pivot": listed.select("url_id", "file_id").distinct(),
        "license": licenses_of(mined, "file_id", "licenses").distinct().unionByName(licenses_of(root, "version_id", "root_licenses")).unionByName(detect.declared_licenses(components).select("id", "source", "spdx_id")),
        "copyright": said(mined, "file_id", 1).distinct().unionByName(said(notices, "purl_id", 2)),
        "cryptography": mined.select(F.col("file_id").alias("id"), F.explode("algorithms").alias("x")).select("id", "x.algorithm", "x.strength").distinct(),
        "quality": mined.where("score IS NOT NULL").select(F.col("file_id").alias("id"), F.lit(0).alias("source"), "score").distinct(),
        "attribution": notices.select("purl_id", F.col("file_id").alias("notice_id")).distinct(),
        "sources": contents(archived),
        "notices": contents(noticed),
        "wfp": fingerprint.first_lines(rows.select("file_id", F.explode("wfps").alias("x")).select("x.wfp", "file_id", "x.line")),
        "extra_file": rows.where("outcome = 'extra'").select("file_id", "url_id", "path"),
        "extra_sources": contents(extra),
    }


def save(tables: dict[str, DataFrame], path: str, only: list[str] | None = None, overwrite: bool = False, batch: tuple[str, int] | None = None) -> None:
    """Write mined tables to a store as one snapshot; only names those wanted.

    batch: a stream's name and the number of its batch. A batch that the store has already is not written again.
    """
    wanted = {n: t for n, t in tables.items() if only is None or n in only}
    if wanted:
        spark = next(iter(wanted.values())).sparkSession
        seen = store.snapshot(spark, path)
        if batch and seen.batches.get(batch[0], -1) >= batch[1]:
            return
        made = {n: store.add(spark, path, seen, n, t, overwrite) for n, t in wanted.items()}
        store.publish(spark, path, seen.next(made, batches=dict([batch]) if batch else None))


def files_of(members: DataFrame) -> DataFrame:
    """Members of unpacked archives (archive_id, path, content) as files to mine, byte for byte."""
    return members.select(F.col("archive_id").alias("url_id"), "path", F.col("content").alias("text"))


def load(spark: SparkSession, mined: str, path: str, tables: list[str] | None = None, overwrite: bool = False, denied: DataFrame | None = None) -> list[str]:
    """Load a dataset into a store as one snapshot; the names of the tables that were there, version first.

    The dataset has a folder of text for each table, binary shards in wfp, sources and notices, and version.json. Lines
    of another length or number of fields are left out. Loads one after the other give what one load of all gives.
    denied: fingerprints (wfp) that are left out.
    """
    seen = store.snapshot(spark, path)
    version, done = dict(seen.version), []
    if exists(spark, f"{mined}/version.json"):
        new = readers.read_version(spark, f"{mined}/version.json")
        old = spark.createDataFrame([tuple(seen.version.get(k) for k in V.VERSION)], "monthly string, daily string")
        version, done = kb.version(new, old).first().asDict(), ["version"]
    made = {}
    for name in tables or [*V.TABLES, *BINARY]:
        for part, rows in _loadable(spark, mined, name, denied).items():
            made[part] = store.add(spark, path, seen, part, rows, overwrite)
            done.append(part)
    store.publish(spark, path, seen.next(made, version))
    return done


BINARY = ("sources", "notices", "wfp")


def _loadable(spark: SparkSession, mined: str, name: str, denied: DataFrame | None) -> dict[str, DataFrame]:
    """The tables that a dataset's folder makes; none if it isn't there."""
    if not exists(spark, f"{mined}/{name}"):
        return {}
    if name in ("sources", "notices"):
        return {name: readers.read_mz(spark, f"{mined}/{name}").where("content IS NOT NULL")}
    if name == "wfp":
        rows = readers.read_wfp(spark, f"{mined}/wfp")
        return {name: fingerprint.without_denied(rows, denied) if denied is not None else rows}
    lines = readers.read_lines(spark, f"{mined}/{name}")
    if name == "file":
        return {name: kb.least_paths(lines)}
    if name == "pivot":
        return {name: kb.load_pivot(lines)}
    if name == "purl":
        rows, related = kb.load_purl(kb.admissible(lines, 2))
        return {name: rows, "purl_related": related}
    key = V.TABLES[name][0]
    rows = kb.with_fields(kb.admissible(lines, len(V.TABLES[name])), name, keep=("shard",))
    return {name: rows.withColumn(key, kb.decoded_key(F.col(key), F.col("shard"))).drop("shard")}


def merge(spark: SparkSession, source: str, target: str, out: str) -> list[str]:
    """Merge two stores into a third; the names of its tables."""
    return list(store.merge(spark, source, target, out).tables)


def local_facts(files: DataFrame, licenses: DataFrame, crypto: DataFrame) -> dict[str, DataFrame]:
    """What the four local detectors say of a folder's files (path, text), by path; no filter by name, no knowledge base."""
    rows = local(files)
    return {
        "license": detect.licenses(rows, licenses, "path"),
        "copyright": detect.copyrights(rows, "path"),
        "cryptography": detect.algorithms(rows, crypto, "path"),
        "quality": detect.quality(rows, "path"),
    }


def urls_of_files(files: DataFrame, pivot: DataFrame, urls: DataFrame) -> DataFrame:
    """file_id and the row of every url that holds it, for the file_id in files."""
    wanted = files.select("file_id").distinct()
    return pivot.join(wanted, "file_id").join(urls, "url_id").select("file_id", *urls.columns)


def local_folder(spark: SparkSession, path: str, licenses: DataFrame | None = None, crypto: DataFrame | None = None) -> dict[str, DataFrame]:
    """local_facts() of every file at or below a folder, by its path below it."""
    files = readers.read_folder(spark, path)
    root = F.regexp_replace(F.lit(path.rstrip("/") + "/"), "^file:/*", "/")
    below = F.replace(F.regexp_replace("path", "^file:/*", "/"), root, F.lit(""))
    rows = files.select(below.alias("path"), F.col("content").alias("text"))
    return local_facts(rows, license_dictionary(spark) if licenses is None else licenses, crypto_dictionary(spark) if crypto is None else crypto)


def local(files: DataFrame, text_col: str = "text", path_col: str = "path") -> DataFrame:
    """Files that a local detector looks at: no filter by name or path, but by content."""
    view = byte_view(F.col(text_col))
    return files.where(~P.unwanted_start(view) & ~P.is_binary(view) & (F.length(view) >= 1)).select(F.col(path_col).alias("path"), F.col(text_col).alias("text"))
