"""Quality rules whose thresholds adapt to each language and source.

Five rates are taken from every text: symbols, repeated lines, words in repeated windows, capital
letters (all per mille) and mean word length (hundredths). Their distributions are kept as mergeable
quantile sketches: counts by bucket, where a bucket is a value's leading six bits (relative
error below 1/32). Adding counts merges sketches, in any order and with one result, so the sketch of
a language is the sum of its sources' and the sketch of all is the sum of the languages'.

Sketches hold the texts that pass the base rules. A group's fence is an upper quantile of its sketch (TAILS names it for each
rate) and FENCE times that quantile's distance from the median beyond it; word length has a lower fence too. Nothing but
the sketch decides: what is far out depends on how wide a group's own texts spread. The quantile of a rate lies where
clean texts still are: symbols come in bad texts above all, so three quarters; repeats come in good ones too, so 99%.
A group's fences are drawn towards those of its language, which are drawn towards those of all: the mean of
both, weighted by the group's texts and PRIOR_DOCS. So small groups lean on larger ones, and no size switches the rule.

Defined results: null texts have no words and fail the base rules; null languages and sources form
groups of their own; repeated rows are judged each; empty tables give an empty result.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestone.llm.common import as_bytes, bound_batches, materialize

SYMBOLS = b"#*$%&|<>"  # fixed value
FENCE = 4
PRIOR_DOCS = 300  # the weight, in texts, of the fences that a group's own are drawn towards
#: Rate -> the quantiles, in hundredths, that its low and high fences are drawn from; 0 is no low fence.
TAILS = {"symbol_rate": (0, 75), "dup_line_rate": (0, 99), "repeat_rate": (0, 99), "capital_rate": (0, 98), "word_length": (5, 90)}


def text_stats(text: bytes | None) -> tuple[int, int, int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_lines, n_capitals."""
    if not text:
        return 0, 0, 0, 0, 0, 0, 0
    words, plain = text.split(), text.decode()
    spaces = len(text) - sum(map(len, words))
    lines = [x for x in text.split(b"\n") if x.split(None, 1)]
    windows = list(zip(words, words[1:], words[2:]))
    repeated = 0
    if len(distinct := set(windows)) < len(windows):
        once, more = set(), set()
        for w in windows:
            (more if w in once else once).add(w)
        covered = bytearray(len(words))
        for i, w in enumerate(windows):
            if w in more:
                covered[i : i + 3] = b"\x01\x01\x01"
        repeated = sum(covered)
    del distinct
    capitals = sum(map(str.isupper, plain)) if not plain.isascii() else sum(map(text.count, _CAPITALS))
    return len(words), len(plain) - spaces, len(text) - len(text.translate(None, SYMBOLS)), len(lines) - len(set(lines)), repeated, len(lines), capitals


_CAPITALS = [bytes([c]) for c in range(65, 91)]


def _bucket(value):
    """The value itself below 64, else the bits cut off it times 64 plus its six leading bits."""
    cut = F.greatest(F.length(F.bin(value)) - 6, F.lit(0))
    return cut.cast("long") * 64 + F.call_function("shiftright", value, cut)


def _lower_bound(bucket):
    """The least value of a bucket. Buckets from 64 on hold leads of 32..63."""
    shift = F.when(bucket < 64, 0).otherwise(F.floor((bucket - 32) / 64)).cast("int")
    return F.call_function("shiftleft", bucket - shift * 64, shift)


def sketch(stats: DataFrame) -> DataFrame:
    """lang, source, rate, bucket, n: one pass, combined before the shuffle."""
    rates = F.array(*[F.struct(F.lit(r).alias("rate"), F.col(r).alias("value")) for r in TAILS])
    kept = stats.where("NOT base_failed").select("lang", "source", F.explode(rates).alias("x"))
    return kept.groupBy("lang", "source", F.col("x.rate").alias("rate"), _bucket(F.col("x.value")).alias("bucket")).agg(F.count("*").alias("n"))


def merged(sketches: DataFrame, *by: str) -> DataFrame:
    return sketches.groupBy(*by, "rate", "bucket").agg(F.sum("n").alias("n"))


def quantiles(sketches: DataFrame, *by: str) -> DataFrame:
    """docs, median, lower and upper quantile (TAILS) of each group and rate. A group has some hundred buckets at most."""
    key = ", ".join([*by, "rate"])
    run = sketches.withColumn("upto", F.expr(f"sum(n) OVER (PARTITION BY {key} ORDER BY bucket)")).withColumn("docs", F.expr(f"sum(n) OVER (PARTITION BY {key})"))
    share = lambda k: F.create_map(*[F.lit(x) for r, tails in TAILS.items() for x in (r, tails[k])])[F.col("rate")]
    at = {name: F.min(F.when(F.col("upto") * 100 >= F.col("docs") * q, F.col("bucket"))) for name, q in (("lower", share(0)), ("median", F.lit(50)), ("upper", share(1)))}
    return run.groupBy(*by, "rate").agg(F.max("docs").alias("docs"), *[_lower_bound(b).alias(name) for name, b in at.items()])


def fences(sketches: DataFrame) -> DataFrame:
    """lang, source and a low and a high fence for each rate, each drawn towards that of the level above."""
    def level(df: DataFrame, tag: str) -> DataFrame:
        two_sided = F.col("rate").isin(*[r for r, (low, _) in TAILS.items() if low])
        low = F.when(two_sided, F.greatest(F.col("lower") - FENCE * (F.col("median") - F.col("lower")), F.lit(0))).otherwise(0)
        high = F.col("upper") + FENCE * (F.col("upper") - F.col("median"))
        return df.withColumns({f"{tag}_low": low, f"{tag}_high": high}).withColumnRenamed("docs", f"{tag}_docs").drop("lower", "median", "upper")

    by_lang = merged(sketches, "lang")
    own, lang, all_ = level(quantiles(sketches, "lang", "source"), "own"), level(quantiles(by_lang, "lang"), "lang"), level(quantiles(merged(by_lang)), "all")
    l2, a2 = lang.withColumnRenamed("lang", "lang_").withColumnRenamed("rate", "rate_"), all_.withColumnRenamed("rate", "rate_")
    joined = own.join(l2, F.col("lang").eqNullSafe(F.col("lang_")) & (F.col("rate") == F.col("rate_")), "left").drop("lang_", "rate_")
    joined = joined.join(a2, F.col("rate") == F.col("rate_"), "left").drop("rate_")
    drawn = lambda tag, x, to: F.expr(f"(cast({tag}_docs AS decimal(38)) * {tag}_{x} + {PRIOR_DOCS} * cast({to} AS decimal(38))) div ({tag}_docs + {PRIOR_DOCS})")
    joined = joined.withColumns({f"near_{x}": drawn("lang", x, f"all_{x}") for x in ("low", "high")})
    at = {r: F.col("rate") == r for r in TAILS}
    return joined.withColumns({x: drawn("own", x, f"near_{x}") for x in ("low", "high")}).groupBy("lang", "source").agg(
        *[F.max(F.when(at[r], F.col(x))).alias(f"{r}_{x}") for r in TAILS for x in ("low", "high")]
    )


RATES = ", ".join(f"{r} long" for r in TAILS)
STATS = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, " + RATES


def _stats_row(text: bytes | None) -> tuple:
    n, chars, symbols, dups, repeated, lines, capitals = text_stats(text)
    per = lambda a, b: 1000 * a // b if b else 0
    failed = n < 50 or 100 * repeated > 50 * n
    return n, chars, symbols, dups, repeated, failed, per(symbols, chars), per(dups, lines), per(repeated, n), per(capitals, chars), 100 * chars // n if n else 0


def stats_of(text):
    """A struct of STATS for a text column."""
    names = [x.split()[0] for x in STATS.split(", ")]

    @F.arrow_udf(STATS)
    def run(texts: pa.Array) -> pa.Array:
        columns = list(zip(*map(_stats_row, as_bytes(texts)), strict=True)) or [[] for _ in names]
        types = [pa.bool_() if n == "base_failed" else pa.int64() for n in names]
        return pa.StructArray.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names)

    # Not deterministic for the optimizer, which else measures a text anew for each rule that it moves.
    return run.asNondeterministic()(text)


def _judged(rows: DataFrame, marks: DataFrame, lang, source, stats: str):
    """rows with the fences of their group beside them, and the verdict as a column."""
    # Few fences, one row per language and source, but no bound is known: Spark picks the join by size.
    near = marks.select(F.struct("*").alias("__fence"))
    joined = rows.join(near, lang.eqNullSafe(F.col("__fence.lang")) & source.eqNullSafe(F.col("__fence.source")), "left")
    kept = ~F.col(f"{stats}.base_failed")
    for r in TAILS:
        kept &= F.coalesce(F.col(f"{stats}.{r}").between(F.col(f"__fence.{r}_low"), F.col(f"__fence.{r}_high")), F.lit(True))
    return joined, kept


def _rows(docs: DataFrame, text_col: str, lang_col: str, source_col: str, *more) -> DataFrame:
    return docs.select(*more, F.col(lang_col).cast("string").alias("lang"), F.col(source_col).cast("string").alias("source"), stats_of(F.col(text_col)).alias("__stats"))


def quality_verdicts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """doc_id, the base counts, base_failed, kept, and the rates behind the verdict, per row."""
    bound_batches(docs.sparkSession)
    stats = materialize(_rows(docs, text_col, lang_col, source_col, F.col(id_col).alias("__id")), "quality-stats")
    marks = materialize(fences(sketch(stats.select("lang", "source", "__stats.*"))), "quality-fences")
    joined, kept = _judged(stats, marks, F.col("lang"), F.col("source"), "__stats")
    base = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    return joined.select(F.col("__id").alias(id_col), *[F.col(f"__stats.{c}") for c in base], kept.alias("kept"), *[F.col(f"__stats.{r}") for r in TAILS])


def keep_good(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """The rows of docs whose texts pass, all columns as they were.

    Texts are measured twice, for the fences and for the verdicts, so that no text is shuffled.
    """
    bound_batches(docs.sparkSession)
    marks = materialize(fences(sketch(_rows(docs, text_col, lang_col, source_col).select("lang", "source", "__stats.*"))), "quality-fences")
    measured = docs.withColumn("__stats", stats_of(F.col(text_col)))
    joined, kept = _judged(measured, marks, F.col(lang_col).cast("string"), F.col(source_col).cast("string"), "__stats")
    return joined.where(kept).select(*[F.col(f"`{c}`") for c in docs.columns])
