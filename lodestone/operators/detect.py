"""Detectors: licenses, copyright, cryptography, quality. Each takes rows with an id and a text and returns facts.

All work row by row in the JVM; dictionaries are small by nature and become literals of the plan, after
a check of their size.
"""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestone.functions import values as V
from lodestone.functions.dictionaries import first_keywords
from lodestone.functions.text import bound, byte_view, count_alnum, count_char, count_marks, from_byte_view, lower_ascii, normalised

TAG = "spdx-license-identifier:"
MAX_ENTRIES = 20_000  # of a dictionary, which goes to every task
MAX_LITERAL = 64  # wordings that are searched for one by one in the plan; more of them by an automaton


def _entries(dictionary: DataFrame, order: str = "ord") -> list:
    rows = dictionary.orderBy(order).limit(MAX_ENTRIES + 1).collect()
    if len(rows) > MAX_ENTRIES:
        raise ValueError(f"a dictionary of over {MAX_ENTRIES} entries; split it")
    return rows


def spdx_ids(view: Column) -> Column:
    """The license ids of the first SPDX tag in the header, as an array."""
    start = F.instr(lower_ascii(F.substring(view, 1, V.HEADER + 1 + len(TAG))), TAG)
    in_header = (start > 0) & (count_char(F.substring(view, F.lit(1), start - 1), "\n") <= V.HEADER_LINES)
    line = F.regexp_extract(F.substring(view, start + len(TAG), F.lit(2 * V.MAX_LICENSE)), r"^[^\n\rA-Za-z]*([A-Za-z][^\n]*)\n", 1)
    parts = F.transform(F.split(line, "(?i) (?:AND|OR) |#"), lambda x: F.regexp_replace(x, "[^A-Za-z0-9+]+$", ""))
    return F.when(in_header & (F.length(line) < V.MAX_LICENSE), F.filter(parts, lambda x: x != "")).otherwise(F.array().cast("array<string>"))


def license_text(view: Column, dictionary: DataFrame) -> Column:
    """The id of the wording that starts first in the header; the dictionary's order breaks ties. Null if none."""
    entries = _entries(dictionary)
    if not entries:
        return F.lit(None).cast("string")
    head = F.substring(normalised(view, V.HEADER - 1), 1, V.MAX_LICENSE - 1)
    if len(entries) > MAX_LITERAL:
        return _first_wording(dictionary.sparkSession, entries)(head)
    found = [F.when(F.instr(head, r.phrase) > 0, F.struct(F.instr(head, r.phrase).alias("at"), F.lit(r.ord).alias("ord"), F.lit(r.spdx_id).alias("id"))) for r in entries]
    return F.array_min(F.array(*found))["id"]


def _first_wording(spark: SparkSession, entries: list):
    """The same by one walk over each header, with an automaton of all wordings."""
    sent, made = spark.sparkContext.broadcast([(r.phrase, r.ord, r.spdx_id) for r in entries]), []

    @F.arrow_udf("string")
    def found(heads: pa.Array) -> pa.Array:
        import ahocorasick

        if not made:
            made.append(ahocorasick.Automaton())
            for phrase, order, spdx_id in sent.value:
                if phrase not in made[0]:
                    made[0].add_word(phrase, (len(phrase), order, spdx_id))
            made[0].make_automaton()
        least = lambda head: min(((end - n, order, spdx_id) for end, (n, order, spdx_id) in made[0].iter(head)), default=(0, 0, None))[2]
        return pa.array([least(h) if h else None for h in heads.to_pylist()], pa.string())

    return found


LICENSE_HEAD = V.HEADER + 1 + len(TAG) + 2 * V.MAX_LICENSE  # tags and wordings start in the header; a tag's line is read on for twice the longest license


def license_facts(view: Column, dictionary: DataFrame, license_file: bool = False) -> Column:
    """source, spdx_id as an array: the tag's ids (source 1), or else the header's wording (2); 3 for license files. Null if none."""
    source = lambda n: F.lit(3 if license_file else n)
    tagged = lambda tags: F.transform(tags, lambda t: F.struct(source(1).alias("source"), t.alias("spdx_id")))
    text = license_text(view, dictionary)
    worded = F.when(text.isNotNull(), F.array(F.struct(source(2).alias("source"), text.alias("spdx_id"))))
    return F.coalesce(bound(spdx_ids(view), lambda tags: F.when(F.size(tags) > 0, tagged(tags))), worded)


def licenses(files: DataFrame, dictionary: DataFrame, id_col: str = "id", text_col: str = "text", license_file: bool = False) -> DataFrame:
    """id, source, spdx_id of every file's license_facts()."""
    view = files.select(F.col(id_col).alias("id"), start_of(F.col(text_col), LICENSE_HEAD).alias("b"))
    return view.select("id", F.explode(license_facts(F.col("b"), dictionary, license_file)).alias("x")).select("id", "x.source", "x.spdx_id")


MARKS = r"\(c\)|copyright|@author"
HEAD = V.HEADER + 2 + V.MAX_COPYRIGHT  # bytes in which statements lie that start in the header


def copyright_statement(view: Column) -> Column:
    """The first acceptable statement of the header, or null. Of view, no more than HEAD bytes are looked at."""

    def in_head(head: Column) -> Column:
        brace = F.instr(head, "{")
        # Starts lie before the first brace and in the first bytes; statements run on to their line's end.
        limit = F.least(F.when(brace > 0, brace - 1).otherwise(V.HEADER + 1), F.lit(V.HEADER + 1))
        lines = F.slice(F.split(head, "\n", -1), 1, V.COPYRIGHT_LINES + 1)
        return bound(F.struct(lines.alias("lines"), limit.alias("limit")), in_lines)

    def in_lines(parts: Column) -> Column:
        # Lines with where each starts, as offsets from 0: each one's start is the one before's and its length.
        at = lambda x, start: F.struct(x.alias("line"), start.alias("start"))
        after = lambda done: F.when(F.size(done) == 0, 0).otherwise(F.element_at(done, -1)["start"] + F.length(F.element_at(done, -1)["line"]) + 1)
        none = F.array().cast("array<struct<line: string, start: int>>")
        placed = F.aggregate(parts["lines"], none, lambda done, x: F.concat(done, F.array(at(x, after(done)))))
        marked = F.filter(placed, lambda z: z["line"].rlike(f"(?i){MARKS}"))
        found = F.filter(F.transform(marked, lambda z: in_line(z, parts["limit"])), lambda s: s.isNotNull())
        return F.get(found, F.lit(0))

    def in_line(z: Column, limit: Column) -> Column:
        # Only places where a mark starts: the line is cut before each, and lengths add up.
        cut = F.split(lower_ascii(z["line"]), f"(?={MARKS})", -1)
        places = F.aggregate(cut, F.array(F.lit(1)), lambda done, x: F.concat(done, F.array(F.element_at(done, -1) + F.length(x))))
        first = F.array_min(F.filter(places, lambda p: acceptable(z, p, limit)))
        return bound(first, lambda p: F.when(p.isNotNull(), F.substring(z["line"], p, F.lit(V.MAX_COPYRIGHT))))

    def acceptable(z: Column, p: Column, limit: Column) -> Column:
        def fits(here: Column) -> Column:
            c, word, author = F.startswith(here, F.lit("(c)")), F.startswith(here, F.lit("copyright")), F.startswith(here, F.lit("@author"))
            for tail in V.IGNORED_COPYRIGHT:
                word &= ~F.startswith(here, F.lit("copyright" + tail))
            return bound(F.when(c, 3).when(word, 9).when(author, 7), after_mark)

        def after_mark(size: Column) -> Column:
            fit = lambda after: (count_alnum(after) >= V.MIN_COPYRIGHT_ALNUM) & (count_marks(after) <= V.MAX_COPYRIGHT_MARKS)
            short = (F.length(z["line"]) - p + 1 <= V.MAX_COPYRIGHT) & (z["start"] + p <= limit)
            return F.coalesce(size.isNotNull() & short & bound(F.substring(z["line"], p + size, F.lit(V.MAX_COPYRIGHT)), fit), F.lit(False))

        return bound(lower_ascii(F.substring(z["line"], p, F.lit(24))), fits)

    def plain(first: Column) -> Column:
        return F.when(F.startswith(lower_ascii(first), F.lit("@author")), F.substring(first, F.lit(9), F.lit(V.MAX_COPYRIGHT))).otherwise(first)

    # Most headers have no mark, and no more is done for them.
    statement = bound(F.substring(view, 1, HEAD), lambda head: F.when(head.rlike(f"(?i){MARKS}"), in_head(head)))
    return bound(statement, lambda found: F.when(found.isNotNull(), F.translate(from_byte_view(plain(found)), ",", ";")))


def start_of(text: Column, n: int) -> Column:
    """The byte view of a text's first n bytes."""
    return byte_view(F.substring(text.cast("binary"), 1, n))


def copyrights(files: DataFrame, id_col: str = "id", text_col: str = "text", source: int = 1) -> DataFrame:
    """id, source, statement: one at most for each file."""
    found = files.select(F.col(id_col).alias("id"), F.lit(source).alias("source"), copyright_statement(start_of(F.col(text_col), HEAD)).alias("statement"))
    return found.where("statement IS NOT NULL")


def algorithms(files: DataFrame, dictionary: DataFrame, id_col: str = "id", text_col: str = "text") -> DataFrame:
    """id, algorithm, strength: what a file's tokens name, once each.

    A file's different tokens meet the keywords in a hash join; up to MAX_ENTRIES of these are broadcast. Only what is
    found is put together by file. Rows with equal ids are one file.
    """
    words = first_keywords(dictionary).where(F.length("keyword") > 2).select("keyword", "algorithm", "strength")
    if words.limit(MAX_ENTRIES + 1).count() <= MAX_ENTRIES:
        words = F.broadcast(words)
    # The tokens' bytes are ASCII in any encoding that a text or its bytes may be in.
    text = F.col(text_col) if dict(files.dtypes)[text_col] == "string" else byte_view(F.col(text_col))
    tokens = F.array_distinct(F.transform(F.regexp_extract_all(text, F.lit("[A-Za-z0-9*._-]{3,}"), F.lit(0)), F.lower))
    each = files.select(F.col(id_col).alias("id"), F.explode(tokens).alias("keyword"))
    return each.join(words, "keyword").select("id", "algorithm", "strength").distinct()


def algorithm_finder(dictionary: DataFrame):
    """algorithm, strength as an array, of a text's bytes: the same as a function of a row, for plans that compute all facts at once."""
    words = {r.keyword.encode(): (r.algorithm, r.strength) for r in _entries(first_keywords(dictionary).where(F.length("keyword") > 2))}
    sent, kind = dictionary.sparkSession.sparkContext.broadcast(words), pa.list_(pa.struct([("algorithm", pa.string()), ("strength", pa.int32())]))

    @F.arrow_udf("array<struct<algorithm: string, strength: int>>")
    def found(texts: pa.Array) -> pa.Array:
        known, token = sent.value, re.compile(rb"[A-Za-z0-9*._-]{3,}")
        names = lambda text: sorted({known[t] for t in map(bytes.lower, set(token.findall(text))) if t in known})
        return pa.array([[{"algorithm": a, "strength": n} for a, n in names(t)] if t else [] for t in texts.to_pylist()], kind)

    return found


def quality_terms(view: Column) -> dict[str, Column]:
    """The five terms of the score, as 0 or 1."""
    pieces = F.split(view, "\n", -1)
    ended = F.slice(pieces, 1, F.greatest(F.size(pieces) - 1, F.lit(1)))
    n_lines = F.size(pieces) - 1
    relevant = F.aggregate(F.filter(ended, lambda x: F.length(x) > 2), F.lit(0), lambda a, x: a + F.length(x))
    comments = F.size(F.filter(pieces, lambda x: x.rlike(r"^[ \t]*(//|/\*|#)")))
    mixed = F.exists(pieces, lambda x: F.startswith(x, F.lit(" "))) & F.exists(pieces, lambda x: F.startswith(x, F.lit("\t")))
    tag = F.instr(lower_ascii(F.substring(view, 1, V.HEADER - 1 + len(TAG))), TAG) > 0
    terms = {
        "few_lines": n_lines <= V.MAX_LINES,
        "short_lines": F.floor(relevant / F.greatest(n_lines, F.lit(1))) <= V.MAX_LINE_LENGTH,
        "few_comments": comments <= V.MAX_COMMENTS,
        "one_indent": ~mixed,
        "has_tag": tag,
    }
    return {k: v.cast("int") for k, v in terms.items()}


def quality_score(view: Column) -> Column:
    """The score from 0 to 5 of a file large enough, with lines and without NUL; null of others."""
    fit = lambda b: (F.length(b) >= V.MIN_FILE) & F.contains(b, F.lit("\n")) & ~F.contains(b, F.char(F.lit(0)))
    return bound(view, lambda b: F.when(fit(b), sum(quality_terms(b).values(), F.lit(0))))


def quality(files: DataFrame, id_col: str = "id", text_col: str = "text") -> DataFrame:
    """id, source (0), score 0 to 5, of files large enough, with lines and without NUL."""
    rows = files.select(F.col(id_col).alias("id"), byte_view(F.col(text_col)).alias("b"))
    fit = rows.where((F.length("b") >= V.MIN_FILE) & F.contains("b", F.lit("\n")) & ~F.contains("b", F.char(F.lit(0))))
    score = sum(quality_terms(F.col("b")).values(), F.lit(0))
    return fit.select("id", F.lit(0).alias("source"), score.alias("score"))


def declared_licenses(components: DataFrame) -> DataFrame:
    """id, source (0), spdx_id: a component's declared license, under its version and its purl."""
    ids = F.array(F.col("version_id"), F.col("purl_id"))
    rows = components.where("license <> ''").select(F.explode(ids).alias("id"), F.lit(0).alias("source"), F.col("license").alias("spdx_id"))
    return rows.where("id IS NOT NULL")


def scancode_licenses(reports: DataFrame, json_col: str = "report") -> DataFrame:
    """id, source (5), spdx_id from reports (id, json) of an external license scanner; each once, no nulls."""
    schema = "files array<struct<path: string, license_expressions: array<string>, detected_license_expression_spdx: string>>"
    files = reports.select("id", F.explode(F.from_json(F.col(json_col), schema)["files"]).alias("f"))
    named = files.select("id", F.explode(F.array_compact(F.concat(F.coalesce("f.license_expressions", F.array()), F.array("f.detected_license_expression_spdx")))).alias("spdx_id"))
    return named.select("id", F.lit(5).alias("source"), "spdx_id").distinct()
