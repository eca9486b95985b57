"""Text helpers as column expressions. Offsets and lengths count bytes: a byte view has a character for each byte."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value), with value computed once however often use takes it. A null value gives what use makes of a null."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def byte_view(text: Column) -> Column:
    """A character for each byte of a text, or of a binary column as it is."""
    return F.decode(text.cast("binary"), "ISO-8859-1")


def from_byte_view(view: Column) -> Column:
    """The text whose bytes these are: UTF-8, of which the end may cut a character, or else Latin-1."""

    def text_of(v: Column) -> Column:
        whole = F.encode(F.regexp_replace(v, "[\u00C2-\u00F4][\u0080-\u00BF]{0,2}$", ""), "ISO-8859-1").cast("string")
        return bound(F.encode(v, "ISO-8859-1").cast("string"), lambda t: F.when(F.is_valid_utf8(t), t).when(F.is_valid_utf8(whole), F.make_valid_utf8(t)).otherwise(v))

    return bound(view, text_of)


def lower_ascii(view: Column) -> Column:
    return F.translate(view, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def normalised(view: Column, limit: int) -> Column:
    """Letters, digits and + of the first limit bytes, lower case."""
    return lower_ascii(F.regexp_replace(F.substring(view, 1, limit), "[^A-Za-z0-9+]", ""))


def count_char(view: Column, char: str) -> Column:
    return F.length(view) - F.length(F.replace(view, F.lit(char), F.lit("")))


def count_alnum(text: Column) -> Column:
    return F.length(F.regexp_replace(text, "[^A-Za-z0-9]", ""))


def count_marks(text: Column) -> Column:
    """Characters that are neither letters, digits nor spaces."""
    return F.length(F.regexp_replace(text, "[A-Za-z0-9 ]", ""))


def basename(path: Column) -> Column:
    return F.substring_index(path, "/", -1)


def extension(path: Column) -> Column:
    """What follows the last dot of the last path part, or that part itself."""
    return F.substring_index(basename(path), ".", -1)


def csv_fields(line: Column) -> Column:
    return F.size(F.split(line, ",", -1))


def field(line: Column, n: int) -> Column:
    """The n-th field of a line, from 1; null if there is none."""
    return F.get(F.split(line, ",", -1), n - 1)


def purl_id(purl: Column) -> Column:
    return F.when(purl != "", F.md5(purl))


def version_id(purl: Column, version: Column) -> Column:
    return F.when((purl != "") & (version != ""), F.md5(F.concat(purl, F.lit("@"), version)))
