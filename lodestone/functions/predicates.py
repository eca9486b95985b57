"""Predicates that decide which files are mined, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from lodestone.functions import values as V
from lodestone.functions.text import basename, bound, count_char, csv_fields, lower_ascii


def _strings(values: list[str]) -> Column:
    return F.array(*[F.lit(v) for v in values])


def is_notice(path: Column) -> Column:
    return F.lower(basename(path)).isin([n.lower() for n in V.NOTICE_NAMES])


def has_ending(name: Column, endings: list[str]) -> Column:
    """The shorter of name and ending decides: either may be the tail of the other."""
    low = F.lower(name)
    return F.exists(_strings(sorted({e.lower() for e in endings})), lambda e: F.endswith(low, e) | F.endswith(e, low))


def ignored_ending(name: Column) -> Column:
    return has_ending(name, V.IGNORED_ENDINGS)


def unarchived_ending(name: Column) -> Column:
    return has_ending(name, V.UNARCHIVED_ENDINGS)


def unwanted_path(path: Column) -> Column:
    hidden = path.rlike(r"^\.[^./]|/\.[A-Za-z0-9]") | (path == ".")
    for part in V.IGNORED_PATH_PARTS:
        hidden |= F.contains(path, F.lit(part))
    return hidden


def unwanted_start(view: Column) -> Column:
    """The text and a start agree, without case, up to the shorter of both."""
    head = lower_ascii(F.substring(view, 1, max(map(len, V.IGNORED_STARTS))))  # all of a text that is shorter than a start

    def agrees(h: Column) -> Column:
        found = h == ""
        for start in V.IGNORED_STARTS:
            found |= F.startswith(h, F.lit(start)) | F.startswith(F.lit(start), h)
        return found

    return bound(head, agrees)


def is_binary(view: Column) -> Column:
    third = F.ascii(F.substring(view, 3, 1))
    zipped = F.startswith(view, F.lit("PK")) & ((third < 9) | (third > 127))
    return zipped | F.contains(view, F.char(F.lit(0)))


def too_square(view: Column, blank_lines: int = 0) -> Column:
    """Most of many lines have one length. Lengths count the line end; up to two are not ranked, nor are lengths beyond the first ranks.

    With blank_lines, of the text after so many empty lines.
    """

    def square(lines: Column) -> Column:
        ended = F.transform(F.slice(lines, 1, F.size(lines) - 1), lambda x: F.length(x) + 1)
        return bound(F.filter(ended, lambda n: n > 2), lambda ranked: F.floor(_most(ranked) * 100 / (F.size(lines) + blank_lines)) > V.SQUARE_PERCENT)

    def _most(ranked: Column) -> Column:
        kinds = F.slice(F.array_distinct(ranked), 1, V.SQUARE_RANKS)
        return F.array_max(F.transform(kinds, lambda n: F.size(F.filter(ranked, lambda m: m == n))))

    # Few texts have so many lines, or enough of them that aren't blank; the others are not split.
    ends = count_char(view, "\n")
    many = (ends >= V.SQUARE_LINES - blank_lines) & (ends * 100 > (ends + 1 + blank_lines) * V.SQUARE_PERCENT) if blank_lines else ends >= V.SQUARE_LINES
    return F.when(many, F.coalesce(bound(F.split(view, "\n", -1), square), F.lit(False))).otherwise(F.lit(False))


def big_enough(view: Column, least: int = V.MIN_FILE) -> Column:
    return F.length(view) >= least


def denied_file(file_id: Column) -> Column:
    return file_id.isin(V.DENIED_FILES)


def reserved_id(file_id: Column) -> Column:
    return file_id.isin(V.EMPTY_MD5, V.ZERO_MD5)


def has_fields(line: Column, n: int) -> Column:
    return csv_fields(line) == n


def license_name(name: Column) -> Column:
    up, found = F.upper(name), F.lit(False)
    for part in V.LICENSE_NAME_PARTS:
        found |= F.contains(up, F.lit(part))
    for start in V.LICENSE_NAME_STARTS:
        found |= F.startswith(up, F.lit(start))
    return found


def fingerprintable(view: Column, blank_lines: int = 0) -> Column:
    """Whether a text, or with blank_lines the text after so many empty lines, is fingerprinted."""
    if blank_lines:  # it starts with a line end
        return bound(view, lambda b: ~F.contains(b, F.char(F.lit(0))) & ~too_square(b, blank_lines))
    return bound(view, lambda b: F.contains(b, F.lit("\n")) & ~F.contains(b, F.char(F.lit(0))) & ~unwanted_start(b) & ~too_square(b))


def first_comma_replaced(path: Column) -> Column:
    """The first comma becomes a dash; later ones stay and fail the field count on loading."""
    at = F.instr(path, ",")
    return F.when(at > 0, F.overlay(path, F.lit("-"), at, F.lit(1))).otherwise(path)


def valid_md5(text: Column) -> Column:
    return F.lower(text).rlike("^[0-9a-f]{32}$")
