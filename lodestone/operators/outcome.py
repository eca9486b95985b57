"""What becomes of a file: the cascade of predicates, cheapest first, as one column."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from lodestone.functions import predicates as P
from lodestone.functions import values as V


def outcome(path: Column, view: Column, file_id: Column, all_extensions: bool = False, keep_rejected: bool = False, least: int = V.MIN_FILE) -> Column:
    """notice, ignored_ending, ignored_path, too_small, denied, binary, not_archived or accepted.

    With keep_rejected, what the first three reject goes to 'extra' instead.
    """
    extra = lambda name: F.lit("extra" if keep_rejected else name)
    chain = F.when(P.is_notice(path), extra("notice"))
    if not all_extensions:
        chain = chain.when(P.ignored_ending(path), extra("ignored_ending"))
    chain = chain.when(P.unwanted_path(path), extra("ignored_path"))
    chain = chain.when(F.coalesce(F.length(view), F.lit(0)) < least, F.lit("too_small")).when(P.denied_file(file_id), F.lit("denied"))
    return chain.when(P.is_binary(view), F.lit("binary")).when(P.unarchived_ending(path), F.lit("not_archived")).otherwise(F.lit("accepted"))


#: Outcomes that get a row in the file table; those of them whose text is mined; those archived too.
LISTED, MINED, ARCHIVED = ("accepted", "not_archived", "binary"), ("accepted", "not_archived"), ("accepted",)
