"""Expressions over one raw behaviour line ``user,item,category,type,stamp``.

Everything is a JVM-side column expression: the same code cleans a batch table and a stream.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from pathlark import schemas as S

# What counts as blank space around a field, and as an integer.
_SPACE = "".join(map(chr, range(0x21)))
_INTEGER = r"^[+-]?[0-9]+$"

REASONS = (
    "blank", "field_count", "user_id", "item_id", "category_id",
    "behavior_type", "timestamp", "non_numeric",
)


def strip(text: Column) -> Column:
    """Remove control characters and spaces at both ends (more than SQL ``trim`` does)."""
    return F.btrim(text, F.lit(_SPACE))


def fields(line: Column) -> Column:
    """Comma-separated fields; empty fields at the end do not count."""
    return F.split(F.rtrim(strip(line), F.lit(",")), ",", -1)


def to_long(text: Column) -> Column:
    """Whole number or NULL; ``12.5`` is NULL, and no bad input raises."""
    bare = strip(text)
    return F.when(bare.rlike(_INTEGER), bare.try_cast("bigint"))


def to_seconds(stamp: Column) -> Column:
    """Milliseconds become seconds; anything else stays."""
    millis = (stamp > F.lit(S.MILLIS_ABOVE)) & (stamp >= F.lit(S.MILLIS_LOWER))
    return F.when(millis, F.call_function("div", stamp, F.lit(1000).cast("bigint"))).otherwise(stamp)


def normalized_line(line: Column, f: Column, stamp: Column) -> Column:
    """The line with a millisecond stamp rewritten; lines of another shape pass through."""
    seconds = to_seconds(stamp)
    rewritten = F.concat_ws(",", F.slice(f, 1, 4), seconds.cast("string"))
    return F.when((F.size(f) == 5) & (seconds != stamp), rewritten).otherwise(line)


def reject_reason(line: Column, parts: Column, user: Column, item: Column, category: Column,
                  kind: Column, stamp: Column) -> Column:
    """The first rule the line breaks, in reading order; NULL for a good line.

    ``parts`` is the number of fields, 0 for a blank line. A field that is not a number is noticed
    when its turn comes, so ``0,x,…`` is a bad user.
    """
    def positive(col: Column, name: str, chain: Column) -> Column:
        return chain.when(col.isNull(), F.lit("non_numeric")).when(col <= 0, F.lit(name))

    chain = F.when(line.isNull() | (parts == 0), F.lit("blank")).when(parts != 5, F.lit("field_count"))
    chain = positive(user, "user_id", chain)
    chain = positive(item, "item_id", chain)
    chain = positive(category, "category_id", chain)
    chain = chain.when(~kind.isin(*S.BEHAVIOR_TYPES), F.lit("behavior_type"))
    chain = chain.when(stamp.isNull(), F.lit("non_numeric"))
    return chain.when(~stamp.between(S.TS_LOWER, S.TS_UPPER), F.lit("timestamp"))
