"""Row helpers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def computed_once(rows: DataFrame, **values: Column) -> DataFrame:
    """Add costly columns that later filters use without computing them again.

    A filter over a plain projection is pushed below it and brings a copy of every expression it
    mentions. ``inline`` of a one-element array gives one row for one, and filters on its columns
    stay above it. Filters on the other columns are pushed down as ever.
    """
    made = F.struct(*[v.alias(name) for name, v in values.items()])
    return rows.select("*", F.inline(F.array(made)))
