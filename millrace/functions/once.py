"""Evaluate costly columns once."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def with_once(df: DataFrame, keep: list[str | Column], **new: Column) -> DataFrame:
    """``keep`` and the ``new`` columns, each computed once per row.

    A filter on a computed column is normally pushed below the projection, as a second copy of the
    whole expression. Filters on the output of a generator stay above it, so the new columns come
    out of one that makes exactly one row.
    """
    row = F.struct(*[c.alias(name) for name, c in new.items()])
    return df.select(*keep, F.inline(F.array(row)))
