"""Compute costly columns exactly once."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def with_once(frame: DataFrame, **columns: Column) -> DataFrame:
    """Add columns as the output of a one-row generator.

    A filter on an ordinary computed column is moved below it with the whole expression
    copied in, once per mention; parsing then runs several times per row. Filters stay
    above a generator, so each row is parsed once. Works on streams and moves no data.
    """
    row = F.struct(*[column.alias(name) for name, column in columns.items()])
    return frame.select("*", F.inline(F.array(row)))
