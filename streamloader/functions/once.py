"""Columns that are computed once per row, whatever is filtered on them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def compute_once(df: DataFrame, name: str, expression: Column) -> DataFrame:
    """Add a column that no filter is pushed below.

    Spark moves filters under projections by copying the projected expressions into them.  For a
    parse that is a loss: every later test of a parsed field would parse the text again, and chained
    steps multiply.  Filters stop at a generator, and one over a single-element array changes no rows.
    """
    return df.select("*", F.explode(F.array(expression)).alias(name))
