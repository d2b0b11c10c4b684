"""Append, upsert and insert-if-absent as plain joins and windows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

MODES = ("append", "upsert", "insert_if_absent")


def one_per_key(
    df: DataFrame, keys: Sequence[Column | str], order: Sequence[Column | str], keep: str
) -> DataFrame:
    """First or last row of each key in ascending order of the given columns, nulls lowest.

    Written as `row_number() = 1`, which Spark also applies before the shuffle: each task sends at
    most one row per key, so a key that holds a third of the batch costs no more than any other.
    """
    if keep == "last":
        order = [_reverse(c) for c in order]
    elif keep != "first":
        raise ValueError(f"keep is 'first' or 'last', not {keep!r}")
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("__rank", rank).where(F.col("__rank") == 1).drop("__rank")


def _reverse(column: Column | str) -> Column:
    return (F.col(column) if isinstance(column, str) else column).desc_nulls_last()


def merge(
    existing: DataFrame,
    batch: DataFrame,
    pk: Sequence[str],
    order: Sequence[Column | str],
    mode: str,
) -> DataFrame:
    """The table after the batch.

    `order` names batch columns of arrival order and must not tie within a key if the outcome is to
    be determined; order columns the table lacks are dropped after use.  Appending keeps every row,
    an upsert keeps the newest row of each key, insert-if-absent keeps what is there, else the first.
    No side is broadcast by hint: Spark does so when its size statistics allow.
    """
    names = existing.columns
    if mode == "append":
        return existing.unionByName(batch.select(*names))
    if mode == "upsert":
        newest = one_per_key(batch, pk, order, "last").select(*names)
        kept = existing.join(newest, list(pk), "left_anti")
        return kept.unionByName(newest)
    if mode == "insert_if_absent":
        first = one_per_key(batch, pk, order, "first").select(*names)
        return existing.unionByName(absent_only(first, existing, pk))
    raise ValueError(f"mode is one of {MODES}, not {mode!r}")


def absent_only(batch: DataFrame, existing: DataFrame, pk: Sequence[str]) -> DataFrame:
    """Rows of the batch whose key the table does not hold; only the table's keys are read."""
    return batch.join(existing.select(*pk), list(pk), "left_anti")
