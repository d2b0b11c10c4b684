"""Separation of refused rows, and ingest counts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..sources.messages import ENVELOPE_COLUMNS

NULL_PK = "NULL_PK"

DETAIL_COLUMNS = ("dest_table", "reason", "bad_column", "bad_value")


def require_key(df: DataFrame, primary_key: list[str] | tuple[str, ...]) -> DataFrame:
    """Refuse projected rows with a null in the primary key."""
    if not primary_key:
        return df
    missing = F.coalesce(
        *[F.when(F.col("record")[c].isNull(), F.lit(c)) for c in primary_key], F.lit(None).cast("string")
    )
    return df.withColumns(
        {
            "bad_column": F.when(F.col("reason").isNull(), missing).otherwise(F.col("bad_column")),
            "reason": F.coalesce(F.col("reason"), F.when(missing.isNotNull(), F.lit(NULL_PK))),
        }
    )


def quarantine_shape(df: DataFrame) -> DataFrame:
    """Envelope and refusal details of a frame of refused rows, in one fixed shape."""
    names = [*ENVELOPE_COLUMNS, *DETAIL_COLUMNS]
    types = {"partition": "int", "offset": "bigint", "timestamp": "timestamp", "schema_version": "int"}
    return df.select(
        *[
            (F.col(c) if c in df.columns else F.lit(None)).cast(types.get(c, "string")).alias(c)
            for c in names
        ]
    )


def split(df: DataFrame, on_error: str = "quarantine") -> tuple[DataFrame, DataFrame]:
    """Accepted rows as table columns, and refused rows in quarantine shape.

    With `on_error="fail"` the first refused row fails the write that consumes the accepted rows.
    """
    bad = quarantine_shape(df.where(F.col("reason").isNotNull()))
    if on_error == "fail":
        return stop_on_refusal(df).select("record.*"), bad
    if on_error != "quarantine":
        raise ValueError(f"on_error is 'quarantine' or 'fail', not {on_error!r}")
    return df.where(F.col("reason").isNull()).select("record.*"), bad


def stop_on_refusal(df: DataFrame) -> DataFrame:
    """Fail the running job at the first refused row."""
    column = F.coalesce(F.col("bad_column"), F.lit("-")) if "bad_column" in df.columns else F.lit("-")
    message = F.concat(
        F.lit("refused row for "),
        F.coalesce(F.col("dest_table"), F.lit("?")) if "dest_table" in df.columns else F.lit("?"),
        F.lit(": "),
        F.col("reason"),
        F.lit(" in column "),
        column,
    )
    return df.where(F.when(F.col("reason").isNull(), F.lit(True)).otherwise(F.raise_error(message).cast("boolean")))


def ingest_metrics() -> list[Column]:
    """Aggregates for `DataFrame.observe`: counts that ride on the write, without a job of their own."""
    return [
        F.count_if(F.col("reason").isNull()).alias("accepted"),
        F.count_if(F.col("reason").isNotNull()).alias("refused"),
    ]


def ingest_counts(df: DataFrame) -> DataFrame:
    """Accepted and refused rows per destination table."""
    return df.groupBy("dest_table").agg(*ingest_metrics())
