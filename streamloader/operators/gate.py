"""Refusal of messages whose schema version is blocked."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, functions as F

VERSION_BLOCKED = "VERSION_BLOCKED"


def version_gate(df: DataFrame, blocked: Iterable[tuple[str, int | None]]) -> DataFrame:
    """Give rows of a blocked (table, version) pair a reason.

    The pairs are driver-side state, one per refused schema version, and become a hashed literal
    set: no join, no shuffle.  Version None stands for unversioned messages.
    """
    marks = [f"{'' if version is None else version}@{table}" for table, version in blocked]
    if not marks:
        return df if "reason" in df.columns else df.withColumn("reason", F.lit(None).cast("string"))
    version = F.coalesce(F.col("schema_version").cast("string"), F.lit(""))
    refused = F.when(
        F.concat(version, F.lit("@"), F.col("dest_table")).isin(marks), F.lit(VERSION_BLOCKED)
    )
    reason = F.coalesce(F.col("reason"), refused) if "reason" in df.columns else refused
    return df.withColumn("reason", reason)
