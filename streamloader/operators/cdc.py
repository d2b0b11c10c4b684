"""Change-data envelopes."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions.once import compute_once

CDC_NO_AFTER = "CDC_NO_AFTER"


def unwrap_cdc(df: DataFrame, value: str = "value") -> DataFrame:
    """Replace a change-data envelope by its `after` image; other messages pass as they are.

    An envelope is a JSON object with a non-null `op_type`.  Without an `after` image (deletes) the
    row keeps its text and gets a reason.  Only texts that can hold the word are parsed, the rest
    cost one substring search.
    """
    text = F.col(value)
    # A key may be spelled with unicode escapes, so texts holding one are parsed as well.
    may_hold = text.contains('"op_type"') | text.contains("\\u")
    envelope = F.when(may_hold, F.from_json(text, "op_type string, after string"))
    wrapped = F.col("_cdc.op_type").isNotNull()
    after = F.col("_cdc.after")
    no_after = F.when(wrapped & after.isNull(), F.lit(CDC_NO_AFTER))
    reason = F.coalesce(F.col("reason"), no_after) if "reason" in df.columns else no_after
    return (
        compute_once(df, "_cdc", envelope)
        .withColumns(
            {value: F.when(wrapped & after.isNotNull(), after).otherwise(text), "reason": reason}
        )
        .drop("_cdc")
    )
