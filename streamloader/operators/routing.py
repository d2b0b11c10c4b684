"""Destination table of each message."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

NO_OVERRIDE = "NO_OVERRIDE"
NO_TABLE_NAME = "NO_TABLE_NAME"

# Fixed value: what a dot of a topic name becomes in a table name.
DOT_REPLACEMENT = "_"


def simple_name(name: Column) -> Column:
    """Text after the last dot, closing dots aside."""
    return F.substring_index(F.regexp_replace(name, r"[.]+$", ""), ".", -1)


def qualify(name: Column, schema_name: str = "") -> Column:
    """Put the namespace before a name that has no dot of its own."""
    if not schema_name:
        return name
    return F.when(name.contains("."), name).otherwise(F.concat(F.lit(schema_name + "."), name))


def _override(
    topics: Sequence[str], overrides: Sequence[str], schema_name: str
) -> tuple[Column, Column] | None:
    if len(topics) != len(overrides):
        return None
    if len(topics) == 1:
        return qualify(F.lit(overrides[0]), schema_name), F.lit(None).cast("string")
    by_topic: dict[str, str] = {}
    for topic, table in zip(topics, overrides):
        by_topic.setdefault(topic.strip().lower(), table)
    pairs = F.create_map(*[F.lit(x) for item in by_topic.items() for x in item])
    table = F.try_element_at(pairs, F.lower(F.trim("topic")))
    return qualify(table, schema_name), F.when(table.isNull(), F.lit(NO_OVERRIDE))


def check_overrides(
    topics: Sequence[str] | None, topics_regex: str | None, overrides: Sequence[str] | None
) -> None:
    """Overrides are positional, so they need a topic list and no blank names."""
    if not overrides:
        return
    if topics_regex is not None or not topics:
        raise ValueError("overrides need a topic list, not a regex")
    for table in overrides:
        parts = table.strip().split(".")
        if not all(parts) or len(parts) > 2:
            raise ValueError(f"bad override {table!r}: expected table or schema.table")


def route(
    df: DataFrame,
    *,
    topics: Sequence[str] | None = None,
    topics_regex: str | None = None,
    overrides: Sequence[str] | None = None,
    prefix: str = "",
    schema_name: str = "",
    single_table_per_topic: bool = False,
    schemaless: Column | None = None,
) -> DataFrame:
    """Add `dest_table`, by override, topic, schema name or text key.

    An override list of the topics' length wins over everything else; one of another length is
    ignored.  Topics match trimmed and whatever their case, table names are taken as they are given.  With `single_table_per_topic` the topic names the table, and an empty topic falls
    back to the schema.  Otherwise the schema's simple name does; a schemaless message takes its
    text key, or else its topic, as schema name.  A message counts as schemaless when it has
    neither schema name nor version, unless `schemaless` says otherwise.
    """
    check_overrides(topics, topics_regex, overrides)
    reason = F.lit(None).cast("string")
    chosen = _override(topics or (), overrides, schema_name) if overrides else None
    if chosen is not None:
        table, reason = chosen
    else:
        if schemaless is None:
            schemaless = F.col("schema_name").isNull() & F.col("schema_version").isNull()
        topic = F.regexp_replace("topic", "[.]", DOT_REPLACEMENT)
        schema = F.when(schemaless, F.coalesce("key", "topic")).otherwise(F.col("schema_name"))
        if single_table_per_topic:
            name = F.when(F.coalesce(topic, F.lit("")) == "", simple_name(schema)).otherwise(topic)
        else:
            name = F.coalesce(simple_name(schema), topic)
        table = qualify(F.concat(F.lit(prefix.strip()), name), schema_name)
        reason = F.when(F.coalesce(name, F.lit("")) == "", F.lit(NO_TABLE_NAME))
    if "reason" in df.columns:
        reason = F.coalesce(F.col("reason"), reason)
    return df.withColumns({"dest_table": table, "reason": reason})
