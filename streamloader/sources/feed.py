"""Change feeds: the rows of a table as keyed, versioned messages."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F, types as T

from ..functions.types import UnsupportedSchema, is_flat
from ..sinks import files
from ..sinks.files import shared_folder
from ..sinks.tables import APPEND, BATCH_FOLDER, COMPACTED, INSERT, UPSERT, Tables
from .decode import message_schema
from .messages import ENVELOPE_COLUMNS, json_value

def number_rows(
    df: DataFrame, order: Sequence[str] | None = None, start: int = 0, stable: bool = False
) -> DataFrame:
    """Add a dense running number `sequence` from `start`.

    Nothing passes through one task: a row's number is (rows in earlier partitions) + (place in its
    partition).  The frame is first written to the shared folder (a checkpoint, which Spark removes with
    the frame), sorted when an order is given, so the numbers stay the same when executors are lost.
    `stable` says that the frame has the same partitions whenever it is computed, as a plain scan
    of files has; it is then numbered where it lies.
    """
    spark = df.sparkSession
    names = df.columns
    if order is not None:
        # The row id breaks ties, so equal order values cannot pile up in one range partition.
        tied = df.withColumn("__tie", F.monotonically_increasing_id())
        df = tied.orderBy(*order, "__tie").drop("__tie")
    if order is not None or not stable:
        if spark.sparkContext.getCheckpointDir() is None:
            spark.sparkContext.setCheckpointDir(shared_folder(spark))
        df = df.checkpoint()
    # The id holds the partition's number in its upper bits and the row's place in the lower 33.
    placed = df.withColumn("__id", F.monotonically_increasing_id()).withColumn("__part", F.shiftright("__id", 33))
    sizes = placed.groupBy("__part").agg(F.count(F.lit(1)).alias("__n"))
    firsts = sizes.select(
        "__part", (F.sum("__n").over(Window.orderBy("__part")) - F.col("__n") + start).alias("__first")
    )
    # One row per partition: no more than the driver already keeps for them.
    numbered = placed.join(F.broadcast(firsts), "__part")
    place = F.col("__id").bitwiseAND(F.lit((1 << 33) - 1))
    return numbered.select((F.col("__first") + place).alias("sequence"), *[F.col(f"`{c}`") for c in names])


def as_message_columns(df: DataFrame) -> DataFrame:
    """Times and dates as epoch milliseconds in `timestamp` columns; any other column must be flat."""
    times = (T.TimestampType, T.TimestampNTZType, T.DateType)
    columns, bad = [], []
    for f in df.schema.fields:
        value = F.col(f"`{f.name}`")
        if isinstance(f.dataType, times):
            columns.append(F.unix_millis(value.cast("timestamp")).alias(f.name, metadata={"properties": ["timestamp"]}))
        elif is_flat(f.dataType):
            columns.append(value)
        else:
            bad.append(f.name)
    if bad:
        raise UnsupportedSchema("no message type for columns: " + ", ".join(bad))
    return df.select(*columns)


def number_by(rows: DataFrame, by: str, starts: DataFrame | None = None) -> DataFrame:
    """Add `sequence`, a dense running number for each value of `by`, from `starts` (by, next) on or else from 0.

    `rows` must be a plain scan of parquet files of which each holds one value of `by`, as `partitionBy` leaves them.  A row's
    number is its place in its file and the rows of the value in earlier files, so no row moves; the
    table of files has one row for each, and Spark broadcasts it when its size allows.
    """
    names = rows.columns
    placed = rows.select("*", F.col("_metadata.file_path").alias("__file"), F.col("_metadata.row_index").alias("__row"))
    sizes = placed.groupBy(by, "__file").agg(F.count(F.lit(1)).alias("__n"))
    before = F.sum("__n").over(Window.partitionBy(by).orderBy("__file")) - F.col("__n")
    firsts = sizes.select(by, F.col("__file").alias("__in"), before.alias("__first"))
    if starts is not None:
        firsts = firsts.join(starts.select(F.col(by).alias("__by"), "next"), F.col(by).eqNullSafe(F.col("__by")), "left")
        firsts = firsts.withColumn("__first", F.col("__first") + F.coalesce("next", F.lit(0)))
    numbered = placed.join(firsts.select("__in", "__first"), F.col("__file") == F.col("__in"))
    return numbered.select((F.col("__first") + F.col("__row")).alias("sequence"), *[F.col(f"`{c}`") for c in names])


def _packed(df: DataFrame, table: str, topic_prefix: str, version: int, key: Column) -> DataFrame:
    schema = T.StructType([f for f in df.schema.fields if f.name != "sequence"])
    return df.select(
        F.lit(f"{topic_prefix}{table}").alias("topic"),
        F.lit(0).alias("partition"),
        key.cast("bigint").alias("offset"),
        F.lit(None).cast("timestamp").alias("timestamp"),
        key.cast("string").alias("key"),
        F.lit(table).alias("schema_name"),
        F.lit(version).alias("schema_version"),
        json_value(*schema.names).alias("value"),
        F.lit(message_schema(schema, table, version)).alias("message_schema"),
    )


def change_feed(
    df: DataFrame,
    table: str,
    topic_prefix: str = "",
    schema_version: int = 1,
    order: Sequence[str] | None = None,
    start: int = 0,
    stable: bool = False,
) -> DataFrame:
    """Every row of an append-only table as a message.

    Topic = prefix + table, key and offset = running number, value = the row as JSON with nulls kept,
    schema = the table's columns, times as epoch milliseconds.  Updates and deletes are not part of a
    feed.  `stable` is as in `number_rows`.
    """
    table = table.strip()
    numbered = number_rows(as_message_columns(df), order, start, stable)
    return _packed(numbered, table, topic_prefix, schema_version, F.col("sequence"))


def feed_versions(
    tables: Sequence[str], schema_versions: Sequence[int] | Mapping[str, int] | None
) -> dict[str, int]:
    """Schema version of each table: given by name or position, 1 where not given."""
    names = [t.strip() for t in tables]
    if not names or not all(names):
        raise ValueError("table names are empty")
    if schema_versions is None:
        return {name: 1 for name in names}
    if isinstance(schema_versions, Mapping):
        unknown = set(schema_versions) - set(names)
        if unknown:
            raise ValueError(f"versions for unknown tables: {sorted(unknown)}")
        return {name: int(schema_versions.get(name, 1)) for name in names}
    if len(schema_versions) != len(names):
        raise ValueError("give one schema version per table")
    return dict(zip(names, map(int, schema_versions)))


def fan_in(
    frames: Mapping[str, DataFrame],
    topic_prefix: str = "",
    schema_versions: Sequence[int] | Mapping[str, int] | None = None,
    order: Mapping[str, Sequence[str]] | None = None,
) -> DataFrame:
    """The feeds of several tables as one frame of messages, one topic per table.

    Streaming frames come out as a stream of unnumbered messages, which `write_feed` numbers topic by topic.
    """
    versions = feed_versions(list(frames), schema_versions)
    merged = None
    for name, df in frames.items():
        version = versions[name.strip()]
        if df.isStreaming:
            feed = _packed(as_message_columns(df), name.strip(), topic_prefix, version, F.lit(None))
        else:
            feed = change_feed(df, name, topic_prefix, version, (order or {}).get(name))
        merged = feed if merged is None else merged.unionByName(feed)
    return merged


def stream_feed(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    table: str,
    topic_prefix: str = "",
    schema_version: int = 1,
    max_files_per_trigger: int | None = None,
) -> DataFrame:
    """Rows arriving in a folder or below it as unnumbered messages; `write_feed` numbers them per batch.

    Rows already there come first, then every file added later.
    """
    return fan_in({table: _arriving(spark, path, schema, max_files_per_trigger)}, topic_prefix, [schema_version])


def _arriving(spark: SparkSession, path: str, schema: T.StructType, max_files_per_trigger: int | None) -> DataFrame:
    reader = spark.readStream.schema(schema).option("recursiveFileLookup", "true")
    if max_files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.parquet(path)


def inserted_rows(
    tables: Tables, name: str, modes: Sequence[str] = (APPEND, INSERT, UPSERT), max_files_per_trigger: int | None = None
) -> DataFrame:
    """A stream of the rows that batches of the given modes brought into a table, each once.

    The folder that a file lies in tells its batch's mode and label.  What compaction wrote are rows that came
    before, so those files are left out.
    """
    state = tables.require(name)
    path = tables.data_path(name)
    files.make_folder(tables.spark, path)
    rows = _arriving(tables.spark, path, state.schema, max_files_per_trigger)
    file = F.col("_metadata.file_path")
    mode = F.regexp_extract(file, BATCH_FOLDER, 1)
    compacted = F.startswith(F.regexp_extract(file, BATCH_FOLDER, 2), F.lit(COMPACTED))
    return rows.where(mode.isin(list(modes)) & ~compacted)


def stream_table(
    tables: Tables,
    name: str,
    topic_prefix: str = "",
    schema_version: int = 1,
    max_files_per_trigger: int | None = None,
) -> DataFrame:
    """The rows of a table of this library as messages, batch after batch as they are written."""
    rows = inserted_rows(tables, name, max_files_per_trigger=max_files_per_trigger)
    return fan_in({name: rows}, topic_prefix, [schema_version])


def stream_tables(
    tables: Tables,
    names: Sequence[str],
    topic_prefix: str = "",
    schema_versions: Sequence[int] | Mapping[str, int] | None = None,
    max_files_per_trigger: int | None = None,
) -> DataFrame:
    """The live feeds of several tables as one stream of messages, one topic per table."""
    rows = {name: inserted_rows(tables, name, max_files_per_trigger=max_files_per_trigger) for name in names}
    return fan_in(rows, topic_prefix, schema_versions)


def write_topics(df: DataFrame, path: str, mode: str = "append") -> None:
    """Messages as files, one folder per topic."""
    out = [c for c in (*ENVELOPE_COLUMNS, "message_schema") if c in df.columns]
    df.select(*out).write.mode(mode).partitionBy("topic").parquet(path)


def with_schema(df: DataFrame) -> DataFrame:
    """Feed messages whose value carries its schema: `{"schema": .., "payload": ..}`."""
    opened = F.concat(F.lit('{"schema":'), "message_schema", F.lit(',"payload":'), F.coalesce("value", F.lit("null")), F.lit("}"))
    return df.withColumn("value", opened)


def write_kafka(df: DataFrame, options: Mapping[str, str]) -> None:
    """Messages to a Kafka cluster, with their schemas; needs Spark's Kafka package on the classpath."""
    carried = with_schema(df) if "message_schema" in df.columns else df
    carried.select("topic", "key", "value").write.format("kafka").options(**options).save()
