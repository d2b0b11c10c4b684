"""The message envelope and the scans that fill it."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

ENVELOPE = T.StructType(
    [
        T.StructField("topic", T.StringType()),
        T.StructField("partition", T.IntegerType()),
        T.StructField("offset", T.LongType()),
        T.StructField("timestamp", T.TimestampType()),
        T.StructField("key", T.StringType()),
        T.StructField("schema_name", T.StringType()),
        T.StructField("schema_version", T.IntegerType()),
        T.StructField("value", T.StringType()),
    ]
)

ENVELOPE_COLUMNS = tuple(ENVELOPE.names)

# Arrival order.  A bus only orders the offsets of one partition, so time comes first; several topics may feed a table.
ARRIVAL = ("timestamp", "partition", "offset", "topic")


def to_envelope(df: DataFrame, *, topic: Column | str, value: Column, **columns: Column) -> DataFrame:
    """Shape any frame as messages.  `value` is JSON text; a plain string `topic` is a constant.

    Other envelope columns are given by name and default to null.  Only text keys name a
    destination table, so a key of any other type is left out of the envelope.
    """
    unknown = set(columns) - set(ENVELOPE_COLUMNS)
    if unknown:
        raise ValueError(f"not envelope columns: {sorted(unknown)}")
    given = {**columns, "topic": F.lit(topic) if isinstance(topic, str) else topic, "value": value}
    if "key" in given:
        key_type = df.select(given["key"].alias("key")).schema["key"].dataType
        if not isinstance(key_type, T.StringType):
            del given["key"]
    return df.select(
        *[given.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in ENVELOPE.fields]
    )


def json_value(*names: str) -> Column:
    """The named columns as one JSON object, nulls kept."""
    return F.to_json(F.struct(*names), {"ignoreNullFields": "false"})


def _check_subscription(topics: Sequence[str] | None, topics_regex: str | None) -> None:
    if (topics is None) == (topics_regex is None):
        raise ValueError("give either topics or topics_regex")
    if topics is not None and not [t for t in topics if t.strip()]:
        raise ValueError("topics is empty")


def subscribe(
    df: DataFrame, topics: Sequence[str] | None = None, topics_regex: str | None = None
) -> DataFrame:
    """Keep the messages of the listed topics, or of the topics a regex matches in full."""
    _check_subscription(topics, topics_regex)
    if topics is not None:
        return df.where(F.col("topic").isin([t.strip() for t in topics]))
    return df.where(F.col("topic").rlike(f"^(?:{topics_regex})$"))


def read_messages(
    spark: SparkSession,
    path: str,
    *,
    streaming: bool = False,
    file_format: str = "parquet",
    max_files_per_trigger: int | None = None,
) -> DataFrame:
    """Messages stored as files in envelope shape, as a batch or a stream."""
    if not streaming:
        return spark.read.format(file_format).schema(ENVELOPE).load(path)
    reader = spark.readStream.format(file_format).schema(ENVELOPE)
    if max_files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.load(path)


def kafka_messages(
    spark: SparkSession,
    options: Mapping[str, str],
    *,
    topics: Sequence[str] | None = None,
    topics_regex: str | None = None,
    streaming: bool = True,
    text_keys: bool = True,
    max_offsets_per_trigger: int | None = None,
) -> DataFrame:
    """Messages of a Kafka cluster; needs Spark's Kafka package on the classpath.

    `options` go to the reader as they are (servers, TLS, SASL).  The raw bytes stay in
    `value_bytes` for registry values.  Only text keys name tables: say `text_keys=False` where keys are
    numbers or records, and they are left out.
    """
    _check_subscription(topics, topics_regex)
    reader = (spark.readStream if streaming else spark.read).format("kafka").options(**options)
    if topics is not None:
        reader = reader.option("subscribe", ",".join(t.strip() for t in topics))
    else:
        reader = reader.option("subscribePattern", topics_regex)
    if streaming and max_offsets_per_trigger is not None:
        reader = reader.option("maxOffsetsPerTrigger", max_offsets_per_trigger)
    raw = reader.load()
    return raw.select(
        "topic",
        "partition",
        "offset",
        "timestamp",
        (F.col("key") if text_keys else F.lit(None)).cast("string").alias("key"),
        F.lit(None).cast("string").alias("schema_name"),
        F.lit(None).cast("int").alias("schema_version"),
        F.col("value").cast("string").alias("value"),
        F.col("value").alias("value_bytes"),
    )

