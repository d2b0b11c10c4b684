"""One query per operator over the driver's tables.

Messages are derived from whole tables by Spark: the stream is `events`, the evolving and
change-data records are `orders`, keyed targets are `customer`.  Every query takes the session and
the folder of a scale factor and returns a frame; writing queries use the session's shared folder.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from ..functions.types import column
from ..operators.cdc import unwrap_cdc
from ..operators.merge import merge, one_per_key
from ..operators.project import field_map as field_status, project, project_json
from ..operators.quarantine import ingest_counts, require_key
from ..operators.routing import route
from ..operators.schemas import conform, infer_schemas, width_classes
from ..sinks.files import scratch_path
from ..sinks.tables import Tables
from ..sources.decode import RegisteredSchema, decode_payload, decode_schema_json, json_body, message_schema, wire_header
from ..sources.feed import as_message_columns, change_feed, fan_in, stream_table, stream_tables
from ..sources.messages import json_value, subscribe, to_envelope
from ..streaming.run import StreamCounts, merge_stream, observe_counts, write_feed
from .ingest import IngestOptions, ingest

Query = Callable[[SparkSession, str], DataFrame]

LONG, INT, DOUBLE, FLOAT = T.LongType(), T.IntegerType(), T.DoubleType(), T.FloatType()
STRING, BINARY = T.StringType(), T.BinaryType()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def new_tables(spark: SparkSession, label: str) -> Tables:
    return Tables(spark, scratch_path(spark, label))


def cents(value: str | Column) -> Column:
    """Money as whole cents, so sums do not depend on the order of addition."""
    return F.round(F.col(value) * 100 if isinstance(value, str) else value * 100).cast("bigint")


def schema(*fields: T.StructField) -> T.StructType:
    return T.StructType(list(fields))


EVENT = schema(
    column("event_id", LONG, nullable=False),
    column("user_id", LONG),
    column("event_type", STRING),
    column("value", DOUBLE),
)


def event_messages(spark: SparkSession, sf_dir: str, **columns: Column) -> DataFrame:
    """Events as JSON objects on one topic per event type."""
    given = {
        "topic": F.concat(F.lit("app.events."), F.col("event_type")),
        "value": json_value(*EVENT.names),
        "partition": F.lit(0),
        "offset": F.col("event_id"),
        "timestamp": F.col("ts"),
        **columns,
    }
    return to_envelope(table(spark, sf_dir, "events"), **given)


def per_table(routed: DataFrame) -> DataFrame:
    """Rows and value per destination of projected event messages."""
    return routed.groupBy("dest_table").agg(
        F.count(F.lit(1)).alias("n"), F.sum(cents(F.col("record.value"))).alias("value_cents")
    )


def route_topic(spark: SparkSession, sf_dir: str) -> DataFrame:
    routed = route(
        event_messages(spark, sf_dir),
        topics_regex="app[.]events[.].*",
        prefix=" raw_",
        schema_name="stage",
        single_table_per_topic=True,
    )
    return per_table(project_json(routed, EVENT))


def create_write(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tables inferred, created and filled by one job, then read back."""
    tables = new_tables(spark, "created")
    options = IngestOptions(single_table_per_topic=True, schema_name="shop")
    counts = ingest(event_messages(spark, sf_dir), tables, options)
    return read_back(tables, sorted(counts))


def read_back(tables: Tables, names: list[str]) -> DataFrame:
    merged = None
    for name in names:
        rows = tables.read(name).groupBy().agg(
            F.count(F.lit(1)).alias("n"),
            F.sum(cents("value")).alias("value_cents"),
            F.sum("user_id").alias("user_ids"),
        )
        rows = rows.select(F.lit(name).alias("dest_table"), "n", "value_cents", "user_ids")
        merged = rows if merged is None else merged.unionByName(rows)
    return merged


def route_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.col("event_type")
    named = kind.isin("click", "view")
    messages = event_messages(
        spark,
        sf_dir,
        topic=F.lit("app.events"),
        schema_name=F.when(named, F.concat(F.lit("com.shop."), kind)),
        key=F.when(kind == "purchase", F.concat(F.lit("keys."), kind)),
        schema_version=F.when(named | (kind == "signup"), F.lit(1)),
    )
    return per_table(project_json(route(messages, prefix="t_"), EVENT))


def route_override(spark: SparkSession, sf_dir: str) -> DataFrame:
    messages = to_envelope(
        table(spark, sf_dir, "orders"),
        topic=F.concat(F.lit("orders."), F.col("o_orderpriority")),
        value=json_value("o_orderkey"),
    )
    routed = route(
        messages,
        topics=[" ORDERS.1-urgent", "orders.2-HIGH ", "Orders.3-Medium", "orders.4-not specified"],
        overrides=["hot.urgent", "high", " medium", "other "],
        schema_name="sales",
    )
    return routed.groupBy("dest_table", "reason").agg(F.count(F.lit(1)).alias("n"))


def decode_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The JSON text the table holds, by its own type and as text."""
    target = schema(column("k", LONG), column("absent", STRING))
    messages = event_messages(spark, sf_dir, value=F.col("props"))
    out = project_json(messages, target)
    return out.groupBy("topic").agg(
        F.count("record.k").alias("n"),
        F.sum("record.k").alias("sum_k"),
        F.count("record.absent").alias("n_absent"),
    )


def decode_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole document texts through JSON and back, all scripts and escapes included."""
    target = schema(column("doc_id", LONG), column("text", STRING), column("n_chars", INT))
    messages = to_envelope(
        table(spark, sf_dir, "documents"),
        topic=F.col("source"),
        value=json_value("doc_id", "text", "n_chars"),
    )
    out = project_json(messages, target).where(F.col("reason").isNull())
    return out.select(
        F.col("record.doc_id").alias("doc_id"),
        F.md5(F.col("record.text").cast("binary")).alias("text_md5"),
        F.col("record.n_chars").alias("n_chars"),
    )


ORDER = schema(
    column("o_orderkey", LONG, nullable=False),
    column("o_custkey", LONG, nullable=False),
    column("o_orderstatus", STRING),
    column("o_totalprice", DOUBLE),
)


def declared_value(columns: T.StructType, name: str, version: int) -> Column:
    """The columns as a message that carries its schema."""
    head = F.lit('{"schema":' + message_schema(columns, name, version) + ',"payload":')
    return F.concat(head, json_value(*columns.names), F.lit("}"))


def decode_envelope(spark: SparkSession, sf_dir: str) -> DataFrame:
    messages = to_envelope(
        table(spark, sf_dir, "orders"), topic="orders", value=declared_value(ORDER, "com.shop.Order", 2)
    )
    opened = decode_payload(decode_schema_json(messages), ORDER)
    out = project(opened, ORDER, source="payload").where(F.col("reason").isNull())
    return out.select("schema_name", "schema_version", "record.*")


def cdc_unwrap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as inserts, updates and deletes, those of low priority as plain objects."""
    status = F.col("o_orderstatus")
    image = F.struct("o_orderkey", "o_custkey", "o_totalprice")
    op = F.when(status == "O", "I").when(status == "F", "U").otherwise("D")
    wrapped = F.to_json(
        F.struct(
            F.lit("SHOP.ORDERS").alias("table"),
            op.alias("op_type"),
            F.col("o_orderdate").cast("string").alias("op_ts"),
            F.when(op != "I", image).alias("before"),
            F.when(op != "D", image).alias("after"),
        )
    )
    plain = F.col("o_orderpriority") == "5-LOW"
    messages = to_envelope(
        table(spark, sf_dir, "orders"),
        topic=F.col("o_orderpriority"),
        value=F.when(plain, F.to_json(image)).otherwise(wrapped),
    )
    target = schema(column("o_orderkey", LONG, False), column("o_totalprice", DOUBLE))
    out = project_json(unwrap_cdc(messages), target)
    accepted = F.col("reason").isNull()
    return out.groupBy("topic", "reason").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(F.when(accepted, F.col("record.o_orderkey"))).alias("order_keys"),
        F.sum(F.when(accepted, cents(F.col("record.o_totalprice")))).alias("price_cents"),
    )


def mixed_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three kinds of records, each on its topic; order keys give the arrival order."""
    orders = table(spark, sf_dir, "orders").withColumn(
        "o_state", F.when(F.col("o_orderstatus") != "P", F.col("o_orderstatus"))
    )
    customers = table(spark, sf_dir, "customer")
    parts = table(spark, sf_dir, "part")
    frames = [
        to_envelope(
            orders,
            topic="orders",
            offset=F.col("o_orderkey"),
            value=json_value("o_orderkey", "o_state", "o_totalprice", "o_custkey"),
        ),
        to_envelope(
            customers,
            topic="customer",
            offset=F.col("c_custkey"),
            value=json_value("c_name", "c_custkey", "c_acctbal"),
        ),
        to_envelope(
            parts,
            topic="part",
            offset=F.col("p_partkey"),
            value=json_value("p_partkey", "p_size", "p_brand"),
        ),
    ]
    merged = frames[0].unionByName(frames[1]).unionByName(frames[2])
    return route(merged, single_table_per_topic=True)


def infer_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    return infer_schemas(mixed_messages(spark, sf_dir), order=["offset"])


def infer_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    return infer_schemas(mixed_messages(spark, sf_dir), infer="all")


def conform_message(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").withColumn("positive", F.col("label") > 0)
    events = table(spark, sf_dir, "events")
    parts = []
    for name, df, key in (("embeddings", vectors, "vec_id"), ("events", events, "event_id")):
        kept, left_out = conform(df, rules="message")
        parts.append(
            kept.groupBy().agg(
                F.lit(name).alias("table"),
                F.lit(",".join(kept.columns)).alias("kept"),
                F.lit(",".join(left_out)).alias("left_out"),
                F.count(F.lit(1)).alias("n"),
                F.sum(key).alias("key_sum"),
            )
        )
    return parts[0].unionByName(parts[1])


def conform_avro(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey",
        (F.col("o_totalprice") > 200000).alias("large"),
        F.struct(F.col("o_orderkey").alias("member0"), F.col("o_orderstatus").alias("member1")).alias("either"),
        "o_orderpriority",
    )
    return conform(orders, rules="avro", strict=True)[0]


def _evolving_messages(
    spark: SparkSession, sf_dir: str, shapes: dict[int, T.StructType], rows: dict[int, Column]
) -> dict[int, DataFrame]:
    """Orders as declared messages of several versions."""
    orders = table(spark, sf_dir, "orders").withColumn("o_channel", F.lit("store"))
    return {
        version: to_envelope(
            orders.where(rows[version]),
            topic="orders",
            offset=F.col("o_orderkey"),
            partition=F.lit(0),
            timestamp=F.col("o_orderdate"),
            value=declared_value(columns, "com.shop.Order", version),
        )
        for version, columns in shapes.items()
    }


EVOLVING = dict(value_format="schema_json", single_table_per_topic=True, evolve=True)


def _added_columns(spark: SparkSession, sf_dir: str) -> dict[int, DataFrame]:
    """Version 2 adds two columns, one with a text default that older rows then read."""
    plus = schema(
        *ORDER.fields, column("o_orderpriority", STRING), column("o_channel", STRING)
    )
    finished = F.col("o_orderstatus") == "F"
    frames = _evolving_messages(spark, sf_dir, {1: ORDER, 2: plus}, {1: finished, 2: ~finished})
    default = ('"field": "o_channel", "type"', '"field": "o_channel", "default": "web", "type"')
    frames[2] = frames[2].withColumn("value", F.replace("value", F.lit(default[0]), F.lit(default[1])))
    return frames


def _evolved(spark: SparkSession, batches: list[DataFrame], **options: bool) -> DataFrame:
    """The table of orders after the batches, with the columns that it then has."""
    tables = new_tables(spark, "evolved")
    for number, batch in enumerate(batches):
        ingest(batch, tables, IngestOptions(**EVOLVING, **options), job="evolve", batch_id=number)
    return tables.read("orders")


def evolve_add(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The two versions one after the other."""
    frames = _added_columns(spark, sf_dir)
    return _evolved(spark, [frames[1], frames[2]], add_new_fields=True)


def evolve_one_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The two versions mixed in one batch: the same table."""
    frames = _added_columns(spark, sf_dir)
    return _evolved(spark, [frames[1].unionByName(frames[2])], add_new_fields=True)


def evolve_relax(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Version 2 lacks a required column, which is relaxed."""
    less = schema(*[f for f in ORDER.fields if f.name != "o_custkey"])
    large = F.col("o_totalprice") > 250000
    frames = _evolving_messages(spark, sf_dir, {1: ORDER, 2: less}, {1: large, 2: ~large})
    return _evolved(spark, [frames[1], frames[2]], relax_missing=True)


def evolve_ignore(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Version 2 has an extra field, which no edit is allowed for."""
    plus = schema(*ORDER.fields, column("o_orderpriority", STRING))
    urgent = F.col("o_orderpriority") == "1-URGENT"
    frames = _evolving_messages(spark, sf_dir, {1: ORDER, 2: plus}, {1: urgent, 2: ~urgent})
    return _evolved(spark, [frames[1], frames[2]])


def field_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How customer records meet a table, with the values each of their fields holds."""
    target = schema(column("c_custkey", LONG), column("c_phone", STRING), column("c_name", STRING))
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey", "c_mktsegment")
    names = customers.columns
    pairs = ", ".join(f"'{c}', n_{c}" for c in names)
    held = customers.agg(*[F.count(c).alias(f"n_{c}") for c in names])
    held = held.selectExpr(f"stack({len(names)}, {pairs}) as (column, n_values)")
    report = field_status(spark, target, customers.schema)
    return report.join(held, "column", "left").select("column", "status", "n_values")


def field_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Retyped, missing and ignored fields of customer records."""
    target = schema(
        column("c_custkey", LONG, nullable=False),
        column("c_nationkey", STRING),
        column("c_acctbal", LONG),
        column("c_phone", STRING),
        column("c_name", STRING),
    )
    messages = to_envelope(
        table(spark, sf_dir, "customer"),
        topic="customer",
        value=json_value("c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"),
    )
    return project_json(messages, target).where(F.col("reason").isNull()).select("record.*")


NARROWED = schema(
    column("wrapped", INT),
    column("saturated", INT),
    column("truncated", LONG),
    column("widened", DOUBLE),
    column("narrowed", FLOAT),
)


def _wide_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    price = F.col("l_extendedprice")
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        (F.col("l_orderkey") * 1000003).alias("wrapped"),
        (price * 40000).alias("saturated"),
        price.alias("truncated"),
        F.col("l_linenumber").alias("widened"),
        price.alias("narrowed"),
    )


def _narrowed(out: DataFrame) -> DataFrame:
    return out.select(
        "l_orderkey",
        "record.wrapped",
        "record.saturated",
        "record.truncated",
        "record.widened",
        F.col("record.narrowed").cast("double").alias("narrowed"),
    )


def narrow_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _narrowed(project(_wide_numbers(spark, sf_dir), NARROWED))


def narrow_json_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same rules for numbers whose type is known per value only."""
    texts = _wide_numbers(spark, sf_dir).select(
        "l_orderkey", json_value(*NARROWED.names).alias("value")
    )
    return _narrowed(project_json(texts, NARROWED, typed_parse=False))


def number_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    target = schema(
        column("l_orderkey", STRING), column("l_quantity", STRING), column("l_extendedprice", STRING)
    )
    lines = table(spark, sf_dir, "lineitem").select(*target.names)
    return project(lines, target).select("record.*")


TIMED = schema(column("event_id", LONG), column("at", LONG, props=["timestamp"]))


def parse_ts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts with nine or no fraction digits, some beyond the range, some not a time at all."""
    kind = F.col("event_type")
    whole = F.date_format("ts", "yyyy-MM-dd HH:mm:ss")
    nine = F.concat(F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS"), F.lit("789"))
    text = (
        F.when(kind == "click", whole)
        .when(kind == "view", F.concat(F.lit("9999"), F.substring(nine, 5, 40)))
        .when(kind == "signup", F.concat(F.lit("0900"), F.substring(nine, 5, 40)))
        .when(kind == "error", F.concat(F.lit("at "), whole))
        .otherwise(nine)
    )
    events = table(spark, sf_dir, "events").withColumn("at", text)
    messages = to_envelope(events, topic="events", value=json_value("event_id", "at"))
    return project_json(messages, TIMED).select(
        F.col("record.event_id").alias("event_id"), F.col("record.at").alias("at_ms"), "reason"
    )


def datetime_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    target = schema(column("event_id", LONG), column("at", STRING, props=["datetime"]))
    events = table(spark, sf_dir, "events").select("event_id", F.unix_millis(F.col("ts").cast("timestamp")).alias("at"))
    return project(events, target).select("record.*")


def booleans(spark: SparkSession, sf_dir: str) -> DataFrame:
    target = schema(
        column("event_id", LONG),
        column("as_text", STRING),
        column("as_int", INT),
        column("as_long", LONG),
        column("as_double", DOUBLE),
    )
    large = F.col("value") > 50
    events = table(spark, sf_dir, "events").select(
        "event_id", *[large.alias(name) for name in target.names[1:]]
    )
    messages = to_envelope(events, topic="events", value=json_value(*target.names))
    return project_json(messages, target, typed_parse=False).select("record.*")


def bytes_column(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes travel as base64 in messages that declare them, and arrive as bytes."""
    shape = schema(column("o_orderkey", LONG), column("raw", BINARY))
    orders = table(spark, sf_dir, "orders").withColumn("raw", F.encode("o_orderpriority", "UTF-8"))
    messages = to_envelope(orders, topic="orders", value=declared_value(shape, "com.shop.Raw", 1))
    opened = decode_payload(decode_schema_json(messages), shape)
    out = project(opened, shape, source="payload")
    raw = F.col("record.raw")
    return out.select("record.o_orderkey", F.decode(raw, "UTF-8").alias("raw"), F.octet_length(raw).alias("size"), "reason")


def quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Refusals by reason and column, with the values of the refused columns."""
    kind = F.col("event_type")
    good = json_value(*EVENT.names)
    value = (
        F.when(kind == "click", F.concat(F.lit("["), good, F.lit("]")))
        .when(kind == "view", F.to_json(F.struct(F.col("user_id").cast("string").alias("event_id"))))
        .when(kind == "signup", F.to_json(F.struct("user_id", "value")))
        .when((kind == "error") & (F.col("value") > 20), F.substring(good, 1, 20))
        .when(kind == "error", F.lit(None))
        .otherwise(good)
    )
    routed = route(event_messages(spark, sf_dir, value=value), single_table_per_topic=True)
    out = project_json(routed, EVENT)
    return out.groupBy("dest_table", "reason", "bad_column").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col("bad_value").cast("bigint")).alias("bad_values")
    )


def quarantine_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A job with refusals, its batch replayed: every refused row is stored once."""
    value = F.when(F.col("event_type") == "view", F.to_json(F.struct(F.col("user_id").cast("string").alias("event_id"))))
    value = value.when(F.col("event_type") == "error", F.lit("{")).otherwise(json_value(*EVENT.names))
    messages = event_messages(spark, sf_dir, value=value, topic=F.lit("events"))
    tables = new_tables(spark, "refused")
    tables.create("events", EVENT, primary_key=["event_id"])
    for _ in range(2):
        ingest(messages, tables, IngestOptions(single_table_per_topic=True), job="events", batch_id=1)
    stored = tables.read("_quarantine").groupBy("dest_table", "reason", "bad_column").agg(
        F.count(F.lit(1)).alias("n"), F.sum("offset").alias("event_ids"), F.sum(F.col("bad_value").cast("bigint")).alias("bad_values")
    )
    kept = tables.read("events").agg(F.count(F.lit(1)).alias("n"), F.sum("event_id").alias("event_ids"))
    return stored.unionByName(kept.withColumn("dest_table", F.lit("events")), allowMissingColumns=True)


def upsert_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    latest = one_per_key(events, ["user_id"], ["ts", "event_id"], "last")
    return latest.select("user_id", "event_id", "event_type", "value")


def first_wins(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    first = one_per_key(events, ["user_id"], ["ts", "event_id"], "first")
    return first.select("user_id", "event_id", "event_type", "value")


def append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three batches appended to a table without key: every row stays, repeated keys too."""
    tables = new_tables(spark, "appended")
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_returnflag", "l_extendedprice"
    )
    state = tables.create("lineitem", lines.schema)
    for flag in ("A", "N", "R"):
        tables.write(state, lines.where(F.col("l_returnflag") == flag), f"batch-{flag}")
    return tables.read("lineitem").groupBy("l_returnflag", "l_linenumber").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum("l_orderkey").alias("order_keys"),
        F.sum(cents("l_extendedprice")).alias("price_cents"),
    )


CUSTOMER = ("c_custkey", "c_name", "c_acctbal")


def _customer_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as changes of their customer: many per key, the highest order key last."""
    return table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("c_custkey"),
        F.concat(F.lit("by order "), F.col("o_orderkey").cast("string")).alias("c_name"),
        F.col("o_totalprice").alias("c_acctbal"),
        "o_orderkey",
    )


def upsert_into(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers loaded into a keyed table, then changed through the bucketed merge."""
    tables = new_tables(spark, "upserted")
    customers = table(spark, sf_dir, "customer").select(*CUSTOMER)
    state = tables.create("customer", customers.schema, primary_key=["c_custkey"])
    tables.write(state, customers, "load", ["c_custkey"], "upsert")
    tables.write(state, _customer_changes(spark, sf_dir), "change", ["o_orderkey"], "upsert")
    return tables.read("customer")


def insert_absent(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same changes into a table that holds one market segment; held rows stay as they are."""
    customers = table(spark, sf_dir, "customer").where(F.col("c_mktsegment") == "BUILDING")
    changes = _customer_changes(spark, sf_dir)
    return merge(
        customers.select(*CUSTOMER), changes, ["c_custkey"], ["o_orderkey"], "insert_if_absent"
    )


ORDER_FEED = (
    "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, o_orderdate bigint, o_orderpriority string"
)


def _read_feed(messages: DataFrame) -> DataFrame:
    fields = F.from_json("value", ORDER_FEED)
    names = ("topic", "key", "offset", "schema_name", "schema_version", "message_schema")
    return messages.select(*names, fields.alias("f")).select(*names, "f.*")


def feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as a change feed, their fields read back from the message values."""
    orders = table(spark, sf_dir, "orders")
    return _read_feed(change_feed(orders, "orders", "feed.", schema_version=3, order=["o_orderkey"]))


def feed_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders stored in a table, streamed from it into topic files, and those read back by topic."""
    tables = new_tables(spark, "fed")
    orders = as_message_columns(table(spark, sf_dir, "orders"))
    state = tables.create("orders", orders.schema)
    for status in ("F", "O", "P"):
        tables.write(state, orders.where(F.col("o_orderstatus") == status), f"batch-{status}")
    path = scratch_path(spark, "topics")
    messages = stream_table(tables, "orders", "feed.", 3)
    write_feed(messages, path, checkpoint=scratch_path(spark, "checkpoint")).awaitTermination()
    back = _read_feed(spark.read.schema(messages.schema).parquet(path))
    sums = [F.sum(c).alias(c) for c in ("o_orderkey", "o_custkey", "o_orderdate")]
    return back.groupBy("topic", "schema_name", "schema_version").agg(
        F.count(F.lit(1)).alias("n"),
        F.countDistinct("key").alias("n_keys"),
        F.min("offset").alias("first_offset"),
        F.max("offset").alias("last_offset"),
        *sums,
        F.sum(cents("o_totalprice")).alias("price_cents"),
        F.sum(F.length("o_orderstatus") + F.length("o_orderpriority")).alias("text_length"),
    )


def fan_in_feeds(spark: SparkSession, sf_dir: str) -> DataFrame:
    frames = {
        "customer": table(spark, sf_dir, "customer"),
        "supplier": table(spark, sf_dir, "supplier"),
        "part": table(spark, sf_dir, "part"),
    }
    messages = fan_in(frames, "feed.", {"supplier": 2})
    return messages.groupBy("topic", "schema_name", "schema_version").agg(
        F.count(F.lit(1)).alias("n"),
        F.countDistinct("offset").alias("n_offsets"),
        F.min("offset").alias("first_offset"),
        F.max("offset").alias("last_offset"),
    )


def fan_in_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three tables fed live into one folder by two runs of one checkpoint, each with half of their rows."""
    tables = new_tables(spark, "live")
    keys = {"customer": "c_custkey", "supplier": "s_suppkey", "part": "p_partkey"}
    frames = {name: as_message_columns(table(spark, sf_dir, name)) for name in keys}
    states = {name: tables.create(name, df.schema) for name, df in frames.items()}
    path, checkpoint = scratch_path(spark, "topics"), scratch_path(spark, "checkpoint")
    for half in (0, 1):
        for name, df in frames.items():
            tables.write(states[name], df.where(F.col(keys[name]) % 2 == half), f"half-{half}")
        messages = stream_tables(tables, list(keys), "feed.", {"supplier": 2})
        write_feed(messages, path, checkpoint=checkpoint).awaitTermination()
    back = spark.read.schema(messages.schema).parquet(path)
    sent = F.coalesce(*[F.get_json_object("value", f"$.{k}").cast("bigint") for k in keys.values()])
    return back.groupBy("topic", "schema_name", "schema_version").agg(
        F.count(F.lit(1)).alias("n"),
        F.countDistinct("key").alias("n_keys"),
        F.min("offset").alias("first_offset"),
        F.max("offset").alias("last_offset"),
        F.sum(F.when(F.col("key") == F.col("offset").cast("string"), F.col("offset"))).alias("sum_offsets"),
        F.sum(sent).alias("sum_sent"),
    )


def feed_compacted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A keyed table fed, compacted, fed on, vacuumed and fed again: every inserted row comes out once."""
    tables = new_tables(spark, "compacted")
    customers = as_message_columns(table(spark, sf_dir, "customer"))
    state = tables.create("customer", customers.schema, primary_key=["c_custkey"])
    path, checkpoint = scratch_path(spark, "topics"), scratch_path(spark, "checkpoint")

    def load(label: str, condition: str) -> None:
        tables.write(state, customers.where(condition), label, ["c_custkey"], "insert_if_absent")

    def publish() -> None:
        write_feed(stream_table(tables, "customer", "feed."), path, checkpoint=checkpoint).awaitTermination()

    load("one", "c_custkey % 4 = 0")
    load("two", "c_custkey % 4 = 1")
    publish()
    load("three", "c_custkey % 4 = 2")
    tables.compact("customer")
    publish()
    tables.vacuum("customer")
    load("four", "c_custkey % 4 = 3")
    publish()
    fed = spark.read.schema("value string, key string, offset bigint, topic string").parquet(path)
    rows = fed.select("topic", "offset", F.get_json_object("value", "$.c_custkey").cast("bigint").alias("c_custkey"))
    held = tables.read("customer").select("c_custkey", "c_name", "c_acctbal")
    return rows.join(held, "c_custkey").groupBy("topic").agg(
        F.count(F.lit(1)).alias("n"),
        F.countDistinct("c_custkey").alias("n_customers"),
        F.countDistinct("offset").alias("n_offsets"),
        F.max("offset").alias("last_offset"),
        F.sum(cents("c_acctbal")).alias("balance_cents"),
    )


def fan_out(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One stream over several tables by text key, staged as files; tables exist beforehand."""
    tables = new_tables(spark, "fanned")
    options = IngestOptions(prefix="by_", stage="files", create_table=False)
    kinds = ("click", "error", "purchase", "signup", "view")
    for kind in kinds:
        tables.create(f"by_{kind}", EVENT)
    messages = event_messages(spark, sf_dir, topic=F.lit("events"), key=F.col("event_type"))
    ingest(messages, tables, options)
    return read_back(tables, [f"by_{kind}" for kind in kinds])


def gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Evolution off: the version that arrives first makes the table, the others are refused."""
    version = F.substring("o_orderpriority", 1, 1)
    head = message_schema(ORDER, "com.shop.Order", 0)
    declared = F.replace(F.lit(head), F.lit('"version": 0'), F.concat(F.lit('"version": '), version))
    messages = to_envelope(
        table(spark, sf_dir, "orders"),
        topic="orders",
        offset=F.col("o_orderkey"),
        partition=F.lit(0),
        timestamp=F.col("o_orderdate"),
        value=F.concat(F.lit('{"schema":'), declared, F.lit(',"payload":'), json_value(*ORDER.names), F.lit("}")),
    )
    tables = new_tables(spark, "gated")
    ingest(messages, tables, IngestOptions(value_format="schema_json", single_table_per_topic=True))
    count = F.count(F.lit(1)).alias("n")
    refused = tables.read("_quarantine").groupBy("dest_table", "schema_version", "reason").agg(count)
    kept = tables.read("orders").agg(count).select(
        F.lit("orders").alias("dest_table"), F.lit(None).cast("int").alias("schema_version"), F.lit(None).cast("string").alias("reason"), "n"
    )
    return kept.unionByName(refused)


def registry_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Framed bytes through a job: two registered versions, an id that nobody knows, and cut-off headers."""
    plus = schema(*ORDER.fields, column("o_orderpriority", STRING))
    registry = {
        7: RegisteredSchema("com.shop.Order", 1, ORDER, json_body(ORDER)),
        8: RegisteredSchema("com.shop.Order", 2, plus, json_body(plus)),
    }
    status = F.col("o_orderstatus")
    number = F.when(status == "F", F.lit("07")).when(status == "O", F.lit("08")).otherwise(F.lit("09"))
    body = F.encode(json_value(*plus.names), "UTF-8")
    framed = F.concat(F.unhex(F.concat(F.lit("00000000"), number)), body)
    cut = (status == "F") & (F.col("o_orderpriority") == "1-URGENT")
    orders = table(spark, sf_dir, "orders").withColumn("framed", F.when(cut, F.substring(framed, 1, 4)).otherwise(framed))
    messages = to_envelope(
        orders, topic="orders", offset=F.col("o_orderkey"), partition=F.lit(0), timestamp=F.col("o_orderdate"), value=F.hex("framed")
    ).withColumn("value_bytes", F.unhex("value"))
    tables = new_tables(spark, "registered")
    options = IngestOptions(
        value_format="registry", registry=registry, single_table_per_topic=True, evolve=True, add_new_fields=True
    )
    ingest(messages, tables, options)
    kept = tables.read("orders").groupBy("o_orderpriority").agg(
        F.count(F.lit(1)).alias("n"), F.sum("o_orderkey").alias("order_keys"), F.sum(cents("o_totalprice")).alias("price_cents")
    )
    refused = tables.read("_quarantine").groupBy("reason").agg(F.count(F.lit(1)).alias("n"), F.sum("offset").alias("order_keys"))
    return kept.withColumn("reason", F.lit(None).cast("string")).unionByName(refused, allowMissingColumns=True)


def wire(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Framed bytes, with a wrong magic byte on pending orders and nothing on urgent finished ones."""
    orders = table(spark, sf_dir, "orders")
    magic = F.when(F.col("o_orderstatus") == "P", F.lit("01")).otherwise(F.lit("00"))
    schema_id = F.lpad(F.hex((F.col("o_custkey") * 100003).bitwiseAND(F.lit(2**32 - 1))), 8, "0")
    body = F.encode(F.col("o_orderpriority"), "UTF-8")
    framed = F.concat(F.unhex(F.concat(magic, schema_id)), body)
    empty = (F.col("o_orderstatus") == "F") & (F.col("o_orderpriority") == "1-URGENT")
    frames = orders.select(
        "o_orderkey", F.when(empty, F.substring(framed, 1, 4)).otherwise(framed).alias("value_bytes")
    )
    return wire_header(frames).select(
        "o_orderkey", "schema_id", F.decode("payload", "UTF-8").alias("payload"), "reason"
    )


def width_class(spark: SparkSession, sf_dir: str) -> DataFrame:
    merged = None
    for name in ("part", "customer", "orders", "documents", "pages"):
        rows = width_classes(table(spark, sf_dir, name)).withColumn("table", F.lit(name))
        merged = rows if merged is None else merged.unionByName(rows)
    return merged


def stream_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The latest event per user once more, through a checkpointed file stream."""
    events = table(spark, sf_dir, "events")
    rows = (
        spark.readStream.schema(events.schema)
        .option("pathGlobFilter", "events.parquet")
        .parquet(sf_dir)
        .select("user_id", "event_id", "event_type", "value", "ts")
    )
    tables = new_tables(spark, "streamed")
    names = ["user_id", "event_id", "event_type", "value"]
    tables.create("latest", T.StructType([events.schema[c] for c in names]), primary_key=["user_id"])
    query = merge_stream(
        rows,
        tables,
        "latest",
        ["ts", "event_id"],
        job="stream-upsert",
        checkpoint=scratch_path(spark, "checkpoint"),
    )
    query.awaitTermination()
    return tables.read("latest")


def subscribe_regex(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A regex must match the topic in full."""
    kept = subscribe(event_messages(spark, sf_dir), topics_regex=r"app\.events\.(click|view|sign)")
    return kept.groupBy("topic").agg(
        F.count(F.lit(1)).alias("n"), F.max("offset").alias("last_offset")
    )


def counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Accepted and refused rows per table; the keyed column is null for small values."""
    value = F.to_json(
        F.struct(F.when(F.col("value") > 5, F.col("event_id")).alias("event_id"), "user_id")
    )
    target = schema(column("event_id", LONG), column("user_id", LONG))
    routed = route(event_messages(spark, sf_dir, value=value), single_table_per_topic=True)
    return ingest_counts(require_key(project_json(routed, target), ["event_id"]))


def stream_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same counts from the progress of a running stream, one row per table and batch."""
    events = table(spark, sf_dir, "events")
    stream = spark.readStream.schema(events.schema).option("pathGlobFilter", "events.parquet").parquet(sf_dir)
    value = F.to_json(F.struct(F.when(F.col("value") > 5, F.col("event_id")).alias("event_id"), "user_id"))
    target = schema(column("event_id", LONG), column("user_id", LONG))
    messages = to_envelope(
        stream, topic=F.concat(F.lit("app.events."), F.col("event_type")), value=value, offset=F.col("event_id"), timestamp=F.col("ts")
    )
    routed = require_key(project_json(route(messages, single_table_per_topic=True), target), ["event_id"])
    listed = [f"app_events_{kind}" for kind in ("click", "error", "purchase", "signup", "view")]
    listener = StreamCounts()
    spark.streams.addListener(listener)
    try:
        writer = observe_counts(routed, listed).writeStream.format("noop").option("checkpointLocation", scratch_path(spark, "checkpoint"))
        query = writer.trigger(availableNow=True).start()
        query.awaitTermination()
        listener.wait(query)
    finally:
        spark.streams.removeListener(listener)
    return listener.frame(spark).groupBy("dest_table").agg(F.sum("accepted").alias("accepted"), F.sum("refused").alias("refused"))


QUERIES: dict[str, Query] = {
    "q01_route_topic": route_topic,
    "q01w_create_write": create_write,
    "q02_route_schema": route_schema,
    "q03_route_override": route_override,
    "q04_decode_json": decode_json,
    "q04b_decode_envelope": decode_envelope,
    "q04c_decode_texts": decode_texts,
    "q05_cdc_unwrap": cdc_unwrap,
    "q06_infer_first": infer_first,
    "q06a_infer_all": infer_all,
    "q06b_conform_message": conform_message,
    "q06c_conform_avro": conform_avro,
    "q07_evolve_add": evolve_add,
    "q07b_evolve_one_batch": evolve_one_batch,
    "q08_evolve_relax": evolve_relax,
    "q09_evolve_ignore": evolve_ignore,
    "q10_field_map": field_map,
    "q10r_field_report": field_report,
    "q11_narrow_numbers": narrow_numbers,
    "q11j_narrow_json_numbers": narrow_json_numbers,
    "q11b_number_text": number_text,
    "q12_parse_ts": parse_ts,
    "q12b_datetime_text": datetime_text,
    "q13_booleans": booleans,
    "q13b_bytes": bytes_column,
    "q14_quarantine": quarantine,
    "q14w_quarantine_table": quarantine_table,
    "q15_upsert_latest": upsert_latest,
    "q16_first_wins": first_wins,
    "q17_append": append,
    "q18_upsert_into": upsert_into,
    "q18b_insert_absent": insert_absent,
    "q19_change_feed": feed,
    "q19s_feed_stream": feed_stream,
    "q19c_feed_compacted": feed_compacted,
    "q20_fan_in": fan_in_feeds,
    "q20s_fan_in_stream": fan_in_stream,
    "q21_fan_out": fan_out,
    "q22_version_gate": gate,
    "q23_wire_header": wire,
    "q23j_registry_ingest": registry_ingest,
    "q24_width_class": width_class,
    "q25_stream_upsert": stream_upsert,
    "q26_subscribe_regex": subscribe_regex,
    "q27_ingest_counts": counts,
    "q27s_stream_counts": stream_counts,
}
