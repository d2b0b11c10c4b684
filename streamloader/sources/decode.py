"""Decoders that find a message's schema: JSON with its schema inside, and registry wire bytes."""

from __future__ import annotations

import json
from collections.abc import Callable, Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F, types as T

from ..functions.once import compute_once
from ..functions.types import MESSAGE_TYPES, UnsupportedSchema, check_names, column, is_flat, message_type

# Magic byte and header length of registry-framed messages.
WIRE_MAGIC = 0
WIRE_HEADER_BYTES = 5

NO_SCHEMA = "NO_SCHEMA"
BAD_WIRE_HEADER = "BAD_WIRE_HEADER"
UNKNOWN_SCHEMA = "UNKNOWN_SCHEMA"
BAD_PAYLOAD = "BAD_PAYLOAD"
UNSUPPORTED_RECORD = "UNSUPPORTED_RECORD"

_CORRUPT = "_corrupt_text"

# Message types a table refuses, read as the Spark type that shows why.
_REFUSED_TYPES: dict[str, T.DataType] = {
    "int8": T.ByteType(),
    "int16": T.ShortType(),
    "boolean": T.BooleanType(),
}


def decode_schema_json(df: DataFrame, value: str = "value") -> DataFrame:
    """Open `{"schema": .., "payload": ..}` messages.

    `value` becomes the payload text; `schema_name`, `schema_version` and `message_schema` (the
    schema's fields as JSON text) come from the message.  One parse serves all four.
    """
    shape = "schema struct<name: string, version: int, fields: string>, payload string"
    opened = compute_once(df, "_outer", F.from_json(F.col(value), shape))
    head = F.col("_outer.schema")
    # A schema without fields is that of a bare value, which no table takes.
    reason = F.when(head.isNull(), F.lit(NO_SCHEMA)).when(head["fields"].isNull(), F.lit(UNSUPPORTED_RECORD))
    if "reason" in df.columns:
        reason = F.coalesce(F.col("reason"), reason)
    return opened.withColumns(
        {
            "schema_name": head["name"],
            "schema_version": head["version"],
            "message_schema": F.concat(F.lit('{"type":"struct","fields":'), head["fields"], F.lit("}")),
            "reason": reason,
            value: F.col("_outer.payload"),
        }
    ).drop("_outer")


def schema_from_message(text: str) -> T.StructType:
    """Columns of a message schema, in declared order, unsupported types included as they are."""
    doc = json.loads(text)
    fields = []
    for item in doc.get("fields", ()):
        kind = item.get("type")
        dtype = MESSAGE_TYPES.get(kind) or _REFUSED_TYPES.get(kind) or T.ArrayType(T.StringType())
        default = item.get("default")
        fields.append(
            column(
                item["field"],
                dtype,
                bool(item.get("optional", False)),
                default=default if isinstance(default, str) else None,
            )
        )
    schema = T.StructType(fields)
    check_names(schema)
    return schema


def schema_shape(text: str | Column) -> Column:
    """What a payload's decoding depends on: names and types of a message schema's fields, as the text of a schema.

    Many schema texts share a shape, as documentation, defaults and versions are no part of it.
    """
    fields = F.from_json(text, "fields array<struct<field: string, type: string>>")["fields"]
    return F.to_json(F.struct(fields.alias("fields")))


def decode_payload(df: DataFrame, schema: T.StructType, value: str = "value") -> DataFrame:
    """Parse payload texts by their declared columns into a struct `payload`.

    A payload that does not fit its own schema is refused.
    """
    fields = [T.StructField(f.name, f.dataType) for f in schema.fields]
    declared = T.StructType([*fields, T.StructField(_CORRUPT, T.StringType())])
    parsed = F.from_json(F.col(value), declared, {"columnNameOfCorruptRecord": _CORRUPT})
    out = compute_once(df, "payload", parsed)
    reason = F.when(F.col("payload")[_CORRUPT].isNotNull(), F.lit(BAD_PAYLOAD))
    if "reason" in df.columns:
        reason = F.coalesce(F.col("reason"), reason)
    return out.withColumn("reason", reason)


def message_schema(schema: T.StructType, name: str, version: int) -> str:
    """The message schema of a table as JSON text."""
    fields = [
        {"field": f.name, "type": message_type(f.dataType), "optional": f.nullable}
        for f in schema.fields
    ]
    return json.dumps({"type": "struct", "name": name, "version": version, "fields": fields})


def refused_columns(schema: T.StructType) -> list[str]:
    return [f.name for f in schema.fields if not is_flat(f.dataType)]


def wire_header(df: DataFrame, value: str = "value_bytes") -> DataFrame:
    """Split registry framing (one magic byte, a four-byte id, the body) into `schema_id`, `payload`."""
    body = F.col(value)
    framed = (F.octet_length(body) >= WIRE_HEADER_BYTES) & (
        F.hex(F.substring(body, 1, 1)) == f"{WIRE_MAGIC:02X}"
    )
    schema_id = F.conv(F.hex(F.substring(body, 2, 4)), 16, 10).cast("bigint")
    reason = F.when(body.isNotNull() & framed, F.lit(None)).otherwise(F.lit(BAD_WIRE_HEADER))
    if "reason" in df.columns:
        reason = F.coalesce(F.col("reason"), reason)
    return df.withColumns(
        {
            "schema_id": F.when(framed, schema_id),
            "payload": F.when(framed, F.expr(f"substring(`{value}`, {WIRE_HEADER_BYTES + 1})")),
            "reason": reason,
        }
    )


@dataclass(frozen=True)
class RegisteredSchema:
    """A schema of a registry: the record's name and version, its columns, and how its bytes are read.

    `decode` turns the body (bytes) into a struct of the columns, null where it cannot be read.
    """

    name: str
    version: int
    columns: T.StructType
    decode: Callable[[Column], Column]


def json_body(columns: T.StructType) -> Callable[[Column], Column]:
    """Bodies that are JSON texts; one that does not fit the columns is null."""
    fields = [T.StructField(f.name, f.dataType) for f in columns.fields]
    shape = T.StructType([*fields, T.StructField(_CORRUPT, T.StringType())])
    options = {"columnNameOfCorruptRecord": _CORRUPT}

    def decode(body: Column) -> Column:
        parsed = F.array(F.from_json(F.decode(body, "UTF-8"), shape, options))
        return F.get(F.filter(parsed, lambda record: record[_CORRUPT].isNull()), F.lit(0))

    return decode


def avro_body(schema: str) -> Callable[[Column], Column]:
    """Bodies in Avro's binary form; needs Spark's Avro package on the classpath."""
    if json.loads(schema).get("type") != "record":
        raise UnsupportedSchema("the top level of an Avro schema must be a record")

    def decode(body: Column) -> Column:
        from pyspark.sql.avro.functions import from_avro

        return from_avro(body, schema, {"mode": "PERMISSIVE"})

    return decode


def open_registry(df: DataFrame, registry: Mapping[int, RegisteredSchema], value: str = "value_bytes") -> DataFrame:
    """Split framed messages and name their schema: `schema_id`, `payload`, `schema_name`, `schema_version`.

    Messages with a bad header or an id that the registry lacks get a reason; their bytes are kept as base64
    text in `value`, as are all others'.
    """
    out = wire_header(df, value)

    def known(part: str) -> Column:
        pairs = [x for key, s in registry.items() for x in (F.lit(key).cast("bigint"), F.lit(getattr(s, part)))]
        return F.create_map(*pairs)[F.col("schema_id")] if pairs else F.lit(None)

    listed = F.col("schema_id").isin([int(k) for k in registry])
    return out.withColumns(
        {
            "schema_name": known("name").cast("string"),
            "schema_version": known("version").cast("int"),
            "value": F.base64(F.col(value)),
            "reason": F.coalesce("reason", F.when(~listed, F.lit(UNKNOWN_SCHEMA))),
        }
    ).drop(value)


def decode_registered(df: DataFrame, schema: RegisteredSchema) -> DataFrame:
    """Read opened bodies of one schema into `body`; those that cannot be read are refused."""
    out = compute_once(df, "body", schema.decode(F.col("payload")))
    reason = F.when(F.col("body").isNull(), F.lit(BAD_PAYLOAD))
    return out.withColumn("reason", F.coalesce("reason", reason)).drop("payload")
