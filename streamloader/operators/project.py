"""Projection of message fields onto table columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from ..functions.convert import (
    BAD_TIMESTAMP,
    NULL_REQUIRED,
    TYPE_MISMATCH,
    Converted,
    convert,
    convert_json,
    json_fraction,
    json_tag,
)
from ..functions.once import compute_once
from ..functions.types import check_names, properties
from ..sources.decode import UNSUPPORTED_RECORD

BAD_JSON = "BAD_JSON"

RESULT_COLUMNS = ("record", "reason", "bad_column", "bad_value")

_CORRUPT = "_corrupt_text"
# Start of a text whose root is an object.
_OBJECT = r"^[ \t\r\n]*[{]"
_JSON_OPTIONS = {"columnNameOfCorruptRecord": _CORRUPT, "allowSingleQuotes": "false"}


def _required(converted: Converted, field: T.StructField) -> Converted:
    """A null in a required column is refused, whether it was sent or absent."""
    if field.nullable:
        return converted
    missing = F.when(converted.value.isNull(), F.lit(NULL_REQUIRED))
    return Converted(converted.value, F.coalesce(converted.reason, missing))


def _result(
    df: DataFrame,
    names: list[str],
    outcome: list[Converted],
    texts: list[Column],
    record_reason: Column,
    kept: list[str],
) -> DataFrame:
    """Add `record`, `reason`, `bad_column` and `bad_value`; the first refused column is reported."""
    refusals = [
        F.when(
            c.reason.isNotNull(),
            F.struct(c.reason.alias("why"), F.lit(name).alias("column"), text.alias("value")),
        )
        for name, c, text in zip(names, outcome, texts)
    ]
    earlier = F.col("reason") if "reason" in df.columns else F.lit(None).cast("string")
    checked = df.withColumn("__first", F.coalesce(earlier, record_reason)).withColumn(
        "__bad", F.when(F.col("__first").isNull(), F.coalesce(*refusals))
    )
    result = F.struct(
        F.struct(*[c.value.alias(name) for name, c in zip(names, outcome)]).alias("record"),
        F.coalesce(F.col("__first"), F.col("__bad.why")).alias("reason"),
        F.col("__bad.column").alias("bad_column"),
        F.col("__bad.value").alias("bad_value"),
    )
    out = compute_once(checked, "__result", result)
    return out.select(*[F.col(f"`{c}`") for c in kept if c not in RESULT_COLUMNS], "__result.*")


def project(df: DataFrame, schema: T.StructType, source: str | None = None) -> DataFrame:
    """Project typed fields onto the table.

    Fields are the columns of `df`, or those of its struct column `source`.  Rules are chosen per
    column at plan time, so a field of the column's own type costs nothing.  Fields the table lacks
    are dropped, and columns the message lacks have their text default or are null.
    """
    check_names(schema)
    fields = df.schema if source is None else df.schema[source].dataType
    types = {f.name: f.dataType for f in fields.fields}

    def field_of(name: str) -> Column:
        return F.col(f"`{name}`") if source is None else F.col(source)[name]

    staged, outcome, texts = {}, [], []
    for i, f in enumerate(schema.fields):
        known = f.name in types
        default = None if known else (f.metadata or {}).get("default")
        value = field_of(f.name) if known else F.lit(default)
        kind = types[f.name] if known else T.NullType() if default is None else T.StringType()
        converted = convert(value, kind, f)
        staged[f"__value{i}"] = converted.value
        outcome.append(_required(Converted(F.col(f"__value{i}"), converted.reason), f))
        texts.append(value.cast("string"))
    record_reason = F.lit(None).cast("string")
    if source is not None:
        record_reason = F.when(F.col(source).isNull(), F.lit(UNSUPPORTED_RECORD))
    ready = df.withColumns(staged)
    return _result(ready, schema.names, outcome, texts, record_reason, df.columns)


def _fast_type(field: T.StructField) -> T.DataType:
    """Type a column is parsed as: that of JSON numbers, or text where the text decides the rule."""
    if "timestamp" in properties(field) or isinstance(field.dataType, T.BinaryType):
        return T.StringType()
    if isinstance(field.dataType, (T.IntegerType, T.FloatType)):
        return T.DoubleType()
    return field.dataType


def _doubt(value: Column, field: T.StructField) -> Column | None:
    """Whether a value that parsed may still have been another JSON type.

    Tokens only parse as long columns when they are whole numbers.  Text columns also accept other
    tokens: numbers and booleans come out as the text they convert to, but nested values must be
    refused and whole numbers beyond a long are doubles.  Floating columns accept quoted NaN and
    infinities.  Int columns are parsed as doubles too: in the range of an int it makes no difference
    how a number was written, beyond it whole numbers wrap and others saturate.
    """
    if isinstance(field.dataType, T.BinaryType):
        return value.isNotNull()
    if isinstance(field.dataType, T.IntegerType):
        return F.isnan(value) | (F.abs(value) >= F.lit(float(2**31)))
    if isinstance(field.dataType, (T.FloatType, T.DoubleType)):
        return F.isnan(value) | (F.abs(value) == F.lit(float("inf")))
    if "timestamp" in properties(field) or "datetime" in properties(field):
        return ~value.rlike(r"^[0-9]+-")
    if isinstance(field.dataType, T.StringType):
        nested = F.substring(value, 1, 1).isin("{", "[", '"')
        return nested | ((F.length(value) > 18) & value.rlike("^-?[0-9]+$"))
    return None


def project_json(
    df: DataFrame, schema: T.StructType, value: str = "value", typed_parse: bool = True
) -> DataFrame:
    """Project the fields of JSON objects onto the table, whatever type each value has.

    JSON carries types per value while a typed parse turns a mismatch into a silent null.  So the
    text is parsed once straight into the column types, and only rows where that parse failed or
    leaves doubt are parsed again, value by value, for the exact rule or reason.  Clean data never
    pays for the exact path.  Where most rows need conversion, `typed_parse=False` goes there at once;
    the results are the same.
    """
    check_names(schema)
    text_of_record = F.col(value)
    fast = T.StructType([T.StructField(f.name, _fast_type(f)) for f in schema.fields])
    exact = T.StructType([T.StructField(f.name, T.VariantType()) for f in schema.fields])
    corrupt = T.StructField(_CORRUPT, T.StringType())

    parsed = F.from_json(text_of_record, T.StructType([*fast.fields, corrupt]), _JSON_OPTIONS)
    doubts = [d for f in schema.fields if (d := _doubt(F.col("__fast")[f.name], f)) is not None]
    in_doubt = F.col("__fast").isNull() | F.col("__fast")[_CORRUPT].isNotNull()
    for doubt in doubts:
        in_doubt = in_doubt | F.coalesce(doubt, F.lit(False))
    if not typed_parse:
        in_doubt = F.lit(True)
    reparsed = F.from_json(text_of_record, T.StructType([*exact.fields, corrupt]), _JSON_OPTIONS)
    again = F.col("__doubt")

    # Each step names earlier columns only, so nothing is computed twice and no step grows large.
    staged = (
        df.withColumn("__fast", parsed)
        .withColumn("__doubt", in_doubt)
        .withColumn("__exact", F.when(again, reparsed))
    )
    numbered = list(enumerate(schema.fields))
    values = [F.col("__exact")[f.name] for f in schema.fields]
    tags = [F.col(f"__tag{i}") for i, _ in numbered]
    staged = staged.withColumns({f"__tag{i}": F.when(again, json_tag(values[i])) for i, _ in numbered})
    fractions = {i: c for i, f in numbered if (c := json_fraction(values[i], tags[i], f)) is not None}
    staged = staged.withColumns({f"__fraction{i}": F.when(again, c) for i, c in fractions.items()})
    final, outcome, texts = {}, [], []
    for i, f in numbered:
        sure = convert(F.col("__fast")[f.name], _fast_type(f), f)
        fraction = F.col(f"__fraction{i}") if i in fractions else None
        slow = convert_json(values[i], tags[i], fraction, f)
        final[f"__value{i}"] = F.when(again, slow).otherwise(sure.value)
        value = F.col(f"__value{i}")
        # Either way a value that is there and came out null was refused.
        there = F.when(again, tags[i].isNotNull() & (tags[i] != "VOID"))
        if "timestamp" in properties(f):
            there = there.otherwise(F.col("__fast")[f.name].isNotNull())
        why = F.lit(TYPE_MISMATCH)
        if "timestamp" in properties(f):
            text_seen = ~again | (tags[i] == "STRING")
            why = F.when(text_seen, F.lit(BAD_TIMESTAMP)).otherwise(why)
        outcome.append(_required(Converted(value, F.when(value.isNull() & there, why)), f))
        text = F.when(again, F.try_variant_get(values[i], "$", "string"))
        texts.append(text.otherwise(F.col("__fast")[f.name].cast("string")))
    unreadable = again & (F.col("__exact").isNull() | F.col("__exact")[_CORRUPT].isNotNull())
    # An object that cannot be read is no JSON.  Only other roots are parsed once more: a parse that fails costs most of all.
    is_object = text_of_record.rlike(_OBJECT)
    other_root = text_of_record.isNull() | F.when(~is_object, F.try_parse_json(text_of_record).isNotNull()).otherwise(F.lit(False))
    record_reason = F.when(
        unreadable, F.when(other_root, F.lit(UNSUPPORTED_RECORD)).otherwise(F.lit(BAD_JSON))
    )
    ready = staged.withColumns(final)
    return _result(ready, schema.names, outcome, texts, record_reason, df.columns)


def field_map(spark: SparkSession, table: T.StructType, record: T.StructType) -> DataFrame:
    """Report of how a message version meets a table: mapped, missing or ignored, by exact name."""
    known = {f.name for f in record.fields}
    rows = [(f.name, "mapped" if f.name in known else "missing") for f in table.fields]
    rows += [(name, "ignored") for name in record.names if name not in set(table.names)]
    return spark.createDataFrame(rows, "column string, status string")
