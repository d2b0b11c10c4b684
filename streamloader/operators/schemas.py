"""Table schemas derived from data: first records, typed frames, text widths."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from ..functions.types import UnsupportedSchema, check_names, column, is_flat, width_word
from ..sources.messages import ARRIVAL
from .merge import one_per_key

UNSUPPORTED_TYPE = "UNSUPPORTED_TYPE"
# Columns that merged records may give a table, unless told otherwise.
MAX_COLUMNS = 1000


def first_rows(
    df: DataFrame, keys: Sequence[str], order: Sequence[str] = ARRIVAL, columns: Sequence[str] = ()
) -> DataFrame:
    """The first row of each group, for a few large groups such as destination tables.

    Ranking alone would sort every row by its group.  So the earliest value of the leading order
    column is taken first, by a hash aggregate over fixed-width buffers, and only the rows holding it
    are ranked.  Spark broadcasts the list of groups when its measured size allows, and otherwise splits
    groups that are large.  Null keys form groups, and null order values come first.
    """
    lead = order[0]
    low = df.groupBy(*keys).agg(F.min(lead).alias("__low"), F.max(F.col(lead).isNull()).alias("__null"))
    low = low.select(
        *[F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)],
        F.when(~F.col("__null"), F.col("__low")).alias("__low"),
    )
    match = F.col("__low").eqNullSafe(F.col(lead))
    for i, key in enumerate(keys):
        match = match & F.col(f"__k{i}").eqNullSafe(F.col(key))
    earliest = df.join(low, match, "left_semi")
    return one_per_key(earliest, keys, order, "first").select(*keys, *columns)


def column_type(tag: Column) -> Column:
    """Flat column type of a JSON value's type tag; null for null values."""
    return (
        F.when(tag == "BIGINT", F.lit("bigint"))
        .when(tag.startswith("DECIMAL") | (tag == "DOUBLE") | (tag == "FLOAT"), F.lit("double"))
        .when(tag == "STRING", F.lit("string"))
        .when(tag.isNull() | (tag == "VOID"), F.lit(None).cast("string"))
        .otherwise(F.lit(UNSUPPORTED_TYPE))
    )


def infer_schemas(
    df: DataFrame,
    infer: str = "first_record",
    order: Sequence[str] = ARRIVAL,
    value: str = "value",
    max_columns: int | None = MAX_COLUMNS,
) -> DataFrame:
    """Columns of each destination table: (dest_table, position, column, type).

    `first_record` reads one message per table: one column per non-null field, in message order.
    `all` reads every message and merges the types; reading the result fails where a table would have more than
    `max_columns`.  Nested and boolean fields come out as UNSUPPORTED_TYPE.
    """
    if infer == "all":
        return _merged_fields(df, value, max_columns)
    if infer != "first_record":
        raise ValueError(f"infer is 'first_record' or 'all', not {infer!r}")
    rows = first_rows(df, ["dest_table"], order, [value]).select(
        "dest_table", F.json_object_keys(value).alias("_keys"), F.try_parse_json(value).alias("_v")
    )
    fields = rows.lateralJoin(df.sparkSession.tvf.variant_explode(F.col("_v").outer()))
    typed = fields.select(
        "dest_table",
        F.array_position("_keys", F.col("key")).alias("_place"),
        F.col("key").alias("column"),
        column_type(F.schema_of_variant(F.col("value"))).alias("type"),
    ).where(F.col("type").isNotNull())
    # The fields of one record are few; numbering them closes the gaps that nulls leave.
    place = F.row_number().over(Window.partitionBy("dest_table").orderBy("_place"))
    return typed.select("dest_table", place.alias("position"), "column", "type")


# Kinds of values a column has had, as bits: their union is the column's place in the lattice of types.
_LONG, _DOUBLE, _STRING, _OTHER = 1, 2, 4, 8


def _merged_fields(df: DataFrame, value: str, max_columns: int | None) -> DataFrame:
    """Fields of all records in name order, with the least type that holds all their values.

    Each record's fields meet by (table, column) as bits, which tasks join before they are shuffled; nothing reaches the driver.
    A table of records that are not objects has one column that no table takes.
    """
    parsed = df.select("dest_table", F.col(value).alias("_text"), F.try_parse_json(value).alias("_v")).where(F.col("_v").isNotNull())
    kind = F.schema_of_variant("_v")
    objects = parsed.where(F.json_object_keys("_text").isNotNull())
    fields = objects.lateralJoin(df.sparkSession.tvf.variant_explode(F.col("_v").outer()))
    name = column_type(F.schema_of_variant(F.col("value")))
    bit = (
        F.when(name == "bigint", _LONG).when(name == "double", _DOUBLE).when(name == "string", _STRING)
        .when(name.isNotNull(), _OTHER).otherwise(0)
    )
    seen = fields.where(F.col("key").isNotNull()).select("dest_table", F.col("key").alias("column"), bit.alias("bit"))
    bare = parsed.where(F.json_object_keys("_text").isNull() & (kind != "VOID")).select(
        "dest_table", F.lit("value").alias("column"), F.lit(_OTHER << 1).alias("bit")
    )
    met = seen.unionByName(bare).groupBy("dest_table", "column").agg(F.bit_or("bit").alias("bits")).where("bits > 0")
    table = Window.partitionBy("dest_table")
    # One row for each column of the table.
    counted = met.withColumns({"_n": F.count(F.lit(1)).over(table), "_bare": F.max("bits").over(table) >= _OTHER << 1})
    if max_columns is not None:
        message = F.concat(F.lit("table "), "dest_table", F.lit(" would have "), F.col("_n").cast("string"), F.lit(f" columns, more than {max_columns}"))
        counted = counted.where(F.when(F.col("_n") <= max_columns, F.lit(True)).otherwise(F.raise_error(message).cast("boolean")))
    bits = F.col("bits")
    kept = counted.where(~F.col("_bare") | (bits >= _OTHER << 1)).select(
        "dest_table",
        F.when(F.col("_bare"), F.lit("value")).otherwise(F.col("column")).alias("column"),
        F.when(bits == _LONG, F.lit("bigint")).when(bits <= _LONG | _DOUBLE, F.lit("double")).when(bits == _STRING, F.lit("string"))
        .otherwise(F.lit(UNSUPPORTED_TYPE)).alias("type"),
    )
    place = F.row_number().over(table.orderBy("column"))
    return kept.select("dest_table", place.alias("position"), "column", "type")


def schema_of_columns(rows: Sequence[tuple[int, str, str]]) -> T.StructType:
    """Table schema of inferred columns, all nullable; a bad type refuses the whole record."""
    fields = []
    for _, name, kind in sorted(rows):
        if kind == UNSUPPORTED_TYPE:
            raise UnsupportedSchema(f"field {name!r} is nested or boolean")
        fields.append(column(name, T.DataType.fromDDL(kind)))
    schema = T.StructType(fields)
    check_names(schema)
    return schema


def _is_union(dtype: T.DataType) -> bool:
    """Avro unions of several types are read as structs of member0, member1, .."""
    return isinstance(dtype, T.StructType) and dtype.names == [f"member{i}" for i in range(len(dtype))]


def conform(df: DataFrame, rules: str = "message", strict: bool = False) -> tuple[DataFrame, list[str]]:
    """Limit a typed frame to the flat column types; returns it with the names left out.

    `message` keeps the six flat types as they are.  `avro` also turns booleans into the texts true
    and false, and drops unions of several types even when strict.  Strict refuses any other column.
    """
    if rules not in ("message", "avro"):
        raise ValueError(f"rules is 'message' or 'avro', not {rules!r}")
    kept, left_out, refused = [], [], []
    for f in df.schema.fields:
        source = F.col(f"`{f.name}`")
        if is_flat(f.dataType):
            kept.append(source)
        elif rules == "avro" and isinstance(f.dataType, T.BooleanType):
            kept.append(source.cast("string").alias(f.name, metadata={"properties": ["dict", "char8"]}))
        else:
            left_out.append(f.name)
            if not (rules == "avro" and _is_union(f.dataType)):
                refused.append(f.name)
    if strict and refused:
        raise UnsupportedSchema("unsupported types for fields: " + ", ".join(refused))
    if not kept:
        raise UnsupportedSchema("schema has no fields")
    return df.select(*kept), left_out


def width_classes(df: DataFrame) -> DataFrame:
    """Longest value and width class of every text column: (column, max_length, width).

    One pass and one aggregate whatever the number of columns.
    """
    names = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    longest = df.agg(*[F.max(F.length(f"`{c}`")).alias(c) for c in names])
    pairs = F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"`{c}`").alias("max_length")) for c in names])
    rows = longest.select(F.inline(pairs))
    width = F.lit("string")
    for size in (256, 128, 64, 32, 16, 8, 4, 2, 1):
        width = F.when(F.col("max_length") <= size, F.lit(width_word(size))).otherwise(width)
    width = F.when(F.coalesce(F.col("max_length"), F.lit(0)) > 0, width).otherwise(F.lit("string"))
    return rows.withColumn("width", width)
