"""The flat type system of destination tables and the text attributes of their columns.

A column is one of six flat types.  Everything else a column can carry (a width class, a
`timestamp` or `datetime` reading, a primary-key mark) is a list of words kept in the
`properties` entry of the field's metadata, so a plain `StructType` describes a table in full.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import types as T

# The flat column types and their names in message schemas.
MESSAGE_TYPES: dict[str, T.DataType] = {
    "bytes": T.BinaryType(),
    "double": T.DoubleType(),
    "float": T.FloatType(),
    "int32": T.IntegerType(),
    "int64": T.LongType(),
    "string": T.StringType(),
}

FLAT_TYPES: tuple[type[T.DataType], ...] = tuple(type(t) for t in MESSAGE_TYPES.values())

_MESSAGE_NAMES = {type(t): name for name, t in MESSAGE_TYPES.items()}

DEFAULT_KEYS = ("EXISTS_DEFAULT", "CURRENT_DEFAULT")


class UnsupportedSchema(ValueError):
    """A schema has no columns, or columns that a flat table cannot hold."""


def is_flat(dtype: T.DataType) -> bool:
    return isinstance(dtype, FLAT_TYPES)


def message_type(dtype: T.DataType) -> str:
    """Name of a flat type in a message schema."""
    if not is_flat(dtype):
        raise UnsupportedSchema(f"no message type for {dtype.simpleString()}")
    return _MESSAGE_NAMES[type(dtype)]


def properties(field: T.StructField) -> frozenset[str]:
    return frozenset((field.metadata or {}).get("properties", ()))


def column(
    name: str,
    dtype: T.DataType,
    nullable: bool = True,
    props: Iterable[str] = (),
    default: str | None = None,
) -> T.StructField:
    """A table column.  A text default is what rows written before the column existed read as."""
    metadata: dict = {}
    if props:
        metadata["properties"] = list(props)
    if default is not None:
        literal = "'" + default.replace("\\", "\\\\").replace("'", "\\'") + "'"
        metadata.update({key: literal for key in DEFAULT_KEYS}, default=default)
    return T.StructField(name, dtype, nullable, metadata or None)


def relaxed(field: T.StructField) -> T.StructField:
    """The same column without its not-null rule."""
    return T.StructField(field.name, field.dataType, True, field.metadata)


def check_names(schema: T.StructType) -> None:
    """Message field names are case-sensitive, Spark's are not: refuse names differing only in case."""
    if not schema.fields:
        raise UnsupportedSchema("schema has no fields")
    seen: dict[str, str] = {}
    for name in schema.names:
        other = seen.setdefault(name.lower(), name)
        if other != name:
            raise UnsupportedSchema(f"columns {other!r} and {name!r} differ only in case")
    if len(set(schema.names)) != len(schema.names):
        raise UnsupportedSchema("duplicate column names")


def check_flat(schema: T.StructType) -> T.StructType:
    check_names(schema)
    bad = [f"{f.name} {f.dataType.simpleString()}" for f in schema.fields if not is_flat(f.dataType)]
    if bad:
        raise UnsupportedSchema("unsupported column types: " + ", ".join(bad))
    return schema


def width_word(length: int) -> str:
    """Width class of a text column: the next power of two up to 256, beyond it unbounded."""
    if not 0 < length <= 256:
        return "string"
    return f"char{1 << (length - 1).bit_length()}"
