"""Value conversion between message fields and table columns.

Every rule is a pair of column expressions, the converted value and the reason it was refused
(null when it was not), so conversion stays inside generated code and a bad value never raises.

Numbers narrow the way the JVM's number classes do: long to int keeps the low 32 bits, a
floating value saturates at the bounds of the target and NaN becomes zero.  Spark's own ANSI
casts raise on all of these, hence the spelled-out expressions.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, functions as F, types as T

from .types import properties

TYPE_MISMATCH = "TYPE_MISMATCH"
BAD_TIMESTAMP = "BAD_TIMESTAMP"
NULL_REQUIRED = "NULL_REQUIRED"

# Pattern of text timestamps and the range they are clamped to, in epoch milliseconds.
TIMESTAMP_READ = "yyyy-MM-dd HH:mm:ss[.SSSSSSSSS]"
TIMESTAMP_WRITE = "yyyy-MM-dd HH:mm:ss.SSS"
MIN_TIMESTAMP_MS = -30610224000000
MAX_TIMESTAMP_MS = 29379542399999

_INT_MIN, _INT_MAX = -(2**31), 2**31 - 1
_LONG_MIN, _LONG_MAX = -(2**63), 2**63 - 1

_WHOLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
_FRACTION = (T.FloatType, T.DoubleType)


class Converted(NamedTuple):
    value: Column
    reason: Column


def _none(dtype: T.DataType | str = "string") -> Column:
    return F.lit(None).cast(dtype)


def _refuse(value: Column, dtype: T.DataType, reason: str) -> Converted:
    return Converted(_none(dtype), F.when(value.isNotNull(), F.lit(reason)))


def whole_to_int(value: Column) -> Column:
    """Low 32 bits of a whole number, read as a signed int."""
    low = value.cast("bigint").bitwiseAND(F.lit(2**32 - 1))
    return (low.bitwiseXOR(F.lit(2**31)) - F.lit(2**31)).cast("int")


def fraction_to_int(value: Column) -> Column:
    """A floating value cut to an int: saturated at the bounds, NaN to zero."""
    x = F.nanvl(value.cast("double"), F.lit(0.0))
    return (
        F.when(x >= _INT_MAX, F.lit(_INT_MAX)).when(x <= _INT_MIN, F.lit(_INT_MIN)).otherwise(x.cast("int"))
    )


def fraction_to_long(value: Column) -> Column:
    """A floating value cut to a long: saturated at the bounds, NaN to zero."""
    x = F.nanvl(value.cast("double"), F.lit(0.0))
    bound = F.when(x > 0, F.lit(_LONG_MAX)).when(x < 0, F.lit(_LONG_MIN))
    return F.coalesce(x.try_cast("bigint"), bound)


def clamp_ms(ms: Column) -> Column:
    clamped = F.least(F.greatest(ms, F.lit(MIN_TIMESTAMP_MS)), F.lit(MAX_TIMESTAMP_MS))
    return F.when(ms.isNotNull(), clamped)


def text_to_ms(value: Column) -> Converted:
    """Text timestamp, in UTC, to clamped epoch milliseconds; a fraction of up to nine digits is a fraction."""
    at = F.try_to_timestamp(F.concat(value, F.lit("+00:00")), F.lit(TIMESTAMP_READ + "XXX"))
    ms = clamp_ms(F.unix_millis(at))
    return Converted(ms, F.when(value.isNotNull() & ms.isNull(), F.lit(BAD_TIMESTAMP)))


def ms_to_text(ms: Column) -> Column:
    """Epoch milliseconds as text in UTC, whatever the session's zone."""
    return F.date_format(F.to_utc_timestamp(F.timestamp_millis(ms), F.current_timezone()), TIMESTAMP_WRITE)


def _number(value: Column, whole: bool, field: T.StructField) -> Converted:
    target = field.dataType
    as_long = value.cast("bigint") if whole else fraction_to_long(value)
    if isinstance(target, T.StringType):
        out = ms_to_text(as_long) if "datetime" in properties(field) else value.cast("string")
    elif isinstance(target, T.LongType):
        out = as_long
    elif isinstance(target, T.IntegerType):
        out = whole_to_int(value) if whole else fraction_to_int(value)
    elif isinstance(target, _FRACTION):
        out = value.cast(target)
    else:
        return _refuse(value, target, TYPE_MISMATCH)
    return Converted(out, _none())


def _boolean(value: Column, field: T.StructField) -> Converted:
    target = field.dataType
    if isinstance(target, T.StringType):
        return Converted(value.cast("string"), _none())
    if isinstance(target, T.BinaryType):
        return _refuse(value, target, TYPE_MISMATCH)
    return Converted(value.cast("int").cast(target), _none())


def _text(value: Column, field: T.StructField) -> Converted:
    if isinstance(field.dataType, T.StringType):
        return Converted(value, _none())
    if "timestamp" in properties(field):
        ms, reason = text_to_ms(value)
        return Converted(ms.cast(field.dataType), reason)
    return _refuse(value, field.dataType, TYPE_MISMATCH)


def convert(value: Column, source: T.DataType, field: T.StructField) -> Converted:
    """Convert a column of a known type to a table column; the rule is picked at plan time."""
    if isinstance(source, T.NullType):
        return Converted(_none(field.dataType), _none())
    if isinstance(source, T.StringType):
        return _text(value, field)
    if source == field.dataType:
        return Converted(value, _none())
    if isinstance(source, _WHOLE):
        return _number(value, True, field)
    if isinstance(source, (*_FRACTION, T.DecimalType)):
        number = value.cast("double") if isinstance(source, T.DecimalType) else value
        return _number(number, False, field)
    if isinstance(source, T.BooleanType):
        return _boolean(value, field)
    if isinstance(source, (T.TimestampType, T.TimestampNTZType)) and isinstance(field.dataType, T.LongType):
        return Converted(F.unix_millis(value.cast("timestamp")), _none())
    return _refuse(value, field.dataType, TYPE_MISMATCH)


def json_tag(value: Column) -> Column:
    """Type tag of a variant.  A number is BIGINT without fraction or exponent, else DOUBLE or DECIMAL."""
    return F.schema_of_variant(value)


def json_fraction(value: Column, tag: Column, field: T.StructField) -> Column | None:
    """Reading of a value the field's rules need several times, to be kept as a column of its own."""
    if isinstance(field.dataType, (T.LongType, T.IntegerType)):
        return F.when(~tag.isin("BIGINT", "STRING"), F.try_variant_get(value, "$", "double"))
    if isinstance(field.dataType, T.StringType) and "datetime" in properties(field):
        return F.when(~tag.isin("STRING", "BOOLEAN"), F.try_variant_get(value, "$", "double"))
    return None


def convert_json(value: Column, tag: Column, fraction: Column | None, field: T.StructField) -> Column:
    """Convert a JSON value whose type differs from row to row.

    A value that is there and comes out null was refused.  Booleans read as the numbers one and zero.
    """
    target = field.dataType
    text = F.try_variant_get(value, "$", "string")
    double = F.try_variant_get(value, "$", "double")
    whole = F.when(tag == "BIGINT", F.try_variant_get(value, "$", "bigint"))
    if isinstance(target, T.LongType):
        out = F.coalesce(whole, fraction_to_long(fraction))
        if "timestamp" in properties(field):
            out = F.when(tag == "STRING", text_to_ms(text).value).otherwise(out)
    elif isinstance(target, T.IntegerType):
        out = F.coalesce(whole_to_int(whole), fraction_to_int(fraction))
    elif isinstance(target, _FRACTION):
        out = F.when(tag != "STRING", double).cast(target)
    elif isinstance(target, T.StringType) and fraction is not None:
        ms = F.coalesce(whole, fraction_to_long(fraction))
        out = F.when(tag.isin("STRING", "BOOLEAN"), text).otherwise(ms_to_text(ms))
    elif isinstance(target, T.StringType):
        out = F.when(tag.isin("STRING", "BIGINT", "BOOLEAN"), text).otherwise(double.cast("string"))
    else:
        out = _none(target)
    return out
