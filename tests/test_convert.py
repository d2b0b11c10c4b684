"""One row per conversion rule, for typed columns and for JSON values."""

from __future__ import annotations

import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F, types as T

from streamloader import column, project, project_json

LONG, INT, DOUBLE, FLOAT = T.LongType(), T.IntegerType(), T.DoubleType(), T.FloatType()
STRING, BINARY, BOOLEAN = T.StringType(), T.BinaryType(), T.BooleanType()


def one(df):
    row = df.select("record", "reason", "bad_column", "bad_value").collect()[0]
    return (row.record["c"] if row.record else None), row.reason


def typed(spark, value, source, target, props=(), nullable=True):
    df = spark.createDataFrame([(value,)], T.StructType([T.StructField("c", source)]))
    return one(project(df, T.StructType([column("c", target, nullable, props)])))


def from_json(spark, text, target, props=(), nullable=True):
    df = spark.createDataFrame([(text,)], "value string")
    return one(project_json(df, T.StructType([column("c", target, nullable, props)])))


TYPED = [
    # null and same type
    (None, LONG, STRING, (), None, None),
    (7, LONG, LONG, (), 7, None),
    ("x", STRING, STRING, (), "x", None),
    (bytearray(b"ab"), BINARY, BINARY, (), bytearray(b"ab"), None),
    # number to text
    (12, LONG, STRING, (), "12", None),
    (1.0e10, DOUBLE, STRING, (), "1.0E10", None),
    (12.0, DOUBLE, STRING, (), "12.0", None),
    # number to long: truncate, saturate, NaN to zero
    (1.9, DOUBLE, LONG, (), 1, None),
    (-1.9, DOUBLE, LONG, (), -1, None),
    (1e300, DOUBLE, LONG, (), 2**63 - 1, None),
    (-1e300, DOUBLE, LONG, (), -(2**63), None),
    (float("nan"), DOUBLE, LONG, (), 0, None),
    (7, INT, LONG, (), 7, None),
    # number to int: longs wrap, floating values saturate
    (2**31, LONG, INT, (), -(2**31), None),
    (2**32 + 5, LONG, INT, (), 5, None),
    (-(2**31) - 1, LONG, INT, (), 2**31 - 1, None),
    (-1, LONG, INT, (), -1, None),
    (3e10, DOUBLE, INT, (), 2**31 - 1, None),
    (-3e10, DOUBLE, INT, (), -(2**31), None),
    (float("nan"), DOUBLE, INT, (), 0, None),
    # number to floating
    (3, INT, DOUBLE, (), 3.0, None),
    (0.5, DOUBLE, FLOAT, (), 0.5, None),
    (1e300, DOUBLE, FLOAT, (), float("inf"), None),
    # number to bytes
    (3, INT, BINARY, (), None, "TYPE_MISMATCH"),
    # number to datetime text
    (1700000000123, LONG, STRING, ("datetime",), "2023-11-14 22:13:20.123", None),
    # text to timestamp
    ("2024-01-02 03:04:05.678", STRING, LONG, ("timestamp",), 1704164645678, None),
    ("2024-01-02 03:04:05", STRING, LONG, ("timestamp",), 1704164645000, None),
    ("2024-01-02 03:04:05.678999111", STRING, LONG, ("timestamp",), 1704164645678, None),
    ("9999-01-01 00:00:00.000", STRING, LONG, ("timestamp",), 29379542399999, None),
    ("0001-01-01 00:00:00.000", STRING, LONG, ("timestamp",), -30610224000000, None),
    ("next week", STRING, LONG, ("timestamp",), None, "BAD_TIMESTAMP"),
    (1700000000123, LONG, LONG, ("timestamp",), 1700000000123, None),
    # boolean
    (True, BOOLEAN, STRING, (), "true", None),
    (False, BOOLEAN, STRING, (), "false", None),
    (True, BOOLEAN, INT, (), 1, None),
    (False, BOOLEAN, LONG, (), 0, None),
    (True, BOOLEAN, DOUBLE, (), 1.0, None),
    (True, BOOLEAN, BINARY, (), None, "TYPE_MISMATCH"),
    # everything else
    ("12", STRING, INT, (), None, "TYPE_MISMATCH"),
    ("x", STRING, BINARY, (), None, "TYPE_MISMATCH"),
    (bytearray(b"ab"), BINARY, STRING, (), None, "TYPE_MISMATCH"),
]


def groups(cases, key):
    found = {}
    for case in cases:
        found.setdefault(key(case), []).append(case)
    return list(found.values())


def outcomes(df):
    """(value, reason) of each row, in the order of `n`."""
    rows = df.select("n", "record", "reason").orderBy("n").collect()
    return [(r.record["c"] if r.record else None, r.reason) for r in rows]


@pytest.mark.parametrize("cases", groups(TYPED, lambda c: (str(c[1]), str(c[2]), c[3])))
def test_typed(spark, cases):
    _, source, target, props, _, _ = cases[0]
    shape = T.StructType([T.StructField("n", INT), T.StructField("c", source)])
    df = spark.createDataFrame([(n, case[0]) for n, case in enumerate(cases)], shape)
    out = project(df, T.StructType([column("c", target, True, props)]))
    assert outcomes(out) == [(case[4], case[5]) for case in cases]


JSON = [
    ('{"c":null}', LONG, (), None, None),
    ("{}", LONG, (), None, None),
    ('{"c":7}', LONG, (), 7, None),
    ('{"c":7}', INT, (), 7, None),
    ('{"c":"x"}', STRING, (), "x", None),
    ('{"c":12}', STRING, (), "12", None),
    ('{"c":1.50}', STRING, (), "1.5", None),
    ('{"c":"1.50"}', STRING, (), "1.50", None),
    ('{"c":12.00}', STRING, (), "12.0", None),
    ('{"c":1e3}', STRING, (), "1000.0", None),
    ('{"c":1e10}', STRING, (), "1.0E10", None),
    ('{"c":9223372036854775808}', STRING, (), "9.223372036854776E18", None),
    ('{"c":"9223372036854775808"}', STRING, (), "9223372036854775808", None),
    ('{"c":9223372036854775807}', STRING, (), "9223372036854775807", None),
    ('{"c":true}', STRING, (), "true", None),
    ('{"c":"{\\"a\\":1}"}', STRING, (), '{"a":1}', None),
    ('{"c":{"a":1}}', STRING, (), None, "TYPE_MISMATCH"),
    ('{"c":[1]}', STRING, (), None, "TYPE_MISMATCH"),
    ('{"c":1.9}', LONG, (), 1, None),
    ('{"c":1e300}', LONG, (), 2**63 - 1, None),
    ('{"c":-1e300}', LONG, (), -(2**63), None),
    ('{"c":2147483648}', INT, (), -(2**31), None),
    ('{"c":4294967301}', INT, (), 5, None),
    ('{"c":3e10}', INT, (), 2**31 - 1, None),
    ('{"c":-7.9}', INT, (), -7, None),
    ('{"c":-2147483648}', INT, (), -(2**31), None),
    ('{"c":-2147483649}', INT, (), 2**31 - 1, None),
    ('{"c":2147483647.9}', INT, (), 2**31 - 1, None),
    ('{"c":"NaN"}', INT, (), None, "TYPE_MISMATCH"),
    ('{"c":9007199254740993}', LONG, (), 9007199254740993, None),
    ('{"c":3}', DOUBLE, (), 3.0, None),
    ('{"c":0.5}', FLOAT, (), 0.5, None),
    ('{"c":"NaN"}', DOUBLE, (), None, "TYPE_MISMATCH"),
    ('{"c":"Infinity"}', FLOAT, (), None, "TYPE_MISMATCH"),
    ('{"c":1.5E400}', DOUBLE, (), float("inf"), None),
    ('{"c":"12"}', LONG, (), None, "TYPE_MISMATCH"),
    ('{"c":"12"}', INT, (), None, "TYPE_MISMATCH"),
    ('{"c":"1.5"}', DOUBLE, (), None, "TYPE_MISMATCH"),
    ('{"c":true}', INT, (), 1, None),
    ('{"c":false}', LONG, (), 0, None),
    ('{"c":true}', DOUBLE, (), 1.0, None),
    ('{"c":{"a":1}}', LONG, (), None, "TYPE_MISMATCH"),
    ('{"c":"x"}', BINARY, (), None, "TYPE_MISMATCH"),
    ('{"c":1}', BINARY, (), None, "TYPE_MISMATCH"),
    ('{"c":true}', BINARY, (), None, "TYPE_MISMATCH"),
    ('{"c":"2024-01-02 03:04:05.678"}', LONG, ("timestamp",), 1704164645678, None),
    ('{"c":1704164645678}', LONG, ("timestamp",), 1704164645678, None),
    ('{"c":"1704164645678"}', LONG, ("timestamp",), None, "BAD_TIMESTAMP"),
    ('{"c":"soon"}', LONG, ("timestamp",), None, "BAD_TIMESTAMP"),
    ('{"c":true}', LONG, ("timestamp",), 1, None),
    ('{"c":1700000000123}', STRING, ("datetime",), "2023-11-14 22:13:20.123", None),
    ('{"c":"1700000000123"}', STRING, ("datetime",), "1700000000123", None),
    ('{"c":"2023-11-14"}', STRING, ("datetime",), "2023-11-14", None),
    ("[1]", LONG, (), None, "UNSUPPORTED_RECORD"),
    ("3", LONG, (), None, "UNSUPPORTED_RECORD"),
    ("null", LONG, (), None, "UNSUPPORTED_RECORD"),
    (None, LONG, (), None, "UNSUPPORTED_RECORD"),
    ("{oops", LONG, (), None, "BAD_JSON"),
    ("", LONG, (), None, "BAD_JSON"),
    ('{"c":1,"c":2}', LONG, (), 2, None),
    ('{"c":1.5,"c":2.5}', LONG, (), 2, None),
]


@pytest.mark.parametrize("cases", groups(JSON, lambda c: (str(c[1]), c[2])))
def test_json(spark, cases):
    _, target, props, _, _ = cases[0]
    df = spark.createDataFrame([(n, case[0]) for n, case in enumerate(cases)], "n int, value string")
    for typed_parse in (True, False):
        out = project_json(df, T.StructType([column("c", target, True, props)]), typed_parse=typed_parse)
        assert outcomes(out) == [(case[3], case[4]) for case in cases]


def test_required_column(spark):
    assert from_json(spark, '{"c":null}', LONG, nullable=False) == (None, "NULL_REQUIRED")
    assert from_json(spark, "{}", LONG, nullable=False) == (None, "NULL_REQUIRED")
    assert from_json(spark, '{"c":"x"}', LONG, nullable=False) == (None, "TYPE_MISMATCH")
    assert typed(spark, None, LONG, LONG, nullable=False) == (None, "NULL_REQUIRED")


def test_first_bad_column_is_reported(spark):
    schema = T.StructType([column("a", LONG), column("b", LONG), column("d", LONG, nullable=False)])
    df = spark.createDataFrame([('{"a":1,"b":"x"}',), ('{"a":1,"b":2}',)], "value string")
    rows = project_json(df, schema).select("reason", "bad_column", "bad_value").collect()
    assert rows[0] == ("TYPE_MISMATCH", "b", "x")
    assert rows[1] == ("NULL_REQUIRED", "d", None)


def test_fields_by_exact_name(spark):
    schema = T.StructType([column("Name", STRING), column("we ird", LONG), column("x.y", LONG)])
    df = spark.createDataFrame([(json.dumps({"name": "low", "we ird": 1, "x.y": 2, "more": 3}),)], "value string")
    row = project_json(df, schema).collect()[0].record
    assert list(row) == [None, 1, 2]
    flat = spark.createDataFrame([(1, 2)], "`x.y` bigint, other int")
    assert list(project(flat, schema).collect()[0].record) == [None, None, 1]


def test_timestamp_column_read_by_a_typed_reader(spark):
    df = spark.createDataFrame([(datetime(2024, 1, 2, 3, 4, 5),)], "c timestamp").select(
        F.col("c")
    )
    schema = T.StructType([column("c", LONG, props=["timestamp"])])
    assert project(df, schema).collect()[0].record["c"] == 1704164645000


def test_text_times_do_not_depend_on_the_session_zone(spark):
    shape = T.StructType([column("at", T.LongType(), props=["timestamp"]), column("text", T.StringType(), props=["datetime"])])
    df = spark.createDataFrame([('{"at":"2024-07-01 12:00:00.25","text":1719835200250}',)], "value string")
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        for name in ("UTC", "America/New_York", "Asia/Kolkata"):
            spark.conf.set("spark.sql.session.timeZone", name)
            for typed in (True, False):
                row = project_json(df, shape, typed_parse=typed).select("record.*").first()
                assert tuple(row) == (1719835200250, "2024-07-01 12:00:00.250")
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_unreadable_roots(spark):
    table = T.StructType([column("a", LONG)])
    texts = {
        ' \t{"a":1': "BAD_JSON",
        '{"a":"q","z":NaN,}': "BAD_JSON",
        '\n[1,{"a":2}]': "UNSUPPORTED_RECORD",
        "[1,": "BAD_JSON",
        ' "{"': "UNSUPPORTED_RECORD",
        "\u00a0{}": "BAD_JSON",
    }
    out = project_json(spark.createDataFrame([(t,) for t in texts], "value string"), table)
    assert {r["value"]: r["reason"] for r in out.collect()} == texts
