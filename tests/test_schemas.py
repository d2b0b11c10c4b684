"""Schema derivation and evolution."""

from __future__ import annotations

import itertools
import json

import pytest
from pyspark.sql import Row, functions as F, types as T

from streamloader import (
    UnsupportedSchema,
    Versions,
    column,
    conform,
    evolve,
    evolve_versions,
    field_map,
    infer_schemas,
    message_schema,
    reshape,
    schema_from_message,
    version_gate,
    width_classes,
)
from streamloader.functions.types import check_names, width_word

LONG, INT, DOUBLE, FLOAT = T.LongType(), T.IntegerType(), T.DoubleType(), T.FloatType()
STRING, BINARY = T.StringType(), T.BinaryType()


def shape(required=(), **columns):
    return T.StructType([column(n, t, n not in required) for n, t in columns.items()])


BASE = dict(
    name=STRING, timestamp=LONG, test_int=INT, test_long=LONG, test_float=FLOAT,
    test_double=DOUBLE, test_bytes=BINARY, test_string=STRING,
)
NAMED = ("name", "timestamp")
V1 = shape(NAMED, **BASE)
V2 = shape(NAMED, **BASE, test_int2=INT, test_long2=LONG)
V3 = shape(
    (*NAMED, "test_int", "test_long", "test_double"),
    **{n: t for n, t in BASE.items() if n != "test_float"},
)
V4 = shape(NAMED, **BASE, test_int2=INT, test_long2=LONG, test_float2=FLOAT, test_double2=DOUBLE)
VERSIONS = {1: V1, 2: V2, 3: V3, 4: V4}


@pytest.mark.parametrize(
    "sequence,add,relax,columns,blocked",
    [
        ((1, 2, 3, 4), True, True, 12, ()),
        ((1, 2, 3, 4), False, False, 8, ()),
        ((1, 2, 4), True, False, 12, ()),
        ((3, 1, 2, 4), False, True, 7, ()),
        ((4, 3), False, False, 12, ()),
        ((3, 1), False, False, 7, ()),
    ],
)
def test_version_sequences(sequence, add, relax, columns, blocked):
    first, *rest = sequence
    plan = evolve_versions(
        VERSIONS[first],
        Versions((first,)),
        [(v, VERSIONS[v]) for v in rest],
        enabled=True,
        add_new_fields=add,
        relax_missing=relax,
    )
    assert len(plan.schema) == columns
    assert plan.versions.blocked == blocked
    assert plan.versions.known == sequence


def test_truth_table():
    table = shape(("r",), r=LONG, o=STRING)
    extra = shape(("r",), r=LONG, o=STRING, x=DOUBLE)
    step = evolve(table, extra, add_new_fields=True)
    assert step.added == ("x",) and step.schema["x"].nullable and not step.blocked
    step = evolve(table, extra)
    assert step.ignored == ("x",) and step.schema == table and not step.changed
    step = evolve(table, shape(("r",), r=LONG))
    assert step.schema == table and not step.blocked
    step = evolve(table, shape(o=STRING), relax_missing=True)
    assert step.relaxed == ("r",) and step.schema["r"].nullable and not step.blocked
    step = evolve(table, shape(o=STRING))
    assert step.blocked and step.missing == ("r",) and not step.schema["r"].nullable
    # A retyped field is a conversion matter, and only text defaults are carried.
    assert evolve(table, shape(("r",), r=STRING, o=LONG)).schema == table
    new = T.StructType([*table.fields, column("d", STRING, default="it's")])
    assert evolve(table, new, add_new_fields=True).schema["d"].metadata["default"] == "it's"


def test_evolution_off():
    plan = evolve_versions(V1, Versions((1,)), [(1, V1), (2, V2)], enabled=False)
    assert plan.versions == Versions((1,), (2,)) and plan.schema == V1
    # Nothing is refused for a table whose versions were never recorded.
    plan = evolve_versions(V1, Versions(), [(2, V2)], enabled=False)
    assert plan.versions == Versions()


def test_blocked_version_is_forgotten():
    versions = Versions((1, 2)).block(2)
    assert versions == Versions((1,), (2,))
    assert versions.block(2) == versions


def test_gate(spark):
    df = spark.createDataFrame(
        [("t", 1), ("t", 2), ("t", None), ("u", 2)], "dest_table string, schema_version int"
    )
    out = version_gate(df, [("t", 2), ("t", None)])
    assert [r.reason for r in out.collect()] == [None, "VERSION_BLOCKED", "VERSION_BLOCKED", None]
    assert {r.reason for r in version_gate(df, []).collect()} == {None}


def test_message_schema_round_trip():
    text = message_schema(V1, "rec", 4)
    assert schema_from_message(text) == V1
    doc = json.loads(text)
    assert (doc["name"], doc["version"], len(doc["fields"])) == ("rec", 4, 8)
    with pytest.raises(UnsupportedSchema):
        schema_from_message('{"type": "struct", "fields": []}')
    with pytest.raises(UnsupportedSchema):
        message_schema(T.StructType([T.StructField("d", T.DateType())]), "rec", 1)


def test_names_differing_in_case():
    with pytest.raises(UnsupportedSchema):
        check_names(shape(a=LONG, A=LONG))


def test_infer(spark):
    rows = [
        ("t", 2, '{"late":1}'),
        ("t", 1, '{"z":1,"none":null,"a":1.0,"s":"x"}'),
        ("t", 3, '{"z":1.5,"s":7,"b":true}'),
        ("u", 1, '{"flag":true,"nested":{"x":1}}'),
    ]
    df = spark.createDataFrame(rows, "dest_table string, offset bigint, value string")
    first = infer_schemas(df, order=["offset"]).orderBy("dest_table", "position").collect()
    assert [tuple(r) for r in first] == [
        ("t", 1, "z", "bigint"),
        ("t", 2, "a", "double"),
        ("t", 3, "s", "string"),
        ("u", 1, "flag", "UNSUPPORTED_TYPE"),
        ("u", 2, "nested", "UNSUPPORTED_TYPE"),
    ]
    merged = infer_schemas(df.where("dest_table = 't'"), infer="all").collect()
    assert {(r.column, r.type) for r in merged} == {
        ("a", "double"),
        ("b", "UNSUPPORTED_TYPE"),
        ("late", "bigint"),
        ("s", "UNSUPPORTED_TYPE"),
        ("z", "double"),
    }


def test_merged_types_form_a_lattice(spark):
    """Every combination of kinds, nulls that say nothing, fields of one record in any order."""
    texts = {"l": "1", "d": "1.5", "s": '"x"', "o": "true", "n": "null"}
    rows, wanted = [], {}
    for kinds in (c for n in (1, 2, 3) for c in itertools.combinations("ldson", n)):
        name = "".join(kinds)
        rows += [("t", f'{{"{name}":{texts[k]}}}') for k in kinds]
        said = set(kinds) - {"n"}
        if said:
            wanted[name] = "bigint" if said == {"l"} else "double" if said <= {"l", "d"} else "string" if said == {"s"} else "UNSUPPORTED_TYPE"
    rows += [("t", "oops"), ("t", None), ("t", "null"), ("list", "[1]"), ("list", '{"a":1}'), ("none", '{"a":null}')]
    df = spark.createDataFrame(rows, "dest_table string, value string")
    found = infer_schemas(df, infer="all").collect()
    assert {r.column: r.type for r in found if r.dest_table == "t"} == wanted
    assert [r.position for r in sorted(found, key=lambda r: r.column) if r.dest_table == "t"] == list(range(1, len(wanted) + 1))
    assert [tuple(r) for r in found if r.dest_table != "t"] == [("list", 1, "value", "UNSUPPORTED_TYPE")]


def test_fifty_thousand_field_names(spark):
    """No schema text is built: rows come out of the executors, or an error that names the table and its count."""
    many = spark.range(50_000).selectExpr("if(id < 9, 'few', 'many') AS dest_table", "concat('{\"f', id, '\":', id, '}') AS value")
    assert infer_schemas(many, infer="all", max_columns=None).groupBy("type").count().collect() == [Row(type="bigint", count=50_000)]
    with pytest.raises(Exception, match="table many would have 49991 columns, more than 1000"):
        infer_schemas(many, infer="all").collect()
    assert infer_schemas(many.where("dest_table = 'few'"), infer="all").count() == 9


def test_first_rows_with_null_order(spark):
    from streamloader.operators.schemas import first_rows

    rows = [("t", 5, 1), ("t", None, 2), ("u", 3, 3), ("u", 3, 1), (None, 1, 9)]
    df = spark.createDataFrame(rows, "g string, a int, b int")
    got = {tuple(r) for r in first_rows(df, ["g"], ["a", "b"], ["b"]).collect()}
    assert got == {("t", 2), ("u", 1), (None, 9)}


def test_conform(spark):
    df = spark.createDataFrame(
        [(1, True, bytearray(b"x"), None, [1])],
        "i int, flag boolean, raw binary, u struct<member0:int,member1:string>, l array<int>",
    )
    kept, out = conform(df)
    assert (kept.columns, out) == (["i", "raw"], ["flag", "u", "l"])
    kept, out = conform(df, rules="avro")
    assert (kept.columns, out) == (["i", "flag", "raw"], ["u", "l"])
    assert kept.schema["flag"].metadata["properties"] == ["dict", "char8"]
    assert kept.collect()[0].flag == "true"
    with pytest.raises(UnsupportedSchema):
        conform(df, rules="avro", strict=True)
    kept, out = conform(df.drop("l"), rules="avro", strict=True)
    assert out == ["u"]
    with pytest.raises(UnsupportedSchema):
        conform(df.select("l"))


def test_widths(spark):
    expected = {1: "char1", 2: "char2", 3: "char4", 9: "char16", 256: "char256", 257: "string", 0: "string"}
    assert {n: width_word(n) for n in expected} == expected
    df = spark.createDataFrame([("x" * 5, ""), ("x" * 3, None)], "a string, b string")
    got = {(r.column, r.max_length, r.width) for r in width_classes(df).collect()}
    assert got == {("a", 5, "char8"), ("b", 0, "string")}


def test_field_map_and_reshape(spark):
    table = T.StructType([column("a", LONG), column("b", STRING, default="web")])
    rows = field_map(spark, table, T.StructType([column("a", LONG), column("c", LONG)])).collect()
    assert {tuple(r) for r in rows} == {("a", "mapped"), ("b", "missing"), ("c", "ignored")}
    old = spark.createDataFrame([(1,)], "a bigint")
    assert [tuple(r) for r in reshape(old, table).collect()] == [(1, "web")]
