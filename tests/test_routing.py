"""Destination names over option combinations, in one frame per combination of options."""

from __future__ import annotations

import itertools
import random

import pytest
from pyspark.sql import functions as F

from streamloader import route, subscribe

LISTS = (("alpha",), ("alpha", "beta"), ("al.pha", "be.ta", "ga.mma"), None)
OVERRIDES = (None, ("first",), ("own.first", " second"), ("first ", "own.second", "third"))
PREFIXES = ("", "p_", " padded_ ", "dotted.p_")
NAMESPACES = ("", "ns")
SCHEMA = "com.shop.Order"
REGEX = "es_(.)*"
MANY, OVER, ONE = ["alpha", "beta", "gamma"], ["first", "second", "third"], ["alpha"]


def rule(topics, overrides, prefix, namespace, single, topic):
    """The destination in plain words: overrides of the list's length, else the topic or the schema's last part."""
    if overrides and len(overrides) == len(topics):
        places = {t.lower(): table for t, table in zip(topics, overrides, strict=True)}
        table = overrides[0] if len(topics) == 1 else places.get((topic or "").strip().lower())
    else:
        table = prefix.strip() + (topic.replace(".", "_") if single and topic else SCHEMA.rsplit(".", 1)[-1])
    if table is None or "." in table or not namespace:
        return table
    return f"{namespace}.{table}"


def test_destinations_follow_the_rule(spark):
    options = [
        combination
        for combination in itertools.product(LISTS, OVERRIDES, PREFIXES, NAMESPACES, (False, True))
        if combination[0] is not None or combination[1] is None
    ]
    wanted, frames = {}, []
    for n, (topics, overrides, prefix, namespace, single) in enumerate(random.Random(1).sample(options, 48)):
        sent = [*(topics or ("es_one",)), " BETA ", "", None]
        df = spark.createDataFrame(
            [(n, k, topic, None, SCHEMA, 1) for k, topic in enumerate(sent)],
            "n int, k int, topic string, key string, schema_name string, schema_version int",
        )
        out = route(
            df,
            topics=topics,
            topics_regex=None if topics else REGEX,
            overrides=overrides,
            prefix=prefix,
            schema_name=namespace,
            single_table_per_topic=single,
        )
        frames.append(out.select("n", "k", "dest_table", "reason"))
        wanted |= {(n, k): rule(topics, overrides, prefix, namespace, single, t) for k, t in enumerate(sent)}
    rows = [r for frame in frames for r in frame.coalesce(1).collect()]
    assert {(r.n, r.k): r.dest_table for r in rows} == wanted
    assert {r.reason for r in rows if r.dest_table is None} == {"NO_OVERRIDE"}


def test_names_from_schema_and_key(spark):
    rows = [
        ("a.b", None, "com.shop.Order", 1, "Order"),
        ("a.b", "k", None, 1, "a_b"),  # a schema without name
        ("a.b", "com.shop.Fruit", None, None, "Fruit"),  # schemaless: text key
        ("a.b", None, None, None, "b"),  # schemaless: topic as schema name
        ("a.b", None, "com.shop.Order..", 1, "Order"),
    ]
    df = spark.createDataFrame(
        [(n, *r[:4]) for n, r in enumerate(rows)],
        "n int, topic string, key string, schema_name string, schema_version int",
    )
    got = [r.dest_table for r in route(df).orderBy("n").collect()]
    assert got == [r[4] for r in rows]


def test_refused_routes(spark):
    df = spark.createDataFrame(
        [("other", None, None, None), (None, None, None, None)],
        "topic string, key string, schema_name string, schema_version int",
    )
    out = route(df, topics=MANY, overrides=OVER)
    assert {r.reason for r in out.collect()} == {"NO_OVERRIDE"}
    out = route(df, single_table_per_topic=True)
    assert sorted((r.dest_table, r.reason) for r in out.collect() if r.reason) == [(None, "NO_TABLE_NAME")]


@pytest.mark.parametrize(
    "options",
    [
        {"topics_regex": REGEX, "overrides": ["t"]},
        {"overrides": ["t"]},
        {"topics": MANY, "overrides": ["a", "", "c"]},
        {"topics": ONE, "overrides": ["a.b.c"]},
        {"topics": ONE, "overrides": ["a."]},
    ],
)
def test_bad_overrides(spark, options):
    df = spark.createDataFrame([("t",)], "topic string")
    with pytest.raises(ValueError):
        route(df, schemaless=F.lit(True), **options)


def test_subscribe(spark):
    df = spark.createDataFrame([("es_a",), ("xes_a",), ("t1",)], "topic string")
    assert [r.topic for r in subscribe(df, topics_regex=REGEX).collect()] == ["es_a"]
    assert [r.topic for r in subscribe(df, topics=[" t1 ", "t2"]).collect()] == ["t1"]
    for options in ({}, {"topics": ["a"], "topics_regex": "b"}, {"topics": [" "]}):
        with pytest.raises(ValueError):
            subscribe(df, **options)
