"""Whole sink jobs: creation, evolution, refusals, modes, replays."""

from __future__ import annotations

import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F, types as T

from streamloader import (
    IngestOptions,
    StaleState,
    column,
    ingest,
    merge,
    message_schema,
    one_per_key,
    to_envelope,
)
from streamloader.plans import ingest as job_module
from streamloader.plans.ingest import TooManyDestinations, TooManySchemas
from streamloader.sinks import files
from streamloader.sinks.tables import JobInUse
from streamloader.sources.decode import schema_shape
from test_schemas import VERSIONS

SINGLE = dict(single_table_per_topic=True)


def messages(spark, rows, topic="t"):
    """(offset, value) or (offset, key, value) rows as messages."""
    full = [(r[0], r[1] if len(r) == 3 else None, r[-1]) for r in rows]
    df = spark.createDataFrame(full, "o bigint, k string, v string")
    at = F.timestamp_seconds(F.lit(1_700_000_000) + F.col("o"))
    return to_envelope(
        df, topic=topic, value=F.col("v"), key=F.col("k"), offset=F.col("o"), partition=F.lit(0), timestamp=at
    )


def declared(version, offsets):
    schema = VERSIONS[version]
    head = json.loads(message_schema(schema, "rec", version))
    samples = {"string": "s", "bytes": "YWI=", "int32": 1, "int64": 2, "float": 0.5, "double": 1.5}
    rows = []
    for offset in offsets:
        payload = {f["field"]: samples[f["type"]] for f in head["fields"]}
        rows.append((offset, json.dumps({"schema": head, "payload": payload})))
    return rows


def quarantined(tables):
    rows = tables.read("_quarantine").collect()
    return sorted((r.offset, r.reason, r.bad_column) for r in rows)


@pytest.mark.parametrize(
    "sequence,add,relax,columns",
    [((1, 2, 3, 4), True, True, 12), ((3, 1, 2, 4), False, True, 7), ((4, 3), False, False, 12)],
)
def test_evolving_topic(spark, tables, sequence, add, relax, columns):
    rows = []
    for place, version in enumerate(sequence):
        rows += declared(version, range(place * 10, place * 10 + 10))
    options = IngestOptions(
        value_format="schema_json", evolve=True, add_new_fields=add, relax_missing=relax, **SINGLE
    )
    counts = ingest(messages(spark, rows), tables, options)
    assert counts == {"t": {"accepted": 10 * len(sequence), "refused": 0}}
    out = tables.read("t")
    assert (out.count(), len(out.columns)) == (10 * len(sequence), columns)
    if columns == 12:
        # The new version's rows carry values in its new columns.
        assert out.where("test_double2 = 1.5").count() == 10


def test_required_column_absent_blocks(spark, tables):
    options = IngestOptions(value_format="schema_json", evolve=True, **SINGLE)
    counts = ingest(messages(spark, declared(3, [0, 1]) + declared(1, [2])), tables, options)
    assert counts["t"] == {"accepted": 3, "refused": 0}
    less = {"type": "struct", "name": "rec", "version": 9, "fields": [{"field": "test_string", "type": "string"}]}
    row = json.dumps({"schema": less, "payload": {"test_string": "x"}})
    counts = ingest(messages(spark, [(3, row)] + declared(1, [4])), tables, options)
    assert counts["t"] == {"accepted": 1, "refused": 1}
    assert quarantined(tables) == [(3, "VERSION_BLOCKED", None)]
    assert tables.state("t").versions.blocked == (9,)


def test_evolution_off_refuses_other_versions(spark, tables):
    options = IngestOptions(value_format="schema_json", **SINGLE)
    counts = ingest(messages(spark, declared(4, [0, 1]) + declared(2, [2])), tables, options)
    assert counts["t"] == {"accepted": 2, "refused": 1}
    assert quarantined(tables) == [(2, "VERSION_BLOCKED", None)]


def test_schemaless_topic_with_several_tables(spark, tables):
    rows = [
        (0, "Apple", '{"id":1,"sort":"a","size":null,"weight":0.5}'),
        (1, "Apple", '{"id":2,"sort":"b","size":3,"weight":null}'),
        (2, "com.x.Orange", '{"id":1,"diameter":9}'),
        (3, "Apple", '{"id":"three"}'),
        (4, "Apple", '{"op_type":"U","after":{"id":4,"sort":"d"}}'),
        (5, "Apple", '{"op_type":"D","before":{"id":4}}'),
        (6, "Lime", '{"ripe":true}'),
        (7, None, '{"id":7}'),
        (8, "Apple", "oops"),
    ]
    counts = ingest(messages(spark, rows, "fruit"), tables, IngestOptions(schema_name="shop", prefix="f_"))
    assert counts == {
        "shop.f_Apple": {"accepted": 3, "refused": 3},
        "shop.f_Orange": {"accepted": 1, "refused": 0},
        "shop.f_Lime": {"accepted": 0, "refused": 1},
        "shop.f_fruit": {"accepted": 1, "refused": 0},
    }
    apples = tables.read("shop.f_Apple")
    # A null in the first record makes no column.
    assert [(f.name, f.dataType.simpleString()) for f in apples.schema] == [
        ("id", "bigint"),
        ("sort", "string"),
        ("weight", "double"),
    ]
    assert sorted(r.id for r in apples.collect()) == [1, 2, 4]
    assert quarantined(tables) == [
        (3, "TYPE_MISMATCH", "id"),
        (5, "CDC_NO_AFTER", None),
        (6, "UNSUPPORTED_TYPE", None),
        (8, "BAD_JSON", None),
    ]
    assert set(tables.names()) >= {"shop.f_Apple", "shop.f_Orange", "shop.f_fruit"}
    # Tables are the catalog's: any session of it reads them by name.
    assert spark.table(tables.catalog_name("shop.f_Apple")).count() == 3
    assert spark.sql(f"SELECT sum(diameter) AS d FROM {tables.catalog_name('shop.f_Orange')}").first().d == 9


def test_no_creation(spark, tables):
    counts = ingest(messages(spark, [(0, '{"a":1}')]), tables, IngestOptions(create_table=False))
    assert counts == {"t": {"accepted": 0, "refused": 1}}
    assert quarantined(tables) == [(0, "NO_TABLE", None)]


def test_fail_on_error(spark, tables):
    tables.create("t", T.StructType([column("a", T.LongType())]))
    options = IngestOptions(on_error="fail")
    with pytest.raises(Exception, match="TYPE_MISMATCH in column a"):
        ingest(messages(spark, [(0, '{"a":1}'), (1, '{"a":"x"}')]), tables, options)
    assert tables.read("t").count() == 0


def ticker(batch):
    return [(batch * 10 + n, json.dumps({"symbol": f"S{n}", "price": batch + n / 10})) for n in range(10)]


TICKER = T.StructType([column("symbol", T.StringType(), False, ["primary_key"]), column("price", T.DoubleType())])


@pytest.mark.parametrize(
    "key,mode,rows,winner", [((), "upsert", 30, None), (("symbol",), "insert_if_absent", 10, 0), (("symbol",), "upsert", 10, 2)]
)
def test_ticker(spark, tables, key, mode, rows, winner):
    tables.create("t", TICKER, primary_key=key)
    for batch in range(3):
        counts = ingest(
            messages(spark, ticker(batch)), tables, IngestOptions(mode=mode), job="job", batch_id=batch
        )
        assert counts == {"t": {"accepted": 10, "refused": 0}}
    out = tables.read("t").collect()
    assert len(out) == rows
    if winner is not None:
        assert {r.symbol: r.price for r in out} == {f"S{n}": winner + n / 10 for n in range(10)}
    # A replayed batch changes nothing.
    ingest(messages(spark, ticker(2)), tables, IngestOptions(mode=mode), job="job", batch_id=2)
    assert tables.read("t").count() == rows


def test_keys_inside_one_batch(spark, tables):
    tables.create("t", TICKER, primary_key=["symbol"])
    rows = [(0, '{"symbol":"A","price":1}'), (2, '{"symbol":"A","price":3}'), (1, '{"symbol":"A","price":2}')]
    rows += [(3, '{"symbol":null,"price":4}')]
    counts = ingest(messages(spark, rows), tables, IngestOptions())
    assert counts == {"t": {"accepted": 3, "refused": 1}}
    assert [tuple(r) for r in tables.read("t").collect()] == [("A", 3.0)]
    assert quarantined(tables) == [(3, "NULL_REQUIRED", "symbol")]


def test_null_key_of_a_nullable_column(spark, tables):
    tables.create("t", T.StructType([column("k", T.LongType()), column("v", T.LongType())]), primary_key=["k"])
    ingest(messages(spark, [(0, '{"k":1,"v":1}'), (1, '{"v":2}')]), tables, IngestOptions(stage="files"))
    assert quarantined(tables) == [(1, "NULL_PK", "k")]


def test_table_altered_meanwhile(spark, tables, monkeypatch):
    """Another job adds a column between reading the state and writing: the batch starts over."""
    state = tables.create("t", TICKER, primary_key=["symbol"])
    original, calls = tables.write, []

    def racing(current, *rest):
        calls.append(current.revision)
        if len(calls) == 1:
            wider = T.StructType([*TICKER.fields, column("note", T.StringType())])
            tables.alter(state, wider, state.versions)
        return original(current, *rest)

    monkeypatch.setattr(tables, "write", racing)
    rows = [(0, '{"symbol":"A","price":1,"note":"n"}')]
    ingest(messages(spark, rows), tables, IngestOptions())
    assert calls == [0, 1]
    assert [tuple(r) for r in tables.read("t").collect()] == [("A", 1.0, "n")]
    with pytest.raises(StaleState):
        tables.alter(state, T.StructType([column("symbol", T.StringType())]), state.versions)
    with pytest.raises(StaleState):
        tables.create("t", TICKER)


def test_struct_values(spark, tables):
    df = spark.createDataFrame([(0, 1, 1.5), (1, 2, None)], "o bigint, a int, b double")
    value = to_envelope(df, topic="t", value=F.lit(None), offset=F.col("o"), schema_version=F.lit(1))
    typed = df.select(
        F.lit("t").alias("topic"), F.lit(0).alias("partition"), F.col("o").alias("offset"),
        F.lit(datetime(2024, 1, 1)).alias("timestamp"), F.lit(None).cast("string").alias("key"),
        F.lit("rec").alias("schema_name"), F.lit(1).alias("schema_version"), F.struct("a", "b").alias("value"),
    )
    assert value.columns == typed.columns
    counts = ingest(typed, tables, IngestOptions(value_format="struct"))
    assert counts == {"rec": {"accepted": 2, "refused": 0}}
    assert sorted((r.a, r.b) for r in tables.read("rec").collect()) == [(1, 1.5), (2, None)]


def test_table_folders_stay_under_the_root(tables):
    names = ["t", "a.b", "a.b.c", "../up", "..", ".x", "a./y", "a/b", "a.."]
    paths = [tables.path(n) for n in names]
    assert len(set(paths)) == len(names)
    for path in paths:
        inner = path.removeprefix(tables.root + "/").split("/")
        assert len(inner) <= 2 and not {"", ".", ".."} & set(inner)


def test_merge_frames(spark):
    held = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    batch = spark.createDataFrame([(2, "c", 1), (2, "d", 2), (3, "e", 1), (3, "f", 2)], "k int, v string, o int")
    rows = {
        mode: sorted(tuple(r) for r in merge(held, batch, ["k"], ["o"], mode).collect())
        for mode in ("append", "upsert", "insert_if_absent")
    }
    assert len(rows["append"]) == 6
    assert rows["upsert"] == [(1, "a"), (2, "d"), (3, "f")]
    assert rows["insert_if_absent"] == [(1, "a"), (2, "b"), (3, "e")]
    with pytest.raises(ValueError):
        merge(held, batch, ["k"], ["o"], "replace")


def test_one_per_key_limits_rows_before_the_shuffle(spark):
    df = spark.range(100).selectExpr("id % 3 AS k", "id")
    plan = one_per_key(df, ["k"], ["id"], "last")._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Exchange") < plan.rindex("WindowGroupLimit")


KEYED = T.StructType([column("k", T.LongType()), column("v", T.LongType())])


def keyed_rows(spark, first, last, v):
    return spark.range(first, last).selectExpr("id AS k", f"{v}L AS v")


def test_modes_of_batches_and_compaction(spark, tables):
    """Upserts win over what is there, inserts only fill gaps; a rewrite changes nothing, and replays stay replays."""
    state = tables.create("t", KEYED, primary_key=["k"])
    steps = [(0, 10, 1, "insert_if_absent"), (5, 15, 2, "insert_if_absent"), (8, 12, 3, "upsert"), (0, 20, 4, "insert_if_absent")]
    for n, (first, last, v, mode) in enumerate(steps):
        assert tables.write(state, keyed_rows(spark, first, last, v), f"b{n}", ["v"], mode)
    wanted = {k: 1 if k < 8 else 3 if k < 12 else 2 if k < 15 else 4 for k in range(20)}
    for _ in range(2):
        assert {r.k: r.v for r in tables.read("t").collect()} == wanted
        assert not tables.write(state, keyed_rows(spark, 0, 20, 9), "b1", ["v"], "upsert")
        tables.compact("t")
    tables.write(state, keyed_rows(spark, 0, 2, 5), "b5", ["v"], "upsert")
    tables.write(state, keyed_rows(spark, 0, 25, 6), "b6", ["v"], "insert_if_absent")
    after = {**wanted, 0: 5, 1: 5, **dict.fromkeys(range(20, 25), 6)}
    assert {r.k: r.v for r in tables.read("t").collect()} == after


def test_small_batch_writes_only_itself(spark, tables):
    state = tables.create("t", KEYED, primary_key=["k"])
    tables.write(state, keyed_rows(spark, 0, 50_000, 1), "load", ["v"], "upsert")
    tables.write(state, keyed_rows(spark, 100, 110, 2), "ten", ["v"], "upsert")
    last = tables.batches("t")[-1].value
    assert spark.table(tables.catalog_name("t")).where(F.col("__batch") == last).count() == 10
    assert tables.read("t").where("v = 2").count() == 10 and tables.read("t").count() == 50_000


def test_keyed_read_has_no_exchange(spark, tables):
    """Batches are bucketed by key, so taking one row per key shuffles nothing, before and after compaction."""
    state = tables.create("t", KEYED, primary_key=["k"])
    for n in range(3):
        tables.write(state, keyed_rows(spark, n, n + 100, n), f"b{n}", ["v"], "upsert")
    for _ in range(2):
        plan = tables.read("t")._jdf.queryExecution().executedPlan().toString()
        assert "Bucketed: true" in plan and "Exchange" not in plan
        tables.compact("t")
    assert tables.read("t").count() == 102


def test_replay_overwrites_what_a_crash_left(spark, tables):
    """Files of a batch that was never registered are replaced, not added to; a registered batch is not written again."""
    state = tables.create("t", KEYED)
    assert tables.write(state, keyed_rows(spark, 0, 5, 1), "a b/c")
    value = tables.batches("t")[0].value
    spark.sql(f"ALTER TABLE {tables.catalog_name('t')} DROP PARTITION (__batch = '{value}')")
    assert tables.read("t").count() == 0 and spark.read.parquet(tables.data_path("t")).count() == 5
    assert tables.write(state, keyed_rows(spark, 0, 7, 2), "a b/c")
    assert {(r.k, r.v) for r in tables.read("t").collect()} == {(k, 2) for k in range(7)}
    assert spark.read.parquet(tables.data_path("t")).count() == 7
    assert not tables.write(state, keyed_rows(spark, 0, 9, 3), "a b/c")


def test_vacuum_keeps_labels(spark, tables):
    state = tables.create("t", KEYED, primary_key=["k"])
    for n in range(3):
        tables.write(state, keyed_rows(spark, 0, 10, n), f"b{n}", ["v"], "upsert")
    tables.compact("t")
    before = spark.read.parquet(tables.data_path("t")).count()
    tables.vacuum("t")
    assert (before, spark.read.parquet(tables.data_path("t")).count()) == (40, 10)
    assert not tables.write(state, keyed_rows(spark, 0, 10, 9), "b1", ["v"], "upsert")
    assert {r.v for r in tables.read("t").collect()} == {2}


def test_state_lives_in_the_catalog(spark, tables):
    """Another handle finds keys, required columns, properties and versions; names differ by case and signs only."""
    shape = T.StructType([column("k", T.LongType(), False, ["primary_key"]), column("it's", T.StringType(), True, ["char8"], "o'x")])
    names = ["t", "T", "t-", "ns.t", "Ns.t"]
    for name in names:
        tables.create(name, shape, primary_key=["k"])
    other = type(tables)(spark, tables.root)
    assert sorted(other.names()) == sorted(names)
    assert all(other.state(n) == tables.state(n) and other.state(n).schema == shape for n in names)
    assert len({other.catalog_name(n) for n in names}) == len(names)


def test_views_show_one_row_per_key(spark, tables):
    state = tables.create("t", KEYED, primary_key=["k"])
    tables.write(state, keyed_rows(spark, 0, 10, 1), "a", ["v"], "upsert")
    tables.compact("t")
    tables.write(state, keyed_rows(spark, 5, 15, 2), "b", ["v"], "upsert")
    tables.write(state, keyed_rows(spark, 0, 20, 3), "c", ["v"], "insert_if_absent")
    (view,) = tables.create_views()
    rows = {r.k: r.v for r in spark.table(view).collect()}
    assert rows == {r.k: r.v for r in tables.read("t").collect()} == {k: 1 if k < 5 else 2 if k < 15 else 3 for k in range(20)}


def refusing(spark):
    return messages(spark, [(0, '{"a":1}'), (1, '{"a":"x"}'), (2, "oops"), (3, None)])


def test_replay_keeps_refused_rows_and_counts(spark, tables):
    tables.create("t", T.StructType([column("a", T.LongType())]), primary_key=["a"])
    first = ingest(refusing(spark), tables, IngestOptions(), job="j", batch_id=4)
    assert first == {"t": {"accepted": 1, "refused": 3}}
    held = quarantined(tables)
    assert ingest(refusing(spark), tables, IngestOptions(), job="j", batch_id=4) == first
    assert quarantined(tables) == held and len(held) == 3 and tables.read("t").count() == 1


def test_crash_between_table_and_quarantine(spark, tables, monkeypatch):
    """The table's batch is there, its refused rows are not: the replay adds them and nothing else."""
    tables.create("t", T.StructType([column("a", T.LongType())]))
    write = tables.write

    def dies(state, *rest):
        if state.name != "t":
            raise OSError("lost")
        return write(state, *rest)

    monkeypatch.setattr(tables, "write", dies)
    with pytest.raises(OSError):
        ingest(refusing(spark), tables, IngestOptions(), job="j")
    monkeypatch.setattr(tables, "write", write)
    assert tables.read("t").count() == 1 and quarantined(tables) == []
    assert ingest(refusing(spark), tables, IngestOptions(), job="j") == {"t": {"accepted": 1, "refused": 3}}
    assert tables.read("t").count() == 1 and len(quarantined(tables)) == 3


def test_job_name_belongs_to_one_source(spark, tables):
    rows = messages(spark, [(0, '{"a":1}')])
    ingest(rows, tables, IngestOptions(), job="j", batch_id=0, source="one")
    with pytest.raises(JobInUse):
        ingest(rows, tables, IngestOptions(), job="j", batch_id=0, source="two")
    with pytest.raises(JobInUse):
        ingest(rows, tables, IngestOptions(), job="j", batch_id=1)
    assert tables.read("t").count() == 1


def test_default_does_not_depend_on_batches(spark, tables):
    """A version without a column that has a default reads it, in one batch or two."""
    def declared_message(offset, version, fields, payload):
        head = {"type": "struct", "name": "rec", "version": version, "fields": fields}
        return offset, json.dumps({"schema": head, "payload": payload})

    k = {"field": "k", "type": "int64", "optional": False}
    channel = {"field": "channel", "type": "string", "optional": True, "default": "web"}
    rows = [
        declared_message(0, 1, [k], {"k": 1}),
        declared_message(1, 2, [k, channel], {"k": 2, "channel": "s"}),
        declared_message(2, 1, [k], {"k": 3}),
    ]
    options = IngestOptions(value_format="schema_json", evolve=True, add_new_fields=True, **SINGLE)
    for topic, cuts in (("one", [rows]), ("two", [rows[:1], rows[1:]]), ("three", [[r] for r in rows])):
        for part in cuts:
            ingest(messages(spark, part, topic), tables, options)
        assert sorted((r.k, r.channel) for r in tables.read(topic).collect()) == [(1, "web"), (2, "s"), (3, "web")]


def test_bound_on_destinations_and_clean_scratch(spark, tables):
    rows = [(n, f"user{n}", '{"a":1}') for n in range(4)]
    with pytest.raises(TooManyDestinations, match="more than 2 destinations"):
        ingest(messages(spark, rows), tables, IngestOptions(max_destinations=2))
    assert tables.names() == []
    ingest(messages(spark, rows), tables, IngestOptions(max_destinations=4))
    assert len(tables.names()) == 4
    assert not [n for n in files.list_names(spark, files.shared_folder(spark)) if n.startswith("routed-")]


def texts_of_one_version(spark, many, version=1):
    """Messages whose schema texts all differ in their documentation."""
    head = F.concat(
        F.lit('{"schema":{"type":"struct","name":"rec","version":%d,"fields":[{"field":"k","type":"int64","optional":true,"doc":"' % version),
        F.col("id").cast("string"), F.lit('"}]},"payload":{"k":'), F.col("id").cast("string"), F.lit("}}"),
    )
    return to_envelope(spark.range(many), topic="t", value=head, offset=F.col("id"), partition=F.lit(0))


def test_many_schema_texts_of_one_version(spark, tables):
    """A hundred thousand texts of a version bring one row to the driver while it is new, and none once it is known."""
    options = IngestOptions(value_format="schema_json", **SINGLE)
    sent = job_module.prepare(texts_of_one_version(spark, 100_000), options)
    nothing = spark.createDataFrame([], "dest_table string, schema_version int")
    (first,) = job_module.first_of_versions(sent, "message_schema", nothing).collect()
    assert (first.schema_version, first["first"].offset) == (1, 0) and '"doc":"0"' in first.schema
    known = spark.createDataFrame([("t", 1), ("t", None)], nothing.schema)
    assert job_module.first_of_versions(sent, "message_schema", known).collect() == []
    assert sent.select(schema_shape("message_schema")).distinct().count() == 1
    assert ingest(texts_of_one_version(spark, 2000), tables, options) == {"t": {"accepted": 2000, "refused": 0}}
    assert ingest(texts_of_one_version(spark, 300), tables, options) == {"t": {"accepted": 300, "refused": 0}}
    assert ingest(texts_of_one_version(spark, 7, version=2), tables, options) == {"t": {"accepted": 0, "refused": 7}}
    assert tables.read("t").agg(F.sum("k")).first()[0] == 1999 * 1000 + 299 * 150


def test_bound_on_schemas(spark, tables):
    rows = [row for v in VERSIONS for row in declared(v, [v])]
    with pytest.raises(TooManySchemas, match="more than 2"):
        ingest(messages(spark, rows), tables, IngestOptions(value_format="schema_json", max_schemas=2, **SINGLE))
    assert tables.names() == []


def test_reserved_table_and_quotes(spark, tables):
    counts = ingest(messages(spark, [(0, "_quarantine", '{"a":1}'), (1, None, "{'a':'x'}"), (2, None, '{"a":1}')]), tables, IngestOptions())
    assert counts == {"_quarantine": {"accepted": 0, "refused": 1}, "t": {"accepted": 1, "refused": 1}}
    assert quarantined(tables) == [(0, "RESERVED_TABLE", None), (1, "BAD_JSON", None)]


@pytest.mark.parametrize(
    "options",
    [
        {"mode": "replace"},
        {"topics": ["a"], "topics_regex": "b"},
        {"retry_count": 0},
        {"topics_regex": "a", "overrides": ["t"]},
        {"value_format": "xml"},
    ],
)
def test_bad_options(options):
    with pytest.raises(ValueError):
        IngestOptions(**options)
    assert job_module.VALUE_FORMATS


def test_names_pass_over_temporary_views(spark, tables):
    ingest(messages(spark, [(0, '{"a":1}')]), tables, IngestOptions(**SINGLE))
    spark.range(3).createOrReplaceTempView("passing_view")
    try:
        assert tables.names() == ["t"]
        assert len(tables.create_views()) == 1
    finally:
        spark.catalog.dropTempView("passing_view")


def test_staged_messages_are_read_in_parts(spark, tables):
    # One destination of some 25 MB, which is staged as one file.
    rows = spark.range(100_000, numPartitions=2)
    body = F.concat(*[F.sha2(F.concat_ws("-", "id", F.lit(k)), 256) for k in range(4)])
    value = F.to_json(F.struct("id", body.alias("body")))
    messages = to_envelope(
        rows, topic="t", value=value, offset=F.col("id"), partition=F.lit(0), timestamp=F.lit(datetime(2024, 1, 1))
    )
    batch = job_module._Batch(messages, tables, IngestOptions(**SINGLE), "parts", 0)
    batch.staged = None
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2m")
    try:
        batch._hold()
        parts = batch.routed.groupBy(F.spark_partition_id()).count().collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        files.delete_folder(spark, batch.staged)
    assert sum(r["count"] for r in parts) == 100_000
    assert len(parts) > 1 and max(r["count"] for r in parts) < 60_000
