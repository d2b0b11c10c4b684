"""Decoders, change feeds and streaming queries."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F, types as T

from streamloader import (
    IngestOptions,
    RegisteredSchema,
    Tables,
    StreamCounts,
    UnsupportedSchema,
    change_feed,
    column,
    decode_schema_json,
    fan_in,
    first_wins,
    ingest,
    inserted_rows,
    json_body,
    merge_stream,
    observe_counts,
    read_messages,
    run_stream,
    stream_feed,
    stream_table,
    stream_tables,
    to_envelope,
    unwrap_cdc,
    wire_header,
    with_schema,
    write_feed,
    write_topics,
)
from streamloader.sinks import files
from streamloader.sources.feed import feed_versions, number_by, number_rows
from streamloader.streaming import run as run_module


def test_schema_json(spark):
    rows = [
        ('{"schema":{"name":"a.B","version":2,"fields":[]},"payload":{"x":1.50,"s":"q\\"\\u00e9"}}',),
        ('{"payload":{"x":1}}',),
        ("nonsense",),
        ('{"schema":{"type":"int32"},"payload":7}',),
    ]
    df = spark.createDataFrame(rows, "value string")
    out = decode_schema_json(df).collect()
    assert (out[0].schema_name, out[0].schema_version, out[0].reason) == ("a.B", 2, None)
    assert [r.reason for r in out[1:]] == ["NO_SCHEMA", "NO_SCHEMA", "UNSUPPORTED_RECORD"]


def test_cdc(spark):
    rows = [
        ('{"op_type":"I","after":{"a":1}}', '{"a":1}', None),
        ('{"a":1}', '{"a":1}', None),
        ('{"op_type":null,"after":{"a":1}}', '{"op_type":null,"after":{"a":1}}', None),
        ('{"op_type":"D","before":{"a":1}}', '{"op_type":"D","before":{"a":1}}', "CDC_NO_AFTER"),
        ('{"op_type":"U","after":null}', '{"op_type":"U","after":null}', "CDC_NO_AFTER"),
        ('{"op\\u005ftype":"I","after":{"a":2}}', '{"a":2}', None),
        ("bad", "bad", None),
        (None, None, None),
    ]
    df = spark.createDataFrame([(n, r[0]) for n, r in enumerate(rows)], "n int, value string")
    out = unwrap_cdc(df).orderBy("n").collect()
    assert [(r.value, r.reason) for r in out] == [r[1:] for r in rows]


def test_wire_header(spark):
    rows = [(bytearray(b"\x00\x00\x00\x01\x02abc"),), (bytearray(b"\x01\x00\x00\x00\x01a"),), (bytearray(b"\x00\x01"),), (None,), (bytearray(b"\x00\xff\xff\xff\xff"),)]
    out = wire_header(spark.createDataFrame(rows, "value_bytes binary")).collect()
    assert [(r.schema_id, r.reason) for r in out] == [
        (258, None),
        (None, "BAD_WIRE_HEADER"),
        (None, "BAD_WIRE_HEADER"),
        (None, "BAD_WIRE_HEADER"),
        (2**32 - 1, None),
    ]
    assert bytes(out[0].payload) == b"abc" and bytes(out[4].payload) == b""


def test_only_text_keys_name_tables(spark):
    df = spark.createDataFrame([(1, "k", "{}")], "n int, k string, v string")
    assert to_envelope(df, topic="t", value=F.col("v"), key=F.col("k")).first().key == "k"
    assert to_envelope(df, topic="t", value=F.col("v"), key=F.col("n")).first().key is None


def test_numbers_are_dense_over_many_files(spark, tmp_path):
    path = str(tmp_path / "rows")
    spark.range(1000).repartition(7).write.parquet(path)
    plain = number_rows(spark.read.parquet(path), start=5)
    assert sorted(r.sequence for r in plain.collect()) == list(range(5, 1005))
    # A filtered read is not a plain one: its rows are numbered without gaps too.
    some = number_rows(spark.read.parquet(path).where("id % 3 = 0"))
    assert sorted(r.sequence for r in some.collect()) == list(range(334))
    ordered = number_rows(spark.read.parquet(path), ["id"])
    assert all(r.sequence == r.id for r in ordered.collect())
    # One order value for all rows must not matter.
    tied = number_rows(spark.read.parquet(path).withColumn("one", F.lit(1)), ["one"])
    assert sorted(r.sequence for r in tied.collect()) == list(range(1000))


def test_feed_keeps_nulls_and_refuses_nested(spark):
    df = spark.createDataFrame([(2, None), (1, "x")], "k bigint, v string")
    rows = change_feed(df, " t ", "p_", 3, order=["k"]).orderBy("offset").collect()
    assert [(r.topic, r.key, r.offset, r.value) for r in rows] == [
        ("p_t", "0", 0, '{"k":1,"v":"x"}'),
        ("p_t", "1", 1, '{"k":2,"v":null}'),
    ]
    with pytest.raises(UnsupportedSchema):
        change_feed(spark.createDataFrame([([1],)], "a array<int>"), "t")


def test_feed_versions():
    assert feed_versions([" a", "b"], None) == {"a": 1, "b": 1}
    assert feed_versions(["a", "b"], [2, 3]) == {"a": 2, "b": 3}
    assert feed_versions(["a", "b"], {"b": 3}) == {"a": 1, "b": 3}
    for tables, versions in (([], None), (["a", " "], None), (["a"], [1, 2]), (["a"], {"c": 1})):
        with pytest.raises(ValueError):
            feed_versions(tables, versions)


def test_round_trip(spark, tables, tmp_path):
    """Tables to topics to tables: all six types survive."""
    schema = "x float, at bigint, txt string, n int, d double, raw binary"
    rows = [(1.5, 10, "é\n", 1, 0.1, bytearray(b"\x00\xff")), (-2.5, 20, None, None, 1e300, None)]
    source = spark.createDataFrame(rows, schema)
    feeds = fan_in({"tweet": source, "other": source.select("n")}, "feed.", {"tweet": 2})
    path = str(tmp_path / "topics")
    write_topics(feeds, path)
    read = spark.read.schema(feeds.schema).parquet(path)
    value = F.concat(F.lit('{"schema":'), "message_schema", F.lit(',"payload":'), "value", F.lit("}"))
    options = IngestOptions(value_format="schema_json", topics=["feed.tweet"])
    counts = ingest(read.withColumn("value", value).drop("message_schema"), tables, options)
    assert counts == {"tweet": {"accepted": 2, "refused": 0}}
    back = tables.read("tweet").select(*source.columns)
    assert sorted(map(repr, back.collect())) == sorted(map(repr, source.collect()))


EVENTS = "user bigint, id bigint, at timestamp"


def events(spark, start, stop):
    return spark.range(start, stop).selectExpr(
        "id % 5 AS user", "id", "timestamp_seconds(1700000000 + id) AS at"
    )


def test_stream_equals_batch(spark, tmp_path):
    source, root = str(tmp_path / "in"), str(tmp_path)
    shape = T.StructType([column("user", T.LongType()), column("id", T.LongType())])
    stored = []
    for n in range(3):
        df = events(spark, n * 20, n * 20 + 20)
        envelope = to_envelope(
            df,
            topic="t",
            value=F.to_json(F.struct("user", "id")),
            offset=F.col("id"),
            partition=F.lit(0),
            timestamp=F.col("at"),
        )
        envelope.coalesce(1).write.mode("append").parquet(source)
        stored.append(envelope)
    options = IngestOptions(**{"single_table_per_topic": True})
    streamed = Tables(spark, f"{root}/streamed")
    batched = Tables(spark, f"{root}/batched")
    for tables in (streamed, batched):
        tables.create("t", shape, primary_key=["user"])
    seen = []
    arguments = dict(job="j", checkpoint=f"{root}/checkpoint", on_counts=lambda i, c: seen.append((i, c)))
    stream = read_messages(spark, source, streaming=True, max_files_per_trigger=1)
    run_stream(stream, streamed, options, **arguments).awaitTermination()
    assert [i for i, _ in seen] == [0, 1, 2]
    ingest(read_messages(spark, source), batched, options)
    rows = [sorted(map(tuple, t.read("t").collect())) for t in (streamed, batched)]
    assert rows[0] == rows[1] == [(u, 55 + u) for u in range(5)]
    # Restarted from its checkpoint with nothing new, the stream does nothing.
    stream = read_messages(spark, source, streaming=True)
    run_stream(stream, streamed, options, **arguments).awaitTermination()
    assert len(seen) == 3


def test_counts_of_a_running_stream(spark, tmp_path):
    """Progress events tell accepted and refused rows of every batch and table, unlisted tables together."""
    source = str(tmp_path / "in")
    shape = "dest_table string, reason string"
    batches = [[("a", None)] * 3 + [("b", "X")], [("a", "X"), ("c", None), (None, "Y")], [("b", None)] * 2]
    for rows in batches:
        spark.createDataFrame(rows, shape).coalesce(1).write.mode("append").parquet(source)
    stream = spark.readStream.schema(shape).option("maxFilesPerTrigger", 1).parquet(source)
    listener = StreamCounts()
    spark.streams.addListener(listener)
    try:
        writer = observe_counts(stream, ["a", "b"]).writeStream.foreachBatch(lambda df, n: df.write.format("noop").mode("overwrite").save())
        query = writer.option("checkpointLocation", str(tmp_path / "checkpoint")).trigger(availableNow=True).start()
        query.awaitTermination()
        listener.wait(query)
    finally:
        spark.streams.removeListener(listener)
    assert [(b, t, x, y) for _, b, t, x, y in listener.rows] == [
        (0, "a", 3, 0), (0, "b", 0, 1), (1, "", 1, 1), (1, "a", 0, 1), (2, "b", 2, 0),
    ]
    assert listener.frame(spark).where("dest_table = 'a'").agg(F.sum("accepted")).first()[0] == 3


def test_typed_stream_first_wins(spark, tmp_path):
    source, root = str(tmp_path / "in"), str(tmp_path)
    for n in range(2):
        events(spark, n * 10, n * 10 + 10).coalesce(1).write.mode("append").parquet(source)
    tables = Tables(spark, f"{root}/tables")
    tables.create("t", T.StructType([column("user", T.LongType()), column("id", T.LongType())]), ["user"])
    rows = spark.readStream.schema(EVENTS).option("maxFilesPerTrigger", 1).parquet(source)
    merge_stream(
        rows, tables, "t", ["at"], "insert_if_absent", job="j", checkpoint=f"{root}/checkpoint"
    ).awaitTermination()
    assert sorted(map(tuple, tables.read("t").collect())) == [(u, u) for u in range(5)]
    for watermark in (None, ("at", "1 hour")):
        name = f"first_{watermark is None}"
        kept = first_wins(rows, ["user"], watermark)
        query = kept.writeStream.format("memory").queryName(name).trigger(availableNow=True).start()
        query.awaitTermination()
        assert spark.table(name).count() == 5


def test_feed_stream_numbers_on(spark, tmp_path):
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    shape = T.StructType([T.StructField("k", T.LongType())])
    for n in range(2):
        spark.range(n * 4, n * 4 + 4).toDF("k").coalesce(1).write.mode("append").parquet(source)
        feed = stream_feed(spark, source, shape, "t", "feed.", 2)
        write_feed(feed, out, checkpoint=str(tmp_path / "checkpoint")).awaitTermination()
    rows = spark.read.option("recursiveFileLookup", "true").parquet(out).collect()
    assert sorted(r.offset for r in rows) == list(range(8))
    assert {r.value for r in rows} == {f'{{"k":{n}}}' for n in range(8)}


def test_shared_folder(spark):
    assert files.scratch_path(spark, "a") != files.scratch_path(spark, "a")

    class Session:
        """A session of a cluster, with and without the setting."""

        def __init__(self, folder):
            self.conf = type("Conf", (), {"get": lambda self, key, default: folder})()
            self.sparkContext = type("Context", (), {"master": "spark://host:1"})()

    assert files.shared_folder(Session("/somewhere/shared/")) == "/somewhere/shared"
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        files.shared_folder(Session(None))


def test_feeds_carry_times_and_schemas(spark):
    df = spark.sql("SELECT 1L AS k, TIMESTAMP'2024-01-02 03:04:05.678' AS at, DATE'1970-01-02' AS day")
    row = with_schema(change_feed(df, "t")).first()
    opened = json.loads(row.value)
    assert opened["payload"] == {"k": 1, "at": 1704164645678, "day": 86400000}
    assert [(f["field"], f["type"]) for f in opened["schema"]["fields"]] == [("k", "int64"), ("at", "int64"), ("day", "int64")]


def test_feed_of_a_loaded_table(spark, tables, tmp_path):
    """Batches that a job published, and later ones, come out of the feed once each."""
    tables.create("t", T.StructType([column("a", T.LongType())]))
    envelope = spark.createDataFrame([(n, json.dumps({"a": n})) for n in range(4)], "o bigint, v string")
    rows = to_envelope(envelope, topic="t", value=F.col("v"), offset=F.col("o"))
    out, seen = str(tmp_path / "out"), []
    for part in ("offset < 1", "offset >= 1"):
        ingest(rows.where(part), tables, IngestOptions())
        feed = stream_table(tables, "t", "feed.")
        write_feed(feed, out, checkpoint=str(tmp_path / "checkpoint")).awaitTermination()
        seen.append(spark.read.schema(feed.schema).parquet(out).count())
    assert seen == [1, 4]


def keyed(spark, first, last):
    return spark.range(first, last).toDF("k")


SHAPE = T.StructType([column("k", T.LongType())])


def published(spark, out):
    rows = spark.read.schema("topic string, offset bigint, key string, value string").parquet(out).collect()
    assert all(r.key == str(r.offset) for r in rows)
    return rows


def test_live_fan_in_numbers_each_topic(spark, tables, tmp_path):
    """Interleaved batches of three tables, one far larger, over several runs: every topic counts 0, 1, 2 .. on its own."""
    for name in ("a", "b", "c"):
        tables.create(name, SHAPE)
    out, sizes = str(tmp_path / "out"), {"a": 0, "b": 0, "c": 0}
    for run, more in enumerate([{"a": 500, "b": 3}, {"b": 4, "c": 1}, {}, {"a": 2, "b": 1, "c": 5}]):
        for name, n in more.items():
            rows = keyed(spark, sizes[name], sizes[name] + n).repartition(4)
            tables.write(tables.state(name), rows, f"run-{run}")
            sizes[name] += n
        feed = stream_tables(tables, list(sizes), "f.", [1, 2, 3], max_files_per_trigger=2)
        write_feed(feed, out, checkpoint=str(tmp_path / "checkpoint")).awaitTermination()
        rows = published(spark, out)
        for name, n in sizes.items():
            own = [r for r in rows if r.topic == f"f.{name}"]
            assert sorted(r.offset for r in own) == list(range(n))
            assert sorted(json.loads(r.value)["k"] for r in own) == list(range(n))


def test_feed_replay_after_a_crash(spark, tmp_path, monkeypatch):
    """A batch whose numbers were never written is published anew, in the same place; a complete one is left alone."""
    source, out, checkpoint = (str(tmp_path / n) for n in ("in", "out", "checkpoint"))
    keyed(spark, 0, 4).coalesce(1).write.parquet(source)
    feed = lambda: stream_feed(spark, source, SHAPE, "t")
    write_feed(feed(), out, checkpoint=checkpoint).awaitTermination()
    keyed(spark, 4, 9).coalesce(1).write.mode("append").parquet(source)
    real = run_module.write_topics

    def dies(df, path, mode):
        real(df, path, mode)
        raise OSError("lost")

    monkeypatch.setattr(run_module, "write_topics", dies)
    with pytest.raises(Exception, match="lost"):
        write_feed(feed(), out, checkpoint=checkpoint).awaitTermination()
    monkeypatch.setattr(run_module, "write_topics", real)
    write_feed(feed(), out, checkpoint=checkpoint).awaitTermination()
    assert sorted((r.offset, json.loads(r.value)["k"]) for r in published(spark, out)) == [(k, k) for k in range(9)]
    assert not [n for n in files.list_names(spark, files.shared_folder(spark)) if n.startswith("feed-")]


@pytest.mark.parametrize("vacuumed", [False, True])
def test_feed_passes_over_compaction(spark, tables, tmp_path, vacuumed):
    """Rows written before compaction and not yet fed still come out, rows fed before do not come again."""
    state = tables.create("t", SHAPE, primary_key=["k"])
    out, checkpoint = str(tmp_path / "out"), str(tmp_path / "checkpoint")
    for n in range(3):
        tables.write(state, keyed(spark, n * 10, n * 10 + 10), f"b{n}", ["k"], "upsert")
        if n == 1:
            tables.compact("t")
        write_feed(stream_table(tables, "t"), out, checkpoint=checkpoint).awaitTermination()
        if vacuumed:
            tables.vacuum("t")
    assert sorted(json.loads(r.value)["k"] for r in published(spark, out)) == list(range(30))
    assert tables.read("t").count() == 30


def test_feed_of_chosen_modes(spark, tables, tmp_path):
    state = tables.create("t", SHAPE, primary_key=["k"])
    tables.write(state, keyed(spark, 0, 5), "a", ["k"], "insert_if_absent")
    tables.write(state, keyed(spark, 3, 9), "b", ["k"], "upsert")
    query = inserted_rows(tables, "t", ["insert_if_absent"]).writeStream.format("memory").queryName("chosen").trigger(availableNow=True).start()
    query.awaitTermination()
    assert sorted(r.k for r in spark.table("chosen").collect()) == list(range(5))


def test_numbers_by_value_move_no_rows(spark, tmp_path):
    path = str(tmp_path / "rows")
    rows = spark.range(3000).selectExpr("concat('t', if(id % 3 = 0, id % 7, 1)) AS topic", "id")
    rows.repartition(5).write.option("maxRecordsPerFile", 100).partitionBy("topic").parquet(path)
    held = spark.read.schema("id bigint, topic string").parquet(path)
    starts = spark.createDataFrame([("t1", 50), ("gone", 7)], "topic string, next bigint")
    numbered = number_by(held, "topic", starts)
    found = {}
    for r in numbered.collect():
        found.setdefault(r.topic, []).append(r.sequence)
    plan = numbered._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert "BroadcastHashJoin [__file" in plan and "hashpartitioning(__file" not in plan
    assert len(found) == 7 and sum(map(len, found.values())) == 3000
    for topic, own in found.items():
        first = 50 if topic == "t1" else 0
        assert sorted(own) == list(range(first, first + len(own)))


def test_registry_bodies_and_ids(spark, tables):
    shape = T.StructType([column("a", T.LongType())])
    bodies = [b'\x00\x00\x00\x00\x07{"a":1}', b"\x00\x00\x00\x00\x07oops", b'\x00\x00\x00\x00\x08{"a":2}', b"\x01\x00", None]
    df = spark.createDataFrame([(n, b) for n, b in enumerate(bodies)], "o bigint, b binary")
    sent = to_envelope(df, topic="t", value=F.hex("b"), offset=F.col("o")).withColumn("value_bytes", F.unhex("value"))
    options = IngestOptions(value_format="registry", registry={7: RegisteredSchema("x.Rec", 1, shape, json_body(shape))})
    counts = ingest(sent, tables, options)
    assert counts["Rec"] == {"accepted": 1, "refused": 1}
    assert [r.a for r in tables.read("Rec").collect()] == [1]
    refused = {r.offset: r.reason for r in tables.read("_quarantine").collect()}
    assert refused == {1: "BAD_PAYLOAD", 2: "UNKNOWN_SCHEMA", 3: "BAD_WIRE_HEADER", 4: "BAD_WIRE_HEADER"}
    with pytest.raises(ValueError):
        IngestOptions(value_format="registry")


def test_job_name_of_another_checkpoint_is_refused(spark, tables, tmp_path):
    source = str(tmp_path / "in")
    df = spark.createDataFrame([(0, '{"a":1}')], "o bigint, v string")
    to_envelope(df, topic="t", value=F.col("v"), offset=F.col("o")).write.parquet(source)
    for name, fails in (("one", False), ("one", False), ("two", True)):
        stream = read_messages(spark, source, streaming=True)
        query = run_stream(stream, tables, IngestOptions(), job="j", checkpoint=str(tmp_path / name))
        if fails:
            with pytest.raises(Exception, match="belongs to"):
                query.awaitTermination()
        else:
            query.awaitTermination()
    assert tables.read("t").count() == 1
