"""The sink job: messages in, table rows and quarantined rows out."""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import DataFrame, Observation, Row, functions as F, types as T

from ..functions.types import UnsupportedSchema
from ..operators.cdc import unwrap_cdc
from ..operators.evolve import Version, Versions, evolve_versions
from ..operators.gate import version_gate
from ..operators.project import project, project_json
from ..operators.quarantine import ingest_metrics, quarantine_shape, require_key, stop_on_refusal
from ..operators.routing import check_overrides, route
from ..operators.schemas import UNSUPPORTED_TYPE, infer_schemas, schema_of_columns
from ..sinks.files import delete_folder, scratch_path
from ..sinks.tables import APPEND, StaleState, Tables, TableState
from ..sources.decode import (
    RegisteredSchema,
    decode_payload,
    decode_registered,
    decode_schema_json,
    open_registry,
    refused_columns,
    schema_from_message,
    schema_shape,
)
from ..sources.messages import ARRIVAL, subscribe

NO_TABLE = "NO_TABLE"
NO_FIELDS = "NO_FIELDS"
RESERVED_TABLE = "RESERVED_TABLE"

QUARANTINE = "_quarantine"

# Column of what a row's payload is decoded by.
_SHAPE = "__shape"

# Readers split a file between its row groups only, and decoding takes far longer than reading.
_STAGE_GROUP_BYTES = 8 << 20

VALUE_FORMATS = ("json", "schema_json", "struct", "registry")


@dataclass(frozen=True)
class IngestOptions:
    """Settings of a sink job.

    Values are `json` (objects without schema, change-data envelopes included), `schema_json`
    (`{"schema", "payload"}`), `struct` (a typed struct column, one schema per frame) or `registry` (framed
    bytes in `value_bytes`, with the ids of `registry`).

    Routed messages are kept while they are loaded: as files of the shared folder, one folder per
    destination, of which each table reads its own (`stage="files"`), or, for small batches, in executor
    storage (`stage="cache"`).  `max_destinations` is the most tables one batch may feed, `max_schemas` the most new
    versions, and shapes of payloads, that it may bring; beyond them nothing is loaded.
    """

    topics: Sequence[str] | None = None
    topics_regex: str | None = None
    overrides: Sequence[str] | None = None
    prefix: str = ""
    schema_name: str = ""
    single_table_per_topic: bool = False
    create_table: bool = True
    mode: str = "upsert"
    evolve: bool = False
    add_new_fields: bool = False
    relax_missing: bool = False
    value_format: str = "json"
    registry: Mapping[int, RegisteredSchema] | None = None
    infer: str = "first_record"
    typed_parse: bool = True
    on_error: str = "quarantine"
    stage: str = "files"
    max_destinations: int = 1000
    max_schemas: int = 1000
    retry_count: int = 1
    parallel_tables: int = 4

    def __post_init__(self) -> None:
        if self.topics is not None and self.topics_regex is not None:
            raise ValueError("give either topics or topics_regex")
        check_overrides(self.topics, self.topics_regex, self.overrides)
        for name, allowed in (
            ("mode", ("upsert", "insert_if_absent")),
            ("value_format", VALUE_FORMATS),
            ("infer", ("first_record", "all")),
            ("on_error", ("quarantine", "fail")),
            ("stage", ("cache", "files")),
        ):
            if getattr(self, name) not in allowed:
                raise ValueError(f"{name} is one of {allowed}, not {getattr(self, name)!r}")
        if (self.value_format == "registry") != (self.registry is not None):
            raise ValueError("a registry goes with value_format 'registry', and only with it")
        if self.retry_count < 1 or self.parallel_tables < 1:
            raise ValueError("retry_count and parallel_tables are at least 1")

    @property
    def matches_versions(self) -> bool:
        """Tables only evolve when one topic feeds one table this job may create."""
        return self.evolve and self.single_table_per_topic and self.create_table


@dataclass(frozen=True)
class _Arrival:
    """One schema version in the batch, with its columns or the reason it has none."""

    version: Version
    schema: T.StructType | None
    reason: str | None = None


def prepare(messages: DataFrame, options: IngestOptions) -> DataFrame:
    """Subscribe, decode what routing needs, unwrap and route: lazy, no shuffle."""
    df = messages
    if options.topics is not None or options.topics_regex is not None:
        df = subscribe(df, options.topics, options.topics_regex)
    schemaless = None
    if options.value_format == "schema_json":
        df = decode_schema_json(df)
        schemaless = F.lit(False)
    elif options.value_format == "registry":
        df = open_registry(df, options.registry)
        schemaless = F.lit(False)
    elif options.value_format == "json":
        df = unwrap_cdc(df)
        schemaless = F.lit(True)
    else:
        schemaless = F.lit(False)
    return route(
        df,
        topics=options.topics,
        topics_regex=options.topics_regex,
        overrides=options.overrides,
        prefix=options.prefix,
        schema_name=options.schema_name,
        single_table_per_topic=options.single_table_per_topic,
        schemaless=schemaless,
    )


def ingest(
    messages: DataFrame,
    tables: Tables,
    options: IngestOptions,
    *,
    job: str | None = None,
    batch_id: int = 0,
    source: str = "",
) -> dict[str, dict[str, int]]:
    """Run one batch and return accepted and refused counts per destination table.

    `job` and `batch_id` name the batch: running it again counts, but skips what is there already.  A job
    belongs to the `source` that used it first (a stream's id; batch calls have none), and any other is
    refused.  Without `job` the batch is a new one.
    """
    if job is not None:
        tables.claim(job, source)
    job = job or f"batch-{uuid.uuid4().hex}"
    return _Batch(messages, tables, options, job, batch_id).run()


class TooManyDestinations(RuntimeError):
    """A batch would feed more tables than its options allow."""


class TooManySchemas(RuntimeError):
    """A batch brings more schema versions, or shapes of payloads, than its options allow."""


def first_of_versions(usable: DataFrame, schema_key: str | None, known: DataFrame) -> DataFrame:
    """(dest_table, schema_version, first, schema) of each version that is not known, by its earliest message.

    `known` is (dest_table, schema_version); what is known is left out before anything leaves the executors.
    """
    arrival = F.struct(*ARRIVAL)
    text = F.min_by(F.col(schema_key), arrival) if schema_key else F.lit(None).cast("string")
    versions = usable.groupBy("dest_table", "schema_version").agg(F.min(arrival).alias("first"), text.alias("schema"))
    held = known.toDF("_table", "_version")
    same = (F.col("dest_table") == F.col("_table")) & F.col("schema_version").eqNullSafe(F.col("_version"))
    return versions.join(held, same, "left_anti")


class _Batch:
    def __init__(
        self, messages: DataFrame, tables: Tables, options: IngestOptions, job: str, batch_id: int
    ) -> None:
        self.tables = tables
        self.options = options
        self.job = job
        self.batch_id = batch_id
        self.label = f"{job}-{batch_id:012d}"
        # The columns that hold a version's schema, and that tell apart how payloads are decoded.
        self.schema_key = {"schema_json": "message_schema", "registry": "schema_id"}.get(options.value_format)
        self.shape_key = {"schema_json": _SHAPE, "registry": "schema_id"}.get(options.value_format)
        self.routed = prepare(messages, options)
        if self.shape_key == _SHAPE:
            self.routed = self.routed.withColumn(_SHAPE, schema_shape("message_schema"))

    def run(self) -> dict[str, dict[str, int]]:
        self.staged = None
        try:
            self._hold()
            return self._run()
        finally:
            self.routed.unpersist()
            if self.staged is not None:
                delete_folder(self.tables.spark, self.staged)

    def _hold(self) -> None:
        reserved = F.when((F.col("dest_table") == QUARANTINE) & F.col("reason").isNull(), F.lit(RESERVED_TABLE))
        self.routed = self.routed.withColumn("reason", F.coalesce("reason", reserved))
        if self.options.stage == "cache":
            self.routed = self.routed.persist(StorageLevel.MEMORY_AND_DISK)
            return
        spark = self.routed.sparkSession
        self.staged = scratch_path(spark, "routed")
        # Small destinations share tasks, large ones are split: neither many small files nor one large task.
        writer = self.routed.hint("rebalance", "dest_table").write.partitionBy("dest_table")
        writer.option("parquet.block.size", _STAGE_GROUP_BYTES).parquet(self.staged)
        names = self.routed.columns
        self.routed = spark.read.schema(self.routed.schema).parquet(self.staged).select(*names)

    def _profile(self) -> list[Row]:
        """Rows of each destination and reason.  Destinations are bounded, reasons are few."""
        most = self.options.max_destinations
        counts = self.routed.groupBy("dest_table").agg(F.count(F.lit(1)).alias("n"))
        sizes = counts.limit(most + 1).collect()
        if len(sizes) > most:
            listed = ", ".join(f"{r['dest_table']}: {r['n']}" for r in sizes[:20])
            raise TooManyDestinations(f"more than {most} destinations, among them {listed}")
        return self.routed.groupBy("dest_table", "reason").agg(F.count(F.lit(1)).alias("n")).collect()

    def _few(self, rows: DataFrame, what: str) -> list[Row]:
        """Rows for the driver, of which there may be only so many."""
        most = self.options.max_schemas
        found = rows.limit(most + 1).collect()
        if len(found) > most:
            tables = sorted({r["dest_table"] for r in found})[:20]
            raise TooManySchemas(f"more than {most} {what}, among others for {', '.join(tables)}")
        return found

    def _run(self) -> dict[str, dict[str, int]]:
        profile = self._profile()
        counts: dict[str, dict[str, int]] = {}
        early = 0
        names = sorted({r["dest_table"] for r in profile if r["reason"] is None})
        for row in profile:
            table = counts.setdefault(row["dest_table"] or "", {"accepted": 0, "refused": 0})
            if row["reason"] is not None:
                table["refused"] += row["n"]
                early += row["n"]
        usable = self.routed.where(F.col("reason").isNull())
        self.shapes: dict[str, list] = {}
        if self.shape_key is not None and names:
            shapes = usable.select("dest_table", F.col(self.shape_key).alias("shape")).distinct()
            for row in self._few(shapes, "shapes of payloads"):
                self.shapes.setdefault(row["dest_table"], []).append(row["shape"])
        if early and self.options.on_error == "fail":
            stop_on_refusal(self.routed).write.format("noop").mode("overwrite").save()
        if early:
            self._quarantine(None, self.routed.where(F.col("reason").isNotNull()))
        arrivals = self._arrivals(names, usable)
        with ThreadPoolExecutor(self.options.parallel_tables) as pool:
            outcomes = list(pool.map(lambda name: self._load(name, arrivals.get(name, [])), names))
        for name, (accepted, bad) in zip(names, outcomes):
            counts[name]["accepted"] += accepted
            counts[name]["refused"] += bad
        return counts

    def _quarantine(self, name: str | None, refused: DataFrame) -> None:
        """Store refused rows of a table (or of none) as a batch of their own; on a replay they are there."""
        rows = quarantine_shape(refused)
        state = self.tables.state(QUARANTINE)
        if state is None:
            try:
                state = self.tables.create_unchecked(QUARANTINE, rows.schema)
            except StaleState:
                state = self.tables.require(QUARANTINE)
        self.tables.write(state, rows, f"{self.label}~{name or ''}")

    def _arrivals(self, names: Sequence[str], usable: DataFrame) -> dict[str, list[_Arrival]]:
        """Versions of each table that the batch brings first, earliest first, with their columns."""
        found: dict[str, list[_Arrival]] = {}
        if self.options.value_format == "json":
            # Objects without schema all have version None, and never evolve a table.
            new = [n for n in names if self.tables.state(n) is None]
            if not self.options.evolve:
                found = {n: [_Arrival(None, T.StructType())] for n in names if n not in new}
            if new and self.options.create_table:
                rows = usable.where(
                    F.col("dest_table").isin(new)
                    & F.json_object_keys("value").isNotNull()
                    & F.try_parse_json("value").isNotNull()
                )
                columns: dict[str, list] = {}
                for table, *column in infer_schemas(rows, self.options.infer).collect():
                    columns.setdefault(table, []).append(tuple(column))
                for name in new:
                    found[name] = [_inferred(columns.get(name, []))]
            return found
        if not names:
            return found
        states = {n: self.tables.state(n) for n in names}
        known = [(n, v) for n, s in states.items() if s is not None for v in (*s.versions.known, *s.versions.blocked)]
        held = usable.sparkSession.createDataFrame(known, "dest_table string, schema_version int")
        new = self._few(first_of_versions(usable, self.schema_key, held), "new schema versions")
        for row in sorted(new, key=lambda r: tuple((v is not None, v) for v in r["first"])):
            version = row["schema_version"]
            if self.options.value_format == "struct":
                arrival = _checked(version, self.routed.schema["value"].dataType)
            elif self.options.value_format == "registry":
                arrival = _checked(version, self.options.registry[row["schema"]].columns)
            else:
                arrival = _declared(version, row["schema"])
            found.setdefault(row["dest_table"], []).append(arrival)
        return found

    def _load(self, name: str, arrivals: list[_Arrival]) -> tuple[int, int]:
        """Load one table; when it changed meanwhile, read its state again and start over."""
        for attempt in range(self.options.retry_count + 1):
            try:
                return self._load_once(name, arrivals)
            except StaleState:
                if attempt == self.options.retry_count:
                    raise
        raise AssertionError("unreachable")

    def _load_once(self, name: str, arrivals: list[_Arrival]) -> tuple[int, int]:
        state = self.tables.state(name)
        rows = self.routed.where((F.col("dest_table") == name) & F.col("reason").isNull())
        if state is None:
            state, refusal = self._create(name, arrivals)
            if state is None:
                bad = rows.withColumn("reason", F.lit(refusal))
                if self.options.on_error == "fail":
                    stop_on_refusal(bad).write.format("noop").mode("overwrite").save()
                self._quarantine(name, bad)
                return 0, bad.count()
        state, rejected = self._match(state, arrivals)
        gated = version_gate(rows, [(name, v) for v in state.versions.blocked])
        for version, reason in rejected.items():
            hit = F.col("reason").isNull() & F.col("schema_version").eqNullSafe(F.lit(version))
            gated = gated.withColumn("reason", F.when(hit, F.lit(reason)).otherwise(F.col("reason")))
        projected = require_key(self._project(gated, state), state.primary_key)
        watch = Observation(f"ingest-{uuid.uuid4().hex}")
        observed = projected.observe(watch, *ingest_metrics())
        if self.options.on_error == "fail":
            good = stop_on_refusal(observed)
        else:
            good = observed.where(F.col("reason").isNull())
        order = [F.col(c).alias(f"__arrival_{c}") for c in ARRIVAL]
        mode = self.options.mode if state.primary_key else APPEND
        if not self.tables.write(state, good.select("record.*", *order), self.label, [f"__arrival_{c}" for c in ARRIVAL], mode):
            # A replay: count again, write nothing.
            observed.write.format("noop").mode("overwrite").save()
        metrics = watch.get
        # Refused rows are a batch of their own; a replay after a crash in between writes what is missing.
        if metrics["refused"]:
            self._quarantine(name, projected.where(F.col("reason").isNotNull()))
        return metrics["accepted"], metrics["refused"]

    def _create(
        self, name: str, arrivals: list[_Arrival]
    ) -> tuple[TableState | None, str]:
        if not self.options.create_table:
            return None, NO_TABLE
        for arrival in arrivals:
            if arrival.schema is not None:
                versions = Versions().accept(arrival.version)
                return self.tables.create(name, arrival.schema, versions=versions), ""
        return None, arrivals[0].reason if arrivals else NO_FIELDS

    def _match(
        self, state: TableState, arrivals: list[_Arrival]
    ) -> tuple[TableState, dict[Version, str]]:
        """Evolve the table over the new versions; versions without usable columns are refused."""
        if self.options.evolve and not self.options.matches_versions:
            return state, {}
        usable = [(a.version, a.schema) for a in arrivals if a.schema is not None]
        rejected: dict[Version, str] = {}
        if self.options.matches_versions:
            rejected = {a.version: a.reason for a in arrivals if a.reason is not None}
        else:
            usable += [(a.version, T.StructType()) for a in arrivals if a.schema is None]
        plan = evolve_versions(
            state.schema,
            state.versions,
            usable,
            enabled=self.options.matches_versions,
            add_new_fields=self.options.add_new_fields,
            relax_missing=self.options.relax_missing,
        )
        return self.tables.alter(state, plan.schema, plan.versions), rejected

    def _project(self, rows: DataFrame, state: TableState) -> DataFrame:
        if self.options.value_format == "json":
            return project_json(rows, state.schema, typed_parse=self.options.typed_parse)
        if self.options.value_format == "struct":
            out = project(rows, state.schema, source="value")
            return out.withColumn("value", F.to_json("value"))
        return self._project_payloads(rows, state)

    def _project_payloads(self, rows: DataFrame, state: TableState) -> DataFrame:
        """Decode payloads by their own schema; one branch per shape of the table's payloads in the batch."""
        record = T.StructType([T.StructField(f.name, f.dataType) for f in state.schema.fields])
        out = rows.where(F.col("reason").isNotNull()).withColumns(
            {
                "record": F.lit(None).cast(record),
                "bad_column": F.lit(None).cast("string"),
                "bad_value": F.lit(None).cast("string"),
            }
        )
        out = out.drop("payload")
        for shape in sorted(self.shapes[state.name]):
            mine = rows.where(F.col("reason").isNull() & (F.col(self.shape_key) == shape))
            if self.options.value_format == "registry":
                opened, body = decode_registered(mine, self.options.registry[shape]), "body"
            else:
                opened, body = decode_payload(mine, schema_from_message(shape)), "payload"
            out = out.unionByName(project(opened, state.schema, source=body).drop(body))
        return out


def _inferred(columns: list) -> _Arrival:
    if not columns:
        return _Arrival(None, None, NO_FIELDS)
    try:
        return _Arrival(None, schema_of_columns(columns))
    except UnsupportedSchema:
        return _Arrival(None, None, UNSUPPORTED_TYPE)


def _declared(version: Version, text: str) -> _Arrival:
    try:
        schema = schema_from_message(text)
    except UnsupportedSchema:
        return _Arrival(version, None, NO_FIELDS)
    return _checked(version, schema)


def _checked(version: Version, schema: T.StructType) -> _Arrival:
    if refused_columns(schema):
        return _Arrival(version, None, UNSUPPORTED_TYPE)
    return _Arrival(version, schema)
