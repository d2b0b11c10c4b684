"""Destination tables of Spark's catalog, one partition per batch.

Tables live in one schema of the catalog, those of a namespace in a schema of their own; `spark.table` and SQL read them
like any other.  Spark writes, lists and alters them: `INSERT OVERWRITE` of a batch's own partition, so a batch that
failed half-way is replaced by its replay; `ALTER TABLE .. ADD COLUMNS` with defaults for rows written before; table
properties for what the catalog has no place for (the exact name, key, required columns, message versions).

Keyed tables are bucketed by their key and only ever added to: reading takes one row per key, of the newest upsert or else
of the oldest insert, bucket by bucket and without an exchange.
"""

from __future__ import annotations

import hashlib
import json
import re
import uuid
from collections.abc import Sequence
from dataclasses import dataclass, replace
from urllib.parse import quote

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from ..functions.types import UnsupportedSchema, check_flat, check_names
from ..operators.evolve import Versions
from ..operators.merge import one_per_key
from . import files

# Partition column: the batch a row came with.
_BATCH = "__batch"
_NAMESPACE = ".db"
_STATE = "streamloader.state"
_SOURCE = "streamloader.source"
# Catalogs bound the length of a property.
_PROPERTY_LENGTH = 3500

APPEND, UPSERT, INSERT = "append", "upsert", "insert_if_absent"
COMPACTED = "~compacted-"
# Mode and label of the batch that a file belongs to, in the file's path.
BATCH_FOLDER = rf"/{_BATCH}=\d+[.](\w+)[.]([^/]*)/"
BUCKETS = 16


def _folder(name: str) -> str:
    """A name as one folder name: no separators, no dot-only names, nothing hidden."""
    escaped = quote(name, safe="")
    return escaped.replace(".", "%2E") if escaped.strip(".") == "" or escaped[0] == "." else escaped


def _word(name: str) -> str:
    """A name as the catalog takes it.  Catalogs ignore case and signs, so a name that has them gets its hash as well."""
    plain = re.sub(r"[^a-z0-9_]", "_", name.lower())
    return plain if plain == name else f"{plain}_{hashlib.md5(name.encode()).hexdigest()[:8]}"


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _text(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


class StaleState(RuntimeError):
    """The table changed between reading its state and writing the next one."""


class NoSuchTable(LookupError):
    """The destination table does not exist and may not be created."""


class JobInUse(RuntimeError):
    """A job name belongs to another stream, whose batches carry the same numbers."""


@dataclass(frozen=True)
class TableState:
    name: str
    schema: T.StructType
    primary_key: tuple[str, ...] = ()
    versions: Versions = Versions()
    revision: int = 0

    def to_properties(self) -> dict[str, str]:
        """What the catalog does not keep: its columns are nullable and its properties are short texts."""
        text = json.dumps(
            {
                "name": self.name,
                "primary_key": self.primary_key,
                "known": self.versions.known,
                "blocked": self.versions.blocked,
                "revision": self.revision,
                "required": [f.name for f in self.schema.fields if not f.nullable],
                "metadata": {f.name: f.metadata for f in self.schema.fields if f.metadata},
            }
        )
        parts = [text[k : k + _PROPERTY_LENGTH] for k in range(0, len(text), _PROPERTY_LENGTH)]
        return {_STATE: str(len(parts)), **{f"{_STATE}.{k}": part for k, part in enumerate(parts)}}

    @staticmethod
    def of(properties: dict[str, str], columns: T.StructType) -> TableState:
        doc = json.loads("".join(properties[f"{_STATE}.{k}"] for k in range(int(properties[_STATE]))))
        fields = [
            T.StructField(f.name, f.dataType, f.name not in doc["required"], doc["metadata"].get(f.name))
            for f in columns.fields
            if f.name != _BATCH
        ]
        return TableState(
            doc["name"],
            T.StructType(fields),
            tuple(doc["primary_key"]),
            Versions(tuple(doc["known"]), tuple(doc["blocked"])),
            doc["revision"],
        )


@dataclass(frozen=True, order=True)
class BatchName:
    """Number, mode and label of a batch, as its partition is named.  Batches of tables without key need no number."""

    number: int
    mode: str
    label: str

    @property
    def value(self) -> str:
        return f"{self.number:012d}.{self.mode}.{self.label}"

    @staticmethod
    def of(value: str) -> BatchName:
        number, mode, label = value.split(".", 2)
        return BatchName(int(number), mode, label)


def _label(label: str) -> str:
    """A label without signs that folder names escape."""
    return re.sub(r"[^A-Za-z0-9_.-]", lambda m: f"~{ord(m.group()):x}~", label)


class Tables:
    """The tables under one root folder, in the catalog's schema `database` and, for a namespace n, `database`_n.

    Without `database` the schema is named after the root.  Jobs that go on in another session need a catalog that
    outlives the session.
    """

    def __init__(self, spark: SparkSession, root: str, database: str | None = None, buckets: int = BUCKETS) -> None:
        self.spark = spark
        self.root = root.rstrip("/")
        self.database = database or _word(f"tables_{hashlib.md5(self.root.encode()).hexdigest()[:12]}")
        self.buckets = buckets
        self._created: set[str] = set()

    def path(self, name: str) -> str:
        """Folder of a table.  Names come from messages, so they are escaped to stay under the root."""
        namespace, dot, table = name.partition(".")
        if not dot:
            return f"{self.root}/{_folder(name)}"
        return f"{self.root}/{_folder(namespace)}{_NAMESPACE}/{_folder(table)}"

    def _schema_name(self, name: str) -> str:
        namespace, dot, _ = name.partition(".")
        return f"{self.database}_{_word(namespace)}" if dot else self.database

    def catalog_name(self, name: str) -> str:
        """The table's name for `spark.table` and SQL."""
        namespace, dot, table = name.partition(".")
        return f"{_quoted(self._schema_name(name))}.{_quoted(_word(table if dot else namespace))}"

    def _properties(self, table: str) -> dict[str, str]:
        return {r["key"]: r["value"] for r in self.spark.sql(f"SHOW TBLPROPERTIES {table}").collect()}

    def state(self, name: str) -> TableState | None:
        table = self.catalog_name(name)
        try:
            properties = self._properties(table)
        except AnalysisException as error:
            if error.getCondition() in ("TABLE_OR_VIEW_NOT_FOUND", "SCHEMA_NOT_FOUND"):
                return None
            raise
        # Another session may have altered the table since this one read it.
        self.spark.catalog.refreshTable(table)
        return TableState.of(properties, self.spark.table(table).schema)

    def require(self, name: str) -> TableState:
        state = self.state(name)
        if state is None:
            raise NoSuchTable(f"table {name} does not exist")
        return state

    def names(self) -> list[str]:
        found = []
        for db in self.spark.catalog.listDatabases(f"{self.database}*"):
            if db.name == self.database or db.name.startswith(f"{self.database}_"):
                for table in self.spark.catalog.listTables(db.name):
                    # The session's temporary views are listed with every schema.
                    if table.tableType != "VIEW" and not table.isTemporary:
                        properties = self._properties(f"{_quoted(db.name)}.{_quoted(table.name)}")
                        if _STATE in properties:
                            found.append(TableState.of(properties, T.StructType()).name)
        return found

    def create(
        self,
        name: str,
        schema: T.StructType,
        primary_key: Sequence[str] = (),
        versions: Versions = Versions(),
    ) -> TableState:
        """Create a table, and its namespace with it."""
        check_flat(schema)
        return self._create(TableState(name, schema, tuple(primary_key), versions))

    def create_unchecked(self, name: str, schema: T.StructType) -> TableState:
        """A table of the library's own, whose columns need not be those of messages."""
        return self._create(TableState(name, schema))

    def _create(self, state: TableState) -> TableState:
        _check_columns(state.schema)
        missing = set(state.primary_key) - set(state.schema.names)
        if missing:
            raise ValueError(f"primary key columns not in schema: {sorted(missing)}")
        columns = ", ".join(f"{_quoted(f.name)} {f.dataType.simpleString()}" for f in state.schema.fields)
        key = ", ".join(map(_quoted, state.primary_key))
        buckets = f"CLUSTERED BY ({key}) SORTED BY ({key}) INTO {self.buckets} BUCKETS" if key else ""
        self._create_schema(state.name)
        self._create_table(
            state.name,
            f"({columns}, {_BATCH} STRING) USING parquet PARTITIONED BY ({_BATCH}) {buckets} LOCATION {_text(self.data_path(state.name))}",
            state.to_properties(),
        )
        return state

    def _create_schema(self, name: str) -> None:
        schema, folder = self._schema_name(name), self.path(name).rsplit("/", 1)[0]
        if schema not in self._created:
            self.spark.sql(f"CREATE SCHEMA IF NOT EXISTS {_quoted(schema)} LOCATION {_text(folder)}")
            self._created.add(schema)

    def _create_table(self, name: str, definition: str, properties: dict[str, str]) -> None:
        try:
            self.spark.sql(f"CREATE TABLE {self.catalog_name(name)} {definition} TBLPROPERTIES ({_listed(properties)})")
        except AnalysisException as error:
            if error.getCondition() == "TABLE_OR_VIEW_ALREADY_EXISTS":
                raise StaleState(f"table {name} was created meanwhile") from error
            raise

    def data_path(self, name: str) -> str:
        return f"{self.path(name)}/data"

    def check_current(self, state: TableState) -> None:
        """Fail when the state is not the table's latest one any more."""
        properties = self._properties(self.catalog_name(state.name))
        if TableState.of(properties, T.StructType()).revision != state.revision:
            raise StaleState(f"table {state.name} changed meanwhile")

    def alter(self, state: TableState, schema: T.StructType, versions: Versions) -> TableState:
        """Add columns, relax required ones, record versions.  Files stay as they are and read with nulls or defaults."""
        if schema == state.schema and versions == state.versions:
            return state
        _check_columns(schema)
        self.check_current(state)
        added = [f for f in schema.fields if f.name not in state.schema.names]
        table = self.catalog_name(state.name)
        if added:
            try:
                self.spark.sql(f"ALTER TABLE {table} ADD COLUMNS ({', '.join(map(_added, added))})")
            except AnalysisException as error:
                raise StaleState(f"table {state.name} changed meanwhile") from error
        new = replace(state, schema=schema, versions=versions, revision=state.revision + 1)
        self.spark.sql(f"ALTER TABLE {table} SET TBLPROPERTIES ({_listed(new.to_properties())})")
        return new

    def claim(self, job: str, source: str) -> None:
        """Bind a job name to the stream (or caller) it numbers batches of; another one may not use it."""
        name = f"_job_{_word(job)}"
        self._create_schema(name)
        folder = f"{self.root}/_jobs/{_folder(job)}"
        try:
            self._create_table(name, f"(source STRING) USING parquet LOCATION {_text(folder)}", {_SOURCE: source or " "})
        except StaleState:
            owner = self._properties(self.catalog_name(name))[_SOURCE].strip()
            if owner != source:
                raise JobInUse(f"job {job} belongs to {owner or 'batch calls'}, not to {source or 'batch calls'}") from None

    def batches(self, name: str) -> list[BatchName]:
        """The batches of a table, in order."""
        found = self.spark.sql(f"SHOW PARTITIONS {self.catalog_name(name)}").collect()
        return sorted(BatchName.of(r["partition"].partition("=")[2]) for r in found)

    def _partition(self, state: TableState, label: str, mode: str) -> BatchName | None:
        """The partition of a new batch, or None where one of that label is there."""
        label = _label(label)
        if not state.primary_key:
            new = BatchName(0, APPEND, label)
            spec = f"PARTITION ({_BATCH} = {_text(new.value)})"
            return new if not self.spark.sql(f"SHOW PARTITIONS {self.catalog_name(state.name)} {spec}").head(1) else None
        known = self.batches(state.name)
        if any(b.label == label for b in known):
            return None
        return BatchName(1 + max((b.number for b in known), default=0), mode, label)

    def read(self, name: str) -> DataFrame:
        """All rows, or of a keyed table one row per key."""
        state = self.require(name)
        table = self.catalog_name(name)
        rows = self.spark.table(table)
        if state.primary_key:
            whole = [b for b in self.batches(name) if b.label.startswith(COMPACTED)]
            if whole:
                # What was compacted is not read any more.
                rows = rows.where(F.col(_BATCH) >= max(whole).value)
            rows = one_per_key(rows, state.primary_key, [_rank(), _BATCH], "last")
        return rows.select(*[F.col(_quoted(c)) for c in state.schema.names])

    def write(
        self, state: TableState, rows: DataFrame, label: str, order: Sequence[Column | str] = (), mode: str = APPEND
    ) -> bool:
        """Write a batch into its own partition; returns False, without reading the rows, when it is there already.

        Rows of a keyed table are reduced to one per key and written by bucket, one file each.
        """
        if state.primary_key and mode not in (UPSERT, INSERT):
            raise ValueError(f"mode is {UPSERT!r} or {INSERT!r}, not {mode!r}")
        self.check_current(state)
        batch = self._partition(state, label, mode)
        if batch is None:
            return False
        if state.primary_key:
            rows = one_per_key(rows, state.primary_key, order, "last" if mode == UPSERT else "first")
        self._insert("OVERWRITE TABLE", state, rows, batch)
        return True

    def _insert(self, verb: str, state: TableState, rows: DataFrame, batch: BatchName) -> None:
        names = [_quoted(c) for c in state.schema.names]
        rows = rows.select(*[F.col(c) for c in names])
        if state.primary_key:
            # Rows are one per key by now, so no key can make a bucket's task large.
            rows = rows.repartition(self.buckets, *[F.col(_quoted(c)) for c in state.primary_key])
        rows.sparkSession.sql(
            f"INSERT {verb} {self.catalog_name(state.name)} PARTITION ({_BATCH} = {_text(batch.value)}) "
            f"({', '.join(names)}) SELECT * FROM {{rows}}",
            rows=rows,
        )

    def compact(self, name: str) -> None:
        """Rewrite a keyed table into one batch, from which reading starts.  Run it while no batch is being written.

        The batches before stay, for feeds that have not read them yet, until `vacuum`.
        """
        state = self.require(name)
        known = self.batches(name)
        if state.primary_key and known and not known[-1].label.startswith(COMPACTED):
            # Its name is new, so there is nothing to overwrite.
            self._insert("INTO", state, self.read(name), BatchName(known[-1].number, UPSERT, f"{COMPACTED}{uuid.uuid4().hex}"))

    def vacuum(self, name: str) -> None:
        """Delete the files of compacted batches.  Their partitions stay, empty, as the record of their labels."""
        known = self.batches(name)
        whole = [b for b in known if b.label.startswith(COMPACTED)]
        for batch in known:
            if whole and batch < max(whole):
                files.empty_folder(self.spark, f"{self.data_path(name)}/{_BATCH}={batch.value}")

    def create_views(self) -> list[str]:
        """A view `<table>_current` in the catalog for every table, without the batch column and with one row per key."""
        views = []
        for name in self.names():
            state = self.require(name)
            table = self.catalog_name(name)
            view = f"{table[:-1]}_current`"
            columns = ", ".join(map(_quoted, state.schema.names))
            rows = f"(SELECT * FROM {table})"
            if state.primary_key:
                key = ", ".join(map(_quoted, state.primary_key))
                rows = (
                    f"(SELECT *, row_number() OVER (PARTITION BY {key} ORDER BY {_RANK} DESC, {_BATCH} DESC) AS __place FROM {table} "
                    f"WHERE {_BATCH} >= (SELECT coalesce(max({_BATCH}), '') FROM {table} WHERE {_BATCH} LIKE '%.{COMPACTED}%')) WHERE __place = 1"
                )
            self.spark.sql(f"CREATE OR REPLACE VIEW {view} AS SELECT {columns} FROM {rows}")
            views.append(view)
        return views


# Upserts count from the newest down; inserts only where there are none, from the oldest up.
_RANK = f"if(split_part({_BATCH}, '.', 2) = '{INSERT}', -1L, 1L) * cast(split_part({_BATCH}, '.', 1) AS bigint)"


def _rank() -> Column:
    return F.expr(_RANK)


def _listed(properties: dict[str, str]) -> str:
    return ", ".join(f"{_text(key)} = {_text(value)}" for key, value in properties.items())


def _added(f: T.StructField) -> str:
    """An added column; rows written before read its default."""
    default = (f.metadata or {}).get("default")
    kind = f.dataType.simpleString()
    return f"{_quoted(f.name)} {kind}" + (f" DEFAULT CAST({_text(default)} AS {kind})" if default is not None else "")


def _check_columns(schema: T.StructType) -> None:
    check_names(schema)
    if _BATCH in (name.lower() for name in schema.names):
        raise UnsupportedSchema(f"{_BATCH} is the name of the batch column")
