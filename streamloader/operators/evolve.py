"""Table schemas over message versions: what each new version adds, relaxes or is refused for."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field, replace

from pyspark.sql import DataFrame, functions as F, types as T

from ..functions.types import check_names, column, properties, relaxed


@dataclass(frozen=True)
class Evolution:
    """Outcome of matching one message version against a table."""

    schema: T.StructType
    added: tuple[str, ...] = ()
    relaxed: tuple[str, ...] = ()
    ignored: tuple[str, ...] = ()
    missing: tuple[str, ...] = ()

    @property
    def blocked(self) -> bool:
        """A required column is absent from the version and may not be relaxed."""
        return bool(self.missing)

    @property
    def changed(self) -> bool:
        return bool(self.added or self.relaxed)


def evolve(
    table: T.StructType,
    incoming: T.StructType,
    *,
    add_new_fields: bool = False,
    relax_missing: bool = False,
) -> Evolution:
    """Match by exact column name; columns are never dropped, renamed or retyped.

    New fields become nullable columns and carry a default only when it is text.  A version that
    ends up blocked still adds its columns, so the answer does not depend on which check ran first.
    """
    have, sent = set(table.names), set(incoming.names)
    extra = [f for f in incoming.fields if f.name not in have]
    lacking = {f.name for f in table.fields if not f.nullable and f.name not in sent}
    fields = [
        relaxed(f) if relax_missing and f.name in lacking else f for f in table.fields
    ]
    if add_new_fields:
        fields += [
            column(f.name, f.dataType, True, sorted(properties(f)), (f.metadata or {}).get("default"))
            for f in extra
        ]
    schema = T.StructType(fields)
    check_names(schema)
    order = [f.name for f in table.fields if f.name in lacking]
    return Evolution(
        schema,
        added=tuple(f.name for f in extra) if add_new_fields else (),
        relaxed=tuple(order) if relax_missing else (),
        ignored=() if add_new_fields else tuple(f.name for f in extra),
        missing=() if relax_missing else tuple(order),
    )


Version = int | None


@dataclass(frozen=True)
class Versions:
    """Schema versions a table has accepted and refused."""

    known: tuple[Version, ...] = ()
    blocked: tuple[Version, ...] = ()

    def accept(self, version: Version) -> Versions:
        if version in self.known:
            return self
        return replace(self, known=(*self.known, version))

    def block(self, version: Version) -> Versions:
        known = tuple(v for v in self.known if v != version)
        blocked = self.blocked if version in self.blocked else (*self.blocked, version)
        return Versions(known, blocked)


@dataclass(frozen=True)
class Plan:
    """A table's schema and versions after a batch, with one evolution per newly matched version."""

    schema: T.StructType
    versions: Versions
    steps: dict[Version, Evolution] = field(default_factory=dict)


def evolve_versions(
    table: T.StructType,
    versions: Versions,
    arriving: Sequence[tuple[Version, T.StructType]],
    *,
    enabled: bool,
    add_new_fields: bool = False,
    relax_missing: bool = False,
) -> Plan:
    """Run the arriving versions against the table in order of first arrival.

    With evolution off, a table with recorded versions refuses any other.  With it on, the first
    version recorded is taken as it is, and later ones are matched once.
    """
    steps: dict[Version, Evolution] = {}
    for version, incoming in arriving:
        if version in versions.known or version in versions.blocked:
            continue
        if not enabled:
            if versions.known:
                versions = versions.block(version)
            continue
        if not versions.known and not versions.blocked:
            versions = versions.accept(version)
            continue
        step = evolve(table, incoming, add_new_fields=add_new_fields, relax_missing=relax_missing)
        steps[version] = step
        table = step.schema
        versions = versions.block(version) if step.blocked else versions.accept(version)
    return Plan(table, versions, steps)


def reshape(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Rows of an older shape as the evolved table reads them: added columns null or their default."""
    have = set(df.columns)
    columns = []
    for f in schema.fields:
        if f.name in have:
            columns.append(F.col(f"`{f.name}`"))
        else:
            default = (f.metadata or {}).get("default")
            columns.append(F.lit(default).cast(f.dataType).alias(f.name))
    return df.select(*columns)
