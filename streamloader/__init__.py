"""Stream-to-table and table-to-stream loading on Spark: see README.md for a tour."""

from .functions.types import UnsupportedSchema, column
from .operators.cdc import unwrap_cdc
from .operators.evolve import Evolution, Versions, evolve, evolve_versions, reshape
from .operators.gate import version_gate
from .operators.merge import merge, one_per_key
from .operators.project import field_map, project, project_json
from .operators.quarantine import ingest_counts, require_key, split
from .operators.routing import route
from .operators.schemas import conform, infer_schemas, width_classes
from .plans.ingest import IngestOptions, ingest
from .sinks.tables import JobInUse, NoSuchTable, StaleState, Tables
from .sources.decode import (
    RegisteredSchema,
    avro_body,
    decode_payload,
    decode_schema_json,
    json_body,
    message_schema,
    schema_from_message,
    wire_header,
)
from .sources.feed import change_feed, fan_in, inserted_rows, stream_feed, stream_table, stream_tables, with_schema, write_kafka, write_topics
from .sources.messages import (
    ENVELOPE,
    kafka_messages,
    read_messages,
    subscribe,
    to_envelope,
)
from .streaming.run import StreamCounts, first_wins, merge_stream, observe_counts, run_stream, write_feed

__all__ = [
    "ENVELOPE",
    "Evolution",
    "IngestOptions",
    "JobInUse",
    "NoSuchTable",
    "RegisteredSchema",
    "StaleState",
    "StreamCounts",
    "Tables",
    "UnsupportedSchema",
    "Versions",
    "avro_body",
    "change_feed",
    "column",
    "conform",
    "decode_payload",
    "decode_schema_json",
    "evolve",
    "evolve_versions",
    "fan_in",
    "field_map",
    "first_wins",
    "infer_schemas",
    "inserted_rows",
    "ingest",
    "ingest_counts",
    "json_body",
    "kafka_messages",
    "merge",
    "merge_stream",
    "message_schema",
    "observe_counts",
    "one_per_key",
    "project",
    "project_json",
    "read_messages",
    "require_key",
    "reshape",
    "route",
    "run_stream",
    "schema_from_message",
    "split",
    "stream_feed",
    "stream_table",
    "stream_tables",
    "subscribe",
    "to_envelope",
    "unwrap_cdc",
    "version_gate",
    "width_classes",
    "wire_header",
    "with_schema",
    "write_feed",
    "write_kafka",
    "write_topics",
]
