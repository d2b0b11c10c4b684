"""The same results as plain SQL over the driver's tables, in DuckDB's dialect.

Each statement is written from the rule, not from the Spark plan.
"""

from __future__ import annotations

_CENTS = "cast(sum(cast(round(value * 100) as bigint)) as bigint)"

_LATEST = """
    SELECT user_id, arg_max(event_id, ts) AS event_id, arg_max(event_type, ts) AS event_type,
           arg_max(value, ts) AS value
    FROM events GROUP BY user_id
"""

# First message of each kind of record, with its fields in message order.
_MIXED = """
    WITH messages AS (
      SELECT 'orders' AS dest_table, o_orderkey AS place, json_object(
          'o_orderkey', o_orderkey, 'o_state', nullif(o_orderstatus, 'P'),
          'o_totalprice', o_totalprice, 'o_custkey', o_custkey) AS body FROM orders
      UNION ALL
      SELECT 'customer', c_custkey, json_object(
          'c_name', c_name, 'c_custkey', c_custkey, 'c_acctbal', c_acctbal) FROM customer
      UNION ALL
      SELECT 'part', p_partkey, json_object(
          'p_partkey', p_partkey, 'p_size', p_size, 'p_brand', p_brand) FROM part
    )
"""

_KIND = """
    CASE WHEN tag IN ('BIGINT', 'UBIGINT') THEN 'bigint' WHEN tag = 'DOUBLE' THEN 'double'
         WHEN tag = 'VARCHAR' THEN 'string' ELSE 'UNSUPPORTED_TYPE' END
"""

_CHANGES = """
    SELECT o_custkey AS c_custkey, 'by order ' || {pick}(o_orderkey) AS c_name,
           {arg}(o_totalprice, o_orderkey) AS c_acctbal
    FROM orders GROUP BY o_custkey
"""

_ADDED = """
    SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice,
           CASE WHEN o_orderstatus <> 'F' THEN o_orderpriority END AS o_orderpriority,
           CASE WHEN o_orderstatus <> 'F' THEN 'store' ELSE 'web' END AS o_channel
    FROM orders
"""

_NARROWED = """
    SELECT l_orderkey,
           cast(xor(cast((l_orderkey * 1000003) & 4294967295 AS bigint), 2147483648) - 2147483648
                AS integer) AS wrapped,
           cast(least(trunc(l_extendedprice * 40000), 2147483647) AS integer) AS saturated,
           cast(trunc(l_extendedprice) AS bigint) AS truncated,
           cast(l_linenumber AS double) AS widened,
           cast(cast(l_extendedprice AS float) AS double) AS narrowed
    FROM lineitem
"""

_WIDTH = """
    SELECT '{table}' AS "table", '{column}' AS "column", max(length({column})) AS max_length
    FROM {table}
"""

_WIDTH_COLUMNS = (
    ("part", "p_name"),
    ("part", "p_brand"),
    ("part", "p_type"),
    ("customer", "c_name"),
    ("customer", "c_mktsegment"),
    ("orders", "o_orderstatus"),
    ("orders", "o_orderpriority"),
    ("documents", "text"),
    ("documents", "lang"),
    ("documents", "source"),
    ("pages", "url"),
    ("pages", "html"),
)

ORACLES: dict[str, str] = {
    "q01_route_topic": f"""
        SELECT 'stage.raw_app_events_' || event_type AS dest_table, count(*) AS n,
               {_CENTS} AS value_cents
        FROM events GROUP BY event_type
    """,
    "q01w_create_write": f"""
        SELECT 'shop.app_events_' || event_type AS dest_table, count(*) AS n,
               {_CENTS} AS value_cents, cast(sum(user_id) AS bigint) AS user_ids
        FROM events GROUP BY event_type
    """,
    "q02_route_schema": f"""
        SELECT 't_' || CASE WHEN event_type IN ('click', 'view', 'purchase') THEN event_type
                            WHEN event_type = 'signup' THEN 'app_events'
                            ELSE 'events' END AS dest_table,
               count(*) AS n, {_CENTS} AS value_cents
        FROM events GROUP BY 1
    """,
    "q03_route_override": """
        SELECT CASE o_orderpriority WHEN '1-URGENT' THEN 'hot.urgent' WHEN '2-HIGH' THEN 'sales.high'
                    WHEN '3-MEDIUM' THEN 'sales. medium' WHEN '4-NOT SPECIFIED' THEN 'sales.other '
               END AS dest_table,
               CASE WHEN o_orderpriority = '5-LOW' THEN 'NO_OVERRIDE' END AS reason,
               count(*) AS n
        FROM orders GROUP BY 1, 2
    """,
    "q04_decode_json": """
        SELECT 'app.events.' || event_type AS topic, count(json_extract(props, '$.k')) AS n,
               cast(sum(cast(json_extract(props, '$.k') AS bigint)) AS bigint) AS sum_k,
               cast(0 AS bigint) AS n_absent
        FROM events GROUP BY event_type
    """,
    "q04b_decode_envelope": """
        SELECT 'com.shop.Order' AS schema_name, 2 AS schema_version, o_orderkey, o_custkey,
               o_orderstatus, o_totalprice
        FROM orders
    """,
    "q04c_decode_texts": """
        SELECT doc_id, md5(text) AS text_md5, cast(n_chars AS integer) AS n_chars FROM documents
    """,
    "q05_cdc_unwrap": """
        SELECT o_orderpriority AS topic,
               CASE WHEN o_orderpriority <> '5-LOW' AND o_orderstatus NOT IN ('O', 'F')
                    THEN 'CDC_NO_AFTER' END AS reason,
               count(*) AS n,
               CASE WHEN reason IS NULL THEN cast(sum(o_orderkey) AS bigint) END AS order_keys,
               CASE WHEN reason IS NULL
                    THEN cast(sum(cast(round(o_totalprice * 100) AS bigint)) AS bigint) END AS price_cents
        FROM orders GROUP BY 1, 2
    """,
    "q06_infer_first": f"""
        {_MIXED}, firsts AS (
          SELECT dest_table, arg_min(body, place) AS body FROM messages GROUP BY dest_table
        ), fields AS (
          SELECT dest_table, body, unnest(json_keys(body)) AS name,
                 unnest(range(1, len(json_keys(body)) + 1)) AS place FROM firsts
        ), typed AS (
          SELECT dest_table, name, place, json_type(body, '$.' || name) AS tag FROM fields
        )
        SELECT dest_table,
               cast(row_number() OVER (PARTITION BY dest_table ORDER BY place) AS integer) AS "position",
               name AS "column", {_KIND} AS type
        FROM typed WHERE tag <> 'NULL'
    """,
    "q06a_infer_all": f"""
        {_MIXED}, fields AS (
          SELECT dest_table, body, unnest(json_keys(body)) AS name FROM messages
        ), typed AS (
          SELECT dest_table, name, json_type(body, '$.' || name) AS tag FROM fields
        ), merged AS (
          SELECT dest_table, name, {_KIND} AS type FROM typed WHERE tag <> 'NULL' GROUP BY ALL
        )
        SELECT dest_table,
               cast(row_number() OVER (PARTITION BY dest_table ORDER BY name) AS integer) AS "position",
               name AS "column", max(type) AS type
        FROM merged GROUP BY dest_table, name
    """,
    "q06b_conform_message": """
        SELECT 'embeddings' AS "table", 'vec_id,label' AS kept, 'embedding,positive' AS left_out,
               count(*) AS n, cast(sum(vec_id) AS bigint) AS key_sum FROM embeddings
        UNION ALL
        SELECT 'events', 'event_id,user_id,event_type,value,props', 'ts', count(*),
               cast(sum(event_id) AS bigint) FROM events
    """,
    "q06c_conform_avro": """
        SELECT o_orderkey, CASE WHEN o_totalprice > 200000 THEN 'true' ELSE 'false' END AS large,
               o_orderpriority
        FROM orders
    """,
    "q07_evolve_add": _ADDED,
    "q07b_evolve_one_batch": _ADDED,
    "q08_evolve_relax": """
        SELECT o_orderkey, CASE WHEN o_totalprice > 250000 THEN o_custkey END AS o_custkey, o_orderstatus, o_totalprice
        FROM orders
    """,
    "q09_evolve_ignore": "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM orders",
    "q10r_field_report": """
        SELECT 'c_custkey' AS "column", 'mapped' AS status, count(c_custkey) AS n_values FROM customer
        UNION ALL SELECT 'c_phone', 'missing', NULL
        UNION ALL SELECT 'c_name', 'mapped', count(c_name) FROM customer
        UNION ALL SELECT 'c_nationkey', 'ignored', count(c_nationkey) FROM customer
        UNION ALL SELECT 'c_mktsegment', 'ignored', count(c_mktsegment) FROM customer
    """,
    "q10_field_map": """
        SELECT c_custkey, cast(c_nationkey AS varchar) AS c_nationkey,
               cast(trunc(c_acctbal) AS bigint) AS c_acctbal, cast(NULL AS varchar) AS c_phone, c_name
        FROM customer
    """,
    "q11_narrow_numbers": _NARROWED,
    "q11j_narrow_json_numbers": _NARROWED,
    "q11b_number_text": """
        SELECT cast(l_orderkey AS varchar) AS l_orderkey, cast(l_quantity AS varchar) AS l_quantity,
               cast(l_extendedprice AS varchar) AS l_extendedprice
        FROM lineitem
    """,
    "q12_parse_ts": """
        SELECT event_id,
               CASE event_type WHEN 'click' THEN epoch_ms(date_trunc('second', ts))
                    WHEN 'view' THEN 29379542399999 WHEN 'signup' THEN -30610224000000
                    WHEN 'error' THEN NULL ELSE epoch_ms(date_trunc('millisecond', ts)) END AS at_ms,
               CASE WHEN event_type = 'error' THEN 'BAD_TIMESTAMP' END AS reason
        FROM events
    """,
    "q12b_datetime_text": """
        SELECT event_id, strftime(date_trunc('millisecond', ts), '%Y-%m-%d %H:%M:%S.%g') AS at
        FROM events
    """,
    "q13_booleans": """
        SELECT event_id, CASE WHEN value > 50 THEN 'true' ELSE 'false' END AS as_text,
               CASE WHEN value > 50 THEN 1 ELSE 0 END AS as_int,
               cast(CASE WHEN value > 50 THEN 1 ELSE 0 END AS bigint) AS as_long,
               cast(CASE WHEN value > 50 THEN 1 ELSE 0 END AS double) AS as_double
        FROM events
    """,
    "q13b_bytes": """
        SELECT o_orderkey, o_orderpriority AS raw, cast(length(o_orderpriority) AS integer) AS size, cast(NULL AS varchar) AS reason
        FROM orders
    """,
    "q14_quarantine": """
        SELECT 'app_events_' || event_type AS dest_table,
               CASE WHEN event_type = 'click' THEN 'UNSUPPORTED_RECORD'
                    WHEN event_type = 'view' THEN 'TYPE_MISMATCH'
                    WHEN event_type = 'signup' THEN 'NULL_REQUIRED'
                    WHEN event_type = 'error' AND value > 20 THEN 'BAD_JSON'
                    WHEN event_type = 'error' THEN 'UNSUPPORTED_RECORD' END AS reason,
               CASE WHEN event_type IN ('view', 'signup') THEN 'event_id' END AS bad_column,
               count(*) AS n,
               cast(sum(CASE WHEN event_type = 'view' THEN user_id END) AS bigint) AS bad_values
        FROM events GROUP BY 1, 2, 3
    """,
    "q14w_quarantine_table": """
        SELECT 'events' AS dest_table,
               CASE event_type WHEN 'view' THEN 'TYPE_MISMATCH' WHEN 'error' THEN 'BAD_JSON' END AS reason,
               CASE event_type WHEN 'view' THEN 'event_id' END AS bad_column, count(*) AS n,
               cast(sum(event_id) AS bigint) AS event_ids,
               cast(sum(CASE event_type WHEN 'view' THEN user_id END) AS bigint) AS bad_values
        FROM events GROUP BY 1, 2, 3
    """,
    "q15_upsert_latest": _LATEST,
    "q16_first_wins": _LATEST.replace("arg_max", "arg_min"),
    "q17_append": """
        SELECT l_returnflag, l_linenumber, count(*) AS n, cast(sum(l_orderkey) AS bigint) AS order_keys,
               cast(sum(cast(round(l_extendedprice * 100) AS bigint)) AS bigint) AS price_cents
        FROM lineitem GROUP BY l_returnflag, l_linenumber
    """,
    "q18_upsert_into": f"""
        WITH changes AS ({_CHANGES.format(pick="max", arg="arg_max")})
        SELECT c_custkey, c_name, c_acctbal FROM changes
        UNION ALL
        SELECT c_custkey, c_name, c_acctbal FROM customer
        WHERE c_custkey NOT IN (SELECT c_custkey FROM changes)
    """,
    "q18b_insert_absent": f"""
        WITH changes AS ({_CHANGES.format(pick="min", arg="arg_min")}),
        held AS (
          SELECT c_custkey, c_name, c_acctbal FROM customer WHERE c_mktsegment = 'BUILDING'
        )
        SELECT * FROM held
        UNION ALL
        SELECT * FROM changes WHERE c_custkey NOT IN (SELECT c_custkey FROM held)
    """,
    "q19_change_feed": """
        SELECT 'feed.orders' AS topic,
               cast(row_number() OVER (ORDER BY o_orderkey) - 1 AS varchar) AS key,
               row_number() OVER (ORDER BY o_orderkey) - 1 AS "offset",
               'orders' AS schema_name, 3 AS schema_version,
               '{"type": "struct", "name": "orders", "version": 3, "fields": ['
               || '{"field": "o_orderkey", "type": "int64", "optional": true}, '
               || '{"field": "o_custkey", "type": "int64", "optional": true}, '
               || '{"field": "o_orderstatus", "type": "string", "optional": true}, '
               || '{"field": "o_totalprice", "type": "double", "optional": true}, '
               || '{"field": "o_orderdate", "type": "int64", "optional": true}, '
               || '{"field": "o_orderpriority", "type": "string", "optional": true}]}' AS message_schema,
               o_orderkey, o_custkey, o_orderstatus, o_totalprice, epoch_ms(o_orderdate) AS o_orderdate, o_orderpriority
        FROM orders
    """,
    "q19s_feed_stream": """
        SELECT 'feed.orders' AS topic, 'orders' AS schema_name, 3 AS schema_version, count(*) AS n, count(*) AS n_keys,
               cast(0 AS bigint) AS first_offset, count(*) - 1 AS last_offset,
               cast(sum(o_orderkey) AS bigint) AS o_orderkey, cast(sum(o_custkey) AS bigint) AS o_custkey,
               cast(sum(epoch_ms(o_orderdate)) AS bigint) AS o_orderdate,
               cast(sum(cast(round(o_totalprice * 100) AS bigint)) AS bigint) AS price_cents,
               cast(sum(length(o_orderstatus) + length(o_orderpriority)) AS bigint) AS text_length
        FROM orders
    """,
    "q19c_feed_compacted": """
        SELECT 'feed.customer' AS topic, count(*) AS n, count(DISTINCT c_custkey) AS n_customers, count(*) AS n_offsets,
               count(*) - 1 AS last_offset, cast(sum(cast(round(c_acctbal * 100) AS bigint)) AS bigint) AS balance_cents
        FROM customer
    """,
    "q20s_fan_in_stream": """
        WITH sizes AS (
          SELECT 'customer' AS schema_name, 1 AS schema_version, count(*) AS n, sum(c_custkey) AS sum_sent FROM customer
          UNION ALL SELECT 'supplier', 2, count(*), sum(s_suppkey) FROM supplier
          UNION ALL SELECT 'part', 1, count(*), sum(p_partkey) FROM part
        )
        SELECT 'feed.' || schema_name AS topic, schema_name, schema_version, n, n AS n_keys, cast(0 AS bigint) AS first_offset,
               n - 1 AS last_offset, cast(n * (n - 1) // 2 AS bigint) AS sum_offsets, cast(sum_sent AS bigint) AS sum_sent
        FROM sizes
    """,
    "q20_fan_in": """
        WITH sizes AS (
          SELECT 'customer' AS schema_name, 1 AS schema_version, count(*) AS n FROM customer
          UNION ALL SELECT 'supplier', 2, count(*) FROM supplier
          UNION ALL SELECT 'part', 1, count(*) FROM part
        )
        SELECT 'feed.' || schema_name AS topic, schema_name, schema_version, n, n AS n_offsets,
               cast(0 AS bigint) AS first_offset, n - 1 AS last_offset
        FROM sizes
    """,
    "q21_fan_out": f"""
        SELECT 'by_' || event_type AS dest_table, count(*) AS n, {_CENTS} AS value_cents,
               cast(sum(user_id) AS bigint) AS user_ids
        FROM events GROUP BY event_type
    """,
    "q22_version_gate": """
        WITH versions AS (
          SELECT *, cast(o_orderpriority[1] AS integer) AS version,
                 first_value(cast(o_orderpriority[1] AS integer)) OVER (ORDER BY o_orderdate, o_orderkey) AS first_version
          FROM orders
        )
        SELECT 'orders' AS dest_table, CASE WHEN version <> first_version THEN version END AS schema_version,
               CASE WHEN version <> first_version THEN 'VERSION_BLOCKED' END AS reason, count(*) AS n
        FROM versions GROUP BY 1, 2, 3
    """,
    "q23j_registry_ingest": """
        WITH kinds AS (
          SELECT *, CASE WHEN o_orderstatus = 'F' AND o_orderpriority = '1-URGENT' THEN 'BAD_WIRE_HEADER'
                         WHEN o_orderstatus = 'P' THEN 'UNKNOWN_SCHEMA' END AS reason
          FROM orders
        )
        SELECT CASE WHEN reason IS NULL AND o_orderstatus = 'O' THEN o_orderpriority END AS o_orderpriority, reason,
               count(*) AS n, cast(sum(o_orderkey) AS bigint) AS order_keys,
               cast(sum(CASE WHEN reason IS NULL THEN cast(round(o_totalprice * 100) AS bigint) END) AS bigint) AS price_cents
        FROM kinds GROUP BY 1, 2
    """,
    "q23_wire_header": """
        WITH framed AS (
          SELECT *, o_orderstatus <> 'P'
                    AND NOT (o_orderstatus = 'F' AND o_orderpriority = '1-URGENT') AS good
          FROM orders
        )
        SELECT o_orderkey, CASE WHEN good THEN (o_custkey * 100003) & 4294967295 END AS schema_id,
               CASE WHEN good THEN o_orderpriority END AS payload,
               CASE WHEN NOT good THEN 'BAD_WIRE_HEADER' END AS reason
        FROM framed
    """,
    "q24_width_class": f"""
        WITH longest AS ({" UNION ALL ".join(_WIDTH.format(table=t, column=c) for t, c in _WIDTH_COLUMNS)})
        SELECT "table", "column", cast(max_length AS integer) AS max_length,
               CASE WHEN max_length > 256 THEN 'string' WHEN max_length > 128 THEN 'char256'
                    WHEN max_length > 64 THEN 'char128' WHEN max_length > 32 THEN 'char64'
                    WHEN max_length > 16 THEN 'char32' WHEN max_length > 8 THEN 'char16'
                    WHEN max_length > 4 THEN 'char8' WHEN max_length > 2 THEN 'char4'
                    WHEN max_length = 2 THEN 'char2' WHEN max_length = 1 THEN 'char1'
                    ELSE 'string' END AS width
        FROM longest
    """,
    "q25_stream_upsert": _LATEST,
    "q26_subscribe_regex": """
        SELECT 'app.events.' || event_type AS topic, count(*) AS n, max(event_id) AS last_offset
        FROM events WHERE regexp_full_match('app.events.' || event_type, 'app\\.events\\.(click|view|sign)')
        GROUP BY event_type
    """,
    "q27s_stream_counts": """
        SELECT 'app_events_' || event_type AS dest_table, count(*) FILTER (value > 5) AS accepted,
               count(*) FILTER (value <= 5) AS refused
        FROM events GROUP BY event_type
    """,
    "q27_ingest_counts": """
        SELECT 'app_events_' || event_type AS dest_table, count(*) FILTER (value > 5) AS accepted,
               count(*) FILTER (value <= 5) AS refused
        FROM events GROUP BY event_type
    """,
}
