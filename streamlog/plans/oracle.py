"""The registered queries as SQL over the given tables, for checking results."""

from __future__ import annotations

import re

SHARED = {
    "LOG": """log AS (SELECT event_type AS topic, CAST(user_id % 4 AS INT) AS "partition",
  row_number() OVER (PARTITION BY event_type, user_id % 4 ORDER BY ts, event_id) - 1 AS "offset",
  ts AS "timestamp", CASE WHEN event_type = 'view' THEN NULL ELSE CAST(user_id AS STRING) END AS "key",
  props AS "value", event_id, user_id FROM events)""",
    "OFFS": """pos AS (SELECT topic, "partition", max("offset") + 1 AS "offset" FROM log GROUP BY topic, "partition")""",
    "STORE": """store AS (SELECT topic, "partition", greatest("offset" - 20, 0) AS "offset" FROM pos WHERE "partition" < 3)""",
    "DELIVERED": """b AS (SELECT *, event_id // 500 AS batch_no FROM log),
  d AS (SELECT batch_no, topic, "partition", max("offset") + 1 AS "offset" FROM b GROUP BY batch_no, topic, "partition"),
  c AS (SELECT batch_no, topic, "partition", "offset" + CASE WHEN batch_no % 3 = 0 AND "partition" = 0 THEN 1 ELSE 0 END AS "offset"
    FROM d WHERE NOT (batch_no % 5 = 1 AND "partition" = 3)),
  ok AS (SELECT d.batch_no, count(*) = count(c."offset") AND bool_and(coalesce(d."offset" = c."offset", false)) AS confirmed
    FROM d LEFT JOIN c ON d.batch_no = c.batch_no AND d.topic = c.topic AND d."partition" = c."partition" GROUP BY d.batch_no)""",
    "UNITS": """units AS (SELECT topic AS unit, dense_rank() OVER (ORDER BY topic) - 1 AS no, 'out' AS topic, "partition",
    row_number() OVER (PARTITION BY "partition" ORDER BY topic, "offset") - 1 AS "offset", "key", "value" FROM log)""",
    "MIXED": """parts AS (SELECT *, 0 AS unit FROM log WHERE event_id % 3 = 0 UNION ALL SELECT *, 1 FROM log WHERE event_id % 3 = 1
    UNION ALL SELECT *, 2 FROM log WHERE event_id % 3 <> 0),
  mixed AS (SELECT unit, topic, "partition", row_number() OVER (PARTITION BY topic, "partition" ORDER BY unit, "timestamp", event_id) - 1 AS "offset",
    event_id, "timestamp" FROM parts)""",
    "HELD": """parts AS (SELECT *, event_id % 3 AS unit FROM log WHERE event_id % 3 <> 1 OR topic IN ('click', 'view')),
  units AS (SELECT unit, topic, "partition", row_number() OVER (PARTITION BY topic, "partition" ORDER BY unit, "timestamp", event_id) - 1 AS "offset", event_id FROM parts),
  held AS (SELECT *, min("offset") FILTER (WHERE unit = 1) OVER (PARTITION BY topic, "partition") AS first_open FROM units)""",
    "PLAN": """dl AS (SELECT event_id, date_diff('millisecond', date_trunc('millisecond', ts), date_trunc('millisecond', nx)) AS delay_ms
    FROM (SELECT event_id, ts, lead(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS nx FROM events) t),
  fd AS (SELECT event_id, delay_ms, CASE WHEN delay_ms IS NULL THEN NULL WHEN delay_ms <= 0 THEN 0 ELSE (delay_ms - 1) // 10000000 END AS fired FROM dl),
  plan AS (SELECT event_id, delay_ms, 1 + least(fired, 3) AS sends,
    CASE WHEN fired IS NULL THEN NULL ELSE greatest(fired - 3, 0) END AS backoffs FROM fd)""",
}

STATEMENTS = {
    "log_view": """WITH $LOG SELECT topic, "partition", "offset", "timestamp", "key", "value" FROM log""",
    "subscribe_topics": """WITH $LOG SELECT topic, "partition", "offset", "key", "value" FROM log WHERE topic IN ('click', 'purchase')""",
    "subscribe_committed": """WITH $LOG, $OFFS, $STORE SELECT l.topic, l."partition", l."offset", l."value" FROM log l
  JOIN store s ON l.topic = s.topic AND l."partition" = s."partition" WHERE l.topic IN ('click', 'purchase') AND l."offset" >= s."offset" """,
    "resume_committed": """WITH $LOG, $OFFS, $STORE SELECT l.topic, l."partition", l."offset" FROM log l
  LEFT JOIN store s ON l.topic = s.topic AND l."partition" = s."partition" WHERE l.topic = 'click' AND l."offset" >= coalesce(s."offset", 0)""",
    "resume_from_offset_store": """WITH $LOG, $OFFS, $STORE SELECT l.topic, l."partition", count(*) AS n, min(l."offset") AS first_offset, max(l."offset") + 1 AS next_offset
  FROM log l LEFT JOIN store s ON l.topic = s.topic AND l."partition" = s."partition" WHERE l."offset" >= coalesce(s."offset", 0) GROUP BY l.topic, l."partition" """,
    "assign_partitions": """WITH $LOG SELECT topic, "partition", "offset", "value" FROM log WHERE (topic = 'click' AND "partition" IN (0, 2)) OR (topic = 'view' AND "partition" = 1)""",
    "assign_committed": """WITH $LOG, $OFFS, $STORE SELECT l.topic, l."partition", l."offset" FROM log l
  LEFT JOIN store s ON l.topic = s.topic AND l."partition" = s."partition"
  WHERE ((l.topic = 'click' AND l."partition" IN (0, 3)) OR (l.topic = 'view' AND l."partition" = 1)) AND l."offset" >= coalesce(s."offset", 0)""",
    "seek_offsets": """WITH $LOG SELECT topic, "partition", "offset", "value" FROM log WHERE (topic = 'click' AND "partition" = 0 AND "offset" >= 25) OR (topic = 'click' AND "partition" = 1 AND "offset" >= 40)""",
    "offsets_for_times": """WITH $LOG SELECT topic, "partition", min("offset") FILTER (WHERE "timestamp" >= TIMESTAMP '2024-01-10 00:00:00') AS "offset" FROM log GROUP BY topic, "partition" """,
    "seek_timestamp": """WITH $LOG, st AS (SELECT topic, "partition", min("offset") AS o FROM log WHERE "timestamp" >= TIMESTAMP '2024-01-10 00:00:00' GROUP BY topic, "partition")
  SELECT l.topic, l."partition", l."offset" FROM log l JOIN st ON l.topic = st.topic AND l."partition" = st."partition" WHERE l."offset" >= st.o""",
    "reset_latest": """WITH $LOG, $OFFS, $STORE SELECT p.topic, p."partition", coalesce(s."offset", p."offset") AS start_offset FROM pos p
  LEFT JOIN store s ON p.topic = s.topic AND p."partition" = s."partition" """,
    "read_committed": """WITH $LOG SELECT topic, "partition", "offset" FROM log
  WHERE event_id // 100 NOT IN (SELECT event_id // 100 FROM log WHERE topic = 'error' AND event_id % 100 = 0)""",
    "bounded_batch": """WITH $LOG SELECT topic, "partition", "offset" FROM log WHERE "offset" < 50""",
    "consume_expected": """WITH $LOG SELECT "key", "value" FROM log WHERE topic = 'click'""",
    "records_pairs": """WITH $LOG SELECT "key", "value" FROM log""",
    "records_values": """WITH $LOG SELECT "value" FROM log""",
    "records_size": """WITH $LOG SELECT count(*) AS n FROM log""",
    "to_producer_records": """WITH $LOG SELECT 'out' AS topic, "key", "value" FROM log""",
    "values_to_producer_records": """WITH $LOG SELECT 'out' AS topic, CAST(NULL AS STRING) AS "key", "value" FROM log""",
    "values_with_key": """WITH $LOG SELECT 'out' AS topic, 'k1' AS "key", "value" FROM log""",
    "destination_record": """WITH $LOG SELECT topic || '.copy' AS topic, CASE WHEN "key" IS NULL THEN 0 ELSE "partition" END AS "partition", "timestamp", "key", "value" FROM log""",
    "records_with_topic": """WITH $LOG SELECT CASE WHEN "partition" = 0 THEN 'even' ELSE 'odd' END AS topic, CAST(NULL AS STRING) AS "key", "value" FROM log""",
    "typed_records": """WITH $LOG SELECT topic, "partition", "offset", CAST("key" AS BIGINT) AS "key", "value" FROM log WHERE TRY_CAST("key" AS BIGINT) IS NOT NULL""",
    "mapped_records": """WITH $LOG SELECT 'mapped-' || topic AS topic, "key", "value" FROM log WHERE topic IN ('click', 'purchase') AND "key" IS NOT NULL""",
    "serde_roundtrip": """WITH $LOG SELECT topic, "partition", "offset", length("value") AS n_chars, upper("value") AS "value" FROM log""",
    "serde_long": """WITH $LOG SELECT topic, "partition", "offset", CASE WHEN "key" IS NOT NULL THEN lpad(to_hex(user_id), 16, '0') END AS bytes,
  CAST("key" AS BIGINT) AS "key" FROM log""",
    "serde_json": """WITH $LOG SELECT topic, "partition", "offset", CAST(regexp_extract("value", '"k": *(-?[0-9]+)', 1) AS BIGINT) AS k FROM log""",
    "serde_function": """WITH $LOG SELECT topic, "partition", "offset", upper(reverse("value")) AS "value" FROM log""",
    "encode_failures": """WITH $LOG SELECT topic, "partition", "offset", CASE WHEN event_id % 7 <> 0 THEN event_id END AS "value",
  CASE WHEN event_id % 7 = 0 THEN 'not a bigint: x' || event_id END AS error FROM log""",
    "positions": """WITH $LOG, $OFFS SELECT topic, "partition", "offset" FROM pos""",
    "end_offsets": """WITH $LOG, $OFFS SELECT topic, "partition", "offset" FROM pos""",
    "offsets_text": """WITH $LOG, $OFFS SELECT topic || '-' || "partition" || ' = ' || "offset" AS text FROM pos""",
    "offsets_keep_only": """WITH $LOG, $OFFS, $STORE SELECT topic, "partition", "offset" FROM pos
  WHERE EXISTS (SELECT 1 FROM store s WHERE s.topic = pos.topic AND s."partition" = pos."partition")""",
    "offsets_remove": """WITH $LOG, $OFFS, $STORE SELECT topic, "partition", "offset" FROM pos
  WHERE NOT EXISTS (SELECT 1 FROM store s WHERE s.topic = pos.topic AND s."partition" = pos."partition")""",
    "topic_partitions": """WITH $LOG SELECT DISTINCT topic, "partition" FROM log""",
    "partitions_for": """WITH $LOG SELECT topic, "partition", min("offset") AS begin_offset, max("offset") + 1 AS end_offset FROM log WHERE topic = 'click' GROUP BY topic, "partition" """,
    "batch_positions": """WITH $LOG, $DELIVERED,
  g AS (SELECT bn.batch_no, tp.topic, tp."partition" FROM (SELECT DISTINCT batch_no FROM b) bn CROSS JOIN (SELECT DISTINCT topic, "partition" FROM b) tp)
  SELECT g.batch_no, g.topic, g."partition", coalesce(max(d."offset") OVER (PARTITION BY g.topic, g."partition" ORDER BY g.batch_no ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 0) AS "offset"
  FROM g LEFT JOIN d ON g.batch_no = d.batch_no AND g.topic = d.topic AND g."partition" = d."partition" """,
    "commit_map": """WITH $LOG, $OFFS SELECT 'group-1' AS group_id, topic, "partition", "offset", TIMESTAMP '2024-02-01 00:00:00' AS committed_at FROM pos""",
    "confirm_match": """WITH $LOG, $DELIVERED SELECT batch_no, confirmed FROM ok""",
    "tracked_batches": """WITH $LOG, $DELIVERED SELECT 'group-1' AS group_id, batch_no, 'delivered' AS event, CAST(0 AS INT) AS redelivery_count FROM ok
  UNION ALL SELECT 'group-1', batch_no, CASE WHEN confirmed THEN 'confirmed' ELSE 'ignored' END, CAST(0 AS INT) FROM ok""",
    "commit_clip": """WITH $LOG, $OFFS, $STORE SELECT p.topic, p."partition", p."offset", s.topic IS NOT NULL AS committed FROM pos p
  LEFT JOIN store s ON p.topic = s.topic AND p."partition" = s."partition" """,
    "commit_upsert": """WITH $LOG, $OFFS, $STORE SELECT coalesce(p.topic, s.topic) AS topic, coalesce(p."partition", s."partition") AS "partition", coalesce(p."offset", s."offset") AS "offset"
  FROM (SELECT * FROM pos WHERE topic <> 'error') p FULL OUTER JOIN store s ON p.topic = s.topic AND p."partition" = s."partition" """,
    "commit_confirmed": """WITH $LOG, $OFFS, $STORE, $DELIVERED,
  r AS (SELECT d.topic, d."partition", arg_max(d."offset", d.batch_no) AS "offset" FROM d JOIN ok ON d.batch_no = ok.batch_no WHERE ok.confirmed GROUP BY d.topic, d."partition")
  SELECT coalesce(r.topic, s.topic) AS topic, coalesce(r."partition", s."partition") AS "partition", coalesce(r."offset", 0) AS "offset"
  FROM store s FULL OUTER JOIN r ON r.topic = s.topic AND r."partition" = s."partition" """,
    "redelivery_plan": """WITH $PLAN SELECT event_id, delay_ms, sends, backoffs FROM plan""",
    "redelivery_timeline": """WITH $PLAN, tries AS (SELECT event_id, unnest(range(0, sends)) AS attempt FROM plan)
  SELECT event_id, attempt, attempt * 10000000 AS after_ms, (attempt + 1) * 1000 AS poll_interval_ms FROM tries""",
    "resume_plan_group": """WITH $LOG, $OFFS, $STORE SELECT p.topic, p."partition", coalesce(s."offset", p."offset") AS "offset" FROM pos p
  LEFT JOIN store s ON p.topic = s.topic AND p."partition" = s."partition" """,
    "resume_plan_manual": """WITH $LOG, $OFFS, $STORE SELECT p.topic, p."partition", coalesce(s."offset", p."offset") AS "offset" FROM pos p
  LEFT JOIN store s ON p.topic = s.topic AND p."partition" = s."partition" """,
    "retried_stream": """WITH $LOG, $OFFS, tries AS (SELECT unnest(['failure', 'success']) AS status)
  SELECT CAST(0 AS BIGINT) AS batch_id, topic, "partition", "offset", status, CASE WHEN status = 'failure' THEN 'receiver is gone' END AS error FROM pos, tries""",
    "stopped_stream": """WITH $LOG SELECT topic, "partition", "offset", true AS covered FROM log""",
    "carried_positions": """WITH $LOG, $OFFS SELECT topic, "partition", CASE WHEN topic = 'purchase' THEN "offset" ELSE 0 END AS "offset" FROM pos""",
    "resume_of_groups": """WITH $LOG, $OFFS, $STORE SELECT 'group-2' AS group_id, l.topic, l."partition", count(*) AS n FROM log l
  LEFT JOIN store s ON l.topic = s.topic AND l."partition" = s."partition" WHERE l."offset" >= coalesce(s."offset", 0) GROUP BY l.topic, l."partition" """,
    "serde_nullable_long": """WITH $LOG SELECT topic, "partition", "offset", CASE WHEN event_id % 5 <> 0 THEN CAST(event_id + 9007199254740993 AS STRING) END AS number,
  CASE WHEN event_id % 3 <> 0 THEN event_id END AS "value", CASE WHEN event_id % 3 = 0 THEN '8 bytes expected, got 4' END AS error FROM log""",
    "relay": """WITH $LOG SELECT 'topic2' AS topic, "key", "value" || '.' AS "value" FROM log""",
    "relay_stream": """WITH $LOG SELECT 'topic2' AS topic, "key", "value" || '.' AS "value" FROM log""",
    "relay_log": """WITH $LOG SELECT topic || '2' AS topic, "partition", "offset", "key", "value" || '.' AS "value" FROM log""",
    "send_acks": """WITH $LOG, $UNITS SELECT no AS batch_id, topic, "partition", "offset", 'success' AS status, CAST(NULL AS STRING) AS error FROM units""",
    "transactional_write": """WITH $LOG SELECT topic, "key", "value" FROM log WHERE topic <> 'error'""",
    "isolated_committed": """WITH $LOG, $UNITS SELECT topic, "partition", "offset", "key", "value" FROM units WHERE unit <> 'error'""",
    "isolated_uncommitted": """WITH $LOG, $UNITS SELECT topic, "partition", "offset", "key", "value" FROM units""",
    "bounded_stream": """WITH $LOG, $MIXED SELECT topic, "partition", "offset", event_id, "offset" // 500 AS batch_no FROM mixed WHERE unit <> 1""",
    "committed_of_mixed": """WITH $LOG, $MIXED SELECT topic, "partition", "offset", event_id FROM mixed WHERE unit <> 1""",
    "uncommitted_of_mixed": """WITH $LOG, $MIXED SELECT topic, "partition", "offset", event_id FROM mixed""",
    "pending_unit_committed": """WITH $LOG, $HELD SELECT topic, "partition", "offset", event_id FROM held WHERE unit <> 1 AND (first_open IS NULL OR "offset" < first_open)""",
    "pending_unit_uncommitted": """WITH $LOG, $HELD SELECT topic, "partition", "offset", event_id FROM held""",
    "pending_unit_ends": """WITH $LOG, $HELD SELECT topic, "partition", coalesce(min(first_open), max("offset") + 1) AS stable_end, max("offset") + 1 AS log_end
  FROM held GROUP BY topic, "partition" """,
    "times_out_of_order": """WITH $LOG, $MIXED SELECT topic, "partition", min("offset") FILTER (WHERE unit <> 1 AND "timestamp" >= TIMESTAMP '2024-01-20 00:00:00') AS "offset"
  FROM mixed GROUP BY topic, "partition" """,
    "relay_offsets": """WITH $LOG SELECT topic, "partition", max("offset") + 1 AS "offset", count(*) AS n, count(DISTINCT event_id) AS n_events FROM log GROUP BY topic, "partition" """,
    "stateful_counts_initial": """WITH $LOG SELECT topic, "partition", count(*) + CASE WHEN "partition" < 3 THEN 1000 ELSE 0 END AS n, max("offset") + 1 AS "offset" FROM log GROUP BY topic, "partition" """,
    "dedup_stream": """SELECT user_id % 8 AS writer, event_id AS sequence FROM events""",
    "typed_payloads": """WITH $LOG SELECT topic, "partition", "offset", event_id AS id, CAST(CASE WHEN event_id % 7 = 3 THEN 0 ELSE 2 END AS BIGINT) AS n_tags, event_id % 7 = 3 AS no_k
  FROM log WHERE event_id % 7 IN (0, 3)""",
    "consume_until": """WITH $LOG SELECT "key", "value" FROM log WHERE topic = 'click'""",
    "retried_write": """WITH $LOG, $OFFS SELECT CAST(0 AS BIGINT) AS batch_id, topic, "partition", "offset", 'success' AS status, CAST(NULL AS STRING) AS error FROM pos""",
    "delivery_settings": """WITH $PLAN SELECT event_id, 1 + least(fired, 2) AS sends, (1 + least(fired, 2)) * 500 AS longest_poll_ms FROM fd""",
    "relay_log_restarted": """WITH $LOG SELECT topic, "partition", "offset", "key", "value" FROM log""",
    "dedup_records": """WITH $LOG SELECT DISTINCT topic, "partition", "offset", "timestamp", "key", "value", event_id
  FROM (SELECT * FROM log UNION ALL SELECT * FROM log WHERE "partition" = 1) u""",
    "stateful_counts": """WITH $LOG SELECT topic, "partition", count(*) AS n, max("offset") + 1 AS "offset" FROM log GROUP BY topic, "partition" """,
    "stateful_counts_stream": """WITH $LOG SELECT topic, "partition", count(*) AS n, max("offset") + 1 AS "offset" FROM log GROUP BY topic, "partition" """,
    "committed_stream": """WITH $LOG, $OFFS SELECT 'group-1' AS group_id, topic, "partition", "offset" FROM pos""",
    "acknowledged_stream": """WITH $LOG, $OFFS SELECT CAST(0 AS BIGINT) AS batch_id, topic, "partition", "offset", 'success' AS status, CAST(NULL AS STRING) AS error FROM pos""",
    "partition_state": """WITH $LOG SELECT topic, "partition", count(*) AS n, max("offset") + 1 AS "offset" FROM log WHERE "partition" = 2 GROUP BY topic, "partition" """,
}


def oracle_sql() -> dict[str, str]:
    """Every statement with its shared parts written out."""
    return {
        name: re.sub(r"\$([A-Z]+)", lambda found: SHARED[found.group(1)], text).strip()
        for name, text in STATEMENTS.items()
    }
