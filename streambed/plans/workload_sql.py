"""The same results as the registered queries, in SQL over the driver's tables."""

from __future__ import annotations

from .inputs import (
    BASE_SQL,
    DAY,
    ISO_SQL,
    LINES_SQL,
    LISTED_SQL,
    RESULTS_SQL,
    SAMPLES_SQL,
    TIMINGS_SQL,
    body,
    message,
    shards_sql,
)

TIME_CASES = (
    "CASE event_id % 9 WHEN 2 THEN sec - 19800 WHEN 4 THEN {bad} WHEN 5 THEN {number} "
    "WHEN 6 THEN {bad} WHEN 7 THEN CASE WHEN strftime(ts, '%m') = '01' THEN {bad} ELSE sec END ELSE sec END"
)
TIME_TEXT = (
    f"CASE event_id % 9 WHEN 0 THEN {ISO_SQL} WHEN 1 THEN replace({ISO_SQL}, 'Z', '.123456789Z') "
    f"WHEN 2 THEN replace({ISO_SQL}, 'Z', '+05:30') WHEN 3 THEN replace({ISO_SQL}, 'Z', '') "
    f"WHEN 4 THEN replace({ISO_SQL}, 'T', ' ') WHEN 5 THEN concat('', sec) "
    f"WHEN 6 THEN '' WHEN 7 THEN replace({ISO_SQL}, '-01-', '-13-') ELSE replace({ISO_SQL}, 'Z', ',5Z') END"
)

# Messages with faults 0, 1, 2, 3, 5 and 6 are rejected; fault 4 has no reference.
MESSAGES_SQL = (
    f"{BASE_SQL}, messages AS (SELECT *, {message(ISO_SQL)} AS value, CASE WHEN event_id % 50 IN (0, 5, 6) "
    "THEN 'invalid JSON' WHEN event_id % 50 = 1 THEN 'missing _event_id' WHEN event_id % 50 = 2 "
    "THEN 'missing _event_timestamp' WHEN event_id % 50 = 3 THEN 'invalid _event_timestamp' ELSE '' END AS reason "
    "FROM base), accepted AS (SELECT *, CASE WHEN event_id % 50 = 4 THEN '' ELSE concat('', user_id) END AS ref, "
    "CASE WHEN event_id % 50 = 4 THEN '' ELSE event_type END AS category, strlen(value) AS bytes, "
    "CAST(user_id % 3 AS INTEGER) AS part FROM messages WHERE reason = '')"
)


def dedup_sql(ids: str, arrival: str, window: int, columns: str) -> str:
    """Row by row along each id's arrival order, carrying the last kept time."""
    same = " AND ".join(f"n.{c.strip()} = f.{c.strip()}" for c in ids.split(","))
    return (
        f"WITH RECURSIVE {BASE_SQL}, n AS (SELECT event_id, user_id, event_type, sec, {arrival} AS arrival, "
        f"row_number() OVER (PARTITION BY {ids} ORDER BY {arrival}) AS rn FROM base), "
        "f AS (SELECT n.*, sec AS last, true AS keep FROM n WHERE rn = 1 UNION ALL "
        f"SELECT n.*, CASE WHEN n.sec - f.last > {window} THEN n.sec ELSE f.last END, n.sec - f.last > {window} "
        f"FROM f JOIN n ON {same} AND n.rn = f.rn + 1) SELECT {columns} FROM f WHERE keep"
    )


def packing_sql(max_rows: int, max_bytes: int, tail: str) -> str:
    """Row by row along each partition, carrying the open segment's rows and bytes."""
    opens = f"f.c + 1 > {max_rows} OR f.b + n.bytes > {max_bytes}"
    return (
        f"WITH RECURSIVE {MESSAGES_SQL}, n AS (SELECT event_id, part, bytes, "
        "row_number() OVER (PARTITION BY part ORDER BY event_id) AS rn FROM accepted), "
        "f AS (SELECT n.*, CAST(1 AS BIGINT) AS c, CAST(bytes AS BIGINT) AS b, CAST(0 AS BIGINT) AS seg "
        "FROM n WHERE rn = 1 UNION ALL "
        f"SELECT n.*, CASE WHEN {opens} THEN 1 ELSE f.c + 1 END, "
        f"CASE WHEN {opens} THEN n.bytes ELSE f.b + n.bytes END, CASE WHEN {opens} THEN f.seg + 1 ELSE f.seg END "
        f"FROM f JOIN n ON n.part = f.part AND n.rn = f.rn + 1) {tail}"
    )


SORTED_KEYS = (
    "parsed AS (SELECT bucket, key, CAST(split_part(key, '/', 2) AS BIGINT) AS timestamp, "
    "split_part(key, '/', 3) AS writer, regexp_replace(split_part(key, '/', 4), '\\.ndjson$', '') AS segment, size "
    "FROM listed WHERE len(string_split(key, '/')) >= 4 AND regexp_matches(split_part(key, '/', 2), '^[0-9]+$'))"
)

ENTRIES_SQL = (
    f"{LINES_SQL}, {shards_sql(16)}, entries AS (SELECT shard, concat('', user_id) AS reference_id, idx_ts AS ts, "
    "concat('', event_id) AS event_id, event_id AS no, bucket, key, start_byte, start_byte + line_bytes AS end_byte, "
    "event_id % 50 = 3 AS time_unreadable, sec - sec % 86400 AS seg_ts, concat('w', user_id % 3) AS writer, "
    "event_type AS segment FROM placed JOIN shards USING (user_id) WHERE status = 'ok')"
)

LATEST = "arg_max(value, ts)"

RATE_SQL = (
    "WITH {samples}, d AS (SELECT *, lag(value) OVER (PARTITION BY name, instance ORDER BY ts) AS prev FROM samples "
    "WHERE name = '{name}') SELECT name, instance, sec - sec % 60 AS window_start, round(coalesce(sum(CASE WHEN prev IS NULL "
    "THEN 0 WHEN value >= prev THEN value - prev ELSE value END), 0) / 60.0::DOUBLE, 6) AS per_second FROM d GROUP BY 1, 2, 3"
)

SIDE_BY_SIDE = (
    "WITH {samples}, l AS (SELECT instance, "
    "coalesce(arg_max(value, ts) FILTER (WHERE name = '{a}'), 0) AS a, "
    "coalesce(arg_max(value, ts) FILTER (WHERE name = '{b}'), 0) AS b FROM samples "
    "WHERE name IN ('{a}', '{b}') GROUP BY 1) "
)

PER_SHARD = (
    f"WITH RECURSIVE {MESSAGES_SQL}, {shards_sql(16)} SELECT shard, count(*) AS entries, "
    "CAST(sum(bytes) AS BIGINT) AS bytes FROM accepted JOIN shards USING (user_id) WHERE ref <> '' GROUP BY 1"
)

QUANTILES = "(SELECT unnest([0.5, 0.95, 0.99]) AS prob)"

SAMPLES_AFTER_BASE = SAMPLES_SQL[len(BASE_SQL) + 2:]

REPORT_PARTS = (
    f"{MESSAGES_SQL}, {SAMPLES_AFTER_BASE}, last AS (SELECT max(sec) AS t FROM accepted), "
    "gauges AS (SELECT coalesce(arg_max(value, ts) FILTER (WHERE name = 'buffer_events'), 0) AS n, "
    "coalesce(arg_max(value, ts) FILTER (WHERE name = 'buffer_bytes'), 0) AS b FROM samples WHERE instance = 'w0'), "
    "rate AS (SELECT count(*) AS eps FROM accepted, last WHERE sec = t)"
)

# Every tenth message is sent twice; a batch of the four flushes one segment, every second one at its second attempt.
RECORDED = (
    f"{MESSAGES_SQL}, recorded AS (SELECT count(*) FILTER (WHERE reason = '') AS consumed, "
    "count(*) FILTER (WHERE reason = '' AND event_id % 10 = 0) AS duplicates, "
    "count(*) FILTER (WHERE reason <> '') + count(*) FILTER (WHERE reason <> '' AND event_id % 10 = 0) AS rejected, "
    "count(*) FILTER (WHERE reason = '') AS flushed, count(DISTINCT event_id % 4) FILTER (WHERE reason = '') AS uploads, "
    "count(DISTINCT event_id % 4) // 2 AS failed_flushes FROM messages)"
)


def trailing_sql(name: str, window: int, step: int) -> str:
    """A RANGE frame over the increases, read at every step that has a sample in its window."""
    w, s = window * 1_000_000, step * 1_000_000
    return (
        f"WITH {SAMPLES_SQL}, d AS (SELECT *, epoch_us(ts) AS us, lag(value) OVER (PARTITION BY name, instance ORDER BY ts) AS prev "
        f"FROM samples WHERE name = '{name}'), i AS (SELECT name, instance, us, CASE WHEN prev IS NULL THEN 0 WHEN value >= prev "
        "THEN value - prev ELSE value END AS up, false AS step FROM d), "
        f"t AS (SELECT DISTINCT name, instance, unnest(range((us + {s - 1}) // {s} * {s}, us + {w}, {s})) AS us FROM i), "
        "u AS (SELECT * FROM i UNION ALL SELECT name, instance, us, 0, true FROM t), "
        f"r AS (SELECT *, sum(up) OVER (PARTITION BY name, instance ORDER BY us RANGE BETWEEN {w - 1} PRECEDING AND CURRENT ROW) AS total FROM u) "
        f"SELECT name, instance, us // 1000000 AS at, round(total / {window}.0::DOUBLE, 6) AS per_second FROM r WHERE step"
    )


# Weeks of the table's span; rows of the first that come with the last are behind the watermark by then.
LATE_SQL = (
    f"{MESSAGES_SQL}, span AS (SELECT min(sec) AS a, max(sec) AS z, (max(sec) - min(sec)) // 4 + 1 AS week FROM accepted), "
    "counted AS (SELECT sec, bytes, z FROM accepted, span WHERE NOT (event_id % 17 = 0 AND sec - a < week))"
)

ORACLES: dict[str, str] = {
    "decode_validate_events": f"WITH {MESSAGES_SQL} SELECT concat('', event_id) AS event_id, ref AS reference_id, "
    "sec AS timestamp, category, event_type, bytes AS payload_bytes FROM accepted",
    "decode_validate_events_lenient_payload": f"WITH {MESSAGES_SQL} SELECT event_type, count(*) AS n FROM accepted GROUP BY 1",
    "reject_reasons": f"WITH {MESSAGES_SQL} SELECT reason, count(*) AS n, CAST(sum(strlen(value)) AS BIGINT) AS bytes "
    "FROM messages WHERE reason <> '' GROUP BY 1",
    "rejected_messages": f"WITH {MESSAGES_SQL} SELECT value, reason FROM messages WHERE reason <> ''",
    "strict_event_time": f"WITH {BASE_SQL} SELECT event_id, {TIME_TEXT} AS text, "
    f"{TIME_CASES.format(bad='NULL', number='NULL')} AS seconds FROM base",
    "lenient_event_time": f"WITH {BASE_SQL} SELECT event_id, {TIME_TEXT} AS text, "
    f"{TIME_CASES.format(bad='0', number='sec')} AS seconds FROM base",
    "dedup_batch_window": dedup_sql("user_id, event_type", "event_id", 3600, "event_id, user_id, event_type, sec AS timestamp"),
    "dedup_batch_late_rows": dedup_sql(
        "user_id, event_type", "CASE WHEN event_id % 11 = 0 THEN event_id * 10 + 4005 ELSE event_id * 10 END",
        3600, "event_id, user_id, event_type, sec AS timestamp, arrival"),
    "dedup_batch_hot_ids": dedup_sql("event_type", "event_id", 300, "event_id, user_id, event_type, sec AS timestamp"),
    "dedup_switched_off": "SELECT event_type, count(*) AS n FROM events GROUP BY 1",
    "segment_keys_parsed": f"WITH {LISTED_SQL}, {SORTED_KEYS} SELECT * FROM parsed",
    "segments_sorted": f"WITH {LISTED_SQL}, {SORTED_KEYS} SELECT timestamp, writer, segment, bucket, key FROM parsed "
    "ORDER BY timestamp, writer, segment, bucket, key",
    "segments_after_cursor": f"WITH {LISTED_SQL}, {SORTED_KEYS}, c AS (SELECT bucket, arg_min(key, size) AS last_key "
    "FROM parsed WHERE bucket <> 'events-5' GROUP BY 1) SELECT p.bucket, p.key FROM parsed p LEFT JOIN c USING (bucket) "
    "WHERE p.key > coalesce(c.last_key, '')",
    "cursor_advance": f"WITH {RESULTS_SQL}, w AS (SELECT *, sum(CASE WHEN failed THEN 1 ELSE 0 END) OVER (PARTITION BY bucket "
    "ORDER BY seg_ts, writer, segment, key) AS bad, row_number() OVER (PARTITION BY bucket ORDER BY seg_ts, writer, segment, key) "
    "AS rn FROM results) SELECT bucket, arg_max(key, rn) AS last_key FROM w WHERE bad = 0 GROUP BY 1",
    "cursor_merge": f"WITH {RESULTS_SQL}, w AS (SELECT *, sum(CASE WHEN failed THEN 1 ELSE 0 END) OVER (PARTITION BY bucket "
    "ORDER BY seg_ts, writer, segment, key) AS bad, row_number() OVER (PARTITION BY bucket ORDER BY seg_ts, writer, segment, key) "
    "AS rn FROM results), moved AS (SELECT bucket, arg_max(key, rn) AS last_key FROM w WHERE bad = 0 AND bucket < 'events-4' "
    "GROUP BY 1), old AS (SELECT bucket, min(key) AS last_key FROM results GROUP BY 1) "
    "SELECT bucket, coalesce(moved.last_key, old.last_key) AS last_key FROM old LEFT JOIN moved USING (bucket)",
    "line_byte_ranges": f"WITH {LINES_SQL} SELECT bucket, key, event_id AS line_no, start_byte, "
    "start_byte + line_bytes AS end_byte FROM placed",
    "index_entries": f"WITH RECURSIVE {ENTRIES_SQL} SELECT shard, reference_id, ts, event_id, "
    "concat('ref:', reference_id, ':time:', ts, ':txn:', event_id) AS row_key, "
    "concat(bucket, '|', key, '|', start_byte, '|', end_byte) AS locator, time_unreadable FROM entries",
    "index_entries_strict_reference": f"WITH RECURSIVE {ENTRIES_SQL} SELECT bucket, count(*) AS n, "
    "CAST(sum(end_byte) AS BIGINT) AS end_bytes FROM entries GROUP BY 1",
    "shard_assignment": f"WITH RECURSIVE {BASE_SQL}, "
    + ", ".join(
        shards_sql(n).replace("hashed", f"hashed{n}").replace("jump", f"jump{n}").replace("shards AS", f"shards{n} AS")
        for n in (1, 4, 6, 16))
    + " SELECT user_id, shards1.shard AS shard_of_1, shards4.shard AS shard_of_4, shards6.shard AS shard_of_6, "
    "shards16.shard AS shard_of_16 FROM shards1 JOIN shards4 USING (user_id) JOIN shards6 USING (user_id) JOIN shards16 USING (user_id)",
    "shard_balance": f"WITH RECURSIVE {BASE_SQL}, {shards_sql(16)} SELECT shard, count(DISTINCT user_id) AS users, "
    "count(*) AS events FROM base JOIN shards USING (user_id) GROUP BY 1",
    "shard_batches": f"WITH RECURSIVE {ENTRIES_SQL} SELECT bucket, key, shard, start_byte, "
    "(row_number() OVER (PARTITION BY bucket, key, shard ORDER BY start_byte) - 1) // 2 AS batch_no FROM entries",
    "index_latest": f"WITH RECURSIVE {ENTRIES_SQL}, twice AS (SELECT reference_id, ts, event_id, seg_ts, writer, segment, bucket, "
    "key, start_byte FROM entries UNION ALL SELECT reference_id, ts, event_id, CASE WHEN no % 2 = 0 THEN seg_ts + 60 ELSE seg_ts END, "
    "'w9', segment, bucket, key, start_byte + 1 FROM entries WHERE no % 3 = 0) "
    "SELECT reference_id, ts, event_id, seg_ts, writer, start_byte FROM (SELECT *, row_number() OVER (PARTITION BY reference_id, "
    "ts, event_id ORDER BY seg_ts DESC, writer DESC, segment DESC, bucket DESC, key DESC, start_byte DESC) AS rn FROM twice) WHERE rn = 1",
    "segment_results": f"WITH {LINES_SQL} SELECT bucket, key, CASE WHEN max(line_bytes) > 199 THEN 0 ELSE "
    "count(*) FILTER (WHERE status = 'ok') END AS indexed, count(*) FILTER (WHERE status = 'malformed') AS malformed, "
    "count(*) FILTER (WHERE status = 'skipped') AS skipped, CASE WHEN max(line_bytes) > 199 THEN 'line too long' ELSE '' END AS error "
    "FROM placed GROUP BY 1, 2",
    "cycle_totals": f"WITH {RESULTS_SQL} SELECT CAST(sum(CASE WHEN failed THEN 0 ELSE n END) AS BIGINT) AS total_indexed, "
    "count(*) FILTER (WHERE NOT failed) AS total_segments, count(*) FILTER (WHERE failed) AS total_errors FROM results",
    "malformed_lines": f"WITH {LINES_SQL} SELECT count(*) AS malformed_lines FROM placed WHERE status = 'malformed'",
    "delta_counts": f"WITH RECURSIVE {BASE_SQL}, {shards_sql(16)}, c AS (SELECT shard, count(DISTINCT {DAY}) AS n FROM base "
    "JOIN shards USING (user_id) GROUP BY 1) SELECT CAST(i AS INTEGER) AS shard, coalesce(n, 0) AS deltas "
    "FROM range(20) t(i) LEFT JOIN c ON c.shard = i",
    "compaction_due": f"WITH RECURSIVE {BASE_SQL}, {shards_sql(16)} SELECT shard, count(DISTINCT {DAY}) AS deltas FROM base "
    "JOIN shards USING (user_id) GROUP BY 1 HAVING deltas >= 30",
    "flush_packing": packing_sql(90, 15_000, "SELECT part AS partition, concat('', event_id) AS event_id, seg AS seg_no FROM f"),
    "flush_interval_segments": f"WITH {MESSAGES_SQL} SELECT sec - sec % 10 AS slot_start, sec - sec % 10 + 10 AS slot_end, "
    "count(*) AS events, CAST(sum(bytes) AS BIGINT) AS bytes FROM accepted GROUP BY 1, 2",
    "segment_manifest": packing_sql(
        500, 60_000,
        "SELECT concat('events/1704067200/w0/segment=b000000007-', part, '-', seg) AS key, 'w0' AS instance_id, "
        "concat('segment=b000000007-', part, '-', seg) AS segment_id, count(*) AS event_count, CAST(7 AS BIGINT) AS batch_id, "
        "CAST(1704067200 AS BIGINT) AS flush_ts, CAST(sum(bytes + 1) AS BIGINT) AS size_bytes FROM f GROUP BY part, seg"),
    "manifest_joins_listing": packing_sql(
        500, 60_000,
        ", s AS (SELECT count(DISTINCT concat(part, '-', seg)) AS n, count(*) AS events FROM f) "
        "SELECT n AS segments, n AS in_manifest, n AS in_listing, n AS same_size, n AS same_id, events FROM s"),
    # Segment 1-0 is broken; the cursor stops at the last segment before it, in order of their ids as text.
    "index_cycle_with_failures": packing_sql(
        500, 60_000,
        ", s AS (SELECT concat('segment=b000000007-', part, '-', seg) AS id, count(*) FILTER (WHERE event_id % 50 <> 4) AS n FROM f GROUP BY part, seg), "
        "good AS (SELECT * FROM s WHERE id <> 'segment=b000000007-1-0') "
        "SELECT CAST(sum(n) AS BIGINT) AS total_indexed, count(*) + 1 AS total_segments, (SELECT count(*) FROM s) - count(*) AS total_errors, "
        "CAST(sum(n) AS BIGINT) AS entries, max(id) FILTER (WHERE id < 'segment=b000000007-1-0') AS cursor_segment FROM good"),
    "index_cycle_from_manifest": packing_sql(
        500, 60_000,
        "SELECT count(*) FILTER (WHERE event_id % 50 <> 4) AS total_indexed, count(DISTINCT concat(part, '-', seg)) AS total_segments, "
        "CAST(count(*) FILTER (WHERE part IS NULL) AS BIGINT) AS total_errors FROM f"),
    # Of equal entries the one of the latest segment counts: the stream's where it has the event.
    "index_batch_then_stream": f"WITH RECURSIVE {ENTRIES_SQL} SELECT shard, count(*) AS entries, "
    "count(*) FILTER (WHERE no % 3 > 0) AS from_stream FROM entries GROUP BY 1",
    "segments_read_back": f"WITH {MESSAGES_SQL} SELECT count(*) AS lines, CAST(sum(length(value)) AS BIGINT) AS chars, "
    "CAST(sum(bytes + 1) AS BIGINT) AS bytes, CAST(0 AS BIGINT) AS size_mismatches FROM accepted",
    "batch_bytes": f"WITH {MESSAGES_SQL} SELECT event_type, count(*) AS events, CAST(sum(bytes) AS BIGINT) AS bytes "
    "FROM accepted GROUP BY 1",
    "ingest_counters": f"WITH {RECORDED} SELECT consumed, duplicates, rejected, flushed, uploads, failed_flushes FROM recorded",
    "flush_success_recorded": f"WITH {RECORDED}, p AS (SELECT *, 100 - failed_flushes / (uploads + failed_flushes + 0.001::DOUBLE) * 100 AS pct FROM recorded) "
    "SELECT 'w0' AS instance, uploads, failed_flushes AS failures, round(pct, 6) AS success_pct, CASE WHEN pct >= 99.9 THEN 'green' "
    "WHEN pct >= 99 THEN 'yellow' ELSE 'red' END AS band FROM p",
    "recorded_stages": f"WITH {RECORDED} SELECT 'w0' AS instance, unnest(['event_processing_duration_seconds', 'kafka_fetch_duration_seconds', "
    "'s3_upload_duration_seconds', 'flush_duration_seconds', 'wal_write_duration_seconds']) AS stage, uploads AS n FROM recorded",
    "events_per_second": f"WITH {MESSAGES_SQL} SELECT sec AS second, count(*) AS events FROM accepted GROUP BY 1",
    "live_ids": f"WITH {BASE_SQL} SELECT count(DISTINCT concat(user_id, '/', event_type)) AS live_ids FROM base "
    "WHERE sec BETWEEN 1705363200 - 21600 AND 1705363200",
    "capacity_flags": f"WITH {MESSAGES_SQL}, s AS (SELECT sec - sec % 3600 AS slot_start, count(*) AS events, "
    "CAST(sum(bytes) AS BIGINT) AS bytes FROM accepted GROUP BY 1) SELECT slot_start, events, bytes, "
    "round(greatest(events / 18.0::DOUBLE, bytes / 3000.0::DOUBLE), 6) AS fill, "
    "greatest(events / 18.0::DOUBLE, bytes / 3000.0::DOUBLE) >= 0.85 AS near_capacity FROM s",
    "flush_rates": f"WITH {BASE_SQL}, d AS (SELECT {DAY} AS day, count(*) AS n, sum(cents) AS b, sum(cents % 7) / 10.0::DOUBLE AS s "
    "FROM base GROUP BY 1) SELECT day, CASE WHEN s > 0 THEN round(b / 1048576.0::DOUBLE / s, 6) END AS mb_per_s, "
    "round(s / n, 6) AS s_per_event FROM d",
    "counter_rate_1m": RATE_SQL.format(samples=SAMPLES_SQL, name="events_consumed_total"),
    "flushed_rate_1m": RATE_SQL.format(samples=SAMPLES_SQL, name="events_flushed_total"),
    "counter_rate_trailing": trailing_sql("events_consumed_total", 60, 30),
    "flushed_rate_trailing": trailing_sql("events_flushed_total", 3600, 1800),
    "latest_totals": f"WITH {SAMPLES_SQL} SELECT name, instance, {LATEST} AS value FROM samples GROUP BY 1, 2",
    "flush_success_pct": SIDE_BY_SIDE.format(samples=SAMPLES_SQL, a="s3_uploads_total", b="flush_failures_total")
    + ", p AS (SELECT *, 100 - b / (a + b + 0.001::DOUBLE) * 100 AS pct FROM l) SELECT instance, a AS uploads, b AS failures, "
    "round(pct, 6) AS success_pct, CASE WHEN pct >= 99.9 THEN 'green' WHEN pct >= 99 THEN 'yellow' ELSE 'red' END AS band FROM p",
    "pending_flush": SIDE_BY_SIDE.format(samples=SAMPLES_SQL, a="events_consumed_total", b="events_flushed_total")
    + "SELECT instance, a AS consumed, b AS flushed, a - b AS pending, CASE WHEN a - b >= 8000 THEN 'red' "
    "WHEN a - b >= 5000 THEN 'yellow' ELSE 'green' END AS band FROM l",
    "buffer_gauges": SIDE_BY_SIDE.format(samples=SAMPLES_SQL, a="buffer_events", b="buffer_bytes")
    + "SELECT instance, a AS buffer_events, round(b / 1048576.0::DOUBLE, 6) AS buffer_mb, CASE WHEN a >= 8500 THEN 'red' "
    "WHEN a >= 7000 THEN 'yellow' ELSE 'green' END AS events_band, CASE WHEN b / 1048576.0::DOUBLE >= 17 THEN 'red' "
    "WHEN b / 1048576.0::DOUBLE >= 14 THEN 'yellow' ELSE 'green' END AS mb_band FROM l",
    "stage_latency_quantiles": f"WITH {TIMINGS_SQL}, w AS (SELECT stage, seconds, unnest(range(sec - sec % 30 - 270, "
    "sec - sec % 30 + 30, 30)) AS window_start FROM timings), q AS (SELECT stage, window_start, "
    "quantile_cont(seconds, [0.5, 0.95, 0.99]) AS qs FROM w GROUP BY 1, 2) SELECT stage, window_start, "
    "unnest([0.5::DOUBLE, 0.95::DOUBLE, 0.99::DOUBLE]) AS prob, round(unnest(qs), 6) AS quantile FROM q",
    "stage_latency_overall": f"WITH {TIMINGS_SQL}, q AS (SELECT stage, quantile_cont(seconds, [0.5, 0.95, 0.99]) AS qs "
    "FROM timings GROUP BY 1) SELECT stage, unnest([0.5::DOUBLE, 0.95::DOUBLE, 0.99::DOUBLE]) AS prob, "
    "round(unnest(qs), 6) AS quantile FROM q",
    "stage_latency_sketched": f"WITH {TIMINGS_SQL}, w AS (SELECT stage, unnest(range({DAY} - 518400, {DAY} + 86400, 86400)) AS window_start FROM timings) "
    "SELECT stage, window_start, count(*) AS n, prob, true AS within FROM w, (SELECT unnest([0.5::DOUBLE, 0.95::DOUBLE, 0.99::DOUBLE]) AS prob) GROUP BY ALL",
    "histogram_buckets": f"WITH {TIMINGS_SQL}, e AS (SELECT unnest([0.001, 0.005, 0.01, 0.02, 0.03, 0.05])::DOUBLE AS le) "
    "SELECT stage, le, count(*) FILTER (WHERE seconds <= le) AS n FROM timings, e GROUP BY 1, 2",
    "histogram_quantile": f"WITH {TIMINGS_SQL}, e AS (SELECT unnest([0.001::DOUBLE, 0.005, 0.01, 0.02, 0.03, 0.05, 'inf'::DOUBLE]) AS le), "
    "c AS (SELECT stage, le, count(*) FILTER (WHERE seconds <= le) AS n FROM timings, e GROUP BY 1, 2), "
    "s AS (SELECT *, lag(le) OVER w AS lo, coalesce(lag(n) OVER w, 0) AS below, max(n) OVER (PARTITION BY stage) AS total "
    "FROM c WINDOW w AS (PARTITION BY stage ORDER BY le)), r AS (SELECT s.*, prob, prob * total AS rank FROM s, "
    "(SELECT unnest([0.5, 0.95, 0.99])::DOUBLE AS prob)) SELECT stage, prob, round(CASE WHEN isinf(le) THEN lo WHEN n = below THEN le "
    "ELSE coalesce(lo, 0) + (le - coalesce(lo, 0)) * (rank - below) / (n - below) END, 6) AS quantile FROM r "
    "WHERE n >= rank AND (below < rank OR lo IS NULL)",
    "health_report": f"WITH {REPORT_PARTS} SELECT 'ok' AS status, 'w0' AS instance_id, n AS buffer_events, "
    "round(b / 1048576.0::DOUBLE, 2) AS buffer_mb, eps AS events_per_sec FROM gauges, rate",
    "metrics_report": f"WITH {REPORT_PARTS}, {RECORDED[len(MESSAGES_SQL) + 2:]} SELECT 'w0' AS instance_id, consumed AS total_consumed, "
    "flushed AS total_flushed, eps AS events_per_sec, uploads AS total_s3_uploads, failed_flushes, rejected AS dlq_count, "
    "duplicates AS duplicates_filtered, n AS buffer_events, round(b / 1048576.0::DOUBLE, 2) AS buffer_mb, "
    "CAST(10000 AS BIGINT) AS buffer_limit_events, CAST(20 AS BIGINT) AS buffer_limit_mb, "
    "CAST(1705363200 + 2592000 - (SELECT max(sec) FROM accepted) AS DOUBLE) AS last_flush_ago_s, "
    "(SELECT count(DISTINCT event_id) FROM accepted WHERE sec BETWEEN 1705363200 - 300 AND 1705363200) AS dedup_cache_size "
    "FROM gauges, rate, recorded",
    "index_entries_per_shard": PER_SHARD,
    "index_compacted": f"WITH RECURSIVE {MESSAGES_SQL}, {shards_sql(16)} SELECT shard, count(*) AS entries, count(*) AS row_keys, "
    "min(sec) AS first_ts FROM accepted JOIN shards USING (user_id) WHERE ref <> '' GROUP BY 1",
    "staged_reload": f"WITH {MESSAGES_SQL} SELECT concat('', event_id) AS event_id, ref AS reference_id, "
    "sec AS timestamp, category, event_type, bytes AS payload_bytes FROM accepted",
    "messages_from_files": f"WITH {MESSAGES_SQL} SELECT reason, count(*) AS n, CAST(sum(strlen(value)) AS BIGINT) AS bytes "
    "FROM messages GROUP BY 1",
    # Every tenth message comes twice: a valid one is stored once, a rejected one twice.
    "stream_ingest": f"WITH {MESSAGES_SQL}, sent AS (SELECT * FROM messages UNION ALL SELECT * FROM messages "
    "WHERE event_id % 10 = 0 AND reason <> '') SELECT reason, count(*) AS n, CAST(sum(strlen(value)) AS BIGINT) AS bytes "
    "FROM sent GROUP BY 1",
    "stream_events_per_second": f"WITH {LATE_SQL} SELECT sec AS second, count(*) AS events FROM counted WHERE sec + 1 <= z - 86400 GROUP BY 1",
    "stream_flush_intervals": f"WITH {LATE_SQL} SELECT sec - sec % 10 AS slot_start, sec - sec % 10 + 10 AS slot_end, count(*) AS events, "
    "CAST(sum(bytes) AS BIGINT) AS bytes FROM counted WHERE sec - sec % 10 + 10 <= z - 86400 GROUP BY 1, 2",
    "stream_index": PER_SHARD,
    "stream_dedup": dedup_sql("user_id, event_type", "event_id", 3600, "event_id, user_id, event_type, sec AS timestamp"),
    "stream_dedup_across_batches": dedup_sql("user_id, event_type", "event_id", 3600, "event_id, user_id, event_type, sec AS timestamp"),
    "live_ids_from_state": "SELECT count(*) AS known_ids, count(*) FILTER (WHERE last BETWEEN 1705363200 - 21600 AND 1705363200) AS live_ids, "
    "CAST(sum(last) AS BIGINT) AS last_kept FROM (SELECT max(timestamp) AS last FROM ("
    + dedup_sql("user_id, event_type", "event_id", 3600, "user_id, event_type, sec AS timestamp") + ") GROUP BY user_id, event_type)",
    "stream_dedup_arrival_clock": "SELECT DISTINCT user_id, event_type FROM events",
    "stream_dedup_event_clock": "SELECT event_type, count(DISTINCT user_id) AS users FROM events GROUP BY 1",
}
# In one micro-batch both clocks keep the same rows of exact copies.
ORACLES["stream_ingest_arrival_clock"] = ORACLES["stream_ingest"]
