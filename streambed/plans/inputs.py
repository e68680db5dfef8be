"""Inputs for the registered queries, derived from the ``events`` table.

The expressions are plain SQL that Spark and the checking engine both read, so both sides
start from the same texts. What the queries then do with them is written once per side.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


ISO = "date_format(ts, \"yyyy-MM-dd'T'HH:mm:ss'Z'\")"
ISO_SQL = "strftime(ts, '%Y-%m-%dT%H:%M:%SZ')"

BASE_SQL = (
    "base AS (SELECT event_id, user_id, event_type, props, ts, "
    "CAST(epoch_us(ts) // 1000000 AS BIGINT) AS sec, "
    "CAST(round(value * 100) AS BIGINT) AS cents FROM events)"
)

DAY = "(sec - sec % 86400)"
BUCKET = "concat('events-', user_id % 6)"
KEY = f"concat('events/', {DAY}, '/w', user_id % 3, '/', event_type, '.ndjson')"


def body(iso: str) -> str:
    """A full envelope with some text outside ASCII."""
    return (
        "concat('{\"_event_id\":\"', event_id, '\",\"_event_timestamp\":\"', " + iso
        + ", '\",\"_category\":\"', event_type, '\",\"_event_type\":\"', event_type, "
        "'\",\"_version\":\"1\",\"reference_id\":\"', user_id, '\",\"_data\":{\"hashUID\":\"', "
        "user_id, '\",\"authResult\":\"é\",\"authDuration\":', cents, ',\"extra\":', props, '}}')"
    )


def message(iso: str) -> str:
    """An envelope with a fault in seven of fifty rows: cut off, no id, no time, bad time,
    no reference, text after the value, number for text."""
    return (
        "CASE event_id % 50 "
        "WHEN 0 THEN concat('{\"_event_id\":\"', event_id) "
        "WHEN 1 THEN concat('{\"_event_timestamp\":\"', " + iso + ", '\"}') "
        "WHEN 2 THEN concat('{\"_event_id\":\"', event_id, '\"}') "
        "WHEN 3 THEN concat('{\"_event_id\":\"', event_id, '\",\"reference_id\":\"', user_id, "
        "'\",\"_event_timestamp\":\"yesterday\"}') "
        "WHEN 4 THEN concat('{\"_event_id\":\"', event_id, '\",\"_event_timestamp\":\"', " + iso
        + ", '\",\"_event_type\":\"', event_type, '\"}') "
        "WHEN 5 THEN concat(" + body(iso) + ", ' x') "
        "WHEN 6 THEN concat('{\"_event_id\":', event_id, ',\"_event_timestamp\":\"', " + iso + ", '\"}') "
        "ELSE " + body(iso) + " END"
    )


def base(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    stamp = F.col("ts").cast("timestamp")
    return events.select(
        "event_id", "user_id", "event_type", "props", stamp.alias("ts"),
        F.unix_seconds(stamp).alias("sec"), F.round(F.col("value") * 100).cast("long").alias("cents"),
    )


def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One message per event, three source partitions, offsets in event order."""
    return base(spark, sf_dir).select(
        F.expr(message(ISO)).alias("value"),
        F.lit("events").alias("topic"),
        (F.col("user_id") % 3).cast("int").alias("partition"),
        F.col("event_id").alias("offset"),
        F.col("event_id").alias("arrival"),
    )


def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The messages as segment lines. Segments of odd days count as large files, read in
    splits of a thousand event numbers."""
    rows = base(spark, sf_dir).select(
        F.expr(BUCKET).alias("bucket"), F.expr(KEY).alias("key"), F.expr(message(ISO)).alias("line"),
        F.col("event_id").alias("line_no"), F.expr(f"{DAY} div 86400 % 2").alias("__odd"),
    )
    return rows.select(
        "bucket", "key", "line", "line_no",
        F.octet_length("line").alias("line_bytes"),
        F.when(F.col("__odd") == 1, 1 << 30).otherwise(1 << 10).cast("long").alias("file_size"),
        F.floor(F.col("line_no") / 1000).cast("long").alias("split_start"),
    )


LINES_SQL = (
    f"{BASE_SQL}, lines AS (SELECT event_id, user_id, event_type, sec, {BUCKET} AS bucket, "
    f"{KEY} AS key, {message(ISO_SQL)} AS line FROM base), "
    "placed AS (SELECT *, CAST(coalesce(sum(strlen(line) + 1) OVER (PARTITION BY bucket, key "
    "ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS start_byte, "
    "CAST(strlen(line) AS BIGINT) AS line_bytes, "
    "CASE WHEN event_id % 50 IN (0, 5, 6) THEN 'malformed' "
    "WHEN event_id % 50 IN (1, 2, 4) THEN 'skipped' ELSE 'ok' END AS status, "
    "CASE WHEN event_id % 50 = 3 THEN 0 ELSE sec END AS idx_ts FROM lines)"
)


def listed_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Listed objects, one per bucket, day, writer and type; some keys are malformed."""
    return base(spark, sf_dir).groupBy(
        F.expr(BUCKET).alias("bucket"), F.expr(LISTED_KEY).alias("key")
    ).agg(F.sum("cents").alias("size"))


LISTED_KEY = (
    f"CASE event_type WHEN 'signup' THEN concat('events/x', {DAY}, '/w', user_id % 3, '/s.ndjson') "
    f"WHEN 'click' THEN concat('events/', {DAY}, '/w', user_id % 3) "
    f"WHEN 'view' THEN concat('events/', {DAY}, '/w', user_id % 3, '/view.ndjson/extra.txt') "
    f"ELSE {KEY} END"
)
LISTED_SQL = (
    f"{BASE_SQL}, listed AS (SELECT {BUCKET} AS bucket, {LISTED_KEY} AS key, "
    "CAST(sum(cents) AS BIGINT) AS size FROM base GROUP BY 1, 2)"
)


def cycle_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Segment results where segments of type ``error`` fail on every seventh day."""
    failed = (F.col("event_type") == "error") & (F.expr(f"{DAY} div 86400 % 7") == 0)
    return (
        base(spark, sf_dir)
        .groupBy(F.expr(BUCKET).alias("bucket"), F.expr(KEY).alias("key"))
        .agg(
            F.count("*").alias("indexed"), F.lit(0).cast("long").alias("malformed"),
            F.lit(0).cast("long").alias("skipped"),
            F.max(F.when(failed, F.lit("unreadable"))).alias("error"),
        )
        .withColumn("indexed", F.when(F.col("error").isNull(), F.col("indexed")).otherwise(0))
    )


RESULTS_SQL = (
    f"{BASE_SQL}, results AS (SELECT {BUCKET} AS bucket, {KEY} AS key, min({DAY}) AS seg_ts, "
    "min(concat('w', user_id % 3)) AS writer, event_type AS segment, count(*) AS n, "
    f"max(event_type = 'error' AND {DAY} // 86400 % 7 = 0) AS failed FROM base GROUP BY 1, 2, event_type)"
)


def counter_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Samples of four counters and two gauges, one per event, per instance ``user_id % 3``.

    Counter values follow the event number and restart from zero every 2000 events.
    """
    run = F.col("event_id") % 2000
    rows = base(spark, sf_dir).select(
        F.timestamp_seconds(F.col("sec") + F.lit(0)).alias("sec_ts"), "ts", "event_id",
        F.concat(F.lit("w"), F.col("user_id") % 3).alias("instance"), "event_type", run.alias("run"),
    )
    return rows.select("ts", "instance", F.expr(SAMPLE_NAME).alias("name"), F.expr(SAMPLE_VALUE).alias("value"))


SAMPLE_NAME = (
    "CASE event_type WHEN 'click' THEN 'events_consumed_total' WHEN 'view' THEN 'events_flushed_total' "
    "WHEN 'purchase' THEN 's3_uploads_total' WHEN 'error' THEN 'flush_failures_total' "
    "ELSE CASE WHEN event_id % 2 = 0 THEN 'buffer_events' ELSE 'buffer_bytes' END END"
)
SAMPLE_VALUE = (
    "CASE event_type WHEN 'click' THEN run * 9 WHEN 'view' THEN run * 5 WHEN 'purchase' THEN run "
    "WHEN 'error' THEN run % 3 ELSE CASE WHEN event_id % 2 = 0 THEN run * 5 ELSE run * 12000 END END"
)
SAMPLES_SQL = (
    f"{BASE_SQL}, runs AS (SELECT *, event_id % 2000 AS run FROM base), "
    f"samples AS (SELECT ts, sec, concat('w', user_id % 3) AS instance, {SAMPLE_NAME} AS name, "
    f"CAST({SAMPLE_VALUE} AS BIGINT) AS value FROM runs)"
)


def stage_timings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return base(spark, sf_dir).select(
        "ts", F.concat(F.lit("w"), F.col("user_id") % 3).alias("instance"),
        F.col("event_type").alias("stage"), (F.col("cents") / 10000).alias("seconds"),
    )


TIMINGS_SQL = f"{BASE_SQL}, timings AS (SELECT ts, sec, event_type AS stage, cents / 10000 AS seconds FROM base)"


def shards_sql(num_shards: int) -> str:
    """CTEs ``hashed`` and ``shards(user_id, shard)`` for every user of ``base``."""
    return (
        "hashed AS (SELECT user_id, list_reduce(list_concat([14695981039346656037::HUGEINT], "
        "list_transform(range(1, len(concat('ref:', user_id)) + 1), "
        "lambda i: ascii(substr(concat('ref:', user_id), i, 1))::HUGEINT)), "
        "lambda h, c: (xor(h, c) * 1099511628211) % 18446744073709551616::HUGEINT) AS k "
        "FROM (SELECT DISTINCT user_id FROM base)), "
        "jump AS (SELECT user_id, k, CAST(-1 AS BIGINT) AS b, CAST(0 AS BIGINT) AS j FROM hashed UNION ALL "
        "SELECT user_id, k2, j, CAST(floor((j + 1) * (2147483648.0::DOUBLE / ((k2 // 8589934592) + 1)::DOUBLE)) AS BIGINT) "
        "FROM (SELECT user_id, j, (k * 2862933555777941757 + 1) % 18446744073709551616::HUGEINT AS k2 "
        f"FROM jump WHERE j < {num_shards})), "
        f"shards AS (SELECT user_id, CAST(b AS INTEGER) AS shard FROM jump WHERE j >= {num_shards})"
    )
