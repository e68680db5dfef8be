"""Sizes, counters and rates of the ingest itself."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .packing import MAX_BYTES, MAX_ROWS

# Fixed value: the fill share from which a buffer counts as nearly full.
NEAR_CAPACITY = 0.85


def beside(row: DataFrame, *others: DataFrame) -> DataFrame:
    """One row made of several one-row tables, each fetched as a scalar subquery."""
    for at, other in enumerate(others):
        name = f"__{at}"
        row = row.withColumn(name, other.select(F.struct(*other.columns)).scalar())
        row = row.select(*[c for c in row.columns if c != name], f"{name}.*")
    return row


def batch_sizes(
    events: DataFrame, group: Sequence[str] = (), payload: str = "payload"
) -> DataFrame:
    """Events and payload bytes per group."""
    return events.groupBy(*group).agg(
        F.count("*").alias("events"),
        F.coalesce(F.sum(F.octet_length(payload)), F.lit(0)).alias("bytes"),
    )


def ingest_counters(
    batches: DataFrame, manifest: DataFrame, failures: DataFrame | None = None
) -> DataFrame:
    """One row of totals.

    ``batches`` has per micro-batch ``accepted, duplicates, rejected``; the manifest has
    one row per uploaded segment; ``failures`` one row per failed flush.
    """
    total = lambda name: F.coalesce(F.sum(name), F.lit(0))
    taken = batches.agg(
        total("accepted").alias("consumed"),
        total("duplicates").alias("duplicates"),
        total("rejected").alias("rejected"),
    )
    written = manifest.agg(
        total("event_count").alias("flushed"), F.count("*").alias("uploads")
    )
    joined = beside(taken, written)
    if failures is None:
        return joined.withColumn("failed_flushes", F.lit(0).cast("long"))
    return beside(joined, failures.agg(F.count("*").alias("failed_flushes")))


def events_per_second(events: DataFrame, seconds_col: str = "timestamp") -> DataFrame:
    """Events per second that had any."""
    return events.groupBy(F.col(seconds_col).alias("second")).agg(F.count("*").alias("events"))


def live_ids(
    events: DataFrame, id_cols: Sequence[str], now_s: int, window_s: int,
    seconds_col: str = "timestamp",
) -> DataFrame:
    """Distinct ids whose time is at most ``window_s`` before ``now_s``."""
    recent = events.where(
        (F.col(seconds_col) >= now_s - window_s) & (F.col(seconds_col) <= now_s)
    )
    return recent.agg(F.count_distinct(*[F.col(c) for c in id_cols]).alias("live_ids"))


def capacity_flags(
    sizes: DataFrame, limit_events: int = MAX_ROWS, limit_bytes: int = MAX_BYTES
) -> DataFrame:
    """Add the fill share of ``events, bytes`` and whether it is near the limit."""
    fill = F.greatest(F.col("events") / F.lit(limit_events), F.col("bytes") / F.lit(limit_bytes))
    return sizes.withColumn("fill", fill).withColumn("near_capacity", fill >= NEAR_CAPACITY)


def flush_rates(flushes: DataFrame) -> DataFrame:
    """Add MB per second and seconds per event to ``events, bytes, seconds``."""
    return flushes.withColumn(
        "mb_per_s", F.when(F.col("seconds") > 0, F.col("bytes") / (1024 * 1024) / F.col("seconds"))
    ).withColumn(
        "s_per_event", F.when(F.col("events") > 0, F.col("seconds") / F.col("events"))
    )
