"""Monitoring queries over counter samples and stage timings."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.accounting import beside
from ..operators.blocked import previous_values
from ..operators.packing import MAX_BYTES, MAX_ROWS
from ..operators.quantiles import (
    PROBABILITIES,
    SKETCH_K,
    bucket_counts,
    exact_quantiles,
    histogram_quantile,
    sketched_quantiles,
)
from ..sinks.metrics import CONSUMED, DUPLICATES, FAILURES, FLUSHED, REJECTED, UPLOADS

# Gauge names, dashboard bands and histogram bounds.
BUFFER_EVENTS = "buffer_events"
BUFFER_BYTES = "buffer_bytes"
SUCCESS_BANDS = (99.0, 99.9)
PENDING_BANDS = (5000, 8000)
BUFFER_EVENT_BANDS = (7000, 8500)
BUFFER_MB_BANDS = (14, 17)
DEFAULT_BOUNDS = (0, 5, 10, 25, 50, 75, 100, 250, 500, 750, 1000, 2500, 5000, 7500, 10000)
MB = 1024 * 1024


def band(value: Column, bands: Sequence[float], high_is_good: bool = False) -> Column:
    """Colour of a value between two thresholds."""
    low, high = bands
    if high_is_good:
        return F.when(value >= high, "green").when(value >= low, "yellow").otherwise("red")
    return F.when(value >= high, "red").when(value >= low, "yellow").otherwise("green")


def counter_increases(samples: DataFrame, block: str = "1 day") -> DataFrame:
    """Add each sample's increase since the series' previous one; a fall is a restart at 0."""
    day = F.unix_seconds(F.date_trunc("day", "ts")) if block == "1 day" else F.unix_seconds(
        F.window("ts", block).start
    )
    placed = previous_values(
        samples.withColumn("__block", day), ["name", "instance"], "__block", "ts",
        {"__before": "value"},
    )
    grown = F.when(F.col("value") >= F.col("__before"), F.col("value") - F.col("__before"))
    return placed.withColumn(
        "increase", F.when(F.col("__before").isNotNull(), F.coalesce(grown, F.col("value")))
    ).drop("__block", "__before")


def counter_rate(samples: DataFrame, name: str | None = None, window_s: int = 60) -> DataFrame:
    """Increase per second of each series in every window that saw samples."""
    chosen = samples if name is None else samples.where(F.col("name") == name)
    slot = F.window("ts", f"{window_s} seconds")
    return (
        counter_increases(chosen)
        .groupBy("name", "instance", F.unix_seconds(slot.start).alias("window_start"))
        .agg((F.coalesce(F.sum("increase"), F.lit(0)) / window_s).alias("per_second"))
    )


def trailing_rate(
    samples: DataFrame, name: str | None = None, window_s: int = 60, step_s: int = 30, block_s: int = 86_400
) -> DataFrame:
    """Increase per second over the ``window_s`` seconds up to each step, where a series has a sample in them.

    A sample at the step counts, one ``window_s`` before it does not. Series are cut into blocks of time; a block also
    gets the samples of the window before it, so its frames are whole and a series never gathers in one task.
    """
    if block_s < window_s:
        raise ValueError("a block must be as long as the window")
    micro = 1_000_000
    window, step, block = window_s * micro, step_s * micro, block_s * micro
    at, lane = F.unix_micros("ts"), ["name", "instance"]
    chosen = samples if name is None else samples.where(F.col("name") == name)
    grown = counter_increases(chosen).select(*lane, at.alias("at"), F.coalesce("increase", F.lit(0)).alias("increase"))
    exact = lambda value, unit: value - F.pmod(value, F.lit(unit))
    first, last = exact(F.col("at") + (step - 1), step), exact(F.col("at") + (window - 1), step)
    steps = grown.select(*lane, F.explode(F.sequence(first, last, F.lit(step).cast("bigint"))).alias("at")).distinct()
    own = exact(F.col("at"), block)
    near = F.col("at") > own + (block - window)  # within the window of the next block's first step
    placed = grown.withColumn("block", F.explode(F.when(near, F.array(own, own + block)).otherwise(F.array(own)))).withColumn("step", F.lit(False))
    marks = steps.select(*lane, "at", F.lit(0).cast("bigint").alias("increase"), own.alias("block"), F.lit(True).alias("step"))
    frame = Window.partitionBy(*lane, "block").orderBy("at").rangeBetween(-(window - 1), 0)
    summed = placed.unionByName(marks).withColumn("total", F.sum("increase").over(frame))
    return summed.where("step").select(*lane, (F.col("at") / micro).cast("bigint").alias("at"), (F.col("total") / window_s).alias("per_second"))


def latest_counters(samples: DataFrame) -> DataFrame:
    """Last value of every series."""
    return samples.groupBy("name", "instance").agg(
        F.max_by("value", "ts").alias("value"), F.max("ts").alias("ts")
    )


def _by_instance(samples: DataFrame, names: Mapping[str, str]) -> DataFrame:
    """Last values of the named counters side by side, missing ones 0, in one pass."""
    of = lambda name: F.when(F.col("name") == name, F.col("ts"))
    return samples.where(F.col("name").isin(*names.values())).groupBy("instance").agg(
        *[
            F.coalesce(F.max_by("value", of(name)), F.lit(0)).alias(column)
            for column, name in names.items()
        ]
    )


def flush_success(samples: DataFrame, uploads: str = UPLOADS, failures: str = FAILURES) -> DataFrame:
    """Share of flushes that worked, in percent, with its band."""
    latest = _by_instance(samples, {"uploads": uploads, "failures": failures})
    lost = F.col("failures") / (F.col("uploads") + F.col("failures") + F.lit(0.001)) * 100
    return latest.withColumn("success_pct", 100 - lost).withColumn(
        "band", band(F.col("success_pct"), SUCCESS_BANDS, high_is_good=True)
    )


def pending(samples: DataFrame, consumed: str = CONSUMED, flushed: str = FLUSHED) -> DataFrame:
    """Consumed but not yet flushed events, with the band."""
    latest = _by_instance(samples, {"consumed": consumed, "flushed": flushed})
    return latest.withColumn("pending", F.col("consumed") - F.col("flushed")).withColumn(
        "band", band(F.col("pending"), PENDING_BANDS)
    )


def stage_quantiles(
    timings: DataFrame,
    stage: str | None = None,
    probs: Sequence[float] = PROBABILITIES,
    window_s: int = 300,
    step_s: int = 30,
) -> DataFrame:
    """Exact quantiles of a stage over sliding windows.

    Equal values of one step merge first; only those counts are copied into the windows
    that cover the step.
    """
    chosen = timings if stage is None else timings.where(F.col("stage") == stage)
    steps = (
        chosen.withColumn("__step", F.floor(F.unix_seconds("ts") / step_s) * step_s)
        .groupBy("stage", "__step", "seconds")
        .agg(F.count("*").alias("__times"))
    )
    first = F.col("__step") - window_s + step_s
    spread = steps.withColumn("window_start", F.explode(F.sequence(first, F.col("__step"), F.lit(step_s).cast("long"))))
    return exact_quantiles(
        spread, ["stage", "window_start"], "seconds", probs, weight="__times"
    )


def stage_quantiles_sketched(
    timings: DataFrame,
    stage: str | None = None,
    probs: Sequence[float] = PROBABILITIES,
    window_s: int = 300,
    step_s: int = 30,
    k: int = SKETCH_K,
) -> DataFrame:
    """``stage_quantiles`` from one sketch per step, merged into the windows that cover it.

    What is copied into windows is of bounded size, however many values a step has. See ``rank_error`` for how
    far a quantile's rank may be off; up to ``k`` values a window is exact to the rank.
    """
    chosen = timings if stage is None else timings.where(F.col("stage") == stage)
    steps = chosen.withColumn("__step", F.floor(F.unix_seconds("ts") / step_s) * step_s)
    first = F.col("__step") - window_s + step_s
    spread = F.explode(F.sequence(first, F.col("__step"), F.lit(step_s).cast("long")))
    return sketched_quantiles(steps, ["stage", "__step"], "seconds", probs, ["stage", "window_start"], {"window_start": spread}, k)


def recorded_counters(samples: DataFrame) -> DataFrame:
    """One row of an ingest's totals over all its instances, from its recorded counters."""
    last = latest_counters(samples)
    total = lambda name: F.coalesce(F.sum(F.when(F.col("name") == name, F.col("value"))), F.lit(0))
    return last.agg(
        total(CONSUMED).alias("consumed"), total(DUPLICATES).alias("duplicates"), total(REJECTED).alias("rejected"),
        total(FLUSHED).alias("flushed"), total(UPLOADS).alias("uploads"), total(FAILURES).alias("failed_flushes"),
    )


def bucket_quantile(
    timings: DataFrame,
    bounds: Sequence[float] = DEFAULT_BOUNDS,
    probs: Sequence[float] = PROBABILITIES,
    group: Sequence[str] = ("stage",),
) -> DataFrame:
    """Quantiles from histogram buckets."""
    return histogram_quantile(bucket_counts(timings, group, "seconds", bounds), group, probs)


def fill_gauges(
    samples: DataFrame, events_name: str = BUFFER_EVENTS, bytes_name: str = BUFFER_BYTES
) -> DataFrame:
    """Buffered events and MB per instance with their bands."""
    latest = _by_instance(samples, {"buffer_events": events_name, "buffer_bytes": bytes_name})
    mb = F.col("buffer_bytes") / MB
    return latest.select(
        "instance", "buffer_events", mb.alias("buffer_mb"),
        band(F.col("buffer_events"), BUFFER_EVENT_BANDS).alias("events_band"),
        band(mb, BUFFER_MB_BANDS).alias("mb_band"),
    )


def buffered(samples: DataFrame, instance: str) -> DataFrame:
    """One row: an instance's last buffer gauges."""
    of = lambda name: F.coalesce(F.max_by("value", F.when(F.col("name") == name, F.col("ts"))), F.lit(0))
    mine = samples.where((F.col("instance") == instance) & F.col("name").isin(BUFFER_EVENTS, BUFFER_BYTES))
    return mine.agg(of(BUFFER_EVENTS).alias("events"), of(BUFFER_BYTES).alias("bytes"))


def health_report(sizes: DataFrame, rate: DataFrame, instance: str) -> DataFrame:
    """One row: status, instance, buffer fill and current rate.

    ``sizes`` has one row ``events, bytes`` (see ``buffered``); ``rate`` one row ``events_per_sec``.
    """
    return beside(sizes, rate).select(
        F.lit("ok").alias("status"),
        F.lit(instance).alias("instance_id"),
        F.col("events").alias("buffer_events"),
        F.round(F.col("bytes") / MB, 2).alias("buffer_mb"),
        F.coalesce("events_per_sec", F.lit(0)).alias("events_per_sec"),
    )


def metrics_report(
    counters: DataFrame,
    sizes: DataFrame,
    rate: DataFrame,
    live: DataFrame,
    last_flush: DataFrame,
    instance: str,
    limit_events: int = MAX_ROWS,
    limit_bytes: int = MAX_BYTES,
) -> DataFrame:
    """One row of all data figures of the ingest; every input has one row.

    ``last_flush`` has ``last_flush_ago_s``.
    """
    everything = beside(counters, sizes, rate, live, last_flush)
    return everything.select(
        F.lit(instance).alias("instance_id"),
        F.col("consumed").alias("total_consumed"),
        F.col("flushed").alias("total_flushed"),
        F.coalesce("events_per_sec", F.lit(0)).alias("events_per_sec"),
        F.col("uploads").alias("total_s3_uploads"),
        "failed_flushes",
        F.col("rejected").alias("dlq_count"),
        F.col("duplicates").alias("duplicates_filtered"),
        F.col("events").alias("buffer_events"),
        F.round(F.col("bytes") / MB, 2).alias("buffer_mb"),
        F.lit(limit_events).cast("long").alias("buffer_limit_events"),
        F.lit(limit_bytes // MB).cast("long").alias("buffer_limit_mb"),
        F.round("last_flush_ago_s", 1).alias("last_flush_ago_s"),
        F.col("live_ids").alias("dedup_cache_size"),
    )
