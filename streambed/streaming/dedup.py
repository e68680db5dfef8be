"""Duplicate removal on streams."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..operators.dedup import DEFAULT_WINDOW_S

#: Groups that ``keep_late`` deals ids to; a stream keeps the number it started with.
STATE_BUCKETS = 256
MODES = ("keep_late", "arrival_clock", "event_clock")


def dedup_stream(
    events: DataFrame,
    id_cols: Sequence[str],
    ts_col: str,
    window_s: int | None = DEFAULT_WINDOW_S,
    mode: str = "keep_late",
    order_col: str = "arrival",
    buckets: int = STATE_BUCKETS,
) -> DataFrame:
    """Drop repeats of an id within the window. ``ts_col`` holds unix seconds.

    ``keep_late``      per id the time of its last kept row; late rows of other ids are
                       kept however late. The same rule as the batch form. The state holds ids and times only
                       (``state_ids`` reads them). Rows without an id are kept and not remembered.
    ``arrival_clock``  built in, no Python: an id is silenced for the window after it was
                       first seen, by the clock of the micro-batch. Nothing is too late. Which of an id's
                       rows in one micro-batch stays is open.
    ``event_clock``    built in: by event time with a watermark, so late rows are dropped.
    """
    if window_s is None:
        return events
    ids = list(id_cols)
    if mode == "arrival_clock":
        return (
            events.withColumn("__seen", F.current_timestamp())
            .withWatermark("__seen", f"{window_s} seconds")
            .dropDuplicatesWithinWatermark(ids)
            .drop("__seen")
        )
    if mode == "event_clock":
        return (
            events.withColumn("__at", F.timestamp_seconds(F.col(ts_col)))
            .withWatermark("__at", f"{window_s} seconds")
            .dropDuplicatesWithinWatermark(ids)
            .drop("__at")
        )
    if mode != "keep_late":
        raise ValueError(f"mode must be one of {MODES}")
    thinned = without_stale_copies(events, ids, ts_col, order_col)
    return _keep_late(thinned, ids, ts_col, window_s, order_col, buckets)


def without_stale_copies(
    events: DataFrame, ids: Sequence[str], ts_col: str, order_col: str = "arrival"
) -> DataFrame:
    """Drop, before any shuffle, rows no newer than an earlier row of their id.

    Such a row is never kept, whatever the state holds: the earlier row was kept, or was
    silenced by one that silences this row too. So a flood of copies of one id leaves a
    source task as a few rows. Looks at one Arrow batch at a time. Rows without an
    arrival number get one from their place in the task.
    """
    ids = list(ids)

    def thin(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        number = TaskContext.get().partitionId() << 33
        for batch in batches:
            if batch[order_col].isna().any():
                batch[order_col] = np.arange(number, number + len(batch))
                number += len(batch)
            batch = batch.sort_values(order_col, kind="stable")
            by = [batch[c] for c in ids]
            best = batch.groupby(by, sort=False, dropna=False)[ts_col].cummax()
            earlier = best.groupby(by, sort=False, dropna=False).shift()
            yield batch[earlier.isna() | (batch[ts_col] > earlier) | batch[ids].isna().all(axis=1)]

    return events.mapInPandas(thin, events.schema)


@contextmanager
def drained(spark: SparkSession, once: bool = True) -> Iterator[None]:
    """Let a query started inside stop when its input ends.

    A state timeout by the clock asks for another batch without data for ever; a run that
    drains its input and stops does without.
    """
    key = "spark.sql.streaming.noDataMicroBatches.enabled"
    before = spark.conf.get(key)
    if once:
        spark.conf.set(key, "false")
    try:
        yield
    finally:
        spark.conf.set(key, before)


_STATE = "ids array<string>, last array<long>, seen array<long>"


def _keep_late(
    events: DataFrame, ids: list[str], ts_col: str, window_s: int, order_col: str, buckets: int
) -> DataFrame:
    """Buckets of ids are the groups, so a batch costs one call per bucket and not one per id.

    A bucket's state holds its live ids, the time of the last kept row of each and when that was; payloads are never held. An id
    goes once the window has passed by the clock since it was seen and its last time is out of the window too: by then no on-time row
    can repeat it.
    """
    def judge(_key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        now_s = state.getCurrentProcessingTimeMs() // 1000
        held = pd.DataFrame(dict(zip(("id", "last", "seen"), state.get, strict=True)) if state.exists else {"id": [], "last": [], "seen": []})
        held = held[~((now_s - held["seen"] >= window_s) & (now_s - held["last"] > window_s))]
        last = pd.Series(held["last"].to_numpy(np.int64), index=held["id"].to_numpy(object))
        seen = pd.Series(held["seen"].to_numpy(np.int64), index=last.index)
        if not state.hasTimedOut:
            rows = pd.concat(list(batches), ignore_index=True)
            named = rows["__id"].notna().to_numpy()
            some, keep = rows[named], ~named
            keep[named], kept_last = opened(some["__id"].to_numpy(object), some[ts_col].to_numpy(np.int64), some[order_col].to_numpy(), last, window_s)
            last = kept_last.combine_first(last).astype(np.int64) if len(last) else kept_last
            seen = pd.Series(np.where(last.index.isin(kept_last.index), now_s, seen.reindex(last.index).fillna(now_s)), index=last.index)
            if keep.any():
                yield rows if keep.all() else rows[keep]
        if len(last):
            state.update((last.index.tolist(), last.tolist(), seen.astype(np.int64).tolist()))
            state.setTimeoutDuration(window_s * 1000)
        elif state.exists:
            state.remove()

    name = F.col(ids[0]).cast("string") if len(ids) == 1 else F.to_json(F.struct(*ids), {"ignoreNullFields": "false"})
    named = events.withColumn("__id", F.when(F.coalesce(*[F.col(c).cast("string") for c in ids]).isNotNull(), name))
    spread = F.xxhash64(F.coalesce("__id", F.col(order_col).cast("string")))
    dealt = named.withColumn("__bucket", F.pmod(spread, F.lit(buckets)).cast("int"))
    judged = dealt.groupBy("__bucket").applyInPandasWithState(judge, dealt.schema, _STATE, "append", GroupStateTimeout.ProcessingTimeTimeout)
    return judged.drop("__id", "__bucket")


def opened(ids: np.ndarray, seconds: np.ndarray, order: np.ndarray, last: pd.Series, window_s: int) -> tuple[np.ndarray, pd.Series]:
    """Which rows are kept, and the time of the last kept row of each id that has rows.

    Rows count in their order; ``last`` is the time of the last kept row of ids known before. All ids take a step at a time.
    """
    code, names = pd.factorize(ids)
    at = np.lexsort((order, code))
    begins = np.flatnonzero(np.r_[True, code[at][1:] != code[at][:-1]])
    size = np.diff(np.r_[begins, len(at)])
    before = last.reindex(names)
    known = before.notna().to_numpy()
    time = before.fillna(0).to_numpy(np.int64)
    keep = np.zeros(len(ids), bool)
    open_, step = np.arange(len(names)), 0
    while len(open_):
        row = at[begins[open_] + step]
        passes = ~known[open_] | (seconds[row] - time[open_] > window_s)
        keep[row[passes]] = True
        time[open_[passes]] = seconds[row[passes]]
        known[open_] = True
        step += 1
        open_ = open_[size[open_] > step]
    return keep, pd.Series(time, index=names)


def state_ids(spark: SparkSession, checkpoint: str) -> DataFrame:
    """``id, last, seen``: the live ids of a ``keep_late`` stream, read from the state in its checkpoint."""
    held = spark.read.format("statestore").load(checkpoint).select("value.groupState.*")
    return held.select(F.explode(F.arrays_zip("ids", "last", "seen")).alias("x")).select(
        F.col("x.ids").alias("id"), F.col("x.last").alias("last"), F.col("x.seen").alias("seen"))
