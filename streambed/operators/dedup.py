"""Duplicate removal on bounded tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .blocked import match, without_nulls
from .chain import mark_openers

DEFAULT_WINDOW_S = 300


def dedup_batch(
    events: DataFrame,
    id_cols: Sequence[str],
    order_col: str,
    ts_col: str,
    window_s: int | None = DEFAULT_WINDOW_S,
    block_s: int = 30 * 86_400,
) -> DataFrame:
    """Keep a row when no row of its id was kept in the last ``window_s`` seconds.

    Rows are taken in order of ``order_col`` (unique per id); a kept row silences its id
    for every time up to ``window_s`` after its own, so older rows are silenced as well.
    ``window_s=None`` switches removal off.
    """
    if window_s is None:
        return events
    kept = kept_keys(events, id_cols, order_col, ts_col, window_s, block_s)
    return match(events, kept, [*id_cols, order_col], "left_semi")


def kept_keys(
    events: DataFrame,
    id_cols: Sequence[str],
    order_col: str,
    ts_col: str,
    window_s: int = DEFAULT_WINDOW_S,
    block_s: int = 30 * 86_400,
) -> DataFrame:
    """Id and order of the rows :func:`dedup_batch` keeps.

    A row can be kept only if its time passes that of every earlier arrival. So first of
    all each id is cut, before any shuffle, to one row per distinct second, which bounds
    what even the busiest id can send to one task by the seconds in a block. Ids that
    never span more than the window, the common case, are settled by plain aggregates;
    only the others go through the ordered segmentation.
    """
    ids = list(id_cols)
    keys = [*ids, "__block"]
    narrow = without_nulls(events, ids).select(
        *ids, F.col(ts_col).cast("long").alias("__ts"), F.col(order_col).alias("__order")
    )
    seconds = (
        narrow.groupBy(*ids, "__ts")
        .agg(F.min("__order").alias("__order"))
        .withColumn("__block", F.floor(F.col("__ts") / block_s).cast("long"))
    )
    blocks = seconds.groupBy(*keys).agg(
        F.min("__order").alias("__first"),
        F.min_by("__ts", "__order").alias("__first_ts"),
        F.max("__ts").alias("__last_ts"),
    )
    whole = Window.partitionBy(*ids)
    later = whole.orderBy("__block").rowsBetween(1, Window.unboundedFollowing)
    blocks = blocks.select(
        *keys,
        "__first",
        F.min("__first").over(later).alias("__later_first"),
        F.min("__first").over(whole).alias("__id_first"),
        (F.max("__last_ts").over(whole) - F.min_by("__first_ts", "__first").over(whole)).alias("__span"),
    )
    quiet = blocks.where(
        (F.col("__span") <= window_s) & (F.col("__first") == F.col("__id_first"))
    ).select(*ids, F.col("__first").alias(order_col))

    busy = blocks.where(F.col("__span") > window_s).select(*keys, "__later_first")
    newer = (
        Window.partitionBy(*keys)
        .orderBy(F.col("__ts").desc())
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    candidates = (
        match(seconds, busy, keys)
        .withColumn("__newer_first", F.min("__order").over(newer))
        .where(
            (F.col("__order") < F.coalesce("__later_first", F.col("__order") + 1))
            & (F.col("__order") < F.coalesce("__newer_first", F.col("__order") + 1))
        )
        .select(*keys, "__ts", "__order")
    )
    chained = mark_openers(
        candidates, ids, "__block", "__order", ["__ts"], ["__ts"], [window_s]
    ).select(*ids, F.col("__order").alias(order_col))
    return quiet.unionByName(chained)


def latest_entries(entries: DataFrame) -> DataFrame:
    """One index entry per row key: the one from the latest segment position.

    A maximum merges before the shuffle, so a key written over and over costs one row per
    input task.
    """
    identity = ["reference_id", "ts", "event_id"]
    rank = ["seg_ts", "writer", "segment", "bucket", "key", "start_byte"]
    rest = [c for c in entries.columns if c not in identity and c not in rank]
    newest = F.max(F.struct(*rank, *rest)).alias("__newest")
    return (
        entries.groupBy(*identity)
        .agg(newest)
        .select(*[c if c in identity else F.col(f"__newest.{c}").alias(c) for c in entries.columns])
    )
