"""Counts over windows of event time, on streams."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.packing import FLUSH_INTERVAL


def windowed_stream(events: DataFrame, seconds_col: str, width: str, lateness_s: int, *totals: Column) -> DataFrame:
    """``slot_start, slot_end`` (unix seconds) and totals of windows of event time, each once, when it is closed.

    A window is closed when an event ``lateness_s`` after its end was seen. Rows that come later than that are not
    counted; the stream's progress says how many (``numRowsDroppedByWatermark``). Windows not closed yet stay in the
    state. Partial totals are made before the shuffle, so a busy second is one row per task.
    """
    at = F.timestamp_seconds(F.col(seconds_col))
    slot = F.window("__at", width)
    summed = events.withColumn("__at", at).withWatermark("__at", f"{lateness_s} seconds").groupBy(slot.alias("__slot")).agg(*totals)
    return summed.select(F.unix_seconds("__slot.start").alias("slot_start"), F.unix_seconds("__slot.end").alias("slot_end"), *summed.columns[1:])


def events_per_second_stream(events: DataFrame, seconds_col: str = "timestamp", lateness_s: int = 60) -> DataFrame:
    """``second, events`` of every second that had any, once it is ``lateness_s`` behind."""
    counted = windowed_stream(events, seconds_col, "1 second", lateness_s, F.count("*").alias("events"))
    return counted.select(F.col("slot_start").alias("second"), "events")


def interval_sizes_stream(events: DataFrame, seconds_col: str = "timestamp", lateness_s: int = 60, payload: str = "payload") -> DataFrame:
    """Events and payload bytes of every flush interval, once it is ``lateness_s`` behind."""
    return windowed_stream(
        events, seconds_col, FLUSH_INTERVAL, lateness_s, F.count("*").alias("events"), F.sum(F.octet_length(payload)).alias("bytes"))
