"""Cutting accepted events into segments by size and by time."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut
from .blocked import match, running_totals
from .chain import mark_openers, with_block

# The flush limits and the flush interval.
MAX_ROWS = 10_000
MAX_BYTES = 20 * 1024 * 1024
FLUSH_INTERVAL = "10 seconds"


def pack_segments(
    events: DataFrame,
    part_cols: Sequence[str],
    order_col: str,
    max_rows: int = MAX_ROWS,
    max_bytes: int = MAX_BYTES,
    size_col: str | None = None,
    block_rows: int = 1_000_000,
) -> DataFrame:
    """Add ``seg_no``: a segment is cut where one more row would pass either limit.

    ``order_col`` is an integer that is unique within a part, such as a source offset. A
    row larger than ``max_bytes`` forms a segment of its own. Only part, order and size
    take part in the cutting, from a written copy; the events themselves are shuffled once,
    to receive the number.
    """
    parts = list(part_cols)
    size = F.octet_length("payload") if size_col is None else F.col(size_col)
    narrow = events.select(*parts, order_col, size.cast("long").alias("__size"))
    sizes = with_block(cut(narrow, "sizes"), order_col, block_rows, "__block")
    placed = running_totals(
        sizes, parts, "__block", [order_col],
        {"__row": F.lit(1).cast("long"), "__byte": F.col("__size")},
    ).select(
        *parts, "__block", order_col, "__row", "__byte",
        (F.col("__row") + 1).alias("__row_end"),
        (F.col("__byte") + F.col("__size")).alias("__byte_end"),
    )
    openers = mark_openers(
        placed, parts, "__block", order_col,
        ["__row", "__byte"], ["__row_end", "__byte_end"], [max_rows, max_bytes],
    ).withColumn("__open", F.lit(1).cast("long"))
    flagged = match(sizes, openers, [*parts, "__block", order_col], "left")
    numbered = running_totals(
        flagged, parts, "__block", [order_col], {"__opened": F.coalesce("__open", F.lit(0))}
    ).select(
        *parts, order_col,
        (F.col("__opened") + F.coalesce("__open", F.lit(0)) - 1).alias("seg_no"),
    )
    return match(events, numbered, [*parts, order_col])


def interval_segments(
    events: DataFrame, ts_col: str = "timestamp", interval: str = FLUSH_INTERVAL
) -> DataFrame:
    """Add the start and end second of the flush interval an event falls into."""
    slot = F.window(F.timestamp_seconds(F.col(ts_col)), interval)
    return (
        events.withColumn("__slot", slot)
        .withColumn("slot_start", F.unix_seconds("__slot.start"))
        .withColumn("slot_end", F.unix_seconds("__slot.end"))
        .drop("__slot")
    )
