"""Shard assignment of index entries and per-shard write batches."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.sharding import shard_of
from .blocked import running_totals
from .chain import with_block

# Fixed value: entries per shard write.
BATCH_SIZE = 5000


def assign_shards(
    rows: DataFrame, num_shards: int, reference_col: str = "reference_id"
) -> DataFrame:
    return rows.withColumn("shard", shard_of(F.col(reference_col), num_shards))


def route(entries: DataFrame, salt_cols: tuple[str, ...] = ()) -> DataFrame:
    """Gather each shard's rows for writing.

    Rebalancing rather than one partition per shard: a reference that owns a third of the
    rows makes its shard that large, and adaptive execution then splits the partition.
    """
    return entries.hint("rebalance", "shard", *salt_cols)


def shard_batches(
    entries: DataFrame, size: int = BATCH_SIZE, block_bytes: int = 64 * 1024 * 1024
) -> DataFrame:
    """Add the batch number of an entry among its segment's entries for the same shard."""
    return (
        running_totals(
            with_block(entries, "start_byte", block_bytes, "__block"),
            ["bucket", "key", "shard"], "__block", ["start_byte"],
            {"__position": F.lit(1).cast("long")},
        )
        .withColumn("batch_no", F.floor(F.col("__position") / size).cast("long"))
        .drop("__block", "__position")
    )
