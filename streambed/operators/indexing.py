"""From segment lines to index entries, segment results and cycle totals."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.keys import locator, parse_segment_key, row_key
from ..session import cut
from .blocked import running_totals
from .decode import parse_index_fields
from .routing import assign_shards


#: The error of lines whose segment was not listed; such a segment has no result in its cycle.
UNLISTED = "not listed"


def with_byte_ranges(lines: DataFrame) -> DataFrame:
    """Add ``start_byte`` and ``end_byte`` (newline excluded) to the lines of segments.

    Needs ``bucket, key, split_start, line_no, line_bytes``. Lines meet only inside their read split.
    """
    taken = F.col("line_bytes") + 1
    placed = running_totals(lines, ["bucket", "key"], "split_start", ["line_no"], {"start_byte": taken})
    return placed.withColumn("end_byte", F.col("start_byte") + F.col("line_bytes"))


def parse_lines(lines: DataFrame, strict_reference: bool = False) -> DataFrame:
    """Index fields per line, without the line itself: all later steps stay narrow."""
    return parse_index_fields(lines, "line", strict_reference)


def entries_of(parsed: DataFrame, num_shards: int) -> DataFrame:
    """Index entries of placed, parsed lines; the segment's rank columns ride along."""
    good = parsed.where(F.col("status") == "ok")
    segment = parse_segment_key(F.col("key"))
    return assign_shards(good, num_shards).select(
        "shard", "reference_id", "ts", "event_id", "bucket", "key", "start_byte", "end_byte",
        row_key(F.col("reference_id"), F.col("ts"), F.col("event_id")).alias("row_key"),
        locator(F.col("bucket"), F.col("key"), F.col("start_byte"), F.col("end_byte")).alias("locator"),
        segment["timestamp"].alias("seg_ts"),
        segment["writer"].alias("writer"),
        segment["segment"].alias("segment"),
        "time_unreadable",
    )


def index_lines(lines: DataFrame, num_shards: int, strict_reference: bool = False) -> DataFrame:
    """Index entries of segment lines in one go; the lines are read and parsed once."""
    parsed = cut(parse_lines(lines, strict_reference), "parsed")
    return entries_of(with_byte_ranges(parsed), num_shards)


def segment_results(parsed: DataFrame, max_line_bytes: int | None = None, listing: DataFrame | None = None) -> DataFrame:
    """Per segment the indexed, malformed and skipped lines, and an error if it failed.

    Lines may have any length unless ``max_line_bytes`` is given: a segment with a longer
    one then fails as a whole. A failed segment indexes nothing.

    ``listing`` (``bucket, key, size``) is what should have been read. Every segment of it has a result: an empty one
    indexes nothing and succeeds; one whose lines do not make up its size could not be read to its end. Lines
    of a segment that was not listed, as it came in between, are marked ``UNLISTED`` and belong to a later cycle.
    """
    of = lambda status: F.sum(F.when(F.col("status") == status, 1).otherwise(0))
    too_long = (
        F.lit(None).cast("string")
        if max_line_bytes is None
        else F.when(F.max("line_bytes") > max_line_bytes, F.lit("line too long"))
    )
    counted = parsed.groupBy("bucket", "key").agg(
        of("ok").alias("__ok"), of("malformed").alias("malformed"),
        of("skipped").alias("skipped"), too_long.alias("error"),
        F.sum(F.col("line_bytes") + 1).alias("__read"),
    )
    if listing is not None:
        counted = listing.select("bucket", "key", "size").join(counted, ["bucket", "key"], "full").withColumns({
            n: F.coalesce(n, F.lit(0)) for n in ("__ok", "malformed", "skipped", "__read")
        })
        # The last line may lack its newline.
        short = ~(F.col("__read") - F.col("size")).isin(0, 1)
        counted = counted.withColumn(
            "error",
            F.when(F.col("size").isNull(), UNLISTED)
            .when(short, F.concat(F.lit("unreadable: "), F.least("__read", "size").cast("string"), F.lit(" of "), F.col("size").cast("string"), F.lit(" bytes read")))
            .otherwise(F.col("error")),
        )
    return counted.select(
        "bucket", "key",
        F.when(F.col("error").isNull(), F.col("__ok")).otherwise(F.lit(0)).alias("indexed"),
        "malformed", "skipped", "error",
    )


def drop_failed(parsed: DataFrame, results: DataFrame) -> DataFrame:
    """Lines of segments without an error."""
    failed = results.where(F.col("error").isNotNull()).select("bucket", "key")
    return parsed.join(failed, ["bucket", "key"], "left_anti")


def cycle_totals(results: DataFrame) -> DataFrame:
    """Entries over good segments, and how many segments succeeded and failed."""
    good = F.col("error").isNull()
    count = lambda condition: F.coalesce(
        F.sum(F.when(condition, 1).otherwise(0)), F.lit(0)
    )
    return results.agg(
        F.coalesce(F.sum(F.when(good, F.col("indexed"))), F.lit(0)).alias("total_indexed"),
        count(good).alias("total_segments"),
        count(~good).alias("total_errors"),
    )


def malformed_lines(results: DataFrame) -> DataFrame:
    return results.agg(F.coalesce(F.sum("malformed"), F.lit(0)).alias("malformed_lines"))


def segment_order(key: Column | None = None) -> Column:
    """The order segments are processed in, as one comparable value."""
    key = F.col("key") if key is None else key
    parsed = parse_segment_key(key)
    return F.struct(parsed["timestamp"], parsed["writer"], parsed["segment"], key)


def sort_segments(segments: DataFrame) -> DataFrame:
    return segments.orderBy("timestamp", "writer", "segment", "bucket", "key")


def advance_cursors(results: DataFrame) -> DataFrame:
    """Per bucket the last key before its first failed segment, if there is one.

    Two maxima instead of a running count, so a bucket's segments never gather in a task.
    """
    placed = results.select("bucket", "key", "error", segment_order().alias("__at"))
    first_failed = (
        placed.where(F.col("error").isNotNull())
        .groupBy("bucket")
        .agg(F.min("__at").alias("__stop"))
    )
    return (
        placed.where(F.col("error").isNull()).join(first_failed, ["bucket"], "left")
        .where(F.col("__stop").isNull() | (F.col("__at") < F.col("__stop")))
        .groupBy("bucket")
        .agg(F.max_by("key", "__at").alias("last_key"))
    )


def after_cursors(segments: DataFrame, cursors: DataFrame) -> DataFrame:
    """Segments whose key sorts after their bucket's cursor; no cursor means all."""
    joined = segments.join(cursors.select("bucket", "last_key"), ["bucket"], "left")
    return joined.where(F.col("key") > F.coalesce("last_key", F.lit(""))).drop("last_key")


def merge_cursors(old: DataFrame, new: DataFrame) -> DataFrame:
    """New positions replace old ones; buckets without a new one keep theirs."""
    kept = old.join(new, ["bucket"], "left_anti")
    return kept.select("bucket", "last_key").unionByName(new.select("bucket", "last_key"))
