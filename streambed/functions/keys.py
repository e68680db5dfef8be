"""Segment keys, index row keys and locators."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .times import INTEGER


def parse_segment_key(key: Column) -> Column:
    """``prefix/{unix}/{writer}/{segment}[.ndjson]...`` as a struct, NULL if malformed."""
    parts = F.split(key, "/")
    unix = F.get(parts, F.lit(1))
    stamp = F.when(unix.rlike(INTEGER), unix.try_cast("bigint"))
    return F.when(
        (F.size(parts) >= 4) & stamp.isNotNull(),
        F.struct(
            stamp.alias("timestamp"),
            F.get(parts, F.lit(2)).alias("writer"),
            F.regexp_replace(F.get(parts, F.lit(3)), r"\.ndjson\z", "").alias("segment"),
        ),
    )


#: Keys that are well formed beyond doubt: their number fits 64 bits.
_USUAL_KEY = r"^[^/]*/[+-]?\d{1,18}/[^/]*/"


def is_segment_key(key: Column) -> Column:
    """Whether ``parse_segment_key`` can read a key; one match where it is asked of every line."""
    return F.when(key.rlike(_USUAL_KEY), F.lit(True)).otherwise(parse_segment_key(key).isNotNull())


def row_key(reference_id: Column, seconds: Column, event_id: Column) -> Column:
    return F.concat(
        F.lit("ref:"), reference_id, F.lit(":time:"), seconds.cast("string"),
        F.lit(":txn:"), event_id,
    )


def locator(bucket: Column, key: Column, start: Column, end: Column) -> Column:
    return F.concat_ws("|", bucket, key, start.cast("string"), end.cast("string"))
