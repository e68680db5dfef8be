"""Event times given as text, to unix seconds."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: date, time, an optional fraction and an optional zone (none means UTC).
EVENT_TIME = (
    r"^(\d{4}-\d{2}-\d{2}T\d{1,2}:\d{2}:\d{2})(?:[.,]\d+)?(?:Z|([+-])(\d{2}):(\d{2}))?\z"
)
# The usual form, all digits, of which Spark's own cast is as strict.
USUAL_TIME = r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}Z\z"
INTEGER = r"^[+-]?\d+\z"


def strict_seconds(text: Column) -> Column:
    """Unix seconds, or NULL where the text is not a full date and time.

    The fraction is dropped, which floors, also before 1970. The zone offset is applied
    by arithmetic because it may reach further than Spark's own zones. Texts of the usual form take one
    match and one cast; only others go through the parts.
    """
    return F.when(text.rlike(USUAL_TIME), F.unix_seconds(text.try_cast("timestamp"))).otherwise(_from_parts(text))


def _from_parts(text: Column) -> Column:
    local = F.unix_seconds(
        F.concat(F.regexp_extract(text, EVENT_TIME, 1), F.lit("Z")).try_cast("timestamp")
    )
    hours = F.regexp_extract(text, EVENT_TIME, 3).try_cast("int")
    minutes = F.regexp_extract(text, EVENT_TIME, 4).try_cast("int")
    sign = F.when(F.regexp_extract(text, EVENT_TIME, 2) == "-", -1).otherwise(1)
    offset = F.when(hours.isNull(), F.lit(0)).when(
        (hours <= 24) & (minutes <= 60), sign * (hours * 3600 + minutes * 60)
    )
    return F.when(text.rlike(EVENT_TIME), local - offset)


def lenient_seconds(text: Column, strict: Column | None = None) -> Column:
    """As :func:`strict_seconds`, which may be given if it is known, then an integer, then 0."""
    number = F.when(text.rlike(INTEGER), text.try_cast("bigint"))
    return F.coalesce(strict_seconds(text) if strict is None else strict, number, F.lit(0).cast("bigint"))
