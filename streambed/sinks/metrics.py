"""What the ingest jobs record about themselves, as the tables that the monitoring queries read.

A batch leaves small files below ``metrics/instance=I/batch=B``, each named by what it tells: ``flush`` (what was written, and
how long that took), ``progress`` (what the stream saw before the dedup, and the engine's own times) and one
``failure-X`` per flush that failed. They hold increments, and a batch that is repeated replaces its own files, so totals count
nothing twice. Counters are running sums of the increments.
"""

from __future__ import annotations

import json
import time
from collections.abc import Mapping
from datetime import datetime, timezone

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import storage
from ..operators.blocked import running_totals

# Counter and stage names.
CONSUMED = "events_consumed_total"
FLUSHED = "events_flushed_total"
DUPLICATES = "events_duplicates_filtered_total"
REJECTED = "events_dlq_total"
UPLOADS = "s3_uploads_total"
FAILURES = "flush_failures_total"
COUNTERS = (CONSUMED, FLUSHED, DUPLICATES, REJECTED, UPLOADS, FAILURES)
STAGES = {
    "processing": "event_processing_duration_seconds",
    "fetch": "kafka_fetch_duration_seconds",
    "upload": "s3_upload_duration_seconds",
    "flush": "flush_duration_seconds",
    "staging": "wal_write_duration_seconds",
}

_RECORD = "ts timestamp, name string, increment long, stage string, seconds double, instance string, batch long"


def record(
    spark: SparkSession, root: str, instance: str, batch_id: int, part: str,
    counters: Mapping[str, int], seconds: Mapping[str, float] | None = None, at: float | None = None,
) -> None:
    """Write one part of a batch's record: counter increments and the seconds of stages, by their keys in ``STAGES``."""
    stamp = datetime.fromtimestamp(time.time() if at is None else at, timezone.utc).strftime("%Y-%m-%dT%H:%M:%S.%fZ")
    rows = [{"ts": stamp, "name": n, "increment": v} for n, v in counters.items()]
    rows += [{"ts": stamp, "stage": STAGES[k], "seconds": v} for k, v in (seconds or {}).items()]
    path = f"{root}/metrics/instance={instance}/batch={batch_id}/{part}.json"
    storage.write_text(spark, path, "".join(json.dumps(r) + "\n" for r in rows))


def recorded(spark: SparkSession, root: str) -> DataFrame:
    try:
        return spark.read.schema(_RECORD).json(f"{root}/metrics")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], _RECORD)


def counter_samples(spark: SparkSession, root: str) -> DataFrame:
    """``ts, instance, name, value``: each counter after each increment, in order of time."""
    rows = recorded(spark, root).where("name IS NOT NULL").withColumn("day", F.unix_date(F.to_date("ts")))
    summed = running_totals(rows, ["name", "instance"], "day", ["ts", "batch"], {"before": F.col("increment")})
    return summed.select("ts", "instance", "name", (F.col("before") + F.col("increment")).alias("value"))


def stage_timings(spark: SparkSession, root: str) -> DataFrame:
    """``ts, instance, stage, seconds``."""
    return recorded(spark, root).where("stage IS NOT NULL").select("ts", "instance", "stage", "seconds")
