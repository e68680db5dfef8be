"""Batch ingest: messages to events, rejects, segments and manifest."""

from __future__ import annotations

import time
import uuid
from collections import Counter
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.decode import decode_events, split_rejects
from ..operators.dedup import DEFAULT_WINDOW_S, kept_keys
from ..operators.packing import MAX_BYTES, MAX_ROWS
from ..session import cut
from ..sinks import metrics
from ..sinks.segments import committed, label_by_task, label_whole, write_rejects, write_segments


@dataclass
class IngestConf:
    root: str
    instance: str = "w0"
    checkpoint: str | None = None
    source: dict[str, str] = field(default_factory=dict)
    # The trigger is the flush interval, the window the dedup window.
    trigger: str = "10 seconds"
    dedup_window_s: int | None = DEFAULT_WINDOW_S
    dedup_mode: str = "keep_late"
    strict: bool = True
    max_rows: int = MAX_ROWS
    max_bytes: int = MAX_BYTES
    # Tasks that cut a flush into segments; unset, as many as the batch has. With one, a streamed flush inside both limits is one
    # segment and needs no cutting: all tasks write files of it.
    write_tasks: int | None = None
    # What writes labelled events as segments and returns their manifest.
    writer: Callable[[DataFrame, int, str, str], DataFrame] = write_segments


def write_batch(
    spark: SparkSession, conf: IngestConf, batch_id: int, events: DataFrame, rejects: DataFrame, counts: Counter[str],
    size: int | None = None,
) -> Counter[str]:
    """Write a batch's rejects and segments and record counts and times; a failure is recorded and raised.

    The manifest comes last and says that the batch is complete; a batch that has one stays as it is. ``size``, if known, is the
    bytes of the events' lines. An upload is a segment, however many files it has.
    """
    began = time.monotonic()
    upload = 0.0
    try:
        stored = committed(spark, conf.root, conf.instance, batch_id)
        if stored is None:
            if counts["rejected"]:
                write_rejects(rejects, conf.root, conf.instance, batch_id)
            if counts["flushed"]:
                fits = size is not None and size <= conf.max_bytes and counts["flushed"] <= conf.max_rows
                if conf.write_tasks == 1 and fits:
                    labelled = label_whole(events, size)
                else:
                    if conf.write_tasks:
                        events = events.coalesce(conf.write_tasks)
                    labelled = label_by_task(events, conf.max_rows, conf.max_bytes)
                began_upload = time.monotonic()
                stored = conf.writer(labelled, batch_id, conf.root, conf.instance)
                upload = time.monotonic() - began_upload
    except Exception:
        metrics.record(spark, conf.root, conf.instance, batch_id, f"failure-{uuid.uuid4().hex}", {metrics.FAILURES: 1})
        raise
    uploads = 0 if stored is None else stored.select("segment_id").distinct().count()
    spent = time.monotonic() - began
    kept = counts["flushed"]
    told = {metrics.CONSUMED: kept, metrics.FLUSHED: kept, metrics.UPLOADS: uploads, metrics.REJECTED: counts["rejected"], metrics.FAILURES: 0}
    if "duplicates" in counts:
        told[metrics.DUPLICATES] = counts["duplicates"]
    seconds = {"flush": spent, "upload": upload, "processing": spent / kept} if kept else {}
    metrics.record(spark, conf.root, conf.instance, batch_id, "flush", told, seconds)
    return counts


def flush_batch(decoded: DataFrame, conf: IngestConf, batch_id: int) -> Counter[str]:
    """Write one decoded, deduplicated batch: rejects, segments, manifest; return counts.

    The batch is read by several writes, so it is kept for their duration, sorted inside
    each task so that a recomputed partition labels its rows the same way.
    """
    order = [c for c in ("arrival", "event_id", "payload") if c in decoded.columns]
    held = decoded.sortWithinPartitions(*order).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        good = F.col("reason").isNull()
        taken = F.sum(F.when(good, F.octet_length("payload") + 1))
        totals = held.agg(F.count(F.when(good, 1)).alias("flushed"), F.count(F.when(~good, 1)).alias("rejected"), taken.alias("size")).head()
        counts = Counter(flushed=totals.flushed, rejected=totals.rejected)
        events, rejects = split_rejects(held)
        return write_batch(held.sparkSession, conf, batch_id, events, rejects, counts, totals["size"])
    finally:
        held.unpersist()


def ingest_batch(messages: DataFrame, conf: IngestConf, batch_id: int = 0) -> Counter[str]:
    """Run a bounded set of messages (with ``arrival``, a number of their own) through the whole ingest.

    Messages are parsed once, into a narrow written table of their ids, times and reasons. What
    to leave out, rejects and repeats, is usually little and is told by arrival; everything else is
    written as it came, without being parsed, shuffled or kept.
    """
    spark = messages.sparkSession
    decoded = decode_events(messages, conf.strict).select("arrival", "event_id", "timestamp", "reason")
    narrow = cut(decoded, "decoded")
    rejected = narrow.where(F.col("reason").isNotNull()).select("arrival", "reason")
    valid = narrow.where(F.col("reason").isNull())
    out = rejected.select("arrival")
    counts = Counter(rejected=rejected.count())
    if conf.dedup_window_s is not None:
        kept = kept_keys(valid, ["event_id"], "arrival", "timestamp", conf.dedup_window_s)
        repeats = cut(valid.select("arrival").join(kept.select("arrival"), "arrival", "left_anti"), "repeats")
        if many := repeats.count():
            counts["duplicates"] = many
        out = out.unionByName(repeats)
    counts["flushed"] = valid.count() - counts.get("duplicates", 0)
    events = messages.join(cut(out, "left-out"), "arrival", "left_anti").select("arrival", F.col("value").alias("payload"))
    rejects = messages.join(rejected, "arrival").select("value", "reason")
    return write_batch(spark, conf, batch_id, events, rejects, counts)
