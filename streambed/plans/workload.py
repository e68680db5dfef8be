"""The registered queries: every operator over the driver's whole ``events`` table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.keys import parse_segment_key
from ..functions.sharding import shard_of
from ..functions.times import lenient_seconds, strict_seconds
from ..operators import accounting, decode, dedup, indexing, packing, routing
from ..operators import quantiles as quantile_ops
from .. import storage
from ..session import cut, prepare, shared_dir
from ..sinks import index as index_sink
from ..sinks import metrics
from ..sinks.segments import label_by_task, write_rejects, write_segments
from ..sources.messages import read_messages
from ..sources.segments import list_segments, manifest_listing, read_segment_lines
from ..sources.staged import reload_staged
from ..streaming.dedup import dedup_stream, drained, state_ids
from ..streaming.jobs import drain_ingest, run_index, run_ingest
from ..streaming.windows import events_per_second_stream, interval_sizes_stream
from . import inputs, monitor
from .index import IndexConf, entries_per_shard, run_index_cycle
from .ingest import IngestConf, ingest_batch

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

SHARDS = 16
HOUR = 3600


def query(run: Query) -> Query:
    def prepared(spark: SparkSession, sf_dir: str) -> DataFrame:
        return run(prepare(spark), sf_dir)

    QUERIES[run.__name__] = prepared
    return run


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Accepted events in arrival order."""
    decoded = decode.decode_events(inputs.messages(spark, sf_dir))
    return decode.split_rejects(decoded)[0]


def _pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inputs.base(spark, sf_dir).select(
        "event_id", "user_id", "event_type", F.col("sec").alias("timestamp")
    )


# Decoding and validation


@query
def decode_validate_events(spark, sf_dir):
    return _events(spark, sf_dir).select(
        "event_id", "reference_id", "timestamp", "category", "event_type",
        F.octet_length("payload").cast("long").alias("payload_bytes"),
    )


@query
def decode_validate_events_lenient_payload(spark, sf_dir):
    decoded = decode.decode_events(inputs.messages(spark, sf_dir), strict=False)
    return decode.split_rejects(decoded)[0].groupBy("event_type").agg(F.count("*").alias("n"))


@query
def reject_reasons(spark, sf_dir):
    _, rejects = decode.split_rejects(decode.decode_events(inputs.messages(spark, sf_dir)))
    return rejects.groupBy("reason").agg(
        F.count("*").alias("n"), F.sum(F.octet_length("value")).alias("bytes")
    )


@query
def rejected_messages(spark, sf_dir):
    _, rejects = decode.split_rejects(decode.decode_events(inputs.messages(spark, sf_dir)))
    root = shared_dir(spark, "rejects")
    write_rejects(rejects, root, "w0", 0)
    return spark.read.parquet(f"{root}/rejects").select("value", "reason")


TIME_TEXTS = (
    "CASE event_id % 9 WHEN 0 THEN {iso} WHEN 1 THEN replace({iso}, 'Z', '.123456789Z') "
    "WHEN 2 THEN replace({iso}, 'Z', '+05:30') WHEN 3 THEN replace({iso}, 'Z', '') "
    "WHEN 4 THEN replace({iso}, 'T', ' ') WHEN 5 THEN concat('', sec) "
    "WHEN 6 THEN '' WHEN 7 THEN replace({iso}, '-01-', '-13-') ELSE replace({iso}, 'Z', ',5Z') END"
)


@query
def strict_event_time(spark, sf_dir):
    text = inputs.base(spark, sf_dir).select("event_id", F.expr(TIME_TEXTS.format(iso=inputs.ISO)).alias("text"))
    return text.select("event_id", "text", strict_seconds(F.col("text")).alias("seconds"))


@query
def lenient_event_time(spark, sf_dir):
    text = inputs.base(spark, sf_dir).select("event_id", F.expr(TIME_TEXTS.format(iso=inputs.ISO)).alias("text"))
    return text.select("event_id", "text", lenient_seconds(F.col("text")).alias("seconds"))


# Deduplication


@query
def dedup_batch_window(spark, sf_dir):
    return dedup.dedup_batch(_pairs(spark, sf_dir), ["user_id", "event_type"], "event_id", "timestamp", HOUR)


@query
def dedup_batch_late_rows(spark, sf_dir):
    arrival = F.when(F.col("event_id") % 11 == 0, F.col("event_id") * 10 + 4005).otherwise(F.col("event_id") * 10)
    late = _pairs(spark, sf_dir).withColumn("arrival", arrival)
    return dedup.dedup_batch(late, ["user_id", "event_type"], "arrival", "timestamp", HOUR)


@query
def dedup_batch_hot_ids(spark, sf_dir):
    """Five ids only, each on most seconds of the data: the skewed extreme."""
    return dedup.dedup_batch(_pairs(spark, sf_dir), ["event_type"], "event_id", "timestamp", 300)


@query
def dedup_switched_off(spark, sf_dir):
    kept = dedup.dedup_batch(_pairs(spark, sf_dir), ["user_id"], "event_id", "timestamp", None)
    return kept.groupBy("event_type").agg(F.count("*").alias("n"))


# Segment keys, listing and cursors


@query
def segment_keys_parsed(spark, sf_dir):
    listed = inputs.listed_segments(spark, sf_dir)
    return (
        listed.withColumn("at", parse_segment_key(F.col("key")))
        .where(F.col("at").isNotNull())
        .select("bucket", "key", "at.timestamp", "at.writer", "at.segment", "size")
    )


@query
def segments_sorted(spark, sf_dir):
    return indexing.sort_segments(segment_keys_parsed(spark, sf_dir)).select(
        "timestamp", "writer", "segment", "bucket", "key"
    )


@query
def segments_after_cursor(spark, sf_dir):
    """Resume after the cursor of every bucket but one."""
    segments = segment_keys_parsed(spark, sf_dir)
    cursors = (
        segments.where("bucket <> 'events-5'")
        .groupBy("bucket")
        .agg(F.min_by("key", "size").alias("last_key"))
    )
    return indexing.after_cursors(segments, cursors).select("bucket", "key")


@query
def cursor_advance(spark, sf_dir):
    return indexing.advance_cursors(inputs.cycle_results(spark, sf_dir))


@query
def cursor_merge(spark, sf_dir):
    moved = indexing.advance_cursors(inputs.cycle_results(spark, sf_dir)).where("bucket < 'events-4'")
    old = inputs.cycle_results(spark, sf_dir).groupBy("bucket").agg(F.min("key").alias("last_key"))
    root = shared_dir(spark, "cursors")
    index_sink.save_cursors(old, root)
    index_sink.save_cursors(indexing.merge_cursors(old, moved), root)
    return index_sink.load_cursors(spark, root)[1]


# Index building


@query
def line_byte_ranges(spark, sf_dir):
    return indexing.with_byte_ranges(inputs.lines(spark, sf_dir)).select(
        "bucket", "key", "line_no", F.col("start_byte").cast("long").alias("start_byte"),
        F.col("end_byte").cast("long").alias("end_byte"),
    )


def _entries(spark, sf_dir):
    return indexing.index_lines(inputs.lines(spark, sf_dir), SHARDS)


@query
def index_entries(spark, sf_dir):
    return _entries(spark, sf_dir).select(
        "shard", "reference_id", "ts", "event_id", "row_key", "locator", "time_unreadable"
    )


@query
def index_entries_strict_reference(spark, sf_dir):
    entries = indexing.index_lines(inputs.lines(spark, sf_dir), SHARDS, strict_reference=True)
    return entries.groupBy("bucket").agg(F.count("*").alias("n"), F.sum("end_byte").cast("long").alias("end_bytes"))


@query
def shard_assignment(spark, sf_dir):
    users = inputs.base(spark, sf_dir).select("user_id", F.col("user_id").cast("string").alias("reference_id")).distinct()
    return users.select(
        "user_id", *[shard_of(F.col("reference_id"), n).alias(f"shard_of_{n}") for n in (1, 4, 6, SHARDS)]
    )


@query
def shard_balance(spark, sf_dir):
    users = inputs.base(spark, sf_dir).groupBy(F.col("user_id").cast("string").alias("reference_id")).count()
    routed = routing.assign_shards(users, SHARDS)
    return routed.groupBy("shard").agg(F.count("*").alias("users"), F.sum("count").alias("events"))


@query
def shard_batches(spark, sf_dir):
    batched = routing.shard_batches(_entries(spark, sf_dir), size=2, block_bytes=512)
    return batched.select("bucket", "key", "shard", "start_byte", "batch_no")


def _rewritten(spark, sf_dir):
    """Entries of which every third event was written again, half of those by another writer."""
    entries = _entries(spark, sf_dir).drop("row_key", "locator", "time_unreadable")
    again = entries.where(F.col("event_id").cast("long") % 3 == 0).withColumn(
        "seg_ts", F.when(F.col("event_id").cast("long") % 2 == 0, F.col("seg_ts") + 60).otherwise(F.col("seg_ts"))
    ).withColumn("writer", F.lit("w9")).withColumn("start_byte", F.col("start_byte") + 1)
    return entries.unionByName(again)


@query
def index_latest(spark, sf_dir):
    return dedup.latest_entries(_rewritten(spark, sf_dir)).select(
        "reference_id", "ts", "event_id", "seg_ts", "writer", "start_byte"
    )


@query
def segment_results(spark, sf_dir):
    parsed = indexing.parse_lines(inputs.lines(spark, sf_dir))
    return indexing.segment_results(parsed, max_line_bytes=199).select(
        "bucket", "key", "indexed", "malformed", "skipped", F.coalesce("error", F.lit("")).alias("error")
    )


@query
def cycle_totals(spark, sf_dir):
    return indexing.cycle_totals(inputs.cycle_results(spark, sf_dir))


@query
def malformed_lines(spark, sf_dir):
    parsed = indexing.parse_lines(inputs.lines(spark, sf_dir))
    return indexing.malformed_lines(indexing.segment_results(parsed))


def _deltas(spark, sf_dir):
    users = inputs.base(spark, sf_dir).select(
        F.col("user_id").cast("string").alias("reference_id"), F.expr(f"{inputs.DAY} div 86400").alias("batch")
    ).distinct()
    return routing.assign_shards(users, SHARDS).select("shard", "batch", F.lit("part").alias("path"))


@query
def delta_counts(spark, sf_dir):
    return index_sink.delta_counts(_deltas(spark, sf_dir), SHARDS + 4)


@query
def compaction_due(spark, sf_dir):
    return index_sink.compaction_due(_deltas(spark, sf_dir), SHARDS + 4, threshold=30)


# Segmentation


@query
def flush_packing(spark, sf_dir):
    packed = packing.pack_segments(
        _events(spark, sf_dir), ["partition"], "arrival", max_rows=90, max_bytes=15_000, block_rows=1000
    )
    return packed.select("partition", "event_id", "seg_no")


@query
def flush_interval_segments(spark, sf_dir):
    slots = packing.interval_segments(_events(spark, sf_dir))
    return slots.groupBy("slot_start", "slot_end").agg(
        F.count("*").alias("events"), F.sum(F.octet_length("payload")).alias("bytes")
    )


@query
def segment_manifest(spark, sf_dir):
    """Events packed, written as segments, and their manifest as stored."""
    packed = packing.pack_segments(
        _events(spark, sf_dir), ["partition"], "arrival", max_rows=500, max_bytes=60_000, block_rows=2000
    ).withColumn("segment", F.concat_ws("-", "partition", "seg_no"))
    root = shared_dir(spark, "segments")
    manifest = write_segments(packed, 7, root, "w0", flush_ts=1_704_067_200, gather=True)
    folder = F.regexp_replace("key", "/part-[^/]*$", "")  # the file's own name is Spark's
    return manifest.select(folder.alias("key"), "instance_id", "segment_id", "event_count", "batch_id", "flush_ts", "size_bytes")


def _packed_segments(spark, sf_dir) -> str:
    """Segments of deterministic content below a new root, as ``segment_manifest`` writes them."""
    packed = packing.pack_segments(
        _events(spark, sf_dir), ["partition"], "arrival", max_rows=500, max_bytes=60_000, block_rows=2000
    ).withColumn("segment", F.concat_ws("-", "partition", "seg_no"))
    root = shared_dir(spark, "segments")
    write_segments(packed, 7, root, "w0", flush_ts=1_704_067_200, gather=True)
    return root


@query
def manifest_joins_listing(spark, sf_dir):
    """The manifest against the listing of what was written: keys, sizes and ids, as the index would read either."""
    buckets = {"events-0": _packed_segments(spark, sf_dir)}
    manifest = manifest_listing(spark, buckets)
    listed = list_segments(spark, buckets).select("key", F.col("size").alias("listed_size"), F.col("segment").alias("listed_id"))
    events = spark.read.parquet(f"{buckets['events-0']}/manifest").agg(F.sum("event_count").alias("events"))
    both = manifest.join(listed, "key", "full").agg(
        F.count("*").alias("segments"), F.count("segment").alias("in_manifest"), F.count("listed_id").alias("in_listing"),
        F.count_if(F.col("size") == F.col("listed_size")).alias("same_size"),
        F.count_if(F.col("segment") == F.col("listed_id")).alias("same_id"))
    return accounting.beside(both, events)


@query
def index_cycle_with_failures(spark, sf_dir):
    """A cycle over real segments, one of them empty and one that cannot be read; and where its cursor stops."""
    root = _packed_segments(spark, sf_dir)
    folder = f"{root}/events/1704067200/w0"
    storage.write_text(spark, f"{folder}/empty.ndjson", "")
    broken = f"{folder}/segment=b000000007-1-0"
    name = next(n for n, _ in storage.children(spark, broken) if n.startswith("part-"))
    storage.move(spark, f"{broken}/{name}", f"{broken}/{name}.gz")  # no such content
    conf = IndexConf(root=shared_dir(spark, "index"), buckets={"events-0": root}, num_shards=SHARDS)
    totals = run_index_cycle(spark, conf)
    _, cursors = index_sink.load_cursors(spark, conf.root)
    stopped = cursors.select(parse_segment_key(F.col("last_key"))["segment"].alias("cursor_segment"))
    held = index_sink.read_index(spark, conf.root).agg(F.count("*").alias("entries"))
    return accounting.beside(totals, held, stopped)


@query
def index_cycle_from_manifest(spark, sf_dir):
    """The writers' manifests in place of a listing."""
    conf = IndexConf(root=shared_dir(spark, "index"), buckets={"events-0": _packed_segments(spark, sf_dir)}, num_shards=SHARDS, listing="manifest")
    return run_index_cycle(spark, conf)


@query
def index_batch_then_stream(spark, sf_dir):
    """Two batch cycles and a stream over other buckets of the same events on one root: nothing of either is lost."""
    base = inputs.lines(spark, sf_dir).select("line", F.expr("line_no % 3").alias("third"))
    roots = {}
    for k, part in enumerate(("third < 2", "third = 2", "third > 0")):
        roots[f"events-{k}"] = shared_dir(spark, "segments")
        base.where(part).select("line").write.text(f"{roots[f'events-{k}']}/events/{1_704_067_200 + k}/w{k}")
    conf = IndexConf(root=shared_dir(spark, "index"), num_shards=SHARDS, compaction_threshold=3, checkpoint=shared_dir(spark, "checkpoint"))
    for k in (0, 1):
        conf.buckets = {f"events-{k}": roots[f"events-{k}"]}
        run_index_cycle(spark, conf)
    conf.buckets = {"events-2": roots["events-2"]}
    run_index(spark, conf, once=True).awaitTermination()
    return index_sink.read_index(spark, conf.root).groupBy("shard").agg(
        F.count("*").alias("entries"), F.count_if(F.col("bucket") == "events-2").alias("from_stream"))


@query
def segments_read_back(spark, sf_dir):
    """Segments written without a gather, listed and read again: every line, byte for byte."""
    events = _events(spark, sf_dir)
    root = shared_dir(spark, "segments")
    write_segments(label_by_task(events, max_rows=700), 0, root, "w0", flush_ts=1_704_067_200)
    buckets = {"events-0": root}
    sizes = list_segments(spark, buckets).groupBy("bucket", "key").agg(F.sum("size").alias("size"))
    ends = indexing.with_byte_ranges(read_segment_lines(spark, buckets))
    checked = ends.groupBy("bucket", "key").agg(
        F.count("*").alias("lines"), (F.max("end_byte") + 1).alias("end"), F.sum(F.length("line")).alias("chars")
    ).join(sizes, ["bucket", "key"])
    return checked.agg(
        F.sum("lines").alias("lines"), F.sum("chars").alias("chars"), F.sum("size").alias("bytes"),
        F.sum(F.when(F.col("end") == F.col("size"), 0).otherwise(1)).alias("size_mismatches"),
    )


# Accounting


@query
def batch_bytes(spark, sf_dir):
    return accounting.batch_sizes(_events(spark, sf_dir), ["event_type"])


QUARTERS = 4


def _recorded_ingest(spark, sf_dir) -> str:
    """An ingest job in four micro-batches that left its record below the returned root.

    Every tenth message comes again in the next batch, and every second batch's first flush fails. All tasks write files of a
    batch; the job drains one batch's files, then finds those of the next.
    """
    root, source = shared_dir(spark, "ingest"), shared_dir(spark, "messages")
    sent = inputs.messages(spark, sf_dir).select("value", "offset", (F.col("offset") % QUARTERS).alias("quarter"))
    again = sent.where(F.col("offset") % 10 == 0).withColumn("quarter", (F.col("quarter") + 1) % QUARTERS)
    waiting = f"{source}/_waiting"  # hidden from the job
    sent.unionByName(again).select("value", "quarter").write.partitionBy("quarter").text(waiting)
    failed = set()

    def flaky(events, batch_id, *where):
        if batch_id % 2 and batch_id not in failed:
            failed.add(batch_id)
            raise OSError("the store does not answer")
        return write_segments(events, batch_id, *where)

    conf = IngestConf(
        root=root, source={"format": "text", "path": source, "maxFilesPerTrigger": str((1 << 31) - 1)}, checkpoint=shared_dir(spark, "checkpoint"),
        dedup_window_s=86_400, max_rows=1 << 30, max_bytes=1 << 60, write_tasks=1, writer=flaky)
    for name, _ in storage.children(spark, waiting):
        if name.startswith("quarter="):
            storage.move(spark, f"{waiting}/{name}", f"{source}/{name}")
            drain_ingest(spark, conf)
    return root


@query
def ingest_counters(spark, sf_dir):
    """What a job with repeated messages and failing flushes recorded of itself."""
    return monitor.recorded_counters(metrics.counter_samples(spark, _recorded_ingest(spark, sf_dir)))


@query
def flush_success_recorded(spark, sf_dir):
    success = monitor.flush_success(metrics.counter_samples(spark, _recorded_ingest(spark, sf_dir)))
    return success.select("instance", "uploads", "failures", F.round("success_pct", 6).alias("success_pct"), "band")


@query
def recorded_stages(spark, sf_dir):
    """How often the job recorded each stage: all once per batch that flushed."""
    return metrics.stage_timings(spark, _recorded_ingest(spark, sf_dir)).where("seconds >= 0").groupBy("instance", "stage").agg(F.count("*").alias("n"))


@query
def events_per_second(spark, sf_dir):
    return accounting.events_per_second(_events(spark, sf_dir))


NOW = 1_705_363_200


@query
def live_ids(spark, sf_dir):
    return accounting.live_ids(_pairs(spark, sf_dir), ["user_id", "event_type"], NOW, 6 * HOUR)


@query
def capacity_flags(spark, sf_dir):
    sizes = accounting.batch_sizes(
        packing.interval_segments(_events(spark, sf_dir), interval="1 hour"), ["slot_start"]
    )
    flags = accounting.capacity_flags(sizes, limit_events=18, limit_bytes=3000)
    return flags.select("slot_start", "events", "bytes", F.round("fill", 6).alias("fill"), "near_capacity")


@query
def flush_rates(spark, sf_dir):
    flushes = inputs.base(spark, sf_dir).groupBy(F.expr(inputs.DAY).alias("day")).agg(
        F.count("*").alias("events"), F.sum("cents").alias("bytes"),
        (F.sum(F.expr("cents % 7")) / 10).alias("seconds"),
    )
    rates = accounting.flush_rates(flushes)
    return rates.select("day", F.round("mb_per_s", 6).alias("mb_per_s"), F.round("s_per_event", 6).alias("s_per_event"))


# Monitoring


@query
def counter_rate_1m(spark, sf_dir):
    rates = monitor.counter_rate(inputs.counter_samples(spark, sf_dir), monitor.CONSUMED)
    return rates.select("name", "instance", "window_start", F.round("per_second", 6).alias("per_second"))


@query
def flushed_rate_1m(spark, sf_dir):
    rates = monitor.counter_rate(inputs.counter_samples(spark, sf_dir), monitor.FLUSHED)
    return rates.select("name", "instance", "window_start", F.round("per_second", 6).alias("per_second"))


@query
def counter_rate_trailing(spark, sf_dir):
    """At every 30 s, over the 60 s before."""
    rates = monitor.trailing_rate(inputs.counter_samples(spark, sf_dir), monitor.CONSUMED)
    return rates.select("name", "instance", "at", F.round("per_second", 6).alias("per_second"))


@query
def flushed_rate_trailing(spark, sf_dir):
    """Over the hour before every 30 s, in blocks of three hours, which most frames then reach across."""
    rates = monitor.trailing_rate(inputs.counter_samples(spark, sf_dir), monitor.FLUSHED, window_s=HOUR, step_s=1800, block_s=3 * HOUR)
    return rates.select("name", "instance", "at", F.round("per_second", 6).alias("per_second"))


@query
def latest_totals(spark, sf_dir):
    return monitor.latest_counters(inputs.counter_samples(spark, sf_dir)).select("name", "instance", "value")


@query
def flush_success_pct(spark, sf_dir):
    success = monitor.flush_success(inputs.counter_samples(spark, sf_dir))
    return success.select("instance", "uploads", "failures", F.round("success_pct", 6).alias("success_pct"), "band")


@query
def pending_flush(spark, sf_dir):
    return monitor.pending(inputs.counter_samples(spark, sf_dir))


@query
def buffer_gauges(spark, sf_dir):
    gauges = monitor.fill_gauges(inputs.counter_samples(spark, sf_dir))
    return gauges.select(
        "instance", "buffer_events", F.round("buffer_mb", 6).alias("buffer_mb"), "events_band", "mb_band"
    )


@query
def stage_latency_quantiles(spark, sf_dir):
    found = monitor.stage_quantiles(inputs.stage_timings(spark, sf_dir))
    return found.select("stage", "window_start", "prob", F.round("quantile", 6).alias("quantile"))


@query
def stage_latency_overall(spark, sf_dir):
    found = quantile_ops.exact_quantiles(inputs.stage_timings(spark, sf_dir), ["stage"], "seconds")
    return found.select("stage", "prob", F.round("quantile", 6).alias("quantile"))


@query
def stage_latency_sketched(spark, sf_dir):
    """Quantiles over a week, at every day, from merged sketches; whether each one's exact rank is within the bound."""
    timings, k = inputs.stage_timings(spark, sf_dir), 100
    found = monitor.stage_quantiles_sketched(timings, window_s=7 * 86_400, step_s=86_400, k=k)
    day = F.floor(F.unix_seconds("ts") / 86_400) * 86_400
    values = timings.select("stage", "seconds", F.explode(F.sequence(day - 6 * 86_400, day, F.lit(86_400).cast("long"))).alias("window_start"))
    quantiles = found.groupBy("stage", "window_start").agg(F.collect_list(F.struct("prob", "quantile")).alias("qs"), F.max("n").alias("n"))
    ranked = values.join(quantiles, ["stage", "window_start"]).select("stage", "window_start", "seconds", "n", F.explode("qs").alias("q")).select(
        "stage", "window_start", "seconds", "n", F.col("q.prob").alias("prob"), F.col("q.quantile").alias("cut_at"))
    share = ranked.groupBy("stage", "window_start", "n", "prob", "cut_at").agg(
        (F.count_if(F.col("seconds") < F.col("cut_at")) / F.count("*")).alias("below"),
        (F.count_if(F.col("seconds") <= F.col("cut_at")) / F.count("*")).alias("upto"))
    off = F.greatest(F.col("below") - F.col("prob"), F.col("prob") - F.col("upto"), F.lit(0.0))
    return share.select("stage", "window_start", "n", "prob", (off <= quantile_ops.rank_error(k)).alias("within"))


BOUNDS = (0.001, 0.005, 0.01, 0.02, 0.03, 0.05)


@query
def histogram_buckets(spark, sf_dir):
    return quantile_ops.bucket_counts(inputs.stage_timings(spark, sf_dir), ["stage"], "seconds", BOUNDS).where(
        F.col("le") < F.lit(float("inf"))
    )


@query
def histogram_quantile(spark, sf_dir):
    found = monitor.bucket_quantile(inputs.stage_timings(spark, sf_dir), BOUNDS, (0.5, 0.95, 0.99))
    return found.select("stage", "prob", F.round("quantile", 6).alias("quantile"))


def _report_parts(spark, sf_dir):
    """Buffered: the last gauges; rate: the last full second. Events are decoded once, into a written table of ids and times."""
    events = cut(_events(spark, sf_dir).select("event_id", "timestamp"), "accepted")
    last = events.agg(F.max("timestamp").alias("t"))
    rate = events.where(F.col("timestamp") == last.scalar()).agg(F.count("*").alias("events_per_sec"))
    return events, monitor.buffered(inputs.counter_samples(spark, sf_dir), "w0"), rate


@query
def health_report(spark, sf_dir):
    _, sizes, rate = _report_parts(spark, sf_dir)
    return monitor.health_report(sizes, rate, "w0")


@query
def metrics_report(spark, sf_dir):
    """Counters from the job's own record; gauges from the samples."""
    events, sizes, rate = _report_parts(spark, sf_dir)
    counters = monitor.recorded_counters(metrics.counter_samples(spark, _recorded_ingest(spark, sf_dir)))
    live = accounting.live_ids(events, ["event_id"], NOW, 300)
    flushed = events.agg((F.lit(NOW + 30 * 86_400) - F.max("timestamp")).cast("double").alias("last_flush_ago_s"))
    return monitor.metrics_report(counters, sizes, rate, live, flushed, "w0")


# Whole jobs on files


def _ingested(spark, sf_dir) -> str:
    root = shared_dir(spark, "ingest")
    ingest_batch(inputs.messages(spark, sf_dir), IngestConf(root=root, instance="w0", max_rows=2000))
    return root


@query
def index_entries_per_shard(spark, sf_dir):
    """Messages to segments to index on disk; entries and bytes per shard."""
    conf = IndexConf(root=shared_dir(spark, "index"), num_shards=SHARDS)
    conf.buckets = {"events-0": _ingested(spark, sf_dir)}
    run_index_cycle(spark, conf)
    return entries_per_shard(index_sink.read_index(spark, conf.root))


@query
def index_compacted(spark, sf_dir):
    """Two overlapping cycles, compaction after each, and the index that readers then see."""
    conf = IndexConf(root=shared_dir(spark, "index"), num_shards=SHARDS, compaction_threshold=2)
    first, second = _ingested(spark, sf_dir), _ingested(spark, sf_dir)
    conf.buckets = {"events-0": first}
    run_index_cycle(spark, conf)
    conf.buckets = {"events-0": first, "events-1": second}
    run_index_cycle(spark, conf)
    found = index_sink.read_index(spark, conf.root)
    return found.groupBy("shard").agg(
        F.count("*").alias("entries"), F.count_distinct("row_key").alias("row_keys"), F.min("ts").alias("first_ts")
    )


@query
def staged_reload(spark, sf_dir):
    """Batches of 500 events staged as JSON array files, reloaded."""
    staged = _events(spark, sf_dir).withColumn("no", F.floor(F.col("arrival") / 500))
    record = F.struct(
        "event_id", "reference_id", "timestamp", "category", "event_type",
        F.base64(F.encode("payload", "UTF-8")).alias("payload"),
    )
    root = shared_dir(spark, "staged")
    staged.groupBy("no").agg(F.to_json(F.collect_list(record)).alias("value")).write.partitionBy("no").text(root)
    return reload_staged(spark, f"{root}/*/*.txt").select(
        "event_id", "reference_id", "timestamp", "category", "event_type",
        F.octet_length("payload").cast("long").alias("payload_bytes"),
    )


@query
def messages_from_files(spark, sf_dir):
    root = shared_dir(spark, "messages")
    inputs.messages(spark, sf_dir).select("value").write.text(root)
    read = read_messages(spark, {"format": "text", "path": root})
    decoded = decode.decode_events(read)
    return decoded.groupBy(F.coalesce("reason", F.lit("")).alias("reason")).agg(
        F.count("*").alias("n"), F.sum(F.octet_length("payload")).alias("bytes")
    )


# Streaming


def _stream_ingest(spark, sf_dir, mode) -> DataFrame:
    """The ingest job over files that hold every tenth message twice."""
    root, source = shared_dir(spark, "ingest"), shared_dir(spark, "messages")
    sent = inputs.messages(spark, sf_dir)
    again = sent.where(F.col("offset") % 10 == 0)
    sent.unionByName(again).select("value").write.text(source)
    conf = IngestConf(
        root=root, instance="w0", max_rows=2000, source={"format": "text", "path": source}, dedup_mode=mode,
        checkpoint=shared_dir(spark, "checkpoint"),
    )
    run_ingest(spark, conf, once=True).awaitTermination()
    stored = read_segment_lines(spark, {"b": root}).select(F.lit("").alias("reason"), F.col("line").alias("value"))
    rejected = spark.read.parquet(f"{root}/rejects").select("reason", "value")
    return stored.unionByName(rejected).groupBy("reason").agg(
        F.count("*").alias("n"), F.sum(F.octet_length("value")).alias("bytes")
    )


@query
def stream_ingest(spark, sf_dir):
    return _stream_ingest(spark, sf_dir, "keep_late")


@query
def stream_ingest_arrival_clock(spark, sf_dir):
    return _stream_ingest(spark, sf_dir, "arrival_clock")


@query
def stream_index(spark, sf_dir):
    conf = IndexConf(root=shared_dir(spark, "index"), num_shards=SHARDS, checkpoint=shared_dir(spark, "checkpoint"))
    conf.buckets = {"events-0": _ingested(spark, sf_dir)}
    run_index(spark, conf, once=True).awaitTermination()
    return entries_per_shard(index_sink.read_index(spark, conf.root))


def _dedup_stream(spark, sf_dir, mode) -> DataFrame:
    source, out = shared_dir(spark, "pairs"), shared_dir(spark, "kept")
    pairs = _pairs(spark, sf_dir).withColumn("arrival", F.col("event_id"))
    pairs.write.parquet(source)
    rows = spark.readStream.schema(pairs.schema).parquet(source)
    kept = dedup_stream(rows, ["user_id", "event_type"], "timestamp", HOUR, mode)
    writer = (
        kept.writeStream.format("parquet")
        .option("path", out)
        .option("checkpointLocation", shared_dir(spark, "checkpoint"))
        .trigger(availableNow=True)
    )
    with drained(spark):
        writer.start().awaitTermination()
    return spark.read.schema(kept.schema).parquet(out).drop("arrival")


@query
def stream_dedup(spark, sf_dir):
    return _dedup_stream(spark, sf_dir, "keep_late")


def _in_turn(spark, batches: list[DataFrame], make: Callable[[DataFrame], DataFrame], drain_last: bool = True) -> tuple[DataFrame, str]:
    """What a stream makes of some batches, each a micro-batch of the files that its tasks wrote; and the checkpoint.

    The stream stops after each batch and goes on from its checkpoint, so a batch has any number of files. Only the
    last run, unless it is drained too, asks for another batch without data, as the watermark moves.
    """
    source, out, checkpoint = (shared_dir(spark, x) for x in ("batches", "made", "checkpoint"))
    for k, batch in enumerate(batches):
        batch.write.mode("append").parquet(source)
        made = make(spark.readStream.schema(batch.schema).parquet(source))
        writer = made.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint).trigger(availableNow=True)
        with drained(spark, drain_last or k + 1 < len(batches)):
            writer.start().awaitTermination()
    return spark.read.schema(made.schema).parquet(out), checkpoint


def _dedup_batches(spark, sf_dir) -> tuple[DataFrame, str]:
    """``stream_dedup`` in five micro-batches by arrival: what was kept, and the checkpoint."""
    pairs = _pairs(spark, sf_dir).withColumn("arrival", F.col("event_id")).persist()
    last = pairs.agg(F.max("arrival")).head()[0] or 0
    batches = [pairs.where((F.col("arrival") * 5 >= k * (last + 1)) & (F.col("arrival") * 5 < (k + 1) * (last + 1))) for k in range(5)]
    kept = _in_turn(spark, batches, lambda rows: dedup_stream(rows, ["user_id", "event_type"], "timestamp", HOUR))
    pairs.unpersist()
    return kept


@query
def stream_dedup_across_batches(spark, sf_dir):
    return _dedup_batches(spark, sf_dir)[0].drop("arrival")


@query
def live_ids_from_state(spark, sf_dir):
    """Ids the stream still knows, and those of them that a repeat within six hours before ``NOW`` would meet."""
    state = state_ids(spark, _dedup_batches(spark, sf_dir)[1])
    recent = F.col("last").between(NOW - 6 * HOUR, NOW)
    return state.agg(F.count("*").alias("known_ids"), F.count_if(recent).alias("live_ids"), F.sum("last").cast("long").alias("last_kept"))


@query
def stream_dedup_arrival_clock(spark, sf_dir):
    """Within one micro-batch an id passes once."""
    return _dedup_stream(spark, sf_dir, "arrival_clock").select("user_id", "event_type")


@query
def stream_dedup_event_clock(spark, sf_dir):
    return _dedup_stream(spark, sf_dir, "event_clock").groupBy("event_type").agg(
        F.count_distinct("user_id").alias("users")
    )


def _late_batches(spark, sf_dir) -> list[DataFrame]:
    """Accepted events in four batches, one per week of the table's span, some of them late.

    Every fifth event of the last half day of a week comes with the next week; every 17th event of the first week comes with the last.
    """
    events = _events(spark, sf_dir).select("event_id", "timestamp", "payload")
    span = events.agg(F.min("timestamp").alias("first"), F.max("timestamp").alias("last")).head()
    week = (span["last"] - span["first"]) // QUARTERS + 1
    at, no = F.col("timestamp") - span["first"], F.col("event_id").cast("long")
    slow = (no % 5 == 0) & (at % week >= week - HALF_DAY) & (at < (QUARTERS - 1) * week)
    lost = (no % 17 == 0) & (at < week)
    batch = F.when(lost, QUARTERS - 1).when(slow, F.floor(at / week) + 1).otherwise(F.floor(at / week))
    placed = cut(events.withColumn("batch", batch), "late")
    return [placed.where(F.col("batch") == k).drop("batch") for k in range(QUARTERS)]


HALF_DAY = 43_200


@query
def stream_events_per_second(spark, sf_dir):
    """Seconds a day behind the last event; rows half a day late count, rows weeks late do not."""
    return _in_turn(spark, _late_batches(spark, sf_dir), lambda rows: events_per_second_stream(rows, lateness_s=2 * HALF_DAY), drain_last=False)[0]


@query
def stream_flush_intervals(spark, sf_dir):
    return _in_turn(spark, _late_batches(spark, sf_dir), lambda rows: interval_sizes_stream(rows, lateness_s=2 * HALF_DAY), drain_last=False)[0]
