"""One index cycle: new segments to a delta, results, cursors and compaction."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import storage
from ..operators.indexing import (
    UNLISTED,
    advance_cursors,
    cycle_totals,
    drop_failed,
    entries_of,
    parse_lines,
    segment_results,
    with_byte_ranges,
)
from ..session import cut, small_files
from ..sinks.commits import CommitLog, State
from ..sinks.index import BASELINE_BUCKETS, COMPACTION_THRESHOLD, compact, compaction_due, new_folder, pending_deltas, write_delta
from ..sources.segments import list_segments, manifest_listing, read_segment_lines

SEGMENT_RESULTS = "bucket string, key string, indexed long, malformed long, skipped long, error string"


@dataclass
class IndexConf:
    root: str
    buckets: dict[str, str] = field(default_factory=dict)
    checkpoint: str | None = None
    num_shards: int = 16
    # Poll interval, compaction threshold. Lines may have any length.
    trigger: str = "5 seconds"
    compaction_threshold: int = COMPACTION_THRESHOLD
    max_line_bytes: int | None = None
    strict_reference: bool = False
    max_files_per_trigger: int = 10_000
    # Buckets of a baseline: as many tasks merge it.
    baseline_buckets: int = BASELINE_BUCKETS
    # How segments are found: ``folders`` or the writers' ``manifest`` (batch), ``seen_files`` or ``start_after`` (stream).
    listing: str = ""
    # Whether a cursor passes segments that failed; else it stops before the first.
    skip_failed: bool = False


def index_segments(spark: SparkSession, conf: IndexConf, lines: DataFrame, listing: DataFrame | None = None) -> tuple[dict, DataFrame]:
    """Write the delta and the per-segment results of some segments' lines; both for a commit to name.

    What is staged is one narrow row per line, a written table: the text is read once, the later steps
    start from there, and no executor loss reaches back to the text. The stage is removed at the end.
    """
    staging = f"{conf.root}/{new_folder('staging')}"
    try:
        parse_lines(lines, conf.strict_reference).write.parquet(staging)
        staged = spark.read.parquet(staging)
        path = new_folder("results")
        segment_results(staged, conf.max_line_bytes, listing).write.parquet(f"{conf.root}/{path}")
        results = spark.read.schema(SEGMENT_RESULTS).parquet(f"{conf.root}/{path}")
        delta = write_delta(entries_of(with_byte_ranges(drop_failed(staged, results)), conf.num_shards), conf.root)
    finally:
        storage.remove(spark, staging)
    return {**delta, "results": path}, results.where(F.coalesce("error", F.lit("")) != UNLISTED)


def _with_delta(state: State, made: dict) -> State:
    delta = {"path": made["path"], "shards": made["shards"], "commit": state["number"] + 1}
    return {**state, "results": made["results"], "deltas": [*state["deltas"], *([delta] if delta["shards"] else [])]}


def compact_due(spark: SparkSession, conf: IndexConf) -> list[int]:
    """Compact shards at the threshold; their numbers (there are ``num_shards`` at most)."""
    due = compaction_due(pending_deltas(spark, conf.root), conf.num_shards, conf.compaction_threshold)
    shards = [row.shard for row in due.collect()]
    compact(spark, conf.root, shards, conf.baseline_buckets)
    return shards


def _bounds(listing: DataFrame) -> tuple[dict[str, str], dict[str, str]]:
    """Per bucket the first and the last key of a listing."""
    rows = listing.groupBy("bucket").agg(F.min("key").alias("first"), F.max("key").alias("last")).collect()
    return {r.bucket: r.first for r in rows}, {r.bucket: r.last for r in rows}


def index_listed(spark: SparkSession, conf: IndexConf, listing: DataFrame, cursors: dict[str, str]) -> tuple[dict, DataFrame]:
    """``index_segments`` for listed segments. A segment that cannot be read gets an error, the others are indexed."""
    first, last = _bounds(listing)
    with small_files(spark):
        # From the first listed key's folder on; what the cursor has passed stays out.
        lines = read_segment_lines(
            spark, {b: r for b, r in conf.buckets.items() if b in first}, {b: max(cursors.get(b, ""), _just_before(k)) for b, k in first.items()},
            upto=last, tolerant=True)
        return index_segments(spark, conf, lines, listing)


def _just_before(key: str) -> str:
    """A text below the key and in its folder, with nothing between but the key's own beginnings."""
    return key[:-1]


def run_index_cycle(spark: SparkSession, conf: IndexConf, listing: DataFrame | None = None) -> DataFrame:
    """Index everything after the cursors once; one row of cycle totals.

    A cycle that finds no new segment writes nothing. Delta, results and cursors count by one commit; a cycle that failed before it
    left nothing that counts. A cycle that starts while another one runs fences that one. ``listing`` takes the place
    of the listing of the buckets (``conf.listing`` ``"manifest"``: that of the writers' manifests).
    """
    log = CommitLog(spark, conf.root)
    known = log.latest()["cursors"]
    if listing is None:
        list_new = manifest_listing if conf.listing == "manifest" else list_segments
        listing = list_new(spark, conf.buckets, known)
    if listing.isEmpty():
        return cycle_totals(spark.createDataFrame([], SEGMENT_RESULTS))
    listing = cut(listing, "listing")
    epoch = log.open("cycle")
    made, results = index_listed(spark, conf, listing, known)
    passed = results.withColumn("error", F.lit(None).cast("string")) if conf.skip_failed else results
    moved = {r.bucket: r.last_key for r in advance_cursors(passed).collect()}  # one row per bucket
    log.commit("cycle", epoch, lambda state: {**_with_delta(state, made), "cursors": {**state["cursors"], **moved}})
    compact_due(spark, conf)
    return cycle_totals(results)


def index_batch(spark: SparkSession, conf: IndexConf, stream: str, epoch: int, batch_id: int,
                lines: DataFrame | None = None, listing: DataFrame | None = None) -> None:
    """One micro-batch of a stream, lines or listed segments, to a delta; a batch that the log has already is passed over."""
    log = CommitLog(spark, conf.root)
    done = lambda state: state["streams"].get(stream, -1) >= batch_id
    if done(log.latest()):
        return
    made, _ = index_segments(spark, conf, lines) if lines is not None else index_listed(spark, conf, listing, {})
    writer = f"stream:{stream}"
    log.commit(writer, epoch, lambda s: None if done(s) else {**_with_delta(s, made), "streams": {**s["streams"], stream: batch_id}})
    compact_due(spark, conf)


def entries_per_shard(entries: DataFrame) -> DataFrame:
    return entries.groupBy("shard").agg(
        F.count("*").alias("entries"),
        F.sum(F.col("end_byte") - F.col("start_byte")).alias("bytes"),
    )
