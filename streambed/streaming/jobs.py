"""The two long-running jobs, each a streaming query with its own checkpoint."""

from __future__ import annotations

import json
from functools import reduce

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from .. import storage
from ..functions.keys import parse_segment_key
from ..operators.decode import decode_events
from ..plans.index import IndexConf, index_batch
from ..plans.ingest import IngestConf, flush_batch
from ..session import cut
from ..sinks.commits import CommitLog
from ..sources.listing import SegmentListing, listing_options
from ..sources.messages import read_messages, with_arrival
from ..sources.segments import stream_segment_lines
from .dedup import dedup_stream, drained
from .recorder import OBSERVED, IngestRecorder


def _trigger(interval: str, once: bool) -> dict:
    return {"availableNow": True} if once else {"processingTime": interval}


def _checkpoint(conf: IngestConf | IndexConf) -> str:
    """Batch numbers live here: a job that forgot them would write over its own batches."""
    if not conf.checkpoint:
        raise ValueError("a streaming job needs a checkpoint folder of its own")
    return conf.checkpoint


def _observed(decoded: DataFrame, name: str = OBSERVED) -> DataFrame:
    """Count valid messages as they pass; progress events report it per micro-batch."""
    return decoded.observe(name, F.count(F.when(F.col("reason").isNull(), 1)).alias("valid"))


def run_ingest(spark: SparkSession, conf: IngestConf, once: bool = False) -> StreamingQuery:
    """Messages to segments, one flush per micro-batch; ``once`` drains and stops.

    Valid and rejected rows travel in one stream and read the source once: a reject
    passes the dedup. Only the event clock, which would hold a
    reject's missing time against it, reads the source a second time for rejects.

    Counts and times of every batch are recorded (``sinks.metrics``): what was flushed with the flush, what the dedup dropped
    when the batch's progress is known. The query's ``recorder`` listens to that; ``settle`` it after a query stopped.
    """
    decoded = decode_events(with_arrival(read_messages(spark, conf.source, stream=True)), conf.strict)
    decoded = decoded.withColumn("timestamp", F.coalesce("timestamp", F.lit(0)))
    valid = F.col("reason").isNull()
    window = conf.dedup_window_s
    if window is None:
        kept = _observed(decoded)
    elif conf.dedup_mode == "event_clock":
        kept = dedup_stream(
            _observed(decoded.where(valid)), ["event_id"], "timestamp", window, "event_clock"
        ).unionByName(decoded.where(~valid))
    else:
        # A reject has no id; only the built-in dedup, which would take those for one, gives it one of its own.
        own = F.concat(F.lit("r:"), F.uuid()) if conf.dedup_mode == "arrival_clock" else F.lit(None).cast("string")
        key = F.when(valid, F.concat(F.lit("e:"), "event_id")).otherwise(own)
        kept = dedup_stream(
            _observed(decoded).withColumn("__id", key), ["__id"], "timestamp", window, conf.dedup_mode
        ).drop("__id")
    recorder = IngestRecorder(spark, conf.root, conf.instance)

    def flush(batch: DataFrame, batch_id: int) -> None:
        recorder.flushed(batch_id, flush_batch(batch, conf, batch_id))

    writer = (
        kept.writeStream.foreachBatch(flush)
        .option("checkpointLocation", _checkpoint(conf))
        .trigger(**_trigger(conf.trigger, once))
        .queryName(f"ingest-{conf.instance}")
    )
    spark.streams.addListener(recorder)
    with drained(spark, once):
        query = writer.start()
    recorder.query_id = str(query.id)
    query.recorder = recorder
    return query


def drain_ingest(spark: SparkSession, conf: IngestConf, attempts: int = 3) -> None:
    """Run the ingest job until its input is drained and its record is complete.

    A flush that fails ends the query, which then starts again from its checkpoint with the same batch, at most
    ``attempts`` times without a batch coming through in between.
    """
    left, last = attempts, -1
    while True:
        query = run_ingest(spark, conf, once=True)
        failed = None
        try:
            query.awaitTermination()
        except StreamingQueryException as error:
            failed = error
        finally:
            query.recorder.settle(query)
            spark.streams.removeListener(query.recorder)
        if failed is None:
            return
        done = max((p.batchId for p in query.recentProgress), default=last)
        left, last = (attempts, done) if done > last else (left, last)
        left -= 1
        if left <= 0:
            raise failed


def stream_id(spark: SparkSession, checkpoint: str) -> str:
    """The id of the query that owns a checkpoint: a new checkpoint in the same place is another stream."""
    return json.loads(storage.read_text(spark, f"{checkpoint.rstrip('/')}/metadata"))["id"]


def run_index(spark: SparkSession, conf: IndexConf, once: bool = False) -> StreamingQuery:
    """Segments of all buckets to index deltas, one cycle per micro-batch.

    ``conf.listing`` ``"seen_files"`` (default): the stream's own log of files seen replaces the cursor, so a file that appears late,
    below keys already read, is indexed all the same. ``"start_after"``: the offset is the last key of each bucket and only
    flush folders at or after it are listed; a late key is not read, a segment that cannot be read is left out with an
    error in the results.

    Micro-batches are commits of the index log, which batch cycles on the same root share. A stream that starts again
    fences its earlier run.
    """
    checkpoint = _checkpoint(conf)
    start_after = conf.listing == "start_after"
    if start_after:
        spark.dataSource.register(SegmentListing)
        source = spark.readStream.format("segment_listing").options(**listing_options(conf.buckets)).load()
        source = source.where(parse_segment_key(F.col("key")).isNotNull())
    else:
        source = reduce(DataFrame.unionByName, [
            stream_segment_lines(spark, bucket, root, conf.max_files_per_trigger) for bucket, root in sorted(conf.buckets.items())
        ])
    run: dict = {}

    def cycle(batch: DataFrame, batch_id: int) -> None:
        if not run:
            run["stream"] = stream_id(spark, checkpoint)
            run["epoch"] = CommitLog(spark, conf.root).open(f"stream:{run['stream']}")
        if start_after:
            listing = cut(batch, "listing")
            if not listing.isEmpty():
                index_batch(spark, conf, run["stream"], run["epoch"], batch_id, listing=listing)
            return
        numbered = batch.withColumn("line_no", F.monotonically_increasing_id()).withColumn(
            "line_bytes", F.octet_length("line")
        )
        index_batch(spark, conf, run["stream"], run["epoch"], batch_id, numbered)

    return (
        source.writeStream.foreachBatch(cycle)
        .option("checkpointLocation", checkpoint)
        .trigger(**_trigger(conf.trigger, once))
        .queryName("index")
        .start()
    )
