"""Segment files with their manifest, and rejected messages.

Every write of a batch goes to folders named by writer instance and batch. The manifest comes
last: a batch that has one is complete and is never written again, so what an index
holds of it stays valid; a batch without one is replaced as a whole.
"""

from __future__ import annotations

import time
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import storage
from ..functions.keys import parse_segment_key
from ..operators.packing import MAX_BYTES, MAX_ROWS
from ..session import small_files
from ..sources.segments import file_path, key_of

# Bytes that one file of a segment gets when several tasks write it.
FILE_BYTES = 64 * 1024 * 1024

_MANIFEST = (
    "key string, instance_id string, segment_id string, event_count long, batch_id long, "
    "flush_ts long, size_bytes long"
)


def _stored(spark: SparkSession, path: str, ddl: str) -> DataFrame | None:
    """A table of a batch, or None if it was not written yet."""
    try:
        return spark.read.schema(ddl).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def _of_batch(root: str, table: str, instance: str, batch_id: int) -> str:
    return f"{root}/{table}/instance={instance}/batch={batch_id}"


def committed(spark: SparkSession, root: str, instance: str, batch_id: int) -> DataFrame | None:
    """The manifest of a complete batch, else None."""
    return _stored(spark, _of_batch(root, "manifest", instance, batch_id), _MANIFEST)


def flush_time(spark: SparkSession, root: str, instance: str, batch_id: int, now: int | None = None) -> int:
    """The flush second of a batch: recorded at its first attempt, read back later."""
    path = _of_batch(root, "_flushes", instance, batch_id)
    stored = _stored(spark, path, "flush_ts long")
    row = stored.head() if stored is not None else None
    if row is not None:
        return row.flush_ts
    else:
        stamp = int(time.time()) if now is None else now
        spark.range(1).select(F.lit(stamp).cast("long").alias("flush_ts")).coalesce(
            1
        ).write.mode("overwrite").parquet(path)
        return stamp


def one_line(payload: Column) -> Column:
    """A payload on one line; JSON has raw newlines only between tokens."""
    return F.translate(payload, "\n", " ")


def label_by_task(
    events: DataFrame, max_rows: int = MAX_ROWS, max_bytes: int = MAX_BYTES
) -> DataFrame:
    """Add ``segment`` labels that keep both limits, with no shuffle.

    A task's rows are cut where a running count or the running bytes of the lines would pass
    a limit; a longer line is a segment of its own. Events must come from a cache or a
    sorted partition, so that a row keeps its place.
    """
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, number, rows, size = TaskContext.get().partitionId(), 0, 0, 0
        for batch in batches:
            labels = []
            for taken in pc.binary_length(batch.column("payload")).to_pylist():
                if rows and (rows >= max_rows or size + taken + 1 > max_bytes):
                    number, rows, size = number + 1, 0, 0
                rows, size = rows + 1, size + taken + 1
                labels.append(f"{task:06d}-{number:06d}")
            yield batch.append_column("segment", pa.array(labels, pa.string()))

    return events.mapInArrow(cut, T.StructType([*events.schema.fields, T.StructField("segment", T.StringType())]))


def label_whole(events: DataFrame, size: int, file_bytes: int = FILE_BYTES) -> DataFrame:
    """Add the ``segment`` label of events that are one segment of ``size`` bytes, with no shuffle.

    Tasks are merged until each writes about ``file_bytes`` of it, a file each; so a small segment has one file.
    """
    return events.coalesce(max(1, -(-size // file_bytes))).withColumn("segment", F.lit(f"{0:06d}-{0:06d}"))


def write_segments(
    events: DataFrame,
    batch_id: int,
    root: str,
    instance: str,
    flush_ts: int | None = None,
    gather: bool = False,
) -> DataFrame:
    """Write labelled events below ``{root}/events/{flush}/{instance}`` and their manifest.

    A segment is a folder ``segment=b{batch}-{label}`` there, which its key names as the segment. What an earlier
    attempt of the batch left goes first. The manifest has a row per file, with the key, size
    and events that the file was then found to have.

    ``gather=True`` brings a segment's rows together
    first, for labels that cross tasks; a segment is bounded by the flush limits.
    """
    spark = events.sparkSession
    stamp = flush_time(spark, root, instance, batch_id, flush_ts)
    folder, mine = f"events/{stamp}/{instance}", f"b{batch_id:09d}-"
    for name, _ in storage.children(spark, f"{root}/{folder}"):
        if name.startswith(f"segment={mine}"):
            storage.remove(spark, f"{root}/{folder}/{name}")
    label = F.concat(F.lit(mine), "segment").alias("segment")
    lines = events.select(label, one_line(F.col("payload")).alias("value"))
    if gather:
        order = [c for c in ("arrival",) if c in events.columns]
        lines = events.select(label, *order, one_line(F.col("payload")).alias("value"))
        lines = lines.repartition("segment").sortWithinPartitions("segment", *order).select("segment", "value")
    lines.write.mode("append").partitionBy("segment").text(f"{root}/{folder}", lineSep="\n")
    path = _of_batch(root, "manifest", instance, batch_id)
    with small_files(spark):
        written = spark.read.option("recursiveFileLookup", "true").text(f"{root}/{folder}", lineSep="\n")
        key = key_of(file_path(), root)
        found = written.where(F.contains(key, F.lit(f"/segment={mine}"))).groupBy(key.alias("key"), F.col("_metadata.file_size").alias("size_bytes"))
        found.agg(F.count("*").alias("event_count")).select(
            "key",
            F.lit(instance).alias("instance_id"),
            parse_segment_key(F.col("key"))["segment"].alias("segment_id"),
            "event_count",
            F.lit(batch_id).cast("long").alias("batch_id"),
            F.lit(stamp).cast("long").alias("flush_ts"),
            "size_bytes",
        ).write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def write_rejects(rejects: DataFrame, root: str, instance: str, batch_id: int) -> None:
    rejects.write.mode("overwrite").parquet(_of_batch(root, "rejects", instance, batch_id))
