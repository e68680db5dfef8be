"""Segment files of one or more buckets: listing and reading."""

from __future__ import annotations

import logging
from collections.abc import Mapping
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from py4j.protocol import Py4JJavaError

from .. import storage
from ..functions.keys import is_segment_key, parse_segment_key
from ..operators.indexing import sort_segments
from ..schemas import SEGMENTS
from .listing import SEGMENT_PREFIX, SegmentListing, listing_options, reachable
from .messages import MAX_FILE_AGE

log = logging.getLogger(__name__)

LINE_COLUMNS = "bucket string, key string, file_size long, split_start long, line_no long, line string, line_bytes int"


def key_of(path: Column, root: str) -> Column:
    """The part of a file path below a bucket's root folder."""
    base = root.split("://", 1)[-1].removeprefix("file:").rstrip("/") + "/"
    return F.substring(path, F.instr(path, F.lit(base)) + F.lit(len(base)), F.length(path))


def file_path() -> Column:
    """Path of the file a row was read from; Spark gives it URL-encoded, which few paths need."""
    path = F.col("_metadata.file_path")
    return F.when(F.contains(path, F.lit("%")), F.url_decode(F.replace(path, F.lit("+"), F.lit("%2B")))).otherwise(path)


def _folder(root: str, prefix: str) -> str:
    return f"{root.rstrip('/')}/{prefix}"


def folders_from(spark: SparkSession, root: str, prefix: str = SEGMENT_PREFIX, first_key: str = "") -> list[str]:
    """Folders to list for the keys from ``first_key`` on: flushes before its own are not opened.

    Flush folders are compared as text, as keys are. Without a first key it is the whole prefix.
    """
    if not first_key.startswith(prefix):
        return [_folder(root, prefix)]
    first = first_key[len(prefix):].split("/", 1)[0]
    return [f"{_folder(root, prefix)}{n}" for n, folder in storage.children(spark, _folder(root, prefix)) if n >= first and folder]


def _each_bucket(buckets: Mapping[str, str], read) -> tuple[list[DataFrame], list[str]]:
    """Read every bucket; one that cannot be listed is reported and left out."""
    tables, failed = [], []
    for bucket, root in buckets.items():
        try:
            tables.append(read(bucket, root))
        except (AnalysisException, Py4JJavaError) as error:
            log.warning("bucket %s left out: %s", bucket, error)
            failed.append(bucket)
    return tables, failed


def list_segments(
    spark: SparkSession,
    buckets: Mapping[str, str],
    cursors: Mapping[str, str] | None = None,
    prefix: str = SEGMENT_PREFIX,
) -> DataFrame:
    """Segments of ``{bucket: root folder}`` after each bucket's cursor, in processing order.

    Only flush folders at or after the cursor's are listed, a task each. A key that appears later below the cursor
    is not found. Files whose key is malformed are left out, and so is a bucket that cannot be listed. Where Arrow knows no file
    system for a root, Spark lists it, which passes over empty files.
    """
    cursors = cursors or {}
    spark.dataSource.register(SegmentListing)
    near = {b: r for b, r in buckets.items() if reachable(r)}
    tables = [spark.read.format("segment_listing").options(**listing_options(near, cursors, prefix)).load()] if near else []

    def read(bucket: str, root: str) -> DataFrame:
        folders = folders_from(spark, root, prefix, cursors.get(bucket, ""))
        if not folders:
            return spark.createDataFrame([], "bucket string, key string, size long")
        listed = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folders)
        return listed.select(F.lit(bucket).alias("bucket"), key_of(F.col("path"), root).alias("key"), F.col("length").alias("size"))

    tables += _each_bucket({b: r for b, r in buckets.items() if b not in near}, read)[0]
    if not tables:
        return spark.createDataFrame([], SEGMENTS)
    after = reduce(lambda rest, b: F.when(F.col("bucket") == b, F.lit(cursors[b])).otherwise(rest), cursors, F.lit(""))
    return sort_segments(
        reduce(DataFrame.unionByName, tables).where(F.col("key") > after)
        .withColumn("at", parse_segment_key(F.col("key")))
        .where(F.col("at").isNotNull())
        .select("bucket", "key", "at.timestamp", "at.writer", "at.segment", "size")
    )


def read_segment_lines(
    spark: SparkSession,
    buckets: Mapping[str, str],
    cursors: Mapping[str, str] | None = None,
    prefix: str = SEGMENT_PREFIX,
    upto: Mapping[str, str] | None = None,
    tolerant: bool = False,
) -> DataFrame:
    """Lines of all segments after each bucket's cursor, with their place in the file.

    The cursor is one literal per bucket and tests only the file path, so Spark drops
    older files while listing and never opens them; flush folders before the cursor's are not listed.
    Files are split like any text, so a large segment is read by many tasks; ``split_start, line_no`` order its lines.
    ``upto`` ends each bucket at a key. ``tolerant`` leaves out what cannot be read of a file, or a
    file that is gone, instead of failing; ``segment_results`` finds such segments by their size.
    """
    cursors = cursors or {}
    lenient = {"ignoreCorruptFiles": str(tolerant).lower(), "ignoreMissingFiles": str(tolerant).lower()}

    def read(bucket: str, root: str) -> DataFrame:
        folders = folders_from(spark, root, prefix, cursors.get(bucket, ""))
        if not folders:
            return spark.createDataFrame([], LINE_COLUMNS)
        text = spark.read.options(recursiveFileLookup="true", **lenient).text(folders, lineSep="\n")
        key = key_of(file_path(), root)
        newer = text.where(key > F.lit(cursors.get(bucket, "")))
        if upto is not None:
            newer = newer.where(key <= F.lit(upto.get(bucket, "")))
        newer = newer.where(is_segment_key(key))
        return placed_lines(newer, F.lit(bucket), key)

    tables, _ = _each_bucket(buckets, read)
    if not tables:
        return spark.createDataFrame([], LINE_COLUMNS)
    return reduce(DataFrame.unionByName, tables)


def manifest_listing(
    spark: SparkSession, buckets: Mapping[str, str], cursors: Mapping[str, str] | None = None
) -> DataFrame:
    """The same table as ``list_segments`` from the manifests that the writers left, without listing a folder of segments."""
    cursors = cursors or {}

    def read(bucket: str, root: str) -> DataFrame:
        rows = spark.read.parquet(f"{root.rstrip('/')}/manifest").where(F.col("key") > F.lit(cursors.get(bucket, "")))
        return (
            rows.withColumn("at", parse_segment_key(F.col("key"))).where(F.col("at").isNotNull())
            .select(F.lit(bucket).alias("bucket"), "key", "at.timestamp", "at.writer", "at.segment", F.col("size_bytes").alias("size"))
        )

    tables, _ = _each_bucket(buckets, read)
    if not tables:
        return spark.createDataFrame([], SEGMENTS)
    return sort_segments(reduce(DataFrame.unionByName, tables))


def placed_lines(text: DataFrame, bucket: Column, key: Column) -> DataFrame:
    """Name and number the lines of a text source that was read with file metadata."""
    return text.select(
        bucket.alias("bucket"),
        key.alias("key"),
        F.col("_metadata.file_size").alias("file_size"),
        F.col("_metadata.file_block_start").alias("split_start"),
        F.monotonically_increasing_id().alias("line_no"),
        F.col("value").alias("line"),
        F.octet_length("value").alias("line_bytes"),
    )


def stream_segment_lines(
    spark: SparkSession, bucket: str, root: str, max_files: int, prefix: str = SEGMENT_PREFIX
) -> DataFrame:
    """One bucket's segments as a stream of lines with their place in the file."""
    text = (
        spark.readStream.option("recursiveFileLookup", "true")
        .option("maxFilesPerTrigger", str(max_files))
        .option("maxFileAge", MAX_FILE_AGE)
        .text(_folder(root, prefix), lineSep="\n")
    )
    key = key_of(file_path(), root)
    return text.select(
        F.lit(bucket).alias("bucket"),
        key.alias("key"),
        F.col("_metadata.file_size").alias("file_size"),
        F.col("_metadata.file_block_start").alias("split_start"),
        F.col("value").alias("line"),
    )
