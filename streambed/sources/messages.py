"""Raw messages from a broker topic or from files, as a table or a stream."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed value: where a new consumer group starts.
STARTING_OFFSETS = "earliest"
# Partitions that arrival numbers tell apart.
MOST_PARTITIONS = 1 << 20
# What one micro-batch takes unless told otherwise, so that the first one is not the whole topic.
MAX_OFFSETS = 1_000_000
MAX_FILES = 1_000
# A file stream skips files this much older than the newest one; far beyond any file's age.
MAX_FILE_AGE = "36500d"


def read_messages(
    spark: SparkSession, options: Mapping[str, str], stream: bool = False
) -> DataFrame:
    """Messages as ``value, topic, partition, offset``.

    ``options["format"]`` is ``kafka`` (default; other entries go to the connector) or
    ``text`` (one message per line below ``options["path"]``). A stream's batches are capped by
    ``maxOffsetsPerTrigger`` (``MAX_OFFSETS``) or ``maxFilesPerTrigger`` (``MAX_FILES``).
    """
    settings = dict(options)
    source = settings.pop("format", "kafka")
    reader = (spark.readStream if stream else spark.read).format(source)
    if source == "kafka":
        settings.setdefault("startingOffsets", STARTING_OFFSETS)
        if stream:
            settings.setdefault("maxOffsetsPerTrigger", str(MAX_OFFSETS))
        raw = reader.options(**settings).load()
        return raw.select(F.col("value").cast("string"), "topic", "partition", "offset")
    if source != "text":
        raise ValueError(f"unknown message source {source!r}")
    path = settings.pop("path")
    topic = settings.pop("topic", "files")
    if stream:
        settings.setdefault("maxFileAge", MAX_FILE_AGE)
        settings.setdefault("maxFilesPerTrigger", str(MAX_FILES))
    raw = reader.options(lineSep="\n", **settings).load(path)
    # Files keep the order of lines within a read split; splits stand in for partitions.
    place = F.monotonically_increasing_id()
    if stream:
        return raw.select(
            "value", F.lit(topic).alias("topic"), F.lit(0).alias("partition"),
            F.lit(None).cast("long").alias("offset"),
        )
    return raw.select(
        "value", F.lit(topic).alias("topic"),
        F.shiftright(place, 33).cast("int").alias("partition"),
        place.bitwiseAND(F.lit((1 << 33) - 1)).alias("offset"),
    )


def with_arrival(messages: DataFrame, name: str = "arrival") -> DataFrame:
    """Number messages in arrival order; NULL where the source has no offsets.

    Offsets order the rows of one partition; rows of other partitions arrived at the same
    time, so any order among them will do. Partitions interleave without a shuffle. A number is of its own for
    up to ``MOST_PARTITIONS`` partitions of up to 2^43 messages; beyond either this fails.
    """
    number = F.col("offset") * MOST_PARTITIONS + F.col("partition")
    fits = (F.col("partition") < MOST_PARTITIONS) & (F.col("offset") < (1 << 43))
    wrong = F.raise_error(F.lit("too many partitions or offsets to number messages by arrival"))
    return messages.withColumn(name, F.when(F.col("offset").isNull() | fits, number).otherwise(wrong.cast("bigint")))
