"""Staged batches: JSON array files of events, reloaded as a backfill."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import EVENTS, fields

# Fixed value: the number in a staged file's name.
STAGED_NUMBER = r"wal-(\d+)\.json$"


def reload_staged(spark: SparkSession, glob: str) -> DataFrame:
    """Events of all staged files matching ``glob``, with the file and its number.

    A file that is not a clean JSON array of events is left out as a whole. Files are
    ordered by their number. Each file holds one collected batch, so a file is one task's
    work. Payloads come back as text.
    """
    names = list(fields(EVENTS))
    text = [name for name in names if name != "timestamp"]
    raw = (
        spark.read.schema(", ".join(f"{name} variant" for name in names) + ", broken string")
        .option("multiLine", "true")
        .option("columnNameOfCorruptRecord", "broken")
        .option("allowSingleQuotes", "false")
        .json(glob)
        .select("*", F.col("_metadata.file_path").alias("staged_file"))
    )
    sound = F.col("broken").isNull()
    for name in names:
        kinds = "'STRING', 'VOID'" if name in text else "'BIGINT', 'VOID'"
        sound = sound & F.expr(f"coalesce(schema_of_variant({name}) IN ({kinds}), true)")
    plain = raw.select(
        "staged_file", sound.alias("__sound"), F.expr("try_cast(timestamp AS bigint)").alias("timestamp"),
        *[F.expr(f"coalesce(try_cast({name} AS string), '')").alias(name) for name in text],
    ).withColumn("__bytes", F.try_to_binary("payload", F.lit("base64")))
    events = plain.select(
        *[name for name in text if name != "payload"],
        F.coalesce("timestamp", F.lit(0)).alias("timestamp"),
        F.col("__bytes").cast("string").alias("payload"),
        "staged_file",
        F.regexp_extract("staged_file", STAGED_NUMBER, 1).try_cast("long").alias("staged_no"),
        (~F.col("__sound") | F.col("__bytes").isNull()).alias("__broken"),
    )
    broken = events.where("__broken").select("staged_file").distinct()
    clean = events.join(broken, ["staged_file"], "left_anti").drop("__broken")
    return clean.select(
        "event_id", "reference_id", "timestamp", "category", "event_type", "payload",
        "staged_file", "staged_no",
    )
