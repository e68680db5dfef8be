"""Session defaults and the shared scratch location."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Settings every result depends on: times are read and shown in UTC.
REQUIRED = {"spark.sql.session.timeZone": "UTC"}

# Settings that only tune speed; a cluster's own values win.
TUNING = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}

# While many small files are listed and read: tasks list a share of the folders each, and read as many files as fill them. Else
# there is a task per folder and one per few files, and the driver keeps an account of every task.
SMALL_FILES = {
    "spark.sql.sources.parallelPartitionDiscovery.parallelism": "64",
    "spark.sql.files.openCostInBytes": "65536",
}


def local_session(cores: str | int = "*", memory: str = "8g", app: str = "streambed") -> SparkSession:
    """A session for tests and the benchmark."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    for key, value in {**REQUIRED, **TUNING}.items():
        builder = builder.config(key, value)
    partitions = 8 if cores == "*" else max(int(cores), 1)
    return (
        builder.config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def prepare(spark: SparkSession) -> SparkSession:
    """Set what results depend on in a session somebody else made."""
    for key, value in REQUIRED.items():
        spark.conf.set(key, value)
    return spark


@contextmanager
def small_files(spark: SparkSession) -> Iterator[None]:
    """Plan and run reads inside for many small files; a session that already asks for less keeps its own values."""
    before = {key: spark.conf.get(key) for key in SMALL_FILES}
    for key, value in SMALL_FILES.items():
        now = before[key]
        if not now.isdigit() or int(now) > int(value):
            spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


def shared_dir(spark: SparkSession, purpose: str) -> str:
    """A new folder below ``spark.checkpoint.dir``.

    The cluster names that folder and every executor sees it. Only a local session without
    that setting, as in tests, gets a temporary folder of this machine.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="streambed-")
    return f"{root.rstrip('/')}/streambed/{purpose}-{uuid.uuid4().hex}"


def cut(rows: DataFrame, purpose: str) -> DataFrame:
    """Write a narrow table to the shared folder and go on from there.

    For tables that several later steps read and whose making is costly: it is made once,
    and an executor that is lost takes none of it along.
    """
    path = shared_dir(rows.sparkSession, purpose)
    rows.write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)
