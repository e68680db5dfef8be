"""The index on disk: deltas per commit, a baseline per shard, cursors.

Layout below an index root:

``commits/N.json``               the state after commit N (see ``commits.py``)
``delta/id=X/shard=N``           entries of one cycle or micro-batch
``baseline/buckets=B/id=X``      compacted entries, by shard, in B buckets of row keys
``results/id=X``                 the latest cycle's segment results

A folder gets a name of its own and counts once a commit names it. Readers open the folders that the latest commit
names, so merged deltas and old baselines are never listed; nothing that a reader may hold is overwritten.

Baselines are bucketed and sorted by row key. What is newer meets them bucket by bucket: reading the index and compacting it
shuffle the deltas, never a baseline.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import storage
from ..operators.dedup import latest_entries
from ..operators.routing import route
from ..schemas import CURSORS
from .commits import CommitLog, StaleWriter, State

# Fixed value: deltas of a shard that make it due for compaction.
COMPACTION_THRESHOLD = 32

# Buckets of a baseline; a parameter of the job, to be as many as tasks should merge it.
BASELINE_BUCKETS = 8
ROW_KEY = ["reference_id", "ts", "event_id"]
_ENTRY = (
    "reference_id string, ts long, event_id string, bucket string, key string, "
    "start_byte long, end_byte long, row_key string, locator string, seg_ts long, "
    "writer string, segment string, time_unreadable boolean"
)
_NAMES = ["shard", *[c.split()[0] for c in _ENTRY.split(", ")]]


def new_folder(table: str) -> str:
    """A folder below the root that no other attempt writes to."""
    return f"{table}/id={uuid.uuid4().hex}"


def _write(entries: DataFrame, path: str) -> None:
    quiet = {"mapreduce.fileoutputcommitter.marksuccessfuljobs": "false"}  # a commit says that the folder is whole
    route(entries.select(*_NAMES)).write.options(**quiet).partitionBy("shard").parquet(path)


def write_delta(entries: DataFrame, root: str) -> dict:
    """Write one cycle's entries by shard; what a commit needs to name them."""
    path = new_folder("delta")
    _write(entries, f"{root}/{path}")
    held = storage.children(entries.sparkSession, f"{root}/{path}")
    return {"path": path, "shards": [int(n.removeprefix("shard=")) for n, folder in held if folder]}


def pending_deltas(spark: SparkSession, root: str) -> DataFrame:
    """``shard, batch, path`` of the deltas not yet part of their shard's baseline, from the log alone."""
    state = CommitLog(spark, root).latest()
    rows = [(shard, d["commit"], f"{root}/{d['path']}") for d in state["deltas"] for shard in d["shards"]]
    return spark.createDataFrame(rows, "shard int, batch long, path string")


def delta_counts(deltas: DataFrame, num_shards: int) -> DataFrame:
    """Deltas per shard, zero included; one delta is one batch, whatever its file count."""
    spark = deltas.sparkSession
    counted = deltas.groupBy("shard").agg(F.count_distinct("batch").alias("__n"))
    shards = spark.range(num_shards).select(F.col("id").cast("int").alias("shard"))
    return shards.join(counted, "shard", "left").select(
        "shard", F.coalesce("__n", F.lit(0)).alias("deltas")
    )


def compaction_due(
    deltas: DataFrame, num_shards: int, threshold: int = COMPACTION_THRESHOLD
) -> DataFrame:
    return delta_counts(deltas, num_shards).where(F.col("deltas") >= threshold)


def read_index(spark: SparkSession, root: str, state: State | None = None) -> DataFrame:
    """All current entries: baselines plus newer deltas, latest write per row key."""
    state = CommitLog(spark, root).latest() if state is None else state
    return _current(spark, root, state)


def _read_deltas(spark: SparkSession, root: str, state: State, shards: set[int]) -> DataFrame:
    """Entries of the unmerged deltas of some shards; nothing else of the table is listed."""
    folders = [f"{root}/{d['path']}/shard={s}" for d in state["deltas"] for s in d["shards"] if s in shards]
    if not folders:
        return spark.createDataFrame([], f"shard int, {_ENTRY}")
    reader = spark.read.schema(f"{_ENTRY}, id string, shard int").option("basePath", f"{root}/delta")
    return reader.parquet(*folders).select(*_NAMES)


def _baseline(spark: SparkSession, root: str, folder: str) -> DataFrame:
    """A baseline as a bucketed table; the session's catalog learns of it by its folder."""
    buckets, name = _buckets_of(folder), _table_of(folder)
    keys = ", ".join(ROW_KEY)
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} ({_ENTRY}, shard int) USING parquet PARTITIONED BY (shard) "
        f"CLUSTERED BY ({keys}) SORTED BY ({keys}) INTO {buckets} BUCKETS LOCATION '{root}/{folder}'")
    return spark.table(name).select(*_NAMES)


def _buckets_of(folder: str) -> int:
    return int(folder.split("buckets=")[1].split("/")[0])


def _table_of(folder: str) -> str:
    return f"streambed_baseline_{folder.rsplit('id=', 1)[1]}"


def _current(spark: SparkSession, root: str, state: State, only: set[int] | None = None) -> DataFrame:
    """Current entries of some shards: each baseline with the newer entries of its shards, and shards without one."""
    by_folder: dict[str, set[int]] = {}
    for shard, path in state["baseline"].items():
        if only is None or int(shard) in only:
            by_folder.setdefault(path.rsplit("/", 1)[0], set()).add(int(shard))
    based = {s for shards in by_folder.values() for s in shards}
    fresh = {s for d in state["deltas"] for s in d["shards"] if only is None or s in only} - based
    parts = [latest_entries(_read_deltas(spark, root, state, fresh))] if fresh or not by_folder else []
    for folder, shards in sorted(by_folder.items()):
        base = _baseline(spark, root, folder).where(F.col("shard").isin(*sorted(shards)))
        # Dealt to as many tasks as the baseline has buckets, else Spark would deal both anew.
        newer = _read_deltas(spark, root, state, shards).repartition(_buckets_of(folder), *ROW_KEY)
        parts.append(newest(base, latest_entries(newer)))
    return reduce(DataFrame.unionByName, parts)


def newest(base: DataFrame, newer: DataFrame) -> DataFrame:
    """Of two tables with one entry per row key: the entry of the latest segment position."""
    rank = ["seg_ts", "writer", "segment", "bucket", "key", "start_byte"]
    rest = [c for c in base.columns if c not in ROW_KEY]
    side = lambda rows, name: rows.select(*ROW_KEY, F.struct(*rank, *[c for c in rest if c not in rank]).alias(name))
    met = side(base, "__base").join(side(newer, "__newer"), ROW_KEY, "full")
    entry = F.greatest("__base", "__newer")  # one of them may be null
    return met.withColumn("__entry", entry).select(*[c if c in ROW_KEY else F.col(f"__entry.{c}").alias(c) for c in base.columns])


def compact(spark: SparkSession, root: str, shards: Sequence[int], buckets: int = BASELINE_BUCKETS) -> str | None:
    """Merge the deltas of the given shards into new baselines; the folder that holds them.

    Deltas committed meanwhile stay as they are. A compaction that another one overtakes is dropped (None).
    """
    shards = sorted({int(s) for s in shards})
    if not shards:
        return None
    log = CommitLog(spark, root)
    epoch = log.open("compaction")
    before = log.latest()
    path = new_folder(f"baseline/buckets={buckets}")
    _write_buckets(_current(spark, root, before, set(shards)), f"{root}/{path}", _table_of(path), buckets)
    held = {n.removeprefix("shard=") for n, folder in storage.children(spark, f"{root}/{path}") if folder}
    merged = {d["path"] for d in before["deltas"]}

    def swap(state: State) -> State:
        left = [
            {**d, "shards": [s for s in d["shards"] if d["path"] not in merged or s not in shards]} for d in state["deltas"]
        ]
        base = {**state["baseline"], **{s: f"{path}/shard={s}" for s in map(str, shards) if s in held}}
        return {**state, "deltas": [d for d in left if d["shards"]], "baseline": base}

    try:
        log.commit("compaction", epoch, swap)
    except StaleWriter:
        storage.remove(spark, f"{root}/{path}")
        return None
    return path


def _write_buckets(entries: DataFrame, path: str, table: str, buckets: int) -> None:
    """One file per shard and bucket. A row key is of one bucket, so a reference with many rows fills them all."""
    quiet = {"mapreduce.fileoutputcommitter.marksuccessfuljobs": "false"}
    entries.repartition(buckets, *ROW_KEY).write.options(**quiet).option("path", path).format("parquet").partitionBy("shard").bucketBy(
        buckets, *ROW_KEY).sortBy(*ROW_KEY).saveAsTable(table)


def load_cursors(spark: SparkSession, root: str) -> tuple[int, DataFrame]:
    """Number of the latest commit and ``bucket, last_key`` rows; 0 and no rows before the first."""
    state = CommitLog(spark, root).latest()
    return state["number"], spark.createDataFrame(sorted(state["cursors"].items()), CURSORS)


def save_cursors(cursors: DataFrame, root: str) -> int:
    """Commit one cursor per bucket in place of those the log has; the number of the commit."""
    log = CommitLog(cursors.sparkSession, root)
    rows = {r.bucket: r.last_key for r in cursors.select("bucket", "last_key").collect()}
    return log.commit("cursors", log.open("cursors"), lambda state: {**state, "cursors": rows})["number"]
