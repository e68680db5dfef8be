"""Sharding by a k-d tree: split at weighted medians along the widest dimension.

The unit is a group of equal texts, so copies never part. Each tree node knows how many leaves it
still has to give; it is cut along the dimension whose extent, measured against the extent over all
units, is widest, at the weight that its left leaves are due. The cut is exact: a histogram of all
units narrows down to the one value that crosses the due weight, then, where many units share that
value, to the one tie value. A round of the search is one aggregate for all nodes of a level; the
driver sees a bounded number of bins per node. Leaves end at the target bytes.

Sizes therefore differ by about the largest unit on the cuts, whatever the skew of a source or
length. A group of copies larger than a leaf fills a leaf of its own and more; nothing parts it.

Defined cases: null text counts as empty and weighs one; null metadata counts as 0; repeated rows
are members of one unit; an empty table gives no rows; only the named columns are read, so extra
columns do not matter.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from streambed.llm.shared import materialize

#: Histogram bins of a level: what the driver collects in one round, over all its nodes.
LEVEL_BINS = 1 << 14
#: Rows that one task numbers within a shard.
SLOT_ROWS = 50_000
#: Tree nodes up to which their table, one row each, is sent to every task.
BROADCAST_NODES = 100_000
#: Levels after which the narrow table of units is written anew, so that plans stay short.
WRITE_EVERY = 4


def _pick(which: Column, dims: list[str]) -> Column:
    out = F.lit(None).cast("double")
    for k, name in enumerate(dims):
        out = F.when(which == k, F.col(name)).otherwise(out)
    return out


def _small(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """A table with one row per tree node, broadcast up to ``BROADCAST_NODES`` rows of 40 bytes."""
    made = spark.createDataFrame(rows, schema)
    return F.broadcast(made) if len(rows) <= BROADCAST_NODES else made


def _cuts(units: DataFrame, dims: list[str], nodes: dict[int, dict]) -> list[tuple]:
    """For each node the dimension, value and tie value up to which units go left."""
    spark = units.sparkSession
    cuts, open_nodes = [], {n: {**x, "base": 0, "tie": False} for n, x in nodes.items()}
    while open_nodes:
        bins = max(16, LEVEL_BINS // len(open_nodes))
        params = _small(
            spark, [(n, x["dim"], x["tie"], float(x["value"]) if x["tie"] else 0.0, float(x["lo"]), float(x["hi"])) for n, x in open_nodes.items()],
            "node int, cut_dim int, cut_tie boolean, cut_value double, cut_lo double, cut_hi double")
        value = _pick(F.col("cut_dim"), dims)
        at = F.when(F.col("cut_tie"), F.col("unit_tie")).otherwise(value)
        inside = (at >= F.col("cut_lo")) & (at <= F.col("cut_hi")) & (~F.col("cut_tie") | (value == F.col("cut_value")))
        span = F.col("cut_hi") - F.col("cut_lo")
        found = (
            units.join(params, "node").where(inside).withColumn("cut_at", at)
            .withColumn("bin", F.when(span > 0, F.least(F.floor((at - F.col("cut_lo")) / span * bins), F.lit(bins - 1))).otherwise(F.lit(0)).cast("int"))
            .groupBy("node", "bin").agg(F.sum("unit_weight").alias("w"), F.count("*").alias("n"), F.min("cut_at").alias("lo"), F.max("cut_at").alias("hi"))
        ).collect()
        by_node: dict[int, list] = {}
        for row in sorted(found, key=lambda r: (r.node, r.bin)):
            by_node.setdefault(row.node, []).append(row)
        still = {}
        for n, x in open_nodes.items():
            rows = by_node[n]
            below, k = x["base"], 0
            while k < len(rows) - 1 and below + rows[k].w < x["due"]:
                below += rows[k].w
                k += 1
            row = rows[k]
            if row.lo < row.hi:
                still[n] = {**x, "lo": row.lo, "hi": row.hi, "base": below}
            elif not x["tie"] and row.n > 1:
                still[n] = {**x, "tie": True, "value": row.lo, "lo": -(2.0 ** 63), "hi": 2.0 ** 63, "base": below}
            else:
                left = x["due"] - below > row.w / 2  # the unit that crosses goes where it is missed more
                value = x["value"] if x["tie"] else row.lo
                bound = row.lo if x["tie"] else 2.0 ** 63
                cuts.append((n, x["dim"], float(value), float(bound), left, x["step"]))
        open_nodes = still
    return cuts


def kd_shards(units: DataFrame, dims: list[str], target_bytes: int) -> DataFrame:
    """Add ``shard`` to units (columns ``dims`` double, ``unit_weight`` long, ``unit_tie`` double)."""
    total = units.agg(F.sum("unit_weight").alias("w"), *[F.min(d).alias(f"lo_{k}") for k, d in enumerate(dims)], *[F.max(d).alias(f"hi_{k}") for k, d in enumerate(dims)]).first()
    leaves = {0: max(1, math.ceil((total.w or 0) / max(1, target_bytes)))}
    whole = [max(total[f"hi_{k}"] - total[f"lo_{k}"], 1e-300) if total.w else 1.0 for k in range(len(dims))]
    units, level = materialize(units.withColumn("node", F.lit(0)), "kd-units"), 0  # read back, so that joins on node stay joins on a key
    while any(c > 1 for c in leaves.values()):
        extents = units.groupBy("node").agg(F.sum("unit_weight").alias("w"), *[F.min(d).alias(f"lo_{k}") for k, d in enumerate(dims)], *[F.max(d).alias(f"hi_{k}") for k, d in enumerate(dims)]).collect()
        nodes = {}
        for row in extents:
            if (count := leaves.get(row.node, 1)) > 1:
                dim = max(range(len(dims)), key=lambda k: (row[f"hi_{k}"] - row[f"lo_{k}"]) / whole[k])
                nodes[row.node] = {"dim": dim, "lo": row[f"lo_{dim}"], "hi": row[f"hi_{dim}"], "due": row.w * (count // 2) / count, "step": count // 2}
        cuts = _cuts(units, dims, nodes)
        table = _small(units.sparkSession, cuts, "node int, cut_dim int, cut_value double, cut_tie double, cut_left boolean, cut_step int") if cuts else None
        if table is not None:
            value = _pick(F.col("cut_dim"), dims)
            tied = value == F.col("cut_value")
            inclusive = F.col("unit_tie") <= F.col("cut_tie")
            exclusive = (F.col("unit_tie") < F.col("cut_tie")) & (F.col("cut_tie") < 2.0 ** 63)
            goes_left = (value < F.col("cut_value")) | (tied & F.when(F.col("cut_left"), inclusive).otherwise(exclusive))
            keep = [c for c in units.columns if c != "node"]
            units = units.join(table, "node", "left").select(*keep, F.when(F.col("cut_dim").isNull() | goes_left, F.col("node")).otherwise(F.col("node") + F.col("cut_step")).alias("node"))
        grown = {}
        for n, count in leaves.items():
            grown[n] = max(1, count // 2)
            if count > 1:
                grown[n + count // 2] = count - count // 2
        leaves, level = grown, level + 1
        if level % WRITE_EVERY == 0:
            units = materialize(units, "kd-units")
    return units.withColumnRenamed("node", "shard")


def shard_documents(docs: DataFrame, shards: int = 8) -> DataFrame:
    """doc_id, size, text_crc32, shard and slot of every document, by the law of near equal bytes."""
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(
        "doc_id", (F.octet_length(text).cast("long") + 1).alias("size"), F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"),
        F.xxhash64(text).alias("text_key"), F.coalesce(F.crc32(F.encode("source", "UTF-8")), F.lit(0)).cast("double").alias("source_key"))
    units = rows.groupBy("text_key").agg(
        F.sum("size").alias("unit_weight"),
        F.coalesce(F.min("doc_id"), F.lit(0)).cast("double").alias("first_id"),
        F.min("size").cast("double").alias("bytes"), F.min("source_key").alias("source"))
    units = units.withColumn("unit_tie", F.xxhash64("text_key").cast("double"))
    total = rows.agg(F.sum("size").alias("w"), F.count("*").alias("n")).first()
    target = math.ceil((total.w or 0) / shards)
    placed = kd_shards(units, ["first_id", "source", "bytes"], target).select("text_key", "shard")
    return number_slots(rows.join(placed, "text_key").drop("text_key", "source_key"), total.n or 0)


def number_slots(rows: DataFrame, count: int) -> DataFrame:
    """Add ``slot``: numbers from 0 without gaps within a shard, counted in blocks of bounded size."""
    blocks = max(1, math.ceil(count / SLOT_ROWS))
    rows = rows.withColumn("block", F.pmod(F.xxhash64("doc_id", "text_crc32"), F.lit(blocks)).cast("int"))
    held = rows.groupBy("shard", "block").agg(F.count("*").alias("n"))
    before = Window.partitionBy("shard").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = held.select("shard", "block", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("begin"))
    inner = Window.partitionBy("shard", "block").orderBy("doc_id", "text_crc32")
    numbered = rows.withColumn("nth", F.row_number().over(inner) - 1)
    return numbered.join(offsets, ["shard", "block"]).withColumn("slot", F.col("begin") + F.col("nth")).drop("block", "begin", "nth")


def sharding_digest(docs: DataFrame) -> DataFrame:
    """The contract's row per document."""
    return shard_documents(docs).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), F.col("shard").cast("int").alias("shard"),
        F.col("slot").cast("long").alias("slot"), F.lit(None).cast(T.IntegerType()).alias("grown_shard"))
