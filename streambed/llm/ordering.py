"""Places and running sums in ordered groups of any size.

Rows are dealt by ranges of group and order, so a group may span any number of tasks; each task numbers
its own sorted rows. Only a partition's first group can have begun before it, so one row per
partition carries the numbers along, whatever the number and size of the groups.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from streambed.llm.shared import buckets, materialize


def _numbered(group: str, weight: str | None):
    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        last, run, count, total, rows = None, -1, 0, 0, 0
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            key, at = batch.column(group), np.arange(n)
            fresh = np.ones(n, bool)
            if n > 1:
                fresh[1:] = pc.not_equal(key.slice(1), key.slice(0, n - 1)).to_numpy(zero_copy_only=False)
            fresh[0] = key[0].as_py() != last
            weights = np.ones(n, np.int64) if weight is None else batch.column(weight).to_numpy(zero_copy_only=False).astype(np.int64)
            ahead = np.cumsum(weights) - weights
            begin = np.maximum.accumulate(np.where(fresh, at, -1))
            own = begin >= 0
            place = np.where(own, at - begin, count + at)
            before = np.where(own, ahead - ahead[np.maximum(begin, 0)], total + ahead)
            runs = run + np.cumsum(fresh)
            extra = {
                "row": (np.int64(part) << np.int64(33)) + rows + at, "part": np.full(n, part, np.int32),
                "run": runs.astype(np.int64), "place": place.astype(np.int64), "before": before.astype(np.int64),
            }
            last, run, rows = key[n - 1].as_py(), int(runs[-1]), rows + n
            count, total = int(place[-1]) + 1, int(before[-1] + weights[-1])
            yield pa.RecordBatch.from_arrays([*batch.columns, *map(pa.array, extra.values())], names=[*batch.schema.names, *extra])

    return number


def running(rows: DataFrame, group: str, order: list[str], weight: str | None = None, purpose: str = "ordered") -> DataFrame:
    """Add ``row`` (a number of its own), ``place`` (from 0 in the group) and ``before`` (weights ahead of it).

    ``group`` and ``weight`` (a long) are never null. Rows that tie in ``order`` follow each other in any
    sequence. The result is a written table. The driver sees one row per partition.
    """
    added = [("row", T.LongType()), ("part", T.IntegerType()), ("run", T.LongType()), ("place", T.LongType()), ("before", T.LongType())]
    schema = T.StructType([*rows.schema.fields, *[T.StructField(n, t) for n, t in added]])
    keys = [group, *order]
    dealt = rows.repartitionByRange(buckets(rows.sparkSession), *keys).sortWithinPartitions(*keys)
    local = materialize(dealt.mapInArrow(_numbered(group, weight), schema), purpose)
    amount = F.lit(1) if weight is None else F.col(weight)
    ends = local.groupBy("part").agg(
        F.min_by(group, "run").alias("first"), F.max(F.struct("run", "place", (F.col("before") + amount).alias("sum"), group)).alias("end")).collect()
    carried, held, count, total = [], None, 0, 0
    for row in sorted(ends, key=lambda r: r.part):
        goes_on = row.first == held
        carried.append((row.part, count if goes_on else 0, total if goes_on else 0))
        alone = goes_on and row.end["run"] == 0
        count, total = row.end["place"] + 1 + (count if alone else 0), row.end["sum"] + (total if alone else 0)
        held = row.end[group]
    carry = F.broadcast(rows.sparkSession.createDataFrame(carried, "part int, carried_count long, carried_sum long"))
    first = F.col("run") == 0
    return local.join(carry, "part").select(
        *rows.columns, "row", (F.col("place") + F.when(first, F.col("carried_count")).otherwise(0)).alias("place"),
        (F.col("before") + F.when(first, F.col("carried_sum")).otherwise(0)).alias("before"))
