"""Ordered computations over lanes of any size.

A plain window over a lane puts the whole lane into one task. Here the caller also names
a block: an integer that never falls along the lane's order and that bounds how many rows
share it (an offset or a time divided by a constant). Rows meet only inside their block;
across blocks a lane is one row per block. Lane and block columns must not be NULL.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _exclusive(window):
    return window.rowsBetween(Window.unboundedPreceding, -1)


def match(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Join on plain equality by sorted sides, so that windows and aggregates on the keys need no new shuffle.

    Both sides may grow with the input. Spark takes a compressed file's size for that of rows derived from it, which are
    many times larger, and would send them through the driver as a broadcast.
    """
    return left.join(right.hint("merge"), list(keys), how)


def without_nulls(rows: DataFrame, names: Sequence[str]) -> DataFrame:
    """Fail on a NULL in the named columns, which equality would lose without a word."""
    return rows.withColumns(
        {n: F.coalesce(F.col(n), F.raise_error(F.lit(f"{n} must not be NULL"))) for n in names}
    )


def running_totals(
    rows: DataFrame,
    lane: Sequence[str],
    block: str,
    order: Sequence[str],
    totals: Mapping[str, Column],
    grand: Mapping[str, str] | None = None,
) -> DataFrame:
    """Add, per name in ``totals``, the sum over all earlier rows of the lane.

    ``grand`` adds, per ``new name: name in totals``, the sum over the whole lane.
    """
    lane, keys, grand = list(lane), [*lane, block], dict(grand or {})
    valued = without_nulls(rows, keys).select("*", *[v.alias(f"__v_{n}") for n, v in totals.items()])
    sums = valued.groupBy(*keys).agg(*[F.sum(f"__v_{n}").alias(f"__s_{n}") for n in totals])
    along = _exclusive(Window.partitionBy(*lane).orderBy(block))
    offsets = sums.select(
        *keys,
        *[F.coalesce(F.sum(f"__s_{n}").over(along), F.lit(0)).alias(f"__o_{n}") for n in totals],
        *[F.sum(f"__s_{n}").over(Window.partitionBy(*lane)).alias(new) for new, n in grand.items()],
    )
    inside = _exclusive(Window.partitionBy(*keys).orderBy(*order))
    # Sums first: their sort serves the join as well, so a task sorts its rows once.
    summed = valued.select(
        *rows.columns, *[F.coalesce(F.sum(f"__v_{n}").over(inside), F.lit(0)).alias(f"__i_{n}") for n in totals]
    )
    placed = match(summed, offsets, keys)
    return placed.select(
        *rows.columns, *[(F.col(f"__o_{n}") + F.col(f"__i_{n}")).alias(n) for n in totals], *grand
    )


def previous_values(
    rows: DataFrame, lane: Sequence[str], block: str, order: str, values: Mapping[str, str]
) -> DataFrame:
    """Add, per ``new name: column``, that column's value in the lane's previous row."""
    lane, keys = list(lane), [*lane, block]
    rows = without_nulls(rows, keys)
    last = rows.groupBy(*keys).agg(
        *[F.max_by(column, order).alias(f"__l_{name}") for name, column in values.items()]
    )
    along = Window.partitionBy(*lane).orderBy(block)
    carried = last.select(
        *keys, *[F.lag(f"__l_{name}").over(along).alias(f"__c_{name}") for name in values]
    )
    inside = Window.partitionBy(*keys).orderBy(order)
    placed = match(rows, carried, keys).withColumn("__first", F.row_number().over(inside) == 1)
    return placed.select(
        *rows.columns,
        *[
            F.when(F.col("__first"), F.col(f"__c_{name}"))
            .otherwise(F.lag(column).over(inside))
            .alias(name)
            for name, column in values.items()
        ],
    )
