"""Exact and bucketed quantiles that never gather a group in one task."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .blocked import running_totals

PROBABILITIES = (0.5, 0.95, 0.99)


def exact_quantiles(
    rows: DataFrame,
    group: Sequence[str],
    value: str,
    probs: Sequence[float] = PROBABILITIES,
    weight: str | None = None,
    bins_per_unit: int = 1000,
) -> DataFrame:
    """Interpolated quantiles per group as ``group..., prob, quantile``.

    Equal values merge into counts before the shuffle, counts are ranked in value order by
    blocks of ``1 / bins_per_unit``, and only the one or two values around each wanted
    rank are kept. ``weight`` names a column of repeat counts.
    """
    group = list(group)
    times = F.lit(1).cast("long") if weight is None else F.col(weight)
    counts = (
        rows.where(F.col(value).isNotNull())
        .groupBy(*group, value)
        .agg(F.sum(times).alias("__n"))
        .withColumn("__bin", F.floor(F.col(value) * bins_per_unit))
    )
    ranked = running_totals(
        counts, group, "__bin", [value], {"__before": F.col("__n")}, grand={"__rows": "__before"}
    )

    def rank(prob):
        return prob * (F.col("__rows") - 1)

    def holds(position):
        return (F.col("__before") <= position) & (position < F.col("__before") + F.col("__n"))

    wanted = F.filter(
        F.array(*[F.lit(float(p)) for p in probs]),
        lambda prob: holds(F.floor(rank(prob))) | holds(F.ceil(rank(prob))),
    )
    hits = ranked.withColumn("prob", F.explode(wanted)).withColumn("__rank", rank(F.col("prob")))
    edges = hits.groupBy(*group, "prob", "__rank").agg(
        F.min(value).alias("__low"), F.max(value).alias("__high")
    )
    share = F.col("__rank") - F.floor("__rank")
    return edges.select(
        *group, "prob",
        (F.col("__low") + (F.col("__high") - F.col("__low")) * share).alias("quantile"),
    )


def bucket_counts(
    rows: DataFrame, group: Sequence[str], value: str, bounds: Sequence[float]
) -> DataFrame:
    """Cumulative counts ``le, n`` per group; the last bound is infinity."""
    edges = [*sorted(float(b) for b in bounds), float("inf")]
    totals = rows.groupBy(*group).agg(
        *[F.count(F.when(F.col(value) <= F.lit(edge), 1)).alias(f"__b{i}") for i, edge in enumerate(edges)]
    )
    pairs = F.array(
        *[F.struct(F.lit(e).alias("le"), F.col(f"__b{i}").alias("n")) for i, e in enumerate(edges)]
    )
    return totals.select(*group, F.inline(pairs))


def histogram_quantile(
    buckets: DataFrame, group: Sequence[str], probs: Sequence[float] = PROBABILITIES
) -> DataFrame:
    """Quantiles by linear interpolation inside the bucket that holds the rank.

    A rank in the last, open bucket gives the highest finite bound. A group has one row
    per bucket, so ordering its buckets is a small window.
    """
    group = list(group)
    order = Window.partitionBy(*group).orderBy("le")
    shaped = buckets.select(
        *group, "le", "n",
        F.lag("le").over(order).alias("__lower"),
        F.coalesce(F.lag("n").over(order), F.lit(0)).alias("__below"),
        F.max("n").over(Window.partitionBy(*group)).alias("__total"),
    ).where(F.col("__total") > 0)
    ranked = shaped.withColumn(
        "prob", F.explode(F.array(*[F.lit(float(p)) for p in probs]))
    ).withColumn("__rank", F.col("prob") * F.col("__total"))
    # The bucket of a rank is the first whose cumulative count reaches it.
    found = (F.col("n") >= F.col("__rank")) & (
        (F.col("__below") < F.col("__rank")) | F.col("__lower").isNull()
    )
    lower = F.coalesce("__lower", F.lit(0.0))
    inside = F.col("n") - F.col("__below")
    return ranked.where(found).select(
        *group, "prob",
        F.when(F.col("le") == F.lit(float("inf")), F.col("__lower"))
        .when(inside == 0, F.col("le"))
        .otherwise(lower + (F.col("le") - lower) * (F.col("__rank") - F.col("__below")) / inside)
        .alias("quantile"),
    )


#: Size of a sketch: it keeps some k values whatever it was given.
SKETCH_K = 200


def rank_error(k: int = SKETCH_K) -> float:
    """How far the rank of a sketched quantile may be off, as a share of all values.

    Twice the published 99 % error of a sketch of that size (2.296 / k^0.9021), so that it holds for
    all windows of a report together.
    """
    return 2 * 2.296 / k ** 0.9021


def sketched_quantiles(
    rows: DataFrame,
    step: Sequence[str],
    value: str,
    probs: Sequence[float],
    group: Sequence[str],
    spread: Mapping[str, Column] | None = None,
    k: int = SKETCH_K,
) -> DataFrame:
    """Quantiles of a group from sketches of its steps, with the number of values: ``*group, n, prob, quantile``.

    ``spread`` says which groups a step belongs to. Sketches merge in the map tasks and may be stored as they are.
    """
    made = rows.where(F.col(value).isNotNull()).groupBy(*step).agg(F.kll_sketch_agg_double(F.col(value).cast("double"), F.lit(k)).alias("__sketch"))
    for name, column in (spread or {}).items():
        made = made.withColumn(name, column)
    merged = made.groupBy(*group).agg(F.kll_merge_agg_double("__sketch", F.lit(k)).alias("__sketch"))
    found = F.explode(F.array(*[
        F.struct(F.lit(float(p)).alias("prob"), F.kll_sketch_get_quantile_double("__sketch", F.lit(float(p))).alias("quantile")) for p in probs
    ]))
    return merged.select(*group, F.kll_sketch_get_n_double("__sketch").alias("n"), found.alias("__q")).select(
        *group, "n", F.col("__q.prob").alias("prob"), F.col("__q.quantile").alias("quantile"))
