"""Ordered operators against plain loops, with blocks small enough to be crossed."""

import random

import pytest
from pyspark.sql import functions as F

from streambed.operators.blocked import running_totals
from streambed.operators.dedup import dedup_batch, latest_entries
from streambed.operators.packing import pack_segments
from streambed.operators.quantiles import bucket_counts, exact_quantiles, histogram_quantile
from streambed.plans.monitor import counter_increases


def kept(rows, window):
    last, out = {}, set()
    for arrival, (name, ts) in enumerate(rows):
        if name not in last or ts - last[name] > window:
            last[name] = ts
            out.add(arrival)
    return out


def run_dedup(spark, rows, window, block):
    frame = spark.createDataFrame([(a, n, t) for a, (n, t) in enumerate(rows)], "arrival long, id string, ts long")
    return {r.arrival for r in dedup_batch(frame, ["id"], "arrival", "ts", window, block).collect()}


def test_dedup_golden(spark):
    rows = [("a", t) for t in (0, 200, 299, 301, 590, 602)]
    assert run_dedup(spark, rows, 300, 86400) == {0, 3, 5}


@pytest.mark.parametrize(("ids", "spread", "jitter", "block"), [(1, 2000, 300, 100), (3, 20000, 0, 700), (40, 5000, 5000, 900)])
def test_dedup_random(spark, ids, spread, jitter, block):
    rnd = random.Random(ids)
    rows = [
        (f"i{rnd.randrange(ids)}", at * spread // 400 + rnd.randrange(-jitter, jitter + 1)) for at in range(400)
    ]
    assert run_dedup(spark, rows, 300, block) == kept(rows, 300)


def test_a_flood_of_copies_is_one_row(spark):
    rows = [("hot", 10)] * 500 + [("cold", 10), ("hot", 400)]
    assert run_dedup(spark, rows, 300, 50) == {0, 500, 501}


def packed(sizes, max_rows, max_bytes):
    seg, count, total, out = -1, 0, 0, []
    for size in sizes:
        if seg < 0 or count + 1 > max_rows or total + size > max_bytes:
            seg, count, total = seg + 1, 0, 0
        count, total = count + 1, total + size
        out.append(seg)
    return out


def run_pack(spark, sizes, max_rows, max_bytes, block):
    frame = spark.createDataFrame([(0, at, size) for at, size in enumerate(sizes)], "part int, at long, size long")
    found = pack_segments(frame, ["part"], "at", max_rows, max_bytes, "size", block)
    return [r.seg_no for r in found.orderBy("at").collect()]


def test_packing_golden(spark):
    assert run_pack(spark, [4, 4, 4, 1, 1, 1, 1, 9, 2], 3, 10, 2) == [0, 0, 1, 1, 1, 2, 2, 3, 4]


@pytest.mark.parametrize(("max_rows", "max_bytes", "block"), [(3, 12, 4), (20, 60, 7), (100, 400, 50)])
def test_packing_random(spark, max_rows, max_bytes, block):
    sizes = [random.Random(block).randrange(1, 15) for _ in range(300)]
    assert run_pack(spark, sizes, max_rows, max_bytes, block) == packed(sizes, max_rows, max_bytes)


def test_latest_entry_wins(spark):
    rows = [("r", 1, "e", s, w, "s", "b", f"k{s}", 0, "x") for s, w in ((1, "w9"), (3, "w1"), (3, "w2"))]
    schema = (
        "reference_id string, ts long, event_id string, seg_ts long, writer string, segment string, "
        "bucket string, key string, start_byte long, note string"
    )
    (row,) = latest_entries(spark.createDataFrame(rows, schema)).collect()
    assert (row.seg_ts, row.writer) == (3, "w2")


def test_exact_quantiles_interpolate(spark):
    rows = spark.createDataFrame([("a", float(v)) for v in (1, 2, 2, 3, 10)] + [("b", 1.0)], "g string, v double")
    got = {(r.g, r.prob): r.quantile for r in exact_quantiles(rows, ["g"], "v", [0.5, 0.95]).collect()}
    assert got[("a", 0.5)] == 2 and got[("a", 0.95)] == pytest.approx(8.6)
    assert got[("b", 0.95)] == 1


def test_histogram_quantile(spark):
    rows = spark.createDataFrame([(v,) for v in (1.0, 1.5, 3.0, 30.0)], "v double")
    buckets = bucket_counts(rows.withColumn("g", F.lit("x")), ["g"], "v", [1, 2, 4])
    got = {r.prob: r.quantile for r in histogram_quantile(buckets, ["g"], (0.25, 0.5, 0.99)).collect()}
    assert got == {0.25: 1.0, 0.5: 2.0, 0.99: 4.0}


def test_counter_restart(spark):
    rows = [(f"2024-01-0{1 + at // 2} 0{at}:00:00", "i", "c", v) for at, v in enumerate((5, 9, 12, 3, 4))]
    samples = spark.createDataFrame(rows, "ts string, instance string, name string, value long")
    samples = samples.withColumn("ts", F.to_timestamp("ts"))
    grown = [r.increase for r in counter_increases(samples).orderBy("ts").collect()]
    assert grown == [None, 4, 3, 3, 1]


def test_running_totals_send_nothing_through_the_driver(spark, tmp_path):
    """A small file may hold many rows once they are derived from it: no side of the join is a broadcast."""
    spark.range(1000).selectExpr("id % 3 lane", "id at", "id div 100 block").write.parquet(str(tmp_path / "rows"))
    rows = spark.read.parquet(str(tmp_path / "rows"))
    found = running_totals(rows, ["lane"], "block", ["at"], {"before": F.lit(1)})
    assert found.where("before <> at div 3").count() == 0
    assert "Broadcast" not in found._jdf.queryExecution().executedPlan().toString()


def test_running_totals_sort_the_rows_once(spark):
    """The order inside blocks serves the join with the blocks' offsets too."""
    rows = spark.range(1000).selectExpr("id % 3 lane", "id div 100 block", "id at", "id % 5 v")
    placed = running_totals(rows, ["lane"], "block", ["at"], {"before": F.col("v")}, {"all": "before"})
    plan = placed._jdf.queryExecution().executedPlan().toString()
    assert len([x for x in plan.splitlines() if "Sort [" in x and "at#" in x.split("]")[0]]) == 1
    assert len([x for x in plan.splitlines() if "Sort [lane#" in x]) == 3  # rows; offsets along the lane and to be joined
    got = {r["at"]: (r.before, r["all"]) for r in placed.collect()}
    for lane in range(3):
        so_far, whole = 0, sum(n % 5 for n in range(lane, 1000, 3))
        for n in range(lane, 1000, 3):
            assert got[n] == (so_far, whole)
            so_far += n % 5
