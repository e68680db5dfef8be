"""The ingest jobs record what they do: counts, failures, times; the monitoring queries read that."""

import json

import pytest
from pyspark.sql import functions as F

from streambed.plans import monitor
from streambed.plans.ingest import IngestConf, ingest_batch
from streambed.sinks import metrics
from streambed.sinks.segments import write_segments
from streambed.sources.messages import MOST_PARTITIONS, with_arrival
from streambed.streaming.jobs import drain_ingest


def text(event, second=0):
    return json.dumps({"_event_id": event, "_event_timestamp": f"2024-01-01T00:{second // 60:02}:{second % 60:02}Z", "_category": "c"})


def totals(spark, root):
    return monitor.recorded_counters(metrics.counter_samples(spark, root)).head().asDict()


def test_ingest_batch_counts_and_records_what_it_drops(spark, tmp_path):
    rows = [text("a"), text("a", 10), text("b"), text("a", 301), text("b", 300), "{", "{"]
    rows = [(value, "t", 0, n, n) for n, value in enumerate(rows)]
    messages = spark.createDataFrame(rows, "value string, topic string, partition int, offset long, arrival long")
    conf = IngestConf(root=str(tmp_path / "out"))
    for _ in range(2):  # a repeated batch is counted alike, and recorded once
        assert ingest_batch(messages, conf) == {"flushed": 3, "rejected": 2, "duplicates": 2}
    assert spark.read.parquet(f"{conf.root}/manifest").agg(F.sum("event_count")).head()[0] == 3
    files = spark.read.parquet(f"{conf.root}/manifest").count()
    assert totals(spark, conf.root) == {"consumed": 3, "duplicates": 2, "rejected": 2, "flushed": 3, "uploads": files, "failed_flushes": 0}
    stored = spark.read.option("recursiveFileLookup", "true").text(f"{conf.root}/events")
    assert sorted(r.value for r in stored.collect()) == sorted([rows[0][0], rows[2][0], rows[3][0]])
    assert [tuple(r) for r in spark.read.parquet(f"{conf.root}/rejects").select("value", "reason").collect()] == [("{", "invalid JSON")] * 2


def test_a_failed_flush_is_recorded_and_done_again(spark, tmp_path):
    source, seen = tmp_path / "in", []
    source.mkdir()
    (source / "1.txt").write_text("".join(text(f"e{n}") + "\n" for n in range(20)) + text("e1") + "\nbad\n")

    def flaky(events, *where):
        seen.append(where[0])
        if len(seen) in (1, 2, 4):
            raise OSError("no answer")
        return write_segments(events, *where)

    conf = IngestConf(
        root=str(tmp_path / "out"), source={"format": "text", "path": str(source)}, checkpoint=str(tmp_path / "checkpoint"), writer=flaky, write_tasks=1)
    drain_ingest(spark, conf)
    (source / "2.txt").write_text("".join(text(f"f{n}") + "\n" for n in range(5)) + text("e2") + "\n" + text("f1") + "\n")
    drain_ingest(spark, conf)
    assert seen == [0, 0, 0, 1, 1]
    assert totals(spark, conf.root) == {"consumed": 25, "duplicates": 3, "rejected": 1, "flushed": 25, "uploads": 2, "failed_flushes": 3}
    stages = {r.stage: r["count"] for r in metrics.stage_timings(spark, conf.root).groupBy("stage").count().collect()}
    assert stages == dict.fromkeys(metrics.STAGES.values(), 2)
    seen[:] = [0]
    conf.writer = lambda *_: (_ for _ in ()).throw(OSError("never"))
    (source / "3.txt").write_text(text("g") + "\n")
    with pytest.raises(Exception, match="never"):
        drain_ingest(spark, conf, attempts=2)
    assert totals(spark, conf.root)["failed_flushes"] == 5


def test_counters_run_on_over_days_and_none_recorded(spark, tmp_path):
    root = str(tmp_path)
    assert metrics.counter_samples(spark, root).count() == 0
    for n in range(4):
        metrics.record(spark, root, "w0", n, "flush", {metrics.FLUSHED: 5}, at=86_400.0 * n + 1)
    values = [r.value for r in metrics.counter_samples(spark, root).orderBy("ts").collect()]
    assert values == [5, 10, 15, 20]


def test_arrival_numbers_are_of_their_own(spark):
    rows = [(p, o) for p in (0, 8191, 8192, MOST_PARTITIONS - 1) for o in (0, 1, (1 << 43) - 1)]
    numbered = with_arrival(spark.createDataFrame(rows, "partition int, offset long"))
    found = {(r.partition, r.offset): r.arrival for r in numbered.collect()}
    assert len(set(found.values())) == len(rows)
    assert all(found[p, o] < found[q, r] for p, o in rows for q, r in rows if o < r)
    with pytest.raises(Exception, match="too many partitions"):
        with_arrival(spark.createDataFrame([(MOST_PARTITIONS, 1)], "partition int, offset long")).collect()


@pytest.mark.parametrize("block", [60, 100, 86_400])
def test_trailing_rate_across_blocks(spark, block):
    at = [0, 10, 29.5, 30, 59, 60, 89.999999, 90, 150, 400, 401]
    value = [5, 7, 9, 9, 20, 3, 4, 10, 11, 30, 31]
    rows = [(metrics.CONSUMED, "w0", 1000.0 * 90 + t, v) for t, v in zip(at, value, strict=True)]
    samples = spark.createDataFrame(rows, "name string, instance string, s double, value long").selectExpr(
        "name", "instance", "timestamp_micros(cast(round(s * 1000000) as bigint)) as ts", "value")
    got = {r["at"] - 90_000: r.per_second for r in monitor.trailing_rate(samples, metrics.CONSUMED, block_s=block).collect()}
    ups = [(t, 0 if k == 0 else v - value[k - 1] if v >= value[k - 1] else v) for k, (t, v) in enumerate(zip(at, value, strict=True))]
    want = {}
    for step in range(0, 600, 30):
        inside = [u for t, u in ups if step - 60 < t <= step]
        if inside:
            want[step] = sum(inside) / 60
    assert got == want


def test_sketches_are_near_and_bounded(spark):
    from streambed.operators.quantiles import rank_error, sketched_quantiles
    rows = spark.range(200_000).selectExpr("id % 7 as step", "cast(id * 7919 % 200000 as double) as v")
    made = sketched_quantiles(rows, ["step"], "v", (0.0, 0.5, 0.99, 1.0), ["all"], {"all": F.lit(1)}).collect()
    assert all(r.n == 200_000 and abs(r["quantile"] / 200_000 - r.prob) <= rank_error() for r in made) and len(made) == 4
    assert sketched_quantiles(rows.limit(0), ["step"], "v", (0.5,), ["step"]).count() == 0


def test_a_flush_that_is_one_segment_is_written_by_all_its_tasks(spark, tmp_path):
    """One upload of several files; with a limit passed, one task cuts as before."""
    from streambed.plans.ingest import flush_batch
    from streambed.sinks import segments

    rows = spark.range(400).repartition(4).selectExpr(
        "id arrival", "concat('e', id) event_id", "'r' reference_id", "1L timestamp", "'' category", "'' event_type",
        "rpad(concat(id, ''), 99, 'x') payload", "if(id % 40 = 0, 'bad', null) reason")
    for at, (file_bytes, max_rows, files, uploads) in enumerate([(13_000, 390, 3, 1), (1 << 20, 390, 1, 1), (13_000, 389, 2, 2)]):
        root, found = str(tmp_path / str(at)), []

        def writer(events, *where):
            found.append(events.rdd.getNumPartitions())
            return write_segments(events, *where)

        conf = IngestConf(root=root, max_rows=max_rows, write_tasks=1, writer=writer)
        with pytest.MonkeyPatch.context() as patch:
            patch.setattr(segments.label_whole, "__defaults__", (file_bytes,))
            flush_batch(rows, conf, 0)
        manifest = spark.read.parquet(f"{root}/manifest")
        counted = manifest.agg(F.sum("event_count").alias("n"), F.count("*").alias("files"), F.count_distinct("segment_id").alias("segments")).head()
        assert tuple(counted) == (390, files, uploads) and found == [files if uploads == 1 else 1]
        assert totals(spark, root)["uploads"] == uploads
        stored = spark.read.option("recursiveFileLookup", "true").text(f"{root}/events")
        assert stored.distinct().count() == stored.count() == 390


def test_a_batch_of_the_recorded_job_is_sent_by_all_tasks(spark, tmp_path, monkeypatch):
    """Four batches of one upload each, whatever the number of files that they came in."""
    from streambed.plans import workload

    spark.range(1, 2001, 1, 3).selectExpr(
        "id event_id", "timestamp_seconds(1704067200 + id) ts", "id % 7 user_id", "'click' event_type", "1.0D value", "'{}' props"
    ).write.parquet(str(tmp_path / "events.parquet"))
    monkeypatch.setattr(workload, "shared_dir", lambda _, purpose: str(tmp_path / purpose))
    root = workload._recorded_ingest(spark, str(tmp_path))
    assert all(len(list((tmp_path / "messages" / f"quarter={n}").glob("part-*"))) > 1 for n in range(4))
    good = [n for n in range(1, 2001) if n % 50 not in (0, 1, 2, 3, 5, 6)]
    again, lost = len([n for n in good if n % 10 == 0]), len([n for n in range(1, 2001) if n not in good])
    assert totals(spark, root) == {
        "consumed": len(good), "duplicates": again, "flushed": len(good), "uploads": 4, "failed_flushes": 2,
        "rejected": lost + len([n for n in range(10, 2001, 10) if n not in good])}


def test_the_parts_of_a_report_decode_the_messages_once(spark, tmp_path, monkeypatch):
    """Rate and live ids read a written table of ids and times, not the messages again."""
    from streambed.plans import workload

    spark.range(1, 101, 1, 3).selectExpr(
        "id event_id", "timestamp_seconds(1704067200 + id div 3) ts", "id % 7 user_id", "'click' event_type", "1.0D value", "'{}' props"
    ).write.parquet(str(tmp_path / "events.parquet"))
    monkeypatch.setattr(workload, "shared_dir", lambda _, purpose: str(tmp_path / purpose))
    events, _, rate = workload._report_parts(spark, str(tmp_path))
    assert not any("from_json" in x._jdf.queryExecution().optimizedPlan().toString() for x in (events, rate))
    assert events.columns == ["event_id", "timestamp"] and rate.head()[0] == 1  # 99; 100 of the same second is cut off
