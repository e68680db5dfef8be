import os
import time
from pathlib import Path

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from streambed.plans.ingest import IngestConf
from streambed.sources import messages
from streambed.sources.segments import read_segment_lines
from streambed.streaming.dedup import dedup_stream, drained, opened, state_ids
from streambed.streaming.jobs import run_ingest

BATCHES = [
    [("a", 0), ("a", 60), ("b", 120)],
    [("a", 240), ("z", 1200)],
    [("a", 1260), ("late", 60)],
    [("b", 1320), ("late2", 120)],
]


def feed(spark, folder, mode, batches, per_trigger=1):
    source = folder / "in"
    source.mkdir()
    arrival = 0
    for at, rows in enumerate(batches):
        numbered = []
        for name, ts in rows:
            numbered.append((name, ts, arrival))
            arrival += 1
        pd.DataFrame(numbered, columns=["id", "ts", "arrival"]).to_parquet(source / f"{at}.parquet")
        os.utime(source / f"{at}.parquet", (1_700_000_000 + at, 1_700_000_000 + at))
    stream = (
        spark.readStream.schema("id string, ts long, arrival long")
        .option("maxFilesPerTrigger", str(per_trigger))
        .parquet(str(source))
    )
    kept = dedup_stream(stream, ["id"], "ts", 300, mode)
    with drained(spark):
        kept.writeStream.format("parquet").option("path", str(folder / "out")).option(
            "checkpointLocation", str(folder / "checkpoint")
        ).trigger(availableNow=True).start().awaitTermination()
    out = spark.read.schema(kept.schema).parquet(str(folder / "out"))
    return [(r.id, r.ts) for r in out.orderBy("arrival").collect()]


WANT = [("a", 0), ("b", 120), ("z", 1200), ("a", 1260), ("late", 60), ("b", 1320), ("late2", 120)]


@pytest.mark.parametrize("per_trigger", [1, 4])
def test_late_rows_are_kept_in_one_or_many_batches(spark, tmp_path, per_trigger):
    assert feed(spark, tmp_path, "keep_late", BATCHES, per_trigger) == WANT


def test_a_step_of_all_ids_is_the_row_by_row_rule():
    rng = np.random.default_rng(6)
    for _ in range(60):
        n = int(rng.integers(0, 60))
        ids, ts, order = rng.integers(0, 7, n).astype(str).astype(object), rng.integers(0, 900, n), rng.permutation(n)
        last = {str(k): int(rng.integers(0, 900)) for k in range(0, 9, 2)}
        keep, found = opened(ids, ts, order, pd.Series(last, dtype=np.int64), 300)
        want, now = set(), dict(last)
        for k in sorted(range(n), key=lambda k: order[k]):
            if ids[k] not in now or ts[k] - now[ids[k]] > 300:
                want.add(k)
                now[ids[k]] = int(ts[k])
        assert set(np.flatnonzero(keep)) == want and dict(found) == {i: now[i] for i in set(ids)}


def test_state_is_narrow_and_readable(spark, tmp_path):
    batches = [[("a", 0), (None, 5), (None, 5)], [("a", 100), ("b", 2000), (None, 5)], [("a", 400)]]
    assert feed(spark, tmp_path, "keep_late", batches) == [("a", 0), (None, 5), (None, 5), ("b", 2000), (None, 5), ("a", 400)]
    state = state_ids(spark, str(tmp_path / "checkpoint"))
    assert {r.id: r.last for r in state.collect()} == {"a": 400, "b": 2000} and state.columns == ["id", "last", "seen"]


def test_old_ids_leave_the_state(spark, tmp_path):
    """With a window of a second the clock passes it between batches; times are long ago."""
    source = tmp_path / "in"
    source.mkdir()
    stream = spark.readStream.schema("id string, ts long, arrival long").option("maxFilesPerTrigger", "1").parquet(str(source))
    kept = dedup_stream(stream, ["id"], "ts", 1, "keep_late", buckets=1)
    for at, name in enumerate(["a", "b"]):
        pd.DataFrame([(name, 10, at)], columns=["id", "ts", "arrival"]).to_parquet(source / f"{at}.parquet")
        with drained(spark):
            kept.writeStream.format("noop").option("checkpointLocation", str(tmp_path / "checkpoint")).trigger(availableNow=True).start().awaitTermination()
        time.sleep(2.1)
    assert [r.id for r in state_ids(spark, str(tmp_path / "checkpoint")).collect()] == ["b"]


def test_event_clock_drops_late_rows(spark, tmp_path):
    got = feed(spark, tmp_path, "event_clock", BATCHES)
    # Which of the copies inside one micro-batch stays is open; that late2 goes is not.
    assert [name for name, _ in got] == ["a", "b", "z", "late", "b"]


def test_arrival_clock_keeps_late_rows(spark, tmp_path):
    got = feed(spark, tmp_path, "arrival_clock", BATCHES)
    assert [name for name, _ in got] == ["a", "b", "z", "late", "late2"]


def test_a_first_batch_is_not_the_whole_topic(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(messages, "MAX_FILES", 2)
    for n in range(5):
        (tmp_path / f"in{n}.txt").write_text(f"m{n}\n")
    stream = messages.read_messages(spark, {"format": "text", "path": f"{tmp_path}/*.txt"}, stream=True)
    query = stream.writeStream.format("noop").option("checkpointLocation", str(tmp_path / "checkpoint")).trigger(availableNow=True).start()
    query.awaitTermination()
    assert [p.numInputRows for p in query.recentProgress if p.numInputRows] == [2, 2, 1]


def test_ingest_restart_repeats_nothing(spark, tmp_path):
    source, root = tmp_path / "in", str(tmp_path / "out")
    source.mkdir()
    text = '{"_event_id":"%s","_event_timestamp":"2024-01-01T00:00:00Z"}\n'
    (source / "1.txt").write_text("".join(text % f"e{n}" for n in range(50)) + text % "e1" + "bad\nbad\n")
    conf = IngestConf(
        root=root, checkpoint=str(tmp_path / "checkpoint"),
        source={"format": "text", "path": str(source)}, max_rows=10,
    )
    run_ingest(spark, conf, once=True).awaitTermination()
    # Lose the record that the batch finished: the job must run it again.
    commit = tmp_path / "checkpoint" / "commits" / "0"
    assert commit.exists()
    lost = tmp_path / "lost"
    commit.replace(lost)
    (commit.parent / ".0.crc").replace(tmp_path / "lost.crc")
    (source / "2.txt").write_text(text % "e50" + text % "e7")
    run_ingest(spark, conf, once=True).awaitTermination()
    assert read_segment_lines(spark, {"b": root}).select("line").distinct().count() == 51
    assert read_segment_lines(spark, {"b": root}).count() == 51
    assert spark.read.parquet(f"{root}/rejects").count() == 2
    assert spark.read.parquet(f"{root}/manifest").agg(F.sum("event_count")).head()[0] == 51


def test_a_batch_of_a_stream_is_written_by_all_its_tasks(spark, tmp_path):
    """Batches keep their number of files, and each is one micro-batch."""
    from streambed.plans import workload

    rows = spark.range(1000).selectExpr("id % 5 n", "id at")
    batches = [rows.where(F.col("n") == n).repartition(3) for n in range(4)]
    kept, checkpoint = workload._in_turn(spark, batches, lambda made: made.withColumn("file", F.col("_metadata.file_path")))
    found = kept.groupBy("n").agg(F.count("*").alias("rows"), F.count_distinct("file").alias("files"))
    assert sorted(map(tuple, found.collect())) == [(n, 200, 3) for n in range(4)]
    assert len(list(Path(checkpoint.removeprefix("file:"), "commits").glob("[0-9]"))) == 4
