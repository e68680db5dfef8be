import pytest
from pyspark.sql import functions as F

from streambed.operators.indexing import advance_cursors, with_byte_ranges
from streambed.plans.index import IndexConf, run_index_cycle
from streambed.plans.ingest import IngestConf, ingest_batch
from streambed.sinks.index import load_cursors, pending_deltas, read_index
from streambed.sources.segments import list_segments, read_segment_lines
from streambed.sources.staged import reload_staged
from streambed.streaming.jobs import run_index

TEXT = '{"a":1}\n\nhéllo\r\nlast\n'


def put(root, key, text):
    path = root / key
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(text.encode())


def test_byte_ranges_slice_back(spark, tmp_path):
    put(tmp_path, "events/1700000000/i1/s 1+.ndjson", TEXT)
    rows = with_byte_ranges(read_segment_lines(spark, {"b": str(tmp_path)})).orderBy("start_byte").collect()
    assert [(r.start_byte, r.end_byte) for r in rows] == [(0, 7), (8, 8), (9, 16), (17, 21)]
    raw = TEXT.encode()
    assert [raw[r.start_byte : r.end_byte].decode() for r in rows] == [r.line for r in rows]
    assert {r.key for r in rows} == {"events/1700000000/i1/s 1+.ndjson"}


def test_large_segment_in_many_splits(spark, tmp_path):
    text = "".join(f"{'é' * (n % 50)}{n}\n" for n in range(20000))
    put(tmp_path, "events/1/i/s.ndjson", text)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "100000")
    try:
        lines = read_segment_lines(spark, {"b": str(tmp_path)})
        rows = with_byte_ranges(lines).collect()
        assert len({r.split_start for r in rows}) > 3
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    raw = text.encode()
    assert len(rows) == 20000
    assert all(raw[r.start_byte : r.end_byte].decode() == r.line for r in rows)


def test_listing_skips_bad_keys_old_keys_and_missing_buckets(spark, tmp_path):
    for key in ("events/2/i/a.ndjson", "events/10/i/b.ndjson", "events/x/i/c.ndjson", "events/3/d"):
        put(tmp_path, key, "x\n")
    buckets = {"b": str(tmp_path), "gone": str(tmp_path / "gone")}
    assert [r.key for r in list_segments(spark, buckets).collect()] == ["events/2/i/a.ndjson", "events/10/i/b.ndjson"]
    assert [r.key for r in list_segments(spark, buckets, {"b": "events/10/i/b.ndjson"}).collect()] == ["events/2/i/a.ndjson"]


@pytest.mark.parametrize(("errors", "want"), [("..x.", "k1"), ("x...", None), ("....", "k3")])
def test_cursor_stops_before_first_failure(spark, errors, want):
    rows = [("b", f"events/{n}/w/k{n}", "e" if e == "x" else None) for n, e in enumerate(errors)]
    found = advance_cursors(spark.createDataFrame(rows, "bucket string, key string, error string")).collect()
    assert [r.last_key[-2:] for r in found] == ([want] if want else [])


def line(event, ref="u", ts=5):
    return f'{{"_event_id":"{event}","reference_id":"{ref}","_event_timestamp":"{ts}"}}\n'


def conf_for(tmp_path, **more):
    return IndexConf(
        root=str(tmp_path / "index"), buckets={"b": str(tmp_path / "b")}, num_shards=4, **more
    )


def entries(spark, conf):
    return sorted((r.row_key, r.locator) for r in read_index(spark, conf.root).collect())


def test_cycles_resume_and_repeat_without_change(spark, tmp_path):
    bucket = tmp_path / "b"
    put(bucket, "events/1/w/s1.ndjson", line("e1") + "junk\n" + line("e2", "v"))
    conf = conf_for(tmp_path, compaction_threshold=2)
    totals = run_index_cycle(spark, conf).head()
    assert (totals.total_indexed, totals.total_segments, totals.total_errors) == (2, 1, 0)
    assert load_cursors(spark, conf.root)[1].head().last_key == "events/1/w/s1.ndjson"
    first = entries(spark, conf)
    put(bucket, "events/2/w/s2.ndjson", line("e1") + line("e3", "v"))
    assert run_index_cycle(spark, conf).head().total_indexed == 2
    found = entries(spark, conf)
    assert [k for k, _ in found] == ["ref:u:time:5:txn:e1", "ref:v:time:5:txn:e2", "ref:v:time:5:txn:e3"]
    assert found[0][1].startswith("b|events/2/w/s2.ndjson|0|")
    assert set(first) - set(found) == {first[0]}
    # Both shards in use reached the threshold and were compacted.
    assert pending_deltas(spark, conf.root).count() == 0
    assert run_index_cycle(spark, conf).head().total_segments == 0
    assert entries(spark, conf) == found


def test_a_line_too_long_fails_its_segment_only(spark, tmp_path):
    bucket = tmp_path / "b"
    put(bucket, "events/1/w/s1.ndjson", line("e1"))
    put(bucket, "events/2/w/s2.ndjson", line("e2") + "x" * 500 + "\n")
    put(bucket, "events/3/w/s3.ndjson", line("e3"))
    conf = conf_for(tmp_path, max_line_bytes=200)
    totals = run_index_cycle(spark, conf).head()
    assert (totals.total_indexed, totals.total_segments, totals.total_errors) == (2, 2, 1)
    assert load_cursors(spark, conf.root)[1].head().last_key == "events/1/w/s1.ndjson"


def test_a_long_line_is_indexed_with_its_neighbours(spark, tmp_path):
    put(tmp_path / "b", "events/1/w/s.ndjson", line("e1") + line("x" * (5 << 20)) + line("e2"))
    conf = conf_for(tmp_path)
    totals = run_index_cycle(spark, conf).head()
    assert (totals.total_indexed, totals.total_errors) == (3, 0)
    before = sorted(p.name for p in (tmp_path / "index").rglob("*") if p.is_dir()) if (tmp_path / "index").exists() else []
    assert run_index_cycle(spark, conf).head().total_segments == 0
    after = sorted(p.name for p in (tmp_path / "index").rglob("*") if p.is_dir()) if (tmp_path / "index").exists() else []
    assert before == after  # an idle cycle writes nothing


def test_merged_deltas_are_pruned_while_listing(spark, tmp_path):
    put(tmp_path / "b", "events/1/w/s.ndjson", line("e1"))
    conf = conf_for(tmp_path, compaction_threshold=1)
    run_index_cycle(spark, conf)
    files = read_index(spark, conf.root).inputFiles()
    assert files and all("/baseline/" in f for f in files)
    assert any((tmp_path / "index" / "delta").rglob("*.parquet"))  # still there for readers of the state before


def test_stream_jobs_need_a_checkpoint(spark, tmp_path):
    put(tmp_path / "b", "events/1/w/s.ndjson", line("e1"))
    with pytest.raises(ValueError, match="checkpoint"):
        run_index(spark, conf_for(tmp_path, checkpoint=None), once=True)


def test_old_files_are_streamed(spark, tmp_path):
    import os
    put(tmp_path / "b", "events/9/w/new.ndjson", line("e1"))
    put(tmp_path / "b", "events/1/w/old.ndjson", line("e2"))
    old = tmp_path / "b" / "events/1/w/old.ndjson"
    os.utime(old, (old.stat().st_mtime - 30 * 86_400,) * 2)
    conf = conf_for(tmp_path, checkpoint=str(tmp_path / "checkpoint"), max_files_per_trigger=1)
    run_index(spark, conf, once=True).awaitTermination()
    assert len(entries(spark, conf)) == 2


def test_two_writers_and_a_wide_payload(spark, tmp_path):
    rows = [(f'{{"_event_id":"e{n}","_event_timestamp":"2024-01-01T00:00:00Z","_category":"{"c" * (5000 if n == 7 else 5)}"}}', "t", 0, n, n) for n in range(100)]
    rows += [("bad", "t", 0, 100 + n, 100 + n) for n in range(3)]
    messages = spark.createDataFrame(rows, "value string, topic string, partition int, offset long, arrival long").coalesce(1)
    for name in ("w0", "w1"):
        ingest_batch(messages, IngestConf(root=str(tmp_path / "out"), instance=name, max_rows=50, max_bytes=4000))
    manifest = spark.read.parquet(f"{tmp_path}/out/manifest")
    assert manifest.agg(F.sum("event_count")).head()[0] == 200 and manifest.select("instance").distinct().count() == 2
    assert spark.read.parquet(f"{tmp_path}/out/rejects").count() == 6
    sizes = sorted(r.event_count for r in manifest.where("instance = 'w0'").collect())
    assert sizes[0] == 1 and sizes[-1] > 20  # the wide line stands alone, the others are cut by their own bytes
    before = {p for p in (tmp_path / "out" / "events").rglob("part-*")}
    ingest_batch(messages, IngestConf(root=str(tmp_path / "out"), instance="w1", max_rows=50, max_bytes=4000))
    assert before == {p for p in (tmp_path / "out" / "events").rglob("part-*")}  # a committed batch is not written again


def test_stream_picks_up_new_and_late_segments(spark, tmp_path):
    bucket = tmp_path / "b"
    conf = conf_for(tmp_path, checkpoint=str(tmp_path / "checkpoint"))
    put(bucket, "events/5/w/s.ndjson", line("e1"))
    run_index(spark, conf, once=True).awaitTermination()
    put(bucket, "events/2/w/s.ndjson", line("e2"))
    run_index(spark, conf, once=True).awaitTermination()
    run_index(spark, conf, once=True).awaitTermination()
    assert len(entries(spark, conf)) == 2


def test_segments_keep_their_limits(spark, tmp_path):
    rows = [
        (f'{{"_event_id":"e{n}",\n"_event_timestamp":"2024-01-01T00:00:00Z","_category":"{"c" * (n % 90)}"}}', "t", 0, n, n)
        for n in range(300)
    ]
    messages = spark.createDataFrame(rows, "value string, topic string, partition int, offset long, arrival long")
    conf = IngestConf(root=str(tmp_path / "out"), max_rows=20, max_bytes=2000)
    assert ingest_batch(messages, conf) == {"flushed": 300, "rejected": 0}
    ingest_batch(messages, conf)  # the same batch again replaces itself
    manifest = spark.read.parquet(f"{conf.root}/manifest").agg(
        F.sum("event_count"), F.max("event_count"), F.max("size_bytes"), F.sum("size_bytes")
    ).head()
    assert manifest[0] == 300 and manifest[1] <= 20 and manifest[2] <= 2000
    segments = list_segments(spark, {"b": conf.root})
    assert segments.agg(F.sum("size")).head()[0] == manifest[3]
    assert read_segment_lines(spark, {"b": conf.root}).count() == 300


def test_staged_files_are_whole_or_left_out(spark, tmp_path):
    good = '[{"event_id":"e%d","reference_id":"r","timestamp":1,"category":"c","event_type":"t","payload":"e30="}]'
    (tmp_path / "wal-2.json").write_text(good % 2)
    (tmp_path / "wal-10.json").write_text(good % 10)
    (tmp_path / "wal-3.json").write_text(good[:-5] % 3)
    (tmp_path / "wal-4.json").write_text((good % 4).replace('"timestamp":1', '"timestamp":"x"'))
    (tmp_path / "wal-5.json").write_text((good % 5).replace("e30=", "%%"))
    rows = reload_staged(spark, str(tmp_path / "wal-*.json")).orderBy("staged_no").collect()
    assert [(r.event_id, r.payload, r.staged_no) for r in rows] == [("e2", "{}", 2), ("e10", "{}", 10)]
