"""One commit log for all writers of an index, listing after the cursor, and segments that cannot be read."""

import json
import os

import pytest

from streambed import storage
from streambed.plans.index import IndexConf, run_index_cycle
from streambed.plans.ingest import IngestConf, ingest_batch
from streambed.sinks import commits
from streambed.sinks.commits import CommitLog, StaleWriter
from streambed.sinks.index import compact, load_cursors, pending_deltas, read_index
from streambed.sources import listing
from streambed.sources.listing import Folder, SegmentListing, listing_options
from streambed.sources.segments import folders_from, list_segments, manifest_listing
from streambed.streaming.jobs import run_index


def put(root, key, text=""):
    path = root / key
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text)
    return path


def line(event, ref="u", ts=5):
    return f'{{"_event_id":"{event}","reference_id":"{ref}","_event_timestamp":"{ts}"}}\n'


def lines(first, last):
    return "".join(line(f"e{n}", f"u{n % 9}") for n in range(first, last))


def conf_for(tmp_path, bucket="b", **more):
    return IndexConf(root=str(tmp_path / "index"), buckets={bucket: str(tmp_path / bucket)}, num_shards=4, **more)


def held(spark, conf):
    return {r.event_id: r.bucket for r in read_index(spark, conf.root).collect()}


def test_a_number_is_taken_once(spark, tmp_path):
    path = f"{tmp_path}/log/00001.json"
    assert storage.create_if_absent(spark, path, "first") and not storage.create_if_absent(spark, path, "second")
    assert storage.read_text(spark, path) == "first"
    assert [n for n, _ in storage.children(spark, f"{tmp_path}/log") if not n.endswith(".crc")] == ["00001.json"]
    assert storage.children(spark, f"{tmp_path}/none") == []


def test_writers_that_meet_lose_nothing(spark, tmp_path, monkeypatch):
    log = CommitLog(spark, str(tmp_path))
    a, b = log.open("a"), log.open("b")
    add = lambda x: lambda s: {**s, "cursors": {**s["cursors"], x: "1"}}
    create, first = storage.create_if_absent, iter([True])

    def once(*args):
        if next(first, False):  # another writer takes the number
            log.commit("b", b, add("of b"))
        return create(*args)

    monkeypatch.setattr(storage, "create_if_absent", once)
    state = log.commit("a", a, add("of a"))
    assert state["cursors"] == {"of a": "1", "of b": "1"} and log.latest() == state


def test_a_stale_writer_is_refused(spark, tmp_path):
    log = CommitLog(spark, str(tmp_path))
    old = log.open("job")
    new = log.open("job")
    with pytest.raises(StaleWriter):
        log.commit("job", old, lambda s: s)
    number = log.latest()["number"]
    assert log.commit("job", new, lambda s: s)["number"] == number + 1
    for _ in range(3 * commits.RETIRE_AFTER):
        log.commit("job", new, lambda s: s)
    assert len(log._numbers()) <= commits.RETIRE_AFTER + 2
    # So slow that its number had been used and removed: the commit does not count and leaves nothing.
    state, real = log.latest(), log.latest
    behind = {**state, "number": 1, "tail": []}
    answers = iter([behind])
    log.latest = lambda: next(answers, None) or real()
    with pytest.raises(StaleWriter):
        log.commit("job", new, lambda s: {**s, "cursors": {"b": "lost"}})
    assert real() == state and len(log._numbers()) <= commits.RETIRE_AFTER + 2


def test_batch_then_stream_then_batch_on_one_root(spark, tmp_path):
    put(tmp_path / "b", "events/1/w/s.ndjson", lines(0, 300))
    put(tmp_path / "c", "events/2/w/s.ndjson", lines(200, 500))
    put(tmp_path / "d", "events/3/w/s.ndjson", lines(250, 400))
    batch = conf_for(tmp_path)
    run_index_cycle(spark, batch)
    put(tmp_path / "b", "events/4/w/s.ndjson", lines(500, 860))
    run_index_cycle(spark, batch)
    assert len(held(spark, batch)) == 660
    stream = conf_for(tmp_path, "c", checkpoint=str(tmp_path / "checkpoint"))
    run_index(spark, stream, once=True).awaitTermination()
    run_index(spark, stream, once=True).awaitTermination()
    other = conf_for(tmp_path, "d", checkpoint=str(tmp_path / "other"))
    run_index(spark, other, once=True).awaitTermination()
    found = held(spark, batch)
    assert len(found) == 860 and found["e210"] == "c" and found["e300"] == "d" and found["e0"] == "b"


def test_a_stream_that_lost_its_checkpoint_is_another_stream(spark, tmp_path):
    put(tmp_path / "b", "events/1/w/s.ndjson", lines(0, 10))
    conf = conf_for(tmp_path, checkpoint=str(tmp_path / "one"))
    run_index(spark, conf, once=True).awaitTermination()
    put(tmp_path / "b", "events/2/w/s.ndjson", lines(10, 20))
    conf.checkpoint = str(tmp_path / "two")  # counts from 0 again
    run_index(spark, conf, once=True).awaitTermination()
    state = CommitLog(spark, conf.root).latest()
    assert len(held(spark, conf)) == 20 and sorted(state["streams"].values()) == [0, 0]


def test_merged_files_go_after_a_while(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(commits, "RETIRE_AFTER", 3)
    conf = conf_for(tmp_path, compaction_threshold=2, baseline_buckets=1)
    counts = []
    for n in range(10):
        put(tmp_path / "b", f"events/{100 + n}/w/s.ndjson", lines(n, n + 3))
        run_index_cycle(spark, conf)
        counts.append(sum(len(files) for _, _, files in os.walk(conf.root)))
    assert len(held(spark, conf)) == 12
    assert max(counts[7:]) <= max(counts[:7]) + 2  # no growth once folders begin to go
    named = {d["path"] for d in CommitLog(spark, conf.root).latest()["deltas"]}
    assert named <= {f"delta/{n}" for n, _ in storage.children(spark, f"{conf.root}/delta")}


def test_compaction_keeps_what_comes_meanwhile(spark, tmp_path, monkeypatch):
    from streambed.sinks import index
    conf = conf_for(tmp_path)
    put(tmp_path / "b", "events/1/w/s.ndjson", lines(0, 50))
    run_index_cycle(spark, conf)
    write, shards = index._write_buckets, list(range(4))

    def slow(*args):
        write(*args)
        put(tmp_path / "b", "events/2/w/s.ndjson", lines(50, 90))
        run_index_cycle(spark, conf)

    monkeypatch.setattr(index, "_write_buckets", slow)
    assert compact(spark, conf.root, shards)
    assert len(held(spark, conf)) == 90 and pending_deltas(spark, conf.root).count() > 0

    def overtaken(*args):
        monkeypatch.setattr(index, "_write_buckets", write)
        write(*args)
        assert compact(spark, conf.root, shards)

    monkeypatch.setattr(index, "_write_buckets", overtaken)
    assert compact(spark, conf.root, shards) is None
    assert len(held(spark, conf)) == 90


def exchanged(plan):
    """Files below an exchange: which tables a physical plan shuffles."""
    found, depth = set(), None
    for text in plan.splitlines():
        at = len(text) - len(text.lstrip(" :+-*(0123456789)"))
        if depth is not None and at <= depth:
            depth = None
        if depth is None and "Exchange" in text and "Broadcast" not in text:
            depth = at
        elif depth is not None and "Location" in text:
            found.add("baseline" if "baseline" in text else "delta")
    return found


def test_reading_and_compacting_shuffle_the_deltas_only(spark, tmp_path, monkeypatch):
    from streambed.sinks import index
    conf = conf_for(tmp_path, baseline_buckets=3)
    put(tmp_path / "b", "events/1/w/s.ndjson", lines(0, 200))
    run_index_cycle(spark, conf)
    assert compact(spark, conf.root, range(4), 3)
    put(tmp_path / "b", "events/2/w/s.ndjson", lines(150, 260))
    run_index_cycle(spark, conf)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    plans, write = [], index._write_buckets
    monkeypatch.setattr(index, "_write_buckets", lambda rows, *more: (plans.append(rows), write(rows, *more)))
    try:
        plan = read_index(spark, conf.root)._jdf.queryExecution().executedPlan().toString()
        assert "Bucketed: true" in plan and exchanged(plan) == {"delta"}
        assert compact(spark, conf.root, [0, 1], 3)
        assert exchanged(plans[0]._jdf.queryExecution().executedPlan().toString()) == {"delta"}
        files = [f for _, _, names in os.walk(f"{conf.root}/baseline") for f in names if f.endswith(".parquet")]
        assert len(files) <= 2 * 4 * 3
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    found = read_index(spark, conf.root).collect()
    assert len(found) == 260 and {r.key for r in found if int(r.event_id[1:]) >= 150} == {"events/2/w/s.ndjson"}


def test_the_second_cycle_lists_the_new_folders_only(spark, tmp_path, monkeypatch):
    for n in range(20):
        put(tmp_path / "b", f"events/{100 + n}/w/s.ndjson", line(f"e{n}"))
    roots = {"b": str(tmp_path / "b")}
    opened = []
    keys = listing._Lister.keys
    monkeypatch.setattr(listing._Lister, "keys", lambda self, part: (opened.append(part.name), keys(self, part))[1])

    def cycle(after):
        source = listing._BatchReader(listing_options(roots, after))
        return [k for part in source.partitions() for _, k, _ in source.read(part)]

    assert len(cycle({})) == 20 and len(opened) == 20
    opened.clear()
    put(tmp_path / "b", "events/119/w/t.ndjson", line("e99"))
    put(tmp_path / "b", "events/120/w/s.ndjson", line("e98"))
    put(tmp_path / "b", "events/103/w/late.ndjson", line("e97"))
    assert cycle({"b": "events/119/w/s.ndjson"}) == ["events/119/w/t.ndjson", "events/120/w/s.ndjson"]
    assert opened == ["119", "120"]
    assert [f.rsplit("/", 1)[1] for f in folders_from(spark, roots["b"], first_key="events/119/w/s.ndjson")] == ["119", "120"]
    opened.clear()
    stream = listing._StreamReader(listing_options(roots))
    first = stream.latestOffset()
    assert first == {"b": "events/120/w/s.ndjson"} and opened == ["120"]
    put(tmp_path / "b", "events/121/w/s.ndjson", line("e1"))
    put(tmp_path / "b", "events/122/w/_hidden", "x")
    stream.commit(first)
    opened.clear()
    second = stream.latestOffset()
    assert second == {"b": "events/121/w/s.ndjson"} and opened == ["122", "121"]
    assert [(p.name, p.low, p.high) for p in stream.partitions(first, second)] == [("120", first["b"], second["b"]), ("121", first["b"], second["b"])]
    assert stream.partitions(second, second) == []


def test_the_listing_source_in_spark(spark, tmp_path):
    spark.dataSource.register(SegmentListing)
    put(tmp_path / "b", "events/1/w/s 1+.ndjson", "abc")
    put(tmp_path / "b", "events/2/w/empty.ndjson")
    put(tmp_path / "b", "events/x/w/odd.ndjson", "z")
    roots = {"b": f"file://{tmp_path}/b", "gone": str(tmp_path / "gone")}
    found = spark.read.format("segment_listing").options(**listing_options(roots)).load()
    assert sorted(map(tuple, found.collect())) == [("b", "events/1/w/s 1+.ndjson", 3), ("b", "events/2/w/empty.ndjson", 0), ("b", "events/x/w/odd.ndjson", 1)]
    assert [r.key for r in list_segments(spark, roots).collect()] == ["events/1/w/s 1+.ndjson", "events/2/w/empty.ndjson"]
    assert list_segments(spark, {}).count() == 0


def test_start_after_stream(spark, tmp_path):
    bucket = tmp_path / "b"
    conf = conf_for(tmp_path, checkpoint=str(tmp_path / "checkpoint"), listing="start_after")
    put(bucket, "events/5/w/s.ndjson", line("e1") + line("e2"))
    run_index(spark, conf, once=True).awaitTermination()
    assert set(held(spark, conf)) == {"e1", "e2"}
    put(bucket, "events/2/w/late.ndjson", line("e3"))  # below the offset: never read
    put(bucket, "events/6/w/s.ndjson", line("e4"))
    run_index(spark, conf, once=True).awaitTermination()
    run_index(spark, conf, once=True).awaitTermination()
    assert set(held(spark, conf)) == {"e1", "e2", "e4"}
    assert list(CommitLog(spark, conf.root).latest()["streams"].values()) == [1]


def test_one_bad_segment_does_not_stop_the_others(spark, tmp_path):
    bucket = tmp_path / "b"
    put(bucket, "events/1/w/a.ndjson", line("e1"))
    put(bucket, "events/2/w/empty.ndjson")
    put(bucket, "events/3/w/no-newline.ndjson", line("e2") + line("e3").rstrip())
    put(bucket, "events/4/w/broken.ndjson.gz", "this is no archive")
    put(bucket, "events/5/w/b.ndjson", line("e4"))
    put(bucket, "events/6/w/gone.ndjson", line("e5"))
    conf = conf_for(tmp_path)
    seen = spark.createDataFrame(list_segments(spark, conf.buckets).collect())
    (bucket / "events/6/w/gone.ndjson").unlink()
    totals = run_index_cycle(spark, conf, seen).head()
    assert (totals.total_indexed, totals.total_segments, totals.total_errors) == (4, 4, 2)
    assert set(held(spark, conf)) == {"e1", "e2", "e3", "e4"}
    assert load_cursors(spark, conf.root)[1].head().last_key == "events/3/w/no-newline.ndjson"
    results = spark.read.parquet(f"{conf.root}/{CommitLog(spark, conf.root).latest()['results']}")
    errors = {r.key.split("/")[3]: r.error for r in results.where("error IS NOT NULL").collect()}
    assert errors == {"broken.ndjson.gz": "unreadable: 0 of 18 bytes read", "gone.ndjson": f"unreadable: 0 of {len(line('e5'))} bytes read"}
    conf.skip_failed = True
    run_index_cycle(spark, conf)
    assert load_cursors(spark, conf.root)[1].head().last_key == "events/5/w/b.ndjson"


def test_a_segment_that_comes_between_waits(spark, tmp_path):
    bucket = tmp_path / "b"
    for n in (1, 2, 4):
        put(bucket, f"events/{n}/w/s.ndjson", line(f"e{n}"))
    conf = conf_for(tmp_path)
    seen = spark.createDataFrame(list_segments(spark, conf.buckets).where("key <> 'events/2/w/s.ndjson'").collect())
    totals = run_index_cycle(spark, conf, seen).head()
    assert (totals.total_indexed, totals.total_segments, totals.total_errors) == (2, 2, 0)
    assert set(held(spark, conf)) == {"e1", "e4"}


def test_the_manifest_names_files(spark, tmp_path):
    rows = [(json.dumps({"_event_id": f"e{n}", "_event_timestamp": "2024-01-01T00:00:00Z", "_data": {"hashUID": "u"}}), "t", 0, n, n) for n in range(100)]
    messages = spark.createDataFrame(rows, "value string, topic string, partition int, offset long, arrival long")
    root = str(tmp_path / "out")
    for batch in (0, 1):  # both may flush in the same second
        ingest_batch(messages, IngestConf(root=root, max_rows=30, dedup_window_s=None), batch)
    manifest = {(r.key, r.segment, r.size) for r in manifest_listing(spark, {"b": root}).collect()}
    listed = {(r.key, r.segment, r.size) for r in list_segments(spark, {"b": root}).collect()}
    assert manifest == listed and len(listed) >= 8 and len({s for _, s, _ in listed}) == len(listed)
    conf = IndexConf(root=str(tmp_path / "index"), buckets={"b": root}, num_shards=4, listing="manifest")
    assert run_index_cycle(spark, conf).head().total_indexed == 200
    assert run_index_cycle(spark, conf).head().total_segments == 0
    assert Folder("b", root, "1", "", None).value is None
