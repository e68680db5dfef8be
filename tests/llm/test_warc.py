"""Archives: round trip, revisits, and a globally ordered index."""

import base64
import gzip
import hashlib
import heapq
import random

from streambed.llm import warc

SCHEMA = "page_id long, url string, html string, record_type string"


def brute(rows):
    largest = {}
    for page, _, html, _ in rows:
        if page is not None:
            largest[html or ""] = max(largest.get(html or "", page), page)
    out = []
    for page, _, html, _ in rows:
        data = (html or "").encode()
        refers = largest.get(html or "")
        again = page is not None and page < refers
        out.append((page, len(data), base64.b32encode(hashlib.sha1(data).digest()).decode(), "revisit" if again else "response", refers if again else None))
    return sorted(out, key=repr)


def fixture():
    rng = random.Random(3)
    html = [None, "", "<p>é</p>", "WARC/1.1\r\n\r\nWARC/1.1\r\n", "x\r\n\r\ny", "\r\n\r\n", "same", "\x00\x1f" * 50, "long " * 30000]
    rows = [(i, rng.choice([None, "http://www.B.com/a?x=1", f"https://a.com/{i % 7}#f", "no url", "http://[bad"]), rng.choice(html) if i % 2 else f"own {i}", "c") for i in range(300)]
    return rows + [(299, "u\r\nWARC-Type: x", "dup", "c"), (299, "u", "dup", "c"), (None, "n", "dup", "c")]


def test_round_trip_and_global_order(spark, monkeypatch):
    monkeypatch.setattr(warc, "ARCHIVE_RECORDS", 20)
    monkeypatch.setattr(warc, "RANGE_ENTRIES", 60)
    rows = fixture()
    pages = spark.createDataFrame(rows, SCHEMA)
    assert sorted(map(tuple, warc.warc_digest(pages).collect()), key=repr) == brute(rows)
    got = warc.archive_index(pages).collect()
    keys = [(r.url_key, r.timestamp, r.page_id is not None, r.page_id or 0) for r in got]
    assert keys == sorted(keys) and len({r.archive for r in got}) > 5


def test_empty_table(spark):
    assert warc.warc_digest(spark.createDataFrame([], SCHEMA)).count() == 0


def test_loser_tree_and_gzip_members():
    rng = random.Random(1)
    for k in (0, 1, 2, 3, 7, 16, 33):
        runs = [sorted(rng.randint(0, 50) for _ in range(rng.randint(0, 20))) for _ in range(k)]
        assert list(warc.LoserTree(runs, lambda x: x)) == list(heapq.merge(*runs))
    source = warc._Unzip(gzip.compress(b"ab--") + gzip.compress(b"cd--" * 100_000))
    assert source.until(b"--") == b"ab--" and source.take(4) == b"cd--" and len(source.take(399_996)) == 399_996 and source.until(b"-") is None
