"""Wu-Manber search against plain search of every window at every place."""

import hashlib
import random
import re

import numpy as np
from pyspark.sql import Row

from streambed.llm import decontaminate as d


def words(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def brute(docs, items):
    out = []
    for doc, text in docs:
        have = words(text)
        hit, found = set(), set()
        for item, passage in items:
            want = words(passage)
            m = min(13, len(want))
            windows = {tuple(want[i:i + m]) for i in range(len(want) - m + 1)} if m else set()
            for i in range(len(have) - m + 1):
                if tuple(have[i:i + m]) in windows:
                    hit.update(range(i, i + m))
                    if item is not None:
                        found.add(str(item))
        out.append((doc, len(have), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), len(hit) > 0 and 20 * len(hit) >= len(have)))
    return sorted(out)


def texts(rng, n):
    return " ".join(rng.choice(["a", "B", "c7", "é", "dog", "Zz"]) + rng.choice([" ", ", ", ".\n", ""]) for _ in range(n))


def fixture():
    rng = random.Random(5)
    items = [(i, texts(rng, rng.choice([0, 1, 3, 12, 13, 14, 40]))) for i in range(30)] + [(3, "one two three"), (40, None)]
    docs = [(i, texts(rng, rng.choice([0, 1, 5, 30, 600]))) for i in range(40)]
    docs += [(100 + i, texts(rng, 30) + " " + (items[i][1] or "") + " x " + texts(rng, 400)) for i in range(30)] + [(7, None), (8, ""), (8, ""), (9, "--- \x00")]
    return docs, items


def test_matches_brute_force_in_one_block_and_many(spark, monkeypatch):
    docs, items = fixture()
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    want = brute(docs, items)
    for size in (16 << 20, 200):
        monkeypatch.setattr(d, "BLOCK_BYTES", size)
        assert sorted(map(tuple, d.decontamination_digest(frame, bench).collect())) == want


def test_keeps_columns_and_handles_empty_tables(spark):
    docs = spark.createDataFrame([Row(doc_id=1, text="p q r", scan_state="s", n_words=4), Row(doc_id=2, text="u", scan_state=None, n_words=5)])
    bench = spark.createDataFrame([(1, "q r")], "item_id long, text string")
    kept = d.drop_contaminated(docs, bench)
    assert kept.columns == docs.columns and [r.doc_id for r in kept.collect()] == [2]
    assert d.drop_contaminated(docs, bench.limit(0)).count() == 2
    assert d.decontamination_digest(docs.limit(0), bench).count() == 0


def test_search_skips():
    rng = np.random.default_rng(1)
    search = d.WuManber(rng.integers(1, 2 ** 60, (50, 13)).astype(np.uint64))
    assert (search.shift == 12).mean() > 0.8


def twisted(n=1024):
    """Two words that every sum of byte values times powers of one number, modulo 2^64, takes for one."""
    first = "".join("ab"[bin(i).count("1") % 2] for i in range(n))
    return first, first.translate(str.maketrans("ab", "ba"))


def test_other_words_are_no_hit(spark, monkeypatch):
    one, other = twisted()
    docs = spark.createDataFrame([(1, one), (2, f"x {other} y"), (3, one[:1000] + "c" * 1_000_000)], "doc_id long, text string")
    bench = spark.createDataFrame([(7, one), (8, "c" * 1_000_000)], "item_id long, text string")
    rows = {r.doc_id: (r.n_hit, r.n_items, r.contaminated) for r in d.decontamination_digest(docs, bench).collect()}
    assert rows == {1: (1, 1, True), 2: (0, 0, False), 3: (0, 0, False)}
    # Values that are equal by chance: the bytes decide, and such windows keep their own items.
    made = d.Words
    monkeypatch.setattr(d, "Words", lambda *a: (w := made(*a), setattr(w, "hashes", w.hashes % np.uint64(2)))[0])
    block = d.Benchmark([("a", "p q"), ("b", "r s"), ("c", "p Q"), ("d", "pq")])
    data = np.frombuffer(b"p q r s pq t p", np.uint8)
    _, hits, items = block.scan(data, np.array([0, len(data)]))
    assert dict(items) == {0: {"a", "b", "c", "d"}} and hits == {0: [0, 5]}
    data = np.frombuffer(b"q p s r t", np.uint8)
    assert block.scan(data, np.array([0, len(data)]))[1:] == ({}, {})
