"""Repeated passages against every string of every document."""

import hashlib
import random

import numpy as np
import pytest

from streambed.llm import suffix_dedup as s


def brute(rows, length):
    rows = sorted(((d, (t or "").encode()) for d, t, *_ in rows), key=lambda r: (r[0] is not None, r[0] or 0))
    seen, out = {}, []
    for doc, data in rows:
        gone = np.zeros(len(data), bool)
        for i in range(len(data) - length + 1):
            string = data[i:i + length]
            if string in seen and seen[string] != (doc, i):
                gone[i:i + length] = True
            seen.setdefault(string, (doc, i))
        spans = int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())
        kept = np.frombuffer(data, np.uint8)[~gone].tobytes()
        out.append((doc, len(data), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def fixture(length):
    rng = random.Random(length)
    text = lambda n: "".join(rng.choices("abé \n", k=n))
    shared = [text(length), text(length + 30), text(3 * length), "line " * length, "ab" * length]
    rows = []
    for i in range(120):
        parts = [text(rng.choice([0, 5, length, 4 * length])) if rng.random() < 0.6 else rng.choice(shared)[rng.choice([0, 0, 3]):] for _ in range(rng.randint(0, 5))]
        rows.append((i, "".join(parts), f"s{i}"))
    rows += [(200 + i, rows[7 + i % 3][1], "copy") for i in range(12)] + [(300, None, None), (301, "", None), (None, shared[2], "n")]
    rows += [(302, shared[2] * 3, "twice"), (302, shared[2] * 3, "twice")]
    return rows


@pytest.mark.parametrize(("length", "hot", "part"), [(100, 4096, 4 << 20), (45, 2, 4 << 20), (45, 4096, 150), (30, 1, 100)])
def test_matches_brute_force(spark, monkeypatch, length, hot, part):
    monkeypatch.setattr(s, "HOT_RUNS", hot)
    monkeypatch.setattr(s, "PART_BYTES", part)
    if part < 1000:
        monkeypatch.setattr("streambed.llm.shared.CHUNK_BYTES", 50)
        monkeypatch.setattr(s, "pieces", lambda d, o: __import__("streambed.llm.shared", fromlist=["pieces"]).pieces(d, o, 50))
        monkeypatch.setattr(s, "PACK_ANCHORS", 40)
        monkeypatch.setattr(s, "SORT_STARTS", 50)
    rows = fixture(length)
    frame = spark.createDataFrame(rows, "doc_id long, text string, marks string").repartition(5)
    got = sorted(map(tuple, s.repeats_digest(frame, length).collect()), key=repr)
    assert got == brute(rows, length)


def test_cleaned_documents_keep_columns(spark):
    passage = " ".join(f"word{i} wörd{i * 7}" for i in range(25)) + " "
    rows = [(1, "first " + passage, 0, "a"), (2, passage + "second", 0, "b"), (3, passage, 0, "c"), (4, None, 0, "d"), (5, "", 0, "e")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_chars long, late string")
    got = {r.doc_id: r for r in s.drop_repeats(docs).collect()}
    assert s.drop_repeats(docs).columns == docs.columns and set(got) == {1, 2, 4, 5}
    assert got[1].text == rows[0][1] and got[2].text.endswith("second") and len(got[2].text) < 120 and got[2].n_chars == len(got[2].text)
    assert s.repeats_digest(docs.limit(0)).count() == 0


def test_previous_smaller():
    rng = np.random.default_rng(3)
    for n in (0, 1, 2, 50, 400):
        rank = rng.integers(0, max(1, n // 2), n)
        want = [max((j for j in range(i) if rank[j] < rank[i]), default=-1) for i in range(n)]
        assert s.previous_smaller(rank).tolist() == want
