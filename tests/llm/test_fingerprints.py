"""Fingerprints: edits by brute force, estimates near true similarity, no Python in the plan."""

import hashlib
import random
import re

from pyspark.sql import functions as F

from streambed.llm import fingerprints as f


def shingles(text):
    words = [w for w in re.split("[ \t-\r]+", (text or "").lower()) if w]
    return {tuple(words[i:i + 5]) for i in range(len(words) - 4)} if len(words) >= 5 else ({tuple(words)} if words else {()})


def similarity(a, b):
    a, b = shingles(a), shingles(b)
    return len(a & b) / len(a | b)


def brute(rows):
    rows = sorted(((d, t or "") for d, t, _ in rows), key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    out = []
    for k, (doc, text) in enumerate(rows):
        follow = rows[(k + 1) % len(rows)][1]
        half = len(text) // 2
        edited = text[:len(text) - half] + follow[:half]
        out.append((doc, len(text), hashlib.sha256(edited.encode()).hexdigest(), similarity(text, edited), similarity(text, follow)))
    return out


def fixture():
    rng = random.Random(8)
    word = lambda: "".join(rng.choices("abcdeé👍", k=rng.randint(1, 4)))
    rows = [(i * 3, " ".join(word() for _ in range(rng.choice([0, 1, 4, 5, 40, 400]))), "x") for i in range(150)]
    rows += [(1000 + i, rows[20 + i][1] + " tail of it", "x") for i in range(20)] + [(2000, "same words", "y"), (2001, "same words", "y"), (2001, "same  words\n", "y"), (None, "n", "z"), (None, None, "z"), (2002, " \t ", None)]
    return rows


def test_against_brute_force(spark, monkeypatch):
    monkeypatch.setattr(f, "RANGE_ROWS", 20)
    rows = fixture()
    got = f.fingerprint_edits(spark.createDataFrame(rows, "doc_id long, text string, range string")).collect()
    want = brute(rows)
    key = lambda r: (str(r[0]), r[1], r[2])
    assert sorted(map(key, got)) == sorted(map(key, want))
    truth = {key(r): r[3:] for r in want}
    errors = []
    for r in got:
        edited, follow = truth[key(r)]
        errors += [abs(r.near_edited - edited), abs(r.near_next - follow)]
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 and len(r.fingerprint) == f.BINS * f.BITS // 4
        assert (edited < 1 or r.near_edited == 1) and (follow < 1 or r.near_next == 1)
    assert max(errors) < 0.25 and sum(errors) / len(errors) < 0.03


def test_single_row_and_empty_table(spark):
    one = spark.createDataFrame([(4, "abc")], "doc_id long, text string")
    assert f.fingerprint_edits(one).select("n_chars", "edited_sha256", "near_next").collect()[0] == (3, hashlib.sha256(b"aba").hexdigest(), 1.0)
    assert f.fingerprint_edits(one.limit(0)).count() == 0


def test_plan_has_no_python(spark):
    docs = spark.createDataFrame([(4, "abc")], "doc_id long, text string")
    plan = f.fingerprint_edits(docs)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def test_densification_is_unbiased(spark):
    rng = random.Random(1)
    pairs = []
    for _ in range(200):
        base = [str(rng.random()) for _ in range(24)]
        pairs.append((" ".join(base), " ".join(base[:16] + [str(rng.random()) for _ in range(8)])))
    rows = spark.createDataFrame(pairs, "a string, b string")
    got = rows.select(f.likeness(f.fingerprint(F.col("a")), f.fingerprint(F.col("b"))).alias("x")).collect()
    assert abs(sum(r.x for r in got) / 200 - 12 / 28) < 0.03


def test_packing_is_reversible(spark):
    rows = spark.createDataFrame([("a b c d e f g",), ("",)], "a string").select(f.fingerprint(F.col("a")).alias("x"))
    for r in rows.select("x", f.unpacked(f.packed(F.col("x"))).alias("y")).collect():
        assert r.x == r.y and len(r.x) == f.BINS
