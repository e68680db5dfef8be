"""Mixing: water-filled targets, even schedules, and blocks that hold each source's exact share."""

import re
from collections import Counter, defaultdict
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from streambed.llm import mixing

SCHEMA = "doc_id long, text string, source string, size string, slot string"


def table(spark, docs):
    return spark.createDataFrame([(*d, "x", "y") for d in docs], SCHEMA)


def words(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def brute_targets(docs, weights=(5, 2, 1), cap=3):
    sizes = Counter()
    for _, text, source in docs:
        sizes[source] += words(text)
    order = sorted(sizes, key=lambda s: (s is None, [ord(c) for c in s or ""]))
    weight = {s: weights[k % len(weights)] for k, s in enumerate(order)}
    target, open_, left = {}, set(order), Fraction(sum(sizes.values()))
    while open_:
        share = {s: left * weight[s] / sum(weight[x] for x in open_) for s in open_}
        over = [s for s in open_ if share[s] > cap * sizes[s]]
        if not over:
            return {**target, **share}, sizes
        for s in over:
            target[s] = Fraction(cap * sizes[s])
            left -= target[s]
            open_.remove(s)
    return target, sizes


def sample(n=400):
    docs = [(i, "w " * (i * 7 % 90), "hot" if i % 3 == 0 else f"s{i % 11}") for i in range(n)]
    return docs + [(900, None, None), (901, "a b", None), (901, "a b", None), (901, "a b c", None), (None, "  x", ""), (902, " \t\n", "empty"), (903, "w " * 5000, "s1"), (904, "\U0001F600 y", "￿"), (905, "y", "\U0001F600")]


def test_targets_and_taken_words(spark):
    docs = sample()
    want, sizes = brute_targets(docs)
    rows = mixing.mixing_digest(table(spark, docs)).collect()
    assert Counter((r.doc_id, r.size) for r in rows) == Counter((d, words(t)) for d, t, _ in docs)
    taken = defaultdict(int)
    source_of = {d: s for d, _, s in docs}
    for r in rows:
        s = source_of[r.doc_id]
        assert r.source_size == sizes[s] and abs(r.target - float(want[s])) < 1e-6 and 0 <= r.taken <= 3 * r.size
        taken[s] += r.taken
    assert all(taken[s] == int(want[s]) for s in want)
    assert sorted(map(repr, rows)) == sorted(map(repr, mixing.mixing_digest(table(spark, docs).repartition(5)).collect()))


def test_blocks_are_the_scheduled_words(spark):
    docs = sample(120)
    known, content = mixing.mix(table(spark, docs), block_words=64)
    size = {r.row: r for r in known.collect()}
    by_slot, times = defaultdict(list), Counter()
    for r in content.collect():
        by_slot[r.slot].append(r)
        for k in range(r.begin, r.begin + r.words):
            times[r.row, k] += 1
        assert r.begin + r.words <= size[r.row].size and r.words > 0
    quota = {s: int(t) for s, t in brute_targets(docs)[0].items()}
    full = [sum(r.words for r in x) for x in by_slot.values()]
    assert max(full) == 64 and sum(full) == sum(quota.values()) and max(times.values()) <= 3
    assert sum(n < 64 for n in full) <= len(quota)
    for x in by_slot.values():
        assert len({(r.source_no, r.rank) for r in x}) == 1


def test_the_schedule_is_even_in_every_stretch(spark):
    sources = spark.createDataFrame([(0, 5000), (1, 2000), (2, 997), (3, 0), (4, 1)], "source_no long, quota long")
    slots = sorted(mixing.schedule(sources, 10).collect())
    total = Counter()
    for r in slots:
        assert r.rank == total[r.source_no]
        total[r.source_no] += 1
    assert total == {0: 500, 1: 200, 2: 100, 4: 1} and len({r.slot for r in slots}) == len(slots)
    assert sum(r.words for r in slots) == 7998
    for n in range(50, 800, 50):
        held = Counter(r.source_no for r in slots[:n])
        assert all(abs(held[s] - n * q / 7998) < 6 for s, q in ((0, 5000), (1, 2000), (2, 997)))


def test_points_are_van_der_corputs(spark):
    ids = [0, 1, 2, 3, 5, 12345, (1 << 31) + 7, (1 << 61) + 1]
    rows = spark.createDataFrame([(i,) for i in ids], "i long").select("i", mixing.van_der_corput(F.col("i")).alias("p")).collect()
    assert all(r.p == int(f"{r.i:062b}"[::-1], 2) for r in rows)


@pytest.mark.parametrize("docs", [[], [(1, None, None)], [(1, "", "a"), (2, " ", "b")], [(1, "one", "a")], [(1, "a b c", "x"), (2, "w " * 100_000, "y")]])
def test_small_tables(spark, docs):
    rows = mixing.mixing_digest(table(spark, docs)).collect()
    want, _ = brute_targets(docs)
    assert len(rows) == len(docs)
    assert sum(r.taken for r in rows) == sum(int(t) for t in want.values())


def test_a_very_long_text(spark):
    rows = mixing.mixing_digest(table(spark, [(1, "ab " * 7_000_000, "a"), (2, "x " * 9, "b")])).collect()
    assert {r.doc_id: r.taken for r in rows} == {1: 7_000_009 - 27, 2: 27}
