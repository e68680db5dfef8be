"""K-d shards: near equal bytes, copies together, slots without gaps, exact medians."""

import random
import zlib
from collections import defaultdict

from pyspark.sql import functions as F

from streambed.llm import sharding


def table(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string, source string, size string")


def check(docs, rows, shards=8):
    by = defaultdict(list)
    where = defaultdict(set)
    texts = {}
    for doc, text, *_ in docs:
        texts.setdefault(doc, []).append(text)
    for r in rows:
        by[r.shard].append(r)
        held = [t for t in texts[r.doc_id] if zlib.crc32((t or "").encode()) == r.text_crc32]
        assert held and r.size == len((held[0] or "").encode()) + 1
        where[held[0] or ""].add(r.shard)
    assert len(rows) == len(docs) and set(by) <= set(range(shards))
    assert all(len(x) == 1 for x in where.values())
    for got in by.values():
        assert sorted(r.slot for r in got) == list(range(len(got)))
    return {s: sum(r.size for r in got) for s, got in by.items()}


def test_equal_bytes_despite_a_hot_source_and_ties(spark, monkeypatch):
    monkeypatch.setattr(sharding, "SLOT_ROWS", 100)
    monkeypatch.setattr(sharding, "LEVEL_BINS", 64)
    rng = random.Random(2)
    docs = [(i, "w" * rng.choice([5, 50, 500]) + str(i), rng.choice(["a", "a", "b", str(i)]), "x") for i in range(2000)]
    docs += [(3000 + i, "copy" * 30, "a", None) for i in range(150)] + [(9000, None, None, None), (9001, "", "é", None), (9001, "", "é", None)]
    sizes = check(docs, sharding.sharding_digest(table(spark, docs)).collect())
    assert len(sizes) == 8 and max(sizes.values()) - min(sizes.values()) < 3 * 505


def test_few_units_and_empty(spark):
    docs = [(1, "same", "s", "x")] * 5 + [(2, "other", "s", "x")]
    check(docs, sharding.sharding_digest(table(spark, docs)).collect())
    assert sharding.sharding_digest(table(spark, docs).limit(0)).count() == 0


def test_a_cut_is_the_weighted_median(spark):
    rows = [(float(i % 7), float(i), i + 1) for i in range(100)]
    units = spark.createDataFrame(rows, "x double, unit_tie double, unit_weight long").withColumn("unit_weight", F.col("unit_weight"))
    got = {(r.x, r.unit_tie): r.shard for r in sharding.kd_shards(units, ["x"], sum(r[2] for r in rows) // 2 + 1).collect()}
    left = [r for r in rows if got[r[0], r[1]] == 0]
    assert max(left)[:2] < min(r for r in rows if got[r[0], r[1]] == 1)[:2]
    assert abs(sum(r[2] for r in left) - sum(r[2] for r in rows) / 2) <= 50
