"""Boosted trees: held-out accuracy, statistics against plain Python, array traversal against node by node."""

import random
import zlib

import numpy as np
import pyarrow as pa
import pytest

from streambed.llm import quality


def corpus(n=1500):
    rng = random.Random(6)
    word = lambda: "".join(rng.choices("abcdeéfgh", k=rng.randint(2, 9)))
    docs, labels = [], []
    for i in range(n):
        words = [word() for _ in range(rng.choice([8, 60, 300]))]
        junk = i % 5
        text = {0: " ".join(w + rng.choice(["###", "$$$"]) for w in words), 1: " ".join([words[0]] * len(words))}.get(junk, " ".join(words) + ".\n" + word())
        docs.append((i, text, f"s{i % 3}"))
        if i % 7:
            labels.append((i, int(junk > 1), 0))
    return docs, labels


@pytest.fixture(scope="module")
def frames(spark):
    docs, labels = corpus()
    docs += [(5000, None, None), (5001, "", "s"), (5001, "", "s"), (5002, "x" * 300_000, "s"), (None, "a b", "s")]
    schema = "doc_id long, text string, score string"
    return spark.createDataFrame(docs, schema), spark.createDataFrame(labels + [(1, None, 0), (None, 1, 1), (3, 0, 0)], "doc_id long, quality int, toxic int")


def test_held_out_accuracy(frames):
    rows = quality.quality_digest(*frames).collect()
    assert len(rows) == 1505
    for r in rows:
        assert 0 <= r.score <= 1 and r.predicted == (r.score >= 0.3)
        assert r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
    held = [r for r in rows if r.held_out and r.doc_id < 5000]
    assert sum(r.predicted == (r.doc_id % 5 > 1) for r in held) / len(held) > 0.97


def test_missing_classes_and_empty_table(frames):
    docs, labels = frames
    assert {r.score for r in quality.quality_digest(docs, labels.limit(0)).collect()} == {0.0}
    assert all(r.score > 0.99 for r in quality.quality_digest(docs, labels.where("quality = 1")).collect() if r.doc_id != 3)
    assert quality.quality_digest(docs.limit(0), labels).count() == 0


def test_statistics_of_a_run_equal_those_of_each_text():
    texts = ["", "One two two.\nOne two two.\n\nend", "A" * 50, "é| 1!", "\n", " "]
    whole = quality.statistics(*quality.text_bytes(pa.array(texts, pa.large_string())))
    for t, row in zip(texts, whole, strict=True):
        assert np.allclose(quality.statistics(*quality.text_bytes(pa.array([t], pa.large_string())))[0], row)
    got = dict(zip(quality.STATISTICS, whole[1], strict=True))
    assert np.isclose(got["words"], np.log1p(7)) and np.isclose(got["distinct_words"], 4 / 7) and np.isclose(got["top_word"], 2 / 7)
    assert np.isclose(got["lines"], np.log1p(4)) and np.isclose(got["distinct_lines"], 3 / 4)
    assert np.isclose(got["upper_share"], 2 / len(texts[1])) and np.isclose(got["distinct_pairs"], 4 / 6)


def test_traversal_equals_node_by_node():
    rng = np.random.default_rng(2)
    rows = rng.normal(size=(500, 5))
    labels = ((rows[:, 0] > 0.3) ^ (rows[:, 3] > 0)).astype(float)
    forest = quality.grow(rows, labels)
    inner = forest.feature.shape[1]
    for k in range(0, 500, 50):
        total = forest.start
        for t in range(len(forest.feature)):
            node = 0
            while node < inner:
                node = 2 * node + 1 + int(rows[k, forest.feature[t, node]] > forest.border[t, node])
            total += forest.leaf[t, node - inner]
        assert np.isclose(total, forest.margin(rows[k:k + 1])[0])
    assert ((forest.margin(rows) > 0) == labels).mean() > 0.95
