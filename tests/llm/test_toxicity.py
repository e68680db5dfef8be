"""Compression distance: held-out accuracy, and defined results for odd rows."""

import random
import zlib

import pytest

from streambed.llm import toxicity


def corpus(n=1500):
    rng = random.Random(3)
    bits = ["ta", "re", "mon", "li", "sho", "ver", "an", "po", "qui", "del"]
    word = lambda: "".join(rng.choices(bits, k=rng.randint(1, 3)))
    docs, labels = [], []
    for i in range(n):
        words = [word() for _ in range(rng.choice([30, 120, 400]))]
        if bad := i % 4 == 0:
            for k in range(0, len(words), 20):
                words[k] = rng.choice(["wretch", "vermin", "dimwit", "grumblefool"]) + rng.choice(["", ",", "."])
        docs.append((i, " ".join(words), "en", f"s{i % 3}", 0))
        if i % 10:
            labels.append((i, 1, int(bad)))
    return docs, labels


@pytest.fixture(scope="module")
def frames(spark):
    docs, labels = corpus()
    docs += [(5000, None, None, None, None), (5001, "", "en", "s", 0), (5001, "", "en", "s", 0), (5002, "x" * 200_000, "en", "s", 1), (None, "wretch", "en", "s", 6)]
    labels += [(1, 1, 0), (1, 1, None), (9999, 1, 1), (None, 0, 1)]
    schema = "doc_id long, text string, lang string, source string, hits long"
    return spark.createDataFrame(docs, schema), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_held_out_accuracy(frames):
    rows = toxicity.toxicity_digest(*frames).collect()
    assert len(rows) == 1505
    for r in rows:
        assert 0 <= r.score <= 1 and r.predicted == (r.score >= 0.7)
        assert r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 3 == 1)
    held = [r for r in rows if r.held_out and r.doc_id < 5000]
    assert sum(r.predicted == (r.doc_id % 4 == 0) for r in held) / len(held) > 0.95
    assert all(r.predicted == 0 for r in rows if r.doc_id is not None and r.doc_id >= 5000)


def test_filter_keeps_columns_and_clean_rows(frames):
    docs, labels = frames
    kept = toxicity.drop_toxic(docs, toxicity.fit_toxicity(docs, labels))
    assert kept.columns == docs.columns
    left = {r.doc_id for r in kept.collect()}
    assert sum(i in left for i in range(1500) if i % 4) > 1080 and sum(i in left for i in range(0, 1500, 4)) < 25
    assert {5000, 5001, 5002} <= left


def test_without_labels_nothing_is_toxic(frames):
    docs, labels = frames
    assert {r.score for r in toxicity.toxicity_digest(docs, labels.limit(0)).collect()} == {0.0}
    assert toxicity.toxicity_digest(docs.limit(0), labels).count() == 0
    assert toxicity.drop_toxic(docs, None).count() == docs.count()


def test_long_words_are_split():
    data, offsets = toxicity._joined(["a" * 100 + " b", ""])
    begin, end = toxicity.split_windows(toxicity.Words(data, offsets, "space"))
    assert list(zip(begin.tolist(), end.tolist(), strict=True)) == [(0, 48), (48, 96), (96, 100), (101, 102)]


def test_rarer_languages_are_learned_too():
    """One toxic stem per language, on endings that are ordinary; the rarest has some forty toxic rows to learn from."""
    rng = random.Random(8)
    rows, where = [], []
    tongues = [("abcdef", "idiot", 6), ("ghijkl", "réeux", 2), ("mnopqr", "bomente", 1)]
    for lang, (letters, stem, weight) in enumerate(tongues):
        bits = ["".join(rng.choices(letters, k=rng.randint(2, 4))) for _ in range(12)]
        for i in range(220 * weight):
            words = ["".join(rng.choices(bits, k=rng.randint(1, 3))) for _ in range(rng.choice([40, 150]))]
            if bad := i % 4 == 0:
                for k in range(0, len(words), 12):
                    words[k] = stem + rng.choice(bits)
            rows.append((" ".join(words), int(bad)))
            where.append(lang)
    order = list(range(len(rows)))
    rng.shuffle(order)
    learn, held = order[: len(order) * 2 // 3], order[len(order) * 2 // 3:]
    model = toxicity.fit([rows[k] for k in learn])
    hits, windows = toxicity.count_hits(toxicity.Distance(model.ordinary, model.toxic), *toxicity._joined([rows[k][0] for k in held]))
    said = model.scores(hits, windows) >= toxicity.THRESHOLD
    for lang in range(3):
        mine = [n for n, k in enumerate(held) if where[k] == lang]
        bad, good = ([n for n in mine if rows[held[n]][1] == y] for y in (1, 0))
        assert said[bad].mean() >= 0.9 and said[good].mean() <= 0.05


def test_gaps_are_compressed_one_by_one():
    import numpy as np
    import zstandard
    ordinary, toxic = b"some ordinary words of text " * 20, b" wretched  vermin "
    words = ["wretched", "vermin", "ordinary", "x", "unwretchedly"]
    data = np.frombuffer(" ".join(words).encode(), np.uint8)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    got = toxicity.Distance(ordinary, toxic).gaps(data, ends - [len(w) for w in words], ends)

    def length(content, word):
        held = zstandard.ZstdCompressionDict(content + toxicity.LEAD_IN, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        side = zstandard.ZstdCompressor(level=toxicity.LEVEL, dict_data=held, write_checksum=False, write_content_size=False, write_dict_id=False)
        return len(side.compress(toxicity.LEAD_IN + b" " + word.encode() + b" " + toxicity.TAIL))

    assert got.tolist() == [length(ordinary, w) - length(ordinary + toxic, w) for w in words] and got[0] >= 3 and got[2] <= 0
