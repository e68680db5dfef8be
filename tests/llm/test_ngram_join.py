"""Components and shingle counts against all pairs."""

import random
import re
from collections import defaultdict

import pytest

from streambed.llm import ngram_join as j

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingles(text):
    words = WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    return {tuple(words[i:i + 5]) for i in range(len(words) - 4)} if len(words) >= 5 else ({tuple(words)} if words else set())


def brute(rows):
    sets = [(d, shingles(t)) for d, t, *_ in rows]
    parent = {d: d for d, _ in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    low = lambda d: (d is not None, d or 0)
    for k, (a, x) in enumerate(sets):
        for b, y in sets[:k]:
            if x and y and 100 * len(x & y) >= 75 * len(x | y):
                p, q = sorted((root(a), root(b)), key=low)
                parent[q] = p
    return sorted(((d, len(s), root(d) if s else d) for d, s in sets), key=repr)


def fixture(seed, n=60):
    rng = random.Random(seed)
    word = lambda: rng.choice("abcdefgh") + rng.choice(["", "x", "É", "9"])
    base = [[word() for _ in range(rng.choice([3, 5, 9, 40, 120]))] for _ in range(12)]
    rows = []
    for i in range(n):
        words = list(rng.choice(base))
        for _ in range(rng.randint(0, 4)):
            words[rng.randrange(len(words))] = word()
        if rng.random() < 0.3:
            words = words[:rng.randint(1, len(words))] + [word() for _ in range(rng.randint(0, 9))]
        rows.append((rng.randrange(10 ** 6), rng.choice([" ", "\n", "  "]).join(words), "x", 0))
    rows += [(2_000_000 + i, rows[i % 5][1].upper(), "c", 1) for i in range(15)] + [(3_000_000, None, "n", 0), (3_000_001, "", "n", 0), (3_000_002, " \t", "n", 0), (None, "alone here", "n", 0)]
    return list({r[0]: r for r in rows}.values())


@pytest.mark.parametrize(("seed", "hub", "pack"), [(1, 2000, 1 << 20), (2, 4, 50), (3, 3, 1 << 20)])
def test_components_match_all_pairs(spark, monkeypatch, seed, hub, pack):
    monkeypatch.setattr(j, "HUB", hub)
    monkeypatch.setattr(j, "PACK_POSTINGS", pack)
    rows = fixture(seed)
    got = j.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string, node string, part int").repartition(5)).collect()
    assert sorted([(r.doc_id, r.n_shingles, r.component_id) for r in got], key=repr) == brute(rows)


def test_repeated_rows_empty_table_and_kept_columns(spark):
    text = " ".join(f"w{i}" for i in range(40))
    rows = [(5, text, "a"), (5, text, "a"), (7, text + " more", "b"), (9, "other words", "c"), (4, None, "d")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, component_id string")
    got = sorted((r.doc_id, r.component_id) for r in j.near_duplicates(docs).collect())
    assert got == [(4, 4), (5, 5), (5, 5), (7, 5), (9, 9)]
    kept = j.keep_one(docs)
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == [4, 5, 5, 9]
    assert j.near_duplicates(docs.limit(0)).count() == 0


def test_long_chain_is_one_component(spark):
    links = [(i, i + 1) for i in range(200)] + [(900, 901)]
    got = {r.id: r.component for r in j.components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {**dict.fromkeys(range(201), 0), 900: 900, 901: 900}


def test_similar_is_exact():
    import numpy as np
    rng = random.Random(4)
    for _ in range(3000):
        a = set(rng.sample(range(200), rng.randint(1, 150)))
        b = set(rng.sample(sorted(a), rng.randint(0, len(a)))) | set(rng.sample(range(260), rng.randint(1, 60)))
        x, y = (np.array(sorted(s), np.uint64) for s in (a, b))
        assert j.similar(x, y) == (100 * len(a & b) >= 75 * len(a | b))


def test_groups_cut_by_length():
    import numpy as np
    by = defaultdict(list)
    shingle, size = np.array([1, 1, 1, 2], np.uint64), np.array([3, 4, 6, 6], np.uint32)
    for k, new in enumerate(j._groups(shingle, size)):
        by[bool(new)].append(k)
    assert by[True] == [0, 2, 3]


@pytest.mark.parametrize(("seed", "hub", "carry"), [(1, 2000, 64), (2, 4, 64), (3, 3, 1)])
def test_every_link_is_found_once_and_counted(spark, monkeypatch, seed, hub, carry):
    monkeypatch.setattr(j, "HUB", hub)
    monkeypatch.setattr(j, "CARRY", carry)
    rows = [r for r in fixture(seed, 90) if r[0] is not None]
    base = [f"w{i}" for i in range(120)]
    rows += [(4_000_000 + i, " ".join(base[:i] + [f"x{i}"] + base[i + 1:]), "g", 0) for i in range(0, 120, 6)]  # a group where all link
    sets = {d: shingles(t) for d, t, *_ in rows}
    want = {(a, b) for a in sets for b in sets if a < b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])}
    docs = spark.createDataFrame(rows, "doc_id long, text string, node string, part int").repartition(5)
    got = [(r.a, r.b) for r in j.similar_pairs(docs).collect()]
    assert len(want) >= 190 and len(got) == len(want) and set(got) == want
    many = defaultdict(int)
    for pair in want:
        for d in pair:
            many[d] += 1
    assert {r.doc_id: r.n_links for r in j.near_duplicates(docs).collect()} == {d: many[d] for d in sets}
    roots = {d: c for d, _, c in brute(rows)}
    assert sorted(r.doc_id for r in j.keep_one(docs).collect()) == sorted(d for d in sets if roots[d] == d)


def test_common_counts_and_forest():
    import numpy as np
    rng = random.Random(5)
    for m in (2, 9, 40, 130):
        base = rng.sample(range(10 ** 6), 300)
        sets = [set(rng.sample(base, rng.randint(0, 300))) | set(rng.sample(range(400), 20)) for _ in range(m)]
        arrays = [np.array(sorted(s), np.uint64) for s in sets]
        got = j.common(arrays)
        assert all(got[i, k] == len(sets[i] & sets[k]) for i in range(m) for k in range(m) if i != k)
        found = j.all_pairs(arrays)
        assert all(found[i, k] == (100 * len(sets[i] & sets[k]) >= 75 * len(sets[i] | sets[k])) for i in range(m) for k in range(m) if i != k)
    chain = np.zeros((6, 6), bool)
    chain[0, 3] = chain[3, 0] = chain[3, 5] = chain[5, 3] = chain[0, 5] = chain[5, 0] = chain[1, 2] = chain[2, 1] = True
    assert len(j.forest(chain)) == 3 and {frozenset(p) for p in j.forest(chain)} <= {frozenset(p) for p in ((0, 3), (0, 5), (3, 5), (1, 2))}


def test_words_of_equal_sums_are_two_words(spark):
    one = "".join("ab"[bin(i).count("1") % 2] for i in range(1024))
    other = one.translate(str.maketrans("ab", "ba"))
    rows = [(1, one), (2, other), (3, "y" * 1_000_000), (4, "y" * 999_999 + "z"), (5, "y" * 1_000_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: (r.component_id, r.n_links) for r in j.near_duplicates(docs).collect()}
    assert got == {1: (1, 0), 2: (2, 0), 3: (3, 1), 4: (4, 0), 5: (3, 1)}


def test_word_hashes_are_of_the_bytes_alone():
    import numpy as np

    from streambed.llm.hashing import LANE_BYTES, Words
    rng = random.Random(3)
    words = ["".join(rng.choice("ab") for _ in range(n)) for n in [*range(1, 40), 255, 256, 257, 300, 5000] for _ in range(4)]
    words += ["a" * n for n in range(1, 2 * LANE_BYTES)] + ["\0" * n for n in range(1, 40)]
    seen = {}
    for _ in range(3):
        rng.shuffle(words)
        data = np.frombuffer(" ".join(words).encode(), np.uint8)
        hashes = Words(data, np.array([0, len(data)]), "space").hashes.tolist()
        for w, h in zip(words, hashes, strict=True):
            assert seen.setdefault(w, h) == h
    assert len(set(seen.values())) == len(seen)
