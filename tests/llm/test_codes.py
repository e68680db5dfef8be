"""Vector codes against plain Lloyd rounds; the trees keep their invariants and spare comparisons."""

import math
import random
from hashlib import sha256

import numpy as np
import pytest

from streambed.llm import codes

SCHEMA = "vec_id long, embedding array<float>, label int, code string, error string"


def sound(v, dims):
    return v is not None and len(v) == dims and all(x is not None and math.isfinite(x) for x in v)


def brute(rows, parts=16, entries=64, rounds=2):
    dims = len(min((r for r in rows if sound(r[1], len(r[1] or [])) and r[1]), key=lambda r: (r[0] is None, r[0] or 0, r[1]))[1])
    kept = [(i, [math.floor(256 * float(np.float32(x))) for x in v], label) for i, v, label in rows if sound(v, dims)]
    order = sorted(kept, key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    step = dims // parts
    books = [[r[1][p * step:(p + 1) * step] for r in order[:entries]] for p in range(parts)]

    def near(p, v):
        x = v[p * step:(p + 1) * step]
        return min((sum((a - b) ** 2 for a, b in zip(x, y)), e) for e, y in enumerate(books[p]))

    for _ in range(rounds):
        sums = [{} for _ in range(parts)]
        for _, v, _ in kept:
            for p in range(parts):
                sums[p].setdefault(near(p, v)[1], []).append(v[p * step:(p + 1) * step])
        for p in range(parts):
            for e, held in sums[p].items():
                books[p][e] = [sum(c) // len(held) for c in zip(*held)]
    digest = sha256(",".join(str(x) for book in books for entry in book for x in entry).encode()).hexdigest()
    coded = [(i, [near(p, v) for p in range(parts)], label) for i, v, label in kept]
    by_label = {}
    for _, found, label in coded:
        by_label[label] = by_label.get(label, 0) + sum(d for d, _ in found)
    return sorted(((i, "".join(f"{e:02x}" for _, e in found), sum(d for d, _ in found), by_label[label], digest) for i, found, label in coded), key=repr)


def got(spark, rows):
    return sorted((tuple(r) for r in codes.codes_digest(spark.createDataFrame([(*r, "x", "y") for r in rows], SCHEMA)).collect()), key=repr)


def vector(rng, dims=32, near=None):
    return [rng.gauss(near[k] if near else 0, 0.05 if near else 0.4) for k in range(dims)]


def test_against_plain_rounds_with_copies_ties_and_bad_rows(spark):
    rng = random.Random(4)
    hot = vector(rng)
    rows = [(i, vector(rng, near=hot if i % 3 else None), rng.choice([1, 2, None])) for i in range(300)]
    rows += [(1000 + i, hot, 7) for i in range(150)] + [(5, hot, None), (5, hot, None), (None, vector(rng), 1)]
    rows += [(2000 + i, [rng.choice([0.0, 1 / 256, -1 / 256])] * 32, 3) for i in range(40)]
    bad = [None, [], [0.1] * 16, [0.1] * 31 + [None], [0.1] * 31 + [math.nan], [0.1] * 31 + [math.inf], [-math.inf] * 32]
    rows += [(3000 + k, v, 1) for k, v in enumerate(bad)]
    assert got(spark, rows) == brute(rows)


def test_the_first_vector_sets_the_length(spark):
    rng = random.Random(1)
    rows = [(1, vector(rng), 1), (0, [1.0] * 16, 2), (2, [2.0] * 16, 2)]
    assert got(spark, rows) == brute(rows) and len(got(spark, rows)) == 2


def test_few_rows_and_none(spark):
    rng = random.Random(2)
    rows = [(i, vector(rng), None) for i in range(3)]
    assert got(spark, rows) == brute(rows)
    assert got(spark, []) == [] and got(spark, [(1, None, 1)]) == []


def test_many_blocks_give_what_one_gives(spark):
    rng = random.Random(3)
    frame = spark.createDataFrame([(i, vector(rng, 8), 1, "x", "y") for i in range(500)], SCHEMA).coalesce(2)
    one, many = (codes.compress_vectors(frame, parts=4, entries=20, block_rows=n) for n in (4096, 17))
    assert (one[1] == many[1]).all()
    assert sorted(map(tuple, one[0].collect())) == sorted(map(tuple, many[0].collect()))


def test_what_cannot_be_exact_is_refused(spark):
    with pytest.raises(ValueError, match="divide"):
        codes.codes_digest(spark.createDataFrame([(1, [1.0] * 20, 1, "", "")], SCHEMA))
    with pytest.raises(Exception, match="would not be exact"):
        codes.codes_digest(spark.createDataFrame([(1, [1e9] * 16, 1, "", "")], SCHEMA)).collect()


@pytest.mark.parametrize("dims, spread", [(1, 50), (3, 200), (4, 5), (16, 300)])
def test_trees_keep_their_invariants(dims, spread):
    points = np.random.default_rng(dims).integers(-spread, spread, (700, dims))
    tree = codes.plant(points)
    again = codes.Tree.unpacked(tree.packed())
    assert sorted(tree.rows.tolist()) == list(range(700)) and (again.rows == tree.rows).all() and (again.radius == tree.radius).all()
    for k in range(len(tree.low)):
        mine = points[tree.rows[tree.low[k]:tree.high[k]]]
        away = np.sqrt(((mine - mine[0]) ** 2).sum(1).astype(float))
        assert away.max() == tree.radius[k]
        below = range(tree.first[k], tree.first[k] + tree.count[k])
        if tree.radius[k] == 0:
            assert tree.count[k] == 0
            continue
        scale = 2.0 ** (math.ceil(math.log2(tree.radius[k])) - 1)
        assert [tree.low[k], *tree.high[below]] == [*tree.low[below], tree.high[k]]  # children share out the stretch
        centres = points[tree.rows[tree.low[below]]]
        assert (centres[0] == mine[0]).all() and (tree.radius[below] <= scale).all()
        gaps = np.sqrt(((centres[:, None] - centres[None]) ** 2).sum(2).astype(float))
        assert (gaps[~np.eye(len(centres), dtype=bool)] > scale).all()


@pytest.mark.parametrize("step", [7, 1 << 18])
def test_subtrees_settle_like_their_rows(monkeypatch, step):
    monkeypatch.setattr(codes, "STEP_PAIRS", step)
    rng = np.random.default_rng(8)
    centres = rng.integers(-500, 500, (12, 4))
    points = np.concatenate([c + rng.integers(-9, 9, (200, 4)) for c in centres])
    book = np.concatenate([centres[::2], centres[:3], rng.integers(-500, 500, (20, 4))])
    tree = codes.plant(points)
    low, high, entry, compared = codes.settle(tree, points, book)
    want = ((points[:, None] - book[None]) ** 2).sum(2).argmin(1)
    assert low[0] == 0 and high[-1] == len(points) and (low[1:] == high[:-1]).all()
    assert (np.repeat(entry, high - low) == want[tree.rows]).all()
    assert compared < len(points) * len(book) / 5
