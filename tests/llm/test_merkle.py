"""Manifest against a tree built in one go: subroots, proofs, versions, many rounds of small blocks."""

import zlib
from collections import defaultdict
from hashlib import sha256

import pytest
from pyspark.sql import functions as F

from streambed.llm import merkle

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, hash string, tree string"


def h(text):
    return sha256(text.encode()).hexdigest()


def leaf(row):
    return h("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (row[0], row[3], row[2], row[4], row[1])))


def climb(nodes):
    """All levels of a tree."""
    levels = [nodes]
    while len(levels[-1]) > 1:
        below = levels[-1]
        levels.append([h("".join(below[i:i + 8])) for i in range(0, len(below), 8)])
    return levels


def walk(levels, at, digest):
    """The proof's digests and the root that another digest gives."""
    proof = ""
    for level in levels[:-1]:
        begin = at - at % 8
        before, after = "".join(level[begin:at]), "".join(level[at + 1:begin + 8])
        proof, digest, at = proof + before + after, h(before + digest + after), at // 8
    return proof, digest


def brute(docs):
    low = {ord(c): c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"}
    trees = defaultdict(list)
    for row in docs:
        bad = row[0] is not None and zlib.crc32(str(row[0]).encode()) % 3 == 0
        forged = leaf((row[0], row[1] and row[1].translate(low), *row[2:])) if bad else None
        trees["" if row[2] is None else "1" + row[2]].append((row[0], leaf(row), forged))
    names = sorted(trees, key=lambda x: x.encode())
    for rows in trees.values():
        rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    levels = {n: climb([r[1] for r in trees[n]]) for n in names}
    crown = climb([levels[n][-1][0] for n in names])
    root = crown[-1][0] if names else None
    out = []
    for k, n in enumerate(names):
        for at, (doc, digest, forged) in enumerate(trees[n]):
            proof, sub = walk(levels[n], at, forged or digest)
            more, folded = walk(crown, k, sub)
            out.append((doc, digest, levels[n][-1][0], root, h(proof + more), folded, folded == root))
    return sorted(out, key=repr)


def got(spark, docs, **more):
    rows = merkle.manifest(spark.createDataFrame([(*d, "x", "y") for d in docs], SCHEMA), versions=False, **more).collect()
    return sorted((tuple(r) for r in rows), key=repr)


ODD = [(None, None, None, None, None), (1, "", "", "", 0), (1, "", "", "", 0), (1, "Other", "", "", 0), (3, "É A", "é", None, -1), (7, "Lone", "zz", "s", 4)]


@pytest.mark.parametrize("levels", [1, 2])
def test_many_rounds_against_one_tree(spark, levels):
    docs = [(i * 3, f"Text {i % 50} Ab", "en" if i % 3 else f"l{i % 90}", "src", i) for i in range(700)] + ODD
    assert got(spark, docs, levels=levels) == brute(docs)


def test_blocks_of_four_levels(spark):
    docs = [(i, f"T{i}", "hot" if i < 4200 else f"l{i}", "s", 2) for i in range(4600)]
    assert got(spark, docs) == brute(docs)


def test_one_row_none_and_long_text(spark):
    assert got(spark, []) == []
    for docs in ([(3, "A" * 20_000_000, None, None, 1)], [(0, "Aé", "x", "s", 2)]):
        assert got(spark, docs) == brute(docs)


def test_digest_of_the_contract(spark):
    docs = [(i, "Same" if i % 2 else None, "en", "s", 3) for i in range(80)]
    rows = merkle.manifest_digest(spark.createDataFrame([(*d, "x", "y") for d in docs], SCHEMA)).collect()
    assert sorted((tuple(r) for r in rows), key=repr) == brute(docs)


def test_versions_copy_only_the_path(spark):
    docs = [(i, f"T{i}", "en", "s", 2) for i in range(100)]
    frame = spark.createDataFrame([(*d, "x", "y") for d in docs], SCHEMA)
    rows = {r.doc_id: r for r in merkle.manifest(frame, tampered=F.col("doc_id") == 42, forged={"source": F.lit("t")}, levels=1).collect()}
    assert [r.doc_id for r in rows.values() if r.copied] == [42] and not rows[42].verified and rows[41].verified
    levels = climb([leaf(d) for d in docs])
    copied = [leaf((42, "T42", "en", "t", 2))]
    for k, level in enumerate(levels[:-1]):
        at = 42 // 8 ** k
        run = level[at - at % 8:at - at % 8 + 8]
        run[at % 8] = copied[-1]
        copied.append(h("".join(run)))
    assert rows[42].copied == copied and rows[42].folded_root == copied[-1] and rows[42].place == 42
