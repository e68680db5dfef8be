"""Merkle manifest of a table, as a persistent tree whose versions copy paths.

Each language is a tree of its own: its leaves ascend by ``doc_id`` and runs of 8 neighbours become
their hash until one node, the subroot, remains; the subroots, in order of language, form the crown. Nodes
live in aligned blocks of 8^4 neighbours. A task holds one block with its four levels, so a language of any size is
many blocks; the tops of the blocks are the leaves of the next round, 4096 times fewer.

A tampered leaf makes a version: it copies the ancestors of that leaf inside its block and shares every other node
with the table as it was. The blocks then carry their versions on, each block with the nodes beside
its path to the root, so upper versions are made where their leaves are and none gathers at the top.

Defined cases: a null value is ``-`` in its leaf; null languages are a tree of their own and come first;
null ids come first and are never tampered; rows of equal ids are ordered by their leaf, equal rows are leaves each; a
lone leaf is its subroot; texts have any length; an empty table has no rows and no root; only the columns of
``COLUMNS`` are read, so extra ones do not matter.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from streambed.llm.ordering import running
from streambed.llm.shared import materialize

COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")
FAN = 8
#: Levels that one block holds.
LEVELS = 4

_STEPS = "array<struct<before string, after string>>"
_PATHS = f"tree string, block long, subroot string, root string, path {_STEPS}"
_ROWS = "doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"


def hashed(text: str) -> str:
    return sha256(text.encode()).hexdigest()


def _field(value: Column) -> Column:
    text = value.cast("string")
    return F.when(value.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf_hash(row: dict[str, Column]) -> Column:
    return F.sha2(F.concat(*[_field(row[c]) for c in COLUMNS]), 256)


def leaves(docs: DataFrame, tampered: Column | None = None, forged: dict[str, Column] | None = None) -> DataFrame:
    """``tree``, ``doc_id``, ``hash`` and, where ``tampered``, the hash of the row with the ``forged`` values.

    By default every document whose id's crc32 3 divides has the letters A-Z of its text lowered.
    """
    row = {c: F.col(c) for c in COLUMNS}
    if tampered is None:
        tampered = F.crc32(F.encode(F.col("doc_id").cast("string"), "UTF-8")) % 3 == 0
    if forged is None:
        forged = {"text": F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")}
    return docs.select(
        F.when(F.col("lang").isNull(), F.lit("0")).otherwise(F.concat(F.lit("1"), F.col("lang"))).alias("tree"),
        F.col("doc_id").cast("long").alias("doc_id"), leaf_hash(row).alias("hash"), F.when(tampered, leaf_hash({**row, **forged})).alias("forged"))


def grow(nodes: list[str], count: int, height: int) -> list[list[str]]:
    """The levels of one block, its nodes first; ``count`` nodes of its whole tree are on their level."""
    levels = [nodes]
    while count > 1 and len(levels) <= height:
        below = levels[-1]
        levels.append([hashed("".join(below[i:i + FAN])) for i in range(0, len(below), FAN)])
        count = -(-count // FAN)
    return levels


def beside(level: list[str], at: int) -> tuple[str, str]:
    """The nodes of the run before and after a node."""
    begin = at - at % FAN
    return "".join(level[begin:at]), "".join(level[at + 1:begin + FAN])


def copy_path(levels: list[list[str]], at: int, digest: str, path: list[tuple[str, str]]) -> list[str]:
    """What a version with another leaf copies, leaf first: the block's ancestors, then those up to the root."""
    copied = [digest]
    for level in levels[:-1]:
        before, after = beside(level, at)
        copied.append(hashed(before + copied[-1] + after))
        at //= FAN
    for before, after in path:
        copied.append(hashed(before + copied[-1] + after))
    return copied


def _blocks(nodes: DataFrame, sizes: DataFrame, block: int, purpose: str) -> DataFrame:
    """Aligned blocks of ``nodes`` (tree, place, hash and more), with the number of nodes of their tree."""
    held = [c for c in nodes.columns if c not in ("tree", "place")]
    grouped = nodes.groupBy("tree", F.floor(F.col("place") / block).cast("long").alias("block")).agg(
        F.sort_array(F.collect_list(F.struct("place", *held))).alias("members"))
    last = F.floor((F.col("nodes") - 1) / block).cast("long")
    known = sizes.select("tree", "nodes", F.explode(F.sequence(F.lit(0).cast("long"), last)).alias("block"))
    return materialize(grouped.join(known, ["tree", "block"]), purpose)  # both keys: a large tree stays spread over tasks


def _top(height: int):
    def top(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.to_pylist()
            yield pa.RecordBatch.from_arrays([
                pa.array([r["tree"] for r in rows], pa.string()), pa.array([r["block"] for r in rows], pa.int64()),
                pa.array([grow([m["hash"] for m in r["members"]], r["nodes"], height)[-1][0] for r in rows], pa.string()),
            ], names=["tree", "place", "hash"])

    return top


def _climb(nodes: DataFrame, sizes: DataFrame, height: int) -> tuple[list[DataFrame], DataFrame]:
    """Rounds of blocks from the leaves up, and the last node of every tree."""
    rounds, done, block = [], None, FAN ** height
    while True:
        blocks = _blocks(nodes, sizes, block, "merkle-blocks")
        rounds.append(blocks)
        tops = materialize(blocks.mapInArrow(_top(height), "tree string, place long, hash string"), "merkle-tops")
        tall = sizes.where(F.col("nodes") > block)
        ready = tops.join(sizes.where(F.col("nodes") <= block), "tree").select("tree", "hash")
        done = ready if done is None else done.unionByName(ready)
        if tall.isEmpty():
            return rounds, done
        sizes = materialize(tall.select("tree", F.ceil(F.col("nodes") / block).cast("long").alias("nodes")), "merkle-sizes")
        nodes = tops.join(sizes.select("tree"), "tree")


def _steps_down(rows: list[dict], crown: bool, height: int) -> dict[str, list]:
    """The path of every member of some blocks: the steps inside its block, then those of the block."""
    out: dict[str, list] = {"tree": [], "block": [], "subroot": [], "root": [], "path": []}
    for r in rows:
        levels, above = grow([m["hash"] for m in r["members"]], r["nodes"], height), r["path"] or []
        for at, member in enumerate(r["members"]):
            steps, node = [], at
            for level in levels[:-1]:
                before, after = beside(level, node)
                steps.append({"before": before, "after": after})
                node //= FAN
            out["tree"].append(member["name"] if crown else r["tree"])
            out["block"].append(0 if crown else member["place"])
            out["subroot"].append(member["hash"] if crown else r["subroot"])
            out["root"].append(r["root"] or levels[-1][0])
            out["path"].append([*steps, *above])
    return out


_PATH_TYPES = {
    "tree": pa.string(), "block": pa.int64(), "subroot": pa.string(), "root": pa.string(),
    "path": pa.list_(pa.struct([("before", pa.string()), ("after", pa.string())])),
}


def _descend(crown: bool, height: int):
    def descend(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():  # a block's paths at a time
                out = _steps_down([row], crown, height)
                yield pa.RecordBatch.from_arrays([pa.array(out[k], t) for k, t in _PATH_TYPES.items()], names=list(_PATH_TYPES))

    return descend


def _paths(blocks: DataFrame, paths: DataFrame, crown: bool, height: int) -> DataFrame:
    found = blocks.join(paths, ["tree", "block"])
    return materialize(found.mapInArrow(_descend(crown, height), _PATHS), "merkle-paths")


def _read(with_versions: bool, height: int):
    """Proof and version of every leaf of a block, from the block and the path above it."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                yield from leaf_rows(row)

    def leaf_rows(row: dict) -> Iterator[pa.RecordBatch]:
        levels = grow([m["hash"] for m in row["members"]], row["nodes"], height)
        path = [(s["before"], s["after"]) for s in row["path"]]
        above = ["".join(before + after for before, after in path)]  # of the block's top, then level by level down
        for level in reversed(levels[1:-1]):
            above = ["".join(beside(level, at)) + above[at // FAN] for at in range(len(level))]
        inner = len(levels) > 1
        proofs, folded, copies = [], [], []
        for at, member in enumerate(row["members"]):
            siblings = "".join(beside(levels[0], at)) + above[at // FAN] if inner else above[0]
            proofs.append(hashed(siblings))
            copied = None if member["forged"] is None else copy_path(levels, at, member["forged"], path)
            copies.append(copied)
            folded.append(copied[-1] if copied else row["root"])
        n = len(proofs)
        arrays = [
            pa.array([m["doc_id"] for m in row["members"]], pa.int64()), pa.array(levels[0], pa.string()), pa.array([row["subroot"]] * n, pa.string()),
            pa.array([row["root"]] * n, pa.string()), pa.array(proofs, pa.string()), pa.array(folded, pa.string()),
            pa.array([f == row["root"] for f in folded], pa.bool_()),
        ]
        names = [part.split()[0] for part in _ROWS.split(", ")]
        if with_versions:
            arrays += [pa.array([m["place"] for m in row["members"]], pa.int64()), pa.array(copies, pa.list_(pa.string()))]
            names += ["place", "copied"]
        yield pa.RecordBatch.from_arrays(arrays, names=names)

    return read


def manifest(docs: DataFrame, tampered: Column | None = None, forged: dict[str, Column] | None = None, versions: bool = True,
             levels: int = LEVELS) -> DataFrame:
    """Every row's leaf, subroot, root and proof, and the root of the version that its tampered leaf makes.

    With ``versions``, also ``place`` (its number in its language) and ``copied`` (the digests that its version
    copies, from the leaf to the version's root; null where no leaf was tampered with). A block holds ``levels`` levels.
    """
    placed = running(leaves(docs, tampered, forged), "tree", ["doc_id", "hash"], purpose="merkle-leaves")
    placed = placed.select("tree", "place", "doc_id", "hash", "forged")
    sizes = materialize(placed.groupBy("tree").agg(F.count("*").alias("nodes")), "merkle-sizes")
    rounds, subroots = _climb(placed, sizes, levels)
    ranked = running(subroots.select(F.lit("crown").alias("tree"), F.col("tree").alias("name"), "hash"), "tree", ["name"], purpose="merkle-subroots")
    ranked = ranked.select("tree", "place", "name", "hash")
    upper, _ = _climb(ranked, ranked.groupBy("tree").agg(F.count("*").alias("nodes")), levels)
    spark = docs.sparkSession
    paths = spark.createDataFrame([("crown", 0, None, None, [])], _PATHS)
    for blocks in reversed(upper[1:]):
        paths = _paths(blocks, paths, False, levels)
    paths = _paths(upper[0], paths, True, levels)
    for blocks in reversed(rounds[1:]):
        # A tree of one block in this round and none above hangs from the crown itself; others come from their upper block.
        here = _paths(blocks, paths, False, levels)
        paths = materialize(here.unionByName(paths.join(blocks.select("tree").distinct(), "tree", "left_anti")), "merkle-paths")
    schema = _ROWS + ", place long, copied array<string>" if versions else _ROWS
    return rounds[0].join(paths, ["tree", "block"]).mapInArrow(_read(versions, levels), schema)


def manifest_digest(docs: DataFrame) -> DataFrame:
    """The contract's row per document."""
    return manifest(docs, versions=False)
