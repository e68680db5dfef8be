"""Vector codes by cover-tree Lloyd: whole subtrees find their codebook entry at once.

A vector's components become integers and the vector is cut into parts; each part position has a codebook. Tasks
cut their rows into blocks of ``BLOCK_ROWS`` and plant one cover tree per block and part: a node is a point and
the radius within which its rows lie, its children cover it at the next smaller power of two and stand further apart than
that, and its rows are one stretch of the block, so that two running sums give any node's total. Trees are written once.

A round sends the codebooks down the trees. At a node of radius r whose nearest entry is at distance d, an entry beyond
``d + 2 r`` cannot be nearest to any of its rows. If one entry is left the whole subtree takes it, by its
sums; else the children go on with the entries left. Rows are compared exactly, in integers, where the radius is 0.
Copies of a vector are one such node. Blocks give one row per part and entry to a Spark sum; the driver sees
``parts * entries`` sums a round, whatever the number of vectors.

Defined cases: rows whose vector is null or holds null, NaN or infinite components are dropped, and so are empty vectors and those
of another length than the first kept vector's, which cannot be cut alike; null ids come last among the starting entries, ties there
go by the vector; repeated rows count each; with fewer vectors than entries the codebooks are as small; an empty table
gives no rows; extra columns are not read. A length that the parts do not divide, or a component whose integer leaves
+-2^26 (then squares would leave 64 bits), raises an error.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from streambed.llm.shared import materialize

PARTS, ENTRIES, ROUNDS, SCALE = 16, 64, 2, 256
#: Vectors of one block of trees.
BLOCK_ROWS = 4096
#: Largest size of an integer component.
LARGEST = 1 << 26
#: Pairs of node and entry that one step compares.
STEP_PAIRS = 1 << 18

_BLOCK = "vec_id array<long>, label array<string>, vectors binary, trees array<struct<rows binary, nodes binary, radius binary>>"
_SUMS = "part int, entry int, n long, total array<long>"


class Tree:
    """A cover tree over some integer points.

    ``rows`` are the points' numbers in tree order; a node is a stretch ``low:high`` of them around the point
    at ``low``, all within ``radius``; its children are the nodes ``first:first + count``.
    """

    def __init__(self, rows: np.ndarray, nodes: np.ndarray, radius: np.ndarray):
        self.rows, self.radius = rows, radius
        self.low, self.high, self.first, self.count = nodes

    def packed(self) -> dict[str, bytes]:
        nodes = np.stack([self.low, self.high, self.first, self.count]).astype("<i4")
        return {"rows": self.rows.astype("<i4").tobytes(), "nodes": nodes.tobytes(), "radius": self.radius.astype("<f8").tobytes()}

    @classmethod
    def unpacked(cls, held: dict[str, bytes]) -> Tree:
        nodes = np.frombuffer(held["nodes"], "<i4").astype(np.int64)
        return cls(np.frombuffer(held["rows"], "<i4").astype(np.int64), nodes.reshape(4, -1), np.frombuffer(held["radius"], "<f8"))


def _squares(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    gap = a - b
    return np.einsum("ij,ij->i", gap, gap)


def _spans(first: np.ndarray, count: np.ndarray) -> np.ndarray:
    """first[0], first[0] + 1, ... first[0] + count[0] - 1, first[1], ..."""
    ends = np.cumsum(count)
    return np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - count - first, count)


def plant(points: np.ndarray) -> Tree:
    """The cover tree of integer points, all nodes of a level at a time."""
    n = len(points)
    rows = np.arange(n)
    lows, highs, radii, firsts, counts = [], [], [], [], []
    low, high, made = np.zeros(min(n, 1), np.int64), np.full(min(n, 1), n, np.int64), 0
    while len(low):
        size = high - low
        node = np.repeat(np.arange(len(low)), size)
        at = _spans(low, size)
        squares = _squares(points[rows[at]], points[rows[np.repeat(low, size)]])
        radius = np.sqrt(np.maximum.reduceat(squares, np.cumsum(size) - size).astype(float))
        scale = np.exp2(np.ceil(np.log2(np.maximum(radius, 1))) - 1)
        open_ = radius > 0
        # Greedy cover: a node's first uncovered row becomes a child and takes what lies within the scale.
        left = np.flatnonzero(open_[node])
        child = np.zeros(len(at), np.int64)
        turn = 0
        while len(left):
            mine = node[left]
            begins = np.flatnonzero(np.r_[True, mine[1:] != mine[:-1]])
            centre = np.repeat(left[begins], np.diff(np.r_[begins, len(left)]))
            covered = _squares(points[rows[at[left]]], points[rows[at[centre]]]) <= scale[mine] ** 2
            child[left[covered]] = turn
            left, turn = left[~covered], turn + 1
        moved = np.argsort(node * (turn + 1) + child, kind="stable")
        rows[at] = rows[at[moved]]
        kept = np.flatnonzero(open_[node[moved]])
        key = (node * (turn + 1) + child)[moved][kept]
        heads = np.flatnonzero(np.r_[True, key[1:] != key[:-1]]) if len(key) else np.zeros(0, np.int64)
        number = np.bincount(node[moved][kept][heads], minlength=len(low))
        made += len(low)
        lows.append(low), highs.append(high), radii.append(radius), counts.append(number)
        firsts.append(made + np.cumsum(number) - number)
        places = at[kept]
        ends = np.r_[heads[1:], len(key)] - 1 if len(heads) else heads
        low, high = places[heads], places[ends] + 1
    nodes = [np.concatenate(x) if x else np.zeros(0, np.int64) for x in (lows, highs, firsts, counts)]
    return Tree(rows, np.stack(nodes), np.concatenate(radii) if radii else np.zeros(0))


def settle(tree: Tree, points: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """Stretches of the tree's rows (low, high) with their nearest entry, in order, and the pairs compared."""
    _, distinct = np.unique(book, axis=0, return_index=True)  # of equal entries the first wins
    entries = np.sort(distinct)
    found, compared = [], 0
    work = [(np.zeros(len(entries), np.int64), entries)] if len(tree.rows) else []
    while work:
        node, entry = work.pop()
        if len(node) > STEP_PAIRS and node[0] != node[-1]:
            middle = int(np.searchsorted(node, node[len(node) // 2]))
            middle = middle or int(np.searchsorted(node, node[0], side="right"))
            work += [(node[:middle], entry[:middle]), (node[middle:], entry[middle:])]
            continue
        compared += len(node)
        begins = np.flatnonzero(np.r_[True, node[1:] != node[:-1]])
        size = np.diff(np.r_[begins, len(node)])
        squares = _squares(points[tree.rows[tree.low[node]]], book[entry])
        best = np.minimum.reduceat(squares, begins)
        nearest = np.flatnonzero(squares == np.repeat(best, size))
        owner = np.repeat(np.arange(len(begins)), size)
        winner = nearest[np.r_[True, owner[nearest][1:] != owner[nearest][:-1]]]  # the lowest of the nearest
        mine = node[begins]
        # A little more than d + 2 r: roundings may keep an entry too many, never one too few.
        reach = (np.sqrt(best.astype(float)) + 2 * tree.radius[mine]) * (1 + 1e-9) + 1e-6
        keep = np.sqrt(squares.astype(float)) <= np.repeat(reach, size)
        kept = np.add.reduceat(keep, begins)
        done = (kept == 1) | (tree.radius[mine] == 0)
        found.append(np.stack([tree.low[mine[done]], tree.high[mine[done]], entry[winner[done]]]))
        go = np.flatnonzero(~done)
        if len(go):
            left = entry[keep & ~np.repeat(done, size)]
            first = np.cumsum(kept[go]) - kept[go]
            children = tree.count[mine[go]]
            each = np.repeat(np.arange(len(go)), children)
            below = _spans(tree.first[mine[go]], children)
            work.append((np.repeat(below, kept[go][each]), left[_spans(first[each], kept[go][each])]))
    low, high, entry = np.concatenate(found, axis=1) if found else np.zeros((3, 0), np.int64)
    order = np.argsort(low)
    return low[order], high[order], entry[order], compared


def _vectors(column: pa.Array, dims: int, scale: int) -> tuple[np.ndarray, np.ndarray]:
    """Which rows have a whole vector, and those vectors as integers."""
    lengths = pc.fill_null(pc.list_value_length(column), -1).to_numpy(zero_copy_only=False)
    flat = pc.list_flatten(column)
    sound = pc.fill_null(pc.is_finite(flat), False).to_numpy(zero_copy_only=False)
    owner = pc.list_parent_indices(column).to_numpy(zero_copy_only=False)
    good = (lengths == dims) & (np.bincount(owner[~sound], minlength=len(column))[:len(column)] == 0)
    values = pc.fill_null(flat, 0).to_numpy(zero_copy_only=False).astype(float)[good[owner]]
    whole = np.floor(values * scale)
    if len(whole) and np.abs(whole).max() > LARGEST:
        raise ValueError(f"a component times {scale} leaves +-{LARGEST}: its squares would not be exact")
    return good, whole.astype(np.int64).reshape(-1, dims)


def _planter(dims: int, parts: int, scale: int, block_rows: int):
    def block(ids: list, labels: list, vectors: np.ndarray) -> pa.RecordBatch:
        step = dims // parts
        trees = [plant(vectors[:, k * step:(k + 1) * step]).packed() for k in range(parts)]
        tree = pa.struct([("rows", pa.binary()), ("nodes", pa.binary()), ("radius", pa.binary())])
        return pa.RecordBatch.from_arrays([
            pa.array([ids], pa.list_(pa.int64())), pa.array([labels], pa.list_(pa.string())),
            pa.array([vectors.astype("<i4").tobytes()], pa.binary()), pa.array([trees], pa.list_(tree)),
        ], names=["vec_id", "label", "vectors", "trees"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, labels, held = [], [], np.zeros((0, dims), np.int64)
        for batch in batches:
            good, vectors = _vectors(batch.column("embedding"), dims, scale)
            ids += batch.column("vec_id").filter(pa.array(good)).to_pylist()
            labels += batch.column("label").filter(pa.array(good)).to_pylist()
            held = np.concatenate([held, vectors])
            while len(ids) >= block_rows:
                yield block(ids[:block_rows], labels[:block_rows], held[:block_rows])
                ids, labels, held = ids[block_rows:], labels[block_rows:], held[block_rows:]
        if ids:
            yield block(ids, labels, held)

    return run


def _opened(row: dict, dims: int, parts: int) -> Iterator[tuple[int, Tree, np.ndarray]]:
    vectors = np.frombuffer(row["vectors"], "<i4").astype(np.int64).reshape(-1, dims)
    step = dims // parts
    for k, held in enumerate(row["trees"]):
        yield k, Tree.unpacked(held), vectors[:, k * step:(k + 1) * step]


def _totals(books: np.ndarray, dims: int):
    parts, entries, step = books.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = np.zeros((parts, entries), np.int64), np.zeros((parts, entries, step), np.int64)
        for batch in batches:
            for row in batch.to_pylist():
                for k, tree, points in _opened(row, dims, parts):
                    low, high, entry, _ = settle(tree, points, books[k])
                    sums = np.concatenate([np.zeros((1, step), np.int64), np.cumsum(points[tree.rows], axis=0)])
                    np.add.at(n[k], entry, high - low)
                    np.add.at(total[k], entry, sums[high] - sums[low])
        part, entry = np.nonzero(n)
        yield pa.RecordBatch.from_arrays([
            pa.array(part, pa.int32()), pa.array(entry, pa.int32()), pa.array(n[part, entry], pa.int64()),
            pa.array(list(total[part, entry]), pa.list_(pa.int64())),
        ], names=["part", "entry", "n", "total"])

    return run


def _coded(books: np.ndarray, dims: int):
    parts = len(books)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                codes = np.zeros((len(row["vec_id"]), parts), np.uint8)
                error = np.zeros(len(codes), np.int64)
                for k, tree, points in _opened(row, dims, parts):
                    low, high, entry, _ = settle(tree, points, books[k])
                    codes[tree.rows, k] = np.repeat(entry, high - low)
                    error += _squares(points, books[k][codes[:, k]])
                text = codes.tobytes().hex()
                yield pa.RecordBatch.from_arrays([
                    pa.array(row["vec_id"], pa.int64()), pa.array(row["label"], pa.string()),
                    pa.array([text[i:i + 2 * parts] for i in range(0, len(text), 2 * parts)], pa.string()), pa.array(error),
                ], names=["vec_id", "label", "code", "error"])

    return run


def _start(rows: DataFrame, entries: int, scale: int) -> tuple[int, np.ndarray]:
    """Length of the vectors, and the integers of those with the smallest ids: ``entries`` rows reach the driver."""
    sound = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    kept = rows.where(F.col("embedding").isNotNull() & (F.size("embedding") > 0) & sound)
    order = [F.col("vec_id").asc_nulls_last(), F.col("embedding")]
    first = kept.orderBy(*order).limit(entries).collect()
    dims = len(first[0].embedding) if first else 0
    if any(len(r.embedding) != dims for r in first):
        first = kept.where(F.size("embedding") == dims).orderBy(*order).limit(entries).collect()
    return dims, np.floor(np.array([r.embedding for r in first], float).reshape(len(first), dims) * scale).astype(np.int64)


def compress_vectors(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS,
                     scale: int = SCALE, block_rows: int = BLOCK_ROWS) -> tuple[DataFrame, np.ndarray]:
    """``vec_id``, ``label`` (as text), ``code`` and ``error`` of every kept vector, and the codebooks (part, entry, component)."""
    if not 0 < entries <= 256:
        raise ValueError("a code has two hex digits a part: 1 to 256 entries")
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"), F.col("label").cast("string").alias("label"))
    dims, start = _start(rows, entries, scale)
    if dims % parts:
        raise ValueError(f"{parts} parts do not divide vectors of length {dims}")
    books = start.reshape(len(start), parts, -1).transpose(1, 0, 2).copy() if dims else np.zeros((parts, 0, 0), np.int64)
    if not dims:
        return vectors.sparkSession.createDataFrame([], "vec_id long, label string, code string, error long"), books
    blocks = materialize(rows.mapInArrow(_planter(dims, parts, scale, block_rows), _BLOCK), "code-trees")
    step = dims // parts
    sums = [F.sum(F.col("total")[k].cast("decimal(38,0)")).alias(f"s{k}") for k in range(step)]
    for _ in range(rounds):
        found = blocks.mapInArrow(_totals(books, dims), _SUMS).groupBy("part", "entry").agg(F.sum("n").alias("n"), *sums).collect()
        books = books.copy()
        for r in found:
            books[r.part, r.entry] = [int(r[f"s{k}"]) // r.n for k in range(step)]
    return blocks.mapInArrow(_coded(books, dims), "vec_id long, label string, code string, error long"), books


def codes_digest(vectors: DataFrame) -> DataFrame:
    """The contract's row per kept vector."""
    coded, books = compress_vectors(vectors)
    digest = sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()
    coded = materialize(coded, "codes")
    by_label = coded.groupBy("label").agg(F.sum("error").alias("label_error")).withColumnRenamed("label", "same")
    return coded.join(by_label, F.col("label").eqNullSafe(F.col("same"))).select(
        "vec_id", "code", "error", "label_error", F.lit(digest).alias("codebooks_sha256"))
