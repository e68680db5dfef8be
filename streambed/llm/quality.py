"""Quality classifier: histogram gradient-boosted trees over statistics of whole documents.

Statistics are computed where documents are scanned, for runs of texts at once; there is no shuffle. Trees are
trained on a bounded sample of labelled rows (``SAMPLE_ROWS`` of each class, by hash order, texts of at most the
toxicity operator's ``SAMPLE_BYTES``): each statistic is cut into quantile bins and each split is the best of
all bin borders. The trees are complete and flattened into arrays, so that a batch goes down all trees by one array
lookup per level. The score's zero is laid so that the best balanced cut of held-back rows is at 0.3.

Defined cases: null and empty texts have statistics of 0 and a score like any other; repeated labels of a
document count as 1 if one is; repeated rows are scored each; without labels of both classes every score is the
share of label 1, or 0 without any; an empty table gives no rows; extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from streambed.llm.hashing import Windows, Words, mix, sequence_hashes
from streambed.llm.shared import pieces, text_bytes
from streambed.llm.toxicity import held_out, learning_rows

SAMPLE_ROWS = 4000
THRESHOLD = 0.3
BINS, DEPTH, TREES, RATE, LEAST, SMOOTH = 64, 4, 80, 0.15, 8, 1.0

#: Byte classes whose shares are statistics.
CLASSES = {
    "lower": range(97, 123), "upper": range(65, 91), "digit": range(48, 58), "space": (32, 9), "line": (10,),
    "stop": b".,;:", "mark": b"!?", "symbol": b"#$%&*@^~<>=+\\/_{}[]", "bar": b"|", "quote": b"'\"()-", "wide": range(128, 256),
}
STATISTICS = [
    *(f"{c}_share" for c in CLASSES), "bytes", "words", "word_length", "word_length_spread", "long_words", "distinct_words", "top_word",
    "distinct_pairs", "distinct_triples", "lines", "distinct_lines", "line_length", "stop_per_word", "mark_per_word", "symbol_per_word",
]


def _per_text(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(values, dtype=np.float64)])
    return total[first[1:]] - total[first[:-1]]


def _distinct(hashes: np.ndarray, owner: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values of each text and how often its commonest stands in it."""
    key = mix(hashes + owner.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    _, at, count = np.unique(key, return_index=True, return_counts=True)
    most = np.zeros(n)
    np.maximum.at(most, owner[at], count)
    return np.bincount(owner[at], minlength=n).astype(float), most


def statistics(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """One row of ``STATISTICS`` for each text of a run."""
    n = len(offsets) - 1
    size = np.diff(offsets).astype(float)
    share = {}
    for name, held in CLASSES.items():
        table = np.zeros(256, np.uint8)
        table[list(held)] = 1
        share[name] = _per_text(table[data], offsets)
    words = Words(data, offsets, "space")
    count = np.diff(words.first).astype(float)
    length = (words.ends - words.starts).astype(float)
    owner = np.repeat(np.arange(n), np.diff(words.first))
    some = np.maximum(count, 1)
    mean = _per_text(length, words.first) / some
    spread = np.sqrt(np.maximum(0, _per_text(length * length, words.first) / some - mean * mean))
    distinct, most = _distinct(words.hashes, owner, n)
    runs = []
    for k in (2, 3):
        h = sequence_hashes(words.hashes, k)
        inside = owner[:len(h)] == owner[k - 1:] if len(h) else np.zeros(0, bool)
        got, _ = _distinct(h[inside], owner[:len(h)][inside], n)
        runs.append(np.where(count >= k, got / np.maximum(count - k + 1, 1), 1.0))
    breaks = np.flatnonzero(data == 10)
    begin = np.union1d(offsets[:-1], breaks + 1)
    begin = begin[begin < len(data)]
    end = np.append(begin[1:], len(data))
    line_owner = np.searchsorted(offsets, begin, "right") - 1
    lines = np.bincount(line_owner, minlength=n).astype(float)
    kinds, _ = _distinct(Windows(words.low).of(begin, end), line_owner, n)
    bytes_ = np.maximum(size, 1)
    columns = [share[c] / bytes_ for c in CLASSES] + [
        np.log1p(size), np.log1p(count), mean, spread, _per_text(length > 20, words.first) / some, distinct / some, most / some, *runs,
        np.log1p(lines), kinds / np.maximum(lines, 1), np.log1p(size / np.maximum(lines, 1)), share["stop"] / some, share["mark"] / some, share["symbol"] / some]
    return np.stack(columns, axis=1)


@dataclass
class Forest:
    """Complete trees of one depth, node by node from the top: inner nodes, then leaf values."""

    feature: np.ndarray  # trees x inner nodes
    border: np.ndarray
    leaf: np.ndarray  # trees x leaves
    start: float
    shift: float = 0.0

    def margin(self, rows: np.ndarray) -> np.ndarray:
        trees, inner = self.feature.shape
        node = np.zeros((len(rows), trees), np.int64)
        tree, row = np.arange(trees), np.arange(len(rows))[:, None]
        for _ in range(inner.bit_length()):
            right = rows[row, self.feature[tree, node]] > self.border[tree, node]
            node = 2 * node + 1 + right
        return self.start + self.leaf[tree, node - inner].sum(axis=1)

    def scores(self, rows: np.ndarray) -> np.ndarray:
        return 1.0 / (1.0 + np.exp(-np.clip(self.margin(rows) + self.shift, -30, 30)))


def grow(rows: np.ndarray, labels: np.ndarray) -> Forest:
    """Boost trees for logistic loss on binned statistics."""
    n, width = rows.shape
    borders = [np.unique(np.quantile(rows[:, f], np.linspace(0, 1, BINS + 1)[1:-1])) for f in range(width)]
    binned = np.stack([np.searchsorted(borders[f], rows[:, f], "left") for f in range(width)], axis=1)
    share = np.clip(labels.mean(), 1e-3, 1 - 1e-3)
    start = float(np.log(share / (1 - share)))
    margin = np.full(n, start)
    inner = (1 << DEPTH) - 1
    feature, border, leaf = np.zeros((TREES, inner), np.int64), np.full((TREES, inner), np.inf), np.zeros((TREES, inner + 1))
    column = np.arange(width) * BINS
    for t in range(TREES):
        p = 1 / (1 + np.exp(-margin))
        slope, bend = labels - p, p * (1 - p)
        node = np.zeros(n, np.int64)
        for level in range(DEPTH):
            first, many = (1 << level) - 1, 1 << level
            place = ((node - first)[:, None] * width * BINS + column + binned).ravel()
            sums = [np.bincount(place, np.repeat(v, width), many * width * BINS).reshape(many, width, BINS) for v in (slope, bend, np.ones(n))]
            left = [np.cumsum(s, axis=2) for s in sums]
            whole = [x[:, :, -1:] for x in left]
            right = [w - x for w, x in zip(whole, left, strict=True)]
            gain = left[0] ** 2 / (left[1] + SMOOTH) + right[0] ** 2 / (right[1] + SMOOTH) - whole[0] ** 2 / (whole[1] + SMOOTH)
            gain[(left[2] < LEAST) | (right[2] < LEAST)] = -1
            best = gain.reshape(many, -1).argmax(axis=1)
            for k in range(many):
                f, b = divmod(int(best[k]), BINS)
                if gain[k, f, b] > 1e-6 and b < len(borders[f]):
                    feature[t, first + k], border[t, first + k] = f, borders[f][b]
            node = 2 * node + 1 + (rows[np.arange(n), feature[t, node]] > border[t, node])
        at = node - inner
        up, down = np.bincount(at, slope, inner + 1), np.bincount(at, bend, inner + 1)
        leaf[t] = RATE * up / (down + SMOOTH)
        margin += leaf[t, at]
    return Forest(feature, border, leaf, start)


def fit(rows: list[tuple[str, int]]) -> Forest | None:
    """Train on (text, label) rows, of which every fourth only sets where the cut lies."""
    if not rows:
        return None
    data, offsets = text_bytes(pa.array([t or "" for t, _ in rows], pa.large_string()))
    parts = [statistics(p, o) for _, _, p, o in pieces(data, offsets)]
    stats, labels = np.concatenate(parts), np.array([y for _, y in rows], float)
    share = labels.mean()
    if share in (0.0, 1.0):
        empty = np.zeros((0, 1), np.int64)
        return Forest(empty, empty.astype(float), np.zeros((0, 2)), 30.0 if share else -30.0)
    check = np.arange(len(rows)) % 4 == 0
    shift = 0.0
    if len(set(labels[check])) == len(set(labels[~check])) == 2:
        margin = grow(stats[~check], labels[~check]).margin(stats[check])
        order, good = np.argsort(margin, kind="stable"), labels[check] == 1
        low = np.cumsum(~good[order]) / (~good).sum()  # label 0 below the cut
        lost = np.cumsum(good[order]) / good.sum()
        last = np.append(np.diff(margin[order]) > 0, False)
        k = int(np.argmax(np.where(last, low - lost, -1)))
        shift = -(margin[order][k] + margin[order][k + 1]) / 2 if last.any() else 0.0
        shift += float(np.log(THRESHOLD / (1 - THRESHOLD)))
    forest = grow(stats, labels)
    forest.shift = float(shift)
    return forest


def score_documents(docs: DataFrame, forest: Forest | None) -> DataFrame:
    """doc_id and score of every document."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text_bytes(batch.column("text"))
            parts = [forest.scores(statistics(p, o)) if forest else np.zeros(e - b) for b, e, p, o in pieces(data, offsets)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(np.concatenate(parts) if parts else np.zeros(0))], ["doc_id", "score"])
    schema = T.StructType([docs.schema["doc_id"], T.StructField("score", T.DoubleType())])
    return docs.select("doc_id", "text").mapInArrow(run, schema)


def fit_quality(docs: DataFrame, labels: DataFrame) -> Forest | None:
    """Train on the rows whose crc32(doc_id) mod 5 is not 0."""
    return fit(learning_rows(docs, labels, "quality", ~held_out(5, 0), SAMPLE_ROWS))


def quality_digest(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The contract's row per document."""
    return score_documents(docs, fit_quality(docs, labels)).select(
        "doc_id", F.coalesce(held_out(5, 0), F.lit(False)).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
