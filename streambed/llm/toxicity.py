"""Toxicity by compression distance: two zstandard dictionaries and the windows they disagree about.

One dictionary is trained on ordinary text. The other is trained on what sets toxic text apart: as toxic text is mostly ordinary
language, it holds the pieces of toxic windows made of byte sequences that toxic documents use far oftener, behind the same
ordinary content. A window that the toxic dictionary shortens by ``MARGIN`` bytes more than the ordinary one counts as a
hit. Hits against the number of windows give the log-likelihood of toxic against ordinary writing, and a logistic curve, laid
so that the best cut of held-back training rows is at 0.7, makes it a score.

What is telling is measured on the whole sample, whatever the languages in it: sequences of ``GRAMS`` bytes that at least
``LEAST_DOCS`` and a share of ``LEAST_SHARE`` of the toxic documents hold, ``ODDS`` times oftener than ordinary ones. Pieces that
shorten ordinary windows too often (``SPARE``) are taken out again.

Training sees a bounded sample of labelled rows (``SAMPLE_ROWS`` of each class, by hash order, texts of at most
``SAMPLE_BYTES``) and all of those texts; scoring reads every whole text where it is scanned, without a shuffle. A window is a run of
letters and digits; of equal words in a run of texts one is compressed.

Defined cases: null and empty texts, with no windows, score as the least suspicious text; words longer than
``WINDOW_BYTES`` are several windows; repeated labels of a document count as toxic if one is; repeated rows are scored each; without toxic
or without ordinary labels every score is 0; an empty table gives no rows; extra columns do not matter.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from streambed.llm.hashing import Windows, Words, sequence_hashes
from streambed.llm.shared import pieces, text_bytes

#: Labelled rows of each class and the longest text that training reads.
SAMPLE_ROWS = 2500
SAMPLE_BYTES = 64 << 10
WINDOW_BYTES = 48
ORDINARY_BYTES = 24 << 10
#: Text that zstandard's trainer gets; of more, every so manieth run of eight words over the whole of each text.
TRAINER_BYTES = 4 << 20
#: Room for telling pieces; the commonest stay where there are more.
TOXIC_BYTES = 32 << 10
#: Lengths of the byte sequences compared in training.
GRAMS = (6, 8, 10)
#: Toxic documents that must hold a sequence, at least and as a share, and how much oftener than ordinary ones.
LEAST_DOCS = 5
LEAST_SHARE = 0.01
ODDS = 8.0
#: Hits in ordinary documents that a piece's sequences may have for one in toxic documents.
SPARE = 0.3
#: Rounds of taking out pieces that hit ordinary windows.
PRUNINGS = 2
MARGIN = 3
THRESHOLD = 0.7
LEVEL = 9
#: Stands in both dictionaries and before each window: without it, words are too short to compress at all.
LEAD_IN = bytes(range(1, 25))
#: Stands behind each window, as the compressor looks for no match in the last bytes of a block.
TAIL = bytes(range(128, 138))


@dataclass
class ToxicityModel:
    ordinary: bytes
    toxic: bytes
    #: Hits per window in ordinary and in toxic documents.
    rates: tuple[float, float]
    #: Slope of the score's curve and its cut.
    slope: float
    cut: float

    def evidence(self, hits: np.ndarray, windows: np.ndarray) -> np.ndarray:
        low, high = self.rates
        return hits * np.log(high / low) - windows * (high - low)

    def scores(self, hits: np.ndarray, windows: np.ndarray) -> np.ndarray:
        x = self.slope * (self.evidence(hits, windows) - self.cut)
        return 1.0 / (1.0 + np.exp(-np.clip(x, -30, 30)) * (1 - THRESHOLD) / THRESHOLD)


def split_windows(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """Begin and end of each window: a word, or its parts of ``WINDOW_BYTES``."""
    count = -(-(words.ends - words.starts) // WINDOW_BYTES)
    nth = np.arange(int(count.sum())) - np.repeat(np.cumsum(count) - count, count)
    begin = np.repeat(words.starts, count) + nth * WINDOW_BYTES
    return begin, np.minimum(begin + WINDOW_BYTES, np.repeat(words.ends, count))


class Distance:
    """Compressed lengths of windows under both dictionaries."""

    def __init__(self, ordinary: bytes, toxic: bytes):
        self.sides = []
        for content in (ordinary, ordinary + toxic):
            held = zstandard.ZstdCompressionDict(content + LEAD_IN, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            held.precompute_compress(level=LEVEL)
            self.sides.append(zstandard.ZstdCompressor(level=LEVEL, dict_data=held, write_checksum=False, write_content_size=False, write_dict_id=False))

    def gaps(self, data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Bytes by which the toxic dictionary shortens each window more; windows stand between spaces."""
        if not len(begin):
            return np.zeros(0, np.int64)
        lead, inner = len(LEAD_IN), end - begin
        sizes = inner + lead + 2 + len(TAIL)
        at = np.cumsum(sizes) - sizes
        padded = np.full(int(sizes.sum()), 32, np.uint8)
        padded[(at[:, None] + np.arange(lead)).ravel()] = np.tile(np.frombuffer(LEAD_IN, np.uint8), len(at))
        padded[((at + lead + inner + 2)[:, None] + np.arange(len(TAIL))).ravel()] = np.tile(np.frombuffer(TAIL, np.uint8), len(at))
        nth = np.arange(int(inner.sum())) - np.repeat(np.cumsum(inner) - inner, inner)
        padded[np.repeat(at + lead + 1, inner) + nth] = data[np.repeat(begin, inner) + nth]
        segments = np.empty((len(begin), 2), np.uint64)
        segments[:, 0], segments[:, 1] = at, sizes
        source = zstandard.BufferWithSegments(padded.tobytes(), segments.tobytes())
        lengths = []
        for side in self.sides:
            out = side.multi_compress_to_buffer(source, threads=1)
            lengths.append(np.fromiter((len(x) for x in out), np.int64, len(out)))
        return lengths[0] - lengths[1]


def count_hits(distance: Distance, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hits and windows of each text of a run."""
    words = Words(data, offsets, "alnum")
    begin, end = split_windows(words)
    first = np.searchsorted(begin, offsets)
    _, some, same = np.unique(Windows(words.low).of(begin, end), return_index=True, return_inverse=True)
    hit = distance.gaps(words.low, begin[some], end[some]) >= MARGIN
    total = np.concatenate([[0], np.cumsum(hit[same])])
    return total[first[1:]] - total[first[:-1]], np.diff(first)


def _joined(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    return text_bytes(pa.array(texts, pa.large_string()))


def drop_copies(texts: list[str], share: float = 0.3) -> list[str]:
    """Texts of which less than ``share`` of the three-word runs stand in the texts before: copies would make any phrase look telling."""
    seen: set[int] = set()
    kept = []
    for text in texts:
        runs = set(sequence_hashes(Words(*_joined([text]), "alnum").hashes, 3).tolist())
        if not runs or len(runs & seen) < share * len(runs):
            kept.append(text)
            seen |= runs
    return kept


def _spaced_words(text: str) -> Words:
    return Words(*_joined([" " + text + " "]), "alnum")


def _telling_sequences(toxic: list[str], ordinary: list[str], size: int) -> np.ndarray:
    """Hashes of the sequences of ``size`` bytes that toxic documents use far oftener; one text is looked at at a time."""
    grams, many = np.unique(np.concatenate([np.unique(Windows(_spaced_words(t).low).all(size)) for t in toxic]), return_counts=True)
    enough = many >= max(LEAST_DOCS, LEAST_SHARE * len(toxic))
    grams, many = grams[enough], many[enough]
    against = np.zeros(len(grams) + 1, np.int64)  # the last one counts what is no candidate
    for text in ordinary:
        found = np.unique(Windows(_spaced_words(text).low).all(size))
        place = np.searchsorted(grams, found)
        known = place < len(grams)
        known[known] = grams[place[known]] == found[known]
        against[place[known]] += 1
    return grams[many / len(toxic) >= ODDS * (against[:-1] + 1) / len(ordinary)]


def _telling_pieces(toxic: list[str], ordinary: list[str]) -> list[bytes]:
    """Of each window of toxic texts the stretch of byte sequences that toxic documents use far oftener."""
    chosen = {size: _telling_sequences(toxic, ordinary, size) for size in GRAMS}
    out = []
    for text in toxic:
        w = _spaced_words(text)
        begin, end = split_windows(w)
        mark = np.zeros(len(w.low) + 1, np.int32)
        for size, grams in chosen.items():
            at = np.flatnonzero(np.isin(Windows(w.low).all(size), grams))
            k = np.searchsorted(begin, at + 1, "right") - 1
            inside = (k >= 0) & (at + 1 >= begin[k]) & (at + size <= end[k] + 1)  # within the window and the spaces at its sides
            np.add.at(mark, at[inside], 1)
            np.add.at(mark, at[inside] + size, -1)
        places = np.flatnonzero(np.cumsum(mark)[:-1] > 0)
        first, last = np.searchsorted(places, begin - 1), np.searchsorted(places, end + 1) - 1
        for k in np.flatnonzero(last >= first).tolist():
            low, high = int(places[first[k]]), int(places[last[k]]) + 1
            out.append(b"".join((b" " if low < begin[k] else b"", w.low[max(low, begin[k]):min(high, end[k])].tobytes(), b" " if high > end[k] else b"")))
    return out


def ordinary_dictionary(samples: list[bytes]) -> bytes:
    """A dictionary by zstandard's own trainer; the samples themselves where they are too few for it."""
    try:
        return zstandard.train_dictionary(ORDINARY_BYTES, samples, d=8, k=64, threads=0).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[-ORDINARY_BYTES:]


def toxic_dictionary(telling: list[bytes]) -> bytes:
    """Whole telling pieces, the commonest at the end, as the general trainer would cut them up between sequences."""
    content = b"".join(w for w, _ in reversed(Counter(telling).most_common()))
    return content[-TOXIC_BYTES:]


def _hits_by_sequence(distance: Distance, texts: list[str], size: int) -> Counter[bytes]:
    """For each short sequence the hits of windows that hold it, per text."""
    held: Counter[bytes] = Counter()
    for _, _, data, offsets in pieces(*_joined(texts)):
        words = Words(data, offsets, "alnum")
        begin, end = split_windows(words)
        _, some, times = np.unique(Windows(words.low).of(begin, end), return_index=True, return_counts=True)
        for k in np.flatnonzero(distance.gaps(words.low, begin[some], end[some]) >= MARGIN).tolist():
            window = b" " + words.low[begin[some[k]]:end[some[k]]].tobytes() + b" "
            share = float(times[k]) / len(texts)
            for gram in {window[i:i + size] for i in range(len(window) - size + 1)}:
                held[gram] += share
    return held


def _prune(telling: list[bytes], ordinary_content: bytes, toxic: list[str], ordinary: list[str]) -> list[bytes]:
    """Without the pieces that shorten ordinary windows: one of their sequences hits ordinary documents too often."""
    size = min(GRAMS)
    distance = Distance(ordinary_content, toxic_dictionary(telling))
    bad, good = _hits_by_sequence(distance, ordinary, size), _hits_by_sequence(distance, toxic, size)
    spared = lambda w: all(bad[w[i:i + size]] <= SPARE * good[w[i:i + size]] for i in range(len(w) - size + 1))
    keep = {w for w in set(telling) if spared(w)}
    return [w for w in telling if w in keep]


def fit(rows: list[tuple[str, int]], ordinary_per_toxic: float | None = None) -> ToxicityModel | None:
    """Train on (text, label) rows, of which every third only sets the rates and the cut.

    ``ordinary_per_toxic`` is how many ordinary rows there are for a toxic one where the sample comes from; the cut is
    laid for that mixture.
    """
    rows = list(dict.fromkeys((t or "", int(y)) for t, y in rows))
    learn = [r for i, r in enumerate(rows) if i % 3] or rows
    held = [r for i, r in enumerate(rows) if i % 3 == 0] or rows
    toxic, ordinary = drop_copies([t for t, y in learn if y]), drop_copies([t for t, y in learn if not y])
    if not toxic or not ordinary or not any(y for _, y in held) or all(y for _, y in held):
        return None
    stride = -(-sum(map(len, ordinary)) // TRAINER_BYTES) or 1
    samples = []
    for text in ordinary:
        words = text.lower().encode().split()
        samples += [b" " + b" ".join(words[i:i + 8]) + b" " for i in range(0, len(words), 8 * stride)]
    telling = _telling_pieces(toxic, ordinary)
    base = ordinary_dictionary(samples)
    for _ in range(PRUNINGS):
        telling = telling and _prune(telling, base, toxic, ordinary)
    if not telling:
        return None
    model = ToxicityModel(base, toxic_dictionary(telling), (0.0, 0.0), 1.0, 0.0)
    distance = Distance(model.ordinary, model.toxic)
    parts = [count_hits(distance, data, offsets) for _, _, data, offsets in pieces(*_joined([t for t, _ in held]))]
    hits, windows = (np.concatenate(x) for x in zip(*parts, strict=True))
    labels = np.array([y for _, y in held], bool)
    low = (hits[~labels].sum() + 0.5) / (windows[~labels].sum() + 1)
    shown = labels & (hits > 0)
    high = max(10 * low, (hits[shown].sum() + 0.5) / (windows[shown].sum() + 1))
    model.rates = (float(low), float(min(high, 0.5)))
    x = model.evidence(hits, windows)
    order = np.argsort(-x, kind="stable")
    right, wrong = np.cumsum(labels[order]), np.cumsum(~labels[order])
    weight = 1.0 if ordinary_per_toxic is None else ordinary_per_toxic * labels.sum() / (~labels).sum()
    last = np.append(x[order][1:] != x[order][:-1], True)
    f1 = np.where(last, 2 * right / (right + weight * wrong + labels.sum()), -1)
    k = int(np.argmax(f1))
    below = x[x < x[order][k]]
    model.cut = float((x[order][k] + below.max()) / 2) if len(below) else float(x[order][k])
    model.slope = float(2.0 / max(1e-6, np.log(model.rates[1] / model.rates[0])))
    return model


def learning_rows(docs: DataFrame, labels: DataFrame, column: str, learn: Column, sample: int = SAMPLE_ROWS) -> list[tuple[str, int]]:
    """The bounded sample of labelled rows: by hash order, ``sample`` of each class at most.

    The ids go to the scan as a broadcast of at most 2 * ``sample`` rows, so the documents are not shuffled.
    """
    known = labels.where(learn).where(F.col(column).isNotNull() & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.max(column).alias("label"))
    ids = [known.where(F.col("label") == y).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample) for y in (0, 1)]
    texts = docs.select("doc_id", "text").where(F.octet_length(F.coalesce("text", F.lit(""))) <= SAMPLE_BYTES)
    found = texts.join(F.broadcast(ids[0].union(ids[1])), "doc_id")
    rows = found.orderBy(F.xxhash64("doc_id"), "doc_id", "text").limit(2 * sample).select("text", "label").collect()
    return [(r.text or "", r.label) for r in rows]


def score_documents(docs: DataFrame, model: ToxicityModel | None) -> DataFrame:
    """doc_id, hits, windows and score of every document."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        distance = Distance(model.ordinary, model.toxic) if model else None
        for batch in batches:
            data, offsets = text_bytes(batch.column("text"))
            parts = [count_hits(distance, p, o) if model else (np.zeros(e - b, np.int64),) * 2 for b, e, p, o in pieces(data, offsets)]
            hits, windows = (np.concatenate(x) for x in zip(*parts, strict=True)) if parts else (np.zeros(0, np.int64),) * 2
            scores = model.scores(hits, windows) if model else np.zeros(len(hits))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(hits), pa.array(windows), pa.array(scores)], ["doc_id", "hits", "windows", "score"])
    schema = T.StructType([docs.schema["doc_id"], T.StructField("hits", T.LongType()), T.StructField("windows", T.LongType()), T.StructField("score", T.DoubleType())])
    return docs.select("doc_id", "text").mapInArrow(run, schema)


def drop_toxic(docs: DataFrame, model: ToxicityModel | None) -> DataFrame:
    """The documents, with all their columns, that score below ``THRESHOLD``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        distance = Distance(model.ordinary, model.toxic)
        for batch in batches:
            data, offsets = text_bytes(batch.column("text"))
            parts = [model.scores(*count_hits(distance, p, o)) for _, _, p, o in pieces(data, offsets)]
            yield batch.filter(pa.array(np.concatenate(parts) < THRESHOLD)) if parts else batch
    return docs.mapInArrow(run, docs.schema) if model else docs


def held_out(modulus: int, rest: int) -> Column:
    return F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(modulus)) == rest


def fit_toxicity(docs: DataFrame, labels: DataFrame) -> ToxicityModel | None:
    """Train on the rows whose crc32(doc_id) mod 3 is not 1."""
    learn = ~held_out(3, 1)
    known = labels.where(learn).where("toxic IS NOT NULL AND doc_id IS NOT NULL").groupBy("doc_id").agg(F.max("toxic").alias("label"))
    counts = known.agg(F.count_if(F.col("label") == 0).alias("ordinary"), F.count_if(F.col("label") == 1).alias("toxic")).first()
    mixture = counts.ordinary / counts.toxic if counts.toxic else None
    return fit(learning_rows(docs, labels, "toxic", learn), mixture)


def toxicity_digest(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The contract's row per document."""
    return score_documents(docs, fit_toxicity(docs, labels)).select(
        "doc_id", F.coalesce(held_out(3, 1), F.lit(False)).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"), "hits", "windows")
