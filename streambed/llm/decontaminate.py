"""Benchmark decontamination: which documents hold windows of benchmark texts (Wu-Manber search).

An item's windows are its runs of 13 words; an item of fewer words is one window. All windows of
one length are searched together: a block of the window's last two words looks up how far the
search may skip; where it may not, the same block selects the few windows that end so. The
words' values thin these out and a direct comparison of the words' bytes decides. Documents are scanned where they are read; there is no
shuffle. The benchmark is cut into blocks of at most ``BLOCK_BYTES`` of text, each broadcast on its
own and searched in one more pass over the rows, so a large benchmark costs passes, not memory.

Defined cases: null or empty texts have no words and are never contaminated; items without words
or without id match nothing; repeated items count once; repeated documents are judged one by one;
all columns of the documents pass through, whatever their names.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from streambed.llm.hashing import Words, mix
from streambed.llm.shared import pieces, text_bytes

WINDOW_WORDS = 13
#: Bytes of benchmark text in one broadcast; a single longer item makes a block of its own.
BLOCK_BYTES = 16 << 20
#: Window starts that one lane of the search walks over.
LANE = 256
_STATE = T.StructType([T.StructField("hits", T.ArrayType(T.LongType())), T.StructField("items", T.ArrayType(T.StringType()))])


def _block_keys(left: np.ndarray, right: np.ndarray, bits: int) -> np.ndarray:
    return (mix(left * np.uint64(0x9FB21C651E98DF25) + right) >> np.uint64(64 - bits)).astype(np.int64)


class WuManber:
    """Search for many patterns of m symbols at once; symbols are 64-bit word values."""

    def __init__(self, patterns: np.ndarray):
        count, self.m = patterns.shape
        self.bits = max(12, min(24, int(count * self.m * 8).bit_length()))
        self.block = min(2, self.m)
        self.shift = np.full(1 << self.bits, self.m - self.block + 1, np.uint8 if self.m < 250 else np.int32)
        for end in range(self.block, self.m + 1):
            np.minimum.at(self.shift, self._keys_ending_at(patterns, end), self.m - end)
        suffix = self._keys_ending_at(patterns, self.m)
        self.order = np.argsort(suffix, kind="stable")
        self.suffix, self.patterns = suffix[self.order], patterns[self.order]

    def _keys_ending_at(self, rows: np.ndarray, end: int) -> np.ndarray:
        right = rows[:, end - 1]
        return _block_keys(rows[:, end - 2] if self.block == 2 else right, right, self.bits)

    def find(self, symbols: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places of the occurrences and the number of the pattern found at each.

        ``first`` are the symbol numbers at which the texts begin, and the end of the last.
        """
        m = self.m
        starts, last = first[:-1], first[1:] - m  # the window starts of a text: starts..last
        lanes = np.maximum(0, (last - starts) // LANE + 1)
        lanes[last < starts] = 0
        if not lanes.sum():
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        text = np.repeat(np.arange(len(starts)), lanes)
        nth = np.arange(len(text)) - np.repeat(np.cumsum(lanes) - lanes, lanes)
        at = starts[text] + nth * LANE
        stop = np.minimum(at + LANE - 1, last[text])
        right = symbols
        left = np.concatenate([symbols[:1], symbols[:-1]]) if self.block == 2 else symbols
        keys = _block_keys(left, right, self.bits)  # of the block that ends at each symbol
        shift = self.shift[keys].astype(np.int64)
        stopped = []
        while len(at):
            step = shift[at + m - 1]
            stopped.append(at[step == 0])
            at = at + np.maximum(step, 1)
            go = at <= stop
            at, stop = at[go], stop[go]
        place = np.sort(np.concatenate(stopped))
        low = np.searchsorted(self.suffix, keys[place + m - 1], "left")
        high = np.searchsorted(self.suffix, keys[place + m - 1], "right")
        places, found = [], []
        while len(place):
            go = low < high
            place, low, high = place[go], low[go], high[go]
            same = self.patterns[low, 0] == symbols[place]
            near, which = place[same], low[same]
            if len(near):
                full = (symbols[near[:, None] + np.arange(m)] == self.patterns[which]).all(axis=1)
                places.append(near[full])
                found.append(self.order[which[full]])
            low = low + 1
        if not places:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        return np.concatenate(places), np.concatenate(found)


def word_bytes(words: Words, first: int, count: int) -> tuple[list[int], bytes]:
    """What makes a run of words equal to another: their lengths and their bytes."""
    spans = list(zip(words.starts[first:first + count].tolist(), words.ends[first:first + count].tolist(), strict=True))
    return [e - b for b, e in spans], b"".join(words.low[b:e].tobytes() for b, e in spans)


class Benchmark:
    """One block of items: a searcher per window length, and per window its place in the items and their ids."""

    def __init__(self, items: list[tuple[str, str]]):
        texts = [text.encode() for _, text in items]
        offsets = np.cumsum([0, *map(len, texts)])
        self.words = words = Words(np.frombuffer(b"".join(texts), np.uint8), offsets, "alnum")
        windows: dict[int, dict[bytes, list[tuple[int, set[str]]]]] = defaultdict(dict)
        for k, (item, _) in enumerate(items):
            begin, end = int(words.first[k]), int(words.first[k + 1])
            m = min(WINDOW_WORDS, end - begin)
            for i in range(begin, end - m + 1) if m else ():
                alike = windows[m].setdefault(words.hashes[i:i + m].tobytes(), [])
                # Windows of equal values are one only if their words are.
                owners = next((o for at, o in alike if word_bytes(words, at, m) == word_bytes(words, i, m)), None)
                if owners is None:
                    alike.append((i, owners := set()))
                owners.add(item)
        self.searches = []
        for m, found in sorted(windows.items()):
            rows = [(key, at, sorted(owners)) for key, alike in found.items() for at, owners in alike]
            patterns = np.frombuffer(b"".join(key for key, _, _ in rows), np.uint64).reshape(-1, m)
            self.searches.append((WuManber(patterns), [at for _, at, _ in rows], [owners for _, _, owners in rows]))

    def _confirmed(self, words: Words, places: np.ndarray, patterns: np.ndarray, firsts: list[int], m: int) -> np.ndarray:
        """Which occurrences have the very words of their window."""
        known: dict[int, tuple[list[int], bytes]] = {}
        out = np.zeros(len(places), bool)
        for k, (place, pattern) in enumerate(zip(places.tolist(), patterns.tolist(), strict=True)):
            if pattern not in known:
                known[pattern] = word_bytes(self.words, firsts[pattern], m)
            out[k] = word_bytes(words, place, m) == known[pattern]
        return out

    def scan(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, dict[int, list[int]], dict[int, set[str]]]:
        """Words per text; for texts with occurrences the hit word ranges, flat, and the items."""
        words = Words(data, offsets, "alnum")
        hits: dict[int, list[int]] = {}
        items: dict[int, set[str]] = defaultdict(set)
        ranges = []
        for search, firsts, owners in self.searches:
            place, pattern = search.find(words.hashes, words.first)
            if len(place):
                real = self._confirmed(words, place, pattern, firsts, search.m)
                place, pattern = place[real], pattern[real]
                ranges.append((place, place + search.m))
                text = np.searchsorted(words.first, place, "right") - 1
                for t, p in set(zip(text.tolist(), pattern.tolist(), strict=True)):
                    items[t].update(owners[p])
        if ranges:
            marks = np.zeros(len(words.hashes) + 1, np.int64)
            for begin, end in ranges:
                np.add.at(marks, begin, 1)
                np.add.at(marks, end, -1)
            covered = np.cumsum(marks)[:-1] > 0
            edge = np.diff(np.concatenate([[0], covered.view(np.int8), [0]]))
            cuts = np.isin(np.arange(len(edge)), words.first)
            begins = np.flatnonzero((edge == 1) | (cuts & (np.concatenate([covered, [False]]))))
            ends = np.flatnonzero((edge == -1) | (cuts & (np.concatenate([[False], covered]))))
            text = np.searchsorted(words.first, begins, "right") - 1
            for t, b, e in zip(text.tolist(), begins.tolist(), ends.tolist(), strict=True):
                hits.setdefault(t, []).extend((b - int(words.first[t]), e - int(words.first[t])))
        return np.diff(words.first), hits, items


def _merged(ranges: list[int]) -> list[int]:
    """Union of flat word ranges."""
    out: list[int] = []
    for begin, end in sorted(zip(ranges[::2], ranges[1::2], strict=True)):
        if out and begin <= out[-1]:
            out[-1] = max(out[-1], end)
        else:
            out += [begin, end]
    return out


def _passes(docs: DataFrame, benchmark: DataFrame, finish, schema: T.StructType) -> DataFrame:
    """Scan the documents once per block of the benchmark; the last pass hands rows to ``finish``.

    ``finish(batch, n_words, hits, items)`` gets lists with one entry per row of the batch.
    """
    spark = docs.sparkSession
    held: list[list[tuple[str, str]]] = [[]]
    size = 0
    rows = benchmark.select(F.col("item_id").cast("string").alias("item"), "text").where("item_id IS NOT NULL AND text IS NOT NULL")
    shares = []
    for item, text in rows.toLocalIterator():
        if held[-1] and size + len(text) > BLOCK_BYTES:
            shares.append(spark.sparkContext.broadcast(held.pop()))
            held.append([])
            size = 0
        held[-1].append((item, text))
        size += len(text)
    shares.append(spark.sparkContext.broadcast(held.pop()))
    state = "scan_state"
    while state in docs.columns:
        state += "_"
    inner = T.StructType([*docs.schema.fields, T.StructField(state, _STATE)])

    def step(share, has_state: bool, last: bool):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            block = Benchmark(share.value)
            for batch in batches:
                data, offsets = text_bytes(batch.column("text"))
                counts, hits, items = [], [], []
                for begin, end, part, own in pieces(data, offsets):
                    n, h, i = block.scan(part, own)
                    counts += n.tolist()
                    hits += [h.get(k, []) for k in range(end - begin)]
                    items += [i.get(k, set()) for k in range(end - begin)]
                if has_state:
                    before = batch.column(state).to_pylist()
                    hits = [_merged(a["hits"] + b) if a["hits"] and b else a["hits"] or b for a, b in zip(before, hits, strict=True)]
                    items = [{*a["items"], *b} for a, b in zip(before, items, strict=True)]
                    batch = batch.drop_columns([state])
                if last:
                    yield finish(batch, counts, hits, items)
                else:
                    held = pa.array([{"hits": h, "items": sorted(i)} for h, i in zip(hits, items, strict=True)], pa.struct([("hits", pa.list_(pa.int64())), ("items", pa.list_(pa.string()))]))
                    yield pa.RecordBatch.from_arrays([*batch.columns, held], [*batch.schema.names, state])
        return run

    for k, share in enumerate(shares):
        last = k == len(shares) - 1
        docs = docs.mapInArrow(step(share, k > 0, last), schema if last else inner)
    return docs


def _hit_words(ranges: list[int]) -> int:
    return sum(ranges[1::2]) - sum(ranges[::2])


def find_benchmark(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Per document: doc_id, n_words, hit_ranges (word numbers, from and past), item_ids, contaminated."""
    def finish(batch, counts, hits, items):
        bad = [_hit_words(h) > 0 and 20 * _hit_words(h) >= n for n, h in zip(counts, hits, strict=True)]
        return pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(counts, pa.int64()), pa.array(hits, pa.list_(pa.int64())), pa.array([sorted(i) for i in items], pa.list_(pa.string())), pa.array(bad, pa.bool_())],
            ["doc_id", "n_words", "hit_ranges", "item_ids", "contaminated"])
    schema = T.StructType([docs.schema["doc_id"], T.StructField("n_words", T.LongType()), T.StructField("hit_ranges", T.ArrayType(T.LongType())), T.StructField("item_ids", T.ArrayType(T.StringType())), T.StructField("contaminated", T.BooleanType())])
    return _passes(docs.select("doc_id", "text"), benchmark, finish, schema)


def drop_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents, with all their columns, of whose words fewer than one in 20 stand in benchmark windows."""
    def finish(batch, counts, hits, items):
        return batch.filter(pa.array([not (_hit_words(h) > 0 and 20 * _hit_words(h) >= n) for n, h in zip(counts, hits, strict=True)], pa.bool_()))
    return _passes(docs, benchmark, finish, docs.schema)


def decontamination_digest(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The contract's row per document, from the operator's real output."""
    found = find_benchmark(docs, benchmark)
    hit = F.aggregate(F.transform("hit_ranges", lambda x, i: F.when(i % 2 == 1, x).otherwise(-x)), F.lit(0).cast("long"), lambda a, x: a + x)
    return found.select(
        "doc_id", "n_words", hit.alias("n_hit"), F.size("item_ids").cast("long").alias("n_items"),
        F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"), "contaminated")
