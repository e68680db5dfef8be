"""Repeated-passage removal: longest-previous-factor arrays over the suffixes that can repeat.

A byte goes if a string of ``length`` bytes that covers it also starts earlier (in a smaller doc_id, or before in
the same document), judged on the input. A full suffix array of the corpus would move every byte a
hundred times; here only suffixes that may have an earlier match are sorted:

1. Of the hashed ``GRAM``-byte windows of any ``length``-byte string the least is its anchor. Equal strings have
   equal anchors at the same place, so anchors split the starts of a document into runs. A run is the bytes
   from its first start to the end of its last string. Tasks merge equal runs before the shuffle.
2. Anchors meet in hash buckets. Of equal runs all but the first are removed whole. Runs of an anchor with other
   runs are asked for.
3. The asked runs' bytes meet by anchor. Their starts, cut at ``length`` bytes, are put in suffix order; the previous and next
   smaller position in that order are the two candidates for an earlier match, and the longer common prefix is
   the longest previous factor, of which only "``length`` or more" matters. An anchor with more than ``HOT_RUNS``
   different runs is dealt by the hash of each start's string instead, so no anchor gathers in one task.
4. The marked starts come back to their documents and cover bytes.

Documents are shuffled once, by id; everything else is packed places and the asked runs.

Defined cases: null and short texts lose nothing; null ids come first; of rows with equal id and different text the order is
that of a hash of the text; rows equal in both are one document and lose the same bytes; an
empty table gives no rows; texts without their UTF-8 borders in the cleaned form lose the broken character; extra columns pass through
``drop_repeats`` untouched.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from streambed.llm.hashing import Windows
from streambed.llm.shared import buckets, materialize, pieces, text_bytes

LENGTH = 100
GRAM = 40
#: Different runs of one anchor beyond which its starts are dealt one by one.
HOT_RUNS = 4096
#: Anchors or run bytes that a task packs before it passes them on.
PACK_ANCHORS = 1 << 20
PACK_BYTES = 8 << 20
#: Starts that are sorted at once, about.
SORT_STARTS = 100_000
#: A longer document is cut into parts that overlap by a string.
PART_BYTES = 4 << 20
NULL_ID = -(1 << 63)
_ANCHOR = np.dtype([("anchor", "<u8"), ("run", "<u8"), ("doc", "<i8"), ("key", "<i8"), ("start", "<u4"), ("count", "u1")])
#: Places of a document: starts that are marked (state 0) or asked for (1, or 2 one by one).
_MARK = np.dtype([("start", "<u4"), ("group", "<u4"), ("count", "u1"), ("state", "u1")])


def _sliding_least(values: np.ndarray, width: int) -> np.ndarray:
    have, least = 1, values
    while have * 2 <= width:
        least = np.minimum(least[:-have], least[have:])
        have *= 2
    rest = width - have
    return np.minimum(least[:-rest], least[rest:]) if rest else least


def runs_of(data: np.ndarray, offsets: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
    """Anchor hash, run hash, first start and number of starts of each run of a few texts."""
    gram = min(GRAM, length)
    if len(data) < length:
        none = np.zeros(0, np.int64)
        return none.astype(np.uint64), none.astype(np.uint64), none, none
    windows = Windows(data)
    grams = windows.all(gram)
    low = np.uint64(0xFFFFFFFF)
    least = _sliding_least((grams & ~low) | np.arange(len(grams), dtype=np.uint64), length - gram + 1)
    anchor = (least & low).astype(np.int64)
    whole = np.arange(len(anchor)) + length <= np.repeat(offsets[1:], np.diff(offsets))[:len(anchor)]
    change = np.append(True, (anchor[1:] != anchor[:-1]) | ~whole[:-1])
    first = np.flatnonzero(whole & change)
    last = np.flatnonzero(whole & np.append(change[1:] | ~whole[1:], True))
    return grams[anchor[first]], windows.of(first, last + length), first, last - first + 1


def _anchors(ids: np.ndarray, keys: np.ndarray, data: np.ndarray, offsets: np.ndarray, length: int) -> Iterator[np.ndarray]:
    for begin, end, part, own in pieces(data, offsets):
        step = PART_BYTES if end - begin == 1 else max(1, len(part))
        for at in range(0, max(1, len(part)), step):
            some = part[at:at + step + length - 1]
            places = own if step >= len(part) else np.array([0, len(some)])
            anchor, run, first, count = runs_of(some, places, length)
            row = begin + np.searchsorted(places, first, "right") - 1
            out = np.empty(len(first), _ANCHOR)
            out["anchor"], out["run"], out["doc"], out["key"], out["count"] = anchor, run, ids[row], keys[row], count
            out["start"] = first - places[row - begin] + at
            yield out


def _sorted_runs(held: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows by anchor, run and place; where an anchor begins, and whether an equal run stands earlier."""
    held = held[np.lexsort((held["start"], held["key"], held["doc"], held["run"], held["anchor"]))]
    new_anchor = np.append(True, held["anchor"][1:] != held["anchor"][:-1])[:len(held)]
    new_run = new_anchor | np.append(True, held["run"][1:] != held["run"][:-1])[:len(held)]
    lead = held[np.flatnonzero(new_run)[np.cumsum(new_run) - 1]] if len(held) else held
    same = (lead["doc"] == held["doc"]) & (lead["key"] == held["key"]) & (lead["start"] == held["start"])
    return held, new_anchor, ~same


def _marks(rows: np.ndarray, state) -> np.ndarray:
    out = np.empty(len(rows), _MARK)
    out["start"], out["count"], out["state"] = rows["start"], rows["count"], state
    out["group"] = rows["anchor"].astype(np.uint32) if "anchor" in rows.dtype.names else 0
    return out


def _by_document(docs: np.ndarray, keys: np.ndarray, marks: np.ndarray) -> tuple[list, list, list, list]:
    """One packed value per document: id, key, marks, whether any is asked for."""
    order = np.lexsort((marks["start"], keys, docs))
    docs, keys, marks = docs[order], keys[order], marks[order]
    cut = np.flatnonzero(np.append(True, (docs[1:] != docs[:-1]) | (keys[1:] != keys[:-1]))[:len(docs)])
    ends = np.append(cut[1:], len(docs))[:len(cut)]
    asks = np.maximum.reduceat(marks["state"], cut) > 0 if len(cut) else np.zeros(0, bool)
    return docs[cut].tolist(), keys[cut].tolist(), [marks[a:b].tobytes() for a, b in zip(cut.tolist(), ends.tolist(), strict=True)], asks.tolist()


_PACKED = "bucket int, doc long, key long, packed binary, asks boolean"


def _packed(bucket: list, doc: list, key: list, packed: list, asks: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(bucket, pa.int32()), pa.array(doc, pa.int64()), pa.array(key, pa.int64()), pa.array(packed, pa.binary()), pa.array(asks, pa.bool_())],
        ["bucket", "doc", "key", "packed", "asks"])


def _split(rows: np.ndarray, bucket: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    order = np.argsort(bucket, kind="stable")
    rows, bucket = rows[order], bucket[order]
    cut = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1])[:len(bucket)])
    for a, b in zip(cut.tolist(), np.append(cut[1:], len(bucket))[:len(cut)].tolist(), strict=True):
        yield int(bucket[a]), rows[a:b]


def _columns(block: np.ndarray) -> bytes:
    """Field by field: neighbours are alike, so the shuffle's compression finds more."""
    return b"".join(np.ascontiguousarray(block[n]).tobytes() for n in block.dtype.names)


def _rows(data: bytes, kind: np.dtype) -> np.ndarray:
    n, at = len(data) // kind.itemsize, 0
    out = np.empty(n, kind)
    for name in kind.names:
        field = kind[name]
        out[name] = np.frombuffer(data, field, n, at)
        at += n * field.itemsize
    return out


def find_runs(docs: DataFrame, length: int) -> DataFrame:
    """Steps 1 and 2: packed marks of documents (doc, key, packed, asks)."""
    n = buckets(docs.sparkSession)

    def pack(held: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        rows, _, again = _sorted_runs(np.concatenate(held))
        doc, key, packed, asks = _by_document(rows["doc"][again], rows["key"][again], _marks(rows[again], 0))
        if doc:
            yield _packed([-1 - (d ^ k) % n for d, k in zip(doc, key, strict=True)], doc, key, packed, asks)
        rows = rows[~again]
        blocks = list(_split(rows, (rows["anchor"] % np.uint64(n)).astype(np.int64)))
        yield _packed([b for b, _ in blocks], [0] * len(blocks), [0] * len(blocks), [_columns(x) for _, x in blocks], [False] * len(blocks))

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            data, offsets = text_bytes(batch.column("text"))
            ids, keys = batch.column("doc").to_numpy(), batch.column("key").to_numpy()
            for found in _anchors(ids, keys, data, offsets, length):
                held.append(found)
                size += len(found)
                if size >= PACK_ANCHORS:
                    yield from pack(held)
                    held, size = [], 0
        if size:
            yield from pack(held)

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blocks = []
        for batch in batches:
            known = pa.array(batch.column("bucket").to_numpy() < 0)
            if known.true_count:
                yield batch.filter(known)
            blocks += [_rows(x.as_py(), _ANCHOR) for x, k in zip(batch.column("packed"), known, strict=True) if not k.as_py()]
        if not blocks:
            return
        rows, new_anchor, again = _sorted_runs(np.concatenate(blocks))
        group = np.cumsum(new_anchor) - 1
        new_run = np.append(True, (rows["run"][1:] != rows["run"][:-1]))[:len(rows)] | new_anchor
        kinds = np.bincount(group, new_run)[group]
        state = np.where(again, 0, np.where(kinds > HOT_RUNS, 2, 1))
        keep = again | (new_run & (kinds > 1))
        doc, key, packed, asks = _by_document(rows["doc"][keep], rows["key"][keep], _marks(rows[keep], state[keep]))
        if doc:
            yield _packed([0] * len(doc), doc, key, packed, asks)

    blocks = docs.select("doc", "key", "text").mapInArrow(emit, _PACKED)
    return blocks.repartition(n, "bucket").mapInArrow(meet, _PACKED).drop("bucket")


def previous_smaller(rank: np.ndarray) -> np.ndarray:
    """For each place the nearest place before it with a smaller rank, or -1.

    All places jump at once; what lies between a place and its candidate is never smaller.
    """
    at = np.arange(len(rank)) - 1
    open_ = np.flatnonzero((at >= 0) & (rank[at] >= rank))
    while len(open_):
        at[open_] = at[at[open_]]
        open_ = open_[at[open_] >= 0]
        open_ = open_[rank[at[open_]] >= rank[open_]]
    return at


def earlier_matches(strings: np.ndarray, rank: np.ndarray) -> np.ndarray:
    """Which of the suffixes, all cut at one length, have an earlier match of that length (LPF is full).

    In suffix order, the previous and next suffix of smaller position have the longest common prefixes with a suffix
    among all earlier ones.
    """
    order = np.argsort(strings, kind="stable")
    placed, text = rank[order], strings[order]
    before = previous_smaller(placed)
    after = len(placed) - 1 - previous_smaller(placed[::-1])[::-1]
    full = (before >= 0) & (text[np.maximum(before, 0)] == text)
    full |= (after < len(placed)) & (text[np.minimum(after, len(placed) - 1)] == text)
    out = np.zeros(len(rank), bool)
    out[order] = full
    return out


_RUN = np.dtype([("doc", "<i8"), ("key", "<i8"), ("start", "<u4"), ("group", "<u4"), ("count", "u1")])


def _run_block(rows: np.ndarray, texts: list[bytes]) -> bytes:
    return len(rows).to_bytes(4, "little") + _columns(rows) + b"".join(texts)


def match_runs(asked: DataFrame, length: int, n: int) -> DataFrame:
    """Step 3: asked runs (doc, key, text, marks) to packed marks of documents."""
    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        texts: list[bytes] = []
        seen: dict[int, tuple] = {}
        size = 0

        def flush() -> pa.RecordBatch:
            nonlocal rows, texts, size
            table = np.array(rows, _RUN)
            where = table["group"] % np.uint32(n)
            found = []
            for b in np.unique(where).tolist():
                mine = np.flatnonzero(where == b)
                found.append((int(b), _run_block(table[mine], [texts[k] for k in mine.tolist()])))
            rows, texts, size = [], [], 0
            return _packed([b for b, _ in found], [0] * len(found), [0] * len(found), [x for _, x in found], [False] * len(found))

        for batch in batches:
            done: list[tuple] = []
            for doc, key, text, packed in zip(*(batch.column(c) for c in ("doc", "key", "text", "marks")), strict=True):
                doc, key, data = doc.as_py(), key.as_py(), text.as_py().encode()
                marks = np.frombuffer(b"".join(packed.as_py()), _MARK)
                for start, group, count, state in marks[marks["state"] > 0].tolist():
                    if state == 1:
                        rows.append((doc, key, start, group, count))
                        texts.append(data[start:start + count - 1 + length])
                        size += count + length
                        continue
                    for at in range(start, start + count):  # a hot anchor: each string by its own hash, once per task
                        string = data[at:at + length]
                        name = int.from_bytes(hashlib.blake2b(string, digest_size=8).digest(), "little")
                        place, old = (doc, key, at), seen.get(name)
                        if old is None or place < old:
                            seen[name] = place
                            rows.append((doc, key, at, name & 0xFFFFFFFF, 1))
                            texts.append(string)
                            size += length
                            place = old
                        if place is not None and place != seen[name]:
                            done.append(place)
                if size > PACK_BYTES:
                    yield flush()
                if len(seen) > 1_000_000:
                    seen.clear()
            if done:
                table = np.array([(d, k, s, 0, 1) for d, k, s in done], _RUN)
                doc, key, packed, asks = _by_document(table["doc"], table["key"], _marks(table, 0))
                yield _packed([-1 - (d ^ k) % n for d, k in zip(doc, key, strict=True)], doc, key, packed, asks)
        if rows:
            yield flush()

    def sort_runs(table: np.ndarray, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        order = np.lexsort((table["start"], table["key"], table["doc"]))
        table, texts = table[order], [texts[k] for k in order.tolist()]
        count = table["count"].astype(np.int64)
        data = np.frombuffer(b"".join(texts), np.uint8)
        sizes = count + length - 1
        nth = np.arange(int(count.sum())) - np.repeat(np.cumsum(count) - count, count)
        places = np.repeat(np.cumsum(sizes) - sizes, count) + nth
        strings = np.ascontiguousarray(np.lib.stride_tricks.sliding_window_view(data, length)[places]).view(f"V{length}").ravel().view(f"S{length}")
        starts = np.empty(len(places), _RUN)
        starts["doc"], starts["key"], starts["count"] = np.repeat(table["doc"], count), np.repeat(table["key"], count), 1
        starts["start"] = np.repeat(table["start"], count) + nth.astype(np.uint32)
        by = np.lexsort((starts["start"], starts["key"], starts["doc"]))
        starts, strings = starts[by], strings[by]
        same = np.append(False, (starts["doc"][1:] == starts["doc"][:-1]) & (starts["key"][1:] == starts["key"][:-1]) & (starts["start"][1:] == starts["start"][:-1]))
        found = starts[earlier_matches(strings, np.cumsum(~same))]
        return found["doc"], found["key"], _marks(found, 0)

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables, texts = [], []
        for batch in batches:
            known = pa.array(batch.column("bucket").to_numpy() < 0)
            if known.true_count:
                yield batch.filter(known)
            for x, k in zip(batch.column("packed"), known, strict=True):
                if not k.as_py():
                    data = x.as_py()
                    end = 4 + int.from_bytes(data[:4], "little") * _RUN.itemsize
                    tables.append(_rows(data[4:end], _RUN))
                    at = end + np.concatenate([[0], np.cumsum(tables[-1]["count"].astype(np.int64) + length - 1)])
                    texts += [data[a:b] for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)]
        if not tables:
            return
        table = np.concatenate(tables)
        parts = max(1, int(table["count"].sum(dtype=np.int64)) // SORT_STARTS)
        where = (table["group"].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(40)) % np.uint64(parts)
        for _, mine in _split(np.arange(len(table)), where.astype(np.int64)):
            doc, key, marks = sort_runs(table[mine], [texts[k] for k in mine.tolist()])
            out = _by_document(doc, key, marks)
            if out[0]:
                yield _packed([0] * len(out[0]), *out)

    blocks = asked.mapInArrow(emit, _PACKED)
    return blocks.repartition(n, "bucket").mapInArrow(meet, _PACKED).select("doc", "key", "packed")


def _covered(size: int, packed: list[bytes], length: int) -> np.ndarray:
    """Which bytes of a document are removed."""
    marks = np.frombuffer(b"".join(packed), _MARK)
    marks = marks[marks["state"] == 0]
    edge = np.zeros(size + 1, np.int32)
    np.add.at(edge, marks["start"], 1)
    np.add.at(edge, marks["start"].astype(np.int64) + marks["count"] - 1 + length, -1)
    return np.cumsum(edge)[:-1] > 0


def _identified(docs: DataFrame) -> DataFrame:
    text = F.coalesce("text", F.lit(""))
    return docs.withColumn("doc", F.coalesce(F.col("doc_id").cast("long"), F.lit(NULL_ID))).withColumn("key", F.xxhash64(text))


def find_repeats(docs: DataFrame, length: int = LENGTH) -> tuple[DataFrame, Column]:
    """The documents joined with all marks of theirs, as arrays ``marks`` and ``late``."""
    spark = docs.sparkSession
    named = _identified(docs)
    text = named.select("doc", "key", F.coalesce("text", F.lit("")).alias("text"))
    runs = materialize(find_runs(text, length), "runs")
    marks = runs.groupBy("doc", "key").agg(F.collect_list("packed").alias("marks"), F.max("asks").alias("asks"))
    asked = named.join(marks, ["doc", "key"], "left").where(F.coalesce("asks", F.lit(False)))
    late = match_runs(asked.select(*named.columns, "marks"), length, buckets(spark))  # all columns, so that the joins share one shuffle of the documents
    late = late.groupBy("doc", "key").agg(F.collect_list("packed").alias("late"))
    nothing = F.array().cast("array<binary>")
    joined = named.join(marks, ["doc", "key"], "left").join(late, ["doc", "key"], "left")
    return joined, F.concat(F.coalesce("marks", nothing), F.coalesce("late", nothing))


def repeats_digest(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """The contract's row per document."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for text, packed in zip(batch.column("text"), batch.column("marks"), strict=True):
                data, packed = (text.as_py() or "").encode(), packed.as_py()
                if packed:
                    gone = _covered(len(data), packed, length)
                    spans = int((np.diff(np.concatenate([[0], gone.view(np.int8)])) == 1).sum())
                    kept = np.frombuffer(data, np.uint8)[~gone].tobytes()
                else:
                    spans, kept = 0, data
                out.append((len(data), len(data) - len(kept), spans, hashlib.sha256(kept).hexdigest()))
            columns = list(zip(*out, strict=True)) or [()] * 4
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *(pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int64(), pa.int64(), pa.string()), strict=True))],
                ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])
    joined, marks = find_repeats(docs.select("doc_id", "text"), length)
    return joined.select("doc_id", "text", marks.alias("marks")).mapInArrow(run, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")


def drop_repeats(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """The documents, with all their columns, without repeated passages; n_chars, if there, is counted anew.

    Documents of which nothing is left go.
    """
    inner = {c: f"own_{k}" for k, c in enumerate(docs.columns) if c not in ("doc_id", "text")}
    plain = docs.withColumnsRenamed(inner)
    joined, marks = find_repeats(plain, length)
    rows = joined.select(*plain.columns, marks.alias("marks_all"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out, keep = [], []
            for text, packed in zip(batch.column("text"), batch.column("marks_all"), strict=True):
                text, packed = text.as_py(), packed.as_py()
                if packed:
                    data = text.encode()
                    text = np.frombuffer(data, np.uint8)[~_covered(len(data), packed, length)].tobytes().decode(errors="ignore")
                out.append(text)
                keep.append(not packed or bool(text))
            cleaned = batch.set_column(batch.schema.get_field_index("text"), "text", pa.array(out, batch.schema.field("text").type))
            yield cleaned.drop_columns(["marks_all"]).filter(pa.array(keep, pa.bool_()))

    out = rows.mapInArrow(run, T.StructType(rows.schema.fields[:-1])).withColumnsRenamed({v: k for k, v in inner.items()})
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return out.select(*docs.columns)
