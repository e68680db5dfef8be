"""N-gram Jaccard join: rare-first prefixes meet, bounds thin them out, texts decide.

Documents are sets of distinct word shingles; two link at a Jaccard similarity of 0.75 or more. Equal sets are one
class from the start, so copies cost one name each.

1. One pass names each document's class and counts shingles into a sketch of fixed size (``SKETCH`` counters), the
   rare-first order: by counter, then by hash. Any order common to all documents gives right results; rare first gives few meetings.
2. Each class sends the prefix that a partner must share one shingle of, packed by hash bucket. The members of a shingle are
   cut where sizes are too far apart (length filter); a pair also where its first places leave too little
   (positional filter). What is left meets at a hub, the least member: every pair that shares a prefix shingle shares a hub.
3. Hubs get the texts of their members. A hub of more than ``HUB`` members is dealt to blocks that meet as pairs of blocks.
   Every similar pair is found (``find_pairs``): common shingles of all pairs of a part are counted at once, and a pair
   belongs to the least hub that both members have, so it is named once. Members carry their ``CARRY`` least hubs for that;
   pairs of a member that has more are made distinct afterwards.
   ``keep_one`` needs components only, so for it (``find_links``) pairs already connected within a hub are
   passed over, others are bounded by the sizes of parts of both sets (suffix filter) and verified at most once.
   There a hub of more than ``HUB`` members is dealt to salted parts that each hold the least member p. Members left unconnected
   to p then meet all members that could link to them: those whose distance to p is at most 0.25 less, as Jaccard
   distance is a metric. These meet as pairs of blocks.
4. The links of a document are those of its class, weighted with class sizes, and its copies. Connected components by least labels and pointer jumping, in Spark, each round written to the shared folder.

A task holds one hub part or pair of blocks; nothing of all documents reaches the driver but the sketch.

Defined cases: null and empty texts have no shingles and link with nothing; rows of one doc_id are one document for the
components, and its texts of different sets count each as a link; null ids are one id, smaller than all; an empty table gives no rows; extra columns pass through ``keep_one``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from streambed.llm.hashing import Words, mix, sequence_hashes
from streambed.llm.shared import buckets, materialize, pieces, text_bytes

SHINGLE_WORDS = 5
#: Similarity is at least OVER / UNDER.
OVER, UNDER = 3, 4
SKETCH = 1 << 20
#: Members of a hub that one task takes.
HUB = 2000
PACK_POSTINGS = 1 << 19
#: Least hubs of a member that tell which hub a pair belongs to.
CARRY = 64
#: Members of a part up to which pairs are tested one by one.
FEW = 8
#: Columns of a dense step, and postings of a sparse one, of counting common elements.
DENSE, SPARSE = 1 << 12, 1 << 22
#: Neighbours by size that a member of a shingle is bounded against; members of larger groups stay.
NEAR = 16
NULL_ID = -(1 << 63)
_POSTING = np.dtype([("shingle", "<u8"), ("node", "<i8"), ("size", "<u4"), ("place", "<u4")])


def shingle_sets(data: np.ndarray, offsets: np.ndarray) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text."""
    words = Words(data, offsets, "space")
    runs = sequence_hashes(words.hashes, SHINGLE_WORDS)
    out = []
    for a, b in zip(words.first[:-1].tolist(), words.first[1:].tolist(), strict=True):
        if b - a >= SHINGLE_WORDS:
            out.append(np.unique(runs[a:b - SHINGLE_WORDS + 1]))
        else:
            out.append(sequence_hashes(words.hashes[a:b], b - a) if b > a else np.zeros(0, np.uint64))
    return out


def node_of(shingles: np.ndarray) -> int:
    """The name of a set's class: equal for equal sets, whatever the order."""
    return int(np.add.reduce(mix(shingles ^ np.uint64(0x5851F42D4C957F2D))).astype(np.int64)) if len(shingles) else 0


def least_overlap(m: int, n: int) -> int:
    """Common shingles that sets of m and n need to link."""
    return -(-OVER * (m + n) // (OVER + UNDER))


def prefix_length(n: int) -> int:
    return n - -(-OVER * n // UNDER) + 1


def similar(a: np.ndarray, b: np.ndarray) -> bool:
    """Exact test of two sorted sets, after the length and suffix filters."""
    need = least_overlap(len(a), len(b))
    if min(len(a), len(b)) < need:
        return False
    if len(b) > 64:
        probes = b[len(b) // 4::len(b) // 4][:3]
        at = np.concatenate([[0], np.searchsorted(a, probes), [len(a)]])
        own = np.concatenate([[0], np.searchsorted(b, probes), [len(b)]])
        if np.minimum(np.diff(at), np.diff(own)).sum() < need:
            return False
    return overlap(a, b) >= need


def overlap(a: np.ndarray, b: np.ndarray) -> int:
    if not len(a):
        return 0
    place = np.searchsorted(a, b)
    return int((a[np.minimum(place, len(a) - 1)] == b).sum())


def name_classes(docs: DataFrame) -> tuple[DataFrame, np.ndarray]:
    """Step 1: (doc, key, n_shingles, node) of every row, and the frequency sketch."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(SKETCH, np.uint32)
        for batch in batches:
            data, offsets = text_bytes(batch.column("text"))
            sizes, nodes = [], []
            for _, _, part, own in pieces(data, offsets):
                sets = shingle_sets(part, own)
                sizes += [len(s) for s in sets]
                nodes += [node_of(s) for s in sets]
                if sets:
                    np.add.at(counts, (np.concatenate(sets) % np.uint64(SKETCH)).astype(np.int64), np.uint32(1))
            n = batch.num_rows
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc"), batch.column("key"), pa.array(sizes, pa.int64()), pa.array(nodes, pa.int64()), pa.nulls(n, pa.int32()), pa.nulls(n, pa.binary())],
                ["doc", "key", "n_shingles", "node", "part", "counts"])
        parts = np.minimum(counts, 65_535).astype("<u2").reshape(64, -1)
        none = pa.nulls(64, pa.int64())
        yield pa.RecordBatch.from_arrays([none, none, none, none, pa.array(range(64), pa.int32()), pa.array([p.tobytes() for p in parts], pa.binary())], ["doc", "key", "n_shingles", "node", "part", "counts"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for part, counts in zip(batch.column("part").to_pylist(), batch.column("counts"), strict=True):
                total[part] = total.get(part, 0) + np.frombuffer(counts.as_py(), "<u2").astype(np.int64)
        if total:
            yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int32()), pa.array([v.tobytes() for v in total.values()], pa.binary())], ["part", "counts"])

    rows = materialize(docs.select("doc", "key", "text").mapInArrow(run, "doc long, key long, n_shingles long, node long, part int, counts binary"), "classes")
    sums = rows.where("part IS NOT NULL").select("part", "counts").repartition(64, "part").mapInArrow(add, "part int, counts binary").collect()
    sketch = np.zeros((64, SKETCH // 64), np.int64)
    for r in sums:
        sketch[r.part] += np.frombuffer(r.counts, np.int64)
    return rows.where("part IS NULL").select("doc", "key", "n_shingles", "node"), np.minimum(sketch.ravel(), (1 << 32) - 1).astype(np.uint32)


def _groups(shingle: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Where members that can link begin anew: another shingle, or a size that is too far from the next smaller one."""
    return np.append(True, (shingle[1:] != shingle[:-1]) | (UNDER * size[:-1].astype(np.int64) < OVER * size[1:].astype(np.int64)))[:len(shingle)]


def find_meetings(docs: DataFrame, sketch: np.ndarray) -> DataFrame:
    """Step 2: distinct (hub, node) of classes that meet on a prefix shingle."""
    n = buckets(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(sketch)  # fixed size: SKETCH counters

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = shared.value
        held: list[np.ndarray] = []
        seen: set[int] = set()
        size = 0

        def flush() -> pa.RecordBatch:
            rows = np.concatenate(held)
            bucket = (rows["shingle"] % np.uint64(n)).astype(np.int64)
            order = np.argsort(bucket, kind="stable")  # a document's postings of a bucket stay together
            rows, bucket = rows[order], bucket[order]
            cut = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1]))
            parts = []
            for a, b in zip(cut.tolist(), np.append(cut[1:], len(rows)).tolist(), strict=True):
                some = rows[a:b]
                new = np.flatnonzero(np.append(True, some["node"][1:] != some["node"][:-1]))
                many = np.diff(np.append(new, len(some))).astype("<u4")
                head = len(new).to_bytes(4, "little") + some["node"][new].tobytes() + some["size"][new].tobytes() + many.tobytes()
                parts.append(head + some["shingle"].tobytes() + some["place"].tobytes())
            return pa.RecordBatch.from_arrays([pa.array(bucket[cut], pa.int32()), pa.array(parts, pa.binary())], ["bucket", "packed"])

        for batch in batches:
            data, offsets = text_bytes(batch.column("text"))
            for _, _, part, own in pieces(data, offsets):
                for shingles in shingle_sets(part, own):
                    if not len(shingles) or (node := node_of(shingles)) in seen:
                        continue
                    seen.add(node)
                    length = prefix_length(len(shingles))
                    many = counts[(shingles % np.uint64(SKETCH)).astype(np.int64)]
                    rows = np.empty(length, _POSTING)
                    rows["shingle"] = shingles[np.argsort(many, kind="stable")[:length]]
                    rows["node"], rows["size"], rows["place"] = node, len(shingles), np.arange(length)
                    held.append(rows)
                    size += length
                if size > PACK_POSTINGS:
                    yield flush()
                    held, size = [], 0
                    if len(seen) > 1_000_000:
                        seen.clear()
        if held:
            yield flush()

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blocks = []
        for batch in batches:
            for x in batch.column("packed"):
                data = x.as_py()
                k = int.from_bytes(data[:4], "little")
                node, at = np.frombuffer(data, "<i8", k, 4), 4 + 8 * k
                size, many = np.frombuffer(data, "<u4", k, at), np.frombuffer(data, "<u4", k, at + 4 * k)
                total = int(many.sum())
                rows = np.empty(total, _POSTING)
                rows["node"], rows["size"] = np.repeat(node, many), np.repeat(size, many)
                rows["shingle"] = np.frombuffer(data, "<u8", total, at + 8 * k)
                rows["place"] = np.frombuffer(data, "<u4", total, at + 8 * k + 8 * total)
                blocks.append(rows)
        if not blocks:
            return
        rows = np.concatenate(blocks)
        del blocks
        rows = rows[np.argsort(rows["shingle"], kind="stable")]
        same = np.append(False, rows["shingle"][1:] == rows["shingle"][:-1])
        rows = rows[same | np.append(same[1:], False)]  # shingles of one posting meet nobody
        rows = rows[np.lexsort((rows["node"], rows["size"], rows["shingle"]))]
        first = np.append(True, (rows["shingle"][1:] != rows["shingle"][:-1]) | (rows["node"][1:] != rows["node"][:-1]))[:len(rows)]
        rows = rows[first]
        begins = np.flatnonzero(_groups(rows["shingle"], rows["size"]))
        many = np.diff(np.append(begins, len(rows)))
        size, left = rows["size"].astype(np.int64), rows["size"].astype(np.int64) - rows["place"]
        group = np.repeat(np.arange(len(begins)), many)
        use = np.repeat(many > NEAR + 1, many)
        for d in range(1, min(NEAR, int(many.max(initial=1)) - 1) + 1):
            # Had the two met at an earlier shingle they would meet there; here what is left decides.
            need = -(-OVER * (size[:-d] + size[d:]) // (OVER + UNDER))
            may = (group[:-d] == group[d:]) & (np.minimum(left[:-d], left[d:]) >= need)
            use[:-d] |= may
            use[d:] |= may
        rows, group = rows[use], group[use]
        if not len(rows):
            return
        begins = np.flatnonzero(np.append(True, group[1:] != group[:-1]))
        group = np.repeat(np.arange(len(begins)), np.diff(np.append(begins, len(rows))))
        hub = np.minimum.reduceat(rows["node"], begins)[group]
        met = np.unique(np.stack([hub, rows["node"]], axis=1), axis=0)
        yield pa.RecordBatch.from_arrays([pa.array(met[:, 0], pa.int64()), pa.array(met[:, 1], pa.int64())], ["hub", "node"])

    blocks = docs.select("text").mapInArrow(emit, "bucket int, packed binary")
    return blocks.repartition(n, "bucket").mapInArrow(meet, "hub long, node long").distinct()


def join_part(nodes: list[int], sets: list[np.ndarray]) -> list[tuple[int, int]]:
    """Links that connect what is similar among a few sets; pairs already connected are passed over."""
    order = sorted(range(len(nodes)), key=lambda k: len(sets[k]))
    parent = list(range(len(nodes)))

    def root(k: int) -> int:
        while parent[k] != k:
            parent[k] = parent[parent[k]]
            k = parent[k]
        return k

    links, begin = [], 0
    for i, x in enumerate(order):
        while UNDER * len(sets[order[begin]]) < OVER * len(sets[x]):
            begin += 1
        mine = root(x)
        for y in order[begin:i]:
            if root(y) != mine and similar(sets[y], sets[x]):
                links.append((nodes[y], nodes[x]))
                parent[root(y)] = mine
    return links


def _of_part(rows: list[tuple[int, bytes]]) -> tuple[list[int], list[np.ndarray]]:
    held = dict(rows)
    data, offsets = text_bytes(pa.array(list(held.values()), pa.large_binary()))
    sets = [s for _, _, p, o in pieces(data, offsets) for s in shingle_sets(p, o)]
    return list(held), sets


def verify(parts: DataFrame, big: bool) -> DataFrame:
    """Links within each part (part, hub, node, text), and of big hubs the members with their distance to the hub.

    Rows: a, b of a link; or hub, node, distance, connected of a member.
    """
    schema = "a long, b long, hub long, node long, distance double, connected boolean"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, held, out = None, [], []

        def close() -> None:
            nodes, sets = _of_part(held)
            links = join_part(nodes, sets)
            out.extend((a, b, None, None, None, None) for a, b in links)
            if big:
                hub = last[1]
                near, more = {hub}, True
                while more:
                    more = False
                    for a, b in links:
                        if (a in near) != (b in near):
                            near |= {a, b}
                            more = True
                pivot = sets[nodes.index(hub)]
                for k, node in enumerate(nodes):
                    if node != hub:
                        both = overlap(pivot, sets[k])
                        out.append((None, None, hub, node, 1 - both / (len(pivot) + len(sets[k]) - both), node in near))

        def flush() -> pa.RecordBatch:
            nonlocal out
            columns = list(zip(*out, strict=True)) or [()] * 6
            out = []
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.int64(),) * 4 + (pa.float64(), pa.bool_()), strict=True)], ["a", "b", "hub", "node", "distance", "connected"])

        for batch in batches:
            for part, hub, node, text in zip(*(batch.column(c) for c in ("part", "hub", "node", "text")), strict=True):
                now = part.as_py(), hub.as_py()
                if now != last:
                    if held:
                        close()
                    last, held = now, []
                held.append((node.as_py(), (text.as_py() or "").encode()))
            yield flush()
        if held:
            close()
        yield flush()

    return parts.sortWithinPartitions("hub", "part").select("part", "hub", "node", "text").mapInArrow(run, schema)


def find_links(docs: DataFrame, classes: DataFrame, sketch: np.ndarray) -> DataFrame:
    """Steps 2 and 3: links (a, b) between classes, enough of them to connect all that are connected."""
    n = buckets(docs.sparkSession)
    met = materialize(find_meetings(docs, sketch), "meetings")
    sizes = met.groupBy("hub").agg(F.count("*").alias("members"))
    met = met.join(sizes, "hub").withColumn("parts", F.ceil(F.col("members") / HUB).cast("int"))
    one = classes.where("n_shingles > 0").groupBy("node").agg(F.min(F.struct("doc", "key")).alias("at")).select("node", "at.doc", "at.key")

    def with_text(rows: DataFrame) -> DataFrame:
        """One text of each class comes to the class's rows."""
        return rows.join(one, "node").join(docs.select("doc", "key", "text"), ["doc", "key"])

    salted = F.when(F.col("node") == F.col("hub"), F.sequence(F.lit(0), F.col("parts") - 1)).otherwise(F.array(F.pmod(F.xxhash64("node"), F.col("parts")).cast("int")))
    texts = with_text(met).withColumn("part", F.explode(salted)).where("members > 1")
    dealt = texts.repartition(n, "hub", "part")
    found = materialize(verify(dealt.where("parts = 1"), False).unionByName(verify(dealt.where("parts > 1"), True)), "links")
    links = found.where("a IS NOT NULL").select("a", "b")
    members = found.where("hub IS NOT NULL").select("hub", "node", "distance", "connected")
    nearest = members.where("NOT connected").groupBy("hub").agg(F.min("distance").alias("least"))
    reach = 1 - OVER / UNDER + 1e-9
    rest = members.join(nearest, "hub").where((F.col("distance") >= F.col("least") - reach) | ~F.col("connected"))
    counts = rest.groupBy("hub").agg(F.ceil(F.count("*") * 2 / HUB).cast("int").alias("blocks"))
    if counts.isEmpty():
        return links
    block = F.pmod(F.xxhash64("node", F.lit(7)), F.col("blocks")).cast("int")
    pairs = F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda k: F.least(k, F.col("block")) * F.col("blocks") + F.greatest(k, F.col("block")))
    rest = rest.join(counts, "hub").withColumn("block", block)
    again = with_text(rest).withColumn("part", F.explode(pairs)).repartition(n, "hub", "part")
    return links.unionByName(materialize(verify(again, False), "links").select("a", "b"))


def common(sets: list[np.ndarray]) -> np.ndarray:
    """How many elements each two of some sets share; the diagonal is of no use.

    Elements of many sets are counted by matrix products, the others by their pairs of holders.
    """
    m = len(sets)
    counts = np.zeros((m, m), np.int32)
    values, element, many = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    holder = np.repeat(np.arange(m), [len(x) for x in sets])
    often = many > max(4, m // 16)
    column = np.cumsum(often) - 1
    use = often[element]
    at, who = column[element[use]], holder[use]
    order = np.argsort(at, kind="stable")
    at, who = at[order], who[order]
    for a in range(0, int(often.sum()), DENSE):
        i, k = np.searchsorted(at, [a, a + DENSE])
        some = np.zeros((m, min(DENSE, int(often.sum()) - a)), np.float32)
        some[who[i:k], at[i:k] - a] = 1
        counts += (some @ some.T).astype(np.int32)
    use = ~often[element] & (many[element] > 1)
    order = np.argsort(element[use], kind="stable")
    element, holder = element[use][order], holder[use][order]
    held: list[np.ndarray] = []

    def add() -> None:
        nonlocal counts, held
        more = np.bincount(np.concatenate(held), minlength=m * m).reshape(m, m).astype(np.int32)
        counts += more + more.T
        held = []

    for d in range(1, int(many[~often].max(initial=1))):
        same = element[:-d] == element[d:]
        held.append(holder[:-d][same] * m + holder[d:][same])
        if sum(map(len, held)) > SPARSE:
            add()
    if held:
        add()
    return counts


def all_pairs(sets: list[np.ndarray]) -> np.ndarray:
    """Whether each two of some sets are similar, as a symmetric matrix; a set is not its own partner."""
    m = len(sets)
    if m <= FEW:
        found = np.zeros((m, m), bool)
        for i in range(m):
            for k in range(i):
                found[i, k] = found[k, i] = similar(sets[i], sets[k])
        return found
    size = np.array([len(x) for x in sets], np.int64)
    found = common(sets).astype(np.int64) * (OVER + UNDER) >= OVER * (size[:, None] + size[None, :])
    np.fill_diagonal(found, False)
    return found


def forest(found: np.ndarray) -> list[tuple[int, int]]:
    """Pairs of a symmetric matrix that connect all that it connects."""
    fresh = np.ones(len(found), bool)
    out = []
    for start in range(len(found)):
        if not fresh[start]:
            continue
        fresh[start] = False
        stack = [start]
        while stack:
            k = stack.pop()
            new = np.flatnonzero(found[k] & fresh)
            fresh[new] = False
            out += [(k, x) for x in new.tolist()]
            stack += new.tolist()
    return out


def _meet_all(parts: DataFrame) -> DataFrame:
    """Similar pairs of each part (part, hub, node, block, one, weight, hubs, many, text), on the row of one member.

    ``links`` sums the weights of a member's partners in ``partners`` of either row; pairs in ``again`` may be named
    by other hubs as well and are not in ``links``; ``tree`` connects what the pairs of the part connect.
    """
    schema = "node long, links long, partners array<long>, again array<long>, tree array<long>"

    def rows_of(hub: int, held: list[tuple]) -> list[tuple]:
        nodes, sets = _of_part([(x[0], x[5]) for x in held])
        about = {x[0]: x for x in held}
        block, one, weight, many = (np.array([about[k][c] for k in nodes]) for c in (1, 2, 3, 6))
        found = all_pairs(sets)
        if not one.all():  # two blocks meet: pairs within one are found where it meets itself
            found &= block[:, None] != block[None, :]
        lower = [np.array([h for h in about[k][4] if h < hub], np.int64) for k in nodes]
        if found.any() and any(map(len, lower)):
            found &= common(lower) == 0
        sure = found & ~(many[:, None] | many[None, :])
        links = sure @ weight
        tree: dict[int, list[int]] = {}
        for i, k in forest(found):
            tree.setdefault(i, []).append(nodes[k])
        names = np.array(nodes, np.int64)
        out = []
        for i in np.flatnonzero(found.any(axis=1)).tolist():
            mine, open_ = names[i + 1:][sure[i, i + 1:]], names[i + 1:][(found & ~sure)[i, i + 1:]] if many.any() else names[:0]
            out.append((nodes[i], int(links[i]), mine, open_, tree.get(i, [])))
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, held, out = None, [], []

        def flush() -> pa.RecordBatch:
            nonlocal out
            columns = list(zip(*out, strict=True)) or [()] * 5
            out = []
            lists = pa.list_(pa.int64())
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int64(), lists, lists, lists), strict=True)], ["node", "links", "partners", "again", "tree"])

        for batch in batches:
            for part, hub, node, block, one, weight, hubs, many, text in zip(*(batch.column(c) for c in ("part", "hub", "node", "block", "one", "weight", "hubs", "many", "text")), strict=True):
                now = part.as_py(), hub.as_py()
                if now != last:
                    if held:
                        out += rows_of(last[1], held)
                        if len(out) > HUB:
                            yield flush()
                    last, held = now, []
                held.append((node.as_py(), block.as_py(), one.as_py(), weight.as_py(), hubs.as_py(), (text.as_py() or "").encode(), many.as_py()))
        if held:
            out += rows_of(last[1], held)
        yield flush()

    return parts.sortWithinPartitions("hub", "part").select("part", "hub", "node", "block", "one", "weight", "hubs", "many", "text").mapInArrow(run, schema)


def find_pairs(docs: DataFrame, classes: DataFrame, sketch: np.ndarray) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Steps 2 and 3 for all pairs: every similar pair (a, b) of classes once, those (a, b) of them that connect all that is
    connected, and (node, links) of the classes that have partners: the documents in them."""
    n = buckets(docs.sparkSession)
    met = materialize(find_meetings(docs, sketch), "meetings")
    sizes = met.groupBy("hub").agg(F.count("*").alias("members")).where("members > 1")
    carried = met.groupBy("node").agg(F.sort_array(F.collect_list("hub")).alias("hubs")).select("node", F.slice("hubs", 1, CARRY).alias("hubs"), (F.size("hubs") > CARRY).alias("many"))
    held = classes.where("n_shingles > 0").groupBy("node", "doc").agg(F.min("key").alias("key"))
    one = materialize(held.groupBy("node").agg(F.min(F.struct("doc", "key")).alias("at"), F.count("*").alias("weight")).select("node", "at.doc", "at.key", "weight"), "weights")
    blocks = F.when(F.col("members") > HUB, F.ceil(F.col("members") * 2 / HUB)).otherwise(1).cast("int")
    dealt = met.join(sizes, "hub").join(carried, "node").withColumn("blocks", blocks).withColumn("block", F.pmod(F.xxhash64("node", F.lit(7)), F.col("blocks")).cast("int"))
    texts = dealt.join(one, "node").join(docs.select("doc", "key", "text").dropDuplicates(["doc", "key"]), ["doc", "key"])
    pairs = F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda k: F.least(k, F.col("block")) * F.col("blocks") + F.greatest(k, F.col("block")))
    parts = texts.withColumn("part", F.explode(pairs)).withColumn("one", F.expr("part div blocks = part % blocks"))
    found = materialize(_meet_all(parts.repartition(n, "hub", "part")), "pairs")
    order = [F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")]
    again = materialize(found.where("size(again) > 0").select(F.col("node").alias("a"), F.explode("again").alias("b")).select(*order).distinct(), "pairs")
    pairs = found.select(F.col("node").alias("a"), F.explode("partners").alias("b")).select(*order).unionByName(again)
    other = one.select(F.col("node").alias("b"), F.col("weight").alias("links"))
    ways = again.unionByName(again.select(F.col("b").alias("a"), F.col("a").alias("b")))
    links = found.select("node", "links").unionByName(ways.join(other, "b").select(F.col("a").alias("node"), "links")).groupBy("node").agg(F.sum("links").alias("links"))
    return pairs, found.select(F.col("node").alias("a"), F.explode("tree").alias("b")), links


def components(links: DataFrame) -> DataFrame:
    """Least reachable id of every linked id: (id, component)."""
    edges = materialize(links.select(F.col("a").alias("id"), F.col("b").alias("other")).where("id <> other").unionByName(links.select(F.col("b").alias("id"), F.col("a").alias("other")).where("id <> other")).distinct(), "edges")
    labels = materialize(edges.groupBy("id").agg(F.min("other").alias("other")).select("id", F.least("id", "other").alias("component")), "labels")
    while True:
        theirs = labels.select(F.col("id").alias("other"), F.col("component").alias("offer"))
        offers = edges.join(theirs, "other").groupBy("id").agg(F.min("offer").alias("offer"))
        better = labels.join(offers, "id").select("id", "component", F.least("component", "offer").alias("next"))
        jump = labels.select(F.col("id").alias("next"), F.col("component").alias("beyond"))
        moved = materialize(better.join(jump, "next").select("id", "component", F.least("next", "beyond").alias("next")), "labels")
        labels = moved.select("id", F.col("next").alias("component"))
        if moved.where("next < component").isEmpty():
            return labels


def _named(docs: DataFrame) -> DataFrame:
    return docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(NULL_ID)).alias("doc"), F.xxhash64(F.coalesce("text", F.lit(""))).alias("key"), F.coalesce("text", F.lit("")).alias("text"))


def _labelled(classes: DataFrame, links: DataFrame) -> DataFrame:
    """The rows of ``classes`` with the component that ``links`` between classes give their document."""
    least = classes.where("n_shingles > 0").groupBy("node").agg(F.min("doc").alias("least"))
    ids = links.join(least.select(F.col("node").alias("a"), F.col("least").alias("x")), "a").join(least.select(F.col("node").alias("b"), F.col("least").alias("y")), "b")
    found = components(ids.select(F.col("x").alias("a"), F.col("y").alias("b")))
    # Rows of one id are one document: its classes share a component.
    whole = least.join(found, F.col("least") == F.col("id"), "left").select("node", F.coalesce("component", "least").alias("component"))
    return classes.join(whole, "node", "left").withColumn("component", F.coalesce("component", "doc"))


def _real(column: str) -> Column:
    return F.when(F.col(column) != NULL_ID, F.col(column))


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id and n_links, the number of other documents that link with it, of every row."""
    named = _named(docs)
    classes, sketch = name_classes(named)
    _, tree, links = find_pairs(named, classes, sketch)
    copies = classes.where("n_shingles > 0").groupBy("node", "doc").count().groupBy("node").agg((F.count("*") - 1).alias("copies"))
    rows = _labelled(classes, tree).join(copies, "node", "left").join(links, "node", "left")
    n_links = F.when(F.col("n_shingles") > 0, F.col("copies") + F.coalesce("links", F.lit(0))).otherwise(0)
    return rows.select(_real("doc").alias("doc_id"), "n_shingles", _real("component").alias("component_id"), n_links.alias("n_links"))


def similar_pairs(docs: DataFrame) -> DataFrame:
    """Every pair (a, b), a < b, of ids of documents that link, once; copies make as many pairs as they are."""
    named = _named(docs)
    classes, sketch = name_classes(named)
    pairs, _, _ = find_pairs(named, classes, sketch)
    held = classes.where("n_shingles > 0").select("node", "doc").distinct()
    x, y = (held.select(F.col("node").alias(c), F.col("doc").alias(d)) for c, d in (("a", "x"), ("b", "y")))
    both = pairs.join(x, "a").join(y, "b").select("x", "y").unionByName(x.join(y, F.col("a") == F.col("b")).select("x", "y"))
    return both.where("x <> y").select(F.least("x", "y").alias("x"), F.greatest("x", "y").alias("y")).distinct().select(_real("x").alias("a"), _real("y").alias("b"))


def keep_one(docs: DataFrame) -> DataFrame:
    """The documents, with all their columns, that are the least of their component."""
    named = _named(docs)
    classes, sketch = name_classes(named)
    rows = _labelled(classes, find_links(named, classes, sketch))
    go = rows.where("doc <> component").select(_real("doc").alias("doc_id")).distinct()
    return docs.join(go, "doc_id", "left_anti").select(*docs.columns)
