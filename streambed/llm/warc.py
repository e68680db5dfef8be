"""WARC archives and their merged capture index.

Writing: pages become WARC/1.1 records with built-in functions; Spark's text sink writes them as
gzip files, with the end of a record as its line separator, so archives can be on any file system Spark
reaches. Of records with equal payloads the one of the largest page id is the response, the
others are revisits that name it. The choice is made on digests, before a payload moves.

Reading: each archive is parsed by its lengths and checked against its digests, and gives a run
of index entries sorted by URL key, time and page id. Entries are dealt to key ranges; a range is the
k-way merge of its runs' slices by a loser tree, so the ranges in order are one global index. Ranges
are of (key, time, page id), so the captures of one frequent URL can spread over several.

Defined cases: null html is an empty payload; null URLs are empty; a page without id is always a
response; repeated rows of the largest id are responses each; an empty table writes no records and
reads none; extra columns are not read.
"""

from __future__ import annotations

import base64
import hashlib
import zlib
from collections.abc import Iterator
from urllib.parse import urlsplit

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from streambed.llm.shared import materialize, scratch

RECORD_END = "\r\n\r\n"
HTTP_HEAD = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
#: Captures without a time of their own are one second apart, from here.
FIRST_CAPTURE = 1_704_067_200
#: Records in one archive file, and index entries in one key range.
ARCHIVE_RECORDS = 10_000
RANGE_ENTRIES = 50_000
INDEX_COLUMNS = ["url_key", "timestamp", "page_id", "archive", "record_offset", "record_type", "payload_bytes", "payload_digest", "refers_to"]
_INDEX_TYPES = [pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
_INDEX_SCHEMA = "url_key string, timestamp string, page_id long, archive string, record_offset long, record_type string, payload_bytes long, payload_digest string, refers_to long"


def base32_sha1(payload):
    """Bare upper-case base32 of the SHA-1: five hex digits are four base32 digits."""
    digest = F.sha1(payload)
    parts = [F.lpad(F.conv(F.substring(digest, 5 * k + 1, 5), 16, 32), 4, "0") for k in range(8)]
    return F.translate(F.concat(*parts), "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def choose_revisits(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """page_id and refers_to of the pages that repeat a payload of at least ``min_bytes``."""
    payload = F.encode(F.coalesce("html", F.lit("")), "UTF-8")
    narrow = pages.select("page_id", F.sha1(payload).alias("digest"), F.octet_length(payload).alias("n")).where(F.col("n") >= min_bytes).where("page_id IS NOT NULL")
    groups = narrow.groupBy("digest").agg(F.max("page_id").alias("refers_to"), F.min("page_id").alias("least")).where("least < refers_to").drop("least")
    return narrow.join(groups, "digest").where("page_id < refers_to").groupBy("page_id", "digest").agg(F.max("refers_to").alias("refers_to"))


def write_archives(pages: DataFrame, path: str, min_bytes: int = 0) -> None:
    """Write one record per page below ``path``."""
    html = F.coalesce("html", F.lit(""))
    rows = pages.select("page_id", html.alias("payload"), F.sha1(F.encode(html, "UTF-8")).alias("digest"), F.translate(F.coalesce("url", F.lit("")), "\r\n", "").alias("url"))
    rows = rows.join(choose_revisits(pages, min_bytes), ["page_id", "digest"], "left")
    revisit = F.col("refers_to").isNotNull()
    size = F.octet_length("payload")
    name = lambda c: F.concat(F.lit("<urn:page:"), F.coalesce(c.cast("string"), F.lit("")), F.lit(">"))
    when = F.date_format(F.timestamp_seconds(F.lit(FIRST_CAPTURE) + F.pmod(F.coalesce("page_id", F.lit(0)), F.lit(1 << 31))), "yyyy-MM-dd'T'HH:mm:ss'Z'")
    digest = base32_sha1(F.encode("payload", "UTF-8"))
    record = F.concat(
        F.lit("WARC/1.1\r\nWARC-Type: "), F.when(revisit, "revisit").otherwise("response"),
        F.lit("\r\nWARC-Record-ID: "), name(F.col("page_id")), F.lit("\r\nWARC-Date: "), when,
        F.lit("\r\nWARC-Target-URI: "), F.col("url"), F.lit("\r\nWARC-Payload-Digest: sha1:"), digest,
        F.lit("\r\nWARC-Payload-Length: "), size.cast("string"),
        F.when(revisit, F.concat(F.lit("\r\nWARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest\r\nWARC-Refers-To: "), name(F.col("refers_to")))).otherwise(F.lit("")),
        F.lit("\r\nContent-Type: application/http; msgtype=response\r\nContent-Length: "),
        (F.lit(len(HTTP_HEAD)) + F.when(revisit, 0).otherwise(size)).cast("string"), F.lit("\r\n\r\n" + HTTP_HEAD),
        F.when(revisit, F.lit("")).otherwise(F.col("payload")))
    (rows.select(record.alias("value")).write.option("lineSep", RECORD_END).option("compression", "gzip")
        .option("zlib.compress.level", "BEST_SPEED").option("maxRecordsPerFile", ARCHIVE_RECORDS).text(path))


def url_key(url: str) -> str:
    """Host labels from the top down, then path and query: captures of a site sort together."""
    try:
        parts = urlsplit(url.strip())
        host = (parts.hostname or "").removeprefix("www.")
    except ValueError:
        return url
    return ",".join(reversed(host.split("."))) + ")" + (parts.path.lower() or "/") + ("?" + parts.query.lower() if parts.query else "")


class _Unzip:
    """Bytes of a gzip file of one or more members, as many at a time as are asked for."""

    def __init__(self, data: bytes):
        self.rest, self.inflate, self.held, self.at = memoryview(data), zlib.decompressobj(31), bytearray(), 0

    def _more(self) -> bool:
        if self.inflate.eof:
            left = self.inflate.unused_data
            if not left:
                return False
            self.rest, self.inflate = memoryview(left), zlib.decompressobj(31)
        if not len(self.rest):
            return False
        self.held += self.inflate.decompress(self.rest[:1 << 18])
        self.rest = self.rest[1 << 18:] if not self.inflate.eof else self.rest[:0]
        return True

    def until(self, sign: bytes) -> bytes | None:
        """Bytes up to and with ``sign``; None at the end of the file."""
        begin = 0
        while (stop := self.held.find(sign, begin)) < 0:
            begin = max(0, len(self.held) - len(sign))
            if not self._more():
                if self.held:
                    raise ValueError("archive ends within a record")
                return None
        return self.take(stop + len(sign))

    def take(self, n: int) -> bytes:
        while len(self.held) < n:
            if not self._more():
                raise ValueError("archive ends within a record")
        out = bytes(self.held[:n])
        del self.held[:n]
        self.at += n
        return out


def read_records(data: bytes, archive: str) -> Iterator[tuple[tuple, bytes]]:
    """Index entry and block of each record of an archive; a wrong digest raises."""
    source = _Unzip(data)
    while True:
        offset = source.at
        head = source.until(b"\r\n\r\n")
        if head is None:
            return
        lines = head.decode().split("\r\n")
        if lines[0] != "WARC/1.1":
            raise ValueError(f"no record at {offset} of {archive}")
        fields = dict(line.split(": ", 1) for line in lines[1:] if ": " in line)
        block = source.take(int(fields["Content-Length"]))
        if source.take(4) != b"\r\n\r\n":
            raise ValueError(f"record at {offset} of {archive} does not end")
        digest, kind = fields["WARC-Payload-Digest"].removeprefix("sha1:"), fields["WARC-Type"]
        if kind == "response":
            payload = memoryview(block)[block.index(b"\r\n\r\n") + 4:]
            if len(payload) != int(fields["WARC-Payload-Length"]) or base64.b32encode(hashlib.sha1(payload).digest()).decode() != digest:
                raise ValueError(f"payload at {offset} of {archive} differs from its digest")
        number = lambda f: int(x) if (x := fields.get(f, "<urn:page:>")[10:-1]) else None
        stamp = "".join(c for c in fields["WARC-Date"] if c.isdigit())
        yield (url_key(fields.get("WARC-Target-URI", "")), stamp, number("WARC-Record-ID"), archive, offset, kind, int(fields["WARC-Payload-Length"]), digest, number("WARC-Refers-To")), block


def _order(entry: tuple) -> tuple:
    return entry[0], entry[1], entry[2] is not None, entry[2] or 0, entry[3], entry[4]


def _columns(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), _INDEX_TYPES, strict=True)], INDEX_COLUMNS)


def capture_runs(spark: SparkSession, path: str) -> DataFrame:
    """Index entries of all archives below ``path``; each archive's are a sorted run."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                name = batch.column("path")[k].as_py().rsplit("/", 1)[-1]
                entries = sorted((e for e, _ in read_records(batch.column("content")[k].as_py(), name)), key=_order)
                if entries:
                    yield _columns(entries)
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(path).select("path", "content")
    return files.mapInArrow(run, _INDEX_SCHEMA)


class LoserTree:
    """Merge of k sorted runs: each inner node keeps the loser of its match, the root's winner is next."""

    def __init__(self, runs: list[Iterator], key):
        self.runs, self.key = [iter(r) for r in runs], key
        self.k = len(self.runs)
        self.heads = [self._next(i) for i in range(self.k)]
        self.losers = [-1] * max(1, self.k)
        winners = [-1] * self.k + list(range(self.k))
        for node in range(self.k - 1, 0, -1):
            a, b = winners[2 * node], winners[2 * node + 1]
            winners[node], self.losers[node] = (a, b) if self._before(a, b) else (b, a)
        self.winner = winners[1] if self.k > 1 else 0

    def _next(self, i: int):
        item = next(self.runs[i], None)
        return None if item is None else (self.key(item), i, item)

    def _before(self, a: int, b: int) -> bool:
        x, y = self.heads[a], self.heads[b]
        return x is not None and (y is None or x[:2] < y[:2])

    def __iter__(self) -> Iterator:
        if not self.k:
            return
        while self.heads[self.winner] is not None:
            yield self.heads[self.winner][2]
            i = self.winner
            self.heads[i] = self._next(i)
            node = (i + self.k) // 2
            while node >= 1:
                if self._before(self.losers[node], i):
                    i, self.losers[node] = self.losers[node], i
                node //= 2
            self.winner = i


def merge_index(entries: DataFrame, count: int) -> DataFrame:
    """The global index: partitions are key ranges in order, each the merge of its runs' slices."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        runs: dict[str, list[tuple]] = {}
        for batch in batches:
            for entry in zip(*(batch.column(c).to_pylist() for c in INDEX_COLUMNS), strict=True):
                runs.setdefault(entry[3], []).append(entry)
        for held in runs.values():
            held.sort(key=_order)  # already in order unless the shuffle mixed blocks of a run
        out = []
        for entry in LoserTree(list(runs.values()), _order):
            out.append(entry)
            if len(out) == 10_000:
                yield _columns(out)
                out = []
        if out:
            yield _columns(out)
    ranges = max(1, -(-count // RANGE_ENTRIES))
    return entries.repartitionByRange(ranges, "url_key", "timestamp", "page_id", "archive", "record_offset").mapInArrow(run, _INDEX_SCHEMA)


def archive_index(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """Write the pages as archives in the shared folder, read them back, and merge their index."""
    spark = pages.sparkSession
    path = scratch(spark, "warc")
    write_archives(pages, path, min_bytes)
    entries = materialize(capture_runs(spark, path), "captures")
    return merge_index(entries, entries.count())


def warc_digest(pages: DataFrame) -> DataFrame:
    """The contract's row per page, read back from the archives, in the order of the capture index."""
    return archive_index(pages).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
