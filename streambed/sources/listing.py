"""New segments of some buckets as a Spark data source whose offset is the last key of each bucket.

Both readers list the flush folders at or after the last key only, a task per folder. As batch:

    spark.dataSource.register(SegmentListing)
    spark.read.format("segment_listing").options(**listing_options(buckets, after)).load()

As a stream each micro-batch holds the keys after the one before. A key that appears below the offset (late, or of a shorter
number, as keys compare as text) is never read by it; the file stream of ``stream_segment_lines`` finds those.
Files are reached through Arrow's file systems, by the scheme of the bucket's root.
"""

from __future__ import annotations

import json
import logging
from collections.abc import Iterator, Mapping
from dataclasses import dataclass

from pyarrow import ArrowInvalid, fs
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

log = logging.getLogger(__name__)

# Fixed value: the folder of a bucket that holds segments.
SEGMENT_PREFIX = "events/"


def listing_options(buckets: Mapping[str, str], after: Mapping[str, str] | None = None, prefix: str = SEGMENT_PREFIX) -> dict[str, str]:
    """Options of the source: root folders, and the last key already read of each bucket."""
    return {"buckets": json.dumps(dict(buckets)), "after": json.dumps(dict(after or {})), "prefix": prefix}


def _open(root: str) -> tuple[fs.FileSystem, str]:
    if "://" in root or root.startswith("file:"):
        system, path = fs.FileSystem.from_uri(root)
    else:
        system, path = fs.LocalFileSystem(), root
    return system, path.rstrip("/")


def reachable(root: str) -> bool:
    """Whether Arrow has a file system for the root's scheme."""
    try:
        return bool(_open(root))
    except (ArrowInvalid, NotImplementedError, OSError):
        return False


@dataclass
class Folder(InputPartition):
    """One flush folder of a bucket, and the keys to take from it: after ``low``, up to ``high`` (None: all)."""

    bucket: str
    root: str
    name: str
    low: str
    high: str | None

    def __post_init__(self) -> None:
        super().__init__(None)


class _Lister:
    def __init__(self, options: Mapping[str, str]):
        self.buckets: dict[str, str] = json.loads(options["buckets"])
        self.after: dict[str, str] = json.loads(options.get("after", "{}"))
        self.prefix = options.get("prefix", SEGMENT_PREFIX)

    def folders(self, root: str, low: str) -> list[str]:
        """Names of the flush folders at or after a key; one listing, that of their parent."""
        system, base = _open(root)
        names = (x.base_name for x in system.get_file_info(fs.FileSelector(f"{base}/{self.prefix.rstrip('/')}", allow_not_found=True)) if x.type == fs.FileType.Directory)
        first = low[len(self.prefix):].split("/", 1)[0] if low.startswith(self.prefix) else ""
        return sorted(n for n in names if n >= first)

    def keys(self, part: Folder) -> Iterator[tuple[str, int]]:
        """Keys and sizes of one folder; hidden files, which are no objects of the writers, are passed over."""
        system, base = _open(part.root)
        for x in system.get_file_info(fs.FileSelector(f"{base}/{self.prefix}{part.name}", recursive=True, allow_not_found=True)):
            key = x.path[len(base) + 1:]
            hidden = any(p.startswith((".", "_")) for p in key.split("/"))
            if x.type == fs.FileType.File and not hidden and key > part.low and (part.high is None or key <= part.high):
                yield key, x.size

    def parts(self, low: Mapping[str, str], high: Mapping[str, str] | None) -> list[Folder]:
        out = []
        for bucket, root in sorted(self.buckets.items()):
            begin, end = low.get(bucket, ""), None if high is None else high.get(bucket, "")
            if end is not None and end <= begin:
                continue
            last = None if end is None else end[len(self.prefix):].split("/", 1)[0]
            try:
                names = self.folders(root, begin)
            except OSError as error:  # its cursor stays, so nothing of it is lost
                log.warning("bucket %s left out: %s", bucket, error)
                continue
            out += [Folder(bucket, root, n, begin, end) for n in names if last is None or n <= last]
        return out

    def last_key(self, bucket: str, low: str) -> str:
        """The greatest key of a bucket; folders are opened from the last one back until one holds a key."""
        root = self.buckets[bucket]
        for name in reversed(self.folders(root, low)):
            found = max((k for k, _ in self.keys(Folder(bucket, root, name, low, None))), default=None)
            if found is not None:
                return found
        return low

    def read(self, partition: Folder) -> Iterator[tuple[str, str, int]]:
        for key, size in self.keys(partition):
            yield partition.bucket, key, size


class _BatchReader(_Lister, DataSourceReader):
    def partitions(self) -> list[Folder]:
        return self.parts(self.after, None)


class _StreamReader(_Lister, DataSourceStreamReader):
    def __init__(self, options: Mapping[str, str]):
        super().__init__(options)
        self.reached = {b: self.after.get(b, "") for b in self.buckets}

    def initialOffset(self) -> dict:
        return {b: self.after.get(b, "") for b in self.buckets}

    def latestOffset(self) -> dict:
        self.reached = {b: self.last_key(b, low) for b, low in self.reached.items()}
        return dict(self.reached)

    def partitions(self, start: dict, end: dict) -> list[Folder]:
        return self.parts(start, end)

    def commit(self, end: dict) -> None:
        self.reached = {b: max(self.reached.get(b, ""), k) for b, k in end.items()}


class SegmentListing(DataSource):
    """``bucket, key, size`` of the files of segments; which keys are well formed is for the reader of the table to say."""

    @classmethod
    def name(cls) -> str:
        return "segment_listing"

    def schema(self) -> str:
        return "bucket string, key string, size long"

    def reader(self, schema) -> DataSourceReader:
        return _BatchReader(self.options)

    def streamReader(self, schema) -> DataSourceStreamReader:
        return _StreamReader(self.options)
