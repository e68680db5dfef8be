"""What the operators of this subpackage share: scratch place, table reading, row batches."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

#: Text bytes that one numpy step works on; its temporary arrays take about 20 times as much.
CHUNK_BYTES = 1 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch(spark: SparkSession, purpose: str) -> str:
    """A new folder below ``spark.checkpoint.dir``, which all executors share.

    Only a local session without that setting, as in tests, gets a temporary folder.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="streambed-llm-")
    return f"{root.rstrip('/')}/llm/{purpose}-{uuid.uuid4().hex}"


def materialize(rows: DataFrame, purpose: str) -> DataFrame:
    """Write a narrow table to the shared folder and read it back: lineage ends there."""
    path = scratch(rows.sparkSession, purpose)
    rows.write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def buckets(spark: SparkSession) -> int:
    """Reduce partitions of the packed shuffles: what the session deals its own shuffles to."""
    return max(8, int(spark.conf.get("spark.sql.shuffle.partitions")))


def text_bytes(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a text column, one after another, and the n + 1 offsets; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if isinstance(column, pa.ChunkedArray):
        column = pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], pa.large_string())
    if column.null_count:
        column = column.fill_null(b"" if pa.types.is_binary(column.type) or pa.types.is_large_binary(column.type) else "")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    n = len(column)
    at = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset:column.offset + n + 1].astype(np.int64) if n else np.zeros(1, np.int64)
    held = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return held[at[0]:at[-1]], at - at[0]


def pieces(data: np.ndarray, offsets: np.ndarray, size: int = CHUNK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Cut a batch of texts into runs of whole rows of about ``size`` bytes.

    Yields first row, row after the last, bytes and own offsets. A longer text is a run of its own.
    """
    n, row = len(offsets) - 1, 0
    while row < n:
        end = max(row + 1, int(np.searchsorted(offsets, offsets[row] + size, side="right")) - 1)
        yield row, end, data[offsets[row]:offsets[end]], offsets[row:end + 1] - offsets[row]
        row = end
