"""Consistent shard numbers for references."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

# 64-bit FNV-1a offset basis and prime, and the jump hash multiplier.
FNV_OFFSET = 0xCBF29CE484222325
FNV_PRIME = 0x100000001B3
JUMP_MULTIPLIER = 2862933555777941757


def _text_bytes(text: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """UTF-8 bytes of an Arrow string array, with each value's start and length."""
    width = np.int64 if pa.types.is_large_string(text.type) else np.int32
    _, offsets, data = text.buffers()
    bounds = np.frombuffer(offsets, dtype=width)[text.offset : text.offset + len(text) + 1]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.zeros(1, np.uint8)
    bounds = bounds.astype(np.int64)
    return raw, bounds[:-1], np.diff(bounds)


def fnv1a(text: pa.Array, prefix: bytes = b"") -> np.ndarray:
    """64-bit FNV-1a of every value, one byte position at a time over the whole batch."""
    raw, starts, lengths = _text_bytes(text)
    prime = np.uint64(FNV_PRIME)
    seed = np.array([FNV_OFFSET], dtype=np.uint64)
    for byte in prefix:
        seed = (seed ^ np.uint64(byte)) * prime
    hashes = np.repeat(seed, len(lengths))
    # Longest first, so the values that still have a byte at a position are a leading run.
    longest_first = np.argsort(-lengths, kind="stable")
    starts, ordered = starts[longest_first], lengths[longest_first]
    live = hashes[longest_first]
    for position in range(int(ordered[0]) if len(ordered) else 0):
        count = int(np.searchsorted(-ordered, -position, side="left"))
        live[:count] = (live[:count] ^ raw[starts[:count] + position]) * prime
    hashes[longest_first] = live
    return hashes


def jump_shards(hashes: np.ndarray, num_shards: int) -> np.ndarray:
    """Jump consistent hash of every value; values leave the loop as they settle."""
    shards = np.zeros(len(hashes), dtype=np.int64)
    active = np.arange(len(hashes))
    state = hashes.astype(np.uint64)
    while len(active):
        state = state * np.uint64(JUMP_MULTIPLIER) + np.uint64(1)
        scale = float(1 << 31) / ((state >> np.uint64(33)) + np.uint64(1)).astype(np.float64)
        step = ((shards[active] + 1) * scale).astype(np.int64)
        moving = step < num_shards
        active, state = active[moving], state[moving]
        shards[active] = step[moving]
    return shards.astype(np.int32)


def shard_of(reference_id: Column, num_shards: int) -> Column:
    """Shard of ``ref:<reference_id>``.

    64-bit wrap-around arithmetic needs wide decimals in SQL expressions; on Arrow
    batches it is plain unsigned arithmetic, and only this one column travels.
    """
    if num_shards < 1:
        raise ValueError("num_shards must be at least 1")

    @F.arrow_udf("int")
    def shard(text: pa.Array) -> pa.Array:
        return pa.array(jump_shards(fnv1a(text, b"ref:"), num_shards))

    return shard(reference_id)


def hash_hex(text: Column) -> Column:
    """The FNV-1a hash of a text as 16 hex digits."""

    @F.arrow_udf("string")
    def digest(values: pa.Array) -> pa.Array:
        return pa.array([format(int(h), "016x") for h in fnv1a(values)])

    return digest(text)
