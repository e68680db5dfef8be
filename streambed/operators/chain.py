"""Greedy segmentation of ordered rows, exact for lanes of any size.

A row opens a segment when, counted from the row that opened the current one, a limit
would be passed. Each row carries begin and end positions on one or more axes; row ``j``
opens a segment after opener ``i`` when on some axis ``end[j] - begin[i] > limit``.

What a block does depends on its history only through the current opener. So each block
is first reduced to a table from "first row to open in this block" to "last opener of
this block"; only rows up to the second opener can be first, which keeps the table short.
A lane's tables are then followed in order as a stream of Arrow batches, holding one
opener per lane, and last every block marks its own openers.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .blocked import match


class _Blocks:
    """Whole blocks of one or more lanes, side by side, on shared position axes.

    Each block is moved to a stretch of its own, further from the next than any limit
    reaches, so one search over the joined arrays never leaves a row's own block.
    """

    def __init__(self, rows: pd.DataFrame, keys, begin, end, limits: np.ndarray):
        self.count = len(rows)
        changed = _key_changes(rows, keys)
        self.first = np.flatnonzero(changed)
        self.stop = np.append(self.first[1:], self.count)
        self.of = np.cumsum(changed) - 1
        self.limits = limits
        self.base, self.begin, self.end = [], [], []
        for start_name, end_name, limit in zip(begin, end, limits, strict=True):
            starts = rows[start_name].to_numpy(np.int64)
            ends = rows[end_name].to_numpy(np.int64)
            origin = starts[self.first]
            reach = ends[self.stop - 1] - origin + int(limit) + 1
            base = origin - np.append(0, np.cumsum(reach)[:-1])
            self.base.append(base)
            self.begin.append(starts - base[self.of])
            self.end.append(ends - base[self.of])

    def after(self, openers: list[np.ndarray], blocks: np.ndarray) -> np.ndarray:
        """First row of each block that opens a segment after an opener on shared axes."""
        found = self.stop[blocks]
        for opener, ends, limit in zip(openers, self.end, self.limits, strict=True):
            found = np.minimum(found, np.searchsorted(ends, opener + limit, side="right"))
        return np.maximum(found, self.first[blocks])

    def next_openers(self) -> np.ndarray:
        """For every row as opener the next one, or the row count where the block ends."""
        following = np.maximum(self.after(self.begin, self.of), np.arange(1, self.count + 1))
        return np.where(following >= self.stop[self.of], self.count, following)


def _key_changes(rows: pd.DataFrame, keys: Sequence[str]) -> np.ndarray:
    """Whether each row's key differs from the row before."""
    changed = np.ones(len(rows), dtype=bool)
    same = np.ones(max(len(rows) - 1, 0), dtype=bool)
    for key in keys:
        values = rows[key].to_numpy()
        same &= values[1:] == values[:-1]
    changed[1:] = ~same
    return changed


def _whole_blocks(batches: Iterator[pd.DataFrame], keys: Sequence[str]) -> Iterator[pd.DataFrame]:
    """Regroup sorted batches so that no block is cut; holds back at most one block."""
    held: list[pd.DataFrame] = []
    for batch in batches:
        if batch.empty:
            continue
        starts = np.flatnonzero(_key_changes(batch, keys))
        head = batch.iloc[[0]]
        if held and _key_changes(pd.concat([held[-1].iloc[[-1]], head]), keys)[1]:
            yield pd.concat(held, ignore_index=True)
            held = []
        if len(starts) > 1:
            yield pd.concat([*held, batch.iloc[: starts[-1]]], ignore_index=True)
            held = [batch.iloc[starts[-1] :]]
        else:
            held.append(batch)
    if held:
        yield pd.concat(held, ignore_index=True)


def mark_openers(
    rows: DataFrame,
    lane: Sequence[str],
    block: str,
    order: str,
    begin: Sequence[str],
    end: Sequence[str],
    limits: Sequence[int],
) -> DataFrame:
    """The ``lane, block, order`` of every row that opens a segment.

    ``order`` is unique within a lane; begin and end never fall along it. Lane columns
    must not be NULL.
    """
    lane, begin, end = list(lane), list(begin), list(end)
    keys = [*lane, block]
    caps = np.array(limits, dtype=np.int64)
    axes = range(len(begin))
    types = {f.name: f.dataType.simpleString() for f in rows.schema}
    exits = [f"exit_{axis}" for axis in axes]
    heads = [f"head_{axis}" for axis in axes]
    openers = [f"opener_{axis}" for axis in axes]

    def ddl(names: Sequence[str], longs: Sequence[str]) -> str:
        return ", ".join([*[f"`{n}` {types[n]}" for n in names], *[f"{n} long" for n in longs]])

    narrow = rows.select(*keys, order, *[c for c in dict.fromkeys([*begin, *end]) if c != order])
    placed = narrow.repartition(*keys)

    def reduce_blocks(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for group in _whole_blocks(batches, keys):
            blocks = _Blocks(group, keys, begin, end, caps)
            count, jump = blocks.count, np.append(blocks.next_openers(), blocks.count)
            # Only rows up to a block's second opener can be the first to open in it.
            limit = np.minimum(jump[blocks.first], blocks.stop - 1)
            candidate = np.arange(count) <= limit[blocks.of]
            # Follow all rows at once, doubling the stride until each has left its block.
            last, stride = np.arange(count + 1), jump.copy()
            inside = stride[:count] < count
            while inside.any():
                last[:count][inside] = last[stride[:count][inside]]
                stride = stride[stride]
                inside = stride[:count] < count
            out = group.loc[candidate, keys].reset_index(drop=True)
            for axis in axes:
                out[heads[axis]] = group[end[axis]].to_numpy(np.int64)[candidate]
                out[exits[axis]] = group[begin[axis]].to_numpy(np.int64)[last[:count][candidate]]
            yield out

    tables = placed.sortWithinPartitions(*keys, order).mapInPandas(
        reduce_blocks, ddl(keys, [*heads, *exits])
    )

    def follow(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        at_lane, at_block, opener, settled = None, None, None, False
        for batch in batches:
            if batch.empty:
                continue
            bounds = np.append(np.flatnonzero(_key_changes(batch, keys)), len(batch))
            head = [batch[n].to_numpy(np.int64) for n in heads]
            leave = [batch[n].to_numpy(np.int64) for n in exits]
            lanes = list(zip(*[batch[n].to_numpy()[bounds[:-1]] for n in lane], strict=True))
            numbers = batch[block].to_numpy()[bounds[:-1]]
            found = []
            for at, (low, high) in enumerate(zip(bounds[:-1], bounds[1:], strict=True)):
                if at_lane is None or lanes[at] != at_lane:
                    at_lane, at_block, opener = lanes[at], None, None
                if at_block is None or numbers[at] != at_block:
                    at_block, settled = numbers[at], False
                    if opener is not None:
                        found.append((low, opener))
                if settled:
                    continue
                first = low
                if opener is not None:
                    first += min(
                        int(np.searchsorted(head[axis][low:high], opener[axis] + caps[axis], side="right"))
                        for axis in axes
                    )
                if first < high:
                    opener, settled = [int(leave[axis][first]) for axis in axes], True
            if found:
                out = batch.iloc[[low for low, _ in found]][keys].reset_index(drop=True)
                for axis in axes:
                    out[openers[axis]] = np.array([seen[axis] for _, seen in found], dtype=np.int64)
                yield out

    entries = (
        tables.repartition(*lane)
        .sortWithinPartitions(*keys, *heads)
        .mapInPandas(follow, ddl(keys, openers))
    )
    entered = match(placed, entries, keys, "left").sortWithinPartitions(*keys, order)

    def mark(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for group in _whole_blocks(batches, keys):
            blocks = _Blocks(group, keys, begin, end, caps)
            jump = np.append(blocks.next_openers(), blocks.count)
            at = blocks.first.copy()
            known = group[openers[0]].notna().to_numpy()[blocks.first]
            if known.any():
                which = np.flatnonzero(known)
                rows_at = blocks.first[which]
                seen = [
                    group[openers[axis]].to_numpy()[rows_at].astype(np.int64) - blocks.base[axis][which]
                    for axis in axes
                ]
                first = blocks.after(seen, which)
                at[which] = np.where(first >= blocks.stop[which], blocks.count, first)
            chosen = np.zeros(blocks.count + 1, dtype=bool)
            at = at[at < blocks.count]
            while len(at):
                chosen[at] = True
                at = jump[at]
                at = at[at < blocks.count]
            yield group.loc[chosen[: blocks.count], [*keys, order]]

    return entered.mapInPandas(mark, ddl([*keys, order], []))


def with_block(rows: DataFrame, order: str, size: int, name: str = "block") -> DataFrame:
    """Add the block number of an integer order column."""
    return rows.withColumn(name, F.floor(F.col(order) / F.lit(size)).cast("long"))
