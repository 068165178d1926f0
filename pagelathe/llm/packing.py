"""Filling fixed-capacity containers with items by best-two-fit.

A bin is filled greedily with the largest item that fits. When nothing fits the rest any more, its smallest
item is taken out if two unpacked items together fill the widened gap more tightly than that item did.
Sizes are small integers, so a bin's choices are lookups in tables over the sizes still present ("largest
present size at most x"), not searches over items: the cost is per bin, not per pair of items.

The distributed part: an item's size is computed where the item is read; only (id, size) is shuffled, to
groups of bounded size that are packed each for itself. A group leaves at most one bin open, which costs less
than one bin in thousands.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagelathe.llm.codepoints import decode, slices, space_table, word_table

#: Repeated rows that are numbered at once.
COPIES = 100_000


def count_tokens(codes: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Tokens of each text: maximal runs of word characters, and maximal runs of other non-space characters."""
    kind = np.where(word_table()[codes], 1, np.where(space_table()[codes], 0, 2)).astype(np.int8)
    begins = np.zeros(len(kind) + 1, bool)
    begins[1:-1] = kind[1:] != kind[:-1]
    begins[starts] = True
    total = np.zeros(len(kind) + 1, np.int64)
    np.cumsum(begins[:-1] & (kind != 0), out=total[1:])
    return total[starts[1:]] - total[starts[:-1]]


def _counter(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch, "text"):
            counts = count_tokens(*decode(part.column(1)))
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(counts)], names=["item", "tokens"])


def with_token_counts(df: DataFrame, key: str, text: str) -> DataFrame:
    """Columns item (``key``) and tokens of every row; null and blank texts have 0."""
    return df.select(F.col(key).cast("long").alias("item"), F.col(text).alias("text")).mapInArrow(_counter, "item long, tokens long")


class _Present:
    """Item numbers by size, with the largest present size at most x for every x."""

    def __init__(self, sizes: np.ndarray, capacity: int):
        order = np.argsort(sizes, kind="stable")
        self.capacity = capacity
        self.left = np.bincount(sizes, minlength=capacity + 1)[: capacity + 1].astype(np.int64)
        self.order = order
        self.begin = np.concatenate([[0], np.cumsum(self.left)])[:-1]
        self.refresh()

    def refresh(self) -> None:
        here = np.where(self.left > 0, np.arange(self.capacity + 1), 0)
        here[0] = 0
        self.at_most = np.maximum.accumulate(here)
        self.sizes = np.flatnonzero(self.left[1:]) + 1

    def take(self, size: int) -> int:
        self.left[size] -= 1
        item = int(self.order[self.begin[size] + self.left[size]])
        if not self.left[size]:
            self.refresh()
        return item

    def give(self, size: int, item: int) -> None:
        self.order[self.begin[size] + self.left[size]] = item
        self.left[size] += 1
        if self.left[size] == 1:
            self.refresh()

    def best_two(self, gap: int) -> tuple[int, int]:
        """Two present sizes (larger first) with the largest sum at most ``gap``; (0, 0) if there are none."""
        first = self.sizes[: np.searchsorted(self.sizes, gap)]
        if not len(first):
            return 0, 0
        second = self.at_most[np.minimum(gap - first, first)]
        # The same item can't be taken twice.
        alone = (second == first) & (self.left[first] < 2)
        if alone.any():
            second = np.where(alone, self.at_most[np.maximum(second - 1, 0)], second)
        total = np.where(second > 0, first + second, 0)
        k = int(np.argmax(total))
        return (int(first[k]), int(second[k])) if total[k] else (0, 0)


def best_two_fit(sizes: np.ndarray, capacity: int) -> np.ndarray:
    """Bin number of each item; ``sizes`` are integers from 1 to ``capacity``."""
    bins = np.full(len(sizes), -1, np.int64)
    present, number, todo = _Present(np.asarray(sizes, np.int64), capacity), 0, len(sizes)
    while todo:
        held: list[tuple[int, int]] = []
        gap = capacity
        while gap and (size := int(present.at_most[gap])):
            held.append((size, present.take(size)))
            gap -= size
        if gap and held:
            smallest, item = held[-1]
            a, b = present.best_two(gap + smallest)
            if a + b > smallest:
                held.pop()
                held.append((a, present.take(a)))
                held.append((b, present.take(b)))
                present.give(smallest, item)
        for _, item in held:
            bins[item] = number
        todo -= len(held)
        number += 1
    return bins


def _pack(capacity: int):
    def run(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["item", "token_begin", "size", "copy"], kind="stable", ignore_index=True)
        group["bin_no"] = best_two_fit(group["size"].to_numpy(), capacity)
        return group[["lot", "bin_no", "item", "piece_no", "pieces", "token_begin", "size"]]

    return run


def pack_items(sized: DataFrame, capacity: int = 1024, lot_items: int = 20_000, items: int | None = None) -> DataFrame:
    """Assign every item of ``sized`` (columns item, tokens) to containers of ``capacity`` tokens.

    Columns: lot and bin_no (together the container), item, piece_no, pieces, token_begin, size. An item above
    the capacity is the only kind that is split: into full pieces and a rest, by token position. Items of
    0 or null tokens take no room and are left out. Repeated rows are items of their own. An empty table
    gives an empty result. ``lot_items`` bounds what one task packs; lots are drawn by a hash of the item,
    salted by its size and the number of the copy so that one id that holds many rows spreads too. The same rows give the
    same containers, however they are stored. ``items`` is their number if known.
    """
    real = sized.where(F.col("tokens") > 0).select(F.col("item"), F.col("tokens").cast("long").alias("tokens"))
    if items is None:
        items = real.agg(F.sum(F.ceil(F.col("tokens") / capacity))).first()[0] or 0
    lots = max(1, -(-int(items) // lot_items))
    # Repeated rows are numbered by counting them, so nothing depends on where a row stands in its file.
    copies = real.groupBy("item", "tokens").agg(F.count(F.lit(1)).alias("copies"))
    runs = copies.select("item", "tokens", "copies", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("copies") - 1) / COPIES))).alias("run"))
    each = runs.select("item", "tokens", F.explode(F.sequence(F.col("run") * COPIES, F.least(F.col("copies"), (F.col("run") + 1) * COPIES) - 1)).alias("copy"))
    count = F.expr(f"cast(ceil(tokens / {capacity}) as int)")
    pieces = each.select("item", "tokens", "copy", count.alias("pieces"), F.explode(F.sequence(F.lit(0), count - 1)).alias("piece_no"))
    begin = F.col("piece_no").cast("long") * capacity
    pieces = pieces.select(
        F.pmod(F.xxhash64("item", "tokens", "piece_no", "copy"), F.lit(lots)).cast("int").alias("lot"),
        "item", "copy", "piece_no", "pieces", begin.alias("token_begin"), F.least(F.lit(capacity).cast("long"), F.col("tokens") - begin).alias("size"),
    )
    return pieces.groupBy("lot").applyInPandas(_pack(capacity), "lot int, bin_no long, item long, piece_no int, pieces int, token_begin long, size long")
