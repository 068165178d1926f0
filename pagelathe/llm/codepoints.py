"""Vectorised word work on Arrow string batches.

A batch is decoded once into an array of code points; words, their hashes and their owners then come from
numpy operations over the whole array, so no Python loop runs per row or per word. Batches are cut into
slices of a bounded number of code points first, which keeps a worker's memory flat however long texts are.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Code points handled at once. A single longer text still goes through whole.
SLICE_CODE_POINTS = 400_000
_BASE = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xD6E8FEB86659FD93)


@lru_cache(maxsize=1)
def word_table() -> np.ndarray:
    """True at each code point that belongs to a word: a letter or digit of any script, or ``_``."""
    table = np.fromiter((chr(i).isalnum() for i in range(0x110000)), dtype=bool, count=0x110000)
    table[ord("_")] = True
    return table


@lru_cache(maxsize=1)
def letter_table() -> np.ndarray:
    return np.fromiter((chr(i).isalpha() for i in range(0x110000)), dtype=bool, count=0x110000)


@lru_cache(maxsize=1)
def cased_table() -> np.ndarray:
    """True at each letter of a script that has upper and lower case."""
    return np.fromiter((chr(i).lower() != chr(i).upper() for i in range(0x110000)), dtype=bool, count=0x110000)


@lru_cache(maxsize=1)
def space_table() -> np.ndarray:
    return np.fromiter((chr(i).isspace() for i in range(0x110000)), dtype=bool, count=0x110000)


@lru_cache(maxsize=1)
def lower_table() -> np.ndarray:
    """Lower case by code point; those whose lower case is longer than one code point stay as they are."""
    table = np.arange(0x110000, dtype=np.uint32)
    for i in range(0x110000):
        low = chr(i).lower()
        if len(low) == 1:
            table[i] = ord(low)
    return table


def mix(x: np.ndarray) -> np.ndarray:
    """A fixed 64-bit finaliser, so that sums and low bits of hashes may be used."""
    x = x ^ (x >> np.uint64(32))
    x = x * _MIX
    x = x ^ (x >> np.uint64(29))
    return x * _MIX ^ (x >> np.uint64(32))


@lru_cache(maxsize=4)
def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    inverse = np.uint64(pow(int(_BASE), -1, 1 << 64))
    up, down = np.full(size, _BASE, np.uint64), np.full(size, inverse, np.uint64)
    up[0] = down[0] = 1
    return np.cumprod(up), np.cumprod(down)


def span_hashes(codes: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A hash of ``codes[begin:end]`` for each pair, by prefix sums of a polynomial modulo 2**64.

    Equal spans hash alike wherever they stand. ``codes`` holds no zero where it counts.
    """
    size = 1 << max(10, int(len(codes) + 1).bit_length())
    up, down = _powers(size)
    prefix = np.zeros(len(codes) + 1, np.uint64)
    np.cumsum(codes.astype(np.uint64) * up[: len(codes)], out=prefix[1:])
    return mix((prefix[end] - prefix[begin]) * down[begin] + (end - begin).astype(np.uint64))


def decode(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Code points of all texts in turn, and where each text starts (one more entry than texts). Nulls are empty."""
    column = column.fill_null("").cast(pa.large_string())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    raw = b"" if data is None else memoryview(data)[int(offsets[0]) : int(offsets[-1])]
    lead = np.frombuffer(raw, np.uint8)
    before = np.zeros(len(lead) + 1, np.int64)
    np.cumsum((lead & 0xC0) != 0x80, out=before[1:])
    codes = np.frombuffer(str(raw, "utf-8").encode("utf-32-le"), np.uint32)
    return codes, before[offsets - offsets[0]]


def slices(batch: pa.RecordBatch, column: str, most: int = SLICE_CODE_POINTS) -> Iterator[pa.RecordBatch]:
    """The batch in runs of rows whose texts together take about ``most`` bytes, at least one row each."""
    if not batch.num_rows:
        return
    sizes = pc.fill_null(pc.binary_length(batch.column(batch.schema.get_field_index(column))), 0)
    total = np.cumsum(sizes.to_numpy(zero_copy_only=False).astype(np.int64))
    at = 0
    while at < batch.num_rows:
        used = total[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(total, used + most, side="right")))
        yield batch.slice(at, to - at)
        at = to


def runs(mask: np.ndarray, edges: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Begin and end of each maximal run of True, never across a position in ``edges``."""
    n = len(mask)
    change = np.zeros(n + 1, bool)
    change[1:n] = mask[1:] != mask[:-1]
    change[edges] = True
    change[0] = change[n] = True
    at = np.flatnonzero(change)
    begin, end = at[:-1], at[1:]
    keep = mask[begin] if n else np.zeros(0, bool)
    return begin[keep], end[keep]


def words(codes: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of each word: begin, end, hash of its lower case, and number of the text that holds it."""
    begin, end = runs(word_table()[codes], starts)
    owner = np.searchsorted(starts, begin, side="right") - 1
    return begin, end, span_hashes(lower_table()[codes], begin, end), owner
