"""Evaluation texts inside training texts, by Wu-Manber multi-pattern search over words.

Patterns are the windows of 12 consecutive words of the items (a shorter item is one window of its own length).
Search works on words instead of characters: a symbol is the hash of a lower-cased word, a block is two
words. The shift table says for each block how far the search window may move without missing an
occurrence; almost every block of ordinary text is in no pattern and lets the window jump by its whole
length less one. Where the shift is zero, the hash of the window's last words selects a bucket of patterns,
and their words are compared one by one.

The search is vectorised over texts: in each round, all windows of a slice of texts look up their shift and jump.
Long texts are cut into overlapping segments first, so no round waits for one of them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagelathe.llm.codepoints import decode, mix, slices, words

WINDOW, BLOCK, SEGMENT = 12, 2, 192
#: Words of all items together that may be broadcast as a pattern set; larger sets are searched in parts.
MOST_ITEM_WORDS = 2_000_000
#: Words of a window whose hash selects its bucket, places of the shift table for each block of the patterns, and its bits at least and at most.
SUFFIX, PLACES, _LEAST_BITS, _MOST_BITS = 4, 8, 12, 26
#: Candidates compared at once.
_COMPARED = 1 << 18
_STEP = np.uint64(0xBF58476D1CE4E5B9)


def _fold(hashes: np.ndarray, begin: np.ndarray, length: int) -> np.ndarray:
    out = np.zeros(len(begin), np.uint64)
    for k in range(length):
        out = out * _STEP + hashes[begin + k]
    return mix(out)


class PatternSet:
    """Windows of one length: shift table over blocks, and buckets by the hash of the window's last words."""

    def __init__(self, length: int, hashes: np.ndarray, begin: np.ndarray, item: np.ndarray):
        self.length, self.block, self.suffix = length, min(BLOCK, length), min(SUFFIX, length)
        self.hashes = hashes
        key = _fold(hashes, begin + length - self.suffix, self.suffix)
        order = np.argsort(key, kind="stable")
        self.key, self.begin, self.item = key[order], begin[order], item[order]
        most = length - self.block + 1
        blocks = [_fold(hashes, begin + length - self.block - ends_before, self.block) for ends_before in range(most)]
        # Windows of an item overlap, so blocks are about as many as windows.
        distinct = len(np.unique(np.concatenate([blocks[0], blocks[-1]])))
        self.bits = min(_MOST_BITS, max(_LEAST_BITS, (PLACES * distinct - 1).bit_length()))
        self.shift = np.full(1 << self.bits, most, np.int8)
        for ends_before, block in enumerate(blocks):
            np.minimum.at(self.shift, self._slot(block), np.int8(ends_before))

    def _slot(self, block: np.ndarray) -> np.ndarray:
        return (block >> np.uint64(64 - self.bits)).astype(np.int64)

    def search(self, hashes: np.ndarray, begin: np.ndarray, end: np.ndarray, owner: np.ndarray, steps: list[int] | None = None) -> tuple[np.ndarray, np.ndarray]:
        """(owner, item) of every occurrence within ``hashes[begin:end]`` of the segments; pairs may repeat. ``steps`` counts looks and words moved."""
        at, last, who = begin.copy(), end - self.length, owner
        hits: list[tuple[np.ndarray, np.ndarray]] = []
        tail = self.length - self.block
        while True:
            alive = at <= last
            at, last, who = at[alive], last[alive], who[alive]
            if not len(at):
                break
            shift = self.shift[self._slot(_fold(hashes, at + tail, self.block))]
            zero = shift == 0
            if zero.any():
                hits.append((at[zero], who[zero]))
            move = np.maximum(shift, 1)
            if steps is not None:
                steps[0] += len(at)
                steps[1] += int(move.sum())
            at = at + move
        if not hits:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        place, text = (np.concatenate(x) for x in zip(*hits))
        key = _fold(hashes, place + self.length - self.suffix, self.suffix)
        low, high = np.searchsorted(self.key, key, "left"), np.searchsorted(self.key, key, "right")
        upto = np.concatenate([[0], np.cumsum(high - low)])
        found: list[tuple[np.ndarray, np.ndarray]] = []
        begins = 0
        while begins < len(place):
            # A bucket is compared whole, a run of windows at a time.
            ends = max(begins + 1, int(np.searchsorted(upto, upto[begins] + _COMPARED, "right")) - 1)
            many = (high - low)[begins:ends]
            which = np.repeat(np.arange(begins, ends), many)
            entry = np.repeat(low[begins:ends] - upto[begins:ends], many) + np.arange(upto[begins], upto[ends])
            for k in range(self.length):
                same = hashes[place[which] + k] == self.hashes[self.begin[entry] + k]
                which, entry = which[same], entry[same]
            found.append((text[which], self.item[entry]))
            begins = ends
        return tuple(np.concatenate(x) for x in zip(*found))


def pattern_sets(items: list[int], texts: list[str | None], window: int = WINDOW) -> list[PatternSet]:
    """One set per window length; items without a word are in none."""
    codes, starts = decode(pa.array(texts, pa.string()))
    _, _, hashes, owner = words(codes, starts)
    number = np.asarray(items, np.int64)
    count = np.bincount(owner, minlength=len(items)) if len(owner) else np.zeros(len(items), np.int64)
    first = np.concatenate([[0], np.cumsum(count)])[:-1]
    out = []
    for length in np.unique(np.minimum(count[count > 0], window)).tolist():
        mine = np.flatnonzero(np.minimum(count, window) == length)
        begin = np.concatenate([np.arange(first[i], first[i] + count[i] - length + 1) for i in mine])
        item = np.repeat(number[mine], count[mine] - length + 1)
        out.append(PatternSet(length, hashes, begin, item))
    return out


def _segments(count: np.ndarray, longest: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Begin, end and owner of overlapping segments over consecutive texts of ``count`` words each."""
    first = np.concatenate([[0], np.cumsum(count)])
    each = np.maximum(1, -(-count // SEGMENT))
    owner = np.repeat(np.arange(len(count)), each)
    begin = first[:-1][owner] + SEGMENT * (np.arange(len(owner)) - np.repeat(np.cumsum(each) - each, each))
    return begin, np.minimum(begin + SEGMENT + longest - 1, first[1:][owner]), owner


def _search(sets: list[PatternSet]):
    longest = max((s.length for s in sets), default=1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                codes, starts = decode(part.column(1))
                _, _, hashes, owner = words(codes, starts)
                begin, end, who = _segments(np.bincount(owner, minlength=part.num_rows), longest)
                found = [s.search(hashes, begin, end, who) for s in sets]
                row = np.concatenate([f[0] for f in found]) if found else np.zeros(0, np.int64)
                item = np.concatenate([f[1] for f in found]) if found else np.zeros(0, np.int64)
                pair = np.unique(np.stack([row, item], axis=1), axis=0)
                yield pa.RecordBatch.from_arrays([part.column(0).take(pa.array(pair[:, 0])), pa.array(pair[:, 1])], names=["owner", "item_id"])

    return run


def find_leaks(docs: DataFrame, key: str, text: str, items: DataFrame, item: str = "item_id", item_text: str = "text", window: int = WINDOW, most_words: int = MOST_ITEM_WORDS) -> DataFrame:
    """Each pair (``key``, ``item``) of a document that holds ``window`` consecutive words of an item, or all words of a
    shorter item in order without a gap.

    Words are runs of letters, digits and underscores of any script in lower case; all between is ignored, so
    restyled passages count. A pair is listed once. Null and wordless texts and items match nothing. Documents
    are read once for every ``most_words`` words of items (a bound on what is broadcast) and are not
    shuffled; only pairs found are. Rows of ``docs`` without key yield pairs with a null key.
    """
    usable = items.where(F.col(item).isNotNull() & F.col(item_text).isNotNull()).select(F.col(item).cast("long").alias("i"), F.col(item_text).alias("t")).distinct()
    # A part holds at most most_words words: a word takes two characters with its space, at least.
    size = usable.agg(F.sum(F.length("t"))).first()[0] or 0
    parts = max(1, -(-int(size) // (2 * most_words)))
    source = docs.select(F.col(key).cast("long").alias("owner"), F.col(text).alias("text"))
    out = None
    for part in range(parts):
        rows = usable.where(F.pmod(F.xxhash64("i"), F.lit(parts)) == part).orderBy("i", "t").collect()
        found = source.mapInArrow(_search(pattern_sets([r.i for r in rows], [r.t for r in rows], window)), "owner long, item_id long")
        out = found if out is None else out.unionByName(found)
    return out.distinct().select(F.col("owner").alias(key), F.col("item_id").alias(item))
