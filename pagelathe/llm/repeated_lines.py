"""Lines repeated across one source's documents, by content-defined chunks.

A text is reduced to its letters in lower case. Where a rolling hash over the last letters hits a fixed pattern, a
chunk ends; where chunks end thus depends on nearby content only, not on line breaks, and a passage that
stands elsewhere, reflowed or restyled, falls into the same chunks. Distinct pages are counted per source and
chunk; chunks on too many pages are repeated and are cut.

Line ends cut nothing. A line's inner chunks are those whose ends its own letters decide; wherever the line stands they are the same, so a
line with an inner chunk that is not repeated is not repeated. One all of whose letters lie in repeated chunks is; where only the
chunks over its ends differ (they reach into other lines), or it is shorter than a chunk, an exact count of the line settles it.
Only hashes and positions are shuffled, never texts, and texts are read once; sources are no grouping unit of any task, so one source
that holds a third of all rows is spread like the rest.

For spans without lines every run of letters counts, so none is missed at a chunk's edge. Texts are shuffled to parts of
bounded size: a part holds several small sources, or some pages of a large one. Parts of a source have different pages, so
their page counts add up; only hashes of runs meet across parts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pagelathe.llm.codepoints import cased_table, decode, letter_table, lower_table, mix, runs, slices, span_hashes
from pagelathe.session import cut

#: Letters the rolling hash looks at, and mean letters between content-defined cuts.
WINDOW, MEAN_CHUNK = 8, 16
#: Fixed value: the marker that some stored texts begin with.
PREFIX = "passage: "
#: Characters a part of the search for spans holds; sources with more are spread over several parts.
PART = 500_000


class Letters:
    """Letters of a slice of texts in lower case: where they stand, their text and their line."""

    def __init__(self, column: pa.Array):
        codes, starts = decode(column)
        letters = letter_table()[codes]
        marker = np.frombuffer(PREFIX.encode("utf-32-le"), np.uint32)
        long = np.flatnonzero(np.diff(starts) >= len(marker))
        if len(long):
            at = starts[long][:, None] + np.arange(len(marker))
            letters[at[(codes[at] == marker).all(axis=1)]] = False
        self.at = np.flatnonzero(letters)
        self.codes = lower_table()[codes[self.at]]
        self.text = np.searchsorted(starts, self.at, side="right") - 1
        newlines = np.zeros(len(codes) + 1, np.int64)
        np.cumsum(codes == 10, out=newlines[1:])
        self.line = newlines[self.at] - newlines[starts[self.text]]
        self.starts = starts


class Chunks(Letters):
    """Letters of a slice of texts, cut into chunks by content alone; ``hit`` tells which ends the content decided (others are ends of texts)."""

    def __init__(self, column: pa.Array):
        super().__init__(column)
        n = len(self.at)
        edge = np.ones(n + 1, bool)
        if n:
            edge[1:n] = self.text[1:] != self.text[:-1]
        self.hit = np.zeros(n + 1, bool)
        if n >= WINDOW:
            end = np.arange(WINDOW, n + 1)
            rolling = span_hashes(self.codes, end - WINDOW, end)
            self.hit[end] = (rolling % np.uint64(MEAN_CHUNK) == 0) & (self.text[end - 1] == self.text[end - WINDOW])
        bounds = np.flatnonzero(edge | self.hit)
        self.begin, self.end = bounds[:-1], bounds[1:]
        self.hash = span_hashes(self.codes, self.begin, self.end).view(np.int64)


def _ranges(low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All numbers from low to high of each pair in turn, and where each pair's begin (one more entry)."""
    many = np.maximum(0, high - low)
    upto = np.concatenate([[0], np.cumsum(many)])
    return np.repeat(low - upto[:-1], many) + np.arange(upto[-1]), upto


def _lines(least_letters: int):
    """Lines of enough letters: where they stand, the hash of their letters, their inner chunks and those over their ends."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                c = Chunks(part.column(2))
                new = np.ones(len(c.at), bool)
                new[1:] = (c.text[1:] != c.text[:-1]) | (c.line[1:] != c.line[:-1])
                first = np.flatnonzero(new)
                last = np.append(first[1:], len(c.at))
                enough = last - first >= least_letters
                if not enough.any():
                    continue
                first, last = first[enough], last[enough]
                row = pa.array(c.text[first])
                # Chunks that touch the line, and of these the inner ones: begun at least a window inside it, ended by its own letters.
                touch, beyond = np.searchsorted(c.end, first, "right"), np.searchsorted(c.begin, last, "left")
                inner, after = np.searchsorted(c.begin, first + WINDOW, "left"), np.searchsorted(c.end, last, "right")
                after = after - ((after > inner) & (c.end[np.maximum(after - 1, 0)] == last) & ~c.hit[last])
                inner = np.minimum(inner, beyond)
                after = np.maximum(after, inner)
                within, upto = _ranges(inner, after)
                head, head_upto = _ranges(touch, inner)
                tail, tail_upto = _ranges(after, beyond)
                order = np.argsort(np.concatenate([np.repeat(np.arange(len(first)), np.diff(u)) for u in (head_upto, tail_upto)]), kind="stable")
                over = np.concatenate([head, tail])[order]
                lists = lambda upto, which: pa.ListArray.from_arrays(pa.array(upto.astype(np.int32)), pa.array(c.hash[which]))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).take(row), part.column(1).take(row), part.column(3).take(row), part.column(4).take(row), pa.array(c.line[first].astype(np.int32)), pa.array(span_hashes(c.codes, first, last).view(np.int64)), lists(upto, within), lists(head_upto + tail_upto, over)],
                    names=["source", "page", "key", "text_no", "line_no", "line", "inner", "over"],
                )

    return run


def _texts(df: DataFrame, key: str, source: str, page: str, texts: str) -> DataFrame:
    each = df.where(F.col(source).isNotNull() & F.col(page).isNotNull()).select(
        F.xxhash64(source).alias("source"), F.col(page).cast("long").alias("page"), F.col(key).cast("long").alias("key"), F.posexplode(F.col(texts)).alias("text_no", "text")
    )
    return each.select("source", "page", "text", "key", "text_no").where(F.col("text").isNotNull())


def _repeated(page_keys: DataFrame, by: list[str], pages: int) -> DataFrame:
    """Keys on at least ``pages`` distinct pages, counted after partial deduplication."""
    return page_keys.distinct().groupBy(*by).agg(F.count(F.lit(1)).alias("pages")).where(F.col("pages") >= pages)


def repeated_lines(df: DataFrame, key: str, source: str, page: str, texts: str, pages: int = 6, letters: int = 20) -> DataFrame:
    """Every occurrence of a line that stands on at least ``pages`` distinct pages of its source: ``key``, text_no, line_no.

    ``texts`` is an array of texts; lines are cut at ``\\n``. Two lines are the same if their letters are, whatever
    case, digits, spacing and punctuation; lines of fewer than ``letters`` letters never count. The marker
    ``passage: `` at a text's beginning is not part of its first line. A page that occurs in several rows counts
    once, and the occurrences of all its rows are listed; rows that repeat key and content are listed once.
    Rows without source or page, null arrays and null or empty texts have no such lines.
    """
    return judged_lines(df, key, source, page, texts, pages, letters).select(key, "text_no", "line_no").distinct()


def judged_lines(df: DataFrame, key: str, source: str, page: str, texts: str, pages: int = 6, letters: int = 20) -> DataFrame:
    """The occurrences of ``repeated_lines`` with ``settled``: true where an exact count of the line decided, false where its chunks did."""
    lines = cut(_texts(df, key, source, page, texts).mapInArrow(_lines(letters), "source long, page long, key long, text_no int, line_no int, line long, inner array<long>, over array<long>"), "lines")
    chunks = cut(_repeated(lines.select("source", "page", F.explode(F.concat("inner", "over")).alias("chunk")), ["source", "chunk"], pages).select("source", "chunk"), "repeated-chunks")
    # First by one inner chunk, which most lines fail; then by all.
    known = chunks.select("source", F.col("chunk").alias("one"))
    some = lines.where(F.size("inner") > 0).withColumn("one", F.array_min("inner")).join(known, ["source", "one"], "left_semi").drop("one")
    likely = some.unionByName(lines.where(F.size("inner") == 0))
    place = ["source", "line", "page", "key", "text_no", "line_no"]
    marks = F.concat(F.transform("inner", lambda c: F.struct(c.alias("chunk"), F.lit(True).alias("own"))), F.transform("over", lambda c: F.struct(c.alias("chunk"), F.lit(False).alias("own"))))
    each = likely.select(*place, F.explode(marks).alias("m")).select(*place, "m.chunk", "m.own")
    held = each.join(chunks.withColumn("repeated", F.lit(True)), ["source", "chunk"], "left").withColumn("repeated", F.coalesce("repeated", F.lit(False)))
    judged = held.groupBy(*place).agg(F.min(~F.col("own") | F.col("repeated")).alias("inner"), F.min("repeated").alias("whole")).where("inner")
    judged = cut(judged.select(*place, "whole"), "judged-lines")
    sure = _repeated(judged.select("source", "line", "page"), ["source", "line"], pages).select("source", "line", F.lit(True).alias("counted"))
    out = judged.join(sure, ["source", "line"], "left").where("whole OR counted")
    return out.select(F.col("key").alias(key), "text_no", "line_no", (~F.col("whole")).alias("settled"))


def remove_lines(df: DataFrame, found: DataFrame, key: str, texts: str) -> DataFrame:
    """Every text without the lines in ``found``: ``key``, text_no, text, removed (lines taken out).

    A text that loses all lines is empty; null texts stay null. ``key`` must be unique in ``df``.
    """
    drop = found.groupBy(key, "text_no").agg(F.collect_set("line_no").alias("__drop"))
    each = df.select(F.col(key).cast("long").alias(key), F.posexplode(F.col(texts)).alias("text_no", "text"))
    kept = F.filter(F.split("text", "\n", -1), lambda _, i: ~F.array_contains("__drop", i))
    return each.join(drop, [key, "text_no"], "left").select(
        key, "text_no", F.when(F.col("__drop").isNull(), F.col("text")).otherwise(F.array_join(kept, "\n")).alias("text"), F.coalesce(F.size("__drop"), F.lit(0)).alias("removed")
    )


def _windows(part: pa.Table, size: int) -> tuple[Letters, np.ndarray, np.ndarray, np.ndarray]:
    """Letters of a part, and of every run of ``size`` letters of a text: its begin, the hash of source and run, and its page."""
    letters = Letters(pa.concat_arrays(part["text"].chunks))
    begin = np.arange(max(0, len(letters.at) - size + 1))
    begin = begin[letters.text[begin] == letters.text[begin + size - 1]]
    row = letters.text[begin]
    source = mix(part["source"].to_numpy().view(np.uint64))
    return letters, begin, mix(span_hashes(letters.codes, begin, begin + size) ^ source[row]), part["page"].to_numpy()[row]


def _page_counts(hashes: np.ndarray, page: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """The hashes that occur ``least`` times, in order, and the distinct pages of each."""
    found, counts = np.unique(hashes, return_counts=True)
    single = found[counts == 1] if least <= 1 else found[:0]
    found = found[counts >= max(2, least)]
    several = _member(hashes, found)
    hashes, page = hashes[several], page[several]
    order = np.lexsort((page, hashes))
    hashes, page = hashes[order], page[order]
    first = np.ones(len(hashes), bool)
    first[1:] = (hashes[1:] != hashes[:-1]) | (page[1:] != page[:-1])
    found, counts = np.unique(hashes[first], return_counts=True)
    found, counts = np.append(found, single), np.append(counts, np.ones(len(single), np.int64))
    order = np.argsort(found)
    return found[order], counts[order]


def _member(values: np.ndarray, ordered: np.ndarray) -> np.ndarray:
    if not len(ordered):
        return np.zeros(len(values), bool)
    return ordered[np.minimum(np.searchsorted(ordered, values), len(ordered) - 1)] == values


_SPAN = "key long, text_no int, char_begin long, char_end long"


def _spans(part: pa.Table, letters: Letters, begin: np.ndarray, size: int) -> pa.Table:
    """Spans of the letters in runs that start at ``begin``, less the words at their edges that are held in part."""
    n = len(letters.at)
    step = np.zeros(n + 1, np.int64)
    step[begin] += 1
    step[begin + size] -= 1
    new = np.ones(n + 1, bool)
    new[1:n] = letters.text[1:] != letters.text[:-1]
    first, last = runs(np.cumsum(step[:n]) > 0, np.flatnonzero(new[:n]))
    apart = new.copy()
    apart[1:n] |= letters.at[1:] != letters.at[:-1] + 1
    # Scripts without case may be written without spaces: there an edge may be anywhere.
    free = ~cased_table()[letters.codes]
    heads, tails = np.flatnonzero(apart[:n] | free), np.flatnonzero(apart[1:] | free)
    if len(first):
        first = np.append(heads, n)[np.searchsorted(heads, first)]
        last = np.append(-1, tails)[np.searchsorted(tails, last)] + 1
        whole = last - first >= size
        first, last = first[whole], last[whole]
    text = letters.text[first]
    row = pa.array(text)
    return pa.table({
        "key": part["key"].take(row), "text_no": part["text_no"].take(row), "char_begin": pa.array(letters.at[first] - letters.starts[text]), "char_end": pa.array(letters.at[last - 1] + 1 - letters.starts[text])
    })


def repeated_spans(df: DataFrame, key: str, source: str, page: str, texts: str, pages: int = 6, fewest: int = 16, part: int = PART) -> DataFrame:
    """Character spans of repeated passages, without regard to lines: ``key``, text_no, char_begin, char_end.

    Every run of ``fewest`` letters that stands on at least ``pages`` distinct pages of its source is repeated; letters
    of such runs that follow each other in a text form one span. A word that a span's edge would cut is left out of it
    (in scripts with case), and a span must keep ``fewest`` letters. What counts as a letter, and which texts have
    none, is as in ``repeated_lines``. All rows of one page are handled together.
    """
    each = _texts(df, key, source, page, texts)
    sizes = each.groupBy("source").agg(F.sum(F.length("text")).alias("size"))
    total = sizes.agg(F.sum("size")).first()[0] or 0
    # At most total / part sources are large.
    large = sizes.where(F.col("size") > part).select("source", F.ceil(F.col("size") / part).alias("parts"))
    placed = each.join(F.broadcast(large), "source", "left")

    def local(t: pa.Table) -> pa.Table:
        letters, begin, hashes, on = _windows(t, fewest)
        found, counts = _page_counts(hashes, on, pages)
        return _spans(t, letters, begin[_member(hashes, found[counts >= pages])], fewest)

    def count(t: pa.Table) -> pa.Table:
        _, _, hashes, on = _windows(t, fewest)
        found, counts = _page_counts(hashes, on, 1)
        return pa.table({"part": pa.repeat(t["part"][0], len(found)), "run": pa.array(found.view(np.int64)), "pages": pa.array(counts.astype(np.int32))})

    def mark(t: pa.Table, known: pa.Table) -> pa.Table:
        if not t.num_rows or not known.num_rows:
            return pa.table({f: pa.array([], pa.int32() if f == "text_no" else pa.int64()) for f in ("key", "text_no", "char_begin", "char_end")})
        letters, begin, hashes, _ = _windows(t, fewest)
        return _spans(t, letters, begin[_member(hashes, np.sort(known["run"].to_numpy().view(np.uint64)))], fewest)

    small = placed.where("parts IS NULL").withColumn("part", F.pmod(F.col("source"), F.lit(max(1, total // part))))
    found = small.groupBy("part").applyInArrow(local, _SPAN)
    spread = placed.where("parts IS NOT NULL").withColumn("part", F.xxhash64("source", F.pmod(F.xxhash64("page"), F.col("parts"))))
    counted = spread.groupBy("part").applyInArrow(count, "part long, run long, pages int")
    # A run has one row in each part at most.
    known = counted.withColumn("n", F.sum("pages").over(Window.partitionBy("run"))).where(F.col("n") >= pages).select("part", "run")
    found = found.unionByName(spread.groupBy("part").cogroup(known.groupBy("part")).applyInArrow(mark, _SPAN))
    return found.select(F.col("key").alias(key), "text_no", "char_begin", "char_end").distinct()
