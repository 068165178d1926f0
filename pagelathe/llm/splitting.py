"""Splitting oversized texts at natural boundaries.

Recursive separator hierarchy: section, paragraph, sentence, word, character. Whole sections are packed greedily up to the
limit; only a section that no piece can hold is split into paragraphs, and so on down. The next piece starts a fixed overlap before the cut.
Pieces are described by code-point positions, so joining them without their overlaps gives back the text.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: What ends a unit at each level of the hierarchy, strongest first. A cut falls after the match.
SEPARATORS = (
    ("section", r"\n\s*\n\s*\n+|\f|\n(?=#{1,6} )"),
    ("paragraph", r"\n[^\S\n]*\n"),
    ("sentence", r"[.!?](?=\s)\s*|。\s*|\n"),
    ("word", r"\s+|[.!?]"),
)
_COMPILED = [(name, re.compile(pattern)) for name, pattern in SEPARATORS]
_BREAKABLE = re.compile(r"[\s.!?。]")


def cut_points(text: str) -> list[np.ndarray]:
    """Positions after which each level of the hierarchy allows a cut, in order of the levels."""
    return [np.fromiter((m.end() for m in pattern.finditer(text)), dtype=np.int64) for _, pattern in _COMPILED]


def split_spans(text: str, limit: int, overlap: int) -> list[tuple[int, int, str]]:
    """Begin, end and boundary of each piece of ``text``; a text within the limit is one piece.

    Units are taken in order: a unit that fits is added whole, one that fits a piece of its own ends the present piece before it, and one that
    fits none is split at the next level, its parts taken likewise.
    """
    size = len(text)
    if size <= limit:
        return [(0, size, "end")] if size else []
    points = cut_points(text)
    spans: list[tuple[int, int, str]] = []
    begin = end = 0
    boundary = "end"
    # Units to come, next one last: begin, end, level it was split at, and the boundary after it.
    units = [(0, size, -1, "end")]
    while size - begin > limit:
        first, last, level, after = units.pop()
        if last - begin <= limit:
            end, boundary = last, after
        elif last - first > limit - overlap and level + 1 < len(points):
            at = points[level + 1]
            inner = at[np.searchsorted(at, first, "right") : np.searchsorted(at, last, "left")].tolist()
            edges = [first, *inner, last]
            parts = [(x, y, level + 1, SEPARATORS[level + 1][0]) for x, y in zip(edges, edges[1:])]
            parts[-1] = (*parts[-1][:3], after)
            units += reversed(parts)
        else:
            units.append((first, last, level, after))
            if end <= begin + overlap:
                # A run without any boundary: cut where the piece is full.
                end, boundary = begin + limit, "character"
                units[-1] = (end, last, level, after)
            spans.append((begin, end, boundary))
            begin = end - overlap
    spans.append((begin, size, "end"))
    return spans


def longest_unbreakable(text: str) -> int:
    """Length of the longest run that holds neither whitespace nor a sentence end."""
    last, most = -1, 0
    for m in _BREAKABLE.finditer(text):
        most = max(most, m.start() - last - 1)
        last = m.start()
    return max(most, len(text) - last - 1)


def _pieces(limit: int, overlap: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = [batch.column(0).to_pylist(), batch.column(1).to_pylist()]
            rows: list[tuple] = []
            held = 0
            for row, text in enumerate(batch.column(2)):
                value = text.as_py()
                forced = int(longest_unbreakable(value) > limit)
                for no, (b, e, level) in enumerate(split_spans(value, limit, overlap)):
                    rows.append((keys[0][row], keys[1][row], no, b, e, level, forced, value[b:e]))
                held += len(value)
                if held > 4_000_000:
                    yield _batch(rows)
                    rows, held = [], 0
            yield _batch(rows)

    return run


_PIECE = pa.schema([("owner", pa.int64()), ("text_no", pa.int32()), ("piece_no", pa.int32()), ("char_begin", pa.int64()), ("char_end", pa.int64()), ("boundary", pa.string()), ("forced", pa.int32()), ("piece", pa.string())])
_PIECE_DDL = "owner long, text_no int, piece_no int, char_begin long, char_end long, boundary string, forced int, piece string"


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows)) if rows else [[] for _ in _PIECE]
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _PIECE)], schema=_PIECE)


def split_texts(df: DataFrame, key: str, texts: str, limit: int = 2000, overlap: int = 200) -> DataFrame:
    """Pieces of every text longer than ``limit`` code points in the array column ``texts``.

    Columns: ``key``, text_no (position in the array), piece_no, char_begin, char_end, boundary (the level of
    the cut that ends the piece: section, paragraph, sentence, word, character or end), forced (1 if the text has a
    run of more than ``limit`` characters without whitespace or sentence end) and piece. Each piece has at
    most ``limit`` code points and starts exactly ``overlap`` before the end of the one before.
    Null arrays, null and empty texts and texts within the limit yield nothing; they need no cut. Rows with the
    same key are split each for itself. Rows without a key yield a null key. Only texts over the limit leave the JVM.
    """
    if not 0 <= overlap < limit // 2:
        raise ValueError("overlap must be at least 0 and less than half of the limit")
    each = df.select(F.col(key).cast("long").alias("owner"), F.posexplode(F.col(texts)).alias("text_no", "text"))
    long_ones = each.where(F.length("text") > limit)
    return long_ones.mapInArrow(_pieces(limit, overlap), _PIECE_DDL).withColumnRenamed("owner", key)
