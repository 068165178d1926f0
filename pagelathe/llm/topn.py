"""Top N items within every group, by partition lower bounds.

A score to be greatest is negated first, so the smallest are wanted throughout. Each task keeps, of every group it meets, the N best distinct items of what it has seen: the N-th of them
bounds the group's final N-th from the wrong side, so nothing beyond it can be in the result. The bounds
of all tasks meet in one aggregation (a row per group and task, partly aggregated before the shuffle), the
tightest is joined back, survivors beyond it go, and only what is left is ranked.
A group with millions of items thus reaches the ranking with at most N rows of each task, and a group too
small to fill N in a task passes whole; no row is dropped that could be in the result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pagelathe.session import cut

_GROUP, _ITEM, _SCORE, _BOUND = "__group", "__item", "__score", "__bound"


def _best(group: np.ndarray, item: np.ndarray, score: np.ndarray, n: int) -> tuple[np.ndarray, ...]:
    """The n best distinct items of each group, and each row's bound (inf where the group has fewer)."""
    order = np.lexsort((score, item, group))
    g, i, s = group[order], item[order], score[order]
    first = np.ones(len(g), bool)
    first[1:] = (g[1:] != g[:-1]) | (i[1:] != i[:-1])
    g, i, s = g[first], i[first], s[first]
    order = np.lexsort((i, s, g))
    g, i, s = g[order], i[order], s[order]
    new = np.ones(len(g), bool)
    new[1:] = g[1:] != g[:-1]
    start = np.flatnonzero(new)
    rank = np.arange(len(g)) - np.repeat(start, np.diff(np.append(start, len(g))))
    keep = rank < n
    g, i, s, rank = g[keep], i[keep], s[keep], rank[keep]
    new = rank == 0
    which = np.cumsum(new) - 1
    bound = np.full(int(new.sum()), np.inf)
    full = rank == n - 1
    bound[which[full]] = s[full]
    return g, i, s, bound[which]


def _local_best(n: int, merge_rows: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, ...]] = []
        rows = 0

        def flush() -> pa.RecordBatch:
            g, i, s, b = _best(*(np.concatenate(c) for c in zip(*held)), n)
            return pa.RecordBatch.from_arrays([pa.array(g), pa.array(i), pa.array(s), pa.array(b)], names=[_GROUP, _ITEM, _SCORE, _BOUND])

        for batch in batches:
            if not batch.num_rows:
                continue
            held.append(tuple(batch.column(k).to_numpy(zero_copy_only=False) for k in range(3)))
            rows += batch.num_rows
            if rows >= merge_rows:
                yield flush()
                held, rows = [], 0
        if held:
            yield flush()

    return run


def top_n(df: DataFrame, group: str, item: str, score: str, n: int, merge_rows: int = 200_000, largest: bool = False, valid: Column | str | None = None) -> DataFrame:
    """The ``n`` items of smallest (with ``largest``, of greatest) ``score`` of each group: columns ``group``, ``item``, ``score``, ``rank`` (from 1).

    ``group`` and ``item`` are integer columns, ``score`` is a number of any sign. An item counts once per group, with its
    best valid score. Ties go to the smaller item. Scores that are null or NaN, rows without group or item, and rows that fail the
    condition ``valid`` if one is given, never count; a group without a valid row is absent, one with fewer than
    ``n`` items yields what it has. Repeated rows change nothing. Other columns of ``df`` are ignored, whatever
    their names. An empty table gives an empty result. ``merge_rows`` bounds what a task holds at once.
    """
    if n < 1:
        raise ValueError("n must be at least 1")
    rows = df if valid is None else df.where(valid)
    toward = F.col(score).cast("double") * (-1.0 if largest else 1.0)
    known = rows.select(F.col(group).cast("long").alias(_GROUP), F.col(item).cast("long").alias(_ITEM), toward.alias(_SCORE)).where(
        F.col(_GROUP).isNotNull() & F.col(_ITEM).isNotNull() & F.col(_SCORE).isNotNull() & ~F.isnan(_SCORE)
    )
    schema = T.StructType([T.StructField(_GROUP, T.LongType()), T.StructField(_ITEM, T.LongType()), T.StructField(_SCORE, T.DoubleType()), T.StructField(_BOUND, T.DoubleType())])
    survivors = cut(known.mapInArrow(_local_best(n, merge_rows), schema), "topn")
    bounds = survivors.groupBy(_GROUP).agg(F.min(_BOUND).alias("__tightest"))
    within = survivors.drop(_BOUND).join(bounds, _GROUP).where(F.col(_SCORE) <= F.col("__tightest"))
    distinct = within.groupBy(_GROUP, _ITEM).agg(F.min(_SCORE).alias(_SCORE))
    ranked = distinct.withColumn("rank", F.row_number().over(Window.partitionBy(_GROUP).orderBy(_SCORE, _ITEM))).where(F.col("rank") <= n)
    return ranked.select(F.col(_GROUP).alias(group), F.col(_ITEM).alias(item), (F.col(_SCORE) * (-1.0 if largest else 1.0)).alias(score), "rank")
