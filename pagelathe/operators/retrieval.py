"""Exact nearest neighbours of a stated query set, fusion and reranking.

The corpus is never shuffled for scoring: each batch of it meets the queries in one matrix product, keeps the k best
of the batch for each query, and only those are ranked against each other. Queries are broadcast in parts of
``MOST_QUERY_BYTES``; a larger query set reads the corpus once for each part, where it lies.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

MOST_QUERY_BYTES = 64 << 20
BLOCK_ROWS = 2048
METRICS = ("l2_sq", "l2", "cosine", "dot")
#: Fixed value: the constant of reciprocal-rank fusion.
RRF_CONSTANT = 60


def _scores(queries: np.ndarray, rows: np.ndarray, metric: str) -> np.ndarray:
    """Smaller is better. Rounded to 9 decimals, so equal vectors tie whatever the order of the sums."""
    product = queries @ rows.T
    if metric == "dot":
        out = -product
    elif metric == "cosine":
        size = np.linalg.norm(queries, axis=1)[:, None] * np.linalg.norm(rows, axis=1)[None]
        out = 1 - np.divide(product, size, out=np.zeros_like(product), where=size > 0)
    else:
        out = np.maximum((queries**2).sum(axis=1)[:, None] + (rows**2).sum(axis=1)[None] - 2 * product, 0)
        out = np.sqrt(out) if metric == "l2" else out
    return np.round(out, 9) + 0.0  # no negative zero


def _local_best(q_ids: np.ndarray, queries: np.ndarray, ids: np.ndarray, rows: np.ndarray, k: int, metric: str, skip_self: bool) -> pa.RecordBatch:
    """The k best of these rows for each query, ties by id."""
    out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    for at in range(0, len(q_ids), 512):
        s = _scores(queries[at : at + 512], rows, metric)
        own = q_ids[at : at + 512]
        if skip_self:
            s = np.where(own[:, None] == ids[None], np.inf, s)
        if s.shape[1] > k:
            bound = np.partition(s, k - 1, axis=1)[:, k - 1 : k]
            q, r = np.nonzero((s <= bound) & np.isfinite(s))
        else:
            q, r = np.nonzero(np.isfinite(s))
        order = np.lexsort((ids[r], s[q, r], q))
        q, r = q[order], r[order]
        first = np.searchsorted(q, np.arange(len(own)))
        keep = np.arange(len(q)) - first[q] < k
        q, r = q[keep], r[keep]
        out.append((own[q], ids[r], s[q, r]))
    a, b, c = (np.concatenate(x) for x in zip(*out)) if out else (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))
    return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(c, pa.float64())], names=["query_id", "id", "distance"])


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)


def _vectors(df: DataFrame, key: str, vector: str, dimensions: int) -> DataFrame:
    sound = F.forall(F.col(vector), lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return df.where(F.col(key).isNotNull() & (F.size(vector) == dimensions) & sound).select(F.col(key).cast("long").alias("id"), F.col(vector).alias("v"))


def top_k(corpus: DataFrame, queries: DataFrame, key: str, vector: str, dimensions: int, k: int = 10, metric: str = "l2_sq", skip_self: bool = False) -> DataFrame:
    """The ``k`` nearest rows of ``corpus`` to each query: query_id, id, distance, rank.

    ``distance`` is ``l2_sq``, ``l2``, ``1 - cosine`` or the negative dot product, rounded to 9 decimals; ties go to the smaller id.
    A filter belongs on ``corpus`` before the call. Rows without key, of another length, or with a null, NaN or infinite entry take no part.
    """
    if metric not in METRICS:
        raise ValueError(f"metric must be one of {METRICS}")
    asked, rows = _vectors(queries, key, vector, dimensions), _vectors(corpus, key, vector, dimensions)
    spark = corpus.sparkSession
    schema = "query_id long, id long, distance double"
    # Hashed parts vary in size; a larger one is broadcast in several.
    most = max(1, MOST_QUERY_BYTES // (dimensions * 8))
    parts = max(1, -(-asked.count() // most))
    near = None
    for part in range(parts):
        mine = asked if parts == 1 else asked.where(F.pmod(F.xxhash64("id"), F.lit(parts)) == part)
        found = mine.orderBy("id").toArrow().combine_chunks()
        for at in range(0, max(1, found.num_rows), most):
            some = found.slice(at, most)
            shared = spark.sparkContext.broadcast((some.column("id").to_numpy(), _matrix(some.column("v").combine_chunks()) if some.num_rows else np.zeros((0, dimensions))))
            one = rows.mapInArrow(_scan(shared, k, metric, skip_self), schema)
            near = one if near is None else near.unionByName(one)
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy("distance", "id"))
    return near.withColumn("rank", rank).where(F.col("rank") <= k)


def _scan(shared, k: int, metric: str, skip_self: bool):  # noqa: ANN001, ANN202
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        q_ids, q = shared.value
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK_ROWS):
                part = batch.slice(at, BLOCK_ROWS)
                yield _local_best(q_ids, q, part.column(0).to_numpy(), _matrix(part.column(1)), k, metric, skip_self)

    return run


def fuse(ranked: list[DataFrame], k: int = 10, constant: int = RRF_CONSTANT) -> DataFrame:
    """V7: reciprocal-rank fusion of ranked lists (query_id, id, rank): query_id, id, score, rank. Ties go to the smaller id."""
    each = [r.select("query_id", "id", (F.lit(1.0) / (F.lit(constant) + F.col("rank"))).alias("s")) for r in ranked]
    whole = each[0]
    for other in each[1:]:
        whole = whole.unionByName(other)
    score = whole.groupBy("query_id", "id").agg(F.round(F.sum("s"), 9).alias("score"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "id"))
    return score.withColumn("rank", rank).where(F.col("rank") <= k)


def rerank(candidates: DataFrame, scorer: Callable[[list[str], list[str]], list[float]], query: str, passage: str, k: int = 10, batch: int = 64) -> DataFrame:
    """The ``k`` best candidates of each query_id by ``scorer`` (query texts, passage texts -> scores, larger is better).

    Columns: query_id, id, score, rank. The scorer gets at most ``batch`` pairs at once, null texts as ``""``, and must return as many scores.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            for at in range(0, rows.num_rows, batch):
                part = rows.slice(at, batch)
                q, p = ([t or "" for t in part.column(c).to_pylist()] for c in (2, 3))
                scores = scorer(q, p)
                if len(scores) != len(q):
                    raise ValueError(f"the scorer returned {len(scores)} scores for {len(q)} pairs")
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(scores, pa.float64())], names=["query_id", "id", "score"])

    scored = candidates.select(F.col("query_id").cast("long").alias("query_id"), F.col("id").cast("long").alias("id"), F.col(query), F.col(passage)).mapInArrow(run, "query_id long, id long, score double")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "id"))
    return scored.withColumn("rank", rank).where(F.col("rank") <= k)


def word_overlap(queries: list[str], passages: list[str]) -> list[float]:
    """A deterministic scorer: distinct words the two share. It stands in for a cross-encoder, it is none."""
    words = lambda t: set(re.findall(r"[^ \t\n\r\f]+", t.lower()))
    return [float(len(words(q) & words(p))) for q, p in zip(queries, passages)]
