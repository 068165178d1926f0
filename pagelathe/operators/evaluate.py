"""Retrieval quality: hits, ranks and recall at k."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: The cut-offs reported.
KS = (1, 3, 5, 10)


def retrieved_lists(ranked: DataFrame, answer: Column | str, k: int = 10) -> DataFrame:
    """query_id and the array of answers in order of rank, at most ``k``: a bounded list, so it may be collected."""
    c = F.col(answer) if isinstance(answer, str) else answer
    short = ranked.where(F.col("rank") <= k).select("query_id", F.struct("rank", c.alias("a")).alias("r"))
    return short.groupBy("query_id").agg(F.transform(F.array_sort(F.collect_list("r")), lambda r: r["a"]).alias("retrieved"))


def ranked_hits(hits: DataFrame, query: str, item: str, distance: str, k: int = 10) -> DataFrame:
    """Hits in order of valid distance, ties by item: query_id, id, distance, rank; other columns are kept."""
    valid = hits.where(F.col(query).isNotNull() & F.col(distance).isNotNull() & ~F.isnan(distance) & (F.col(distance) >= 0))
    rank = F.row_number().over(Window.partitionBy(query).orderBy(distance, item, *[c for c in ("hit_id",) if c in hits.columns and c != item]))
    return valid.withColumn("rank", rank).where(F.col("rank") <= k).withColumnsRenamed({query: "query_id", item: "id", distance: "distance"})


def hit_columns(golden: Column | str, retrieved: Column | str, ks: Sequence[int] = KS) -> list[Column]:
    """hit_at_k and rank_at_k (from 1, null for a miss) for each k."""
    g, r = (F.col(c) if isinstance(c, str) else c for c in (golden, retrieved))
    first = [F.coalesce(F.array_position(F.slice(r, 1, k), g), F.lit(0)) for k in ks]
    return [c for k, p in zip(ks, first) for c in ((p > 0).alias(f"hit_at_{k}"), F.nullif(p, F.lit(0)).alias(f"rank_at_{k}"))]


def query_hits(golden: DataFrame, lists: DataFrame, ks: Sequence[int] = KS) -> DataFrame:
    """One row per query of ``golden`` (query_id, golden): hits and ranks; a query without results misses."""
    return golden.join(lists, "query_id", "left").select("query_id", "golden", "retrieved", *hit_columns("golden", "retrieved", ks))


def hit_summary(detail: DataFrame, ks: Sequence[int] = KS) -> DataFrame:
    """k, hits, misses, recall (null without queries)."""
    one = detail.agg(F.count(F.lit(1)).alias("n"), *[F.count_if(f"hit_at_{k}").alias(f"h{k}") for k in ks])
    stack = F.explode(F.array(*[F.struct(F.lit(k).alias("k"), F.col(f"h{k}").alias("hits")) for k in ks])).alias("s")
    return one.select("n", stack).select("s.k", "s.hits", (F.col("n") - F.col("s.hits")).alias("misses"), F.round(F.try_divide("s.hits", "n"), 6).alias("recall"))
