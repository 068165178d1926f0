"""Queries over vectors, metrics and hits (problems 1, 2 and 5)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagelathe.llm.neighbours import LIST_ROWS, nearest, similar_pairs, usable_vectors
from pagelathe.llm.quantiles import merge_sketches, metric_values, read_quantiles, sketch_groups
from pagelathe.llm.topn import top_n
from pagelathe.operators.retrieval import top_k
from pagelathe.session import table

_METRIC = ["run_day", "metric_field", "metric_name"]
_PERCENTILES = [0.5, 0.9, 0.95, 0.99]


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Similar pairs among all usable vectors."""
    pairs = similar_pairs(table(spark, sf_dir, "chunk_vectors"), "vec_id", "vector")
    return pairs.withColumnsRenamed({"id_a": "vec_id_a", "id_b": "vec_id_b"})


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups whose 95th percentile is at least 3 times their median."""
    sketches = sketch_groups(metric_values(table(spark, sf_dir, "page_metrics")), _METRIC, "value")
    q = read_quantiles(sketches, [0.5, 0.95])
    return q.where(F.col("quantiles")[1] >= 3 * F.col("quantiles")[0]).select(*_METRIC)


def p2_overall(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Percentiles of each metric over all days, from the days' sketches."""
    days = sketch_groups(metric_values(table(spark, sf_dir, "page_metrics")), _METRIC, "value")
    q = read_quantiles(merge_sketches(days, _METRIC[1:]), _PERCENTILES)
    return q.select("metric_field", "metric_name", "n", *[F.col("quantiles")[i].alias(f"p{round(100 * p)}") for i, p in enumerate(_PERCENTILES)])


def p2_rank_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Percentiles of each metric over all days by small sketches (section 8, so that they compact), with the exact ranks of what they give.

    ``sound`` tells whether every percentile's rank is off by at most a third of its distance to the upper tail, beside one value.
    """
    values = metric_values(table(spark, sf_dir, "page_metrics")).where(F.col("value").isNotNull() & ~F.isnan("value") & (F.col("value") >= 0))
    q = read_quantiles(sketch_groups(values, _METRIC[1:], "value", section=8), _PERCENTILES).select(*_METRIC[1:], "n", "quantiles")
    at = F.array(*[F.lit(p) for p in _PERCENTILES])
    # Values up to each percentile, and below it: its exact rank lies between.
    seen = values.join(q, _METRIC[1:])
    tally = lambda test, name: [F.sum(test(F.col("value"), F.col("quantiles")[i]).cast("long")).alias(f"{name}{i}") for i in range(len(_PERCENTILES))]
    ranks = seen.groupBy(*_METRIC[1:]).agg(F.count(F.lit(1)).alias("n"), *tally(lambda v, x: v <= x, "upto"), *tally(lambda v, x: v < x, "below"))
    sound = F.lit(True)
    for i in range(len(_PERCENTILES)):
        share, slack = at[i] * F.col("n"), (1 - at[i]) * F.col("n") / 3 + 1
        sound = sound & (F.col(f"upto{i}") >= share - slack) & (F.col(f"below{i}") <= share + slack)
    return ranks.select(*_METRIC[1:], "n", sound.alias("sound"))


def p1_k_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 10 nearest of every usable vector without a floor, through several lists, measured on the queries whose id is divisible by 50.

    One row: queries, and whether recall against brute force over all rows is at least 0.9.
    """
    usable = usable_vectors(table(spark, sf_dir, "chunk_vectors"), "vec_id", "vector", 96)
    rows = usable.count()
    near = nearest(usable, 96, 10, rows=rows, probes=8, list_rows=min(LIST_ROWS, max(64, rows // 16)))
    unit = usable.select("id", F.transform("vector", lambda x: x.cast("double")).alias("vector"))
    exact = top_k(unit, unit.where("id % 50 = 0"), "id", "vector", 96, k=10, metric="cosine", skip_self=True)
    # A neighbour as near as the tenth nearest is as good as it.
    tenth = exact.groupBy("query_id").agg(F.max("distance").alias("tenth"), F.count(F.lit(1)).alias("wanted"))
    found = near.where("id % 50 = 0").join(tenth, F.col("id") == F.col("query_id")).where("1 - similarity <= tenth + 1e-6").groupBy("query_id").agg(F.count(F.lit(1)).alias("found"))
    each = tenth.join(found, "query_id", "left").select("wanted", F.coalesce("found", F.lit(0)).alias("found"))
    return each.agg(F.count(F.lit(1)).alias("queries"), (F.sum("found") >= 0.9 * F.sum("wanted")).alias("recall_reached"))


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ten nearest chunks of each query."""
    return p5_ranked(spark, sf_dir).select("query_id", "chunk_id")


def p5_ranked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with distance and rank."""
    return top_n(table(spark, sf_dir, "query_hits"), "query_id", "chunk_id", "_distance", 10, valid="_distance >= 0")


QUERIES = {"p1_found": p1_found, "p2_found": p2_found, "p1_k_nearest": p1_k_nearest, "p2_overall": p2_overall, "p2_rank_errors": p2_rank_errors, "p5_found": p5_found, "p5_ranked": p5_ranked}

_P1 = """
WITH u AS (SELECT vec_id AS id, list_transform(vector, lambda x: CAST(x AS DOUBLE)) AS v FROM chunk_vectors
  WHERE vector IS NOT NULL AND len(vector) = 96 AND len(list_filter(vector, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
    AND len(list_filter(vector, lambda x: x <> 0)) > 0),
n AS (SELECT id, list_transform(v, lambda x: x / m) AS v FROM (SELECT *, sqrt(list_inner_product(v, v)) AS m FROM u)),
s AS (SELECT a.id AS a, b.id AS b, list_inner_product(a.v, b.v) AS sim FROM n a JOIN n b ON a.id <> b.id),
r AS (SELECT *, row_number() OVER (PARTITION BY a ORDER BY round(sim, 7) DESC, b) AS k FROM s WHERE sim >= 0.85)
SELECT DISTINCT least(a, b) AS vec_id_a, greatest(a, b) AS vec_id_b FROM r WHERE k <= 5"""
_P2 = """
WITH once AS (
  SELECT DISTINCT ON (pdf_path, page_index, run_at) strftime(run_at, '%Y-%m-%d') AS run_day, timing_s, models FROM page_metrics),
each AS (
  SELECT run_day, 'timing_s' AS metric_field, unnest(map_keys(timing_s)) AS metric_name, unnest(map_values(timing_s)) AS v FROM once
  UNION ALL
  SELECT run_day, 'seconds', unnest(map_keys(models)), unnest(list_transform(map_values(models), lambda m: m.seconds)) FROM once),
valid AS (SELECT * FROM each WHERE v IS NOT NULL AND NOT isnan(v) AND v >= 0)
"""
_P5 = """
WITH best AS (
  SELECT query_id, chunk_id, min(_distance) AS _distance FROM query_hits
  WHERE query_id IS NOT NULL AND chunk_id IS NOT NULL AND _distance IS NOT NULL AND NOT isnan(_distance) AND _distance >= 0
  GROUP BY 1, 2),
ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY _distance, chunk_id) AS r FROM best)
"""
#: p2_overall has none: its percentiles are within a bound, not equal (see tests).
SQL = {
    "p1_found": _P1,
    "p2_found": _P2 + "SELECT run_day, metric_field, metric_name FROM valid GROUP BY ALL HAVING quantile_cont(v, 0.95) >= 3 * quantile_cont(v, 0.5)",
    "p1_k_nearest": """
SELECT count(*) AS queries, true AS recall_reached FROM chunk_vectors WHERE vec_id % 50 = 0 AND vector IS NOT NULL AND len(vector) = 96
  AND len(list_filter(vector, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0 AND len(list_filter(vector, lambda x: x <> 0)) > 0""",
    "p2_rank_errors": _P2 + "SELECT metric_field, metric_name, count(*) AS n, true AS sound FROM valid GROUP BY 1, 2",
    "p5_found": _P5 + "SELECT query_id, chunk_id FROM ranked WHERE r <= 10",
    "p5_ranked": _P5 + "SELECT query_id, chunk_id, _distance, CAST(r AS INTEGER) AS rank FROM ranked WHERE r <= 10",
}
