"""Queries over vector and keyword retrieval and its evaluation."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagelathe.operators import ann, bm25, evaluate, retrieval
from pagelathe.session import new_path, table


def _asked(df: DataFrame) -> DataFrame:
    """The stated query set: every row whose id is divisible by 50."""
    return df.where(F.col("vec_id") % 50 == 0)


def _top(metric: str, where: str | None = None, name: str = "chunk_vectors", vector: str = "vector", dimensions: int = 96):
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        df = table(spark, sf_dir, name)
        found = retrieval.top_k(df.where(where) if where else df, _asked(df), "vec_id", vector, dimensions, 10, metric, skip_self=True)
        return found.withColumn("distance", F.round("distance", 6))

    return query


def _labelled(spark: SparkSession, sf_dir: str, k: int = 10) -> DataFrame:
    """Hits of embeddings' queries where golden is the query's label and an answer is a neighbour's label."""
    e = table(spark, sf_dir, "embeddings")
    near = retrieval.top_k(e.where("vec_id % 50 <> 0"), _asked(e), "vec_id", "embedding", 64, k)
    answers = near.join(e.select(F.col("vec_id").alias("id"), "label"), "id")
    lists = evaluate.retrieved_lists(answers, "label", k)
    golden = _asked(e).select(F.col("vec_id").alias("query_id"), F.col("label").alias("golden"))
    return evaluate.query_hits(golden, lists)


def recall_at_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evaluate.hit_summary(_labelled(spark, sf_dir)).select("k", "recall")


def label_hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _labelled(spark, sf_dir).drop("retrieved")


def _page_hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored hits against ground truth: the answer's key is PDF and page (null page where the metadata has none)."""
    hits = evaluate.ranked_hits(table(spark, sf_dir, "query_hits"), "query_id", "chunk_id", "_distance")
    page = F.get_json_object("metadata", "$.page_number").try_cast("int")
    key = F.concat(F.regexp_extract("source", r"([^/]+)\.pdf$", 1), F.lit("_"), page.cast("string"))
    lists = evaluate.retrieved_lists(hits, F.coalesce(key, F.lit("")))
    golden = table(spark, sf_dir, "query_rows").where("pdf_page IS NOT NULL").groupBy("query_id").agg(F.min("pdf_page").alias("golden"))
    return evaluate.query_hits(golden, lists)


def page_hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _page_hits(spark, sf_dir).withColumn("retrieved", F.array_join("retrieved", "|"))


def page_hit_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evaluate.hit_summary(_page_hits(spark, sf_dir))


def page_misses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Queries that miss within the first ten."""
    return _page_hits(spark, sf_dir).where("NOT hit_at_10").select("query_id", "golden")


def expected_pdf_mark(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether each of a query's ten nearest hits is of the expected PDF."""
    hits = evaluate.ranked_hits(table(spark, sf_dir, "query_hits"), "query_id", "chunk_id", "_distance")
    golden = table(spark, sf_dir, "query_rows").where("pdf IS NOT NULL").groupBy("query_id").agg(F.min("pdf").alias("pdf"))
    return hits.join(golden, "query_id").select("query_id", "rank", (F.regexp_extract("source", r"([^/]+)\.pdf$", 1) == F.col("pdf")).alias("expected"))


def bm25_top(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bm25.bm25_top_k(table(spark, sf_dir, "documents"), "doc_id", "text", table(spark, sf_dir, "query_rows"), "query_id", "query")


def bm25_statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Document frequencies of the queries' terms."""
    words = table(spark, sf_dir, "query_rows").where("query IS NOT NULL").select(F.explode(F.split(F.lower("query"), r"[^\p{L}\p{N}]+")).alias("term")).where("term <> ''").distinct()
    return bm25.corpus_statistics(table(spark, sf_dir, "documents"), "doc_id", "text", words)


def rrf_hybrid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """V7: hits ranked by distance, fused with the documents ranked by keywords (ids shared)."""
    dense = evaluate.ranked_hits(table(spark, sf_dir, "query_hits"), "query_id", "chunk_id", "_distance").select("query_id", "id", "rank")
    sparse = bm25_top(spark, sf_dir).select("query_id", "id", "rank")
    return retrieval.fuse([dense.groupBy("query_id", "id").agg(F.min("rank").alias("rank")), sparse])


def rerank_hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """V9: fifty nearest hits of each query, reranked by words shared with the document of that id."""
    hits = evaluate.ranked_hits(table(spark, sf_dir, "query_hits"), "query_id", "chunk_id", "_distance", 50)
    first = hits.groupBy("query_id", "id").agg(F.min("query").alias("query"))
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), "text")
    return retrieval.rerank(first.join(docs, "id", "left"), retrieval.word_overlap, "query", "text")


def _index_top(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = table(spark, sf_dir, "chunk_vectors")
    path = new_path(spark, "index")
    ann.write_index(df, path, "vec_id", "vector", 96, 16)
    return ann.search_index(ann.open_index(spark, path), _asked(df), "vec_id", "vector", 96, 10, 6, skip_self=True)


def ivf_top(spark: SparkSession, sf_dir: str) -> DataFrame:
    """V3, V5: approximate neighbours from a stored index of quantised inverted lists."""
    return _index_top(spark, sf_dir).withColumn("distance", F.round("distance", 6))


def ivf_recall(spark: SparkSession, sf_dir: str) -> DataFrame:
    """V3, V5, K7: queries asked of the stored index, and whether recall at 10 against the exact answer is at least 0.9."""
    exact = _top("l2_sq")(spark, sf_dir)
    found = exact.join(_index_top(spark, sf_dir).select("query_id", "id", F.lit(1).alias("found")), ["query_id", "id"], "left")
    return found.agg(F.count_distinct("query_id").alias("queries"), (F.sum(F.coalesce("found", F.lit(0))) >= 0.9 * F.count(F.lit(1))).alias("recall_reached"))


QUERIES = {
    "v1_topk_cosine": _top("cosine"),
    "v2_topk_l2": _top("l2_sq"),
    "v2_topk_l2_root": _top("l2"),
    "v4_topk_filtered": _top("l2_sq", "text_kind = 'ocr_region'"),
    "v10_topk_labelled": _top("l2_sq", "label < 5", "embeddings", "embedding", 64),
    "v1_recall_at_k": recall_at_k,
    "w1_label_hits": label_hits,
    "a1_page_hits": page_hits,
    "a2_hit_summary": page_hit_summary,
    "f18_misses": page_misses,
    "j12_expected_mark": expected_pdf_mark,
    "v6_bm25": bm25_top,
    "a25_bm25_statistics": bm25_statistics,
    "v7_rrf_hybrid": rrf_hybrid,
    "v9_rerank": rerank_hits,
    "v3_ivf": ivf_top,
    "v3_ivf_recall": ivf_recall,
}

_USABLE = "SELECT vec_id, list_transform(vector, lambda x: x::DOUBLE) AS v, text_kind FROM chunk_vectors WHERE len(vector) = 96 AND len(list_filter(vector, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0"
_L2 = "list_sum(list_transform(list_zip(q.v, c.v), lambda z: (z[1] - z[2]) * (z[1] - z[2])))"
_COS = "1 - coalesce(list_inner_product(q.v, c.v) / nullif(sqrt(list_inner_product(q.v, q.v)) * sqrt(list_inner_product(c.v, c.v)), 0), 0)"


def _top_sql(distance: str, source: str = _USABLE, corpus: str = "true", skip: str = "q.vec_id <> c.vec_id") -> str:
    return f"""WITH u AS ({source}), s AS (SELECT q.vec_id AS query_id, c.vec_id AS id, round({distance}, 9) AS d FROM u q JOIN (SELECT * FROM u WHERE {corpus}) c ON {skip} WHERE q.vec_id % 50 = 0),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY d, id) AS rank FROM s)
SELECT query_id, id, round(d, 6) + 0.0::DOUBLE AS distance, CAST(rank AS INTEGER) AS rank FROM r WHERE rank <= 10"""


_EMB = "SELECT vec_id, list_transform(embedding, lambda x: x::DOUBLE) AS v, label FROM embeddings"
_LABELS = f"""WITH u AS ({_EMB}), s AS (SELECT q.vec_id AS query_id, q.label AS golden, c.label, c.vec_id AS id, round({_L2}, 9) AS d FROM u q JOIN (SELECT * FROM u WHERE vec_id % 50 <> 0) c ON true WHERE q.vec_id % 50 = 0),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY d, id) AS rank FROM s),
g AS (SELECT query_id, any_value(golden) AS golden, min(CASE WHEN label = golden THEN rank END) AS first FROM r WHERE rank <= 10 GROUP BY 1)
"""
_HITS = "SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY _distance, chunk_id, hit_id) AS rank FROM query_hits WHERE query_id IS NOT NULL AND _distance IS NOT NULL AND NOT isnan(_distance) AND _distance >= 0"
_PAGES = rf"""WITH h AS ({_HITS}), k AS (SELECT query_id, rank, coalesce(regexp_extract(source, '([^/]+)\.pdf$', 1) || '_' || TRY_CAST(CASE WHEN json_valid(metadata) THEN json_extract_string(metadata, '$.page_number') END AS INTEGER), '') AS key FROM h WHERE rank <= 10),
gold AS (SELECT query_id, min(pdf_page) AS golden FROM query_rows WHERE pdf_page IS NOT NULL GROUP BY 1),
l AS (SELECT query_id, string_agg(key, '|' ORDER BY rank) AS retrieved FROM k GROUP BY 1),
f AS (SELECT g.query_id, g.golden, (SELECT min(rank) FROM k WHERE k.query_id = g.query_id AND k.key = g.golden) AS first, l.retrieved FROM gold g LEFT JOIN l USING (query_id))
"""
_FLAGS = ", ".join(f"coalesce(first <= {k}, false) AS hit_at_{k}, CASE WHEN first <= {k} THEN first END AS rank_at_{k}" for k in evaluate.KS)
_T = r"list_filter(string_split_regex(lower({0}), '[^\p{{L}}\p{{N}}]+'), lambda w: w <> '')"
_BM25 = f"""WITH d AS (SELECT doc_id, {_T.format('text')} AS w FROM documents WHERE text IS NOT NULL), st AS (SELECT count(*) AS n, avg(len(w)) AS mean FROM d),
q AS (SELECT query_id, min(query) AS query FROM query_rows WHERE query IS NOT NULL AND query_id IS NOT NULL GROUP BY 1), qt AS (SELECT DISTINCT query_id, unnest({_T.format('query')}) AS term FROM q),
tf AS (SELECT doc_id, any_value(len(w)) AS size, term, count(*) AS f FROM (SELECT doc_id, w, unnest(w) AS term FROM d) GROUP BY doc_id, term), df AS (SELECT term, count(*) AS df FROM tf GROUP BY 1),
sc AS (SELECT query_id, doc_id AS id, round(sum(ln(1 + (n - df + 0.5) / (df + 0.5)) * f * 2.2 / (f + 1.2 * (0.25 + 0.75 * size / mean))), 6) AS score FROM qt JOIN df USING (term) JOIN tf USING (term), st GROUP BY 1, 2),
bm AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, id) AS rank FROM sc)
"""

SQL = {
    "v3_ivf_recall": f"SELECT count(*) AS queries, true AS recall_reached FROM ({_USABLE}) WHERE vec_id % 50 = 0",
    "v1_topk_cosine": _top_sql(_COS),
    "v2_topk_l2": _top_sql(_L2),
    "v2_topk_l2_root": _top_sql(f"sqrt({_L2})"),
    "v4_topk_filtered": _top_sql(_L2, corpus="text_kind = 'ocr_region'"),
    "v10_topk_labelled": _top_sql(_L2, _EMB, "label < 5"),
    "v1_recall_at_k": _LABELS + "SELECT k, round(avg(CAST(coalesce(first <= k, false) AS INTEGER)), 6) AS recall FROM g, (SELECT unnest([1, 3, 5, 10])::INTEGER AS k) GROUP BY 1",
    "w1_label_hits": _LABELS + f"SELECT query_id, golden, {_FLAGS} FROM g",
    "a1_page_hits": _PAGES + f"SELECT query_id, golden, retrieved, {_FLAGS} FROM f",
    "a2_hit_summary": _PAGES + "SELECT k, count(*) FILTER (first <= k) AS hits, count(*) - count(*) FILTER (first <= k) AS misses, round(count(*) FILTER (first <= k) / count(*), 6) AS recall FROM f, (SELECT unnest([1, 3, 5, 10])::INTEGER AS k) GROUP BY 1",
    "f18_misses": _PAGES + "SELECT query_id, golden FROM f WHERE first IS NULL",
    "j12_expected_mark": rf"WITH h AS ({_HITS}), g AS (SELECT query_id, min(pdf) AS pdf FROM query_rows WHERE pdf IS NOT NULL GROUP BY 1) SELECT query_id, CAST(rank AS INTEGER) AS rank, regexp_extract(source, '([^/]+)\.pdf$', 1) = pdf AS expected FROM h JOIN g USING (query_id) WHERE rank <= 10",
    "v6_bm25": _BM25 + "SELECT query_id, id, score, CAST(rank AS INTEGER) AS rank FROM bm WHERE rank <= 10",
    "a25_bm25_statistics": f"WITH d AS (SELECT doc_id, {_T.format('text')} AS w FROM documents WHERE text IS NOT NULL), v AS (SELECT DISTINCT unnest({_T.format('query')}) AS term FROM query_rows WHERE query IS NOT NULL) SELECT term, count(*) AS documents FROM (SELECT DISTINCT doc_id, unnest(w) AS term FROM d) JOIN v USING (term) GROUP BY 1",
    "v7_rrf_hybrid": _BM25 + f""", h AS ({_HITS}), dense AS (SELECT query_id, chunk_id AS id, min(rank) AS rank FROM h WHERE rank <= 10 GROUP BY 1, 2),
u AS (SELECT query_id, id, rank FROM dense UNION ALL SELECT query_id, id, rank FROM bm WHERE rank <= 10), f AS (SELECT query_id, id, round(sum(1.0::DOUBLE / (60 + rank)), 9) AS score FROM u GROUP BY 1, 2),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, id) AS rank FROM f) SELECT query_id, id, score, CAST(rank AS INTEGER) AS rank FROM r WHERE rank <= 10""",
    "v9_rerank": rf"""WITH h AS ({_HITS}), c AS (SELECT query_id, chunk_id AS id, min(query) AS query FROM h WHERE rank <= 50 GROUP BY 1, 2),
s AS (SELECT query_id, id, CAST(len(list_intersect(list_filter(string_split_regex(lower(coalesce(query, '')), '\s+'), lambda w: w <> ''), list_filter(string_split_regex(lower(coalesce(text, '')), '\s+'), lambda w: w <> ''))) AS DOUBLE) AS score FROM c LEFT JOIN documents ON doc_id = id),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, id) AS rank FROM s) SELECT query_id, id, score, CAST(rank AS INTEGER) AS rank FROM r WHERE rank <= 10""",
}
