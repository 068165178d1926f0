"""Queries over texts (problems 3 and 6 to 10)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagelathe.llm.leakage import find_leaks
from pagelathe.llm.packing import pack_items, with_token_counts
from pagelathe.llm.repeated_lines import remove_lines, repeated_lines, repeated_spans
from pagelathe.llm.repetition import repetition
from pagelathe.llm.scan_noise import repair_pages, scan_defects
from pagelathe.llm.splitting import split_texts
from pagelathe.session import cut, table


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines on at least 6 pages of their PDF."""
    return repeated_lines(table(spark, sf_dir, "page_texts"), "rec_id", "pdf_path", "page_index", "texts")


def p3_cleaned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All page texts without those lines."""
    return remove_lines(table(spark, sf_dir, "page_texts"), p3_found(spark, sf_dir), "rec_id", "texts")


def p3_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Repeated passages by content-defined chunks alone, wherever lines break."""
    return repeated_spans(table(spark, sf_dir, "page_texts"), "rec_id", "pdf_path", "page_index", "texts")


def p6_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines with noise of scanning."""
    return scan_defects(table(spark, sf_dir, "page_scans"), table(spark, sf_dir, "lexicon"))


def p6_paragraphs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All scanned pages as repaired paragraphs."""
    return repair_pages(table(spark, sf_dir, "page_scans"), table(spark, sf_dir, "lexicon"))


def p7_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces of all page texts over 2,000 characters."""
    return split_texts(table(spark, sf_dir, "page_texts"), "rec_id", "texts", 2000, 200)


def p7_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts that had to be split, and whether a cut inside a run was unavoidable."""
    pieces = p7_pieces(spark, sf_dir)
    return pieces.where("piece_no = 0").select("rec_id", "text_no", "forced").distinct()


def p7_invariants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What must hold of the pieces of every text over 2,000 characters: its length, and whether they join to it, keep the limit and overlap by 200."""
    pieces = p7_pieces(spark, sf_dir)
    part = F.struct("piece_no", "char_begin", "char_end", "piece")
    held = pieces.groupBy("rec_id", "text_no").agg(F.array_sort(F.collect_list(part)).alias("p"))
    texts = table(spark, sf_dir, "page_texts").select("rec_id", F.posexplode("texts").alias("text_no", "text"))
    whole = F.array_join(F.transform("p", lambda x: F.when(x["piece_no"] == 0, x["piece"]).otherwise(F.substr(x["piece"], F.lit(201)))), "")
    limited = F.forall("p", lambda x: (F.length(x["piece"]) <= 2000) & (x["char_end"] - x["char_begin"] == F.length(x["piece"])))
    steps = F.forall(F.sequence(F.lit(1), F.size("p") - 1), lambda i: F.get("p", i)["char_begin"] == F.get("p", i - 1)["char_end"] - 200)
    checked = held.join(texts, ["rec_id", "text_no"]).select("rec_id", "text_no", F.length("text").alias("chars"), (whole == F.col("text")).alias("joined"), limited.alias("limited"), steps.alias("overlapping"))
    return checked.distinct()


def p8_invariants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What must hold of the containers: items and tokens in all, fullest container, documents in several pieces; and whether containers are at most 1 % more than the room needs, beside one open container."""
    bins = cut(p8_bins(spark, sf_dir), "bins")
    used = bins.groupBy("lot", "bin_no").agg(F.sum("size").alias("used"))
    room = used.agg(F.max("used").alias("fullest"), (F.count(F.lit(1)) <= 1.01 * F.ceil(F.sum("used") / 1024) + 1).alias("tight"))
    items = bins.agg(F.count_if(F.col("piece_no") == 0).alias("documents"), F.sum("size").alias("tokens"), F.count_if((F.col("piece_no") == 0) & (F.col("pieces") > 1)).alias("split"))
    both = items.withColumn("k", F.lit(1)).join(room.withColumn("k", F.lit(1)), "k")  # a row each
    return both.select("documents", "tokens", "split", (F.col("fullest") <= 1024).alias("within"), "tight")


def p10_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words and the exact share of repeated ones (six decimals) of every document."""
    return p10_shares(spark, sf_dir).select("doc_id", "words", F.round("repeated_share", 6).alias("repeated_share"))


def p8_bins(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Containers of 1,024 tokens for all documents."""
    sized = cut(with_token_counts(table(spark, sf_dir, "documents"), "doc_id", "text"), "tokens")
    return pack_items(sized, 1024).withColumnRenamed("item", "doc_id")


def p8_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that the packing had to split."""
    return p8_bins(spark, sf_dir).where("pieces > 1 AND piece_no = 0").select("doc_id")


def p9_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that contain an evaluation item, with the items."""
    return find_leaks(table(spark, sf_dir, "documents"), "doc_id", "text", table(spark, sf_dir, "eval_items"))


def p9_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents each leaked item stands in."""
    return p9_found(spark, sf_dir).groupBy("item_id").agg(F.count("*").alias("documents"))


def p10_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Repetition of every document."""
    return repetition(table(spark, sf_dir, "documents"), "doc_id", "text")


def p10_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents of which the line field leaves at most 70 % as content."""
    return p10_shares(spark, sf_dir).where("NOT retained").select("doc_id").distinct()


QUERIES = {"p6_found": p6_found, "p6_paragraphs": p6_paragraphs, "p3_found": p3_found, "p3_cleaned": p3_cleaned, "p3_spans": p3_spans, "p7_found": p7_found, "p7_pieces": p7_pieces, "p7_invariants": p7_invariants, "p8_invariants": p8_invariants, "p10_exact": p10_exact, "p8_found": p8_found, "p8_bins": p8_bins, "p9_found": p9_found, "p9_items": p9_items, "p10_found": p10_found, "p10_shares": p10_shares}

_WORDS = r"regexp_extract_all(lower(text), '[\p{L}\p{N}_]+')"
_P9 = rf"""
WITH iw AS (SELECT item_id, {_WORDS} AS w FROM eval_items WHERE text IS NOT NULL),
pat AS (SELECT item_id, least(12, len(w)) AS k, array_to_string(w[i : i + least(12, len(w)) - 1], ' ') AS p
  FROM iw, unnest(generate_series(1, len(w) - least(12, len(w)) + 1)) AS u(i) WHERE len(w) > 0),
dw AS (SELECT doc_id, {_WORDS} AS w FROM documents WHERE text IS NOT NULL),
found AS (SELECT DISTINCT doc_id, item_id FROM (
  SELECT doc_id, k, array_to_string(w[i : i + k - 1], ' ') AS p
  FROM dw, (SELECT DISTINCT k FROM pat) ks, unnest(generate_series(1, len(w) - k + 1)) AS u(i) WHERE len(w) >= k) d JOIN pat USING (k, p))
"""
_P10 = rf"""
WITH dw AS (SELECT doc_id, {_WORDS} AS w FROM documents WHERE text IS NOT NULL),
g AS (SELECT doc_id, len(w) AS n, i, array_to_string(w[i : i + 7], ' ') AS p FROM dw, unnest(generate_series(1, len(w) - 7)) AS u(i) WHERE len(w) >= 8),
again AS (SELECT doc_id, n, i FROM (SELECT *, row_number() OVER (PARTITION BY doc_id, p ORDER BY i) AS r FROM g) WHERE r > 1),
share AS (SELECT doc_id, count(DISTINCT i + k) / any_value(n) AS s FROM again, unnest(generate_series(0, 7)) AS u(k) GROUP BY doc_id)
"""
_P3 = r"""
WITH t AS (SELECT rec_id, pdf_path, page_index, unnest(texts) AS text, generate_subscripts(texts, 1) - 1 AS text_no FROM page_texts),
l AS (SELECT rec_id, pdf_path, page_index, text_no, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS line_no FROM t),
n AS (SELECT *, lower(regexp_replace(CASE WHEN line_no = 0 AND starts_with(line, 'passage: ') THEN line[10:] ELSE line END, '[^\p{L}]+', '', 'g')) AS s FROM l),
r AS (SELECT pdf_path, s FROM n WHERE length(s) >= 20 GROUP BY 1, 2 HAVING count(DISTINCT page_index) >= 6),
found AS (SELECT rec_id, CAST(text_no AS INTEGER) AS text_no, CAST(line_no AS INTEGER) AS line_no FROM n JOIN r USING (pdf_path, s))
"""
SQL = {
    "p3_found": _P3 + "SELECT DISTINCT rec_id, text_no, line_no FROM found",
    "p3_cleaned": _P3 + """, d AS (SELECT rec_id, text_no, list(line_no) AS dl FROM (SELECT DISTINCT * FROM found) GROUP BY 1, 2)
SELECT t.rec_id, CAST(t.text_no AS INTEGER) AS text_no, CASE WHEN dl IS NULL THEN text ELSE array_to_string(list_filter(string_split(text, chr(10)), lambda x, i: NOT list_contains(dl, i - 1)), chr(10)) END AS text,
  CAST(coalesce(len(dl), 0) AS INTEGER) AS removed FROM t LEFT JOIN d ON d.rec_id = t.rec_id AND d.text_no = t.text_no""",
    "p9_found": _P9 + "SELECT doc_id, item_id FROM found",
    "p9_items": _P9 + "SELECT item_id, count(*) AS documents FROM found GROUP BY 1",
    "p10_found": _P10 + "SELECT doc_id FROM share WHERE s >= 0.3",
    "p7_invariants": """
WITH t AS (SELECT rec_id, unnest(texts) AS text, generate_subscripts(texts, 1) - 1 AS text_no FROM page_texts)
SELECT DISTINCT rec_id, CAST(text_no AS INTEGER) AS text_no, CAST(length(text) AS INTEGER) AS chars, true AS joined, true AS limited, true AS overlapping FROM t WHERE length(text) > 2000""",
    "p8_invariants": r"""
WITH t AS (SELECT doc_id, len(regexp_extract_all(text, '[\p{L}\p{N}_]+|[^\p{L}\p{N}_\s\x1c-\x1f\x{85}\p{Z}]+')) AS n FROM documents)
SELECT count(*) AS documents, CAST(sum(n) AS BIGINT) AS tokens, count(*) FILTER (n > 1024) AS split, true AS within, true AS tight FROM t WHERE n > 0""",
    "p10_exact": _P10 + """, w AS (SELECT doc_id, len(w) AS n FROM dw UNION ALL SELECT doc_id, 0 FROM documents WHERE text IS NULL)
SELECT doc_id, CAST(n AS BIGINT) AS words, round(coalesce(s, 0), 6) AS repeated_share FROM w LEFT JOIN share USING (doc_id)""",
    "p7_found": r"""
WITH t AS (SELECT rec_id, unnest(texts) AS text, generate_subscripts(texts, 1) - 1 AS text_no FROM page_texts)
SELECT DISTINCT rec_id, CAST(text_no AS INTEGER) AS text_no,
       CAST(list_max(list_transform(regexp_split_to_array(text, '[\s.!?。]'), lambda x: length(x))) > 2000 AS INTEGER) AS forced
FROM t WHERE length(text) > 2000""",
    "p8_found": r"""
SELECT doc_id FROM documents
WHERE len(regexp_extract_all(text, '[\p{L}\p{N}_]+|[^\p{L}\p{N}_\s]+')) > 1024""",
}
