"""Queries over scalar functions: paths, texts, labels, boxes and vectors."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagelathe.functions import boxes, labels, text, vectors
from pagelathe.session import table

_W, _H = 1275, 1650


def _from(name: str, *columns, where: str | None = None):
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        df = table(spark, sf_dir, name)
        return (df.where(where) if where else df).select(*[c() if callable(c) else c for c in columns])

    return query


def _box(df: DataFrame) -> DataFrame:
    """Boxes made of line items, in [0, 1] for the most part."""
    made = F.array(F.col("l_discount") * 5, F.col("l_tax") * 5, F.col("l_discount") * 5 + F.col("l_quantity") / 100, F.col("l_tax") * 5 + 0.1)
    inner = F.array(F.col("l_tax") * 2, F.col("l_discount") * 2, F.col("l_tax") * 2 + F.col("l_quantity") / 60, F.col("l_discount") * 2 + 0.2)
    return df.withColumns({"box": made, "inner": inner})


def _boxed(*columns):
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        df = _box(table(spark, sf_dir, "lineitem"))
        out = df.select("l_orderkey", "l_linenumber", *[c() for c in columns])
        return out

    return query


def _axes(make, names=("x1", "y1", "x2", "y2")):
    return lambda: [F.get(make(), i).alias(n) for i, n in enumerate(names)]


def _box_query(make):
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        df = _box(table(spark, sf_dir, "lineitem"))
        return df.select("l_orderkey", "l_linenumber", *_axes(make)())

    return query


def _entries(df: DataFrame, vector) -> DataFrame:
    """Every entry of every vector: vec_id, place, entry (six decimals)."""
    return df.select("vec_id", F.posexplode(vector).alias("place", "entry")).select("vec_id", "place", F.round("entry", 6).alias("entry"))


def _vector_query(make):
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        df = table(spark, sf_dir, "embeddings").withColumn("scaled", F.transform("embedding", lambda x: x.cast("double") * 2))
        return _entries(df, make())

    return query


def pooled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each vector and its reverse as two token vectors, the second masked for even ids: all entries of the pooled one."""
    e = table(spark, sf_dir, "embeddings")
    return _entries(e, vectors.mean_pool(F.array("embedding", F.reverse("embedding")), F.array(F.lit(1), (F.col("vec_id") % 2).cast("int"))))


def dimension_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many dimensions the collection has, and how many vectors."""
    e = table(spark, sf_dir, "chunk_vectors").where("vector IS NOT NULL")
    return e.agg(F.count_distinct(F.size("vector")).alias("dimensions"), F.count(F.lit(1)).alias("vectors"), F.max(F.size("vector")).alias("widest"))


def ocr_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T6 over results of several shapes made from documents' whole texts."""
    d = table(spark, sf_dir, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("t"))
    held = lambda name: F.col("t").alias(name)
    shape = F.pmod("doc_id", F.lit(5))
    raw = (
        F.when(shape == 0, F.to_json(F.struct(held("text"))))
        .when(shape == 1, F.to_json(F.struct(F.lit("").alias("text"), held("ocr_text"))))
        .when(shape == 2, F.to_json(F.array(F.struct(held("text")), F.struct(F.lit("b").alias("text")))))
        .when(shape == 3, F.to_json(F.struct(F.struct(held("generated_text")).alias("raw"))))
        .otherwise(F.concat(F.lit("  "), F.col("t"), F.lit("  ")))
    )
    return d.select("doc_id", text.ocr_text(raw).alias("ocr_text"))


def record_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as typed records; texts over 65,535 characters are dropped."""
    d = _records(table(spark, sf_dir, "documents"))
    return d.select("doc_id", F.length(text.record_text("document_type", "subtype", {"content": "text", "table_content": "text", "caption": "source", "image_text": "text", "audio_transcript": "text"}, ("text", "table", "image", "audio"), 65_535, F.col("page_number").isNotNull())).alias("text_chars"))


def _records(d: DataFrame) -> DataFrame:
    return d.withColumn("subtype", F.element_at(F.array(F.lit("chart"), F.lit("table"), F.lit("infographic"), F.lit("page_image")), (F.pmod("doc_id", F.lit(4)) + 1).cast("int")))


def metadata_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T11 over documents' languages, some of them as list literals."""
    d = table(spark, sf_dir, "documents")
    cell = F.when(F.pmod("doc_id", F.lit(3)) == 0, F.concat(F.lit("['"), F.coalesce("lang", F.lit("")), F.lit("', 'x']"))).when(F.pmod("doc_id", F.lit(3)) == 1, F.lit("")).otherwise(F.col("lang"))
    out = text.metadata_cell(cell)
    return d.select("doc_id", out["value"].alias("value"), F.coalesce(F.size(out["items"]), F.lit(-1)).alias("items"))


def words_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Results whose text is spread over words, made from documents' sources."""
    raw = F.when(F.pmod("doc_id", F.lit(2)) == 0, F.concat(F.lit('{"words": [{"text": "'), "source", F.lit('"}, {"box": [1]}, {"text": "b"}]}'))).otherwise(F.col("source"))
    return table(spark, sf_dir, "documents").select("doc_id", text.words_text(raw).alias("words_text"))


def record_locations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T10 over documents as typed records; charts are switched off."""
    d = _records(table(spark, sf_dir, "documents"))
    return d.select("doc_id", text.record_location("document_type", "subtype", F.concat(F.lit("t"), F.col("doc_id").cast("string")), F.concat(F.lit("i"), F.col("doc_id").cast("string")), ("table", "image")).alias("location"))


def embeddings_from_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """V15 over services' answers of several shapes."""
    e = table(spark, sf_dir, "embeddings")
    row = F.to_json("embedding")
    shape = F.pmod("vec_id", F.lit(4))
    raw = F.when(shape == 0, F.concat(F.lit('{"embedding": '), row, F.lit("}"))).when(shape == 1, F.concat(F.lit('{"embeddings": ['), row, F.lit("]}"))).when(shape == 2, F.concat(F.lit('{"last_hidden_state": [['), row, F.lit(", "), row, F.lit("]]}"))).otherwise(row)
    return e.select("vec_id", F.posexplode(vectors.embedding_from_json(raw)).alias("place", "entry"))


def overlays(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K22 without drawing: pixel boxes of detections with a score of at least one half, unknown scores included."""
    df = _box(table(spark, sf_dir, "lineitem")).withColumn("score", F.when(F.col("l_linenumber") != 3, F.col("l_quantity") / 50))
    return df.where(labels.keeps_score("score", 0.5)).select("l_orderkey", "l_linenumber", "score", *_axes(lambda: boxes.overlay_pixels("box", _W, _H))())


QUERIES = {
    "t7_words_text": words_texts,
    "t10_record_location": record_locations,
    "v15_embedding_from_json": embeddings_from_json,
    "k22_overlay_boxes": overlays,
    "g9_centred_canvas": _from("page_scans", "page_id", *[(lambda f=f: boxes.centred_on_canvas("height", "width", (1024, 1024))[f].alias(f)) for f in ("height", "width", "top", "left")], where="height IS NOT NULL AND width IS NOT NULL"),
    "t1_page_key": _from("page_texts", "rec_id", lambda: text.page_key("image_path")["doc"].alias("doc"), lambda: text.page_key("image_path")["page"].alias("page"), lambda: text.page_key("image_path")["image_name"].alias("image_name")),
    "t2_skipped_page_key": _from("page_texts", "rec_id", lambda: text.skipped_page_key("image_path").alias("pdf_page"), lambda: text.skipped_page_key("image_path", 1).alias("pdf_page_base1")),
    "t3_split_pdf_page": _from("query_rows", "query_id", "pdf_page", lambda: text.split_pdf_page("pdf_page")["pdf"].alias("pdf_part"), lambda: text.split_pdf_page("pdf_page")["page"].alias("page_part")),
    "t4_page_from_path": _from("chunk_vectors", "vec_id", lambda: text.page_from_path("path").alias("page")),
    "t5_padded_page": _from("page_texts", "rec_id", lambda: text.padded_page("page_index").alias("padded")),
    "pr7_retrieved_key": _from("query_hits", "hit_id", lambda: text.retrieved_key("source", "metadata").alias("key")),
    "pr9_embedding_stem": _from("chunk_vectors", "vec_id", lambda: text.embedding_stem("path").alias("stem")),
    "pr10_preview": _from("page_texts", "rec_id", lambda: text.preview(F.filter("texts", lambda x: x.isNotNull())).alias("preview")),
    "pr12_artifact_paths": _from("page_texts", "rec_id", lambda: F.explode(F.array(*[F.concat("image_path", F.lit(s)) for s in (".page_elements_v3.json", ".graphic_elements_v1.json", ".table_structure_v1.json", ".ocr_v1.json", ".embeddings.pt", ".embedder-input.txt", ".page_element_detections.png")])).alias("path")),
    "t6_ocr_text": ocr_texts,
    "t9_record_text": record_texts,
    "t11_metadata_cell": metadata_cells,
    "t12_report_page": _from("page_scans", "page_id", lambda: text.report_page(F.col("page_number") + 1, "text").alias("section")),
    "t13_shortened": _from("documents", "doc_id", lambda: text.shortened("text", 60).alias("short")),
    "t14_clock": _from("page_metrics", "pdf_path", "page_index", "run_at", lambda: text.clock(F.col("wall_s") * 100).alias("wall")),
    "t15_human_size": _from("lineitem", "l_orderkey", "l_linenumber", lambda: text.human_size(F.floor(F.col("l_quantity")) * F.floor(F.col("l_quantity")) * 1000).alias("size")),
    "t17_stage_number": _from("region_sidecars", "sidecar_id", lambda: text.stage_number(F.concat(F.lit("Stage "), F.col("stage").cast("string"))).alias("stage_no")),
    "t19_label_key": _from("documents", "doc_id", lambda: text.label_key("document_type", F.pmod("doc_id", F.lit(6))).alias("label")),
    "f16_not_blank": _from("documents", "doc_id", lambda: text.not_blank("text").alias("has_text"), lambda: F.length(text.ustrip("text")).alias("stripped_chars")),
    "v16_prefix": _from("query_rows", "query_id", lambda: F.concat(F.lit(text.QUERY_PREFIX), "query").alias("embedder_input")),
    "g1_region_to_page": _box_query(lambda: boxes.region_to_page("box", "inner")),
    "g2_crop_pixels": _box_query(lambda: boxes.crop_pixels("box", _W, _H)),
    "g3_letterboxed_pixels": _box_query(lambda: boxes.letterboxed_pixels("box", (_H, _W), (1024, 1024))),
    "g4_letterbox_shape": _from("page_scans", "page_id", lambda: boxes.letterbox_shape("height", "width", (1024, 1024))["height"].alias("new_height"), lambda: boxes.letterbox_shape("height", "width", (1024, 1024))["width"].alias("new_width"), lambda: boxes.letterbox_shape("height", "width", (1024, 1024))["pad_right"].alias("pad_right")),
    "g5_to_pixels": _box_query(lambda: boxes.to_pixels("box", F.lit(1275.0), F.lit(1650.0))),
    "g5_to_normalised": _box_query(lambda: boxes.to_normalised(boxes.to_pixels("box", F.lit(1275.0), F.lit(1650.0)), F.lit(1275.0), F.lit(1650.0))),
    "g6_overlay_pixels": _box_query(lambda: boxes.overlay_pixels("box", _W, _H)),
    "g7_detected_pixels": _box_query(lambda: boxes.detected_pixels("box", _W, _H)),
    "g8_coerce": _from("query_rows", "query_id", lambda: F.col("pdf_page").try_cast("int").alias("as_int"), lambda: F.col("pdf").try_cast("double").alias("as_double")),
    "g10_render_scale": _from("page_scans", "page_id", lambda: boxes.render_scale(F.col("width").cast("double")).alias("scale")),
    "f1_f5_label_routes": _from("lineitem", "l_orderkey", "l_linenumber", lambda: labels.label_name(F.col("l_linenumber") % 8).alias("name"), lambda: labels.is_table(F.col("l_linenumber") % 8).alias("to_table"), lambda: labels.is_graphic(F.col("l_linenumber") % 8).alias("to_graphic"), lambda: labels.is_graphic(F.col("l_linenumber") % 8, True).alias("to_graphic_wide"), lambda: labels.is_ocr_target(labels.label_name(F.col("l_linenumber") % 8), F.lit("x")).alias("to_ocr")),
    "f4_graphic_count": _from("documents", "doc_id", lambda: labels.counts_as_graphic("document_type", F.pmod("doc_id", F.lit(4)).cast("int")).alias("graphic")),
    "f6_valid_box": _from("page_texts", "rec_id", lambda: F.size(F.filter("bboxes_xyxy_norm_in_page", boxes.valid_box)).alias("valid")),
    "f8_score_threshold": _from("lineitem", "l_orderkey", "l_linenumber", lambda: (F.col("l_quantity") / 50).alias("score"), where="l_quantity / 50 >= 0.5 OR l_quantity IS NULL"),
    "v13_normalised": _vector_query(lambda: vectors.normalised("scaled")),
    "v14_normalised_floor": _vector_query(lambda: vectors.normalised("scaled", True)),
    "a24_mean_pool": pooled,
    "s17_dimension_check": dimension_check,
}

_BASE = "list_extract(string_split({0}, '/'), -1)"
_IMG = _BASE.format("image_path")
_STEM = rf"regexp_replace({_IMG}, '\.[^.]*$', '')"
_BOX = """WITH b AS (SELECT l_orderkey, l_linenumber, l_discount * 5 AS b1, l_tax * 5 AS b2, l_discount * 5 + l_quantity / 100 AS b3, l_tax * 5 + 0.1::DOUBLE AS b4,
 l_tax * 2 AS i1, l_discount * 2 AS i2, l_tax * 2 + l_quantity / 60 AS i3, l_discount * 2 + 0.2::DOUBLE AS i4 FROM lineitem)
"""


def _inside(low: str, high: str, size: int) -> tuple[str, str]:
    a = f"greatest(0, least({low}, {size - 1}))"
    return f"CAST({a} AS INTEGER)", f"CAST(greatest({a} + 1, least({high}, {size})) AS INTEGER)"


def _pixels(round_: str, sides: tuple[int, int], exprs: list[str]) -> str:
    v = [f"CAST({round_}({e}) AS BIGINT)" for e in exprs]
    (x1, x2), (y1, y2) = _inside(v[0], v[2], sides[0]), _inside(v[1], v[3], sides[1])
    return _BOX + f"SELECT l_orderkey, l_linenumber, {x1} AS x1, {y1} AS y1, {x2} AS x2, {y2} AS y2 FROM b"


_SCALE = min(1024 / _H, 1024 / _W)
_PAD_X, _PAD_Y = (1024 - int(_W * _SCALE)) / 2, (1024 - int(_H * _SCALE)) / 2
_AXIS = "SELECT l_orderkey, l_linenumber, x1, y1, CASE WHEN x2 <= x1 THEN least(1.0::DOUBLE, x1 + 1e-6::DOUBLE) ELSE x2 END AS x2, CASE WHEN y2 <= y1 THEN least(1.0::DOUBLE, y1 + 1e-6::DOUBLE) ELSE y2 END AS y2 FROM p"
_P = "least(1.0::DOUBLE, greatest(0.0::DOUBLE, {r} + {d} * greatest(1e-12::DOUBLE, {s} - {r}))) AS {n}"
_NAMES = "CASE l_linenumber % 8 WHEN 0 THEN 'table' WHEN 1 THEN 'chart' WHEN 2 THEN 'title' WHEN 3 THEN 'infographic' WHEN 4 THEN 'text' WHEN 5 THEN 'header_footer' ELSE 'unknown_' || (l_linenumber % 8) END"
_E = "WITH e AS (SELECT vec_id, list_transform(embedding, lambda x: x::DOUBLE * 2) AS v FROM embeddings), n AS (SELECT *, sqrt(list_inner_product(v, v)) AS s FROM e), u AS (SELECT vec_id, list_transform(v, lambda x: x / s) AS v FROM n) "
_U = r"'^[\s\x1c-\x1f\x{85}\p{Z}]+|[\s\x1c-\x1f\x{85}\p{Z}]+$'"

SQL = {
    "t7_words_text": "SELECT doc_id, CASE WHEN doc_id % 2 = 0 THEN source || ' b' ELSE source END AS words_text FROM documents",
    "t10_record_location": "SELECT doc_id, CASE WHEN document_type = 'structured' THEN CASE WHEN doc_id % 4 NOT IN (0, 2) THEN 't' || doc_id END WHEN document_type = 'image' THEN 'i' || doc_id END AS location FROM documents",
    "v15_embedding_from_json": "SELECT vec_id, CAST(i - 1 AS INTEGER) AS place, embedding[i]::VARCHAR::DOUBLE AS entry FROM embeddings, unnest(generate_series(1, 64)) AS g(i)",
    "k22_overlay_boxes": _pixels("round_even", (_W, _H), [f"b1 * {_W}, 0", f"b2 * {_H}, 0", f"b3 * {_W}, 0", f"b4 * {_H}, 0"]).replace("SELECT l_orderkey, l_linenumber, CAST", "SELECT l_orderkey, l_linenumber, score, CAST").replace("FROM lineitem)", ", CASE WHEN l_linenumber <> 3 THEN l_quantity / 50 END AS score FROM lineitem WHERE l_linenumber = 3 OR l_quantity IS NULL OR l_quantity / 50 >= 0.5)"),
    "g9_centred_canvas": "WITH s AS (SELECT page_id, least(1.0::DOUBLE, 1024::DOUBLE / height, 1024::DOUBLE / width) AS s, height AS h, width AS w FROM page_scans WHERE height IS NOT NULL AND width IS NOT NULL), n AS (SELECT page_id, CAST(greatest(1, round_even(h * s, 0)) AS INTEGER) AS height, CAST(greatest(1, round_even(w * s, 0)) AS INTEGER) AS width FROM s) SELECT page_id, height, width, CAST(floor((1024 - height) / 2) AS INTEGER) AS top, CAST(floor((1024 - width) / 2) AS INTEGER) AS left FROM n",
    "t1_page_key": rf"SELECT rec_id, coalesce(nullif(regexp_extract({_IMG}, '(?i)^(.+)_page(\d+)\.(png|jpg|jpeg)$', 1), ''), {_STEM}) AS doc, TRY_CAST(regexp_extract({_IMG}, '(?i)^(.+)_page(\d+)\.(png|jpg|jpeg)$', 2) AS INTEGER) AS page, {_IMG} AS image_name FROM page_texts",
    "t2_skipped_page_key": rf"SELECT rec_id, CASE WHEN regexp_matches({_STEM}, '^(\d+)_page(\d+)$') THEN regexp_extract({_STEM}, '^(\d+)_page(\d+)$', 1) || '_' || (CAST(regexp_extract({_STEM}, '^(\d+)_page(\d+)$', 2) AS BIGINT) + 1) END AS pdf_page, CASE WHEN regexp_matches({_STEM}, '^(\d+)_page(\d+)$') THEN regexp_extract({_STEM}, '^(\d+)_page(\d+)$', 1) || '_' || CAST(regexp_extract({_STEM}, '^(\d+)_page(\d+)$', 2) AS BIGINT) END AS pdf_page_base1 FROM page_texts",
    "t3_split_pdf_page": "SELECT query_id, pdf_page, string_split(pdf_page, '_')[1] AS pdf_part, TRY_CAST(CASE WHEN instr(pdf_page, '_') > 0 THEN substr(pdf_page, instr(pdf_page, '_') + 1) END AS INTEGER) AS page_part FROM query_rows",
    "t4_page_from_path": "SELECT vec_id, TRY_CAST(string_split(list_extract(string_split(path, '_page'), -1), '.')[1] AS INTEGER) AS page FROM chunk_vectors",
    "t5_padded_page": "SELECT rec_id, CASE WHEN page_index IS NULL THEN 'null' ELSE printf('%04d', page_index) END AS padded FROM page_texts",
    "pr7_retrieved_key": f"SELECT hit_id, string_split({_BASE.format('source')}, '_')[1] || '_' || metadata AS key FROM query_hits",
    "pr9_embedding_stem": rf"SELECT vec_id, CASE WHEN {_BASE.format('path')} LIKE '%.embedding_results.pt' THEN replace({_BASE.format('path')}, '.embedding_results.pt', '') ELSE regexp_replace({_BASE.format('path')}, '\.[^.]*$', '') END AS stem FROM chunk_vectors",
    "pr10_preview": "WITH w AS (SELECT rec_id, replace(array_to_string(list_filter(texts, lambda x: x IS NOT NULL), ' '), chr(10), ' ') AS t FROM page_texts) SELECT rec_id, CASE WHEN length(t) > 200 THEN substr(t, 1, 200) || '…' ELSE t END AS preview FROM w",
    "pr12_artifact_paths": "SELECT rec_id, image_path || unnest(['.page_elements_v3.json', '.graphic_elements_v1.json', '.table_structure_v1.json', '.ocr_v1.json', '.embeddings.pt', '.embedder-input.txt', '.page_element_detections.png']) AS path FROM page_texts",
    "t6_ocr_text": rf"""WITH d AS (SELECT doc_id, coalesce(text, '') AS whole, regexp_replace(coalesce(text, ''), {_U}, '', 'g') AS t FROM documents)
SELECT doc_id, CASE doc_id % 5 WHEN 0 THEN CASE WHEN t = '' THEN CAST(to_json({{'text': whole}}) AS VARCHAR) ELSE t END
 WHEN 1 THEN CASE WHEN t = '' THEN CAST(to_json({{'text': '', 'ocr_text': whole}}) AS VARCHAR) ELSE t END
 WHEN 2 THEN CASE WHEN t = '' THEN CAST(to_json({{'text': whole}}) AS VARCHAR) ELSE t END || ' b'
 WHEN 3 THEN CASE WHEN t = '' THEN CAST(to_json({{'generated_text': whole}}) AS VARCHAR) ELSE t END ELSE t END AS ocr_text FROM d""",
    "t9_record_text": """WITH d AS (SELECT *, ['chart', 'table', 'infographic', 'page_image'][doc_id % 4 + 1] AS subtype FROM documents),
t AS (SELECT doc_id, page_number, CASE WHEN document_type = 'text' THEN text WHEN document_type = 'structured' THEN CASE WHEN subtype NOT IN ('chart', 'infographic') THEN text END
 WHEN document_type = 'image' THEN CASE WHEN subtype = 'page_image' THEN text ELSE source END WHEN document_type = 'audio' THEN text END AS t FROM d)
SELECT doc_id, CASE WHEN length(t) BETWEEN 1 AND 65535 AND page_number IS NOT NULL THEN CAST(length(t) AS INTEGER) END AS text_chars FROM t""",
    "t11_metadata_cell": "SELECT doc_id, CASE doc_id % 3 WHEN 0 THEN '[''' || coalesce(lang, '') || ''', ''x'']' WHEN 2 THEN lang END AS value, CASE doc_id % 3 WHEN 0 THEN 2 ELSE -1 END AS items FROM documents",
    "t12_report_page": "SELECT page_id, '## Page ' || (page_number + 1) || chr(10) || chr(10) || coalesce(text, '') AS section FROM page_scans",
    "t13_shortened": "SELECT doc_id, CASE WHEN length(text) > 60 THEN substr(text, 1, 60) || '...' ELSE text END AS short FROM documents",
    "t14_clock": "SELECT pdf_path, page_index, run_at, CASE WHEN wall_s IS NULL OR isnan(wall_s) OR wall_s < 0 THEN 'unknown' ELSE printf('%02d:%02d:%02d', CAST(floor(floor(wall_s * 100) / 3600) AS BIGINT), CAST(floor((CAST(floor(wall_s * 100) AS BIGINT) % 3600) / 60) AS BIGINT), CAST(floor(wall_s * 100) AS BIGINT) % 60) END AS wall FROM page_metrics",
    "t15_human_size": "WITH s AS (SELECT l_orderkey, l_linenumber, floor(l_quantity) * floor(l_quantity) * 1000 AS s FROM lineitem) SELECT l_orderkey, l_linenumber, CASE WHEN s < 1024 THEN printf('%.1f B', s) WHEN s < 1048576 THEN printf('%.1f KB', s / 1024) ELSE printf('%.1f MB', s / 1048576) END AS size FROM s",
    "t17_stage_number": "SELECT sidecar_id, stage AS stage_no FROM region_sidecars",
    "t19_label_key": "SELECT doc_id, coalesce(nullif(trim(document_type), ''), 'label_' || (doc_id % 6)) AS label FROM documents",
    "f16_not_blank": rf"SELECT doc_id, coalesce(length(regexp_replace(text, {_U}, '', 'g')) > 0, false) AS has_text, CAST(length(regexp_replace(text, {_U}, '', 'g')) AS INTEGER) AS stripped_chars FROM documents",
    "v16_prefix": "SELECT query_id, 'query: ' || query AS embedder_input FROM query_rows",
    "g1_region_to_page": _BOX + ", p AS (SELECT l_orderkey, l_linenumber, " + ", ".join(_P.format(r=r, s=s, d=d, n=n) for r, s, d, n in (("b1", "b3", "i1", "x1"), ("b2", "b4", "i2", "y1"), ("b1", "b3", "i3", "x2"), ("b2", "b4", "i4", "y2"))) + " FROM b) " + _AXIS,
    "g2_crop_pixels": _pixels("trunc", (_W, _H), [f"b1 * {_W}", f"b2 * {_H}", f"b3 * {_W}", f"b4 * {_H}"]),
    "g3_letterboxed_pixels": _pixels("trunc", (1024, 1024), [f"b{i} * {side}::DOUBLE * {_SCALE!r}::DOUBLE + {pad!r}::DOUBLE" for i, side, pad in ((1, _W, _PAD_X), (2, _H, _PAD_Y), (3, _W, _PAD_X), (4, _H, _PAD_Y))]),
    "g4_letterbox_shape": "WITH s AS (SELECT page_id, least(1024::DOUBLE / height, 1024::DOUBLE / width) AS s0, height, width FROM page_scans), n AS (SELECT page_id, CASE WHEN height IS NULL THEN 1024::DOUBLE / width ELSE s0 END AS s, height, width FROM s) SELECT page_id, CAST(greatest(1, trunc(height * s)) AS INTEGER) AS new_height, CAST(greatest(1, trunc(width * s)) AS INTEGER) AS new_width, CAST(1024 - greatest(1, trunc(width * s)) AS INTEGER) AS pad_right FROM n",
    "g5_to_pixels": _BOX + "SELECT l_orderkey, l_linenumber, b1 * 1275::DOUBLE AS x1, b2 * 1650::DOUBLE AS y1, b3 * 1275::DOUBLE AS x2, b4 * 1650::DOUBLE AS y2 FROM b",
    "g5_to_normalised": _BOX + "SELECT l_orderkey, l_linenumber, b1 * 1275::DOUBLE / 1275::DOUBLE AS x1, b2 * 1650::DOUBLE / 1650::DOUBLE AS y1, b3 * 1275::DOUBLE / 1275::DOUBLE AS x2, b4 * 1650::DOUBLE / 1650::DOUBLE AS y2 FROM b",
    "g6_overlay_pixels": _pixels("round_even", (_W, _H), [f"b1 * {_W}, 0", f"b2 * {_H}, 0", f"b3 * {_W}, 0", f"b4 * {_H}, 0"]),
    "g7_detected_pixels": _BOX + f", v AS (SELECT *, greatest(b1, b2, b3, b4) <= 1 AS s FROM b), q AS (SELECT l_orderkey, l_linenumber, " + ", ".join(f"greatest(0, least(CAST(trunc(CASE WHEN s THEN b{i} * {z} ELSE b{i} END) AS INTEGER), {z - 1})) AS {n}" for i, z, n in ((1, _W, "x1"), (2, _H, "y1"), (3, _W, "x2"), (4, _H, "y2"))) + " FROM v) SELECT l_orderkey, l_linenumber, " + ", ".join(f"CASE WHEN x2 > x1 AND y2 > y1 THEN {n} END AS {n}" for n in ("x1", "y1", "x2", "y2")) + " FROM q",
    "g8_coerce": "SELECT query_id, TRY_CAST(CASE WHEN regexp_matches(pdf_page, '^[+-]?[0-9]+$') THEN pdf_page END AS INTEGER) AS as_int, TRY_CAST(pdf AS DOUBLE) AS as_double FROM query_rows",
    "g10_render_scale": "SELECT page_id, width::DOUBLE / 72::DOUBLE AS scale FROM page_scans",
    "f1_f5_label_routes": f"SELECT l_orderkey, l_linenumber, {_NAMES} AS name, l_linenumber % 8 = 0 AS to_table, l_linenumber % 8 IN (1, 3) AS to_graphic, l_linenumber % 8 IN (1, 2, 3) AS to_graphic_wide, l_linenumber % 8 IN (0, 1, 3) AS to_ocr FROM lineitem",
    "f4_graphic_count": "SELECT doc_id, CASE WHEN document_type IS NOT NULL THEN lower(trim(document_type)) IN ('chart', 'infographic') ELSE doc_id % 4 IN (1, 3) END AS graphic FROM documents",
    "f6_valid_box": "SELECT rec_id, CASE WHEN bboxes_xyxy_norm_in_page IS NULL THEN NULL ELSE CAST(len(list_filter(bboxes_xyxy_norm_in_page, lambda b: coalesce(len(b) = 4 AND len(list_filter(b, lambda x: x IS NULL)) = 0, false))) AS INTEGER) END AS valid FROM page_texts",
    "f8_score_threshold": "SELECT l_orderkey, l_linenumber, l_quantity / 50 AS score FROM lineitem WHERE l_quantity / 50 >= 0.5 OR l_quantity IS NULL",
    "v13_normalised": _E + "SELECT vec_id, CAST(i - 1 AS INTEGER) AS place, round(v[i], 6) AS entry FROM u, unnest(generate_series(1, 64)) AS g(i)",
    "v14_normalised_floor": _E + "SELECT vec_id, CAST(i - 1 AS INTEGER) AS place, round(v[i], 6) AS entry FROM u, unnest(generate_series(1, 64)) AS g(i)",
    "a24_mean_pool": "WITH e AS (SELECT vec_id, list_transform(embedding, lambda x: x::DOUBLE) AS a, list_reverse(list_transform(embedding, lambda x: x::DOUBLE)) AS b FROM embeddings), m AS (SELECT vec_id, CASE WHEN vec_id % 2 = 0 THEN a ELSE list_transform(list_zip(a, b), lambda z: (z[1] + z[2]) / 2) END AS v FROM e) SELECT vec_id, CAST(i - 1 AS INTEGER) AS place, round(v[i] / sqrt(list_inner_product(v, v)), 6) AS entry FROM m, unnest(generate_series(1, 64)) AS g(i)",
    "s17_dimension_check": "SELECT count(DISTINCT len(vector)) AS dimensions, count(*) AS vectors, CAST(max(len(vector)) AS INTEGER) AS widest FROM chunk_vectors WHERE vector IS NOT NULL",
}
