"""Queries over chunk assembly, joins, set operations, reports, collections and streams."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pagelathe.functions import text
from pagelathe.operators import chunks, collections, detections, models, reports, resolve
from pagelathe.operators.records import tagged_table, write_tagged
from pagelathe.session import new_path, table
from pagelathe.sources import readers, sinks
from pagelathe.streaming import ingest


def _t(name: str):
    return lambda s, d: table(s, d, name)


_pages, _scans, _docs, _metrics, _sidecars, _hits, _asked = (_t(n) for n in ("page_texts", "page_scans", "documents", "page_metrics", "region_sidecars", "query_hits", "query_rows"))
_EMPTY = "texts IS NULL OR size(filter(texts, t -> length(trim(coalesce(t, ''))) > 0)) = 0"


def _first() -> Column:
    return F.get("texts", 0)


def _rest() -> Column:
    return F.expr("slice(texts, 2, greatest(size(texts) - 1, 0))")


def _key() -> Column:
    return F.concat("pdf_path", F.lit("#"), F.col("page_index").cast("string"))


def ocr_tasks(s: SparkSession, d: str) -> DataFrame:
    """Line items as an order's detections, some with a box that is none."""
    box = F.when(F.col("l_linenumber") % 3 == 0, F.array(F.lit("0.1"), F.lit("x"), F.lit("0.5"), F.lit("0.6"))).otherwise(F.array(*[F.col(c).cast("string") for c in ("l_discount", "l_tax", "l_quantity", "l_extendedprice")]))
    det = F.struct(box.alias("bbox_xyxy_norm"), (F.col("l_linenumber") % 6).alias("label"), F.when(F.col("l_linenumber") % 2 == 0, F.lit(" Chart ")).alias("label_name"), F.col("l_quantity").alias("score"))
    pages = table(s, d, "lineitem").groupBy("l_orderkey").agg(F.transform(F.array_sort(F.collect_list(F.struct("l_linenumber", det.alias("d")))), lambda r: r["d"]).alias("detections"))
    return chunks.ocr_tasks(pages, "l_orderkey", "detections").select("l_orderkey", F.col("detection.label").alias("label"), F.col("detection.score").alias("score"))


def region_counts(s: SparkSession, d: str) -> DataFrame:
    """An order's items as regions, each with as many detections as its number."""
    region = F.struct("l_linenumber", F.sequence(F.lit(1), "l_linenumber").alias("detections"))
    regions = table(s, d, "lineitem").groupBy("l_orderkey").agg(F.collect_list(region).alias("regions"))
    return reports.region_counts(table(s, d, "orders").join(regions, F.col("o_orderkey") == F.col("l_orderkey"), "left"), F.col("regions")).select("o_orderkey", "regions_n", "detections_n")


def stage_state(s: SparkSession, d: str) -> DataFrame:
    """Pages with their stage-3 sidecar: present, missing or bad."""
    side = _sidecars(s, d).where("stage = 3").groupBy(_key().alias("page")).agg(F.min(F.coalesce(F.length(F.trim("payload")), F.lit(0)) == 0).alias("bad"))
    return resolve.with_sidecar(_pages(s, d).select("rec_id", _key().alias("page")), side, "page").select("rec_id", "state")


def either_content(s: SparkSession, d: str) -> DataFrame:
    """A page needs a scanned text or a region text."""
    scan = _scans(s, d).groupBy(F.concat("pdf_path", F.lit("#"), F.col("page_number").cast("string")).alias("page")).agg(F.max(text.not_blank("text")).alias("scanned"))
    pages = _pages(s, d).select("rec_id", _key().alias("page"), text.not_blank(_rest_text()).alias("regions"))
    return pages.join(scan, "page", "left").select("rec_id", (F.coalesce("scanned", F.lit(False)) | F.col("regions")).alias("usable"))


def _rest_text() -> Column:
    return F.array_join(F.filter(F.coalesce("texts", F.array().cast("array<string>")), lambda t: t.isNotNull()), "")


def sidecar_images(s: SparkSession, d: str) -> DataFrame:
    """The image of each sidecar, by the path in it or by its own name."""
    side = _sidecars(s, d).select("sidecar_id", F.get_json_object("payload", "$.image.path").alias("embedded"), F.concat(F.lit("/pages/"), text.stem("pdf_path"), F.format_string("_page%04d", F.col("page_index") + 1), F.lit(".png.graphic_elements_v1.json")).alias("path"))
    return resolve.resolve_image(side, _pages(s, d).select(F.col("image_path").alias("path")), "embedded", "path", ".graphic_elements_v1.json").select("sidecar_id", "image_path")


def query_images(s: SparkSession, d: str) -> DataFrame:
    """Each distinct query's page image."""
    asked = _asked(s, d).select("query_id", "pdf", "pdf_page", F.col("gt_page").alias("page")).distinct()
    asked = asked.groupBy("query_id").agg(*[F.min(c).alias(c) for c in ("pdf", "pdf_page", "page")])
    return resolve.resolve_queries(asked, _pages(s, d).select(F.col("image_path").alias("path")), "query_id").select("query_id", "image_path")


def skipped_asked(s: SparkSession, d: str) -> DataFrame:
    """Skipped pages that are asked for; the last record of a page counts."""
    key = F.concat(text.stem("pdf_path"), F.lit("_"), F.col("page_index").cast("string"))
    skips = _pages(s, d).where(f"{_EMPTY} OR schema_version IS NULL").select(key.alias("pdf_page"), F.when(F.expr(_EMPTY), "no_content").otherwise("already_exists").alias("reason"), F.col("rec_id").alias("order"))
    return resolve.skipped_in_queries(skips, _asked(s, d))


def share_affected(s: SparkSession, d: str) -> DataFrame:
    """Percent of queries whose page was skipped."""
    hit = skipped_asked(s, d).select(F.col("queries").alias("affected"), F.lit(0).cast("long").alias("queries"))
    every = _asked(s, d).where("pdf_page IS NOT NULL").select(F.lit(0).cast("long").alias("affected"), F.lit(1).cast("long").alias("queries"))
    whole = hit.unionByName(every).agg(F.coalesce(F.sum("affected"), F.lit(0)).alias("affected"), F.coalesce(F.sum("queries"), F.lit(0)).alias("queries"))
    return whole.select("affected", "queries", reports.share_percent(F.col("affected"), F.col("queries")).alias("percent"))


def enriched(s: SparkSession, d: str) -> DataFrame:
    """Documents with size and language of the first scan of their PDF."""
    return resolve.first_match(_docs(s, d).select("doc_id", "pdf_path"), _scans(s, d).select("pdf_path", "page_id", "width", F.col("page_id").alias("first_scan")), "pdf_path", ["width", "first_scan"], "page_id").select("doc_id", "width", "first_scan")


def hit_records(s: SparkSession, d: str) -> DataFrame:
    """Hits with the kind of the chunk they point to."""
    return resolve.by_place(_hits(s, d).select("hit_id", F.col("chunk_id").alias("place")), table(s, d, "chunk_vectors").select(F.col("vec_id").alias("place"), "text_kind")).select("hit_id", "text_kind")


def context_window(s: SparkSession, d: str) -> DataFrame:
    """Texts of the documents on the page of a scan and the pages beside it."""
    docs = _docs(s, d).where("text IS NOT NULL").select("pdf_path", "page_number", "doc_id", "text")
    return resolve.window_text(resolve.page_window(_scans(s, d), docs, "page_id", "pdf_path", "page_number", 1), ["page_number", "doc_id"], "text").select("anchor", F.length("text").alias("chars"), F.md5("text").alias("digest"))


def artifacts(s: SparkSession, d: str) -> DataFrame:
    """Which artifacts exist, of those that sidecars account for."""
    suffix = F.when(F.col("stage") == 3, ".graphic_elements_v1.json").otherwise(".table_structure_v1.json")
    files = _sidecars(s, d).where("payload IS NOT NULL").select(F.concat(F.lit("/pages/"), text.stem("pdf_path"), F.format_string("_page%04d", F.col("page_index") + 1), F.lit(".png"), suffix).alias("path"), F.length("payload").alias("length"))
    return resolve.artifact_presence(_pages(s, d).select("image_path").distinct(), "image_path", files)


def coverage(s: SparkSession, d: str) -> DataFrame:
    """How many pages each other table has."""
    key = lambda df, page: df.select(F.concat("pdf_path", F.lit("#"), F.col(page).cast("string")).alias("page"))
    stages = {"scans": key(_scans(s, d), "page_number"), "stage3": key(_sidecars(s, d).where("stage = 3"), "page_index"), "stage4": key(_sidecars(s, d).where("stage = 4"), "page_index"), "metrics": key(_metrics(s, d), "page_index")}
    return reports.coverage(key(_pages(s, d), "page_index"), stages, "page")


def pages_per_document(s: SparkSession, d: str) -> DataFrame:
    key = lambda df, page, name: df.select(F.col("pdf_path").alias("doc"), F.col(page).alias("page"), name.alias("image_name"))
    return reports.pages_per_document([key(_docs(s, d), "page_number", F.lit("none")), key(_scans(s, d), "page_number", F.lit("none")), key(_pages(s, d), "page_index", F.col("image_path"))])


def stage_invocations(s: SparkSession, d: str) -> DataFrame:
    """Pages each stage ran for, and payloads without content."""
    return _sidecars(s, d).groupBy("stage").agg(F.count_distinct(_key()).alias("pages"), F.count_if(F.coalesce(F.length(F.trim("payload")), F.lit(0)) == 0).alias("bad"))


def _eligible(s: SparkSession, d: str) -> DataFrame:
    items = table(s, d, "lineitem").select(F.col("l_suppkey").alias("doc"), (F.col("l_linenumber") % 6).alias("label"), (F.col("l_linenumber") % 2 + 3).alias("stage"), F.when(F.col("l_quantity") > 5, F.array("l_tax", "l_tax", "l_quantity", "l_quantity")).alias("box"))
    return reports.eligible_by_document(items, "doc", "stage", chunks.eligible(F.col("label"), F.col("box")))


def daily_throughput(s: SparkSession, d: str) -> DataFrame:
    """Pages a second of each day, and batches of 32 they need."""
    good = F.when(F.col("wall_s").isNotNull() & ~F.isnan("wall_s"), F.col("wall_s"))
    day = _metrics(s, d).groupBy(F.date_format("run_at", "yyyy-MM-dd").alias("day")).agg(F.count(F.lit(1)).alias("pages"), F.sum(good).alias("seconds"))
    return day.select("day", "pages", reports.throughput(F.col("pages"), F.round("seconds", 3)).alias("per_second"), reports.batches_needed(F.col("pages"), 32).alias("batches"))


def merged_counts(s: SparkSession, d: str) -> DataFrame:
    """M6: counts of all pages of a day summed by key."""
    return _metrics(s, d).select(F.date_format("run_at", "yyyy-MM-dd").alias("day"), F.explode("counts").alias("kind", "n")).groupBy("day", "kind").agg(F.sum("n").alias("total"))


def numbered(s: SparkSession, d: str) -> DataFrame:
    """Running number, batch of 64 and one of 4 workers of each document in order."""
    return resolve.numbered(_docs(s, d).select("doc_id"), ["doc_id"]).select("doc_id", "number", F.floor(F.col("number") / 64).alias("batch"), F.pmod("number", F.lit(4)).alias("worker"))


def latest_pages(s: SparkSession, d: str) -> DataFrame:
    """The last record of each page."""
    return resolve.one_by_order(_pages(s, d), ["pdf_path", "page_index"], [F.desc("written_at"), F.desc("rec_id")]).select("pdf_path", "page_index", "rec_id")


def sets(kind: str):
    def query(s: SparkSession, d: str) -> DataFrame:
        a, b = _docs(s, d).select("pdf_path").where("pdf_path IS NOT NULL"), _scans(s, d).select("pdf_path").where("pdf_path IS NOT NULL")
        return a.intersect(b) if kind == "both" else a.union(b).distinct() if kind == "any" else a.distinct().join(b, "pdf_path", "left_anti")

    return query


def embedder_inputs(s: SparkSession, d: str) -> DataFrame:
    """Each page's embedder input."""
    each = chunks.assemble(_pages(s, d), "rec_id", _first(), _rest())
    return sinks.embedder_input(each, ["rec_id"], "chunk_no", chunks.embedder_text("text")).select("rec_id", F.length("value").alias("chars"), F.md5("value").alias("digest"))


def reports_by_pdf(s: SparkSession, d: str) -> DataFrame:
    """Scanned pages of each PDF as one document."""
    pages = _scans(s, d).where("pdf_path IS NOT NULL AND page_number IS NOT NULL")
    one = resolve.one_by_order(pages, ["pdf_path", "page_number"], [F.col("page_id")])
    return sinks.report_document(one, "pdf_path", "page_number", text.report_page(F.col("page_number") + 1, "text")).select("pdf_path", "part", F.length("report").alias("chars"), F.md5("report").alias("digest"))


def embedded(s: SparkSession, d: str) -> DataFrame:
    """The model seam with the hashing stand-in (no model)."""
    done = models.embed(_docs(s, d).select("doc_id", "text"), "doc_id", "text", "hash32", models.hash_embedder, prefix=text.PASSAGE_PREFIX)
    return done.select("doc_id", F.size("vector").alias("dimensions"), "error")


def cleaned_queries(s: SparkSession, d: str) -> DataFrame:
    """S20, S21 over the stored queries."""
    return readers.clean_queries(_asked(s, d).select("query", "pdf", "gt_page", "pdf_page", "modality").distinct())


def streamed(s: SparkSession, d: str) -> DataFrame:
    """Events by way of a file stream, counted by type."""
    source, target, state = (new_path(s, n) for n in ("stream-in", "stream-out", "stream-state"))
    table(s, d, "events").write.parquet(source)
    for _ in range(2):  # the second call finds nothing new
        ingest.ingest(s, source, "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string", target, state)
    return s.read.parquet(target).groupBy("event_type").agg(F.count(F.lit(1)).alias("events"))


def windows(s: SparkSession, d: str) -> DataFrame:
    return ingest.windowed_counts(table(s, d, "events").withColumn("ts", F.col("ts").cast("timestamp")), "ts", "event_type", "value").withColumn("window_start", F.date_format("window_start", "yyyy-MM-dd HH:mm:ss"))


def progress(s: SparkSession, d: str) -> DataFrame:
    """Pages done by the end of each day, rate so far and days left of all pages; one row a day meets in the window."""
    day = _metrics(s, d).where("run_at IS NOT NULL").groupBy(F.date_format("run_at", "yyyy-MM-dd").alias("day")).agg(F.count(F.lit(1)).alias("pages"))
    return reports.progress(day, "day", "pages")


def unique_pages(s: SparkSession, d: str) -> DataFrame:
    """The first pages by name, each once."""
    return resolve.first_rows(_pages(s, d).where("image_path IS NOT NULL").select(text.base_name("image_path").alias("image_name")).distinct(), ["image_name"], 50)


def collection_split(s: SparkSession, d: str) -> DataFrame:
    """Rows of each collection when types are spread over collections."""
    kinds = {"texts": ["text", "audio"], "media": ["image", "structured"]}
    out = None
    for name, wanted in kinds.items():
        part = _docs(s, d).where(F.col("document_type").isin(*wanted)).select("doc_id", F.lit(name).alias("collection"))
        out = part if out is None else out.unionByName(part)
    return out


def star_join(s: SparkSession, d: str) -> DataFrame:
    """Revenue by nation, to see the session's joins at work (not an operator of the inventory)."""
    li, o, c, n = (table(s, d, x) for x in ("lineitem", "orders", "customer", "nation"))
    whole = li.join(o, F.col("l_orderkey") == F.col("o_orderkey")).join(c, F.col("o_custkey") == F.col("c_custkey")).join(n, F.col("c_nationkey") == F.col("n_nationkey"))
    return whole.groupBy("n_name").agg(F.round(F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount"))), 2).alias("revenue"))


def collection_rows(s: SparkSession, d: str) -> DataFrame:
    """Documents as ingest records (every seventh without embedding), cleaned to collection rows."""
    kinds = F.element_at(F.array(F.lit("chart"), F.lit("table"), F.lit("infographic"), F.lit("page_image")), (F.pmod("doc_id", F.lit(4)) + 1).cast("int"))
    vector = F.when(F.pmod("doc_id", F.lit(7)) != 0, F.array(F.col("page_number").cast("float"), F.lit(1.0).cast("float")))
    held = lambda name, value: F.struct(F.col(value).alias(name))
    metadata = F.struct(
        F.col("text").alias("content"), held("table_content", "text").alias("table_metadata"), F.struct(F.col("source").alias("caption"), F.col("text").alias("text")).alias("image_metadata"), held("audio_transcript", "text").alias("audio_metadata"),
        vector.alias("embedding"), held("source_name", "source").alias("source_metadata"), F.struct(kinds.alias("subtype"), "doc_id", "page_number").alias("content_metadata"),
    )
    rows = chunks.clean_records(_docs(s, d).select("document_type", metadata.alias("metadata")), ("text", "table", "image", "audio"))
    return rows.select("content_metadata.doc_id", F.length("text").alias("chars"), F.size("vector").alias("dimensions"), F.col("source.source_name").alias("source_name"), "content_metadata.page_number")


def ingest_records(s: SparkSession, d: str) -> DataFrame:
    """P5: collection rows read back as ingest records."""
    rows = table(s, d, "chunk_vectors").select("vector", F.col("text_kind").alias("text"), F.col("vec_id").cast("string").alias("metadata"), "source")
    r = chunks.to_records(rows)
    return r.select("document_type", F.col("metadata.content").alias("content"), F.size("metadata.embedding").alias("dimensions"), F.col("metadata.source_metadata.source_name").alias("source_name"), F.col("metadata.content_metadata.page_number").alias("number"))


def kept_detections(s: SparkSession, d: str) -> DataFrame:
    """Detections of every sidecar that stay after the threshold and the suppression of overlaps, by position in their region."""
    found = tagged_table(write_tagged(_sidecars(s, d), "sidecar_id", "payload"), "detection", "sidecar_id")
    each = F.array_sort(F.collect_list(F.struct("det_no", F.col("bbox_in_region").alias("box"), "label", "score")))
    rows = found.groupBy("sidecar_id", "record_no", "region_no").agg(each.alias("e"))
    part = lambda name: F.transform("e", lambda x: x[name])
    return detections.suppress(rows, ["sidecar_id", "record_no", "region_no"], part("box"), part("label"), part("score"), "graphic_elements")


QUERIES = {
    "t8_joined_text": lambda s, d: _pages(s, d).select("rec_id", text.joined_text(F.transform("texts", lambda t: F.struct(t.alias("text")))).alias("joined")),
    "k17_run_report": lambda s, d: reports.run_report(_metrics(s, d), "nemotron_ocr_v1"),
    "k18_hotspots": lambda s, d: reports.run_hotspots(_metrics(s, d)),
    "pr3_collection_rows": collection_rows,
    "pr5_ingest_records": ingest_records,
    "n2_kept_detections": kept_detections,
    "x3_ocr_tasks": ocr_tasks,
    "x4_chunks": lambda s, d: chunks.assemble(_pages(s, d), "rec_id", _first(), _rest()),
    "x5_flatten": lambda s, d: chunks.flatten_records(_pages(s, d).select(F.array(F.transform("texts", lambda t: F.struct(t.alias("text"))), F.lit(None)).alias("nested")), "nested").groupBy(F.md5("text").alias("digest")).agg(F.count(F.lit(1)).alias("n")),
    "f14_work_list": lambda s, d: chunks.work_list(table(s, d, "chunk_vectors").select(F.col("vec_id").alias("id")), _hits(s, d).select(F.col("chunk_id").alias("id")), "id"),
    "f15_skips": lambda s, d: chunks.skips(_pages(s, d), "rec_id", F.coalesce(_first(), F.lit("")), F.coalesce(_rest(), F.array().cast("array<string>")), _pages(s, d).where("schema_version IS NULL")),
    "f7_a9_eligible": _eligible,
    "l2_top_documents": lambda s, d: reports.top_documents(_eligible(s, d).select("doc", "eligible"), "doc", "eligible", 25),
    "j1_sidecar_state": stage_state,
    "j2_either_content": either_content,
    "j3_sidecar_image": sidecar_images,
    "j4_query_image": query_images,
    "j5_skipped_asked": skipped_asked,
    "a22_share_affected": share_affected,
    "j6_enriched": enriched,
    "j7_hit_records": hit_records,
    "j10_context_window": context_window,
    "j11_zip_shortest": lambda s, d: _pages(s, d).where("texts IS NOT NULL AND text_kinds IS NOT NULL").select("rec_id", F.size(chunks.zip_shortest({"t": "texts", "k": "text_kinds"})).alias("pairs")),
    "j13_artifacts": artifacts,
    "a3_events_by_label": lambda s, d: reports.detections_by_label(_docs(s, d).select(F.col("document_type").alias("label_name"), F.pmod("doc_id", F.lit(4)).alias("label"))),
    "a4_region_counts": region_counts,
    "a5_ocr_summary": lambda s, d: _pages(s, d).select("rec_id", *reports.ocr_summary(F.col("texts"))).withColumn("samples", F.md5(F.array_join("samples", "|"))),
    "a6_coverage": coverage,
    "a7_pages_per_document": pages_per_document,
    "a8_stage_invocations": stage_invocations,
    "a10_model_totals": lambda s, d: reports.model_totals(_metrics(s, d)),
    "a11_component_totals": lambda s, d: reports.component_totals(_metrics(s, d)),
    "a12_errors": lambda s, d: reports.error_count(_metrics(s, d)),
    "a14_batch_histogram": lambda s, d: reports.batch_histogram(_metrics(s, d)),
    "a15_latency": lambda s, d: reports.latency(table(s, d, "events"), ["event_type"], "value"),
    "a16_wall_latency": lambda s, d: reports.latency(_metrics(s, d), ["pdf_path"], "wall_s"),
    "a17_throughput": daily_throughput,
    "a19_totals": lambda s, d: _metrics(s, d).agg(F.count_distinct("pdf_path").alias("pdfs"), F.count(F.lit(1)).alias("runs"), F.sum(F.size("models")).alias("calls")),
    "a21_reasons": lambda s, d: reports.reasons(QUERIES["f15_skips"](s, d)),
    "a23_sizes": lambda s, d: reports.sizes_by_kind(_docs(s, d).withColumnRenamed("n_chars", "length"), F.coalesce("document_type", F.lit("none"))),
    "a27_runs": lambda s, d: reports.run_summary(_metrics(s, d), ["pdf_path"], F.coalesce(F.size("errors"), F.lit(0)) <= 0, F.when(~F.isnan("wall_s"), F.col("wall_s"))),
    "l3_hot_models": lambda s, d: reports.hotspots(reports.model_totals(_metrics(s, d)).select("model", "seconds"), "model", 15),
    "l3_hot_components": lambda s, d: reports.hotspots(reports.component_totals(_metrics(s, d)), "component", 20),
    "l1_first_rows": lambda s, d: resolve.first_rows(_pages(s, d).select("image_path", "rec_id"), ["image_path", "rec_id"], 20),
    "l6_unique_pages": unique_pages,
    "w6_progress": progress,
    "l8_sample": lambda s, d: resolve.sampled(_docs(s, d).select("doc_id"), 3, "doc_id"),
    "m6_merged_counts": merged_counts,
    "w4_numbered": numbered,
    "w5_latest_pages": latest_pages,
    "u1_both": sets("both"),
    "u2_any": sets("any"),
    "u4_only": sets("only"),
    "u5_distinct_kinds": lambda s, d: _pages(s, d).select("rec_id", F.array_join(F.array_distinct("text_kinds"), ",").alias("kinds")),
    "k4_embedder_input": embedder_inputs,
    "k14_without_source": lambda s, d: collections.without_source(_hits(s, d), "source", "/data/pdfs/manual/1037909.pdf").groupBy("source").agg(F.count(F.lit(1)).alias("hits")),
    "k24_report": reports_by_pdf,
    "pr4_vector_rows": lambda s, d: chunks.to_vector_rows(table(s, d, "chunk_vectors").withColumn("page_number", text.page_from_path("path")), "vector", "path", "source").select("text", "metadata", "source"),
    "pr11_collection_split": collection_split,
    "f12_filtered": lambda s, d: _hits(s, d).where("source LIKE '%manual%' AND get_json_object(metadata, '$.page_number') = '3'").select("hit_id"),
    "f13_catalog_match": lambda s, d: collections.catalog_match(_docs(s, d).select("doc_id", F.col("source").alias("collection_name"), F.col("lang").alias("embedding_model")), collection_name="tas", embedding_model="e").select("doc_id"),
    "f17_viewer_search": lambda s, d: _asked(s, d).where(F.lower(F.concat_ws(" ", "pdf_page", "query")).contains("some")).select("query_id", "query"),
    "f20_stage_from": lambda s, d: _sidecars(s, d).where(text.stage_number(F.col("stage").cast("string")) >= 4).groupBy("stage").agg(F.count(F.lit(1)).alias("files")),
    "m5_sparse": lambda s, d: table(s, d, "lineitem").groupBy("l_orderkey", "l_linenumber").agg(F.sum("l_quantity").alias("l_quantity")).groupBy("l_orderkey").agg(F.map_values(chunks.sparse_map(F.collect_list(F.struct("l_linenumber", "l_quantity")))).alias("w")).select("l_orderkey", F.size("w").alias("entries"), F.aggregate("w", F.lit(0.0), lambda a, x: a + x).alias("weight")),
    "s21_queries": cleaned_queries,
    "v17_embedded": embedded,
    "z4_stream": streamed,
    "z_windows": windows,
    "extra_star_join": star_join,
}

_NB = r"coalesce(length(regexp_replace({0}, '^[\s\x1c-\x1f\x{{85}}\p{{Z}}]+|[\s\x1c-\x1f\x{{85}}\p{{Z}}]+$', '', 'g')) > 0, false)"
_ST = r"regexp_replace({0}, '^[\s\x1c-\x1f\x{{85}}\p{{Z}}]+|[\s\x1c-\x1f\x{{85}}\p{{Z}}]+$', '', 'g')"
_STEM = r"regexp_replace(list_extract(string_split(pdf_path, '/'), -1), '\.[^.]*$', '')"
_E = "len(list_filter(coalesce(texts, []), lambda t: length(trim(coalesce(t, ''))) > 0)) = 0"
_CH = f"""WITH e AS (SELECT rec_id, unnest(texts) AS t, generate_subscripts(texts, 1) AS i FROM page_texts), k AS (SELECT rec_id, i, {_ST.format('t')} AS text FROM e WHERE {_NB.format('t')}),
c AS (SELECT rec_id, row_number() OVER (PARTITION BY rec_id ORDER BY i) - 1 AS chunk_no, CASE WHEN i = 1 THEN 'pdfium_page_text' ELSE 'ocr_region' END AS text_kind, text FROM k)
"""
_SKIPS = f"SELECT CAST(rec_id AS VARCHAR) AS image_path, CASE WHEN schema_version IS NULL THEN 'already_exists' ELSE 'no_content' END AS reason, '' AS details FROM page_texts WHERE schema_version IS NULL OR len(list_filter(coalesce(texts, []), lambda t: {_NB.format('t')})) = 0"
_J5 = f"""WITH s AS (SELECT {_STEM} || '_' || page_index AS pdf_page, CASE WHEN {_E} THEN 'no_content' ELSE 'already_exists' END AS reason, rec_id FROM page_texts WHERE {_E} OR schema_version IS NULL),
l AS (SELECT pdf_page, arg_max(reason, rec_id) AS reason FROM s GROUP BY 1), q AS (SELECT pdf_page, count(*) AS queries FROM query_rows WHERE pdf_page IS NOT NULL GROUP BY 1), j AS (SELECT pdf_page, reason, queries FROM l JOIN q USING (pdf_page))
"""
_EL = """WITH i AS (SELECT l_suppkey AS doc, l_linenumber % 6 IN (0, 1, 3) AND coalesce(l_quantity > 5, false) AS e, l_linenumber % 2 + 3 AS stage FROM lineitem),
g AS (SELECT doc, count(*) AS total, count(*) FILTER (e) AS eligible, count(*) FILTER (stage = 3) AS total_stage3, count(*) FILTER (stage = 4) AS total_stage4, count(*) FILTER (e AND stage = 3) AS eligible_stage3, count(*) FILTER (e AND stage = 4) AS eligible_stage4 FROM i GROUP BY 1)
"""
_CAND = """WITH q AS (SELECT query_id, min(pdf) AS pdf, min(pdf_page) AS pp, min(gt_page) AS page FROM query_rows GROUP BY 1),
n AS (SELECT query_id, coalesce(CASE WHEN contains(pp, '_') THEN nullif(trim(string_split(pp, '_')[1]), '') END, nullif(trim(pdf), '')) AS name, TRY_CAST(CASE WHEN instr(pp, '_') > 0 THEN trim(substr(pp, instr(pp, '_') + 1)) END AS INTEGER) AS f, page, pp FROM q),
c AS (SELECT query_id, 1 AS o, name || '_page' || printf('%04d', f) AS s FROM n WHERE f > 0 UNION ALL SELECT query_id, 2, name || '_page' || f FROM n WHERE f > 0
 UNION ALL SELECT query_id, 3, name || '_page' || printf('%04d', page + 1) FROM n WHERE page >= 0 UNION ALL SELECT query_id, 4, name || '_page' || (page + 1) FROM n WHERE page >= 0 UNION ALL SELECT query_id, 5, nullif(pp, '') FROM n),
im AS (SELECT regexp_replace(list_extract(string_split(image_path, '/'), -1), '\\.[^.]*$', '') AS s, min(image_path) AS path FROM page_texts WHERE image_path IS NOT NULL GROUP BY 1), b AS (SELECT query_id, arg_min(path, o) AS image_path FROM c JOIN im USING (s) GROUP BY 1)
SELECT query_id, image_path FROM q LEFT JOIN b USING (query_id)"""
_MT = """WITH e AS (SELECT unnest(map_entries(models)) AS m FROM page_metrics), g AS (SELECT m.key AS model, sum(CASE WHEN isnan(m.value.seconds) THEN 0 ELSE coalesce(m.value.seconds, 0) END) AS s, sum(coalesce(m.value.calls, 0)) AS calls, sum(coalesce(m.value.items, 0)) AS items FROM e GROUP BY 1)
"""
_CT = "WITH e AS (SELECT unnest(map_entries(timing_s)) AS m FROM page_metrics), g AS (SELECT m.key AS component, round(sum(CASE WHEN isnan(m.value) THEN 0 ELSE coalesce(m.value, 0) END), 4) AS seconds FROM e GROUP BY 1) "
_LAT = "SELECT {by}, count(*) AS n, round(quantile_cont({v}, 0.5), 6) AS p50, round(quantile_cont({v}, 0.9), 6) AS p90, round(quantile_cont({v}, 0.99), 6) AS p99, round(avg({v}), 9) AS mean, round(coalesce(stddev_samp({v}), 0), 6) AS deviation FROM {t} WHERE {v} IS NOT NULL AND NOT isnan({v}) GROUP BY 1"
_K = "pdf_path || '#' || page_index"

SQL = {
    "v17_embedded": r"SELECT doc_id, 32 AS dimensions, CAST(NULL AS VARCHAR) AS error FROM documents WHERE length(regexp_replace(text, '^[\s\x1c-\x1f\x{85}\p{Z}]+|[\s\x1c-\x1f\x{85}\p{Z}]+$', '', 'g')) > 0",
    "t8_joined_text": r"SELECT rec_id, regexp_replace(array_to_string(list_transform(texts, lambda x: coalesce(x, '')), ' '), '^[\s\x1c-\x1f\x{85}\p{Z}]+|[\s\x1c-\x1f\x{85}\p{Z}]+$', '', 'g') AS joined FROM page_texts",
    "k17_run_report": """
WITH m AS (SELECT coalesce(len(errors), 0) > 0 AS bad, models['nemotron_ocr_v1'] AS m, CASE WHEN wall_s IS NULL OR isnan(wall_s) THEN 0 ELSE wall_s END AS w FROM page_metrics),
t AS (SELECT count(*) AS pages, count(*) FILTER (NOT bad AND m IS NOT NULL) AS processed_pages, count(*) FILTER (NOT bad AND m IS NULL) AS skipped_pages, count(*) FILTER (bad) AS failed_pages,
  coalesce(sum(m.items), 0) AS processed_crops, coalesce(sum(m.calls), 0) AS processed_batches, coalesce(sum(CASE WHEN m.seconds IS NULL OR isnan(m.seconds) THEN 0 ELSE m.seconds END), 0) AS s, sum(w) AS w FROM m)
SELECT 'nemotron_ocr_v1' AS model, pages, processed_pages, skipped_pages, failed_pages, CAST(processed_crops AS BIGINT) AS processed_crops, CAST(processed_batches AS BIGINT) AS processed_batches, round(s, 4) AS seconds,
  CASE WHEN round(s, 4) = 0 THEN 0.0::DOUBLE ELSE round(processed_crops / round(s, 4), 6) END AS crops_per_second, round(w, 4) AS wall_s FROM t""",
    "k18_hotspots": """
WITH e AS (SELECT unnest(map_keys(models)) AS name, unnest(map_values(models)) AS m FROM page_metrics), c AS (SELECT unnest(map_keys(timing_s)) AS name, unnest(map_values(timing_s)) AS v FROM page_metrics),
t AS (SELECT 'model' AS part, name, round(sum(CASE WHEN m.seconds IS NULL OR isnan(m.seconds) THEN 0 ELSE m.seconds END), 4) AS seconds, CAST(sum(coalesce(m.calls, 0)) AS BIGINT) AS calls, CAST(sum(coalesce(m.items, 0)) AS BIGINT) AS items FROM e GROUP BY name
  UNION ALL SELECT 'component', name, round(sum(CASE WHEN v IS NULL OR isnan(v) THEN 0 ELSE v END), 4), NULL, NULL FROM c GROUP BY name),
r AS (SELECT part, CAST(row_number() OVER (PARTITION BY part ORDER BY seconds DESC, name) AS INTEGER) AS place, name, seconds, calls, items FROM t)
SELECT * FROM r WHERE place <= CASE part WHEN 'model' THEN 10 ELSE 15 END""",
    "pr3_collection_rows": """
WITH d AS (SELECT *, ['chart', 'table', 'infographic', 'page_image'][doc_id % 4 + 1] AS subtype FROM documents),
t AS (SELECT doc_id, page_number, source, CASE WHEN document_type = 'text' THEN text WHEN document_type = 'structured' THEN CASE WHEN subtype NOT IN ('chart', 'infographic') THEN text END
 WHEN document_type = 'image' THEN CASE WHEN subtype = 'page_image' THEN text ELSE source END WHEN document_type = 'audio' THEN text END AS t FROM d)
SELECT doc_id, CAST(length(t) AS INTEGER) AS chars, 2 AS dimensions, source AS source_name, page_number FROM t WHERE length(t) BETWEEN 1 AND 65535 AND doc_id % 7 <> 0""",
    "pr5_ingest_records": "SELECT 'text' AS document_type, text_kind AS content, coalesce(CAST(len(vector) AS INTEGER), NULL) AS dimensions, source AS source_name, CAST(vec_id AS INTEGER) AS number FROM chunk_vectors",
    "x3_ocr_tasks": "SELECT l_orderkey, l_linenumber % 6 AS label, l_quantity AS score FROM lineitem WHERE (l_linenumber % 6 IN (0, 1, 3) OR l_linenumber % 2 = 0) AND l_linenumber % 3 <> 0",
    "x4_chunks": _CH + "SELECT rec_id, CAST(chunk_no AS INTEGER) AS chunk_no, text_kind, text FROM c",
    "x5_flatten": "SELECT md5(t) AS digest, count(*) AS n FROM (SELECT unnest(texts) AS t FROM page_texts) GROUP BY 1",
    "f14_work_list": "SELECT vec_id AS id FROM chunk_vectors WHERE vec_id NOT IN (SELECT chunk_id FROM query_hits WHERE chunk_id IS NOT NULL)",
    "f15_skips": _SKIPS,
    "f7_a9_eligible": _EL + "SELECT * FROM g",
    "l2_top_documents": _EL + "SELECT doc, eligible FROM g ORDER BY eligible DESC, doc DESC LIMIT 25",
    "j1_sidecar_state": f"WITH s AS (SELECT {_K} AS page, min(coalesce(length(trim(payload)), 0) = 0) AS bad FROM region_sidecars WHERE stage = 3 GROUP BY 1) SELECT rec_id, CASE WHEN s.page IS NULL THEN 'missing' WHEN bad THEN 'bad' ELSE 'present' END AS state FROM page_texts p LEFT JOIN s ON p.{_K} = s.page",
    "j2_either_content": f"WITH s AS (SELECT pdf_path, page_number, max({_NB.format('text')}) AS scanned FROM page_scans GROUP BY 1, 2) SELECT rec_id, coalesce(scanned, false) OR {_NB.format('''array_to_string(list_filter(coalesce(texts, []), lambda t: t IS NOT NULL), '')''')} AS usable FROM page_texts p LEFT JOIN s ON s.pdf_path = p.pdf_path AND page_number = page_index",
    "j4_query_image": _CAND,
    "j5_skipped_asked": _J5 + "SELECT * FROM j",
    "a22_share_affected": _J5 + "SELECT CAST(coalesce(sum(queries), 0) AS BIGINT) AS affected, (SELECT count(pdf_page) FROM query_rows) AS queries, round(coalesce(sum(queries), 0) * 100.0::DOUBLE / (SELECT count(pdf_page) FROM query_rows), 1) AS percent FROM j",
    "j6_enriched": "WITH s AS (SELECT pdf_path, arg_min(width, page_id) AS width, min(page_id) AS first_scan FROM page_scans WHERE pdf_path IS NOT NULL GROUP BY 1) SELECT doc_id, width, first_scan FROM documents LEFT JOIN s USING (pdf_path)",
    "j7_hit_records": "SELECT hit_id, text_kind FROM query_hits LEFT JOIN chunk_vectors ON vec_id = chunk_id",
    "j10_context_window": "SELECT page_id AS anchor, CAST(length(string_agg(d.text, chr(10) ORDER BY d.page_number, doc_id)) AS INTEGER) AS chars, md5(string_agg(d.text, chr(10) ORDER BY d.page_number, doc_id)) AS digest FROM page_scans s JOIN documents d ON d.pdf_path = s.pdf_path AND d.page_number BETWEEN s.page_number - 1 AND s.page_number + 1 WHERE d.text IS NOT NULL GROUP BY 1",
    "j11_zip_shortest": "SELECT rec_id, CAST(least(len(texts), len(text_kinds)) AS INTEGER) AS pairs FROM page_texts WHERE texts IS NOT NULL AND text_kinds IS NOT NULL",
    "j13_artifacts": f"""WITH f AS (SELECT '/pages/' || {_STEM} || '_page' || printf('%04d', page_index + 1) || '.png' || CASE WHEN stage = 3 THEN '.graphic_elements_v1.json' ELSE '.table_structure_v1.json' END AS path, max(length(payload)) AS bytes FROM region_sidecars WHERE payload IS NOT NULL GROUP BY 1),
e AS (SELECT image_path, unnest(['', '.pdfium_text.txt', '.page_elements_v3.json', '.graphic_elements_v1.json', '.table_structure_v1.json', '.ocr_v1.json', '.embeddings.pt', '.embedder-input.txt', '.page_element_detections.png']) AS kind FROM (SELECT DISTINCT image_path FROM page_texts))
SELECT image_path, kind, bytes IS NOT NULL AS present, CAST(bytes AS INTEGER) AS bytes FROM e LEFT JOIN f ON path = CASE WHEN kind = '.pdfium_text.txt' THEN regexp_replace(image_path, '\\.[^./]*$', '') || kind ELSE image_path || kind END""",
    "a3_events_by_label": "SELECT coalesce(document_type, 'label_' || (doc_id % 4)) AS label_key, count(*) AS detections FROM documents GROUP BY 1",
    "a4_region_counts": "WITH i AS (SELECT l_orderkey, count(*) AS n, sum(l_linenumber) AS s FROM lineitem GROUP BY 1) SELECT o_orderkey, CAST(coalesce(n, 0) AS INTEGER) AS regions_n, CAST(coalesce(s, 0) AS INTEGER) AS detections_n FROM orders LEFT JOIN i ON l_orderkey = o_orderkey",
    "a5_ocr_summary": f"WITH f AS (SELECT rec_id, texts, list_filter(texts, lambda t: {_NB.format('t')}) AS k FROM page_texts) SELECT rec_id, CAST(coalesce(len(texts), 0) AS INTEGER) AS regions, CAST(coalesce(len(k), 0) AS INTEGER) AS nonempty, md5(array_to_string(list_transform(k[1:8], lambda t: {_ST.format('''replace(t, chr(10), ' ')''')}), '|')) AS samples FROM f",
    "a6_coverage": f"WITH p AS (SELECT DISTINCT {_K} AS page FROM page_texts WHERE {_K} IS NOT NULL), x AS (SELECT 'scans' AS stage, pdf_path || '#' || page_number AS page FROM page_scans UNION SELECT 'stage' || stage, {_K} FROM region_sidecars WHERE stage IN (3, 4) UNION SELECT 'metrics', {_K} FROM page_metrics), c AS (SELECT stage, count(DISTINCT p.page) AS present FROM x LEFT JOIN p USING (page) GROUP BY 1) SELECT stage, (SELECT count(*) FROM p) AS pages, present, (SELECT count(*) FROM p) - present AS missing FROM c",
    "a7_pages_per_document": "WITH k AS (SELECT pdf_path AS doc, coalesce(CAST(page_number AS VARCHAR), 'none') AS p FROM documents UNION SELECT pdf_path, coalesce(CAST(page_number AS VARCHAR), 'none') FROM page_scans UNION SELECT pdf_path, coalesce(CAST(page_index AS VARCHAR), image_path) FROM page_texts) SELECT doc, count(p) AS pages FROM k GROUP BY 1",
    "a8_stage_invocations": f"SELECT stage, count(DISTINCT {_K}) AS pages, count(*) FILTER (coalesce(length(trim(payload)), 0) = 0) AS bad FROM region_sidecars GROUP BY 1",
    "a10_model_totals": _MT + "SELECT model, round(s, 4) AS seconds, CAST(calls AS BIGINT) AS calls, CAST(items AS BIGINT) AS items, round(coalesce(s / nullif(calls, 0), 0), 6) AS per_call, round(coalesce(s / nullif(items, 0), 0), 6) AS per_item FROM g",
    "a11_component_totals": _CT + "SELECT * FROM g",
    "a12_errors": "SELECT CAST(sum(coalesce(len(errors), 0)) AS BIGINT) AS errors, count(*) FILTER (coalesce(len(errors), 0) > 0) AS pages_with_errors FROM page_metrics",
    "a14_batch_histogram": "WITH e AS (SELECT unnest(map_entries(models)) AS m FROM page_metrics), b AS (SELECT m.key AS model, unnest(map_entries(m.value.batch_size_hist)) AS h FROM e) SELECT model, TRY_CAST(h.key AS INTEGER) AS batch_size, CAST(sum(h.value) AS BIGINT) AS batches FROM b GROUP BY 1, 2",
    "a15_latency": _LAT.format(by="event_type", v="value", t="events"),
    "a16_wall_latency": _LAT.format(by="pdf_path", v="wall_s", t="page_metrics"),
    "a17_throughput": "WITH g AS (SELECT strftime(run_at, '%Y-%m-%d') AS day, count(*) AS pages, round(sum(CASE WHEN NOT isnan(wall_s) THEN wall_s END), 3) AS s FROM page_metrics GROUP BY 1) SELECT day, pages, round(coalesce(pages / nullif(s, 0), 0), 6) AS per_second, CAST(ceil(pages / 32) AS BIGINT) AS batches FROM g",
    "a19_totals": "SELECT count(DISTINCT pdf_path) AS pdfs, count(*) AS runs, CAST(sum(cardinality(models)) AS BIGINT) AS calls FROM page_metrics",
    "a21_reasons": f"SELECT reason, count(*) AS pages FROM ({_SKIPS}) GROUP BY 1",
    "a23_sizes": "SELECT coalesce(document_type, 'none') AS kind, count(*) AS files, CAST(sum(n_chars) AS BIGINT) AS bytes FROM documents GROUP BY 1",
    "a27_runs": "SELECT pdf_path, count(*) AS runs, count(*) FILTER (coalesce(len(errors), 0) = 0) AS succeeded, count(*) FILTER (coalesce(len(errors), 0) > 0) AS failed, round(avg(CASE WHEN coalesce(len(errors), 0) = 0 AND NOT isnan(wall_s) THEN wall_s END), 9) AS mean_seconds FROM page_metrics GROUP BY 1",
    "l3_hot_models": _MT + "SELECT model, round(s, 4) AS seconds FROM g ORDER BY 2 DESC, 1 LIMIT 15",
    "l3_hot_components": _CT + "SELECT * FROM g ORDER BY seconds DESC, component LIMIT 20",
    "l1_first_rows": "SELECT image_path, rec_id FROM page_texts ORDER BY image_path NULLS FIRST, rec_id LIMIT 20",
    "l6_unique_pages": "SELECT DISTINCT list_extract(string_split(image_path, '/'), -1) AS image_name FROM page_texts WHERE image_path IS NOT NULL ORDER BY 1 LIMIT 50",
    "w6_progress": "WITH d AS (SELECT strftime(run_at, '%Y-%m-%d') AS day, count(*) AS pages FROM page_metrics WHERE run_at IS NOT NULL GROUP BY 1), r AS (SELECT day, pages, CAST(sum(pages) OVER (ORDER BY day) AS BIGINT) AS done, row_number() OVER (ORDER BY day) AS n, CAST(sum(pages) OVER () AS BIGINT) AS total FROM d) SELECT day, pages, done, round(done / n, 6) AS rate, round((total - done) / (done / n), 6) AS remaining FROM r",
    "m6_merged_counts": "WITH e AS (SELECT strftime(run_at, '%Y-%m-%d') AS day, unnest(map_entries(counts)) AS c FROM page_metrics) SELECT day, c.key AS kind, CAST(sum(c.value) AS BIGINT) AS total FROM e GROUP BY 1, 2",
    "w4_numbered": "WITH n AS (SELECT doc_id, row_number() OVER (ORDER BY doc_id) - 1 AS number FROM documents) SELECT doc_id, number, number // 64 AS batch, number % 4 AS worker FROM n",
    "w5_latest_pages": "SELECT pdf_path, page_index, rec_id FROM page_texts QUALIFY row_number() OVER (PARTITION BY pdf_path, page_index ORDER BY written_at DESC NULLS LAST, rec_id DESC) = 1",
    "u1_both": "SELECT pdf_path FROM documents INTERSECT SELECT pdf_path FROM page_scans WHERE pdf_path IS NOT NULL",
    "u2_any": "SELECT pdf_path FROM (SELECT pdf_path FROM documents UNION SELECT pdf_path FROM page_scans) WHERE pdf_path IS NOT NULL",
    "u4_only": "SELECT pdf_path FROM (SELECT pdf_path FROM documents EXCEPT SELECT pdf_path FROM page_scans) WHERE pdf_path IS NOT NULL",
    "u5_distinct_kinds": "SELECT rec_id, array_to_string(list_transform(list_filter(generate_series(1, len(text_kinds)), lambda i: list_position(text_kinds, text_kinds[i]) = i), lambda i: text_kinds[i]), ',') AS kinds FROM page_texts",
    "k4_embedder_input": _CH + ", v AS (SELECT rec_id, string_agg(CASE WHEN starts_with(text, 'passage: ') THEN text ELSE 'passage: ' || text END, chr(10) ORDER BY chunk_no) AS value FROM c GROUP BY 1) SELECT rec_id, CAST(length(value) AS INTEGER) AS chars, md5(value) AS digest FROM v",
    "k14_without_source": "SELECT source, count(*) AS hits FROM query_hits WHERE source IS NULL OR source <> '/data/pdfs/manual/1037909.pdf' GROUP BY 1",
    "k24_report": "WITH o AS (SELECT * FROM page_scans WHERE pdf_path IS NOT NULL AND page_number IS NOT NULL QUALIFY row_number() OVER (PARTITION BY pdf_path, page_number ORDER BY page_id) = 1), r AS (SELECT pdf_path, CAST(page_number // 200 AS INTEGER) AS part, string_agg('## Page ' || (page_number + 1) || chr(10) || chr(10) || coalesce(text, ''), chr(10) || chr(10) ORDER BY page_number) AS report FROM o GROUP BY 1, 2) SELECT pdf_path, part, CAST(length(report) AS INTEGER) AS chars, md5(report) AS digest FROM r",
    "pr4_vector_rows": "SELECT path AS text, CAST(TRY_CAST(string_split(list_extract(string_split(path, '_page'), -1), '.')[1] AS INTEGER) AS VARCHAR) AS metadata, source FROM chunk_vectors WHERE vector IS NOT NULL",
    "pr11_collection_split": "SELECT doc_id, CASE WHEN document_type IN ('text', 'audio') THEN 'texts' ELSE 'media' END AS collection FROM documents WHERE document_type IN ('text', 'audio', 'image', 'structured')",
    "f12_filtered": "SELECT hit_id FROM query_hits WHERE source LIKE '%manual%' AND CASE WHEN json_valid(metadata) THEN json_extract_string(metadata, '$.page_number') END = '3'",
    "f13_catalog_match": "SELECT doc_id FROM documents WHERE contains(source, 'tas') AND contains(lang, 'e')",
    "f17_viewer_search": "SELECT query_id, query FROM query_rows WHERE contains(lower(concat_ws(' ', pdf_page, query)), 'some')",
    "f20_stage_from": "SELECT stage, count(*) AS files FROM region_sidecars WHERE stage >= 4 GROUP BY 1",
    "m5_sparse": "SELECT l_orderkey, CAST(count(DISTINCT l_linenumber) AS INTEGER) AS entries, sum(l_quantity) AS weight FROM lineitem GROUP BY 1",
    "s21_queries": f"WITH q AS (SELECT DISTINCT query, pdf, gt_page, pdf_page, modality FROM query_rows), c AS (SELECT CASE WHEN {_NB.format('query')} THEN {_ST.format('query')} END AS query, CASE WHEN {_NB.format('pdf')} THEN {_ST.format('pdf')} END AS pdf, gt_page AS page, CASE WHEN {_NB.format('modality')} THEN {_ST.format('modality')} END AS modality, CASE WHEN {_NB.format('pdf_page')} THEN {_ST.format('pdf_page')} END AS pdf_page FROM q), m AS (SELECT query, pdf, page, modality, coalesce(pdf_page, pdf || '_' || page) AS pdf_page FROM c) SELECT * FROM m WHERE query IS NOT NULL OR pdf_page IS NOT NULL",
    "z4_stream": "SELECT event_type, count(*) AS events FROM events GROUP BY 1",
    "z_windows": "SELECT strftime(date_trunc('hour', ts), '%Y-%m-%d %H:%M:%S') AS window_start, event_type, count(*) AS events, round(sum(value), 6) AS total FROM events GROUP BY 1, 2",
    "extra_star_join": "SELECT n_name, round(sum(l_extendedprice * (1 - l_discount)), 2) AS revenue FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey GROUP BY 1",
}
