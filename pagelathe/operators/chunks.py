"""From pages to chunks: region fan-out, chunk assembly, skips, work lists and record clean-up."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagelathe.functions.boxes import coerced_box
from pagelathe.functions.labels import OCR_LABELS, is_ocr_target
from pagelathe.functions.text import PASSAGE_PREFIX, not_blank, record_text, ustrip

#: Kinds of chunks, and reasons for skipping a page.
PAGE_TEXT, OCR_REGION = "pdfium_page_text", "ocr_region"
ALREADY, NO_CONTENT, NO_MEMORY = "already_exists", "no_content", "cuda_oom"


def ocr_tasks(pages: DataFrame, key: str, detections: str) -> DataFrame:
    """Detections to be read, with their position in the page: ``key``, position, detection, bbox."""
    each = pages.select(key, F.posexplode(detections).alias("position", "detection"))
    box = coerced_box(F.col("detection.bbox_xyxy_norm"))
    return each.where(is_ocr_target(F.col("detection.label_name"), F.col("detection.label").cast("string")) & box.isNotNull()).withColumn("bbox", box)


def assemble(pages: DataFrame, key: str, page_text: Column | str, regions: Column | str, prefix: str = "") -> DataFrame:
    """Chunks of each page, page text first, then regions in order: ``key``, chunk_no, text_kind, text.

    Blank and null texts are left out before numbering. The stored text is raw; ``prefix`` is for what an embedder is given.
    """
    page, region = (F.col(c) if isinstance(c, str) else c for c in (page_text, regions))
    entry = lambda t, kind: F.struct(F.lit(kind).alias("text_kind"), ustrip(t).alias("text"))
    whole = F.concat(F.array(entry(page, PAGE_TEXT)), F.coalesce(F.transform(region, lambda t: entry(t, OCR_REGION)), F.array().cast("array<struct<text_kind:string,text:string>>")))
    kept = F.filter(whole, lambda c: not_blank(c["text"]))
    out = pages.select(key, F.posexplode(kept).alias("chunk_no", "c"))
    return out.select(key, "chunk_no", "c.text_kind", F.concat(F.lit(prefix), "c.text").alias("text") if prefix else F.col("c.text"))


def embedder_text(c: Column | str) -> Column:
    """Text as the embedder gets it, whether or not it was stored with the prefix."""
    c = F.col(c) if isinstance(c, str) else c
    return F.when(c.startswith(PASSAGE_PREFIX), c).otherwise(F.concat(F.lit(PASSAGE_PREFIX), c))


def skips(pages: DataFrame, key: str, page_text: Column, regions: Column, done: DataFrame | None = None) -> DataFrame:
    """image_path, reason, details of pages that are not embedded: those ``done`` (by key), then those without content."""
    flagged = pages.withColumn("__empty", ~not_blank(page_text) & (F.coalesce(F.size(F.filter(regions, not_blank)), F.lit(0)) <= 0))
    flagged = flagged.join(done.select(key).distinct().withColumn("__done", F.lit(True)), key, "left") if done is not None else flagged.withColumn("__done", F.lit(None).cast("boolean"))
    reason = F.when(F.col("__done"), ALREADY).when(F.col("__empty"), NO_CONTENT)
    return flagged.withColumn("reason", reason).where("reason IS NOT NULL").select(F.col(key).cast("string").alias("image_path"), "reason", F.lit("").alias("details"))


def work_list(wanted: DataFrame, done: DataFrame, key: str) -> DataFrame:
    """What is not done yet; rows without key are never done."""
    return wanted.join(done.select(key).distinct(), key, "left_anti")


def flatten_records(nested: DataFrame, column: str) -> DataFrame:
    """Rows of an array of arrays of records; null lists and null records are skipped."""
    return nested.select(F.explode(F.flatten(F.filter(column, lambda x: x.isNotNull()))).alias("record")).where("record IS NOT NULL").select("record.*")


def zip_shortest(arrays: dict[str, Column | str]) -> Column:
    """Arrays zipped to the length of the shortest, where Spark pads to the longest; null if one is null."""
    cols = {n: F.col(c) if isinstance(c, str) else c for n, c in arrays.items()}
    least = F.array_min(F.array(*[F.size(c) for c in cols.values()]))
    return F.slice(F.arrays_zip(*[c.alias(n) for n, c in cols.items()]), 1, F.greatest(least, F.lit(0)))


def clean_records(records: DataFrame, enabled: Sequence[str], most: int = 65_535) -> DataFrame:
    """Ingest records as collection rows: text, vector, source, content_metadata; those without text or vector go."""
    m = "metadata."
    fields = {"content": m + "content", "table_content": m + "table_metadata.table_content", "caption": m + "image_metadata.caption", "image_text": m + "image_metadata.text", "audio_transcript": m + "audio_metadata.audio_transcript"}
    text = record_text("document_type", F.col(m + "content_metadata.subtype"), fields, enabled, most, F.col(m + "embedding").isNotNull())
    return records.withColumn("text", text).where("text IS NOT NULL").select("text", F.col(m + "embedding").alias("vector"), F.col(m + "source_metadata").alias("source"), F.col(m + "content_metadata").alias("content_metadata"))


def to_vector_rows(chunks: DataFrame, embedding: str = "embedding", content: str = "content", source: str = "source_id", page: str = "page_number") -> DataFrame:
    """P4, V12 rows: vector, text, metadata (the page as string), source; chunks without embedding go."""
    return chunks.where(F.col(embedding).isNotNull()).select(F.col(embedding).alias("vector"), F.col(content).alias("text"), F.col(page).cast("string").alias("metadata"), F.col(source).alias("source"))


def to_records(rows: DataFrame) -> DataFrame:
    """P5: collection rows as ingest records."""
    return rows.select(F.lit("text").alias("document_type"), F.struct(F.col("text").alias("content"), F.col("vector").alias("embedding"), F.struct(F.col("source").alias("source_name")).alias("source_metadata"), F.struct(F.col("metadata").try_cast("int").alias("page_number")).alias("content_metadata")).alias("metadata"))


def sparse_map(terms: Column | str) -> Column:
    """M5: a sparse vector from an array of structs (index, weight); an empty one is {0: 0.0}."""
    c = F.col(terms) if isinstance(terms, str) else terms
    return F.when(F.size(c) > 0, F.map_from_entries(c)).otherwise(F.create_map(F.lit(0), F.lit(0.0)))


def eligible(label: Column, box: Column) -> Column:
    """a detection whose region is a table, chart or infographic and whose page box has four entries."""
    return F.coalesce(label.try_cast("int").isin(*OCR_LABELS), F.lit(False)) & F.coalesce(F.size(box) == 4, F.lit(False))
