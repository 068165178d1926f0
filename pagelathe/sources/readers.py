"""Readers: file listings, sidecars, texts, query and skip tables, metrics, side tables."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagelathe.functions.text import base_name, not_blank, page_from_path, query_column, ustrip
from pagelathe.sources.schemas import METRICS, SKIPS

#: Image extensions of a page folder and of a benchmark folder.
IMAGE_EXTENSIONS = ("png", "jpg", "jpeg")
WIDE_IMAGE_EXTENSIONS = (*IMAGE_EXTENSIONS, "webp", "bmp", "tif", "tiff")
#: Sidecar suffixes by stage; readers take any suffix.
SIDECARS = {2: ".page_elements_v3.json", 3: ".graphic_elements_v1.json", 4: ".table_structure_v1.json", 5: ".ocr_v1.json"}
_FILE = "path string, modificationTime timestamp, length long"


def list_files(spark: SparkSession, path: str, extensions: Iterable[str] = (), suffix: str = "", recursive: bool = False) -> DataFrame:
    """Path, modificationTime, length of files with one of the extensions (any case) or the suffix, contents unread.

    A missing folder gives an empty table. Order by path where order matters; a listing has none.
    """
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", str(recursive).lower())
    try:
        files = reader.load(path).select("path", "modificationTime", "length")
    except AnalysisException as problem:
        if "PATH_NOT_FOUND" in (problem.getCondition() or ""):
            return spark.createDataFrame([], _FILE)
        raise
    wanted = [e.lower().lstrip(".") for e in extensions]
    if wanted:
        files = files.where(F.lower(F.regexp_extract(base_name("path"), r"\.([^.]*)$", 1)).isin(*wanted))
    return files.where(F.col("path").endswith(suffix)) if suffix else files


def list_images(spark: SparkSession, path: str, recursive: bool = False, wide: bool = False) -> DataFrame:
    return list_files(spark, path, WIDE_IMAGE_EXTENSIONS if wide else IMAGE_EXTENSIONS, recursive=recursive)


def list_pdfs(spark: SparkSession, path: str) -> DataFrame:
    """A PDF or the PDFs of a folder, not of folders within."""
    return list_files(spark, path, ("pdf",))


def read_sidecars(spark: SparkSession, path: str, schema: str, suffix: str = ".json", recursive: bool = True) -> DataFrame:
    """One row per JSON file, with path, json (struct) and bad (unreadable, or no object)."""
    texts = read_texts(spark, path, suffix, recursive, strip=False)
    parsed = texts.withColumn("json", F.from_json("text", f"{schema}, _broken string", {"columnNameOfCorruptRecord": "_broken", "mode": "PERMISSIVE"}))
    bad = F.col("json").isNull() | F.col("json._broken").isNotNull() | ~ustrip("text").startswith("{")
    return parsed.select("path", F.when(~bad, F.col("json").dropFields("_broken")).alias("json"), bad.alias("bad"))


def read_texts(spark: SparkSession, path: str, suffix: str = ".txt", recursive: bool = True, strip: bool = True) -> DataFrame:
    """Path and text of whole files; bytes that are no UTF-8 become replacement characters."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", str(recursive).lower()).option("pathGlobFilter", f"*{suffix}")
    text = F.make_valid_utf8(F.col("content").cast("string"))
    return reader.load(path).select("path", (ustrip(text) if strip else text).alias("text"))


def read_chunks(spark: SparkSession, path: str, vector: str = "vector", dimensions: int | None = None) -> DataFrame:
    """Embedding chunks stored as Parquet, with page_number from the path; a vector of another length is an error."""
    chunks = spark.read.parquet(path).withColumn("page_number", page_from_path("path"))
    if dimensions is None:
        return chunks
    wrong = F.concat(F.lit("vector of "), F.size(vector).cast("string"), F.lit(f" entries, not {dimensions}"))
    return chunks.withColumn(vector, F.when(F.col(vector).isNull() | (F.size(vector) == dimensions), F.col(vector)).otherwise(F.raise_error(wrong).cast(chunks.schema[vector].dataType)))


def read_queries(spark: SparkSession, path: str) -> DataFrame:
    """Query, pdf, page, modality, pdf_page of a query CSV.

    Names match in any case; ``gt_page`` stands for ``page``. Values are stripped, blanks are null, a page that is no integer is null,
    ``pdf_page`` is made of the two where missing, and rows with neither query nor pdf_page are dropped.
    """
    raw = spark.read.csv(path, header=True, multiLine=True, escape='"')
    return clean_queries(raw)


def clean_queries(raw: DataFrame) -> DataFrame:
    names = {c.strip().lower(): c for c in reversed(raw.columns)}
    at = lambda *options: next((F.col(f"`{names[o]}`").cast("string") for o in options if o in names), F.lit(None).cast("string"))
    value = lambda c: F.when(not_blank(c), ustrip(c))
    query = query_column(raw.columns)
    rows = raw.select(
        value(F.col(f"`{query}`").cast("string")).alias("query"), value(at("pdf")).alias("pdf"), value(at("page", "gt_page")).try_cast("int").alias("page"), value(at("modality")).alias("modality"), value(at("pdf_page")).alias("given")
    )
    made = F.when(F.col("pdf").isNotNull() & F.col("page").isNotNull(), F.concat("pdf", F.lit("_"), F.col("page").cast("string")))
    return rows.withColumn("pdf_page", F.coalesce("given", made)).drop("given").where(F.col("query").isNotNull() | F.col("pdf_page").isNotNull())


def latest_path(paths: Iterable[str], prefix: str = "stage6_skipped_") -> str | None:
    """The last of the paths by name among those with the prefix."""
    return max((p for p in paths if p.rsplit("/", 1)[-1].startswith(prefix)), default=None)


def read_skips(spark: SparkSession, path: str) -> DataFrame:
    """A skip log."""
    return spark.read.schema(SKIPS).csv(path, header=True, multiLine=True, escape='"')


def read_metrics(spark: SparkSession, path: str) -> DataFrame:
    """Metrics of PDFs, one row per file; no file at all is an error."""
    files = list_files(spark, path, suffix=".metrics.json", recursive=True)
    if files.isEmpty():
        raise FileNotFoundError(f"no metrics under {path}")
    return spark.read.schema(METRICS).option("multiLine", True).option("recursiveFileLookup", "true").option("pathGlobFilter", "*.metrics.json").json(path)


def read_side_table(spark: SparkSession, path: str) -> DataFrame:
    """A metadata table by its extension; a CSV's first column is its index and is dropped."""
    kind = path.rstrip("/").rsplit(".", 1)[-1].lower()
    if kind == "csv":
        rows = spark.read.csv(path, header=True, multiLine=True, escape='"')
        return rows.drop(rows.columns[0])
    if kind == "json":
        return spark.read.json(path)
    if kind in ("parquet", "pq"):
        return spark.read.parquet(path)
    raise ValueError(f"a side table is json, csv or parquet, not {kind}")
