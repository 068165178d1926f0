"""Joins that find what belongs together: sidecars, images, skipped pages, side tables, neighbouring pages."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pagelathe.functions.text import stem

#: What belongs to a page besides its image; where a recogniser names its files otherwise, pass ``kinds``.
ARTIFACTS = (".pdfium_text.txt", ".page_elements_v3.json", ".graphic_elements_v1.json", ".table_structure_v1.json", ".ocr_v1.json", ".embeddings.pt", ".embedder-input.txt", ".page_element_detections.png")


def with_sidecar(images: DataFrame, sidecars: DataFrame, key: str) -> DataFrame:
    """Images with their sidecar and its state (present, missing or bad)."""
    found = images.join(sidecars.withColumn("__found", F.lit(True)), key, "left")
    state = F.when(F.col("__found").isNull(), "missing").when(F.col("bad"), "bad").otherwise("present")
    return found.withColumn("state", state).drop("__found")


def resolve_image(sidecars: DataFrame, images: DataFrame, embedded: str, path: str, suffix: str) -> DataFrame:
    """The image of each sidecar: the embedded path if there is such an image, else the sidecar's own name without suffix."""
    known = images.select(F.col("path").alias("__known")).distinct()
    a = sidecars.join(known, sidecars[embedded] == F.col("__known"), "left").withColumnRenamed("__known", "__by_path")
    own = F.when(F.col(path).endswith(suffix), F.expr(f"substring({path}, 1, length({path}) - {len(suffix)})"))
    b = a.withColumn("__own", own).join(known, F.col("__own") == F.col("__known"), "left")
    return b.withColumn("image_path", F.coalesce("__by_path", "__known")).drop("__by_path", "__known", "__own")


def candidate_stems(pdf: Column, pdf_page: Column, page: Column) -> Column:
    """Stems under which a query's page image may be stored, best first, each once.

    ``<pdf>_page<NNNN>`` and ``<pdf>_page<N>`` of pdf_page (from 1), the same of page + 1 (from 0), then pdf_page as it is.
    """
    parts = F.split(pdf_page, "_", 2)
    name = F.coalesce(F.when(pdf_page.contains("_"), F.nullif(F.trim(F.get(parts, 0)), F.lit(""))), F.nullif(F.trim(pdf), F.lit("")))
    first = F.trim(F.get(parts, 1)).try_cast("int")
    padded = lambda n, ok: F.when(ok & name.isNotNull(), F.concat(name, F.format_string("_page%04d", n)))
    plain = lambda n, ok: F.when(ok & name.isNotNull(), F.concat(name, F.lit("_page"), n.cast("string")))
    every = F.array(padded(first, first > 0), plain(first, first > 0), padded(page + 1, page >= 0), plain(page + 1, page >= 0), F.nullif(pdf_page, F.lit("")))
    return F.array_distinct(F.filter(every, lambda s: s.isNotNull()))


def resolve_queries(queries: DataFrame, images: DataFrame, key: str) -> DataFrame:
    """Each query with the image of its first candidate stem that has one (``image_path``, null if none has).

    Of images with the same stem, the first path in order counts.
    """
    by_stem = images.groupBy(stem("path").alias("__stem")).agg(F.min("path").alias("__path"))
    each = queries.select(key, F.posexplode(candidate_stems(F.col("pdf"), F.col("pdf_page"), F.col("page"))).alias("__place", "__stem"))
    best = each.join(by_stem, "__stem").groupBy(key).agg(F.min_by("__path", "__place").alias("image_path"))
    return queries.join(best, key, "left")


def skipped_in_queries(skips: DataFrame, queries: DataFrame, key: str = "pdf_page") -> DataFrame:
    """Skipped pages that queries ask for, with reason and queries; of several skip records of a page, the last by order counts."""
    last = skips.groupBy(key).agg(F.max_by("reason", "order").alias("reason"))
    asked = queries.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("queries"))
    return last.join(asked, key)


def first_match(records: DataFrame, side: DataFrame, on: str, fields: Sequence[str], order: str) -> DataFrame:
    """Records with the fields of the first row of ``side`` (by ``order``) with the same ``on``; null where there is none.

    Spark decides whether the deduplicated side is small enough to be broadcast.
    """
    first = side.where(F.col(on).isNotNull()).groupBy(on).agg(*[F.min_by(f, order).alias(f) for f in fields])
    return records.join(first, on, "left")


def by_place(found: DataFrame, records: DataFrame, place: str = "place") -> DataFrame:
    """Search results with the record they point to by stable number; results without one are kept with nulls."""
    return found.join(records, place, "left")


def page_window(anchors: DataFrame, pages: DataFrame, anchor: str, source: str, page: str, reach: int = 0) -> DataFrame:
    """Pages of an anchor's source within ``reach`` pages: the anchor's id with each page's columns.

    The range becomes an equi-join on the page number: an anchor stands once for each page it reaches.
    """
    wanted = anchors.where(F.col(source).isNotNull() & F.col(page).isNotNull()).select(F.col(anchor).alias("anchor"), source, F.explode(F.sequence(F.col(page) - reach, F.col(page) + reach)).alias(page))
    return wanted.join(pages, [source, page])


def window_text(window: DataFrame, order: Sequence[str], text: str) -> DataFrame:
    """The text of each anchor's window, in order, by lines."""
    ordered = F.array_sort(F.collect_list(F.struct(*order, F.col(text).alias("__t"))))
    return window.groupBy("anchor").agg(F.array_join(F.transform(ordered, lambda r: r["__t"]), "\n").alias("text"))


def artifact_presence(pages: DataFrame, image: str, files: DataFrame, kinds: Sequence[str] = ARTIFACTS) -> DataFrame:
    """For each page and kind of artifact, whether the file exists and its size: image_path, kind, present, bytes."""
    each = pages.select(F.col(image).alias("image_path"), F.explode(F.array(F.lit(""), *[F.lit(a) for a in kinds])).alias("kind"))
    # The page's text is stored under the stem, all else under the image's full name.
    path = F.when(F.col("kind").endswith(".txt") & (F.col("kind") != ".embedder-input.txt"), F.concat(F.regexp_replace("image_path", r"\.[^./]*$", ""), "kind")).otherwise(F.concat("image_path", "kind"))
    known = files.groupBy("path").agg(F.max("length").alias("bytes"))
    return each.withColumn("path", path).join(known, "path", "left").select("image_path", "kind", F.col("bytes").isNotNull().alias("present"), "bytes")


def numbered(df: DataFrame, order: Sequence[str], name: str = "number") -> DataFrame:
    """A contiguous number from 0 in the given total order, without bringing all rows into one task.

    Rows are sorted by range partition; only the partitions' sizes meet on the driver.
    """
    from pagelathe.session import cut

    placed = cut(df.orderBy(*order).withColumn("__part", F.spark_partition_id()).withColumn("__place", F.monotonically_increasing_id()), "numbered")
    sizes = placed.groupBy("__part").agg(F.count(F.lit(1)).alias("n"), F.min("__place").alias("first")).orderBy("__part").collect()
    rows, at = [], 0
    for r in sizes:
        rows.append((r["__part"], at - r["first"]))
        at += r["n"]
    shift = df.sparkSession.createDataFrame(rows, "__part int, __shift long")
    return placed.join(F.broadcast(shift), "__part").withColumn(name, F.col("__place") + F.col("__shift")).drop("__part", "__place", "__shift")


def sampled(df: DataFrame, count: int, key: str, seed: int = 0) -> DataFrame:
    """``count`` rows by a seeded hash of the key, the same on every run."""
    return df.orderBy(F.xxhash64(F.lit(seed), key), key).limit(count)


def first_rows(df: DataFrame, order: Sequence[str], limit: int | None) -> DataFrame:
    """In order, the first ``limit`` rows (all without one)."""
    ordered = df.orderBy(*order)
    return ordered if limit is None else ordered.limit(limit)


def one_by_order(df: DataFrame, key: Sequence[str], order: Sequence[Column], name: str = "__r") -> DataFrame:
    """The first row of each key."""
    return df.withColumn(name, F.row_number().over(Window.partitionBy(*key).orderBy(*order))).where(F.col(name) == 1).drop(name)
