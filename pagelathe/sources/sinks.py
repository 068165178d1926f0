"""Writers. Spark's file committer makes each of them atomic: a reader sees a whole table or none."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagelathe.operators.evaluate import KS


def write_json(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """JSON lines."""
    df.write.mode(mode).json(path)


def write_embeddings(chunks: DataFrame, path: str, by: str = "doc", mode: str = "overwrite") -> None:
    """K3: chunks in folders by document."""
    chunks.write.mode(mode).partitionBy(by).parquet(path)


def embedder_input(chunks: DataFrame, by: list[str], order: str, text: Column | str = "text") -> DataFrame:
    """K4: the exact embedder input of each page, its texts by line in order: the ``by`` columns and value."""
    ordered = F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), (F.col(text) if isinstance(text, str) else text).alias("t"))))
    return chunks.groupBy(*by).agg(F.array_join(F.transform(ordered, lambda r: r["t"]), "\n").alias("value"))


def write_skips(skips: DataFrame, path: str) -> bool:
    """K5: the skip log, only if there is something in it; whether it was written."""
    if skips.isEmpty():
        return False
    skips.select("image_path", "reason", "details").write.mode("overwrite").csv(path, header=True, escape='"')
    return True


def write_hits(detail: DataFrame, path: str) -> None:
    """All queries, and the hits and the misses of each cut-off, as CSV."""
    flat = detail.withColumn("retrieved", F.array_join(F.transform("retrieved", lambda x: x.cast("string")), "|"))
    flat.write.mode("overwrite").csv(f"{path}/queries", header=True)
    for k in KS:
        flat.where(f"hit_at_{k}").write.mode("overwrite").csv(f"{path}/hits_at_{k}", header=True)
        flat.where(f"NOT hit_at_{k}").write.mode("overwrite").csv(f"{path}/misses_at_{k}", header=True)


def report_document(pages: DataFrame, by: str, number: str, section: Column, part_pages: int = 200) -> DataFrame:
    """Markdown texts of each document in parts of ``part_pages`` pages, in order: ``by``, part, report.

    The parts bound what one task holds, however long a document is.
    """
    part = F.floor(F.col(number) / part_pages).cast("int").alias("part")
    ordered = F.array_sort(F.collect_list(F.struct(F.col(number).alias("n"), section.alias("s"))))
    return pages.groupBy(by, part).agg(F.array_join(F.transform(ordered, lambda r: r["s"]), "\n\n").alias("report"))


def removable(files: DataFrame, stage: Column, least: int) -> DataFrame:
    """Files of stage ``least`` and above, by stage: stage, files, bytes (the dry run; nothing is deleted)."""
    return files.withColumn("stage", stage).where(F.col("stage") >= least).groupBy("stage").agg(F.count(F.lit(1)).alias("files"), F.sum("length").alias("bytes"))


def remove_outputs(files: DataFrame, stage: Column, least: int, force: bool = False) -> int:
    """Delete the files (path) of stage ``least`` and above; how many. Without ``force`` nothing is deleted and an error tells how many files and bytes it would be.

    Paths come to the driver a partition at a time. A file that is gone already counts as none.
    """
    doomed = files.where(stage >= least)
    if not force:
        would = doomed.agg(F.count(F.lit(1)).alias("files"), F.coalesce(F.sum("length"), F.lit(0)).alias("bytes")).first()
        raise ValueError(f"{would.files} files of {would.bytes} bytes would be deleted; force does it")
    spark, gone = files.sparkSession, 0
    for row in doomed.select("path").toLocalIterator():
        target = spark._jvm.org.apache.hadoop.fs.Path(row.path)  # noqa: SLF001
        gone += bool(target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, False))  # noqa: SLF001
    return gone


def summary_lines(hotspots: DataFrame, pdfs: int, pages: int) -> list[str]:
    """The lines of a run's summary, from ``reports.run_hotspots`` (a few dozen rows)."""
    rows = hotspots.orderBy("part", "place").collect()
    rate = lambda seconds, n: seconds / n if n else 0.0
    lines = ["Summary of the run", f"pdfs={pdfs} pages={pages}", "", "Models by seconds:"]
    lines += [f"- {r.name}: seconds={r.seconds:.2f} calls={r.calls} items={r.items} per_call_s={rate(r.seconds, r.calls):.3f} per_item_s={rate(r.seconds, r['items']):.6f}" for r in rows if r.part == "model"]
    return [*lines, "", "Components by seconds:", *(f"- {r.name}: {r.seconds:.2f}s" for r in rows if r.part == "component")]


def write_pages(pages: DataFrame, path: str) -> int:
    """K2: image and text of each page (path, page_number, image, text), as a table; pages that stand there already are left out. How many were written."""
    spark = pages.sparkSession
    new = pages.where("error IS NULL").select("path", "page_number", "image", "text")
    target = spark._jvm.org.apache.hadoop.fs.Path(path)  # noqa: SLF001
    before = 0
    if target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target):  # noqa: SLF001
        there = spark.read.parquet(path).select("path", "page_number")
        before = there.count()
        new = new.join(there, ["path", "page_number"], "left_anti")
    new.write.mode("append").parquet(path)
    return spark.read.parquet(path).count() - before


def write_bundle(files: DataFrame, path: str, most_bytes: int = 1 << 30) -> int:
    """Files (name, content) and a manifest in one zip on the driver; how many. Beyond ``most_bytes`` it refuses before reading contents."""
    import zipfile

    size = files.agg(F.sum(F.octet_length("content"))).first()[0] or 0
    if size > most_bytes:
        raise ValueError(f"{size} bytes are too many for one bundle")
    count = 0
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as out:
        names = []
        for row in files.select("name", "content").orderBy("name").toLocalIterator():
            out.writestr(row.name, bytes(row.content))
            names.append(row.name)
            count += 1
        out.writestr("manifest.txt", "\n".join(names))
    return count


def schema_tree(df: DataFrame, depth: int = 3) -> list[str]:
    """A table's nested structure as indented lines, to a depth. Nothing is unpickled to find it."""
    from pyspark.sql import types as T

    lines: list[str] = []

    def walk(name: str, kind: T.DataType, level: int) -> None:
        lines.append("  " * level + f"{name}: {kind.typeName()}")
        if level + 1 >= depth:
            return
        if isinstance(kind, T.StructType):
            for field in kind:
                walk(field.name, field.dataType, level + 1)
        elif isinstance(kind, T.ArrayType):
            walk("[]", kind.elementType, level + 1)
        elif isinstance(kind, T.MapType):
            walk("{}", kind.valueType, level + 1)

    for field in df.schema:
        walk(field.name, field.dataType, 0)
    return lines
