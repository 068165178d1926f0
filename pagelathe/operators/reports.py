"""Coverage, counts, hotspots and latency reports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pagelathe.functions.text import label_key, not_blank, ustrip


def detections_by_label(detections: DataFrame, page: Sequence[str] = ()) -> DataFrame:
    """Detections of each label (of each page), most first, then by name."""
    return detections.groupBy(*page, label_key("label_name", "label").alias("label_key")).agg(F.count(F.lit(1)).alias("detections")).orderBy(*page, F.desc("detections"), "label_key")


def region_counts(sidecars: DataFrame, regions: Column) -> DataFrame:
    """A4: the columns of ``sidecars`` with regions and detections of each (0 where null)."""
    return sidecars.withColumns({
        "regions_n": F.greatest(F.size(regions), F.lit(0)),
        "detections_n": F.coalesce(F.aggregate(regions, F.lit(0), lambda acc, r: acc + F.greatest(F.coalesce(F.size(r["detections"]), F.lit(0)), F.lit(0))), F.lit(0)),
    })


def ocr_summary(texts: Column, samples: int = 8) -> list[Column]:
    """A5: number of region texts, of those with content, and the first few of them in one line each."""
    full = F.filter(texts, not_blank)
    return [
        F.coalesce(F.greatest(F.size(texts), F.lit(0)), F.lit(0)).alias("regions"), F.coalesce(F.greatest(F.size(full), F.lit(0)), F.lit(0)).alias("nonempty"),
        F.transform(F.slice(full, 1, samples), lambda t: ustrip(F.regexp_replace(t, "\n", " "))).alias("samples"),
    ]


def coverage(pages: DataFrame, stages: dict[str, DataFrame], key: str) -> DataFrame:
    """Pages in all, and of each stage how many of them it has and lacks: stage, pages, present, missing."""
    wanted = pages.select(key).where(F.col(key).isNotNull()).distinct()
    for name, done in stages.items():
        wanted = wanted.join(done.select(key).distinct().withColumn(f"has_{name}", F.lit(True)), key, "left")
    one = wanted.agg(F.count(F.lit(1)).alias("pages"), *[F.count_if(F.col(f"has_{n}")).alias(n) for n in stages])
    stack = F.explode(F.array(*[F.struct(F.lit(n).alias("stage"), F.col(n).alias("present")) for n in stages])).alias("s")
    return one.select("pages", stack).select("s.stage", "pages", "s.present", (F.col("pages") - F.col("s.present")).alias("missing"))


def pages_per_document(keys: Sequence[DataFrame], doc: str = "doc", page: Column | None = None) -> DataFrame:
    """Distinct pages of each document over several sources of (doc, page, image_name); without page number the name counts."""
    whole = keys[0].select(doc, "page", "image_name")
    for other in keys[1:]:
        whole = whole.unionByName(other.select(doc, "page", "image_name"))
    name = page if page is not None else F.coalesce(F.col("page").cast("string"), "image_name")
    return whole.select(doc, name.alias("__page")).distinct().groupBy(doc).agg(F.count("__page").alias("pages"))


def eligible_by_document(detections: DataFrame, doc: str, stage: str, eligible: Column) -> DataFrame:
    """Detections and eligible detections of each document, in all and by stage 3 and 4."""
    own = lambda s: F.col(stage) == s
    return detections.groupBy(doc).agg(
        F.count(F.lit(1)).alias("total"), F.count_if(eligible).alias("eligible"),
        *[F.count_if(own(s)).alias(f"total_stage{s}") for s in (3, 4)], *[F.count_if(own(s) & eligible).alias(f"eligible_stage{s}") for s in (3, 4)],
    )


def top_documents(counts: DataFrame, doc: str, by: str, k: int = 25) -> DataFrame:
    """L2: most first, among equals the last name first."""
    return counts.orderBy(F.desc(by), F.desc(doc)).limit(k)


def model_totals(metrics: DataFrame, models: str = "models") -> DataFrame:
    """Seconds, calls, items of each model, and per call and item (0 where nothing was counted).

    Null and NaN seconds count as 0. Sums are partly taken before the shuffle.
    """
    each = metrics.select(F.explode(models).alias("model", "m"))
    seconds = F.nanvl(F.coalesce("m.seconds", F.lit(0.0)), F.lit(0.0))
    total = each.groupBy("model").agg(F.sum(seconds).alias("seconds"), F.sum(F.coalesce("m.calls", F.lit(0))).alias("calls"), F.sum(F.coalesce("m.items", F.lit(0))).alias("items"))
    per = lambda c: F.round(F.coalesce(F.try_divide("seconds", c), F.lit(0.0)), 6)
    return total.select("model", F.round("seconds", 4).alias("seconds"), "calls", "items", per(F.col("calls")).alias("per_call"), per(F.col("items")).alias("per_item"))


def component_totals(metrics: DataFrame, timings: str = "timing_s") -> DataFrame:
    """Seconds of each component."""
    return metrics.select(F.explode(timings).alias("component", "s")).groupBy("component").agg(F.round(F.sum(F.nanvl(F.coalesce("s", F.lit(0.0)), F.lit(0.0))), 4).alias("seconds"))


def hotspots(totals: DataFrame, name: str, k: int) -> DataFrame:
    """L3: the slowest, equal ones by name."""
    return totals.orderBy(F.desc("seconds"), name).limit(k)


def error_count(metrics: DataFrame, errors: str = "errors") -> DataFrame:
    """Errors and pages with errors."""
    n = F.greatest(F.coalesce(F.size(errors), F.lit(0)), F.lit(0))
    return metrics.agg(F.sum(n).alias("errors"), F.count_if(n > 0).alias("pages_with_errors"))


def batch_histogram(metrics: DataFrame, models: str = "models") -> DataFrame:
    """Batches of each size by model: model, batch_size, batches."""
    each = metrics.select(F.explode(models).alias("model", "m")).select("model", F.explode("m.batch_size_hist").alias("batch_size", "n"))
    return each.groupBy("model", F.col("batch_size").try_cast("int").alias("batch_size")).agg(F.sum("n").alias("batches"))


#: Steps that approximate percentiles are accurate to, and so half the width of the band searched exactly.
ACCURACY = 10_000


#: Parts that the values of a group are spread over where they meet their bands.
SALTS = 32


def exact_percentiles(df: DataFrame, by: Sequence[str], value: Column | str, at: Sequence[float], also: Sequence[Column] = ()) -> DataFrame:
    """Exact percentiles, interpolated at (n - 1) * p, of each group: the ``by`` columns, n and the array percentiles (in order of ``at``).

    ``also`` are aggregates over the values (column ``__v``) that come along. No task holds a group: a mergeable summary bounds where each percentile lies, values outside these bands are only counted, and the distinct values in a
    band, a few ten-thousandths of the group, are ordered. Null and NaN values do not count; a null key is a key.
    """
    c = F.col(value) if isinstance(value, str) else value
    kept = df.select(*by, c.cast("double").alias("__v")).where(F.col("__v").isNotNull() & ~F.isnan("__v"))
    eps = 2.0 / ACCURACY
    low, high = ([min(1.0, max(0.0, p + sign * eps)) for p in at] for sign in (-1, 1))
    near = lambda ps: F.percentile_approx("__v", F.array(*[F.lit(p) for p in ps]), F.lit(ACCURACY))
    bound = kept.groupBy(*by).agg(F.count(F.lit(1)).alias("n"), F.min("__v").alias("__min"), F.max("__v").alias("__max"), near(low).alias("__low"), near(high).alias("__high"), F.struct(F.lit(0).alias("_"), *also).alias("__also"))
    # In a small group a rank is wider than the summary's error, so all its values are its band.
    small = F.col("n") <= 4 * ACCURACY
    bands = F.array(*[
        F.struct(F.lit(i).alias("i"), F.lit(p).alias("p"), (F.col("__min") if low[i] == 0 else F.when(small, F.col("__min")).otherwise(F.get("__low", i))).alias("low"), (F.col("__max") if high[i] == 1 else F.when(small, F.col("__max")).otherwise(F.get("__high", i))).alias("high"))
        for i, p in enumerate(at)
    ])
    keys = [f"__k{i}" for i in range(len(by))]
    bound = bound.select(*[F.col(b).alias(k) for b, k in zip(by, keys)], "n", "__also", F.explode(bands).alias("b"))
    # Bands are few and stand in every part; values of a hot group are spread over the parts, whatever kind of join is taken.
    bound = bound.withColumn("__part", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    kept = kept.withColumn("__salt", F.pmod(F.xxhash64("__v", F.spark_partition_id()), F.lit(SALTS)).cast("int"))
    same = F.col("__salt") == F.col("__part")
    for b, k in zip(by, keys):
        same = same & F.col(b).eqNullSafe(F.col(k))
    met = kept.join(bound, same).where(F.col("__v") <= F.col("b.high"))
    # All values below a band fall together into one row of counts.
    place = F.when(F.col("__v") >= F.col("b.low"), F.col("__v"))
    counted = met.groupBy(*by, "n", F.col("b.i").alias("i"), F.col("b.p").alias("p"), place.alias("v")).agg(F.count(F.lit(1)).alias("m"), F.any_value("__also").alias("__also"))
    upto = F.sum("m").over(Window.partitionBy(*by, "i").orderBy(F.col("v").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, 0))
    rank = F.col("p") * (F.col("n") - 1)
    first = lambda r: F.min(F.when(F.col("v").isNotNull() & (F.col("__upto") > r), F.col("v")))
    found = counted.withColumn("__upto", upto).groupBy(*by, "n", "i", "p").agg(first(F.floor(rank)).alias("a"), first(F.ceil(rank)).alias("z"), F.any_value("__also").alias("__also"))
    exact = F.col("a") + (F.col("z") - F.col("a")) * (rank - F.floor(rank))
    return found.groupBy(*by, "n").agg(F.transform(F.array_sort(F.collect_list(F.struct("i", exact.alias("x")))), lambda r: r["x"]).alias("percentiles"), F.any_value("__also").alias("__also")).select(*by, "n", "percentiles", *[F.col("__also")[f].alias(f) for f in bound.schema["__also"].dataType.names[1:]])


def latency(df: DataFrame, by: Sequence[str], value: Column | str) -> DataFrame:
    """N, p50, p90, p99 (interpolated at (n - 1) * p), mean and sample deviation (0 for one value), rounded."""
    c = F.col(value) if isinstance(value, str) else value
    moments = (F.round(F.avg("__v"), 9).alias("mean"), F.round(F.coalesce(F.stddev_samp("__v"), F.lit(0.0)), 6).alias("deviation"))
    found = exact_percentiles(df, by, c, (0.5, 0.9, 0.99), moments)
    return found.select(*by, "n", *[F.round(F.get("percentiles", i), 6).alias(f"p{p}") for i, p in enumerate((50, 90, 99))], "mean", "deviation")


def throughput(count: Column, seconds: Column) -> Column:
    """Per second, 0 where no time passed."""
    return F.round(F.coalesce(F.try_divide(count.cast("double"), seconds), F.lit(0.0)), 6)


def batches_needed(count: Column, size: int) -> Column:
    """A20."""
    return F.ceil(count / F.lit(size)).cast("long")


def progress(periods: DataFrame, period: str, count: str) -> DataFrame:
    """Running total, rate per period so far, and periods the rest takes at that rate.

    ``periods`` has one row for each period (aggregate first): only these few rows meet in one task.
    """
    w = Window.orderBy(period).rowsBetween(Window.unboundedPreceding, 0)
    total = F.sum(count).over(Window.partitionBy())
    out = periods.select(period, count, F.sum(count).over(w).alias("done"), F.count(F.lit(1)).over(w).alias("__n"), total.alias("__total"))
    rate = F.col("done") / F.col("__n")
    return out.select(period, count, "done", F.round(rate, 6).alias("rate"), F.round(F.try_divide(F.col("__total") - F.col("done"), rate), 6).alias("remaining"))


def reasons(skips: DataFrame) -> DataFrame:
    """Skips by reason, most first, then by name."""
    return skips.groupBy("reason").agg(F.count(F.lit(1)).alias("pages")).orderBy(F.desc("pages"), "reason")


def share_percent(part: Column, whole: Column) -> Column:
    """Percent to one decimal; null without a whole."""
    return F.round(F.try_divide(part * 100.0, whole), 1)


def sizes_by_kind(files: DataFrame, kind: Column) -> DataFrame:
    """Files and bytes of each kind."""
    return files.groupBy(kind.alias("kind")).agg(F.count(F.lit(1)).alias("files"), F.sum("length").alias("bytes"))


def run_summary(runs: DataFrame, by: Sequence[str], ok: Column, seconds: Column) -> DataFrame:
    """Runs, successes, failures, and mean seconds of the successful."""
    return runs.groupBy(*by).agg(F.count(F.lit(1)).alias("runs"), F.count_if(ok).alias("succeeded"), F.count_if(~ok).alias("failed"), F.round(F.avg(F.when(ok, seconds)), 9).alias("mean_seconds"))


def run_report(metrics: DataFrame, model: str) -> DataFrame:
    """One row on a run of ``model``: pages, processed, skipped and failed pages, crops and batches processed, seconds, crops a second (0 if no time passed), wall seconds.

    ``metrics`` has errors, models and wall_s of each page. A page with errors failed, one the model did not run on was skipped.
    """
    m = F.try_element_at("models", F.lit(model))
    failed = F.coalesce(F.size("errors"), F.lit(0)) > 0
    number = lambda c: F.nanvl(F.coalesce(c, F.lit(0.0)), F.lit(0.0))
    total = metrics.agg(
        F.count(F.lit(1)).alias("pages"), F.count_if(~failed & m.isNotNull()).alias("processed_pages"), F.count_if(~failed & m.isNull()).alias("skipped_pages"), F.count_if(failed).alias("failed_pages"),
        F.coalesce(F.sum(m["items"]), F.lit(0)).alias("processed_crops"), F.coalesce(F.sum(m["calls"]), F.lit(0)).alias("processed_batches"), F.coalesce(F.sum(number(m["seconds"])), F.lit(0.0)).alias("seconds"), F.coalesce(F.sum(number(F.col("wall_s"))), F.lit(0.0)).alias("wall_s"),
    )
    rate = throughput(F.col("processed_crops"), F.round("seconds", 4))
    return total.select(F.lit(model).alias("model"), "pages", "processed_pages", "skipped_pages", "failed_pages", "processed_crops", "processed_batches", F.round("seconds", 4).alias("seconds"), rate.alias("crops_per_second"), F.round("wall_s", 4).alias("wall_s"))


def run_hotspots(metrics: DataFrame, models: int = 10, components: int = 15) -> DataFrame:
    """The summary of a run as rows: part (model or component), place (from 1), name, seconds, calls, items; slowest first, equal ones by name."""
    order = lambda: Window.partitionBy("part").orderBy(F.desc("seconds"), "name")
    both = model_totals(metrics).select(F.lit("model").alias("part"), F.col("model").alias("name"), "seconds", "calls", "items")
    both = both.unionByName(component_totals(metrics).select(F.lit("component").alias("part"), F.col("component").alias("name"), "seconds"), allowMissingColumns=True)
    ranked = both.withColumn("place", F.row_number().over(order()))
    return ranked.where(((F.col("part") == "model") & (F.col("place") <= models)) | ((F.col("part") == "component") & (F.col("place") <= components))).select("part", "place", "name", "seconds", "calls", "items")
