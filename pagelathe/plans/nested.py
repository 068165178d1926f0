"""Queries over nested sidecars (problem 4)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagelathe.operators import chunks, reports
from pagelathe.operators.records import tagged_table, write_tagged
from pagelathe.session import table


def _table(tag: str):
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return tagged_table(write_tagged(table(spark, sf_dir, "region_sidecars"), "sidecar_id", "payload"), tag, "sidecar_id")

    return query


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every detection of every payload."""
    return _table("detection")(spark, sf_dir).select("sidecar_id", "region_no", "det_no").distinct()


def p4_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Regions at each position of a sidecar and the detections whose parent key leads to them."""
    written = write_tagged(table(spark, sf_dir, "region_sidecars"), "sidecar_id", "payload")
    regions, found = (tagged_table(written, tag, "sidecar_id") for tag in ("region", "detection"))
    children = found.groupBy("parent").agg(F.count(F.lit(1)).alias("children"))
    linked = regions.select("pk", "sidecar_id", "region_no").join(children, F.col("pk") == F.col("parent"), "left")
    return linked.groupBy("sidecar_id", "region_no").agg(F.count(F.lit(1)).alias("regions"), F.sum(F.coalesce("children", F.lit(0))).alias("detections"))


def x2_sidecar_regions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """X1, X2, A4 over the sidecars' own regions: how many each sidecar has, and detections nested in them."""
    written = write_tagged(table(spark, sf_dir, "region_sidecars"), "sidecar_id", "payload")
    regions, found = (tagged_table(written, tag, "sidecar_id") for tag in ("region", "detection"))
    nested = regions.join(found.groupBy(F.col("parent").alias("pk")).agg(F.collect_list("det_no").alias("detections")), "pk", "left")
    each = nested.groupBy("sidecar_id").agg(F.collect_list(F.struct("region_no", "detections")).alias("regions"))
    return reports.region_counts(each, F.col("regions")).select("sidecar_id", "regions_n", "detections_n")


def a9_sidecar_eligible(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F7, A9, X3 over the sidecars' own detections: those whose region is a table, chart or infographic and that have a page box, by PDF and stage."""
    side = table(spark, sf_dir, "region_sidecars")
    written = write_tagged(side, "sidecar_id", "payload")
    regions, found = (tagged_table(written, tag, "sidecar_id") for tag in ("region", "detection"))
    whole = found.select("parent", "sidecar_id", F.col("bbox_in_page").alias("box")).join(regions.select(F.col("pk").alias("parent"), "label"), "parent")
    items = whole.join(side.select("sidecar_id", F.coalesce("pdf_path", F.lit("")).alias("doc"), "stage"), "sidecar_id")
    return reports.eligible_by_document(items, "doc", "stage", chunks.eligible(F.col("label"), F.col("box")))


QUERIES = {"x2_sidecar_regions": x2_sidecar_regions, "a9_sidecar_eligible": a9_sidecar_eligible, "p4_found": p4_found, "p4_links": p4_links, "p4_records": _table("record"), "p4_regions": _table("region"), "p4_detections": _table("detection")}

#: Walks a payload level by level: a node is what may hold records, a place the positions down to a leaf.
_WALK = r"""WITH RECURSIVE w AS (
  SELECT sidecar_id AS id, 'node' AS kind, CAST([] AS BIGINT[]) AS rec, CAST(-1 AS BIGINT) AS region, CAST([] AS BIGINT[]) AS place, CAST(payload AS JSON) AS v FROM region_sidecars WHERE json_valid(payload)
  UNION ALL
  SELECT id, k.kind, k.rec, k.region, k.place, k.v FROM (SELECT id, unnest(CASE
    WHEN kind = 'leaf' THEN []
    WHEN json_type(v) = 'VARCHAR' AND json_valid(v->>'$') AND json_type(CAST(v->>'$' AS JSON)) IN ('ARRAY', 'OBJECT', 'VARCHAR') THEN [{'kind': kind, 'rec': rec, 'region': region, 'place': place, 'v': CAST(v->>'$' AS JSON)}]
    WHEN kind = 'node' AND json_type(v) = 'ARRAY' THEN list_transform(range(CAST(json_array_length(v) AS BIGINT)), lambda i: {'kind': 'node', 'rec': list_append(rec, i), 'region': region, 'place': place, 'v': json_extract(v, i)})
    WHEN kind = 'node' AND json_type(v) = 'OBJECT' AND list_contains(json_keys(v), 'regions') THEN [{'kind': 'regions', 'rec': rec, 'region': region, 'place': place, 'v': json_extract(v, '$.regions')}]
    WHEN kind = 'node' AND json_type(v) = 'OBJECT' THEN list_transform(range(CAST(len(json_keys(v)) AS BIGINT)), lambda i: {'kind': 'node', 'rec': list_append(rec, i), 'region': region, 'place': place, 'v': json_extract(v, '$."' || json_keys(v)[i + 1] || '"')})
    WHEN kind = 'regions' AND json_type(v) = 'ARRAY' THEN list_transform(range(CAST(json_array_length(v) AS BIGINT)), lambda i: {'kind': 'region', 'rec': rec, 'region': i, 'place': place, 'v': json_extract(v, i)})
    WHEN kind = 'regions' AND json_type(v) = 'OBJECT' AND list_has_any(json_keys(v), ['region_index', 'page_element', 'detections', 'boxes', 'raw_preds_present']) THEN [{'kind': 'region', 'rec': rec, 'region': CAST(0 AS BIGINT), 'place': place, 'v': v}]
    WHEN kind = 'regions' AND json_type(v) = 'OBJECT' THEN list_transform(range(CAST(len(json_keys(v)) AS BIGINT)), lambda i: {'kind': 'region', 'rec': rec, 'region': i, 'place': place, 'v': json_extract(v, '$."' || json_keys(v)[i + 1] || '"')})
    WHEN kind = 'region' AND json_type(v) = 'OBJECT' AND coalesce(json_type(v, '$.detections'), 'NULL') <> 'NULL' THEN [{'kind': 'det', 'rec': rec, 'region': region, 'place': place, 'v': json_extract(v, '$.detections')}]
    WHEN kind = 'region' AND json_type(v) = 'OBJECT' AND json_type(v, '$.boxes') = 'ARRAY' THEN [{'kind': 'det', 'rec': rec, 'region': region, 'place': place, 'v': json_object('boxes', json_extract(v, '$.boxes'))}]
    WHEN kind = 'det' AND json_type(v) = 'ARRAY' THEN list_transform(range(CAST(json_array_length(v) AS BIGINT)), lambda i: {'kind': 'det', 'rec': rec, 'region': region, 'place': list_append(place, i), 'v': json_extract(v, i)})
    WHEN kind = 'det' AND json_type(v) = 'OBJECT' AND json_type(v, '$.boxes') = 'ARRAY' THEN list_transform(range(CAST(json_array_length(v, '$.boxes') AS BIGINT)), lambda i: {'kind': 'leaf', 'rec': rec, 'region': region, 'place': list_append(place, i), 'v': json_extract(v, '$.boxes[' || i || ']')})
    WHEN kind = 'det' AND (json_type(v) = 'OBJECT' OR len(place) > 0) THEN [{'kind': 'leaf', 'rec': rec, 'region': region, 'place': place, 'v': CASE WHEN json_type(v) = 'OBJECT' THEN v END}]
    ELSE [] END) AS k FROM w)),
leaf AS (SELECT id AS sidecar_id, rec, region AS region_no, row_number() OVER (PARTITION BY id, rec, region ORDER BY place) - 1 AS det_no, v FROM w WHERE kind = 'leaf')
"""
_LISTED = "v IS NOT NULL AND json_type(v) <> 'NULL'"
SQL = {
    "p4_found": _WALK + f"SELECT DISTINCT sidecar_id, CAST(region_no AS INTEGER) AS region_no, CAST(det_no AS INTEGER) AS det_no FROM leaf WHERE {_LISTED}",
    "p4_links": _WALK + f""", r AS (SELECT id AS sidecar_id, region AS region_no, count(*) AS regions FROM w WHERE kind = 'region' AND json_type(v) = 'OBJECT' GROUP BY ALL),
d AS (SELECT sidecar_id, region_no, count(*) AS n FROM leaf WHERE {_LISTED} GROUP BY ALL)
SELECT sidecar_id, CAST(region_no AS INTEGER) AS region_no, regions, coalesce(n, 0) AS detections FROM r LEFT JOIN d USING (sidecar_id, region_no)""",
    "x2_sidecar_regions": _WALK + f""", r AS (SELECT id AS sidecar_id, count(*) AS n FROM w WHERE kind = 'region' AND json_type(v) = 'OBJECT' GROUP BY 1),
d AS (SELECT sidecar_id, count(*) AS n FROM leaf WHERE {_LISTED} GROUP BY 1)
SELECT sidecar_id, CAST(r.n AS INTEGER) AS regions_n, CAST(coalesce(d.n, 0) AS INTEGER) AS detections_n FROM r LEFT JOIN d USING (sidecar_id)""",
    "a9_sidecar_eligible": _WALK + f""", r AS (SELECT id, rec, region, TRY_CAST(CASE WHEN json_type(v, '$.page_element') = 'VARCHAR' THEN json_extract_string(CAST(v->>'$.page_element' AS JSON), '$.label') ELSE json_extract_string(v, '$.page_element.label') END AS INTEGER) AS label
  FROM w WHERE kind = 'region' AND json_type(v) = 'OBJECT'),
b AS (SELECT sidecar_id AS id, rec, region_no AS region, CASE WHEN json_type(v) = 'OBJECT' THEN coalesce(json_extract(v, '$.bbox_xyxy_norm_in_page'), json_extract(v, '$.bbox_xyxy_norm')) END AS box FROM leaf WHERE {_LISTED}),
f AS (SELECT id, rec, region, coalesce(json_type(box) = 'ARRAY' AND json_array_length(box) = 4 AND len(list_filter(CAST(box AS JSON[]), lambda x: TRY_CAST(x->>'$' AS DOUBLE) IS NOT NULL)) = 4, false) AS boxed FROM b),
e AS (SELECT coalesce(pdf_path, '') AS doc, stage, boxed AND coalesce(label IN (0, 1, 3), false) AS ok FROM f JOIN r USING (id, rec, region) JOIN region_sidecars ON sidecar_id = id)
SELECT doc, count(*) AS total, count(*) FILTER (ok) AS eligible, count(*) FILTER (stage = 3) AS total_stage3, count(*) FILTER (stage = 4) AS total_stage4, count(*) FILTER (stage = 3 AND ok) AS eligible_stage3, count(*) FILTER (stage = 4 AND ok) AS eligible_stage4
FROM e GROUP BY 1""",
}
