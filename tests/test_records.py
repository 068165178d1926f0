"""Tagged emission: shapes, positions, links, and awkward input."""

import json

import duckdb
import pytest
from pagelathe.operators.records import TABLES, _parse_deep, emit_tagged, tagged_table, to_json, write_tagged

DET = {"bbox_xyxy_norm_in_region": [0.1, 0.2, 0.3, 0.4], "label": 1, "score": "0.5"}
COLUMNS = {"boxes": [[0, 0, 1, 1], None, [0, 0, 2, 2]], "labels": ["3", 4], "scores": [0.5, None, "x"]}


def found(spark, payloads, ddl="sidecar_id long, payload string, tag string, owner int"):
    rows = [(i, p if p is None or isinstance(p, str) else json.dumps(p), "clash", 7) for i, p in enumerate(payloads)]
    return emit_tagged(spark.createDataFrame(rows, ddl), "sidecar_id", "payload")


def detections(spark, *payloads):
    rows = found(spark, payloads).where("tag = 'detection'").collect()
    return sorted((r.owner, r.region_no, r.det_no) for r in rows)


def record(regions):
    return {"schema_version": 1, "regions": regions}


def test_shapes_read_alike(spark):
    plain = record([{"detections": [DET, DET]}, {"detections": [DET]}])
    shapes = [
        plain, [plain], {"result": plain}, json.dumps(plain), record(json.dumps(plain["regions"])), record({"0": plain["regions"][0], "1": plain["regions"][1]}),
        record([{"detections": [[DET], DET]}, {"detections": json.dumps([DET])}]), record([{"detections": [[[DET, DET]]]}, {"detections": DET}]),
    ]
    want = [(0, 0), (0, 1), (1, 0)]
    assert detections(spark, *shapes) == [(i, *w) for i in range(len(shapes)) for w in want]


def test_positions_count_nulls(spark):
    got = detections(spark, record([None, {"detections": [None, DET, [None, DET]]}, {"detections": COLUMNS}, {"boxes": [[0, 0, 1, 1]]}]))
    assert got == [(0, 1, 1), (0, 1, 3), (0, 2, 0), (0, 2, 2), (0, 3, 0)]


def test_awkward_payloads_emit_nothing(spark):
    bad = [None, "", "  ", '{"regions": [', "null", "3", '"text"', "[]", "{}x"]
    got = found(spark, [*bad, record(None), record([]), record("x"), record([{"detections": None}])]).collect()
    assert {r.owner for r in got} == {len(bad), len(bad) + 1, len(bad) + 2, len(bad) + 3}
    assert [r.tag for r in got if r.owner == len(bad) + 3] == ["record", "region"]
    assert found(spark, []).count() == 0


def test_tables_link_and_type(spark):
    payload = record([{"region_index": "5", "page_element": json.dumps({"label": "2", "score": 1, "bbox_xyxy_norm": [0, 0, 1, 1]}), "detections": COLUMNS, "more": [1]}])
    df = spark.createDataFrame([(4, json.dumps(payload)), (None, json.dumps(payload))], "sidecar_id long, payload string")
    written = write_tagged(df, "sidecar_id", "payload")
    tables = {t: tagged_table(written, t, "sidecar_id").where("sidecar_id = 4").collect() for t in TABLES}
    region = tables["region"][0]
    assert (region.region_index, region.label, region.score, region.bbox, region.extra) == (5, 2, 1.0, [0.0, 0.0, 1.0, 1.0], '{"more": [1]}')
    assert {d.parent for d in tables["detection"]} == {region.pk} and region.parent == tables["record"][0].pk
    assert sorted((d.det_no, d.label, d.score) for d in tables["detection"]) == [(0, 3, 0.5), (2, None, None)]
    assert tagged_table(written, "detection", "sidecar_id").where("sidecar_id IS NULL").count() == 2


def test_any_depth_of_lists_quotings_and_wrappers(spark):
    many = '{"regions": [{"detections": ' + "[" * 50_000 + json.dumps(DET) + "]" * 50_000 + "}]}"
    broken = '{"regions": [{"detections": ' + "[" * 50_000 + json.dumps(DET) + "]" * 49_999 + "}]}"
    quoted = json.dumps([DET])
    for _ in range(20):
        quoted = json.dumps(quoted) if len(quoted) < 200_000 else quoted
    wrapped = json.dumps(record([{"detections": [DET, DET]}]))
    for _ in range(3_000):
        wrapped = '{"layer": ' + wrapped + "}"
    beyond = {"regions": [{"detections": [DET]}], "more": None}
    beyond = json.dumps(beyond)[:-5] + "[" * 20_000 + "1" + "]" * 20_000 + "}"
    got = detections(spark, many, broken, record([{"detections": quoted}]), wrapped, beyond)
    assert got == [(0, 0, 0), (2, 0, 0), (3, 0, 0), (3, 0, 1), (4, 0, 0)]


def test_wrappers_are_known_by_what_they_hold(spark):
    one, two = record([{"detections": [DET]}]), record([None, {"detections": [DET, DET]}])
    got = detections(spark, {"payload": one}, {"result": one, "data": two, "note": {"model": "x"}}, {"a": {"b": [one, {"c": json.dumps(two)}]}})
    assert got == [(0, 0, 0), *[(i, *p) for i in (1, 2) for p in [(0, 0), (1, 0), (1, 1)]]]
    rows = found(spark, [{"result": one, "data": two}, {"stage": 3}, {"result": {"stage": 4}}]).where("tag = 'record'").collect()
    assert sorted((r.owner, r.record_no, r.payload.stage) for r in rows) == [(0, 0, None), (0, 1, None), (1, 0, 3), (2, 0, 4)]


def test_deep_parser_equals_the_standard_one():
    for text in ('{"a": [1, -2.5e3, true, null, "x\\n\\u00e9"], "b": {}, "c": [[], [{}]], "a": 2}', "[]", " 3 ", '"x"', '[1, [2, [3]]]'):
        assert _parse_deep(text) == json.loads(text)
        assert to_json(json.loads(text)) == json.dumps(json.loads(text), sort_keys=True, ensure_ascii=False)
    for bad in ("[1,]", "{,}", '{"a" 1}', "[1 2]", "[}", '{"a": 1', "]", "1 2", '{"a": }', "[1}", "{1: 2}", ""):
        for read in (json.loads, _parse_deep):
            with pytest.raises(ValueError):
                read(bad)


def test_very_long_and_deep_payloads(spark):
    deep = DET
    for _ in range(60):
        deep = [deep]
    assert detections(spark, record([{"detections": [DET] * 20_000}]), record([{"detections": deep}]))[-1] == (1, 0, 0)
    assert detections(spark, '{"regions": ' + "[" * 100_000 + "]" * 100_000 + "}") == []


def brute(payload):
    """A plain walk of its own, for the shapes in the data."""
    try:
        value = json.loads(payload)
    except (TypeError, ValueError):
        return
    load = lambda v: json.loads(v) if isinstance(v, str) else v
    value = load(value)
    value = value[0] if isinstance(value, list) and value else value
    value = value.get("result", value) if isinstance(value, dict) else {}
    regions = load(value.get("regions")) or []
    for r, region in enumerate(regions.values() if isinstance(regions, dict) else regions):
        dets = load((region or {}).get("detections")) or []
        if isinstance(dets, dict):
            dets = dets["boxes"] if "boxes" in dets else [dets]
            flat = dets
        else:
            flat = [y for x in dets for y in (x if isinstance(x, list) else [x])]
        yield from ((r, d) for d, x in enumerate(flat) if x is not None)


def test_data_equals_plain_walk(spark, sf):
    from pagelathe.plans.nested import p4_found

    rows = duckdb.sql(f"SELECT sidecar_id, payload FROM '{sf}/region_sidecars.parquet'").fetchall()
    want = {(i, *p) for i, payload in rows for p in brute(payload)}
    assert {tuple(r) for r in p4_found(spark, sf).collect()} == want
