"""Box geometry against values worked out by hand."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pagelathe.functions import boxes
from pyspark.sql import functions as F


def one(spark, make, box, **other):
    row = spark.createDataFrame([(box, *other.values())], "box array<double>" + "".join(f", {k} array<double>" for k in other))
    return row.select(make.alias("v")).first().v


def test_region_to_page(spark):
    got = one(spark, boxes.region_to_page("box", "inner"), [0.2, 0.4, 0.6, 0.8], inner=[0.25, 0.5, 0.75, 1.0])
    assert [round(x, 9) for x in got] == [0.3, 0.6, 0.5, 0.8]
    # Without extent it gets a millionth, and nothing leaves the page.
    got = one(spark, boxes.region_to_page("box", "inner"), [0.5, 0.5, 0.5, 0.5], inner=[0.1, 0.1, 0.9, 0.9])
    assert got[2] > got[0] and got[3] > got[1]
    assert one(spark, boxes.region_to_page("box", "inner"), [0.0, 0.0, 1.0, 1.0], inner=[-3.0, 0.5, 7.0, 0.6])[:3] == [0.0, 0.5, 1.0]


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(*[st.floats(-2, 2) for _ in range(8)]), min_size=1, max_size=20))
def test_region_to_page_stays_inside(spark, rows):
    df = spark.createDataFrame([(list(r[:4]), list(r[4:])) for r in rows], "a array<double>, b array<double>")
    for (v,) in df.select(boxes.region_to_page("a", "b")).collect():
        assert all(0 <= x <= 1 for x in v)
        assert v[2] > v[0] or v[0] == 1.0


def test_pixels(spark):
    assert one(spark, boxes.crop_pixels("box", 100, 200), [0.105, 0.5, 0.999, 0.5]) == [10, 100, 99, 101]
    assert one(spark, boxes.crop_pixels("box", 100, 200), [1.0, 1.0, 1.0, 1.0]) == [99, 199, 100, 200]
    # Half goes to the even neighbour: 0.5 -> 0, 1.5 -> 2.
    assert one(spark, boxes.overlay_pixels("box", 10, 10), [0.05, 0.15, 0.25, 0.35]) == [0, 2, 2, 4]
    assert one(spark, boxes.letterboxed_pixels("box", (800, 600), (1024, 1024)), [0.1, 0.2, 0.5, 0.8]) == [204, 204, 512, 819]
    assert one(spark, boxes.detected_pixels("box", 100, 100), [10.0, 20.0, 30.0, 400.0]) == [10, 20, 30, 99]
    assert one(spark, boxes.detected_pixels("box", 100, 100), [0.5, 0.5, 0.5, 0.6]) is None


def test_shapes(spark):
    row = spark.createDataFrame([(800, 600)], "h int, w int").select(boxes.letterbox_shape("h", "w", (1024, 1024)).alias("s"), boxes.centred_on_canvas("h", "w", (1024, 1024)).alias("c")).first()
    assert (row.s.height, row.s.width, row.s.pad_bottom, row.s.pad_right) == (1024, 768, 0, 256)
    assert (row.c.height, row.c.width, row.c.top, row.c.left) == (800, 600, 112, 212)


def test_valid_and_coerced(spark):
    df = spark.createDataFrame([(["1", "2", "3", "4.5"],), (["1", "2", "3"],), (["1", "x", "3", "4"],), (None,), (["1", None, "3", "4"],)], "b array<string>")
    got = df.select(boxes.valid_box("b").alias("v"), boxes.coerced_box("b").alias("c")).collect()
    assert [r.v for r in got] == [True, False, False, False, False]
    assert got[0].c == [1.0, 2.0, 3.0, 4.5] and got[1].c is None


def test_overlap(spark):
    assert one(spark, F.round(boxes.overlap("box", "other"), 9), [0.0, 0.0, 2.0, 2.0], other=[1.0, 1.0, 3.0, 3.0]) == round(1 / 7, 9)
    assert one(spark, boxes.overlap("box", "other"), [0.0, 0.0, 0.0, 0.0], other=[0.0, 0.0, 0.0, 0.0]) == 0.0
