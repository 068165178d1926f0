"""Text and path functions against values worked out by hand."""

import json

import pytest
from pagelathe.functions import labels, text, vectors
from pagelathe.plans import scalars
from pyspark.sql import functions as F


def values(spark, rows, ddl, make):
    return [r.v for r in spark.createDataFrame(rows, ddl).select(make.alias("v")).collect()]


def test_strip_takes_all_of_unicodes_spaces(spark):
    spaces = "".join(chr(c) for c in range(0x3001) if chr(c).isspace())
    assert values(spark, [(spaces + "a b" + spaces,), (spaces,), (None,)], "c string", text.ustrip("c")) == ["a b", "", None]
    assert values(spark, [(spaces,), (" x",), (None,)], "c string", text.not_blank("c")) == [False, True, False]


def test_page_keys(spark):
    rows = [("/d/12_page0007.PNG",), ("/d/a_page_b_page3.jpg",), ("/d/cover.png",), ("x_page2.tiff",)]
    got = values(spark, rows, "c string", text.page_key("c"))
    assert [(r.doc, r.page) for r in got] == [("12", 7), ("a_page_b", 3), ("cover", None), ("x_page2", None)]
    assert values(spark, [("/d/12_page0.png",), ("/d/a1_page0.png",)], "c string", text.skipped_page_key("c")) == ["12_1", None]
    got = values(spark, [("12_3",), ("a_b_c",), ("a",), (None,)], "c string", text.split_pdf_page("c"))
    assert [(r.pdf, r.page) for r in got] == [("12", 3), ("a", None), ("a", None), (None, None)]
    assert values(spark, [(7,), (12345,)], "c int", text.padded_page("c")) == ["0007", "12345"]
    assert values(spark, [("/x/7_page12.pt",), ("/x/none.pt",)], "c string", text.page_from_path("c")) == [12, None]


def test_ocr_text(spark):
    rows = [('{"text": " a "}',), ('{"text": " ", "ocr_text": "b"}',), ('[{"text": "a"}, {"text": "b"}, ""]',), ('{"raw": {"text": "c"}}',), ("  plain ",), (None,), ("[broken",)]
    assert values(spark, rows, "c string", text.ocr_text("c")) == ["a", "b", "a b", "c", "plain", "", "[broken"]
    assert values(spark, [('{"words": [{"text": "a"}, {"x": 1}, {"text": "b"}]}',), ("s",)], "c string", text.words_text("c")) == ["a b", "s"]


def test_record_text(spark):
    fields = {"content": "a", "table_content": "b", "caption": "c", "image_text": "d", "audio_transcript": "e"}
    rows = [("text", None), ("structured", "chart"), ("structured", "table"), ("image", "page_image"), ("image", "x"), ("audio", None), ("other", None), (None, None)]
    df = spark.createDataFrame([(*r, "A", "B", "C", "D", "E") for r in rows], "k string, s string, a string, b string, c string, d string, e string")
    assert [r.v for r in df.select(text.record_text("k", "s", fields).alias("v")).collect()] == ["A", "B", "B", "D", "C", "E", None, None]
    assert [r.v for r in df.select(text.record_text("k", "s", fields, ("table",)).alias("v")).collect()] == [None, None, "B", None, None, None, None, None]
    assert [r.v for r in df.select(text.record_text("k", "s", fields, most=0).alias("v")).collect()] == [None] * 8


def test_formats(spark):
    assert values(spark, [(3661.9,), (None,), (float("nan"),), (-1.0,), (0.0,)], "c double", text.clock("c")) == ["01:01:01", "unknown", "unknown", "unknown", "00:00:00"]
    assert values(spark, [(5,), (2048,), (5 * 1024**3,), (9 * 1024**5,), (None,)], "c long", text.human_size("c")) == ["5.0 B", "2.0 KB", "5.0 GB", "9216.0 TB", None]
    assert values(spark, [("stage 3",), ("Stage12",), ("4",), ("x",), (None,)], "c string", text.stage_number("c")) == [3, 12, 4, None, None]
    assert text.endpoint_url(" host:1 ") == "http://host:1" and text.endpoint_url("https://h") == "https://h" and text.endpoint_url(" ") is None
    assert text.query_column(["id", "Question", "text"]) == "Question" and text.query_column(["a", "b"]) == "a" and text.query_column([]) is None


def test_labels(spark):
    assert values(spark, [(0,), (5,), (9,), (None,)], "c int", labels.label_name("c")) == ["table", "header_footer", "unknown_9", None]
    rows = [("chart", 0), (" Chart ", 4), ("", 1), (None, 1), (None, None)]
    assert values(spark, rows, "n string, l int", labels.counts_as_graphic("n", "l")) == [True, True, False, True, False]
    assert values(spark, [("x", "1"), ("TABLE", "9"), ("x", "1.0"), (None, None)], "n string, l string", labels.is_ocr_target("n", "l")) == [True, True, False, False]
    assert values(spark, [(None,), (0.4,), (0.5,)], "s double", labels.keeps_score("s", 0.5)) == [True, False, True]


def test_vectors(spark):
    got = spark.createDataFrame([([3.0, 4.0], [0.0, 0.0])], "a array<double>, z array<double>").select(vectors.norm("a"), vectors.dot("a", "a"), vectors.l2("a", "z"), vectors.cosine("a", "z"), vectors.normalised("z"), vectors.normalised("a", True)).first()
    assert got[0] == 5.0 and got[1] == 25.0 and got[2] == 5.0 and got[3] is None and got[4] == [0.0, 0.0] and got[5] == [0.6, 0.8]
    df = spark.createDataFrame([([[1.0, 0.0], [0.0, 5.0], [3.0, 4.0]], [1, 0, 1]), ([[1.0, 1.0]], [0])], "v array<array<double>>, m array<int>")
    rows = [r.p for r in df.select(vectors.mean_pool("v", "m").alias("p")).collect()]
    assert [round(x, 6) for x in rows[0]] == [0.707107, 0.707107] and rows[1] is None
    jsons = [('{"embedding": [1, 2]}',), ('{"embeddings": [[3, 4], [5, 6]]}',), ('{"last_hidden_state": [[[1, 2], [3, 4]]]}',), ("[[7, 8]]",), ("[9, 1]",), ("x",)]
    assert values(spark, jsons, "c string", vectors.embedding_from_json("c")) == [[1.0, 2.0], [3.0, 4.0], [2.0, 3.0], [7.0, 8.0], [9.0, 1.0], None]


@pytest.mark.parametrize("cell,value,items", [("", None, None), ("a", "a", None), ("['a', 'b']", "['a', 'b']", ["a", "b"]), (None, None, None)])
def test_metadata_cell(spark, cell, value, items):
    got = values(spark, [(cell,)], "c string", text.metadata_cell("c"))[0]
    assert got.value == value and (got["items"] or None) == items


def test_preview(spark):
    assert values(spark, [(["a\nb", "c"],), (["x" * 300],)], "t array<string>", text.preview("t")) == ["a b c", "x" * 200 + "…"]
    assert values(spark, [("a", 1), (" ", 2), (None, None)], "n string, l int", text.label_key("n", "l")) == ["a", "label_2", "label_None"]
    assert values(spark, [("/a/7_x.pdf", "3"), ("/a/7.pdf", None)], "s string, m string", text.retrieved_key("s", "m")) == ["7_3", None]
    assert values(spark, [("/a/7_x.pdf",)], "s string", text.retrieved_key("s", F.lit("3"), True)) == ["7_x_3"]


def test_ocr_text_of_whole_documents(spark, tmp_path):
    long = 'He said "no\\yes" — twice.\r\n\tà la {x} [y] \u2028 \u0001 end ' * 2_000
    texts = [long, "short", None, " \n ", "a" * 41, '"', "x" * 70_000]
    rows = [(5 * n + shape, t) for n, t in enumerate(texts) for shape in range(5)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: r.ocr_text for r in scalars.ocr_texts(spark, str(tmp_path)).collect()}
    assert len(got) == len(rows)
    for doc, t in rows:
        key = {0: "text", 1: "ocr_text", 2: "text", 3: "generated_text"}.get(doc % 5)
        t, clean = t or "", (t or "").strip()
        if not clean and key:
            held = {"text": "", key: t} if doc % 5 == 1 else {key: t}
            clean = json.dumps(held, ensure_ascii=False, separators=(",", ":"))
        assert got[doc] == (clean + " b" if doc % 5 == 2 else clean), doc
