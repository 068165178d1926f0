"""Sources, sinks, retrieval paths, model seam, collections and streams."""

import json

import numpy as np
import pytest
from pagelathe.operators import ann, bm25, chunks, collections, evaluate, models, reports, resolve, retrieval
from pagelathe.sources import media, readers, schemas, sinks
from pagelathe.streaming import ingest
from pyspark.sql import functions as F


@pytest.fixture()
def vectors(spark):
    x = np.random.default_rng(0).normal(size=(3000, 8)).astype(np.float32)
    x[10] = x[11]
    return spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "id long, v array<float>").repartition(3).cache(), x.astype(np.float64)


def brute(x, asked, k):
    out = {}
    for q in asked:
        d = np.round(((x - x[q]) ** 2).sum(axis=1), 9)
        d[q] = np.inf
        out[q] = np.lexsort((np.arange(len(x)), d))[:k].tolist()
    return out


def as_lists(df):
    out = {}
    for r in df.orderBy("query_id", "rank").collect():
        out.setdefault(r.query_id, []).append(r.id)
    return out


def test_top_k_by_broadcast_and_by_blocks(spark, vectors, monkeypatch):
    df, x = vectors
    asked = df.where("id % 50 = 0")
    want = brute(x, range(0, 3000, 50), 7)
    assert as_lists(retrieval.top_k(df, asked, "id", "v", 8, 7, skip_self=True)) == want
    monkeypatch.setattr(retrieval, "MOST_QUERY_BYTES", 12 * 64)
    assert as_lists(retrieval.top_k(df, asked, "id", "v", 8, 7, skip_self=True)) == want
    assert retrieval.top_k(df.limit(0), asked, "id", "v", 8).count() == 0
    assert retrieval.top_k(df, df.limit(0), "id", "v", 8).count() == 0


def test_unsound_vectors_take_no_part(spark):
    rows = [(1, [1.0, 0.0]), (2, [0.0, 1.0]), (3, [float("nan"), 0.0]), (4, [1.0]), (5, None), (None, [1.0, 1.0]), (6, [None, 1.0])]
    df = spark.createDataFrame(rows, "id long, v array<double>")
    got = as_lists(retrieval.top_k(df, df, "id", "v", 2, 5, "cosine"))
    assert got == {1: [1, 2], 2: [2, 1]}


def test_stored_index_recall(spark, vectors, tmp_path):
    df, x = vectors
    path = f"file://{tmp_path}/index"
    assert ann.write_index(df, path, "id", "v", 8, 12, expected=3000) == 3000
    asked = df.where("id % 50 = 0")
    want = brute(x, range(0, 3000, 50), 10)
    search = lambda probes, **kw: as_lists(ann.search_index(ann.open_index(spark, path), asked, "id", "v", 8, 10, probes, skip_self=True, **kw))
    got = search(6)
    assert np.mean([len(set(got[q]) & set(want[q])) / 10 for q in want]) >= 0.9
    # All cells and no cut by codes: exact.
    assert search(12, widen=300) == want
    with pytest.raises(ValueError, match="3000 of 3001"):
        ann.write_index(df, path, "id", "v", 8, 12, expected=3001)
    assert ann.write_index(df.limit(0), path, "id", "v", 8) == 0
    assert ann.search_index(ann.open_index(spark, path), asked, "id", "v", 8).count() == 0


def test_bm25_against_brute_force(spark, monkeypatch):
    rng = np.random.default_rng(3)
    words = [f"w{i}" for i in range(60)]
    docs = [(i, " ".join(rng.choice(words, rng.integers(1, 40)))) for i in range(700)]
    asked = [(i, " ".join(rng.choice(words, 5))) for i in range(30)]
    counts = [bm25.Counter(t.split()) for _, t in docs]
    mean = np.mean([sum(c.values()) for c in counts])
    df = {w: sum(w in c for c in counts) for w in words}
    want = {}
    for q, t in asked:
        s = [round(sum(np.log(1 + (700 - df[w] + 0.5) / (df[w] + 0.5)) * c[w] * 2.2 / (c[w] + 1.2 * (0.25 + 0.75 * sum(c.values()) / mean)) for w in set(t.split())), 6) for c in counts]
        want[q] = [i for i in np.lexsort((np.arange(700), -np.array(s))) if s[i] > 0][:7]
    d, a = spark.createDataFrame(docs, "i long, t string").repartition(3), spark.createDataFrame(asked, "q long, s string")
    assert as_lists(bm25.bm25_top_k(d, "i", "t", a, "q", "s", 7)) == want
    # In several passes, and where the queries' terms are too many to restrict documents to.
    monkeypatch.setattr(bm25, "MOST_QUERIES", 7)
    monkeypatch.setattr(bm25, "MOST_TERMS", 0)
    monkeypatch.setattr(bm25, "BLOCK", 50)
    assert as_lists(bm25.bm25_top_k(d, "i", "t", a, "q", "s", 7)) == want


def test_fusion_does_not_depend_on_order(spark):
    a = spark.createDataFrame([(1, 5, 1), (1, 6, 2)], "query_id long, id long, rank int")
    b = spark.createDataFrame([(1, 6, 1), (1, 7, 2)], "query_id long, id long, rank int")
    rows = [(r.id, r["rank"]) for r in retrieval.fuse([a, b]).orderBy("rank").collect()]
    assert rows == [(6, 1), (5, 2), (7, 3)]
    assert rows == [(r.id, r["rank"]) for r in retrieval.fuse([b, a]).orderBy("rank").collect()]


def test_bm25_ignores_nulls_and_empty(spark):
    docs = spark.createDataFrame([(1, "a b"), (2, None), (3, ""), (None, "a")], "i long, t string")
    asked = spark.createDataFrame([(1, "A!"), (2, None), (3, "zz")], "q long, s string")
    assert [(r.query_id, r.id) for r in bm25.bm25_top_k(docs, "i", "t", asked, "q", "s").collect()] == [(1, 1)]
    assert bm25.bm25_top_k(docs.limit(0), "i", "t", asked, "q", "s").count() == 0


def test_evaluation(spark):
    golden = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "query_id long, golden string")
    ranked = spark.createDataFrame([(1, "x", 1), (1, "a", 2), (2, "b", 1)], "query_id long, a string, rank int")
    detail = evaluate.query_hits(golden, evaluate.retrieved_lists(ranked, "a"))
    rows = {r.query_id: r for r in detail.collect()}
    assert (rows[1].hit_at_1, rows[1].rank_at_3, rows[2].rank_at_1, rows[3].hit_at_10) == (False, 2, 1, False)
    summary = {r.k: (r.hits, r.misses, r.recall) for r in evaluate.hit_summary(detail).collect()}
    assert summary == {1: (1, 2, 0.333333), 3: (2, 1, 0.666667), 5: (2, 1, 0.666667), 10: (2, 1, 0.666667)}
    assert evaluate.hit_summary(detail.limit(0)).first().recall is None


def test_chunks(spark):
    pages = spark.createDataFrame([(1, " page ", ["r1", " ", None, "r2"]), (2, None, None), (3, " ", ["x"])], "k long, t string, r array<string>")
    got = [(r.k, r.chunk_no, r.text_kind, r.text) for r in chunks.assemble(pages, "k", "t", "r", "passage: ").orderBy("k", "chunk_no").collect()]
    assert got == [(1, 0, "pdfium_page_text", "passage: page"), (1, 1, "ocr_region", "passage: r1"), (1, 2, "ocr_region", "passage: r2"), (3, 0, "ocr_region", "passage: x")]
    skipped = chunks.skips(pages, "k", F.col("t"), F.col("r"), spark.createDataFrame([(3,)], "k long"))
    assert {(r.image_path, r.reason) for r in skipped.collect()} == {("2", "no_content"), ("3", "already_exists")}
    zipped = pages.select(F.size(chunks.zip_shortest({"a": "r", "b": F.array(F.lit(1), F.lit(2))})).alias("n")).collect()
    assert [r.n for r in zipped] == [2, None, 1]


def test_resolve(spark):
    asked = spark.createDataFrame([(1, "7", "7_3", None), (2, "7", None, 4), (3, None, "odd", None), (4, "9", "9_x", None)], "q long, pdf string, pdf_page string, page int")
    images = spark.createDataFrame([("/b/7_page0003.png",), ("/a/7_page0003.png",), ("/a/7_page5.png",), ("/a/odd.jpg",)], "path string")
    got = {r.q: r.image_path for r in resolve.resolve_queries(asked, images, "q").collect()}
    assert got == {1: "/a/7_page0003.png", 2: "/a/7_page5.png", 3: "/a/odd.jpg", 4: None}
    numbered = resolve.numbered(spark.range(1000).select((F.col("id") * 7919 % 1000).alias("x")).repartition(5), ["x"])
    assert numbered.where("x <> number").count() == 0 and numbered.count() == 1000


def test_sources_and_sinks(spark, tmp_path):
    folder = tmp_path / "in"
    (folder / "sub").mkdir(parents=True)
    for name in ("b.PNG", "a.jpeg", "c.webp", "d.pdf", "sub/e.png"):
        (folder / name).write_bytes(b"x")
    names = lambda df: sorted(r.path.rsplit("/", 1)[-1] for r in df.collect())
    assert names(readers.list_images(spark, str(folder))) == ["a.jpeg", "b.PNG"]
    assert names(readers.list_images(spark, str(folder), recursive=True, wide=True)) == ["a.jpeg", "b.PNG", "c.webp", "e.png"]
    assert names(readers.list_pdfs(spark, str(folder))) == ["d.pdf"]
    assert readers.list_images(spark, str(tmp_path / "none")).count() == 0
    good = {"schema_version": 1, "stage": 2, "detections": [{"label": 1, "bbox_xyxy_norm": [0, 0, 1, 1]}]}
    for name, body in (("g", json.dumps(good)), ("h", "[1]"), ("i", '{"a": ')):
        (folder / f"{name}.page_elements_v3.json").write_text(body)
    rows = {r.path.rsplit("/", 1)[-1][0]: r for r in readers.read_sidecars(spark, str(folder), schemas.PAGE_ELEMENTS, ".page_elements_v3.json").collect()}
    assert rows["g"].json.detections[0].label == 1 and not rows["g"].bad and rows["h"].bad and rows["i"].bad
    (folder / "t.txt").write_bytes(b"  ab\xff \n")
    assert readers.read_texts(spark, str(folder)).first().text == "ab�"
    (folder / "q.csv").write_text('Query,pdf,gt_page,modality\n"a, b",7,3,text\n,,,\n , 8 , 2.5 ,\n')
    got = [tuple(r) for r in readers.read_queries(spark, str(folder / "q.csv")).collect()]
    assert got == [("a, b", "7", 3, "text", "7_3")]
    assert readers.latest_path(["/a/stage6_skipped_1.csv", "/a/stage6_skipped_2.csv", "/a/x.csv"]).endswith("_2.csv")
    skips = spark.createDataFrame([("p", "no_content", "")], "image_path string, reason string, details string")
    assert sinks.write_skips(skips, str(tmp_path / "skips")) and not sinks.write_skips(skips.limit(0), str(tmp_path / "skips2"))
    assert readers.read_skips(spark, str(tmp_path / "skips")).first().reason == "no_content"
    with pytest.raises(FileNotFoundError):
        readers.read_metrics(spark, str(folder))
    (folder / "m.metrics.json").write_text(json.dumps({"pdf_path": "p", "pages": [{"page_index": 0, "models": {"a": {"calls": 2, "seconds": 1.0, "items": 4}}}]}))
    metrics = readers.read_metrics(spark, str(folder)).select(F.explode("pages").alias("p")).select("p.*")
    assert reports.model_totals(metrics).first().per_call == 0.5
    (folder / "side.csv").write_text("i,a\n0,x\n")
    assert readers.read_side_table(spark, str(folder / "side.csv")).columns == ["a"]
    with pytest.raises(ValueError, match="side table"):
        readers.read_side_table(spark, "x.xlsx")
    files = spark.createDataFrame([("a", 2, 10), ("b", 3, 20), ("c", 3, 5)], "path string, s int, length long")
    assert [tuple(r) for r in sinks.removable(files, F.col("s"), 3).collect()] == [(3, 2, 25)]


def test_chunks_of_wrong_length_are_an_error(spark, tmp_path):
    spark.createDataFrame([("/e/7_page3.pt", [1.0, 2.0]), ("/e/7_page4.pt", [1.0])], "path string, vector array<float>").write.parquet(str(tmp_path / "c"))
    assert {r.page_number for r in readers.read_chunks(spark, str(tmp_path / "c")).collect()} == {3, 4}
    with pytest.raises(Exception, match="entries, not 2"):
        readers.read_chunks(spark, str(tmp_path / "c"), dimensions=2).collect()


def test_media_seam(spark):
    def backend(content):
        if content == b"bad":
            raise ValueError("broken")
        yield {"page_number": 0, "width": 1, "height": 2, "text": "t", "image": b"i"}

    files = spark.createDataFrame([("a", bytearray(b"ok")), ("b", bytearray(b"bad"))], "path string, content binary")
    rows = {r.path: r for r in media.render_pages(files, backend).collect()}
    assert rows["a"].text == "t" and rows["b"].error == "ValueError: broken"
    assert {r.path: r.pages for r in media.page_counts(files, lambda content: len(list(backend(content)))).collect()} == {"a": 1, "b": 0}
    def layout(content):
        for page in backend(content):
            yield {"page_number": page["page_number"], "title": "t", "width": 612.0, "fonts": ["Sans"], "images": 2}

    rows = {r.path: r for r in media.page_layouts(files, layout).collect()}
    assert (rows["a"].title, rows["a"].width, rows["a"].fonts, rows["a"].images, rows["a"].links) == ("t", 612.0, ["Sans"], 2, None) and rows["b"].error
    assert media.available() in (True, False)


def test_model_seam(spark):
    calls = []

    def backend(batch):
        calls.append(len(batch))
        if len(batch) > 2:
            raise models.BatchTooLarge("memory")
        if "bad" in batch:
            raise ValueError("no")
        return [[float(len(x))] for x in batch]

    done = models.call_batch(backend, ["a", "bb", "bad", "c", "d"])
    assert [r for r, _ in done] == [[1.0], [2.0], None, [1.0], [1.0]] and done[2][1] == "ValueError: no"
    assert models.call_batch(lambda b: [], ["a"])[0][1].startswith("ValueError")
    assert models.items_of({"x": 1, "output": [1]}) == [1] and models.items_of("x") is None
    assert models.detections_of({"objects": [{"box": [1], "class": 0, "confidence": 0.0}, {"label": 1}]}) == [{"bbox": [1], "label": 0, "score": 0.0}]
    assert models.vectors_of({"data": [{"embedding": [1, 2]}]}) == [[1.0, 2.0]] and models.vectors_of([1, 2]) == [[1.0, 2.0]]
    texts = spark.createDataFrame([(1, "a b"), (2, " "), (3, None), (4, "a b")], "k long, t string")
    good, failed = models.split_failures(models.embed(texts, "k", "t", "test", models.hash_embedder), "k")
    rows = {r.k: r.vector for r in good.collect()}
    assert rows.keys() == {1, 4} and rows[1] == rows[4] and failed.count() == 0


def test_collections(spark, tmp_path):
    store = collections.TableStore(spark, f"file://{tmp_path}", 2)
    ddl = "id long, vector array<float>, text string, metadata string, source string"
    rows = spark.createDataFrame([(1, [1.0, 0.0], "a", "1", "s"), (2, [0.0, 1.0], "b", "2", "t"), (3, [0.5, 0.5], "c", "3", None)], ddl)
    assert store.run("c", rows) == 3
    store.create_index("c", rows.limit(0), recreate=False)
    store.write_to_index("c", spark.createDataFrame([(4, [0.9, 0.1], "d", "4", "s")], ddl))
    assert store.scan("c", with_vector=False).columns == ["id", "text", "metadata", "source"]
    with pytest.raises(ValueError, match="1 rows"):
        store.write_to_index("c", spark.createDataFrame([(5, [1.0], "d", "4", "s")], ddl))
    asked = spark.createDataFrame([(9, [1.0, 0.0])], "id long, vector array<float>")
    near = store.retrieval("c", asked, 2, where="source IS NULL OR source <> 't'").orderBy("rank").collect()
    assert [r.id for r in near] == [1, 4] and "vector" not in near[0]
    words = spark.createDataFrame([(9, 2, 1)], "query_id long, id long, rank int")
    assert store.retrieval("c", asked, 5, keywords=words).where("id = 2").count() == 1
    assert store.run_async("e", rows).result(120) == 3
    store.remove_source("c", "s")
    assert {r.id for r in store.scan("c").collect()} == {2, 3}
    # A source may come back; only what was there before is removed. An append adds its own files only.
    before = {p.name for p in (tmp_path / "c").iterdir()}
    assert store.ingest("c", spark.createDataFrame([(7, [0.1, 0.1], "g", "7", "s")], ddl)) == "stream"
    assert {r.id for r in store.scan("c").collect()} == {2, 3, 7} and len({p.name for p in (tmp_path / "c").iterdir()} - before) == 1
    store.compact("c")
    assert store.wait_for_rows("c", 3) == 3 and store._manifest("c")[1][0]["without"] == []
    ticks = iter(range(0, 1000, 20))
    with pytest.raises(TimeoutError, match="3 of 4 rows"):
        store.wait_for_rows("c", 4, clock=lambda: next(ticks), sleep=lambda _: None)
    with pytest.raises(RuntimeError, match="another write"):
        store._publish("c", store._manifest("c")[0], [])
    store.remove_source("c", "s")
    store.reindex("c", lambda r: r.select("id", F.array(F.lit(7.0).cast("float"), F.lit(0.0).cast("float")).alias("vector")), "d")
    assert store.scan("d").first().vector == [7.0, 0.0]
    store.split_run(rows.withColumn("kind", F.lit("text")), {"only": ["text"], "none": ["image"]}, "kind")
    assert store.scan("only").count() == 3 and store.scan("none").count() == 0
    assert {r.collection_name for r in store.catalog().collect()} == {"c", "d", "e", "only", "none"}
    assert collections.catalog_match(store.catalog(), collection_name="on").count() == 2
    assert collections.catalog_match(store.catalog(), "exact", collection_name="c").count() == 1
    with pytest.raises(ValueError, match="no collection"):
        store.scan("zz")


def test_stream_processes_each_file_once(spark, tmp_path):
    source, target, state = (f"{tmp_path}/{n}" for n in ("in", "out", "state"))
    spark.range(10).write.parquet(source)
    for _ in range(2):
        ingest.ingest(spark, source, "id long", target, state)
    assert spark.read.parquet(target).count() == 10
    spark.range(10, 15).write.mode("append").parquet(source)
    ingest.ingest(spark, source, "id long", target, state, lambda df: df.where("id % 2 = 0"))
    assert spark.read.parquet(target).count() == 13


def test_exact_percentiles_of_large_and_small_groups(spark):
    rng = np.random.default_rng(9)
    big, ties = rng.lognormal(0, 2, 60_000), np.repeat([1.0, 2.0, 7.0], [30_000, 25_000, 20])
    rows = [("big", float(x)) for x in big] + [("ties", float(x)) for x in ties] + [("one", 5.0), (None, 1.0), (None, 2.0), ("one", None), ("none", float("nan"))]
    at = (0.0, 0.001, 0.5, 0.9, 0.999, 1.0)
    got = {r.g: r for r in reports.exact_percentiles(spark.createDataFrame(rows, "g string, v double").repartition(7), ["g"], "v", at).collect()}
    assert got.keys() == {"big", "ties", "one", None}
    for name, values in (("big", big), ("ties", ties), ("one", [5.0]), (None, [1.0, 2.0])):
        assert got[name].n == len(values) and np.allclose(got[name].percentiles, np.quantile(values, at), rtol=1e-12)


def test_bundle_tree_images_and_devices(spark, tmp_path):
    import base64
    import zipfile

    files = spark.createDataFrame([("b", bytearray(b"2")), ("a", bytearray(b"1"))], "name string, content binary")
    assert sinks.write_bundle(files, f"{tmp_path}/x.zip") == 2
    with zipfile.ZipFile(f"{tmp_path}/x.zip") as z:
        assert z.namelist() == ["a", "b", "manifest.txt"] and z.read("manifest.txt") == b"a\nb"
    with pytest.raises(ValueError, match="too many"):
        sinks.write_bundle(files, f"{tmp_path}/y.zip", 1)
    assert sinks.schema_tree(spark.createDataFrame([], "a array<struct<b:int>>, c int"), 2) == ["a: array", "  []: struct", "c: integer"]
    raw = base64.b64decode(media.png_base64(np.ones((3, 2, 5)) * 0.5))
    assert raw[:8] == b"\x89PNG\r\n\x1a\n" and raw[16:24] == (5).to_bytes(4, "big") + (2).to_bytes(4, "big")
    boxed = media.letterboxed(np.zeros((1, 10, 20), np.uint8), (8, 8))
    assert boxed.shape == (1, 8, 8) and (boxed[0, :4] == 0).all() and (boxed[0, 4:] == 114).all()
    assert models.device_list("all", 2) == [0, 1] and models.device_list("1,0,1", 2) == [1, 0]
    with pytest.raises(ValueError):
        models.device_list("2", 2)


def test_pixels_of_pngs_and_drawing():
    import base64
    import struct
    import zlib

    rng = np.random.default_rng(0)
    for channels in (1, 3):
        image = rng.integers(0, 256, (channels, 7, 5)).astype(np.uint8)
        assert (media.png_pixels(base64.b64decode(media.png_base64(image))) == image).all()
    # All filters, with alpha.
    pixels = rng.integers(0, 256, (5, 6, 4)).astype(np.int32)
    rows = []
    for y in range(5):
        up = pixels[y - 1] if y else np.zeros((6, 4), np.int32)
        line = pixels[y]
        left = np.concatenate([np.zeros((1, 4), np.int32), line[:-1]])
        corner = np.concatenate([np.zeros((1, 4), np.int32), up[:-1]])
        p = left + up - corner
        a, b, c = abs(p - left), abs(p - up), abs(p - corner)
        guess = [0, left, up, (left + up) // 2, np.where((a <= b) & (a <= c), left, np.where(b <= c, up, corner))][y]
        rows.append(bytes([y]) + ((line - guess) & 255).astype(np.uint8).tobytes())
    chunk = lambda kind, data: struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data))
    png = b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", struct.pack(">IIBBBBB", 6, 5, 8, 6, 0, 0, 0)) + chunk(b"IDAT", zlib.compress(b"".join(rows))) + chunk(b"IEND", b"")
    assert (media.png_pixels(png) == pixels[..., :3].transpose(2, 0, 1)).all()
    with pytest.raises(ValueError):
        media.png_pixels(b"x")
    drawn = media.drawn_boxes(np.zeros((3, 10, 10), np.uint8), [[2, 3, 7, 8]], [(9, 8, 7)], 1)
    assert drawn[:, 3, 2].tolist() == [9, 8, 7] and drawn[0, 4, 3] == 0 and drawn[0].sum() == 9 * 16
    canvas = media.on_canvas(np.zeros((3, 4, 8), np.uint8), (4, 4))
    assert canvas.shape == (3, 4, 4) and (canvas[:, 1:3] == 0).all() and (canvas[:, 0] == 255).all()


def test_suppression_of_overlaps(spark):
    from pagelathe.operators import detections

    box = [[0.0, 0.0, 1.0, 1.0], [0.0, 0.0, 0.9, 1.0], [0.0, 0.0, 0.9, 1.0], [0.5, 0.5, 0.6, 0.6], [0.0, 0.0, 1.0], [0.2, 0.2, 0.3, 0.3]]
    rows = [(1, box, [0, 0, 1, 0, 0, 0], [0.5, 0.9, 0.4, 0.9, 0.8, 0.001]), (2, None, None, None), (3, [], [], []), (4, box[:1] * 3, [None, None, 2], [0.2, None, float("nan")])]
    df = spark.createDataFrame(rows, "k long, b array<array<double>>, l array<int>, s array<double>").withColumn("place", F.lit("clash"))
    got = {(r.k, r.place, r["rank"]) for r in detections.suppress(df, "k", "b", "l", "s", "page_elements").collect()}
    assert got == {(1, 1, 0), (1, 3, 1), (1, 2, 2), (4, 0, 0)}
    assert detections.suppress(df.limit(0), "k", "b", "l", "s").count() == 0


def test_run_reports_and_clean_up(spark, tmp_path):
    metrics = spark.createDataFrame([({"m": (2, 1.5, 8)}, {"a": 1.0}, [], 3.0), (None, None, ["x"], float("nan")), ({"m": (1, None, 4)}, {"a": float("nan"), "b": 2.0}, None, None), ({}, {}, [], 1.0)], "models map<string,struct<calls:int,seconds:double,items:int>>, timing_s map<string,double>, errors array<string>, wall_s double")
    r = reports.run_report(metrics, "m").first()
    assert (r.pages, r.processed_pages, r.skipped_pages, r.failed_pages, r.processed_crops, r.processed_batches, r.seconds, r.crops_per_second, r.wall_s) == (4, 2, 1, 1, 12, 3, 1.5, 8.0, 4.0)
    assert reports.run_report(metrics.limit(0), "m").first().crops_per_second == 0.0
    lines = sinks.summary_lines(reports.run_hotspots(metrics), 1, 4)
    assert lines[1] == "pdfs=1 pages=4" and "- m: seconds=1.50 calls=3 items=12 per_call_s=0.500 per_item_s=0.125000" in lines and lines[-2:] == ["- b: 2.00s", "- a: 1.00s"]
    for n in range(4):
        (tmp_path / f"f{n}").write_text("x" * n)
    files = spark.createDataFrame([(f"file://{tmp_path}/f{n}", n, n) for n in range(4)], "path string, length long, stage int")
    with pytest.raises(ValueError, match="2 files of 5 bytes"):
        sinks.remove_outputs(files, F.col("stage"), 2)
    assert sinks.remove_outputs(files, F.col("stage"), 2, force=True) == 2 and sorted(p.name for p in tmp_path.iterdir() if p.name.startswith("f")) == ["f0", "f1"]
    assert sinks.remove_outputs(files, F.col("stage"), 2, force=True) == 0
    pages = spark.createDataFrame([("a", 0, b"i", "t", None), ("a", 1, b"j", "u", None), ("b", None, None, None, "bad")], "path string, page_number int, image binary, text string, error string")
    out = f"file://{tmp_path}/pages"
    assert sinks.write_pages(pages.limit(1), out) == 1 and sinks.write_pages(pages, out) == 1 and sinks.write_pages(pages, out) == 0


def test_plain_writers_and_http(spark, tmp_path):
    rows = spark.createDataFrame([(1, "a", [0.5])], "id long, doc string, embedding array<double>")
    sinks.write_json(rows, f"file://{tmp_path}/j")
    sinks.write_embeddings(rows, f"file://{tmp_path}/e")
    assert spark.read.json(f"file://{tmp_path}/j").first().doc == "a" and spark.read.parquet(f"file://{tmp_path}/e").first().doc == "a"
    import threading
    from http.server import BaseHTTPRequestHandler, HTTPServer

    class Handler(BaseHTTPRequestHandler):
        def do_POST(self):
            asked = json.loads(self.rfile.read(int(self.headers["Content-Length"])))["input"]
            body = json.dumps({"data": asked[: len(asked) - (asked[0] == "short")]}).encode()
            self.send_response(200)
            self.end_headers()
            self.wfile.write(body)

        def log_message(self, *_):
            pass

    server = HTTPServer(("127.0.0.1", 0), Handler)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    try:
        call = models.HttpBackend(f"127.0.0.1:{server.server_port}")
        assert call(["a", "b"]) == ["a", "b"]
        with pytest.raises(ValueError, match="1 results for 2"):
            call(["short", "b"])
    finally:
        server.shutdown()


def test_intermediate_tables_go_and_clusters_need_a_shared_folder(spark, monkeypatch):
    from pagelathe import session

    with session.temporary():
        held = session.cut(spark.range(5), "probe")
        path = session._WRITTEN[-1][1]
        assert held.count() == 5
    with pytest.raises(Exception):
        spark.read.parquet(path).count()

    class Cluster:
        class conf:  # noqa: N801
            get = staticmethod(lambda *_: None)

        class sparkContext:  # noqa: N801
            master = "spark://host:7077"

    with pytest.raises(ValueError, match="share"):
        session.shared_dir(Cluster)
    Cluster.sparkContext.master = "local-cluster[2,1,1024]"
    with pytest.raises(ValueError, match="share"):
        session.shared_dir(Cluster)


def test_record_text_drops_very_long_texts(spark):
    from pagelathe.functions import text

    df = spark.createDataFrame([(65_535,), (65_536,)], "n int").selectExpr("n", "repeat('x', n) AS t", "'text' AS kind", "cast(null as string) AS subtype")
    got = {r.n: r.chars for r in df.select("n", F.length(text.record_text("kind", "subtype", {"content": "t", "table_content": "t", "caption": "t", "image_text": "t", "audio_transcript": "t"}, ("text",))).alias("chars")).collect()}
    assert got == {65_535: 65_535, 65_536: None}
