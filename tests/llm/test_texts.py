"""Repeated lines, splitting, leaks, repetition and scans: brute force and awkward input."""

import random
import re

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pagelathe.llm import leakage, repeated_lines, repetition, scan_noise, splitting
from pagelathe.llm.codepoints import decode, slices, span_hashes, words

WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon phi chi psi omega".split()


def text_of(rng, n):
    return " ".join(rng.choice(WORDS) + str(rng.randrange(50)) for _ in range(n))


# --- code points

@settings(max_examples=60, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(max_size=60)), max_size=12))
def test_words_equal_the_regular_expression(texts):
    column = pa.array(texts, pa.string())
    codes, starts = decode(column)
    begin, end, hashes, owner = words(codes, starts)
    want = [(i, m.start(), m.end(), m.group()) for i, t in enumerate(texts) for m in re.finditer(r"\w+", t or "")]
    assert [(o, b - starts[o], e - starts[o]) for o, b, e in zip(owner, begin, end)] == [w[:3] for w in want]
    by = {}
    for h, w in zip(hashes, want):
        assert by.setdefault(w[3].lower() if len(w[3].lower()) == len(w[3]) else w[3], h) == h
    assert len(set(by.values())) == len(by) or any(len(k.lower()) != len(k) for k in by)


def test_slices_keep_all_rows():
    batch = pa.RecordBatch.from_arrays([pa.array(range(7)), pa.array(["a" * n for n in (5, 0, 900, 3, 3, 3, 1)])], names=["k", "text"])
    parts = list(slices(batch, "text", 10))
    assert [r for p in parts for r in p.column(0).to_pylist()] == list(range(7)) and len(parts) == 3
    assert list(slices(batch.slice(0, 0), "text")) == []


def test_span_hashes_do_not_depend_on_place():
    codes = np.array([1, 2, 3, 9, 1, 2, 3], np.uint32)
    h = span_hashes(codes, np.array([0, 4, 0]), np.array([3, 7, 4]))
    assert h[0] == h[1] != h[2]


# --- repeated lines

def brute_lines(rows, pages, letters):
    seen, places = {}, {}
    for key, pdf, page, texts in rows:
        if pdf is None or page is None:
            continue
        for n, t in enumerate(texts or []):
            t = t or ""
            for i, line in enumerate(t.split("\n")):
                if i == 0 and line.startswith("passage: "):
                    line = line[9:]
                s = "".join(c for c in line.lower() if c.isalpha())
                if len(s) >= letters:
                    seen.setdefault((pdf, s), set()).add(page)
                    places.setdefault((pdf, s), set()).add((key, n, i))
    return {p for k, v in places.items() if len(seen[k]) >= pages for p in v}


def pages_with_boilerplate(seed=0):
    rng = random.Random(seed)
    lines = ["All rights stay with the Owner of this Page", "share this 12 with your friends and families!", "twentyletterslineabc", "nineteenletterslinea"]
    rows = []
    for key in range(150):
        pdf = "hot" if key % 3 == 0 else f"p{key % 9}"
        body = [text_of(rng, 8) for _ in range(4)]
        for line in lines:
            if rng.random() < 0.6:
                styled = rng.choice([line, line.upper(), f"- {line} | {rng.randrange(99)}", "passage: " + line if not body else line + "\r"])
                body.insert(rng.randrange(len(body) + 1), styled)
        rows.append((key, pdf, rng.randrange(14), [rng.choice(["", "passage: "]) + "\n".join(body), None, "", "\n".join(body[:2])]))
    return rows + [(900, None, 1, ["x" * 30]), (901, "hot", None, [lines[0]]), (902, "hot", 3, None), (903, "hot", 3, []), (904, "hot", 5, [(lines[0] + "\n") * 3000 + "y" * 100_000])]


DDL = "rec_id long, pdf_path string, page_index int, texts array<string>"


def test_repeated_lines_against_brute_force(spark):
    rows = pages_with_boilerplate()
    df = spark.createDataFrame(rows, DDL).withColumn("text", pytest.importorskip("pyspark.sql.functions").lit("clash"))
    got = {tuple(r) for r in repeated_lines.repeated_lines(df, "rec_id", "pdf_path", "page_index", "texts").collect()}
    assert got == brute_lines(rows, 6, 20) and len(got) > 100
    cleaned = {(r.rec_id, r.text_no): r for r in repeated_lines.remove_lines(df, repeated_lines.repeated_lines(df, "rec_id", "pdf_path", "page_index", "texts"), "rec_id", "texts").collect()}
    for key, _, _, texts in rows:
        for n, t in enumerate(texts or []):
            want = None if t is None else "\n".join(x for i, x in enumerate(t.split("\n")) if (key, n, i) not in got)
            assert cleaned[(key, n)].text == want
    assert repeated_lines.repeated_lines(df.limit(0), "rec_id", "pdf_path", "page_index", "texts").count() == 0


def test_chunks_decide_lines(spark):
    """Blocks of repeated lines are decided by their chunks alone; exact counts settle single lines at ragged ends."""
    rng = random.Random(2)
    block = [f"{text_of(rng, 9)} of the company and its owners" for _ in range(5)]
    # Each line occurs on every page, but the second's second half on pages of its own.
    rows = [(k, "p", k, ["\n".join([text_of(rng, 12), *block, text_of(rng, 12)]), block[0] + " " + text_of(rng, 6)]) for k in range(12)]
    df = spark.createDataFrame(rows, DDL)
    got = repeated_lines.judged_lines(df, "rec_id", "pdf_path", "page_index", "texts").collect()
    want = brute_lines(rows, 6, 20)
    assert {(r.rec_id, r.text_no, r.line_no) for r in got} == want == {(k, 0, i) for k in range(12) for i in range(1, 6)}
    by_chunks = {r.line_no for r in got if not r.settled}
    assert by_chunks >= {2, 3, 4}
    assert repeated_lines.judged_lines(df, "rec_id", "pdf_path", "page_index", "texts", pages=13).count() == 0


def test_inner_chunks_do_not_depend_on_neighbours():
    rng = random.Random(8)
    for _ in range(30):
        line = text_of(rng, rng.randrange(4, 14))
        alike = []
        for before, after in ((text_of(rng, 5) + "\n", "\n" + text_of(rng, 5)), ("", ""), ("x\n", ""), ("", " \nyes")):
            batch = pa.RecordBatch.from_arrays([pa.array([1]), pa.array([2]), pa.array([before + line + after]), pa.array([3]), pa.array([0], pa.int32())], names=["source", "page", "text", "key", "text_no"])
            out = pa.Table.from_batches(repeated_lines._lines(1)([batch])).to_pylist()
            alike.append(next((tuple(r["inner"]), r["line"]) for r in out if r["line_no"] == before.count("\n")))
        assert len(set(alike)) == 1


def test_reflowed_passages_are_found_without_lines(spark):
    rng = random.Random(1)
    notice = "this notice was printed on every single page of the whole report by order of the board of directors and may not be removed from copies. "
    notice += "questions about it go to the office of the secretary, who keeps a register of them and answers within a reasonable time. no other office may answer."
    rows = []
    for key in range(12):
        cut = rng.randrange(20, 60)
        broken = notice[:cut] + "\n" + notice[cut:]
        rows.append((key, "p", key, [text_of(rng, 30) + "\n" + broken + "\n" + text_of(rng, 30)]))
    spans = repeated_lines.repeated_spans(spark.createDataFrame(rows, DDL), "rec_id", "pdf_path", "page_index", "texts").collect()
    assert {r.rec_id for r in spans} == set(range(12))
    for r in spans:
        held = rows[r.rec_id][3][0][r.char_begin : r.char_end].replace("\n", "")
        assert held in notice and len(held) >= 16


def brute_spans(rows, pages, fewest):
    seen, out = {}, set()
    texts = [(key, pdf, page, n, t) for key, pdf, page, ts in rows if pdf is not None and page is not None for n, t in enumerate(ts or []) if t]
    letters = lambda t: [i for i, c in enumerate(t) if c.isalpha() and not (i < 9 and t.startswith("passage: "))]
    windows = lambda t: [("".join(t[i] for i in at).lower(), at) for k in [letters(t)] for at in (k[i : i + fewest] for i in range(len(k) - fewest + 1))]
    for _, pdf, page, _, t in texts:
        for w, _ in windows(t):
            seen.setdefault((pdf, w), set()).add(page)
    for key, pdf, _, n, t in texts:
        held = {i for w, at in windows(t) if len(seen[pdf, w]) >= pages for i in at}
        cased = lambda i: t[i].lower() != t[i].upper()
        run = []
        for i in [*letters(t), None]:
            if i in held:
                run.append(i)
                continue
            while run and cased(run[0]) and run[0] and t[run[0] - 1].isalpha():
                run.pop(0)
            while run and cased(run[-1]) and t[run[-1] + 1 : run[-1] + 2].isalpha():
                run.pop()
            if len(run) >= fewest:
                out.add((key, n, run[0], run[-1] + 1))
            run = []
    return out


@pytest.mark.parametrize("part", [2_000, 10_000_000])
def test_repeated_spans_against_brute_force(spark, part):
    rows = [r for r in pages_with_boilerplate() if r[0] != 904]
    rows += [(1000 + k, "short", k, [f"{WORDS[k]} {k} sixteen letters!! {WORDS[-k]}", f"{k}这一行字在每一页上都出现而且没有空格也不会断开{k}", "passage: a line of the marker's text"]) for k in range(7)]
    df = spark.createDataFrame(rows, DDL)
    got = {tuple(r) for r in repeated_lines.repeated_spans(df, "rec_id", "pdf_path", "page_index", "texts", part=part).collect()}
    assert got == brute_spans(rows, 6, 16) and len(got) > 300
    # Every repeated line lies in spans, letter for letter.
    lines = {(r.rec_id, r.text_no, r.line_no) for r in repeated_lines.repeated_lines(df, "rec_id", "pdf_path", "page_index", "texts").collect()}
    texts = {(r[0], n): t for r in rows for n, t in enumerate(r[3] or [])}
    for key, n, i in lines:
        t = texts[key, n]
        begin = sum(len(x) + 1 for x in t.split("\n")[:i])
        at = [begin + j for j, c in enumerate(t.split("\n")[i]) if c.isalpha() and not (begin + j < 9 and t.startswith("passage: "))]
        assert any(k == key and m == n and b <= at[0] and at[-1] < e for k, m, b, e in got)
    assert repeated_lines.repeated_spans(df.limit(0), "rec_id", "pdf_path", "page_index", "texts").count() == 0


# --- splitting

@settings(max_examples=80, deadline=None)
@given(st.text(alphabet="ab .!?。\n\t日é", max_size=400), st.integers(8, 60))
def test_pieces_join_to_the_text(text, limit):
    overlap = limit // 4
    spans = splitting.split_spans(text, limit, overlap)
    assert "".join(text[b if i == 0 else b + overlap : e] for i, (b, e, _) in enumerate(spans)) == text
    assert all(e - b <= limit for b, e, _ in spans)
    assert all(b2 == e1 - overlap for (_, e1, _), (b2, _, _) in zip(spans, spans[1:]))


def test_cuts_prefer_strong_boundaries():
    text = "a" * 30 + "\n\n\n" + "b. " * 10 + "\n\n" + "c" * 50
    assert splitting.split_spans(text, 40, 5)[0] == (0, 33, "section")
    assert splitting.split_spans("word " * 30, 40, 5)[0][2] == "word"
    assert splitting.split_spans("x" * 100, 40, 5)[0] == (0, 40, "character")
    assert splitting.longest_unbreakable("aa bbb.cccc") == 4 and splitting.longest_unbreakable("") == 0


def test_only_units_too_large_are_split():
    """Sections that a piece can hold stay whole; one that none can hold is split by paragraphs, those by sentences, and so on."""
    sentence = "A short sentence here. "
    first, second = sentence * 38 + "end of it.\n\n\n\n", sentence * 64 + "end of it."
    assert [(b, e) for b, e, _ in splitting.split_spans(first + second, 2000, 200)] == [(0, len(first)), (len(first) - 200, len(first + second))]
    large = "\n\n".join(sentence * 30 for _ in range(5)) + "\n\n\n\n"
    spans = splitting.split_spans(first + large + second, 2000, 200)
    assert (len(first + large) in {e for _, e, _ in spans}) and {k for _, _, k in spans} == {"paragraph", "section", "end"}


def walk_units(text, limit):
    """Units by the hierarchy written plainly: what a piece of its own can hold is one unit, else it is split one level down."""
    patterns = [re.compile(p) for _, p in splitting.SEPARATORS]

    def units(a, b, level):
        if b - a <= limit or level == len(patterns):
            return [(a, b)]
        ends = [m.end() for m in patterns[level].finditer(text) if a < m.end() < b]
        return [u for x, y in zip([a, *ends], [*ends, b]) for u in units(x, y, level + 1)]

    return units(0, len(text), 0)


@settings(max_examples=120, deadline=None)
@given(st.text(alphabet="ab .!\n", max_size=500), st.integers(12, 60))
def test_units_that_fit_are_never_cut(text, limit):
    overlap = limit // 4
    spans = splitting.split_spans(text, limit, overlap)
    cuts = {e for _, e, _ in spans[:-1]}
    for a, b in walk_units(text, limit - overlap):
        if b - a <= limit - overlap:
            assert not any(a < c < b for c in cuts), (a, b, spans)


def test_split_awkward_input(spark):
    rows = [(1, ["x" * 2001, None, "", "short", "w " * 1500]), (2, None), (3, []), (None, ["y" * 5000]), (1, ["x" * 2001])]
    df = spark.createDataFrame(rows, "rec_id long, texts array<string>").selectExpr("*", "'clash' AS piece")
    got = splitting.split_texts(df, "rec_id", "texts").collect()
    assert {(r.rec_id, r.text_no, r.forced) for r in got} == {(1, 0, 1), (1, 4, 0), (None, 0, 1)}
    assert sum(r.rec_id == 1 and r.text_no == 0 for r in got) == 4
    assert splitting.split_texts(df.limit(0), "rec_id", "texts").count() == 0
    with pytest.raises(ValueError):
        splitting.split_texts(df, "rec_id", "texts", 100, 60)


def test_very_long_text_is_split_whole(spark):
    text = ("Sentence with some words. " * 40 + "\n\n") * 400
    got = splitting.split_texts(spark.createDataFrame([(1, [text])], "k long, texts array<string>"), "k", "texts").orderBy("piece_no").collect()
    assert "".join(r.piece[200 if r.piece_no else 0 :] for r in got) == text and {r.boundary for r in got} <= {"paragraph", "sentence", "end", "section"}


# --- leaks

def brute_leaks(docs, items, window=12):
    clean = lambda t: re.findall(r"\w+", (t or "").lower())
    out = set()
    for d, text in docs:
        w = clean(text)
        for i, item in items:
            p = clean(item)
            n = min(window, len(p))
            grams = {tuple(p[k : k + n]) for k in range(len(p) - n + 1)} if n else set()
            if any(tuple(w[k : k + n]) in grams for k in range(len(w) - n + 1)):
                out.add((d, i))
    return out


def test_leaks_against_brute_force(spark):
    rng = random.Random(3)
    items = [(i, text_of(rng, rng.choice([3, 9, 12, 13, 40, 90]))) for i in range(40)]
    items += [(50, None), (51, ""), (52, "?!"), (53, "one"), (54, items[4][1])]
    docs = []
    for d in range(300):
        parts = [text_of(rng, rng.randrange(0, 300))]
        if d % 4 == 0:
            w = rng.choice(items[:40])[1].split()
            at, n = rng.randrange(len(w)), rng.choice([11, 12, 20, 90])
            parts.append(rng.choice([" ", "  --  ", ",\n"]).join(x.upper() if rng.random() < 0.3 else x for x in w[at : at + n]))
        docs.append((d, " ".join(parts + [text_of(rng, 30)])))
    docs += [(900, None), (901, ""), (902, text_of(rng, 60_000) + " " + items[5][1]), (903, "one"), (903, "one")]
    d, i = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "1 AS item_id"), spark.createDataFrame(items, "item_id long, text string")
    want = brute_leaks(docs, items)
    got = leakage.find_leaks(d, "doc_id", "text", i).collect()
    assert {tuple(r) for r in got} == want and len(got) == len(want) > 20
    assert {tuple(r) for r in leakage.find_leaks(d, "doc_id", "text", i, most_words=60).collect()} == want
    assert leakage.find_leaks(d.limit(0), "doc_id", "text", i).count() == 0
    assert leakage.find_leaks(d, "doc_id", "text", i.limit(0)).count() == 0


def test_shift_table_skips():
    sets = leakage.pattern_sets([1], [" ".join(WORDS[:12])])
    assert sets[0].length == 12 and sets[0].shift.max() == 11 and (sets[0].shift == 0).sum() == 1


def test_large_item_sets_still_skip():
    """Two million words of items: a step moves by more than five words on average."""
    rng = np.random.default_rng(1)
    hashes = rng.integers(0, 1 << 63, 2_000_000).astype(np.uint64)
    begin = np.arange(len(hashes) - 11)
    patterns = leakage.PatternSet(12, hashes, begin, begin // 200)
    text = np.concatenate([rng.integers(0, 1 << 63, 50_000).astype(np.uint64), hashes[1000:1012], rng.integers(0, 1 << 63, 50_000).astype(np.uint64)])
    steps = [0, 0]
    owner, item = patterns.search(text, np.array([0]), np.array([len(text)]), np.array([7]), steps)
    assert owner.tolist() == [7] and item.tolist() == [5] and steps[1] / steps[0] > 5


def test_common_suffixes_share_a_bucket():
    """Many items that end in the same words: the bucket is compared from the first word on, in runs."""
    tail = " ".join(WORDS[:8])
    items = [f"w{i} x{i} y{i} z{i} {tail}" for i in range(3000)]
    sets = leakage.pattern_sets(list(range(3000)), items)
    codes, starts = decode(pa.array([" ".join(items[5:7] * 200)]))
    _, _, hashes, owner = words(codes, starts)
    got = sets[0].search(hashes, np.array([0]), np.array([len(hashes)]), np.array([0]))
    assert set(got[1].tolist()) == {5, 6} and len(got[1]) == 400


# --- repetition

def brute_share(text):
    w = re.findall(r"\w+", (text or "").lower())
    seen, hit = set(), [False] * len(w)
    for i in range(len(w) - 7):
        g = tuple(w[i : i + 8])
        if g in seen:
            hit[i : i + 8] = [True] * 8
        seen.add(g)
    return sum(hit) / len(w) if w else 0.0


def repeating_documents(n=400, seed=6):
    rng = random.Random(seed)
    out = []
    for d in range(n):
        lines = [text_of(rng, rng.randrange(3, 25)) + "." for _ in range(rng.randrange(3, 14))]
        if d % 5 == 0:
            lines[1:1] = [text_of(rng, 12)] * rng.randrange(8, 30)
        elif d % 5 == 1:
            lines += [" ".join([text_of(rng, 9)] * rng.randrange(8, 30))]
        elif d % 5 == 2:
            lines += [lines[0]]
        out.append((d, rng.choice(["\n", " "]).join(lines)))
    return out


def test_shares_are_exact_and_the_field_misses_none(spark):
    docs = repeating_documents() + [(900, None), (901, ""), (902, "..."), (903, "a " * 30_000), (903, "a b c"), (None, "x " * 40)]
    df = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "'clash' AS words").repartition(4)
    rows = repetition.repetition(df, "doc_id", "text").collect()
    assert len(rows) == len(docs)
    want = sorted(round(brute_share(t), 9) for _, t in docs)
    assert sorted(round(r.repeated_share, 9) for r in rows) == want
    by = {r.doc_id: r for r in rows}
    assert (by[900].words, by[900].content_share, by[900].retained, by[902].repeated_share) == (0, 1.0, True, 0.0)
    bad = {d for d, t in docs if brute_share(t) >= 0.3}
    assert len(bad) > 50 and all(not r.retained for r in rows if r.repeated_share >= 0.3)
    assert repetition.repetition(df.limit(0), "doc_id", "text").count() == 0


def test_field_learns_from_few_repeating_documents(spark):
    rng = random.Random(9)
    docs = [(i, text_of(rng, 60)) for i in range(400)] + [(1000 + i, "\n".join([text_of(rng, 20)] * 8)) for i in range(2)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    got = repetition.repetition(df, "doc_id", "text", sample=10).where("repeated_share >= 0.3 AND NOT retained").collect()
    assert {r.doc_id for r in got} == {1000, 1001}


def test_the_field_alone_decides(spark):
    docs = [(d, t) for d, t in repeating_documents() if not 0.15 < brute_share(t) < 0.45]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    want = {d for d, t in docs if brute_share(t) >= 0.3}
    found = lambda **kw: {r.doc_id for r in repetition.repetition(df, "doc_id", "text", **kw).where("NOT retained").collect()}
    assert found() == want and len(want) > 50
    # Without its weights the field finds nothing, whatever the exact shares are.
    assert found(field=repetition.LineField()) == set()


def test_field_on_held_out_documents():
    u = repetition.units_of(*decode(pa.array([t for _, t in repeating_documents(300, 7)])))
    labels = (2 * u.repeated >= u.words).astype(np.int64)
    field = repetition.LineField().fit(u.owner, u.features, labels)
    v = repetition.units_of(*decode(pa.array([t for _, t in repeating_documents(300, 8)])))
    truth = 2 * v.repeated >= v.words
    states = field.decode(v.owner, v.features)
    assert (states == truth).mean() > 0.97 and states[truth].mean() > 0.97


def test_viterbi_equals_enumeration():
    rng = np.random.default_rng(0)
    field = repetition.LineField(rng.normal(size=(6, 2)), rng.normal(size=(2, 2)), rng.normal(size=2))
    owner, x = np.array([0, 0, 0, 0, 1, 2, 2]), rng.normal(size=(7, 6))
    got = field.decode(owner, x)
    for o in range(3):
        rows = np.flatnonzero(owner == o)
        emit = x[rows] @ field.weights
        score = lambda path: field.begin[path[0]] + sum(emit[i, s] for i, s in enumerate(path)) + sum(field.steps[a, b] for a, b in zip(path, path[1:]))
        best = max(np.ndindex(*[2] * len(rows)), key=score)
        assert got[rows].tolist() == list(best)


# --- scans

LEXICON = ["the", "printer", "group", "journal", "capital", "capitalist", "across", "image", "stone", "dock", "small", "warm", "summary", "number", "field", "and", "under", "a"]


def scan(spark, pages):
    df = spark.createDataFrame(pages, "page_id long, pdf_path string, page_number int, text string").selectExpr("*", "1 AS line_no")
    lex = spark.createDataFrame([(w, "en") for w in LEXICON] + [(None, None), ("the", "de")], "word string, lang string")
    return df, lex


def reader(words, edits, **kw):
    return scan_noise.Reader(scan_noise.Lexicon(set(words)), {e: 2.0 for e in edits}, **kw)


def test_repairs_by_learned_edits():
    edits = [("0", "o"), ("ii", "u"), ("@", "a"), ("rn", "m"), ("1", "l"), ("ﬁ", "fi"), ("c", "e"), ("6", "b"), ("5", "s"), ("d", "cl")]
    r = reader([*LEXICON, "boards", "article", "cycle"], edits)
    fixed = lambda w: [x[0] for x in r.repairs(w)]
    assert fixed("gr0up") == ["group"] and fixed("joiirnal") == ["journal"] and fixed("c@pital") == ["capital"] and fixed("warrn") == ["warm"]
    assert fixed("zzz") == [] and fixed("sma1l") == ["small"] and fixed("ﬁeld") == ["field"] and fixed("num6cr") == ["number"]
    # Any number of wrong glyphs.
    assert fixed("60@rd5") == ["boards"] and fixed("artide") == ["article"] and fixed("cyde") == ["cycle"]
    assert reader(LEXICON, []).repairs("gr0up") == []


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(alphabet="abcé0", min_size=1, max_size=6), max_size=8), st.lists(st.text(alphabet="abcé", min_size=1, max_size=6), min_size=1, max_size=8))
def test_links_against_brute_force(words, known):
    words = sorted(set(words))
    want = set()
    for w in words:
        for v in set(known):
            for m, t in ((1, 1), (2, 1), (1, 2)):
                for i in range(len(w) - m + 1):
                    x, y = w[i : i + m], v[i : i + t]
                    if len(y) == t and w[:i] == v[:i] and w[i + m :] == v[i + t :] and x != y and (m == t or (x[0] != y[0] and x[-1] != y[-1])):
                        want.add((w, v, x, y))
    assert set(scan_noise.glyph_links(words, scan_noise.Lexicon(set(known)))) == want


def test_contexts_choose_between_repairs():
    lexicon = scan_noise.Lexicon({"hall", "hill", "ball"})
    basis = np.eye(2 * scan_noise.BUCKETS, 2, dtype=np.float32)
    vectors = {lexicon.number("hall"): np.array([2, -2], np.float32), lexicon.number("hill"): np.array([-2, 2], np.float32)}
    r = scan_noise.Reader(lexicon, {("1", "a"): 1.0, ("1", "i"): 1.0}, vectors, basis, 1.0)
    assert r.correct("h1ll", [0]) == "hall" and r.correct("h1ll", [1]) == "hill" and r.correct("h1ll", []) in ("hall", "hill")
    # A word of its own: no repair fits the words around it.
    assert scan_noise.Reader(lexicon, {("1", "a"): 1.0}, vectors, basis, 1.0).correct("h1ll", [1]) is None


def test_vectors_decide_which_words_are_misread(spark):
    """The name bill is one learned edit from hill: only among the words that hill stands with is it a misreading."""
    rng = random.Random(4)
    near = ["near the {} of green stone", "under the {} of green grass", "near a {} of old stone"]
    said = ["mister {} said yesterday that", "mister {} spoke yesterday that", "young {} said they that"]
    pages, listed = [], set()
    for n in range(240):
        lines = [rng.choice(near).format("hill") for _ in range(3)] + [rng.choice(said).format(rng.choice(["tom", "ann"])) for _ in range(3)]
        rng.shuffle(lines)
        lines.insert(3, rng.choice(said if n % 2 else near).format("bill"))
        if n % 2 == 0:
            listed.add((n, 3, "misread"))
        if n % 12 == 0:
            lines[5] = "near tbe hill of wbite stone"
            listed.add((n, 5, "misread"))
        pages.append((n, f"p{n}", 0, "\n".join(lines)))
    words = sorted({w for t in near + said for w in t.split() if w != "{}"} | {"hill", "tom", "ann", "white"})
    df = spark.createDataFrame(pages, "page_id long, pdf_path string, page_number int, text string")
    lex = spark.createDataFrame([(w,) for w in words], "word string")
    assert {tuple(r) for r in scan_noise.scan_defects(df, lex).where("defect = 'misread'").collect()} == listed
    assert {tuple(r)[:2] for r in scan_noise.scan_defects(df, lex, use_vectors=False).where("defect = 'misread'").collect()} == {x[:2] for x in listed} | {(n, 3) for n in range(240)}


def test_confusions_of_another_scanner_are_learned(spark):
    """Confusions that no table lists: q for g, and 3 for s."""
    words = ["garden", "bridge", "gallery", "glass", "stone", "house", "sister", "rising"]
    wrong = lambda w, a, b: w.replace(a, b, 1)
    pages = [(n, f"p{n}", 0, " ".join(rng.choice(words) for _ in range(9)) + "\nthe " + (wrong(words[n % 8], "g", "q") if n % 3 else wrong(words[n % 8], "s", "3"))) for n, rng in ((n, random.Random(n)) for n in range(96))]
    df = spark.createDataFrame(pages, "page_id long, pdf_path string, page_number int, text string")
    lex = spark.createDataFrame([(w,) for w in [*words, "the"]], "word string")
    want = {n for n, _, _, t in pages if t.split("\n")[1].split()[1] not in words}
    got = scan_noise.scan_defects(df, lex).where("defect = 'misread' AND line_no = 1").collect()
    assert {r.page_id for r in got} == want and len(want) > 40


def test_deep_headers_are_furniture(spark):
    heads = "Survey of the Northern Rivers\nSection on Dams\nThird Edition"
    pages = [(n, "p", n, f"{heads}\n{text_of(random.Random(n), 6)}\n{text_of(random.Random(n + 50), 6)}\nthe stone\n") for n in range(6)]
    found = scan_noise.scan_defects(*scan(spark, pages)).where("defect = 'furniture'").collect()
    assert {(r.page_id, r.line_no) for r in found} == {(n, i) for n in range(6) for i in (0, 1, 2, 5)}


def test_page_numbers():
    assert scan_noise.page_number("- 53 -") == (53, True) and scan_noise.page_number(" 12 ") == (12, False) and scan_noise.page_number("Page 3 / 12") == (3, True)
    assert scan_noise.page_number("xiv") == (14, True) and scan_noise.page_number("12 34") is None and scan_noise.page_number("") is None


def test_scan_defects(spark):
    names = ["Quenlunrek", "Vastodermin", "Ilbrazoph", "Murtekinga", "Ossefalwyd", "Czernhubix"]
    pages = []
    for n, name in enumerate(names):
        title = f"Tidal Pattern Summary {n + 7}" if n % 3 else f"Tidal Patt1rn Summary {n + 7}"
        body = [f"{'tal' if n else 'the'} printer {name} the", "gr0up under a small", "stone-", f"dock {name[::-1]} and {name} capi-"]
        pages.append((n, "p", n, "\n".join([title, "", *body, f"Page {n + 7}"])))
    pages += [(100, None, 0, "the gr0up\n[5]"), (101, "p", None, "warrn"), (102, "q", 0, None), (103, "q", 1, ""), (104, "q", 2, "  \n\n"), (105, "p", 2, pages[2][3])]
    df, lex = scan(spark, pages)
    got = {tuple(r) for r in scan_noise.scan_defects(df, lex).collect()}
    for i, n in [(k, k) for k in range(6)] + [(105, 2)]:
        mine = {g[1:] for g in got if g[0] == i}
        want = {(0, "furniture"), (6, "furniture"), (3, "misread")} | ({(5, "hyphen")} if n < 5 else set())
        assert mine == want, (i, mine)
    assert {g[1:] for g in got if g[0] == 100} == {(0, "misread"), (1, "furniture")} and {g[1:] for g in got if g[0] == 101} == {(0, "misread")}
    assert not {g for g in got if g[0] in (102, 103, 104)}
    assert scan_noise.scan_defects(df.limit(0), lex).count() == 0


def test_all_running_headers_of_a_pdf_are_found(spark):
    heads = [f"Annual Report {x} Division" for x in ("Procurement", "Human Resources", "Sales and Marketing", "Legal", "Infrastructure of the North")] + ["Atlas", "Ix"]
    rng = random.Random(3)
    pages = [(n, "p", n, f"{heads[n % 7]}\n{text_of(rng, 6)}\n{text_of(rng, 6)}") for n in range(21)]
    # Damaged in the midst, of a header that is not among the block's first two.
    pages += [(50, "p", 50, "Annual Report Infrastructvre of the North Division\nthe stone\nthe warm field"), (51, "q", 1, "Atlas\nthe stone and\na warm field")]
    pages += [(60 + n, "p", 60 + n, f"pond.\n{text_of(rng, 6)}\n{text_of(rng, 6)}") for n in range(2)]
    found = scan_noise.scan_defects(*scan(spark, pages)).where("defect = 'furniture'").select("page_id", "line_no").collect()
    assert {tuple(r) for r in found} == {(n, 0) for n in [*range(21), 50]}


def test_damaged_headers_are_compared_with_every_line_of_their_pdf(spark):
    rng = random.Random(11)
    body = lambda: "\n".join(text_of(rng, 6) for _ in range(9))
    long = " ".join("".join(rng.choices("bdgkmpvz", k=7)) for _ in range(60))
    heads = {
        0: "Chronicle of the Western Harbours", 1: "Chronjcle of the Western Harbovrs",  # damaged in the first and in the last six letters
        2: "Zentralblatt der Vermessung", 3: "Zentralblatt dar Vermessung",  # with other lines between them in either order of letters
        4: long, 5: long[:200] + "x" + long[201:], 6: "Index", 7: "lndex",
    }
    pages = [(n, "p", n, f"{head}\n{body()}") for n, head in heads.items()]
    between = [f"Zentralblatt d{x}{text_of(rng, 5)}{x}r Vermessung" for x in "bcdbcdbcd"]
    pages += [(20 + n, "p", 20 + n, f"{line}\n{body()}") for n, line in enumerate(between)]
    pages.append((50, "q", 50, f"Index\n{body()}"))
    found = scan_noise.scan_defects(*scan(spark, pages)).where("defect = 'furniture'").select("page_id", "line_no").collect()
    assert {tuple(r) for r in found} == {(n, 0) for n in heads}


@pytest.mark.parametrize("held", [1 << 10, 1 << 20])
def test_alike_lines_equal_comparing_all_pairs(held):
    def distance(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            before, row = row, [i]
            for j, y in enumerate(b, 1):
                row.append(min(before[j] + 1, row[-1] + 1, before[j - 1] + (x != y)))
        return row[-1]

    for seed in range(6):
        rng = random.Random(seed)
        lines = {"".join(rng.choices("abcdefgü"[: rng.choice([2, 8])], k=rng.choice([1, 3, 4, 6, 12, 20, 60, 210]))) for _ in range(20)}
        for line in sorted(lines):
            for _ in range(3):
                lines.add("".join(rng.choice(["", "x", c + "y"]) if rng.random() < rng.choice([0.05, 0.1, 0.15]) else c for c in line) or "a")
        lines = sorted(lines)
        low = np.array([rng.randrange(6) for _ in lines])
        high = low + np.array([rng.choice([0, 0, 0, 2]) for _ in lines])
        met = np.array([rng.random() < 0.8 for _ in lines])
        asks = np.array([rng.random() < 0.8 for _ in lines]) & (low == high)
        near = lambda i, j: distance(lines[i], lines[j]) <= 0.15 * (len(lines[i]) + len(lines[j])) / 2 + 0.5
        want = [bool(asks[i]) and any(met[j] and j != i and (low[j], high[j]) != (low[i], high[i]) and near(i, j) for j in range(len(lines))) for i in range(len(lines))]
        assert scan_noise.alike_lines(pa.array(lines), low, high, asks, met, 0.85, held).tolist() == want


def test_parts_of_a_large_pdf_meet_in_pairs(spark, monkeypatch):
    rng = random.Random(12)
    heads = [f"{''.join(rng.choices('bdgkmpvz', k=24))}" for _ in range(12)]
    pages = [(2 * n + k, "p", 2 * n + k, f"{head[:9] + 'xx'[:k] + head[9 + k:]}\n{text_of(rng, 6)}\n{text_of(rng, 6)}") for n, head in enumerate(heads) for k in range(2)]
    monkeypatch.setattr(scan_noise, "LINES", 10)
    found = scan_noise.scan_defects(*scan(spark, pages)).where("defect = 'furniture'").select("page_id", "line_no").collect()
    assert {tuple(r) for r in found} == {(n, 0) for n in range(24)}


def test_paragraphs_are_continuous(spark):
    pages = [
        (1, "p", 0, "the gr0up un-\nder the stone-\ndock and\n\nthe capi-\nPage 1"), (2, "p", 1, "Page 2\ntal and the\nsma1l image"), (3, "p", 2, "under a\nPage 3"), (4, "p", 3, "warm stone.\n\nA number"),
        (5, "p", 5, "and the dock"), (6, "q", 6, "Stone"), (7, "p", 2, "under a\nPage 3"), (8, None, None, "the image"), (9, "q", 7, None), (10, "q", 8, ""),
    ]
    df, lex = scan(spark, pages)
    got = {(r.page_id, r.paragraph_no): (r.paragraph, r.pages) for r in scan_noise.repair_pages(df, lex).collect()}
    assert got == {
        (1, 0): ("the group under the stone-dock and", 1), (1, 1): ("the capital and the small image under a warm stone.", 4), (4, 1): ("A number", 1),
        (5, 0): ("and the dock", 1), (6, 0): ("Stone", 1), (7, 0): ("under a", 1), (8, 0): ("the image", 1),
    }
    rng = random.Random(5)
    long = [(n, "p", n, " ".join("".join(rng.choices("bdgkmpvz", k=7)) for _ in range(6))) for n in range(40)]
    df, lex = scan(spark, long)
    assert [r.pages for r in scan_noise.repair_pages(df, lex).collect()] == [40]
    assert scan_noise.repair_pages(df.limit(0), lex).count() == 0


def test_very_long_scan(spark):
    df, lex = scan(spark, [(1, "p", 0, "the gr0up and the small stone\n" * 20_000)])
    assert scan_noise.scan_defects(df, lex).where("defect = 'misread'").count() == 20_000
