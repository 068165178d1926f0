"""Neighbours, percentiles, top N and packing: brute force and awkward input."""

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pagelathe.llm import neighbours, packing, quantiles
from pagelathe.llm.codepoints import decode
from pagelathe.llm.topn import top_n

NAN = float("nan")


# --- neighbours

def brute_pairs(ids, x, k, floor):
    x = x / np.linalg.norm(x, axis=1, keepdims=True)
    s = x @ x.T
    out = set()
    for i in range(len(ids)):
        near = [j for j in np.lexsort((ids, -s[i].round(6))) if j != i and s[i, j] >= floor][:k]
        out |= {(min(ids[i], ids[j]), max(ids[i], ids[j])) for j in near}
    return out


def clustered(n=3000, d=96, seed=1):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(n // 20, d))
    return (centres[rng.integers(0, len(centres), n)] + rng.normal(size=(n, d)) * rng.choice([0.2, 0.45], (n, 1))).astype(np.float32) * rng.uniform(0.1, 9, (n, 1)).astype(np.float32)


def test_one_list_is_exact_and_several_reach_recall(spark):
    x = clustered()
    ids = np.arange(len(x)) * 3
    df = spark.createDataFrame([(int(i), v.tolist()) for i, v in zip(ids, x)], "vec_id long, vector array<float>").repartition(3).cache()
    want = brute_pairs(ids, x.astype(np.float64), 5, 0.85)
    assert len(want) > 1000
    pairs = lambda **kw: {(r.id_a, r.id_b) for r in neighbours.similar_pairs(df, "vec_id", "vector", **kw).collect()}
    got = pairs(list_rows=5000)
    assert len(got & want) >= 0.999 * len(want) and len(got - want) <= 0.001 * len(want)
    assert len(pairs(list_rows=200) & want) >= 0.9 * len(want)
    # Lists cut into blocks give what whole lists give.
    assert pairs(list_rows=5000, task_rows=700) == got


@pytest.mark.parametrize("kind", ["clustered", "random"])
def test_k_nearest_without_a_floor(spark, kind):
    """Every vector's 10 nearest through several lists: recall over the queries whose id is divisible by 50."""
    x = clustered(4000) if kind == "clustered" else np.random.default_rng(5).normal(size=(4000, 24)).astype(np.float32) @ np.random.default_rng(6).normal(size=(24, 96)).astype(np.float32)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, vector array<float>").repartition(3)
    got = neighbours.nearest(neighbours.usable_vectors(df, "vec_id", "vector", 96), 96, 10, probes=6, list_rows=250).where("id % 50 = 0").collect()
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    s = unit[::50] @ unit.T
    s[np.arange(80), np.arange(0, 4000, 50)] = -9
    want = {(i * 50, int(j)) for i in range(80) for j in np.argsort(-s[i])[:10]}
    assert len(got) == 800 and len({(r.id, r.other) for r in got} & want) >= 0.9 * 800


def test_scan_without_a_floor_equals_brute_force_and_abandons():
    x = clustered(3000, seed=4)
    x = (x / np.linalg.norm(x, axis=1, keepdims=True)).astype(np.float32) @ neighbours.rotation(96)
    ids = np.arange(len(x))
    q, m, _ = neighbours.adaptive_scan(x[:500], x, ids[:500], ids, 5)
    s = x[:500].astype(np.float64) @ x.T.astype(np.float64)
    s[np.arange(500), np.arange(500)] = -9
    want = {(i, int(j)) for i in range(500) for j in np.argsort(-s[i])[:5]}
    assert len(set(zip(q.tolist(), m.tolist())) & want) >= 0.98 * len(want)
    # Once a k-th best is known, most candidates go before their last column block.
    qb, mb = neighbours._blocks(x[:500]), neighbours._blocks(x)
    kth = (2 * (1 - np.sort(s, axis=1)[:, -5]) + 1e-6).astype(np.float32)
    alive, _ = neighbours._alive(qb[:1], mb[:1], slice(0, 500), slice(0, 2048), kth, [np.float32((1 + neighbours.SIGNIFICANCE / np.sqrt(32)) ** 2 / 3)], 5)
    assert len(alive) < 0.5 * 500 * 2048


def test_two_levels_of_lists_find_the_nearest_lists():
    x = clustered(9000, seed=2)
    x = (x / np.linalg.norm(x, axis=1, keepdims=True)).astype(np.float32)
    known = neighbours.Lists(x, 600)
    assert known.cells is not None and len(known.centroids) >= 500
    got = known.nearest(x[:800], 3)
    want = np.argsort(-(x[:800] @ known.centroids.T), axis=1)[:, :3]
    assert np.mean([len(set(a) & set(b)) for a, b in zip(got.tolist(), want.tolist())]) >= 2.7
    assert all(len(set(r)) == 3 for r in got.tolist())


def test_copies_ties_and_unusable_vectors(spark):
    base = np.random.default_rng(0).normal(size=96)
    near = base + 0.01 * np.random.default_rng(1).normal(size=96)
    v = lambda x: [float(a) for a in x]
    rows = [(i, v(base), "a") for i in range(10)] + [(20, v(near), "b"), (21, v(base)[:95], "c"), (22, None, "d"), (23, [0.0] * 96, "e"), (24, [NAN] + v(base)[1:], "f"), (25, [float("inf")] + v(base)[1:], "g"), (26, [None] + v(base)[1:], "h"), (None, v(base), "i"), (3, v(base), "again")]
    df = spark.createDataFrame(rows, "vec_id long, vector array<float>, id_a string")
    got = {(r.id_a, r.id_b) for r in neighbours.similar_pairs(df, "vec_id", "vector").collect()}
    want = {(min(i, j), max(i, j)) for i in range(10) for j in [j for j in range(10) if j != i][:5]} | {(i, 20) for i in range(5)}
    assert got == want
    assert neighbours.similar_pairs(df.limit(0), "vec_id", "vector").count() == 0


def test_adaptive_scan_abandons_nothing_within_reach():
    rng = np.random.default_rng(3)
    turn = neighbours.rotation(96)
    assert np.allclose(turn @ turn.T, np.eye(96), atol=1e-5)
    x = rng.normal(size=(400, 96))
    x[200:] = x[:200] + rng.normal(size=(200, 96)) * 0.55
    x = (x / np.linalg.norm(x, axis=1, keepdims=True)).astype(np.float32) @ turn
    ids = np.arange(400)
    q, m, _ = neighbours.adaptive_scan(x, x, ids, ids, 400, 0.85)
    s = x.astype(np.float64) @ x.T
    want = {(i, j) for i, j in zip(*np.nonzero(s >= 0.85)) if i != j}
    assert len(want) > 50 and len(set(zip(q, m)) & want) >= 0.99 * len(want)


def test_a_dense_third_of_all_rows(spark):
    rng = np.random.default_rng(8)
    blob = rng.normal(size=96) + rng.normal(size=(4000, 96)) * 0.15
    x = np.concatenate([blob, rng.normal(size=(2000, 96))]).astype(np.float32)
    ids = np.arange(len(x))
    want = brute_pairs(ids, x.astype(np.float64), 5, 0.85)
    q, m, _ = neighbours.adaptive_scan(unit := neighbours._unit(x) @ neighbours.rotation(96), unit, ids, ids, 5, 0.85)
    got = {(min(a, b), max(a, b)) for a, b in zip(q.tolist(), m.tolist())}
    assert len(got & want) >= 0.99 * len(want) > 9000


# --- percentiles

@pytest.mark.parametrize("seed", range(3))
def test_sketch_error_shrinks_towards_the_tail(seed):
    rng = np.random.default_rng(seed)
    values = rng.lognormal(0, 2, 400_000)
    whole = quantiles.TailSketch(32)
    for part in np.array_split(values, 40):
        one = quantiles.TailSketch(32)
        one.add(part)
        whole.merge(quantiles.TailSketch.from_bytes(one.to_bytes()))
    assert whole.count == len(values) and sum(len(x) for x in whole.levels) < 20_000
    values.sort()
    for q in (0.5, 0.9, 0.99, 0.999, 0.9999):
        rank = np.searchsorted(values, whole.quantiles([q])[0]) / len(values)
        assert abs(rank - q) <= 0.05 * (1 - q) + 2 / len(values)


@settings(max_examples=40, deadline=None)
@given(st.lists(st.floats(0, 1e6), min_size=1, max_size=200), st.floats(0, 1))
def test_small_sketch_is_exact(values, q):
    s = quantiles.TailSketch(64)
    s.add(np.array(values))
    assert np.isclose(s.quantiles([q])[0], np.quantile(values, q), rtol=1e-9, atol=1e-9)


def test_empty_sketch():
    assert np.isnan(quantiles.TailSketch().quantiles([0.5])[0])


def test_sketch_groups_awkward_input(spark):
    rows = [("a", 1.0), ("a", 3.0), ("a", None), ("a", NAN), ("a", -1.0), ("a", float("inf")), (None, 2.0), ("b", None)]
    df = spark.createDataFrame(rows, "g string, v double").withColumnRenamed("v", "sketch")
    df = df.withColumnRenamed("sketch", "value")
    got = {r.g: (r.n, r.quantiles) for r in quantiles.read_quantiles(quantiles.sketch_groups(df, ["g"], "value"), [0.5]).collect()}
    assert got == {"a": (2, [2.0]), None: (1, [2.0])}
    assert quantiles.sketch_groups(df.limit(0), ["g"], "value").count() == 0


def test_merge_order_does_not_matter_much(spark):
    rng = np.random.default_rng(5)
    df = spark.createDataFrame([(f"d{i % 7}", "m", float(x)) for i, x in enumerate(rng.exponential(1, 20_000))], "day string, name string, value double").repartition(6)
    days = quantiles.sketch_groups(df, ["day", "name"], "value")
    a = quantiles.read_quantiles(quantiles.merge_sketches(days, ["name"]), [0.95]).first()
    b = quantiles.read_quantiles(quantiles.sketch_groups(df, ["name"], "value"), [0.95]).first()
    assert a.n == b.n == 20_000 and abs(a.quantiles[0] - b.quantiles[0]) < 0.1


def test_coins_differ_between_sketches_and_alternate():
    coins = [[quantiles.TailSketch(8, seed=seed)._coin(level, throw) for level in range(4) for throw in range(16)] for seed in range(40)]
    assert 0.4 < np.mean(coins) < 0.6 and len({tuple(c) for c in coins}) == 40
    # The second of two compactions moves the side the first left.
    a, b = quantiles.TailSketch(8, seed=3), quantiles.TailSketch(8, seed=3)
    for s in (a, b):
        s.add(np.arange(500.0))
    assert all((x == y).all() for x, y in zip(a.levels, b.levels)) and quantiles.TailSketch.from_bytes(a.to_bytes()).seed == 3


def test_errors_of_many_partitions_cancel():
    """Merged sketches of 400 partitions that saw the same values: the median's rank error stays far below that of one partition's coin."""
    values = np.sort(np.random.default_rng(0).exponential(1, 600))
    whole = quantiles.TailSketch(8, seed=1)
    for part in range(400):
        one = quantiles.TailSketch(8, seed=part * 7919)
        one.add(values)
        whole.merge(one)
    for q in (0.5, 0.9, 0.99):
        got = whole.quantiles([q])[0]
        assert abs(np.searchsorted(values, got) / 600 - q) <= 0.1 * (1 - q) + 2 / 600


def test_repeated_keys_are_dropped_without_a_shuffle_of_the_rest(spark):
    rng = np.random.default_rng(1)
    rows = [(f"k{k}", int(k) % 7, {"a": float(k)}) for k in rng.integers(0, 9000, 12_000)] + [(None, None, {"a": -1.0})] * 3 + [("hot", 1, {"a": -2.0})] * 4000
    df = spark.createDataFrame(rows, "a string, b int, m map<string,double>").repartition(5)
    want = {(a, b) for a, b, _ in rows}
    for bits in (quantiles.MOST_BITS, 1024):
        got = [(r.a, r.b) for r in quantiles.without_repeats(df, ["a", "b"], bits).collect()]
        assert len(got) == len(want) and set(got) == want
    assert quantiles.without_repeats(df.limit(0), ["a", "b"]).count() == 0


def test_metric_values_awkward_rows(spark):
    ddl = "pdf_path string, page_index int, run_at timestamp, timing_s map<string,double>, models map<string,struct<calls:int,seconds:double,items:int,batch_size_hist:map<string,int>>>"
    import datetime as dt

    at = dt.datetime(2022, 1, 3)
    rows = [("p", 0, at, {"a": 1.0, "b": None}, {"m": (1, 2.0, 1, {})}), ("p", 0, at, {"a": 1.0, "b": None}, {"m": (1, 2.0, 1, {})}), (None, None, None, None, None), ("p", 1, at, {}, {"m": None})]
    got = sorted((r.run_day or "", r.metric_field, r.metric_name, r.value) for r in quantiles.metric_values(spark.createDataFrame(rows, ddl)).collect() if r.value is not None)
    assert got == [("2022-01-03", "seconds", "m", 2.0), ("2022-01-03", "timing_s", "a", 1.0)]


# --- top N

def test_top_n_against_brute_force(spark):
    rng = np.random.default_rng(2)
    rows = [(int(g), int(i), float(round(s, 1))) for g, i, s in zip(rng.choice(30, 6000, p=[0.4] + [0.6 / 29] * 29), rng.integers(0, 400, 6000), rng.uniform(0, 9, 6000))]
    best = {}
    for g, i, s in rows:
        best.setdefault(g, {})[i] = min(s, best.get(g, {}).get(i, 99))
    want = {(g, i, s, r + 1) for g, items in best.items() for r, (s, i) in enumerate(sorted((s, i) for i, s in items.items())[:5])}
    df = spark.createDataFrame(rows, "g long, i long, s double").repartition(5)
    assert {tuple(r) for r in top_n(df, "g", "i", "s", 5).collect()} == want
    assert {tuple(r) for r in top_n(df, "g", "i", "s", 5, merge_rows=100).collect()} == want
    most = {}
    for g, i, s in rows:
        most.setdefault(g, {})[i] = max(s - 4, most.get(g, {}).get(i, -99))
    want = {(g, i, r + 1) for g, items in most.items() for r, (s, i) in enumerate(sorted((-s, i) for i, s in items.items())[:5])}
    assert {(r.g, r.i, r["rank"]) for r in top_n(df.selectExpr("g", "i", "s - 4 AS s"), "g", "i", "s", 5, largest=True).collect()} == want


def test_top_n_awkward_input(spark):
    rows = [(1, 1, NAN, 0), (1, 2, None, 0), (1, 3, -1.0, 0), (1, 4, 0.5, 0), (1, 4, 0.5, 0), (1, 4, 0.7, 0), (None, 5, 0.1, 0), (1, None, 0.1, 0), (2, 6, NAN, 0), (3, 7, 0.0, 0)]
    df = spark.createDataFrame(rows, "g long, i long, s double, rank int")
    assert {tuple(r) for r in top_n(df, "g", "i", "s", 3, valid="s >= 0").collect()} == {(1, 4, 0.5, 1), (3, 7, 0.0, 1)}
    # Of any sign where nothing says otherwise, and from either end.
    assert {tuple(r) for r in top_n(df, "g", "i", "s", 3).collect()} == {(1, 3, -1.0, 1), (1, 4, 0.5, 2), (3, 7, 0.0, 1)}
    assert {tuple(r) for r in top_n(df, "g", "i", "s", 1, largest=True).collect()} == {(1, 4, 0.7, 1), (3, 7, 0.0, 1)}
    assert top_n(df.limit(0), "g", "i", "s", 3).count() == 0
    with pytest.raises(ValueError):
        top_n(df, "g", "i", "s", 0)


# --- packing

@settings(max_examples=40, deadline=None)
@given(st.lists(st.integers(1, 100), max_size=120))
def test_bins_hold_all_items_within_capacity(sizes):
    bins = packing.best_two_fit(np.array(sizes, np.int64), 100)
    assert (bins >= 0).all()
    assert all(np.sum(np.array(sizes)[bins == b]) <= 100 for b in set(bins.tolist()))
    if sizes:
        assert len(set(bins.tolist())) <= 1 + 1.7 * -(-sum(sizes) // 100)


def test_two_replace_one_where_tighter():
    # 60 takes 30 (gap 10); the pair 21 + 19 fills the gap of 40 wholly.
    bins = packing.best_two_fit(np.array([60, 30, 21, 19]), 100)
    assert bins[0] == bins[2] == bins[3] != bins[1]


def test_packing_wastes_little(spark):
    rng = np.random.default_rng(4)
    df = spark.createDataFrame([(int(i), int(t)) for i, t in enumerate(rng.lognormal(5.2, 0.9, 5000).astype(int) + 1)], "item long, tokens long")
    out = packing.pack_items(df, 1024, 1500).toPandas()
    used = out.groupby(["lot", "bin_no"])["size"].sum()
    assert used.max() <= 1024 and used.sum() / (1024 * len(used)) > 0.97
    assert out.groupby("item")["size"].sum().to_dict() == {r.item: r.tokens for r in df.collect()}
    assert (out[out["size"] < 1024].groupby("item").size() == 1).all()


def test_packing_does_not_depend_on_storage(spark):
    rng = np.random.default_rng(6)
    rows = [(int(i % 700), int(t)) for i, t in enumerate(rng.lognormal(5, 1, 2000).astype(int) + 1)] + [(5, 77)] * 300
    df = spark.createDataFrame(rows, "item long, tokens long")
    key = ["lot", "bin_no", "item", "piece_no", "pieces", "token_begin", "size"]
    one, two = (sorted(map(tuple, packing.pack_items(df.repartition(n, c), 1024, 400).select(*key).collect())) for n, c in ((1, "item"), (5, "tokens")))
    assert one == two and len(one) >= 2300


def test_packing_awkward_input(spark):
    df = spark.createDataFrame([(1, 0), (2, None), (3, 1024), (4, 1025), (3, 1024), (None, 5)], "item long, tokens long").withColumnRenamed("tokens", "tokens")
    out = packing.pack_items(df).toPandas()
    assert sorted(out[out.item == 4]["size"]) == [1, 1024] and (out.item == 3).sum() == 2 and out.item.isna().sum() == 1
    assert packing.pack_items(df.limit(0)).count() == 0


def test_token_counts():
    import pyarrow as pa

    texts = ["a b", "don't -- stop", None, "", "  ", "x_1,y", "日本 語。é"]
    assert packing.count_tokens(*decode(pa.array(texts))).tolist() == [2, 5, 0, 0, 0, 3, 4]
