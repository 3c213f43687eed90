"""Tile matcher and walks against numpy, with blocks so small that every cut happens."""

from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tastemill.operators import content as c
from tastemill.operators import graph as g
from tastemill.operators import retrieval as r
from tastemill.operators import tiles
from tastemill.operators.quantised import QuantisedIndex, decoded


@pytest.fixture(scope="module")
def vecs(spark):
    rng = np.random.default_rng(3)
    m = rng.normal(size=(90, 6))
    m[7] = 0.0
    m[11] = m[12]
    df = spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(m)], "id long, v array<double>")
    return m, df


def expected(score, k, drop_self):
    out = []
    s = np.round(score, 6) + 0.0
    for i, row in enumerate(s):
        order = sorted((-(x), j) for j, x in enumerate(row) if not (drop_self and i == j))
        out += [(i, j, -x, n + 1) for n, (x, j) in enumerate(order[:k])]
    return out


@pytest.mark.parametrize("measure", ["dot", "cosine", "l2"])
@pytest.mark.parametrize("drop_self", [False, True])
def test_nearest(monkeypatch, vecs, measure, drop_self):
    monkeypatch.setattr(tiles, "BLOCK", 17)
    m, df = vecs
    if measure == "dot":
        score = m @ m.T
    elif measure == "cosine":
        n = np.linalg.norm(m, axis=1)
        n[n == 0] = 1
        score = (m / n[:, None]) @ (m / n[:, None]).T
    else:
        score = -((m[:, None, :] - m[None, :, :]) ** 2).sum(axis=2)
    out = r.nearest(df, df, "id", 5, measure, drop_self)
    col = "distance" if measure == "l2" else "score"
    sign = -1 if measure == "l2" else 1
    got = sorted((x.query_key, x["rank"], x.match_key, sign * x[col]) for x in out.collect())
    want = sorted((q, n, j, s) for q, j, s, n in expected(score, 5, drop_self))
    assert [x[:3] for x in got] == [x[:3] for x in want]
    assert [x[3] for x in got] == pytest.approx([x[3] for x in want], abs=2e-6)


def test_fewer_candidates_than_k(spark, vecs):
    _, df = vecs
    out = r.nearest(df.limit(3), df.limit(3), "id", 10, "dot", drop_self=True)
    assert out.count() == 6


@pytest.mark.parametrize("share", [1, 8, 10**6])
def test_text_neighbours(monkeypatch, spark, share):
    monkeypatch.setattr(tiles, "BLOCK", 16)
    monkeypatch.setattr(tiles, "DENSE_SHARE", share)
    rnd = random.Random(9)
    words = [f"w{i}" for i in range(60)]
    texts = [(i, " ".join(["the"] + rnd.choices(words, k=rnd.randint(1, 25)))) for i in range(70)]
    df = spark.createDataFrame(texts, "id long, text string")
    tok = c.tokens(df, "id", "text")
    got = {(x.query_key, x["rank"]): (x.match_key, x.score) for x in c.content_neighbours(tok, "id", 70, 4).collect()}
    weights = {}
    for x in c.tf_idf(tok, "id", 70).collect():
        weights.setdefault(x.id, {})[x.token] = x.weight
    for q in range(70):
        scored = sorted(
            (-round(sum(w * weights[j].get(t, 0.0) for t, w in weights[q].items()), 6), j) for j in range(70) if j != q
        )
        for n in range(4):
            assert got[(q, n + 1)][1] == pytest.approx(-scored[n][0], abs=2e-6)


def test_leaf_search_is_exact_when_all_leaves_are_searched(vecs):
    _, df = vecs
    index = r.LeafIndex(df, "id", leaves=4, slice_rows=10)
    a = {(x.query_key, x["rank"]): x.score for x in index.search(df, 5, 4).collect()}
    b = {(x.query_key, x["rank"]): x.score for x in r.nearest(df, df, "id", 5, "dot").collect()}
    assert a == pytest.approx(b, abs=2e-6)
    recall = r.recall_against(r.nearest(df, df, "id", 5, "dot"), index.search(df, 5, 4), 5).first()
    assert recall.recall > 0.99 and recall.queries == 90


def test_long_titles_that_round_to_100_are_not_exact(spark):
    long = "ab" * 125
    titles = spark.createDataFrame([(long + "x",), ("other",)], "t string")
    asked = spark.createDataFrame([(long + "y",), ("OTHER",)], "a string")
    got = {x.typed: (x.score, x.exact) for x in c.closest_titles(asked, "a", titles, "t").collect()}
    assert got == {long + "y": (100.0, False), "OTHER": (100.0, True)}


def test_ratio_of_common_letters(spark):
    def common(a, b):
        row = [0] * (len(b) + 1)
        for x in a:
            old = row[:]
            for j, y in enumerate(b):
                row[j + 1] = old[j] + 1 if x == y else max(row[j], old[j + 1])
        return row[-1]

    names = ["Golden Eye", "goldeneye", "Heat", "The Heat", "Eye"]
    asked = ["GoldenEye", "heat", "he Heat!", "Eye"]
    titles = spark.createDataFrame([(n,) for n in names], "t string")
    frame = spark.createDataFrame([(a,) for a in asked], "a string")
    got = {x.typed: (x.closest, x.score, x.exact) for x in c.closest_titles(frame, "a", titles, "t", "ratio").collect()}
    for a in asked:
        best = max(sorted(names), key=lambda n: round(200 * common(a, n) / (len(a) + len(n))))
        assert got[a] == (best, float(round(200 * common(a, best) / (len(a) + len(best)))), a in names)


def test_closest_titles(spark):
    asked = spark.createDataFrame([("toy storry",), ("Heat",), ("zzz",)], "a string")
    titles = spark.createDataFrame([("Toy Story",), ("heat",), ("Casino",)], "t string")
    got = {x.typed: (x.closest, x.score, x.exact) for x in c.closest_titles(asked, "a", titles, "t").collect()}
    assert got["toy storry"] == ("Toy Story", 90.0, False)
    assert got["Heat"] == ("heat", 100.0, True)
    assert got["zzz"][1] == 0.0


# --- walks ------------------------------------------------------------------


@pytest.fixture(scope="module")
def clicks(spark):
    """One item holds a third of the clicks; ids hold underscores, and users and items share them."""
    rnd = random.Random(4)
    rows = {(f"user_{u}", "item_0") for u in range(30)}
    while len(rows) < 90:
        rows.add((f"user_{rnd.randint(0, 29)}", f"user_{rnd.randint(0, 9)}"))
    rows = sorted(rows)
    return rows, spark.createDataFrame(rows, "user_id string, item_id string")


def matrix(rows, decimals=None):
    nodes = sorted({("user", u) for u, _ in rows} | {("item", i) for _, i in rows})
    at = {n: k for k, n in enumerate(nodes)}
    m = np.zeros((len(nodes), len(nodes)))
    for u, i in rows:
        m[at[("user", u)], at[("item", i)]] = 1
        m[at[("item", i)], at[("user", u)]] = 1
    m = m / m.sum(axis=1, keepdims=True)
    return nodes, at, m if decimals is None else np.where(m > 0, np.round(m, decimals), 0)


@pytest.mark.parametrize(("dense", "edges"), [(8_000_000, 40), (0, 40), (8_000_000, 10**6), (0, 10**6)])
def test_personal_rank(monkeypatch, clicks, dense, edges):
    monkeypatch.setattr(g, "FAN", 4)
    monkeypatch.setattr(g, "ROOTS", 7)
    monkeypatch.setattr(g, "DENSE", dense)
    rows, df = clicks
    nodes, at, m = matrix(rows)
    monkeypatch.setattr(g, "EDGES", edges)
    got = {(x.user_id, x.item_id): x.score for x in g.personal_rank(df, 0.4, 100, tolerance=1e-7).collect()}
    want = {}
    seen = set(rows)
    for kind, u in nodes:
        if kind == "user":
            r0 = np.zeros(len(nodes))
            r0[at[(kind, u)]] = 1
            x = np.linalg.solve(np.eye(len(nodes)) - 0.4 * m.T, 0.6 * r0)
            want |= {
                (u, i): x[at[(k, i)]]
                for k, i in nodes
                if k == "item" and (u, i) not in seen and x[at[(k, i)]] > 1e-12
            }
    assert got == pytest.approx(want, abs=2e-6)


@pytest.mark.parametrize("drop_self", [False, True])
def test_cosines_by_direction_are_those_of_all_blocks(spark, monkeypatch, drop_self):
    rnd = np.random.default_rng(3)
    m = rnd.normal(size=(400, 3)).round(1)
    m[:30] = m[30]  # equal directions, more than a slice
    m[[40, 41, 77]] = 0.0
    df = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(m)], "id long, v array<double>")
    asked = df if drop_self else df.where("id % 3 = 0").unionByName(spark.createDataFrame([(None, [1.0, 0.0, 2.0])], df.schema))
    monkeypatch.setattr(tiles, "BLOCK", 25)

    def found():
        rows = tiles.best_matches(asked, df, "id", 4, "cosine", drop_self=drop_self).collect()
        return {(r.query_key, r["rank"]): (r.match_key, r.score) for r in rows}

    want = found()
    monkeypatch.setattr(tiles, "CELL_ROWS", 12)
    moved, matched = [], tiles._by_direction
    monkeypatch.setattr(tiles, "_by_direction", lambda *a: moved.append(matched(*a)) or moved[0])
    assert found() == want and len(want) == 4 * asked.count()
    assert moved[0] is not None


@pytest.mark.parametrize("edges", [40, 150])
@pytest.mark.parametrize("few", [0, 10**6])
def test_walks_over_item_pairs_are_those_over_users(monkeypatch, clicks, edges, few):
    monkeypatch.setattr(g, "FAN", 4)
    monkeypatch.setattr(g, "ROOTS", 7)
    monkeypatch.setattr(g, "EDGES", edges)
    monkeypatch.setattr(g, "FEW_WALKS", few)
    _, df = clicks
    found = []
    for closure, steps in ((1, 1), (0, 2)):
        monkeypatch.setattr(g, "CLOSURE", closure)
        assert g.WalkGraph(df, "user_id", "item_id", None).steps == steps
        rows = g.personal_rank(df, 0.4, 5, tolerance=1e-9).collect()
        found.append({(x.user_id, x["rank"]): x.score for x in rows})
    assert found[0].keys() == found[1].keys() and found[0] == pytest.approx(found[1], abs=2e-6)


def test_linear_system_agrees_with_a_solver(clicks):
    rows, df = clicks
    nodes, at, m = matrix(rows, 3)
    got = {(x.user_id, x.item_id): x.score for x in g.rank_by_linear_system(df, 0.4, 100).collect()}
    for (u, i), score in got.items():
        r0 = np.zeros(len(nodes))
        r0[at[("user", u)]] = 1
        r = np.linalg.solve(np.eye(len(nodes)) - 0.4 * m.T, r0)
        assert score == pytest.approx(r[at[("item", i)]], abs=2e-5)


def test_roots_can_be_chosen(spark, clicks):
    _, df = clicks
    roots = spark.createDataFrame([("user_3",)], "user_id string")
    out = g.personal_rank(df, 0.6, 5, roots=roots)
    assert {x.user_id for x in out.select("user_id").collect()} == {"user_3"}


def test_weights_sum_to_one_before_rounding(clicks):
    _, df = clicks
    w = g.transition_weights(g.bipartite_graph(df), None).groupBy("src").agg(F.sum("weight").alias("w"))
    assert all(abs(x.w - 1) < 1e-9 for x in w.collect())


# ---- quantised search


def test_quantised_index_against_numpy(spark, vecs):
    m, df = vecs
    index = QuantisedIndex(df, "id", leaves=5, parts=3, codes=4, rounds=1, slice_rows=7)
    placed = {x.key: (x.leaf, np.frombuffer(x.v, np.uint8)) for x in index.placed.collect()}
    assert sorted(placed) == list(range(90))
    flat = np.stack([decoded(index.centres, placed[i][1][None, :])[0] for i in range(90)])
    near = np.round(((m[:, None, :] - index.leaf_centres[None]) ** 2).sum(axis=2), 9)
    assert [placed[i][0] for i in range(90)] == near.argmin(axis=1).tolist()
    probed = np.argsort(near, axis=1, kind="stable")[:, :3]
    approx, exact = np.round(m @ flat.T, 6) + 0.0, np.round(m @ m.T, 6) + 0.0
    got = sorted((x.query_key, x["rank"], x.match_key, x.score) for x in index.search(df, 4, 3, 9, drop_self=True).collect())
    want = []
    for i in range(90):
        open_ = [j for j in range(90) if j != i and placed[j][0] in probed[i]]
        first = sorted(open_, key=lambda j: (-approx[i, j], j))[:9]
        want += [(i, n + 1, j, exact[i, j]) for n, j in enumerate(sorted(first, key=lambda j: (-exact[i, j], j))[:4])]
    assert [x[:3] for x in got] == [x[:3] for x in want]
    assert [x[3] for x in got] == pytest.approx([x[3] for x in want], abs=2e-6)


def test_quantised_index_reads_everything_when_asked_to(vecs):
    _, df = vecs
    index = QuantisedIndex(df, "id", leaves=3, parts=2, codes=4)
    exact = r.nearest(df, df, "id", 5, "dot", drop_self=True)
    assert r.recall_against(exact, index.search(df, 5, 3, 90, drop_self=True), 5).first().recall == 1.0


def test_quantised_index_of_hot_leaves_nulls_and_nothing(spark, vecs):
    _, df = vecs
    same = spark.range(400).select((F.col("id") + 1000).alias("id"), F.array(*[F.lit(0.5)] * 6).alias("v"))
    none = spark.createDataFrame([(5000, None)], df.schema)
    all_ = df.unionAll(same).unionAll(none)
    index = QuantisedIndex(all_, "id", leaves=4, parts=2, codes=4, slice_rows=50)
    got = index.search(all_, 3, 2, 20, drop_self=True)
    assert got.where("query_key = 5000 or match_key = 5000").isEmpty()
    twins = got.where("query_key >= 1000").groupBy("query_key").agg(F.min("score").alias("s"), F.count("*").alias("n"))
    assert twins.count() == 400 and twins.where("n <> 3 or s < 1.5").isEmpty()
    empty = QuantisedIndex(all_.where("false"), "id", leaves=4, parts=2)
    assert empty.search(all_, 3, 2, 20).isEmpty()
    assert index.search(all_.where("false"), 3, 2, 20).isEmpty()
