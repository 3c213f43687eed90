"""Content, sequences, splits, features, metrics, losses on small known input."""

from __future__ import annotations

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tastemill.functions import scalar as fx
from tastemill.functions import vector as vx
from tastemill.operators import aggregates as a
from tastemill.operators import cleaning as cl
from tastemill.operators import content as c
from tastemill.operators import features as f
from tastemill.operators import joins as j
from tastemill.operators import losses as lo
from tastemill.operators import metrics as m
from tastemill.operators import ordering as o
from tastemill.operators import retrieval as r
from tastemill.operators import sequences as s
from tastemill.operators import sets as st


def one(df, expr):
    return df.select(expr.alias("x")).first().x


# --- expressions --------------------------------------------------------------


def test_scalar_edges(spark):
    d = spark.range(1)
    assert one(d, fx.half_even(F.lit(0.0625), 3)) == 0.062
    assert one(d, fx.time_closeness(F.lit(None).cast("long"), F.lit(86400))) == 0.5
    assert one(d, fx.guarded_log1p(F.lit(-3.0))) == -1.0
    assert one(d, fx.coerce_int(F.lit("abc"))) == 0
    assert one(d, fx.coerce_int(F.lit("3.7"))) == 3
    assert one(d, fx.coerce_double(F.lit("abc"))) is None
    assert one(d, fx.trailing_year(F.lit("Heat (1995) "))) == 1995
    assert one(d, fx.trailing_year(F.lit("Heat"))) is None
    assert one(d, fx.any_year(F.lit("(1995) Heat"))) == 1995
    assert one(d, fx.any_year(F.lit("Heat"))) == 0
    assert one(d, fx.tidy_genres(F.lit("Film-Noir|Drama"))) == "Noir Drama"
    assert one(d, fx.bucket_index(F.lit(30.0), [18, 25, 30, 35])) == 3
    assert one(d, fx.point_part(fx.compose_point(F.lit(1.5), F.lit(-2.25)), 1)) == -2.25
    assert one(d, fx.parse_epoch(F.lit("1970-01-02T00:00:00.000Z"))) == 86400
    assert one(d, fx.parse_epoch(F.lit("yesterday"))) is None
    assert one(d, fx.edit_similarity(F.lit(""), F.lit(""))) == 100


def test_vector_edges(spark):
    d = spark.range(1)
    a1, b1 = F.array(*map(F.lit, [1.0, 0.0, 0.0, 0.0])), F.array(*map(F.lit, [1.0, 0.0, 1.0, 0.0]))
    zero = F.array(*map(F.lit, [0.0, 0.0, 0.0, 0.0]))
    assert one(d, vx.cosine(a1, b1)) == pytest.approx(0.707107, abs=1e-6)
    assert one(d, vx.cosine(a1, zero)) == 0.0
    assert one(d, vx.squared_distance(a1, b1)) == 1.0
    assert one(d, vx.sinusoid(F.lit(0), 4)) == [0.0, 1.0, 0.0, 1.0]


def test_history_summary_of_the_worked_example(spark):
    # fixed values of the worked example
    hist = spark.createDataFrame([("u", 1, "a"), ("u", 2, "b"), ("u", 3, "c")], "user_id string, pos int, item_id string")
    items = spark.createDataFrame(
        [("a", [1.0, 2.0]), ("b", [3.0, 4.0]), ("c", [-1.0, 0.0])], "item_id string, v array<double>"
    )
    got = {x.dim: (x["mean"], x.recent) for x in r.history_summary(hist, items).collect()}
    assert got == {0: (1.0, 1.0), 1: (2.0, 2.0)}


# --- cleaning and joins -----------------------------------------------------------


def test_first_time_is_taken_before_the_filter(spark):
    df = spark.createDataFrame(
        [("u", "i", 1.0, 50, 1), ("u", "i", 5.0, 10, 2)], "user_id string, item_id string, rating double, ts long, n int"
    )
    got = cl.first_time_then_filter(df, ["n"], 3.0).first()
    assert (got.rating, got.ts, got.first_ts) == (5.0, 10, 50)


def test_shown_until_last_click(spark):
    rows = [("t", 1, None), ("t", 2, "x"), ("t", 3, None), ("s", 1, None)]
    df = spark.createDataFrame(rows, "traceId string, resPos int, click_object_id string")
    got = sorted((x.traceId, x.resPos) for x in j.shown_until_last_click(df).collect())
    assert got == [("t", 1), ("t", 2)]


def test_nearest_reference_ties_and_nulls(spark):
    df = spark.createDataFrame([(0.0, 0.0), (9.0, 0.0), (None, 1.0)], "a double, b double")
    got = [x.n for x in df.select(j.nearest_reference(F.col("a"), F.col("b"), [(1.0, 0.0), (-1.0, 0.0)]).alias("n")).collect()]
    assert got == [0, 0, None]


def test_grid_is_the_product(spark):
    parts = [spark.createDataFrame([(x,) for x in v], f"{n} string") for n, v in (("a", "xyz"), ("b", "pq"), ("c", "12"))]
    got = sorted(tuple(x) for x in j.grid(parts).select("a", "b", "c").collect())
    assert got == sorted((x, y, z) for x in "xyz" for y in "pq" for z in "12")


def test_not_taken(spark):
    df = spark.createDataFrame([("u", 1), ("u", 2), ("v", 3)], "user_id string, item_id int")
    assert sorted(tuple(x) for x in st.not_taken(df).select("user_id", "item_id").collect()) == [("u", 3), ("v", 1), ("v", 2)]


def test_histogram_last_bin_holds_its_end(spark):
    df = spark.createDataFrame([(0.0,), (10.0,), (20.0,), (21.0,)], "x double")
    assert {x.bin: x.n for x in cl.histogram(df, "x", [0.0, 10.0, 20.0]).collect()} == {0: 1, 1: 2}


def test_null_part_makes_the_key_unknown(spark):
    df = spark.createDataFrame([("n", None, "m", 1), ("n", 2, "m", 1)], "a string, b int, c string, d int")
    got = {x.left_key: x.n for x in a.composed_pair_counts(df, ["a", "b"], ["c", "d"], F.lit(True)).collect()}
    assert got == {"unknown": 1, "n:2": 1}


# --- content ------------------------------------------------------------------------


def test_profile_and_its_list(spark):
    items = spark.createDataFrame([("a", "x|y"), ("b", "x"), ("c", "y"), ("d", None)], "item_id string, categories string")
    ev = spark.createDataFrame(
        [("u", "a", 4.0, 0), ("u", "b", 2.0, 0), ("v", "b", 5.0, 0)], "user_id string, item_id string, rating double, ts long"
    )
    cats = c.item_categories(items)
    prof = c.user_profile(ev, cats, 3.0, 10)
    got = {(x.user_id, x.category): x.ratio for x in prof.collect()}
    assert got == {("u", "x"): 0.5, ("u", "y"): 0.5, ("v", "x"): 1.0}
    top = c.top_items_per_category(cats, a.total_rating(ev), 10)
    recs = {(x.user_id, x.item_id): x["rank"] for x in c.recommend_from_profile(prof, top, 2).collect()}
    assert recs == {("u", "b"): 1, ("u", "a"): 2, ("v", "b"): 1, ("v", "a"): 2}


def test_popular_for_unknown(spark):
    users = spark.createDataFrame([("a",), ("b",)], "user_id string")
    pop = spark.createDataFrame([("i", 9, 1), ("j", 5, 2)], "item_id string, score int, rank int")
    out = c.popular_for_unknown(users, users.filter("user_id = 'a'"), pop).collect()
    assert [(x.user_id, x.item_id) for x in out] == [("b", "i"), ("b", "j")]


# --- sequences -------------------------------------------------------------------------


@pytest.fixture(scope="module")
def events(spark):
    rnd = random.Random(2)
    rows = [("hot", i, i * 10, 1.0) for i in range(40)]  # the hot user took all items but two
    rows += [(f"u{u}", i, rnd.randint(0, 900), float(rnd.randint(1, 5))) for u in range(8) for i in rnd.sample(range(42), 10)]
    return spark.createDataFrame(rows, "user_id string, item_id int, ts long, rating double")


def test_unseen_negatives_are_exact(events):
    seen = {(x.user_id, x.item_id) for x in events.collect()}
    universe = {i for _, i in seen}
    got = {}
    for x in s.unseen_negatives(events, 5).collect():
        assert (x.user_id, x.item_id) not in seen
        got.setdefault(x.user_id, set()).add(x.item_id)
    for u in {u for u, _ in seen}:
        assert len(got.get(u, ())) == min(5, len(universe) - sum(1 for v, _ in seen if v == u))


def test_borrowed_negatives(events):
    out = s.borrowed_negatives(events, ["user_id", "item_id"], 6).collect()
    per = {}
    for x in out:
        per[x.user_id] = per.get(x.user_id, 0) + 1
    assert set(per.values()) == {6} and len(per) == 9


def test_count_up_in_steps(spark, monkeypatch):
    monkeypatch.setattr(s, "RANGE_CHUNK", 4)
    df = spark.createDataFrame([("a", 10), ("b", 0), ("c", 4)], "k string, n long")
    got = sorted((x.k, x.i) for x in s.count_up(df, F.col("n"), "i").collect())
    assert got == [("a", i) for i in range(10)] + [("c", i) for i in range(4)]


def test_sequence_windows(spark):
    df = spark.createDataFrame([("u", i, i) for i in range(1, 9)] + [("v", 1, 1)], "user_id string, item_id int, ts int")
    train, test = s.sequence_windows(df, ["ts"], 3, 1, 2)
    assert sorted((x.seq, x.target) for x in train.collect()) == [
        ([1, 2, 3], [4]),
        ([2, 3, 4], [5]),
        ([3, 4, 5], [6]),
    ]
    assert {x.user_id: (x.seq, x.target) for x in test.collect()} == {"u": ([4, 5, 6], [7, 8]), "v": ([], [1])}


def test_context_examples_skip_short_timelines(spark):
    df = spark.createDataFrame([("u", i, i) for i in range(4)] + [("v", 1, 1), ("v", 2, 2)], "user_id string, item_id int, ts int")
    ex = s.context_examples(df, ["ts"], 2, {"ctx": F.col("item_id")})
    out = s.padded(ex, 3, {"ctx": F.lit(-1)})
    assert sorted((x.user_id, x.label_item, x.ctx) for x in out.collect()) == [
        ("u", 1, [0, -1, -1]),
        ("u", 2, [0, 1, -1]),
        ("u", 3, [1, 2, -1]),
    ]


def test_padded_lists(spark):
    df = spark.createDataFrame([(1, [7, 8], [1.0, 0.0]), (2, [1, 2, 3, 4], [0.0, 0.0, 2.0, 1.0])], "q int, items array<int>, labels array<double>")
    got = {x.q: (x["items"], x.labels, x["mask"]) for x in s.padded_lists(df, 3).collect()}
    assert got == {1: ([7, 8, 0], [1.0, 0.0, -1.0], [1, 1, 0]), 2: ([1, 2, 3], [0.0, 0.0, 2.0], [1, 1, 1])}


def test_splits_are_disjoint_and_stable(events):
    a1 = s.random_split(events, 0.8, "user_id", "item_id")
    a2 = s.random_split(events.repartition(7), 0.8, "user_id", "item_id")
    assert a1.exceptAll(a2).count() == 0
    strat = s.stratified_split(events, "user_id", 0.75, "user_id", "item_id")
    per = {(x.user_id, x.split): x["count"] for x in strat.groupBy("user_id", "split").count().collect()}
    assert per[("hot", "train")] == 30 and per[("u1", "train")] == 8 and per[("u1", "test")] == 2
    last = s.latest_as_test(events, ["ts", "item_id"]).filter("split = 'test'")
    assert last.count() == 9
    chrono = {x.split: x["count"] for x in s.chronological_split(events, ["ts", "user_id", "item_id"]).groupBy("split").count().collect()}
    assert chrono == {"train": 96, "valid": 12, "test": 12}


def test_balanced_labels(events):
    per = {}
    for x in s.balanced_labels(events, 3.0, ["ts", "item_id"]).collect():
        per.setdefault(x.user_id, [0, 0])[x.label] += 1
    assert "hot" not in per  # only negatives
    assert all(n == p for n, p in per.values())


# --- features ------------------------------------------------------------------------------


def test_sequential_encoding(spark):
    df = spark.createDataFrame([(1, "a", 1), (2, "b", 0), (3, "a", 0), (4, "a", 1)], "id int, c string, y int")
    got = {x.id: (x.target, x["share"]) for x in f.sequential_encoding(df, "c", "y", ["id"]).collect()}
    assert got[1] == (None, None) and got[2] == (None, 0.0)
    assert got[3] == (1.0, 0.5) and got[4] == (0.5, pytest.approx(2 / 3))


def test_impute_rare_and_codes(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", None), (None, 3.0), ("b", 5.0)], "c string, x double")
    assert [tuple(x) for x in f.impute(df, ["x"], ["c"]).collect()] == [("a", 1.0), ("a", 3.0), ("a", 3.0), ("b", 5.0)]
    assert sorted(x.c for x in f.rare_and_missing(df, "c", 2).collect()) == ["LESS", "UNK", "a", "a"]
    assert [x[0] for x in spark.range(1).select(f.binary_code(F.lit(5), F.lit(5)).alias("b")).collect()] == [[1, 0, 1]]


def test_unknown_category_is_all_zeros(spark):
    from pyspark.ml.functions import vector_to_array

    train = spark.createDataFrame([("a", 1.0), ("a", 2.0), ("b", 3.0)], "c string, x double")
    model = f.fit_encoder(train, ["x"], ["c"])
    new = spark.createDataFrame([("a", 1.0), ("b", 1.0), ("zzz", 1.0)], "c string, x double")
    got = [x.v for x in model.transform(new).select(vector_to_array("features").alias("v")).collect()]
    assert got == [[1.0, 1.0, 0.0], [1.0, 0.0, 1.0], [1.0, 0.0, 0.0]]


# --- retrieval recipes --------------------------------------------------------------------------


def test_values_and_debiasing(spark):
    df = spark.createDataFrame([("p", 0.0), ("p", 0.6), ("q", 0.0)], "pos string, value double")
    got = sorted((x.pos, x.debiased) for x in r.debiased(df, "value", ["pos"], 1e-3).collect())
    assert got == [("p", 0.0), ("p", 2.0), ("q", 0.0)]
    assert sorted(x.weight for x in r.normalised_value(df, "value").collect()) == pytest.approx([1e-6 / 0.6, 1e-6 / 0.6, 1.0])
    v = spark.range(1).select(r.net_user_value(F.array(*map(F.lit, [1.0, 0.0, 1.0])), [0.1, 0.2, 0.3]).alias("v")).first().v
    assert v == pytest.approx(0.4)


# --- metrics -----------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def lists(spark):
    recs = spark.createDataFrame(
        [("u", "a", 1), ("u", "b", 2), ("v", "a", 1), ("v", "c", 2)], "user_id string, item_id string, rank int"
    )
    truth = spark.createDataFrame([("u", "b"), ("u", "z"), ("v", "c"), ("w", "a")], "user_id string, item_id string")
    train = spark.createDataFrame([("u", "c"), ("v", "b"), ("v", "d"), ("w", "c")], "user_id string, item_id string")
    return recs, truth, train


def test_list_metrics(lists):
    recs, truth, train = lists
    x = m.recall_precision(recs, truth).first()
    assert (x.recall, x.precision) == (50.0, 50.0)
    assert m.coverage(recs, train).first().coverage == 100.0
    want = (math.log(1) + math.log(2) + math.log(1) + math.log(3)) / 4
    assert m.mean_popularity(recs, train).first().popularity == pytest.approx(want, abs=1e-6)
    assert m.hit_rate(recs, truth, 2).first().hit_rate == 0.5
    y = m.ranking_at_k(recs, truth, 2).first()
    assert y["map"] == pytest.approx((0.25 + 0.5 + 0) / 3, abs=1e-6)
    ideal = 1 + 1 / math.log2(3)
    assert y.ndcg == pytest.approx((1 / math.log2(3) / ideal + 1 / math.log2(3)) / 3, abs=1e-6)
    assert (y.precision, y.recall) == (pytest.approx(1 / 3, abs=1e-6), pytest.approx(0.5, abs=1e-6))


def test_auc_with_ties_and_one_class(spark):
    df = spark.createDataFrame([(1, 0.9), (0, 0.5), (1, 0.5), (0, 0.1)], "y int, p double")
    assert m.auc(df, "y", "p").first().auc == 0.875
    assert m.auc(df.filter("y = 1"), "y", "p").first().auc is None
    assert m.accuracy(df, "y", "p").first().accuracy == 0.75
    rep = m.classification_report(df.withColumn("s", F.lit("x")), "s", "y", "p").first()
    assert (rep.accuracy, rep.precision, rep.recall, rep.auc) == (0.75, pytest.approx(2 / 3, abs=1e-6), 1.0, 0.875)


def test_rating_errors_and_log_loss(spark):
    df = spark.createDataFrame([(1.0, 2.0), (3.0, 2.0), (5.0, 5.0)], "rating double, prediction double")
    x = m.rating_errors(df).first()
    assert (x.rmse, x.mae) == (pytest.approx(math.sqrt(2 / 3), abs=1e-6), pytest.approx(2 / 3, abs=1e-6))
    assert x.r2 == pytest.approx(0.75)
    p = spark.createDataFrame([(1, 1.0), (0, 0.5)], "y int, p double")
    assert m.log_loss(p, "y", "p").first().log_loss == pytest.approx(math.log(2) / 2, abs=1e-6)


def test_list_ndcg_ignores_padding(spark):
    rows = [("q", 2.0, 0.1, 1), ("q", 0.0, 0.9, 2), ("q", -1.0, 5.0, 3), ("e", 0.0, 1.0, 1)]
    df = spark.createDataFrame(rows, "q string, label double, score double, id int")
    x = m.list_ndcg(df, ["q"], "label", "score", "id", (1, 3)).first()
    assert (x.ndcg_1, x.ndcg_3) == (0.0, pytest.approx(1 / math.log2(3), abs=1e-6))


def test_losses(spark):
    df = spark.createDataFrame([(2.0, 0.0), (-800.0, 0.0)], "pos double, neg double")
    x = lo.bpr(df, "pos", "neg").first()
    assert x.bpr_sum == pytest.approx(800 + math.log(1 + math.exp(-2)), abs=1e-3)
    assert lo.pairwise_hinge(df, "pos", "neg").first().hinge == 801.0
    rows = spark.createDataFrame([("q", 1.0, 2.0, 1), ("q", 0.0, 1.0, 2)], "q string, label double, z double, id int")
    want = math.log(math.exp(2) + math.exp(1)) - 2
    assert lo.listwise_softmax(rows, ["q"], "label", "z").first().softmax == pytest.approx(want, abs=1e-6)
    assert lo.list_mle(rows, ["q"], "label", "z", "id").first().list_mle == pytest.approx(want, abs=1e-6)


def test_in_batch_softmax(spark):
    rng = np.random.default_rng(0)
    u, i, w = rng.normal(size=(6, 3)), rng.normal(size=(6, 3)), rng.random(6)
    rows = [("b", [float(x) for x in u[k]], [float(x) for x in i[k]], float(w[k])) for k in range(6)]
    df = spark.createDataFrame(rows, "batch string, u array<double>, i array<double>, w double")
    z = u @ i.T
    want = ((np.log(np.exp(z).sum(axis=1)) - np.diag(z)) * w).mean()
    assert lo.in_batch_softmax(df, "batch", "u", "i", "w").first().loss == pytest.approx(want, abs=1e-6)


def test_top_k_cut_breaks_ties_by_id(spark):
    df = spark.createDataFrame([("g", i, 1.0) for i in (3, 1, 2)], "g string, id int, score double")
    assert [x.id for x in o.top_k(df, ["g"], [F.desc("score"), "id"], 2).orderBy("id").collect()] == [1, 2]
