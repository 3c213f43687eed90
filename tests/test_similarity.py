"""Worked example, and pair operators against brute force with hot groups."""

from __future__ import annotations

import itertools
import math
import random

import pytest
from pyspark.sql import functions as F

from tastemill.operators import pairs as p
from tastemill.operators import similarity as s


def table(df):
    return {(r.a, r.b): r.score for r in df.collect()}


def test_pearson_users(ratings):
    got = table(s.pearson(ratings, "item_id", "user_id"))
    want = {"user1": 0.852803, "user2": 0.707107, "user3": 0.0, "user4": -0.792118}
    assert {b: v for (a, b), v in got.items() if a == "Alice"} == pytest.approx(want, abs=1e-6)


def test_pearson_items(ratings):
    got = table(s.pearson(ratings, "user_id", "item_id"))
    want = {"A": 0.969458, "D": 0.581675, "C": -0.427618, "B": -0.478091}
    assert {a: v for (a, b), v in got.items() if b == "E"} == pytest.approx(want, abs=1e-6)


def test_predictions(spark, ratings):
    target = spark.createDataFrame([("Alice", "E")], "user_id string, item_id string")
    users = s.predict_from_users(ratings, s.pearson(ratings, "item_id", "user_id"), target, 2).first()
    items = s.predict_from_items(ratings, s.pearson(ratings, "user_id", "item_id"), target, 2).first()
    assert users.prediction == pytest.approx(4.871980, abs=1e-5)
    assert items.prediction == pytest.approx(4.6, abs=1e-5)


def test_swing(ratings):
    got = table(s.swing(ratings, 0.5))
    for pair in itertools.combinations("ABCD", 2):
        assert got[pair] == pytest.approx(1.979798, abs=1e-6)
    for a in "ABCD":
        assert got[(a, "E")] == pytest.approx(1.090909, abs=1e-6)


def test_count_cosine_and_jaccard(ratings):
    got = table(s.co_occurrence(ratings, "user_id", "item_id"))
    assert got[("A", "D")] == 1.0
    assert got[("A", "E")] == pytest.approx(0.894427, abs=1e-6)
    jac = table(s.jaccard(ratings))
    assert jac[("B", "C")] == 1.0
    assert jac[("D", "E")] == pytest.approx(0.8)


def test_constant_ratings_give_no_pearson(spark):
    df = spark.createDataFrame(
        [("u", "a", 3.0), ("u", "b", 3.0), ("v", "a", 1.0), ("v", "b", 5.0)],
        "user_id string, item_id string, rating double",
    )
    assert s.pearson(df, "item_id", "user_id").count() == 0


def test_suggestions_leave_seen_items_out(ratings):
    near = s.neighbours(s.co_occurrence(ratings, "user_id", "item_id", "decay"), 5)
    out = s.item_based(ratings, near, 3, [F.desc("ts"), F.col("item_id")]).collect()
    assert [(r.user_id, r.item_id) for r in out] == [("Alice", "E")]
    everything = s.item_based(ratings, near, 3, [F.desc("ts"), F.col("item_id")], remove_seen=False)
    assert everything.count() > 1


def test_top_n_of_both_kinds(ratings):
    for fn in (s.user_top_n, s.item_top_n):
        assert [(r.user_id, r.item_id, r["rank"]) for r in fn(ratings, 80, 10).collect()] == [("Alice", "E", 1)]


def test_rating_vector_neighbours_include_self(ratings):
    out = s.rating_vector_neighbours(ratings, 2).collect()
    firsts = {r.a: r.b for r in out if r["rank"] == 1}
    assert firsts == {i: i for i in "ABCDE"}


@pytest.fixture(scope="module")
def skewed(spark):
    """One user holds a third of all rows."""
    rnd = random.Random(5)
    rows = [("hot", f"i{i:03d}", rnd.randint(0, 10**6)) for i in range(120)]
    rows += [(f"u{u}", f"i{i:03d}", rnd.randint(0, 10**6)) for u in range(24) for i in rnd.sample(range(150), 10)]
    return spark.createDataFrame(rows, "user_id string, item_id string, ts long")


def brute_decay(df):
    rows = df.collect()
    n, by = {}, {}
    for r in rows:
        n[r.item_id] = n.get(r.item_id, 0) + 1
        by.setdefault(r.user_id, []).append((r.item_id, r.ts))
    out = {}
    for x in by.values():
        for (i, ti), (j, tj) in itertools.combinations(sorted(x), 2):
            out[(i, j)] = out.get((i, j), 0.0) + 1 / (1 + abs(ti - tj) / 86400)
    return {k: v / math.sqrt(n[k[0]] * n[k[1]]) for k, v in out.items()}


@pytest.mark.parametrize("tile", [2000, 50, 7])
def test_tiled_pairs_lose_nothing(skewed, tile):
    got = table(s.co_occurrence(skewed, "user_id", "item_id", "decay", tile=tile))
    assert got == pytest.approx(brute_decay(skewed), abs=2e-6)


def test_tiles_bound_the_hot_group(skewed):
    base = p._blocks(skewed.select("user_id", "item_id"), "user_id", "item_id", 10)
    largest = base.groupBy("user_id", "_b").count().agg(F.max("count")).first()[0]
    assert largest <= 30  # 120 rows of the hot user over 12 blocks


def test_mirrored_is_symmetric(ratings):
    got = table(p.mirrored(s.co_occurrence(ratings, "user_id", "item_id")))
    assert all(got[(b, a)] == v for (a, b), v in got.items())
    assert len(got) == 20


def test_sar_top_items_are_unseen(ratings):
    out = s.sar(ratings, F.lit(1.0) * F.col("rating"), k=10)
    assert [(r.user_id, r.item_id) for r in out.collect()] == [("Alice", "E")]
