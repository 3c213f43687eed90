"""Rows that stay within a task: the plans move lists and sums, and find what brute force finds."""

from __future__ import annotations

import random
import re
import tracemalloc

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tastemill.operators import content, features, ordering, sequences, tiles
from tastemill.operators import similarity as s


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def exchanged(df):
    """Columns by which the plan brings rows together, without their numbers."""
    return [re.sub(r"#\d+L?", "", x) for x in re.findall(r"hashpartitioning\((.*), \d+\)", plan(df))]


# --- I6_user_cf_top_n ------------------------------------------------------------


@pytest.mark.parametrize("length", [1000, 3])
def test_items_of_neighbours_travel_as_lists(monkeypatch, spark, length):
    monkeypatch.setattr(s, "LIST_LIMIT", length)
    monkeypatch.setattr(s, "block_count", lambda *_: 10**6)
    rnd = random.Random(5)
    rows = sorted({(u, rnd.randint(0, 25)) for u in range(30) for _ in range(rnd.randint(1, 9))} | {(7, i) for i in range(26)})
    df = spark.createDataFrame([*rows, (3, None), (None, 4)], "user_id long, item_id long")
    out = s.user_top_n(df, 4, 5)
    assert "user_id, item_id" not in exchanged(out)
    near = {}
    for r in s.most_similar(df, "item_id", "user_id", 4).collect():
        near.setdefault(r.a, []).append((r.b, r.score))
    held = {}
    for u, i in [*rows, (3, None)]:
        held.setdefault(u, set()).add(i)
    want = {}
    for u, found in near.items():
        sums = {}
        for v, x in found:
            for i in held.get(v, ()):
                sums[i] = sums.get(i, 0.0) + x
        unseen = [(-round(x, 6), i is not None, i or 0, i) for i, x in sums.items() if i is None or i not in held.get(u, ())]
        want |= {(u, n + 1): (x[3], -x[0]) for n, x in enumerate(sorted(unseen)[:5])}
    got = {(r.user_id, r["rank"]): (r.item_id, r.score) for r in out.collect()}
    assert {x: y[0] for x, y in got.items()} == {x: y[0] for x, y in want.items()}
    assert [got[x][1] for x in want] == pytest.approx([y[1] for y in want.values()], abs=1.01e-6)


# --- H15_mean_token_vectors ------------------------------------------------------


@pytest.mark.parametrize(("piece", "limit"), [(64, 10**9), (2, 0)])
def test_mean_vectors_are_summed_in_a_row_a_text(monkeypatch, spark, piece, limit):
    monkeypatch.setattr(features, "PIECE", piece)
    monkeypatch.setattr(features, "BROADCAST_BYTES", limit)
    vectors = {"a": [1.0, 2.0, 3.0, 4.0, 5.0], "b": [2.0, None, -1.0], "c": [], "d": None, "e": [None, 0.5]}
    tok = [(1, "a", 1), (1, "b", 2), (2, "b", 1), (2, "c", 3), (3, "d", 1), (4, "x", 1), (None, "a", 2), (None, "e", 1), (5, "e", 2)]
    out = features.mean_token_vectors(
        spark.createDataFrame(tok, "k long, token string, tf long"), "k", spark.createDataFrame(list(vectors.items()), "token string, v array<double>")
    )
    assert "k, dim" not in exchanged(out) and "keys=[k" in plan(out) and ", dim#" not in "".join(re.findall(r"keys=\[[^\]]*\]", plan(out)))
    sums = {}
    for k, token, tf in tok:
        for d, x in enumerate(vectors.get(token) or []):
            n, s_ = sums.get((k, d), (0, None))
            sums[(k, d)] = n + tf, s_ if x is None else (s_ or 0.0) + tf * x
    want = {x: None if v is None else round(v / n, 6) for x, (n, v) in sums.items()}
    assert {(r.k, r.dim): r.x for r in out.collect()} == want


def test_mean_vectors_of_no_vector(spark):
    tok = spark.createDataFrame([(1, "a", 1)], "k long, token string, tf long")
    out = features.mean_token_vectors(tok, "k", spark.createDataFrame([("a", [])], "token string, v array<double>"))
    assert out.collect() == [] and out.columns == ["k", "dim", "x"]


# --- X10_balanced_labels ---------------------------------------------------------


@pytest.mark.parametrize("limit", [10**6, 3])
def test_balanced_labels_meet_once_a_user(monkeypatch, spark, limit):
    monkeypatch.setattr(ordering, "GROUP_LIMIT", limit)
    rnd = random.Random(3)
    rows = [(u, i, float(rnd.randint(1, 9)), rnd.randint(0, 99)) for u in range(12) for i in rnd.sample(range(20), rnd.randint(1, 9))]
    df = spark.createDataFrame([*rows, (None, 1, 9.0, 1), (None, 2, 1.0, 1)], "user_id long, item_id long, rating double, ts long")
    out = sequences.balanced_labels(df, 5.0, ["ts", "item_id"])
    if limit > 3:  # the items' means, the rows that get them, one exchange of users
        assert [x for x in exchanged(out) if "user_id" in x] == ["user_id"]
    ratings = {}
    for _, i, x, _ in [*rows, (None, 1, 9.0, 1), (None, 2, 1.0, 1)]:
        ratings.setdefault(i, []).append(x)
    mean = {i: round(sum(x) / len(x), 3) for i, x in ratings.items()}
    want = set()
    for u in range(12):
        liked = sorted((ts, i) for w, i, x, ts in rows if w == u and x >= 5)
        rest = sorted((-mean[i], ts, i) for w, i, x, ts in rows if w == u and x < 5)
        take = min(len(liked), len(rest))
        want |= {(u, x[-1], 1) for x in liked[:take]} | {(u, x[-1], 0) for x in rest[:take]}
    assert {tuple(r) for r in out.collect()} == want


# --- I11_sar_top_k ---------------------------------------------------------------


@pytest.mark.parametrize("few", [500_000, 0])
@pytest.mark.parametrize("normalise", [True, False])
def test_scores_of_a_user_are_summed_where_the_user_is(monkeypatch, spark, few, normalise):
    monkeypatch.setattr(s, "FEW_SIMILARITIES", few)
    rnd = random.Random(2)
    rows = [(rnd.randint(0, 20), rnd.randint(0, 12), 86400 * rnd.randint(0, 60), rnd.choice([1.0, 3.0])) for _ in range(90)]
    rows += [(None, 3, 0, 1.0), (None, 4, 0, 3.0), (5, None, 0, 1.0)]
    df = spark.createDataFrame(rows, "user_id long, item_id long, ts long, w double")
    out = s.sar(df, F.col("w"), 30, normalise=normalise)
    if few:
        assert exchanged(out).count("user_id, item_id") == 1  # of the events; neither the sums nor the items taken
    latest = max(r[2] for r in rows)
    taken, users = {}, {}
    for u, i, ts, w in rows:
        taken[(u, i)] = taken.get((u, i), 0.0) + w * 2 ** (-(latest - ts) / 86400 / 30)
    for u, i in taken:
        users.setdefault(i, set()).add(u)
    like = {}
    for a in filter(lambda i: i is not None, users):
        for b in filter(lambda i: i is not None, users):
            both = len({u for u in users[a] & users[b] if u is not None})
            if a == b or both:
                like[(a, b)] = 1.0 if a == b else both / (len(users[a]) + len(users[b]) - both)
    raw = {}
    for (u, a), x in taken.items():
        for (c, b), y in like.items():
            if a == c:
                r, unit = raw.get((u, b), (0.0, 0.0))
                raw[(u, b)] = r + x * y, unit + y
    items = len({i for _, i, _, _ in rows})
    want = {}
    for (u, b), (r, unit) in raw.items():
        units = [y for (v, _), (_, y) in raw.items() if v == u]
        if normalise:
            start, end = (0.0 if len(units) < items else min(units)) * 1.0, max(units) * 3.0
            r = 1.0 + 2.0 * (r - start) / (end - start)
        if u is None and not normalise or u is not None and (u, b) not in taken:
            want[(u, b)] = r
    got = {(r.user_id, r.item_id): r.score for r in out.collect()}
    assert got.keys() == want.keys()
    assert [got[x] for x in want] == pytest.approx(list(want.values()), abs=1.01e-6)


# --- H13_tf_idf ------------------------------------------------------------------


def test_words_are_counted_where_their_text_is(monkeypatch, spark):
    texts = [(1, "red red blue sky"), (2, "red sea"), (2, "sea blue"), (3, None), (None, "red sky"), (None, "rare red"), (4, "a b"), (5, "rare red")]
    df = spark.createDataFrame(texts, "k long, text string")
    tasks = content.text_tasks(df, "k", "text")
    counted = content.tokens(df, "k", "text", ["sky"], tasks)
    assert exchanged(counted) == ["k"]
    monkeypatch.setattr(content, "COMMON_WORDS", 1)
    got = content.tf_idf(counted, "k", 8, tasks)
    assert "k, token" not in exchanged(got)
    plain = content.tf_idf(content.tokens(df, "k", "text", ["sky"]), "k", 8)
    want = sorted((str(r.k), r.token, round(r.weight, 9)) for r in plain.collect())
    assert sorted((str(r.k), r.token, round(r.weight, 9)) for r in got.collect()) == want and len(want) == 9
    monkeypatch.setattr(content, "TASK_CHARS", 3)
    assert content.text_tasks(df, "k", "text") is None  # one key has more than a task's


# --- J4_profile_recommend, X3_context_features: rows in tasks by their number ------


@pytest.mark.parametrize("users", [None, 3])
def test_profile_lists_in_tasks_by_users(monkeypatch, spark, users):
    monkeypatch.setattr(ordering, "TASK_ROWS", 2)
    profile = spark.createDataFrame(
        [(1, "x", 1, 0.5), (1, "y", 2, 0.5), (2, "y", 1, 1.0), (None, "x", 1, 1.0)], "user_id long, category string, rank long, ratio double"
    )
    top = spark.createDataFrame([("x", 7, 1), ("x", 8, 2), ("x", 9, 3), ("y", 8, 1), ("y", 6, 2)], "category string, item_id long, rank long")
    out = content.recommend_from_profile(profile, top, 3, users)
    got = sorted((str(r.user_id), r["rank"], r.item_id) for r in out.collect())
    assert got == [("1", 1, 7), ("1", 2, 8), ("1", 3, 6), ("2", 1, 8), ("2", 2, 6), ("None", 1, 7), ("None", 2, 8), ("None", 3, 9)]
    if users:
        assert "hashpartitioning(user_id" in plan(out) and "user_id, item_id" not in exchanged(out)
        assert max(map(int, re.findall(r"hashpartitioning\(user_id#\d+L?, (\d+)\)", plan(out)))) == 9  # 2 x 3 rows of 3 users


@pytest.mark.parametrize("limit", [10**6, 20])
def test_frames_in_tasks_by_rows(monkeypatch, spark, limit):
    monkeypatch.setattr(ordering, "TASK_ROWS", 10)
    rnd = random.Random(4)
    some = [None] if limit > 20 else []  # chunks are joined by their group
    rows = [(rnd.choice([*some, "hot", "hot", *"abcdef"]), rnd.randint(0, 9), i) for i in range(200)]
    df = spark.createDataFrame(rows, "g string, t int, id int")
    out = ordering.previous_rows(df, ["g"], ["t", "id"], 3, {"before": F.col("id")}, limit=limit)
    if limit > 20:
        assert re.findall(r"hashpartitioning\(g#\d+, (\d+)\)", plan(out)) == ["20"] and plan(out).count("Sort [") == 1
    groups = {}
    for g, ts, i in sorted(rows, key=lambda r: r[1:]):
        groups.setdefault(g, []).append(i)
    want = {i: (n + 1, held[max(0, n - 3) : n]) for held in groups.values() for n, i in enumerate(held)}
    assert {r.id: (r.pos, r.before) for r in out.collect()} == want


# --- L2_cosine_top_k, L3_l2_neighbours -------------------------------------------


@pytest.mark.parametrize("kernel", ["cosine", "l2"])
def test_a_tile_of_full_blocks_takes_little_memory(kernel):
    rng = np.random.default_rng(1)
    side = [pd.DataFrame({"key": np.arange(tiles.BLOCK), "v": list(rng.normal(size=(tiles.BLOCK, 64)))}) for _ in range(2)]
    tracemalloc.start()
    found = tiles.matcher(kernel, 10)(*side)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(found) == 10 * tiles.BLOCK and peak < 80e6


# --- I8_user_pearson_predict -----------------------------------------------------


def test_nearest_raters_leave_tiles_of_users(monkeypatch, spark):
    monkeypatch.setattr(s, "RATER_CELLS", 40)
    monkeypatch.setattr(s, "RATER_ITEMS", 3)
    monkeypatch.setattr(s, "block_count", lambda *_: 3)
    rnd = random.Random(6)
    rows = [(u, i, None if rnd.random() < 0.1 else float(rnd.randint(1, 9))) for u in range(25) for i in rnd.sample(range(10), rnd.randint(1, 7))]
    df = spark.createDataFrame([*rows, (None, 1, 2.0), (3, None, 4.0)], "user_id long, item_id long, rating double")
    want = s.predict_from_users(df, s.pearson(df, "item_id", "user_id"), df, 2)

    def pairs(*_args, **_kw):
        raise AssertionError("a row for every pair of members")

    monkeypatch.setattr(s, "shared_pairs", pairs)
    monkeypatch.setattr(s, "pair_sums", pairs)
    near = s.nearest_raters(df, df, 2)
    got = {(r.user_id, r.item_id): r.prediction for r in s.predict_from_raters(df, near).collect()}
    want = {(r.user_id, r.item_id): r.prediction for r in want.collect()}
    assert got.keys() == want.keys() and len(got) > 50
    assert all(got[x] is None and y is None or abs(got[x] - y) < 1.5e-5 for x, y in want.items())
