"""Blocks that meet without copies: same rows as brute force, and nothing shuffled by pairs."""

from __future__ import annotations

import itertools
import math
import random
import re

import numpy as np
import pytest

from tastemill.operators import content, tiles
from tastemill.operators import similarity as s


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def exchanged(df):
    """Columns by which the plan brings rows together, without their numbers."""
    return [re.sub(r"#\d+L?", "", x) for x in re.findall(r"hashpartitioning\((.*), \d+\)", plan(df))]


# --- I8_user_pearson -------------------------------------------------------------


def pearson_of(rows):
    held = {}
    for u, i, x in rows:
        if u is not None and i is not None:
            held.setdefault(u, []).append((i, x))
    want = {}
    for a, b in itertools.combinations(sorted(held), 2):
        met = [(x, y) for i, x in held[a] for j, y in held[b] if i == j]
        xs, ys = [[v for v in side if v is not None] for side in (list(z) for z in zip(*met))] if met else ([], [])
        xy = [x * y for x, y in met if x is not None and y is not None]
        if not xy:
            continue
        n, sx, sy = len(met), sum(xs), sum(ys)
        var = (n * sum(x * x for x in xs) - sx * sx, n * sum(y * y for y in ys) - sy * sy)
        if min(var) > 0:
            want[a, b] = (n * sum(xy) - sx * sy) / math.sqrt(var[0] * var[1])
    return want


@pytest.mark.parametrize("kind", [int, str])
def test_pearson_of_many_members_by_blocks(monkeypatch, spark, kind):
    rnd = random.Random(3)
    rows = [(kind(u), i, float(rnd.randint(1, 5))) for u in range(40) for i in range(12) if rnd.random() < 0.6]
    rows += [(kind(3), 4, 2.0), (kind(5), 2, None), (kind(6), 3, None), (None, 1, 2.0), (kind(7), None, 3.0)]
    df = spark.createDataFrame(rows, f"user_id {'long' if kind is int else 'string'}, item_id long, rating double")
    joined = {(r.a, r.b): r.score for r in s.pearson(df, "item_id", "user_id").collect()}
    monkeypatch.setattr(s, "TILED_MEMBERS", 2)
    monkeypatch.setattr(s, "block_count", lambda *_: 3)
    monkeypatch.setattr(s, "RATER_CELLS", 100)
    monkeypatch.setattr(s, "RATER_ITEMS", 5)
    monkeypatch.setattr(s, "PAIRS_SENT", 7)
    out = s.pearson(df, "item_id", "user_id")
    assert "CartesianProduct" in plan(out) and "Exchange" not in plan(out)
    found = out.collect()
    got = {(r.a, r.b): r.score for r in found}
    assert len(got) == len(found) and got == joined
    want = pearson_of(rows)
    assert got.keys() == want.keys() and got == pytest.approx(want, abs=1.01e-6)


def test_pearson_of_ratings_without_end_is_joined(monkeypatch, spark):
    df = spark.createDataFrame([(u, i, math.inf if u == i else float(u + i)) for u in range(4) for i in range(4)], "user_id long, item_id long, rating double")
    joined = sorted(map(str, s.pearson(df, "item_id", "user_id").collect()))
    monkeypatch.setattr(s, "TILED_MEMBERS", 2)
    assert sorted(map(str, s.pearson(df, "item_id", "user_id").collect())) == joined


# --- J5_content_neighbours -------------------------------------------------------


@pytest.mark.parametrize("kind", [int, str])
def test_blocks_of_texts_meet_without_copies(monkeypatch, spark, kind):
    rnd = random.Random(8)
    texts = [(kind(i), " ".join(rnd.choice(["alpha", "beta", "gamma", "delta", f"w{rnd.randint(0, 30)}"]) for _ in range(rnd.randint(1, 6)))) for i in range(30)]
    texts += [(kind(90), "alone"), (kind(91), "x"), (None, "alpha beta"), (None, "gamma")]
    df = spark.createDataFrame(texts, f"doc_id {'long' if kind is int else 'string'}, text string")
    tok = content.tokens(df, "doc_id", "text")
    whole = content.content_neighbours(tok, "doc_id", len(texts), 4).collect()
    monkeypatch.setattr(content, "block_count", lambda *_: 5)
    out = content.content_neighbours(tok, "doc_id", len(texts), 4)
    assert "CartesianProduct" in plan(out) and not any("_q" in x or "_c" in x for x in exchanged(out))
    weights = {r.key: {} for r in content.tf_idf(tok.withColumnRenamed("doc_id", "key"), "key", len(texts)).collect()}
    for r in content.tf_idf(tok.withColumnRenamed("doc_id", "key"), "key", len(texts)).collect():
        weights[r.key][r.token] = r.weight
    want = {}
    for a in weights:
        found = [(-round(sum(x * weights[b].get(w, 0.0) for w, x in weights[a].items()), 6), b) for b in weights if a != b]
        want |= {(a, n + 1): (b, -x) for n, (x, b) in enumerate(sorted((x, b) for x, b in found if x < 0 and b is not None)[:4]) if a is not None}
    got = {(r.query_key, r["rank"]): (r.match_key, r.score) for r in out.collect() if r.query_key is not None and r.match_key is not None}
    assert sorted(map(str, whole)) == sorted(map(str, out.collect()))
    for x, (b, score) in want.items():
        assert got[x][1] == pytest.approx(score, abs=2e-6)


def test_best_of_many_positive_scores_as_of_few(monkeypatch):
    rnd = np.random.default_rng(4)
    for share in (0.0, 0.3, 1.0):
        scores = np.round(rnd.random((20, 50)) * (rnd.random((20, 50)) < share), 2) - 0.1 * (rnd.random((20, 50)) < 0.1)
        scores[0] = -1.0
        scores[1, :3] = 1e-9
        same = np.arange(20), np.arange(20)
        found = []
        for few in (16, 0):
            monkeypatch.setattr(tiles, "FEW_SHARE", few)
            found.append(tiles._best_of_positive(scores.copy(), 7, same))
        for x, y in zip(*found):
            assert (x == y).all()


# --- I7_item_cf_top_n ------------------------------------------------------------


def test_lists_of_items_go_once_to_their_users(monkeypatch, spark):
    rnd = random.Random(9)
    rows = [(u, rnd.randint(0, 12)) for u in range(25) for _ in range(rnd.randint(1, 5))]  # some rows twice
    df = spark.createDataFrame([*rows, (None, 4), (None, 5), (3, None), (40, None), (41, 99)], "user_id long, item_id long")
    out = s.item_top_n(df, 4, 5)
    assert "user_id, item_id" not in exchanged(out)
    monkeypatch.setattr(s, "USER_CELLS", 0)
    by_item = s.item_top_n(df, 4, 5)
    assert "user_id, item_id" in exchanged(by_item)
    assert sorted(map(str, out.collect())) == sorted(map(str, by_item.collect()))
    assert out.count() > 20
