"""Chunked positions, running sums and frames must equal the plain window."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from tastemill.operators import ordering as o


@pytest.fixture(scope="module")
def rows(spark):
    rnd = random.Random(1)
    data = []
    for i in range(600):
        g = "hot" if i % 3 == 0 else f"g{rnd.randint(0, 40)}"  # one group holds a third
        data.append((g, rnd.randint(0, 50), i, rnd.randint(-5, 9)))
    return spark.createDataFrame(data, "g string, t int, id int, v int")


def brute(rows):
    groups = {}
    for r in rows.collect():
        groups.setdefault(r.g, []).append((r.t, r.id, r.v))
    return {g: sorted(x) for g, x in groups.items()}


@pytest.mark.parametrize("limit", [10**6, 20])
def test_running_and_position(rows, limit):
    want = {}
    for x in brute(rows).values():
        total = 0
        for i, (_, id_, v) in enumerate(x):
            want[id_] = (total, i, i + 1)
            total += v
    out = o.running(rows, ["g"], ["t", "id"], {"s": F.col("v"), "n": F.lit(1)}, limit)
    out = o.position(out, ["g"], ["t", "id"], "pos", limit)
    assert {r.id: (r.s, r.n, r.pos) for r in out.collect()} == want


def test_position_of_whole_table(rows):
    got = {r.id: r.pos for r in o.position(rows, [], ["t", "id"]).collect()}
    order = sorted((r.t, r.id) for r in rows.collect())
    assert got == {id_: i + 1 for i, (_, id_) in enumerate(order)}


@pytest.mark.parametrize("limit", [10**6, 20, 7])
def test_previous_rows(rows, limit):
    want = {}
    for x in brute(rows).values():
        ids = [id_ for _, id_, _ in x]
        for i, id_ in enumerate(ids):
            want[id_] = ids[max(0, i - 5) : i]
    out = o.previous_rows(rows, ["g"], ["t", "id"], 5, {"c": F.col("id")}, limit=limit)
    got = {r.id: r.c for r in out.collect()}
    assert out.count() == 600
    assert got == want


def test_list_parts_keep_every_row(rows):
    out = o.list_parts(rows, ["g"], ["t", "id"], {"ids": F.col("id")}, size=30).collect()
    want = brute(rows)
    got = {}
    for r in sorted(out, key=lambda r: (r.g, r.part)):
        assert len(r.ids) <= 30
        got.setdefault(r.g, []).extend(r.ids)
    assert got == {g: [id_ for _, id_, _ in x] for g, x in want.items()}


def test_top_k_is_pruned_before_the_shuffle(rows):
    plan = o.top_k(rows, ["g"], ["t", "id"], 3)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_dense_index_skips_null(spark):
    df = spark.createDataFrame([("b",), ("a",), (None,), ("b",)], "v string")
    assert {r.v: r.idx for r in o.dense_index(df, "v").collect()} == {"a": 1, "b": 2}
