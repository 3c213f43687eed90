"""How often vectors are sent: large blocks, floats where they hold every number, one copy of a query a slice."""

from __future__ import annotations

import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from tastemill.operators import retrieval as r
from tastemill.operators import tiles
from tastemill.operators.quantised import QuantisedIndex


def plan(df):
    return df._jdf.queryExecution().analyzed().toString()


def made(spark, numbers):
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(numbers)]
    return spark.createDataFrame(rows, "id long, v array<double>")


def test_blocks_of_vectors_hold_as_many_numbers_as_fit():
    assert tiles.vector_blocks(120_000, 64, 12) == 6  # 15 blocks of 8,192 rows before, each sent to the 15 others
    assert tiles.vector_blocks(1_800_000, 64, 12) == 28
    assert tiles.vector_blocks(1_800_000, 1024, 12) == 440
    assert tiles.vector_blocks(10, 64, 12) == 1 and tiles.vector_blocks(0, 0, 12) == 1


@pytest.mark.parametrize("measure", ["dot", "l2"])
@pytest.mark.parametrize("width", ["f4", "f8"])
def test_vectors_travel_as_floats_only_where_these_are_exact(monkeypatch, spark, measure, width):
    monkeypatch.setattr(tiles, "BLOCK_NUMBERS", 5 * 7)
    m = np.random.default_rng(4).normal(size=(40, 5)).astype(width).astype(float)
    df = made(spark, m)
    assert tiles.floats(df) == (width == "f4")
    out = r.nearest(df, df, "id", 3, measure, drop_self=True)
    assert ("array<float>" in plan(out)) == (width == "f4")
    name, sign = ("score", -1) if measure == "dot" else ("distance", 1)
    score = m @ m.T if measure == "dot" else ((m[:, None] - m[None]) ** 2).sum(axis=2)
    want = [sorted((sign * round(score[i, j], 6), j) for j in range(40) if j != i)[:3] for i in range(40)]
    got = {(x.query_key, x["rank"]): (sign * x[name], x.match_key) for x in out.collect()}
    assert {k: v[1] for k, v in got.items()} == {(i, n + 1): x[1] for i, w in enumerate(want) for n, x in enumerate(w)}


def test_numbers_that_are_null_or_not_finite(spark):
    rows = [(0, [1.0, None]), (1, [0.5, 2.0])]
    assert not tiles.floats(spark.createDataFrame(rows, "id long, v array<double>"))
    rows = [(0, [1.0, float("inf")]), (1, [0.5, float("nan")]), (2, None)]
    assert tiles.floats(spark.createDataFrame(rows, "id long, v array<double>"))
    assert not tiles.floats(spark.createDataFrame([(0, [1e300])], "id long, v array<double>"))


def test_a_query_goes_once_to_a_slice_of_codes(spark):
    m = np.random.default_rng(4).normal(size=(60, 4))
    df = made(spark, m)
    index = QuantisedIndex(df, "id", leaves=6, parts=2, codes=4)
    asked = index.probes(df, 5, "<f8")
    assert asked.count() == 60  # a row for each leaf before, 300
    assert {len(x.leaf) // 4 for x in asked.select("leaf").collect()} == {5}
    text = plan(index.search(df, 3, 5, 10))
    assert re.search(r"explode\(sequence\(0, 0", text)
    assert index.search(df, 3, 6, 60).where(F.col("query_key") == F.col("match_key")).count() > 0
