"""Fitted models must learn what is there to learn."""

from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from tastemill.operators import factors as fa
from tastemill.operators import machines as fm
from tastemill.operators import features as f
from tastemill.operators import learning as g
from tastemill.operators import losses
from tastemill.operators import metrics as m


@pytest.fixture(scope="module")
def rows(spark):
    rnd = random.Random(8)
    data = []
    for i in range(800):
        x, y, c = rnd.random(), rnd.random(), rnd.choice("abc")
        data.append((i, x, y, c, float(x * y + (0.3 if c == "a" else 0.0) > 0.35), i % 4 == 0))
    return spark.createDataFrame(data, "id int, x double, y double, c string, label double, held boolean").cache()


def area(scored):
    return m.auc(scored, "label", "p").first().auc


def test_trees_and_leaf_features(rows):
    model = g.tree_pipeline(["x", "y"], ["c"], trees=8, depth=3).fit(rows)
    assert area(g.probability(model.transform(rows))) > 0.95
    enc = f.fit_encoder(rows, ["x", "y"], ["c"]).transform(rows)
    leaves = g.LeafFeatures(enc, trees=6, depth=3)
    assert area(leaves.score(enc).withColumn("p", F.round("p", 6))) > 0.95


def test_wide_and_deep_parts(rows):
    data = g.with_crosses(rows.withColumn("d", F.floor(F.col("x") * 4).cast("string")), [("c", "d")])
    _, wide = g.wide_pipeline(["c"], ["x", "y"], [("c", "d")], size=256)
    assert area(g.probability(wide.fit(data).transform(data))) > 0.9
    deep = g.deep_model(rows, ["x", "y"], ["c"], rounds=60)
    assert area(g.probability(deep.transform(rows))) > 0.9


def test_searches(rows):
    enc = f.fit_encoder(rows, ["x", "y"], ["c"]).transform(rows).withColumn("fold", F.col("id") % 2)
    cv = g.grid_search(enc, g.boosted_trees(trees=2), {"maxDepth": [1, 3]}, "fold", 2)
    assert cv.avgMetrics[1] > cv.avgMetrics[0]
    found = g.random_search(enc, g.boosted_trees(trees=2), {"maxDepth": (1, 3), "stepSize": (0.1, 0.3)}, trials=3)
    assert len(found.validationMetrics) == 3


def test_early_stopping_keeps_fewer_trees(rows):
    noise = rows.withColumn("label", (F.hash("id") % 2 == 0).cast("double"))
    model = g.tree_pipeline(["x"], [], trees=30, depth=2, validation="held").fit(noise)
    assert model.stages[-1].getNumTrees < 30


def test_linear_models(spark, rows):
    data = rows.withColumn("z", 2 * F.col("x") * F.col("y") + F.col("x"))
    fit = g.crossed_linear(["x", "y"], "z").fit(data).transform(data)
    assert m.rating_errors(fit, "z", "prediction").first().r2 > 0.999
    line = g.ridge(["x"], "z", 0.0).fit(data).stages[-1]
    assert 1.5 < line.coefficients[0] < 2.5


def test_save_and_reload(rows, tmp_path):
    model = g.tree_pipeline(["x", "y"], ["c"], trees=2, depth=2).fit(rows)
    again = g.saved_and_loaded(model, str(tmp_path / "m"))
    a = {x.id: x.p for x in g.probability(model.transform(rows)).select("id", "p").collect()}
    b = {x.id: x.p for x in g.probability(again.transform(rows)).select("id", "p").collect()}
    assert a == b


@pytest.fixture(scope="module")
def tastes(spark):
    """Two groups of users, each likes its own half of the items."""
    rnd = random.Random(6)
    data = []
    for u in range(40):
        for i in rnd.sample(range(30), 18):
            good = (u % 2) == (i % 2)
            data.append((f"u{u}", 10**12 + i, 4.5 if good else 1.5, float(good)))
    return spark.createDataFrame(data, "user_id string, item_id long, rating double, label double")


def test_bias_model(tastes):
    model = fa.BiasModel(tastes)
    machine = fm.fit(tastes, ["user_id", "item_id"], "rating", rank=4, rounds=8)
    fitted = m.rating_errors(machine.score(tastes)).first().rmse
    base = m.rating_errors(model.baseline(tastes).withColumnRenamed("baseline", "prediction")).first().rmse
    assert fitted < 0.5 * base
    nobody = tastes.sparkSession.createDataFrame([("nobody", 1)], "user_id string, item_id long")
    mean = pytest.approx(tastes.agg(F.avg("rating")).first()[0])
    assert model.baseline(nobody).first().baseline == mean and machine.score(nobody).first().prediction == mean


def test_implicit_factors_find_the_own_half(tastes):
    users, items = fa.implicit_factors(fa.dense_ids(tastes.filter("label = 1")), rank=4)
    out = fa.top_n_by_cosine(users, items, 5).collect()
    right = sum((int(x.user_id[1:]) % 2) == (x.item_id % 2) for x in out)
    assert right / len(out) > 0.9


def plain_machine(rows, columns, rank, rounds, reg, decay, start):
    """Round by round with dictionaries; rows are (ids, target)."""
    mu = sum(y for _, y in rows) / len(rows)
    tables = [{i: np.concatenate([[w], v]) for i, w, v in start(c)} for c in columns]
    for n in range(rounds):
        for k in range(len(columns)):
            a, b = {}, {}
            for ids, y in rows:
                sides = [tables[o][ids[o]] for o in range(len(columns)) if o != k]
                z = np.concatenate([[1.0], sum(s[1:] for s in sides)])
                pairs = sum(sides[p][1:] @ sides[q][1:] for p in range(len(sides)) for q in range(p))
                r = y - mu - sum(s[0] for s in sides) - pairs
                a[ids[k]] = a.get(ids[k], reg * np.eye(rank + 1)) + np.outer(z, z)
                b[ids[k]] = b.get(ids[k], 0) + r * z
            tables[k] = {i: t + decay**n * (np.linalg.solve(a[i], b[i]) - t) for i, t in tables[k].items()}
    return mu, tables


def test_machine_of_three_columns_with_a_hot_id_and_nulls(spark):
    rnd = random.Random(4)
    data = [("hot" if rnd.random() < 0.4 else rnd.choice(["a", "b", None]), rnd.choice([*range(9), None]), rnd.choice("xyz")) for _ in range(400)]
    data = [(*d, float(rnd.gauss((d[1] or 0) * 0.3, 1))) for d in data]
    rows = spark.createDataFrame(data, "u string, i long, c string, y double")
    columns = ["u", "i", "c"]
    model = fm.fit(rows.repartition(5), columns, "y", rank=3, rounds=3, reg=0.5, decay=0.8)

    def start(c):
        return [(r.id, r.w, r.v) for r in fm.first_factors(rows, c, 3, 42).collect()]

    mu, tables = plain_machine([(d[:3], d[3]) for d in data], columns, 3, 3, 0.5, 0.8, start)
    assert model.mu == pytest.approx(mu)
    for c, want in zip(columns, tables, strict=True):
        got = {r.id: [r.w, *r.v] for r in model.tables[c].collect()}
        assert got.keys() == want.keys()
        for k, t in want.items():
            assert got[k] == pytest.approx(t.tolist(), abs=1e-9)
    scored = model.score(rows.withColumn("w_0", F.lit(1)).drop("w_0")).collect()
    for r in scored[:40]:
        t = [tables[k][r[c]] for k, c in enumerate(columns)]
        pairs = sum(t[p][1:] @ t[q][1:] for p in range(3) for q in range(p))
        assert r.prediction == pytest.approx(mu + sum(x[0] for x in t) + pairs, abs=1e-9)


def test_machine_of_rank_fifty_and_its_vectors(tastes):
    e = tastes.withColumn("y", F.col("label"))
    model = fm.fit(e, ["user_id", "item_id"], "y", rank=50, rounds=4, reg=1.0)
    scored = model.score(e, "p").withColumn("p", F.round("p", 6))
    assert area(scored) > 0.9
    uv = {r.key: r.v for r in model.vectors("user_id", False).collect()}
    iv = {r.key: r.v for r in model.vectors("item_id", True).collect()}
    weight = {r.id: r.w for r in model.tables["user_id"].collect()}
    for r in model.score(e, "p").limit(50).collect():
        assert sum(a * b for a, b in zip(uv[r.user_id], iv[r.item_id])) + weight[r.user_id] + model.mu == pytest.approx(r.p, abs=1e-9)


def test_machine_without_rows(tastes):
    none = fm.fit(tastes.where("false"), ["user_id", "item_id"], "rating", rank=2, rounds=1)
    assert none.mu == 0.0 and none.score(tastes.limit(3)).select("prediction").distinct().collect()[0][0] == 0.0


def test_sequence_embeddings(tastes):
    cells = fa.sequence_embeddings(tastes.withColumn("ts", F.lit(0)).filter("label = 1"), ["ts", "item_id"], size=64).collect()
    vectors: dict[int, dict[int, float]] = {}
    for c in cells:
        vectors.setdefault(c.item_id % 10**12, {})[c.dim] = c.x
    assert sorted(vectors) == list(range(30)) and all(len(v) == 64 for v in vectors.values())

    def cosine(a, b):
        dot = sum(vectors[a][d] * vectors[b][d] for d in range(64))
        return dot / (sum(x * x for x in vectors[a].values()) * sum(x * x for x in vectors[b].values())) ** 0.5

    own = [cosine(a, b) for a in range(30) for b in range(a) if (a - b) % 2 == 0]
    other = [cosine(a, b) for a in range(30) for b in range(a) if (a - b) % 2]
    assert sum(own) / len(own) > 0.2 + sum(other) / len(other)  # met by the same users


@pytest.mark.parametrize("tile_rows", [7, 4_096])
def test_in_batch_softmax_in_tiles(spark, tile_rows):
    rng = np.random.default_rng(3)
    u, i, w = rng.normal(size=(60, 5)) * 4, rng.normal(size=(60, 5)) * 4, rng.random(60)
    batch = [None if k < 20 else 1 for k in range(60)]
    data = [(b, x.tolist(), y.tolist(), float(z)) for b, x, y, z in zip(batch, u, i, w, strict=True)]
    rows = spark.createDataFrame(data, "b int, u array<double>, i array<double>, w double")
    got = {r.b: r.loss for r in losses.in_batch_softmax(rows, "b", "u", "i", "w", tile_rows).collect()}
    for b, at in ((None, slice(0, 20)), (1, slice(20, 60))):
        z = u[at] @ i[at].T
        want = ((np.log(np.exp(z).sum(axis=1)) - np.diag(z)) * w[at]).mean()
        assert got[b] == pytest.approx(want, abs=1e-6)


@pytest.mark.parametrize("products", [0, 10**6])
def test_ids_that_fit_a_task_are_solved_like_ranged_ones(spark, monkeypatch, products):
    monkeypatch.setattr(fm, "PRODUCTS", products)
    rnd = np.random.default_rng(5)
    ids = [None if x == 0 else f"id_{x}" for x in rnd.integers(0, 9, 300).tolist()]
    z, r = rnd.normal(size=(300, 3)), rnd.normal(size=300)
    rows = spark.createDataFrame(list(zip(ids, z.tolist(), r.tolist(), strict=True)), "id string, z array<double>, r double")
    for whole in (True, False):
        found = fm.solved(rows, 3, 0.5, whole).collect()
        assert len(found) == len(set(ids))
        for x in found:
            mine = np.array([i == x.id for i in ids])
            want = np.linalg.solve(z[mine].T @ z[mine] + 0.5 * np.eye(3), r[mine] @ z[mine])
            assert x.theta == pytest.approx(want.tolist())
