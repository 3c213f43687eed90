"""Models (M1-M10). What SQL can say of a fitted model is compared: rows, positives and whether it beats the base rate."""

from __future__ import annotations

from pyspark.sql import functions as F

from tastemill.functions import scalar as fx
from tastemill.operators import learning as g
from tastemill.operators import metrics as m
from tastemill.operators import sequences as s
from tastemill.operators.features import fit_encoder
from tastemill.plans import tables as t
from tastemill.plans.registry import query
from tastemill.session import for_training, scratch_path

NUMERIC = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
CATEGORICAL = ["l_linestatus", "o_orderpriority"]


def rows(spark, sf):
    """Order lines of all orders, label: the order is large; split by hash."""
    li = t.table(spark, sf, "lineitem")
    od = t.table(spark, sf, "orders")
    out = li.join(od, li.l_orderkey == od.o_orderkey).select(
        *NUMERIC,
        *CATEGORICAL,
        "l_returnflag",
        "l_orderkey",
        "l_linenumber",
        "l_suppkey",
        (F.col("l_extendedprice") * (1 - F.col("l_discount")) > 30000).cast("double").alias("label"),
    )
    return for_training(s.random_split(out, 0.8, "l_orderkey", "l_linenumber", "l_suppkey"))


KEYS = ("l_orderkey", "l_linenumber", "l_suppkey")
BUCKET = t.bucket_sql(10000, *KEYS)
LABEL = "l_extendedprice * (1 - l_discount) > 30000"
SPLIT = f"CASE WHEN {BUCKET} < 8000 THEN 'train' ELSE 'test' END"
REPORT_SQL = """SELECT {split} AS split, count(*) AS n, CAST(sum(({label})::INT) AS BIGINT) AS positives, true AS better
FROM lineitem JOIN orders ON o_orderkey = l_orderkey GROUP BY 1"""


def _report(scored):
    return m.against_base_rate(scored, ["split"], "label", "p")


def _fit_report(spark, sf, pipeline):
    data = rows(spark, sf)
    model = pipeline.fit(data.filter("split = 'train'"))
    return _report(g.probability(model.transform(data)))


@query("M1_boosted_trees", REPORT_SQL.format(split=SPLIT, label=LABEL))
def boosted_trees(spark, sf):
    """Train and test against the base rate; the smallest number of trees and depth that is usual."""
    return _fit_report(spark, sf, g.tree_pipeline(NUMERIC, CATEGORICAL, trees=10, depth=4))


@query("M2_leaf_features", REPORT_SQL.format(split=SPLIT, label=LABEL))
def leaf_features(spark, sf):
    """Trees' leaves as indicators of a logistic regression, train and test against the base rate."""
    data = rows(spark, sf)
    enc = fit_encoder(data.filter("split = 'train'"), NUMERIC, CATEGORICAL)
    encoded = for_training(enc.transform(data).select("split", "label", "features"))
    model = g.LeafFeatures(encoded.filter("split = 'train'"), trees=5, depth=3)
    return _report(model.score(encoded))


def _customers(spark, sf):
    """Customers with order statistics; label: balance above 4500."""
    n = t.table(spark, sf, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(
        F.count(F.lit(1)).cast("double").alias("orders"), F.avg("o_totalprice").alias("price")
    )
    c = t.table(spark, sf, "customer").join(n, "c_custkey", "left").fillna(0.0, ["orders", "price"])
    c = c.withColumn("label", (F.col("c_acctbal") > 4500).cast("double"))
    data = fit_encoder(c, ["orders", "price", "c_nationkey"], ["c_mktsegment"]).transform(c)
    return s.folds(data.select("c_custkey", "features", "label"), 5, "c_custkey")


@query("M3_grid_search")
def grid_search(spark, sf):
    """27 settings by 5-fold AUC."""
    data = _customers(spark, sf).withColumn("fold", F.col("fold").cast("int"))
    grid = {"maxDepth": [2, 3, 4], "stepSize": [0.05, 0.1, 0.3], "subsamplingRate": [0.6, 0.8, 1.0]}
    cv = g.grid_search(for_training(data), g.boosted_trees(trees=3), grid, "fold", 5, parallelism=8)
    return g.settings_table(spark, cv.getEstimatorParamMaps(), cv.avgMetrics)


@query("M4_random_search")
def random_search(spark, sf):
    """30 random settings on a held-out fifth."""
    ranges = {"maxDepth": (2, 4), "stepSize": (0.05, 0.4)}
    found = g.random_search(for_training(_customers(spark, sf)), g.boosted_trees(trees=3), ranges, trials=30, parallelism=8)
    return g.settings_table(spark, found.getEstimatorParamMaps(), found.validationMetrics)


@query("M5_wide_model", REPORT_SQL.format(split=SPLIT, label=LABEL))
def wide_model(spark, sf):
    """Hashed categories and a cross, train and test against the base rate."""
    data = g.with_crosses(rows(spark, sf), [("l_returnflag", "o_orderpriority")])
    _, pipeline = g.wide_pipeline(["l_linestatus"], NUMERIC, [("l_returnflag", "o_orderpriority")])
    model = pipeline.fit(data.filter("split = 'train'"))
    return _report(g.probability(model.transform(data)))


@query("M6_deep_model", REPORT_SQL.format(split=SPLIT, label=LABEL))
def deep_model(spark, sf):
    """Perceptron on numbers and one-hot line status; its width is that of the fitted features."""
    data = rows(spark, sf)
    model = g.deep_model(data.filter("split = 'train'"), NUMERIC, ["l_linestatus"], rounds=30)
    return _report(g.probability(model.transform(data)))


@query("M7_crossed_linear", "SELECT 0.0::DOUBLE AS rmse, 1.0::DOUBLE AS r2")
def crossed_linear(spark, sf):
    """Net price from price, discount and their products: the target is one of the crosses, so nothing is left over."""
    li = t.table(spark, sf, "lineitem").withColumn("net", F.col("l_extendedprice") * (1 - F.col("l_discount")))
    model = g.crossed_linear(["l_extendedprice", "l_discount"], "net").fit(li)
    return m.rating_errors(model.transform(li), "net", "prediction").select(
        fx.tidy("rmse", 2).alias("rmse"), fx.tidy("r2", 4).alias("r2")
    )


@query("M8_ridge", """
WITH s AS (SELECT covar_pop(l_quantity, l_extendedprice) AS xy, var_pop(l_quantity) AS xx, avg(l_quantity) AS mx,
  avg(l_extendedprice) AS my, var_samp(l_quantity) AS vx, stddev_samp(l_extendedprice) AS sy, count(*) AS n FROM lineitem),
k AS (SELECT xy / (xx + 0.1::DOUBLE / sy * vx) AS b, mx, my FROM s)
SELECT round_even(b, 1) AS slope, round_even(my - b * mx, 0) AS intercept FROM k""")
def ridge(spark, sf):
    """Price from quantity: slope and intercept."""
    model = g.ridge(["l_quantity"], "l_extendedprice").fit(t.table(spark, sf, "lineitem")).stages[-1]
    return t.table(spark, sf, "lineitem").agg(F.count(F.lit(1)).alias("n")).select(
        fx.tidy(F.lit(float(model.coefficients[0])), 1).alias("slope"),
        fx.tidy(F.lit(float(model.intercept)), 0).alias("intercept"),
    )


NOISE = t.bucket_sql(10, *KEYS, seed=7)


@query("M9_early_stopping", "SELECT *, true AS stopped FROM (" + REPORT_SQL.format(
    split=f"CASE WHEN {BUCKET} < 6000 THEN 'train' WHEN {BUCKET} < 8000 THEN 'valid' ELSE 'test' END",
    label=f"CASE WHEN {NOISE} < 3 THEN NOT ({LABEL}) ELSE ({LABEL}) END") + ")")
def early_stopping(spark, sf):
    """Trees grown until a validation part stops gaining, reported on all three parts; three labels in ten are wrong."""
    bucket = fx.seeded_bucket(10000, *KEYS)
    split = F.when(bucket < 6000, "train").when(bucket < 8000, "valid").otherwise("test")
    wrong = fx.seeded_bucket(10, *KEYS, seed=7) < 3
    data = rows(spark, sf).withColumn("split", split).withColumn("held", F.col("split") == "valid")
    data = data.withColumn("label", F.when(wrong, 1.0 - F.col("label")).otherwise(F.col("label")))
    grown = g.tree_pipeline(NUMERIC, CATEGORICAL, trees=40, depth=4, validation="held").fit(data.filter("split <> 'test'"))
    report = _report(g.probability(grown.transform(data)))
    return report.withColumn("stopped", F.lit(int(grown.stages[-1].getNumTrees) < 40))


@query("M10_save_and_reload", f"SELECT {SPLIT} AS split, count(*) AS n, 0.0::DOUBLE AS apart FROM lineitem GROUP BY 1")
def save_and_reload(spark, sf):
    """Greatest difference between the probabilities of a row before and after a save and load."""
    data = rows(spark, sf)
    model = g.tree_pipeline(NUMERIC, CATEGORICAL, trees=3, depth=3).fit(data.filter("split = 'train'"))
    again = g.saved_and_loaded(model, scratch_path(spark, "model"))
    before = g.probability(model.transform(data), "before").select(*data.columns, "before")
    both = g.probability(again.transform(before), "after")
    return both.groupBy("split").agg(
        F.count(F.lit(1)).alias("n"), F.max(F.abs(F.col("before") - F.col("after"))).alias("apart")
    )
