"""Metrics (N1-N14)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tastemill.functions import scalar as fx
from tastemill.operators import features as f
from tastemill.operators import metrics as m
from tastemill.operators import sequences as s
from tastemill.operators import windows as w
from tastemill.operators.ordering import top_k
from tastemill.operators.similarity import drop_seen
from tastemill.plans import tables as t
from tastemill.plans.registry import query

# Train: three quarters of the pairs by hash. Suggestions: the ten most taken
# unseen items of the customer's nation. Truth: the other pairs.
REC_SQL = (
    t.RATINGS_SQL
    + f""", sp AS (SELECT *, {t.bucket_sql(10000, 'user_id', 'item_id')} < 7500 AS tr FROM ratings),
train AS (SELECT user_id, item_id, rating FROM sp WHERE tr), truth AS (SELECT user_id, item_id, rating FROM sp WHERE NOT tr),
nat AS (SELECT c_custkey AS user_id, c_nationkey FROM customer),
pop AS (SELECT c_nationkey, item_id, count(*) AS n FROM train JOIN nat USING (user_id) GROUP BY 1, 2
  QUALIFY row_number() OVER (PARTITION BY c_nationkey ORDER BY count(*) DESC, item_id) <= 30),
recs AS (SELECT user_id, item_id, row_number() OVER (PARTITION BY user_id ORDER BY n DESC, item_id) AS rank
  FROM nat JOIN pop USING (c_nationkey)
  WHERE NOT EXISTS (SELECT 1 FROM train t WHERE t.user_id = nat.user_id AND t.item_id = pop.item_id) QUALIFY rank <= 10)"""
)


def split_and_recs(spark, sf):
    sp = s.random_split(t.ratings(spark, sf), 0.75, "user_id", "item_id")
    train = sp.filter("split = 'train'").select("user_id", "item_id", "rating")
    truth = sp.filter("split = 'test'").select("user_id", "item_id", "rating")
    nat = t.table(spark, sf, "customer").select(F.col("c_custkey").alias("user_id"), "c_nationkey")
    counts = train.join(nat, "user_id").groupBy("c_nationkey", "item_id").agg(F.count(F.lit(1)).alias("n"))
    pop = top_k(counts, ["c_nationkey"], [F.desc("n"), "item_id"], 30).drop("rank")
    unseen = drop_seen(nat.join(pop, "c_nationkey"), train)
    recs = top_k(unseen, ["user_id"], [F.desc("n"), "item_id"], 10).select("user_id", "item_id", "rank")
    return train, truth, recs


@query("N1_recall_precision", "WITH " + REC_SQL + """,
a AS (SELECT recs.* FROM recs WHERE user_id IN (SELECT user_id FROM truth)),
h AS (SELECT count(*) AS h FROM a JOIN truth USING (user_id, item_id))
SELECT round_even(h * 100.0::DOUBLE / (SELECT count(*) FROM truth), 2) AS recall,
  round_even(h * 100.0::DOUBLE / (SELECT count(*) FROM a), 2) AS precision FROM h""")
def recall_precision(spark, sf):
    _, truth, recs = split_and_recs(spark, sf)
    return m.recall_precision(recs, truth)


@query("N2_coverage", "WITH " + REC_SQL + """
SELECT round_even(count(DISTINCT item_id) * 100.0::DOUBLE / (SELECT count(DISTINCT item_id) FROM train
  WHERE user_id IN (SELECT user_id FROM recs)), 2) AS coverage FROM recs""")
def coverage(spark, sf):
    train, _, recs = split_and_recs(spark, sf)
    return m.coverage(recs, train)


@query("N3_popularity", "WITH " + REC_SQL + """, c AS (SELECT item_id, count(*) AS n FROM train GROUP BY 1)
SELECT round_even(avg(ln(1.0::DOUBLE + coalesce(n, 0))), 6) AS popularity FROM recs LEFT JOIN c USING (item_id)""")
def popularity(spark, sf):
    train, _, recs = split_and_recs(spark, sf)
    return m.mean_popularity(recs, train)


@query("N4_hit_rate", "WITH " + REC_SQL + """
SELECT round_even((SELECT count(*) FROM recs JOIN truth USING (user_id, item_id) WHERE rank <= 5)::DOUBLE
  / (SELECT count(*) FROM truth), 6) AS hit_rate""")
def hit_rate(spark, sf):
    _, truth, recs = split_and_recs(spark, sf)
    return m.hit_rate(recs, truth, 5)


RANK_SQL = "WITH " + t.RAW_SQL + """,
sc AS (SELECT user_id, item_id, sum(rating) AS score FROM raw GROUP BY 1, 2),
l AS (SELECT user_id, item_id FROM raw QUALIFY row_number() OVER
  (PARTITION BY user_id ORDER BY ts DESC, order_id DESC, line_no DESC, supp_id DESC, item_id DESC) = 1),
r AS (SELECT user_id, item_id, rank() OVER (PARTITION BY user_id ORDER BY score DESC) AS rank FROM sc),
ranks AS (SELECT rank FROM r JOIN l USING (user_id, item_id))"""


def _ranks(spark, sf):
    raw = t.raw_interactions(spark, sf)
    scored = raw.groupBy("user_id", "item_id").agg(F.sum("rating").alias("score"))
    truth = w.last_value_per(raw, "user_id", "item_id", ["ts", "order_id", "line_no", "supp_id", "item_id"], "item_id")
    return w.competition_rank(scored, truth, ["user_id"], "item_id")


@query("N5_mrr", RANK_SQL + " SELECT round_even(avg(1.0::DOUBLE / rank), 6) AS mrr FROM ranks")
def mrr(spark, sf):
    return m.mrr(_ranks(spark, sf))


@query("N6_recall_at_cuts", RANK_SQL + " SELECT " + ", ".join(
    f"round_even(avg((rank <= {k})::INT::DOUBLE), 6) AS recall_{k}" for k in (1, 5, 10, 50)) + " FROM ranks")
def recall_at_cuts(spark, sf):
    return m.recall_at(_ranks(spark, sf))


@query("N7_ranking_at_k", "WITH " + REC_SQL + """,
sz AS (SELECT user_id, count(*) AS rel FROM truth GROUP BY 1),
h AS (SELECT user_id, rank, row_number() OVER (PARTITION BY user_id ORDER BY rank) AS i FROM recs JOIN truth USING (user_id, item_id)),
p AS (SELECT user_id, count(*) AS h, sum(i::DOUBLE / rank) AS ap, sum(1.0::DOUBLE / log2(rank + 1.0::DOUBLE)) AS dcg FROM h GROUP BY 1)
SELECT round_even(avg(coalesce(ap / least(rel, 10), 0)), 6) AS map,
  round_even(avg(coalesce(dcg / list_sum([1.0::DOUBLE / log2(g + 1.0::DOUBLE) FOR g IN generate_series(1, least(rel, 10))]), 0)), 6) AS ndcg,
  round_even(avg(coalesce(h / 10.0::DOUBLE, 0)), 6) AS precision, round_even(avg(coalesce(h::DOUBLE / rel, 0)), 6) AS recall
FROM sz LEFT JOIN p USING (user_id)""")
def ranking_at_k(spark, sf):
    _, truth, recs = split_and_recs(spark, sf)
    return m.ranking_at_k(recs, truth, 10)


PAIR_SQL = "WITH " + REC_SQL + """, im AS (SELECT item_id, avg(rating) AS prediction FROM train GROUP BY 1),
pairs AS (SELECT rating, prediction, user_id, item_id FROM truth JOIN im USING (item_id))"""


def _pairs(spark, sf):
    """Test ratings with the item's train mean as prediction."""
    train, truth, _ = split_and_recs(spark, sf)
    return truth.join(train.groupBy("item_id").agg(F.avg("rating").alias("prediction")), "item_id")


@query("N8_rating_errors", PAIR_SQL + """
SELECT round_even(sqrt(avg((rating - prediction) * (rating - prediction))), 6) AS rmse, round_even(avg(abs(rating - prediction)), 6) AS mae,
 round_even(1.0::DOUBLE - avg((rating - prediction) * (rating - prediction)) / var_pop(rating), 6) AS r2,
 round_even(1.0::DOUBLE - var_pop(rating - prediction) / var_pop(rating), 6) AS explained_variance FROM pairs""")
def rating_errors(spark, sf):
    return m.rating_errors(_pairs(spark, sf))


@query("N9_log_loss", PAIR_SQL + """, b AS (SELECT min(prediction) AS lo, max(prediction) AS hi FROM pairs),
q AS (SELECT (rating >= 25)::INT AS y, least(greatest((prediction - lo) / (hi - lo), 1e-15::DOUBLE), 1.0::DOUBLE - 1e-15::DOUBLE) AS p FROM pairs, b)
SELECT round_even(-avg(y * ln(p) + (1 - y) * ln(1.0::DOUBLE - p)), 5) AS log_loss FROM q""")
def log_loss(spark, sf):
    """Predictions scaled to 0..1 first."""
    scaled = f.min_max(_pairs(spark, sf), "prediction", "p").withColumn("y", (F.col("rating") >= 25).cast("int"))
    return m.log_loss(scaled, "y", "p").select(fx.tidy("log_loss", 5).alias("log_loss"))


SCORE_SQL = f"""sc AS (SELECT event_id, (event_type IN ('click', 'purchase'))::INT AS y,
  round_even(1.0::DOUBLE / (1.0::DOUBLE + exp(-(value - 60) / 50)), 2) AS p,
  CASE WHEN {t.bucket_sql(10000, 'event_id')} < 8000 THEN 'train' ELSE 'test' END AS split FROM events)"""


def _scored(spark, sf):
    p = fx.tidy(fx.sigmoid((F.col("value") - 60) / 50), 2)
    e = t.table(spark, sf, "events").select(
        "event_id", F.col("event_type").isin("click", "purchase").cast("int").alias("y"), p.alias("p")
    )
    return s.random_split(e, 0.8, "event_id")


@query("N10_auc", f"""WITH {SCORE_SQL}, r AS (SELECT y, rank() OVER (ORDER BY p) + (count(*) OVER (PARTITION BY p) - 1) / 2.0::DOUBLE AS r FROM sc)
SELECT round_even((sum(r) FILTER (y = 1) - sum(y) * (sum(y) + 1) / 2.0::DOUBLE) / (sum(y)::DOUBLE * sum(1 - y)), 6) AS auc FROM r""")
def auc(spark, sf):
    return m.auc(_scored(spark, sf), "y", "p")


@query("N11_accuracy", f"WITH {SCORE_SQL} SELECT round_even(avg(((p >= 0.5)::INT = y)::INT::DOUBLE), 6) AS accuracy FROM sc")
def accuracy(spark, sf):
    return m.accuracy(_scored(spark, sf), "y", "p")


@query("N12_classification_report", f"""WITH {SCORE_SQL},
r AS (SELECT *, rank() OVER (PARTITION BY split ORDER BY p) + (count(*) OVER (PARTITION BY split, p) - 1) / 2.0::DOUBLE AS r, p >= 0.5 AS z FROM sc)
SELECT split, round_even(avg((z::INT = y)::INT::DOUBLE), 6) AS accuracy,
 round_even(count(*) FILTER (z AND y = 1)::DOUBLE / count(*) FILTER (z), 6) AS precision,
 round_even(count(*) FILTER (z AND y = 1)::DOUBLE / count(*) FILTER (y = 1), 6) AS recall,
 round_even(2.0::DOUBLE * count(*) FILTER (z AND y = 1) / (2 * count(*) FILTER (z AND y = 1) + count(*) FILTER (z AND y = 0)
   + count(*) FILTER (NOT z AND y = 1)), 6) AS f1,
 round_even((sum(r) FILTER (y = 1) - sum(y) * (sum(y) + 1) / 2.0::DOUBLE) / (sum(y)::DOUBLE * sum(1 - y)), 6) AS auc
FROM r GROUP BY 1""")
def classification_report(spark, sf):
    return m.classification_report(_scored(spark, sf), "split", "y", "p")


@query("N13_top_100_accuracy", RANK_SQL + " SELECT round_even(avg((rank <= 100)::INT::DOUBLE), 6) AS recall_100 FROM ranks")
def top_100_accuracy(spark, sf):
    return m.recall_at(_ranks(spark, sf), (100,))


LIST_SQL = """ls AS (SELECT l_orderkey, l_linenumber || '-' || l_suppkey || '-' || l_partkey || '-' || l_quantity::INT AS tie, l_extendedprice AS score,
  CASE WHEN l_linestatus = 'F' AND l_returnflag = 'N' THEN -1.0 WHEN l_quantity >= 40 THEN 2.0 WHEN l_quantity >= 20 THEN 1.0 ELSE 0.0 END::DOUBLE AS label
  FROM lineitem)"""


def lists(spark, sf):
    """Order lines as lists: graded by quantity, scored by price, some marked as padding."""
    grade = (
        F.when((F.col("l_linestatus") == "F") & (F.col("l_returnflag") == "N"), -1.0)
        .when(F.col("l_quantity") >= 40, 2.0)
        .when(F.col("l_quantity") >= 20, 1.0)
        .otherwise(0.0)
    )
    return t.table(spark, sf, "lineitem").select(
        "l_orderkey",
        F.concat_ws("-", "l_linenumber", "l_suppkey", "l_partkey", F.col("l_quantity").cast("int")).alias("tie"),
        F.col("l_extendedprice").alias("score"),
        grade.alias("label"),
    )


def _ndcg_sql() -> str:
    def part(order: str, p: str) -> str:
        cells = ", ".join(
            f"sum(CASE WHEN r <= {k} THEN (pow(2.0::DOUBLE, label) - 1) / log2(r + 1.0::DOUBLE) ELSE 0 END) AS {p}{k}"
            for k in (1, 3, 5, 10)
        )
        return f"""(SELECT l_orderkey, {cells} FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY {order}, tie) AS r
  FROM ls WHERE label >= 0) GROUP BY 1)"""

    out = ", ".join(f"round_even(avg(d{k} / i{k}), 6) AS ndcg_{k}" for k in (1, 3, 5, 10))
    return f"WITH {LIST_SQL} SELECT {out} FROM {part('score DESC', 'd')} a JOIN {part('label DESC', 'i')} b USING (l_orderkey) WHERE i10 > 0"


@query("N14_list_ndcg", _ndcg_sql())
def list_ndcg(spark, sf):
    return m.list_ndcg(lists(spark, sf), ["l_orderkey"], "label", "score", "tie", (1, 3, 5, 10))
