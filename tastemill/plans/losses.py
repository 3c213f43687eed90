"""Losses (O1-O5)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tastemill.functions import vector as vx
from tastemill.operators import losses as o
from tastemill.operators import retrieval as r
from tastemill.plans import tables as t
from tastemill.plans.metrics import LIST_SQL, lists
from tastemill.plans.registry import query

PAIR_SQL = """pr AS (SELECT l_quantity / 10 AS pos, l_discount * 50 AS neg FROM lineitem)"""


def _pairs(spark, sf):
    return t.table(spark, sf, "lineitem").select((F.col("l_quantity") / 10).alias("pos"), (F.col("l_discount") * 50).alias("neg"))


@query("O1_bpr", f"""WITH {PAIR_SQL}
SELECT round_even(sum(ln(1.0::DOUBLE + exp(-(pos - neg)))), 4) AS bpr_sum, round_even(avg(ln(1.0::DOUBLE + exp(-(pos - neg)))), 6) AS bpr_mean FROM pr""")
def bpr(spark, sf):
    return o.bpr(_pairs(spark, sf), "pos", "neg")


@query("O2_pairwise_hinge", f"WITH {PAIR_SQL} SELECT round_even(sum(greatest(0.0::DOUBLE, 1.0::DOUBLE - (pos - neg))), 4) AS hinge FROM pr")
def pairwise_hinge(spark, sf):
    return o.pairwise_hinge(_pairs(spark, sf), "pos", "neg")


@query("O3_top1", f"""WITH {PAIR_SQL}
SELECT round_even(avg(1.0::DOUBLE / (1.0::DOUBLE + exp(pos - neg)) + 1.0::DOUBLE / (1.0::DOUBLE + exp(-neg * neg))), 6) AS top1 FROM pr""")
def top1(spark, sf):
    return o.top1(_pairs(spark, sf), "pos", "neg")


@query("O4_in_batch_softmax", """
WITH e AS (SELECT vec_id, vec_id // 128 AS batch, embedding::DOUBLE[] AS v, greatest(label * 0.1::DOUBLE, 1e-6::DOUBLE) AS fl FROM embeddings),
w AS (SELECT *, fl / max(fl) OVER (PARTITION BY batch) AS weight, v[1:32] AS u, v[33:64] AS i FROM e),
z AS (SELECT a.batch, a.vec_id, any_value(a.weight) AS weight, ln(sum(exp(list_dot_product(a.u, b.i)))) AS lse,
  sum(CASE WHEN a.vec_id = b.vec_id THEN list_dot_product(a.u, b.i) ELSE 0 END) AS own
  FROM w a JOIN w b USING (batch) GROUP BY 1, 2)
SELECT batch, round_even(avg((lse - own) * weight), 6) AS loss FROM z GROUP BY 1""")
def in_batch_softmax(spark, sf):
    """Halves of the vectors as user and item, batches of 128, weighted by the normalised value."""
    v = F.col("v")
    e = t.table(spark, sf, "embeddings").select(
        F.floor(F.col("vec_id") / 128).alias("batch"),
        (F.col("label") * F.lit(0.1)).alias("value"),
        vx.as_double("embedding").alias("v"),
    )
    w = r.normalised_value(e, "value", "batch")
    rows = w.select("batch", "weight", F.slice(v, 1, 32).alias("u"), F.slice(v, 33, 32).alias("i"))
    return o.in_batch_softmax(rows, "batch", "u", "i", "weight")


REAL_SQL = f"WITH {LIST_SQL}, rl AS (SELECT l_orderkey, tie, score / 50000 AS z, label FROM ls WHERE label >= 0)"


def _real(spark, sf):
    return lists(spark, sf).filter(F.col("label") >= 0).withColumn("z", F.col("score") / 50000)


@query("O5_listwise_softmax", REAL_SQL + """, s AS (SELECT l_orderkey, sum(label) * ln(sum(exp(z))) - sum(label * z) AS l FROM rl GROUP BY 1)
SELECT round_even(avg(l), 6) AS softmax FROM s""")
def listwise_softmax(spark, sf):
    return o.listwise_softmax(_real(spark, sf), ["l_orderkey"], "label", "z")


@query("O5_list_mle", REAL_SQL + """, s AS (SELECT l_orderkey, ln(sum(exp(z)) OVER (PARTITION BY l_orderkey
  ORDER BY label DESC, tie ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)) - z AS l FROM rl),
g AS (SELECT l_orderkey, sum(l) AS l FROM s GROUP BY 1) SELECT round_even(avg(l), 6) AS list_mle FROM g""")
def list_mle(spark, sf):
    return o.list_mle(_real(spark, sf), ["l_orderkey"], "label", "z", "tie")
