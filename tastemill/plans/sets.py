"""Sorts, limits, set operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from tastemill.functions import scalar as fx
from tastemill.operators import aggregates as a
from tastemill.operators import sets as s
from tastemill.operators.ordering import position, top_k
from tastemill.plans import tables as t
from tastemill.plans.aggregations import TRENDING_SQL
from tastemill.plans.registry import query


@query("S1_order_by_client_score", TRENDING_SQL + """
SELECT *, row_number() OVER (ORDER BY client_id, weighted_clicks DESC, item_id) AS place FROM trend""")
def order_by_client_score(spark, sf):
    """Global order by client, score descending, made visible as the place of each row."""
    order = ["client_id", F.desc("weighted_clicks"), "item_id"]
    return position(a.trending(t.click_log(spark, sf), t.LOG), [], order, "place").orderBy("place")


@query("S2_global_top_n", """
SELECT l_partkey AS item_id, round_even(sum(l_quantity), 3) AS score FROM lineitem GROUP BY 1
ORDER BY round_even(sum(l_quantity), 3) DESC, l_partkey LIMIT 20""")
def global_top_n(spark, sf):
    sc = t.table(spark, sf, "lineitem").groupBy(F.col("l_partkey").alias("item_id")).agg(
        fx.tidy(F.sum("l_quantity"), 3).alias("score")
    )
    return s.top_overall(sc, 20, F.desc("score"), "item_id")


@query("S3_ordered_distinct", "WITH " + t.CLICKS_SQL.replace("clicks AS", "unused AS") + """,
f AS (SELECT user_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS item_id,
  min(lpad(event_id::VARCHAR, 20, '0')) AS p FROM events GROUP BY 1, 2)
SELECT user_id, item_id, row_number() OVER (PARTITION BY user_id ORDER BY p, item_id) AS rank FROM f QUALIFY rank <= 20""")
def ordered_distinct(spark, sf):
    return s.ordered_distinct(t.click_events(spark, sf), "user_id", "item_id", ["event_id"], 20)


@query("S4_union_all", """
SELECT doc_id, 1 AS label FROM labels WHERE quality = 1 UNION ALL SELECT doc_id, 0 FROM labels WHERE toxic = 1""")
def union_all(spark, sf):
    lab = t.table(spark, sf, "labels")
    good = lab.filter("quality = 1").select("doc_id", F.lit(1).alias("label"))
    return good.unionByName(lab.filter("toxic = 1").select("doc_id", F.lit(0).alias("label")))


@query("S5_edge_mirror", "WITH " + t.CLICKS_SQL + """
SELECT 'user' AS src_kind, user_id AS src, 'item' AS dst_kind, item_id AS dst FROM clicks
UNION ALL SELECT 'item', item_id, 'user', user_id FROM clicks""")
def edge_mirror(spark, sf):
    e = s.mirrored_edges(t.click_events(spark, sf))
    return e.select(
        F.col("src.kind").alias("src_kind"),
        F.col("src.id").alias("src"),
        F.col("dst.kind").alias("dst_kind"),
        F.col("dst.id").alias("dst"),
    )


@query("S6_intersection_sizes", "WITH " + t.RATINGS_SQL + """,
early AS (SELECT item_id, user_id FROM ratings WHERE rating >= 25),
late AS (SELECT l_partkey AS item_id, o_custkey AS user_id FROM lineitem JOIN orders ON l_orderkey = o_orderkey
  WHERE l_returnflag = 'R' GROUP BY 1, 2)
SELECT item_id, count(*) AS common FROM early JOIN late USING (item_id, user_id) GROUP BY 1""")
def intersection_sizes(spark, sf):
    """Users who rated an item high and also returned it."""
    high = t.ratings(spark, sf).filter("rating >= 25")
    li, od = t.table(spark, sf, "lineitem"), t.table(spark, sf, "orders")
    back = (
        li.filter("l_returnflag = 'R'")
        .join(od, li.l_orderkey == od.o_orderkey)
        .select(F.col("l_partkey").alias("item_id"), F.col("o_custkey").alias("user_id"))
        .distinct()
    )
    return s.common_members(high, back, "item_id", "user_id")


@query("S7_items_not_taken", "WITH " + t.CLICKS_SQL + """
SELECT u.user_id, i.item_id FROM (SELECT DISTINCT user_id FROM clicks) u, (SELECT DISTINCT item_id FROM clicks) i
EXCEPT SELECT user_id, item_id FROM clicks""")
def items_not_taken(spark, sf):
    return s.not_taken(t.clicks(spark, sf))


@query("S8_seeded_shuffle", f"""
SELECT o_orderkey, row_number() OVER (ORDER BY {t.key_sql('o_orderkey')}, o_orderkey) AS place FROM orders""")
def seeded_shuffle(spark, sf):
    od = t.table(spark, sf, "orders").select("o_orderkey")
    return position(od, [], [fx.shuffle_key("o_orderkey"), "o_orderkey"], "place")
