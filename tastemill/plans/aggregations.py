"""Aggregations."""

from __future__ import annotations

from pyspark.sql import functions as F

from tastemill.functions.scalar import tidy
from tastemill.operators import aggregates as a
from tastemill.operators.ordering import list_parts
from tastemill.plans import tables as t
from tastemill.plans.registry import query

ACTIONS = "click_object_id IS NOT NULL AND action = 'actions'"


@query("D1_clicks_per_user_item", f"""WITH {t.LOG_SQL}
SELECT _token_associate_id AS user_id, click_object_id AS item_id, CAST(sum(click) AS BIGINT) AS rating
FROM log WHERE {ACTIONS} GROUP BY 1, 2""")
def clicks_per_user_item(spark, sf):
    return a.clicks_per_pair(t.click_log(spark, sf), names=t.LOG)


@query("D2_clicks_per_user_item_second", f"""WITH {t.LOG_SQL}
SELECT _token_associate_id AS user_id, click_object_id AS item_id, sec AS unix_time_stamp,
       CAST(sum(click) AS BIGINT) AS rating FROM log WHERE {ACTIONS} GROUP BY 1, 2, 3""")
def clicks_per_user_item_second(spark, sf):
    return a.clicks_per_pair(t.click_log(spark, sf), with_time=True, names=t.LOG)


@query("D3_item_catalogue", f"""WITH {t.LOG_SQL}
SELECT DISTINCT click_object_id AS item_id, click_details_caption AS title FROM log WHERE {ACTIONS}""")
def item_catalogue(spark, sf):
    return a.item_catalogue(t.click_log(spark, sf), t.LOG)


@query("D4_item_category_bag", f"""WITH {t.LOG_SQL}
SELECT item_id, title, (rn - 1) // 1000 AS part, string_agg(user_agent, '|' ORDER BY rn) AS categories FROM (
  SELECT *, row_number() OVER (PARTITION BY item_id, title ORDER BY user_agent NULLS FIRST) AS rn FROM (
    SELECT DISTINCT click_object_id AS item_id, click_details_caption AS title, user_agent FROM log WHERE {ACTIONS}))
GROUP BY 1, 2, 3""")
def item_category_bag(spark, sf):
    return a.item_category_bag(t.click_log(spark, sf), "user_agent", t.LOG)


@query("D5_deepest_click", f"""WITH {t.LOG_SQL}
SELECT "traceId", max("resPos") AS "max_resPos" FROM log WHERE click_object_id IS NOT NULL GROUP BY 1""")
def deepest_click(spark, sf):
    return a.deepest_click(t.click_log(spark, sf, with_position=True), "traceId", "resPos", t.LOG)


@query("D6_composed_pair_counts", f"""WITH {t.LOG_SQL}
SELECT coalesce(client_id || ':' || _token_associate_id, 'unknown') AS left_key,
       coalesce(user_agent || ':' || click_object_id, 'unknown') AS right_key, count(*) AS n
FROM log WHERE click >= 0 GROUP BY 1, 2""")
def composed_pair_counts(spark, sf):
    log = t.click_log(spark, sf)
    return a.composed_pair_counts(
        log, ["client_id", "_token_associate_id"], ["user_agent", "click_object_id"], F.col("click") >= 0
    )


TRENDING_SQL = f"""WITH {t.LOG_SQL},
cl AS (SELECT client_id, click_object_id AS item_id, click_details_caption AS title, sec, count(*) AS clicks
  FROM log WHERE {ACTIONS} GROUP BY 1, 2, 3, 4),
trend AS (SELECT client_id, item_id, title,
  round_even(sum((1.0::DOUBLE / (1 + (((SELECT max(sec) FROM cl) - sec) / 86400.0::DOUBLE / 100.0::DOUBLE))) * clicks), 6)
    AS weighted_clicks
FROM cl GROUP BY 1, 2, 3)"""


@query("D7_trending", TRENDING_SQL + " SELECT * FROM trend")
def trending(spark, sf):
    return a.trending(t.click_log(spark, sf), t.LOG)


@query("D8_mean_rating", "WITH " + t.RAW_SQL + " SELECT item_id, round_even(avg(rating), 3)::DOUBLE AS score FROM raw GROUP BY 1")
def mean_rating(spark, sf):
    return a.mean_rating(t.raw_interactions(spark, sf))


@query("D9_total_rating", "WITH " + t.RAW_SQL + " SELECT item_id, round_even(sum(rating), 3)::DOUBLE AS score FROM raw GROUP BY 1")
def total_rating(spark, sf):
    return a.total_rating(t.raw_interactions(spark, sf))


@query("D10_latest_timestamp", "SELECT max(CAST(floor(epoch(o_orderdate)) AS BIGINT)) AS latest FROM orders")
def latest_timestamp(spark, sf):
    return t.table(spark, sf, "orders").agg(F.max(F.unix_timestamp("o_orderdate")).alias("latest"))


@query("D11_items_per_user", "WITH " + t.RATINGS_SQL + """
SELECT user_id, (rn - 1) // 1000 AS part, string_agg(item_id, ',' ORDER BY rn) AS items
FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY item_id) AS rn FROM ratings) GROUP BY 1, 2""")
def items_per_user(spark, sf):
    """Ordered item lists, 1000 items to a row; longer lists go on in the next part."""
    lists = list_parts(t.ratings(spark, sf), ["user_id"], ["item_id"], {"items": F.col("item_id")})
    return lists.withColumn("items", F.concat_ws(",", F.col("items").cast("array<string>")))


@query("D12_users_per_item", "WITH " + t.RATINGS_SQL + """
SELECT item_id, (rn - 1) // 1000 AS part, string_agg(user_id, ',' ORDER BY rn) AS users
FROM (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY user_id) AS rn FROM ratings) GROUP BY 1, 2""")
def users_per_item(spark, sf):
    lists = list_parts(t.ratings(spark, sf), ["item_id"], ["user_id"], {"users": F.col("user_id")})
    return lists.withColumn("users", F.concat_ws(",", F.col("users").cast("array<string>")))


@query("D13_item_popularity", "SELECT l_partkey AS item_id, count(*) AS n FROM lineitem GROUP BY 1")
def item_popularity(spark, sf):
    return a.popularity(t.table(spark, sf, "lineitem").select(F.col("l_partkey").alias("item_id")))


@query("D14_category_counts", "WITH " + t.ITEMS_SQL + """
SELECT category, count(*) AS n FROM (SELECT unnest(string_split(categories, '|')) AS category FROM items) GROUP BY 1""")
def category_counts(spark, sf):
    return a.category_counts(t.items(spark, sf))


@query("D15_centred_means", "WITH " + t.RAW_SQL + """
SELECT user_id, round_even(avg(rating), 6) AS mean, (SELECT round_even(avg(rating), 6) FROM raw) AS global_mean FROM raw GROUP BY 1""")
def centred_means(spark, sf):
    return a.centred_means(t.raw_interactions(spark, sf), "user_id")


@query("D16_distinct_counts", "SELECT count(DISTINCT l_partkey) AS l_partkey, count(DISTINCT l_orderkey) AS l_orderkey FROM lineitem")
def distinct_counts(spark, sf):
    return a.distinct_counts(t.table(spark, sf, "lineitem"), ["l_partkey", "l_orderkey"])
