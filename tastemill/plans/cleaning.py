"""Filters, cleaning, profiles."""

from __future__ import annotations

from pyspark.sql import functions as F

from tastemill.functions import scalar as fx
from tastemill.operators import cleaning as c
from tastemill.plans import tables as t
from tastemill.plans.registry import query


@query("B1_rating_threshold", "WITH " + t.RAW_SQL + " SELECT user_id, item_id, rating, ts FROM raw WHERE rating >= 25")
def rating_threshold(spark, sf):
    return c.at_least(t.raw_interactions(spark, sf), 25.0).select("user_id", "item_id", "rating", "ts")


@query("B2_log_filter", "WITH " + t.LOG_SQL + """
SELECT _id, click_object_id FROM log WHERE click_object_id IS NOT NULL AND action = 'actions'""")
def log_filter(spark, sf):
    return c.log_actions(t.click_log(spark, sf), t.LOG).select("_id", "click_object_id")


@query("B3_drop_nulls", "WITH " + t.LOG_SQL + """
SELECT _id, click_object_id, click_details_caption FROM log
WHERE click_object_id IS NOT NULL AND click_details_caption IS NOT NULL""")
def drop_nulls(spark, sf):
    log = t.click_log(spark, sf).select("_id", "click_object_id", "click_details_caption")
    return log.dropna(subset=["click_object_id", "click_details_caption"])


@query("B4_default_fill", "WITH " + t.LOG_SQL + """
SELECT _id, coalesce(click_object_id, 'unknown') AS click_object_id,
       coalesce(click_details_caption, 'none') AS click_details_caption FROM log""")
def default_fill(spark, sf):
    log = t.click_log(spark, sf).select("_id", "click_object_id", "click_details_caption")
    return log.fillna({"click_object_id": "unknown", "click_details_caption": "none"})


@query("B5_numeric_coercion", """
SELECT p_partkey, coalesce(try_cast(try_cast(replace(p_brand, 'Brand#1', '1') AS DOUBLE) AS BIGINT), 0) AS zero_if_bad,
       try_cast(replace(p_brand, 'Brand#1', '1') AS DOUBLE) AS null_if_bad FROM part""")
def numeric_coercion(spark, sf):
    code = F.replace(F.col("p_brand"), F.lit("Brand#1"), F.lit("1"))
    return t.table(spark, sf, "part").select(
        "p_partkey", fx.coerce_int(code).alias("zero_if_bad"), fx.coerce_double(code).alias("null_if_bad")
    )


@query("B6_alternation_filter", "SELECT p_partkey, p_name FROM part WHERE regexp_matches(p_name, 'ring|plate')")
def alternation_filter(spark, sf):
    return t.table(spark, sf, "part").filter(F.col("p_name").rlike("ring|plate")).select("p_partkey", "p_name")


@query("B7_column_selection", "SELECT l_orderkey, l_partkey, l_quantity FROM lineitem")
def column_selection(spark, sf):
    li = t.table(spark, sf, "lineitem")
    return li.drop(*[x for x in li.columns if x not in ("l_orderkey", "l_partkey", "l_quantity")])


@query("B8_active_users", "WITH " + t.RAW_SQL + """
SELECT user_id, item_id, rating FROM raw
WHERE user_id IN (SELECT user_id FROM raw GROUP BY 1 HAVING count(*) >= 40)""")
def active_users(spark, sf):
    raw = t.raw_interactions(spark, sf).select("user_id", "item_id", "rating")
    return c.frequent(raw, "user_id", 40)


@query("B9_frequent_values", "WITH " + t.RAW_SQL + """
SELECT rating, count(*) AS n FROM raw
WHERE rating IN (SELECT rating FROM raw GROUP BY 1 HAVING count(*) >= 100) GROUP BY 1""")
def frequent_values(spark, sf):
    raw = t.raw_interactions(spark, sf).select("rating")
    return c.frequent(raw, "rating", 100).groupBy("rating").agg(F.count(F.lit(1)).alias("n"))


@query("B10_popular_titles", """
WITH tr AS (SELECT p_name AS title, l_orderkey, l_linenumber, l_suppkey FROM lineitem JOIN part ON l_partkey = p_partkey),
n AS (SELECT title, count(*) AS n FROM tr GROUP BY 1 HAVING count(*) >= 50)
SELECT tr.title, l_orderkey, l_linenumber, l_suppkey, n FROM tr JOIN n USING (title)""")
def popular_titles(spark, sf):
    li = t.table(spark, sf, "lineitem")
    p = t.table(spark, sf, "part")
    rows = li.join(p, li.l_partkey == p.p_partkey).select(
        F.col("p_name").alias("title"), "l_orderkey", "l_linenumber", "l_suppkey"
    )
    return c.frequent_with_count(rows, "title", 50)


@query("B11_item_min_count", "WITH " + t.RAW_SQL + """
SELECT user_id, item_id, ts FROM raw WHERE item_id IN (SELECT item_id FROM raw GROUP BY 1 HAVING count(*) >= 25)""")
def item_min_count(spark, sf):
    return c.frequent(t.raw_interactions(spark, sf).select("user_id", "item_id", "ts"), "item_id", 25)


@query("B12_sentinel_removal", "SELECT event_id, event_type FROM events WHERE event_type <> 'error'")
def sentinel_removal(spark, sf):
    return t.table(spark, sf, "events").filter(F.col("event_type") != "error").select("event_id", "event_type")


@query("B13_pair_dedup", "WITH " + t.RAW_SQL + """
SELECT user_id, item_id, rating, ts FROM raw
QUALIFY row_number() OVER (PARTITION BY user_id, item_id ORDER BY ts, order_id, line_no, supp_id, rating) = 1""")
def pair_dedup(spark, sf):
    raw = t.raw_interactions(spark, sf)
    return c.keep_one(raw, ["user_id", "item_id"], ["ts", "order_id", "line_no", "supp_id", "rating"]).select(
        "user_id", "item_id", "rating", "ts"
    )


@query("B14_first_timestamp", "WITH " + t.RAW_SQL + """,
f AS (SELECT user_id, item_id, ts AS first_ts FROM raw
  QUALIFY row_number() OVER (PARTITION BY user_id, item_id ORDER BY order_id, line_no, supp_id) = 1)
SELECT raw.user_id, raw.item_id, rating, ts, first_ts FROM raw JOIN f USING (user_id, item_id) WHERE rating >= 25""")
def first_timestamp(spark, sf):
    out = c.first_time_then_filter(t.raw_interactions(spark, sf), ["order_id", "line_no", "supp_id"], 25.0)
    return out.select("user_id", "item_id", "rating", "ts", "first_ts")


@query("B15_label_binarisation", """
SELECT l_orderkey, l_linenumber, l_suppkey, CAST(l_quantity >= 25 AS INTEGER) AS by_threshold,
       CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS by_text FROM lineitem""")
def label_binarisation(spark, sf):
    return t.table(spark, sf, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        "l_suppkey",
        (F.col("l_quantity") >= 25).cast("int").alias("by_threshold"),
        F.when(F.col("l_returnflag") == "R", 1).otherwise(0).alias("by_text"),
    )


@query("B16_sample_rows", "SELECT o_orderkey, o_custkey FROM orders ORDER BY " + t.key_sql("o_orderkey") + ", o_orderkey LIMIT 100")
def sample_rows(spark, sf):
    return c.sample_rows(t.table(spark, sf, "orders").select("o_orderkey", "o_custkey"), 100, "o_orderkey")


@query("B17_distinct_vocabulary", """
SELECT DISTINCT 'p_brand' AS feature, p_brand AS value FROM part UNION ALL
SELECT DISTINCT 'p_type', p_type FROM part UNION ALL SELECT DISTINCT 'p_size', CAST(p_size AS VARCHAR) FROM part""")
def distinct_vocabulary(spark, sf):
    return c.distinct_values(t.table(spark, sf, "part"), ["p_brand", "p_type", "p_size"])


@query("B18_null_profile", "WITH " + t.LOG_SQL + """
SELECT count(*) FILTER (click_object_id IS NULL) AS click_object_id,
       count(*) FILTER (click_details_caption IS NULL) AS click_details_caption,
       count(*) FILTER (action IS NULL) AS action FROM log""")
def null_profile(spark, sf):
    return c.null_profile(t.click_log(spark, sf), ["click_object_id", "click_details_caption", "action"])


@query("B19_dataset_profile", "WITH " + t.RAW_SQL + """
SELECT count(*) AS n, count(DISTINCT user_id) AS users, count(DISTINCT item_id) AS items, sum(rating) AS total,
  round_even(1.0::DOUBLE - count(*) / (count(DISTINCT user_id)::DOUBLE * count(DISTINCT item_id)), 6) AS sparsity FROM raw""")
def dataset_profile(spark, sf):
    return c.interaction_profile(t.raw_interactions(spark, sf), "user_id", "item_id", "rating")


@query("B20_five_number_summary", """
SELECT l_returnflag, count(l_quantity) AS n, min(l_quantity) AS low, quantile_cont(l_quantity, 0.25) AS q1,
  quantile_cont(l_quantity, 0.5) AS median, quantile_cont(l_quantity, 0.75) AS q3, max(l_quantity) AS high
FROM lineitem GROUP BY 1""")
def five_number_summary(spark, sf):
    return c.five_numbers(t.table(spark, sf, "lineitem"), "l_quantity", ["l_returnflag"])


@query("B21_histogram", """
SELECT least(CAST(floor(l_quantity / 10) AS INTEGER), 4) AS bin, count(*) AS n FROM lineitem
WHERE l_quantity BETWEEN 0 AND 50 GROUP BY 1""")
def histogram(spark, sf):
    return c.histogram(t.table(spark, sf, "lineitem"), "l_quantity", [0.0, 10.0, 20.0, 30.0, 40.0, 50.0])


@query("B21_value_counts", "SELECT l_quantity AS rating, count(*) AS n FROM lineitem GROUP BY 1")
def value_counts(spark, sf):
    return t.table(spark, sf, "lineitem").groupBy(F.col("l_quantity").alias("rating")).agg(F.count(F.lit(1)).alias("n"))
