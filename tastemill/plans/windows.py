"""Window recipes."""

from __future__ import annotations

from pyspark.sql import functions as F

from tastemill.functions import scalar as fx
from tastemill.operators import aggregates as a
from tastemill.operators import windows as w
from tastemill.operators.ordering import position, previous_rows, running, top_k
from tastemill.operators.similarity import share_of_group
from tastemill.plans import tables as t
from tastemill.plans.registry import query


@query("E1_latest_on_every_row", "WITH " + t.LOG_SQL + """
SELECT _id, sec AS unix_timestamp, (SELECT max(sec) FROM log) AS max_timestamp FROM log""")
def latest_on_every_row(spark, sf):
    log = t.table(spark, sf, "events").select(
        F.col("event_id").alias("_id"), F.unix_timestamp("ts").alias("unix_timestamp")
    )
    return a.with_latest(log, "unix_timestamp")


@query("E2_last_user_agent", "WITH " + t.LOG_SQL + """
SELECT DISTINCT _token_associate_id AS user_id, last_value(user_agent) OVER (PARTITION BY _token_associate_id
  ORDER BY ts, _id ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS last_user_agent FROM log""")
def last_user_agent(spark, sf):
    log = t.click_log(spark, sf).withColumnRenamed("_token_associate_id", "user_id")
    return w.last_value_per(log, "user_id", "user_agent", ["ts", "_id"], "last_user_agent")


@query("E3_top_k_per_group", """
WITH n AS (SELECT l_suppkey, l_partkey, count(*) AS n, round_even(sum(l_extendedprice), 2) AS revenue FROM lineitem GROUP BY 1, 2)
SELECT l_suppkey, l_partkey, revenue, row_number() OVER (PARTITION BY l_suppkey ORDER BY revenue DESC, l_partkey) AS rank
FROM n QUALIFY rank <= 10""")
def top_k_per_group(spark, sf):
    n = t.table(spark, sf, "lineitem").groupBy("l_suppkey", "l_partkey").agg(
        fx.tidy(F.sum("l_extendedprice"), 2).alias("revenue")
    )
    return top_k(n, ["l_suppkey"], [F.desc("revenue"), "l_partkey"], 10)


@query("E4_competition_rank", "WITH " + t.RAW_SQL + """,
s AS (SELECT user_id, item_id, sum(rating) AS score FROM raw GROUP BY 1, 2),
l AS (SELECT user_id, item_id FROM raw QUALIFY row_number() OVER
  (PARTITION BY user_id ORDER BY ts DESC, order_id DESC, line_no DESC, supp_id DESC, item_id DESC) = 1),
r AS (SELECT user_id, item_id, rank() OVER (PARTITION BY user_id ORDER BY score DESC) AS rank FROM s)
SELECT user_id, item_id, rank FROM r JOIN l USING (user_id, item_id)""")
def competition_rank(spark, sf):
    """Rank of each user's latest item among the user's items by total rating."""
    raw = t.raw_interactions(spark, sf)
    scored = raw.groupBy("user_id", "item_id").agg(F.sum("rating").alias("score"))
    truth = w.last_value_per(raw, "user_id", "item_id", ["ts", "order_id", "line_no", "supp_id", "item_id"], "item_id")
    return w.competition_rank(scored, truth, ["user_id"], "item_id")


@query("E5_user_timeline", "WITH " + t.RATINGS_SQL + """
SELECT user_id, item_id, ts, row_number() OVER (PARTITION BY user_id ORDER BY ts, item_id) AS pos FROM ratings""")
def user_timeline(spark, sf):
    return position(t.ratings(spark, sf).select("user_id", "item_id", "ts"), ["user_id"], ["ts", "item_id"])


@query("E6_previous_rows", "WITH " + t.RATINGS_SQL + """
SELECT user_id, item_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, item_id) AS pos,
  coalesce(array_to_string(list(item_id) OVER (PARTITION BY user_id ORDER BY ts, item_id
    ROWS BETWEEN 10 PRECEDING AND 1 PRECEDING), ','), '') AS context FROM ratings""")
def previous_items(spark, sf):
    r = t.ratings(spark, sf).select("user_id", "item_id", "ts")
    out = previous_rows(r, ["user_id"], ["ts", "item_id"], 10, {"context": F.col("item_id")})
    return out.select(
        "user_id", "item_id", "pos", F.concat_ws(",", F.col("context").cast("array<string>")).alias("context")
    )


@query("E7_prior_row_statistics", """
SELECT event_id, CAST(coalesce(sum(value::DECIMAL(18,2)) OVER w, 0) AS DOUBLE) AS prior_sum, count(*) OVER w AS prior_n FROM events
WINDOW w AS (PARTITION BY event_type ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)""")
def prior_row_statistics(spark, sf):
    e = t.table(spark, sf, "events").select("event_id", "event_type", "ts", "value")
    out = running(
        e,
        ["event_type"],
        ["ts", "event_id"],
        {"prior_sum": F.col("value").cast("decimal(18,2)"), "prior_n": F.lit(1)},
    )
    return out.select("event_id", F.col("prior_sum").cast("double").alias("prior_sum"), "prior_n")


@query("E8_first_rows_per_user", "WITH " + t.RATINGS_SQL + """
SELECT user_id, item_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, item_id) AS rank
FROM ratings QUALIFY rank <= 3""")
def first_rows_per_user(spark, sf):
    r = t.ratings(spark, sf).select("user_id", "item_id", "ts")
    return top_k(r, ["user_id"], ["ts", "item_id"], 3).drop("ts")


@query("E9_share_after_top_k", """
WITH s AS (SELECT user_id, event_type, round_even(sum(value), 2) AS score FROM events GROUP BY 1, 2
  QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY round_even(sum(value), 2) DESC, event_type) <= 3)
SELECT user_id, event_type, score, round_even(CASE WHEN sum(score) OVER (PARTITION BY user_id) = 0 THEN 0
  ELSE score / sum(score) OVER (PARTITION BY user_id) END, 3)::DOUBLE AS share FROM s""")
def share_after_top_k(spark, sf):
    s = t.table(spark, sf, "events").groupBy("user_id", "event_type").agg(fx.tidy(F.sum("value"), 2).alias("score"))
    return share_of_group(top_k(s, ["user_id"], [F.desc("score"), "event_type"], 3), "user_id", "score").drop("rank")
