"""The concepts of the engine bound to the test tables, as DataFrames and as SQL.

Each pair (function, ``*_SQL`` text) says the same thing; oracles start with
``WITH`` + the text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tastemill.functions.scalar import epoch_seconds
from tastemill.operators.cleaning import LogColumns


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# --- timed interactions: one row per order line ------------------------------

RAW_SQL = """raw AS (
  SELECT o_custkey AS user_id, l_partkey AS item_id, l_quantity AS rating,
         CAST(floor(epoch(o_orderdate)) AS BIGINT) AS ts,
         l_orderkey AS order_id, l_linenumber AS line_no, l_suppkey AS supp_id
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"""


def raw_interactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    od = table(spark, sf_dir, "orders")
    return li.join(od, li.l_orderkey == od.o_orderkey).select(
        F.col("o_custkey").alias("user_id"),
        F.col("l_partkey").alias("item_id"),
        F.col("l_quantity").alias("rating"),
        epoch_seconds("o_orderdate").alias("ts"),
        F.col("l_orderkey").alias("order_id"),
        F.col("l_linenumber").alias("line_no"),
        F.col("l_suppkey").alias("supp_id"),
    )


# --- one row per (user, item): first time, best rating -----------------------

RATINGS_SQL = (
    RAW_SQL
    + """, ratings AS (
  SELECT user_id, item_id, max(rating) AS rating, min(ts) AS ts FROM raw GROUP BY user_id, item_id)"""
)


def ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raw_interactions(spark, sf_dir).groupBy("user_id", "item_id").agg(
        F.max("rating").alias("rating"), F.min("ts").alias("ts")
    )


# --- search and click log -----------------------------------------------------

LOG_SQL = """log0 AS (
  SELECT event_id AS _id, user_id AS _token_associate_id, ts,
         CASE WHEN event_type = 'error' THEN NULL ELSE json_extract_string(props, '$.k') END AS click_object_id,
         CAST(event_type IN ('click', 'purchase') AS INTEGER) AS click,
         user_id || '-' || strftime(ts, '%Y-%m-%d') AS "traceId",
         CASE WHEN event_type = 'signup' THEN 'views' ELSE 'actions' END AS action,
         event_type AS user_agent,
         'client' || (CAST(json_extract_string(props, '$.k') AS BIGINT) % 7) AS client_id
  FROM events),
log AS (
  SELECT *, 'caption ' || click_object_id AS click_details_caption,
         strftime(ts, '%Y-%m-%dT%H:%M:%S') || '.000Z' AS time_stamp,
         CAST(floor(epoch(ts)) AS BIGINT) AS sec,
         row_number() OVER (PARTITION BY "traceId" ORDER BY ts, _id) AS "resPos"
  FROM log0)"""


#: The log's input schema has these column names.
LOG = LogColumns(
    user="_token_associate_id", item="click_object_id", title="click_details_caption", time="time_stamp"
)


def click_log(spark: SparkSession, sf_dir: str, with_position: bool = False) -> DataFrame:
    """``events`` as the search/click log; ``resPos`` (a window) only where it is read."""
    k = F.get_json_object("props", "$.k")
    obj = F.when(F.col("event_type") != "error", k)
    log = table(spark, sf_dir, "events").select(
        F.col("event_id").alias("_id"),
        F.col("user_id").alias("_token_associate_id"),
        "ts",
        obj.alias("click_object_id"),
        F.concat(F.lit("caption "), obj).alias("click_details_caption"),
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'.000Z'").alias("time_stamp"),
        F.col("event_type").isin("click", "purchase").cast("int").alias("click"),
        F.concat_ws("-", "user_id", F.date_format("ts", "yyyy-MM-dd")).alias("traceId"),
        F.when(F.col("event_type") == "signup", "views").otherwise("actions").alias("action"),
        F.col("event_type").alias("user_agent"),
        F.concat(F.lit("client"), k.cast("long") % 7).alias("client_id"),
    )
    if with_position:
        from tastemill.operators.ordering import position

        log = position(log, ["traceId"], ["ts", "_id"], "resPos")
    return log


# --- clicks as (user, item) counts, small alphabet of items ------------------

CLICKS_SQL = """clicks AS (
  SELECT user_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS item_id,
         count(*) AS n, max(CAST(floor(epoch(ts)) AS BIGINT)) AS ts
  FROM events GROUP BY 1, 2)"""


def click_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per event: user, item, event_type, ts (seconds), value, event_id."""
    return table(spark, sf_dir, "events").select(
        "user_id",
        F.get_json_object("props", "$.k").cast("long").alias("item_id"),
        "event_type",
        epoch_seconds("ts").alias("ts"),
        "value",
        "event_id",
    )


def clicks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return click_events(spark, sf_dir).groupBy("user_id", "item_id").agg(
        F.count(F.lit(1)).alias("n"), F.max("ts").alias("ts")
    )


# --- items with a bag of categories -------------------------------------------

ITEMS_SQL = """items AS (
  SELECT p_partkey AS item_id, p_name AS title,
         p_type || '|' || p_brand || '|' || replace(p_name, ' ', '|') AS categories FROM part)"""


def items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("item_id"),
        F.col("p_name").alias("title"),
        F.concat_ws("|", "p_type", "p_brand", F.replace(F.col("p_name"), F.lit(" "), F.lit("|"))).alias("categories"),
    )


# --- hash of a key with a seed ------------------------------------------------


def key_sql(*cols: str, seed: int = 42) -> str:
    """DuckDB text of ``shuffle_key``."""
    return f"md5(concat_ws('|', {', '.join(cols)}, '{seed}'))"


def bucket_sql(buckets: int, *cols: str, seed: int = 42) -> str:
    """DuckDB text of ``seeded_bucket``."""
    return f"(('0x' || substr({key_sql(*cols, seed=seed)}, 1, 15))::BIGINT % {buckets})"
