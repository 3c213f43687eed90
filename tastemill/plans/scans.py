"""Scans and sinks (A1-A13): tables are written as text under the shared folder and read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from tastemill.operators.ordering import list_parts
from tastemill.plans import tables as t
from tastemill.plans.registry import query
from tastemill.session import scratch_path
from tastemill.sources import readers as r
from tastemill.sources import writers as w


@query("A1_csv_clicks", "WITH " + t.LOG_SQL + """
SELECT CAST(_token_associate_id AS VARCHAR) AS user_id, click_object_id AS item_id,
       CAST(sum(click) AS DOUBLE) AS rating
FROM log WHERE click_object_id IS NOT NULL GROUP BY 1, 2""")
def csv_clicks(spark, sf):
    log = t.click_log(spark, sf).filter(F.col("click_object_id").isNotNull())
    out = log.groupBy(F.col("_token_associate_id").alias("user_id"), F.col("click_object_id").alias("item_id")).agg(
        F.sum("click").alias("rating")
    )
    return r.read_csv(spark, w.write_csv(out, scratch_path(spark, "clicks")), r.CLICKS)


@query("A2_csv_title_with_commas", """
SELECT CAST(p_partkey AS VARCHAR) AS itemid, p_name || ', ' || p_type || ', ' || p_size AS title,
       p_brand || '|' || p_type AS genres
FROM part WHERE p_size > 1""")
def csv_title_with_commas(spark, sf):
    """Lines of size-1 parts are written with two fields, so the reader has lines to skip."""
    p = t.table(spark, sf, "part")
    title = F.concat_ws(", ", "p_name", "p_type", "p_size")
    quoted = F.concat(F.lit('"'), title, F.lit('"'))
    full = F.concat_ws(",", "p_partkey", quoted, F.concat_ws("|", "p_brand", "p_type"))
    line = F.when(F.col("p_size") > 1, full).otherwise(F.concat_ws(",", "p_partkey", "p_name"))
    return r.read_items_with_commas(spark, w.write_lines(p.select(line), scratch_path(spark, "movies")))


@query("A3_double_colon_ratings", "WITH " + t.RAW_SQL + """
SELECT user_id AS "UserID", item_id AS "MovieID", rating AS "Rating", ts AS "Timestamp" FROM raw WHERE rating >= 30""")
def double_colon_ratings(spark, sf):
    raw = t.raw_interactions(spark, sf)
    line = raw.select(F.concat_ws("::", "user_id", "item_id", "rating", "ts"))
    return r.read_ratings_1m(spark, w.write_lines(line, scratch_path(spark, "ratings-1m")), min_rating=30.0)


@query("A4_tab_ratings_counts", "WITH " + t.RAW_SQL + """
SELECT count(*) AS n, count(DISTINCT user_id) AS users, count(DISTINCT item_id) AS items FROM raw""")
def tab_ratings_counts(spark, sf):
    raw = t.raw_interactions(spark, sf).select("user_id", "item_id", F.col("rating").cast("int"), "ts")
    path = w.write_csv(raw, scratch_path(spark, "ratings-100k"), sep="\t", header=False)
    return r.read_delimited(spark, path, r.RATINGS_100K, "\t").agg(
        F.count(F.lit(1)).alias("n"),
        F.count_distinct("user_id").alias("users"),
        F.count_distinct("item_id").alias("items"),
    )


@query("A5_latin1_drop_malformed", """
SELECT c_custkey AS "userID", c_mktsegment AS "Location", CAST(floor(c_acctbal) AS INTEGER) AS "Age"
FROM customer WHERE c_nationkey <> 3""")
def latin1_drop_malformed(spark, sf):
    """Customers of nation 3 get a word where the number belongs; the reader drops those lines."""
    c = t.table(spark, sf, "customer")
    age = F.when(F.col("c_nationkey") == 3, F.lit("Fünf")).otherwise(F.floor("c_acctbal").cast("string"))
    lines = c.select(F.concat_ws(";", "c_custkey", "c_mktsegment", age))
    path = w.write_lines(lines, scratch_path(spark, "users"))
    return r.read_dropping_malformed(
        spark, path, ["userID", "Location", "Age"], ["long", "string", "int"], header=False
    )


@query("A6_question_mark_rows", """
SELECT CAST(l_linenumber AS INT) AS line, l_returnflag AS flag FROM lineitem WHERE l_linestatus <> 'F'""")
def question_mark_rows(spark, sf):
    li = t.table(spark, sf, "lineitem").select(
        F.when(F.col("l_linestatus") != "F", F.col("l_linenumber").cast("string")).otherwise("?"),
        "l_returnflag",
        "l_suppkey",
    )
    path = w.write_csv(li, scratch_path(spark, "income"), sep=",", header=False)
    return r.read_complete_rows(spark, path, "line int, flag string, supp long", drop=["supp"])


@query("A7_lines_with_defaults", """
SELECT CAST(CASE WHEN l_quantity < 10 THEN 0 ELSE l_linenumber END AS INT) AS line, coalesce(l_returnflag, 'none') AS flag,
       'x' AS mark
FROM lineitem WHERE l_linestatus <> 'F'""")
def lines_with_defaults(spark, sf):
    """Small quantities leave the first field empty: it is read as its default 0."""
    li = t.table(spark, sf, "lineitem")
    first = F.when(F.col("l_quantity") < 10, "").otherwise(F.col("l_linenumber").cast("string"))
    mark = F.when(F.col("l_linestatus") == "F", "?").otherwise("x")
    path = w.write_lines(li.select(F.concat_ws(", ", first, "l_returnflag", mark)), scratch_path(spark, "adult"))
    return r.read_lines_with_defaults(
        spark, path, "line int, flag string, mark string", {"line": 0, "flag": "none", "mark": ""}
    )


@query("A8_sql_table_scan", "SELECT event_type, count(*) AS n FROM events GROUP BY 1")
def sql_table_scan(spark, sf):
    t.table(spark, sf, "events").createOrReplaceTempView("event_log")
    return r.read_table(spark, "SELECT event_type, count(*) AS n FROM event_log GROUP BY event_type")


@query("A9_csv_export", "WITH " + t.RATINGS_SQL + """
SELECT CAST(user_id AS VARCHAR) AS user_id, CAST(item_id AS VARCHAR) AS item_id, ts AS "timestamp", rating FROM ratings""")
def csv_export(spark, sf):
    out = t.ratings(spark, sf).select("user_id", "item_id", F.col("ts").alias("timestamp"), "rating")
    return r.read_csv(spark, w.write_csv(out, scratch_path(spark, "export")), r.CLICKS_WITH_TIME)


@query("A10_matrix_export", """
SELECT l_returnflag AS label, l_quantity AS quantity, l_discount AS discount, l_tax AS tax, 3 AS num_features FROM lineitem""")
def matrix_export(spark, sf):
    li = t.table(spark, sf, "lineitem").select(
        F.col("l_returnflag").alias("label"), F.array("l_quantity", "l_discount", "l_tax").alias("features")
    )
    back = spark.read.parquet(w.write_matrix(li, scratch_path(spark, "matrix"), "features", 3))
    return back.select(
        "label",
        *[F.col("features")[i].alias(n) for i, n in enumerate(("quantity", "discount", "tax"))],
        F.lit(w.matrix_width(back, "features")).alias("num_features"),
    )


@query("A11_sequence_examples", "WITH " + t.RATINGS_SQL + """
SELECT user_id, (rn - 1) // 1000 AS part, string_agg(item_id, ',' ORDER BY rn) AS item_ids, count(*) AS n, 'UNK' AS genre
FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, item_id) AS rn FROM ratings) GROUP BY 1, 2""")
def sequence_examples(spark, sf):
    """Per-user sequences written as lists and read back, a missing list gets its default."""
    lists = list_parts(t.ratings(spark, sf), ["user_id"], ["ts", "item_id"], {"items": F.col("item_id")})
    lists = lists.withColumn("genres", F.lit(None).cast("array<string>"))
    back = spark.read.parquet(w.write_parquet(lists, scratch_path(spark, "examples")))
    full = r.with_defaults(back, {"genres": F.array(F.lit("UNK"))})
    return full.select(
        "user_id",
        "part",
        F.concat_ws(",", F.col("items").cast("array<string>")).alias("item_ids"),
        F.size("items").cast("long").alias("n"),
        F.col("genres")[0].alias("genre"),
    )


@query("A12_list_with_context", """
SELECT o_orderkey, o_custkey, (rn - 1) // 1000 AS part, count(*) AS n, string_agg(l_partkey, ',' ORDER BY rn) AS parts
FROM (SELECT *, row_number() OVER (PARTITION BY o_orderkey, o_custkey ORDER BY l_linenumber, l_partkey, l_suppkey) AS rn
  FROM orders JOIN lineitem ON o_orderkey = l_orderkey) GROUP BY 1, 2, 3""")
def list_with_context(spark, sf):
    """An order is the context, its lines are the examples."""
    od = t.table(spark, sf, "orders").select("o_orderkey", "o_custkey")
    li = t.table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    rows = od.join(li, od.o_orderkey == li.l_orderkey)
    nested = w.list_with_context(rows, ["o_orderkey", "o_custkey"], "l_linenumber", ["l_partkey", "l_suppkey"])
    parts = F.transform("examples", lambda e: e["l_partkey"].cast("string"))
    return nested.select(
        "o_orderkey", "o_custkey", "part", F.size("examples").cast("long").alias("n"), F.concat_ws(",", parts).alias("parts")
    )


@query("A13_vocabulary", "SELECT p_name AS title, count(*) AS n FROM part GROUP BY 1")
def vocabulary_export(spark, sf):
    vocab = w.vocabulary(t.table(spark, sf, "part").select(F.col("p_name").alias("title")), "title")
    return spark.read.parquet(w.write_parquet(vocab, scratch_path(spark, "vocab")))
