"""Column expressions over the tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from tastemill.functions import scalar as fx
from tastemill.functions import vector as vx
from tastemill.operators.content import closest_titles
from tastemill.plans import tables as t
from tastemill.plans.registry import query


@query("G1_time_closeness", """
SELECT l_orderkey, l_linenumber, l_suppkey, round_even(1.0::DOUBLE / (1.0::DOUBLE +
  abs(floor(epoch(o_orderdate)) - floor(epoch(l_shipdate))) / 86400.0::DOUBLE), 6) AS closeness
FROM lineitem JOIN orders ON l_orderkey = o_orderkey""")
def time_closeness(spark, sf):
    li, od = t.table(spark, sf, "lineitem"), t.table(spark, sf, "orders")
    near = fx.time_closeness(fx.epoch_seconds("o_orderdate"), fx.epoch_seconds("l_shipdate"))
    return li.join(od, li.l_orderkey == od.o_orderkey).select(
        "l_orderkey", "l_linenumber", "l_suppkey", fx.tidy(near).alias("closeness")
    )


@query("G2_recency", """
SELECT o_orderkey, round_even(1.0::DOUBLE / (1.0::DOUBLE + ((SELECT max(floor(epoch(o_orderdate))) FROM orders)
  - floor(epoch(o_orderdate))) / 86400.0::DOUBLE / 100.0::DOUBLE), 3)::DOUBLE AS recency FROM orders""")
def recency(spark, sf):
    od = t.table(spark, sf, "orders").select("o_orderkey", fx.epoch_seconds("o_orderdate").alias("ts"))
    return od.select("o_orderkey", fx.recency(od.agg(F.max("ts")).scalar(), F.col("ts")).alias("recency"))


@query("G3_activity_damping", """
SELECT o_custkey, round_even(1.0::DOUBLE / log10(1.0::DOUBLE + count(*)), 6) AS damping FROM orders GROUP BY 1""")
def activity_damping(spark, sf):
    n = t.table(spark, sf, "orders").groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n"))
    return n.select("o_custkey", fx.tidy(fx.activity_damping(F.col("n"))).alias("damping"))


@query("G4_text_to_epoch", "SELECT event_id AS _id, CAST(floor(epoch(ts)) AS BIGINT) AS sec FROM events")
def text_to_epoch(spark, sf):
    return t.click_log(spark, sf).select("_id", fx.parse_epoch("time_stamp").alias("sec"))


@query("G5_title_year", """
SELECT p_partkey, CASE WHEN p_size % 2 = 0 THEN 1950 + p_size END AS trailing, p_name AS title,
       1950 + p_size AS anywhere FROM part""")
def title_year(spark, sf):
    year = (F.lit(1950) + F.col("p_size")).cast("string")
    even = F.concat("p_name", F.lit(" ("), year, F.lit(")"))
    odd = F.concat(F.lit("("), year, F.lit(") "), F.col("p_name"))
    title = F.when(F.col("p_size") % 2 == 0, even).otherwise(odd)
    p = t.table(spark, sf, "part").select("p_partkey", "p_name", title.alias("t"))
    return p.select(
        "p_partkey",
        fx.trailing_year("t").alias("trailing"),
        F.trim(F.regexp_replace(fx.strip_trailing_year("t"), r"^\(\d{4}\)", "")).alias("title"),
        fx.any_year("t").alias("anywhere"),
    )


@query("G6_bag_explode", "WITH " + t.ITEMS_SQL + """
SELECT item_id, category, round_even(1.0::DOUBLE / n, 3)::DOUBLE AS ratio FROM (SELECT item_id,
  unnest(string_split(categories, '|')) AS category, len(string_split(categories, '|')) AS n FROM items)""")
def bag_explode(spark, sf):
    return t.items(spark, sf).select(
        "item_id", F.explode(fx.split_bag("categories")).alias("category"), fx.bag_ratio("categories").alias("ratio")
    )


@query("G7_tidy_genres", "SELECT p_partkey, trim(replace(p_type || '|' || p_name || '|', '|', ' ')) AS genres FROM part")
def tidy_genres(spark, sf):
    bag = F.concat("p_type", F.lit("|"), "p_name", F.lit("|"))
    return t.table(spark, sf, "part").select("p_partkey", fx.tidy_genres(bag).alias("genres"))


@query("G8_point_text", """
SELECT s_suppkey, CAST(s_nationkey AS DOUBLE) AS lat, s_acctbal AS long FROM supplier""")
def point_text(spark, sf):
    p = t.table(spark, sf, "supplier").select(
        "s_suppkey", fx.compose_point(F.col("s_nationkey").cast("double"), F.col("s_acctbal")).alias("point")
    )
    return p.select("s_suppkey", fx.point_part("point", 0).alias("lat"), fx.point_part("point", 1).alias("long"))


@query("G9_guarded_log1p", """
SELECT c_custkey, CASE WHEN c_acctbal > -1 THEN round_even(ln(1.0::DOUBLE + c_acctbal), 6) ELSE -1.0::DOUBLE END AS v
FROM customer""")
def guarded_log1p(spark, sf):
    return t.table(spark, sf, "customer").select("c_custkey", fx.tidy(fx.guarded_log1p(F.col("c_acctbal"))).alias("v"))


@query("G10_closest_title", """
WITH ti AS (SELECT DISTINCT p_name FROM part),
q AS (SELECT p_name AS asked, replace(p_name, ' ', '') AS typed FROM ti),
s AS (SELECT asked, typed, p_name AS closest,
  round_even((1.0::DOUBLE - levenshtein(lower(typed), lower(p_name))::DOUBLE
    / greatest(length(typed), length(p_name))) * 100, 0)::DOUBLE AS score FROM q, ti)
SELECT typed, closest, score, lower(typed) = lower(closest) AS exact FROM s
QUALIFY row_number() OVER (PARTITION BY typed ORDER BY score DESC, closest) = 1""")
def closest_title(spark, sf):
    """Names typed without the blank, matched to the nearest title."""
    titles = t.table(spark, sf, "part").select("p_name").distinct()
    asked = titles.select(F.replace(F.col("p_name"), F.lit(" "), F.lit("")).alias("typed"))
    return closest_titles(asked, "typed", titles, "p_name")


@query("G11_bucketise", """
SELECT c_custkey, CASE WHEN c_acctbal >= 5000 THEN 4 WHEN c_acctbal >= 2500 THEN 3 WHEN c_acctbal >= 1000 THEN 2
  WHEN c_acctbal >= 0 THEN 1 ELSE 0 END AS bucket FROM customer""")
def bucketise(spark, sf):
    b = fx.bucket_index(F.col("c_acctbal"), [0.0, 1000.0, 2500.0, 5000.0])
    return t.table(spark, sf, "customer").select("c_custkey", b.alias("bucket"))


@query("G12_hashed_cross", f"""
SELECT p_partkey, {t.bucket_sql(1000, 'p_brand', 'p_size', seed=0)} AS bucket FROM part""")
def hashed_cross(spark, sf):
    return t.table(spark, sf, "part").select("p_partkey", fx.hashed_cross("p_brand", "p_size", 1000).alias("bucket"))


@query("G13_hash_bucket", f"SELECT p_partkey, {t.bucket_sql(512, 'p_name', seed=0)} AS bucket FROM part")
def hash_bucket(spark, sf):
    return t.table(spark, sf, "part").select("p_partkey", fx.hash_bucket("p_name", 512).alias("bucket"))


@query("G14_sigmoid", """
SELECT l_orderkey, l_linenumber, l_suppkey, round_even(1.0::DOUBLE / (1.0::DOUBLE + exp(-(l_quantity - 25) / 10)), 6) AS p
FROM lineitem""")
def sigmoid(spark, sf):
    z = (F.col("l_quantity") - 25) / 10
    return t.table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_suppkey", fx.tidy(fx.sigmoid(z)).alias("p")
    )


@query("G15_dot_norm_cosine", """
WITH e AS (SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings)
SELECT a.vec_id, round_even(list_dot_product(a.v, b.v), 6) AS dot, round_even(sqrt(list_dot_product(a.v, a.v)), 6) AS norm,
  round_even(list_cosine_similarity(a.v, b.v), 6) AS cosine FROM e a JOIN e b ON b.vec_id = a.vec_id + 1""")
def dot_norm_cosine(spark, sf):
    """Each vector against the next one."""
    e = t.table(spark, sf, "embeddings").select("vec_id", vx.as_double("embedding").alias("v"))
    nxt = e.select((F.col("vec_id") - 1).alias("vec_id"), F.col("v").alias("w"))
    v, w = F.col("v"), F.col("w")
    return e.join(nxt, "vec_id").select(
        "vec_id",
        fx.tidy(vx.dot(v, w)).alias("dot"),
        fx.tidy(vx.norm(v)).alias("norm"),
        fx.tidy(vx.cosine(v, w)).alias("cosine"),
    )


@query("G16_position_table", """
WITH h AS (SELECT conv_id, turn, (max(turn) OVER (PARTITION BY conv_id) - turn) AS age FROM conversations)
SELECT conv_id, turn, round_even(sin(age), 6) AS d0, round_even(cos(age / pow(10000.0::DOUBLE, 0.5::DOUBLE)), 6) AS d1,
  round_even(sin(age / 10000.0::DOUBLE), 6) AS d2 FROM h""")
def position_table(spark, sf):
    """Encoding of each turn by its distance from the newest one."""
    c = t.table(spark, sf, "conversations")
    last = c.groupBy("conv_id").agg(F.max("turn").alias("last"))
    enc = c.join(last, "conv_id").select(
        "conv_id", "turn", vx.sinusoid(F.col("last") - F.col("turn"), 4).alias("pe")
    )
    return enc.select("conv_id", "turn", *[fx.tidy(F.col("pe")[i]).alias(f"d{i}") for i in range(3)])


@query("G17_half_even", """
SELECT l_orderkey, l_linenumber, l_suppkey, round_even(l_quantity / 16, 3)::DOUBLE AS r3,
       round_even(l_quantity / 32, 4)::DOUBLE AS r4 FROM lineitem""")
def half_even(spark, sf):
    q = F.col("l_quantity")
    return t.table(spark, sf, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        "l_suppkey",
        fx.half_even(q / 16, 3).alias("r3"),
        fx.half_even(q / 32, 4).alias("r4"),
    )


@query("G18_pad_or_cut", """
SELECT p_partkey, array_to_string((string_split(p_type || ' ' || p_name, ' ') || ['UNK', 'UNK', 'UNK', 'UNK'])[1:4], ',')
  AS words FROM part""")
def pad_or_cut(spark, sf):
    words = fx.pad_list(F.split(F.concat_ws(" ", "p_type", "p_name"), " "), 4, F.lit("UNK"))
    return t.table(spark, sf, "part").select("p_partkey", F.concat_ws(",", words).alias("words"))
