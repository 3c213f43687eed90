"""Joins (C1-C6, C8-C11); C7 stands with the similarities."""

from __future__ import annotations

from pyspark.sql import functions as F

from tastemill.functions import scalar as fx
from tastemill.operators import joins as j
from tastemill.operators.ordering import top_k
from tastemill.operators.similarity import drop_seen
from tastemill.plans import tables as t
from tastemill.plans.registry import query

# The eight reference points (latitude, longitude).
CENTROIDS = [
    (36.68147669256268, -82.8910274009993),
    (23.22243322909555, 78.23027450833709),
    (50.04997682638993, 0.22379313938744885),
    (37.9309447099281, -117.00741350764692),
    (-32.795864819917725, 148.7159172660312),
    (-18.570548393114084, -54.280255665692565),
    (13.921140442819565, 116.38740315555172),
    (29.78951080730802, 40.279515865947936),
]


@query("C1_inner_join_titles", """
SELECT l_orderkey, l_linenumber, l_suppkey, p_partkey AS item_id, p_name AS title
FROM lineitem JOIN part ON l_partkey = p_partkey""")
def inner_join_titles(spark, sf):
    li = t.table(spark, sf, "lineitem")
    p = t.table(spark, sf, "part")
    return li.join(p, li.l_partkey == p.p_partkey).select(
        "l_orderkey", "l_linenumber", "l_suppkey", F.col("p_partkey").alias("item_id"), F.col("p_name").alias("title")
    )


@query("C2_left_join_labels", """
SELECT d.doc_id, d.lang, l.quality FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id""")
def left_join_labels(spark, sf):
    d = t.table(spark, sf, "documents").select("doc_id", "lang")
    return d.join(t.table(spark, sf, "labels").select("doc_id", "quality"), "doc_id", "left")


@query("C3_shown_until_last_click", "WITH " + t.LOG_SQL + """
SELECT v._token_associate_id AS user_id, v._id AS item_id, v.click AS rating
FROM log v JOIN (SELECT "traceId", max("resPos") AS m FROM log WHERE click_object_id IS NOT NULL GROUP BY 1) c
  ON v."traceId" = c."traceId" AND v."resPos" <= c.m WHERE v.action = 'actions'""")
def shown_until_last_click(spark, sf):
    log = t.click_log(spark, sf, with_position=True)
    return j.shown_until_last_click(log).filter(F.col("action") == "actions").select(
        F.col("_token_associate_id").alias("user_id"), F.col("_id").alias("item_id"), F.col("click").alias("rating")
    )


@query("C4_lookup_with_default", """
WITH sc AS (SELECT l_partkey AS k, avg(l_quantity) AS s FROM lineitem GROUP BY 1 HAVING count(*) >= 30)
SELECT p_partkey, coalesce(round_even(s, 6), 0.0) AS score FROM part LEFT JOIN sc ON k = p_partkey""")
def lookup_with_default(spark, sf):
    sc = (
        t.table(spark, sf, "lineitem")
        .groupBy(F.col("l_partkey").alias("p_partkey"))
        .agg(F.count(F.lit(1)).alias("n"), fx.tidy(F.avg("l_quantity"), 6).alias("score"))
        .filter(F.col("n") >= 30)
    )
    return j.lookup(t.table(spark, sf, "part").select("p_partkey"), sc, "p_partkey", "score", 0.0)


@query("C5_known_items", """
SELECT l_orderkey, l_linenumber, l_suppkey FROM lineitem
WHERE l_partkey IN (SELECT p_partkey FROM part WHERE p_size <= 10)""")
def known_items(spark, sf):
    known = t.table(spark, sf, "part").filter(F.col("p_size") <= 10).select(F.col("p_partkey").alias("l_partkey"))
    li = t.table(spark, sf, "lineitem")
    return li.join(known, "l_partkey", "left_semi").select("l_orderkey", "l_linenumber", "l_suppkey")


@query("C6_remove_seen", "WITH " + t.RATINGS_SQL + """,
nat AS (SELECT c_custkey, c_nationkey FROM customer),
pop AS (SELECT c_nationkey, item_id, count(*) AS n FROM ratings JOIN nat ON user_id = c_custkey GROUP BY 1, 2
  QUALIFY row_number() OVER (PARTITION BY c_nationkey ORDER BY count(*) DESC, item_id) <= 10)
SELECT c_custkey AS user_id, item_id, n FROM nat JOIN pop USING (c_nationkey)
WHERE NOT EXISTS (SELECT 1 FROM ratings r WHERE r.user_id = c_custkey AND r.item_id = pop.item_id)""")
def remove_seen(spark, sf):
    """Ten most taken items of the user's nation, those the user has removed."""
    r = t.ratings(spark, sf)
    nat = t.table(spark, sf, "customer").select(F.col("c_custkey").alias("user_id"), "c_nationkey")
    counts = r.join(nat, "user_id").groupBy("c_nationkey", "item_id").agg(F.count(F.lit(1)).alias("n"))
    pop = top_k(counts, ["c_nationkey"], [F.desc("n"), "item_id"], 10)
    return drop_seen(nat.join(pop, "c_nationkey"), r).select("user_id", "item_id", "n")


@query("C9_label_candidates", "WITH " + t.RATINGS_SQL + """,
nat AS (SELECT c_custkey AS user_id, c_nationkey FROM customer),
pop AS (SELECT c_nationkey, item_id, row_number() OVER (PARTITION BY c_nationkey ORDER BY count(*) DESC, item_id) AS rank
  FROM ratings JOIN nat USING (user_id) GROUP BY 1, 2 QUALIFY rank <= 10)
SELECT nat.user_id, string_agg(pop.item_id, ',' ORDER BY rank) AS items,
       string_agg(CAST(coalesce(rating, 0) AS INTEGER), ',' ORDER BY rank) AS labels
FROM nat JOIN pop USING (c_nationkey) LEFT JOIN ratings r ON r.user_id = nat.user_id AND r.item_id = pop.item_id
GROUP BY 1""")
def label_candidates(spark, sf):
    """Ten candidates per user with the true rating or 0, regrouped to lists by rank."""
    r = t.ratings(spark, sf)
    nat = t.table(spark, sf, "customer").select(F.col("c_custkey").alias("user_id"), "c_nationkey")
    counts = r.join(nat, "user_id").groupBy("c_nationkey", "item_id").agg(F.count(F.lit(1)).alias("n"))
    pop = top_k(counts, ["c_nationkey"], [F.desc("n"), "item_id"], 10)
    cand = nat.join(pop, "c_nationkey").select("user_id", "item_id", "rank")
    labelled = j.label_candidates(cand, r, ["user_id", "item_id"], "rating")
    row = F.struct("rank", "item_id", F.col("rating").cast("int").cast("string").alias("rating"))
    lists = labelled.groupBy("user_id").agg(F.sort_array(F.collect_list(row)).alias("l"))  # 10 rows per user
    return lists.select(
        "user_id",
        F.concat_ws(",", F.col("l.item_id").cast("array<string>")).alias("items"),
        F.concat_ws(",", F.col("l.rating")).alias("labels"),
    )


def _point_sql() -> str:
    cells = " UNION ALL ".join(f"SELECT {i} AS i, {a}::DOUBLE AS a, {b}::DOUBLE AS b" for i, (a, b) in enumerate(CENTROIDS))
    return f"""WITH c AS ({cells}),
pt AS (SELECT c_custkey, c_acctbal / 100 - 10 AS lat, (c_custkey % 361) - 180.0::DOUBLE AS lon FROM customer)
SELECT c_custkey, i AS centroid FROM pt, c
QUALIFY row_number() OVER (PARTITION BY c_custkey ORDER BY (lat - a) * (lat - a) + (lon - b) * (lon - b), i) = 1"""


@query("C10_nearest_centroid", _point_sql())
def nearest_centroid(spark, sf):
    lat = F.col("c_acctbal") / 100 - 10
    lon = (F.col("c_custkey") % 361).cast("double") - 180.0
    return t.table(spark, sf, "customer").select(
        "c_custkey", j.nearest_reference(lat, lon, CENTROIDS).alias("centroid")
    )


@query("C11_scoring_grid", """
WITH b AS (SELECT DISTINCT p_brand FROM part), y AS (SELECT DISTINCT p_type FROM part), s AS (SELECT DISTINCT p_size FROM part),
st AS (SELECT p_brand, p_type, p_size, avg(p_retailprice) AS price FROM part GROUP BY 1, 2, 3)
SELECT b.p_brand, y.p_type, s.p_size, coalesce(round_even(price, 2), 0.0) AS score FROM b, y, s
LEFT JOIN st ON st.p_brand = b.p_brand AND st.p_type = y.p_type AND st.p_size = s.p_size""")
def scoring_grid(spark, sf):
    """Every combination of brand, type and size, scored by the mean price seen for it."""
    p = t.table(spark, sf, "part")
    cells = j.grid([p.select(x).distinct() for x in ("p_brand", "p_type", "p_size")])
    price = p.groupBy("p_brand", "p_type", "p_size").agg(fx.tidy(F.avg("p_retailprice"), 2).alias("score"))
    return cells.join(price, ["p_brand", "p_type", "p_size"], "left").select(
        "p_brand", "p_type", "p_size", F.coalesce("score", F.lit(0.0)).alias("score")
    )
