"""Item, user and rating similarities and the suggestions built on them."""

from __future__ import annotations

from pyspark.sql import functions as F

from tastemill.operators import similarity as sim
from tastemill.operators.pairs import pair_sums
from tastemill.plans import tables as t
from tastemill.plans.registry import query


def _cooc_sql(group: str, member: str, weight: str) -> str:
    """CTE ``sim(a, b, score)`` with a < b."""
    w = {
        "base": "1.0::DOUBLE",
        "damped": "1.0::DOUBLE / log10(1.0::DOUBLE + g.n)",
        "decay": "1.0::DOUBLE / (1.0::DOUBLE + abs(x.ts - y.ts) / 86400.0::DOUBLE)",
    }[weight]
    return f""", gsize AS (SELECT {group} AS g, count(*) AS n FROM ratings GROUP BY 1),
msize AS (SELECT {member} AS m, count(*) AS n FROM ratings GROUP BY 1),
sim0 AS (
  SELECT x.{member} AS a, y.{member} AS b, sum({w}) AS s
  FROM ratings x JOIN ratings y ON x.{group} = y.{group} AND x.{member} < y.{member}
  JOIN gsize g ON g.g = x.{group}
  GROUP BY 1, 2),
sim AS (
  SELECT a, b, round_even(s / sqrt(p.n::DOUBLE * q.n::DOUBLE), 6) AS score
  FROM sim0 JOIN msize p ON p.m = a JOIN msize q ON q.m = b),
sims2 AS (SELECT a, b, score FROM sim UNION ALL SELECT b, a, score FROM sim)"""


def _top_sql(k: int, name: str = "near") -> str:
    return f""", {name} AS (
  SELECT a, b, score, row_number() OVER (PARTITION BY a ORDER BY score DESC, b) AS rank
  FROM sims2 QUALIFY rank <= {k})"""


def _item_sim_sql(weight: str) -> str:
    return "WITH " + t.RATINGS_SQL + _cooc_sql("user_id", "item_id", weight) + _top_sql(10)


def _user_sim_sql(weight: str) -> str:
    return "WITH " + t.RATINGS_SQL + _cooc_sql("item_id", "user_id", weight) + _top_sql(10)


ITEM_OUT = " SELECT a AS item_id, b AS similar_id, score, rank FROM near"
USER_OUT = " SELECT a AS user_id, b AS similar_id, score, rank FROM near"


@query(
    "C7_self_join_pairs",
    "WITH "
    + t.RATINGS_SQL
    + """ SELECT x.item_id AS a, y.item_id AS b, count(*) AS shared
  FROM ratings x JOIN ratings y ON x.user_id = y.user_id AND x.item_id < y.item_id
  GROUP BY 1, 2 HAVING count(*) >= 3""",
)
def item_pairs(spark, sf):
    """Item pairs with the number of users they share, at least 3."""
    pairs = pair_sums(t.ratings(spark, sf), "user_id", "item_id", {"shared": F.lit(1)})
    return pairs.filter(F.col("shared") >= 3)


def _item_sim(spark, sf, weight):
    near = sim.most_similar(t.ratings(spark, sf), "user_id", "item_id", 10, weight)
    return near.withColumnsRenamed({"a": "item_id", "b": "similar_id"})


def _user_sim(spark, sf, weight):
    near = sim.most_similar(t.ratings(spark, sf), "item_id", "user_id", 10, weight)
    return near.withColumnsRenamed({"a": "user_id", "b": "similar_id"})


@query("I1_item_similarity_decay", _item_sim_sql("decay") + ITEM_OUT)
def item_similarity_decay(spark, sf):
    return _item_sim(spark, sf, "decay")


@query("I2_item_similarity_base", _item_sim_sql("base") + ITEM_OUT)
def item_similarity_base(spark, sf):
    return _item_sim(spark, sf, "base")


@query("I2_item_similarity_damped", _item_sim_sql("damped") + ITEM_OUT)
def item_similarity_damped(spark, sf):
    return _item_sim(spark, sf, "damped")


@query(
    "I3_item_based_recommend",
    "WITH "
    + t.RATINGS_SQL
    + _cooc_sql("user_id", "item_id", "decay")
    + _top_sql(5)
    + """, seed AS (
  SELECT user_id, item_id FROM ratings
  QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, item_id) <= 3)
SELECT s.user_id, n.b AS item_id, round_even(sum(n.score), 6) AS score
FROM seed s JOIN near n ON n.a = s.item_id
WHERE NOT EXISTS (SELECT 1 FROM ratings r WHERE r.user_id = s.user_id AND r.item_id = n.b)
GROUP BY 1, 2""",
)
def item_based_recommend(spark, sf):
    """3 latest items of each user, 5 neighbours each, unseen only."""
    r = t.ratings(spark, sf)
    near = sim.most_similar(r, "user_id", "item_id", 5, "decay")
    return sim.item_based(r, near, 3, [F.desc("ts"), F.col("item_id")])


@query("I4_user_similarity_decay", _user_sim_sql("decay") + USER_OUT)
def user_similarity_decay(spark, sf):
    return _user_sim(spark, sf, "decay")


@query("I4_user_similarity_base", _user_sim_sql("base") + USER_OUT)
def user_similarity_base(spark, sf):
    return _user_sim(spark, sf, "base")


@query("I4_user_similarity_damped", _user_sim_sql("damped") + USER_OUT)
def user_similarity_damped(spark, sf):
    return _user_sim(spark, sf, "damped")


@query(
    "I5_user_based_recommend",
    "WITH "
    + t.RATINGS_SQL
    + _cooc_sql("item_id", "user_id", "decay")
    + _top_sql(3)
    + """, firsts AS (
  SELECT user_id, item_id FROM ratings
  QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, item_id) <= 5)
SELECT n.a AS user_id, f.item_id, max(n.score) AS score
FROM near n JOIN firsts f ON f.user_id = n.b
WHERE NOT EXISTS (SELECT 1 FROM ratings r WHERE r.user_id = n.a AND r.item_id = f.item_id)
GROUP BY 1, 2""",
)
def user_based_recommend(spark, sf):
    """3 nearest users, their 5 latest items, best score kept, unseen only."""
    r = t.ratings(spark, sf)
    near = sim.most_similar(r, "item_id", "user_id", 3, "decay")
    return sim.user_based(r, near, 5, [F.desc("ts"), F.col("item_id")])


@query(
    "I6_user_cf_top_n",
    "WITH "
    + t.RATINGS_SQL
    + _cooc_sql("item_id", "user_id", "base")
    + _top_sql(20)
    + """, scored AS (
  SELECT n.a AS user_id, r.item_id, round_even(sum(n.score), 6) AS score
  FROM near n JOIN ratings r ON r.user_id = n.b
  WHERE NOT EXISTS (SELECT 1 FROM ratings s WHERE s.user_id = n.a AND s.item_id = r.item_id)
  GROUP BY 1, 2)
SELECT user_id, item_id, score, row_number() OVER (PARTITION BY user_id ORDER BY score DESC, item_id) AS rank
FROM scored QUALIFY rank <= 10""",
)
def user_cf_top_n(spark, sf):
    return sim.user_top_n(t.ratings(spark, sf), 20, 10)


@query(
    "I7_item_cf_top_n",
    "WITH "
    + t.RATINGS_SQL
    + _cooc_sql("user_id", "item_id", "base")
    + _top_sql(20)
    + """, scored AS (
  SELECT r.user_id, n.b AS item_id, round_even(sum(n.score), 6) AS score
  FROM ratings r JOIN near n ON n.a = r.item_id
  WHERE NOT EXISTS (SELECT 1 FROM ratings s WHERE s.user_id = r.user_id AND s.item_id = n.b)
  GROUP BY 1, 2)
SELECT user_id, item_id, score, row_number() OVER (PARTITION BY user_id ORDER BY score DESC, item_id) AS rank
FROM scored QUALIFY rank <= 10""",
)
def item_cf_top_n(spark, sf):
    return sim.item_top_n(t.ratings(spark, sf), 20, 10)


# --- Pearson ------------------------------------------------------------------
# Rated pairs come from the click events, where every user meets many items
# of a small catalogue: value is the rating.

VALUED_SQL = """valued AS (
  SELECT user_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS item_id,
         CAST(floor(max(value)) AS DOUBLE) AS rating FROM events GROUP BY 1, 2)"""


def _valued(spark, sf):
    return t.click_events(spark, sf).groupBy("user_id", "item_id").agg(
        F.floor(F.max("value")).cast("double").alias("rating")
    )


def _pearson_sql(group: str, member: str) -> str:
    return f""", s AS (
  SELECT x.{member} AS a, y.{member} AS b, count(*)::DOUBLE AS n, sum(x.rating) AS x, sum(y.rating) AS y,
         sum(x.rating * y.rating) AS xy, sum(x.rating * x.rating) AS xx, sum(y.rating * y.rating) AS yy
  FROM valued x JOIN valued y ON x.{group} = y.{group} AND x.{member} < y.{member} GROUP BY 1, 2),
sim AS (
  SELECT a, b, round_even((n * xy - x * y) / nullif(sqrt(greatest(n * xx - x * x, 0) * greatest(n * yy - y * y, 0)), 0), 6)
         AS score FROM s),
sims2 AS (SELECT a, b, score FROM sim WHERE score IS NOT NULL
         UNION ALL SELECT b, a, score FROM sim WHERE score IS NOT NULL)"""


def _predict_sql(member: str, other: str) -> str:
    return f""", means AS (SELECT {member} AS m, avg(rating) AS mean FROM valued GROUP BY 1),
wanted AS (
  SELECT t.user_id, t.item_id, b.b AS v, b.score, r.rating - q.mean AS dev
  FROM valued t JOIN sims2 b ON b.a = t.{member}
  JOIN valued r ON r.{other} = t.{other} AND r.{member} = b.b JOIN means q ON q.m = b.b
  QUALIFY row_number() OVER (PARTITION BY t.user_id, t.item_id ORDER BY b.score DESC, b.b) <= 2)
SELECT user_id, item_id,
       round_even(any_value(mean) + sum(score * dev) / nullif(round_even(sum(score), 6), 0), 5) AS prediction
FROM wanted JOIN means ON m = {member} GROUP BY 1, 2"""


@query("I8_user_pearson", "WITH " + VALUED_SQL + _pearson_sql("item_id", "user_id") + " SELECT a, b, score FROM sims2 WHERE a < b")
def user_pearson(spark, sf):
    return sim.pearson(_valued(spark, sf), "item_id", "user_id")


@query("I8_user_pearson_predict", "WITH " + VALUED_SQL + _pearson_sql("item_id", "user_id") + _predict_sql("user_id", "item_id"))
def user_pearson_predict(spark, sf):
    """Every rated pair predicted from the 2 nearest other users who rated the item."""
    v = _valued(spark, sf)
    return sim.predict_from_raters(v, sim.nearest_raters(v, v, 2))


@query("I9_item_pearson", "WITH " + VALUED_SQL + _pearson_sql("user_id", "item_id") + " SELECT a, b, score FROM sims2 WHERE a < b")
def item_pearson(spark, sf):
    return sim.pearson(_valued(spark, sf), "user_id", "item_id")


@query("I9_item_pearson_predict", "WITH " + VALUED_SQL + _pearson_sql("user_id", "item_id") + _predict_sql("item_id", "user_id"))
def item_pearson_predict(spark, sf):
    """Every rated pair predicted from the 2 nearest other items the user rated."""
    v = _valued(spark, sf)
    return sim.predict_from_items(v, sim.pearson(v, "user_id", "item_id"), v, 2)


@query(
    "I10_swing",
    "WITH "
    + t.RATINGS_SQL
    + """, up AS (
  SELECT x.user_id AS u, y.user_id AS v, x.item_id FROM ratings x
  JOIN ratings y ON x.item_id = y.item_id AND x.user_id < y.user_id),
ov AS (SELECT u, v, count(*) AS c FROM up GROUP BY 1, 2 HAVING count(*) >= 2),
cm AS (SELECT up.u, up.v, up.item_id, 1.0::DOUBLE / (0.5::DOUBLE + c) AS w FROM up JOIN ov ON up.u = ov.u AND up.v = ov.v),
sim AS (
  SELECT x.item_id AS a, y.item_id AS b, round_even(sum(x.w), 6) AS score
  FROM cm x JOIN cm y ON x.u = y.u AND x.v = y.v AND x.item_id < y.item_id GROUP BY 1, 2),
sims2 AS (SELECT a, b, score FROM sim UNION ALL SELECT b, a, score FROM sim)"""
    + _top_sql(2)
    + ITEM_OUT,
)
def swing(spark, sf):
    """2 best partners of each item by swing score."""
    near = sim.neighbours(sim.swing(t.ratings(spark, sf)), 2)
    return near.withColumnsRenamed({"a": "item_id", "b": "similar_id"})


WEIGHTED_SQL = """ev AS (
  SELECT user_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS item_id,
         CAST(floor(epoch(ts)) AS BIGINT) AS ts,
         CASE event_type WHEN 'purchase' THEN 3.0 WHEN 'click' THEN 2.0 ELSE 1.0 END::DOUBLE AS w FROM events)"""


@query(
    "I11_sar_top_k",
    "WITH "
    + WEIGHTED_SQL
    + """, taken AS (
  SELECT user_id, item_id,
         sum(w * pow(2.0::DOUBLE, -(((SELECT max(ts) FROM ev) - ts) / 86400.0::DOUBLE) / 30.0::DOUBLE)) AS aff
  FROM ev GROUP BY 1, 2),
cnt AS (SELECT item_id, count(*) AS n FROM taken GROUP BY 1),
co AS (SELECT x.item_id AS a, y.item_id AS b, count(*)::DOUBLE AS c FROM taken x
  JOIN taken y ON x.user_id = y.user_id GROUP BY 1, 2),
sims AS (SELECT a, b, c / (p.n + q.n - c) AS score FROM co JOIN cnt p ON p.item_id = a JOIN cnt q ON q.item_id = b),
raw AS (SELECT user_id, b AS item_id, sum(aff * score) AS raw, sum(score) AS unit
  FROM taken JOIN sims ON a = item_id GROUP BY 1, 2),
ends AS (SELECT user_id,
   CASE WHEN count(*) < (SELECT count(DISTINCT item_id) FROM ev) THEN 0.0 ELSE min(unit) END * (SELECT min(w) FROM ev) AS lo,
   max(unit) * (SELECT max(w) FROM ev) AS hi FROM raw GROUP BY 1),
scored AS (
  SELECT r.user_id, r.item_id, round_even((SELECT min(w) FROM ev) + ((SELECT max(w) FROM ev) - (SELECT min(w) FROM ev))
      * ((raw - lo) / nullif(hi - lo, 0)), 6) AS score
  FROM raw r JOIN ends e ON e.user_id = r.user_id
  WHERE NOT EXISTS (SELECT 1 FROM taken k WHERE k.user_id = r.user_id AND k.item_id = r.item_id))
SELECT user_id, item_id, score, row_number() OVER (PARTITION BY user_id ORDER BY score DESC, item_id) AS rank
FROM scored QUALIFY rank <= 10""",
)
def sar_top_k(spark, sf):
    w = F.when(F.col("event_type") == "purchase", 3.0).when(F.col("event_type") == "click", 2.0).otherwise(1.0)
    ev = t.click_events(spark, sf).select("user_id", "item_id", "ts", w.alias("w"))
    return sim.sar(ev, F.col("w"))


@query(
    "I12_rating_vector_knn",
    "WITH "
    + t.RATINGS_SQL
    + """, nrm AS (SELECT item_id, sqrt(sum(rating * rating)) AS l FROM ratings GROUP BY 1),
d AS (SELECT x.item_id AS a, y.item_id AS b, sum(x.rating * y.rating) AS d FROM ratings x
  JOIN ratings y ON x.user_id = y.user_id AND x.item_id <> y.item_id GROUP BY 1, 2),
near AS (SELECT a, b, round_even(1.0::DOUBLE - d / (p.l * q.l), 6) AS distance
  FROM d JOIN nrm p ON p.item_id = a JOIN nrm q ON q.item_id = b
  UNION ALL SELECT item_id, item_id, 0.0::DOUBLE FROM nrm)
SELECT a AS item_id, b AS similar_id, distance, row_number() OVER (PARTITION BY a ORDER BY distance, b) AS rank
FROM near QUALIFY rank <= 6""",
)
def rating_vector_knn(spark, sf):
    near = sim.rating_vector_neighbours(t.ratings(spark, sf), 6)
    return near.withColumnsRenamed({"a": "item_id", "b": "similar_id"})
