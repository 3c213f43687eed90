"""Sequences, negatives, splits."""

from __future__ import annotations

from pyspark.sql import functions as F

from tastemill.operators import sequences as s
from tastemill.operators.ordering import list_parts
from tastemill.plans import tables as t
from tastemill.plans.registry import query

ORDER = ["ts", "item_id"]


def _text(c):
    return F.concat_ws(",", F.col(c).cast("array<string>")).alias(c)


@query("X1_user_timelines", "WITH " + t.RATINGS_SQL + """, n AS (SELECT item_id, count(*) AS n FROM ratings GROUP BY 1)
SELECT user_id, (rn - 1) // 1000 AS part, string_agg(item_id, ',' ORDER BY rn) AS items, string_agg(n, ',' ORDER BY rn) AS item_counts
FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, item_id) AS rn FROM ratings JOIN n USING (item_id)) GROUP BY 1, 2""")
def user_timelines(spark, sf):
    out = s.timelines(t.ratings(spark, sf), ORDER)
    return out.select("user_id", "part", _text("items"), _text("item_counts"))


PAD = "['0','0','0','0','0','0','0','0','0','0']"


@query("X2_context_examples", "WITH " + t.RATINGS_SQL + f""",
f AS (SELECT user_id, item_id, row_number() OVER w AS pos, count(*) OVER (PARTITION BY user_id) AS n,
  list(item_id::VARCHAR) OVER (PARTITION BY user_id ORDER BY ts, item_id ROWS BETWEEN 10 PRECEDING AND 1 PRECEDING) AS c
  FROM ratings WINDOW w AS (PARTITION BY user_id ORDER BY ts, item_id))
SELECT user_id, pos, item_id AS label_item, array_to_string((c || {PAD})[1:10], ',') AS context
FROM f WHERE pos > 1 AND n >= 3""")
def context_examples(spark, sf):
    ex = s.context_examples(t.ratings(spark, sf), ORDER, 10, {"context": F.col("item_id")})
    out = s.padded(ex, 10, {"context": F.lit(0).cast("long")})
    return out.select("user_id", "pos", "label_item", _text("context"))


@query("X3_context_features", "WITH " + t.RATINGS_SQL + f""",
r AS (SELECT ratings.*, 1950 + p_size AS year, string_split(p_name, ' ') AS genres FROM ratings JOIN part ON p_partkey = item_id),
f AS (SELECT user_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, item_id) AS pos, count(*) OVER (PARTITION BY user_id) AS n,
  list(year::VARCHAR) OVER w AS y, list(CAST(rating AS INT)::VARCHAR) OVER w AS rt, flatten(list(genres) OVER w) AS g FROM r
  WINDOW w AS (PARTITION BY user_id ORDER BY ts, item_id ROWS BETWEEN 5 PRECEDING AND 1 PRECEDING))
SELECT user_id, pos, array_to_string((y || {PAD})[1:5], ',') AS years, array_to_string((rt || {PAD})[1:5], ',') AS ratings,
  array_to_string((g || ['UNK','UNK','UNK','UNK','UNK','UNK','UNK','UNK'])[1:8], ',') AS genres FROM f WHERE pos > 1 AND n >= 3""")
def context_features(spark, sf):
    """Years and ratings of 5 context items, their genres flattened and padded to 8."""
    p = t.table(spark, sf, "part").select(
        F.col("p_partkey").alias("item_id"), (F.col("p_size") + 1950).alias("year"), F.split("p_name", " ").alias("g")
    )
    rows = t.ratings(spark, sf).join(p, "item_id")
    ex = s.context_examples(
        rows, ORDER, 5, {"years": F.col("year"), "ratings": F.col("rating").cast("int"), "genres": F.col("g")}
    )
    out = s.padded(ex, 5, {"years": F.lit(0), "ratings": F.lit(0)})
    out = s.padded(out, 8, {"genres": F.lit("UNK")})
    return out.select("user_id", "pos", _text("years"), _text("ratings"), _text("genres"))


WINDOW_SQL = "WITH " + t.RATINGS_SQL + """,
l AS (SELECT user_id, list(item_id ORDER BY ts, item_id) AS l, count(*) AS n FROM ratings GROUP BY 1)"""


@query("X4_train_windows", WINDOW_SQL + """,
i AS (SELECT user_id, l, unnest(generate_series(5, n - 3 - 2)) AS i FROM l WHERE n >= 10)
SELECT user_id, i + 2 AS pos, array_to_string(l[i - 4:i], ',') AS seq, array_to_string(l[i + 1:i + 2], ',') AS target FROM i""")
def train_windows(spark, sf):
    """5 items in, 2 out; the last 3 of each user are not touched."""
    train, _ = s.sequence_windows(t.ratings(spark, sf), ORDER, 5, 2, 3)
    return train.select("user_id", "pos", _text("seq"), _text("target"))


@query("X4_test_windows", WINDOW_SQL + """
SELECT user_id, array_to_string(l[greatest(n - 7, 1):greatest(n - 3, 0)], ',') AS seq, array_to_string(l[greatest(n - 2, 1):n], ',') AS target FROM l""")
def test_windows(spark, sf):
    _, test = s.sequence_windows(t.ratings(spark, sf), ORDER, 5, 2, 3)
    return test.select("user_id", _text("seq"), _text("target"))


@query("X5_listwise_sampling", "WITH " + t.CLICKS_SQL + f""",
e AS (SELECT user_id FROM clicks GROUP BY 1 HAVING count(*) >= 5),
r AS (SELECT user_id, item_id, list_no FROM clicks JOIN e USING (user_id), generate_series(1, 20) g(list_no))
SELECT user_id, list_no::INT AS list_no, item_id, row_number() OVER (PARTITION BY user_id, list_no
  ORDER BY {t.key_sql('user_id', 'item_id', 'list_no')}, item_id) AS place FROM r QUALIFY place <= 5""")
def listwise_sampling(spark, sf):
    """20 lists of 5 items per user."""
    return s.sampled_lists(t.clicks(spark, sf).select("user_id", "item_id"), 20, 5)


@query("X6_lists_of_100", """
SELECT user_id, (rn - 1) // 100 AS part, count(*) AS n, string_agg(event_id, ',' ORDER BY rn) AS event_ids
FROM (SELECT user_id, event_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS rn FROM events) GROUP BY 1, 2""")
def lists_of_100(spark, sf):
    e = t.table(spark, sf, "events").select("user_id", "event_id", "ts")
    out = list_parts(e, ["user_id"], ["ts", "event_id"], {"event_ids": F.col("event_id")}, size=100)
    return out.select("user_id", "part", F.size("event_ids").cast("long").alias("n"), _text("event_ids"))


@query("X7_padded_lists", """
WITH l AS (SELECT l_orderkey, list(l_partkey::VARCHAR ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity) AS i,
  list(CAST(l_quantity AS INT)::VARCHAR ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity) AS q, count(*) AS n FROM lineitem GROUP BY 1)
SELECT l_orderkey, array_to_string((i || ['0','0','0','0','0','0'])[1:6], ',') AS items,
  array_to_string((q || ['-1','-1','-1','-1','-1','-1'])[1:6], ',') AS labels,
  array_to_string([(g <= n)::INT FOR g IN [1,2,3,4,5,6]], ',') AS mask FROM l""")
def padded_lists(spark, sf):
    """Order lines as lists of 6."""
    li = t.table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity")
    order = ["l_linenumber", "l_partkey", "l_suppkey", "l_quantity"]
    lists = s.first_of_each(li, ["l_orderkey"], order, 6, {"items": F.col("l_partkey"), "labels": F.col("l_quantity")})
    out = s.padded_lists(lists, 6)
    return out.select(
        "l_orderkey", _text("items"), F.concat_ws(",", F.col("labels").cast("array<int>").cast("array<string>")).alias("labels"), _text("mask")
    )


@query("X8_unseen_negatives", "WITH " + t.CLICKS_SQL + f""",
ring AS (SELECT item_id, row_number() OVER (ORDER BY {t.key_sql('item_id')}, item_id) - 1 AS idx FROM (SELECT DISTINCT item_id FROM clicks)),
n AS (SELECT count(*) AS n FROM ring),
u AS (SELECT user_id, {t.bucket_sql('(SELECT n FROM n)', 'user_id')} AS o FROM (SELECT DISTINCT user_id FROM clicks))
SELECT user_id, item_id, row_number() OVER (PARTITION BY user_id ORDER BY (idx - o + n) % n) AS rank FROM u, ring, n
WHERE NOT EXISTS (SELECT 1 FROM clicks c WHERE c.user_id = u.user_id AND c.item_id = ring.item_id) QUALIFY rank <= 10""")
def unseen_negatives(spark, sf):
    return s.unseen_negatives(t.clicks(spark, sf), 10)


@query("X9_borrowed_negatives", f"""
WITH e AS (SELECT event_id, user_id AS owner, CAST(json_extract_string(props, '$.k') AS BIGINT) AS item_id FROM events),
ring AS (SELECT *, row_number() OVER (ORDER BY {t.key_sql('event_id')}, event_id) - 1 AS idx FROM e),
n AS (SELECT count(*) AS n FROM ring),
u AS (SELECT owner AS user_id, {t.bucket_sql('(SELECT n FROM n)', 'owner')} AS o FROM (SELECT DISTINCT owner FROM e))
SELECT user_id, item_id, 0 AS like, row_number() OVER (PARTITION BY user_id ORDER BY (idx - o + n) % n) AS rank FROM u, ring, n
WHERE owner <> user_id QUALIFY rank <= 80""")
def borrowed_negatives(spark, sf):
    return s.borrowed_negatives(t.click_events(spark, sf), ["event_id"], 80)


@query("X10_balanced_labels", "WITH " + t.RATINGS_SQL + """,
m AS (SELECT item_id, round_even(avg(rating), 3)::DOUBLE AS mean FROM ratings GROUP BY 1),
r AS (SELECT user_id, item_id, CAST(rating >= 25 AS INT) AS label, mean, ts FROM ratings JOIN m USING (item_id)),
p AS (SELECT *, row_number() OVER (PARTITION BY user_id, label ORDER BY CASE WHEN label = 0 THEN -mean ELSE 0 END, ts, item_id) AS pos,
  least(sum(label) OVER (PARTITION BY user_id), sum(1 - label) OVER (PARTITION BY user_id)) AS take FROM r)
SELECT user_id, item_id, label FROM p WHERE pos <= take""")
def balanced_labels(spark, sf):
    return s.balanced_labels(t.ratings(spark, sf), 25.0, ORDER)


@query("X11_random_split", f"""
SELECT o_orderkey, CASE WHEN {t.bucket_sql(10000, 'o_orderkey')} < 8000 THEN 'train' ELSE 'test' END AS split FROM orders""")
def random_split(spark, sf):
    return s.random_split(t.table(spark, sf, "orders").select("o_orderkey"), 0.8, "o_orderkey")


@query("X12_latest_as_test", "WITH " + t.RATINGS_SQL + """
SELECT user_id, item_id, CASE WHEN row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, item_id DESC) = 1
  THEN 'test' ELSE 'train' END AS split FROM ratings""")
def latest_as_test(spark, sf):
    return s.latest_as_test(t.ratings(spark, sf).select("user_id", "item_id", "ts"), ORDER).drop("ts")


@query("X13_chronological_split", """
WITH p AS (SELECT event_id, row_number() OVER (ORDER BY ts, event_id) - 1 AS i, count(*) OVER () AS n FROM events)
SELECT event_id, CASE WHEN i < n * 0.8::DOUBLE THEN 'train' WHEN i < n * 0.9::DOUBLE THEN 'valid' ELSE 'test' END AS split FROM p""")
def chronological_split(spark, sf):
    e = t.table(spark, sf, "events").select("event_id", "ts")
    return s.chronological_split(e, ["ts", "event_id"]).drop("ts")


@query("X14_per_user_split", "WITH " + t.RATINGS_SQL + f""",
p AS (SELECT user_id, item_id, row_number() OVER (PARTITION BY user_id ORDER BY {t.key_sql('user_id', 'item_id')}, user_id, item_id) AS pos,
  count(*) OVER (PARTITION BY user_id) AS n FROM ratings)
SELECT user_id, item_id, CASE WHEN pos <= greatest(1, floor(n * 0.75::DOUBLE + 0.5::DOUBLE)) THEN 'train' ELSE 'test' END AS split FROM p""")
def per_user_split(spark, sf):
    r = t.ratings(spark, sf).select("user_id", "item_id")
    return s.stratified_split(r, "user_id", 0.75, "user_id", "item_id")


@query("X15_label_stratified_split", f"""
WITH p AS (SELECT doc_id, quality, row_number() OVER (PARTITION BY quality ORDER BY {t.key_sql('doc_id')}, doc_id) AS pos,
  count(*) OVER (PARTITION BY quality) AS n FROM labels)
SELECT doc_id, quality, CASE WHEN pos <= greatest(1, floor(n * 0.8::DOUBLE + 0.5::DOUBLE)) THEN 'train' ELSE 'test' END AS split FROM p""")
def label_stratified_split(spark, sf):
    return s.stratified_split(t.table(spark, sf, "labels").select("doc_id", "quality"), "quality", 0.8, "doc_id")


@query("X16_folds", f"SELECT doc_id, {t.bucket_sql(5, 'doc_id')} AS fold FROM labels")
def folds(spark, sf):
    return s.folds(t.table(spark, sf, "labels").select("doc_id"), 5, "doc_id")
