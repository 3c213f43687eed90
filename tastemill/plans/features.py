"""Feature encoding."""

from __future__ import annotations

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from tastemill.functions import scalar as fx
from tastemill.functions import vector as vx
from tastemill.operators import content as c
from tastemill.operators import features as f
from tastemill.operators import retrieval as r
from tastemill.operators import sequences as s
from tastemill.operators.ordering import dense_index, position
from tastemill.plans import tables as t
from tastemill.plans.content import TOKENS_SQL
from tastemill.plans.registry import query

STOP_WORDS = ["the", "and", "of", "de", "la"]


@query("H1_id_vocabulary", """
WITH v AS (SELECT l_partkey, row_number() OVER (ORDER BY l_partkey) AS idx
  FROM (SELECT DISTINCT l_partkey FROM lineitem WHERE l_returnflag = 'R'))
SELECT p_partkey, coalesce(idx, 0) AS idx FROM part LEFT JOIN v ON l_partkey = p_partkey""")
def id_vocabulary(spark, sf):
    """Parts numbered by the vocabulary of returned parts, others 0."""
    seen = t.table(spark, sf, "lineitem").filter("l_returnflag = 'R'").select(F.col("l_partkey").alias("p_partkey"))
    vocab = dense_index(seen, "p_partkey")
    return f.index_column(t.table(spark, sf, "part").select("p_partkey"), vocab, "p_partkey", "idx")


@query("H2_remap_ids", "WITH " + t.CLICKS_SQL + """,
u AS (SELECT user_id, row_number() OVER (ORDER BY user_id) AS user_idx FROM (SELECT DISTINCT user_id FROM clicks)),
i AS (SELECT item_id, row_number() OVER (ORDER BY item_id) AS item_idx FROM (SELECT DISTINCT item_id FROM clicks))
SELECT user_id, item_id, user_idx, item_idx FROM clicks JOIN u USING (user_id) JOIN i USING (item_id)""")
def remap_ids(spark, sf):
    cl = t.clicks(spark, sf).select("user_id", "item_id")
    out = f.index_column(cl, dense_index(cl, "user_id"), "user_id", "user_idx").drop("idx")
    return f.index_column(out, dense_index(cl, "item_id"), "item_id", "item_idx").drop("idx")


@query("H3_label_encoder", """
SELECT p_partkey, CAST(dense_rank() OVER (ORDER BY p_brand) - 1 AS BIGINT) AS brand_code FROM part""")
def label_encoder(spark, sf):
    p = t.table(spark, sf, "part").select("p_partkey", "p_brand")
    codes = dense_index(p, "p_brand", start=0)
    return f.index_column(p, codes, "p_brand", "brand_code", -1).select("p_partkey", "brand_code")


FREQ_SQL = """codes AS (SELECT p_type, row_number() OVER (ORDER BY count(*) DESC, p_type) - 1 AS idx FROM part
  WHERE p_size <= 40 GROUP BY 1)"""


@query("H4_one_hot", f"""WITH {FREQ_SQL}
SELECT p_partkey, array_to_string([(coalesce(idx, -1) = g)::INT FOR g IN range(n)], '') AS hot
FROM part LEFT JOIN codes USING (p_type), (SELECT count(*) AS n FROM codes)""")
def one_hot(spark, sf):
    """Codes by falling frequency among parts up to size 40, applied to all parts."""
    p = t.table(spark, sf, "part").select("p_partkey", "p_type", "p_size")
    codes = f.frequency_index(p.filter("p_size <= 40"), "p_type")
    out = p.join(codes, "p_type", "left")
    out = out.withColumn("width", f.vocabulary_size(codes))
    hot = f.one_hot(F.col("idx"), F.col("width"))
    return out.select("p_partkey", F.concat_ws("", hot.cast("array<string>")).alias("hot"))


GAPS_SQL = """gaps AS (SELECT c_custkey, CASE WHEN c_custkey % 7 = 0 THEN NULL ELSE c_acctbal END AS bal,
  CASE WHEN c_custkey % 5 = 0 THEN NULL ELSE c_mktsegment END AS seg FROM customer)"""


def _gaps(spark, sf):
    k = F.col("c_custkey")
    return t.table(spark, sf, "customer").select(
        "c_custkey",
        F.when(k % 7 != 0, F.col("c_acctbal")).alias("bal"),
        F.when(k % 5 != 0, F.col("c_mktsegment")).alias("seg"),
    )


@query("H5_impute", f"""WITH {GAPS_SQL}
SELECT c_custkey, round_even(coalesce(bal, (SELECT avg(bal) FROM gaps)), 4) AS bal,
  coalesce(seg, (SELECT seg FROM gaps WHERE seg IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, seg LIMIT 1)) AS seg FROM gaps""")
def impute(spark, sf):
    return f.impute(_gaps(spark, sf), ["bal"], ["seg"]).withColumn("bal", fx.tidy("bal", 4))


@query("H6_standardise", """
WITH s AS (SELECT avg(c_acctbal) AS m, stddev_pop(c_acctbal) AS d FROM customer WHERE c_custkey % 4 <> 0)
SELECT c_custkey, round_even((c_acctbal - m) / d, 6) AS c_acctbal FROM customer, s""")
def standardise(spark, sf):
    cu = t.table(spark, sf, "customer").select("c_custkey", "c_acctbal")
    out = f.standardise(cu, cu.filter("c_custkey % 4 <> 0"), ["c_acctbal"])
    return out.select("c_custkey", fx.tidy(F.col("c_acctbal")).alias("c_acctbal"))


@query("H7_min_max", """
SELECT event_id, round_even((value - (SELECT min(value) FROM events)) / (SELECT max(value) - min(value) FROM events), 6) AS p FROM events""")
def min_max(spark, sf):
    out = f.min_max(t.table(spark, sf, "events").select("event_id", "value"), "value", "p")
    return out.select("event_id", fx.tidy(F.col("p")).alias("p"))


@query("H8_ordinal_encode", f"""
WITH v AS (SELECT p_name, row_number() OVER (ORDER BY p_name) AS idx FROM (SELECT DISTINCT p_name FROM part
  WHERE {t.bucket_sql(10000, 'p_partkey')} < 8000))
SELECT p_partkey, coalesce(idx, -1) AS code FROM part LEFT JOIN v USING (p_name)""")
def ordinal_encode(spark, sf):
    """Codes from the training part, unseen names -1."""
    p = s.random_split(t.table(spark, sf, "part").select("p_partkey", "p_name"), 0.8, "p_partkey")
    codes = dense_index(p.filter("split = 'train'"), "p_name")
    return f.index_column(p, codes, "p_name", "code", -1).select("p_partkey", "code")


@query("H9_rare_and_missing", f"""WITH w AS (SELECT c_custkey, CASE WHEN c_custkey % 5 = 0 THEN NULL ELSE c_nationkey::VARCHAR END AS nat FROM customer),
n AS (SELECT nat, count(*) AS n FROM w GROUP BY 1)
SELECT c_custkey, CASE WHEN w.nat IS NULL THEN 'UNK' WHEN n < 50 THEN 'LESS' ELSE w.nat END AS nat
FROM w LEFT JOIN n ON n.nat = w.nat""")
def rare_and_missing(spark, sf):
    w = t.table(spark, sf, "customer").select(
        "c_custkey", F.when(F.col("c_custkey") % 5 != 0, F.col("c_nationkey").cast("string")).alias("nat")
    )
    return f.rare_and_missing(w, "nat", 50)


SEQ_SQL = """s AS (SELECT event_id, event_type, CAST(value >= 50 AS BIGINT) AS y, ts FROM events),
enc AS (SELECT event_id, sum(y) OVER w AS sy, count(*) OVER w AS c, row_number() OVER (ORDER BY ts, event_id) AS i FROM s
  WINDOW w AS (PARTITION BY event_type ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))"""


def _encoded(spark, sf):
    e = t.table(spark, sf, "events").select(
        "event_id", "event_type", "ts", (F.col("value") >= 50).cast("long").alias("y")
    )
    return f.sequential_encoding(e, "event_type", "y", ["ts", "event_id"])


@query("H10_sequential_target", f"WITH {SEQ_SQL} SELECT event_id, round_even(sy::DOUBLE / nullif(c, 0), 6) AS target FROM enc")
def sequential_target(spark, sf):
    return _encoded(spark, sf).select("event_id", fx.tidy(F.col("target")).alias("target"))


@query("H11_sequential_count", f"WITH {SEQ_SQL} SELECT event_id, round_even(c::DOUBLE / nullif(i - 1, 0), 6) AS share FROM enc")
def sequential_count(spark, sf):
    return _encoded(spark, sf).select("event_id", fx.tidy(F.col("share")).alias("share"))


@query("H12_binary_code", """
WITH v AS (SELECT p_brand, row_number() OVER (ORDER BY p_brand) AS idx FROM (SELECT DISTINCT p_brand FROM part))
SELECT p_partkey, array_to_string([(idx >> g) & 1 FOR g IN range(n)], '') AS bits
FROM part JOIN v USING (p_brand), (SELECT length(bin(count(*))) AS n FROM v)""")
def binary_code(spark, sf):
    p = t.table(spark, sf, "part").select("p_partkey", "p_brand")
    codes = dense_index(p, "p_brand")
    coded = f.index_column(p, codes, "p_brand", "code")
    coded = coded.withColumn("highest", f.vocabulary_size(codes))
    bits = f.binary_code(F.col("code"), F.col("highest"))
    return coded.select("p_partkey", F.concat_ws("", bits.cast("array<string>")).alias("bits"))


@query("H13_tf_idf", "WITH " + TOKENS_SQL.format(key="doc_id", text="text", table="documents").replace(
    "WHERE length(token) >= 2", "WHERE length(token) >= 2 AND token NOT IN ('the', 'and', 'of', 'de', 'la')")
    + " SELECT k AS doc_id, token, round_even(weight, 6) AS weight FROM wt")
def tf_idf(spark, sf):
    docs = t.table(spark, sf, "documents").select("doc_id", "text")
    tasks = c.text_tasks(docs, "doc_id", "text")
    tok = c.tokens(docs, "doc_id", "text", STOP_WORDS, tasks)
    out = c.tf_idf(tok, "doc_id", docs.agg(F.count(F.lit(1))).scalar(), tasks)
    return out.select("doc_id", "token", fx.tidy(F.col("weight")).alias("weight"))


@query("H14_text_vocabulary", "WITH " + TOKENS_SQL.format(key="doc_id", text="text", table="documents") + """
SELECT token, CAST(sum(tf) AS BIGINT) AS n, row_number() OVER (ORDER BY sum(tf) DESC, token) AS idx FROM tok GROUP BY 1
QUALIFY idx <= 1000""")
def text_vocabulary(spark, sf):
    """The 1000 most frequent words of all texts."""
    tok = c.tokens(t.table(spark, sf, "documents").select("doc_id", "text"), "doc_id", "text")
    counts = tok.groupBy("token").agg(F.sum("tf").alias("n"))
    best = counts.orderBy(F.desc("n"), "token").limit(1000)
    return position(best, [], [F.desc("n"), "token"], "idx")


@query("H15_mean_token_vectors", "WITH " + TOKENS_SQL.format(key="p_partkey", text="p_name || ' ' || p_type", table="part") + """,
vocab AS (SELECT token, row_number() OVER (ORDER BY token) - 1 AS vec_id FROM (SELECT DISTINCT token FROM tok)),
vec AS (SELECT token, embedding::DOUBLE[] AS v FROM vocab JOIN embeddings USING (vec_id)),
cells AS (SELECT k, tf, unnest(generate_series(0, 63)) AS dim, unnest(v) AS x FROM tok JOIN vec USING (token))
SELECT k AS p_partkey, dim::INT AS dim, round_even(sum(tf * x) / sum(tf), 6) AS x FROM cells GROUP BY 1, 2""")
def mean_token_vectors(spark, sf):
    """Words of the part names with the vectors of the embeddings table, in order of the words."""
    p = t.table(spark, sf, "part").select("p_partkey", F.concat_ws(" ", "p_name", "p_type").alias("text"))
    tok = c.tokens(p, "p_partkey", "text")
    ids = dense_index(tok, "token", "vec_id", start=0)
    vecs = ids.join(t.table(spark, sf, "embeddings"), "vec_id").select("token", vx.as_double("embedding").alias("v"))
    return f.mean_token_vectors(tok, "p_partkey", vecs)


@query("H16_history_summary", "WITH " + t.RATINGS_SQL + """,
h AS (SELECT user_id, item_id, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, item_id) AS pos FROM ratings QUALIFY pos <= 10),
vec AS (SELECT vec_id AS item_id, embedding::DOUBLE[] AS v FROM embeddings),
known AS (SELECT user_id, count(*) - count(v) AS missing FROM h LEFT JOIN vec USING (item_id) GROUP BY 1),
cells AS (SELECT user_id, pos, unnest(generate_series(0, 63)) AS dim, unnest(v) AS x FROM h JOIN vec USING (item_id))
SELECT user_id, dim::INT AS dim, round_even(avg(x), 6) AS mean, round_even(max(CASE WHEN pos = 1 THEN x END), 6) AS recent, missing
FROM known LEFT JOIN cells USING (user_id) GROUP BY 1, 2, missing""")
def history_summary(spark, sf):
    """The 10 newest items of each user; ``recent`` is null where the newest has no vector, ``missing`` counts those."""
    vecs = r.vectors(t.table(spark, sf, "embeddings").withColumnRenamed("vec_id", "item_id"), "item_id", "embedding")
    return r.history_summary(f.newest_items(t.ratings(spark, sf), 10), vecs)


@query("H17_dense_and_sparse", f"""WITH {GAPS_SQL}, s AS (SELECT c_custkey, coalesce(bal, 0) AS b, coalesce(seg, '-1') AS seg FROM gaps),
v AS (SELECT seg, row_number() OVER (ORDER BY seg) - 1 AS code FROM (SELECT DISTINCT seg FROM s))
SELECT c_custkey, CASE WHEN b > -1 THEN round_even(ln(1.0::DOUBLE + b), 6) ELSE -1.0::DOUBLE END AS bal, seg,
  array_to_string([(code = g)::INT FOR g IN range(n)], '') AS hot FROM s JOIN v USING (seg), (SELECT count(*) AS n FROM v)""")
def dense_and_sparse(spark, sf):
    out = f.dense_and_sparse(_gaps(spark, sf), ["bal"], ["seg"])
    codes = dense_index(out, "seg", start=0)
    coded = out.join(codes, "seg").withColumn("width", f.vocabulary_size(codes))
    hot = F.concat_ws("", f.one_hot(F.col("idx"), F.col("width")).cast("array<string>"))
    return coded.select("c_custkey", fx.tidy(F.col("bal")).alias("bal"), "seg", hot.alias("hot"))


@query("H18_assemble", f"""WITH codes AS (SELECT p_type, row_number() OVER (ORDER BY count(*) DESC, p_type) - 1 AS idx FROM part GROUP BY 1)
SELECT p_partkey, p_retailprice AS f0, CAST(p_size AS DOUBLE) AS f1, CAST(idx = 0 AS DOUBLE) AS f2, CAST(idx = 5 AS DOUBLE) AS f7
FROM part JOIN codes USING (p_type)""")
def assemble(spark, sf):
    """Two numbers and a one-hot type in one vector; four of its places shown."""
    p = t.table(spark, sf, "part")
    model = f.fit_encoder(p, ["p_retailprice", "p_size"], ["p_type"])
    v = vector_to_array("features")
    return model.transform(p).select("p_partkey", *[v[i].alias(f"f{i}") for i in (0, 1, 2, 7)])


@query("H19_second_order", """
SELECT l_orderkey, l_linenumber, l_suppkey, round_even(l_quantity, 6) AS x, round_even(l_quantity * l_quantity, 6) AS xx,
  round_even(l_discount, 6) AS y, round_even(l_quantity * l_discount, 6) AS xy, round_even(l_discount * l_discount, 6) AS yy FROM lineitem""")
def second_order(spark, sf):
    li = t.table(spark, sf, "lineitem")
    rows = VectorAssembler(inputCols=["l_quantity", "l_discount"], outputCol="v").transform(li)
    out = f.second_order("v", "w").transform(rows)
    w = vector_to_array("w")
    names = ["x", "xx", "y", "xy", "yy"]
    return out.select(
        "l_orderkey", "l_linenumber", "l_suppkey", *[fx.tidy(w[i]).alias(n) for i, n in enumerate(names)]
    )
