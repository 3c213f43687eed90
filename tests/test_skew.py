"""All queries on tables where one user, item, type or text group holds a third of the rows.

The limits of a task are set so low that every hot group is cut into chunks,
tiles and fans; the results must still be those of the SQL.
"""

from __future__ import annotations

import os

import duckdb
import pytest
from check import TABLES, compare, connect, rows_of

from __spark_entry__ import oracle_sql, queries
from tastemill.operators import graph, ordering, pairs, sequences, similarity, tiles

# Queries over the skewed columns with a SQL twin; fitted models are left out.
NAMES = [n for n in oracle_sql() if n[0] in "CDEHIJKLNOSX" or n in ("B8_active_users", "B10_popular_titles", "B20_five_number_summary")]


@pytest.fixture(scope="module")
def skewed(sf, tmp_path_factory):
    out = str(tmp_path_factory.mktemp("skew"))
    con = duckdb.connect()
    change = {
        "orders": "SELECT * REPLACE (CASE WHEN o_orderkey % 3 = 0 THEN 7 ELSE o_custkey END AS o_custkey) FROM t",
        "lineitem": "SELECT * REPLACE (CASE WHEN l_suppkey % 3 = 0 THEN 5 ELSE l_partkey END AS l_partkey) FROM t",
        "events": """SELECT * REPLACE (CASE WHEN event_id % 3 = 0 THEN 1 ELSE user_id END AS user_id,
            CASE WHEN event_id % 3 = 1 THEN '{"k": 4}' ELSE props END AS props) FROM t""",
        "labels": "SELECT * REPLACE (CASE WHEN doc_id % 3 = 0 THEN 1 ELSE quality END AS quality) FROM t",
    }
    for name in TABLES:
        src = f"(SELECT * FROM read_parquet('{sf}/{name}.parquet'))"
        sql = change.get(name, "SELECT * FROM t").replace("FROM t", f"FROM {src} t")
        con.execute(f"COPY ({sql}) TO '{out}/{name}.parquet' (FORMAT parquet)")
    return out


@pytest.fixture(scope="module")
def duck(skewed):
    return connect(skewed)


@pytest.fixture
def small_limits(monkeypatch):
    monkeypatch.setattr(ordering, "GROUP_LIMIT", 150)
    monkeypatch.setattr(pairs, "TILE", 40)
    monkeypatch.setattr(tiles, "BLOCK", 60)
    monkeypatch.setattr(tiles, "CELLS", 5000)
    monkeypatch.setattr(graph, "FAN", 12)
    monkeypatch.setattr(graph, "ROOTS", 10)
    monkeypatch.setattr(sequences, "RANGE_CHUNK", 30)


@pytest.mark.skipif(os.environ.get("SKIP_SKEW") == "1", reason="long")
@pytest.mark.parametrize("name", NAMES)
def test_skewed(spark, skewed, duck, small_limits, name):
    ok, message, _, _ = compare(spark, duck, name, skewed)
    assert ok, message


@pytest.mark.parametrize("way", ["pairs", "tiles", "hot members"])
@pytest.mark.parametrize("name", ["I1_item_similarity_decay", "I2_item_similarity_damped", "I12_rating_vector_knn"])
def test_all_ways_of_similarity_agree(spark, skewed, duck, monkeypatch, way, name):
    monkeypatch.setattr(similarity, "BLOCK_ROWS", 1 if way == "pairs" else 10**9)
    if way != "pairs":
        monkeypatch.setattr(similarity, "block_count", lambda rows, parallel: 1)
    if way == "hot members":
        monkeypatch.setattr(similarity, "MEMBER_ROWS", 40)
        monkeypatch.setattr(similarity, "BIG_GROUP", 25)
    ok, message, _, _ = compare(spark, duck, name, skewed)
    assert ok, message


@pytest.mark.parametrize("name", ["A11_sequence_examples", "A12_list_with_context", "D4_item_category_bag", "D11_items_per_user", "D12_users_per_item", "X1_user_timelines"])
def test_long_lists_go_on_in_the_next_part(spark, skewed, duck, name, monkeypatch):
    """Lists of five: a hot group has many parts, and every row is in one of them."""
    monkeypatch.setattr(ordering, "LIST_LIMIT", 5)
    df = queries()[name](spark, skewed)
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    res = duck.execute(oracle_sql()[name].replace("1000", "5"))
    assert got == rows_of([d[0] for d in res.description], res.fetchall())
    assert name == "D4_item_category_bag" or df.filter("part > 1").count() > 0


def test_padded_lists_have_one_row_per_group(spark, skewed, duck, monkeypatch):
    monkeypatch.setattr(ordering, "LIST_LIMIT", 2)
    ok, message, _, _ = compare(spark, duck, "X7_padded_lists", skewed)
    assert ok, message


def test_hot_keys_are_split_before_the_next_step(spark, skewed):
    """A join whose result is aggregated by the same key: the hot key's rows go to several tasks."""
    low = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.shuffle.partitions": "16",
    }
    orders = spark.read.parquet(f"{skewed}/orders.parquet").repartition(6).selectExpr("o_custkey AS k", "o_totalprice AS v")
    sides = spark.read.parquet(f"{skewed}/customer.parquet").selectExpr("c_custkey AS k", "c_acctbal AS b")
    was = {k: spark.conf.get(k) for k in low}
    try:
        for k, v in low.items():
            spark.conf.set(k, v)
        out = orders.join(sides, "k").groupBy("k").sum("v")
        out.collect()
        assert "skew=true" in out._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in was.items():
            spark.conf.set(k, v)
