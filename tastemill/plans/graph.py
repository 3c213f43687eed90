"""Graph ranking over the click graph (K1-K4)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tastemill.operators import graph as g
from tastemill.plans import tables as t
from tastemill.plans.registry import query

EDGE_SQL = t.CLICKS_SQL + """,
edge AS (SELECT 'u' || user_id AS src, 'i' || item_id AS dst FROM clicks
  UNION ALL SELECT 'i' || item_id, 'u' || user_id FROM clicks),
deg AS (SELECT src, count(*) AS d FROM edge GROUP BY 1)"""


def _series_sql(weight: str, factor: float, terms: int = 45) -> str:
    """Walks from items over two steps at a time, all terms above the last bit of a double; then one step from the users."""
    out = EDGE_SQL + f", e AS (SELECT src, dst, {weight} AS w FROM edge JOIN deg USING (src)),\n"
    out += """q AS MATERIALIZED (SELECT a.src AS i, b.dst AS j, sum(0.6::DOUBLE * 0.6::DOUBLE * a.w * b.w) AS w FROM e a JOIN e b ON b.src = a.dst
  WHERE a.src LIKE 'i%' GROUP BY 1, 2),
p0 AS MATERIALIZED (SELECT DISTINCT src AS i, src AS j, 1.0::DOUBLE AS m FROM e WHERE src LIKE 'i%')"""
    for k in range(1, terms + 1):
        out += f""",
p{k} AS MATERIALIZED (SELECT p.i, q.j, sum(p.m * q.w) AS m FROM p{k - 1} p JOIN q ON q.i = p.j GROUP BY 1, 2)"""
    out += ",\ntot AS (SELECT i, j, sum(m) AS m FROM (" + " UNION ALL ".join(f"SELECT * FROM p{k}" for k in range(terms + 1)) + ") GROUP BY 1, 2)"
    return out + f""",
last AS (SELECT CAST(substr(e.src, 2) AS BIGINT) AS root, tot.j AS node, sum({factor!r}::DOUBLE * e.w * tot.m) AS m
  FROM e JOIN tot ON tot.i = e.dst WHERE e.src LIKE 'u%' GROUP BY 1, 2)"""


TAIL_SQL = """, sc AS (SELECT root AS user_id, CAST(substr(node, 2) AS BIGINT) AS item_id, round_even(m, 6) AS score
  FROM {last} WHERE node LIKE 'i%')
SELECT user_id, item_id, score, row_number() OVER (PARTITION BY user_id ORDER BY score DESC, item_id) AS rank
FROM sc WHERE NOT EXISTS (SELECT 1 FROM clicks c WHERE c.user_id = sc.user_id AND c.item_id = sc.item_id)
QUALIFY rank <= 10"""


@query("K1_bipartite_graph", "WITH " + EDGE_SQL + " SELECT substr(src, 1, 1) AS kind, substr(src, 2)::BIGINT AS id, d AS degree FROM deg")
def bipartite_graph(spark, sf):
    """Nodes of the graph with their degree."""
    e = g.bipartite_graph(t.click_events(spark, sf))
    kind = F.substring("src.kind", 1, 1)
    return e.groupBy(kind.alias("kind"), F.col("src.id").alias("id")).agg(F.count(F.lit(1)).alias("degree"))


@query("K2_personal_rank", "WITH " + _series_sql("1.0::DOUBLE / d", 0.6 * (1.0 - 0.6)) + TAIL_SQL.format(last="last"))
def personal_rank(spark, sf):
    return g.personal_rank(t.clicks(spark, sf), alpha=0.6, k=10)


@query("K3_rank_linear_system", "WITH " + _series_sql("round_even(1.0::DOUBLE / d, 3)::DOUBLE", 0.6) + TAIL_SQL.format(last="last"))
def rank_linear_system(spark, sf):
    return g.rank_by_linear_system(t.clicks(spark, sf), alpha=0.6, k=10)


@query("K4_transition_weights", "WITH " + EDGE_SQL + """
SELECT src, dst, round_even(1.0::DOUBLE / d, 3)::DOUBLE AS weight FROM edge JOIN deg USING (src)""")
def transition_weights(spark, sf):
    w = g.transition_weights(g.bipartite_graph(t.click_events(spark, sf)))

    def name(node):
        return F.concat(F.substring(f"{node}.kind", 1, 1), F.col(f"{node}.id").cast("string"))

    return w.select(name("src").alias("src"), name("dst").alias("dst"), "weight")
