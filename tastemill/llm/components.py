"""Connected components by alternating stars: every round is a few joins and sums over the edges that remain."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written


def _least(pairs: DataFrame) -> DataFrame:
    """The least neighbour of each node, or itself; written, so that the join with a hot node's edges can be split."""
    return written(
        pairs.groupBy(F.col("u").alias("node")).agg(F.least(F.min("v"), F.first("u")).alias("low")), "component-low"
    )


def components(edges: DataFrame) -> DataFrame:
    """(a, b) -> (node, component), the least node that links reach. Nodes without a link to another don't appear.

    Large stars hang a node's larger neighbours on its least one, small stars the others; rounds end when nothing
    moves. Nulls are dropped, repeated edges and loops do no harm, no edges give no rows.
    """
    now = written(
        edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "component-edges"
    )
    state = _state(now)
    while state[0]:
        both = now.unionAll(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = (
            both.join(_least(both), F.col("u") == F.col("node"))
            .where("v > u")
            .select(F.col("v").alias("u"), F.col("low").alias("v"))
            .distinct()
        )
        large = written(large, "component-large")
        low = _least(large)
        small = large.join(low, F.col("u") == F.col("node")).select(
            F.explode(
                F.array(
                    F.struct(F.col("u"), F.col("low").alias("v")), F.struct(F.col("v").alias("u"), F.col("low").alias("v"))
                )
            ).alias("e")
        ).select("e.u", "e.v").where("u <> v").distinct()
        after = written(small, "component-edges")
        was, state = state, _state(after)
        now = after
        if was == state:
            break
    nodes = now.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return nodes.unionAll(now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    return tuple(row)
