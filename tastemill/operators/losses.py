"""Pairwise and listwise losses over score tables (O1-O5); each returns one row."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tastemill.functions import scalar as fx
from tastemill.functions.vector import dot
from tastemill.operators import ordering
from tastemill.operators.ordering import running
from tastemill.session import cut_lineage


def _log_sigmoid(x: Column) -> Column:
    """ln sigmoid(x) without overflow on either side."""
    return F.least(x, F.lit(0.0)) - F.log1p(F.exp(-F.abs(x)))


def bpr(rows: DataFrame, pos: str, neg: str) -> DataFrame:
    """-ln sigmoid(pos - neg), summed and averaged (O1)."""
    loss = -_log_sigmoid(F.col(pos) - F.col(neg))
    return rows.agg(fx.tidy(F.sum(loss), 4).alias("bpr_sum"), fx.tidy(F.avg(loss)).alias("bpr_mean"))


def pairwise_hinge(rows: DataFrame, pos: str, neg: str, margin: float = 1.0) -> DataFrame:
    """Sum of max(0, margin - (pos - neg)) (O2)."""
    gap = F.lit(margin) - (F.col(pos) - F.col(neg))
    return rows.agg(fx.tidy(F.sum(F.greatest(gap, F.lit(0.0))), 4).alias("hinge"))


def top1(rows: DataFrame, pos: str, neg: str) -> DataFrame:
    """Mean of sigmoid(neg - pos) + sigmoid(neg^2) (O3)."""
    n = F.col(neg)
    return rows.agg(fx.tidy(F.avg(fx.sigmoid(n - F.col(pos)) + fx.sigmoid(n * n))).alias("top1"))


#: Rows on either side of a tile of a batch's score matrix.
TILE_ROWS = 4_096


def in_batch_softmax(rows: DataFrame, batch: str, user: str, item: str, weight: str, tile_rows: int = TILE_ROWS) -> DataFrame:
    """Cross entropy of each row's own item against the items of its batch, weighted, averaged.

    A batch's score matrix is cut into tiles, a task holds one of them. A tile leaves the greatest score of each of its
    rows and the sum of exponentials below it; these are put together row by row, so a batch may have any size.
    """
    numbered = cut_lineage(
        rows.select(
            F.col(batch).alias("_batch"), F.col(user).cast("array<double>").alias("_u"), F.col(item).cast("array<double>").alias("_i"),
            F.col(weight).alias("_w"), F.monotonically_increasing_id().alias("_row"),
        )
    )
    blocks = numbered.groupBy(F.col("_batch").alias("_of")).agg(F.ceil(F.count(F.lit(1)) / F.lit(float(tile_rows))).cast("int").alias("_n"))
    placed = numbered.join(blocks, F.col("_batch").eqNullSafe(F.col("_of")))
    own = F.pmod(F.xxhash64("_row"), F.col("_n")).cast("int")
    every = F.explode(F.sequence(F.lit(0), F.col("_n") - 1))
    left = placed.select("_batch", own.alias("_a"), every.alias("_b"), "_row", F.col("_u").alias("_v"))
    right = placed.select("_batch", every.alias("_a"), own.alias("_b"), F.lit(None).cast("long").alias("_row"), F.col("_i").alias("_v"))

    def tile(pdf: pd.DataFrame) -> pd.DataFrame:
        mine = pdf["_row"].notna().to_numpy()
        if mine.all() or not mine.any():
            return pd.DataFrame({"_row": np.zeros(0, np.int64), "top": np.zeros(0), "total": np.zeros(0)})
        z = np.stack(pdf["_v"][mine].to_list()) @ np.stack(pdf["_v"][~mine].to_list()).T
        top = z.max(axis=1)
        return pd.DataFrame({"_row": pdf["_row"][mine].astype(np.int64), "top": top, "total": np.exp(z - top[:, None]).sum(axis=1)})

    tiles = left.unionAll(right).groupBy("_batch", "_a", "_b").applyInPandas(tile, "_row long, top double, total double")
    tops = tiles.groupBy(F.col("_row").alias("_r")).agg(
        F.max("top").alias("_top"), F.collect_list(F.struct("top", "total")).alias("_parts")  # one for each block of items
    )
    total = F.aggregate("_parts", F.lit(0.0), lambda done, p: done + p["total"] * F.exp(p["top"] - F.col("_top")))
    loss = (F.col("_top") + F.log(total) - dot(F.col("_u"), F.col("_i"))) * F.col("_w")
    per = numbered.join(tops, F.col("_row") == F.col("_r"))
    return per.groupBy(F.col("_batch").alias(batch)).agg(fx.tidy(F.avg(loss)).alias("loss"))


def listwise_softmax(rows: DataFrame, group: Sequence[str], label: str, score: str) -> DataFrame:
    """Mean over lists of -sum(label x ln softmax(score))."""
    top = rows.groupBy(*group).agg(F.max(score).alias("_m"))
    sums = rows.join(top, list(group)).groupBy(*group).agg(
        F.log(F.sum(F.exp(F.col(score) - F.col("_m")))).alias("_lse"),
        F.sum(F.col(label) * (F.col(score) - F.col("_m"))).alias("_hit"),
        F.sum(label).alias("_mass"),
    )
    return sums.agg(fx.tidy(F.avg(F.col("_mass") * F.col("_lse") - F.col("_hit"))).alias("softmax"))


def list_mle(rows: DataFrame, group: Sequence[str], label: str, score: str, tie: str) -> DataFrame:
    """Mean over lists of -ln P(order by label | scores) (O5): sum of ln(sum of exp of the rest) - score.

    The rest of a list is a running sum from its end, so a long list is summed
    in chunks like any other group; where no list is that long, one shuffle by
    list gives its maximum and the sums.
    """
    if ordering.largest_group(rows, group) <= ordering.GROUP_LIMIT:
        whole = Window.partitionBy(*group)
        shifted = rows.withColumn("_m", F.max(score).over(whole)).withColumn("_e", F.exp(F.col(score) - F.col("_m")))
        rest = whole.orderBy(F.asc(label), F.desc(tie)).rowsBetween(Window.unboundedPreceding, 0)
        loss = F.log(F.sum("_e").over(rest)) + F.col("_m") - F.col(score)
        return shifted.withColumn("_l", loss).groupBy(*group).agg(F.sum("_l").alias("_l")).agg(
            fx.tidy(F.avg("_l")).alias("list_mle")
        )
    top = rows.groupBy(*group).agg(F.max(score).alias("_m"))
    shifted = rows.join(top, list(group)).withColumn("_e", F.exp(F.col(score) - F.col("_m")))
    from_end = running(shifted, group, [F.asc(label), F.desc(tie)], {"_after": F.col("_e")})
    loss = F.log(F.col("_after") + F.col("_e")) + F.col("_m") - F.col(score)
    return from_end.groupBy(*group).agg(F.sum(loss).alias("_l")).agg(fx.tidy(F.avg("_l")).alias("list_mle"))
