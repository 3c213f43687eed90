"""Window recipes that a hot group cannot bring down."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def last_value_per(df: DataFrame, key: str, value: str, order: Sequence[str], name: str) -> DataFrame:
    """Last value of each key in ``order`` (E2): an aggregate, combined before the shuffle."""
    return df.groupBy(key).agg(F.max_by(value, F.struct(*order)).alias(name))


def competition_rank(
    scored: DataFrame, truth: DataFrame, group: Sequence[str], item: str, score: str = "score", name: str = "rank"
) -> DataFrame:
    """1 + number of rows of the group that score strictly higher than the true item.

    The true score joins the group's rows and the higher ones are counted: the
    group is never sorted. A true item without a score is dropped.
    """
    own = truth.select(*group, item).join(scored, [*group, item]).select(
        *group, F.col(item).alias("_true"), F.col(score).alias("_own")
    )
    higher = F.count_if(F.col(score) > F.col("_own"))
    counted = scored.join(own, list(group)).groupBy(*group, F.col("_true").alias(item)).agg(higher.alias("_h"))
    return counted.select(*group, item, (F.col("_h") + 1).alias(name))
