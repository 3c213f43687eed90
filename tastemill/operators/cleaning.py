"""Filters, cleaning and profiles."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tastemill.functions import scalar as fx
from tastemill.operators.ordering import order_cols, running


def at_least(df: DataFrame, threshold: float, rating: str = "rating") -> DataFrame:
    """Rows rated ``threshold`` or better (B1)."""
    return df.filter(F.col(rating) >= threshold)


@dataclass(frozen=True)
class LogColumns:
    """Names of the columns of a search and click log, and the action that marks rows to use."""

    user: str = "user_id"
    item: str = "item_id"
    title: str = "title"
    time: str = "time"
    click: str = "click"
    client: str = "client_id"
    action: str = "action"
    used_action: str = "actions"


def log_actions(log: DataFrame, names: LogColumns = LogColumns()) -> DataFrame:
    """Log rows with an object and the used action (B2)."""
    return log.filter(F.col(names.item).isNotNull() & (F.col(names.action) == names.used_action))


def frequent(df: DataFrame, key: str, least: int) -> DataFrame:
    """Rows whose key occurs at least ``least`` times.

    The counts are combined before the shuffle, and the semi join can be split
    on a hot key; a window would bring all rows of the key to one task.
    """
    keep = df.groupBy(key).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") >= least)
    return df.join(keep.select(key), key, "left_semi")


def frequent_with_count(df: DataFrame, key: str, least: int, name: str = "n") -> DataFrame:
    """Rows whose key occurs at least ``least`` times, the count attached."""
    counts = df.groupBy(key).agg(F.count(F.lit(1)).alias(name)).filter(F.col(name) >= least)
    return df.join(counts, key)


def keep_one(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str]) -> DataFrame:
    """One row per key, the first in ``order`` (B13); tasks keep one row per key before the shuffle."""
    rest = [c for c in df.columns if c not in keys]
    best = F.min_by(F.struct(*rest), F.struct(*[c.alias(f"_{i}") for i, c in enumerate(order_cols(order))]))
    return df.groupBy(*keys).agg(best.alias("_row")).select(*keys, *[F.col("_row")[c].alias(c) for c in rest])


def first_time_then_filter(
    df: DataFrame, order: Sequence[str], threshold: float, keys: Sequence[str] = ("user_id", "item_id")
) -> DataFrame:
    """The pair keeps the time of its first row in ``order`` - even one below the threshold."""
    firsts = df.groupBy(*keys).agg(F.min_by("ts", F.struct(*order)).alias("first_ts"))
    return at_least(df, threshold).join(firsts, list(keys))


def sample_rows(df: DataFrame, n: int, *key: str, seed: int = 42) -> DataFrame:
    """n rows in hash order of the key: the same rows on every run."""
    return df.orderBy(fx.shuffle_key(*key, seed=seed), *key).limit(n)


def distinct_values(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Distinct values of each column as (feature, value) rows, one pass."""
    pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).cast("string").alias("value")) for c in columns]))
    return df.select(pairs.alias("p")).select("p.feature", "p.value").distinct()


def null_profile(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Null count per column, one row."""
    return df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])


def interaction_profile(df: DataFrame, user: str, item: str, weight: str) -> DataFrame:
    """Rows, users, items, total weight and sparsity 1 - n/(users*items)."""
    out = df.agg(
        F.count(F.lit(1)).alias("n"),
        F.count_distinct(user).alias("users"),
        F.count_distinct(item).alias("items"),
        F.sum(weight).alias("total"),
    )
    cells = F.col("users").cast("double") * F.col("items").cast("double")
    return out.withColumn("sparsity", fx.tidy(F.lit(1.0) - fx.safe_ratio(F.col("n"), cells)))


def five_numbers(df: DataFrame, value: str, by: Sequence[str] = ()) -> DataFrame:
    """Count, min, quartiles with linear interpolation, max.

    Rows are counted per distinct value; running counts over the values tell
    which value stands at a rank. Exact, and no task holds the values of a group.
    """
    keys = list(by) or ["_all"]
    rows = df if by else df.withColumn("_all", F.lit(0))
    per = rows.filter(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count(F.lit(1)).alias("_n"))
    below = running(per, keys, [value], {"_below": F.col("_n")})
    sizes = per.groupBy(*keys).agg(F.sum("_n").alias("n"), F.min(value).alias("low"), F.max(value).alias("high"))

    def at(rank: Column) -> Column:
        here = (F.col("_below") <= rank) & (rank < F.col("_below") + F.col("_n"))
        return F.max(F.when(here, F.col(value)))

    def quantile(q: float) -> Column:
        rank = F.lit(q) * (F.col("n") - 1)
        return at(F.floor(rank)) + (F.max(rank) - F.floor(F.max(rank))) * (at(F.ceil(rank)) - at(F.floor(rank)))

    out = below.join(sizes, keys).groupBy(*keys, "n", "low", "high").agg(
        quantile(0.25).alias("q1"), quantile(0.5).alias("median"), quantile(0.75).alias("q3")
    )
    return out.select(*by, "n", "low", "q1", "median", "q3", "high")


def histogram(df: DataFrame, value: str, edges: Sequence[float]) -> DataFrame:
    """Rows per interval [edge, next edge); the last interval includes its end."""
    last = len(edges) - 2
    inside = df.filter((F.col(value) >= edges[0]) & (F.col(value) <= edges[-1]))
    bin_no = F.least(fx.bucket_index(F.col(value), edges) - 1, F.lit(last))
    return inside.groupBy(bin_no.alias("bin")).agg(F.count(F.lit(1)).alias("n"))
