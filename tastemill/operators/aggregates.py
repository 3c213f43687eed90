"""Click-log aggregates, time-decayed popularity, per-item statistics."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tastemill.functions import scalar as fx
from tastemill.operators.cleaning import LogColumns, log_actions
from tastemill.operators.ordering import list_parts

def clicks_per_pair(log: DataFrame, with_time: bool = False, names: LogColumns = LogColumns()) -> DataFrame:
    """Sum of clicks per (user, item), or per (user, item, second)."""
    keys = [F.col(names.user).alias("user_id"), F.col(names.item).alias("item_id")]
    if with_time:
        keys.append(fx.parse_epoch(names.time).alias("unix_time_stamp"))
    return log_actions(log, names).groupBy(*keys).agg(F.sum(names.click).alias("rating"))


def item_catalogue(log: DataFrame, names: LogColumns = LogColumns()) -> DataFrame:
    """Distinct (item, title) (D3)."""
    return log_actions(log, names).select(F.col(names.item).alias("item_id"), F.col(names.title).alias("title")).distinct()


def item_category_bag(log: DataFrame, category: str = "client_id", names: LogColumns = LogColumns()) -> DataFrame:
    """Distinct categories of an item joined by bars, in sorted order (D4); long bags go on in the next part."""
    kept = log_actions(log, names)
    rows = kept.select(F.col(names.item).alias("item_id"), F.col(names.title).alias("title"), category).distinct()
    bags = list_parts(rows, ["item_id", "title"], [F.col(category).asc_nulls_first()], {"categories": F.col(category)})
    return bags.withColumn("categories", F.concat_ws("|", "categories"))


def deepest_click(log: DataFrame, trace: str, pos: str, names: LogColumns = LogColumns()) -> DataFrame:
    """Greatest clicked position per trace."""
    return log.filter(F.col(names.item).isNotNull()).groupBy(trace).agg(F.max(pos).alias(f"max_{pos}"))


def composed_pair_counts(df: DataFrame, left: Sequence[str], right: Sequence[str], flag: Column) -> DataFrame:
    """Counts per pair of ``a:b`` keys where the flag holds; a null part gives ``unknown``."""

    def key(parts: Sequence[str]) -> Column:
        return F.coalesce(F.concat(F.col(parts[0]), F.lit(":"), F.col(parts[1]).cast("string")), F.lit("unknown"))

    rows = df.filter(flag).select(key(left).alias("left_key"), key(right).alias("right_key"))
    return rows.groupBy("left_key", "right_key").agg(F.count(F.lit(1)).alias("n"))


def with_latest(df: DataFrame, ts: str, name: str = "max_timestamp") -> DataFrame:
    """The latest time on every row (E1, D10): a scalar subquery, not a window over all rows."""
    return df.withColumn(name, df.agg(F.max(ts)).scalar())


def trending(log: DataFrame, names: LogColumns = LogColumns()) -> DataFrame:
    """Time-decayed clicks per (client, item, title).

    Rows are counted per second first, then each count is divided by
    1 + age in days / 100.
    """
    rows = log_actions(log, names).select(
        F.col(names.client).alias("client_id"),
        F.col(names.item).alias("item_id"),
        F.col(names.title).alias("title"),
        fx.parse_epoch(names.time).alias("unix_timestamp"),
    )
    counted = rows.groupBy("client_id", "item_id", "title", "unix_timestamp").agg(F.count(F.lit(1)).alias("clicks"))
    weight = fx.recency(F.col("max_timestamp"), F.col("unix_timestamp"), decimals=None)
    return (
        counted.withColumn("max_timestamp", rows.agg(F.max("unix_timestamp")).scalar())
        .groupBy("client_id", "item_id", "title")
        .agg(fx.tidy(F.sum(weight * F.col("clicks"))).alias("weighted_clicks"))
    )


def mean_rating(df: DataFrame, item: str = "item_id", rating: str = "rating") -> DataFrame:
    """Mean rating per item, 3 decimals."""
    return df.groupBy(item).agg(fx.half_even(F.avg(rating), 3).alias("score"))


def total_rating(df: DataFrame, item: str = "item_id", rating: str = "rating") -> DataFrame:
    """Sum of ratings per item, 3 decimals."""
    return df.groupBy(item).agg(fx.half_even(F.sum(F.col(rating).cast("double")), 3).alias("score"))


def popularity(df: DataFrame, item: str = "item_id") -> DataFrame:
    """Rows per item."""
    return df.groupBy(item).agg(F.count(F.lit(1)).alias("n"))


def category_counts(items: DataFrame, bag: str = "categories") -> DataFrame:
    """Items per category after splitting the bag."""
    return items.select(F.explode(fx.split_bag(bag)).alias("category")).groupBy("category").agg(
        F.count(F.lit(1)).alias("n")
    )


def centred_means(df: DataFrame, member: str, rating: str = "rating") -> DataFrame:
    """Mean per member next to the mean of all rows (D15); one shuffle of partial sums."""
    sums = df.groupBy(member).agg(F.sum(rating).alias("_s"), F.count(rating).alias("_n"))
    overall = sums.agg(F.sum("_s") / F.sum("_n")).scalar()
    return sums.select(
        member, fx.tidy(F.col("_s") / F.col("_n")).alias("mean"), fx.tidy(overall).alias("global_mean")
    )


def distinct_counts(df: DataFrame, columns: Sequence[str], exact: bool = True) -> DataFrame:
    """Distinct values per column (D16); the sketch keeps one small state per task."""
    count = F.count_distinct if exact else F.approx_count_distinct
    return df.agg(*[count(c).alias(c) for c in columns])
