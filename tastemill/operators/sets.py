"""Sorts, limits and set operations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tastemill.functions import scalar as fx
from tastemill.operators.joins import grid


def top_overall(df: DataFrame, n: int, *order: Column | str) -> DataFrame:
    """The first n rows of all; each task keeps n, no full sort."""
    return df.orderBy(*order).limit(n)


def ordered_distinct(df: DataFrame, group: str, item: str, place: list[Column | str], k: int) -> DataFrame:
    """First place of every item in the group's list, cut to k (S3)."""
    from tastemill.operators.ordering import order_cols, top_k

    names = [f"_p{i}" for i in range(len(place))]
    key = F.struct(*[c.alias(n) for c, n in zip(order_cols(place), names)])
    firsts = df.groupBy(group, item).agg(F.min(key).alias("_first"))
    return top_k(firsts, [group], ["_first", item], k).drop("_first")


def mirrored_edges(df: DataFrame, user: str = "user_id", item: str = "item_id") -> DataFrame:
    """user->item and item->user edges with the kind of each end, in one pass."""

    def node(kind: str, c: str) -> Column:
        return F.struct(F.lit(kind).alias("kind"), F.col(c).alias("id"))

    u, i = node("user", user), node("item", item)
    both = F.explode(F.array(F.struct(u.alias("src"), i.alias("dst")), F.struct(i.alias("src"), u.alias("dst"))))
    return df.select(user, item).distinct().select(both.alias("e")).select("e.src", "e.dst")


def common_members(a: DataFrame, b: DataFrame, key: str, item: str, name: str = "common") -> DataFrame:
    """Size of the intersection of two sets per key."""
    return a.select(key, item).join(b.select(key, item), [key, item]).groupBy(key).agg(F.count(F.lit(1)).alias(name))


def not_taken(df: DataFrame, user: str = "user_id", item: str = "item_id") -> DataFrame:
    """All items minus the user's items, for every user.

    The result itself is users x items long; the grid is made by ranges, so no
    task or driver holds one side whole.
    """
    cells = grid([df.select(user).distinct(), df.select(item).distinct()])
    return cells.join(df.select(user, item), [user, item], "left_anti")


def shuffled(df: DataFrame, *key: str, seed: int = 42) -> DataFrame:
    """Rows in hash order of their key."""
    return df.orderBy(fx.shuffle_key(*key, seed=seed), *key)
