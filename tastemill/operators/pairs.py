"""Self join to pairs of members that share a group.

All items of one user, all users of one item, all texts with one token: the work
is quadratic in the group, so a large group must not land in one task. Members
of a group with n rows are hashed into ceil(n / TILE) blocks, and the join key is
(group, block, block): a task sees at most about TILE x TILE pairs of a group, no
pair is lost, and small groups have one block and are not copied. The pairs
flow straight into a partial aggregate in the same stage; what is shuffled is
one row per pair and task, not one row per shared group.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tastemill.session import cut_lineage

#: Members of one group per block.
TILE = 2000


def _blocks(df: DataFrame, group: str, member: str, tile: int, size: str | None = None) -> DataFrame:
    if size is None:
        sizes = df.groupBy(group).agg(F.ceil(F.count(F.lit(1)) / tile).cast("int").alias("_nb"))
        df = df.join(sizes, group)
    else:
        df = df.withColumn("_nb", F.ceil(F.col(size) / tile).cast("int"))
    return df.withColumn("_b", F.pmod(F.xxhash64(member), F.col("_nb")))


def shared_pairs(
    df: DataFrame, group: str, member: str, values: Sequence[str] = (), tile: int | None = None, size: str | None = None
) -> DataFrame:
    """Every unordered pair (``a`` < ``b``) of members of a group, once per group.

    ``df`` has one row per (group, member). Output: group, a, b and, for each
    value column v, ``v_a`` and ``v_b``. ``size`` names a column that already
    holds the number of rows of the group. The input is written once, for both
    sides of the join read it.
    """
    wanted = [group, member, *values]
    if size is not None and size not in wanted:
        wanted.append(size)
    base = cut_lineage(_blocks(df.select(*wanted), group, member, tile or TILE, size))
    all_blocks = F.sequence(F.lit(0).cast("long"), F.col("_nb").cast("long") - 1)
    left = base.select(
        group,
        F.col(member).alias("a"),
        *[F.col(v).alias(f"{v}_a") for v in values],
        F.col("_b").alias("_x"),
        F.explode(all_blocks).alias("_y"),
    )
    right = base.select(
        group,
        F.col(member).alias("b"),
        *[F.col(v).alias(f"{v}_b") for v in values],
        F.explode(all_blocks).alias("_x"),
        F.col("_b").alias("_y"),
    )
    key = [group, "_x", "_y"]
    # Little data may be a lot of pairs: the number of tasks is not left to the bytes.
    spark = df.sparkSession
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 4 * spark.sparkContext.defaultParallelism)
    joined = left.repartition(tasks, *key).join(right.repartition(tasks, *key), key)
    return joined.filter(F.col("a") < F.col("b")).drop("_x", "_y")


def pair_sums(
    df: DataFrame,
    group: str,
    member: str,
    sums: dict[str, Column],
    values: Sequence[str] = (),
    tile: int | None = None,
    size: str | None = None,
) -> DataFrame:
    """Aggregate over the groups two members share; columns a < b and ``sums``."""
    pairs = shared_pairs(df, group, member, values, tile, size)
    return pairs.groupBy("a", "b").agg(*[F.sum(v).alias(n) for n, v in sums.items()])


def mirrored(pairs: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """Both directions of a symmetric pair table, in one pass over it."""
    both = F.explode(
        F.array(
            F.struct(F.col(a).alias("_l"), F.col(b).alias("_r")),
            F.struct(F.col(b).alias("_l"), F.col(a).alias("_r")),
        )
    )
    rest = [c for c in pairs.columns if c not in (a, b)]
    return pairs.select(both.alias("_p"), *rest).select(
        F.col("_p._l").alias(a), F.col("_p._r").alias(b), *rest
    )


def degrees(df: DataFrame, member: str, name: str = "n") -> DataFrame:
    """Rows per member."""
    return df.groupBy(member).agg(F.count(F.lit(1)).alias(name))
