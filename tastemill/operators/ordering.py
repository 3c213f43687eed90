"""Top-k, positions and running totals that hold when one group has a third of the rows.

``row_number() <= k`` lets Spark prune each task to k rows per group before the
shuffle. A full numbering of a group cannot be pruned, so groups above
``GROUP_LIMIT`` rows are cut into ordered chunks: each chunk is numbered by
itself and an offset, summed over the chunks before it, is added.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tastemill.session import cut_lineage

#: Rows of one group a single task may order; above it the group is cut into chunks.
GROUP_LIMIT = 1_000_000
#: Longest list a result row may hold; longer groups give several rows.
LIST_LIMIT = 1000
#: Rows a task is to hold, on average, where their number tells more than their bytes.
TASK_ROWS = 200_000

_CHUNK = "_chunk"
_ONE = "_all"


def order_cols(order: Sequence[Column | str]) -> list[Column]:
    return [F.col(o) if isinstance(o, str) else o for o in order]


def spread(df: DataFrame) -> DataFrame:
    """The rows over all cores when the input has fewer files than cores; otherwise unchanged.

    For costly work per row on a small table. An input of many files has splits
    enough and is not shuffled.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if len(df.inputFiles()) < cores else df


def by_rows(df: DataFrame, rows: float, *keys: str) -> DataFrame:
    """The rows brought together by ``keys``, in tasks of about TASK_ROWS of the ``rows`` they stand for.

    Partitions are merged by their compressed bytes; rows that shrink well, or grow later in the stage, would put
    millions on one task. A number of partitions that is set here is left alone.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(max(cores, math.ceil(rows / TASK_ROWS)), *keys)


def top_k(df: DataFrame, group: Sequence[str], order: Sequence[Column | str], k: int, rank: str = "rank") -> DataFrame:
    """The first ``k`` rows of every group; ``order`` must be total."""
    w = Window.partitionBy(*group).orderBy(*order_cols(order))
    kept = df.withColumn(rank, F.row_number().over(w)).filter(F.col(rank) <= k)
    return kept.withColumn(rank, F.col(rank).cast("long"))


def group_sizes(df: DataFrame, group: Sequence[str]) -> tuple[int, int]:
    """Rows of the largest group and of all; counts are combined before the shuffle."""
    sizes = df.groupBy(*group).agg(F.count(F.lit(1)).alias("n")) if group else df.agg(F.count(F.lit(1)).alias("n"))
    return tuple(x or 0 for x in sizes.agg(F.max("n"), F.sum("n")).first())


def largest_group(df: DataFrame, group: Sequence[str]) -> int:
    """Rows of the largest group."""
    return group_sizes(df, group)[0]


def running(
    df: DataFrame,
    group: Sequence[str],
    order: Sequence[Column | str],
    sums: dict[str, Column],
    limit: int | None = None,
) -> DataFrame:
    """Sums over the rows strictly before each row of its group.

    ``sums`` maps a new column to the value to add up; the first row of a group
    gets 0. ``order`` must be total.
    """
    by = order_cols(order)
    if group and largest_group(df, group) <= (limit or GROUP_LIMIT):
        w = Window.partitionBy(*group).orderBy(*by).rowsBetween(Window.unboundedPreceding, -1)
        return df.select("*", *[F.coalesce(F.sum(v).over(w), F.lit(0)).alias(n) for n, v in sums.items()])
    return _running_chunked(df, list(group), by, sums)


def _running_chunked(df: DataFrame, group: list[str], by: list[Column], sums: dict[str, Column]) -> DataFrame:
    keys = group or [_ONE]
    if not group:
        df = df.withColumn(_ONE, F.lit(0))
    # Order decides the chunk, so a hot key is spread like any other. The layout is
    # written down once: numbering a row twice must give the same chunk twice.
    tagged = df.select("*", *[v.alias(f"_v_{n}") for n, v in sums.items()])
    chunked = cut_lineage(tagged.repartitionByRange(*by).withColumn(_CHUNK, F.spark_partition_id()))
    part = chunked.groupBy(*keys, _CHUNK).agg(*[F.sum(f"_v_{n}").alias(f"_s_{n}") for n in sums])
    before = Window.partitionBy(*keys).orderBy(_CHUNK).rowsBetween(Window.unboundedPreceding, -1)
    offsets = part.select(
        *keys, _CHUNK, *[F.coalesce(F.sum(f"_s_{n}").over(before), F.lit(0)).alias(f"_o_{n}") for n in sums]
    )
    inside = Window.partitionBy(*keys, _CHUNK).orderBy(*by).rowsBetween(Window.unboundedPreceding, -1)
    local = chunked.select(
        "*", *[F.coalesce(F.sum(f"_v_{n}").over(inside), F.lit(0)).alias(f"_l_{n}") for n in sums]
    )
    joined = local.join(offsets, [*keys, _CHUNK])
    kept = [c for c in df.columns if c != _ONE]
    return joined.select(*kept, *[(F.col(f"_l_{n}") + F.col(f"_o_{n}")).alias(n) for n in sums])


def position(
    df: DataFrame, group: Sequence[str], order: Sequence[Column | str], name: str = "pos", limit: int | None = None
) -> DataFrame:
    """1-based place of each row in its group; with no group, in the whole table."""
    by = order_cols(order)
    if group and largest_group(df, group) <= (limit or GROUP_LIMIT):
        return df.withColumn(name, F.row_number().over(Window.partitionBy(*group).orderBy(*by)).cast("long"))
    out = _running_chunked(df, list(group), by, {name: F.lit(1)})
    return out.withColumn(name, F.col(name) + F.lit(1).cast("long"))


def list_parts(
    df: DataFrame,
    group: Sequence[str],
    order: Sequence[Column | str],
    fields: dict[str, Column],
    size: int | None = None,
    part: str = "part",
) -> DataFrame:
    """Ordered lists per group, at most ``size`` (LIST_LIMIT) long: longer groups give parts 0, 1, 2 ....

    Rows of a group lie in ``part`` order; callers keep ``part``, so a list can be put together again.
    """
    size = size or LIST_LIMIT
    placed = position(df.select("*", *[v.alias(f"_f_{n}") for n, v in fields.items()]), group, order, "_pos")
    placed = placed.withColumn(part, F.floor((F.col("_pos") - 1) / size))
    row = F.struct("_pos", *[F.col(f"_f_{n}").alias(n) for n in fields])
    lists = placed.groupBy(*group, part).agg(F.sort_array(F.collect_list(row)).alias("_rows"))
    return lists.select(*group, part, *[F.col("_rows")[n].alias(n) for n in fields])


def previous_rows(
    df: DataFrame,
    group: Sequence[str],
    order: Sequence[Column | str],
    n: int,
    fields: dict[str, Column],
    place: str = "pos",
    limit: int | None = None,
) -> DataFrame:
    """The up to ``n`` rows before each row of its group, oldest first, one list per field.

    Groups that fit a task are ordered once. Long groups are framed chunk by
    chunk; the last ``n`` rows of a chunk are copied into the next one, so no
    frame is cut.
    """
    limit = limit or GROUP_LIMIT
    tagged = df.select("*", *[v.alias(f"_f_{f}") for f, v in fields.items()])
    largest, rows = group_sizes(df, group)
    if group and largest <= limit:
        w = Window.partitionBy(*group).orderBy(*order_cols(order))
        return by_rows(tagged, rows, *group).select(
            *df.columns,
            F.row_number().over(w).cast("long").alias(place),
            *[F.collect_list(f"_f_{f}").over(w.rowsBetween(-n, -1)).alias(f) for f in fields],
        )
    placed = position(tagged, group, order, place, limit)
    chunk = F.floor((F.col(place) - 1) / limit)
    copies = F.when(
        (F.col(place) - 1) % limit >= limit - n, F.array(chunk, chunk + 1)
    ).otherwise(F.array(chunk))
    spread = placed.withColumn(_CHUNK, F.explode(copies))
    w = Window.partitionBy(*group, _CHUNK).orderBy(place).rowsBetween(-n, -1)
    framed = spread.select(
        *df.columns, place, _CHUNK, *[F.collect_list(f"_f_{f}").over(w).alias(f) for f in fields]
    )
    return framed.filter(F.col(_CHUNK) == chunk).drop(_CHUNK)


def dense_index(values: DataFrame, value: str, name: str = "idx", start: int = 1) -> DataFrame:
    """Distinct non-null values numbered in sorted order, from ``start`` (H1)."""
    distinct = values.select(value).filter(F.col(value).isNotNull()).distinct()
    placed = position(distinct, [], [value], name)
    return placed.withColumn(name, F.col(name) + F.lit(start - 1))
