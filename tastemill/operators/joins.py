"""Join recipes: lookups, shown-before-click, nearest reference point, scoring grid."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tastemill.operators.ordering import dense_index

#: Largest share of a grid one generated row range covers before it is spread out.
GRID_CHUNK = 100_000


def lookup(df: DataFrame, dim: DataFrame, key: str, value: str, default: object, name: str | None = None) -> DataFrame:
    """Value of the key in ``dim``, ``default`` where the key is unknown (C4).

    Spark broadcasts the dimension by itself when its size allows it.
    """
    name = name or value
    side = dim.select(key, F.col(value).alias("_v"))
    return df.join(side, key, "left").withColumn(name, F.coalesce(F.col("_v"), F.lit(default))).drop("_v")


def shown_until_last_click(
    log: DataFrame, trace: str = "traceId", pos: str = "resPos", clicked: str = "click_object_id"
) -> DataFrame:
    """Rows of a trace up to the position of its deepest click."""
    deepest = log.filter(F.col(clicked).isNotNull()).groupBy(trace).agg(F.max(pos).alias("max_resPos"))
    return log.join(deepest, trace).filter(F.col(pos) <= F.col("max_resPos"))


def label_candidates(candidates: DataFrame, truth: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """Retrieved rows with their true value, 0.0 where there is none."""
    side = truth.select(*keys, F.col(value).cast("double").alias("_v"))
    return candidates.join(side, list(keys), "left").withColumn(value, F.coalesce("_v", F.lit(0.0))).drop("_v")


def nearest_reference(lat: Column, lon: Column, points: Sequence[tuple[float, float]]) -> Column:
    """0-based number of the closest of a few fixed points.

    The points are constants of the expression, so there is no join at all;
    equally close points go to the lower number.
    """
    cells = [
        F.struct(
            ((lat - F.lit(a)) * (lat - F.lit(a)) + (lon - F.lit(b)) * (lon - F.lit(b))).alias("d"),
            F.lit(i).alias("i"),
        )
        for i, (a, b) in enumerate(points)
    ]
    return F.when(lat.isNotNull() & lon.isNotNull(), F.array_min(F.array(*cells))["i"])


def grid(parts: Sequence[DataFrame]) -> DataFrame:
    """Every combination of the rows of several one-column frames of distinct values.

    The grid is the number range 0..n1*n2*...-1: Spark spreads the range over
    the tasks, each number is read as one index per column, and the values come
    by equality joins. No task holds more than its part of the range.
    """
    spark = parts[0].sparkSession
    total = 1
    sides = []
    for i, p in enumerate(parts):
        name = p.columns[0]
        side = dense_index(p, name, f"_i{i}", start=0)
        n = side.count()
        sides.append((side, f"_i{i}", total, n))
        total *= n
    parallel = max(spark.sparkContext.defaultParallelism, -(-total // GRID_CHUNK)) if total else 1
    out = spark.range(0, total, 1, min(parallel, 1_000_000))
    for _, idx, step, n in sides:
        out = out.withColumn(idx, (F.floor(F.col("id") / F.lit(step)) % F.lit(n)).cast("long"))
    out = out.drop("id")
    for side, idx, _, _ in sides:
        out = out.join(side, idx).drop(idx)
    return out
