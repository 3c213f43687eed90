"""Vector retrieval, two-stage ranking, value weights."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tastemill.functions import scalar as fx
from tastemill.functions import vector as vx
from tastemill.operators.ordering import top_k
from tastemill.operators.similarity import drop_seen
from tastemill.operators.tiles import BLOCK, best_matches, by_tile, floats, match_schema, matcher, vector_blocks
from tastemill.session import cut_lineage


def vectors(df: DataFrame, key: str, vector: str) -> DataFrame:
    """(key, v) with v as array of doubles."""
    return df.select(key, vx.as_double(vector).alias("v"))


def nearest(
    queries: DataFrame, candidates: DataFrame, key: str, k: int, measure: str = "dot", drop_self: bool = False
) -> DataFrame:
    """Exact k best candidates of each query (L1 ``dot``, L2 ``cosine``, L3 ``l2``).

    Both frames come from ``vectors``. For ``l2`` the column ``distance`` holds
    the squared distance, for the others ``score`` the product or cosine.
    """
    blocks = None
    if measure != "cosine":  # cosines have a way of their own to leave blocks out
        cores = queries.sparkSession.sparkContext.defaultParallelism
        sizes = [x.agg(F.count(F.lit(1)), F.max(F.size("v"))).first() for x in (queries, candidates)]
        blocks = tuple(vector_blocks(n, width or 1, cores) for n, width in sizes)
        queries, candidates = (x.withColumn("v", F.col("v").cast("array<float>")) if floats(x) else x for x in (queries, candidates))
    out = best_matches(queries, candidates, key, k, measure, drop_self, blocks=blocks)
    if measure == "l2":
        return out.withColumn("distance", -F.col("score") + F.lit(0.0)).drop("score")
    return out


def with_vectors(matches: DataFrame, candidates: DataFrame, key: str) -> DataFrame:
    """The vectors of the matches joined on (L1 returns ids, scores and vectors)."""
    return matches.join(candidates.select(F.col(key).alias("match_key"), F.col("v").alias("match_vector")), "match_key")


def nearest_unseen(
    users: DataFrame, items: DataFrame, seen: DataFrame | Callable[[DataFrame], DataFrame], k: int, n: int
) -> DataFrame:
    """k best items by inner product, seen ones dropped, the first n kept (L4).

    ``users`` (user_id, v), ``items`` (item_id, v). ``seen`` is a table (user_id, item_id), or tells which of the rows
    found are in it, where that table would be far larger than what is found.
    """
    found = best_matches(
        users.withColumnRenamed("user_id", "key"), items.withColumnRenamed("item_id", "key"), "key", k, "dot"
    ).select(F.col("query_key").alias("user_id"), F.col("match_key").alias("item_id"), "score")
    if not isinstance(seen, DataFrame):
        found = cut_lineage(found)  # read for the rows and for what is seen of them
        seen = seen(found).select("user_id", "item_id")
    return top_k(drop_seen(found, seen), ["user_id"], [F.desc("score"), "item_id"], n)


# --- approximate search ---------------------------------------------------------


class LeafIndex:
    """Candidates sorted into k-means leaves; a query looks into its nearest leaves only.

    The leaf centres are a table of ``leaves`` rows. Within a leaf, candidates
    and queries are both cut into slices of about ``slice_rows``; one task
    compares one slice with one slice, so a leaf that holds a third of
    everything is shared among many tasks.
    """

    def __init__(self, candidates: DataFrame, key: str, leaves: int, seed: int = 42, slice_rows: int = BLOCK):
        self.key = key
        self.slice_rows = slice_rows
        spread = cut_lineage(candidates.withColumn("_vec", array_to_vector("v")))  # k-means reads it every round
        self.model = KMeans(k=leaves, seed=seed, maxIter=10, featuresCol="_vec", predictionCol="leaf").fit(spread)
        centres = [(i, [float(x) for x in c]) for i, c in enumerate(self.model.clusterCenters())]
        self.centres = candidates.sparkSession.createDataFrame(centres, f"{key} int, v array<double>")
        self.placed = self.model.transform(spread).select(F.col(key).alias("key"), "v", "leaf")

    def probes(self, queries: DataFrame, n: int) -> DataFrame:
        """(query_key, leaf): the n leaves nearest to each query."""
        return nearest(queries, self.centres, self.key, n, "l2").select("query_key", F.col("match_key").alias("leaf"))

    def _slices(self, rows: DataFrame, name: str) -> DataFrame:
        return rows.groupBy("leaf").agg(F.ceil(F.count(F.lit(1)) / self.slice_rows).cast("int").alias(name))

    def search(self, queries: DataFrame, k: int, leaves_to_search: int, drop_self: bool = False) -> DataFrame:
        """k best by exact inner product among the candidates of the probed leaves."""
        probed = self.probes(queries, leaves_to_search).withColumnRenamed("query_key", "key")
        asked = queries.select(F.col(self.key).alias("key"), "v").join(probed, "key")
        sizes = self._slices(asked, "_nq").join(self._slices(self.placed, "_nc"), "leaf")

        def sliced(rows: DataFrame, own: str, own_n: str, other: str, other_n: str) -> DataFrame:
            return rows.join(sizes, "leaf").select(  # own names: both sides may come from one frame
                F.col("key").alias("key"),
                F.col("v").alias("v"),
                F.col("leaf").alias("leaf"),
                F.pmod(F.xxhash64("key"), F.col(own_n)).cast("int").alias(own),
                F.explode(F.sequence(F.lit(0), F.col(other_n) - 1)).alias(other),
            )

        tile = ["leaf", "_q", "_c"]
        schema = match_schema(queries.schema[self.key].dataType, self.placed.schema["key"].dataType)
        leaves = self.model.getK()  # tiles, at least
        found = (
            by_tile(sliced(asked, "_q", "_nq", "_c", "_nc"), tile, leaves)
            .groupBy(*tile)
            .cogroup(by_tile(sliced(self.placed, "_c", "_nc", "_q", "_nq"), tile, leaves).groupBy(*tile))
            .applyInPandas(matcher("dot", k, drop_self), schema)
        )
        return top_k(found, ["query_key"], [F.desc("score"), "match_key"], k)


def recall_against(exact: DataFrame, approximate: DataFrame, k: int) -> DataFrame:
    """Mean share of the exact top k that the approximate list holds; one row."""
    hits = exact.select("query_key", "match_key").join(
        approximate.select("query_key", "match_key", F.lit(1).alias("_hit")), ["query_key", "match_key"], "left"
    )
    per = hits.groupBy("query_key").agg((F.sum(F.coalesce("_hit", F.lit(0))) / F.lit(float(k))).alias("recall"))
    return per.agg(fx.tidy(F.avg("recall")).alias("recall"), F.count(F.lit(1)).alias("queries"))


# --- ranking ----------------------------------------------------------------------


def two_stage(
    retrieved: DataFrame, features: DataFrame, tasks: Sequence[Column], weights: Sequence[float], n: int
) -> DataFrame:
    """Retrieved rows get features and T task scores; the weighted sum ranks them.

    ``retrieved`` (user_id, item_id, score), ``features`` (item_id, ...).
    """
    rows = retrieved.join(features, "item_id")
    final = F.lit(0.0)
    for task, weight in zip(tasks, weights):
        final = final + task * F.lit(float(weight))
    rows = rows.withColumn("final", fx.tidy(final))
    return top_k(rows, ["user_id"], [F.desc("final"), "item_id"], n).select("user_id", "item_id", "final", "rank")


def net_user_value(labels: Column, weights: Sequence[float]) -> Column:
    """Weighted sum of the labels of an impression."""
    return vx.weighted_sum(labels, F.array(*[F.lit(float(w)) for w in weights]))


def normalised_value(df: DataFrame, value: str, batch: str | None = None, floor: float = 1e-6) -> DataFrame:
    """Value floored, then divided by the greatest of its batch."""
    floored = F.greatest(F.col(value), F.lit(floor))
    if batch is None:
        return df.withColumn("weight", floored / df.agg(F.max(floored)).scalar())
    top = df.groupBy(batch).agg(F.max(floored).alias("_max"))
    return df.join(top, batch).withColumn("weight", floored / F.col("_max")).drop("_max")


def debiased(df: DataFrame, value: str, by: Sequence[str], floor: float) -> DataFrame:
    """Value divided by the value expected for the position (L9), the user.

    The mean per key is what minimises the squared error; it is floored first.
    """
    expected = df.groupBy(*by).agg(F.avg(value).alias("_expected"))
    return df.join(expected, list(by)).withColumn(
        "debiased", F.col(value) / F.greatest(F.col("_expected"), F.lit(floor))
    )


def debiased_by_position_and_user(
    df: DataFrame, value: str, position: str, user_feature: str, floor: float = 1e-3
) -> DataFrame:
    """Value divided by a linear estimate from the user feature and the position's mean.

    The least-squares line of two regressors comes from one row of sums.
    """
    per_position = df.groupBy(position).agg(F.avg(value).alias("_p"))
    rows = df.join(per_position, position)
    x, z, y = F.col(user_feature).cast("double"), F.col("_p"), F.col(value)
    s = rows.agg(
        F.struct(
            F.avg(x).alias("mx"), F.avg(z).alias("mz"), F.avg(y).alias("my"),
            F.covar_pop(x, x).alias("xx"), F.covar_pop(z, z).alias("zz"), F.covar_pop(x, z).alias("xz"),
            F.covar_pop(x, y).alias("xy"), F.covar_pop(z, y).alias("zy"),
        )
    ).scalar()
    rows = rows.withColumn("_s", s)
    c = {k: F.col("_s")[k] for k in ("mx", "mz", "my", "xx", "zz", "xz", "xy", "zy")}
    det = c["xx"] * c["zz"] - c["xz"] * c["xz"]
    bx = F.coalesce(F.try_divide(c["xy"] * c["zz"] - c["zy"] * c["xz"], det), F.lit(0.0))
    bz = F.coalesce(F.try_divide(c["zy"] * c["xx"] - c["xy"] * c["xz"], det), F.lit(1.0))
    estimate = c["my"] + bx * (x - c["mx"]) + bz * (z - c["mz"])
    out = rows.withColumn("expected", estimate)
    return out.withColumn("debiased", y / F.greatest(F.col("expected"), F.lit(floor))).drop("_s", "_p")


def target_aware_pooling(pairs: DataFrame, interests: DataFrame, key: Sequence[str] = ("user_id", "item_id")) -> DataFrame:
    """Sum of the user's vectors weighted by softmax(item . vector).

    ``pairs`` (user_id, item_id, iv), ``interests`` (user_id, slot, uv) with a
    fixed number of slots per user.
    """
    rows = pairs.join(interests, "user_id").withColumn("_z", vx.dot(F.col("iv"), F.col("uv")))
    w = Window.partitionBy(*key)
    rows = rows.withColumn("_e", F.exp(F.col("_z") - F.max("_z").over(w)))
    cells = rows.select(*key, "_e", F.posexplode("uv").alias("d", "x"))
    pooled = cells.groupBy(*key, "d").agg((F.sum(F.col("_e") * F.col("x")) / F.sum("_e")).alias("x"))
    return pooled


def history_summary(history: DataFrame, items: DataFrame, user: str = "user_id") -> DataFrame:
    """Most recent item vector and mean of the history vectors.

    ``history`` (user, pos, item_id) with pos 1 the newest, ``items`` (item_id, v).
    One row per user and dimension: dim, mean over the items that have a vector,
    recent (null where the newest item has none), missing (items without one).
    A user without any vector has one row with null dim.
    """
    rows = history.join(items, "item_id", "left")
    missing = rows.groupBy(user).agg(F.sum(F.col("v").isNull().cast("long")).alias("missing"))
    cells = rows.select(user, "pos", F.posexplode("v").alias("dim", "x"))
    summary = cells.groupBy(user, "dim").agg(
        fx.tidy(F.avg("x")).alias("mean"), fx.tidy(F.max(F.when(F.col("pos") == 1, F.col("x")))).alias("recent")
    )
    return missing.join(summary, user, "left").select(user, "dim", "mean", "recent", "missing")


def batch_recommend(model_rows: DataFrame, fallback: DataFrame) -> DataFrame:
    """(user, item, score, rank) of the model plus the fallback for users it does not know."""
    cols = ["user_id", "item_id", "score", "rank"]
    return model_rows.select(*cols).unionByName(fallback.select(*cols))
