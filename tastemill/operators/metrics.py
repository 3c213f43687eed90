"""Metrics of top-n lists, ratings and classifiers (N1-N14); each returns one row unless said otherwise."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tastemill.functions import scalar as fx
from tastemill.operators.ordering import running, top_k
from tastemill.session import cut_lineage

KEYS = ["user_id", "item_id"]


def _rows(df: DataFrame) -> Column:
    return df.agg(F.count(F.lit(1))).scalar()


def recall_precision(recs: DataFrame, truth: DataFrame) -> DataFrame:
    """Hits over all truth rows and over all recommended rows of truth users, percent."""
    asked = recs.select(*KEYS).join(truth.select("user_id").distinct(), "user_id", "left_semi")
    hits = asked.join(truth.select(*KEYS), KEYS, "left_semi").agg(F.count(F.lit(1)).alias("_h"))
    h = F.col("_h").cast("double") * 100
    return hits.select(
        fx.tidy(F.try_divide(h, _rows(truth)), 2).alias("recall"),
        fx.tidy(F.try_divide(h, _rows(asked)), 2).alias("precision"),
    )


def coverage(recs: DataFrame, train: DataFrame) -> DataFrame:
    """Distinct recommended items over distinct train items of those users, percent."""
    users = recs.select("user_id").distinct()
    base = train.join(users, "user_id", "left_semi").agg(F.count_distinct("item_id")).scalar()
    return recs.agg(F.count_distinct("item_id").alias("_r")).select(
        fx.tidy(F.try_divide(F.col("_r").cast("double") * 100, base), 2).alias("coverage")
    )


def mean_popularity(recs: DataFrame, train: DataFrame) -> DataFrame:
    """Mean ln(1 + train count) of the recommended items; unseen items count 0."""
    counts = train.groupBy("item_id").agg(F.count(F.lit(1)).alias("_n"))
    joined = recs.select("item_id").join(counts, "item_id", "left")
    return joined.agg(fx.tidy(F.avg(F.log1p(F.coalesce("_n", F.lit(0)).cast("double")))).alias("popularity"))


def hit_rate(recs: DataFrame, truth: DataFrame, n: int) -> DataFrame:
    """Truth rows found among the first n suggestions over all truth rows."""
    hits = truth.select(*KEYS).join(recs.filter(F.col("rank") <= n).select(*KEYS), KEYS, "left_semi")
    return hits.agg(F.count(F.lit(1)).alias("_h")).select(
        fx.tidy(F.try_divide(F.col("_h").cast("double"), _rows(truth))).alias("hit_rate")
    )


def mrr(ranks: DataFrame, rank: str = "rank") -> DataFrame:
    """Mean of 1 / rank of the true item."""
    return ranks.agg(fx.tidy(F.avg(F.lit(1.0) / F.col(rank))).alias("mrr"))


def recall_at(ranks: DataFrame, cuts: Sequence[int] = (1, 5, 10, 50), rank: str = "rank") -> DataFrame:
    """Share of true items ranked within each cut (N6; N13 with a cut of 100)."""
    return ranks.agg(*[fx.tidy(F.avg((F.col(rank) <= k).cast("double"))).alias(f"recall_{k}") for k in cuts])


def ranking_at_k(recs: DataFrame, truth: DataFrame, k: int) -> DataFrame:
    """MAP, NDCG, precision and recall at k, averaged over the truth users.

    A hit is a recommended item of the truth; a user without suggestions counts 0.
    """
    sizes = truth.groupBy("user_id").agg(F.count(F.lit(1)).alias("_rel"))
    hits = (
        recs.filter(F.col("rank") <= k)
        .select(*KEYS, "rank")
        .join(truth.select(*KEYS), KEYS)
        .withColumn("_i", F.row_number().over(Window.partitionBy("user_id").orderBy("rank")))  # at most k rows
    )
    per = hits.groupBy("user_id").agg(
        F.count(F.lit(1)).alias("_h"),
        F.sum(F.col("_i") / F.col("rank")).alias("_ap"),
        F.sum(F.lit(1.0) / F.log2(F.col("rank") + F.lit(1.0))).alias("_dcg"),
    )
    ideal = [0.0]
    for i in range(1, k + 1):
        ideal.append(ideal[-1] + 1.0 / math.log2(i + 1))
    best = F.get(F.array(*[F.lit(x) for x in ideal]), F.least(F.col("_rel"), F.lit(k)).cast("int"))
    zero = F.lit(0.0)
    joined = sizes.join(per, "user_id", "left")
    reach = F.least(F.col("_rel"), F.lit(k))
    return joined.agg(
        fx.tidy(F.avg(F.coalesce(F.col("_ap") / reach, zero))).alias("map"),
        fx.tidy(F.avg(F.coalesce(F.col("_dcg") / best, zero))).alias("ndcg"),
        fx.tidy(F.avg(F.coalesce(F.col("_h") / F.lit(k), zero))).alias("precision"),
        fx.tidy(F.avg(F.coalesce(F.col("_h") / F.col("_rel"), zero))).alias("recall"),
    )


def rating_errors(pairs: DataFrame, truth: str = "rating", guess: str = "prediction") -> DataFrame:
    """RMSE, MAE, R2 and explained variance of matched pairs."""
    y, p = F.col(truth), F.col(guess)
    e = y - p
    return pairs.agg(
        fx.tidy(F.sqrt(F.avg(e * e))).alias("rmse"),
        fx.tidy(F.avg(F.abs(e))).alias("mae"),
        fx.tidy(F.lit(1.0) - F.try_divide(F.avg(e * e), F.var_pop(y))).alias("r2"),
        fx.tidy(F.lit(1.0) - F.try_divide(F.var_pop(e), F.var_pop(y))).alias("explained_variance"),
    )


def log_loss(rows: DataFrame, label: str, probability: str, eps: float = 1e-15) -> DataFrame:
    """-mean(y ln p + (1-y) ln(1-p)), p kept away from 0 and 1."""
    p = F.least(F.greatest(F.col(probability), F.lit(eps)), F.lit(1.0 - eps))
    y = F.col(label).cast("double")
    return rows.agg(fx.tidy(-F.avg(y * F.log(p) + (F.lit(1.0) - y) * F.log(F.lit(1.0) - p))).alias("log_loss"))


def against_base_rate(rows: DataFrame, by: Sequence[str], label: str, probability: str, eps: float = 1e-15) -> DataFrame:
    """Rows, positives and whether the log loss is below that of the share of positives, per group of ``by``."""
    p = F.least(F.greatest(F.col(probability), F.lit(eps)), F.lit(1.0 - eps))
    y = F.col(label).cast("double")
    share = F.least(F.greatest(F.avg(y), F.lit(eps)), F.lit(1.0 - eps))
    loss = -F.avg(y * F.log(p) + (F.lit(1.0) - y) * F.log(F.lit(1.0) - p))
    base = -(share * F.log(share) + (F.lit(1.0) - share) * F.log(F.lit(1.0) - share))
    return rows.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col(label).cast("long")).alias("positives"), (loss < base).alias("better")
    )


def auc(rows: DataFrame, label: str, score: str) -> DataFrame:
    """Area under the ROC curve by rank sums, ties at their mean rank.

    Rows are first counted per distinct score, so equal scores cost one row and
    the running count of negatives is over scores, not over rows. One class
    only: null.
    """
    y = F.col(label).cast("long")
    per = rows.groupBy(score).agg(F.sum(y).alias("_p"), F.sum(1 - y).alias("_q"))
    below = running(per, [], [score], {"_below": F.col("_q")})
    wins = F.sum(F.col("_p").cast("double") * (F.col("_below") + F.col("_q") / 2.0))
    return below.agg(
        fx.tidy(F.try_divide(wins, F.sum("_p").cast("double") * F.sum("_q").cast("double"))).alias("auc")
    )


def accuracy(rows: DataFrame, label: str, probability: str, cut: float = 0.5) -> DataFrame:
    """Share of rows whose class at the cut is the label."""
    right = (F.col(probability) >= cut).cast("int") == F.col(label).cast("int")
    return rows.agg(fx.tidy(F.avg(right.cast("double"))).alias("accuracy"))


def classification_report(rows: DataFrame, by: str, label: str, probability: str, cut: float = 0.5) -> DataFrame:
    """Accuracy, precision, recall, F1 and AUC per split, one row each.

    Rows are counted per distinct probability first; everything else follows
    from those counts.
    """
    yy = F.col(label).cast("long")
    per = rows.groupBy(by, probability).agg(F.sum(yy).alias("_p"), F.sum(1 - yy).alias("_q"))
    per = cut_lineage(per)  # the scores are computed once, then read several times
    yes = F.col(probability) >= cut
    counts = per.groupBy(by).agg(
        F.sum(F.col("_p") + F.col("_q")).alias("n"),
        F.sum(F.when(yes, F.col("_p")).otherwise(0)).alias("tp"),
        F.sum(F.when(yes, F.col("_q")).otherwise(0)).alias("fp"),
        F.sum(F.when(yes, 0).otherwise(F.col("_p"))).alias("fn"),
    )
    below = running(per, [by], [probability], {"_below": F.col("_q")})
    wins = F.sum(F.col("_p").cast("double") * (F.col("_below") + F.col("_q") / 2.0))
    area = below.groupBy(by).agg(
        F.try_divide(wins, F.sum("_p").cast("double") * F.sum("_q").cast("double")).alias("_auc")
    )
    prec = F.try_divide(F.col("tp").cast("double"), F.col("tp") + F.col("fp"))
    rec = F.try_divide(F.col("tp").cast("double"), F.col("tp") + F.col("fn"))
    right = F.col("n") - F.col("fp") - F.col("fn")
    f1 = F.try_divide(2.0 * F.col("tp"), 2 * F.col("tp") + F.col("fp") + F.col("fn"))
    return counts.join(area, by).select(
        by,
        fx.tidy(right / F.col("n")).alias("accuracy"),
        fx.tidy(prec).alias("precision"),
        fx.tidy(rec).alias("recall"),
        fx.tidy(f1).alias("f1"),
        fx.tidy(F.col("_auc")).alias("auc"),
    )


def list_ndcg(rows: DataFrame, group: Sequence[str], label: str, score: str, tie: str, cuts: Sequence[int]) -> DataFrame:
    """Mean NDCG at several cuts over lists, padding (label < 0) ignored.

    Gain 2^label - 1, discount 1/log2(1 + place). Lists without a positive
    label do not count.
    """
    real = rows.filter(F.col(label) >= 0)
    deepest = max(cuts)
    gain = F.pow(F.lit(2.0), F.col(label)) - 1.0

    def places(order: list, ideal: bool) -> DataFrame:
        top = top_k(real, group, order, deepest, "_r")
        return top.select(*group, "_r", gain.alias("_g"), F.lit(ideal).alias("_ideal"))

    both = places([F.desc(score), tie], False).unionAll(places([F.desc(label), tie], True))
    worth = F.col("_g") / F.log2(F.col("_r") + 1.0)
    sums = [
        F.sum(F.when((F.col("_ideal") == ideal) & (F.col("_r") <= k), worth).otherwise(0.0)).alias(f"{prefix}{k}")
        for prefix, ideal in (("_d", False), ("_i", True))
        for k in cuts
    ]
    lists = both.groupBy(*group).agg(*sums).filter(F.col(f"_i{deepest}") > 0)
    return lists.agg(*[fx.tidy(F.avg(F.try_divide(F.col(f"_d{k}"), F.col(f"_i{k}")))).alias(f"ndcg_{k}") for k in cuts])
