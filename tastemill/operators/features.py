"""Feature encoding for models."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import OneHotEncoder, PolynomialExpansion, StringIndexer, VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tastemill.functions import scalar as fx
from tastemill.operators.joins import lookup
from tastemill.operators.ordering import by_rows, position, running, top_k

#: Dimensions of a vector that are summed in one row.
PIECE = 64
#: Vectors of at most so many bytes go to every task.
BROADCAST_BYTES = 32_000_000


def index_column(df: DataFrame, vocabulary: DataFrame, column: str, name: str, unknown: int = 0) -> DataFrame:
    """Dense index of a column by an index table (column, idx); unknown values get ``unknown`` (H1, H2)."""
    return lookup(df, vocabulary, column, "idx", unknown, name)


def frequency_index(df: DataFrame, value: str, name: str = "idx", start: int = 0, size: int | None = None) -> DataFrame:
    """Values numbered by falling frequency, ties by value; optionally the first ``size`` only."""
    counts = df.filter(F.col(value).isNotNull()).groupBy(value).agg(F.count(F.lit(1)).alias("n"))
    if size is not None:
        counts = counts.orderBy(F.desc("n"), value).limit(size)
    placed = position(counts, [], [F.desc("n"), value], name)
    return placed.withColumn(name, F.col(name) - 1 + start)


def one_hot(code: Column, width: Column | int) -> Column:
    """0/1 array of ``width``, the size of the fitted vocabulary; an unknown code (null or out of range) is all zeros (H4)."""
    places = F.sequence(F.lit(0).cast("long"), F.lit(width).cast("long") - 1)
    hot = F.transform(places, lambda i: F.coalesce((code == i).cast("int"), F.lit(0)))
    return F.when(F.lit(width) > 0, hot).otherwise(F.array().cast("array<int>"))


def vocabulary_size(codes: DataFrame) -> Column:
    """Number of rows of a fitted index table, as a scalar subquery."""
    return codes.agg(F.count(F.lit(1))).scalar()


def impute(df: DataFrame, numeric: Sequence[str] = (), categorical: Sequence[str] = ()) -> DataFrame:
    """Nulls become the mean (numeric) or the most frequent value, ties to the lower one (H5).

    Every fill value is a scalar subquery: counts are combined map-side and no
    value passes through the driver.
    """
    fills = {}
    for c in numeric:
        fills[c] = F.coalesce(F.col(c).cast("double"), df.agg(F.avg(c)).scalar())
    for c in categorical:
        counts = df.filter(F.col(c).isNotNull()).groupBy(c).agg(F.count(F.lit(1)).alias("n"))
        best = counts.agg(F.min_by(c, F.struct(-F.col("n"), F.col(c)))).scalar()
        fills[c] = F.coalesce(F.col(c), best)
    return df.withColumns(fills)


def standardise(df: DataFrame, train: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(x - mean) / population standard deviation of the training rows (H6)."""
    out = {}
    for c in columns:
        mean, dev = train.agg(F.avg(c)).scalar(), train.agg(F.stddev_pop(c)).scalar()
        out[c] = F.coalesce(F.try_divide(F.col(c) - mean, dev), F.lit(0.0))
    return df.withColumns(out)


def min_max(df: DataFrame, column: str, name: str) -> DataFrame:
    """Column scaled to 0..1 (H7)."""
    low, high = df.agg(F.min(column)).scalar(), df.agg(F.max(column)).scalar()
    return df.withColumn(name, F.coalesce(F.try_divide(F.col(column) - low, high - low), F.lit(0.0)))


def rare_and_missing(df: DataFrame, column: str, least: int, name: str | None = None) -> DataFrame:
    """Null -> ``UNK``, values seen fewer than ``least`` times -> ``LESS`` (H9)."""
    kept = df.groupBy(column).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") >= least).select(
        F.col(column).alias("_k")
    )
    value = F.when(F.col(column).isNull(), "UNK").when(F.col("_k").isNull(), "LESS").otherwise(F.col(column))
    return df.join(kept, F.col(column) == F.col("_k"), "left").withColumn(name or column, value).drop("_k")


def sequential_encoding(df: DataFrame, column: str, label: str, order: Sequence[str]) -> DataFrame:
    """Target and count encoding from earlier rows only.

    ``target``: mean label of earlier rows of the category (null for its first
    row); ``share``: earlier rows of the category / all earlier rows.
    """
    per = running(df, [column], order, {"_y": F.col(label).cast("long"), "_c": F.lit(1)})
    placed = position(per, [], order, "_i")
    return placed.withColumns(
        {
            "target": F.try_divide(F.col("_y").cast("double"), F.col("_c").cast("double")),
            "share": F.try_divide(F.col("_c").cast("double"), (F.col("_i") - 1).cast("double")),
        }
    ).drop("_y", "_c", "_i")


def binary_code(code: Column, highest: Column) -> Column:
    """The bits of a code, lowest first, as many as the ``highest`` code needs."""
    bits = F.length(F.bin(highest))
    return F.transform(
        F.sequence(F.lit(0), bits - 1), lambda i: F.call_function("shiftright", code, i).bitwiseAND(F.lit(1)).cast("int")
    )


def mean_token_vectors(tok: DataFrame, key: str, vectors: DataFrame) -> DataFrame:
    """Mean of the token vectors of each text, (key, dim, x) rows.

    ``tok`` (key, token, tf), ``vectors`` (token, v). The counts weight the
    mean, so a text's repeated tokens are joined once. A text is one row of
    sums for every PIECE dimensions and becomes a row per dimension at the end.
    """
    at = F.sequence(F.lit(0), F.ceil(F.size("v") / PIECE).cast("int") - 1)
    pieces = vectors.filter(F.size("v") > 0).select(
        "token", F.posexplode(F.transform(at, lambda i: F.slice("v", i * PIECE + 1, PIECE))).alias("_piece", "v")
    )
    counts = dict(tuple(r) for r in pieces.groupBy(F.size("v")).count().collect())  # at most PIECE lengths
    lengths = sorted(counts) or [1]
    if sum(n * 8 * c for n, c in counts.items()) <= BROADCAST_BYTES:
        pieces = F.broadcast(pieces)
    tf = F.col("tf")
    totals = [F.sum(F.when(F.size("v") >= n, tf)).alias(f"_n{n}") for n in lengths]
    sums = [F.sum(tf * F.get("v", F.lit(d))).alias(f"_s{d}") for d in range(lengths[-1])]
    rows = by_rows(tok, tok.count(), key).join(pieces, "token").groupBy(key, "_piece").agg(*totals, *sums)
    cells = [
        F.struct(
            (F.col("_piece") * PIECE + d).alias("dim"),
            F.col(f"_s{d}").alias("s"),
            F.col(f"_n{next(n for n in lengths if n > d)}").alias("n"),
        )
        for d in range(lengths[-1])
    ]
    out = rows.select(key, F.explode(F.array(*cells)).alias("c")).filter(F.col("c.n").isNotNull())
    return out.select(key, "c.dim", fx.tidy(F.col("c.s") / F.col("c.n")).alias("x"))


def dense_and_sparse(df: DataFrame, dense: Sequence[str], sparse: Sequence[str]) -> DataFrame:
    """Dense: null -> 0, guarded log; sparse: null -> '-1' (H17)."""
    out = {c: fx.guarded_log1p(F.coalesce(F.col(c).cast("double"), F.lit(0.0))) for c in dense}
    out |= {c: F.coalesce(F.col(c).cast("string"), F.lit("-1")) for c in sparse}
    return df.withColumns(out)


def encoder(numeric: Sequence[str], categorical: Sequence[str], features: str = "features") -> Pipeline:
    """Index by frequency, one-hot with unknowns as all zeros, assemble."""
    stages = []
    if categorical:
        indexed = [f"{c}_idx" for c in categorical]
        hot = [f"{c}_hot" for c in categorical]
        stages.append(
            StringIndexer(
                inputCols=list(categorical), outputCols=indexed, handleInvalid="keep", stringOrderType="frequencyDesc"
            )
        )
        # The slot kept for unknown values is the last one, and dropLast takes it away.
        stages.append(OneHotEncoder(inputCols=indexed, outputCols=hot, dropLast=True))
    else:
        hot = []
    stages.append(VectorAssembler(inputCols=[*numeric, *hot], outputCol=features))
    return Pipeline(stages=stages)


def fit_encoder(train: DataFrame, numeric: Sequence[str], categorical: Sequence[str]) -> PipelineModel:
    return encoder(numeric, categorical).fit(train)


def second_order(input_col: str, output_col: str) -> PolynomialExpansion:
    """All products of two features next to the features themselves."""
    return PolynomialExpansion(degree=2, inputCol=input_col, outputCol=output_col)


def newest_items(df: DataFrame, n: int) -> DataFrame:
    """(user_id, pos, item_id): the n newest interactions of each user, 1 the newest."""
    return top_k(df, ["user_id"], [F.desc("ts"), "item_id"], n, "pos").select("user_id", "pos", "item_id")
