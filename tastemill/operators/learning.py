"""Trees, linear and wide models on encoded features (M1-M10), through Spark ML pipelines."""

from __future__ import annotations

import random
from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression, MultilayerPerceptronClassifier
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import FeatureHasher, OneHotEncoder, PolynomialExpansion, StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import LinearRegression
from pyspark.ml.tuning import CrossValidator, CrossValidatorModel, ParamGridBuilder, TrainValidationSplit
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tastemill.functions import scalar as fx
from tastemill.operators.features import encoder
from tastemill.session import for_training


def boosted_trees(features: str = "features", label: str = "label", trees: int = 10, depth: int = 4,
                  step: float = 0.3, seed: int = 42, validation: str | None = None, tolerance: float = 0.01) -> GBTClassifier:
    """Gradient-boosted trees (M1); with a validation flag column they stop early (M9)."""
    gbt = GBTClassifier(
        featuresCol=features, labelCol=label, maxIter=trees, maxDepth=depth, stepSize=step, seed=seed
    )
    if validation is not None:
        gbt = gbt.setValidationIndicatorCol(validation).setParams(validationTol=tolerance)
    return gbt


def tree_pipeline(numeric: Sequence[str], categorical: Sequence[str], **params) -> Pipeline:
    return Pipeline(stages=[*encoder(numeric, categorical).getStages(), boosted_trees(**params)])


class LeafFeatures:
    """Boosted trees whose leaves become the features of a logistic regression (M2)."""

    def __init__(self, train: DataFrame, features: str = "features", label: str = "label",
                 trees: int = 10, depth: int = 4, reg: float = 0.01, seed: int = 42):
        gbt = boosted_trees(features, label, trees, depth, seed=seed).setLeafCol("_leaves")
        self.trees = gbt.fit(train)
        grown = self.trees.getNumTrees
        self.names = [f"_leaf{i}" for i in range(grown)]
        hot = [f"{n}_hot" for n in self.names]
        encode = OneHotEncoder(inputCols=self.names, outputCols=hot, handleInvalid="keep")
        gather = VectorAssembler(inputCols=hot, outputCol="_leaf_features")
        linear = LogisticRegression(
            featuresCol="_leaf_features", labelCol=label, regParam=reg, maxIter=30,
            predictionCol="_lr_prediction", rawPredictionCol="_lr_raw", probabilityCol="_lr_probability",
        )
        self.model = Pipeline(stages=[encode, gather, linear]).fit(for_training(self._leaves(train).select(label, *self.names)))

    def _leaves(self, df: DataFrame) -> DataFrame:
        out = self.trees.transform(df).withColumn("_l", vector_to_array("_leaves"))
        return out.select("*", *[F.col("_l")[i].alias(n) for i, n in enumerate(self.names)])

    def score(self, df: DataFrame) -> DataFrame:
        """Rows with ``p``, the probability of class 1."""
        out = self.model.transform(self._leaves(df))
        return out.withColumn("p", vector_to_array("_lr_probability")[1])


def grid_search(
    train: DataFrame,
    estimator: GBTClassifier,
    grid: dict[str, Sequence],
    fold: str,
    folds: int,
    parallelism: int = 4,
) -> CrossValidatorModel:
    """All settings of the grid by k-fold AUC, folds given by a column (M3)."""
    builder = ParamGridBuilder()
    for name, values in grid.items():
        builder = builder.addGrid(estimator.getParam(name), list(values))
    cv = CrossValidator(
        estimator=estimator,
        estimatorParamMaps=builder.build(),
        evaluator=BinaryClassificationEvaluator(labelCol=estimator.getLabelCol()),
        numFolds=folds,
        foldCol=fold,
        parallelism=parallelism,
    )
    return cv.fit(train)


def random_search(
    train: DataFrame,
    estimator: GBTClassifier,
    ranges: dict[str, tuple],
    trials: int = 30,
    seed: int = 42,
    parallelism: int = 4,
):
    """``trials`` random settings on a held-out fifth, greatest AUC wins (M4).

    A range of two ints draws an int, of two floats a float.
    """
    rnd = random.Random(seed)
    maps = []
    for _ in range(trials):
        drawn = {}
        for name, (low, high) in ranges.items():
            value = rnd.randint(low, high) if isinstance(low, int) else rnd.uniform(low, high)
            drawn[estimator.getParam(name)] = value
        maps.append(drawn)
    tvs = TrainValidationSplit(
        estimator=estimator,
        estimatorParamMaps=maps,
        evaluator=BinaryClassificationEvaluator(labelCol=estimator.getLabelCol()),
        trainRatio=0.8,
        seed=seed,
        parallelism=parallelism,
    )
    return tvs.fit(train)


def settings_table(spark, maps: Sequence[dict], scores: Sequence[float]) -> DataFrame:
    """(setting, auc) of a finished search."""
    rows = [
        (", ".join(f"{p.name}={v}" for p, v in sorted(m.items(), key=lambda x: x[0].name)), float(a))
        for m, a in zip(maps, scores)
    ]
    return spark.createDataFrame(rows, "setting string, auc double")


def wide_pipeline(
    categorical: Sequence[str],
    numeric: Sequence[str],
    crosses: Sequence[tuple[str, str]],
    size: int = 1 << 14,
    label: str = "label",
    reg: float = 0.001,
) -> tuple[list[str], Pipeline]:
    """Linear model over hashed categories, numbers and crosses (M5).

    The crosses are columns ``a_x_b`` to be added by ``with_crosses``.
    """
    names = [*categorical, *[f"{a}_x_{b}" for a, b in crosses]]
    hashed = FeatureHasher(
        inputCols=[*names, *numeric], outputCol="features", numFeatures=size, categoricalCols=names
    )
    linear = LogisticRegression(featuresCol="features", labelCol=label, regParam=reg, maxIter=20)
    return names, Pipeline(stages=[hashed, linear])


def with_crosses(df: DataFrame, crosses: Sequence[tuple[str, str]], buckets: int = 1000) -> DataFrame:
    return df.withColumns({f"{a}_x_{b}": fx.hashed_cross(a, b, buckets) for a, b in crosses})


def deep_model(
    train: DataFrame, numeric: Sequence[str], categorical: Sequence[str], hidden: Sequence[int] = (16, 8),
    label: str = "label", rounds: int = 30, seed: int = 42,
) -> PipelineModel:
    """Multilayer perceptron on assembled, scaled features (M6); the first layer has as many nodes as the encoder gives."""
    scale = StandardScaler(inputCol="features", outputCol="scaled", withMean=True)
    encode = Pipeline(stages=[*encoder(numeric, categorical).getStages(), scale]).fit(train)
    width = encode.stages[-1].mean.size
    net = MultilayerPerceptronClassifier(
        featuresCol="scaled", labelCol=label, layers=[width, *hidden, 2], maxIter=rounds, seed=seed
    )
    return PipelineModel(stages=[*encode.stages, net.fit(encode.transform(train))])


def crossed_linear(inputs: Sequence[str], label: str, reg: float = 0.0) -> Pipeline:
    """Linear regression on the features and their explicit products (M7)."""
    gather = VectorAssembler(inputCols=list(inputs), outputCol="_x")
    cross = PolynomialExpansion(degree=2, inputCol="_x", outputCol="features")
    return Pipeline(stages=[gather, cross, LinearRegression(featuresCol="features", labelCol=label, regParam=reg)])


def ridge(inputs: Sequence[str], label: str, reg: float = 0.1) -> Pipeline:
    """Ridge regression on scaled inputs and target (M8); Spark scales both inside and gives the plain unit back."""
    gather = VectorAssembler(inputCols=list(inputs), outputCol="features")
    line = LinearRegression(
        featuresCol="features", labelCol=label, regParam=reg, elasticNetParam=0.0, standardization=True
    )
    return Pipeline(stages=[gather, line])


def probability(scored: DataFrame, name: str = "p") -> DataFrame:
    """Probability of class 1 with 6 decimals."""
    return scored.withColumn(name, fx.tidy(vector_to_array("probability")[1]))


def saved_and_loaded(model: PipelineModel, path: str) -> PipelineModel:
    """The model after a round trip through storage."""
    model.write().overwrite().save(path)
    return PipelineModel.load(path)
