"""Sinks: executors write their own part files, nothing passes through the driver."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tastemill.operators.ordering import list_parts


def write_csv(df: DataFrame, path: str, sep: str = ",", header: bool = True) -> str:
    """Folder of headed CSV files."""
    df.write.mode("overwrite").option("header", header).option("sep", sep).csv(path)
    return path


def write_lines(df: DataFrame, path: str) -> str:
    """One text column as plain lines."""
    df.write.mode("overwrite").text(path)
    return path


def write_parquet(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> str:
    """Columnar export."""
    df.write.mode("overwrite").partitionBy(*partition_by).parquet(path)
    return path


def write_matrix(df: DataFrame, path: str, features: str, width: int) -> str:
    """Training matrix; the number of features is kept as metadata of the column (A10)."""
    tagged = df.withMetadata(features, {"num_features": int(width)})
    return write_parquet(tagged, path)


def matrix_width(df: DataFrame, features: str) -> int:
    """Number of features written by ``write_matrix``."""
    return int(df.schema[features].metadata["num_features"])


def vocabulary(df: DataFrame, value: str, name: str = "n") -> DataFrame:
    """Distinct values with their counts."""
    return df.groupBy(value).agg(F.count(F.lit(1)).alias(name))


def list_with_context(
    df: DataFrame, context: Sequence[str], order: str, example: Sequence[str], size: int | None = None
) -> DataFrame:
    """One nested record per context with its ordered examples (A12); long lists go on in the next ``part``."""
    names = [order, *[c for c in example if c != order]]
    lists = list_parts(df, context, names, {"examples": F.struct(*names)}, size)
    return lists.select(*context, "part", "examples")


def examples_of(nested: DataFrame, context: Sequence[str]) -> DataFrame:
    """Inverse of ``list_with_context``."""
    return nested.select(*context, F.explode("examples").alias("e")).select(*context, "e.*")
