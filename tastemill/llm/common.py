"""Shared pieces: reading tables, words, tables written in the shared folder."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tastemill.session import scratch_path

#: Fixed by the contract: white space is U+0020 and U+0009 to U+000D, everything else belongs to words.
SPACE = r"[\x20\x09-\x0D]+"
SPACE_CHARS = " \t\n\x0b\x0c\r"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def words(text: Column) -> Column:
    """Words of a text as an array; none for null, empty and blank texts."""
    inner = F.btrim(text, F.lit(SPACE_CHARS))
    return F.when(F.coalesce(F.length(inner), F.lit(0)) == 0, F.array().cast("array<string>")).otherwise(
        F.split(inner, SPACE)
    )


def word_count(text: Column) -> Column:
    return F.size(words(text)).cast("long")


def written(df: DataFrame, label: str) -> DataFrame:
    """The rows as a table in the shared folder: computed once, lineage cut, safe when executors are lost."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
