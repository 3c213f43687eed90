"""Text sources: every reader declares its schema; nothing is inferred."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

CLICKS = "user_id string, item_id string, rating double"
CLICKS_WITH_TIME = "user_id string, item_id string, timestamp long, rating double"
ITEMS = "item_id string, title string"
ITEMS_WITH_CATEGORIES = "item_id string, title string, categories string"
USERS = "user_id string, last_user_agent string"
RATINGS = "userid string, itemid string, rating double, timestamp long"
RATINGS_1M = "UserID long, MovieID long, Rating double, Timestamp long"
MOVIES_1M = "MovieID long, Title string, Genres string"
RATINGS_100K = "user_id long, item_id long, rating int, timestamp long"


def read_csv(spark: SparkSession, path: str, schema: str | T.StructType, header: bool = True) -> DataFrame:
    """Comma-separated scan with a header row to skip and declared columns (A1)."""
    return spark.read.schema(schema).option("header", header).option("enforceSchema", True).csv(path)


def read_items_with_commas(spark: SparkSession, path: str) -> DataFrame:
    """Items whose title may hold commas: id first, genres last, the rest is the title (A2).

    Lines with fewer than three fields are skipped; of several lines with one id
    the first stays (first by file and place in the file).
    """
    lines = spark.read.text(path).select(
        "value",
        F.struct("_metadata.file_path", "_metadata.file_block_start").alias("_f"),
        F.monotonically_increasing_id().alias("_i"),
    )
    pattern = r"^([^,]*),(.*),([^,]*)$"
    title = F.regexp_replace(F.regexp_extract("value", pattern, 2), r'^"|"$', "")
    parsed = lines.filter(F.col("value").rlike(pattern)).select(
        F.regexp_extract("value", pattern, 1).alias("itemid"),
        title.alias("title"),
        F.regexp_extract("value", pattern, 3).alias("genres"),
        "_f",
        "_i",
    )
    first = F.min_by(F.struct("title", "genres"), F.struct("_f", "_i"))
    return parsed.groupBy("itemid").agg(first.alias("r")).select("itemid", "r.title", "r.genres")


def read_delimited(
    spark: SparkSession, path: str, schema: str, sep: str, encoding: str = "UTF-8", header: bool = False
) -> DataFrame:
    """Scan with another separator and encoding (A3 ``::``, A4 tab)."""
    return (
        spark.read.schema(schema).option("sep", sep).option("encoding", encoding).option("header", header).csv(path)
    )


def read_ratings_1m(
    spark: SparkSession, path: str, min_rating: float | None = None, encoding: str = "ISO-8859-1"
) -> DataFrame:
    """``::`` ratings, optionally only those of at least ``min_rating`` (A3)."""
    out = read_delimited(spark, path, RATINGS_1M, "::", encoding)
    return out if min_rating is None else out.filter(F.col("Rating") >= min_rating)


def read_dropping_malformed(
    spark: SparkSession, path: str, names: Sequence[str], types: Sequence[str], sep: str = ";", header: bool = True
) -> DataFrame:
    """Latin-1 scan that drops lines that do not fit, columns named by place (A5)."""
    schema = ", ".join(f"`{n}` {t}" for n, t in zip(names, types))
    return (
        spark.read.schema(schema)
        .option("sep", sep)
        .option("encoding", "ISO-8859-1")
        .option("header", header)
        .option("mode", "DROPMALFORMED")
        .csv(path)
    )


def read_complete_rows(
    spark: SparkSession, path: str, schema: str, drop: Sequence[str] = (), null_mark: str = "?"
) -> DataFrame:
    """``?`` is null, named columns leave, rows with any null leave."""
    raw = (
        spark.read.schema(schema)
        .option("header", False)
        .option("nullValue", null_mark)
        .option("ignoreLeadingWhiteSpace", True)
        .option("ignoreTrailingWhiteSpace", True)
        .csv(path)
    )
    return raw.drop(*drop).dropna("any")


def read_lines_with_defaults(
    spark: SparkSession, path: str, schema: str, defaults: dict[str, object], reject: str = "?"
) -> DataFrame:
    """Lines holding ``reject`` leave; the others are decoded with a default per column."""
    lines = spark.read.text(path).filter(~F.col("value").contains(reject))
    options = {"ignoreLeadingWhiteSpace": "true", "ignoreTrailingWhiteSpace": "true"}
    parsed = lines.select(F.from_csv("value", schema, options).alias("r")).select("r.*")
    return parsed.fillna(defaults)


def read_table(spark: SparkSession, sql: str) -> DataFrame:
    """Warehouse scan through SQL."""
    return spark.sql(sql)


def with_defaults(df: DataFrame, defaults: dict[str, Column]) -> DataFrame:
    """Missing fields of a re-read data set get their default, lists included."""
    return df.withColumns({c: F.coalesce(F.col(c), d) for c, d in defaults.items()})
