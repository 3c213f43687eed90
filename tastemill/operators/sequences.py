"""Timelines, training examples, negatives, splits."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tastemill.functions import scalar as fx
from tastemill.operators import ordering
from tastemill.operators.ordering import by_rows, group_sizes, list_parts, order_cols, position, previous_rows, top_k

#: Numbers one generated row holds before it is spread out again.
RANGE_CHUNK = 10_000


def timelines(df: DataFrame, order: Sequence[str]) -> DataFrame:
    """User timelines in time order with the number of rows of each item.

    One list per user, in parts of at most 1000 items.
    """
    counts = df.groupBy("item_id").agg(F.count(F.lit(1)).alias("_n"))
    rows = df.join(counts, "item_id")
    return list_parts(rows, ["user_id"], order, {"items": F.col("item_id"), "item_counts": F.col("_n")})


def context_examples(df: DataFrame, order: Sequence[str], context: int, fields: dict[str, Column], least: int = 3) -> DataFrame:
    """All (context, next item) examples of users with at least ``least`` rows.

    One row per position from the second on; each field gives the list of its
    values in the up to ``context`` rows before, oldest first.
    """
    sizes = df.groupBy("user_id").agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") >= least)
    long_enough = df.join(sizes.select("user_id"), "user_id", "left_semi")
    framed = previous_rows(long_enough, ["user_id"], order, context, fields)
    return framed.filter(F.col("pos") > 1).select(
        "user_id", "pos", F.col("item_id").alias("label_item"), *fields.keys()
    )


def padded(examples: DataFrame, length: int, fillers: dict[str, Column]) -> DataFrame:
    """Context lists cut or padded on the right (X2, X3); nested lists are flattened first."""
    out = {}
    for name, filler in fillers.items():
        values = F.col(name)
        if examples.schema[name].dataType.simpleString().startswith("array<array"):
            values = F.flatten(values)
        out[name] = fx.pad_list(values, length, filler)
    return examples.withColumns(out)


def sequence_windows(
    df: DataFrame, order: Sequence[str], len_seq: int, len_tag: int, len_pred: int
) -> tuple[DataFrame, DataFrame]:
    """Fixed-length (sequence, target) windows, the last ``len_pred`` items held out as test."""
    width = len_seq + max(len_tag, len_pred) - 1
    sizes = df.groupBy("user_id").agg(F.count(F.lit(1)).alias("_n"))
    framed = previous_rows(df, ["user_id"], order, width, {"_prev": F.col("item_id")}).join(sizes, "user_id")
    framed = framed.withColumn("_all", F.concat("_prev", F.array("item_id")))
    size = F.size("_all")
    train = framed.filter(
        (F.col("pos") >= len_seq + len_tag) & (F.col("pos") <= F.col("_n") - len_pred)
    ).select(
        "user_id",
        "pos",
        F.slice("_all", size - len_tag - len_seq + 1, F.lit(len_seq)).alias("seq"),
        F.slice("_all", size - len_tag + 1, F.lit(len_tag)).alias("target"),
    )
    held = F.least(F.lit(len_pred), size)
    start = F.greatest(size - held - len_seq + 1, F.lit(1))
    test = framed.filter(F.col("pos") == F.col("_n")).select(
        "user_id",
        F.slice("_all", start, size - held - start + 1).alias("seq"),
        F.slice("_all", size - held + 1, held).alias("target"),
    )
    return train, test


def sampled_lists(df: DataFrame, lists: int, size: int, seed: int = 42) -> DataFrame:
    """``lists`` lists per user of ``size`` rated items each, drawn by hash order.

    Users with fewer items than that give none. Tasks keep ``size`` rows per
    list before the shuffle.
    """
    enough = df.groupBy("user_id").agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") >= size)
    rows = df.join(enough.select("user_id"), "user_id", "left_semi")
    rows = rows.withColumn("list_no", F.explode(F.sequence(F.lit(1), F.lit(lists))))
    key = fx.shuffle_key("user_id", "item_id", "list_no", seed=seed)
    return top_k(rows, ["user_id", "list_no"], [key, "item_id"], size, "place")


def first_of_each(df: DataFrame, group: Sequence[str], order: Sequence[str], n: int, fields: dict[str, Column]) -> DataFrame:
    """Lists of the first ``n`` rows of each group, one row per group."""
    rows = top_k(df.select(*group, *order, *[v.alias(f"_f_{k}") for k, v in fields.items()]), group, order, n, "_place")
    row = F.struct("_place", *[F.col(f"_f_{k}").alias(k) for k in fields])
    lists = rows.groupBy(*group).agg(F.sort_array(F.collect_list(row)).alias("_rows"))  # n rows
    return lists.select(*group, *[F.col("_rows")[k].alias(k) for k in fields])


def padded_lists(lists: DataFrame, length: int, items: str = "items", labels: str = "labels") -> DataFrame:
    """Lists of one length with a mask; padded places have label -1."""
    item_type = lists.schema[items].dataType.elementType
    counted = lists.withColumn("_n", F.least(F.size(items), F.lit(length)))
    return counted.select(
        *[c for c in lists.columns if c not in (items, labels)],
        fx.pad_list(F.col(items), length, F.lit(0).cast(item_type)).alias(items),
        fx.pad_list(F.col(labels).cast("array<double>"), length, F.lit(-1.0)).alias(labels),
        F.transform(F.sequence(F.lit(1), F.lit(length)), lambda i: (i <= F.col("_n")).cast("int")).alias("mask"),
    )


def count_up(df: DataFrame, n: Column, name: str) -> DataFrame:
    """Rows repeated for 0..n-1, in two steps so that no list is longer than RANGE_CHUNK."""
    chunks = df.withColumn("_n", n).filter(F.col("_n") > 0)
    chunks = chunks.withColumn(
        "_c", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("_n") - 1) / RANGE_CHUNK)))
    )
    start = F.col("_c") * RANGE_CHUNK
    end = F.least(start + RANGE_CHUNK, F.col("_n")) - 1
    return chunks.withColumn(name, F.explode(F.sequence(start, end))).drop("_c", "_n")


def hash_index(df: DataFrame, key: Sequence[str], name: str = "idx", seed: int = 42) -> DataFrame:
    """Rows numbered 0, 1, 2 ... in hash order of their key."""
    placed = position(df, [], [fx.shuffle_key(*key, seed=seed), *key], name)
    return placed.withColumn(name, F.col(name) - 1)


def unseen_negatives(df: DataFrame, k: int, seed: int = 42) -> DataFrame:
    """k items per user that the user never took.

    Items stand in hash order on a ring. A user starts at an own hashed place and
    walks on: among any (items taken + k) places at least k are unseen, so the
    walk is exact and its length is the size of the data, not users x items.
    """
    pairs = df.select("user_id", "item_id").distinct()
    ring = hash_index(pairs.select("item_id").distinct(), ["item_id"], seed=seed)
    n = ring.count()
    taken = pairs.groupBy("user_id").agg(F.count(F.lit(1)).alias("_taken"))
    walk = count_up(taken, F.least(F.col("_taken") + k, F.lit(n)), "_step")
    walk = walk.withColumn("idx", F.pmod(fx.seeded_bucket(n, "user_id", seed=seed) + F.col("_step"), F.lit(n)))
    fresh = walk.join(ring, "idx").join(pairs, ["user_id", "item_id"], "left_anti")
    return top_k(fresh, ["user_id"], ["_step"], k).select("user_id", "item_id", "rank")


def borrowed_negatives(df: DataFrame, key: Sequence[str], k: int, seed: int = 42) -> DataFrame:
    """k rows of other users re-assigned to each user (X9); same walk, over the rows."""
    ring = hash_index(df, key, seed=seed).select(F.col("user_id").alias("_owner"), "item_id", "idx")
    n = df.count()
    own = df.groupBy("user_id").agg(F.count(F.lit(1)).alias("_own"))
    walk = count_up(own, F.least(F.col("_own") + k, F.lit(n)), "_step")
    walk = walk.withColumn("idx", F.pmod(fx.seeded_bucket(n, "user_id", seed=seed) + F.col("_step"), F.lit(n)))
    other = walk.join(ring, "idx").filter(F.col("_owner") != F.col("user_id"))
    return top_k(other, ["user_id"], ["_step"], k).select("user_id", "item_id", F.lit(0).alias("like"), "rank")


def balanced_labels(df: DataFrame, threshold: float, order: Sequence[str]) -> DataFrame:
    """Per user as many positives as negatives.

    Positives in ``order``, negatives by falling mean rating of the item. Users
    that fit a task are brought together once, for their counts and places.
    """
    means = df.groupBy("item_id").agg(fx.half_even(F.avg("rating"), 3).alias("_mean"))
    rows = df.join(means, "item_id").withColumn("label", (F.col("rating") >= threshold).cast("int"))
    take = F.least(F.sum("label"), F.sum(1 - F.col("label")))
    by = [F.when(F.col("label") == 0, -F.col("_mean")).otherwise(F.lit(0.0)), *order_cols(order)]
    largest, n = group_sizes(df, ["user_id"])
    if largest <= ordering.GROUP_LIMIT:
        rows = by_rows(rows.filter(F.col("user_id").isNotNull()), n, "user_id")
        place = F.row_number().over(Window.partitionBy("user_id", "label").orderBy(*by))
        per_user = Window.partitionBy("user_id")
        sums = F.least(F.sum("label").over(per_user), F.sum(1 - F.col("label")).over(per_user))
        placed = rows.withColumn("_pos", place).withColumn("_take", sums)
    else:
        sizes = rows.groupBy("user_id").agg(take.alias("_take")).filter(F.col("_take") > 0)
        placed = position(rows, ["user_id", "label"], by, "_pos").join(sizes, "user_id")
    return placed.filter(F.col("_pos") <= F.col("_take")).select("user_id", "item_id", "label")


# --- splits ---------------------------------------------------------------------


def random_split(df: DataFrame, train_share: float, *key: str, seed: int = 42) -> DataFrame:
    """``split`` = train or test by the hash of the key: stable under retries and new rows (X11)."""
    bucket = fx.seeded_bucket(10_000, *key, seed=seed)
    return df.withColumn("split", F.when(bucket < round(train_share * 10_000), "train").otherwise("test"))


def latest_as_test(df: DataFrame, order: Sequence[str]) -> DataFrame:
    """Each user's latest row is test, the others train."""
    key = F.struct(*order)
    last = df.groupBy("user_id").agg(F.max(key).alias("_last"))
    marked = df.withColumn("_key", key).join(last, "user_id")
    return marked.withColumn("split", F.when(F.col("_key") == F.col("_last"), "test").otherwise("train")).drop(
        "_key", "_last"
    )


def chronological_split(df: DataFrame, order: Sequence[str], shares: tuple[float, float] = (0.8, 0.9)) -> DataFrame:
    """First 80 % train, next 10 % valid, rest test, by place in ``order``."""
    n = df.agg(F.count(F.lit(1))).scalar()
    placed = position(df, [], order, "_pos")
    at = F.col("_pos") - 1
    split = F.when(at < n * F.lit(shares[0]), "train").when(at < n * F.lit(shares[1]), "valid").otherwise("test")
    return placed.withColumn("split", split).drop("_pos")


def stratified_split(df: DataFrame, group: str, train_share: float, *key: str, seed: int = 42) -> DataFrame:
    """The share of every group's rows in hash order is train, at least one row of each."""
    sizes = df.groupBy(group).agg(F.count(F.lit(1)).alias("_n"))
    placed = position(df, [group], [fx.shuffle_key(*key, seed=seed), *key], "_pos").join(sizes, group)
    take = F.greatest(F.lit(1), F.floor(F.col("_n") * F.lit(train_share) + F.lit(0.5)))
    return placed.withColumn("split", F.when(F.col("_pos") <= take, "train").otherwise("test")).drop("_pos", "_n")


def folds(df: DataFrame, k: int, *key: str, seed: int = 42) -> DataFrame:
    """Fold 0..k-1 of every row."""
    return df.withColumn("fold", fx.seeded_bucket(k, *key, seed=seed))


