"""Collaborative filtering: co-occurrence, Pearson, swing, Jaccard affinity, cosine neighbours."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tastemill.functions import scalar as fx
from tastemill.operators import listed
from tastemill.operators.grid import meetings, packed
from tastemill.operators.ordering import LIST_LIMIT, by_rows, group_sizes, top_k
from tastemill.operators.pairs import degrees, mirrored, pair_sums, shared_pairs
from tastemill.operators.tiles import _best_of_all, best_matches, block_count, by_tile
from tastemill.session import cut_lineage

DECIMALS = 6
#: Rows of a table of similar items that is handed to every task.
FEW_SIMILARITIES = 500_000
#: (item, neighbour) cells of one user that a task sums up.
USER_CELLS = 20_000_000
#: Pairs of users whose similarity a task holds at a time, and items added up at a time.
RATER_CELLS = 1_000_000
RATER_ITEMS = 256
#: Members from which their pairs are summed in tiles; cells of dense tables (members x members x groups) that cost as
#: much as a row of the join; pairs that leave a tile at once.
TILED_MEMBERS = 1_000
DENSE_WORK = 512
PAIRS_SENT = 250_000


def _weighted(
    df: DataFrame, group: str, member: str, weight: str, ts: str | None, rating: str | None
) -> DataFrame:
    """(key, token, weight[, t]): what a member brings to a shared group.

    The product of two weights (times the closeness of the two ``t``, if there
    is one) is the gain of a pair, divisor included, so sums need no later join.
    """
    cols = [F.col(member).alias("key"), F.col(group).alias("token")]
    if rating is not None:
        norms = df.groupBy(member).agg(F.sqrt(F.sum(F.col(rating) * F.col(rating))).alias("_norm"))
        share = F.coalesce(F.try_divide(F.col(rating), F.col("_norm")), F.lit(0.0))
        return df.join(norms, member).select(*cols, share.alias("weight"))
    base = df.join(degrees(df, member, "_n"), member)
    value = F.lit(1.0) / F.sqrt(F.col("_n").cast("double"))
    if weight == "damped":
        busy = degrees(df, group, "_g").select(group, F.sqrt(fx.activity_damping(F.col("_g"))).alias("_w"))
        base, value = base.join(busy, group), value * F.col("_w")
    elif weight == "decay":
        cols.append(F.coalesce(ts, F.lit(0)).alias("t"))
    elif weight != "base":
        raise ValueError(f"unknown weight {weight}")
    return base.select(*cols, value.alias("weight"))


def _list_rows(
    df: DataFrame, group: str, member: str, weight: str, ts: str | None, rating: str | None
) -> DataFrame:
    """The same for lists: (key, token, f[, v][, t][, w]), divisors and weights of groups not multiplied out."""
    cols = [F.col(member).alias("key"), F.col(group).alias("token")]
    if rating is not None:
        value = F.col(rating).cast("double")
        norms = df.groupBy(member).agg(F.coalesce(F.sum(value * value), F.lit(0.0)).alias("f"))
        return df.join(norms, member).select(*cols, "f", F.coalesce(value, F.lit(0.0)).alias("v"))
    base = df.join(degrees(df, member, "f"), member)
    cols.append(F.col("f").cast("double"))
    if weight == "damped":
        busy = degrees(df, group, "_g").select(group, fx.activity_damping(F.col("_g")).alias("w"))
        base = base.join(busy, group)
        cols.append("w")
    elif weight == "decay":
        cols.append(F.coalesce(ts, F.lit(0)).alias("t"))
    elif weight != "base":
        raise ValueError(f"unknown weight {weight}")
    return base.select(*cols)


def _values(table: DataFrame) -> list[str]:
    return [c for c in table.columns if c not in ("key", "token")]


def _gain(table: DataFrame) -> Column:
    product = F.col("weight_a") * F.col("weight_b")
    return product * fx.time_closeness(F.col("t_a"), F.col("t_b")) if "t" in table.columns else product


def _positive_sums(pairs: DataFrame, table: DataFrame) -> DataFrame:
    """Summed gain per pair, where above 0 (a rating of 0 brings nothing)."""
    sums = pairs.groupBy("a", "b").agg(F.sum(_gain(table)).alias("score")).filter(F.col("score") > 0)
    return sums.withColumn("score", fx.tidy("score", DECIMALS))


def _pair_scores(table: DataFrame, tile: int | None = None) -> DataFrame:
    pairs = shared_pairs(table, "token", "key", _values(table), tile)
    return _positive_sums(pairs, table)


def co_occurrence(
    df: DataFrame, group: str, member: str, weight: str = "base", ts: str = "ts", tile: int | None = None
) -> DataFrame:
    """Similarity of members that share groups; columns a, b (a < b), score.

    ``weight`` is what one shared group adds: ``base`` 1, ``damped``
    1/log10(1 + size of the group), ``decay`` the closeness in time of the two
    interactions. The sum is divided by sqrt(n_a * n_b).
    """
    return _pair_scores(_weighted(df, group, member, weight, ts, None), tile)


def neighbours(sim: DataFrame, k: int) -> DataFrame:
    """The k most similar members of each member, from a symmetric a < b table."""
    return top_k(mirrored(sim), ["a"], [F.desc("score"), "b"], k)


#: Rows of a group in one block when a few members meet it.
BIG_GROUP = 100_000
#: Rows the members of a block bring to a tile, on average.
BLOCK_ROWS = 2_000_000
#: Rows of one member that fit a tile; members with more are matched by themselves.
MEMBER_ROWS = 2_000_000


def most_similar(
    df: DataFrame, group: str, member: str, k: int, weight: str = "base", ts: str = "ts", rating: str | None = None
) -> DataFrame:
    """The k most similar members of each member: a, b, score, rank.

    Two exact ways, chosen by their cost:

    * tiles - blocks of members against blocks of members; a tile holds all rows
      of its members, so its sums are final and only k rows per member leave it.
      Every row is copied once per block of the other side. Members with too
      many rows for a tile are few; their pairs are summed by a join.
    * lists - the list of a group goes to every block that holds one of its
      members (``listed``). Cheaper when groups are small and members are many.
      Members with too many partners for a block are few; theirs are summed by a join.

    ``weight`` is one of ``co_occurrence``; with ``rating`` the similarity is the
    cosine of the rating vectors.
    """
    used = [group, member, *([ts] if weight == "decay" else []), *([rating] if rating else [])]
    df = cut_lineage(df.select(*used))  # counted and read from both sides: computed once
    per_group = df.groupBy(group).agg(F.count(F.lit(1)).cast("double").alias("_n"))
    per_group = per_group.agg(F.sum("_n"), F.sum(F.col("_n") * (F.col("_n") - 1) / 2), F.max("_n"))
    rows, pairs, widest = (x or 0 for x in per_group.first())
    sizes = degrees(df, member, "_n")
    members, largest = (x or 0 for x in sizes.agg(F.count(F.lit(1)), F.max("_n")).first())
    parallel = df.sparkSession.sparkContext.defaultParallelism
    blocks = max(block_count(members, parallel), math.ceil(rows / BLOCK_ROWS))
    table = _weighted(df, group, member, weight, ts, rating)
    if pairs < 2 * blocks * rows:
        hot = None
        if largest * widest > listed.MEMBER_ENTRIES:
            met = df.join(degrees(df, group, "_g"), group).groupBy(F.col(member).alias("key")).agg(F.sum("_g").alias("_m"))
            hot = cut_lineage(met.filter(F.col("_m") > listed.MEMBER_ENTRIES).select("key"))
        near = listed.best_by_lists(_list_rows(df, group, member, weight, ts, rating), k, pairs, int(widest), hot)
        if hot is None:
            return near
        table = cut_lineage(table)
        theirs = _pairs_of(table.join(hot, "key", "left_semi"), table)
        return near.unionByName(top_k(theirs, ["a"], [F.desc("score"), "b"], k))
    table = cut_lineage(table)  # both sides of the tiles read it
    hot = None
    if largest > MEMBER_ROWS:
        big = sizes.filter(F.col("_n") > MEMBER_ROWS).select(F.col(member).alias("key"))
        hot = _pairs_of(table.join(big, "key", "left_semi"), table)
        table = table.join(big, "key", "left_anti")
    kernel = "closeness" if "t" in table.columns else "overlap"
    near = best_matches(table, table, "key", k, kernel, drop_self=True, positive_only=True, blocks=(blocks, blocks))
    near = near.select(F.col("query_key").alias("a"), F.col("match_key").alias("b"), "score", "rank")
    if hot is None:
        return near
    hot = cut_lineage(hot)
    mirror = hot.join(big.withColumnRenamed("key", "b"), "b", "left_anti")  # pairs of two big ones stand both ways
    every = near.drop("rank").unionByName(hot).unionByName(mirror.select(F.col("b").alias("a"), F.col("a").alias("b"), "score"))
    return top_k(every, ["a"], [F.desc("score"), "b"], k)


def _pairs_of(few: DataFrame, table: DataFrame) -> DataFrame:
    """(a, b, score) of each of a few members with every member it shares a group with.

    A group of many rows is cut into blocks, and the rows of the few members go to each.
    """
    counts = table.groupBy("token").agg(F.ceil(F.count(F.lit(1)) / BIG_GROUP).cast("int").alias("_nb"))
    left = few.join(counts, "token").select(
        F.col("key").alias("a"),
        "token",
        *[F.col(v).alias(f"{v}_a") for v in _values(table)],
        F.explode(F.sequence(F.lit(0), F.col("_nb") - 1)).alias("_x"),
    )
    right = table.join(counts, "token").select(
        F.col("key").alias("b"),
        "token",
        *[F.col(v).alias(f"{v}_b") for v in _values(table)],
        F.pmod(F.xxhash64("key"), F.col("_nb")).cast("int").alias("_x"),
    )
    pairs = left.join(right, ["token", "_x"]).filter(F.col("a") != F.col("b"))
    return _positive_sums(pairs, table)


def item_based(
    df: DataFrame, sim_top: DataFrame, seeds: int, order: list[Column], remove_seen: bool = True
) -> DataFrame:
    """Neighbours of each user's first ``seeds`` items, summed scores.

    ``sim_top`` holds the neighbours already cut to the wanted number.
    """
    seed_rows = top_k(df, ["user_id"], order, seeds, "_r").select("user_id", F.col("item_id").alias("a"))
    scored = (
        seed_rows.join(sim_top.select("a", "b", "score"), "a")
        .groupBy("user_id", F.col("b").alias("item_id"))
        .agg(fx.tidy(F.sum("score"), DECIMALS).alias("score"))
    )
    return drop_seen(scored, df) if remove_seen else scored


def drop_seen(scored: DataFrame, seen: DataFrame) -> DataFrame:
    """Rows whose (user, item) is not in ``seen``."""
    return scored.join(seen.select("user_id", "item_id"), ["user_id", "item_id"], "left_anti")


def user_based(
    df: DataFrame,
    sim_top: DataFrame,
    per_neighbour: int,
    order: list[Column],
    remove_seen: bool = True,
) -> DataFrame:
    """First items of each user's neighbours; the best neighbour's score counts."""
    firsts = top_k(df, ["user_id"], order, per_neighbour, "_r").select(F.col("user_id").alias("b"), "item_id")
    scored = (
        sim_top.select(F.col("a").alias("user_id"), "b", "score")
        .join(firsts, "b")
        .groupBy("user_id", "item_id")
        .agg(F.max("score").alias("score"))
    )
    return drop_seen(scored, df) if remove_seen else scored


def _held_lists(df: DataFrame) -> DataFrame:
    """(user_id, items, nulls): the items of each user in lists of about LIST_LIMIT, rows without item counted."""
    sizes = degrees(df, "user_id", "_n").select(F.col("user_id").alias("_u"), F.ceil(F.col("_n") / LIST_LIMIT).alias("_parts"))
    parts = F.pmod(F.xxhash64("item_id"), F.col("_parts")).alias("_part")
    lists = df.join(sizes, F.col("user_id").eqNullSafe(F.col("_u"))).groupBy("user_id", parts).agg(
        F.sort_array(F.collect_list("item_id")).alias("items"), F.count_if(F.col("item_id").isNull()).cast("int").alias("nulls")
    )
    return lists.drop("_part")


def user_top_n(df: DataFrame, k: int, n: int) -> DataFrame:
    """User CF: sum of the similarities of the k nearest users who took the item, unseen only.

    A neighbour's items travel as lists and meet the user's own ones at the user: a row for every user, neighbour and
    item exists within a task only.
    """
    df = cut_lineage(df.select("user_id", "item_id"))
    near = most_similar(df, "item_id", "user_id", k)
    held = _held_lists(df)
    theirs = near.select(F.col("a").alias("user_id"), F.col("b").alias("_v"), "score").join(
        held.withColumnRenamed("user_id", "_v"), "_v"
    )
    own = held.select("user_id", F.lit(None).cast("double").alias("score"), "items", F.lit(0).alias("nulls"))
    lists = by_rows(theirs.drop("_v").unionByName(own), (k + 1) * df.count(), "user_id")
    nothing = F.array_repeat(F.lit(None).cast(df.schema["item_id"].dataType), F.col("nulls"))
    cells = lists.select("user_id", "score", F.explode(F.concat("items", nothing)).alias("item_id"))
    scored = cells.groupBy("user_id", "item_id").agg(
        fx.tidy(F.sum("score"), DECIMALS).alias("score"), F.count_if(F.col("score").isNull()).alias("_own")
    )
    unseen = scored.filter(F.col("_own") == 0).drop("_own")
    return top_k(unseen, ["user_id"], [F.desc("score"), "item_id"], n)


def item_top_n(df: DataFrame, k: int, n: int) -> DataFrame:
    """Item CF: sum over the user's items of the similarity to their k nearest items.

    The neighbours of an item travel to its users as one list, and meet the users' own items there. Where a user has
    too many items for a task, users' sums are made by item.
    """
    near = most_similar(df, "user_id", "item_id", k)
    largest, rows = group_sizes(df, ["user_id"])
    if largest * k > USER_CELLS:
        scored = (
            df.select("user_id", F.col("item_id").alias("a"))
            .join(near.select("a", F.col("b").alias("item_id"), "score"), "a")
            .groupBy("user_id", "item_id")
            .agg(fx.tidy(F.sum("score"), DECIMALS).alias("score"))
        )
        return top_k(drop_seen(scored, df), ["user_id"], [F.desc("score"), "item_id"], n)
    lists = near.groupBy("a").agg(F.collect_list(F.struct(F.col("b"), "score")).alias("_l"))
    lists = lists.select("a", F.col("_l.b").alias("items"), F.col("_l.score").alias("scores"))
    # the item itself stands last and has no score; a null user or item is never seen
    seen = F.when(F.col("user_id").isNotNull() & F.col("item_id").isNotNull(), F.array("item_id")).otherwise(F.slice(F.array("item_id"), 1, 0))
    met = df.select("user_id", "item_id").join(lists, F.col("item_id") == F.col("a"), "left").select(
        "user_id",
        F.concat(F.coalesce("items", F.slice(F.array("item_id"), 1, 0)), seen).alias("items"),
        F.coalesce("scores", F.array().cast("array<double>")).alias("scores"),
    )
    met = by_rows(met, (k + 1) * rows, "user_id")
    cells = met.select("user_id", "scores", F.posexplode("items").alias("_at", "item_id")).select(
        "user_id", "item_id", F.get("scores", F.col("_at")).alias("score")
    )
    scored = cells.groupBy("user_id", "item_id").agg(
        fx.tidy(F.sum("score"), DECIMALS).alias("score"), F.count_if(F.col("score").isNull()).alias("_own")
    )
    unseen = scored.filter(F.col("_own") == 0).drop("_own")
    return top_k(unseen, ["user_id"], [F.desc("score"), "item_id"], n)


def _pearson_tiles(df: DataFrame, members: int, rows: int) -> DataFrame:
    """(a, b, _r) of all pairs of members, a < b, that share a group, from (member, group, x): null where there is none.

    Blocks of members meet blocks of members, and the sums of a tile are final: what leaves a task is the result.
    """
    blocks = max(block_count(members, df.sparkSession.sparkContext.defaultParallelism), math.ceil(rows / BLOCK_ROWS))
    kind = df.schema["member"].dataType
    schema = T.StructType().add("a", kind).add("b", kind).add("_r", "double")

    def sums(table: pa.Table, groups: pd.Index) -> tuple[np.ndarray, list[np.ndarray], np.ndarray]:
        """Members in order; of their rows the number, sum, sum of squares and known ones; places by group."""
        frame = table.to_pandas()
        names, who = np.unique(frame["member"], return_inverse=True)
        at = groups.get_indexer(frame["group"])
        x = frame["x"].to_numpy(dtype=float)
        known, x = ~np.isnan(x), np.nan_to_num(x)
        order = np.argsort(at, kind="stable")
        order = order[at[order] >= 0]
        return names, [v[order] for v in (who, at, np.ones(len(x)), x, x * x, known.astype(float))], known.all()

    def run(met: Iterator[tuple[int, pa.Table, int, pa.Table]]) -> Iterator[pa.RecordBatch]:
        for block, asked, other, offered in met:
            both = np.intersect1d(asked.column("group").unique().to_pandas(), offered.column("group").unique().to_pandas())
            groups = pd.Index(both)
            us, left, sound = sums(asked, groups)
            vs, right, sound_v = sums(offered, groups)
            sound = sound and sound_v
            ends = [np.searchsorted(side[1], np.arange(0, len(groups) + RATER_ITEMS, RATER_ITEMS)) for side in (left, right)]
            later = np.arange(len(vs))[None, :]
            step = max(1, RATER_CELLS // len(vs))
            for lo in range(0, len(us), step):
                hi = min(lo + step, len(us))
                n, sx, sy, sxy, sxx, syy, pairs = (np.zeros((hi - lo, len(vs))) for _ in range(7))
                for part, first in enumerate(range(0, len(groups), RATER_ITEMS)):
                    width = min(RATER_ITEMS, len(groups) - first)

                    def dense(side: list[np.ndarray], at: slice, low: int, count: int) -> list[np.ndarray]:
                        who, group, *values = (v[at] for v in side)
                        mine = (who >= low) & (who < low + count)
                        cell = (who[mine] - low) * width + group[mine] - first
                        return [np.bincount(cell, v[mine], count * width).reshape(count, width) for v in values]

                    one, x, xx, known = dense(left, slice(*ends[0][part : part + 2]), lo, hi - lo)
                    one_v, y, yy, known_v = (m.T for m in dense(right, slice(*ends[1][part : part + 2]), 0, len(vs)))
                    n += one @ one_v
                    sx += x @ one_v
                    sy += one @ y
                    sxy += x @ y
                    sxx += xx @ one_v
                    syy += one @ yy
                    if not sound:
                        pairs += known @ known_v
                var = np.sqrt(np.maximum(n * sxx - sx * sx, 0.0) * np.maximum(n * syy - sy * sy, 0.0))
                real = (var > 0) & ((n if sound else pairs) > 0)
                if block == other:  # the same members on both sides, in order
                    real &= later > np.arange(lo, hi)[:, None]
                i, j = np.nonzero(real)
                r = (n[i, j] * sxy[i, j] - sx[i, j] * sy[i, j]) / var[i, j]
                a, b = us[lo + i], vs[j]
                swap = a > b
                a, b = np.where(swap, b, a), np.where(swap, a, b)
                kinds = asked.schema.field("member").type
                for at in range(0, len(a), PAIRS_SENT):
                    cells = slice(at, at + PAIRS_SENT)
                    yield pa.RecordBatch.from_arrays([pa.array(a[cells], kinds), pa.array(b[cells], kinds), pa.array(r[cells])], ["a", "b", "_r"])

    held = packed(df, "member", blocks)
    return meetings(held, held, (blocks, blocks), run, schema, once=True)


def _tiled_pearson(df: DataFrame, group: str, member: str, rating: str) -> DataFrame | None:
    """``pearson`` by tiles, None where a join is cheaper: few members, or few groups that two members share."""
    known = F.col(group).isNotNull() & F.col(member).isNotNull()
    df = df.filter(known).select(F.col(member).alias("member"), F.col(group).alias("group"), F.col(rating).cast("double").alias("x"))
    df = cut_lineage(df)
    whole = F.every(F.coalesce(F.abs("x") < F.lit(math.inf), F.lit(True)))
    rows, members, finite = df.agg(F.count(F.lit(1)), F.count_distinct("member"), whole).first()
    if members < TILED_MEMBERS or not finite:
        return None
    n = F.col("_n").cast("double")
    groups, pairs = degrees(df, "group", "_n").agg(F.count(F.lit(1)), F.sum(n * (n - 1) / 2)).first()
    largest = degrees(df, "member", "_n").agg(F.max("_n")).first()[0]
    if float(members) ** 2 * groups > DENSE_WORK * pairs or largest > MEMBER_ROWS:
        return None
    return _pearson_tiles(df, members, rows)


def pearson(df: DataFrame, group: str, member: str, rating: str = "rating", tile: int | None = None) -> DataFrame:
    """Pearson of the ratings two members gave to the same groups; a < b.

    Built from sums, so that constant ratings give no similarity and no error. Where most of many members share
    groups, a table of pairs would be larger than the result with its sums in tow; blocks of members then meet
    blocks of members.
    """
    found = _tiled_pearson(df, group, member, rating) if tile is None else None
    if found is not None:
        return found.select("a", "b", fx.tidy("_r", DECIMALS).alias("score"))
    x, y = F.col(f"{rating}_a"), F.col(f"{rating}_b")
    sums = pair_sums(
        df,
        group,
        member,
        {"_n": F.lit(1.0), "_x": x, "_y": y, "_xy": x * y, "_xx": x * x, "_yy": y * y},
        [rating],
        tile=tile,
    )
    c = {k: F.col(k) for k in ("_n", "_x", "_y", "_xy", "_xx", "_yy")}
    cov = c["_n"] * c["_xy"] - c["_x"] * c["_y"]
    var_x = c["_n"] * c["_xx"] - c["_x"] * c["_x"]
    var_y = c["_n"] * c["_yy"] - c["_y"] * c["_y"]
    r = F.try_divide(cov, F.sqrt(F.greatest(var_x, F.lit(0.0)) * F.greatest(var_y, F.lit(0.0))))
    return sums.select("a", "b", fx.tidy(r, DECIMALS).alias("score")).filter(F.col("score").isNotNull())


def predict_from_users(df: DataFrame, sim: DataFrame, targets: DataFrame, k: int) -> DataFrame:
    """Mean-centred rating of (user, item) targets from the k nearest raters of the item (I8)."""
    means = df.groupBy("user_id").agg(F.avg("rating").alias("mean"))
    both = mirrored(sim).select(F.col("a").alias("user_id"), F.col("b").alias("_v"), "score")
    raters = df.join(means, "user_id").select(
        F.col("user_id").alias("_v"), "item_id", (F.col("rating") - F.col("mean")).alias("_dev")
    )
    wanted = targets.select("user_id", "item_id").join(raters, "item_id").join(both, ["user_id", "_v"])
    best = top_k(wanted, ["user_id", "item_id"], [F.desc("score"), "_v"], k)
    return _centred(best, means, "user_id")


def _rater_tile(k: int):
    """Function of one tile: what a block of users wants and rated, what another rated, to the k nearest raters there."""

    def dense(codes: np.ndarray, items: np.ndarray, values: np.ndarray, shape: tuple[int, int]) -> np.ndarray:
        out = np.zeros(shape)
        out[codes, items] = values
        return out

    def tile(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        out = [pd.DataFrame({"user_id": [], "item_id": [], "_v": [], "score": []})]
        rated, wanted = left[~left["wanted"]], left[left["wanted"]]
        if not len(rated) or not len(wanted) or not len(right):
            return out[0]
        us, vs = np.unique(rated["user_id"]), np.unique(right["user_id"])
        items = pd.Index(np.unique(right["item_id"]))
        wanted = wanted[wanted["user_id"].isin(us) & wanted["item_id"].isin(items)]
        rated = rated[rated["item_id"].isin(items)]
        u, w, v = (np.searchsorted(x, y["user_id"]) for x, y in ((us, rated), (us, wanted), (vs, right)))
        ui, wi, vi = (items.get_indexer(y["item_id"]) for y in (rated, wanted, right))
        x, y = rated["rating"].to_numpy(dtype=float), right["rating"].to_numpy(dtype=float)
        twin = pd.Index(vs).get_indexer(us)
        order = np.argsort(vi, kind="stable")
        v, vi, y = v[order], vi[order], y[order]
        of_item = np.searchsorted(vi, np.arange(len(items) + 1))
        step = max(1, RATER_CELLS // len(vs))
        for lo in range(0, len(us), step):
            hi = min(lo + step, len(us))
            mine, asked = (u >= lo) & (u < hi), (w >= lo) & (w < hi)
            n, sx, sy, sxy, sxx, syy, both = (np.zeros((hi - lo, len(vs))) for _ in range(7))
            for first in range(0, len(items), RATER_ITEMS):
                width = min(RATER_ITEMS, len(items) - first)
                a = mine & (ui >= first) & (ui < first + width)
                b = slice(of_item[first], of_item[first + width])
                left_at = (u[a] - lo, ui[a] - first)
                right_at = (v[b], vi[b] - first)
                value, other = np.nan_to_num(x[a]), np.nan_to_num(y[b])
                one, rate, known = (dense(*left_at, z, (hi - lo, width)) for z in (1.0, value, ~np.isnan(x[a])))
                one_v, rate_v, known_v = (dense(*right_at, z, (len(vs), width)).T for z in (1.0, other, ~np.isnan(y[b])))
                n += one @ one_v
                sx += rate @ one_v
                sy += one @ rate_v
                sxy += rate @ rate_v
                sxx += (rate * rate) @ one_v
                syy += one @ (rate_v * rate_v)
                both += known @ known_v
            var = np.sqrt(np.maximum(n * sxx - sx * sx, 0.0) * np.maximum(n * syy - sy * sy, 0.0))
            r = np.divide(n * sxy - sx * sy, var, out=np.full(n.shape, -np.inf), where=(var > 0) & (both > 0))
            self_at = np.flatnonzero(twin[lo:hi] >= 0)
            r[self_at, twin[lo:hi][self_at]] = -np.inf
            who, what = w[asked] - lo, wi[asked]
            by = np.argsort(what, kind="stable")
            who, what = who[by], what[by]
            start = np.searchsorted(what, np.arange(len(items) + 1))
            for i in np.unique(what):
                asking = who[start[i] : start[i + 1]]
                raters = np.sort(v[of_item[i] : of_item[i + 1]])
                rows, cols, score = _best_of_all(r[np.ix_(asking, raters)], k, None)
                out.append(
                    pd.DataFrame({"user_id": us[lo + asking[rows]], "item_id": items[i], "_v": vs[raters[cols]], "score": score})
                )
        return pd.concat(out[1:]) if len(out) > 1 else out[0]

    return tile


def nearest_raters(df: DataFrame, targets: DataFrame, k: int) -> DataFrame:
    """(user_id, item_id, _v, score): of each target the k users nearest by ``pearson`` who rated the item (I8).

    Blocks of users meet blocks of users; the similarities of a tile are final, serve all items there, and only k
    raters of each target leave it. No row per pair of users exists, nor one per pair of raters of an item.
    """
    known = F.col("user_id").isNotNull() & F.col("item_id").isNotNull()
    df = cut_lineage(df.filter(known).select("user_id", "item_id", F.col("rating").cast("double").alias("rating")))
    users, rows = df.agg(F.count_distinct("user_id"), F.count(F.lit(1))).first()
    n = max(block_count(users, df.sparkSession.sparkContext.defaultParallelism), math.ceil(rows / BLOCK_ROWS))
    block, every = F.pmod(F.xxhash64("user_id"), F.lit(n)).cast("int"), F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    asked = targets.filter(known).select("user_id", "item_id", F.lit(None).cast("double").alias("rating"), F.lit(True).alias("wanted"))
    left = df.withColumn("wanted", F.lit(False)).unionByName(asked).select("*", block.alias("_q"), every.alias("_c"))
    right = df.select("*", every.alias("_q"), block.alias("_c"))
    tile = ["_q", "_c"]
    kinds = {c: df.schema[c].dataType for c in ("user_id", "item_id")}
    schema = T.StructType().add("user_id", kinds["user_id"]).add("item_id", kinds["item_id"])
    schema = schema.add("_v", kinds["user_id"]).add("score", "double")
    met = by_tile(left, tile, n * n).groupBy(*tile).cogroup(by_tile(right, tile, n * n).groupBy(*tile))
    return top_k(met.applyInPandas(_rater_tile(k), schema), ["user_id", "item_id"], [F.desc("score"), "_v"], k)


def predict_from_raters(df: DataFrame, near: DataFrame) -> DataFrame:
    """The prediction of ``predict_from_users`` from the raters that ``nearest_raters`` found."""
    means = df.groupBy("user_id").agg(F.avg("rating").alias("mean"))
    raters = df.join(means, "user_id").select(
        F.col("user_id").alias("_v"), "item_id", (F.col("rating") - F.col("mean")).alias("_dev")
    )
    return _centred(near.join(raters, ["_v", "item_id"]), means, "user_id")


def predict_from_items(df: DataFrame, sim: DataFrame, targets: DataFrame, k: int) -> DataFrame:
    """Mean-centred rating of (user, item) targets from the k nearest items the user rated."""
    means = df.groupBy("item_id").agg(F.avg("rating").alias("mean"))
    both = mirrored(sim).select(F.col("a").alias("item_id"), F.col("b").alias("_v"), "score")
    rated = df.join(means, "item_id").select(
        "user_id", F.col("item_id").alias("_v"), (F.col("rating") - F.col("mean")).alias("_dev")
    )
    wanted = targets.select("user_id", "item_id").join(rated, "user_id").join(both, ["item_id", "_v"])
    best = top_k(wanted, ["user_id", "item_id"], [F.desc("score"), "_v"], k)
    return _centred(best, means, "item_id")


def _centred(best: DataFrame, means: DataFrame, key: str) -> DataFrame:
    sums = best.groupBy("user_id", "item_id").agg(
        F.sum(F.col("score") * F.col("_dev")).alias("_num"), F.sum("score").alias("_den")
    )
    shift = F.try_divide(F.col("_num"), fx.tidy("_den", DECIMALS))
    return sums.join(means, key).select(
        "user_id", "item_id", fx.tidy(F.col("mean") + shift, 5).alias("prediction")
    )


def swing(df: DataFrame, alpha: float = 0.5, tile: int | None = None) -> DataFrame:
    """Swing score of item pairs, a < b.

    Two items taken by the same two users gain 1/(alpha + items both users took).
    Users are paired through their common items first; a pair with one common
    item holds no item pair and leaves before the second join.
    """
    user_pairs = shared_pairs(df, "item_id", "user_id", tile=tile).select(
        F.col("a").alias("u"), F.col("b").alias("v"), "item_id"
    )
    overlap = user_pairs.groupBy("u", "v").agg(F.count(F.lit(1)).alias("_c")).filter(F.col("_c") >= 2)
    common = user_pairs.join(overlap, ["u", "v"]).select(
        F.struct("u", "v").alias("_uv"), "item_id", "_c", (F.lit(1.0) / (F.lit(alpha) + F.col("_c"))).alias("_w")
    )
    sums = pair_sums(common, "_uv", "item_id", {"_s": F.col("_w_a")}, ["_w"], size="_c", tile=tile)
    return sums.select("a", "b", fx.tidy(F.col("_s"), DECIMALS).alias("score"))


def jaccard(df: DataFrame, group: str = "user_id", member: str = "item_id", tile: int | None = None) -> DataFrame:
    """Shared groups / groups of either, a < b (item similarity of I11)."""
    pairs = shared_pairs(df.join(degrees(df, member, "_n"), member), group, member, ["_n"], tile=tile)
    both = F.count(F.lit(1))
    either = F.max("_n_a") + F.max("_n_b") - both
    return pairs.groupBy("a", "b").agg((both / either).alias("score"))


def affinity(events: DataFrame, weight: Column, half_life_days: float = 30.0) -> DataFrame:
    """Sum per (user, item) of weight x 2^(-(latest - ts) / half life)."""
    age_days = (F.col("_latest") - F.col("ts")) / F.lit(float(fx.DAY_SECONDS))
    decayed = weight * F.pow(F.lit(2.0), -age_days / F.lit(half_life_days))
    return (
        events.withColumn("_latest", events.agg(F.max("ts")).scalar())
        .groupBy("user_id", "item_id")
        .agg(F.sum(decayed).alias("affinity"))
    )


def sar(
    events: DataFrame, weight: Column, k: int = 10, half_life_days: float = 30.0, normalise: bool = True
) -> DataFrame:
    """Jaccard item similarity x decayed affinity, seen items removed, top k.

    An item is similar to itself with 1. ``normalise`` rescales a user's scores
    to the range of the weights: the ends are the least and the greatest score
    the user could get if every affinity were the smallest or the largest weight.
    """
    taken = affinity(events, weight, half_life_days)
    scale = events.groupBy("item_id").agg(F.min(weight).alias("lo"), F.max(weight).alias("hi"))
    scale = scale.agg(
        F.struct(
            F.min("lo").cast("double").alias("lo"), F.max("hi").cast("double").alias("hi"), F.count(F.lit(1)).alias("n")
        )
    ).scalar()
    own = taken.select(F.col("item_id").alias("a")).distinct()
    sims = mirrored(jaccard(taken)).unionByName(own.select("a", F.col("a").alias("b"), F.lit(1.0).alias("score")))
    sims = cut_lineage(sims)
    few, kept = sims.count(), taken.select("user_id", F.col("item_id").alias("a"), "affinity")
    if few <= FEW_SIMILARITIES:
        # every task gets the table, and a user's sums are final where the user's rows are
        sims = F.broadcast(sims)
        kept = by_rows(kept, taken.count() * few / max(1, own.count()), "user_id")
    # a user took an item that is reached from itself; rows without user are never seen
    met = F.coalesce(F.max((F.col("a") == F.col("b")) & F.col("user_id").isNotNull()), F.lit(False))
    raw = kept.join(sims, "a").groupBy("user_id", F.col("b").alias("item_id")).agg(
        F.sum(F.col("affinity") * F.col("score")).alias("_raw"), F.sum("score").alias("_unit"), met.alias("_seen")
    )
    if normalise:
        per_user = Window.partitionBy("user_id")
        raw = raw.withColumns({
            "_n": F.count(F.lit(1)).over(per_user), "_mn": F.min("_unit").over(per_user), "_mx": F.max("_unit").over(per_user),
        }).filter(F.col("user_id").isNotNull())
        raw = raw.withColumn("_s", scale)
        low, high = F.col("_s.lo"), F.col("_s.hi")
        start = F.when(F.col("_n") < F.col("_s.n"), F.lit(0.0)).otherwise(F.col("_mn")) * low
        place = F.try_divide(F.col("_raw") - start, F.col("_mx") * high - start)
        raw = raw.withColumn("_raw", low + (high - low) * place)
    scored = raw.filter(~F.col("_seen")).select("user_id", "item_id", fx.tidy(F.col("_raw"), DECIMALS).alias("score"))
    return top_k(scored, ["user_id"], [F.desc("score"), "item_id"], k)


def rating_vector_neighbours(df: DataFrame, k: int = 6) -> DataFrame:
    """k nearest items by cosine distance of rating vectors, the item itself included."""
    near = most_similar(df, "user_id", "item_id", k, rating="rating")
    near = near.select("a", "b", fx.tidy(F.lit(1.0) - F.col("score"), DECIMALS).alias("distance"))
    ids = df.select("item_id").distinct()
    own = ids.select(F.col("item_id").alias("a"), F.col("item_id").alias("b"), F.lit(0.0).alias("distance"))
    return top_k(near.unionByName(own), ["a"], ["distance", "b"], k)


def share_of_group(df: DataFrame, group: str, value: str, name: str = "share") -> DataFrame:
    """value / group total, 3 decimals; 0 when the total is 0 (E9). For groups already cut to a top-k."""
    total = F.sum(value).over(Window.partitionBy(group))
    share = F.when(total == 0, F.lit(0.0)).otherwise(F.try_divide(F.col(value), total))
    return df.withColumn(name, fx.half_even(share, 3))
