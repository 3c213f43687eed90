"""Sharding: best-fit-decreasing packing of indivisible groups.

Groups of rows (here: equal texts) never part. Groups larger than a small share of a shard are packed one by one; the
many smaller ones are first hashed into bundles about that size, so what the driver packs is bounded by the number of
shards, whatever the number of groups. Items enter, largest first, the bin with the tightest remaining capacity that
still holds them, found in a balanced tree. For a fixed number of shards the least capacity that needs no more bins
is searched.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import written

#: Items a full shard holds at least; the driver packs at most twice this many items per shard.
GRAIN = 256
#: Rows that one task numbers at once.
RUN_ROWS = 20_000


class FreeTree:
    """Balanced (AA) tree of keys; finds the least key that is not below a bound."""

    __slots__ = ("root",)

    class _Node:
        __slots__ = ("key", "left", "level", "right")

        def __init__(self, key):
            self.key, self.level, self.left, self.right = key, 1, None, None

    def __init__(self):
        self.root = None

    @staticmethod
    def _skew(t):
        if t is not None and t.left is not None and t.left.level == t.level:
            up = t.left
            t.left, up.right = up.right, t
            return up
        return t

    @staticmethod
    def _split(t):
        if t is not None and t.right is not None and t.right.right is not None and t.right.right.level == t.level:
            up = t.right
            t.right, up.left = up.left, t
            up.level += 1
            return up
        return t

    def add(self, key):
        def put(t):
            if t is None:
                return FreeTree._Node(key)
            if key < t.key:
                t.left = put(t.left)
            else:
                t.right = put(t.right)
            return self._split(self._skew(t))

        self.root = put(self.root)

    def remove(self, key):
        def cut(t, k):
            if t is None:
                return None
            if k < t.key:
                t.left = cut(t.left, k)
            elif k > t.key:
                t.right = cut(t.right, k)
            elif t.left is None and t.right is None:
                return None
            else:
                side = t.right or t.left
                while (side.left if t.right else side.right) is not None:
                    side = side.left if t.right else side.right
                key = side.key  # the removal below may move keys
                if t.right:
                    t.right = cut(t.right, key)
                else:
                    t.left = cut(t.left, key)
                t.key = key
            low = min(t.left.level if t.left else 0, t.right.level if t.right else 0) + 1
            if low < t.level:
                t.level = low
                if t.right and t.right.level > low:
                    t.right.level = low
            t = self._skew(t)
            t.right = self._skew(t.right)
            if t.right:
                t.right.right = self._skew(t.right.right)
            t = self._split(t)
            t.right = self._split(t.right)
            return t

        self.root = cut(self.root, key)

    def least_from(self, bound):
        t, best = self.root, None
        while t is not None:
            if t.key >= bound:
                best, t = t.key, t.left
            else:
                t = t.right
        return best


def best_fit_decreasing(items: list[tuple[int, object]], capacity: int) -> list[list[object]]:
    """Bins of item names. An item larger than the capacity gets a bin of its own."""
    free, bins = FreeTree(), []
    for size, name in sorted(items, key=lambda x: (-x[0], str(x[1]))):
        found = free.least_from((size, -1))
        if found is None:
            found = (max(capacity, size), len(bins))
            bins.append([])
        else:
            free.remove(found)
        bins[found[1]].append(name)
        free.add((found[0] - size, found[1]))
    return bins


def pack_into(items: list[tuple[int, object]], shards: int) -> list[list[object]]:
    """At most ``shards`` bins of the least capacity for which best-fit-decreasing needs no more."""
    total = sum(s for s, _ in items)
    low, high = -(-total // shards), max(total, 1)
    step = max(1, total // (shards * GRAIN * 64))
    best = best_fit_decreasing(items, high)
    while low <= high:
        capacity = (low + high) // 2
        bins = best_fit_decreasing(items, capacity)
        if len(bins) <= shards:
            best, high = bins, capacity - step
        else:
            low = capacity + step
    return best


def assign(rows: DataFrame, group: str, size: str, shards: int | None = None, capacity: int | None = None) -> DataFrame:
    """The rows with column ``shard``: rows of equal ``group`` stay together.

    Give ``shards`` (sizes near equal) or ``capacity`` (as few shards as best fit needs). ``group`` is not null.
    """
    groups = rows.groupBy(group).agg(F.sum(size).alias("group_size"))
    groups = written(groups, "groups")
    total = groups.agg(F.sum("group_size")).first()[0] or 0
    bins = shards or max(1, -(-total // capacity))
    grain = max(1, total // (bins * GRAIN))
    bundle = F.when(F.col("group_size") < grain, F.pmod(F.xxhash64(group), F.lit(bins * GRAIN)))
    small = groups.where(F.col("group_size") < grain).groupBy(bundle.alias("bundle")).agg(F.sum("group_size").alias("s"))
    large = groups.where(F.col("group_size") >= grain).select(F.col(group).alias("name"), "group_size")
    # at most bins * GRAIN rows each, by the choice of the grain
    items = [(int(r["s"]), ("b", int(r["bundle"]))) for r in small.collect()]
    items += [(int(r["group_size"]), ("g", r["name"])) for r in large.collect()]
    packed = pack_into(items, shards) if shards else best_fit_decreasing(items, capacity)
    places = [(kind, name, n) for n, names in enumerate(packed) for kind, name in names]
    spark = rows.sparkSession
    kinds = dict(rows.dtypes)
    of_bundle = spark.createDataFrame([(m, n) for k, m, n in places if k == "b"], "b_bundle long, b_shard int")
    of_group = spark.createDataFrame([(m, n) for k, m, n in places if k == "g"], f"g_name {kinds[group]}, g_shard int")
    placed = rows.join(F.broadcast(of_group), F.col(group) == F.col("g_name"), "left").join(
        F.broadcast(of_bundle), F.pmod(F.xxhash64(group), F.lit(bins * GRAIN)) == F.col("b_bundle"), "left"
    )
    return placed.select(*rows.columns, F.coalesce("g_shard", "b_shard").alias("shard"))


def number(rows: DataFrame, shard: str, order: list[Column], slot: str = "slot") -> DataFrame:
    """The rows with gapless numbers from 0 within each shard.

    Rows are hashed into runs of bounded length by what orders them; runs are numbered by themselves and get the
    count of the runs before. Rows equal in ``order`` may swap numbers.
    """
    n = rows.count()
    runs = max(8, -(-n // RUN_ROWS))
    rows = rows.withColumn("run_", F.pmod(F.xxhash64(*order), F.lit(runs)))
    counts = rows.groupBy(shard, "run_").agg(F.count("*").alias("run_rows_"))
    before = Window.partitionBy(shard).orderBy("run_").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(
        F.col(shard).alias("o_shard_"), F.col("run_").alias("o_run_"), F.coalesce(F.sum("run_rows_").over(before), F.lit(0)).alias("from_")
    )
    within = F.row_number().over(Window.partitionBy(shard, "run_").orderBy(*order)) - 1
    numbered = rows.withColumn("at_", within)
    joined = numbered.join(offsets, (F.col(shard) == F.col("o_shard_")) & (F.col("run_") == F.col("o_run_")))
    return joined.withColumn(slot, (F.col("from_") + F.col("at_")).cast("long")).drop(
        "run_", "at_", "from_", "o_shard_", "o_run_"
    )


def shard_texts(docs: DataFrame, shards: int, key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, size, text_crc32, shard, slot: sizes near equal, equal texts in one shard.

    Size is the UTF-8 length plus 8. A null text counts as empty and shares the group of empty texts. A group larger
    than an even share makes its shard that much larger. Null and repeated ids are rows like any other; an empty
    table gives an empty result.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    rows = written(
        docs.select(
            F.col(key).alias("doc_id"),
            (F.octet_length(body) + 8).cast("long").alias("size"),
            F.crc32(body).alias("text_crc32"),
            F.md5(body).alias("text_group"),
        ),
        "shard-rows",
    )
    placed = assign(rows, "text_group", "size", shards=shards)
    return number(placed, "shard", [F.col("doc_id"), F.col("text_crc32"), F.col("size")]).drop("text_group")


SHARDS = 24


def query(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return shard_texts(docs, SHARDS).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        F.col("shard").cast("int"),
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )
