"""Mixing sources to target weights by min-cost flow over membership patterns.

Documents are summed by the set of sources they belong to (their pattern). Tokens flow from patterns, each usable
``max_repeats`` times at a cost that rises with every repetition, to the sources' quotas; the cheapest flow that fills
the quotas best says how many tokens of each pattern serve each source. Documents are then taken in the order of a
seeded hash until a pattern's flow is reached. Only sums per pattern reach the driver.
"""

from __future__ import annotations

import heapq
import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import word_count, written

#: Bits of the seeded order, and bits that one round of counting resolves.
ORDER_BITS, ROUND_BITS = 60, 10


class Flow:
    """Successive cheapest paths with potentials over an integer network."""

    def __init__(self, nodes: int):
        self.out: list[list[int]] = [[] for _ in range(nodes)]
        self.to: list[int] = []
        self.room: list[int] = []
        self.cost: list[int] = []

    def edge(self, a: int, b: int, room: int, cost: int = 0) -> int:
        for x, y, r, c in ((a, b, room, cost), (b, a, 0, -cost)):
            self.out[x].append(len(self.to))
            self.to.append(y)
            self.room.append(r)
            self.cost.append(c)
        return len(self.to) - 2

    def used(self, edge: int) -> int:
        return self.room[edge + 1]

    def run(self, source: int, sink: int) -> None:
        height = [0] * len(self.out)
        while True:
            far: list[float] = [float("inf")] * len(self.out)
            came = [-1] * len(self.out)
            far[source], queue = 0, [(0, source)]
            while queue:
                d, a = heapq.heappop(queue)
                if d > far[a]:
                    continue
                for e in self.out[a]:
                    b = self.to[e]
                    if self.room[e] and (n := d + self.cost[e] + height[a] - height[b]) < far[b]:
                        far[b], came[b] = n, e
                        heapq.heappush(queue, (n, b))
            if came[sink] < 0:
                return
            height = [h + (d if d < float("inf") else 0) for h, d in zip(height, far, strict=True)]
            path, b = [], sink
            while b != source:
                path.append(came[b])
                b = self.to[came[b] ^ 1]
            push = min(self.room[e] for e in path)
            for e in path:
                self.room[e] -= push
                self.room[e ^ 1] += push


def route(sizes: dict[str, int], quotas: dict, max_repeats: int) -> dict[str, list[tuple[object, int]]]:
    """Tokens from each pattern (JSON list of sources) to its sources, in the order of the pattern's list."""
    patterns, sources = sorted(sizes), list(quotas)
    place = {s: 1 + len(patterns) + i for i, s in enumerate(sources)}
    sink = 1 + len(patterns) + len(sources)
    flow = Flow(sink + 1)
    kept: dict[str, list[tuple[object, int]]] = {}
    for i, p in enumerate(patterns, 1):
        for repeat in range(max_repeats):
            flow.edge(0, i, sizes[p], repeat * repeat)  # convex: each further repetition costs more
        kept[p] = [(s, flow.edge(i, place[s], sizes[p] * max_repeats)) for s in json.loads(p) if s in place]
    for s in sources:
        flow.edge(place[s], sink, quotas[s])
    flow.run(0, sink)
    return {p: [(s, flow.used(e)) for s, e in edges] for p, edges in kept.items()}


def hash_bounds(rows: DataFrame, wanted: DataFrame) -> DataFrame:
    """The last hash of each wanted prefix.

    ``rows``: pattern, h, size. ``wanted``: pattern, part, rest. Documents in the order of h, those of one h together,
    belong to the prefix while that brings its sum nearer to ``rest``. Rounds of bucket counts narrow the place down,
    so that no task sorts a pattern; result: pattern, part, bound (-1 for an empty prefix).
    """
    found = written(wanted.select("pattern", "part", "rest", F.lit(0).cast("long").alias("head")), "mix-wanted")
    shift = ORDER_BITS
    for turn in range(2):
        shift -= ROUND_BITS
        if turn:
            heads = found.select(F.col("pattern").alias("p"), F.col("head").alias("hd")).distinct()
            inside = rows.join(
                heads, (rows["pattern"] == heads["p"]) & (F.shiftright("h", shift + ROUND_BITS) == heads["hd"])
            )
        else:  # every row lies below head 0; counted without a join, which would gather a hot pattern
            inside = rows.withColumn("hd", F.lit(0).cast("long"))
        sums = inside.groupBy("pattern", "hd", F.shiftright("h", shift).alias("bucket")).agg(F.sum("size").alias("s"))
        running = sums.withColumn(
            "upto", F.sum("s").over(Window.partitionBy("pattern", "hd").orderBy("bucket"))
        ).select(F.col("pattern").alias("p"), "hd", "bucket", "s", "upto")
        step = found.join(running, (F.col("pattern") == F.col("p")) & (F.col("head") == F.col("hd")), "left")
        narrowed = step.groupBy("pattern", "part", "rest").agg(
            F.min(F.when(F.col("upto") > F.col("rest"), F.struct("bucket", (F.col("upto") - F.col("s")).alias("b")))).alias("hit"),
            F.max(F.struct("bucket", (F.col("upto") - F.col("s")).alias("b"))).alias("last"),
        )
        at = F.coalesce("hit", "last")
        found = narrowed.select(
            "pattern",
            "part",
            (F.col("rest") - F.coalesce(at["b"], F.lit(0))).alias("rest"),
            F.coalesce(at["bucket"], F.lit(0)).alias("head"),
        )
        found = written(found, "mix-heads")
    heads = found.select(F.col("pattern").alias("p"), F.col("head").alias("hd")).distinct()
    inside = rows.join(heads, (rows["pattern"] == heads["p"]) & (F.shiftright("h", shift) == heads["hd"]))
    each = inside.groupBy("pattern", "hd", "h").agg(F.sum("size").alias("s"))
    ordered = each.withColumn("upto", F.sum("s").over(Window.partitionBy("pattern", "hd").orderBy("h"))).select(
        F.col("pattern").alias("p"), "hd", "h", "s", "upto"
    )
    step = found.join(ordered, (F.col("pattern") == F.col("p")) & (F.col("head") == F.col("hd")), "left")
    inside_prefix = 2 * F.col("upto") - F.col("s") <= 2 * F.col("rest")  # nearer with it than without
    first = F.shiftleft(F.col("head"), shift) - 1  # everything before the bucket
    return step.groupBy("pattern", "part", "head").agg(F.max(F.when(inside_prefix, F.col("h"))).alias("h")).select(
        "pattern", "part", F.coalesce("h", first).alias("bound")
    )


def mix(
    docs: DataFrame, quotas: dict, seed: int = 0, max_repeats: int = 3, key: str = "doc_id", size: str = "size",
    sources: str = "sources", also: tuple[str, ...] = (),
) -> DataFrame:
    """doc_id, size, the columns ``also``, copies, taken (words over all copies) and ``serves`` (source of each copy).

    ``sources`` is the array of sources of a document (an entry may be null), ``quotas`` tokens per source. Rows of
    one id and size are taken alike, so repeated rows get the same answer. Documents of no source, and of size 0, are
    not taken; an empty table gives an empty result.
    """
    pattern, h = _pattern(F.col(sources)), _order(F.col(key), seed)
    rows = docs.select(
        F.col(key).alias("doc_id"), F.col(size).cast("long").alias("size"), *also, pattern.alias("pattern"), h.alias("h")
    )
    rows = written(rows, "mix-rows")
    return _taken(rows, _ends(rows, quotas, max_repeats)).select("doc_id", "size", *also, "copies", "taken", "serves")


def _pattern(sources: Column) -> Column:
    """The set of sources as JSON."""
    return F.to_json(F.sort_array(F.array_distinct(sources)), {"ignoreNullFields": "false"})


def _order(key: Column, seed: int) -> Column:
    """Place of an id in the seeded order."""
    digest = F.md5(F.concat_ws(":", F.lit(str(seed)), F.coalesce(key.cast("string"), F.lit("null"))))
    return F.conv(F.substring(digest, 1, ORDER_BITS // 4), 16, 10).cast("long")


def _ends(rows: DataFrame, quotas: dict, max_repeats: int) -> DataFrame:
    """(p, ends): for each pattern where the parts that serve its sources end; one row per pattern."""
    # one row per set of sources
    sizes = {r["pattern"]: r["s"] for r in rows.where("pattern is not null").groupBy("pattern").agg(F.sum("size").alias("s")).collect()}
    parts, wanted = [], []
    for pattern, flows in route(sizes, quotas, max_repeats).items():
        at, whole = 0, sizes[pattern]
        for part, (source, n) in enumerate(flows):
            if n:
                at += n
                epoch, rest = divmod(at, whole)
                parts.append((pattern, part, source, epoch))
                wanted.append((pattern, part, rest))
    spark = rows.sparkSession
    bounds = hash_bounds(
        rows.select("pattern", "h", "size"), spark.createDataFrame(wanted, "pattern string, part int, rest long")
    )
    part_rows = spark.createDataFrame(parts, "pattern string, part int, source string, epoch int")
    ends = part_rows.join(bounds, ["pattern", "part"]).groupBy("pattern").agg(
        F.sort_array(F.collect_list(F.struct("part", "epoch", "bound", "source"))).alias("ends")
    )
    return written(ends, "mix-ends").select(F.col("pattern").alias("p"), "ends")


def _taken(rows: DataFrame, ends: DataFrame) -> DataFrame:
    """The rows (with pattern, h and size) with copies, taken and serves.

    ``ends`` has a row per pattern; the driver has routed these, so they are few enough to broadcast.
    """
    joined = rows.join(F.broadcast(ends), F.col("pattern") == F.col("p"), "left")
    # copies of a document that lie before the end of each part
    upto = F.transform(
        "ends", lambda e: e["epoch"] + F.when(F.col("h") <= e["bound"], F.lit(1)).otherwise(F.lit(0))
    )
    joined = joined.withColumn("upto", F.when(F.col("size") > 0, upto))
    copies = F.coalesce(F.element_at("upto", -1), F.lit(0))
    serves = F.flatten(
        F.transform(
            "ends",
            lambda e, i: F.array_repeat(
                e["source"], F.get("upto", i) - F.when(i == 0, F.lit(0)).otherwise(F.get("upto", i - 1))
            ),
        )
    )
    return joined.select(
        *rows.columns,
        copies.alias("copies"),
        (F.col("size") * copies).alias("taken"),
        F.when(copies > 0, serves).otherwise(F.array().cast("array<string>")).alias("serves"),
    )


def water_fill(sizes: dict, weights: dict, total: int, most: int = 3) -> dict:
    """Targets proportional to weights that stop at ``most`` times a source's size; what is cut goes to the others by
    weight. Sources that fill first are those with the least size per weight."""
    order = sorted(sizes, key=lambda s: most * sizes[s] / weights[s])
    rest, weight, out = total, sum(weights.values()), {}
    for s in order:
        if most * sizes[s] * weight <= weights[s] * rest:
            out[s] = float(most * sizes[s])
            rest -= most * sizes[s]
            weight -= weights[s]
        else:
            break
    for s in order:
        if s not in out:
            out[s] = float(weights[s] * rest) / float(weight)
    return out


def contract_targets(sizes: dict) -> dict:
    """Sources by code point, null last, weigh 1, 2, 3, 1, ...; they share all words of the table."""
    names = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    weights = {s: 1 + i % 3 for i, s in enumerate(names)}
    return water_fill(sizes, weights, sum(sizes.values()))


def mixed_documents(docs: DataFrame, seed: int = 42, max_repeats: int = 3) -> tuple[DataFrame, dict, dict]:
    """(result of ``mix`` with the source column, words by source, target by source) for a table of documents."""
    measured = written(
        docs.select("doc_id", "source", word_count(F.col("text")).alias("size"), F.array("source").alias("sources")),
        "mix-sizes",
    )
    sizes = {r["source"]: r["s"] for r in measured.groupBy("source").agg(F.sum("size").alias("s")).collect()}
    targets = contract_targets(sizes)
    quotas = {s: round(t) for s, t in targets.items()}
    return mix(measured, quotas, seed, max_repeats, also=("source",)), sizes, targets


def repeated_documents(docs: DataFrame, seed: int = 42, max_repeats: int = 3) -> DataFrame:
    """The rows, each as often as the mix takes it; columns stay as they are. Texts don't move.

    Null and repeated ids are rows like any other; rows of one id and source are taken alike.
    """
    size, pattern, h = word_count(F.col("text")), _pattern(F.array("source")), _order(F.col("doc_id"), seed)
    measured = written(
        docs.select("source", size.alias("size"), pattern.alias("pattern"), h.alias("h")), "mix-sizes"
    )
    sizes = {r["source"]: r["s"] for r in measured.groupBy("source").agg(F.sum("size").alias("s")).collect()}
    quotas = {s: round(t) for s, t in contract_targets(sizes).items()}
    ends = _ends(measured, quotas, max_repeats)
    names = docs.columns
    row = F.struct(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(names)]).alias("row_")
    rows = docs.select(row, size.alias("size"), pattern.alias("pattern"), h.alias("h"))
    each = _taken(rows, ends).where("copies > 0").select("row_", F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("copy"))
    return each.select(*[F.col("row_")[f"c{i}"].alias(c) for i, c in enumerate(names)])


def query(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "source", "text")
    mixed, sizes, targets = mixed_documents(docs)
    known = spark.createDataFrame(
        [(s, sizes[s], targets[s]) for s in sizes], "k_source string, source_size long, target double"
    )
    return mixed.join(F.broadcast(known), F.col("source").eqNullSafe(F.col("k_source"))).select(
        "doc_id", "size", "source_size", "target", "taken", "copies"
    )


ORACLE = r"""
with d as (
  select doc_id, source,
         cast(case when trim(coalesce(text, ''), E' \t\n\x0b\f\r') = '' then 0
              else len(string_split_regex(trim(text, E' \t\n\x0b\f\r'), '[\x20\x09-\x0D]+')) end as bigint) as size,
         cast('0x' || substr(md5('42:' || coalesce(cast(doc_id as varchar), 'null')), 1, 15) as bigint) as h
  from documents
), s as (
  select source, cast(sum(size) as bigint) as source_size,
         1 + (row_number() over (order by source nulls last) - 1) % 3 as w
  from d group by source
), o as (
  select *, 3 * source_size as lid, row_number() over (order by 3.0 * source_size / w, source) as k from s
), c as (
  select *, coalesce(sum(lid) over (order by k rows between unbounded preceding and 1 preceding), 0) as lids,
         sum(w) over () - coalesce(sum(w) over (order by k rows between unbounded preceding and 1 preceding), 0) as wleft,
         sum(source_size) over () as total
  from o
), g as (
  select *, lid * wleft <= w * (total - lids) as fits from c
), u as (
  select coalesce(min(k), 1000000000) as stop from g where not fits
), l as (
  select cast((select total from g where k = stop) - (select lids from g where k = stop) as double) as rest,
         cast((select wleft from g where k = stop) as double) as wrest, stop from u
), t as (
  select source, source_size,
         case when k < stop then cast(lid as double) else cast(w as double) * rest / wrest end as target
  from g, l
), q as (
  select *, cast(round_even(target, 0) as bigint) as quota from t
), e as (
  select *, case when source_size > 0 then quota // source_size else 0 end as epoch,
         case when source_size > 0 then quota % source_size else 0 end as rest from q
), r as (
  select source, h, sum(size) as s from d group by source, h
), p as (
  select source, h, s, sum(s) over (partition by source order by h) as upto from r
), b as (
  select e.source, max(p.h) as bound from e join p on e.source is not distinct from p.source
  where 2 * p.upto - p.s <= 2 * e.rest group by e.source
)
select d.doc_id, d.size, e.source_size, e.target,
       cast(d.size * (e.epoch + case when d.h <= coalesce(b.bound, -1) then 1 else 0 end) as bigint) as taken,
       cast(case when d.size > 0 then e.epoch + case when d.h <= coalesce(b.bound, -1) then 1 else 0 end else 0 end as int) as copies
from d join e on d.source is not distinct from e.source
left join b on b.source is not distinct from d.source
"""
