"""Near-duplicate vectors by cosine: PCA-ordered tiles, suffix bounds, no pair of a group ever leaves its task.

Equal vectors are one node. Unit vectors are turned so that their leading coordinates hold most of the product; nodes
are cut into tiles along the first two, and a pair of tiles whose boxes are too far apart in the leading coordinates
is never formed. In a pair of tiles the leading coordinates are multiplied first; what the others can add is bounded by
the norms of the suffixes, and only products that may still reach the threshold go on, in longer steps, and are
confirmed in double precision on the vectors as given. A task returns the links it counted per node and a spanning
forest of them.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import ceil, sqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import written
from .components import components
from .simhash import forest

#: Bytes of vectors in one side of a pair of tiles.
TILE_BYTES = 16 << 20
#: Leading coordinates that tiles' boxes cover.
BOX = 6
#: Rows by columns multiplied at once.
ROWS, COLUMNS = 1_024, 4_096
#: Slack of the single-precision bounds and of the final comparison's first pass.
SLACK, CLOSE = 1e-4, 1e-9
#: Above this share of survivors a block is multiplied whole.
DENSE = 0.02


def usable(vector: Column) -> Column:
    """Not null, not empty, only finite components, not all of them zero."""
    fine = F.forall(vector, lambda x: F.coalesce(F.abs(x) < F.lit(float("inf")), F.lit(False)))  # NaN is above infinity
    return F.coalesce(fine & (F.size(vector) > 0) & F.exists(vector, lambda x: x != 0), F.lit(False))


def _matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1)


def _unit(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(axis=1, keepdims=True)  # so that squares neither overflow nor vanish
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def principal_axes(nodes: DataFrame, width: int) -> np.ndarray:
    """Columns: directions of falling mean squared product, from the second moments of all unit vectors."""

    def moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((width, width))
        for batch in batches:
            if batch.num_rows:
                u = _unit(_matrix(batch.column(0)))
                total += u.T @ u
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(width), pa.int32()), pa.array(total.tolist(), pa.list_(pa.float64()))], names=["i", "row"]
        )

    partial = nodes.select("vector").mapInArrow(moments, "i int, row array<double>")
    sums = partial.select("i", F.posexplode("row").alias("j", "v")).groupBy("i", "j").agg(F.sum("v").alias("v"))
    out = np.zeros((width, width))  # one entry for each pair of dimensions
    for r in sums.collect():
        out[r["i"], r["j"]] = r["v"]
    _, axes = np.linalg.eigh(out)
    return axes[:, ::-1].copy()


def tiled(nodes: DataFrame, axes: np.ndarray, tiles: int) -> DataFrame:
    """node, rows, vector, p (leading coordinates), slab, tile: about ``tiles`` tiles of like size."""
    width = min(BOX, axes.shape[1])

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            p = _unit(_matrix(batch.column(2))) @ axes[:, :width] if batch.num_rows else np.zeros((0, width))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(p.tolist(), pa.list_(pa.float64()))], names=["node", "rows", "vector", "p"]
            )

    kind = nodes.schema["vector"].dataType.simpleString()
    rows = written(
        nodes.select("node", "rows", "vector").mapInArrow(project, f"node long, rows long, vector {kind}, p array<double>"),
        "vector-places",
    )
    slabs = max(1, round(sqrt(tiles)))
    inner = max(1, ceil(tiles / slabs))

    def quantiles(k: int) -> list[float]:
        return [i / k for i in range(1, k)]

    def above(value: Column, cuts: Column) -> Column:
        return F.size(F.filter(cuts, lambda c: value >= c))

    first = F.lit(0)
    if slabs > 1:
        cuts = rows.agg(F.percentile_approx(F.col("p")[0], quantiles(slabs), 10_000).alias("c")).first()["c"]
        first = sum((F.col("p")[0] >= F.lit(c)).cast("int") for c in cuts)
    rows = rows.withColumn("slab", first)
    if inner > 1 and width > 1:
        second = written(
            rows.groupBy(F.col("slab").alias("s")).agg(F.percentile_approx(F.col("p")[1], quantiles(inner), 10_000).alias("cuts")),
            "vector-cuts",
        )
        rows = rows.join(second, F.col("slab") == F.col("s")).withColumn(
            "tile", F.col("slab") * inner + above(F.col("p")[1], F.col("cuts"))
        ).drop("s", "cuts")
    else:
        rows = rows.withColumn("tile", F.col("slab"))
    return written(rows, "vector-tiles")


def tile_pairs(rows: DataFrame, threshold: float) -> DataFrame:
    """(a, b), a <= b: tiles that may hold a link. Two unit vectors of that cosine are sqrt(2 - 2t) apart at most."""
    reach = sqrt(2 - 2 * threshold) + 1e-6
    width = len(rows.select("p").first()["p"])
    boxes = written(
        rows.groupBy("tile", "slab").agg(
            F.array(*[F.min(F.col("p")[k]) for k in range(width)]).alias("low"),
            F.array(*[F.max(F.col("p")[k]) for k in range(width)]).alias("high"),
        ),
        "vector-boxes",
    )
    ends = boxes.groupBy("slab").agg(F.min(F.col("low")[0]).alias("lo"), F.max(F.col("high")[0]).alias("hi"))
    # slabs are intervals of the first coordinate in order: those within reach of a slab are a range of numbers
    slabs = [(r["slab"], r["lo"], r["hi"]) for r in ends.orderBy("slab").collect()]  # the root of the number of tiles
    near = [(s, o) for s, lo, hi in slabs for o, lo2, hi2 in slabs if s <= o and lo2 - hi <= reach]
    near_rows = rows.sparkSession.createDataFrame(near, "s int, o int")
    a = boxes.select(F.col("tile").alias("a"), F.col("slab").alias("s"), F.col("low").alias("la"), F.col("high").alias("ha"))
    b = boxes.select(F.col("tile").alias("b"), F.col("slab").alias("o"), F.col("low").alias("lb"), F.col("high").alias("hb"))
    gap2 = sum(
        F.pow(F.greatest(F.lit(0.0), F.col("lb")[k] - F.col("ha")[k], F.col("la")[k] - F.col("hb")[k]), F.lit(2.0))
        for k in range(width)
    )
    return a.join(near_rows, "s").join(b, "o").where((F.col("a") <= F.col("b")) & (gap2 <= reach * reach)).select("a", "b")


class _Side:
    def __init__(self, table: pa.Table, axes: np.ndarray, steps: list[int]):
        self.node = table["node"].to_numpy()
        self.rows = table["rows"].to_numpy()
        self.unit = _unit(_matrix(table["vector"].combine_chunks()))
        turned = self.unit @ axes
        squares = np.cumsum((turned * turned)[:, ::-1], axis=1)[:, ::-1]
        # leading coordinates of each step, the norm of the rest as one more column
        self.parts = [
            np.column_stack([turned[:, :d], np.sqrt(squares[:, d]) if d < turned.shape[1] else np.zeros(len(turned))]).astype(np.float32)
            for d in steps
        ]


def _links(a: _Side, b: _Side, same: bool, threshold: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places (i, j) of links, block by block; i < j within one tile."""
    for i0 in range(0, len(a.node), ROWS):
        i1 = min(len(a.node), i0 + ROWS)
        for j0 in range(i0 if same else 0, len(b.node), COLUMNS):
            j1 = min(len(b.node), j0 + COLUMNS)
            bound = a.parts[0][i0:i1] @ b.parts[0][j0:j1].T
            i, j = np.nonzero(bound >= threshold - SLACK)
            if len(i) > DENSE * bound.size:
                product = a.unit[i0:i1] @ b.unit[j0:j1].T
                i, j = np.nonzero(product >= threshold - CLOSE)
                product = product[i, j]
                i, j = i + i0, j + j0
            else:
                i, j = i + i0, j + j0
                for x, y in zip(a.parts[1:], b.parts[1:], strict=True):
                    still = np.einsum("ij,ij->i", x[i], y[j]) >= threshold - SLACK
                    i, j = i[still], j[still]
                product = np.einsum("ij,ij->i", a.unit[i], b.unit[j])
            ok = product >= threshold
            if same:
                ok &= i < j
            if ok.any():
                yield i[ok], j[ok]


def linked(nodes: DataFrame, width: int, threshold: float) -> DataFrame:
    """(node, rows, vector) -> (kind, a, b): kind 0, b rows linked to node a; kind 1, a forest edge."""
    spark = nodes.sparkSession
    n = nodes.count()
    axes = principal_axes(nodes, width)
    at_once = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    tiles = max(ceil(n * width * 4 / TILE_BYTES), min(ceil(sqrt(4 * at_once)), ceil(n / 64)))
    rows = tiled(nodes, axes, tiles)
    pairs = written(tile_pairs(rows, threshold), "vector-pairs")
    wanted = pairs.select(F.col("a").alias("t"), "a", "b", F.lit(0).alias("side")).unionAll(
        pairs.where("a <> b").select(F.col("b").alias("t"), "a", "b", F.lit(1).alias("side"))
    )
    dealt = rows.join(wanted, F.col("tile") == F.col("t")).select("a", "b", "side", "node", "rows", "vector")
    steps = sorted({max(1, width // 4), max(1, width // 2)})

    def compare(table: pa.Table) -> pa.Table:
        side = table["side"].to_numpy()
        left = _Side(table.filter(pa.array(side == 0)), axes, steps)
        same = not (side == 1).any() and table["a"][0].as_py() == table["b"][0].as_py()
        right = left if same else _Side(table.filter(pa.array(side == 1)), axes, steps)
        found_a, found_b = np.zeros(len(left.node), np.int64), np.zeros(len(right.node), np.int64)
        edges: list[tuple[np.ndarray, np.ndarray]] = []
        for i, j in _links(left, right, same, threshold):
            np.add.at(found_a, i, right.rows[j])
            np.add.at(found_a if same else found_b, j, left.rows[i])
            edges.append(forest(left.node[i], right.node[j]))
        heads = [left.node[found_a > 0]] + ([] if same else [right.node[found_b > 0]])
        counts = [found_a[found_a > 0]] + ([] if same else [found_b[found_b > 0]])
        if edges:
            u, v = forest(np.concatenate([e[0] for e in edges]), np.concatenate([e[1] for e in edges]))
        else:
            u = v = np.zeros(0, np.int64)
        kind = np.repeat([0, 1], [sum(map(len, heads)), len(u)]).astype(np.int32)
        return pa.table(
            {"kind": pa.array(kind), "a": pa.array(np.concatenate([*heads, u])), "b": pa.array(np.concatenate([*counts, v]))}
        )

    return dealt.groupBy("a", "b").applyInArrow(compare, "kind int, a long, b long")


def near_vectors(
    vectors: DataFrame, threshold: float = 0.95, key: str = "vec_id", vector: str = "embedding"
) -> DataFrame:
    """vec_id, n_links, component_id, kept: a row per row.

    Vectors that are null or empty, hold null or non-finite components or are zero link with nothing, and so do
    vectors of different length. Equal vectors link. Repeated ids are separate vectors; ``component_id`` is the least
    id that links reach (null ids only if there is no other), ``kept`` is whether that is the vector's own.
    """
    rows = vectors.select(F.col(key).alias("vec_id"), F.col(vector).alias("vector"))
    fine = rows.where(usable(F.col("vector")))
    groups = fine.groupBy("vector").agg(F.count("*").alias("rows"), F.min("vec_id").alias("first"))
    nodes = written(groups.withColumn("node", F.monotonically_increasing_id()), "vector-nodes")
    widths = [r["w"] for r in nodes.groupBy(F.size("vector").alias("w")).count().collect()]  # lengths of vectors
    found = None
    for width in sorted(widths):
        part = linked(nodes.where(F.size("vector") == width), width, threshold)
        found = part if found is None else found.unionAll(part)
    alone = rows.where(~usable(F.col("vector"))).select(
        "vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id")
    )
    if found is None:
        out = alone
    else:
        found = written(found, "vector-links")
        counts = found.where("kind = 0").groupBy(F.col("a").alias("c_node")).agg(F.sum("b").alias("others"))
        reach = components(found.where("kind = 1").select("a", "b"))
        labelled = nodes.join(reach.withColumnRenamed("node", "r_node"), F.col("node") == F.col("r_node"), "left").join(
            counts, F.col("node") == F.col("c_node"), "left"
        ).select(
            "node", "vector", "first", (F.col("rows") - 1 + F.coalesce("others", F.lit(0))).alias("n_links"),
            F.coalesce("component", "node").alias("part"),
        )
        labelled = written(labelled, "vector-parts")
        least = written(labelled.groupBy(F.col("part").alias("p")).agg(F.min("first").alias("component_id")), "vector-least")
        answers = written(
            labelled.join(least, F.col("part") == F.col("p")).select(F.col("vector").alias("v"), "n_links", "component_id"),
            "vector-answers",
        )
        out = fine.join(answers, F.col("vector") == F.col("v")).select("vec_id", "n_links", "component_id").unionAll(alone)
    return out.withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))


def query(spark, sf_dir):
    return near_vectors(spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding"))


ORACLE = r"""
with v as (
  select vec_id, cast(embedding as double[]) as e from embeddings
), n as (
  select vec_id, e, sqrt(list_sum(list_transform(e, lambda x: x * x))) as norm from v
  where e is not null and len(e) > 0 and len(list_filter(e, lambda x: x is null or not isfinite(x))) = 0
    and len(list_filter(e, lambda x: x <> 0)) > 0
), l as (
  select a.vec_id as a, b.vec_id as b from n a join n b on a.vec_id <> b.vec_id and len(a.e) = len(b.e)
  where list_dot_product(a.e, b.e) / (a.norm * b.norm) >= 0.95
), r as (
  with recursive reach(a, b) as (select vec_id, vec_id from v union select r.a, l.b from reach r join l on r.b = l.a)
  select a, min(b) as component_id from reach group by a
)
select v.vec_id, coalesce(c.n_links, 0) as n_links, r.component_id, v.vec_id = r.component_id as kept
from v join r on r.a = v.vec_id left join (select a, count(*) as n_links from l group by a) c on c.a = v.vec_id
"""
