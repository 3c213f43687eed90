"""Best matches of every query among all candidates, tile by tile.

Queries and candidates are hashed into blocks; one task compares one block with
one block and hands on only the k best candidates of each query, so neither a
cross join nor a table of all pairs exists, no side is broadcast, and the
memory of a task is bounded by the block sizes. The kernels run on numpy.

Cosines of few dimensions need not compare all blocks: candidates lie in cells
of directions, the k best of a query's own cell bound what another cell must
reach, and the query goes to no cell that cannot.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tastemill.operators.ordering import top_k
from tastemill.session import cut_lineage

#: Most tasks of one tile stage; beyond it a task takes several tiles.
MOST_TASKS = 20_000
#: Rows of a block, on either side.
BLOCK = 8192
#: Numbers of a block of vectors, 32 MB.
BLOCK_NUMBERS = 1 << 22
#: Cells of the score table a kernel holds at a time.
CELLS = 1_000_000
#: A token held by more than one in DENSE_SHARE candidates of a tile is common.
DENSE_SHARE = 8
#: More than one in FEW_SHARE cells above 0 are many.
FEW_SHARE = 16
DECIMALS = 6
#: Dimensions up to which directions are cut into cells, candidates of a cell on average, most cells.
FEW_DIMENSIONS = 6
CELL_ROWS = 2048
MOST_CELLS = 4096
#: Cells there must be, so that leaving some out is worth two rounds.
FEWEST_CELLS = 16
#: What angles and rounded scores may be off.
SLACK = 1e-6

#: Keys of the queries, sorted keys of the candidates, and the score rows a few queries at a time.
Scored = tuple[np.ndarray, np.ndarray, Iterator[np.ndarray]]
Kernel = Callable[[pd.DataFrame, pd.DataFrame], Scored]


def stack(column: pd.Series) -> np.ndarray:
    return np.stack([np.asarray(v, dtype=np.float64) for v in column])


def by_rows(
    q: pd.DataFrame, c: pd.DataFrame, scores: Callable[..., np.ndarray], asked: Callable = stack, offered: Callable | None = None
) -> Scored:
    """Kernel of one vector per row; ``asked`` and ``offered`` make a matrix of either column."""
    c = c.sort_values("key", kind="stable")
    a, b = asked(q["v"]), (offered or asked)(c["v"])
    step = max(1, CELLS // max(1, len(b)))
    return q["key"].to_numpy(), c["key"].to_numpy(), (scores(a[i : i + step], b) for i in range(0, len(a), step))


def _unit(m: np.ndarray) -> np.ndarray:
    n = np.sqrt(np.einsum("ij,ij->i", m, m))[:, None]
    return np.divide(m, n, out=np.zeros_like(m), where=n > 0)


def _dot(q: pd.DataFrame, c: pd.DataFrame) -> Scored:
    return by_rows(q, c, lambda a, b: a @ b.T)


def _cosine(q: pd.DataFrame, c: pd.DataFrame) -> Scored:
    return by_rows(q, c, lambda a, b: a @ b.T, lambda v: _unit(stack(v)))


def _negative_l2(q: pd.DataFrame, c: pd.DataFrame) -> Scored:
    def scores(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        aa, bb = np.einsum("ij,ij->i", a, a), np.einsum("ij,ij->i", b, b)
        return -np.maximum(aa[:, None] + bb[None, :] - 2.0 * (a @ b.T), 0.0)

    return by_rows(q, c, scores)


def _postings(
    q: pd.DataFrame,
    c: pd.DataFrame,
    normalise: bool = False,
    separable: bool = True,
    term: Callable[[np.ndarray, np.ndarray], np.ndarray] | None = None,
) -> Scored:
    """Sum over the shared tokens of weight x weight (x ``term`` of the two ``t``), bags as long rows.

    The postings of the queries' tokens are looked up and summed per candidate,
    so nothing is computed for pairs without a common token. If the sum is a
    plain product, tokens that more than one in DENSE_SHARE candidates hold are
    multiplied as a dense table instead.
    """
    qr, lk = pd.factorize(q["key"], sort=True)
    cr, rk = pd.factorize(c["key"], sort=True)
    codes, known = pd.factorize(np.concatenate([c["token"].to_numpy(), q["token"].to_numpy()]))
    cp, qp = codes[: len(c)], codes[len(c) :]
    qw, cw = q["weight"].to_numpy(dtype=np.float64), c["weight"].to_numpy(dtype=np.float64)
    if normalise:
        qw = qw / np.sqrt(np.bincount(qr, weights=qw * qw))[qr]
        cw = cw / np.sqrt(np.bincount(cr, weights=cw * cw))[cr]
    qt = q["t"].to_numpy() if term else None
    ct = c["t"].to_numpy() if term else None
    held = np.bincount(cp, minlength=len(known))
    common = held > (len(rk) / DENSE_SHARE if separable else len(c))
    column = np.cumsum(common) - 1
    table_q, table_c = np.zeros((len(lk), common.sum())), np.zeros((common.sum(), len(rk)))
    hot = common[qp]
    table_q[qr[hot], column[qp[hot]]] = qw[hot]
    order = np.flatnonzero(~hot)
    order = order[np.argsort(qr[order], kind="stable")]
    qr, qp, qw, qt = qr[order], qp[order], qw[order], (qt[order] if term else None)
    hot = common[cp]
    table_c[column[cp[hot]], cr[hot]] = cw[hot]
    order = np.flatnonzero(~hot)
    order = order[np.argsort(cp[order], kind="stable")]
    cr, cp, cw, ct = cr[order], cp[order], cw[order], (ct[order] if term else None)

    first = np.searchsorted(cp, np.arange(len(known) + 1))
    size = (first[1:] - first[:-1])[qp]
    first = first[qp]
    rows = np.searchsorted(qr, np.arange(len(lk) + 1))
    work = np.concatenate([[0], np.cumsum(size)])[rows]  # postings before each query

    def blocks() -> Iterator[np.ndarray]:
        widest = max(1, CELLS // len(rk))
        i = 0
        while i < len(lk):
            j = int(np.searchsorted(work, work[i] + CELLS, side="right")) - 1
            j = min(max(j, i + 1), i + widest, len(lk))
            x = np.arange(rows[i], rows[j])
            n = size[x]
            to = np.arange(n.sum()) + np.repeat(first[x] - (np.cumsum(n) - n), n)
            x = np.repeat(x, n)
            gain = qw[x] * cw[to]
            if term:
                gain = gain * term(qt[x], ct[to])
            cell = (qr[x] - i) * len(rk) + cr[to]
            out = np.bincount(cell, weights=gain, minlength=(j - i) * len(rk)).reshape(j - i, len(rk))
            yield out + table_q[i:j] @ table_c if len(table_c) else out
            i = j

    return np.asarray(lk), np.asarray(rk), blocks()


def _bag(q: pd.DataFrame, c: pd.DataFrame) -> Scored:
    """Cosine of token bags given as (key, token, weight) rows."""
    return _postings(q, c, normalise=True)


def _overlap(q: pd.DataFrame, c: pd.DataFrame) -> Scored:
    """Sum of weight x weight over shared tokens."""
    return _postings(q, c)


def _closeness(q: pd.DataFrame, c: pd.DataFrame) -> Scored:
    """Sum of weight x weight / (1 + days between the two times) over shared tokens."""
    return _postings(q, c, separable=False, term=lambda x, y: 1.0 / (1.0 + np.abs(x - y) / 86400.0))


def _distances(text: str, chars: np.ndarray, length: np.ndarray, replace: int) -> np.ndarray:
    """Edit distances of a text to all candidates; a replaced letter costs ``replace``."""
    column = np.arange(chars.shape[1] + 1)
    prev = np.tile(column, (len(chars), 1))
    for i, ch in enumerate(text):
        cur = np.empty_like(prev)
        cur[:, 0] = i + 1
        cur[:, 1:] = np.minimum(prev[:, :-1] + replace * (chars != ord(ch)), prev[:, 1:] + 1)
        prev = np.minimum.accumulate(cur - column, axis=1) + column  # insertions run to the right
    return prev[np.arange(len(chars)), length]


def _titles(c: pd.DataFrame, fold: bool) -> tuple[pd.DataFrame, np.ndarray, np.ndarray]:
    c = c.sort_values("key", kind="stable")
    names = [s.lower() if fold else s for s in c["key"]]
    length = np.array([len(s) for s in names])
    chars = np.zeros((len(names), int(length.max())), dtype=np.int64)
    for i, s in enumerate(names):
        chars[i, : len(s)] = [ord(ch) for ch in s]
    return c, chars, length


def _share(part: np.ndarray, whole: np.ndarray) -> np.ndarray:
    return 100 * (1.0 - np.divide(part, whole, out=np.zeros(len(whole)), where=whole > 0))


def _edit(q: pd.DataFrame, c: pd.DataFrame) -> Scored:
    """0..100: 1 - edit distance / longer length, case ignored."""
    c, chars, length = _titles(c, True)

    def rows() -> Iterator[np.ndarray]:
        for text in (x.lower() for x in q["key"]):
            yield np.rint(_share(_distances(text, chars, length, 1), np.maximum(length, len(text))))[None, :]

    return q["key"].to_numpy(), c["key"].to_numpy(), rows()


def _ratio(q: pd.DataFrame, c: pd.DataFrame) -> Scored:
    """0..100: twice the letters two texts have in common, in order, over their summed length; case counts."""
    c, chars, length = _titles(c, False)

    def rows() -> Iterator[np.ndarray]:
        for text in q["key"]:
            yield np.rint(_share(_distances(text, chars, length, 2), length + len(text)))[None, :]

    return q["key"].to_numpy(), c["key"].to_numpy(), rows()


KERNELS: dict[str, Kernel] = {"dot": _dot, "cosine": _cosine, "l2": _negative_l2, "edit": _edit, "ratio": _ratio}
KERNELS |= {"bag": _bag, "overlap": _overlap, "closeness": _closeness}


Picked = tuple[np.ndarray, np.ndarray, np.ndarray]


def _best_of_all(scores: np.ndarray, k: int, same: tuple | None) -> Picked:
    """Row, column and score of the k greatest of each row; equal scores in order of the columns."""
    scores = np.round(scores, DECIMALS) + 0.0
    if same is not None:
        scores[same] = -np.inf
    n = scores.shape[1]
    if n > k:
        least = -np.partition(-scores, k - 1, axis=1)[:, k - 1]
        keep = [np.flatnonzero(row >= x) for row, x in zip(scores, least)]
    else:
        keep = [np.arange(n)] * len(scores)
    picked = [ix[np.argsort(-row[ix], kind="stable")][:k] for row, ix in zip(scores, keep)]
    rows = np.repeat(np.arange(len(scores)), [len(ix) for ix in picked])
    cols = np.concatenate(picked)
    best = scores[rows, cols]
    real = best > -np.inf
    return rows[real], cols[real], best[real]


def _best_of_positive(scores: np.ndarray, k: int, same: tuple | None) -> Picked:
    """The same for scores above 0 before rounding; where these are few it works on those cells only."""
    if same is not None:
        scores[same] = 0.0
    positive = scores > 0
    at = np.flatnonzero(positive.ravel())
    if len(at) * FEW_SHARE > scores.size:  # cheaper than to sort all cells of a row
        return _best_of_all(np.where(positive, scores, -np.inf), k, None)
    rows, cols = np.divmod(at, scores.shape[1])
    values = np.round(scores.ravel()[at], DECIMALS)
    ends = np.searchsorted(rows, np.arange(len(scores) + 1))
    picked = [
        s + np.argsort(-values[s:e], kind="stable")[:k] for s, e in zip(ends[:-1], ends[1:]) if e > s
    ]
    ix = np.concatenate(picked) if picked else np.zeros(0, dtype=np.int64)
    return rows[ix], cols[ix], values[ix]


def block_count(rows: int, parallel: int) -> int:
    """Number of blocks of one side: bounded size, and on small tables tiles enough for the cores."""
    return max(1, -(-rows // BLOCK), min(math.ceil(math.sqrt(parallel)), rows // 256))


def vector_blocks(rows: int, dimensions: int, parallel: int) -> int:
    """The same for vectors, of which a block holds about BLOCK_NUMBERS numbers, and three tiles for each core."""
    block = max(1, BLOCK_NUMBERS // max(1, dimensions))
    return max(1, -(-rows // block), min(math.ceil(math.sqrt(3 * parallel)), rows // 256))


def floats(rows: DataFrame) -> bool:
    """Whether floats hold all numbers of the vectors ``v``."""
    same = F.forall("v", lambda x: F.coalesce(x.cast("float").cast("double") == x, F.lit(False)))
    return bool(rows.agg(F.every(same)).first()[0])


def by_tile(df: DataFrame, keys: list[str], tiles: int) -> DataFrame:
    """Rows brought together per tile, few tiles to a task.

    Hashing few keys into as few partitions would put several tiles on one core
    and none on another, and the partitions are small in bytes though long in
    work, so their number is set here and not left to be merged.
    """
    default = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(min(max(4 * tiles, default), MOST_TASKS), *keys)


def matcher(
    kernel: str | Kernel, k: int, drop_self: bool = False, positive_only: bool = False
) -> Callable[[pd.DataFrame, pd.DataFrame], pd.DataFrame]:
    """Function of one tile: queries and candidates (``key`` and payload) to the k best of each query.

    ``positive_only`` keeps only pairs whose score is above 0 before rounding.
    """
    fn = KERNELS[kernel] if isinstance(kernel, str) else kernel
    best = _best_of_positive if positive_only else _best_of_all

    def tile(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if left.empty or right.empty:
            return pd.DataFrame({"query_key": [], "match_key": [], "score": []})
        lk, rk, blocks = fn(left, right)
        twin = pd.Index(rk).get_indexer(lk) if drop_self else None
        out_q, out_m, out_s = [], [], []
        done = 0
        for block in blocks:
            same = None
            if twin is not None:
                mine = twin[done : done + len(block)]
                same = np.flatnonzero(mine >= 0), mine[mine >= 0]
            rows, cols, scores = best(block, k, same)
            out_q.append(lk[done + rows])
            out_m.append(rk[cols])
            out_s.append(scores)
            done += len(block)
        return pd.DataFrame(
            {"query_key": np.concatenate(out_q), "match_key": np.concatenate(out_m), "score": np.concatenate(out_s)}
        )

    return tile


def match_schema(query_key: T.DataType, match_key: T.DataType) -> T.StructType:
    return T.StructType(
        [
            T.StructField("query_key", query_key),
            T.StructField("match_key", match_key),
            T.StructField("score", T.DoubleType()),
        ]
    )


def _vectors(df: DataFrame, key: str) -> DataFrame:
    return cut_lineage(df.select(F.col(key).alias("key"), F.col("v").cast("array<double>").alias("v")))


def _widths(vectors: DataFrame) -> tuple[int, int] | None:
    """Least and greatest number of dimensions; None where a vector or number is null or not finite."""
    sound = F.forall("v", lambda x: F.coalesce(F.abs(x) < F.lit(math.inf), F.lit(False)))
    least, most, fine = vectors.agg(F.min(F.size("v")), F.max(F.size("v")), F.every(F.coalesce(sound, F.lit(False)))).first()
    return (least, most) if fine else None


def _matrix(batch: pa.RecordBatch) -> np.ndarray:
    flat = batch.column("v").flatten().to_numpy(zero_copy_only=False)
    return _unit(flat.reshape(batch.num_rows, -1))


def _nearest(m: np.ndarray, centres: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nearest centre of each row and the angle to it."""
    cell, angle = np.zeros(len(m), np.int32), np.zeros(len(m))
    step = max(1, CELLS // len(centres))
    for i in range(0, len(m), step):
        near = m[i : i + step] @ centres.T
        cell[i : i + step] = near.argmax(axis=1)
        angle[i : i + step] = np.arccos(np.clip(near.max(axis=1), -1.0, 1.0))
    return cell, angle


def _by_direction(
    queries: DataFrame, candidates: DataFrame, key: str, k: int, drop_self: bool, positive_only: bool, offered: int
) -> DataFrame | None:
    """(query_key, match_key, score) with the k best by cosine of every query; None where vectors are not fit for cells.

    Centres are candidates in hash order, a cell is what lies nearest to one. A first round finds the k best of a
    query's own cell; the second takes the query to the cells that may hold as good ones, by the angle to the centre
    and the greatest angle in the cell. Candidates without direction have a cell that scores 0. Cells and their
    queries are cut into slices of BLOCK rows.
    """
    kinds = match_schema(queries.schema[key].dataType, candidates.schema[key].dataType)
    queries, candidates = _vectors(queries, key), _vectors(candidates, key)
    widths = _widths(queries), _widths(candidates)
    if widths[0] is None or widths[0] != widths[1] or not 0 < widths[0][0] == widths[0][1] <= FEW_DIMENSIONS:
        return None
    some = candidates.orderBy(F.xxhash64("key"), "key").limit(min(MOST_CELLS, -(-offered // CELL_ROWS))).collect()
    centres = np.unique(_unit(np.array([r.v for r in some])), axis=0)
    centres = centres[(centres != 0).any(axis=1)]
    if not len(centres):
        return None
    none = len(centres)  # the cell of candidates without direction

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            m = _matrix(batch)
            cell, angle = _nearest(m, centres)
            cell[~m.any(axis=1)] = none
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cell), pa.array(angle)], ["key", "v", "cell", "angle"])

    plain = T.StructType([candidates.schema["key"], candidates.schema["v"]]).add("cell", "integer")
    offers = cut_lineage(candidates.mapInArrow(placed, T.StructType(plain.fields).add("angle", "double")))
    widest = np.full(none + 1, -1.0)  # a cell without rows stays below 0
    for r in offers.groupBy("cell").agg(F.max("angle").alias("angle")).collect():
        widest[r.cell] = r.angle

    def slices(rows: DataFrame, name: str) -> DataFrame:
        return F.broadcast(rows.groupBy("cell").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias(name)))

    held = cut_lineage(offers.groupBy("cell").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("_nc")))

    def met(asked: DataFrame) -> DataFrame:
        def sliced(rows: DataFrame, own: str, other: str) -> DataFrame:
            both = rows.join(slices(asked, "_nq"), "cell").join(F.broadcast(held), "cell")
            part = F.pmod(F.xxhash64("key"), F.col(f"_n{own}")).cast("int").alias(f"_{own}")
            every = F.explode(F.sequence(F.lit(0), F.col(f"_n{other}") - 1)).alias(f"_{other}")
            return by_tile(both.select("key", "v", "cell", part, every), tile, -(-none // 4)).groupBy(*tile)

        tile = ["cell", "_q", "_c"]
        fn = matcher("cosine", k, drop_self, positive_only)
        return sliced(asked, "q", "c").cogroup(sliced(offers.drop("angle"), "c", "q")).applyInPandas(fn, kinds)

    def home(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cell, _ = _nearest(_matrix(batch), centres)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cell)], ["key", "v", "cell"])

    def elsewhere(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            whole = _matrix(batch)
            goal = batch.column("least").to_numpy(zero_copy_only=False)
            step = max(1, CELLS // none)
            for i in range(0, len(whole), step):
                m = whole[i : i + step]
                near = m @ centres.T
                apart = np.arccos(np.clip(near, -1.0, 1.0)) - widest[:none] - SLACK
                best = np.zeros((len(m), none + 1))
                best[:, :none] = np.where(m.any(axis=1)[:, None], np.cos(np.maximum(apart, 0.0)), 0.0)
                open_ = (best >= goal[i : i + step, None] - SLACK) & (widest >= 0.0)
                open_[np.arange(len(m)), near.argmax(axis=1)] = False
                row, cell = np.nonzero(open_)
                at = pa.array(row + i)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("key").take(at), batch.column("v").take(at), pa.array(cell.astype(np.int32))], ["key", "v", "cell"]
                )

    asks = T.StructType([queries.schema["key"], queries.schema["v"]]).add("cell", "integer")
    first = top_k(met(cut_lineage(queries.mapInArrow(home, asks))), ["query_key"], [F.desc("score"), "match_key"], k)
    first = cut_lineage(first.drop("rank"))
    full = first.groupBy("query_key").agg(F.min("score").alias("least"), F.count(F.lit(1)).alias("_n")).filter(F.col("_n") >= k)
    goals = queries.join(full, F.col("key").eqNullSafe(F.col("query_key")), "left").select(
        "key", "v", F.coalesce("least", F.lit(-math.inf)).alias("least")
    )
    return first.unionByName(met(cut_lineage(goals.mapInArrow(elsewhere, asks))))


def best_matches(
    queries: DataFrame,
    candidates: DataFrame,
    key: str,
    k: int,
    kernel: str,
    drop_self: bool = False,
    positive_only: bool = False,
    sizes: tuple[int, int] | None = None,
    blocks: tuple[int, int] | None = None,
) -> DataFrame:
    """(query_key, match_key, score, rank): the k best candidates of every query.

    Both frames hold ``key`` and the columns the kernel reads: ``v``, or for
    bags one row per ``token`` with its ``weight`` (and ``t``). Scores have 6 decimals;
    ties go to the lower key. ``sizes`` are the numbers of queries and
    candidates; without them the rows are counted first. ``blocks`` sets the
    number of blocks of either side itself.
    """
    if blocks is None:
        parallel = queries.sparkSession.sparkContext.defaultParallelism
        asked, offered = sizes or (queries.count(), candidates.count())
        blocks = block_count(asked, parallel), block_count(offered, parallel)
        if kernel == "cosine" and offered > FEWEST_CELLS * CELL_ROWS:
            found = _by_direction(queries, candidates, key, k, drop_self, positive_only, offered)
            if found is not None:
                return top_k(found, ["query_key"], [F.desc("score"), "match_key"], k)
    nq, nc = blocks
    every_c = F.explode(F.sequence(F.lit(0), F.lit(nc - 1))).alias("_c")
    every_q = F.explode(F.sequence(F.lit(0), F.lit(nq - 1))).alias("_q")
    payload = [c for c in queries.columns if c != key]
    q = queries.select(
        F.col(key).alias("key"), *payload, F.pmod(F.xxhash64(key), F.lit(nq)).cast("int").alias("_q"), every_c
    )
    c = candidates.select(  # own names: both sides may come from one frame
        F.col(key).alias("key"),
        *[F.col(p).alias(p) for p in payload],
        F.pmod(F.xxhash64(key), F.lit(nc)).cast("int").alias("_c"),
        every_q,
    )
    schema = match_schema(queries.schema[key].dataType, candidates.schema[key].dataType)
    tile = ["_q", "_c"]
    found = (
        by_tile(q, tile, nq * nc)
        .groupBy(*tile)
        .cogroup(by_tile(c, tile, nq * nc).groupBy(*tile))
        .applyInPandas(matcher(kernel, k, drop_self, positive_only), schema)
    )
    return top_k(found, ["query_key"], [F.desc("score"), "match_key"], k)
