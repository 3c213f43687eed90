"""SimHash near-duplicates through Golay-code fuzzy hashing.

Fingerprints are cut into segments that are read as 23-bit words of the perfect Golay code: every word lies within
three flips of exactly one codeword, and words two flips apart have a codeword within four flips of both. A segment's
keys are the indices of the codewords within four flips: one, or six. Of three segments with three flips among them
two have one flip at most, so keys of two segments together find every such pair (one side then needs the nearest
codeword only); with all keys on both sides pairs of five flips are certain and many beyond are found. Pairs meet by
key, are verified by counting bits, and leave a task as a spanning forest, never as all pairs of a group. Where links need
common shingles as well, a forest's edge may fail; what it connected is then compared again, in rounds that let more pairs
out, until no pair of different parts is left untested.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written
from .components import components
from .url_filter import bloom_table, flag_listed, maybe_listed

SEED = 42
#: Flips that keys of nearest codewords on one side are sure to find.
SURE_ONE_SIDED = 3
#: Members of one side of a key that a task holds; keys with more are dealt to several tasks.
SIDE_ROWS = 2_048
#: Pairs compared at once.
PAIR_BLOCK = 1 << 21
#: Fingerprints that travel with a key, so that its pairs can be compared; fewer where texts are compared afterwards.
COMPARED, COMPARED_FIRST = 3, 2
#: Pairs of each part that the second round lets out of a task and a key, and by how many times every round lets out more.
SECOND_ROUND = 32
#: Bytes of a sketch, each the number of shingles whose hash is in one of as many ranges; the last value stands for more.
SKETCH, SKETCH_FULL = 32, 255
#: Rows of one codeword that a task looks at together, rows it holds at most; of more each key goes out by itself.
WORD_ROWS, MOST_WORD_ROWS = 100_000, 1_000_000

#: Generator polynomial of the binary Golay code, word and message length.
GENERATOR, WORD_BITS, MESSAGE_BITS = 0b101011100011, 23, 12
CHECK_BITS = WORD_BITS - MESSAGE_BITS


def _remainders() -> np.ndarray:
    """Remainder by the generator of each 23-bit word with one bit set."""
    out = []
    for bit in range(WORD_BITS):
        x = 1 << bit
        for high in range(WORD_BITS - 1, CHECK_BITS - 1, -1):
            if x >> high & 1:
                x ^= GENERATOR << (high - CHECK_BITS)
        out.append(x)
    return np.array(out, np.uint32)


class Golay:
    """Codeword indices near 23-bit words, by tables over the 2048 remainders."""

    def __init__(self) -> None:
        unit = _remainders()
        low, high = np.arange(1 << MESSAGE_BITS, dtype=np.uint32), np.arange(1 << CHECK_BITS, dtype=np.uint32)
        self.low, self.high = np.zeros(1 << MESSAGE_BITS, np.uint32), np.zeros(1 << CHECK_BITS, np.uint32)
        for bit in range(MESSAGE_BITS):
            self.low[low >> bit & 1 == 1] ^= unit[bit]
        for bit in range(CHECK_BITS):
            self.high[high >> bit & 1 == 1] ^= unit[bit + MESSAGE_BITS]
        self.nearest = np.zeros(1 << CHECK_BITS, np.uint32)
        four: list[list[int]] = [[] for _ in range(1 << CHECK_BITS)]
        for flips in range(5):
            for bits in combinations(range(WORD_BITS), flips):
                mask = sum(1 << b for b in bits)
                rest = int(np.bitwise_xor.reduce(unit[list(bits)])) if bits else 0
                if flips < 4:
                    self.nearest[rest] = mask
                else:
                    four[rest].append(mask)
        # words three flips from their codeword are four flips from five others; -1 where there are none
        self.others = np.full((1 << CHECK_BITS, 5), -1, np.int64)
        for rest, masks in enumerate(four):
            self.others[rest, : len(masks)] = masks

    def keys(self, words: np.ndarray, all_near: bool) -> np.ndarray:
        """(words, 1 or 6) codeword indices, -1 for none."""
        rest = self.low[words & 0xFFF] ^ self.high[words >> MESSAGE_BITS]
        own = ((words ^ self.nearest[rest]) >> CHECK_BITS).astype(np.int64)[:, None]
        if not all_near:
            return own
        flips = self.others[rest]
        near = (words.astype(np.int64)[:, None] ^ flips) >> CHECK_BITS
        return np.concatenate([own, np.where(flips < 0, -1, near)], axis=1)


#: First bit and bits of the segments of 64, and the pairs of them that are keys. Three find every link of few flips;
#: quarters with a partner each find more of the links of many flips for as many keys.
Scheme = tuple[tuple[tuple[int, int], ...], tuple[tuple[int, int], ...]]
THIRDS: Scheme = ((0, 22), (22, 21), (43, 21)), tuple(combinations(range(3), 2))
QUARTERS: Scheme = ((0, 16), (16, 16), (32, 16), (48, 16)), ((0, 1), (2, 3))


def pair_keys(prints: np.ndarray, table: int, all_near: bool, code: Golay, scheme: Scheme = THIRDS) -> tuple[np.ndarray, np.ndarray]:
    """(row, key) of all keys of 64-bit fingerprints: table, pair of segments, codeword index of either."""
    segments, pairs = scheme
    ids = [
        code.keys(((prints >> np.uint64(start)) & np.uint64((1 << bits) - 1)).astype(np.uint32), all_near)
        for start, bits in segments
    ]
    rows, keys = [], []
    for k, (a, b) in enumerate(pairs):
        both = (ids[a][:, :, None] << MESSAGE_BITS) | ids[b][:, None, :]
        there = (ids[a][:, :, None] >= 0) & (ids[b][:, None, :] >= 0)
        row = np.broadcast_to(np.arange(len(prints))[:, None, None], there.shape)
        rows.append(row[there])
        keys.append(both[there] | ((len(pairs) * table + k) << (2 * MESSAGE_BITS)))
    return np.concatenate(rows), np.concatenate(keys)


#: An odd step and the shifts and multipliers of a well-known 64-bit mixing function.
MIX_STEP, MIX_LAST = 0x9E3779B97F4A7C15, 31
MIX = ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB))


def _mixed(hashes: np.ndarray, seed: int) -> np.ndarray:
    """Other hashes of the same pieces, from their first: odd multiples and shifts, so that every bit reaches every other."""
    x = hashes + np.uint64((2 * seed + 1) * MIX_STEP % (1 << 64))
    for shift, factor in MIX:
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
    return (x ^ (x >> np.uint64(MIX_LAST))).astype("<u8")


def sketched(hashes: np.ndarray) -> np.ndarray:
    """Number of hashes in each of SKETCH ranges, as bytes."""
    shift = np.uint64(64 - (SKETCH - 1).bit_length())
    return np.minimum(np.bincount((hashes >> shift).astype(np.int64), minlength=SKETCH), SKETCH_FULL).astype(np.uint8)


def may_resemble(a: np.ndarray, b: np.ndarray, sizes: np.ndarray, least: float) -> np.ndarray:
    """Whether texts of these sketches (a row each) and sum of sizes can have ``least`` of their shingles in common.

    Common shingles are in the same range, so they are at most the sum of the lesser numbers.
    """
    common = np.minimum(a, b).sum(axis=1, dtype=np.int64)
    full = ((a == SKETCH_FULL) & (b == SKETCH_FULL)).any(axis=1)
    either = sizes - common
    return full | (either <= 0) | (common / np.maximum(either, 1) >= least)


def fingerprint(text: bytes, shingle: int, seeds: tuple[int, ...], once: bool = False) -> list[int]:
    """64-bit fingerprints of a text: a bit is set if more than half of the shingles' hashes have it.

    With ``once`` repeated shingles count once, so that no shingle decides alone. Pieces are hashed with the first seed;
    the hashes of the others follow from that one.
    """
    return _described(text, shingle, seeds, once)[0]


def _described(text: bytes, shingle: int, seeds: tuple[int, ...], once: bool) -> tuple[list[int], int, np.ndarray]:
    """The fingerprints, the number of shingles and their sketch."""
    import xxhash

    found = text.lower().split()  # A-Z and ASCII white space only
    if not found:
        return [0] * len(seeds), 0, np.zeros(SKETCH, np.uint8)
    line = b" ".join(found)
    sizes = np.fromiter(map(len, found), np.int64, len(found))
    begin = np.cumsum(sizes + 1) - sizes - 1
    n = max(1, len(found) - shingle + 1)
    end = (begin + sizes)[min(shingle, len(found)) - 1 :]
    pieces = [line[b:e] for b, e in zip(begin[:n].tolist(), end.tolist(), strict=True)]
    if once:
        pieces = list(dict.fromkeys(pieces))
        n = len(pieces)
    out = []
    first = np.array([xxhash.xxh64_intdigest(p, seeds[0]) for p in pieces], "<u8")
    for seed in seeds:
        counts = np.zeros(64, np.int64)
        hashes = first if seed == seeds[0] else _mixed(first, seed)
        for at in range(0, n, 1 << 15):
            bits = np.unpackbits(hashes[at : at + (1 << 15)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            counts += bits.sum(axis=0, dtype=np.uint32)
        out.append(int.from_bytes(np.packbits(2 * counts > n, bitorder="little").tobytes(), "little"))
    return out, n, sketched(first)


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


#: Columns of a text's sketch.
SKETCHED = ["size", *(f"sk_{i}" for i in range(SKETCH // 8))]


def fingerprints(
    docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = 3, seeds: tuple[int, ...] = (SEED,),
    once: bool = False,
) -> DataFrame:
    """doc_id, digest (of the text, null for null), fp_0, fp_1, ... as signed longs, a row per row.

    Null and blank texts have fingerprint 0. With ``once`` also the number of shingles and their sketch (size, sk_0, ...).
    """
    kind = docs.schema[key].dataType.simpleString()
    names = [f"fp_{i}" for i in range(len(seeds))] + SKETCHED * once

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [_described(t.as_py() or b"", shingle, seeds, once) for t in batch.column(1)]
            columns = [pa.array([_signed(f[0][i]) for f in found], pa.int64()) for i in range(len(seeds))]
            if once:
                sketch = np.array([f[2] for f in found], np.uint8).reshape(-1, SKETCH).view("<i8")
                columns += [pa.array([f[1] for f in found], pa.int64()), *(pa.array(sketch[:, i]) for i in range(SKETCH // 8))]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), *columns], names=["doc_id", "digest", *names])

    body = F.col(f"`{text}`")
    rows = docs.select(
        F.col(f"`{key}`").alias("doc_id"), body.cast("binary").alias("text"), F.unhex(F.md5(body)).alias("digest")
    )
    return rows.mapInArrow(compute, ", ".join([f"doc_id {kind}", "digest binary", *(f"{n} long" for n in names)]))


def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edges that connect what the given edges connect: at most one per node, to the least node of its part."""
    nodes, where = np.unique(np.concatenate([a, b]), return_inverse=True)
    i, j = where[: len(a)], where[len(a) :]
    label = np.arange(len(nodes))
    while True:
        low = np.minimum(label[i], label[j])
        after = label.copy()
        np.minimum.at(after, i, low)
        np.minimum.at(after, j, low)
        np.minimum.at(after, label[i], low)
        np.minimum.at(after, label[j], low)
        after = after[after]
        if (after == label).all():
            break
        label = after
    moved = label != np.arange(len(nodes))
    return nodes[label[moved]], nodes[moved]


def closest_forest(a: np.ndarray, b: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The edges of a spanning forest of least weights: every part takes its lightest way out until none is left."""
    edge = _forest_edges(a, b, weight)
    return a[edge], b[edge]


def _forest_edges(a: np.ndarray, b: np.ndarray, weight: np.ndarray) -> np.ndarray:
    nodes, where = np.unique(np.concatenate([a, b]), return_inverse=True)
    i, j = where[: len(a)], where[len(a) :]
    order = weight.astype(np.int64) * len(a) + np.arange(len(a))  # no two alike
    label, taken = np.arange(len(nodes)), []
    while True:
        la, lb = label[i], label[j]
        out = np.nonzero(la != lb)[0]
        if not len(out):
            break
        best = np.full(len(nodes), np.iinfo(np.int64).max)
        np.minimum.at(best, la[out], order[out])
        np.minimum.at(best, lb[out], order[out])
        edge = np.unique(best[best < np.iinfo(np.int64).max]) % len(a)
        taken.append(edge)
        u, v = forest(la[edge], lb[edge])
        to = np.arange(len(nodes))
        to[v] = u
        label = to[label]
    return np.concatenate(taken) if taken else np.zeros(0, np.int64)


def lightest(a: np.ndarray, b: np.ndarray, weight: np.ndarray, many: int) -> np.ndarray:
    """The edges that are among the ``many`` lightest of one of their ends, and a spanning forest."""
    order = np.argsort(weight, kind="stable")
    end, edge = np.concatenate([a[order], b[order]]), np.concatenate([order, order])
    place = np.tile(np.arange(len(order)), 2)
    by_end = np.lexsort((place, end))
    fresh = np.ones(len(end), bool)
    fresh[1:] = end[by_end][1:] != end[by_end][:-1]
    start = np.nonzero(fresh)[0]
    rank = np.arange(len(end)) - np.repeat(start, np.diff(np.append(start, len(end))))
    return np.unique(np.concatenate([edge[by_end][rank < many], _forest_edges(a, b, weight)]))


def _near(l_: np.ndarray, r_: np.ndarray, prints: list[np.ndarray], part: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Which pairs of different parts are ``most`` flips apart, and the flips of all."""
    differ = np.zeros(len(l_), np.uint16)
    for p in prints:
        differ += np.bitwise_count(p[l_] ^ p[r_])
    return (differ <= most) & (part[l_] != part[r_]), differ


def _out(nodes: np.ndarray, part: np.ndarray, sketch: list[np.ndarray], l_: np.ndarray, r_: np.ndarray, differ: np.ndarray, many: int, least: float):
    """(a, b, more) of the pairs that can resemble each other, as few as ``lightest`` lets out; None where there are none."""
    bytes_ = np.stack(sketch[1:], axis=1).view(np.uint8) if len(l_) else None
    if len(l_):
        ok = may_resemble(bytes_[l_], bytes_[r_], sketch[0][l_] + sketch[0][r_], least)
        l_, r_, differ = l_[ok], r_[ok], differ[ok]
    if not len(l_):
        return None
    a, b = nodes[l_], nodes[r_]
    edge = lightest(part[l_], part[r_], differ, many)
    return np.minimum(a, b)[edge], np.maximum(a, b)[edge], np.full(len(edge), len(edge) < len(a))


def _worded(tables: int, most: int, many: int, least: float, slices: int):
    """Kernel over rows sorted by (word, slice): the pairs of a codeword that share the codeword of the other segment too.

    A row is (word, slice, node, prints, sketch, part). Out come edges (a, b, more), and the rows of keys that have more
    than SIDE_ROWS, or of words that have more than MOST_WORD_ROWS, with their ``key``.
    """
    segments, pairs = QUARTERS
    starts = np.array([segments[b][0] for _, b in pairs], np.uint64)
    bits = np.uint64((1 << segments[0][1]) - 1)

    def keyed(cols: list[np.ndarray], code: Golay) -> tuple[np.ndarray, np.ndarray]:
        word, slice_, first = cols[0], cols[1], cols[3].view(np.uint64)
        other = (first >> starts[(word >> MESSAGE_BITS) % len(pairs)]) & bits
        ids = code.keys(other.astype(np.uint32), True)
        row, place = np.nonzero((ids >= 0) & (ids % slices == slice_[:, None]))
        key = (word[row].astype(np.int64) << MESSAGE_BITS) | ids[row, place]
        order = np.argsort(key, kind="stable")
        return row[order], key[order]

    names = ["a", "b", "more", "key", *_carried()]

    def deferred(cols: list[np.ndarray], row: np.ndarray, key: np.ndarray) -> pa.RecordBatch:
        nothing = pa.nulls(len(row), pa.int64())
        rows = [pa.array(c[row]) for c in cols[2:]]
        return pa.RecordBatch.from_arrays([nothing, nothing, pa.nulls(len(row), pa.bool_()), pa.array(key.astype(np.int32)), *rows], names)

    def edges(a: np.ndarray, b: np.ndarray, more: np.ndarray) -> pa.RecordBatch:
        rest = [pa.nulls(len(a), pa.int32()), *[pa.nulls(len(a), pa.int64()) for _ in _carried()]]
        return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b), pa.array(more), *rest], names)

    def pairs_of(cols: list[np.ndarray], code: Golay) -> Iterator[pa.RecordBatch]:
        row, key = keyed(cols, code)
        start = np.nonzero(np.append(True, key[1:] != key[:-1]))[0]
        sizes = np.diff(np.append(start, len(key)))
        hot = np.repeat(sizes > SIDE_ROWS, sizes)
        if hot.any():
            yield deferred(cols, row[hot], key[hot])
        end = np.repeat(start + sizes, sizes)
        later = np.where(hot, 0, end - np.arange(len(key)) - 1)
        at_, total = np.nonzero(later)[0], np.cumsum(later[later > 0])
        node, prints, sketch, part = cols[2], [c.view(np.uint64) for c in cols[3 : 3 + COMPARED_FIRST]], cols[3 + COMPARED_FIRST : -1], cols[-1]
        at = 0
        while at < len(at_):
            done = total[at - 1] if at else 0
            to = max(at + 1, int(np.searchsorted(total, done + PAIR_BLOCK)))
            p, c = at_[at:to], later[at_[at:to]]
            ramp = np.arange(int(c.sum())) - np.repeat(np.cumsum(c) - c, c)
            l_, r_ = row[np.repeat(p, c)], row[np.repeat(p + 1, c) + ramp]
            ok, differ = _near(l_, r_, prints, part, most)
            found = _out(node, part, sketch, l_[ok], r_[ok], differ[ok], many, least) if ok.any() else None
            if found is not None:
                yield edges(*found)
            at = to

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = Golay()
        held: list[list[np.ndarray]] = []
        rows, wanted, passed = 0, WORD_ROWS, None  # rows held, rows to look at, word that is too long
        for batch in batches:
            if not batch.num_rows:
                continue
            held.append([c.to_numpy(zero_copy_only=False) for c in batch.columns])
            rows += batch.num_rows
            if rows < wanted:
                continue
            cols = [np.concatenate(c) for c in zip(*held, strict=True)]
            fresh = np.nonzero(np.append(True, (cols[0][1:] != cols[0][:-1]) | (cols[1][1:] != cols[1][:-1])))[0]
            if passed is not None and (cols[0][0], cols[1][0]) == passed:
                until = fresh[1] if len(fresh) > 1 else rows
                yield deferred([c[:until] for c in cols], *keyed([c[:until] for c in cols], code))
                cols, fresh = [c[until:] for c in cols], fresh[1:] - until
            cut = int(fresh[-1]) if len(fresh) else 0
            if cut:
                yield from pairs_of([c[:cut] for c in cols], code)
            cols = [c[cut:] for c in cols]
            rows = len(cols[0])
            held, wanted = [cols] if rows else [], max(WORD_ROWS, min(2 * rows, MOST_WORD_ROWS))
            if rows >= MOST_WORD_ROWS:
                passed = cols[0][0], cols[1][0]
                yield deferred(cols, *keyed(cols, code))
                held, rows, wanted = [], 0, 1
            elif rows:
                wanted = wanted if passed is None or (cols[0][0], cols[1][0]) != passed else 1
        if rows:
            cols = [np.concatenate(c) for c in zip(*held, strict=True)]
            mine = (cols[0] == passed[0]) & (cols[1] == passed[1]) if passed is not None else np.zeros(rows, bool)
            if mine.any():
                rest = [c[mine] for c in cols]
                yield deferred(rest, *keyed(rest, code))
                cols = [c[~mine] for c in cols]
            if len(cols[0]):
                yield from pairs_of(cols, code)

    return run


def _carried() -> list[str]:
    return ["node", *(f"print_{i}" for i in range(COMPARED_FIRST)), *SKETCHED, "part"]


def resembling_links(prints: DataFrame, tables: int, most: int, least: float, many: int = 0) -> DataFrame:
    """Edges (a < b, more) of nodes as by ``links`` with ``closest``, of pairs that can have ``least`` of their shingles in common.

    ``prints`` has fp_0, ..., node, part and the sketch. A row goes to the codewords of one segment of each pair of
    segments, with the other segment's only where words have many rows; keys are made and counted where rows meet.
    """
    spark = prints.sparkSession
    held_tables = [f"fp_{i}" for i in range(tables)]
    segments, pairs = QUARTERS
    rows = prints.select(*held_tables, "node", *SKETCHED, "part")
    near = 6  # codewords of a segment, at most
    need = prints.count() * near / (1 << MESSAGE_BITS) / WORD_ROWS
    slices = 1
    while slices < need and slices < 1 << MESSAGE_BITS:
        slices *= 2

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = Golay()

        def words(column: np.ndarray, at: int) -> np.ndarray:
            start, bits = segments[at]
            return code.keys(((column.view(np.uint64) >> np.uint64(start)) & np.uint64((1 << bits) - 1)).astype(np.uint32), True)

        for batch in batches:
            cols = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
            for t in range(tables):
                sent = [tables, *compared(t, tables, True), *range(tables + 1, len(cols))]
                for k, (a, b) in enumerate(pairs):
                    ids = words(cols[t], a)
                    row, place = np.nonzero(ids >= 0)
                    word = ids[row, place]
                    slice_ = np.zeros(len(row), np.int64)
                    if slices > 1:
                        others = words(cols[t], b)[row]
                        one = np.unique(np.where(others >= 0, np.arange(len(row))[:, None] * slices + others % slices, -1))
                        one = one[one >= 0]
                        row, word, slice_ = row[one // slices], word[one // slices], one % slices
                    word = word | ((len(pairs) * t + k) << MESSAGE_BITS)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(word.astype(np.int32)), pa.array(slice_.astype(np.int32)), *(pa.array(cols[i][row]) for i in sent)],
                        names=["word", "slice", *_carried()],
                    )

    longs = ", ".join(f"{n} long" for n in _carried())
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    placed = rows.mapInArrow(emit, f"word int, slice int, {longs}").repartition(parts, "word", "slice").sortWithinPartitions("word", "slice")
    found = placed.mapInArrow(_worded(tables, most, many, least, slices), f"a long, b long, more boolean, key int, {longs}")
    found = written(found, "simhash-met")
    edges = found.where("key is null").select("a", "b", "more")
    hot = found.where("key is not null").select("key", F.lit(3).cast("byte").alias("side"), *_carried())
    if hot.isEmpty():
        return edges
    return edges.unionAll(_dealt(hot, _carried(), COMPARED_FIRST, most, True, many, least))


def _linked(words: int, most: int, closest: bool, many: int, least: float = 0.0):
    """Kernel over rows sorted by (key, deal, side): L rows (side 1, 3) of a key against its R rows (3, 2).

    With ``closest`` rows end in their sketch and the part they belong to; ``more`` says that links of different parts
    stayed here.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] | None = None
        for batch in batches:
            if not batch.num_rows:
                continue
            cols = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
            if held is not None and held[0][0] == cols[0][0] and held[1][0] == cols[1][0]:
                cols = [np.concatenate([h, c]) for h, c in zip(held, cols, strict=True)]
            key, deal, side = cols[:3]
            prints = [c.view(np.uint64) for c in cols[3 + closest : 3 + closest + words]]
            part = cols[-1] if closest else cols[3]
            fresh = np.ones(len(key), bool)
            fresh[1:] = (key[1:] != key[:-1]) | (deal[1:] != deal[:-1])
            group, start = np.cumsum(fresh) - 1, np.nonzero(fresh)[0]
            lefts = np.bincount(group, side != 2, minlength=len(start)).astype(np.int64)
            sizes = np.diff(np.append(start, len(key)))
            right = np.nonzero((side != 1) & (lefts > 0)[group] & (sizes > 1)[group])[0]
            count = lefts[group[right]]
            total = np.cumsum(count)
            at = 0
            while at < len(right):
                done = total[at - 1] if at else 0
                to = max(at + 1, int(np.searchsorted(total, done + PAIR_BLOCK)))
                r, c = right[at:to], count[at:to]
                ramp = np.arange(int(c.sum())) - np.repeat(np.cumsum(c) - c, c)
                l_, r_ = np.repeat(start[group[r]], c) + ramp, np.repeat(r, c)
                ok, differ = _near(l_, r_, prints, part, most)
                if ok.any():
                    l_, r_, differ = l_[ok], r_[ok], differ[ok]
                    if closest:
                        found = _out(cols[3], part, cols[-1 - len(SKETCHED) : -1], l_, r_, differ, many, least)
                        if found is not None:
                            yield pa.RecordBatch.from_arrays([pa.array(x) for x in found], names=["a", "b", "more"])
                    else:
                        a, b = forest(cols[3][l_], cols[3][r_])
                        yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])
                at = to
            last = np.nonzero((group == group[-1]) & (side != 2))[0]
            held = [c[last].copy() for c in cols]
            if len(last):
                held[2] = np.ones(len(last), held[2].dtype)
            else:
                held = None

    return run


def compared(table: int, tables: int, closest: bool) -> list[int]:
    """Tables whose fingerprints are compared under the keys of one: its own and the next, before them the first if it names the row."""
    if closest:
        return list(dict.fromkeys((table + k) % tables for k in range(COMPARED_FIRST)))
    if tables <= COMPARED:
        return list(range(tables))
    own = max(table, 1)
    return [0, *((own - 1 + k) % (tables - 1) + 1 for k in range(COMPARED - 1))]


def links(prints: DataFrame, tables: int = 1, most: int = 3) -> DataFrame:
    """Distinct (fp_0, ...) rows -> edges (a, b) of fp_0 that connect all found fingerprints ``most`` flips apart.

    With ``most`` <= 3 and one table every link is found; flips are counted over ``COMPARED`` tables, all if there are
    no more.
    """
    one_sided = most <= SURE_ONE_SIDED and tables == 1
    held_tables = [f"fp_{i}" for i in range(tables)]
    words = len(compared(0, tables, False))
    names = held_tables[:words]
    longs = ", ".join(f"{n} long" for n in names)

    def emit(sides: tuple[tuple[int, bool], ...], key_only: bool = False):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            code = Golay()
            for batch in batches:
                cols = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
                for side, all_near in sides:
                    for t in range(tables):
                        for lo in range(0, len(cols[0]), 2_000):
                            row, key = pair_keys(cols[t][lo : lo + 2_000].view(np.uint64), t, all_near, code)
                            sent = [] if key_only else compared(t, tables, False)
                            yield pa.RecordBatch.from_arrays(
                                [
                                    pa.array(key.astype(np.int32)),
                                    pa.array(np.full(len(row), side, np.int8)),
                                    *(pa.array(cols[k][lo : lo + 2_000][row]) for k in sent),
                                ],
                                names=["key", "side", *([] if key_only else names)],
                            )

        rows = prints.select(*held_tables)
        return rows.mapInArrow(run, "key int, side byte" + ("" if key_only else f", {longs}"))

    rows = emit(((1, False), (2, True)) if one_sided else ((3, True),))
    return _dealt(rows, names, words, most, False, counted=emit(((1, not one_sided),), True))


def _dealt(
    rows: DataFrame, names: list[str], words: int, most: int, closest: bool, many: int = 0, least: float = 0.0,
    counted: DataFrame | None = None,
) -> DataFrame:
    """Edges of rows (key, side, names) that share a key; keys of more than SIDE_ROWS rows, as ``counted``, are dealt out."""
    spark = rows.sparkSession
    hot = written(
        (rows if counted is None else counted).groupBy(F.col("key").alias("hot_key")).agg(F.count("*").alias("n"))
        .where(F.col("n") > SIDE_ROWS).select("hot_key", F.ceil(F.col("n") / SIDE_ROWS).cast("int").alias("deals")),
        "simhash-hot",
    )
    if hot.isEmpty():
        dealt = rows.withColumn("deal", F.lit(0))
    else:
        met = rows.join(hot, F.col("key") == F.col("hot_key"), "left").withColumn("deals", F.coalesce("deals", F.lit(1)))
        own = F.pmod(F.xxhash64(names[0]), F.col("deals")).cast("int")
        everywhere = F.sequence(F.lit(0), F.col("deals") - 1)
        dealt = met.withColumn("own", own).withColumn(
            "deal", F.explode(F.when(F.col("side") == 1, F.array("own")).otherwise(everywhere))
        ).withColumn(
            "side", F.when((F.col("side") == 3) & (F.col("deal") != F.col("own")), F.lit(2)).otherwise(F.col("side")).cast("byte")
        )
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    order = F.when(F.col("side") == 3, 1.5).otherwise(F.col("side"))
    placed = dealt.select("key", "deal", "side", *names).repartition(parts, "key", "deal").sortWithinPartitions(
        "key", "deal", order
    )
    return placed.mapInArrow(_linked(words, most, closest, many, least), "a long, b long" + ", more boolean" * closest)


def resemblance(a: str, b: str, shingle: int) -> float:
    """Jaccard similarity of the word shingles of two texts, A-Z lower-cased."""

    def shingles(text: str) -> set[bytes]:
        found = text.encode().lower().split()
        return {b" ".join(found[i : i + shingle]) for i in range(max(1, len(found) - shingle + 1))} if found else set()

    x, y = shingles(a), shingles(b)
    return len(x & y) / len(x | y) if x or y else 1.0


def _verified(edges: DataFrame, nodes: DataFrame, docs: DataFrame, text: str, shingle: int, least: float) -> DataFrame:
    """The edges (of nodes, which have the digest of a text each) whose texts resemble each other."""
    digest = nodes.select(F.col("node").alias("f"), "digest")
    both = edges.join(digest, F.col("a") == F.col("f")).select("a", "b", F.col("digest").alias("da"))
    both = written(
        both.join(digest, F.col("b") == F.col("f")).select("a", "b", "da", F.col("digest").alias("db")), "simhash-candidates"
    )
    wanted = written(both.select(F.explode(F.array("da", "db")).alias("k")).distinct(), "simhash-wanted")
    plain = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    body = docs.select(F.unhex(F.md5(plain)).alias("d"), plain.alias("body"))
    texts = maybe_listed(body, F.col("d"), wanted, "k").join(wanted, F.col("d") == F.col("k"), "left_semi")
    texts = written(texts.dropDuplicates(["d"]), "simhash-texts")
    left = both.join(texts, F.col("da") == F.col("d")).select("a", "b", "db", F.col("body").alias("left"))
    pairs = left.join(texts, F.col("db") == F.col("d")).select("a", "b", "left", "body")

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ok = [resemblance(x.as_py(), y.as_py(), shingle) >= least for x, y in zip(batch.column(2), batch.column(3), strict=True)]
            yield batch.select(["a", "b"]).filter(pa.array(ok, pa.bool_()))

    return pairs.mapInArrow(check, "a long, b long")


def _resembling(firsts: DataFrame, docs: DataFrame, text: str, tables: int, shingle: int, most: int, least: float) -> DataFrame:
    """Edges of ``resembling_links`` that hold, enough of them to connect whatever any pair under a key connects.

    The first round tests a forest. Groups of it that still have several parts, and of which a task left out a pair,
    are compared again; every round lets out more pairs of each part, so that it ends with all pairs of different parts
    tested.
    """
    names = [f"fp_{i}" for i in range(tables)]
    nodes = firsts.select("node", "digest")
    found = written(resembling_links(firsts.withColumn("part", F.col("node")), tables, most, least), "simhash-links")
    tested = written(found.select("a", "b").distinct(), "simhash-tested")
    true = written(_verified(tested, nodes, docs, text, shingle, least), "simhash-verified")
    group = written(components(tested).withColumnRenamed("component", "group"), "simhash-groups")
    many = SECOND_ROUND
    while True:
        reach = components(true).select(F.col("node").alias("n"), F.col("component"))
        label = written(
            group.join(reach, F.col("node") == F.col("n"), "left").select(
                F.col("node").alias("l"), "group", F.coalesce("component", "node").alias("part")
            ),
            "simhash-labels",
        )
        several = label.groupBy("group").agg(F.min("part").alias("p"), F.max("part").alias("q")).where("p <> q")
        cut = found.where("more").select(F.col("a").alias("n")).distinct().join(group, F.col("n") == F.col("node"))
        again = written(several.join(cut.select("group").distinct(), "group").select("group"), "simhash-again")
        if again.isEmpty():
            return true
        active = label.join(again, "group").join(firsts.drop("digest"), F.col("l") == F.col("node")).select(*names, "node", *SKETCHED, "part")
        found = written(resembling_links(written(active, "simhash-active"), tables, most, least, many), "simhash-links")
        fresh = written(found.select("a", "b").distinct().join(tested, ["a", "b"], "left_anti"), "simhash-fresh")
        true = written(true.unionAll(_verified(fresh, nodes, docs, text, shingle, least)), "simhash-verified")
        tested = written(tested.unionAll(fresh), "simhash-tested")
        many *= SECOND_ROUND


def classes(
    docs: DataFrame, key: str, text: str, shingle: int, seeds: tuple[int, ...], most: int, resembling: float | None
) -> DataFrame:
    """doc_id, digest (of the text, null for null), fp_0, ..., part: rows of one part are near-duplicates.

    With ``resembling`` a node is a text and two texts are of one part only through links whose shingles were compared;
    a null text is the empty one there. Without, a node is a fingerprint.
    """
    names = [f"fp_{i}" for i in range(len(seeds))]
    printed = written(fingerprints(docs, key, text, shingle, seeds, once=resembling is not None), "simhash-prints")
    if resembling is None:
        firsts = written(printed.groupBy("fp_0").agg(F.count("*").alias("rows"), *[F.min(n).alias(n) for n in names[1:]]), "simhash-distinct")
        edges = written(links(firsts.select(*names), len(seeds), most), "simhash-links")
        own, of = F.col("fp_0"), F.col("fp_0")
    else:
        own = F.coalesce("digest", F.unhex(F.md5(F.lit(""))))
        # prints without sketches can be of any shingles
        printed = printed.withColumns({c: F.lit(-1).cast("long") for c in SKETCHED if c not in printed.columns})
        texts = printed.groupBy(own.alias("digest")).agg(*[F.min(n).alias(n) for n in [*names, *SKETCHED]])
        firsts = written(texts.withColumn("node", F.monotonically_increasing_id()), "simhash-distinct")
        edges = _resembling(firsts, docs, text, len(seeds), shingle, most, resembling)
        of = F.col("digest")
    reach = components(edges).select(F.col("node").alias("n"), "component")
    name = F.col("fp_0" if resembling is None else "node")
    part = firsts.join(reach, name == F.col("n"), "left").select(of.alias("f"), F.coalesce(F.col("component"), name).alias("part"))
    return printed.select("doc_id", "digest", *names).join(written(part, "simhash-parts"), own == F.col("f")).drop("f")


def near_duplicates(
    docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = 3, seeds: tuple[int, ...] = (SEED,), most: int = 3,
    resembling: float | None = None,
) -> DataFrame:
    """doc_id, fp_0, ..., component_id: the least doc_id among the documents that links of fingerprints reach.

    A row per row. Fingerprints link at ``most`` differing bits, over all seeds; with ``resembling`` links also need
    that share of common shingles. Null and blank texts have fingerprint 0 and link like any other; null ids are
    members but never name a component unless all its ids are null; an empty table gives an empty result.
    """
    member = written(classes(docs, key, text, shingle, seeds, most, resembling), "simhash-members")
    least = written(member.groupBy(F.col("part").alias("p")).agg(F.min("doc_id").alias("component_id")), "simhash-least")
    names = [f"fp_{i}" for i in range(len(seeds))]
    return member.join(least, F.col("part") == F.col("p")).select("doc_id", *names, "component_id")


def one_of_each(
    docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = 5,
    seeds: tuple[int, ...] = tuple(range(SEED, SEED + 5)), most: int = 37, resembling: float = 0.8,
) -> DataFrame:
    """The rows without near-duplicates: of each group the one with the least id (then digest of the text) stays.

    Five fingerprints of 64 bits by default, each of two keys: texts that share a key and differ in at most ``most`` bits
    of the two fingerprints that are compared under it are compared by their shingles, those of equal fingerprints too.
    Texts of equal size that have 0.8 of their shingles in common differ in 19 of 128 bits, standard deviation 4, and
    share no key of one fingerprint in 13 to 15 % of cases, of five in 0.01 %. Null texts are empty, and one of the empty and blank
    texts stays. Other columns stay as they are, whatever their names; rows equal in id and text are one row.
    """
    member = classes(docs, key, text, shingle, seeds, most, resembling).select("doc_id", "digest", "part")
    order = F.struct(F.col("doc_id").isNull().alias("n"), "doc_id", F.coalesce("digest", F.lit(b"")).alias("digest"))
    member = written(member.select("part", order.alias("k")), "simhash-members")
    first = member.groupBy(F.col("part").alias("p")).agg(F.min("k").alias("first"))
    # rows to look at: those that go, and those of one id and text of which one stays
    same = member.groupBy("part", "k").agg(F.count("*").alias("n")).join(first, F.col("part") == F.col("p"))
    checked = same.where("n > 1 or k <> first").select(
        F.col("k.doc_id").alias("k_id"), F.col("k.digest").alias("k_digest"), (F.col("k") == F.col("first")).alias("stays")
    )
    checked = written(checked.withColumn("k_hash", F.xxhash64("k_digest", "k_id")), "simhash-checked")
    names = docs.columns
    row = F.struct(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(names)]).alias("row_")
    rows = docs.select(
        row, F.col(f"`{key}`").alias("id_"), F.coalesce(F.unhex(F.md5(F.col(f"`{text}`"))), F.lit(b"")).alias("digest_")
    )
    hashes = written(checked.select("k_hash").distinct(), "simhash-hashes")
    rows = rows.withColumn("hash_", F.xxhash64("digest_", "id_"))
    bloom, blocks = bloom_table(hashes, "k_hash")
    flagged = flag_listed(rows, F.col("hash_"), bloom, blocks, "may_")
    here = (F.col("digest_") == F.col("k_digest")) & F.col("id_").eqNullSafe(F.col("k_id"))
    looked = flagged.where("may_").join(checked, here, "left").where("stays or stays is null")
    once = flagged.where("not may_").select("row_").unionAll(
        looked.where("stays is null").select("row_")
    ).unionAll(looked.where("stays").dropDuplicates(["digest_", "id_"]).select("row_"))
    return once.select(*[F.col("row_")[f"c{i}"].alias(c) for i, c in enumerate(names)])


def query(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return near_duplicates(docs).select(
        "doc_id", F.lower(F.lpad(F.hex("fp_0"), 16, "0")).alias("fingerprint"), "component_id"
    )
