"""Removal of byte strings that occur anywhere else, by suffix sorting of what may repeat.

Every window of 200 bytes names an anchor: the 32-byte gram in it with the least hash. Equal windows have equal
anchors, so a window whose anchor's gram occurs nowhere else cannot repeat; that settles most of a corpus with a few
rows per document. Neighbouring windows of one anchor form a stretch. If all stretches of a gram are equal, all their
windows repeat. The stretches of the other grams (the borders of repeated passages) are dealt out by gram into shards,
one of each text. A stretch is trimmed to the windows that can repeat at all: what lies before and after the gram has
its longest match in the gram's other stretches next to it in sorted order, once from the gram on and once backwards.
Stretches that are equal after that repeat whole and one of them stands for all. The shard's suffixes are then put in order by external induced sorting, which carries their common prefixes, and
windows that share 200 bytes with a neighbour in that order repeat. Grams with very many different
stretches are settled window by window in a grouped count instead, so no shard grows with a gram.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written
from .induced_sort import Folder, suffix_order
from .url_filter import maybe_listed

WINDOW = 200
GRAM = 32
#: Bytes of text hashed at once.
PIECE = 1 << 20
#: Stretches are trimmed at the end of the gram that brings them to so many bytes.
TRIM_BYTES = 4 << 20
#: A shard is sorted when what trimming left of it has so many bytes.
SHARD_BYTES = 2 << 20
#: Bytes of stretches that are worth a task of their own.
TASK_BYTES = 8 << 20
#: Grams with more different stretches than a shard holds are counted window by window.
HOT_STRETCHES = 8_192
#: Windows written at once by that count.
WINDOW_ROWS = 20_000

_BASE, _MIX = np.uint64(0xD6E8FEB86659FD93), np.uint64(0x9E3779B97F4A7C15)
_PLACE_BITS = 21
_PLACES = np.uint64((1 << _PLACE_BITS) - 1)


def gram_hashes(data: np.ndarray) -> np.ndarray:
    """64-bit hash of the GRAM bytes from each place on, by doubling the length."""
    h = (data.astype(np.uint64) + np.uint64(1)) * _MIX
    h ^= h >> np.uint64(31)
    size, factor = 1, int(_BASE)
    while size < GRAM:
        h = h[: len(h) - size] * np.uint64(factor) + h[size:]
        size, factor = 2 * size, factor * factor % (1 << 64)
    h ^= h >> np.uint64(32)
    h *= _MIX
    h ^= h >> np.uint64(29)
    return h


def window_anchors(h: np.ndarray, window: int = WINDOW) -> np.ndarray:
    """Place of the least gram hash in each window; the first of equal ones."""
    reach = window - GRAM + 1
    count = len(h) - reach + 1
    if count <= 0:
        return np.zeros(0, np.int64)
    both = (h & ~_PLACES) | np.arange(len(h), dtype=np.uint64)
    full = -(-len(h) // reach) * reach
    table = np.full(full, np.iinfo(np.uint64).max, np.uint64)
    table[: len(h)] = both
    table = table.reshape(-1, reach)
    forward = np.minimum.accumulate(table, axis=1).reshape(-1)
    backward = np.minimum.accumulate(table[:, ::-1], axis=1)[:, ::-1].reshape(-1)
    return (np.minimum(backward[:count], forward[reach - 1 : reach - 1 + count]) & _PLACES).astype(np.int64)


def _pieces(lengths: list[int]) -> Iterator[list[tuple[int, int, int]]]:
    """Groups of (text, from, to) of about PIECE bytes; long texts go in parts that overlap by a window less one."""
    group: list[tuple[int, int, int]] = []
    size = 0
    for i, n in enumerate(lengths):
        if n < WINDOW:
            continue
        for lo in range(0, n - WINDOW + 1, PIECE):
            hi = min(n, lo + PIECE + WINDOW - 1)
            if size and size + hi - lo > PIECE:
                yield group
                group, size = [], 0
            group.append((i, lo, hi))
            size += hi - lo
    if group:
        yield group


def stretches(texts: list[bytes], window: int = WINDOW) -> Iterator[tuple[np.ndarray, ...]]:
    """(text, first window, last window, hash of the anchor's gram, hash of the stretch's bytes, place of the gram
    behind the first window's start) of all windows."""
    import xxhash

    for group in _pieces([len(t) for t in texts]):
        parts = [memoryview(texts[i])[lo:hi] for i, lo, hi in group]
        joined = b"".join(parts)
        sizes = np.array([len(p) for p in parts])
        starts = np.cumsum(sizes) - sizes
        h = gram_hashes(np.frombuffer(joined, np.uint8))
        anchor = window_anchors(h, window)
        inside = np.zeros(len(anchor) + 1, np.int32)
        np.add.at(inside, starts, 1)
        np.add.at(inside, np.minimum(starts + sizes - window + 1, len(anchor)), -1)
        at = np.nonzero(np.cumsum(inside[:-1]) > 0)[0]  # windows that don't cross into the next text
        a = anchor[at]
        fresh = np.ones(len(at), bool)
        fresh[1:] = (a[1:] != a[:-1]) | (at[1:] != at[:-1] + 1)
        head = np.nonzero(fresh)[0]
        first, last = at[head], at[np.append(head[1:], len(at)) - 1]
        owner = np.searchsorted(starts, first, side="right") - 1
        view = memoryview(joined)
        content = np.array(
            [xxhash.xxh3_64_intdigest(view[b : e + window]) for b, e in zip(first.tolist(), last.tolist(), strict=True)], np.uint64
        )
        text = np.array([g[0] for g in group])[owner]
        shift = np.array([g[1] for g in group])[owner] - starts[owner]
        yield text, first + shift, last + shift, h[a[head]].view(np.int64), content.view(np.int64), a[head] - first


STRETCH = "doc binary, first int, last int, gram long, content long, at int"


def stretch_rows(bodies: DataFrame) -> DataFrame:
    """(doc, body) -> a row per stretch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            docs = batch.column(0)
            for text, first, last, gram, content, at in stretches(batch.column(1).to_pylist()):
                yield pa.RecordBatch.from_arrays(
                    [
                        docs.take(pa.array(text)),
                        pa.array(first.astype(np.int32)),
                        pa.array(last.astype(np.int32)),
                        pa.array(gram),
                        pa.array(content),
                        pa.array(at.astype(np.int32)),
                    ],
                    names=["doc", "first", "last", "gram", "content", "at"],
                )

    return bodies.mapInArrow(run, STRETCH)


def _spans(places: np.ndarray) -> list[dict]:
    """Runs of consecutive places."""
    if not len(places):
        return []
    cut = np.nonzero(np.diff(places) != 1)[0]
    return [
        {"a": int(a), "b": int(b)}
        for a, b in zip(places[np.append(0, cut + 1)].tolist(), places[np.append(cut, len(places) - 1)].tolist(), strict=True)
    ]


def shard_repeats(contents: list[bytes], window: int = WINDOW) -> list[np.ndarray]:
    """Places in each content whose window occurs at another place of the shard."""
    sizes = np.array([len(c) for c in contents])
    text = np.ones(int(sizes.sum()) + len(contents) + 1, np.int16)  # 1 ends a content, 0 the text
    text[-1] = 0
    starts = np.cumsum(sizes + 1) - sizes - 1
    inside = np.ones(len(text), bool)
    inside[starts + sizes] = False
    inside[-1] = False
    text[inside] = np.frombuffer(b"".join(contents), np.uint8).astype(np.int16) + 2
    found = np.zeros(len(text), bool)
    folder = Folder()
    last = -1
    for part in suffix_order(text, folder, most=window):
        hit = np.nonzero(part["common"] >= window)[0]
        found[part["at"][hit]] = True
        found[part["at"][hit[hit > 0] - 1]] = True
        if len(hit) and hit[0] == 0:
            found[last] = True
        last = int(part["at"][-1])
    folder.close()
    places = np.nonzero(found)[0]
    owner = np.searchsorted(starts, places, side="right") - 1
    whole = places + window <= starts[owner] + sizes[owner]  # not those that reach into the next content
    places, owner = places[whole], owner[whole]
    cut = np.searchsorted(owner, np.arange(len(contents) + 1))
    return [places[a:b] - start for a, b, start in zip(cut[:-1], cut[1:], starts, strict=True)]


class Shard:
    """Trimmed stretches of one task, gram by gram, and the contents that are still to be sorted.

    Stretches that trimming made equal repeat whole, and one of them stands for all in the sort. A gram that is left
    with one content needs no sort: the windows of a stretch hold its gram at different places, so none equals another.
    """

    def __init__(self, window: int = WINDOW):
        self.window = window
        self.open: dict[tuple[int, bytes], list[tuple[int, int]]] = {}
        self.size = 0

    def add(self, grams: list[int], keys: list[int], places: list[int], bodies: list[bytes]) -> Iterator[tuple[int, int, np.ndarray]]:
        """Takes all stretches of some grams; (gram, content, places of repeated windows) of those that are settled."""
        if not bodies:
            return
        first, last = possible_windows(grams, places, bodies, self.window)
        same: dict[tuple[int, bytes], list[tuple[int, int]]] = {}
        for i in np.nonzero(first <= last)[0].tolist():
            same.setdefault((grams[i], bodies[i][first[i] : last[i] + self.window]), []).append((keys[i], int(first[i])))
        contents: dict[int, int] = {}
        for gram, _ in same:
            contents[gram] = contents.get(gram, 0) + 1
        for (gram, piece), users in same.items():
            if len(users) > 1:
                whole = np.arange(len(piece) - self.window + 1)
                yield from ((gram, key, whole + start) for key, start in users)
            if contents[gram] > 1:
                self.open[gram, piece] = users if len(users) == 1 else []
                self.size += len(piece)

    def sort(self) -> Iterator[tuple[int, int, np.ndarray]]:
        """The same of the contents that waited for the sort; the shard is empty after it."""
        if self.open:
            found = shard_repeats([piece for _, piece in self.open], self.window)
            for ((gram, _), users), at in zip(self.open.items(), found, strict=True):
                yield from ((gram, key, at + start) for key, start in users if len(at))
        self.open, self.size = {}, 0


def possible_windows(grams: list[int], places: list[int], contents: list[bytes], window: int = WINDOW) -> tuple[np.ndarray, np.ndarray]:
    """First and last window of each content that can occur in another content of its gram; first > last for none.

    ``places`` says where the gram lies in a content. A window reaches to the left and to the right of the gram; either
    part has to be there in some other content.
    """
    n = len(contents)
    group = np.unique(np.array(grams), return_inverse=True)[1]
    size, at = np.array([len(c) for c in contents]), np.array(places)
    reach = []
    for backwards in (True, False):
        table = np.zeros((n, 4 + window), np.uint8)
        table[:, :4] = group.astype(">u4").view(np.uint8).reshape(n, 4)
        for i, (c, p) in enumerate(zip(contents, places, strict=True)):
            side = c[:p][::-1][:window] if backwards else c[p : p + window]
            table[i, 4 : 4 + len(side)] = np.frombuffer(side, np.uint8)
        there = np.minimum(at if backwards else size - at, window)
        order = np.argsort(table.view(f"S{table.shape[1]}").ravel(), kind="stable")
        i, j = order[:-1], order[1:]
        alike = group[i] == group[j]
        i, j = i[alike], j[alike]
        differ = table[i, 4:] != table[j, 4:]
        common = np.where(differ.any(axis=1), differ.argmax(axis=1), window)
        common = np.minimum(common, np.minimum(there[i], there[j]))
        longest = np.zeros(n, np.int64)
        np.maximum.at(longest, i, common)
        np.maximum.at(longest, j, common)
        reach.append(longest)
    left, right = reach
    return np.maximum(at - left, 0), np.minimum(at + right, size) - window


SPANS = "array<struct<a:int,b:int>>"


def _sorted_shards(rows: DataFrame, size: int) -> DataFrame:
    """(gram, content, at, body), dealt by gram and sorted -> (gram, content, spans of repeated windows).

    ``size`` is the bytes of all bodies: it says how few tasks are worth while, the session's setting says how many at most.
    """
    kinds = pa.list_(pa.struct([("a", pa.int32()), ("b", pa.int32())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: tuple[list, list, list, list] = ([], [], [], [])
        size = 0
        shard = Shard()

        def told(found: Iterator[tuple[int, int, np.ndarray]]) -> pa.RecordBatch:
            out = [(gram, key, _spans(at)) for gram, key, at in found]
            columns = [pa.array([o[k] for o in out], t) for k, t in enumerate((pa.int64(), pa.int64(), kinds))]
            return pa.RecordBatch.from_arrays(columns, names=["gram", "content", "spans"])

        for batch in batches:
            for row in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
                if size >= TRIM_BYTES and row[0] != held[0][-1]:
                    yield told(shard.add(*held))
                    held, size = ([], [], [], []), 0
                    if shard.size >= SHARD_BYTES:
                        yield told(shard.sort())
                for column, value in zip(held, row, strict=True):
                    column.append(value)
                size += len(row[3])
        yield told(shard.add(*held))
        yield told(shard.sort())

    most = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    parts = max(1, min(most, -(-size // TASK_BYTES)))
    dealt = rows.select("gram", "content", "at", "body").repartition(parts, "gram").sortWithinPartitions("gram")
    return dealt.mapInArrow(run, f"gram long, content long, spans {SPANS}")


def _window_counts(rows: DataFrame) -> DataFrame:
    """The same for grams with very many stretches: every window is a row, equal ones are counted."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.int64(), pa.int64(), pa.int32(), pa.binary()]
        rows: list[tuple] = []

        def full() -> pa.RecordBatch:
            columns = [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)]
            rows.clear()
            return pa.RecordBatch.from_arrays(columns, names=["gram", "content", "place", "digest"])

        for batch in batches:
            for gram, key, body in zip(*(batch.column(i) for i in range(3)), strict=True):
                g, k, text = gram.as_py(), key.as_py(), body.as_py()
                rows.extend(
                    (g, k, i, hashlib.blake2b(text[i : i + WINDOW], digest_size=16).digest()) for i in range(len(text) - WINDOW + 1)
                )
                if len(rows) >= WINDOW_ROWS:
                    yield full()
        if rows:
            yield full()

    each = rows.select("gram", "content", "body").mapInArrow(cut, "gram long, content long, place int, digest binary")
    each = written(each, "hot-windows")
    twice = written(
        each.groupBy("digest").agg(F.count("*").alias("n")).where("n > 1").select(F.col("digest").alias("d")), "hot-repeats"
    )
    return (
        each.join(twice, F.col("digest") == F.col("d"))
        .groupBy("gram", "content")
        .agg(F.sort_array(F.collect_list(F.struct(F.col("place").alias("a"), F.col("place").alias("b")))).cast(SPANS).alias("spans"))
    )


def bodies_of(docs: DataFrame, text: str = "text") -> DataFrame:
    """The rows with ``body`` (bytes; none for null) and ``doc`` (its digest: copies of a text share it)."""
    body = F.coalesce(F.col(f"`{text}`"), F.lit("")).cast("binary")
    return docs.withColumn("body", body).withColumn("doc", F.unhex(F.md5("body")))


def repeated_windows(docs: DataFrame, text: str = "text", hot: int = HOT_STRETCHES) -> DataFrame:
    """(doc, spans): for each text that has any, the first and last of runs of windows that occur anywhere else.

    A window counts as occurring elsewhere also in the same text or in a copy of it. ``doc`` is the digest of the
    text. Null, empty and short texts have no windows; an empty table gives an empty result.
    """
    bodies = bodies_of(docs.select(text), text).select("doc", "body")
    rows = written(stretch_rows(bodies.where(F.octet_length("body") >= WINDOW)), "stretches")
    grams = written(
        rows.groupBy(F.col("gram").alias("g")).agg(F.count("*").alias("n"), (F.min("content") != F.max("content")).alias("differ"))
        .where("n > 1").select("g", "differ"),
        "repeated-grams",
    )
    rows = maybe_listed(rows, F.col("gram"), grams, "g").join(grams, F.col("gram") == F.col("g")).drop("g")
    rows = written(rows, "repeated-stretches")
    whole = rows.where("not differ").select("doc", "first", "last")
    border = rows.where("differ")

    # one stretch of each text that is left
    kinds = border.groupBy("gram", "content").agg(F.count("*").alias("n"), F.min(F.struct("doc", "first", "last", "at")).alias("where"))
    kinds = written(kinds.select("gram", "content", "n", "where.*"), "stretch-kinds")
    many = kinds.groupBy(F.col("gram").alias("g")).agg(F.count("*").alias("kinds")).where(F.col("kinds") > hot).select("g")
    many = written(many, "hot-grams")
    wanted = written(kinds.select(F.col("doc").alias("k")).distinct(), "stretch-docs")
    sources = maybe_listed(bodies, F.col("doc"), wanted, "k").select(F.col("doc").alias("d"), "body")
    cut = (
        kinds.join(sources, F.col("doc") == F.col("d"))
        .select("gram", "content", "at", F.substring("body", F.col("first") + 1, F.col("last") - F.col("first") + WINDOW).alias("body"))
        .dropDuplicates(["gram", "content"])
    )
    cut = written(cut, "stretch-bodies")
    size = kinds.agg(F.coalesce(F.sum((F.col("last") - F.col("first") + WINDOW).cast("long")), F.lit(0))).first()[0]
    if many.isEmpty():
        found = _sorted_shards(cut, size)
    else:
        found = _sorted_shards(cut.join(many, F.col("gram") == F.col("g"), "left_anti"), size).unionAll(
            _window_counts(cut.join(many, F.col("gram") == F.col("g"), "left_semi"))
        )
    several = kinds.where("n > 1").select(
        F.col("gram").alias("g"), F.col("content").alias("c"),
        F.array(F.struct(F.lit(0).alias("a"), (F.col("last") - F.col("first")).alias("b"))).cast(SPANS).alias("spans"),
    )
    found = written(found.select(F.col("gram").alias("g"), F.col("content").alias("c"), "spans").unionAll(several), "stretch-spans")
    partly = border.join(found, (F.col("gram") == F.col("g")) & (F.col("content") == F.col("c"))).select(
        "doc", "first", F.explode("spans").alias("s")
    ).select("doc", (F.col("first") + F.col("s.a")).alias("first"), (F.col("first") + F.col("s.b")).alias("last"))
    marks = whole.unionAll(partly).groupBy("doc").agg(F.array_sort(F.collect_set(F.struct("first", "last"))).alias("spans"))
    return written(marks, "repeated-windows")


def removed_runs(spans: list[dict], window: int = WINDOW) -> list[tuple[int, int]]:
    """Maximal runs of bytes that windows starting in the spans (in order of their first) cover."""
    runs: list[list[int]] = []
    for s in spans:
        begin, end = s["first"], s["last"] + window
        if runs and begin <= runs[-1][1]:
            runs[-1][1] = max(runs[-1][1], end)
        else:
            runs.append([begin, end])
    return [(b, e) for b, e in runs]


def kept_bytes(body: bytes, runs: list[tuple[int, int]]) -> bytes:
    at, out = 0, []
    for begin, end in runs:
        out.append(body[at:begin])
        at = end
    out.append(body[at:])
    return b"".join(out)


CUT = "doc binary, n_removed long, n_spans long, kept binary"


def cut_texts(docs: DataFrame, text: str = "text") -> DataFrame:
    """(doc, n_removed, n_spans, kept): what is left of each text that loses something, once for all its copies.

    ``doc`` is the digest of the text (see ``bodies_of``).
    """
    marks = repeated_windows(docs, text)
    bodies = bodies_of(docs.select(text), text).select("doc", "body")
    near = maybe_listed(bodies, F.col("doc"), marks, "doc")
    hit = near.join(marks.withColumnRenamed("doc", "m_doc"), F.col("doc") == F.col("m_doc")).select("doc", "body", "spans")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            runs = [removed_runs(s) for s in batch.column(2).to_pylist()]
            bodies = batch.column(1)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array([sum(e - b for b, e in r) for r in runs], pa.int64()),
                    pa.array([len(r) for r in runs], pa.int64()),
                    pa.array([kept_bytes(b.as_py(), r) for b, r in zip(bodies, runs, strict=True)], pa.binary()),
                ],
                names=["doc", "n_removed", "n_spans", "kept"],
            )

    return written(hit.mapInArrow(run, CUT), "cut-texts").dropDuplicates(["doc"])


def digests(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 of every row, repeated passages removed.

    A null text is empty. Rows of equal text have equal results; null and repeated ids are rows like any other.
    """
    rows = bodies_of(docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text")), "text").select(
        "doc_id", "doc", F.octet_length("body").cast("long").alias("n_bytes"), F.sha2("body", 256).alias("whole")
    )
    cut = written(
        cut_texts(docs, text).select(F.col("doc").alias("c_doc"), "n_removed", "n_spans", F.sha2("kept", 256).alias("part")),
        "cut-digests",
    )
    return rows.join(cut, F.col("doc") == F.col("c_doc"), "left").select(
        "doc_id",
        "n_bytes",
        F.coalesce("n_removed", F.lit(0)).alias("n_removed"),
        F.coalesce("n_spans", F.lit(0)).alias("n_spans"),
        F.coalesce("part", "whole").alias("kept_sha256"),
    )


def without_repeats(docs: DataFrame, text: str = "text") -> DataFrame:
    """The rows with repeated passages cut from ``text``; halves of characters that a cut leaves go too.

    Other columns stay as they are, whatever their names, and so do texts without a repeat and null texts.
    """
    names = docs.columns
    cut = cut_texts(docs, text).select(
        F.col("doc").alias("c_doc"), F.try_validate_utf8(F.col("kept").cast("string")).alias("plain"), F.col("kept").cast("string").alias("kept_")
    )
    cut = written(cut.select("c_doc", F.coalesce("plain", F.make_valid_utf8("kept_")).alias("kept_text")), "cut-documents")
    row = F.struct(*[F.col(f"`{c}`").alias(f"c{k}") for k, c in enumerate(names)]).alias("row_")
    body = F.coalesce(F.col(f"`{text}`"), F.lit("")).cast("binary")
    keyed = docs.select(row, F.unhex(F.md5(body)).alias("doc"))
    joined = keyed.join(cut, F.col("doc") == F.col("c_doc"), "left")
    place = names.index(text)
    return joined.select(
        *[
            (F.coalesce("kept_text", F.col("row_")[f"c{k}"]) if k == place else F.col("row_")[f"c{k}"]).alias(c)
            for k, c in enumerate(names)
        ]
    )


def query(spark, sf_dir):
    return digests(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))


ORACLE = r"""
with d as (
  select row_number() over () as r, doc_id, encode(coalesce(text, '')) as b from documents
), w as (
  select r, s, md5(hex(array_slice(b, s + 1, s + 200))) as k
  from (select r, b, unnest(range(0, octet_length(b) - 199)) as s from d where octet_length(b) >= 200)
), m as (
  select r, s from w where k in (select k from w group by k having count(*) > 1)
), g as (
  select r, s, lag(s) over (partition by r order by s) as before, lead(s) over (partition by r order by s) as after from m
), n as (
  select r, cast(sum(least(200, coalesce(after - s, 200))) as bigint) as n_removed,
         cast(sum(case when before is null or s - before > 200 then 1 else 0 end) as bigint) as n_spans from g group by r
), starts as (
  select r, s, row_number() over (partition by r order by s) as k from g where before is null or s - before > 200
), ends as (
  select r, s + 200 as e, row_number() over (partition by r order by s) as k from g where after is null or after - s > 200
), holes as (
  select r, e as lo, k from ends union all select distinct r, 0 as lo, 0 as k from starts
), kept as (
  select h.r, string_agg(hex(array_slice(d.b, h.lo + 1, coalesce(x.s, octet_length(d.b)))), '' order by h.k) as rest
  from holes h join d on d.r = h.r left join starts x on x.r = h.r and x.k = h.k + 1 group by h.r
)
select d.doc_id, octet_length(d.b) as n_bytes, coalesce(n.n_removed, 0) as n_removed, coalesce(n.n_spans, 0) as n_spans,
       case when n.r is null then sha256(d.b) else sha256(unhex(kept.rest)) end as kept_sha256
from d left join n on n.r = d.r left join kept on kept.r = d.r
"""
