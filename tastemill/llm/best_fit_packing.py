"""Documents packed into sequences of tokens by a configuration linear program over the histogram of piece lengths.

Documents longer than a sequence are cut, all others stay whole. Lengths are all that the program needs: Spark counts
them, the driver solves for kinds of sequences (``packing_plan``, bounded by the capacity), and every piece finds its
sequence from its length and its number among the pieces of that length. Pieces are numbered where they are encoded, by
part; only counts per part and length are added up, so no task holds all pieces of a length and texts never move.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import table, written
from .packing_plan import Plan, plan
from .word_tokens import encoder

CAPACITY = 2048
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long, part int, number long"


def pieces(
    docs: DataFrame, vocabulary: str, end_id: int, capacity: int = CAPACITY, key: str = "doc_id", text: str = "text", ids: bool = False
) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, part, number [, ids]: the pieces of every text's ids and ``end_id``.

    ``number`` counts the pieces of one length within a part from 0. ``ids`` are little-endian 32-bit integers.
    """
    body = F.coalesce(F.col(f"`{text}`"), F.lit("")).cast("binary")
    rows = docs.select(F.col(f"`{key}`").cast("long").alias("doc_id"), body.alias("body"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        ids_of = encoder(vocabulary)
        tail = np.array([end_id], ids_of.kind).tobytes()
        seen = np.zeros(capacity + 1, np.int64)
        for batch in batches:
            for lo in range(0, batch.num_rows, 1_000):
                some = batch.slice(lo, 1_000)
                raw = [np.frombuffer(ids_of(t.as_py()) + tail, ids_of.kind).astype("<u4") for t in some.column(1)]
                count = np.array([-(-len(r) // capacity) for r in raw], np.int64)
                places = np.repeat(np.arange(len(raw)), count)
                piece = np.arange(len(places)) - np.repeat(np.cumsum(count) - count, count)
                parts = [raw[d][k * capacity : (k + 1) * capacity] for d, k in zip(places.tolist(), piece.tolist(), strict=True)]
                length = np.array([len(p) for p in parts], np.int64)
                by_length = np.argsort(length, kind="stable")
                fresh = np.searchsorted(length[by_length], length[by_length])  # first of the same length
                number = np.empty(len(length), np.int64)
                number[by_length] = seen[length[by_length]] + np.arange(len(length)) - fresh
                np.add.at(seen, length, 1)
                columns = [
                    some.column(0).take(pa.array(places)),
                    pa.array(piece.astype(np.int32)),
                    pa.array(piece * capacity),
                    pa.array(length),
                    pa.array([zlib.crc32(p) for p in parts], pa.int64()),
                    pa.array(np.full(len(length), part, np.int32)),
                    pa.array(number),
                ]
                names = ["doc_id", "piece", "start", "length", "ids_crc32", "part", "number"]
                if ids:
                    columns.append(pa.array([p.tobytes() for p in parts], pa.binary()))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(columns, names=names)

    return written(rows.mapInArrow(cut, PIECES + ", ids binary" * ids), "packing-pieces")


class _Places:
    """Where the r-th piece of a length goes: runs of sequences of one kind, in the order of the plan."""

    def __init__(self, kinds: Plan):
        runs: dict[int, list[tuple[int, int, int, int]]] = {}
        first = 0
        for config, n in kinds:
            at = 0
            for length in dict.fromkeys(config):
                many = config.count(length)
                runs.setdefault(length, []).append((n, many, first, at))
                at += many * length
            first += n
        self.by_length = {}
        for length, found in runs.items():
            n, many, sequence, at = (np.array(c, np.int64) for c in zip(*found, strict=True))
            self.by_length[length] = (np.cumsum(n * many), n, many, sequence, at)

    def __call__(self, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(sequence, offset of the piece in it)."""
        sequence, offset = np.empty_like(rank), np.empty_like(rank)
        for value in np.unique(length).tolist():
            ends, n, many, first, at = self.by_length[value]
            mine = np.nonzero(length == value)[0]
            run = np.searchsorted(ends, rank[mine], side="right")
            inside = rank[mine] - (ends[run] - n[run] * many[run])
            sequence[mine] = first[run] + inside // many[run]
            offset[mine] = at[run] + inside % many[run] * value
        return sequence, offset


def packed(
    docs: DataFrame, vocabulary: str, end_id: int, capacity: int = CAPACITY, key: str = "doc_id", text: str = "text", ids: bool = False
) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset [, ids]: a row for each piece of each document.

    Each document's ids end with ``end_id``; null texts are empty, so every document has a piece. Sequences are numbered
    from 0 and hold ``capacity`` ids at most, their pieces one after another from offset 0. Repeated rows and ids are
    documents of their own. No documents, no rows. Other columns are not looked at, whatever their names.
    """
    rows = pieces(docs, vocabulary, end_id, capacity, key, text, ids)
    per_part = written(rows.groupBy("part", "length").agg(F.count("*").alias("n")), "packing-counts")
    histogram = {r["length"]: r["n"] for r in per_part.groupBy("length").agg(F.sum("n").alias("n")).collect()}  # capacity rows at most
    places = _Places(plan(histogram, capacity))
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # a row per part
    starts = per_part.select(
        F.col("part").alias("p"), F.col("length").alias("l"), F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before")
    )
    ranked = rows.join(starts, (F.col("part") == F.col("p")) & (F.col("length") == F.col("l"))).select(
        "doc_id", "piece", "start", "length", "ids_crc32", (F.col("number") + F.col("before")).alias("rank"), *["ids"] * ids
    )

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sequence, offset = places(batch.column(3).to_numpy(), batch.column(5).to_numpy())
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:5], pa.array(sequence), pa.array(offset), *batch.columns[6:]],
                names=["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset", *["ids"] * ids],
            )

    schema = "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"
    return ranked.mapInArrow(place, schema + ", ids binary" * ids)


def sequences(rows: DataFrame) -> DataFrame:
    """sequence_id, n_ids, ids (little-endian 32-bit integers) of packed rows with ids; a group is one sequence."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "length", "ids")))
    joined = F.aggregate("parts", F.lit(b"").cast("binary"), lambda done, p: F.concat(done, p["ids"]))
    return rows.groupBy("sequence_id").agg(F.sum("length").alias("n_ids"), parts.alias("parts")).select("sequence_id", "n_ids", joined.alias("ids"))


def query(spark, sf_dir):
    import public_tokenizers

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return packed(docs, public_tokenizers.path("word_bpe_49k.json"), end_id=0)
