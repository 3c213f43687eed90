"""Token ids as compact binary files: patched frame-of-reference blocks.

A file holds the ids of whole documents one after another. Ids are cut into blocks of 128: the block's minimum is
subtracted, the rest is packed at the width that a percentile of its values needs, and values that need more go to an
exception list. An index holds where each block starts, so that any block can be read by itself.

A file is one row of a table (binary column) that Spark writes and commits, so any store that Spark reaches will do
and a lost executor leaves no half-written file. Layout, all little-endian:

    magic "TFOR1" | u32 documents | u64 ids | u64 exceptions
    document ids i64, a null mark u8 each, ids per document u32
    index, by block: start u64 (within the packed blocks), minimum u32, exceptions u16, width u8
    exceptions, by block: place u8 each; then the part above the width u32 each
    packed blocks: width // 8 planes of bytes, then width % 8 planes of bits, lowest first
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import written
from .word_tokens import encoder

MAGIC = b"TFOR1"
BLOCK = 128
#: Share of a block's values that the packed width has to hold.
PERCENTILE = 0.9
#: A file is closed when it holds as many ids; a longer document makes a longer file.
FILE_IDS = 1 << 20
_HEAD = struct.Struct("<5sIQQ")


def pack_ids(ids: np.ndarray, percentile: float = PERCENTILE) -> tuple[bytes, int]:
    """(index and packed blocks, number of exceptions) of ids; the last block is filled up with its last id.

    Blocks of one width lie side by side; the index gives the start, minimum, width and exceptions of each in order.
    """
    n = len(ids)
    blocks = -(-n // BLOCK)
    kind = np.dtype("<u2" if n and int(ids.max()) < 1 << 16 else "<u4")
    table = np.empty((blocks, BLOCK), kind)
    flat = table.reshape(-1)
    flat[:n] = ids
    if n:
        flat[n:] = ids[-1]
    low = table.min(axis=1) if n else np.zeros(0, kind)
    table -= low[:, None]
    rank = min(BLOCK, max(1, int(np.ceil(percentile * BLOCK)))) - 1
    bound = np.partition(table, rank, axis=1)[:, rank]
    width = np.frexp(bound.astype(np.float64))[1].astype(np.uint8)
    sizes = width.astype(np.int64) * (BLOCK // 8)
    order = np.argsort(width, kind="stable")
    starts = np.zeros(blocks, "<u8")
    starts[order] = np.cumsum(sizes[order]) - sizes[order]
    over = table > ((np.uint64(1) << width.astype(np.uint64)) - np.uint64(1)).astype(kind)[:, None]
    row, place = np.nonzero(over)
    exceptions = np.bincount(row, minlength=blocks).astype("<u2")
    high = (table[row, place].astype("<u4") >> width[row].astype(np.uint32)).astype("<u4")
    packed = []
    for w in np.unique(width).tolist():
        part = table[width == w].view(np.uint8).reshape(-1, BLOCK, kind.itemsize)
        planes = [part[:, :, k] for k in range(w // 8)]
        planes += [np.packbits((part[:, :, w // 8] >> bit) & 1, axis=1) for bit in range(w % 8)]
        if planes:
            packed.append(np.concatenate(planes, axis=1).tobytes())
    index = [starts, low.astype("<u4"), exceptions, width, place.astype(np.uint8), high]
    return b"".join([x.tobytes() for x in index] + packed), len(row)


def unpack_ids(data: bytes | memoryview, n: int, n_exceptions: int, only: slice = slice(None)) -> np.ndarray:
    """Ids of all blocks, or of those that ``only`` names; no other block is read."""
    blocks = -(-n // BLOCK)
    at, index = 0, []
    for kind, m in (("<u8", blocks), ("<u4", blocks), ("<u2", blocks), ("u1", blocks), ("u1", n_exceptions), ("<u4", n_exceptions)):
        index.append(np.frombuffer(data, kind, m, at))
        at += index[-1].nbytes
    starts, low, exceptions, width, place, high = index
    numbers = np.arange(blocks)[only]
    table = np.zeros((len(numbers), BLOCK), np.uint32)
    body = np.frombuffer(data, np.uint8, offset=at)
    for w in np.unique(width[numbers]).tolist():
        rows = np.nonzero(width[numbers] == w)[0]
        size = w * (BLOCK // 8)
        begin = starts[numbers[rows]].astype(np.int64)
        if not size:
            continue
        if (np.diff(begin) == size).all():
            raw = body[begin[0] : begin[-1] + size].reshape(-1, size)
        else:
            raw = body[begin[:, None] + np.arange(size)]
        value = np.zeros((len(rows), BLOCK, 4), np.uint8)
        for k in range(w // 8):
            value[:, :, k] = raw[:, k * BLOCK : (k + 1) * BLOCK]
        for bit in range(w % 8):
            from_ = (w // 8) * BLOCK + bit * (BLOCK // 8)
            value[:, :, w // 8] |= np.unpackbits(raw[:, from_ : from_ + BLOCK // 8], axis=1) << bit
        table[rows] = value.reshape(len(rows), -1).view("<u4")
    row = np.repeat(np.arange(blocks), exceptions)
    wanted = np.full(blocks, -1)
    wanted[numbers] = np.arange(len(numbers))
    mine = wanted[row] >= 0
    table[wanted[row[mine]], place[mine]] |= high[mine] << width[row[mine]].astype(np.uint32)
    table += low[numbers][:, None]
    flat = table.reshape(-1)
    return flat[: n - BLOCK * int(numbers[0])] if len(numbers) else flat


def file_bytes(doc_ids: list[int | None], lengths: list[int], ids: np.ndarray) -> bytes:
    packed, n_exceptions = pack_ids(ids)
    return b"".join(
        [
            _HEAD.pack(MAGIC, len(doc_ids), len(ids), n_exceptions),
            np.array([d or 0 for d in doc_ids], "<i8").tobytes(),
            np.array([d is None for d in doc_ids], np.uint8).tobytes(),
            np.array(lengths, "<u4").tobytes(),
            packed,
        ]
    )


def read_file(data: bytes) -> tuple[list[int | None], np.ndarray, np.ndarray]:
    """(document ids, ids per document, all ids) of a file."""
    magic, docs, n, n_exceptions = _HEAD.unpack_from(data)
    if magic != MAGIC:
        raise ValueError("not a token file")
    at = _HEAD.size
    keys = np.frombuffer(data, "<i8", docs, at)
    nulls = np.frombuffer(data, np.uint8, docs, at + 8 * docs)
    lengths = np.frombuffer(data, "<u4", docs, at + 9 * docs)
    ids = unpack_ids(memoryview(data)[at + 13 * docs :], n, n_exceptions)
    return [None if z else int(k) for k, z in zip(keys, nulls, strict=True)], lengths, ids


FILES = "part int, file int, first_doc long, n_docs long, n_ids long, data binary"


def write_token_files(docs: DataFrame, vocabulary: str, end_id: int, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Files of the ids of all documents, in ascending order of (part, file) and of doc_id within and across them.

    Columns: part, file, first_doc, n_docs, n_ids, data. Texts are range-partitioned by doc_id and encoded after that
    shuffle, so texts move once and ids never. A null text is empty, every document ends with ``end_id``, null ids
    come first, repeated ids stand next to each other. An empty table gives no files.
    """
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    body = F.coalesce(F.col(text), F.lit("")).cast("binary")
    rows = docs.select(F.col(key).cast("long").alias("doc_id"), body.alias("body")).withColumn(
        "tie", F.crc32("body")
    )
    placed = rows.repartitionByRange(parts, "doc_id", "tie").sortWithinPartitions("doc_id", "tie")

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, number = TaskContext.get().partitionId(), 0
        ids_of = encoder(vocabulary)
        tail = np.array([end_id], ids_of.kind).tobytes()
        keys: list[int | None] = []
        pieces: list[bytes] = []
        size = 0

        def closed() -> pa.RecordBatch:
            ids = np.frombuffer(b"".join(pieces), ids_of.kind).astype(np.uint32)
            lengths = [len(p) // ids_of.kind.itemsize for p in pieces]
            row = (part, number, keys[0], len(keys), len(ids), file_bytes(keys, lengths, ids))
            return pa.RecordBatch.from_arrays(
                [pa.array([v], t) for v, t in zip(row, kinds, strict=True)],
                names=["part", "file", "first_doc", "n_docs", "n_ids", "data"],
            )

        kinds = [pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
        for batch in batches:
            for doc_id, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                ids = ids_of(raw) + tail
                keys.append(doc_id)
                pieces.append(ids)
                size += len(ids)
                if size >= FILE_IDS * ids_of.kind.itemsize:
                    yield closed()
                    keys, pieces, size, number = [], [], 0, number + 1
        if keys:
            yield closed()

    return written(placed.select("doc_id", "body").mapInArrow(encode, FILES), "token-files")


def read_token_files(files: DataFrame) -> DataFrame:
    """doc_id, part, file, start_in_file, n_tokens, ids_crc32 (of the ids as 32-bit integers), one row per document."""

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, number, data in zip(*(batch.column(i) for i in range(3)), strict=True):
                keys, lengths, ids = read_file(data.as_py())
                ends = np.cumsum(lengths.astype(np.int64))
                raw = memoryview(ids.astype("<u4").tobytes())
                begins = ends - lengths
                sums = [zlib.crc32(raw[4 * b : 4 * e]) for b, e in zip(begins.tolist(), ends.tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(keys, pa.int64()),
                        pa.array([part.as_py()] * len(keys), pa.int32()),
                        pa.array([number.as_py()] * len(keys), pa.int32()),
                        pa.array(begins, pa.int64()),
                        pa.array(lengths, pa.int64()),
                        pa.array(sums, pa.int64()),
                    ],
                    names=["doc_id", "part", "file", "start_in_file", "n_tokens", "ids_crc32"],
                )

    return files.select("part", "file", "data").mapInArrow(
        decode, "doc_id long, part int, file int, start_in_file long, n_tokens long, ids_crc32 long"
    )


def file_starts(files: DataFrame) -> DataFrame:
    """part, file, start: ids in all files before. Sums per part are added up first, so no task sees all files."""
    sizes = files.select("part", "file", "n_ids")
    by_part = sizes.groupBy("part").agg(F.sum("n_ids").alias("s"))
    # one row per part of the shuffle
    before = by_part.select(
        F.col("part").alias("p"),
        F.coalesce(F.sum("s").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"),
    )
    inside = Window.partitionBy("part").orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    return sizes.withColumn("inside", F.coalesce(F.sum("n_ids").over(inside), F.lit(0))).join(
        before, F.col("part") == F.col("p")
    ).select(F.col("part").alias("s_part"), F.col("file").alias("s_file"), (F.col("inside") + F.col("before")).alias("start"))


def query(spark, sf_dir):
    import public_tokenizers

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    files = write_token_files(docs, public_tokenizers.path("word_bpe_49k.json"), end_id=1)
    starts = file_starts(files)
    return read_token_files(files).join(
        starts, (F.col("part") == F.col("s_part")) & (F.col("file") == F.col("s_file"))
    ).select("doc_id", (F.col("start") + F.col("start_in_file")).alias("start"), "n_tokens", "ids_crc32")
