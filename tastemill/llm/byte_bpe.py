"""Byte-level BPE: overlapping chunks are split into pre-tokens in parallel and stitched, then pieces are encoded.

A long text is cut into chunks of ``CHUNK`` characters that overlap by ``OVERLAP``, each a row of its own. Where two
neighbouring chunks put a pre-token boundary at the same place, both go on alike from there (the pattern never looks
back), so the text can be cut there without changing a pre-token, unless the piece before it would end in white space:
what a run of white space is split into depends on what follows. Chunks that share no boundary within the overlap
(one endless run of letters, say) stay joined in one piece. Pieces are encoded by themselves; decoding concatenates
the bytes of the ids. Shorter texts are one chunk and never leave their task.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import written

CHUNK = 32_768
OVERLAP = 1_024
#: A boundary is certain if this many characters after it are seen: the pattern looks at most three ahead of a match.
MARGIN = 4
#: Information separators, white space to some libraries only.
SEPARATORS = frozenset("\x1c\x1d\x1e\x1f")


class Codec:
    """Ids of the matches of a pattern by a file of ranks, and back."""

    def __init__(self, ranks_path: str, pattern: str):
        import regex
        import tiktoken

        with open(ranks_path, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.merges = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.pattern = regex.compile(pattern)
        self.piece = [b""] * (1 + max(ranks.values()))
        for raw, rank in ranks.items():
            self.piece[rank] = raw

    def encode(self, text: str) -> list[int]:
        return self.merges.encode_ordinary(text)

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.piece.__getitem__, ids))

    def boundaries(self, text: str, whole: bool) -> list[int]:
        """Ends of pre-tokens after which the text can be cut; unless ``whole``, only those that no later text can move.

        White space does not end a piece, and neither do separators that libraries do not all count as white space.
        """
        last = len(text) if whole else len(text) - MARGIN
        ends = (m.end() for m in self.pattern.finditer(text))
        return [e for e in ends if e <= last and not text[e - 1].isspace() and not SEPARATORS.intersection(text[e : e + 2])]


@lru_cache(maxsize=2)
def codec(ranks_path: str, pattern: str) -> Codec:
    return Codec(ranks_path, pattern)


def chunk_texts(texts: DataFrame, chunk: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """(text_key, text) -> (text_key, chunk, last, slice): character chunks, each with its overlap."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                body = text.as_py()
                count = max(1, -(-(len(body) - overlap) // chunk))
                for i in range(count):
                    yield pa.RecordBatch.from_pydict(
                        {
                            "text_key": pa.array([key], pa.string()),
                            "chunk": pa.array([i], pa.int32()),
                            "last": pa.array([i == count - 1]),
                            "slice": pa.array([body[i * chunk : (i + 1) * chunk + overlap if i < count - 1 else None]], pa.string()),
                        }
                    )

    return texts.mapInArrow(cut, "text_key string, chunk int, last boolean, slice string")


def stitch(chunks: DataFrame, ranks_path: str, pattern: str, chunk: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """(text_key, chunk, start): where the text can be cut within each chunk; no row where it can't.

    Starts are character offsets in the text; the first chunk starts at 0.
    """

    def edges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(ranks_path, pattern)
        for batch in batches:
            heads, tails = [], []
            for i, last, text in zip(*(batch.column(k).to_pylist() for k in (1, 2, 3)), strict=True):
                ends = np.array(c.boundaries(text, last), np.int64)
                heads.append((ends[ends <= overlap] + i * chunk).tolist())
                tails.append([] if last else (ends[ends > chunk] + i * chunk).tolist())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(heads, pa.list_(pa.int64())), pa.array(tails, pa.list_(pa.int64()))],
                names=["text_key", "chunk", "head", "tail"],
            )

    ends = chunks.mapInArrow(edges, "text_key string, chunk int, head array<bigint>, tail array<bigint>")
    before = F.lag("tail").over(Window.partitionBy("text_key").orderBy("chunk"))
    shared = ends.withColumn("before", before).select(
        "text_key",
        "chunk",
        F.when(F.col("chunk") == 0, F.lit(0).cast("long")).otherwise(F.array_min(F.array_intersect("before", "head"))).alias("start"),
    )
    return shared.where("start is not null")


def encode_long(texts: DataFrame, ranks_path: str, pattern: str, chunk: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """(text_key, text), keys unique -> (text_key, ids as bytes), by chunks, stitching and pieces."""
    parts = int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    chunks = written(chunk_texts(texts, chunk, overlap).repartition(parts, "text_key", "chunk"), "bpe-chunks")
    starts = stitch(chunks, ranks_path, pattern, chunk, overlap)
    after = Window.partitionBy("text_key").orderBy("chunk")
    pieces = (
        chunks.join(starts, ["text_key", "chunk"], "left")
        .withColumn("piece", F.count("start").over(after))
        .withColumn("next", F.min("start").over(after.rowsBetween(1, Window.unboundedFollowing)))
        .withColumn("first", F.max("start").over(after))
    )
    # chunks of one piece: mostly one
    gathered = pieces.groupBy("text_key", "piece").agg(
        F.sort_array(F.collect_list(F.struct("chunk", "last", "slice"))).alias("slices"),
        F.min("first").alias("start"),
        F.max("next").alias("until"),
    )

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(ranks_path, pattern)
        for batch in batches:
            out = []
            for slices, start, until in zip(*(batch.column(k).to_pylist() for k in (2, 3, 4)), strict=True):
                text = "".join(s["slice"] if k == len(slices) - 1 else s["slice"][:chunk] for k, s in enumerate(slices))
                base = slices[0]["chunk"] * chunk
                out.append(np.array(c.encode(text[start - base : None if until is None else until - base]), "<u4").tobytes())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(out, pa.binary())], names=["text_key", "piece", "ids"]
            )

    encoded = gathered.mapInArrow(encode, "text_key string, piece bigint, ids binary")
    whole = encoded.groupBy("text_key").agg(F.sort_array(F.collect_list(F.struct("piece", "ids"))).alias("pieces"))
    return whole.select("text_key", F.transform("pieces", lambda p: p["ids"]).alias("pieces"))


DIGESTS = "n_tokens long, ids_sha256 string, decoded_sha256 string"


def _digest_batch(lists: list[np.ndarray], c: Codec) -> list[pa.Array]:
    sizes, ids_sha, text_sha = [], [], []
    for ids in lists:
        sizes.append(len(ids))
        ids_sha.append(hashlib.sha256(ids.tobytes()).hexdigest())
        text_sha.append(hashlib.sha256(c.decode(ids.tolist())).hexdigest())
    return [pa.array(sizes, pa.int64()), pa.array(ids_sha, pa.string()), pa.array(text_sha, pa.string())]


def encode_texts(
    docs: DataFrame, ranks_path: str, pattern: str, key: str = "doc_id", text: str = "text",
    digests: bool = False, chunk: int = CHUNK, overlap: int = OVERLAP,
) -> DataFrame:
    """doc_id with ``ids`` (array of int), or with ``digests`` n_tokens, ids_sha256, decoded_sha256; a row per row.

    Null and empty texts have no ids. Texts longer than a chunk and its overlap go through ``encode_long``, copies of
    one text only once. Repeated and null ids are kept as they are.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(F.col(key).alias("doc_id"), body.alias("text"))
    is_long = F.length("text") > chunk + overlap
    kind = docs.schema[key].dataType.simpleString()
    out = DIGESTS if digests else "ids array<int>"

    def columns(lists: list[np.ndarray], c: Codec) -> tuple[list[pa.Array], list[str]]:
        if digests:
            return _digest_batch(lists, c), ["n_tokens", "ids_sha256", "decoded_sha256"]
        return [pa.array([x.tolist() for x in lists], pa.list_(pa.int32()))], ["ids"]

    def short(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(ranks_path, pattern)
        for batch in batches:
            got, names = columns([np.array(c.encode(t.as_py()), "<u4") for t in batch.column(1)], c)
            yield pa.RecordBatch.from_arrays([batch.column(0), *got], names=["doc_id", *names])

    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(ranks_path, pattern)
        for batch in batches:
            got, names = columns([np.frombuffer(b"".join(p.as_py()), "<u4") for p in batch.column(1)], c)
            yield pa.RecordBatch.from_arrays([batch.column(0), *got], names=["text_key", *names])

    done = rows.where(~is_long).mapInArrow(short, f"doc_id {kind}, {out}")
    keyed = rows.where(is_long).withColumn("text_key", F.sha2("text", 256))
    texts = keyed.select("text_key", "text").dropDuplicates(["text_key"])
    long_ids = encode_long(texts, ranks_path, pattern, chunk, overlap).mapInArrow(joined, f"text_key string, {out}")
    return done.unionByName(keyed.select("doc_id", "text_key").join(long_ids, "text_key").drop("text_key"))


def query(spark, sf_dir):
    import public_tokenizers

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return encode_texts(docs, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN, digests=True)
