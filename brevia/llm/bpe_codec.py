"""Byte-level BPE with rank files: encode in overlapping chunks, decode to raw bytes.

A text up to ``CHUNK`` characters is pre-tokenised and encoded where it is read. A longer
one is pre-tokenised in overlapping chunks, in parallel; chunks are stitched at
boundaries that both sides have (see ``overlap``), and the pieces between the stitches
are encoded in parallel again. A piece begins and ends at pre-token boundaries, so its
ids are those of the whole text. Only a document's own ids are put together in one task,
which its digest needs. Decoding concatenates the bytes of the ids.

A null text is empty and has no ids. Repeated rows are encoded once if they are long and
returned as often as they occur.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from functools import lru_cache, reduce

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from brevia.llm import arrow, overlap

VOCABULARY = "byte_bpe_50k.tiktoken"
DIGESTS = "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string"


class Codec:
    """Ranks of a file with a pattern, and the inverse."""

    def __init__(self, path: str, pattern: str):
        import regex
        import tiktoken

        with open(path, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.splitter = regex.compile(pattern)
        self.encode = tiktoken.Encoding(
            "ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}
        ).encode_ordinary
        self.bytes_of: list[bytes] = [b""] * (max(ranks.values(), default=-1) + 1)
        for token, rank in ranks.items():
            self.bytes_of[rank] = token
        self.digits = [str(i) for i in range(len(self.bytes_of))]

    def decode(self, ids) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, ids))

    def boundaries(self, text: str) -> list[int]:
        """Ends of the pre-tokens."""
        return [m.end() for m in self.splitter.finditer(text)]

    def digests(self, ids) -> tuple[int, str, str]:
        listed = " ".join(map(self.digits.__getitem__, ids)).encode()
        return len(ids), hashlib.sha256(listed).hexdigest(), hashlib.sha256(self.decode(ids)).hexdigest()


@lru_cache(maxsize=2)
def codec(path: str, pattern: str) -> Codec:
    return Codec(path, pattern)


def _digest_rows(keys: dict[str, list], found: list[tuple[int, str, str]]) -> pa.RecordBatch:
    n, ids, decoded = zip(*found)
    columns = {k: pa.array(v, pa.int64()) for k, v in keys.items()}
    columns |= {"n_tokens": pa.array(n, pa.int64()), "ids_sha256": pa.array(ids), "decoded_sha256": pa.array(decoded)}
    return pa.record_batch(columns)


def _short(path: str, pattern: str):
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(path, pattern)
        for rows in arrow.slices(batches):
            found = [own.digests(own.encode(t)) for t in arrow.texts(rows.column("text"))]
            yield _digest_rows({"doc_id": rows.column("doc_id").to_pylist()}, found)

    return encode


def _analyse(path: str, pattern: str):
    """Marks each chunk's boundaries near its ends; those at a cut end don't count."""

    def analyse(chunks: DataFrame, chunk: int, width: int) -> DataFrame:
        def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            own = codec(path, pattern)
            for batch in batches:
                heads, tails = [], []
                for row in batch.to_pylist():
                    stop = len(row["text"])
                    ends = np.array([0, *own.boundaries(row["text"])])
                    ends = ends[ends < stop] if not row["last"] else ends
                    heads.append((ends[ends <= width] + row["begin"]).tolist())
                    tails.append((ends[ends >= chunk] + row["begin"]).tolist())
                kind = pa.list_(pa.int64())
                yield batch.append_column("heads", pa.array(heads, kind)).append_column(
                    "tails", pa.array(tails, kind)
                )

        return chunks.mapInArrow(mark, overlap.CHUNK_ROWS + ", heads array<bigint>, tails array<bigint>")

    return analyse


def _encode_pieces(path: str, pattern: str):
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(path, pattern)
        for rows in arrow.slices(batches):
            ids = [np.array(own.encode(t), "<u4").tobytes() for t in arrow.texts(rows.column("text"))]
            yield rows.drop_columns(["text"]).append_column("ids", pa.array(ids, pa.binary()))

    return encode


def _join_pieces(path: str, pattern: str):
    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(path, pattern)
        for batch in batches:
            for row in batch.to_pylist():
                ids = np.frombuffer(b"".join(p["ids"] for p in row["pieces"]), "<u4").tolist()
                yield _digest_rows({k: [row[k]] for k in overlap.KEY}, [own.digests(ids)])

    return join


def encode_long(docs: DataFrame, path: str, pattern: str, chunk: int, overlaps: tuple[int, ...]) -> DataFrame:
    """(key, n_tokens, digests) of the distinct long texts."""
    cut, rest = overlap.spliced(docs, _analyse(path, pattern), chunk, overlaps)
    begin = F.coalesce("lo", F.lit(0))
    text = F.substr("text", (begin - F.col("begin") + 1).cast("int"), F.when(
        F.col("hi").isNotNull(), (F.col("hi") - begin).cast("int")
    ).otherwise(F.length("text")))
    parts = [c.select(*overlap.KEY, "chunk", text.alias("text")) for c in cut]
    if rest is not None:
        parts.append(rest.select(*overlap.KEY, F.lit(0).alias("chunk"), "text"))
    pieces = reduce(DataFrame.unionByName, parts).mapInArrow(
        _encode_pieces(path, pattern), "doc_id bigint, h1 bigint, h2 bigint, chunk int, ids binary"
    )
    whole = pieces.groupBy(*overlap.KEY).agg(
        F.array_sort(F.collect_list(F.struct("chunk", "ids"))).alias("pieces")
    )
    return whole.mapInArrow(
        _join_pieces(path, pattern), DIGESTS.replace("doc_id bigint", "doc_id bigint, h1 bigint, h2 bigint")
    )


def encode_digests(
    docs: DataFrame,
    path: str,
    pattern: str = public_tokenizers.PATTERN,
    chunk: int = overlap.CHUNK,
    overlaps: tuple[int, ...] = overlap.OVERLAPS,
) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) of every row of (doc_id, text)."""
    docs = docs.select("doc_id", "text")
    long = overlap.is_long(chunk)
    short = docs.where(~long).mapInArrow(_short(path, pattern), DIGESTS)
    found = encode_long(docs.where(long), path, pattern, chunk, overlaps)
    return short.unionByName(overlap.join_back(docs.where(long), found))


def op3_bpe_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return encode_digests(docs, public_tokenizers.path(VOCABULARY))
