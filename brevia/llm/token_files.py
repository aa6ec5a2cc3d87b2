"""Token files: the ids of all documents in ascending order, Simple-8b coded.

A file is a parquet table of chunks, written by Spark's committer, so a retried task
leaves no half file and any store that Spark can reach will do. A chunk holds whole
documents until it has ``CHUNK_IDS`` ids: their ids and lengths, the coded words, the
word offset of every block and the escapes. Files follow each other by ``part``, chunks
in a file by ``first``. One exchange by ranges of the document id sorts the table;
the ids before each part come from one sum per part.

A null text has no ids but its end id. Documents with a null id come first, equal ids
are ordered by text. A document is never split between chunks.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from brevia.llm import arrow, simple8b
from brevia.llm.units import word_units
from brevia.session import scratch_path

END_ID = 1
CHUNK_IDS = 1 << 16
START = 64
VOCABULARY = "word_bpe_49k.json"
CHUNKS = (
    "part int, first bigint, n_ids bigint, doc_ids array<bigint>, lengths array<bigint>, "
    "words binary, offsets array<bigint>, escapes binary"
)
TOKENS = "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint"


def _chunk(part: int, first: int, doc_ids: list, lengths: list, ids: list) -> pa.RecordBatch:
    values = np.concatenate(ids)
    words, offsets, raw = simple8b.encode(values)
    row = [part, first, len(values), doc_ids, lengths, words.tobytes(), offsets.tolist(), raw.tobytes()]
    types = [pa.int32(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64())]
    types += [pa.binary(), pa.list_(pa.int64()), pa.binary()]
    names = ["part", "first", "n_ids", "doc_ids", "lengths", "words", "offsets", "escapes"]
    return pa.record_batch([pa.array([x], t) for x, t in zip(row, types)], names=names)


def _encoder(path: str, end_id: int):
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        units, part = word_units(path), TaskContext.get().partitionId()
        end = np.array([end_id], np.uint32)
        doc_ids, lengths, ids, first, size = [], [], [], 0, 0
        for rows in arrow.slices(batches):
            found, lens = units.encode(arrow.raw(rows.column("text")))
            stops = np.cumsum(lens)
            for doc_id, stop, n in zip(rows.column("doc_id").to_pylist(), stops.tolist(), lens.tolist()):
                doc_ids.append(doc_id)
                lengths.append(n + 1)
                ids += [found[stop - n : stop], end]
                size += n + 1
                if size >= CHUNK_IDS:
                    yield _chunk(part, first, doc_ids, lengths, ids)
                    first += size
                    doc_ids, lengths, ids, size = [], [], [], 0
        if doc_ids:
            yield _chunk(part, first, doc_ids, lengths, ids)

    return encode


def write_tokens(docs: DataFrame, path: str, vocabulary: str, end_id: int = END_ID) -> None:
    """Writes the token files of ``docs`` (doc_id, text) to ``path``."""
    # ranges by the start of the text too, so that rows with one id, or none, are many ranges
    ordered = docs.select("doc_id", "text").repartitionByRange("doc_id", F.substring("text", 1, START))
    ordered = ordered.sortWithinPartitions("doc_id", "text")
    chunks = ordered.mapInArrow(_encoder(vocabulary, end_id), CHUNKS)
    chunks.write.option("compression", "none").parquet(path)


def _decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            ids = simple8b.decode(
                np.frombuffer(row["words"], np.uint64),
                np.array(row["offsets"], np.int64),
                np.frombuffer(row["escapes"], np.uint64),
                row["n_ids"],
            ).astype("<u4")
            stops = np.cumsum(row["lengths"])
            starts = stops - row["lengths"]
            crcs = [zlib.crc32(ids[a:b]) for a, b in zip(starts.tolist(), stops.tolist())]
            columns = [row["doc_ids"], row["first"] + row["base"] + starts, row["lengths"], crcs]
            yield pa.record_batch(
                [pa.array(c, pa.int64()) for c in columns],
                names=["doc_id", "start", "n_tokens", "ids_crc32"],
            )


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, from the files."""
    chunks = spark.read.schema(CHUNKS).parquet(path)
    parts = chunks.groupBy("part").agg(F.sum("n_ids").alias("n"))
    order = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    # one row per written file
    base = parts.select("part", F.coalesce(F.sum("n").over(order), F.lit(0)).alias("base"))
    return chunks.join(F.broadcast(base), "part").mapInArrow(_decode, TOKENS)


def op2_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    path = scratch_path(spark, "tokens")
    write_tokens(docs, path, public_tokenizers.path(VOCABULARY))
    return read_tokens(spark, path)
