"""Document and sentence tables.

``documents`` is ``(doc_id, text)`` and ``sentences`` is ``(doc_id, pos, raw)``.
"""

from __future__ import annotations

import os
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from brevia.functions import text as tx
from brevia.session import bucketed

# Bytes of files for each bucket of documents, and blocks for each bucket.
BUCKET_BYTES = 8 << 20
BLOCKS = 2
# Bytes of files that a task reads at once.
READ_BYTES = 1 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(df: DataFrame) -> DataFrame:
    """Deal rows out when the scan has fewer splits than the cluster has cores.

    Cleaning is CPU-bound, and a small file with one row group would be one task. A
    large table already has more splits than cores and is left alone.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def by_document(docs: DataFrame) -> DataFrame:
    """Deal rows out by id, as many partitions as the session shuffles into.

    Counts by document and term, and by document, then need no exchange: a text travels once
    in place of all its terms, several times over.
    """
    spark = docs.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return docs.repartition(max(parts, spark.sparkContext.defaultParallelism), "doc_id")


def by_block(docs: DataFrame) -> tuple[DataFrame, int]:
    """Rows ``(block, doc_id, text)`` dealt by block, and the number of partitions they are dealt into.

    All rows of an id are in one block. Partitions follow the size of the files that ``docs`` scans, not the
    session's shuffles, so that a block holds enough documents to share their terms.
    """
    files = docs.select("_metadata.file_path", "_metadata.file_size").distinct()
    size = files.agg(F.sum("file_size")).first()[0] or 0
    n = max(2 * docs.sparkSession.sparkContext.defaultParallelism, -(-size // BUCKET_BYTES))
    block = F.pmod(F.xxhash64("doc_id"), F.lit(BLOCKS * n)).cast("int").alias("block")
    return docs.select(block, "doc_id", "text").repartition(n, "block"), n


def in_blocks(docs: DataFrame, stop_words: Iterable[str] | None = None) -> DataFrame:
    """Kept tokens of each line of a row, ``(block, doc_id, lines)``, written in buckets of the block.

    What is counted by document, or joined to ``(block, term)``, needs no exchange; the latter has
    one row for all documents of a block. Texts are shuffled and cleaned once (see :func:`by_block`).
    """
    dealt, n = by_block(docs)
    lines = F.transform(F.split("text", "\n"), lambda line: tx.clean_tokens(line, stop_words))
    return bucketed(dealt.select("block", "doc_id", lines.alias("lines")), "block", n, "blocks")


def block_terms(blocks: DataFrame) -> DataFrame:
    """:func:`terms` of :func:`in_blocks`, with the block: ``(block, doc_id, pos, term)``."""
    lines = blocks.select("block", "doc_id", F.posexplode_outer("lines").alias("pos", "tokens"))
    found = lines.select("block", "doc_id", "pos", F.explode_outer("tokens").alias("term"))
    return found.where("term IS NOT NULL")


def same_block(*tables: DataFrame) -> list[str]:
    """``["block"]`` if all tables have it: one more key that spares an exchange."""
    return ["block"] if all("block" in df.columns for df in tables) else []


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spread(table(spark, sf_dir, "documents").select("doc_id", "text"))


def read_lines(spark: SparkSession, path: str, sep: str = "\t") -> DataFrame:
    """Line scan with a key and a value column split at the first separator."""
    parts = F.split("value", sep, 2)
    return spark.read.text(path).select(
        parts.getItem(0).alias("key"), F.get(parts, F.lit(1)).alias("value")
    )


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """Whole-document scan, one row per file; the full path is the identity.

    ``name`` is the base name. Two files with one base name stay two documents.
    """
    return spark.read.text(path, wholetext=True).select(
        F.col("_metadata.file_path").alias("doc_id"),
        F.col("_metadata.file_name").alias("name"),
        F.col("value").alias("text"),
    )


def _folder_files(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for folder in batch.column("folder").to_pylist():
            names = sorted(x for x in os.listdir(folder) if x[0] not in "._")
            found, size = [], 0
            for name in names:
                with open(f"{folder}/{name}", "rb") as file:
                    found.append((f"file://{folder}/{name}", name, file.read()))
                size += len(found[-1][2])
                if size > READ_BYTES or name == names[-1]:
                    ids, own, texts = map(list, zip(*found))
                    # a view: like Spark's reader, this takes any bytes for text
                    texts = pa.array(texts, pa.binary()).view(pa.string())
                    yield pa.record_batch({"doc_id": ids, "name": own, "text": texts})
                    found, size = [], 0


def read_folders(spark: SparkSession, path: str, tasks: int) -> DataFrame:
    """:func:`read_documents` of the folders below ``path``, which all tasks see.

    The tasks list and read the files: a scan would hold every file's name and status in the driver.
    """
    folders = sorted(x.path for x in os.scandir(path) if x.is_dir() and x.name[0] not in "._")
    table = spark.createDataFrame(pa.table({"folder": pa.array(folders, pa.string())}))
    return table.repartition(max(1, min(tasks, len(folders)))).mapInArrow(_folder_files, "doc_id string, name string, text string")


def corpus_size(docs: DataFrame) -> DataFrame:
    """Number of documents, those without any kept token included."""
    return docs.agg(F.count(F.lit(1)).alias("n_docs"))


def n_docs(docs: DataFrame) -> Column:
    """Corpus size as a scalar-subquery column: one row, no join."""
    return corpus_size(docs).scalar()


def sentences(docs: DataFrame) -> DataFrame:
    """Newline-separated lines of each document as ``(doc_id, pos, raw)``, with the block if the documents have one."""
    lines = F.posexplode_outer(F.split("text", "\n")).alias("pos", "raw")
    return docs.select(*same_block(docs), "doc_id", lines)


def clean(sents: DataFrame, stop_words: Iterable[str] | None = None) -> DataFrame:
    """``(doc_id, pos, tokens, sentence)``; sentences without tokens stay."""
    return sents.select(
        "doc_id", "pos", tx.clean_tokens(F.col("raw"), stop_words).alias("tokens")
    ).withColumn("sentence", F.concat_ws(" ", "tokens"))


def terms(
    sents: DataFrame, stop_words: Iterable[str] | None = None, keys: Iterable[str] = ("doc_id", "pos")
) -> DataFrame:
    """Kept tokens as rows ``(doc_id, pos, term)``; other ``keys`` take the place of id and line.

    ``explode_outer`` keeps the optimiser from adding a size filter below the
    generator, which would tokenise every sentence once more.
    """
    tokens = tx.clean_tokens(F.col("raw"), stop_words)
    return sents.select(*keys, F.explode_outer(tokens).alias("term")).where(
        "term IS NOT NULL"
    )
