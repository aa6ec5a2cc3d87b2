"""Tagged-record scan: the text from a start tag through the first end tag after it."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# The tags of a sentence record.
START_TAG = "<sentence id="
END_TAG = "</sentence>"
# File names that the text reader unpacks.
COMPRESSED = r"\.(gz|bz2|zst|lz4|snappy|deflate)$"


def record_pattern(start_tag: str, end_tag: str) -> str:
    return f"(?s)({re.escape(start_tag)}.*?{re.escape(end_tag)})"


def tagged_records(
    df: DataFrame,
    id_col: str,
    text_col: str,
    start_tag: str = START_TAG,
    end_tag: str = END_TAG,
) -> DataFrame:
    """Records of a text column as ``(doc_id, pos, raw)``; an unterminated tail is no record."""
    records = F.regexp_extract_all(text_col, F.lit(record_pattern(start_tag, end_tag)), 1)
    return df.select(F.col(id_col).alias("doc_id"), F.posexplode(records).alias("pos", "raw"))


def read_tagged(
    spark: SparkSession,
    path: str,
    start_tag: str = START_TAG,
    end_tag: str = END_TAG,
    strict: bool = True,
) -> DataFrame:
    """Records of text files as ``(doc_id, name, pos, raw)``.

    The end tag is the line separator, so files stay splittable and a record that
    straddles two splits is read once. ``doc_id`` is the file path, ``name`` its base
    name; ``pos`` orders the records of a file but is not dense.

    A reader cannot see whether the last piece of a file was terminated. In strict
    mode a file whose pieces and separators add up to more bytes than the file holds
    has an open tail, and that piece is dropped. The sums are one row per file. The
    bytes of a compressed file are counted by a second scan of such files alone.
    """
    pieces = (
        spark.read.option("lineSep", end_tag)
        .text(path)
        .select(
            F.col("_metadata.file_path").alias("doc_id"),
            F.col("_metadata.file_name").alias("name"),
            F.col("_metadata.file_size").alias("size"),
            F.monotonically_increasing_id().alias("pos"),
            "value",
        )
    )
    records = pieces.withColumn(
        "raw", F.regexp_extract("value", f"(?s)({re.escape(start_tag)}.*)$", 1)
    ).where("raw <> ''")
    if strict:
        tag_bytes = len(end_tag.encode("utf-8"))
        open_tails = (
            pieces.groupBy("doc_id")
            .agg(
                F.sum(F.octet_length("value") + F.lit(tag_bytes)).alias("read"),
                F.max("size").alias("stored"),
                F.max("pos").alias("pos"),
            )
            .join(_unpacked_sizes(spark, path, end_tag), "doc_id", "left")
            .where(F.col("read") > F.coalesce("unpacked", "stored"))
            .select("doc_id", "pos")
        )
        records = records.join(open_tails, ["doc_id", "pos"], "left_anti")
    return records.select("doc_id", "name", "pos", F.concat("raw", F.lit(end_tag)).alias("raw"))


def _unpacked_sizes(spark: SparkSession, path: str, end_tag: str) -> DataFrame:
    """``(doc_id, unpacked)`` of compressed files, exact where the end tag ends the file.

    Pieces are cut at the last character of the end tag. A file that ends in the end tag
    ends in that character too, so pieces and separators add up to its bytes. Any other
    file comes out at most one byte too long, less than the end tag overshoots.
    """
    if len(end_tag) < 2 or not end_tag.isascii():
        raise ValueError("strict mode needs an ASCII end tag of two characters or more")
    return (
        spark.read.option("lineSep", end_tag[-1])
        .text(path)
        .where(F.col("_metadata.file_name").rlike(COMPRESSED))
        .groupBy(F.col("_metadata.file_path").alias("doc_id"))
        .agg(F.sum(F.octet_length("value") + F.lit(1)).alias("unpacked"))
    )
