"""Helpers that several operators of the subpackage share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = UPPER.lower()
# ASCII white space: blank and 0x09-0x0D
WHITE = " \t\n\x0b\x0c\r"


def ascii_lower(c: Column) -> Column:
    """A-Z in lower case, every other character as it is."""
    return F.translate(c, UPPER, LOWER)


def text_of(c: str = "text") -> Column:
    return F.coalesce(F.col(c), F.lit(""))


def row_key(doc_id: str = "doc_id", text: str = "text") -> list[Column]:
    """Columns that tell rows apart by content: the id and 128 bits of text hash.

    Rows equal in both are the same to every operator here, so whatever is found for
    one of them holds for all. Unlike a generated row number the key is the same in
    every scan and in every retried task.
    """
    t = text_of(text)
    return [
        F.col(doc_id).alias("doc_id"),
        F.xxhash64(t).alias("h1"),
        F.xxhash64(F.lit(17), t).alias("h2"),
    ]


def same_row(a: DataFrame, b: DataFrame) -> Column:
    """Null-safe equality of two row keys, usable as an equi-join condition."""
    return (
        a["doc_id"].eqNullSafe(b["doc_id"]) & (a["h1"] == b["h1"]) & (a["h2"] == b["h2"])
    )
