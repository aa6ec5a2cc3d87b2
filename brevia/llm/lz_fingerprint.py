"""Document fingerprints from Lempel-Ziv phrases.

A document is parsed from left to right into phrases: each is the longest phrase met
before and one unit more. Texts that a compressor would find alike share phrases. The
set of phrases is hashed and reduced to ``PERMUTATIONS`` minimum hashes, by one
permutation with rotation for empty bins; the likeness of two texts is the share of
equal minima, which estimates the Jaccard similarity of their phrase sets.

Units are words between white space; a word of more than ``LONG_WORD`` characters counts as
its characters, so text without blanks is parsed too. A null text is empty; texts without
units have the fingerprint of the empty set and likeness 1 to each other, 0 to others.

Each document also meets its successor by ascending id. One exchange by ranges of the id
sorts the texts; only the last text of a partition misses its successor. Those pairs,
one per partition, are completed from the first texts of the partitions.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from brevia.llm import arrow
from brevia.session import materialise

PERMUTATIONS = 128
LONG_WORD = 32
_EMPTY = np.uint32(0xFFFFFFFF)

OUT = (
    "doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint binary, "
    "edited_fingerprint binary, near_edited double, near_next double"
)
BORDER = ", part int, head string, tail string"
_FIELDS = [
    ("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()),
    ("fingerprint", pa.binary()), ("edited_fingerprint", pa.binary()),
    ("near_edited", pa.float64()), ("near_next", pa.float64()),
]
_BORDER_FIELDS = [*_FIELDS, ("part", pa.int32()), ("head", pa.string()), ("tail", pa.string())]


def units(text: str) -> list[str]:
    words = text.split()
    if max(map(len, words), default=0) <= LONG_WORD:
        return words
    return [u for w in words for u in ([w] if len(w) <= LONG_WORD else w)]


def phrases(text: str) -> set[str]:
    """The phrases of a text; an unfinished last one is known already or joins them."""
    known: set[str] = set()
    phrase = ""
    for unit in units(text):
        phrase = phrase + " " + unit
        if phrase not in known:
            known.add(phrase)
            phrase = ""
    return known


def minima(known: set[str]) -> np.ndarray:
    """16-bit minima of the hashed phrases, one for each of ``PERMUTATIONS`` bins."""
    if not known:
        return np.zeros(PERMUTATIONS, np.uint16)
    digest = xxhash.xxh3_64_intdigest
    hashes = np.sort(np.fromiter(map(digest, known), np.uint64, len(known)))
    bins = (hashes >> np.uint64(57)).astype(np.int64)
    firsts = np.flatnonzero(np.diff(bins, prepend=-1))
    found = bins[firsts]
    values = ((hashes[firsts] >> np.uint64(20)) & np.uint64(0xFFFFFFFF)).astype(np.uint32)
    # an empty bin takes the next full one's value, mixed with the distance
    to = np.searchsorted(found, np.arange(PERMUTATIONS))
    full = found[to % len(found)]
    distance = (full - np.arange(PERMUTATIONS)) % PERMUTATIONS
    mixed = values[to % len(found)] + distance.astype(np.uint32) * np.uint32(0x9E3779B1)
    return ((mixed ^ (mixed >> np.uint32(16))) & np.uint32(0xFFFF)).astype(np.uint16)


def fingerprint(text: str) -> str:
    known = phrases(text)
    return ("1" if known else "0") + minima(known).astype(">u2").tobytes().hex()


def likeness(a: str, b: str) -> float:
    """Share of equal minima of two fingerprints."""
    if a[0] != b[0]:
        return 0.0
    x = np.frombuffer(bytes.fromhex(a[1:]), ">u2")
    y = np.frombuffer(bytes.fromhex(b[1:]), ">u2")
    return float((x == y).mean())


def edited(text: str, successor: str) -> str:
    n = len(text) // 4
    return text[: len(text) - n] + successor[:n]


class _Text:
    """A text with the fingerprint it needs as a document and as a successor."""

    def __init__(self, doc_id: int | None, text: str):
        self.doc_id, self.text, self.mark = doc_id, text, fingerprint(text)

    def row(self, successor: _Text) -> dict:
        changed = edited(self.text, successor.text)
        mark = self.mark if changed == self.text else fingerprint(changed)
        return {
            "doc_id": self.doc_id,
            "n_chars": len(self.text),
            "edited_sha256": hashlib.sha256(changed.encode()).hexdigest(),
            "fingerprint": bytes.fromhex("0" + self.mark),
            "edited_fingerprint": bytes.fromhex("0" + mark),
            "near_edited": likeness(self.mark, mark),
            "near_next": likeness(self.mark, successor.mark),
        }


def _in_partitions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of all documents but the partition's last; a border row has its ends."""
    part, first, last = TaskContext.get().partitionId(), None, None
    schema = pa.schema(_BORDER_FIELDS)
    for rows in arrow.slices(batches):
        out = []
        for doc_id, text in zip(rows.column("doc_id").to_pylist(), arrow.texts(rows.column("text"))):
            new = _Text(doc_id, text)
            if last is None:
                first = new
            else:
                out.append(last.row(new))
            last = new
        yield pa.RecordBatch.from_pylist(out, schema=schema)
    if last is not None:
        border = {"doc_id": last.doc_id, "part": part, "head": first.text, "tail": last.text}
        yield pa.RecordBatch.from_pylist([border], schema=schema)


def _at_borders(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for rows in batches:
        out = [_Text(r["doc_id"], r["tail"]).row(_Text(None, r["next"])) for r in rows.to_pylist()]
        yield pa.RecordBatch.from_pylist(out, schema=pa.schema(_FIELDS))


def fingerprints(docs: DataFrame) -> DataFrame:
    """One row for every row of (doc_id, text); see ``OUT``.

    Documents with a null id come first and equal ids are ordered by text. The written
    table keeps the fingerprints, so borders are settled without a second parse.
    """
    ordered = docs.select("doc_id", "text").repartitionByRange("doc_id")
    ordered = ordered.sortWithinPartitions("doc_id", "text")
    found = materialise(ordered.mapInArrow(_in_partitions, OUT + BORDER), "fingerprints")
    border = found.where("part IS NOT NULL").select("doc_id", "part", "head", "tail")
    # numbers only: a row per partition; the texts are joined by number
    parts = border.select("part")
    order = Window.orderBy("part")
    first = F.first("part").over(order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    links = parts.select("part", F.coalesce(F.lead("part").over(order), first).alias("then"))
    heads = border.select(F.col("part").alias("then"), F.col("head").alias("next"))
    pairs = border.select("doc_id", "part", "tail").join(links, "part").join(heads, "then")
    last = pairs.select("doc_id", "tail", "next").mapInArrow(_at_borders, OUT)
    out = found.where("part IS NULL").drop("part", "head", "tail").unionByName(last)
    text = lambda c: F.expr(f"lower(substring(hex({c}), 2))")  # noqa: E731  a half byte leads the mark
    return out.withColumns({c: text(c) for c in ("fingerprint", "edited_fingerprint")})


def op4_lz_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints(spark.read.parquet(f"{sf_dir}/documents.parquet"))
