"""Importance resampling towards a target distribution, with an Aho-Corasick dictionary.

Texts are lower-cased in A-Z and every character that belongs to no word becomes a blank,
so a word stands between delimiters. The steps:

1. The distinct words of all texts are counted. The ``DICTIONARY`` most frequent of them,
   delimiters included, are compiled to an automaton whose payload is a word's CRC and
   length. The dictionary has a fixed size and only saves work: a word outside it lies in
   the gap between two matches and gets the same payload from its own bytes.
2. One scan of a text emits payloads. A run of ``n`` consecutive words has the CRC that
   composes from its payloads, so no n-gram is ever spelled out. CRCs modulo ``buckets``
   are kept, two bytes a feature, and the text is not read again.
3. Buckets are counted over all texts and over the target; their gains (``buckets``
   numbers) are broadcast, and a text's weight is the floored mean of its features' gains.
4. A Gumbel draw per id gives the score. Rows are sorted by it once; ranks are places in
   the sorted files plus the sizes of the files before, so no task sees all rows.

A null text has no words: no features, weight 0 and no rank. A null id is drawn as the
empty id and comes last among ties; repeated rows are drawn one by one, ties of equal ids
by text hash. An empty target leaves the gains to the smoothing. Columns other than
``doc_id`` and ``text`` are not read.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from brevia.llm import arrow
from brevia.llm.common import row_key
from brevia.session import materialise

MAX_WORDS = 1
BUCKETS = 10_000
MIN_WORDS = 20
PERCENT = 10
SEED = "2024"
# Words of the automaton, none longer than LONGEST bytes: about a megabyte to broadcast.
DICTIONARY = 1 << 16
LONGEST = 48
# Bytes the automaton reads at once; a longer text is read in pieces cut at blanks.
PIECE = 1 << 21
# Distinct words a task holds before it hands its counts on.
HELD = 1 << 18

_BLANK = [*range(0x00, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)]
_DELIMIT = bytearray(range(256))
for _b in _BLANK:
    _DELIMIT[_b] = 0x20
for _b in range(0x41, 0x5B):
    _DELIMIT[_b] = _b + 0x20
_DELIMIT = bytes(_DELIMIT)


def delimited(text: bytes) -> bytes:
    """Lower-cased words between blanks."""
    return text.translate(_DELIMIT)


@lru_cache(maxsize=1)
def _advance_tables() -> list[np.ndarray]:
    """Tables that advance a CRC over 2^k zero bytes, one 4 x 256 table for each k."""
    byte = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        byte = np.where(byte & 1, (byte >> 1) ^ np.uint32(0xEDB88320), byte >> 1)
    lanes = np.arange(256, dtype=np.uint32)[None, :] << (8 * np.arange(4, dtype=np.uint32))[:, None]
    tables = [byte[lanes & 255] ^ (lanes >> np.uint32(8))]
    for _ in range(31):
        tables.append(_advanced_once(tables[-1], tables[-1]))
    return tables


def _advanced_once(table: np.ndarray, crc: np.ndarray) -> np.ndarray:
    out = table[0][crc & 255]
    for lane in range(1, 4):
        out = out ^ table[lane][(crc >> np.uint32(8 * lane)) & 255]
    return out


def composed(crc_a: np.ndarray, crc_b: np.ndarray, size_b: np.ndarray) -> np.ndarray:
    """CRCs of ``a + b`` from those of ``a`` and ``b`` and the size of ``b``."""
    out, size_b = crc_a.astype(np.uint32), size_b.astype(np.int64)
    for k, table in enumerate(_advance_tables()):
        if not (size_b >> k).any():
            break
        odd = (size_b >> k) & 1 > 0
        out[odd] = _advanced_once(table, out[odd])
    return out ^ crc_b.astype(np.uint32)


class WordScanner:
    """The automaton of a dictionary; words are bytes, read as Latin-1 characters."""

    def __init__(self, dictionary: list[bytes]):
        import ahocorasick

        self.automaton = ahocorasick.Automaton()
        for word in dictionary:
            self.automaton.add_word(f" {word.decode('latin-1')} ", zlib.crc32(word) << 16 | len(word))
        if dictionary:
            self.automaton.make_automaton()

    def payloads(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """CRC and size of every word of delimited ``texts`` in order, and words per text."""
        joined = b" " + b" ".join(texts) + b" "
        filled = np.frombuffer(joined, np.uint8) != 0x20
        first = filled.copy()
        first[1:] &= ~filled[:-1]
        begins = np.cumsum([1] + [len(t) + 1 for t in texts])[:-1]
        counts = np.add.reduceat(first, begins, dtype=np.int64)
        found, begin = [], 0
        while begin + 1 < len(joined):
            end = joined.find(b" ", min(begin + PIECE, len(joined) - 1))
            found.append(self._piece(joined[begin : end + 1], filled[begin : end + 1]))
            begin = end
        crc, size = (np.concatenate(c) for c in zip(*found))
        return crc, size, counts

    def _piece(self, joined: bytes, filled: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Payloads of the words of a piece that begins and ends with a blank."""
        matches = list(self.automaton.iter(joined.decode("latin-1"))) if len(self.automaton) else []
        flat = np.array(matches, np.int64).reshape(-1, 2)
        stop, crc, size = flat[:, 0], flat[:, 1] >> 16, flat[:, 1] & 0xFFFF
        before = np.concatenate([[0], np.cumsum(filled)])
        # words of no dictionary lie between a match and the next
        begin, end = np.append(0, stop), np.append(stop - size, len(joined))
        gaps = np.flatnonzero(before[end] > before[begin])
        missed = [joined[a:b].split() for a, b in zip(begin[gaps].tolist(), end[gaps].tolist())]
        at = np.repeat(gaps, [len(m) for m in missed])
        words = [w for m in missed for w in m]
        crc = np.insert(crc, at, [zlib.crc32(w) for w in words]).astype(np.uint32)
        return crc, np.insert(size, at, [len(w) for w in words])


def run_buckets(
    crc: np.ndarray, size: np.ndarray, counts: np.ndarray, max_words: int, buckets: int
) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of all runs of up to ``max_words`` words, text by text, and their number."""
    doc = np.repeat(np.arange(len(counts)), counts)
    runs, docs = [crc], [doc]
    blank = np.full(len(crc), zlib.crc32(b" "), np.uint32)
    lead = composed(blank, crc, size)  # a word after one blank
    for n in range(1, max_words):
        run = runs[-1][: max(0, len(crc) - n)]
        inside = doc[: len(run)] == doc[n : n + len(run)]
        # runs of n words that go on in their text, numbered by their first word
        last = composed(run, lead[n:], size[n:] + 1)
        runs.append(last)
        docs.append(np.where(inside, doc[: len(run)], -1))
    all_runs, all_docs = np.concatenate(runs), np.concatenate(docs)
    keep = all_docs >= 0
    order = np.argsort(all_docs[keep], kind="stable")
    kept = all_docs[keep]
    return (all_runs[keep][order] % np.uint32(buckets)).astype(np.uint16), np.bincount(kept, minlength=len(counts))


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def rows() -> pa.RecordBatch:
        return pa.record_batch(
            {"word": pa.array(list(counts), pa.binary()), "n": pa.array(list(counts.values()), pa.int64())}
        )

    counts: Counter = Counter()
    for part in arrow.slices(batches):
        for text in arrow.raw(part.column("text")):
            counts.update(delimited(text).split())
        if len(counts) > HELD:
            yield rows()
            counts.clear()
    yield rows()


_scanners: dict[int, WordScanner] = {}


def _scanner(dictionary) -> WordScanner:
    """One automaton for a worker process and broadcast dictionary."""
    known = _scanners.get(dictionary.value[0])
    if known is None:
        _scanners.clear()
        known = _scanners[dictionary.value[0]] = WordScanner(dictionary.value[1])
    return known


def _scan(dictionary, max_words: int, buckets: int):
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in arrow.slices(batches):
            texts = [delimited(t) for t in arrow.raw(part.column("text"))]
            crc, size, n_words = _scanner(dictionary).payloads(texts)
            found, n = run_buckets(crc, size, n_words, max_words, buckets)
            ends = np.cumsum(n).tolist()
            cells = [found[e - k : e].tobytes() for e, k in zip(ends, n.tolist())]
            keep = {c: part.column(c) for c in part.schema.names if c != "text"}
            yield pa.record_batch(
                keep
                | {
                    "n_words": pa.array(n_words, pa.int64()),
                    "n_features": pa.array(n, pa.int64()),
                    "buckets": pa.array(cells, pa.binary()),
                }
            )

    return scan


def _flat_buckets(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint16)


def _count_buckets(buckets: int):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = np.zeros(buckets, np.int64)
        for batch in batches:
            n += np.bincount(_flat_buckets(batch.column("buckets")), minlength=buckets)
        some = np.flatnonzero(n)
        yield pa.record_batch({"bucket": some.astype(np.int64), "n": n[some]})

    return count


def _weigh(gains):
    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.column("n_features").to_numpy()
            upto = np.concatenate([[0], np.cumsum(gains.value[_flat_buckets(batch.column("buckets"))])])
            ends = np.cumsum(n)
            weight = (upto[ends] - upto[ends - n]) // np.maximum(n, 1)
            yield batch.drop_columns(["buckets"]).append_column("weight", pa.array(weight, pa.int64()))

    return weigh


class ImportanceResampler:
    """Scores and draws rows of ``docs`` (doc_id, text) by likeness to ``target`` (text)."""

    def __init__(
        self,
        docs: DataFrame,
        target: DataFrame,
        max_words: int = MAX_WORDS,
        buckets: int = BUCKETS,
        min_words: int = MIN_WORDS,
        percent: int = PERCENT,
        seed: str = SEED,
        dictionary: int = DICTIONARY,
    ):
        if not 0 < buckets <= 1 << 16:
            raise ValueError("a bucket is stored in two bytes")
        self.docs, self.target, self.max_words, self.buckets = docs, target, max_words, buckets
        self.min_words, self.percent, self.seed, self.size = min_words, percent, seed, dictionary

    def dictionary(self) -> list[bytes]:
        """The most frequent distinct words of all texts, at most ``dictionary`` of them."""
        texts = self.docs.select("text").unionByName(self.target.select("text"))
        words = texts.mapInArrow(_count_words, "word binary, n bigint")
        words = words.where(F.length("word") <= LONGEST).groupBy("word").agg(F.sum("n").alias("n"))
        best = words.orderBy(F.desc("n"), "word").limit(self.size).toArrow()
        return best.column("word").to_pylist()

    def _scanned(self, rows: DataFrame, columns: str, dictionary, name: str) -> DataFrame:
        scan = _scan(dictionary, self.max_words, self.buckets)
        found = rows.mapInArrow(scan, f"{columns}n_words bigint, n_features bigint, buckets binary")
        return materialise(found, name)

    def _counts(self, scanned: DataFrame) -> np.ndarray:
        """Features in each bucket; ``buckets`` rows at most reach the driver."""
        counts = scanned.select("buckets").mapInArrow(_count_buckets(self.buckets), "bucket bigint, n bigint")
        found = counts.groupBy("bucket").agg(F.sum("n").alias("n")).toArrow()
        out = np.zeros(self.buckets, np.int64)
        out[found.column("bucket").to_numpy()] = found.column("n").to_numpy()
        return out

    def gains(self, all_counts: np.ndarray, target_counts: np.ndarray) -> np.ndarray:
        total, target = int(all_counts.sum()) + self.buckets, int(target_counts.sum()) + self.buckets
        return np.array(
            [
                math.floor(1000 * math.log((t + 1) * total / ((s + 1) * target)))
                for s, t in zip(all_counts.tolist(), target_counts.tolist())
            ],
            np.int64,
        )

    def scored(self) -> DataFrame:
        """(doc_id, h1, h2, n_words, n_features, weight, score) of every row."""
        share = self.docs.sparkSession.sparkContext.broadcast
        words = self.dictionary()
        dictionary = share((zlib.crc32(b" ".join(words)) << 20 | len(words), words))
        key = "doc_id bigint, h1 bigint, h2 bigint, "
        scanned = self._scanned(self.docs.select(*row_key(), "text"), key, dictionary, "buckets")
        target = self._scanned(self.target.select("text"), "", dictionary, "target")
        gains = share(self.gains(self._counts(scanned), self._counts(target)))
        weighed = scanned.mapInArrow(_weigh(gains), key + "n_words bigint, n_features bigint, weight bigint")
        drawn = F.concat(F.lit(f"{self.seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
        h = F.conv(F.substring(F.sha2(drawn, 256), 1, 8), 16, 10).cast("long")
        gumbel = F.floor(-1000 * F.log(-F.log((h + 0.5) / F.lit(4294967296.0))))
        return weighed.withColumn("score", F.col("weight") + gumbel.cast("long"))

    def ranked(self) -> DataFrame:
        """``scored`` with ``rank``: 1, 2, 3 ... of the drawn rows, null of all others."""
        able = F.col("n_words") >= self.min_words
        order = [F.desc("able"), F.desc("score"), F.asc_nulls_last("doc_id"), "h1", "h2"]
        placed = self.scored().withColumn("able", able).orderBy(*order)
        rows = materialise(placed.withColumn("place", F.monotonically_increasing_id()), "drawn")
        n = rows.where("able").count() * self.percent // 100
        # a place holds its file in the high bits and the row in the low 33
        rows = rows.withColumn("file", F.shiftright("place", 33)).withColumn(
            "place", F.col("place").bitwiseAND((1 << 33) - 1)
        )
        before = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
        starts = rows.groupBy("file").agg(F.count(F.lit(1)).alias("size"))
        starts = starts.select("file", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("start"))
        rank = F.col("start") + F.col("place") + 1
        ranked = rows.join(starts, "file").withColumn("rank", F.when(rank <= n, rank))
        return ranked.drop("able", "file", "place", "start")

    def drawn(self) -> DataFrame:
        """The rows of ``docs`` that are drawn; of rows equal in id and text, all or none."""
        keys = self.ranked().where("rank IS NOT NULL").select(F.col("doc_id").alias("_d"), "h1", "h2").distinct()
        names = self.docs.columns
        rows = self.docs.select(F.struct(*names).alias("row"), *row_key()[1:])
        same = F.col("row.doc_id").eqNullSafe(F.col("_d")) & (rows["h1"] == keys["h1"]) & (rows["h2"] == keys["h2"])
        return rows.join(keys, same, "left_semi").select("row.*")


def op13_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, target = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "benchmark"))
    ranked = ImportanceResampler(docs, target).ranked()
    return ranked.select("doc_id", "n_features", "weight", "score", "rank")
