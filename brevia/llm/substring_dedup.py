"""Substring dedup with automata of repeated phrases.

A window is ``WINDOW`` consecutive words. Its anchor is the run of ``GRAM`` words in it with
the smallest hash, so equal windows have equal anchors wherever they occur, and about a
fifth of all places are anchors. The steps:

1. Every text gives its anchors, its word count and the digest of its words. Texts equal
   word for word to one with a smaller id lose all their words and go no further.
2. Anchors found under two ids or more are recurring. Counting aggregates before its exchange.
   A Bloom filter of fixed size thins the anchors and the texts before they are exchanged;
   exact joins decide.
3. Windows with recurring anchors are counted by hash, and those found under two ids are
   confirmed, with the smallest id. Hashes choose what is compiled; texts are compared.
4. Confirmed windows are compiled, as text, to Aho-Corasick automata, one for a shard of
   anchors, and the passages of all texts that can hold one stream through the automaton of
   their shard. An anchor with many passages is dealt over several shards, which all get
   its windows.
5. A word goes if a window over it was found with a smaller id. Windows are judged on the input.

A null text has no words. A null id counts as smaller than all others. Rows with one id are
no copies of each other.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from brevia.llm import arrow, words
from brevia.llm.bloom import bloom, passes
from brevia.llm.common import row_key
from brevia.session import discard, materialise, scratch_path

WINDOW = 13
GRAM = 5
SHARD_PATTERNS = 20_000
SHARD_PASSAGES = 4_096
NO_ID = -(1 << 63)


_BLANKS = bytes.maketrans(b"\t\n\x0b\x0c\r", b" " * 5)
# a word's hash is the sum of its bytes' values times powers of an odd number, so one sum
# over all bytes gives those of all words
_BYTE = words.mix(np.arange(1, 257, dtype=np.uint64))
_BASE = 0x9E3779B97F4A7C15


def spaced(text: bytes) -> bytes:
    """The words of a text, joined by one blank."""
    text = text.translate(_BLANKS).strip(b" ")
    return b" ".join(text.split()) if b"  " in text else text


@lru_cache(maxsize=1)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base from 0 on, and those of its inverse, modulo 2^64."""
    out = []
    for base in (_BASE, pow(_BASE, -1, 1 << 64)):
        factors = np.full(n, base, np.uint64)
        factors[:1] = 1
        out.append(np.cumprod(factors, dtype=np.uint64))
    return out[0], out[1]


class Slice:
    """Words, windows and anchors of a slice of rows, as arrays over all its words."""

    def __init__(self, rows: pa.RecordBatch, window: int, gram: int):
        self.texts = [spaced(t) for t in arrow.raw(rows.column("text"))]
        self.data = b" ".join(self.texts) + b" "
        chars = np.frombuffer(self.data, np.uint8)
        blank = chars == 32
        before = np.append(True, blank[:-1])
        # first byte of every word, and the blank after it
        self.begin, self.end = np.flatnonzero(~blank & before), np.flatnonzero(blank & ~before)
        self.hashes = self._hashes(chars)
        tops = np.cumsum([len(t) + 1 for t in self.texts]).astype(np.int64)
        self.sizes = np.diff(np.searchsorted(self.begin, tops), prepend=0)
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.doc = np.repeat(np.arange(len(self.sizes)), self.sizes)
        grams, span = words.grams(self.hashes, gram), window - gram + 1
        n = max(0, len(self.hashes) - window + 1)
        self.place = np.empty(0, np.int64)
        if n:
            view = np.lib.stride_tricks.sliding_window_view(grams, span)
            self.place = view.argmin(axis=1) + np.arange(n)
        self.valid = self.doc[:n] == self.doc[len(self.doc) - n :]
        self.anchor = grams[self.place]

    def _hashes(self, chars: np.ndarray) -> np.ndarray:
        up, down = _powers(1 << max(21, len(chars).bit_length()))
        sums = np.append(np.uint64(0), np.cumsum(_BYTE[chars] * up[: len(chars)], dtype=np.uint64))
        return words.mix((sums[self.end] - sums[self.begin]) * down[self.begin])

    def fresh(self, mask: np.ndarray) -> np.ndarray:
        """Windows of ``mask`` that begin a run with one anchor and without a gap."""
        new, doc = mask.copy(), self.doc[: len(mask)]
        new[1:] &= ~(mask[:-1] & (self.place[1:] == self.place[:-1]) & (doc[1:] == doc[:-1]))
        return new

    def _keys(self, rows: pa.RecordBatch) -> np.ndarray:
        """Hashes of the row and anchor of the row's ``anchors``."""
        of = np.repeat(np.arange(len(rows)), rows.column("anchors").value_lengths().to_numpy())
        return _joined(rows.column("anchors").flatten().to_numpy().view(np.uint64), of)

    def marked(self, rows: pa.RecordBatch) -> np.ndarray:
        """Valid windows whose anchor is among the row's ``anchors``."""
        return self.valid & np.isin(_joined(self.anchor, self.doc[: len(self.anchor)]), self._keys(rows))

    def salts(self, rows: pa.RecordBatch, at: np.ndarray) -> np.ndarray:
        """The row's ``salts`` for the anchors of marked windows."""
        keys = self._keys(rows)
        by = np.argsort(keys)
        found = by[np.searchsorted(keys[by], _joined(self.anchor[at], self.doc[at]))]
        return rows.column("salts").flatten().to_numpy()[found].astype(np.int64)


def _joined(anchor: np.ndarray, doc: np.ndarray) -> np.ndarray:
    return words.mix(anchor ^ words.mix(doc.astype(np.uint64) + np.uint64(1)))


def _scan(window: int, gram: int):
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in arrow.slices(batches):
            own = Slice(rows, window, gram)
            new = np.flatnonzero(own.fresh(own.valid))
            counts = np.bincount(own.doc[new], minlength=len(rows))
            offsets = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
            out = {
                "id": rows.column("id"),
                "h1": rows.column("h1"),
                "h2": rows.column("h2"),
                "n_words": pa.array(own.sizes, pa.int64()),
                "digest": pa.array([hashlib.sha256(t).digest() for t in own.texts], pa.binary()),
                "anchors": pa.ListArray.from_arrays(offsets, words.signed(own.anchor[new])),
            }
            yield pa.record_batch(out)

    return scan


def _thin(bits):
    def thin(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            anchors = batch.column("anchors").flatten().to_numpy()
            counts = batch.column("anchors").value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
            at = np.repeat(np.arange(len(counts)), counts)
            keep = passes(bits.value, anchors)
            ids = batch.column("id").to_numpy()
            yield pa.record_batch({"anchor": anchors[keep], "id": ids[at[keep]]})

    return thin


def _likely(bits):
    def likely(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = passes(bits.value, batch.column("hashed").to_numpy())
            yield batch.filter(pa.array(keep)).drop_columns(["hashed"])

    return likely


def _windows(window: int, gram: int):
    """(id, w) of the windows with recurring anchors, w a hash."""

    def hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in arrow.slices(batches):
            own = Slice(rows, window, gram)
            at = np.flatnonzero(own.marked(rows))
            w = words.signed(words.grams(own.hashes, window, 1)[at])
            yield pa.record_batch({"id": rows.column("id").to_numpy()[own.doc[at]], "w": w})

    return hashes


def _sourced(w: np.ndarray, ids: np.ndarray) -> np.ndarray:
    return words.signed(words.mix(w.view(np.uint64) ^ words.mix(ids.view(np.uint64))))


def _confirmed_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        w, first = batch.column("w").to_numpy(), batch.column("first").to_numpy()
        yield pa.record_batch({"w": w, "sourced": _sourced(w, first)})


PASSAGES = "kind int, id bigint, h1 bigint, h2 bigint, anchor bigint, salt int, n_salts int, at bigint, text string"
_PASSAGE_TYPES = [pa.int32()] + [pa.int64()] * 4 + [pa.int32()] * 2 + [pa.int64(), pa.string()]


def _passages(window: int, gram: int, confirmed, sourced):
    """Runs of windows with one anchor that are likely confirmed (kind 1) and, apart, that
    are likely the first of their kind (kind 0). Both tests may let too much pass: a window
    found where it does occur is no error, and one found nowhere else removes nothing."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in arrow.slices(batches):
            own = Slice(rows, window, gram)
            w = words.signed(words.grams(own.hashes, window, 1))
            likely = own.marked(rows) & passes(confirmed.value, w)
            ids, h1, h2 = (rows.column(c).to_numpy() for c in ("id", "h1", "h2"))
            source = likely & passes(sourced.value, _sourced(w, ids[own.doc[: len(w)]]))
            for kind, mask in ((0, source), (1, likely)):
                at, begin = np.flatnonzero(mask), np.flatnonzero(own.fresh(mask))
                if not len(at):
                    continue
                last = at[np.append(np.searchsorted(at, begin)[1:], len(at)) - 1]
                d, n = own.doc[begin], own.salts(rows, begin)
                ends = zip(own.begin[begin].tolist(), own.end[last + window - 1].tolist())
                text = pa.array([own.data[a:b] for a, b in ends], pa.binary()).cast(pa.string())
                columns = [np.full(len(d), kind), ids[d], h1[d], h2[d], words.signed(own.anchor)[begin]]
                columns += [h1[d] % n, n, begin - own.starts[d], text]
                columns = [c if c is text else pa.array(c).cast(t) for c, t in zip(columns, _PASSAGE_TYPES)]
                yield pa.record_batch(columns, names=[c.split()[0] for c in PASSAGES.split(", ")])

    return cut


def _locate(window: int):
    """Builds the automaton of a shard from its first rows and streams the others.

    Its letters are whole words, numbered as they come; a word of no pattern is 0.
    """

    def locate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import ahocorasick

        shard, automaton, ready, numbers = None, None, False, {}
        names = ("shard", "kind", "id", "h1", "h2", "at", "text")
        schema = pa.schema([(c, pa.int64()) for c in ("id", "h1", "h2", "begin", "stop")])
        for batch in batches:
            out = []
            for of, kind, own_id, h1, h2, at, text in zip(*[batch.column(c).to_pylist() for c in names]):
                if of != shard:
                    shard, ready, numbers = of, False, {}
                    automaton = ahocorasick.Automaton(ahocorasick.STORE_ANY, ahocorasick.KEY_SEQUENCE)
                tokens = text.split(" ")
                if kind == 0:
                    letters = tuple([numbers.setdefault(w, len(numbers) + 1) for w in tokens])
                    for k in range(len(letters) - window + 1):
                        pattern = letters[k : k + window]
                        if automaton.get(pattern, own_id) >= own_id:
                            automaton.add_word(pattern, own_id)
                    continue
                if not ready:
                    automaton.make_automaton()
                    ready = True
                if not len(automaton):
                    continue
                letters, begin, stop = tuple([numbers.get(w, 0) for w in tokens]), None, None
                for last, first_id in automaton.iter(letters):
                    if first_id >= own_id:
                        continue
                    end = at + last + 1
                    if stop is None or end - window > stop:
                        if stop is not None:
                            out.append((own_id, h1, h2, begin, stop))
                        begin = end - window
                    stop = end
                if stop is not None:
                    out.append((own_id, h1, h2, begin, stop))
            columns = list(zip(*out)) or [[]] * 5
            yield pa.record_batch([pa.array(c, pa.int64()) for c in columns], schema=schema)

    return locate


def _remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = []
        for row in batch.to_pylist():
            tokens = (row["text"] or "").encode().split()
            keep = np.ones(len(tokens), bool)
            for span in row["spans"]:
                if (span["h1"], span["h2"]) == (row["h1"], row["h2"]):
                    keep[span["begin"] : span["stop"]] = False
            kept = [t for t, k in zip(tokens, keep.tolist()) if k]
            digest = hashlib.sha256(b" ".join(kept)).digest()
            out.append([row["id"], row["h1"], row["h2"], len(tokens) - len(kept), digest])
        columns = list(zip(*out)) or [[]] * 5
        types = [pa.int64()] * 4 + [pa.binary()]
        yield pa.record_batch(
            [pa.array(c, t) for c, t in zip(columns, types)], names=["id", "h1", "h2", "n_removed", "kept"]
        )


def _bucketed(df: DataFrame, by: str, name: str) -> DataFrame:
    """A written table in buckets, which joins by ``by`` read without another exchange."""
    spark = df.sparkSession
    table = f"{name}_{uuid.uuid4().hex}"
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    writer = df.write.bucketBy(n, by).option("path", scratch_path(spark, name))
    writer.saveAsTable(table)
    return spark.table(table)


def remove_repeats(docs: DataFrame, window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_sha256) of every row of (doc_id, text)."""
    share = docs.sparkSession.sparkContext.broadcast
    key = ["id", "h1", "h2"]
    rank = F.coalesce("doc_id", F.lit(NO_ID)).alias("id")
    texts = docs.select(rank, *row_key()[1:], "text")
    scanned = texts.mapInArrow(
        _scan(window, gram),
        "id bigint, h1 bigint, h2 bigint, n_words bigint, digest binary, anchors array<bigint>",
    )
    scanned = materialise(scanned, "anchors")
    firsts = materialise(scanned.groupBy("digest").agg(F.min("id").alias("first")), "firsts")
    short = materialise(scanned.drop("anchors").join(firsts, "digest"), "copies")
    copy = (F.col("id") > F.col("first")) & (F.col("n_words") >= window)

    ends = scanned.select("id", F.explode("anchors").alias("anchor")).groupBy("anchor")
    ends = ends.agg(F.min("id").alias("lo"), F.max("id").alias("hi"), F.count(F.lit(1)).alias("n"))
    recurring = materialise(ends.where("lo < hi").select("anchor", "n"), "recurring")
    likely = scanned.select("id", "anchors").mapInArrow(
        _thin(share(bloom(recurring, F.col("anchor")))), "anchor bigint, id bigint"
    )
    salts = F.ceil(F.col("n") / SHARD_PASSAGES).cast("int").alias("salts")
    hits = likely.join(recurring, "anchor").select("id", F.struct("anchor", salts).alias("hit"))
    hits = hits.groupBy("id").agg(F.collect_set("hit").alias("hits"))
    # ids whose rows are all copies go no further
    owners = short.where(~copy).select("id").distinct()
    hits = hits.select("id", F.col("hits.anchor").alias("anchors"), F.col("hits.salts").alias("salts"))
    hits = materialise(hits.join(owners, "id", "left_semi"), "hits")

    marked = texts.withColumn("hashed", F.xxhash64("id")).mapInArrow(
        _likely(share(bloom(hits, F.xxhash64("id")))), "id bigint, h1 bigint, h2 bigint, text string"
    )
    marked = _bucketed(marked.join(hits, "id"), "id", "marked")
    discard(scanned, recurring, hits)
    counted = marked.mapInArrow(_windows(window, gram), "id bigint, w bigint").groupBy("w")
    confirmed = counted.agg(F.min("id").alias("first"), F.max("id").alias("last")).where("first < last")
    confirmed = confirmed.select("w", "first").mapInArrow(_confirmed_keys, "w bigint, sourced bigint")
    confirmed = materialise(confirmed, "confirmed")
    bits = [share(bloom(confirmed, F.col(c))) for c in ("w", "sourced")]
    shards = max(1, -(-confirmed.count() // SHARD_PATTERNS))
    passages = marked.mapInArrow(_passages(window, gram, *bits), PASSAGES)
    # the windows of an anchor go to all its shards, a passage to one
    all_salts = F.sequence(F.lit(0), F.col("n_salts") - 1)
    passages = passages.withColumn("salt", F.explode(F.when(F.col("kind") == 0, all_salts).otherwise(F.array("salt"))))
    shard = F.pmod(F.xxhash64("anchor", "salt"), F.lit(shards)).alias("shard")
    dealt = passages.select(shard, "kind", "id", "h1", "h2", "at", "text")
    dealt = dealt.repartition("shard").sortWithinPartitions("shard", "kind")
    spans = dealt.mapInArrow(_locate(window), "id bigint, h1 bigint, h2 bigint, begin bigint, stop bigint")
    spans = spans.groupBy("id").agg(F.collect_list(F.struct("h1", "h2", "begin", "stop")).alias("spans"))
    changed = marked.select(*key, "text").join(materialise(spans, "spans"), "id")
    changed = changed.mapInArrow(_remove, "id bigint, h1 bigint, h2 bigint, n_removed bigint, kept binary")
    changed = materialise(changed, "changed").dropDuplicates(key)

    out = short.join(changed, key, "left")
    nothing = F.sha2(F.lit(""), 256)
    return out.select(
        F.nullif("id", F.lit(NO_ID)).alias("doc_id"),
        "n_words",
        F.when(copy, F.col("n_words")).otherwise(F.coalesce("n_removed", F.lit(0))).alias("n_removed"),
        F.when(copy, nothing).otherwise(F.lower(F.hex(F.coalesce("kept", "digest")))).alias("kept_sha256"),
    )


def op9_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(spark.read.parquet(f"{sf_dir}/documents.parquet"))
