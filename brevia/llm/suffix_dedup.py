"""Repeated byte strings by suffix arrays of shards, in bounded parts and exactly.

A window is ``WINDOW`` bytes of one text; a window that also starts anywhere else is
repeated, and every byte of it goes. Its anchor is the run of ``GRAM`` bytes in it with the
smallest hash (all of them in a tie), so equal windows have equal anchors wherever they lie.

1. A text gives its anchors: place, hash of the run, and a digest of its passage, which are
   all bytes of windows that can have this anchor. Equal texts are one row with a count.
2. Anchors are counted by hash, aggregated before the exchange. One found once has unique
   windows. Where all passages of an anchor are equal, they go whole. So do texts that
   occur twice.
3. The other anchors, those with several passages, send one copy of each distinct passage
   to a shard. A shard sorts the suffixes of its passages (Larsson and Sadakane's refinement:
   eight bytes first, then groups by the rank 8, 16, 32 ... bytes further on, until none is
   left) and takes common prefixes with Kasai's scan, run in many lanes. Suffixes
   that share a window's length are one group of equal windows.
4. An anchor with very many passages is dealt over several shards, each of bounded size.
   Each hands on its windows found once, as runs sorted by digest, and the runs are merged
   by binary search: a window that a second run has is repeated.
5. Spans found in passages are moved to the places of their anchors and cut out of the texts.

Anchors and window digests decide what meets, 64 and 128 bits; bytes are compared in the
shards. A null text is empty. Rows that repeat an id are texts of their own; a null id is an
id like any other, as rows are known by their text. Empty tables give no rows. Other columns
are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from brevia.llm import arrow
from brevia.llm.common import row_key, text_of
from brevia.llm.words import mix
from brevia.session import discard, materialise

WINDOW = 200
GRAM = 132
# Passage bytes of a shard, and passages of one anchor that stay in one shard.
SHARD_BYTES = 1 << 21
SHARD_PASSAGES = 6_144
# Windows a task of the merge gets on average.
RUN_ROWS = 1 << 19
# Rows of equal texts a task remembers, so that it reads each of them once.
REMEMBERED = 1 << 18

_BASE = np.uint64(0x9E3779B97F4A7C15)


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
# Bytes that are hashed at once; blocks overlap by a run.
BLOCK = 1 << 20
_UP, _DOWN = _powers(_BASE, 2 * BLOCK), _powers(_INVERSE, 2 * BLOCK)


def run_hashes(data: np.ndarray, gram: int) -> np.ndarray:
    """A hash of each run of ``gram`` bytes."""
    out = []
    for begin in range(0, max(0, len(data) - gram + 1), BLOCK):
        block = data[begin : begin + BLOCK + gram - 1]
        sums = np.zeros(len(block) + 1, np.uint64)
        np.cumsum((block.astype(np.uint64) + np.uint64(1)) * _UP[: len(block)], out=sums[1:])
        n = len(block) - gram + 1
        out.append(mix((sums[gram:] - sums[:n]) * _DOWN[:n]))
    return np.concatenate(out) if out else np.empty(0, np.uint64)


def _sliding(values: np.ndarray, span: int, best) -> np.ndarray:
    """``best`` (minimum or maximum) of every ``span`` consecutive values, by doubling."""
    width = 1
    while 2 * width <= span:
        values = best(values[:-width], values[width:])
        width *= 2
    rest = span - width
    return best(values[:-rest], values[rest:]) if rest else values


def anchors(data: np.ndarray, window: int, gram: int) -> tuple[np.ndarray, np.ndarray]:
    """Places and hashes of the anchors of all windows of a text."""
    span = window - gram + 1
    if len(data) < window:
        return np.empty(0, np.int64), np.empty(0, np.uint64)
    hashes = run_hashes(data, gram)
    least = _sliding(hashes, span, np.minimum)
    # a place is an anchor if some window over it has its hash as minimum
    padded = np.concatenate([np.zeros(span - 1, np.uint64), least, np.zeros(span - 1, np.uint64)])
    at = np.flatnonzero(_sliding(padded, span, np.maximum) == hashes)
    return at, hashes[at]


# An anchor of a text, as it is stored; a text is shorter than 2 GB.
_CELL = np.dtype([("at", "<i4"), ("anchor", "<i8"), ("passage", "<i8")])


def _keys(rows: pa.RecordBatch) -> list[tuple[int, int]]:
    return list(zip(rows.column("h1").to_pylist(), rows.column("h2").to_pylist()))


def _scan(window: int, gram: int):
    left, right = window - gram, window

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set = set()
        for rows in arrow.slices(batches):
            texts, keys = arrow.raw(rows.column("text")), _keys(rows)
            out = []
            for text, key in zip(texts, keys):
                if key in seen or len(text) < window:
                    out.append(None)
                    continue
                if len(seen) < REMEMBERED:
                    seen.add(key)
                at, hashes = anchors(np.frombuffer(text, np.uint8), window, gram)
                view, digest = memoryview(text), xxhash.xxh3_64_intdigest
                passages = [digest(view[max(0, p - left) : p + right]) for p in at.tolist()]
                cells = np.empty(len(at), _CELL)
                cells["at"], cells["anchor"], cells["passage"] = at, hashes.view(np.int64), np.array(passages, np.uint64).view(np.int64)
                out.append(cells.tobytes())
            yield pa.record_batch(
                {
                    "h1": rows.column("h1"),
                    "h2": rows.column("h2"),
                    "n_bytes": pa.array([len(t) for t in texts], pa.int64()),
                    "cells": pa.array(out, pa.binary()),
                }
            )

    return scan


OCCURRENCES = "h1 bigint, h2 bigint, n_bytes bigint, n bigint, at bigint, anchor bigint, passage bigint"


def _occurrences(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        cells = batch.column("cells").to_pylist()
        counts = np.array([len(c) // _CELL.itemsize for c in cells], np.int64)
        flat = np.frombuffer(b"".join(cells), _CELL)
        names = ["h1", "h2", "n_bytes", "n"]
        out = {c: np.repeat(batch.column(c).to_numpy(), counts) for c in names}
        yield pa.record_batch(out | {c: pa.array(flat[c].astype(np.int64)) for c in _CELL.names})


PASSAGES = "anchor bigint, passage bigint, n bigint, subs int, t1 bigint, begin bigint, bytes binary"


def _cut_passages(window: int, gram: int):
    """The passages that a text is asked for; a task reads each of its equal texts once."""
    left, right = window - gram, window

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema(
            [(c, pa.int64()) for c in ("anchor", "passage", "n")]
            + [("subs", pa.int32()), ("t1", pa.int64()), ("begin", pa.int64()), ("bytes", pa.binary())]
        )
        seen: set = set()
        for rows in arrow.slices(batches):
            texts, out = arrow.raw(rows.column("text")), []
            for text, key, asked in zip(texts, _keys(rows), rows.column("wanted")):
                if key in seen:
                    continue
                if len(seen) < REMEMBERED:
                    seen.add(key)
                for w in asked.as_py():
                    begin = max(0, w["at"] - left)
                    out.append((w["anchor"], w["passage"], w["n"], w["subs"], key[0] ^ key[1], begin, text[begin : w["at"] + right]))
            columns = list(zip(*out)) or [[]] * len(schema)
            yield pa.record_batch([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)

    return cut


def eight_bytes(data: np.ndarray) -> np.ndarray:
    """The eight bytes from each place on as one number, zeros beyond the end."""
    padded = np.concatenate([data, np.zeros(7, np.uint8)])
    words = np.lib.stride_tricks.sliding_window_view(padded, 8)
    return np.ascontiguousarray(words).view(">u8").reshape(-1).astype(np.uint64)


def suffix_order(data: np.ndarray) -> np.ndarray:
    """The suffix array of ``data``, which should end with a byte found nowhere else."""
    n = len(data)
    rank = eight_bytes(data)
    order = np.argsort(rank)
    head = np.ones(n, bool)
    head[1:] = rank[order[1:]] != rank[order[:-1]]
    place = np.empty(n + 1, np.int64)
    place[n] = -1
    start = np.flatnonzero(head)
    place[order] = np.repeat(start, np.diff(np.append(start, n)))
    done = 8
    while True:
        # groups of two or more suffixes, which alone are refined
        single = head & np.append(head[1:], True)
        slots = np.flatnonzero(~single)
        if not len(slots):
            break
        suffix = order[slots]
        group = place[suffix]
        further = place[np.minimum(suffix + done, n)] + 1
        code = (group.astype(np.uint64) << np.uint64(32)) | further.astype(np.uint64)
        by = np.argsort(code)
        suffix, code = suffix[by], code[by]
        order[slots] = suffix
        new = np.ones(len(slots), bool)
        new[1:] = code[1:] != code[:-1]
        head[slots] = new
        begin = np.flatnonzero(new)
        place[suffix] = np.repeat(slots[begin], np.diff(np.append(begin, len(slots))))
        done *= 2
    return order


LANE = 64


def common_prefixes(data: np.ndarray, order: np.ndarray, most: int) -> np.ndarray:
    """Bytes that each suffix in ``order`` shares with the one before it, up to ``most``.

    Kasai's scan goes by text position, and a suffix shares at least what the one a byte
    earlier shared, less one. Every ``LANE`` bytes a lane begins anew; all lanes take their
    next step together and compare eight bytes at once.
    """
    n = len(data)
    before = np.full(n, -1, np.int64)
    before[order[1:]] = order[:-1]
    shared = np.zeros(n, np.int64)
    words = np.append(eight_bytes(data), np.zeros(1, np.uint64))
    lanes = np.arange(0, n, LANE)
    length = np.zeros(len(lanes), np.int64)
    for step in range(min(LANE, n)):
        at = lanes + step
        if at[-1] >= n:
            lanes, length, at = lanes[:-1], length[:-1], at[:-1]
        other = before[at]
        length = np.where(other < 0, 0, np.maximum(length - 1, 0))
        live = np.flatnonzero((other >= 0) & (length < most))
        while len(live):
            a, b = at[live] + length[live], other[live] + length[live]
            differ = words[np.minimum(a, n)] ^ words[np.minimum(b, n)]
            # equal leading bytes, none of them beyond the end
            alike = np.where(differ == 0, 8, (64 - _bits(differ)) >> 3)
            alike = np.minimum(alike, n - np.maximum(a, b))
            length[live] += alike
            live = live[(alike == 8) & (length[live] < most)]
        shared[at] = np.minimum(length, most)
    return shared[order]


def _bits(x: np.ndarray) -> np.ndarray:
    """Bits up to the highest that is set."""
    x = x.copy()
    for k in (1, 2, 4, 8, 16, 32):
        x |= x >> np.uint64(k)
    return np.bitwise_count(x).astype(np.int64)


def equal_windows(passages: list[bytes], window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(passage, place, group) of all windows, equal windows in one group."""
    # no UTF-8 text has the byte 0xFF, so no window reaches the end of the data
    data = np.frombuffer(b"".join(passages) + b"\xff" * window, np.uint8)
    sizes = np.array([len(p) for p in passages], np.int64)
    ends = np.cumsum(sizes)
    order = suffix_order(data)
    group = np.cumsum(common_prefixes(data, order, window) < window)
    inside = order < ends[-1]
    order, group = order[inside], group[inside]
    of = np.searchsorted(ends, order, "right")
    whole = order + window <= ends[of]  # others reach into the next passage
    order, group, of = order[whole], group[whole], of[whole]
    return of, order - (ends - sizes)[of], group


SPANS = "kind int, anchor bigint, passage bigint, begin bigint, stop bigint, w1 bigint, w2 bigint, sub bigint, place bigint"
_SPAN_NAMES = [c.split()[0] for c in SPANS.split(", ")]


def _spans(passage: np.ndarray, place: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(passage, begin, stop) of the bytes that windows cover, runs of them joined."""
    by = np.lexsort((place, passage))
    passage, place = passage[by], place[by]
    new = np.ones(len(place), bool)
    new[1:] = (passage[1:] != passage[:-1]) | (place[1:] > place[:-1] + window)
    begin = np.flatnonzero(new)
    last = np.append(begin[1:], len(place)) - 1 if len(place) else begin
    return passage[begin], place[begin], place[last] + window


def _span_rows(kind: int, columns: dict) -> pa.RecordBatch:
    n = len(columns["anchor"])
    zero = np.zeros(n, np.int64)
    types = [pa.int32()] + [pa.int64()] * (len(_SPAN_NAMES) - 1)
    cells = {"kind": np.full(n, kind, np.int32)} | columns
    return pa.record_batch([pa.array(cells.get(c, zero), t) for c, t in zip(_SPAN_NAMES, types)], names=_SPAN_NAMES)


def _shard_spans(window: int):
    """Repeated spans of each shard's passages (kind 0) and, of anchors that are dealt over
    several shards, the windows that are found once in this one (kind 1)."""

    def one(rows: list[dict]) -> Iterator[pa.RecordBatch]:
        column = lambda c: np.array([r[c] for r in rows], np.int64)
        anchor, passage, n, subs, text, begin = map(column, ("anchor", "passage", "n", "subs", "t1", "begin"))
        sub = np.array([r["sub"] for r in rows], np.int64)
        cells = [r["bytes"] for r in rows]
        of, place, group = equal_windows(cells, window)
        # a place of a text that several passages hold counts once
        spot = text[of] * 1_000_003 + begin[of] + place
        _, group = np.unique(group, return_inverse=True)
        by = np.lexsort((spot, group))
        other = np.ones(len(by), bool)
        other[1:] = (group[by][1:] != group[by][:-1]) | (spot[by][1:] != spot[by][:-1])
        found = np.bincount(group[by][other], minlength=group.max(initial=-1) + 1)
        # a passage that itself occurs twice goes whole elsewhere, and its windows are elsewhere
        found += np.bincount(group[n[of] > 1], minlength=len(found))
        repeated = found[group] > 1
        p, a, b = _spans(of[repeated], place[repeated], window)
        yield _span_rows(0, {"anchor": anchor[p], "passage": passage[p], "begin": a, "stop": b})
        first = np.zeros(len(group), bool)
        first[np.unique(group, return_index=True)[1]] = True
        # once in this shard: to be looked for; more often: one of them, to be found
        open_ = (subs[of] > 1) & (~repeated | first)
        p, a = of[open_], place[open_]
        digests = [xxhash.xxh3_128_digest(cells[i][k : k + window]) for i, k in zip(p.tolist(), a.tolist())]
        w = np.frombuffer(b"".join(digests), np.int64).reshape(-1, 2)
        yield _span_rows(
            1,
            {
                "anchor": anchor[p], "passage": passage[p], "begin": a, "stop": repeated[open_].astype(np.int64),
                "w1": w[:, 0], "w2": w[:, 1], "sub": sub[p], "place": spot[open_],
            },
        )

    def spans(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, rows = None, []
        for batch in batches:
            for row in batch.to_pylist():
                if row["shard"] != shard and rows:
                    yield from one(rows)
                    rows = []
                shard = row["shard"]
                rows.append(row)
        if rows:
            yield from one(rows)

    return spans


def _merge_runs(window: int):
    """Windows of sorted runs that another run has too, found by binary search."""

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = list(batches)
        if not rows:
            return
        table = pa.Table.from_batches(rows)
        cell = {c: table.column(c).to_numpy() for c in _SPAN_NAMES[1:]}
        code, known = np.zeros(len(table), np.uint64), cell["stop"] > 0
        for c in ("w1", "w2", "anchor"):
            code = mix(code ^ cell[c].view(np.uint64)) * _BASE
        hit = np.zeros(len(code), bool)
        runs = [np.flatnonzero(cell["sub"] == s) for s in np.unique(cell["sub"])]
        merged = np.empty(0, np.int64)
        for run in runs:
            run = run[np.argsort(code[run], kind="stable")]
            low = np.searchsorted(code[merged], code[run], "left")
            same = np.zeros(len(run), bool)
            if len(merged):
                near = merged[np.minimum(low, len(merged) - 1)]
                same = code[near] == code[run]
                mine, theirs = run[same], near[same]
                # one place of a text in two passages is no repeat by itself
                apart = (cell["place"][mine] != cell["place"][theirs]) | known[mine] | known[theirs]
                hit[mine[apart]] = hit[theirs[apart]] = known[theirs[apart]] = True
            merged = np.insert(merged, low[~same], run[~same])
        at = np.flatnonzero(hit)
        of, inverse = np.unique(
            np.stack([cell["anchor"][at], cell["passage"][at]]), axis=1, return_inverse=True
        )
        p, begin, stop = _spans(inverse.reshape(-1), cell["begin"][at], window)
        yield _span_rows(0, {"anchor": of[0][p], "passage": of[1][p], "begin": begin, "stop": stop})

    return merge


def _cut_texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for rows in arrow.slices(batches):
        removed, n_spans, kept = [], [], []
        for text, spans in zip(arrow.raw(rows.column("text")), rows.column("spans")):
            parts, at, gone, count = [], 0, 0, 0
            cells = np.frombuffer(spans.as_py(), np.int64).reshape(-1, 2)
            for begin, stop in cells.tolist():
                parts.append(text[at:begin])
                gone, count, at = gone + stop - begin, count + 1, stop
            parts.append(text[at:])
            removed.append(gone)
            n_spans.append(count)
            kept.append(hashlib.sha256(b"".join(parts)).hexdigest())
        out = {c: rows.column(c) for c in ("doc_id", "n_bytes")}
        out |= {"n_removed": pa.array(removed, pa.int64()), "n_spans": pa.array(n_spans, pa.int64())}
        yield pa.record_batch(out | {"kept_sha256": pa.array(kept, pa.string())})


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Spans of each text in order, those that touch joined, as bytes."""
    for batch in batches:
        out = []
        for begins, stops in zip(batch.column("begins"), batch.column("stops")):
            begin = np.array(begins.as_py(), np.int64)
            stop = np.array(stops.as_py(), np.int64)
            by = np.argsort(begin, kind="stable")
            begin, reach = begin[by], np.maximum.accumulate(stop[by])
            new = np.ones(len(begin), bool)
            new[1:] = begin[1:] > reach[:-1]
            at = np.flatnonzero(new)
            out.append(np.stack([begin[at], reach[np.append(at[1:], len(begin)) - 1]]).T.tobytes())
        yield pa.record_batch(
            {"h1": batch.column("h1"), "h2": batch.column("h2"), "spans": pa.array(out, pa.binary())}
        )


class SuffixDedup:
    """Removal of repeated windows of bytes from rows (doc_id, text)."""

    def __init__(
        self,
        docs: DataFrame,
        window: int = WINDOW,
        gram: int | None = None,
        shard_bytes: int = SHARD_BYTES,
        shard_passages: int = SHARD_PASSAGES,
    ):
        self.window, self.gram = window, gram or min(GRAM, window)
        self.shard_bytes, self.shard_passages = shard_bytes, shard_passages
        self.docs = docs.select(*row_key(), text_of().alias("text"))

    def texts(self) -> DataFrame:
        """(h1, h2, n_bytes, n, cells): each distinct text, its rows and its anchors."""
        scanned = self.docs.select("h1", "h2", "text").mapInArrow(
            _scan(self.window, self.gram), "h1 bigint, h2 bigint, n_bytes bigint, cells binary"
        )
        equal = scanned.groupBy("h1", "h2").agg(
            F.max("n_bytes").alias("n_bytes"),
            F.count(F.lit(1)).alias("n"),
            F.first("cells", ignorenulls=True).alias("cells"),
        )
        return materialise(equal, "texts")

    def spans(self, texts: DataFrame) -> DataFrame:
        """(h1, h2, spans): repeated bytes of the texts that occur once."""
        window, left = self.window, self.window - self.gram
        occurrences = texts.where("cells IS NOT NULL").mapInArrow(_occurrences, OCCURRENCES)
        counted = occurrences.groupBy("anchor").agg(
            F.sum("n").alias("found"), F.min("passage").alias("lo"), F.max("passage").alias("hi")
        )
        recurring = counted.where("found > 1").select("anchor", (F.col("lo") != F.col("hi")).alias("mixed"))
        recurring = materialise(recurring, "recurring")
        marked = materialise(occurrences.join(recurring, "anchor"), "marked")

        # one copy of each passage of a mixed anchor, with the number of its occurrences
        first = F.min(F.struct("h1", "h2", "at")).alias("first")
        passages = marked.where("mixed").groupBy("anchor", "passage").agg(F.sum("n").alias("n"), first)
        passages = materialise(passages, "passages")
        size = F.ceil(F.count(F.lit(1)) / F.lit(self.shard_passages)).cast("int").alias("subs")
        hot = materialise(passages.groupBy("anchor").agg(size).where("subs > 1"), "hot")
        asked = passages.join(hot, "anchor", "left").select(
            F.col("first.h1").alias("h1"), F.col("first.h2").alias("h2"),
            F.struct("anchor", "passage", "n", F.coalesce("subs", F.lit(1)).alias("subs"), F.col("first.at").alias("at")).alias("w"),
        )
        asked = materialise(asked.groupBy("h1", "h2").agg(F.collect_list("w").alias("wanted")), "asked")
        cut = self.docs.join(asked, ["h1", "h2"]).select("h1", "h2", "text", "wanted")
        cut = cut.mapInArrow(_cut_passages(window, self.gram), PASSAGES)
        found = materialise(self._dealt(cut, passages).mapInArrow(_shard_spans(window), SPANS), "found")
        runs = found.where("kind = 1")
        n_runs = runs.count()
        in_passages = found.where("kind = 0")
        if n_runs:
            # each task merges the runs of its range of digests
            ranged = runs.repartitionByRange(n_runs // RUN_ROWS + 1, "w1")
            in_passages = in_passages.unionByName(ranged.mapInArrow(_merge_runs(window), SPANS))
        in_passages = in_passages.select("anchor", "passage", "begin", "stop")

        # texts that occur twice go whole and need no spans
        single = marked.where("n = 1").select("h1", "h2", "n_bytes", "at", "anchor", "passage", "mixed")
        begin = F.greatest(F.lit(0), F.col("at") - left)
        whole = F.least("n_bytes", F.col("at") + window)
        often = passages.where("n > 1").select("anchor", "passage")
        rows = [
            single.where("NOT mixed").select("h1", "h2", begin.alias("begin"), whole.alias("stop")),
            single.where("mixed").join(often, ["anchor", "passage"]).select("h1", "h2", begin.alias("begin"), whole.alias("stop")),
            single.where("mixed")
            .withColumn("from", begin)
            .drop("begin")
            .join(in_passages, ["anchor", "passage"])
            .select("h1", "h2", (F.col("from") + F.col("begin")).alias("begin"), (F.col("from") + F.col("stop")).alias("stop")),
        ]
        spans = rows[0].unionByName(rows[1]).unionByName(rows[2]).where("stop - begin >= %d" % window)
        lists = spans.groupBy("h1", "h2").agg(F.collect_list("begin").alias("begins"), F.collect_list("stop").alias("stops"))
        joined = materialise(lists.mapInArrow(_joined, "h1 bigint, h2 bigint, spans binary"), "spans")
        discard(recurring, marked, passages, hot, asked, found)
        return joined

    def _dealt(self, cut: DataFrame, passages: DataFrame) -> DataFrame:
        """Passages sorted by shard. An anchor's passages share one, or some if they are many."""
        shards = passages.count() * (2 * self.window) // self.shard_bytes + 1
        sub = F.pmod(F.col("passage"), F.col("subs").cast("long")).alias("sub")
        # a task may have cut a passage of equal texts that another cut as well
        once = cut.groupBy("anchor", "passage").agg(
            *[F.first(c).alias(c) for c in ("n", "subs")], F.min(F.struct("t1", "begin", "bytes")).alias("p")
        )
        once = once.select("anchor", "passage", "n", "subs", "p.*", sub)
        # shards of a many-passage anchor are its own
        own = F.when(F.col("subs") > 1, F.xxhash64("anchor", "sub")).otherwise(
            F.pmod(F.xxhash64("anchor"), F.lit(shards))
        )
        dealt = once.withColumn("shard", own)
        return dealt.repartition("shard").sortWithinPartitions("shard")

    def cleaned(self) -> DataFrame:
        """(doc_id, n_bytes, n_removed, n_spans, kept_sha256) of every row."""
        texts = self.texts()
        spans = self.spans(texts)
        window = F.lit(self.window)
        rows = self.docs.join(texts.select("h1", "h2", "n_bytes", "n"), ["h1", "h2"])
        gone = (F.col("n") > 1) & (F.col("n_bytes") >= window)
        rows = rows.join(spans, ["h1", "h2"], "left")
        changed = rows.where(~gone & F.col("spans").isNotNull()).select("doc_id", "n_bytes", "text", "spans")
        changed = changed.mapInArrow(
            _cut_texts, "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string"
        )
        same = rows.where(gone | F.col("spans").isNull()).select(
            "doc_id",
            "n_bytes",
            F.when(gone, F.col("n_bytes")).otherwise(F.lit(0)).cast("long").alias("n_removed"),
            F.when(gone, F.lit(1)).otherwise(F.lit(0)).cast("long").alias("n_spans"),
            F.sha2(F.when(gone, F.lit("")).otherwise(F.col("text")), 256).alias("kept_sha256"),
        )
        return same.unionByName(changed)


def op12_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return SuffixDedup(spark.read.parquet(f"{sf_dir}/documents.parquet")).cleaned()
