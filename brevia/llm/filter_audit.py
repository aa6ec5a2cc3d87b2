"""Which filter removes what, in every order, kept up to date by a stream with retractions.

The files of a folder are read as available-now micro-batches:

1. A text becomes a few bytes: its 128-bit digest, the mask of its own failures (``A`` to
   ``D``) and, from ``labels``, whether it is good or toxic. Texts never travel.
2. Each task first settles rows that have a copy with a smaller id in its own input: they
   fail ``E`` whatever comes, so of a large group only one row per task, part and label
   goes on.
3. The state of a text is its smallest id so far and the rows that carry it. A row with a
   larger id fails ``E``. When a smaller id arrives, what was counted for the former
   smallest rows is retracted and counted again with ``E``. Some thousand texts share a key
   of the state store, so that a micro-batch updates them in one go.
4. A micro-batch adds its changes, summed, to the counters (part, mask, good, toxic), in a
   folder of its own, so a repeated batch replaces itself. State and progress lie in the
   checkpoint folder; a run that begins again with the same folders goes on.

The state store is the session's. Its rows are compressed blocks of about 100 kB, some 30 bytes
a text; where they outgrow the executors' heap, set the session's provider to RocksDB.

Filters act on a document through its mask alone, so every figure of every order follows
from the counters: at most 32 masks times labels and parts.

A null text is empty, a null part the empty string. A null id is neither smaller nor larger
than another: such rows neither fail ``E`` nor make others fail, and have no label. Rows
that repeat an id and a text are counted each and don't make each other fail. Repeated
labels count as the largest. No documents give no rows. Other columns are not read.
"""

from __future__ import annotations

import itertools
import json
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from brevia.llm import arrow
from brevia.llm.common import text_of
from brevia.session import materialise, scratch_path

FILTERS = "ABCDE"
MIN_WORDS = 100
DISTINCT_PERCENT = 80
UPPER_PERCENT = 10
SYMBOLS = re.compile(rb"[#$%&*|]")
# The folder is read in this many micro-batches.
BATCHES = 4
# Rows a task settles at once.
HELD = 1 << 17

_COPY = 1 << FILTERS.index("E")
_NOT_UPPER = bytes(b for b in range(256) if not 0x41 <= b <= 0x5A)
_NOT_FIRST = bytes(range(0x80, 0xC0))
# Texts that share a key of the state, on average: a key's texts are updated in one batch.
KEY_TEXTS = 4_096

ROWS = "k1 bigint, k2 bigint, doc_id bigint, part string, mask int"
ARRIVING = f"{ROWS}, good int, toxic int, n bigint, settled boolean"
CHANGES = "part string, mask int, good int, toxic int, n bigint"
_ARRIVING, _CHANGED = ([c.split()[0] for c in schema.split(", ")] for schema in (ARRIVING, CHANGES))
_COUNTED, _SAME = _CHANGED[:-1], _ARRIVING[:-2]
_STATE_ROWS = pa.schema(
    [("k1", pa.int64()), ("k2", pa.int64()), ("doc_id", pa.int64()), ("part", pa.string())]
    + [(c, pa.int32()) for c in ("mask", "good", "toxic")]
    + [("n", pa.int64())]
)


def own_failures(text: bytes) -> int:
    """The mask of the filters a text fails by itself."""
    words = text.split()
    upper = len(text.translate(None, _NOT_UPPER))
    points = len(text.translate(None, _NOT_FIRST))
    fails = (
        len(words) < MIN_WORDS,
        100 * len(set(words)) < DISTINCT_PERCENT * len(words),
        100 * upper > UPPER_PERCENT * points,
        SYMBOLS.search(text) is not None,
    )
    return sum(1 << k for k, failed in enumerate(fails) if failed)


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for rows in arrow.slices(batches):
        texts = arrow.raw(rows.column("text"))
        keys = np.frombuffer(b"".join(xxhash.xxh3_128_digest(t) for t in texts), np.int64).reshape(-1, 2)
        yield pa.record_batch(
            {
                "k1": pa.array(keys[:, 0]),
                "k2": pa.array(keys[:, 1]),
                "doc_id": rows.column("doc_id"),
                "part": rows.column("part"),
                "mask": pa.array([own_failures(t) for t in texts], pa.int32()),
            }
        )


def marked_copies(rows: pd.DataFrame) -> pd.DataFrame:
    """Rows with ``E`` in the mask where their text has a smaller id among them."""
    first = rows["doc_id"].groupby([rows["k1"], rows["k2"]]).transform("min")
    copy = (rows["doc_id"] > first).to_numpy()
    return rows.assign(mask=rows["mask"].to_numpy() | np.where(copy, _COPY, 0))


def _summed(rows: pd.DataFrame, by: list[str]) -> pd.DataFrame:
    return rows.groupby(by, as_index=False, sort=False)["n"].sum()


def _settle(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Sums of rows that can't change any more, and the smallest ids of each text."""

    def settled(rows: pd.DataFrame) -> pd.DataFrame:
        known = marked_copies(rows[rows["known"]])
        copy = known["mask"] & _COPY > 0
        done = _summed(pd.concat([rows[~rows["known"]], known[copy]]), _COUNTED)
        # settled sums have no text; any spread of keys does
        done = done.assign(k1=done["mask"].astype("int64"), k2=0, doc_id=0, settled=True)
        rest = _summed(known[~copy], _SAME).assign(settled=False)
        return pd.concat([done, rest])[_ARRIVING].astype({"settled": bool})

    held, size = [], 0
    for batch in batches:
        held.append(batch.assign(n=1))
        size += len(batch)
        if size >= HELD:
            yield settled(pd.concat(held))
            held, size = [], 0
    if held:
        yield settled(pd.concat(held))


def merged(state: pd.DataFrame, arrived: pd.DataFrame) -> tuple[pd.DataFrame, pd.DataFrame]:
    """The new state, rows with the smallest id of each text, and the changes it makes.

    An arrived row counts with ``E`` if its text has a smaller id. A row of the state that
    is smallest no more is retracted and counts again with ``E``.
    """
    rows = marked_copies(pd.concat([state.assign(old=True), arrived.assign(old=False)], ignore_index=True))
    copy, old = rows["mask"] & _COPY > 0, rows["old"].astype(bool)
    former = rows[old & copy]
    retracted = former.assign(n=-former["n"], mask=former["mask"] - _COPY)
    changes = _summed(pd.concat([rows[~old | copy], retracted]), _COUNTED)
    return _summed(rows[~copy], _SAME), changes[changes["n"] != 0]


def _packed(rows: pd.DataFrame) -> bytes:
    sink = pa.BufferOutputStream()
    batch = pa.RecordBatch.from_pandas(rows, schema=_STATE_ROWS, preserve_index=False)
    with pa.ipc.new_stream(sink, _STATE_ROWS, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
        out.write_batch(batch)
    return sink.getvalue().to_pybytes()


def _unpacked(state) -> pd.DataFrame:
    if not state.exists:
        return _STATE_ROWS.empty_table().to_pandas()
    return pa.ipc.open_stream(state.get[0]).read_all().to_pandas()


def _update(key, frames: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
    """Changes of the counters by the rows of the texts of one key, and settled sums."""
    rows = pd.concat(list(frames))
    over = rows["settled"].astype(bool)
    out = [rows[over][_CHANGED]]
    if not over.all():
        kept, changes = merged(_unpacked(state), rows[~over].drop(columns=["settled"]))
        state.update((_packed(kept),))
        out.append(changes[_CHANGED])
    yield pd.concat(out)


def _pattern(path: str) -> str:
    """A pattern for one path; streams read a single file only through a pattern."""
    folder, _, name = path.rstrip("/").rpartition("/")
    return f"{folder}/{{{name}}}"


class FilterAudit:
    """Audit of the parquet files of ``path`` (doc_id, text, lang) with ``labels``.

    ``folder`` holds progress, state and counters. A second audit with the same folder reads
    only files that have come since; give ``keys`` then, the number of state keys, which has
    to stay the same. By default there is one for each ``KEY_TEXTS`` rows, so the state of a
    key stays small however many texts there are.
    """

    def __init__(
        self,
        spark: SparkSession,
        path: str,
        labels: DataFrame,
        batches: int = BATCHES,
        folder: str | None = None,
        keys: int | None = None,
    ):
        self.spark, self.path, self.labels, self.batches = spark, path, labels, batches
        self.folder, self.keys = folder or scratch_path(spark, "filter-audit"), keys

    def _rows(self) -> DataFrame:
        """The stream of settled sums and open rows."""
        table = self.spark.read.parquet(self.path)
        files, keys = len(table.inputFiles()), self.keys or table.count() // KEY_TEXTS + 1
        stream = (
            self.spark.readStream.schema(table.schema)
            .option("maxFilesPerTrigger", max(1, -(-files // self.batches)))
            .parquet(_pattern(self.path))
        )
        docs = stream.select(
            F.col("doc_id").cast("long"), F.coalesce("lang", F.lit("")).alias("part"), text_of().alias("text")
        )
        flag = lambda c: F.coalesce(F.max((F.col(c) == 1).cast("int")), F.lit(0)).alias(c)
        labels = self.labels.where("doc_id IS NOT NULL").groupBy(F.col("doc_id").cast("long").alias("labelled"))
        labels = materialise(labels.agg(flag("quality"), flag("toxic")), "labels")
        rows = docs.mapInArrow(_digests, ROWS)
        # a null id joins nothing, and its rows are spread by their text
        by = F.coalesce("doc_id", "k1") == F.col("labelled")
        marked = rows.join(labels, by & F.col("doc_id").isNotNull(), "left").select(
            "k1", "k2", F.coalesce("doc_id", F.lit(0)).alias("doc_id"), F.isnotnull("doc_id").alias("known"),
            "part", "mask", *[F.coalesce(c, F.lit(0)).alias(n) for c, n in (("quality", "good"), ("toxic", "toxic"))],
        )
        return marked.mapInPandas(_settle, ARRIVING).withColumn("key", F.pmod("k1", F.lit(keys)))

    def counters(self) -> DataFrame:
        """(part, mask, good, toxic, n) of all files read, after reading the new ones."""
        changes = f"{self.folder}/changes"

        def add(batch: DataFrame, number: int) -> None:
            sums = batch.groupBy("part", "mask", "good", "toxic").agg(F.sum("n").alias("n"))
            sums.where("n <> 0").write.mode("overwrite").parquet(f"{changes}/batch={number}")

        stream = self._rows().groupBy("key")
        stream = stream.applyInPandasWithState(_update, CHANGES, "rows binary", "update", "NoTimeout")
        writer = stream.writeStream.foreachBatch(add).outputMode("update").trigger(availableNow=True)
        writer.option("checkpointLocation", f"{self.folder}/progress").start().awaitTermination()
        written = self.spark.read.schema(CHANGES).parquet(f"{changes}/batch=*")
        return written.groupBy("part", "mask", "good", "toxic").agg(F.sum("n").alias("n")).where("n <> 0")

    def report(self) -> DataFrame:
        """One row for each part, order of the filters and step."""
        return audit_report(self.counters())


def audit_report(counters: DataFrame) -> DataFrame:
    """Figures of every order and step from counters (part, mask, good, toxic, n)."""
    bit = {f: 1 << k for k, f in enumerate(FILTERS)}
    steps = [
        ("".join(order), step + 1, bit[f], sum(bit[e] for e in order[:step]))
        for order in itertools.permutations(FILTERS)
        for step, f in enumerate(order)
    ]
    names = ("filter_order", "step", "own", "earlier")
    # one literal of 600 structs
    schema = "array<struct<filter_order: string, step: int, own: int, earlier: int>>"
    literal = F.from_json(F.lit(json.dumps([dict(zip(names, s)) for s in steps])), schema)
    n, mask = F.col("n"), F.col("mask")
    by_mask = counters.groupBy("part", "mask").agg(
        F.sum("n").alias("n"),
        F.sum(F.when(F.col("good") == 1, n).otherwise(0)).alias("good"),
        F.sum(F.when(F.col("toxic") == 1, n).otherwise(0)).alias("toxic"),
    )
    rows = by_mask.select("*", F.explode(literal).alias("s")).select("*", "s.*").drop("s")
    own, earlier = F.col("own"), F.col("earlier")
    fails, before = mask.bitwiseAND(own) != 0, mask.bitwiseAND(earlier) != 0

    def total(value, condition, name):
        return F.sum(F.when(condition, value).otherwise(F.lit(0))).cast("long").alias(name)

    # of all orders, a filter comes before the document's other failures in one of popcount
    orders = len(steps) // len(FILTERS)
    share = n * F.floor(F.lit(orders) / F.bit_count(mask))
    return rows.groupBy("part", "filter_order", "step").agg(
        total(n, mask.bitwiseAND(own.bitwiseOR(earlier)) == 0, "kept"),
        total(n, fails & ~before, "removed"),
        total(n, fails & before, "redundant"),
        total(n, mask == own, "unique_fails"),
        total(F.col("good"), fails & ~before, "good_lost"),
        total(F.col("toxic"), fails & ~before, "toxic_lost"),
        total(share, fails, "shapley"),
    )


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return FilterAudit(spark, f"{sf_dir}/documents.parquet", labels).report()


SQL = r"""
WITH docs AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text FROM documents
), words AS (
  SELECT *, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS w,
         min(doc_id) OVER (PARTITION BY text) AS first_id FROM docs
), label AS (
  SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good,
         max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic
  FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id
), fails AS (
  SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic,
         CASE WHEN len(w) < 100 THEN 'A' ELSE '' END
      || CASE WHEN 100 * len(list_distinct(w)) < 80 * len(w) THEN 'B' ELSE '' END
      || CASE WHEN 100 * (length(text) - length(regexp_replace(text, '[A-Z]', '', 'g'))) > 10 * length(text)
              THEN 'C' ELSE '' END
      || CASE WHEN regexp_matches(text, '[#$%&*|]') THEN 'D' ELSE '' END
      || CASE WHEN coalesce(words.doc_id > first_id, false) THEN 'E' ELSE '' END AS failed
  FROM words LEFT JOIN label ON words.doc_id = label.doc_id
), counted AS (
  SELECT part, failed, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM fails GROUP BY part, failed
), letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS f), orders AS (
  SELECT a.f || b.f || c.f || d.f || e.f AS filter_order
  FROM letters a, letters b, letters c, letters d, letters e
  WHERE len(list_distinct([a.f, b.f, c.f, d.f, e.f])) = 5
), steps AS (
  SELECT filter_order, step, filter_order[step] AS own, filter_order[:step - 1] AS earlier
  FROM orders, (SELECT unnest([1, 2, 3, 4, 5])::INTEGER AS step)
), hits AS (
  SELECT part, filter_order, step, own, n, good, toxic, failed,
         contains(failed, own) AS fails,
         len(failed) > len(translate(failed, earlier, '')) AS before
  FROM counted, steps
), per_step AS (
  SELECT part, filter_order, step, own,
         sum(CASE WHEN NOT fails AND NOT before THEN n ELSE 0 END)::BIGINT AS kept,
         sum(CASE WHEN fails AND NOT before THEN n ELSE 0 END)::BIGINT AS removed,
         sum(CASE WHEN fails AND before THEN n ELSE 0 END)::BIGINT AS redundant,
         sum(CASE WHEN failed = own THEN n ELSE 0 END)::BIGINT AS unique_fails,
         sum(CASE WHEN fails AND NOT before THEN good ELSE 0 END)::BIGINT AS good_lost,
         sum(CASE WHEN fails AND NOT before THEN toxic ELSE 0 END)::BIGINT AS toxic_lost
  FROM hits GROUP BY part, filter_order, step, own
)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
       (sum(removed) OVER (PARTITION BY part, own))::BIGINT AS shapley
FROM per_step
"""
