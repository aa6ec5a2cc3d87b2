"""Line dedup over levelled sorted runs of line hashes.

A line's key is the line without ASCII white space at its ends and with A-Z in lower
case. Runs hold (128-bit key hash, number of documents), sorted by hash. A batch of
documents first drops, by an anti-join, the keys that older runs have already settled
(found in ``min_docs`` documents or more), then writes the rest as a new run of level 0.
``fanout`` runs of a level are merged into one run of the next level, so a key is
rewritten a logarithmic number of times however many batches arrive.

Everything is DataFrame code. Counting aggregates before its exchange, so a line that
a third of all documents share costs one row per task. Documents are rows: a null text
is one empty line, empty keys are never dropped, a line repeated within one row counts
once, and repeated rows count as documents of their own.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from brevia.llm.common import WHITE, ascii_lower, row_key, same_row, text_of
from brevia.session import materialise

MIN_DOCS = 10
MIN_CHARS = 1
BATCHES = 4
FANOUT = 2


def lines(text: Column) -> Column:
    return F.split(text, "\n", -1)


def line_key(line: Column) -> Column:
    return ascii_lower(F.btrim(line, F.lit(WHITE)))


def key_hash(key: Column) -> list[Column]:
    return [F.xxhash64(key).alias("k1"), F.xxhash64(F.lit(17), key).alias("k2")]


def key_counts(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """(k1, k2, n): in how many rows of ``docs`` each line key occurs."""
    keys = F.array_distinct(F.transform(lines(text_of()), line_key))
    return (
        docs.select(F.explode(keys).alias("key"))
        .where(F.length("key") >= min_chars)
        .select(*key_hash(F.col("key")))
        .groupBy("k1", "k2")
        .agg(F.count(F.lit(1)).alias("n"))
    )


class LineRuns:
    """The levelled runs and the keys they have settled."""

    def __init__(self, min_docs: int = MIN_DOCS, fanout: int = FANOUT):
        self.min_docs, self.fanout = min_docs, fanout
        self.levels: list[list[DataFrame]] = []
        self.settled: DataFrame | None = None

    def _runs(self) -> list[DataFrame]:
        return [run for level in self.levels for run in level]

    @staticmethod
    def _merged(runs: list[DataFrame]) -> DataFrame:
        out = runs[0]
        for run in runs[1:]:
            out = out.unionByName(run)
        return out.groupBy("k1", "k2").agg(F.sum("n").alias("n"))

    @staticmethod
    def _write(run: DataFrame, level: int) -> DataFrame:
        return materialise(run.sortWithinPartitions("k1", "k2"), f"line-run-{level}")

    def add(self, counts: DataFrame) -> None:
        """Adds a batch's key counts as a run and compacts levels that are full."""
        if self.settled is not None:
            counts = counts.join(self.settled, ["k1", "k2"], "left_anti")
        run, level = self._write(counts, 0), 0
        while True:
            if level == len(self.levels):
                self.levels.append([])
            self.levels[level].append(run)
            if len(self.levels[level]) < self.fanout:
                return
            run = self._write(self._merged(self.levels[level]), level + 1)
            self.levels[level] = []
            if level == 0:
                self.settled = self._settle(run)
            level += 1

    def _settle(self, newest: DataFrame) -> DataFrame:
        found = self._merged([newest, *self._runs()]).where(F.col("n") >= self.min_docs)
        found = found.select("k1", "k2")
        if self.settled is not None:
            found = found.unionByName(self.settled).distinct()
        return self._write(found, 99)

    def unseen(self, counts: DataFrame) -> DataFrame:
        """The keys of a batch that no earlier run holds."""
        for run in [*self._runs(), *([self.settled] if self.settled is not None else [])]:
            counts = counts.join(run, ["k1", "k2"], "left_anti")
        return counts

    def frequent(self) -> DataFrame:
        """(k1, k2) of all keys in at least ``min_docs`` documents, as a written table.

        Its measured size lets the planner broadcast it where that is cheap; beyond
        the session's threshold it is a sort-merge join whose hot keys can be split.
        """
        runs = self._runs()
        return self._settle(runs[0].where(F.lit(False))) if runs else self.settled


def batches(docs: DataFrame, n: int = BATCHES) -> list[DataFrame]:
    """Groups of the table's files, which scans prune; else the table as one batch."""
    try:
        group = F.pmod(F.xxhash64("_metadata.file_name"), F.lit(n))
        parts = [docs.where(group == i) for i in range(n)]
        parts[0].schema  # noqa: B018  resolves the hidden column
        return parts
    except AnalysisException:
        return [docs]


def frequent_lines(
    docs: DataFrame, min_docs: int = MIN_DOCS, min_chars: int = MIN_CHARS, n_batches: int = BATCHES
) -> DataFrame:
    runs = LineRuns(min_docs)
    for batch in batches(docs, n_batches):
        runs.add(key_counts(batch, min_chars))
    return runs.frequent()


def _kept(all_lines: Column, dropped: Column) -> Column:
    """The lines between the dropped positions (ascending, from 0)."""
    n = F.size(dropped)

    def piece(i: Column) -> Column:
        start = F.when(i == 0, 0).otherwise(F.get(dropped, i - 1) + 1)
        end = F.when(i == n, F.size(all_lines)).otherwise(F.get(dropped, i))
        return F.slice(all_lines, start + 1, end - start)

    return F.flatten(F.transform(F.sequence(F.lit(0), n), piece))


def drop_lines(docs: DataFrame, frequent: DataFrame) -> DataFrame:
    """``docs`` with ``kept`` (text), ``n_lines`` and ``n_dropped``.

    Only key hashes meet the frequent keys; the text is exchanged once, by row key.
    """
    keyed = docs.select(*row_key(), F.posexplode(lines(text_of())).alias("pos", "line"))
    keyed = keyed.select("doc_id", "h1", "h2", "pos", *key_hash(line_key(F.col("line"))))
    hits = keyed.join(frequent, ["k1", "k2"], "left_semi")
    drops = hits.groupBy("doc_id", "h1", "h2").agg(
        F.array_sort(F.collect_set("pos")).alias("dropped")
    )
    drops = drops.select(F.col("doc_id").alias("_id"), "h1", "h2", "dropped")
    rows = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"), *row_key())
    both = rows.join(
        drops,
        rows["doc_id"].eqNullSafe(drops["_id"])
        & (rows["h1"] == drops["h1"])
        & (rows["h2"] == drops["h2"]),
        "left",
    )
    split = lines(F.coalesce("row.text", F.lit("")))
    dropped = F.coalesce("dropped", F.array().cast("array<int>"))
    return both.select(
        "row.*",
        F.array_join(_kept(split, dropped), "\n").alias("kept_text"),
        F.size(split).cast("long").alias("n_lines"),
        F.size(dropped).cast("long").alias("n_dropped"),
    )


def dedup_lines(docs: DataFrame, **limits: int) -> DataFrame:
    """Both passes: find the frequent keys, drop their lines everywhere."""
    return drop_lines(docs, frequent_lines(docs, **limits))


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return dedup_lines(docs).select(
        "doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256")
    )


SQL = r"""
WITH lines AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos
  FROM documents
), keyed AS (
  SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM lines
), hot AS (
  SELECT key FROM keyed WHERE length(key) >= 1
  GROUP BY key HAVING count(DISTINCT doc_id) >= 10
)
SELECT doc_id, count(*) AS n_lines,
       count(*) FILTER (WHERE key IN (SELECT key FROM hot)) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos)
                       FILTER (WHERE key NOT IN (SELECT key FROM hot)), '')) AS kept_sha256
FROM keyed GROUP BY doc_id
"""
