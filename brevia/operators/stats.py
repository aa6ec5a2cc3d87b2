"""Word and term statistics.

Every grouping is a partial aggregate before its exchange, and statistics are
attached by equi-joins instead of windows, which would sort a hot key in one task.
Both sides are written first: the adaptive skew join splits a term or document that
holds a third of all rows only between two plain scans, not above an aggregate. The
small sides (one row per term or document) carry no broadcast hint; the planner
broadcasts them only when their measured size allows it.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from brevia.functions import text as tx
from brevia.session import bucketed, buckets, materialise, written
from brevia.sources.documents import same_block


def word_count(terms: DataFrame) -> DataFrame:
    """Case-sensitive corpus count of kept tokens: ``(term, n)``."""
    return terms.groupBy("term").agg(F.count(F.lit(1)).alias("n"))


def top_words(counts: DataFrame, k: int = 15) -> DataFrame:
    """The ``k`` most frequent words, ties by term."""
    return counts.orderBy(F.desc("n"), "term").limit(k)


def term_freq(terms: DataFrame) -> DataFrame:
    """``(doc_id, term, n)``, with the block if the terms have one."""
    return terms.groupBy(*same_block(terms), "doc_id", "term").agg(F.count(F.lit(1)).alias("n"))


def doc_totals(tf: DataFrame) -> DataFrame:
    """Kept tokens per document: ``(doc_id, doc_total)``."""
    return tf.groupBy("doc_id").agg(F.sum("n").alias("doc_total"))


def term_share(tf: DataFrame) -> DataFrame:
    """``(doc_id, term, n, doc_total)``."""
    tf = written(tf, "term-freq")
    totals = materialise(doc_totals(tf), "doc-totals")
    return tf.join(totals, "doc_id").select("doc_id", "term", "n", "doc_total")


def document_shares(docs: DataFrame, stop_words: Iterable[str] | None = None) -> DataFrame:
    """:func:`term_share` for a table with one row per document.

    The row knows its own total, so it travels with the term: one exchange on
    (document, term) replaces the count, the totals and the join.
    """
    lines = F.transform(F.split("text", "\n"), lambda line: tx.clean_tokens(line, stop_words))
    return (
        docs.select("doc_id", F.flatten(lines).alias("tokens"))
        .select("doc_id", F.size("tokens").cast("long").alias("doc_total"), F.explode_outer("tokens").alias("term"))
        .where("term IS NOT NULL")
        .groupBy("doc_id", "doc_total", "term")
        .agg(F.count(F.lit(1)).alias("n"))
        .select("doc_id", "term", "n", "doc_total")
    )


def doc_freq(tf: DataFrame) -> DataFrame:
    """Documents holding each term: ``(term, df)``."""
    return tf.groupBy("term").agg(F.count(F.lit(1)).alias("df"))


def tfidf(shares: DataFrame, n_docs: Column) -> DataFrame:
    """``(doc_id, term, tfidf)`` from term shares; a term of every document keeps weight tf.

    ``n_docs`` is a scalar (see ``sources.documents.n_docs``), so no cross join.
    """
    shares = written(shares, "shares")
    freq = materialise(doc_freq(shares), "doc-freq")
    weighted = shares.join(freq, "term").withColumn("n_docs", n_docs)
    return weighted.select("doc_id", "term", _weight().alias("tfidf"))


def _weight() -> Column:
    share = F.col("n") / F.col("doc_total")
    rarity = F.log10(F.col("n_docs") / F.col("df"))
    return F.when(F.col("df") == F.col("n_docs"), share).otherwise(share * rarity)


def block_shares(blocks: DataFrame) -> DataFrame:
    """:func:`document_shares` of ``sources.documents.in_blocks``, with the block and without an exchange."""
    return (
        blocks.select("block", "doc_id", F.flatten("lines").alias("tokens"))
        .select("block", "doc_id", F.size("tokens").cast("long").alias("doc_total"), F.explode_outer("tokens").alias("term"))
        .where("term IS NOT NULL")
        .groupBy("block", "doc_id", "doc_total", "term")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def block_freq(blocks: DataFrame, more: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """:func:`doc_freq` for each block: ``(block, term, df)``, ``df`` over all blocks.

    Rows are the distinct terms of a block, far fewer than those of its documents; only they
    travel by term and back. ``more`` adds columns that follow from a term to ``(term, df)``.
    """
    shares = block_shares(blocks)
    held = materialise(shares.groupBy("block", "term").agg(F.count(F.lit(1)).alias("n")), "block-terms")
    freq = materialise(held.groupBy("term").agg(F.sum("n").alias("df")), "doc-freq")
    found = more(freq) if more else freq
    found = held.select("block", "term").join(found, "term")
    return bucketed(found, "block", buckets(blocks), "block-freq")


def block_weights(
    blocks: DataFrame, n_docs: Column, more: Callable[[DataFrame], DataFrame] | None = None
) -> DataFrame:
    """:func:`tfidf` of ``sources.documents.in_blocks``, with the block and the columns of ``more``.

    It is no table yet: what it is used for is written inside ``session.as_dealt``. A task
    hashes the terms of its own blocks.
    """
    freq = block_freq(blocks, more)
    added = [c for c in freq.columns if c not in ("block", "term", "df")]
    weighted = block_shares(blocks).join(freq.hint("shuffle_hash"), ["block", "term"]).withColumn("n_docs", n_docs)
    return weighted.select("block", "doc_id", "term", _weight().alias("tfidf"), *added)


def with_letters(terms: DataFrame) -> DataFrame:
    return terms.withColumn("letters", tx.letters_only(F.col("term")))


def letter_weights(weights: DataFrame) -> DataFrame:
    """Weights keyed by the letters of a term: ``(doc_id, term, tfidf)``.

    When several terms of a document share their letters, the byte-greatest one wins.
    """
    block = same_block(weights)
    if "letters" not in weights.columns:
        weights = with_letters(weights)
    return (
        weights.where("letters <> ''")
        .groupBy(*block, "doc_id", "letters")
        .agg(F.max_by("tfidf", "term").alias("tfidf"))
        .select(*block, "doc_id", F.col("letters").alias("term"), "tfidf")
    )


def vectors(weights: DataFrame) -> DataFrame:
    """Term-aligned document vectors in long form: ``(doc_id, term, w)``."""
    return weights.select(*same_block(weights), "doc_id", "term", F.col("tfidf").alias("w"))


def positional_vectors(weights: DataFrame) -> DataFrame:
    """``(doc_id, slot, w)``: rounded weights in term order, slots from 0.

    Slots are numbered in two levels so that no task sorts a whole document: ranks
    inside a document's terms that share their first two characters, plus the
    number of terms under smaller such heads. A token has at most 64 x 64 heads,
    which bounds the second window. With a block a task holds its documents anyway; there
    one sort of its terms, which spills where it must, takes the place of the heads.
    """
    if same_block(weights):
        slot = F.row_number().over(Window.partitionBy("block", "doc_id").orderBy("term")) - 1
        placed = weights.where("doc_id IS NOT NULL").withColumn("slot", slot.cast("long"))
        return placed.select("doc_id", "slot", tx.round2(F.col("tfidf")).alias("w"))
    headed = weights.withColumn("head", F.substring("term", 1, 2))
    before = (
        Window.partitionBy("doc_id")
        .orderBy("head")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    offsets = (
        headed.groupBy("doc_id", "head")
        .agg(F.count(F.lit(1)).alias("in_head"))
        .select(
            "doc_id", "head", F.coalesce(F.sum("in_head").over(before), F.lit(0)).alias("offset")
        )
    )
    rank = F.row_number().over(Window.partitionBy("doc_id", "head").orderBy("term")) - 1
    return (
        headed.withColumn("rank", rank)
        .join(offsets, ["doc_id", "head"])
        .select(
            "doc_id", (F.col("offset") + F.col("rank")).alias("slot"), tx.round2(F.col("tfidf")).alias("w")
        )
    )
