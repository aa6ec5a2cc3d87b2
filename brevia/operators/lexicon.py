"""Dictionary lookups against a user-supplied synonym table.

A lexicon is ``(lemma, pos, sense, ordinal, synonym)`` with ``pos`` one of noun,
adjective, verb, adverb; lemmas are lower case and lookups ignore case.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# A word takes the first part of speech that knows it.
POS_ORDER = ("noun", "adjective", "verb", "adverb")


def _pos_rank(column: str = "pos"):
    ranks = F.lit(len(POS_ORDER))
    for rank in reversed(range(len(POS_ORDER))):
        ranks = F.when(F.col(column) == POS_ORDER[rank], rank).otherwise(ranks)
    return ranks


def top_dictionary_words(counts: DataFrame, lexicon: DataFrame, k: int = 15) -> DataFrame:
    """The ``k`` most frequent words that have an entry; others take no slot."""
    lemmas = lexicon.where(F.col("pos").isin(*POS_ORDER)).select("lemma")
    known = counts.withColumn("lemma", F.lower("term")).join(lemmas, "lemma", "left_semi")
    return known.orderBy(F.desc("n"), "term").limit(k).select("term", "n")


def synonyms(words: DataFrame, lexicon: DataFrame) -> DataFrame:
    """Attach to each ``(term, n)`` the lemmas of its senses, in dictionary order.

    ``words`` is a top-k report, so the lexicon is reduced to its lemmas before the
    group; the lexicon side may be large.
    """
    entries = lexicon.withColumn("pos_rank", _pos_rank()).where(
        F.col("pos_rank") < len(POS_ORDER)
    )
    keyed = words.withColumn("lemma", F.lower("term"))
    hits = keyed.join(entries, "lemma")
    first = hits.groupBy("term").agg(F.min("pos_rank").alias("pos_rank"))
    return (
        hits.join(first, ["term", "pos_rank"])
        .groupBy("term", "n")
        .agg(F.array_sort(F.collect_list(F.struct("sense", "ordinal", "synonym"))).alias("s"))
        .select("term", "n", F.concat_ws(", ", "s.synonym").alias("synonyms"))
    )
