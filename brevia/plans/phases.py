"""The four analyses a user runs, as compositions of operators.

Each takes and returns DataFrames. ``run_*`` variants also write the stage outputs
under their folder names.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brevia.operators import clustering, dedup, lexicon, ranking, stats, topics
from brevia.plans import manifest
from brevia.session import materialise, scanned
from brevia.sources import documents as src
from brevia.sources import sinks

# Fixed value: what stands between a word's count and its synonyms in the text output.
SYNONYMS = ". Available syns are: "
# Documents per cluster a cluster topic model reads.
REPRESENTATIVES = 5


def frequent_words(terms: DataFrame, lexicon_table: DataFrame, k: int = 15) -> DataFrame:
    """Phase 1: the ``k`` most frequent dictionary words with their synonyms."""
    words = lexicon.top_dictionary_words(stats.word_count(terms), lexicon_table, k)
    return lexicon.synonyms(words, lexicon_table)


def topics_of_clusters(
    docs: DataFrame, assignment: DataFrame, n_per_cluster: int = REPRESENTATIVES, **kw
) -> topics.Topics:
    """Phase 3, first model: topics of the documents nearest to their centres."""
    reps = clustering.representatives(assignment, n_per_cluster)
    return topics.cluster_topics(clustering.representative_documents(docs, reps), **kw)


def ranked_summary(
    scores: DataFrame,
    sents: DataFrame,
    k: int = ranking.TOP_SENTENCES,
    threshold: float = 0.8,
    stop_words: Iterable[str] | None = None,
) -> DataFrame:
    """Phase 4: the best sentences without near-duplicates, with their scores.

    ``k`` sentences are profiled; no index of the corpus is needed.
    """
    best = materialise(ranking.top_sentences(scores, sents, k, stop_words=stop_words), "top")
    kept = dedup.remove_near_duplicates(best, threshold)
    return best.join(kept, "sentence", "left_semi").select("score", "sentence")


def topic_summary(
    clean: DataFrame,
    topic_terms: DataFrame,
    threshold: float = 0.8,
    case_sensitive: bool = True,
    index: dedup.SimilarityIndex | None = None,
) -> DataFrame:
    """Phase 4: sentences that hit a topic term, without near-duplicates.

    With an ``index`` of the corpus' sentences the chosen ones are taken from it.
    """
    chosen = ranking.topic_sentences(clean, topic_terms, case_sensitive)
    if index is None:
        return dedup.remove_near_duplicates(chosen, threshold)
    return index.survivors(chosen.select("sentence").distinct(), threshold)


def run_word_statistics(terms: DataFrame, lexicon_table: DataFrame, out: str) -> DataFrame:
    """Phase 1 with its text output: word, count and synonyms."""
    words = frequent_words(terms, lexicon_table)
    line = F.concat(F.col("n").cast("string"), F.lit(SYNONYMS), F.col("synonyms"), F.lit(", "))
    sinks.write_pairs(words.withColumn("line", line), "term", "line", f"{out}/{sinks.WORD_COUNT}")
    return words


def run_clustering(
    terms: DataFrame,
    n_docs,
    out: str,
    k: int = clustering.CLUSTERS,
    seed: int | None = 1,
    delta: float = clustering.DELTA,
    max_rounds: int = clustering.MAX_ROUNDS,
    inputs: str | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Phase 2: every stage is written once and the next one reads it back.

    With ``inputs``, a fingerprint of the input (:func:`manifest.fingerprint`), a run that
    begins again with the same folder and settings takes finished stages as they are.
    """
    spark = terms.sparkSession
    stages = manifest.Stages(spark, out, inputs)
    tf = stages.table(sinks.TERM_FREQ, lambda: stats.term_freq(terms))
    shares = stages.table(sinks.TERM_SHARE, lambda: stats.term_share(tf))
    weights = stages.table(sinks.TFIDF, lambda: stats.tfidf(shares, n_docs))

    def write_vectors(path: str) -> None:
        vocab = materialise(topics.vocabulary(weights), "terms")
        indexed = weights.join(vocab, "term").select("doc_id", "idx", F.col("tfidf").alias("w"))
        sinks.write_vectors(indexed, vocab.count(), path)

    stages.files(sinks.VECTORS, write_vectors)
    vectors = scanned(stats.vectors(weights))
    chosen = stages.table(sinks.SEEDS, lambda: clustering.seeds(vectors, k, seed), k=k, seed=seed)
    fitted: list[DataFrame] = []

    def fit(which: int) -> DataFrame:
        if not fitted:
            fitted.extend(clustering.kmeans(vectors, chosen, k, delta, max_rounds))
        return fitted[which]

    rounds = {"delta": delta, "max_rounds": max_rounds}
    centres = stages.table(f"{sinks.KMEANS}/centres", lambda: fit(0), **rounds)
    return centres, stages.table(f"{sinks.KMEANS}/points", lambda: fit(1), **rounds)


def run_topics(terms: DataFrame, topic_terms: DataFrame, provider: str, out: str) -> DataFrame:
    """Phase 3: a provider's term list and its corpus counts."""
    folder = f"{out}/topics-{provider}"
    sinks.write_lines(topic_terms, "term", f"{folder}/{sinks.TOPIC_TERMS}")
    counts = ranking.topic_term_counts(terms, topic_terms)
    sinks.write_pairs(counts, "term", "n", f"{folder}/{sinks.TOPIC_COUNTS}")
    return counts


def run_summaries(
    scores: DataFrame,
    sents: DataFrame,
    cluster_terms: DataFrame,
    corpus_terms: DataFrame,
    out: str,
    stop_words: Iterable[str] | None = None,
) -> dict[str, str]:
    """Phase 4: the three summaries as value-only text, chosen from one similarity index."""
    clean = src.clean(sents, stop_words)
    index = dedup.SimilarityIndex(clean)
    best = materialise(ranking.top_sentences(scores, sents, stop_words=stop_words), "top")
    sinks.write_pairs(best, "score", "sentence", f"{out}/{sinks.TOP_SENTENCES}", sep="@")
    summaries = {
        "top_rank_doc": index.survivors(best.select("sentence").distinct()),
        "cluster_topics_doc": topic_summary(clean, cluster_terms, index=index),
        "corpus_topics_doc": topic_summary(clean, corpus_terms, index=index),
    }
    return {
        name: sinks.write_lines(df, "sentence", f"{out}/{name}/{sinks.FILTERED}")
        for name, df in summaries.items()
    }
