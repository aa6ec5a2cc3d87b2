"""The registered queries: name -> function of (session, table folder)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from brevia.functions import shingles as sh
from brevia.functions import text as tx
from brevia.operators import clustering, dedup, lexicon, ranking, stats, topics
from brevia.plans import manifest, phases
from brevia.session import as_dealt, bucketed, buckets, materialise, scratch_path, written
from brevia.sources import documents as src
from brevia.sources import sinks, tagged

Query = Callable[[SparkSession, str], DataFrame]

# Elements dropped with their content in the web-page form of the element filter.
PAGE_ELEMENTS = ("title", "script", "style")
# Size of the term list that stands in for a topic model where SQL must define it.
FREQUENT_TERMS = 50
# Rounds of the topic models whose results SQL checks.
TOPIC_ROUNDS = 3
# Part of speech that stands for each role in the derived lexicon.
ROLE_POS = {"user": "noun", "assistant": "verb", "system": "adverb"}


def _lines(spark: SparkSession, d: str) -> DataFrame:
    return src.sentences(src.documents(spark, d))


def _clean(spark: SparkSession, d: str) -> DataFrame:
    return src.clean(_lines(spark, d))


def _terms(spark: SparkSession, d: str) -> DataFrame:
    return src.terms(_lines(spark, d))


def _dealt(spark: SparkSession, d: str) -> DataFrame:
    """The documents for what is counted by document."""
    return src.by_document(src.table(spark, d, "documents").select("doc_id", "text"))


def _document_terms(spark: SparkSession, d: str) -> DataFrame:
    return src.terms(src.sentences(_dealt(spark, d)))


def _pages(spark: SparkSession, d: str) -> DataFrame:
    return src.table(spark, d, "pages")


def _n_docs(spark: SparkSession, d: str):
    return src.n_docs(src.table(spark, d, "documents"))


def _shares(spark: SparkSession, d: str) -> DataFrame:
    return stats.document_shares(_dealt(spark, d))


def _blocks(spark: SparkSession, d: str) -> DataFrame:
    return src.in_blocks(src.table(spark, d, "documents").select("doc_id", "text"))


def _weights(spark: SparkSession, d: str) -> DataFrame:
    return stats.tfidf(_shares(spark, d), _n_docs(spark, d))


def _block_weights(spark: SparkSession, d: str, more: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """:func:`_weights` with the block of each document."""
    return stats.block_weights(_blocks(spark, d), _n_docs(spark, d), more)


def _dealt_table(df: DataFrame, name: str) -> DataFrame:
    with as_dealt(df.sparkSession):
        return materialise(df, name)


def _with_index(freq: DataFrame) -> DataFrame:
    return freq.join(topics.vocabulary(freq), "term")


def _letter_weights(spark: SparkSession, d: str) -> DataFrame:
    return stats.letter_weights(_weights(spark, d))


def _scores(spark: SparkSession, d: str) -> DataFrame:
    blocks = _blocks(spark, d)
    weights = stats.letter_weights(stats.block_weights(blocks, _n_docs(spark, d), stats.with_letters))
    scores = ranking.sentence_scores(src.block_terms(blocks), weights)
    return _dealt_table(scores, "scores")


def _frequent_terms(spark: SparkSession, d: str) -> DataFrame:
    df = stats.doc_freq(stats.term_freq(_document_terms(spark, d)))
    return df.orderBy(F.desc("df"), "term").limit(FREQUENT_TERMS).select("term")


def _round9(df: DataFrame, column: str) -> DataFrame:
    return df.withColumn(column, F.round(column, 9))


# sources


def tagged_records(spark: SparkSession, d: str) -> DataFrame:
    return tagged.tagged_records(_pages(spark, d), "page_id", "html", "<p>", "</p>")


def corpus_size(spark: SparkSession, d: str) -> DataFrame:
    return src.corpus_size(src.table(spark, d, "documents"))


# sinks, read back


def text_sink_round_trip(spark: SparkSession, d: str) -> DataFrame:
    path = scratch_path(spark, sinks.WORD_COUNT)
    sinks.write_pairs(stats.word_count(_terms(spark, d)), "term", "n", path)
    return src.read_lines(spark, path).select(
        F.col("key").alias("term"), F.col("value").cast("long").alias("n")
    )


def line_sink_round_trip(spark: SparkSession, d: str) -> DataFrame:
    path = scratch_path(spark, sinks.FILTERED)
    sinks.write_lines(ranking.distinct_sentences(_clean(spark, d)), "sentence", path)
    return spark.read.text(path).select(F.col("value").alias("sentence"))


def vector_sink_round_trip(spark: SparkSession, d: str) -> DataFrame:
    """Stored entries and their sum for each document vector."""
    sizes = []

    def more(freq: DataFrame) -> DataFrame:
        sizes.append(freq.count())
        return _with_index(freq)

    weights = _block_weights(spark, d, more)
    path = scratch_path(spark, sinks.VECTORS)
    with as_dealt(spark):
        sinks.write_vectors(weights.withColumnRenamed("tfidf", "w"), sizes[0], path)
    return _vector_sizes(sinks.read_vectors(spark, path))


def overwrite_round_trip(spark: SparkSession, d: str) -> DataFrame:
    """Counts read back from a folder that first held other lines and then the counts."""
    path = scratch_path(spark, sinks.WORD_COUNT)
    sinks.write_lines(ranking.distinct_sentences(_clean(spark, d)), "sentence", path)
    sinks.write_pairs(stats.word_count(_terms(spark, d)), "term", "n", path)
    return src.read_lines(spark, path).select(
        F.col("key").alias("term"), F.col("value").cast("long").alias("n")
    )


# files, written from a table and scanned


def tagged_file_round_trip(spark: SparkSession, d: str) -> DataFrame:
    """Occurrences of each tagged record, scanned from text files that hold them."""
    path = scratch_path(spark, "tagged")
    sinks.write_lines(tagged_records(spark, d), "raw", path)
    records = tagged.read_tagged(spark, path, "<p>", "</p>")
    return records.groupBy("raw").agg(F.count(F.lit(1)).alias("n"))


def document_file_round_trip(spark: SparkSession, d: str) -> DataFrame:
    """Documents scanned from one text file each; the path carries the id."""
    path = scratch_path(spark, "documents")
    n = sinks.write_documents(src.documents(spark, d), path)
    # a scan counts an opened file as 4 MB and would be a task for each 32 documents
    tasks = max(4 * spark.sparkContext.defaultParallelism, -(-n // sinks.FOLDER_FILES))
    folder = sinks.mounted(spark, path)
    read = src.read_folders(spark, folder, tasks) if folder else src.read_documents(spark, f"{path}/*").coalesce(tasks)
    return read.select(
        F.regexp_extract("doc_id", "/doc_id=(-?[0-9]+)[^/]*(/[^/]*)?$", 1).try_cast("long").alias("doc_id"),
        # the writer ends each text with a line feed
        F.expr("substring(text, 1, length(text) - 1)").alias("text"),
    )


# text functions


def strip_tags(spark: SparkSession, d: str) -> DataFrame:
    return _pages(spark, d).select("page_id", tx.strip_tags(F.col("html")).alias("stripped"))


def punct_to_space(spark: SparkSession, d: str) -> DataFrame:
    return _lines(spark, d).select(
        "doc_id", "pos", tx.punct_to_space(F.col("raw")).alias("words")
    )


def tokens(spark: SparkSession, d: str) -> DataFrame:
    words = tx.tokenize(tx.punct_to_space(tx.strip_tags(F.col("raw"))))
    return (
        _lines(spark, d)
        .select("doc_id", "pos", F.explode_outer(words).alias("token"))
        .where("token IS NOT NULL")
    )


def remove_stop_words(spark: SparkSession, d: str) -> DataFrame:
    return _terms(spark, d)


def clean_sentences(spark: SparkSession, d: str) -> DataFrame:
    return _clean(spark, d).select("doc_id", "pos", "sentence")


def drop_elements(spark: SparkSession, d: str) -> DataFrame:
    text = tx.drop_elements(F.col("html"), attributed=(), bare=PAGE_ELEMENTS)
    return _pages(spark, d).select("page_id", text.alias("dropped"))


def letter_tokens(spark: SparkSession, d: str) -> DataFrame:
    return topics.bag_of_letter_terms(_dealt(spark, d))


def distinct_letter_terms(spark: SparkSession, d: str) -> DataFrame:
    found = tx.distinct_letter_terms(F.col("raw"))
    return (
        _lines(spark, d)
        .select("doc_id", "pos", F.explode_outer(found).alias("term"))
        .where("term IS NOT NULL")
    )


def char_shingles(spark: SparkSession, d: str) -> DataFrame:
    """Cleaned sentences holding each shingle."""
    counts = sh.shingle_counts(_clean(spark, d).select("sentence"))
    return counts.withColumnRenamed("n", "n_sentences")


def jaccard_pairs(spark: SparkSession, d: str) -> DataFrame:
    """Similarity of each sentence to the next one of its document, without a shuffle.

    Lines are cleaned once, paired inside the row and become rows before any shingle is made,
    so a long document costs two copies of its text and not an array of its shingles.
    """

    def neighbours(lines):
        starts = F.when(F.size(lines) > 1, F.sequence(F.lit(0), F.size(lines) - 2))
        return F.transform(
            starts, lambda i: F.struct(F.get(lines, i).alias("a"), F.get(lines, i + 1).alias("b"))
        )

    cleaned = F.transform(F.split("text", "\n"), lambda line: tx.clean_sentence(line))
    pairs = F.get(F.transform(F.array(cleaned), neighbours), F.lit(0))
    rows = (
        src.documents(spark, d)
        .select("doc_id", F.posexplode_outer(pairs).alias("pos", "p"))
        .where("p IS NOT NULL")
        .select("doc_id", "pos", "p.a", "p.b")
    )
    a, b, shared = F.col("size_a"), F.col("size_b"), F.col("shared")
    likeness = shared / F.nullif(a + b - shared, F.lit(0))
    return (
        sh.compared(rows)
        .where((a > 0) | (b > 0))
        .select(
            "doc_id",
            "pos",
            F.round(likeness, 9).alias("similarity"),
            ((a > 0) & (b > 0) & (likeness >= sh.THRESHOLD)).alias("is_similar"),
        )
    )


# statistics


def word_count(spark: SparkSession, d: str) -> DataFrame:
    return stats.word_count(_terms(spark, d))


def top_words(spark: SparkSession, d: str) -> DataFrame:
    return stats.top_words(word_count(spark, d))


def term_freq(spark: SparkSession, d: str) -> DataFrame:
    return stats.term_freq(_document_terms(spark, d))


def term_share(spark: SparkSession, d: str) -> DataFrame:
    return _shares(spark, d)


def doc_freq(spark: SparkSession, d: str) -> DataFrame:
    return stats.doc_freq(stats.term_freq(_document_terms(spark, d)))


def tfidf(spark: SparkSession, d: str) -> DataFrame:
    return _round9(_weights(spark, d), "tfidf")


def term_weights_letters_only(spark: SparkSession, d: str) -> DataFrame:
    return _round9(_letter_weights(spark, d), "tfidf")


def doc_vectors_aligned(spark: SparkSession, d: str) -> DataFrame:
    """Long vectors with dense term indexes."""
    indexed = _block_weights(spark, d, _with_index)
    return _dealt_table(indexed.select("doc_id", "idx", F.round("tfidf", 9).alias("w")), sinks.VECTORS)


def doc_vectors_positional(spark: SparkSession, d: str) -> DataFrame:
    return _dealt_table(stats.positional_vectors(_block_weights(spark, d)), sinks.VECTORS)


# dictionary


def derived_lexicon(spark: SparkSession, d: str) -> DataFrame:
    """A lexicon out of the conversations: the spellings of a word by role.

    Each role stands for a part of speech and a lower-case spelling is the later sense.
    Words of the documents that no conversation uses have no entry.
    """
    turns = src.table(spark, d, "conversations").where(F.col("role").isin(*ROLE_POS))
    pos = F.lit(None).cast("string")
    for role, name in ROLE_POS.items():
        pos = F.when(F.col("role") == role, name).otherwise(pos)
    words = turns.select(
        pos.alias("pos"), F.explode_outer(tx.clean_tokens(F.col("text"))).alias("synonym")
    )
    return (
        words.where("synonym IS NOT NULL")
        .distinct()
        .select(
            F.lower("synonym").alias("lemma"),
            "pos",
            (F.col("synonym") == F.lower("synonym")).cast("int").alias("sense"),
            F.lit(0).alias("ordinal"),
            "synonym",
        )
    )


def top_dictionary_words(spark: SparkSession, d: str) -> DataFrame:
    return lexicon.top_dictionary_words(word_count(spark, d), derived_lexicon(spark, d))


def top_word_synonyms(spark: SparkSession, d: str) -> DataFrame:
    return phases.frequent_words(_terms(spark, d), derived_lexicon(spark, d))


# sentences


def sentence_scores(spark: SparkSession, d: str) -> DataFrame:
    return _round9(_scores(spark, d), "score")


def top_sentences(spark: SparkSession, d: str) -> DataFrame:
    return ranking.top_sentences(_scores(spark, d), _lines(spark, d))


def distinct_sentences(spark: SparkSession, d: str) -> DataFrame:
    return ranking.distinct_sentences(_clean(spark, d))


def near_dup_sentences(spark: SparkSession, d: str) -> DataFrame:
    return dedup.remove_near_duplicates(_clean(spark, d))


def topic_term_counts(spark: SparkSession, d: str) -> DataFrame:
    return ranking.topic_term_counts(_terms(spark, d), _frequent_terms(spark, d))


def topic_sentences(spark: SparkSession, d: str) -> DataFrame:
    chosen = ranking.topic_sentences(_clean(spark, d), _frequent_terms(spark, d))
    return chosen.select("doc_id", "pos", "sentence")


def summary_top_rank(spark: SparkSession, d: str) -> DataFrame:
    return phases.ranked_summary(_scores(spark, d), _lines(spark, d))


# clustering


def _vectors(spark: SparkSession, d: str) -> DataFrame:
    """The vectors, written in buckets."""
    blocks = _blocks(spark, d)
    vectors = stats.vectors(stats.block_weights(blocks, _n_docs(spark, d)))
    return bucketed(vectors, "block", buckets(blocks), "vectors")


def _dense(spark: SparkSession, d: str) -> DataFrame:
    return clustering.dense_vectors(src.table(spark, d, "embeddings"), "vec_id", "embedding")


def cluster_seeds(spark: SparkSession, d: str) -> DataFrame:
    return clustering.seeds(_vectors(spark, d))


def _first_round(vectors: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    vectors = written(vectors, "vectors")
    centres = clustering.centres_of(vectors, clustering.seeds(vectors))
    return vectors, centres, clustering.assign(vectors, centres)


def kmeans_l1_assign(spark: SparkSession, d: str) -> DataFrame:
    return _first_round(_vectors(spark, d))[2]


def kmeans_l1_update(spark: SparkSession, d: str) -> DataFrame:
    vectors, centres, assignment = _first_round(_vectors(spark, d))
    assignment = materialise(assignment, "assignment")
    return _round9(clustering.update(vectors, assignment, centres), "w")


def kmeans_l1_dense_assign(spark: SparkSession, d: str) -> DataFrame:
    return _first_round(_dense(spark, d))[2]


def kmeans_l1_dense_update(spark: SparkSession, d: str) -> DataFrame:
    vectors, centres, assignment = _first_round(_dense(spark, d))
    assignment = materialise(assignment, "assignment")
    means = _round9(clustering.update(vectors, assignment, centres), "w")
    return means.withColumnRenamed("term", "idx")


def kmeans_l1(spark: SparkSession, d: str) -> DataFrame:
    vectors = _vectors(spark, d)
    return clustering.kmeans(vectors, clustering.seeds(vectors, seed=1))[1]


def kmeans_l1_rounds(spark: SparkSession, d: str) -> DataFrame:
    """The assignment after exactly three rounds, from the first ids as seeds."""
    vectors = _vectors(spark, d)
    return clustering.kmeans(vectors, clustering.seeds(vectors), delta=0.0, max_rounds=3)[1]


def clustering_run(spark: SparkSession, d: str) -> DataFrame:
    """Phase 2 from documents to assignment, three rounds from the first ids; run twice.

    The second run takes every stage of the first.
    """
    out, settings = scratch_path(spark, "clustering"), {"seed": None, "delta": 0.0, "max_rounds": 3}
    inputs = manifest.fingerprint(src.table(spark, d, "documents"))
    for _ in range(2):
        _, points = phases.run_clustering(_document_terms(spark, d), _n_docs(spark, d), out, inputs=inputs, **settings)
    return points


def cluster_representatives(spark: SparkSession, d: str) -> DataFrame:
    return clustering.representatives(_first_round(_vectors(spark, d))[2])


def cluster_seed_representatives(spark: SparkSession, d: str) -> DataFrame:
    vectors, _, assignment = _first_round(_vectors(spark, d))
    return clustering.representatives(assignment, seed_docs=clustering.seeds(vectors))


def representative_docs(spark: SparkSession, d: str) -> DataFrame:
    reps = clustering.representatives(_first_round(_vectors(spark, d))[2])
    return clustering.representative_documents(
        src.table(spark, d, "documents").select("doc_id", "text"), reps
    )


# topic models


def _corpus_bag(spark: SparkSession, d: str) -> DataFrame:
    return topics.corpus_bag(stats.term_freq(_document_terms(spark, d)))


def _corpus_fit(spark: SparkSession, d: str, **settings) -> topics.Topics:
    """Topics of the whole corpus, its documents dealt by block."""
    docs, n = src.by_block(src.table(spark, d, "documents").select("doc_id", "text"))
    terms = src.terms(src.sentences(docs), keys=("block", "doc_id"))
    return topics.corpus_topics(stats.term_freq(terms), buckets=n, **settings)


def _exact_rounds(rounds: int) -> dict:
    """Settings that make a fit end after so many rounds, whatever it has reached."""
    return {"max_iter": rounds, "tolerance": -1.0}


def _corpus_rounds(spark: SparkSession, d: str, rounds: int = TOPIC_ROUNDS) -> topics.Topics:
    return _corpus_fit(spark, d, **_exact_rounds(rounds))


def _cluster_rounds(spark: SparkSession, d: str) -> topics.Topics:
    """Topics of the documents nearest to the centres, after rounds that SQL can follow."""
    docs = src.table(spark, d, "documents").select("doc_id", "text")
    assignment = materialise(kmeans_l1_rounds(spark, d), "assignment")
    return phases.topics_of_clusters(docs, assignment, **_exact_rounds(TOPIC_ROUNDS))


def lda_cluster_topics(spark: SparkSession, d: str) -> DataFrame:
    vectors = _vectors(spark, d)
    _, assignment = clustering.kmeans(vectors, clustering.seeds(vectors, seed=1))
    docs = src.table(spark, d, "documents").select("doc_id", "text")
    return phases.topics_of_clusters(docs, assignment).terms


def lda_corpus_topics(spark: SparkSession, d: str) -> DataFrame:
    return _corpus_fit(spark, d).terms


def _term_topics(model: topics.Topics) -> DataFrame:
    counts = F.array(*[F.round(f"t{j}", 6) for j in range(len(model.totals))])
    return model.counts.select("term", F.posexplode(counts).alias("topic", "n"))


def lda_cvb0_step(spark: SparkSession, d: str) -> DataFrame:
    """Expected counts of each term and topic after one round from the hashed starts."""
    return _term_topics(_corpus_rounds(spark, d, 1))


def lda_cvb0_rounds(spark: SparkSession, d: str) -> DataFrame:
    return _term_topics(_corpus_rounds(spark, d))


def lda_likelihood_rounds(spark: SparkSession, d: str) -> DataFrame:
    """Log-likelihood a token before each of three rounds."""
    rows = [(r, round(x, 6)) for r, x in enumerate(_corpus_rounds(spark, d).likelihood)]
    return spark.createDataFrame(rows, "round int, likelihood double")


def lda_prior_update(spark: SparkSession, d: str) -> DataFrame:
    """The document prior after one step from the hashed starts."""
    k, alpha = topics.CORPUS_TOPICS, topics.CORPUS_ALPHA
    cells = topics.starting_cells(_corpus_bag(spark, d), k)
    new = topics.updated_prior(topics.topic_counts(cells, "doc_id", "d", k), [alpha] * k)
    return spark.createDataFrame([(j, round(a, 6)) for j, a in enumerate(new)], "topic int, alpha double")


def lda_topic_terms(spark: SparkSession, d: str) -> DataFrame:
    return _corpus_rounds(spark, d).terms


def lda_cluster_terms(spark: SparkSession, d: str) -> DataFrame:
    return _cluster_rounds(spark, d).terms


def lda_corpus_terms(spark: SparkSession, d: str) -> DataFrame:
    return topics.distinct_terms(_corpus_rounds(spark, d).terms)


def topic_term_counts_lda(spark: SparkSession, d: str) -> DataFrame:
    return ranking.topic_term_counts(_terms(spark, d), lda_corpus_terms(spark, d))


def topic_term_counts_cluster(spark: SparkSession, d: str) -> DataFrame:
    found = topics.distinct_terms(_cluster_rounds(spark, d).terms)
    return ranking.topic_term_counts(_terms(spark, d), found)


def lda_corpus_shape(spark: SparkSession, d: str) -> DataFrame:
    """Terms and ranks of each topic, and how many of its terms no document has."""
    found = lda_corpus_topics(spark, d)
    words = word_count(spark, d).select(F.lower("term").alias("term")).distinct()
    known = words.withColumn("known", F.lit(1))
    return (
        found.join(known, "term", "left")
        .groupBy("topic")
        .agg(
            F.count(F.lit(1)).alias("n_terms"),
            (F.max("rank") + 1).cast("long").alias("n_ranks"),
            F.count_if(F.col("known").isNull()).alias("n_unknown"),
        )
    )


def summary_topics_frequent(spark: SparkSession, d: str) -> DataFrame:
    """The topic summary with the most frequent terms in a topic model's place.

    Its sentences are taken from an index of all sentences, as those of the three summaries.
    """
    clean = _clean(spark, d)
    index = dedup.SimilarityIndex(clean)
    return phases.topic_summary(clean, _frequent_terms(spark, d), index=index)


def summary_topics_cluster(spark: SparkSession, d: str) -> DataFrame:
    return phases.topic_summary(_clean(spark, d), _cluster_rounds(spark, d).terms)


def summary_topics_corpus(spark: SparkSession, d: str) -> DataFrame:
    return phases.topic_summary(_clean(spark, d), lda_corpus_terms(spark, d))


def _vector_sizes(vectors: DataFrame) -> DataFrame:
    raw = vectors.select("doc_id", F.unwrap_udt("features").alias("v"))
    return raw.select(
        "doc_id",
        F.size("v.values").cast("long").alias("entries"),
        F.round(F.aggregate("v.values", F.lit(0.0), lambda a, x: a + x), 6).alias("total"),
    )


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        tagged_records,
        corpus_size,
        text_sink_round_trip,
        line_sink_round_trip,
        vector_sink_round_trip,
        overwrite_round_trip,
        tagged_file_round_trip,
        document_file_round_trip,
        strip_tags,
        punct_to_space,
        tokens,
        remove_stop_words,
        clean_sentences,
        drop_elements,
        letter_tokens,
        distinct_letter_terms,
        char_shingles,
        jaccard_pairs,
        word_count,
        top_words,
        term_freq,
        term_share,
        doc_freq,
        tfidf,
        term_weights_letters_only,
        doc_vectors_aligned,
        doc_vectors_positional,
        top_dictionary_words,
        top_word_synonyms,
        sentence_scores,
        top_sentences,
        distinct_sentences,
        near_dup_sentences,
        topic_term_counts,
        topic_sentences,
        summary_top_rank,
        cluster_seeds,
        kmeans_l1_assign,
        kmeans_l1_update,
        kmeans_l1_dense_assign,
        kmeans_l1_dense_update,
        kmeans_l1,
        kmeans_l1_rounds,
        clustering_run,
        cluster_representatives,
        cluster_seed_representatives,
        representative_docs,
        lda_cluster_topics,
        lda_corpus_topics,
        lda_cvb0_step,
        lda_cvb0_rounds,
        lda_likelihood_rounds,
        lda_prior_update,
        lda_topic_terms,
        lda_cluster_terms,
        lda_corpus_terms,
        topic_term_counts_lda,
        topic_term_counts_cluster,
        lda_corpus_shape,
        summary_topics_frequent,
        summary_topics_cluster,
        summary_topics_corpus,
    )
}
