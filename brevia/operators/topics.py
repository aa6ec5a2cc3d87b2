"""Topic models over bags of words ``(doc_id, term, n)``.

Inference is collapsed and variational, of order zero (CVB0): every (document, term) cell
has one responsibility for each topic. A round groups the cells' expected counts by term
and by document, joins both tables back and writes the new cells. All three tables are
sharded, no document or term is dropped, and a round costs two exchanges of the cells at
most; the planner broadcasts a table of counts when its files are small. A bag with the block of
each document (``sources.documents.by_block``) costs none: its cells lie as arrays in buckets of the block, and only
the counts of the distinct terms of a block travel (``topic_blocks``). ``k`` totals and one log-likelihood reach the driver.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from brevia.functions import text as tx
from brevia.operators import topic_blocks
from brevia.session import as_dealt, bucketed, discard, materialise, observed
from brevia.sources.documents import same_block

# Settings of the two models.
CLUSTER_TOPICS = 50
CLUSTER_SEED = 5
CLUSTER_TERMS = 15
CLUSTER_ALPHA = 1.0
CLUSTER_BETA = 0.01
PRIOR_ROUNDS = 50
CORPUS_TOPICS = 4
CORPUS_ALPHA = 0.5
CORPUS_TERMS = 50

CORPUS_BETA = 0.01
# A fit has this many rounds at most, and at least MIN_ROUNDS: from hashed starts the
# first rounds move little.
ROUNDS = 200
MIN_ROUNDS = 10
TOLERANCE = 5e-4
MIN_ALPHA = 1e-6
FOLD_IN_ROUNDS = 10
# Numbers of the cells (topics times cells) that one task may hold.
TOGETHER = 1 << 23


def bag_of_letter_terms(docs: DataFrame, stop_words=None, **elements) -> DataFrame:
    """Element-free, lower-cased letter tokens of whole documents: ``(doc_id, term, n)``."""
    tokens = tx.letter_tokens(tx.drop_elements(F.col("text"), **elements), stop_words)
    return (
        docs.select("doc_id", F.explode_outer(tokens).alias("term"))
        .where("term IS NOT NULL")
        .groupBy("doc_id", "term")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def vocabulary(bag: DataFrame) -> DataFrame:
    """Every term with a dense index from 0 in term order: ``(term, idx)``.

    The sorted terms are written once; an index is the place inside its partition plus
    the sizes of the partitions before it, so no task sees the whole vocabulary. Only
    one count per partition is joined back.
    """
    spread = bag.select("term").distinct().orderBy("term")
    rows = materialise(
        spread.select("term", F.monotonically_increasing_id().alias("id")), "vocabulary"
    )
    # an id holds its partition in the high bits and the place inside it in the low 33
    rows = rows.select(
        "term", F.shiftright("id", 33).alias("part"), F.col("id").bitwiseAND((1 << 33) - 1).alias("at")
    )
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        rows.groupBy("part")
        .agg(F.count(F.lit(1)).alias("size"))
        .select("part", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("start"))
    )
    return rows.join(starts, "part").select("term", (F.col("start") + F.col("at")).alias("idx"))


def _names(prefix: str, k: int) -> list[str]:
    return [f"{prefix}{j}" for j in range(k)]


def _all(columns) -> Column:
    return reduce(lambda a, b: a + b, columns)


def starting_cells(bag: DataFrame, k: int, seed: int = 0) -> DataFrame:
    """``(doc_id, term, n, g0 ... gk-1)`` with responsibilities drawn from a digest.

    Eight hexadecimal digits of the digest of seed, document, term and block make one
    draw, so another engine gets the same ones; draws are scaled to sum to 1.
    """
    digest = [F.md5(F.concat_ws(" ", F.lit(str(seed)), "doc_id", "term", F.lit(str(b)))) for b in range(-(-k // 4))]
    draw = [
        (F.conv(F.substring(f"h{j // 4}", 8 * (j % 4) + 1, 8), 16, 10).cast("double") + 1.0).alias(f"g{j}")
        for j in range(k)
    ]
    own = [*same_block(bag), "doc_id", "term", "n"]
    drawn = bag.select(*own, *[h.alias(f"h{b}") for b, h in enumerate(digest)])
    drawn = drawn.select(*own, *draw)
    total = _all(F.col(g) for g in _names("g", k))
    drawn = drawn.withColumn("total", total)
    return drawn.select(*own, *[(F.col(g) / F.col("total")).alias(g) for g in _names("g", k)])


def topic_counts(cells: DataFrame, by: str, prefix: str, k: int) -> DataFrame:
    """Expected tokens of each topic for every term or document: ``(by, prefix0 ...)``.

    Those of documents keep the block, if the cells have one.
    """
    sums = [F.sum(F.col("n") * F.col(f"g{j}")).alias(f"{prefix}{j}") for j in range(k)]
    return cells.groupBy(*(same_block(cells) if by == "doc_id" else []), by).agg(*sums)


def _likelihood(alpha: list[float], beta: float, size: int) -> Column:
    """Log-likelihood of a cell's tokens under the counts joined to it."""
    mix = [
        (F.col(f"t{j}") + beta) / (F.col(f"all{j}") + size * beta) * (F.col(f"d{j}") + a) for j, a in enumerate(alpha)
    ]
    length = _all(F.col(f"d{j}") for j in range(len(alpha)))
    return F.col("n") * F.log(_all(mix) / (length + sum(alpha)))


def cvb0_update(
    cells: DataFrame,
    terms: DataFrame,
    docs: DataFrame,
    totals: list[float],
    alpha: list[float],
    beta: float,
    size: int,
) -> DataFrame:
    """Cells after one round, with ``ll``, their log-likelihood before it.

    A token's responsibility for topic ``k`` is proportional to the expected counts of all
    other tokens: (term + beta) (document + alpha) / (topic + size beta). The totals are
    joined as one row: as literals they would make each round new code to compile.
    """
    k = len(alpha)
    one = cells.sparkSession.createDataFrame(pa.table({f"all{j}": [n] for j, n in enumerate(totals)}))
    own = [*same_block(cells), "doc_id", "term", "n"]
    joined = cells.join(terms, "term").join(docs, "doc_id").join(F.broadcast(one))
    new = [
        (
            (F.col(f"t{j}") - F.col(f"g{j}") + beta)
            * (F.col(f"d{j}") - F.col(f"g{j}") + a)
            / (F.col(f"all{j}") - F.col(f"g{j}") + size * beta)
        ).alias(f"x{j}")
        for j, a in enumerate(alpha)
    ]
    ll = _likelihood(alpha, beta, size).alias("ll")
    joined = joined.select(*own, ll, *new)
    joined = joined.withColumn("total", _all(F.col(x) for x in _names("x", k)))
    shares = [(F.col(f"x{j}") / F.col("total")).alias(f"g{j}") for j in range(k)]
    return joined.select(*own, *shares, "ll")


def digamma(x: Column) -> Column:
    """Logarithmic derivative of the gamma function for positive values.

    The recurrence carries ``x`` past 6, where four terms of the series are exact to 1e-8.
    """
    y = x + 6.0
    z = 1.0 / (y * y)
    series = F.log(y) - 0.5 / y - z * (1 / 12.0 - z * (1 / 120.0 - z / 252.0))
    return series - _all(1.0 / (x + float(i)) for i in range(6))


def updated_prior(docs: DataFrame, alpha: list[float]) -> list[float]:
    """One fixed-point step of the documents' Dirichlet prior from counts ``(doc_id, d0 ...)``."""
    whole = sum(alpha)
    length = _all(F.col(f"d{j}") for j in range(len(alpha)))
    over = F.sum(digamma(length + whole) - digamma(F.lit(whole))).alias("over")
    under = [F.sum(digamma(F.col(f"d{j}") + a) - digamma(F.lit(a))).alias(f"u{j}") for j, a in enumerate(alpha)]
    row = docs.agg(over, *under).first()
    if not row["over"]:
        return alpha
    return [max(a * row[f"u{j}"] / row["over"], MIN_ALPHA) for j, a in enumerate(alpha)]


@dataclass
class Topics:
    """A fitted model.

    ``terms`` is ``(topic, rank, term, weight)``, the best terms of each topic. ``counts`` is
    ``(term, t0 ...)`` for the whole vocabulary. ``likelihood`` holds the log-likelihood a
    token before each round and after the last.
    """

    terms: DataFrame
    vocabulary_size: int
    counts: DataFrame
    totals: list[float]
    alpha: list[float]
    beta: float
    likelihood: list[float]


def top_terms(counts: DataFrame, totals: list[float], beta: float, size: int, top_n: int) -> DataFrame:
    """The ``top_n`` terms of each topic, ties by term: ``(topic, rank, term, weight)``.

    The counts stay sharded by term; the rank filter is pushed below the exchange, so a
    task sends at most ``top_n`` rows of a topic. Weights are compared to nine places.
    """
    shares = [F.round((F.col(f"t{j}") + beta) / (n + size * beta), 9) for j, n in enumerate(totals)]
    best = Window.partitionBy("topic").orderBy(F.desc("weight"), "term")
    return (
        counts.select("term", F.posexplode(F.array(*shares)).alias("topic", "weight"))
        .withColumn("rank", F.row_number().over(best))
        .where(F.col("rank") <= top_n)
        .select("topic", (F.col("rank") - 1).alias("rank"), "term", "weight")
    )


def fit_topics(
    bag: DataFrame,
    k: int,
    top_n: int,
    alpha: float = CORPUS_ALPHA,
    beta: float = CORPUS_BETA,
    seed: int = 0,
    max_iter: int = ROUNDS,
    min_iter: int = MIN_ROUNDS,
    tolerance: float = TOLERANCE,
    prior_every: int = 0,
    buckets: int = 0,
    together: int = 0,
) -> Topics:
    """Fit ``k`` topics by collapsed variational inference of order zero.

    The fit ends when a round changes the log-likelihood by less than ``tolerance`` of it,
    not before ``min_iter`` rounds; ``max_iter`` bounds it. With ``prior_every`` the
    document prior is estimated anew after every so many rounds. The starting cells follow
    from the bag, so only the bag is written for them. A bag with a block lies in ``buckets`` buckets of
    it, and so do the cells. A bag of up to ``together`` numbers (cells times topics) is fitted by one task.
    """
    settings = (k, top_n, alpha, beta, seed, max_iter, min_iter, tolerance, prior_every)
    if not buckets:
        return _fit(bag.select("doc_id", "term", "n"), *settings, together)
    with as_dealt(bag.sparkSession):
        return _fit_blocks(bag.select("block", "doc_id", "term", "n"), buckets, *settings)


def _fit(
    bag: DataFrame,
    k: int,
    top_n: int,
    alpha: float,
    beta: float,
    seed: int,
    max_iter: int,
    min_iter: int,
    tolerance: float,
    prior_every: int,
    together: int,
) -> Topics:
    bag, seen = observed(bag, "bag", {"n": F.sum("n"), "cells": F.count(F.lit(1))})
    if 0 < seen["cells"] * k <= together:
        return _fit_together(bag, k, top_n, alpha, beta, seed, max_iter, min_iter, tolerance, prior_every)
    n, kept, cells = seen["n"] or 0, bag, starting_cells(bag, k, seed)
    priors, likelihood = [float(alpha)] * k, []
    sums = {f"t{j}": F.sum(f"t{j}") for j in range(k)} | {"size": F.count(F.lit(1))}
    terms, seen = observed(topic_counts(cells, "term", "t", k), "terms", sums)
    for done in range(max_iter + 1):
        totals, size = [seen[f"t{j}"] or 0.0 for j in range(k)], seen["size"]
        last = done == max_iter or not n
        anew = prior_every and done and done % prior_every == 0
        docs = materialise(topic_counts(cells, "doc_id", "d", k), "docs") if anew or not last else None
        if anew:
            priors = updated_prior(docs, priors)
        if last:
            discard(kept, *[docs] * anew)
            break
        met = Observation()
        moved = cvb0_update(cells, terms, docs, totals, priors, beta, size)
        moved = moved.observe(met, F.sum("ll").alias("ll")).drop("ll")
        # cells that no further round and no prior reads are counted without being written
        ends = done + 1 == max_iter and not (prior_every and max_iter % prior_every == 0)
        cells = moved if ends else materialise(moved, "cells")
        counts, seen = observed(topic_counts(cells, "term", "t", k), "terms", sums)
        likelihood.append((met.get["ll"] or 0.0) / n)
        discard(kept, terms, docs)
        kept, terms = cells, counts
        if ends or _settled(likelihood, tolerance) and done + 1 >= min_iter:
            totals = [seen[f"t{j}"] or 0.0 for j in range(k)]
            discard(kept)
            break
    best = materialise(top_terms(terms, totals, beta, size, top_n), "topics")
    return Topics(best, size, terms, totals, priors, beta, likelihood)


def _settled(likelihood: list[float], tolerance: float) -> bool:
    return len(likelihood) > 1 and abs(likelihood[-1] - likelihood[-2]) <= tolerance * abs(likelihood[-2])


def _fit_together(
    bag: DataFrame,
    k: int,
    top_n: int,
    alpha: float,
    beta: float,
    seed: int,
    max_iter: int,
    min_iter: int,
    tolerance: float,
    prior_every: int,
) -> Topics:
    """:func:`_fit` of a small bag: a round is too little work for a query."""

    def settled(likelihood: list[float]) -> bool:
        return _settled(likelihood, tolerance)

    found = topic_blocks.together(bag, k, alpha, beta, seed, max_iter, min_iter, prior_every, settled, MIN_ALPHA)
    found = materialise(found, "fit")
    discard(bag)
    fit = found.where("term IS NULL").first()
    terms = found.where("term IS NOT NULL").select("term", *[F.get("t", F.lit(j)).alias(f"t{j}") for j in range(k)])
    best = materialise(top_terms(terms, fit["totals"], beta, fit["size"], top_n), "topics")
    return Topics(best, fit["size"], terms, fit["totals"], fit["alpha"], beta, fit["likelihood"])


def _fit_blocks(
    bag: DataFrame,
    buckets: int,
    k: int,
    top_n: int,
    alpha: float,
    beta: float,
    seed: int,
    max_iter: int,
    min_iter: int,
    tolerance: float,
    prior_every: int,
) -> Topics:
    """:func:`_fit` with the cells of each block as arrays (``topic_blocks``); a round is one query."""
    bag, seen = observed(bag, "bag", {"n": F.sum("n")}, n=buckets)
    n = seen["n"] or 0
    # a null id has starting cells only
    words = bag.groupBy("term").agg(F.max(F.col("doc_id").isNotNull().cast("int")).alias("stays"))
    words = words.select("term", "stays", F.monotonically_increasing_id().alias("idx"))
    words, seen = observed(words, "words", {"size": F.count(F.lit(1)), "stays": F.sum("stays")})
    size, stays = seen["size"], seen["stays"] or 0
    held = bag.select("block", "term").distinct().join(words.select("term", "idx"), "term")
    held, seen = observed(held, "held", {"n": F.count(F.lit(1))}, n=buckets)
    shards = max(2 * bag.sparkSession.sparkContext.defaultParallelism, seen["n"] * k // topic_blocks.SHARD)
    sums = {f"t{j}": F.sum(F.get("sums", F.lit(j))) for j in range(k)}
    cells, seen = observed(topic_blocks.start(bag, held, k, seed, shards), "cells", sums, n=buckets, dealt=True)
    discard(bag, held)
    priors, likelihood = [float(alpha)] * k, []
    for done in range(max_iter + 1):
        totals = [seen[f"t{j}"] or 0.0 for j in range(k)]
        size = stays if done else size
        if prior_every and done and done % prior_every == 0:
            priors = updated_prior(topic_blocks.document_counts(cells, k), priors)
        if done == max_iter or not n:
            break
        # cells that no further round and no prior reads are not written
        ends = done + 1 == max_iter and not (prior_every and max_iter % prior_every == 0)
        met = Observation()
        moved = topic_blocks.step(cells, buckets, totals, priors, beta, size, shards, ends)
        moved = moved.observe(met, F.sum("ll").alias("ll"), *[c.alias(t) for t, c in sums.items()])
        moved = materialise(moved, "counts") if ends else bucketed(moved, "block", buckets, "cells", True)
        seen = met.get
        likelihood.append((seen["ll"] or 0.0) / n)
        discard(cells)
        cells = moved
        if ends or _settled(likelihood, tolerance) and done + 1 >= min_iter:
            totals = [seen[f"t{j}"] or 0.0 for j in range(k)]
            break
    terms = materialise(topic_blocks.term_counts(cells, words, k), "terms")
    discard(cells, words)
    best = materialise(top_terms(terms, totals, beta, size, top_n), "topics")
    return Topics(best, size, terms, totals, priors, beta, likelihood)


def held_out_perplexity(model: Topics, bag: DataFrame, rounds: int = FOLD_IN_ROUNDS) -> float:
    """Perplexity a token of documents the model was not fitted to.

    Half of a document's terms, chosen by hash, give its topics; the others are scored.
    Terms outside the vocabulary are left out.
    """
    k, size, beta = len(model.alpha), model.vocabulary_size, model.beta
    shares = [((F.col(f"t{j}") + beta) / (t + size * beta)).alias(f"p{j}") for j, t in enumerate(model.totals)]
    half = (F.pmod(F.xxhash64("doc_id", "term"), F.lit(2)) == 0).alias("seen")
    cells = bag.join(model.counts.select("term", *shares), "term").select("doc_id", "n", half, *_names("p", k))
    cells = materialise(cells, "held-out")
    flat = [F.lit(0.0).alias(f"d{j}") for j in range(k)]
    docs = materialise(cells.select("doc_id").distinct().select("doc_id", *flat), "fold-in")
    for _ in range(rounds):
        joined = cells.where("seen").join(docs, "doc_id")
        x = [F.col(f"p{j}") * (F.col(f"d{j}") + a) for j, a in enumerate(model.alpha)]
        parts = [F.sum(F.col("n") * x[j] / _all(x)).alias(f"d{j}") for j in range(k)]
        found = joined.groupBy("doc_id").agg(*parts)
        moved = materialise(found, "fold-in")
        discard(docs)
        docs = moved
    joined = cells.where("NOT seen").join(docs, "doc_id")
    length = _all(F.col(f"d{j}") for j in range(k)) + sum(model.alpha)
    mix = _all(F.col(f"p{j}") * (F.col(f"d{j}") + a) for j, a in enumerate(model.alpha))
    ll, n = joined.agg(F.sum(F.col("n") * F.log(mix / length)), F.sum("n")).first()
    return math.exp(-ll / n) if n else float("nan")


def cluster_topics(docs: DataFrame, k: int = CLUSTER_TOPICS, top_n: int = CLUSTER_TERMS, **kw) -> Topics:
    """Topics of the cluster-representative documents, with an estimated document prior."""
    elements = {n: kw.pop(n) for n in ("attributed", "bare", "stop_words") if n in kw}
    settings = {"alpha": CLUSTER_ALPHA, "beta": CLUSTER_BETA, "seed": CLUSTER_SEED, "prior_every": PRIOR_ROUNDS}
    settings["together"] = TOGETHER
    return fit_topics(bag_of_letter_terms(docs, **elements), k, top_n, **settings | kw)


def corpus_bag(tf: DataFrame) -> DataFrame:
    """Raw term frequencies, folded to lower case."""
    return tf.groupBy(*same_block(tf), "doc_id", F.lower("term").alias("term")).agg(F.sum("n").alias("n"))


def corpus_topics(tf: DataFrame, k: int = CORPUS_TOPICS, top_n: int = CORPUS_TERMS, **kw) -> Topics:
    """Topics of the whole corpus from raw term frequencies."""
    return fit_topics(corpus_bag(tf), k, top_n, **kw)


def distinct_terms(topic_terms: DataFrame, stop_words=None) -> DataFrame:
    """Letters-only set of the terms of all topics: ``(term)``."""
    return topic_terms.select(
        F.explode(tx.distinct_letter_terms(F.col("term"), stop_words)).alias("term")
    ).distinct()
