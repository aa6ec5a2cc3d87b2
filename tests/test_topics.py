"""The topic model against a plain second implementation."""

import hashlib
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from brevia.operators import stats, topics
from brevia.session import materialise, observed
from brevia.sources import documents as src


def bag_rows(seed=2, docs=30):
    rng = random.Random(seed)
    words = [[f"{p}{c}" for c in "abcdefgh"] for p in ("red", "blue", "green")]
    out = []
    for d in range(docs):
        own = rng.choices(words[d % 3], k=20) + rng.choices(sum(words, []), k=3)
        out += [(d, w, own.count(w)) for w in sorted(set(own))]
    return out


def start(doc, term, k, seed):
    draws = []
    for j in range(k):
        digest = hashlib.md5(f"{seed} {doc} {term} {j // 4}".encode()).hexdigest()
        draws.append(int(digest[8 * (j % 4) : 8 * (j % 4) + 8], 16) + 1.0)
    return np.array(draws) / sum(draws)


def plain_rounds(rows, k, alpha, beta, rounds, seed=0):
    """Counts by term, totals, counts by document and likelihoods, cell by cell."""
    g = {(d, w): start(d, w, k, seed) for d, w, _ in rows}
    vocabulary, documents = sorted({w for _, w, _ in rows}), sorted({d for d, _, _ in rows})
    likelihood = []
    for done in range(rounds + 1):
        t = {w: sum(n * g[d, v] for d, v, n in rows if v == w) for w in vocabulary}
        by_doc = {e: sum(n * g[d, v] for d, v, n in rows if d == e) for e in documents}
        total = sum(t.values())
        if done == rounds:
            return t, total, by_doc, likelihood
        ll, new = 0.0, {}
        for d, w, n in rows:
            own = g[d, w]
            x = (t[w] - own + beta) * (by_doc[d] - own + alpha) / (total - own + len(vocabulary) * beta)
            new[d, w] = x / x.sum()
            p = ((t[w] + beta) / (total + len(vocabulary) * beta) * (by_doc[d] + alpha)).sum()
            ll += n * math.log(p / (by_doc[d].sum() + k * alpha))
        likelihood.append(ll / sum(n for _, _, n in rows))
        g = new


@pytest.fixture(scope="module")
def bag(spark):
    return spark.createDataFrame(bag_rows(), "doc_id long, term string, n long")


@pytest.mark.parametrize("k, rounds", [(3, 4), (6, 2)])
def test_rounds(bag, k, rounds):
    model = topics.fit_topics(bag, k, 5, alpha=0.3, beta=0.05, seed=7, max_iter=rounds, tolerance=-1.0)
    t, total, _, likelihood = plain_rounds(bag_rows(), k, 0.3, 0.05, rounds, 7)
    for row in model.counts.collect():
        assert np.allclose([row[f"t{j}"] for j in range(k)], t[row["term"]], atol=1e-9)
    assert np.allclose(model.totals, total) and np.allclose(model.likelihood, likelihood)
    size = len(t)
    for row in model.terms.where("rank = 0").collect():
        j = row["topic"]
        weight = {w: round((c[j] + 0.05) / (total[j] + size * 0.05), 9) for w, c in t.items()}
        assert row["term"] == min(weight, key=lambda w: (-weight[w], w))


def test_fit_ends_by_likelihood_and_finds_the_groups(bag):
    model = topics.fit_topics(bag, 3, 8, alpha=0.1, beta=0.01, tolerance=1e-6)
    rises = np.diff(model.likelihood)
    assert len(model.likelihood) < topics.ROUNDS and abs(rises[-1]) <= 1e-6 * abs(model.likelihood[-2])
    assert model.likelihood[-1] > model.likelihood[0]
    groups = [{r["term"][:3] for r in model.terms.where(F.col("topic") == j).collect()} for j in range(3)]
    assert sorted(map(tuple, groups)) == [("blu",), ("gre",), ("red",)]


def plain_prior(by_doc, alpha):
    def digamma(x):  # a difference quotient of the logarithm of the gamma function
        return (math.lgamma(x + 1e-5) - math.lgamma(x - 1e-5)) / 2e-5

    whole = sum(alpha)
    over = sum(digamma(c.sum() + whole) - digamma(whole) for c in by_doc.values())
    return [a * sum(digamma(c[j] + a) - digamma(a) for c in by_doc.values()) / over for j, a in enumerate(alpha)]


def test_prior_update(bag):
    cells = topics.starting_cells(bag, 3)
    new = topics.updated_prior(topics.topic_counts(cells, "doc_id", "d", 3), [0.4, 0.5, 0.6])
    _, _, by_doc, _ = plain_rounds(bag_rows(), 3, 0.4, 0.01, 0)
    assert np.allclose(new, plain_prior(by_doc, [0.4, 0.5, 0.6]), rtol=1e-5)


def test_estimated_prior_is_used(bag):
    settings = {"alpha": 0.7, "beta": 0.01, "max_iter": 3, "tolerance": -1.0}
    fixed, free = (topics.fit_topics(bag, 3, 3, prior_every=e, **settings) for e in (0, 2))
    _, _, by_doc, _ = plain_rounds(bag_rows(), 3, 0.7, 0.01, 2)
    assert fixed.alpha == [0.7] * 3
    assert np.allclose(free.alpha, plain_prior(by_doc, [0.7] * 3), rtol=1e-5)
    assert free.likelihood[:2] == pytest.approx(fixed.likelihood[:2])
    assert free.likelihood[2] != pytest.approx(fixed.likelihood[2], abs=1e-9)


def test_held_out_perplexity_falls(spark, bag):
    fresh = spark.createDataFrame(
        [(100 + d, w, n) for d, w, n in bag_rows(9)] + [(500, "unknown", 3)], "doc_id long, term string, n long"
    )
    early = topics.fit_topics(bag, 3, 3, alpha=0.1, max_iter=1, tolerance=-1.0)
    late = topics.fit_topics(bag, 3, 3, alpha=0.1, max_iter=40)
    a, b = (topics.held_out_perplexity(m, fresh) for m in (early, late))
    assert 1 < b < 0.8 * a < 24


def test_empty_bag(spark):
    none = spark.createDataFrame([], "doc_id long, term string, n long")
    model = topics.fit_topics(none, 2, 3)
    assert model.terms.count() == 0 and model.vocabulary_size == 0 and model.likelihood == []


def test_a_fit_writes_cells_only_for_a_further_round(spark, bag, monkeypatch):
    written = []
    monkeypatch.setattr(topics, "materialise", lambda df, name: (written.append(name), materialise(df, name))[1])
    monkeypatch.setattr(topics, "observed", lambda df, name, m: (written.append(name), observed(df, name, m))[1])
    topics.fit_topics(bag, 3, 5, max_iter=2, tolerance=-1.0)
    assert written.count("cells") == 1 and written.count("docs") == 2


def test_rows_dealt_by_document_are_counted_without_an_exchange(spark):
    docs = spark.createDataFrame([(1, "Red red\nblue"), (1, "green"), (None, "red")], "doc_id long, text string")
    tf = stats.term_freq(src.terms(src.sentences(src.by_document(docs))))
    bag = topics.corpus_bag(tf)
    rows = [(r.doc_id, r.term, r.n) for r in bag.collect()]
    assert sorted(rows, key=str) == sorted([(1, "red", 2), (1, "blue", 1), (1, "green", 1), (None, "red", 1)], key=str)
    plan = bag._jdf.queryExecution().executedPlan().toString()
    assert plan.split("Initial Plan")[-1].count("Exchange") == 1


def test_a_small_bag_is_fitted_by_one_task(spark, monkeypatch):
    rows = bag_rows() + [(None, "red", 2), (None, "nobody", 1)]
    bag = spark.createDataFrame(rows, "doc_id long, term string, n long")
    names = []
    monkeypatch.setattr(topics, "materialise", lambda df, name: (names.append(name), materialise(df, name))[1])
    for more in ({"max_iter": 4, "prior_every": 2}, {"max_iter": 1}, {"max_iter": 3, "prior_every": 3}, {"max_iter": 40}):
        settings = {"alpha": 0.7, "beta": 0.05, "seed": 7, "tolerance": 0.05 if more["max_iter"] == 40 else -1.0} | more
        old = topics.fit_topics(bag, 6, 5, **settings)
        names.clear()
        new = topics.fit_topics(bag, 6, 5, together=1 << 20, **settings)
        assert names == ["fit", "topics"]
        assert new.likelihood == pytest.approx(old.likelihood) and new.alpha == pytest.approx(old.alpha)
        assert new.totals == pytest.approx(old.totals) and new.vocabulary_size == old.vocabulary_size
        by = lambda m: {r["term"]: [r[f"t{j}"] for j in range(6)] for r in m.counts.collect()}
        a, b = by(old), by(new)
        assert set(a) == set(b) and all(a[w] == pytest.approx(b[w], abs=1e-9) for w in a)
        assert sorted(old.terms.select("topic", "rank", "term").collect()) == sorted(new.terms.select("topic", "rank", "term").collect())
    names.clear()
    topics.fit_topics(bag, 6, 5, together=10, max_iter=2, tolerance=-1.0)
    assert "fit" not in names and "cells" in names
