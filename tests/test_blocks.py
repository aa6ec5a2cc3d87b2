"""Tables in buckets of blocks give what the tables dealt by document give."""

import os

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pytest
from pyspark.sql import functions as F

from brevia.functions import shingles as sh
from brevia.operators import clustering, ranking, stats, topics
from brevia.session import as_dealt, bucketed, buckets, discard, materialise
from brevia.sources import documents as src

WORDS = "alpha Beta beta2 gamma delta x1 x2 the of epsilon zeta_1 eta theta".split()


@pytest.fixture(scope="module")
def docs(spark, tmp_path_factory):
    text = lambda i: "\n".join(" ".join(WORDS[(i * 7 + j * j + k) % len(WORDS)] for k in range(4)) for j in range(i % 5))
    rows = [(i, text(i)) for i in range(60)] + [(3, "alpha again"), (None, "alpha\nnobody"), (70, None), (71, "")]
    path = str(tmp_path_factory.mktemp("blocks") / "documents.parquet")
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(path)
    return spark.read.parquet(path)


def _sorted(df, *columns):
    return sorted(map(repr, df.select(*columns).collect()))


def _exchanges(df):
    return df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")


def test_weights_and_scores_by_block(spark, docs):
    plain = stats.tfidf(stats.document_shares(docs), src.n_docs(docs))
    blocks = src.in_blocks(docs)
    weights = stats.block_weights(blocks, src.n_docs(docs), stats.with_letters)
    rounded = F.round("tfidf", 9).alias("tfidf")
    assert _sorted(weights, "doc_id", "term", rounded) == _sorted(plain, "doc_id", "term", rounded)
    letters = stats.letter_weights(weights)
    scores = ranking.sentence_scores(src.block_terms(blocks), letters)
    with as_dealt(spark):
        assert _exchanges(weights) == _exchanges(letters) == _exchanges(scores) == 0
    old = ranking.sentence_scores(src.terms(src.sentences(docs)), stats.letter_weights(plain.where("doc_id <> 3")))
    columns = "doc_id", "pos", "n_tokens", F.round("score", 9).alias("score")
    keep = "doc_id <> 3 OR doc_id IS NULL"
    assert _sorted(scores.where(keep), *columns) == _sorted(old.where(keep), *columns)


def test_slots_by_block(spark, docs):
    plain = stats.positional_vectors(stats.tfidf(stats.document_shares(docs), src.n_docs(docs)).where("doc_id <> 3"))
    found = stats.positional_vectors(stats.block_weights(src.in_blocks(docs), src.n_docs(docs)).where("doc_id <> 3"))
    assert _sorted(found, "doc_id", "slot", "w") == _sorted(plain, "doc_id", "slot", "w")


def test_rounds_by_block(spark, docs):
    blocks = src.in_blocks(docs)
    vectors = bucketed(stats.vectors(stats.block_weights(blocks, src.n_docs(docs))), "block", buckets(blocks), "vectors")
    plain = materialise(vectors.drop("block"), "vectors")
    seeds = clustering.seeds(plain.where("doc_id IS NOT NULL"))
    for rounds in (1, 4):
        a, b = (clustering.kmeans(v, seeds, delta=0.0, max_rounds=rounds) for v in (vectors, plain))
        assert _sorted(a[1], "doc_id", "cluster", "distance") == _sorted(b[1], "doc_id", "cluster", "distance")
        w = F.round("w", 9).alias("w")
        assert _sorted(a[0], "cluster", "term", w) == _sorted(b[0], "cluster", "term", w)
    wide = spark.range(3).select(F.concat(F.lit("x"), "id").alias("term"), *[F.lit(1.0).alias(f"c{j}") for j in range(5)])
    with as_dealt(spark):
        near = clustering._nearest_two(vectors, wide, [F.lit(1.0)] * 5, clustering._block_terms(vectors), buckets(vectors))
        plan = near._jdf.queryExecution().executedPlan().toString()
        assert "Exchange hashpartitioning(block" in plan and "Exchange hashpartitioning(doc_id" not in plan


def test_shingles_as_arrays(spark, monkeypatch):
    texts = ["abcabc", "ab", "", None, "a\t \nb  c", "żółć 😀😀😀x", "aaaa", "abcabd", "cafés"]
    rows = [(i, a, b) for i, (a, b) in enumerate(zip(texts, texts[3:] + texts[:3]))]
    df = spark.createDataFrame(rows, "k int, a string, b string").repartition(1)
    for size in (1, 8, sh.SLICE):
        monkeypatch.setattr(sh, "SLICE", size)
        pairs = [p for p in sh._slices([texts, texts])]
        assert [i for p in pairs for i in range(p.start, p.stop)] == list(range(len(texts)))
    a, b = (sh.shingle_codes(F.col(c)) for c in "ab")
    sizes = [F.when(F.col(c).isNull(), 0).otherwise(F.size(x)) for c, x in zip("ab", (a, b))]
    both = F.when(F.col("a").isNull() | F.col("b").isNull(), 0).otherwise(F.size(F.array_intersect(a, b)))
    ascii_only = df.where("k NOT IN (2, 5)")  # split cuts characters outside the plane in two
    want = ascii_only.select("k", *[x.cast("long").alias(n) for x, n in zip([*sizes, both], ("size_a", "size_b", "shared"))])
    assert _sorted(sh.compared(ascii_only), "k", "size_a", "size_b", "shared") == _sorted(want, "k", "size_a", "size_b", "shared")
    want = df.select(F.explode(sh.char_shingles(F.col("a"))).alias("shingle")).groupBy("shingle").agg(F.count("*").alias("n"))
    found = sh.shingle_counts(df.select("a"))
    assert _sorted(found, "shingle", "n") == _sorted(want, "shingle", "n")
    # counted before the exchange: no array of shingles in the plan
    assert "array_distinct" not in found._jdf.queryExecution().toString()


def test_topic_rounds_by_block_exchange_no_cells(spark, docs, monkeypatch):
    plans, gone = [], []
    watch = lambda df, *more: (plans.append(df._jdf.queryExecution().executedPlan().toString()), bucketed(df, *more))[1]
    monkeypatch.setattr(topics, "bucketed", watch)
    monkeypatch.setattr(topics, "discard", lambda *tables: (gone.extend(f for t in tables for f in t.inputFiles()), discard(*tables)))
    plain = stats.term_freq(src.terms(src.sentences(docs)))
    dealt, n = src.by_block(docs)
    by_block = stats.term_freq(src.terms(src.sentences(dealt), keys=("block", "doc_id")))
    settings = {"k": 3, "top_n": 4, "max_iter": 3, "tolerance": -1.0, "prior_every": 2}
    old, new = topics.corpus_topics(plain, **settings), topics.corpus_topics(by_block, buckets=n, **settings)
    columns = ["term", *[F.round(f"t{j}", 9).alias(f"t{j}") for j in range(3)]]
    assert _sorted(new.counts, *columns) == _sorted(old.counts, *columns)
    assert new.likelihood == pytest.approx(old.likelihood) and new.alpha == pytest.approx(old.alpha)
    # terms out of a block and back, and the documents' counts, but not the cells
    assert len(plans) == 2 and all("REPARTITION_BY_COL" not in p and "Bucketed: true" in p for p in plans)
    assert gone and not [f for f in gone if os.path.exists(f.removeprefix("file://"))]


def test_topic_rounds_by_block_write_one_table_each(spark, docs, monkeypatch):
    names = []
    for write, at in (("materialise", 1), ("observed", 1), ("bucketed", 3)):
        old = getattr(topics, write)
        monkeypatch.setattr(topics, write, lambda *a, old=old, at=at, **kw: (names.append(a[at]), old(*a, **kw))[1])
    dealt, n = src.by_block(docs)
    tf = stats.term_freq(src.terms(src.sentences(dealt), keys=("block", "doc_id")))
    model = topics.corpus_topics(tf, k=3, top_n=4, max_iter=5, tolerance=-1.0, buckets=n)
    assert len(model.likelihood) == 5 and names.count("cells") == 5 and "docs" not in names
    assert len(names) <= 5 + 6


def test_cells_as_arrays_in_parts(monkeypatch):
    from brevia.operators import topic_blocks as tb

    rng = np.random.default_rng(3)
    g = rng.dirichlet(np.ones(3), 50).T
    starts, own, at, n = np.array([0, 7, 30]), np.arange(10, 18) * 2**33, rng.integers(0, 8, 50), rng.integers(1, 5, 50)
    t = tb._term_counts(at, n, g, 8)
    want, ll = tb.moved(starts, at, n, g, t, t.sum(axis=1), [0.1, 0.2, 0.3], 0.01, 8)
    doc = np.repeat([0, 1, 2], [7, 23, 20])
    d = np.stack([np.bincount(doc, n * x) for x in g])
    alpha = np.array([[0.1], [0.2], [0.3]])
    x = (t[:, at] - g + 0.01) * (d[:, doc] - g + alpha) / (t.sum(axis=1)[:, None] - g + 0.08)
    assert np.allclose(want, x / x.sum(axis=0)) and ll < 0
    for part, size in ((9, 4), (1, 1), (1 << 20, 1 << 16)):
        monkeypatch.setattr(tb, "PART", part)
        monkeypatch.setattr(tb, "SLICE", size)
        rows = tb._table(tb._cell_rows(4, starts, own, at.astype(np.int32), n, g)[::-1])
        assert rows.num_rows == -(-50 // max(1, part // 3))
        found = tb.cells_of(rows, 3)
        assert all(np.allclose(a, b) for a, b in zip(found, (starts, own, at, n, g)))
        again, ll2 = tb.moved(*(found[i] for i in (0, 2, 3, 4)), t, t.sum(axis=1), [0.1, 0.2, 0.3], 0.01, 8)
        assert np.allclose(again, want) and ll2 == pytest.approx(ll)
    for shards in (1, 3, 100):  # counts come back to the block whole, whatever the shards
        rows = tb._table(tb._count_rows(4, own, t, shards, -2.0) + tb._count_rows(5, own[2:4], t[:, :2], shards))
        idx, found = [], []
        for shard in set(rows.column("shard").to_pylist()):
            summed = tb._summed(3)(rows.filter(pc.equal(rows.column("shard"), shard)))
            here = tb._counts_of(summed.filter(pc.equal(summed.column("block"), 4)), 3)
            idx.append(here[0]), found.append(here[1])
        by = np.argsort(np.concatenate(idx))
        both = t.copy()
        both[:, 2:4] += t[:, :2]
        assert np.allclose(np.concatenate(found, axis=1)[:, by], both) and rows.column("ll").to_pylist().count(-2.0) == 1


def test_rounds_over_arrays(spark, docs, monkeypatch):
    blocks = src.in_blocks(docs)
    vectors = bucketed(stats.vectors(stats.block_weights(blocks, src.n_docs(docs))), "block", buckets(blocks), "vectors")
    seeds = clustering.seeds(vectors.where("doc_id IS NOT NULL"))
    want = [clustering.kmeans(vectors, seeds, delta=0.0, max_rounds=r) for r in (1, 4)]
    monkeypatch.setattr(clustering, "ARRAY_ROUNDS", 1)
    monkeypatch.setattr(clustering, "_tagged", lambda *a: (_ for _ in ()).throw(AssertionError))  # no join of entries
    for rounds, old in zip((1, 4), want):
        new = clustering.kmeans(vectors, seeds, delta=0.0, max_rounds=rounds)
        assert _sorted(new[1], "doc_id", "cluster", "distance") == _sorted(old[1], "doc_id", "cluster", "distance")
        w = F.round("w", 9).alias("w")
        assert _sorted(new[0], "cluster", "term", w) == _sorted(old[0], "cluster", "term", w)


def test_vectors_as_arrays_in_parts(monkeypatch):
    from brevia.operators import vector_blocks as vb

    monkeypatch.setattr(vb, "PART", 2)
    kinds = [pa.int32(), pa.int32(), pa.list_(pa.int64()), *[pa.binary()] * 4]
    schema = pa.schema(list(zip(["block", "part", "docs", "starts", "own", "at", "w"], kinds)))
    rows = pa.table({"doc_id": [7, None, 3, 7, None], "term": list("babca"), "w": [1.0, 2.0, 3.0, 4.0, 5.0]})
    terms = pa.table({"block": pa.array([1, 1, 1], pa.int32()), "term": list("abc"), "idx": [30, 10, 20]})
    found = vb._packed(schema)(rows, terms)
    assert found.num_rows == 3
    docs, starts, own, at, w = vb._entries(found.take([2, 0, 1]))
    assert docs.to_pylist() == [7, None, 3] and starts.tolist() == [0, 2, 4] and own.tolist() == [10, 20, 30]
    assert at.tolist() == [0, 1, 2, 2, 0] and w.tolist() == [1.0, 4.0, 2.0, 5.0, 3.0]
