"""k-means under Manhattan distance, vocabulary and topic models."""

import random

import pytest
from pyspark.sql import functions as F

from brevia.operators import clustering, stats, topics
from brevia.plans import phases
from brevia.sources import documents as src


def long_vectors(spark, data):
    rows = [(i, t, float(w)) for i, v in data.items() for t, w in v.items()]
    return spark.createDataFrame(rows, "doc_id long, term string, w double")


def l1(a, b):
    return sum(abs(a.get(t, 0) - b.get(t, 0)) for t in {*a, *b})


def nearest(v, centres):
    return min(range(len(centres)), key=lambda j: (round(l1(v, centres[j]), 9), j))


def plain_kmeans(data, seeds, delta, rounds):
    centres = [dict(data[s]) for s in seeds]
    for _ in range(rounds):
        where = {i: nearest(v, centres) for i, v in data.items()}
        moved = []
        for j, old in enumerate(centres):
            own = [data[i] for i in data if where[i] == j]
            terms = {t for v in own for t in v}
            moved.append({t: sum(v.get(t, 0) for v in own) / len(own) for t in terms} if own else old)
        shift = max(l1(a, b) for a, b in zip(centres, moved))
        centres = moved
        if shift <= delta:
            break
    return {i: nearest(v, centres) for i, v in data.items()}


def sparse_data(rng, n, terms):
    return {
        i: {f"t{rng.randrange(terms)}": round(rng.random(), 3) for _ in range(rng.randint(1, 5))}
        for i in range(n)
    }


@pytest.mark.parametrize("seed, rounds", [(1, 100), (2, 100), (3, 2)])
def test_kmeans_equals_plain_rounds(spark, seed, rounds):
    data = sparse_data(random.Random(seed), 40, 12)
    vectors = long_vectors(spark, data)
    seeds = clustering.seeds(vectors, 4)
    _, got = clustering.kmeans(vectors, seeds, 4, max_rounds=rounds)
    want = plain_kmeans(data, range(4), clustering.DELTA, rounds)
    assert {r.doc_id: r.cluster for r in got.collect()} == want


def test_a_circle_of_rounds_gives_the_round_the_limit_falls_on(spark, monkeypatch):
    """Pretend nothing converges: the circle must still land on the plain result."""
    data = sparse_data(random.Random(11), 30, 8)
    vectors = long_vectors(spark, data)
    for rounds in (9, 10):
        _, got = clustering.kmeans(vectors, clustering.seeds(vectors, 3), 3, -1.0, rounds)
        want = plain_kmeans(data, range(3), -1.0, rounds)
        assert {r.doc_id: r.cluster for r in got.collect()} == want


def test_assignment_distance_and_representatives(spark):
    data = {0: {"a": 1.0}, 1: {"b": -2.0}, 2: {"a": 0.5, "c": 0.25}, 3: {"z": 9.0}}
    vectors = long_vectors(spark, data)
    centres = clustering.centres_of(vectors, clustering.seeds(vectors, 2))
    rows = clustering.assign(vectors, centres, 2)
    got = {r.doc_id: (r.cluster, r.distance) for r in rows.collect()}
    assert got == {0: (0, 0.0), 1: (1, 0.0), 2: (0, 0.75), 3: (0, 10.0)}
    reps = clustering.representatives(rows, 2)
    assert sorted((r.cluster, r["rank"], r.doc_id) for r in reps.collect()) == [
        (0, 1, 0),
        (0, 2, 2),
        (1, 1, 1),
    ]
    seed_docs = clustering.seeds(vectors, 2)
    began = clustering.representatives(rows, seed_docs=seed_docs)
    assert sorted(tuple(r) for r in began.collect()) == [(0, 1, 0, 0.0), (1, 1, 1, 0.0)]
    docs = spark.createDataFrame([(i, "x") for i in range(4)], "doc_id long, text string")
    kept = clustering.representative_documents(docs, reps)
    assert sorted(r.doc_id for r in kept.collect()) == [0, 1, 2]


def test_update_keeps_an_empty_cluster(spark):
    vectors = long_vectors(spark, {0: {"a": 1.0}, 1: {"a": 3.0, "b": 1.0}})
    assignment = spark.createDataFrame([(0, 0), (1, 0)], "doc_id long, cluster int")
    centres = spark.createDataFrame([(0, "a", 9.0), (1, "q", 4.0)], "cluster int, term string, w double")
    got = {(r.cluster, r.term): r.w for r in clustering.update(vectors, assignment, centres).collect()}
    assert got == {(0, "a"): 2.0, (0, "b"): 0.5, (1, "q"): 4.0}


def test_seeds_are_repeatable(spark):
    vectors = long_vectors(spark, {i: {"a": 1.0} for i in range(30)})
    a, b = (sorted(clustering.seeds(vectors, 5, s).collect()) for s in (1, 1))
    assert a == b and len({r.doc_id for r in a}) == 5
    assert a != sorted(clustering.seeds(vectors, 5, 2).collect())


def corpus(spark):
    rng = random.Random(4)
    groups = [[f"{p}{c}" for c in "abcdefgh"] for p in ("red", "blue")]
    rows = [(i, "\n".join(" ".join(rng.choices(groups[i % 2], k=8)) for _ in range(3))) for i in range(24)]
    return spark.createDataFrame(rows, "doc_id long, text string")


def test_vocabulary_is_dense_and_ordered(spark):
    bag = spark.range(5000).select(F.col("id").cast("string").alias("term"))
    rows = topics.vocabulary(bag.repartition(7)).orderBy("idx").collect()
    assert [r.idx for r in rows] == list(range(5000))
    assert [r.term for r in rows] == sorted(str(i) for i in range(5000))


def test_topics_describe_the_whole_vocabulary(spark):
    docs = corpus(spark)
    tf = stats.term_freq(src.terms(src.sentences(docs)))
    model = topics.corpus_topics(tf, k=2, top_n=5, max_iter=5)
    rows = model.terms.collect()
    assert model.vocabulary_size == 16
    assert {(r.topic, r["rank"]) for r in rows} == {(t, r) for t in range(2) for r in range(5)}
    assert {r.term for r in rows} <= {r.term for r in tf.select("term").collect()}
    found = topics.distinct_terms(model.terms)
    assert {r.term for r in found.collect()} == {r.term for r in rows}


def test_phases_write_their_outputs(spark, tmp_path):
    docs = corpus(spark)
    sents = src.sentences(docs)
    terms = src.terms(sents)
    out = str(tmp_path)
    table = spark.createDataFrame(
        [("reda", "noun", 0, 0, "crimson")], "lemma string, pos string, sense int, ordinal int, synonym string"
    )
    words = phases.run_word_statistics(terms, table, out).collect()
    line = src.read_lines(spark, f"{out}/word_count").first()
    assert line.key == "reda" and line.value == f"{words[0].n}. Available syns are: crimson, "
    centres, points = phases.run_clustering(terms, src.n_docs(docs), out, k=2)
    assert points.count() == 24 and {r.cluster for r in points.collect()} <= {0, 1}
    model = phases.topics_of_clusters(docs, points, 3, k=2, top_n=4, max_iter=3)
    counts = phases.run_topics(terms, model.terms.select("term").distinct(), "cluster", out)
    assert counts.count() == model.terms.select("term").distinct().count()
    weights = stats.tfidf(stats.document_shares(docs), src.n_docs(docs))
    scores = ranking_scores(terms, weights)
    paths = phases.run_summaries(scores, sents, model.terms, topics.distinct_terms(model.terms), out)
    assert set(paths) == {"top_rank_doc", "cluster_topics_doc", "corpus_topics_doc"}
    assert all(spark.read.text(p).count() > 0 for p in paths.values())


def ranking_scores(terms, weights):
    from brevia.operators import ranking

    return ranking.sentence_scores(terms, stats.letter_weights(weights))


def test_a_hot_term_or_document_is_split(spark):
    """One term in all documents, one document with most terms: the joins are skew joins."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "0",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "2k",
        "spark.sql.files.maxPartitionBytes": "16k",
        "spark.sql.files.openCostInBytes": "1k",
    }
    before = {key: spark.conf.get(key, None) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        ids = spark.range(30_000).repartition(8)
        hot_term = ids.select("id", F.lit("hot").alias("term"))
        own_term = ids.select("id", F.concat(F.lit("t"), "id").alias("term"))
        hot_doc = ids.select((F.col("id") * 0 - 1).alias("id"), F.concat(F.lit("t"), "id").alias("term"))
        rows = hot_term.unionByName(own_term).unionByName(hot_doc)
        tf = rows.select(F.col("id").alias("doc_id"), "term", F.lit(1).cast("long").alias("n"))
        shares = stats.term_share(tf)
        weights = stats.tfidf(shares, F.lit(30_001))
        for df in (shares, weights):
            df.write.format("noop").mode("overwrite").save()
            df.collect()
            plan = df._jdf.queryExecution().executedPlan().toString()
            assert "skew=true" in plan
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def test_bounds_spare_documents_and_change_nothing(spark):
    rng = random.Random(8)
    centres = [[rng.uniform(-9, 9) for _ in range(6)] for _ in range(4)]
    points = {i: [c + rng.gauss(0, 1.5) for c in centres[i % 4]] for i in range(120)}
    rows = [(i, t, w) for i, v in points.items() for t, w in enumerate(v)]
    vectors = spark.createDataFrame(rows, "doc_id long, term int, w double")
    joined = []
    _, got = clustering.kmeans(vectors, clustering.seeds(vectors, 4), 4, delta=0.0, max_rounds=8, joined=joined)

    def nearest(v, cs):
        return min(range(4), key=lambda j: (round(sum(abs(a - b) for a, b in zip(v, cs[j])), 9), j))

    cs = [points[i] for i in range(4)]
    for _ in range(8):
        own = {i: nearest(v, cs) for i, v in points.items()}
        for j in range(4):
            members = [points[i] for i, c in own.items() if c == j]
            cs[j] = [sum(x) / len(members) for x in zip(*members)] if members else cs[j]
    want = {i: nearest(v, cs) for i, v in points.items()}
    assert {r.doc_id: r.cluster for r in got.collect()} == want
    assert joined[0] == len(rows) and joined[-1] < joined[0] / 2
