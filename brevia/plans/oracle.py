"""ANSI SQL with the same result as a registered query, for a second engine."""

from __future__ import annotations

from brevia.functions.stopwords import default_stop_words

# Spelt out here and not imported, so that a wrong value of the library shows.
TAG = "<[^>]*>"
TOKEN = r"[^ \t\n\r\f]+"
CLEAN_TOKEN = r"[0-9A-Za-z_\v]+"
LETTER_RUN = r"[\p{L}_]+"
NON_LETTER = "[^a-zA-Z]"
PAGE_ELEMENTS = ("title", "script", "style")
CLUSTERS = 5
TOP_SENTENCES = 400
FREQUENT_TERMS = 50
# The second engine's blank class lacks the vertical tab, so both classes are spelt out.
_NON_WORD = r"[^0-9A-Za-z_ \t\n\r\f\v]"


def _stop() -> str:
    return ", ".join(f"'{w}'" for w in default_stop_words())


def _with(*names: str) -> str:
    """The named building blocks and those they read, in order."""
    ctes = _ctes()
    order = list(ctes)
    wanted: set[str] = set()
    todo = list(names)
    while todo:
        name = todo.pop()
        if name not in wanted:
            wanted.add(name)
            todo += [n for n in order if n != name and f" {n} " in f" {ctes[name]} ".replace("\n", " ")]
    parts = [f"{n} AS ({ctes[n]})" for n in order if n in wanted]
    return "WITH " + ",\n".join(parts) + "\n"


def _ctes() -> dict[str, str]:
    stop = _stop()
    clean_list = (
        f"list_filter(regexp_extract_all(regexp_replace(raw, '{TAG}', '', 'g'), "
        f"'{CLEAN_TOKEN}'), lambda t: lower(t) NOT IN ({stop}))"
    )
    return {
        "lines": """SELECT doc_id, (i - 1)::INT AS pos, raw FROM (
            SELECT doc_id, unnest(string_split(text, chr(10))) AS raw,
                   generate_subscripts(string_split(text, chr(10)), 1) AS i FROM documents )""",
        "clean": f"""SELECT doc_id, pos, {clean_list} AS tokens,
            array_to_string({clean_list}, ' ') AS sentence FROM lines """,
        "terms": "SELECT doc_id, pos, unnest(tokens) AS term FROM clean ",
        "counts": "SELECT term, count(*) AS n FROM terms GROUP BY term",
        "tf": "SELECT doc_id, term, count(*) AS n FROM terms GROUP BY doc_id, term",
        "totals": "SELECT doc_id, sum(n)::BIGINT AS doc_total FROM tf GROUP BY doc_id",
        "df": "SELECT term, count(*) AS df FROM tf GROUP BY term",
        "weights": """SELECT doc_id, term, CASE WHEN df = (SELECT count(*) FROM documents)
            THEN n / doc_total::DOUBLE
            ELSE n / doc_total::DOUBLE * log10((SELECT count(*) FROM documents) / df::DOUBLE) END
            AS tfidf FROM tf JOIN totals USING (doc_id) JOIN df USING (term)""",
        "letter_weights": f"""SELECT doc_id, letters AS term, arg_max(tfidf, term) AS tfidf FROM (
            SELECT doc_id, term, tfidf, regexp_replace(term, '{NON_LETTER}', '', 'g') AS letters
            FROM weights ) WHERE letters <> '' GROUP BY doc_id, letters""",
        "scores": """SELECT doc_id, pos, count(*) AS n_tokens,
            sum(coalesce(tfidf, 0.0)) / count(*) AS score
            FROM terms LEFT JOIN letter_weights USING (doc_id, term) GROUP BY doc_id, pos""",
        "best": f"""SELECT DISTINCT round(score, 9) AS score, sentence
            FROM scores JOIN clean USING (doc_id, pos)
            ORDER BY score DESC, sentence DESC LIMIT {TOP_SENTENCES}""",
        "vocab": """SELECT term, row_number() OVER (ORDER BY term) - 1 AS idx FROM df """,
        "frequent": f"SELECT term FROM df ORDER BY df DESC, term LIMIT {FREQUENT_TERMS}",
        "lexicon": f"""SELECT DISTINCT CASE role WHEN 'user' THEN 'noun'
            WHEN 'assistant' THEN 'verb' WHEN 'system' THEN 'adverb' END AS pos, synonym,
            lower(synonym) AS lemma, (synonym = lower(synonym))::INT AS sense FROM (
            SELECT role, unnest(regexp_extract_all(text, '{CLEAN_TOKEN}')) AS synonym
            FROM conversations WHERE role IN ('user', 'assistant', 'system') )
            WHERE lower(synonym) NOT IN ({stop}) """,
        "known": """SELECT term, n FROM counts WHERE lower(term) IN (SELECT lemma FROM lexicon )
            ORDER BY n DESC, term LIMIT 15""",
        "hits": """SELECT term, n, sense, synonym,
            CASE pos WHEN 'noun' THEN 0 WHEN 'verb' THEN 1 WHEN 'adverb' THEN 2 END AS pos_rank FROM known JOIN lexicon ON lemma = lower(term)""",
        "grams": """SELECT doc_id, pos, list_distinct(list_transform(
            range(1, length(sentence) - 1), lambda i: sentence[i:i+2])) AS grams FROM clean """,
        "seeds": f"""SELECT row_number() OVER (ORDER BY doc_id) - 1 AS cluster, doc_id FROM (
            SELECT DISTINCT doc_id FROM vectors ORDER BY doc_id LIMIT {CLUSTERS})""",
        "centres": "SELECT cluster, term, w FROM vectors JOIN seeds USING (doc_id)",
        "norms": "SELECT doc_id, sum(abs(w)) AS norm FROM vectors GROUP BY doc_id",
        "centre_norms": "SELECT cluster, sum(abs(w)) AS centre_norm FROM centres GROUP BY cluster",
        "common": """SELECT v.doc_id, c.cluster, sum(abs(v.w - c.w) - abs(v.w) - abs(c.w)) AS gap
            FROM vectors v JOIN centres c ON v.term = c.term GROUP BY v.doc_id, c.cluster""",
        "distances": """SELECT doc_id, cluster,
            round(norm + centre_norm + coalesce(gap, 0.0), 9) AS distance
            FROM norms CROSS JOIN centre_norms LEFT JOIN common USING (doc_id, cluster)""",
        "assigned": """SELECT doc_id, cluster::INT AS cluster, distance FROM distances
            QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY distance, cluster) = 1""",
        "means": """SELECT cluster, term, round(sum(w) / any_value(size), 9) AS w FROM vectors
            JOIN assigned USING (doc_id)
            JOIN (SELECT cluster, count(*) AS size FROM assigned GROUP BY cluster) USING (cluster)
            GROUP BY cluster, term""",
        "reps": """SELECT cluster, 1::INT AS rank, doc_id, distance FROM assigned
            QUALIFY row_number() OVER (PARTITION BY cluster ORDER BY distance, doc_id) = 1""",
    }


_SPARSE = "vectors AS (SELECT doc_id, term, tfidf AS w FROM weights),\n"
_DENSE = """vectors AS (SELECT vec_id AS doc_id, unnest(embedding)::DOUBLE AS w,
    (generate_subscripts(embedding, 1) - 1)::INT AS term FROM embeddings),\n"""
_CLUSTER = ("seeds", "centres", "norms", "centre_norms", "common", "distances", "assigned")


def _clustered(vectors: str, tail: str, *extra: str) -> str:
    ctes = _ctes()
    names = [*_CLUSTER, *extra]
    head = _with("weights").rstrip("\n") + ",\n" if vectors is _SPARSE else "WITH "
    return head + vectors + ",\n".join(f"{n} AS ({ctes[n]})" for n in names) + "\n" + tail


def _rounds(n: int) -> str:
    """Assignment after ``n`` rounds, each a group of subqueries with its number."""
    ctes = _ctes()
    parts = [f"seeds AS ({ctes['seeds']})", f"norms AS ({ctes['norms']})", f"centres0 AS ({ctes['centres']})"]
    for r in range(n + 1):
        parts += [
            f"""centre_norms{r} AS (SELECT cluster, sum(abs(w)) AS centre_norm
                FROM centres{r} GROUP BY cluster)""",
            f"""common{r} AS (SELECT v.doc_id, c.cluster, sum(abs(v.w - c.w) - abs(v.w) - abs(c.w)) AS gap
                FROM vectors v JOIN centres{r} c ON v.term = c.term GROUP BY v.doc_id, c.cluster)""",
            f"""assigned{r} AS MATERIALIZED (SELECT doc_id, cluster::INT AS cluster,
                round(norm + centre_norm + coalesce(gap, 0.0), 9) AS distance
                FROM norms CROSS JOIN centre_norms{r} LEFT JOIN common{r} USING (doc_id, cluster)
                QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY distance, cluster) = 1)""",
            f"""centres{r + 1} AS MATERIALIZED (SELECT cluster, term, sum(w) / any_value(size) AS w
                FROM vectors JOIN assigned{r} USING (doc_id)
                JOIN (SELECT cluster, count(*) AS size FROM assigned{r} GROUP BY cluster) USING (cluster)
                GROUP BY cluster, term
                UNION ALL SELECT cluster, term, w FROM centres{r}
                WHERE cluster NOT IN (SELECT cluster FROM assigned{r}))""",
        ]
    head = _with("weights").rstrip("\n") + ",\n" + _SPARSE
    return head + ",\n".join(parts) + f"\nSELECT doc_id, cluster, distance FROM assigned{n}"


def _cvb0(bag: str, k: int, alpha: float, beta: float, rounds: int, seed: int = 0) -> str:
    """Subqueries of a topic model: cells g, counts t and d, totals a and likelihood l of each round."""
    hexes = f"substr(md5(concat_ws(' ', '{seed}', doc_id, term, j // 4)), 8 * (j % 4)::INT + 1, 8)"
    parts = [
        f"""draws AS (SELECT doc_id, term, n, j::INT AS topic, ('0x' || {hexes})::BIGINT + 1.0::DOUBLE AS x
            FROM {bag}, range({k}) r(j))""",
        """g0 AS MATERIALIZED (SELECT doc_id, term, n, topic, x / sum(x) OVER (PARTITION BY doc_id, term) AS g
            FROM draws)""",
    ]
    for r in range(rounds + 1):
        parts += [
            f"t{r} AS MATERIALIZED (SELECT term, topic, sum(n * g) AS t FROM g{r} GROUP BY term, topic)",
            f"""d{r} AS MATERIALIZED (SELECT doc_id, topic, sum(n * g) AS d,
                sum(sum(n * g)) OVER (PARTITION BY doc_id) AS length FROM g{r} GROUP BY doc_id, topic)""",
            f"""a{r} AS MATERIALIZED (SELECT topic, sum(t) AS a, count(*) * {beta} AS spread
                FROM t{r} GROUP BY topic)""",
        ]
        if r < rounds:
            parts += [
                f"""x{r} AS MATERIALIZED (SELECT doc_id, term, n, topic,
                    (t - g + {beta}) * (d - g + {alpha}) / (a - g + spread) AS x,
                    (t + {beta}) / (a + spread) * (d + {alpha}) / (length + {k * alpha}) AS p
                    FROM g{r} JOIN t{r} USING (term, topic) JOIN d{r} USING (doc_id, topic) JOIN a{r} USING (topic))""",
                f"""l{r} AS (SELECT {r}::INT AS round, round(sum(n * ln(p)) / sum(n), 6) AS likelihood FROM (
                    SELECT n, sum(p) AS p FROM x{r} GROUP BY doc_id, term, n))""",
                f"""g{r + 1} AS MATERIALIZED (SELECT doc_id, term, n, topic,
                    x / sum(x) OVER (PARTITION BY doc_id, term) AS g FROM x{r})""",
            ]
    return ",\n".join(parts)


def _topic_terms(rounds: int, beta: float, top_n: int) -> str:
    return f"""topic_terms AS MATERIALIZED (SELECT topic, (row_number() OVER (
        PARTITION BY topic ORDER BY weight DESC, term) - 1)::INT AS rank, term, weight FROM (
        SELECT topic, term, round((t + {beta}) / (a + spread), 9) AS weight
        FROM t{rounds} JOIN a{rounds} USING (topic))
        QUALIFY row_number() OVER (PARTITION BY topic ORDER BY weight DESC, term) <= {top_n})"""


def _letter_set() -> str:
    """The distinct letter terms of ``topic_terms``."""
    return f"""topic_set AS MATERIALIZED (SELECT DISTINCT w AS term FROM (SELECT unnest(regexp_extract_all(
        regexp_replace(term, '{NON_LETTER}', ' ', 'g'), '{TOKEN}')) AS w FROM topic_terms)
        WHERE lower(w) NOT IN ({_stop()}))"""


def _corpus_model(rounds: int) -> str:
    """The building blocks up to the corpus model, without a tail."""
    bag = "bag AS MATERIALIZED (SELECT doc_id, lower(term) AS term, sum(n)::BIGINT AS n FROM tf GROUP BY ALL)"
    model = _cvb0("bag", 4, 0.5, 0.01, rounds)
    return ",\n".join([_with("clean", "counts", "tf").rstrip("\n"), bag, model, _topic_terms(rounds, 0.01, 50), _letter_set()])


def _cluster_model(letters: str, rounds: int) -> str:
    """The building blocks up to the model of representative documents, without a tail."""
    clusters = _rounds(3).rsplit("\nSELECT ", 1)[0]
    clusters = clusters.replace(_with("weights").rstrip("\n"), _with("weights", "clean", "counts").rstrip("\n"))
    reps = """reps AS (SELECT doc_id FROM assigned3
        QUALIFY row_number() OVER (PARTITION BY cluster ORDER BY distance, doc_id) <= 5)"""
    bag = f"""bag AS MATERIALIZED (SELECT doc_id, term, count(*) AS n FROM (
        SELECT doc_id, lower(unnest(regexp_extract_all(regexp_replace(text, '{letters}', '', 'g'), '{LETTER_RUN}')))
        AS term FROM documents SEMI JOIN reps USING (doc_id))
        WHERE term NOT IN ({_stop()}) GROUP BY doc_id, term)"""
    model = _cvb0("bag", 50, 1.0, 0.01, rounds, seed=5)
    return ",\n".join([clusters, reps, bag, model, _topic_terms(rounds, 0.01, 15), _letter_set()])


def _digamma(x: str) -> str:
    y = f"({x} + 6.0::DOUBLE)"
    z = f"(1 / ({y} * {y}))"
    steps = " - ".join(f"1 / ({x} + {i}.0::DOUBLE)" for i in range(6))
    return f"(ln({y}) - 0.5 / {y} - {z} * (1 / 12.0::DOUBLE - {z} * (1 / 120.0::DOUBLE - {z} / 252.0::DOUBLE)) - {steps})"


def oracle_sql() -> dict[str, str]:
    stop = _stop()
    elements = "|".join([*(f"<{e}>.*?</{e}>" for e in PAGE_ELEMENTS), "<[^>]+>"])
    bare = "<name>.*?</name>|<AustLII>.*?</AustLII>"
    letters = f"<catchphrase [^>]*>.*?</catchphrase>|{bare}|<[^>]+>"
    round9 = "round({0}, 9) AS {0}"
    return {
        "tagged_records": """SELECT page_id AS doc_id, (i - 1)::INT AS pos, raw FROM (
            SELECT page_id, unnest(regexp_extract_all(html, '(?s)<p>.*?</p>')) AS raw,
                   generate_subscripts(regexp_extract_all(html, '(?s)<p>.*?</p>'), 1) AS i
            FROM pages)""",
        "corpus_size": "SELECT count(*) AS n_docs FROM documents",
        "text_sink_round_trip": _with("counts") + "SELECT term, n FROM counts",
        "overwrite_round_trip": _with("counts") + "SELECT term, n FROM counts",
        "line_sink_round_trip": _with("clean")
        + "SELECT DISTINCT sentence FROM clean WHERE sentence <> ''",
        "vector_sink_round_trip": _with("weights")
        + "SELECT doc_id, count(*) AS entries, round(sum(tfidf), 6) AS total "
        "FROM weights GROUP BY doc_id",
        "tagged_file_round_trip": """SELECT raw, count(*) AS n FROM (
            SELECT unnest(regexp_extract_all(html, '(?s)<p>.*?</p>')) AS raw FROM pages) GROUP BY raw""",
        "document_file_round_trip": "SELECT doc_id, coalesce(text, '') AS text FROM documents",
        "strip_tags": f"SELECT page_id, regexp_replace(html, '{TAG}', '', 'g') AS stripped FROM pages",
        "punct_to_space": _with("lines")
        + f"SELECT doc_id, pos, regexp_replace(raw, '{_NON_WORD}', ' ', 'g') AS words FROM lines",
        "tokens": _with("lines")
        + f"SELECT doc_id, pos, unnest(regexp_extract_all(regexp_replace(regexp_replace(raw, "
        f"'{TAG}', '', 'g'), '{_NON_WORD}', ' ', 'g'), '{TOKEN}')) AS token FROM lines",
        "remove_stop_words": _with("terms") + "SELECT doc_id, pos, term FROM terms",
        "clean_sentences": _with("clean") + "SELECT doc_id, pos, sentence FROM clean",
        "drop_elements": f"SELECT page_id, regexp_replace(html, '{elements}', '', 'g') AS dropped FROM pages",
        "letter_tokens": f"""SELECT doc_id, term, count(*) AS n FROM (
            SELECT doc_id, lower(unnest(regexp_extract_all(
                regexp_replace(text, '{letters}', '', 'g'), '{LETTER_RUN}'))) AS term FROM documents)
            WHERE term NOT IN ({stop}) GROUP BY doc_id, term""",
        "distinct_letter_terms": _with("lines")
        + f"""SELECT DISTINCT doc_id, pos, term FROM (SELECT doc_id, pos, unnest(regexp_extract_all(
            regexp_replace(raw, '{NON_LETTER}', ' ', 'g'), '{TOKEN}')) AS term FROM lines)
            WHERE lower(term) NOT IN ({stop})""",
        "char_shingles": _with("grams")
        + "SELECT shingle, count(*) AS n_sentences FROM "
        "(SELECT unnest(grams) AS shingle FROM grams) GROUP BY shingle",
        "jaccard_pairs": _with("grams")
        + """SELECT doc_id, pos, round(j, 9) AS similarity, m > 0 AND n > 0 AND j >= 0.8 AS is_similar
            FROM (SELECT a.doc_id, a.pos, len(a.grams) AS m, len(b.grams) AS n,
                len(list_intersect(a.grams, b.grams)) /
                (len(a.grams) + len(b.grams) - len(list_intersect(a.grams, b.grams)))::DOUBLE AS j
                FROM grams a JOIN grams b ON a.doc_id = b.doc_id AND a.pos + 1 = b.pos
                WHERE len(a.grams) + len(b.grams) > 0)""",
        "word_count": _with("counts") + "SELECT term, n FROM counts",
        "top_words": _with("counts") + "SELECT term, n FROM counts ORDER BY n DESC, term LIMIT 15",
        "term_freq": _with("tf") + "SELECT doc_id, term, n FROM tf",
        "term_share": _with("tf", "totals")
        + "SELECT doc_id, term, n, doc_total FROM tf JOIN totals USING (doc_id)",
        "doc_freq": _with("df") + "SELECT term, df FROM df",
        "tfidf": _with("weights") + f"SELECT doc_id, term, {round9.format('tfidf')} FROM weights",
        "term_weights_letters_only": _with("letter_weights")
        + f"SELECT doc_id, term, {round9.format('tfidf')} FROM letter_weights",
        "doc_vectors_aligned": _with("weights", "vocab")
        + "SELECT doc_id, idx, round(tfidf, 9) AS w FROM weights JOIN vocab USING (term)",
        "doc_vectors_positional": _with("weights")
        + "SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY term) - 1 AS slot, "
        "floor(tfidf * 100.0::DOUBLE + 0.5::DOUBLE) / 100.0::DOUBLE AS w FROM weights",
        "top_dictionary_words": _with("known") + "SELECT term, n FROM known",
        "top_word_synonyms": _with("hits")
        + """SELECT term, n, string_agg(synonym, ', ' ORDER BY sense, synonym) AS synonyms FROM (
            SELECT *, min(pos_rank) OVER (PARTITION BY term) AS first FROM hits)
            WHERE pos_rank = first GROUP BY term, n""",
        "sentence_scores": _with("scores")
        + f"SELECT doc_id, pos, n_tokens, {round9.format('score')} FROM scores",
        "top_sentences": _with("best") + "SELECT score, sentence FROM best",
        "distinct_sentences": _with("clean")
        + "SELECT DISTINCT sentence FROM clean WHERE sentence <> ''",
        "near_dup_sentences": _near_dup("SELECT DISTINCT sentence FROM clean WHERE sentence <> ''")
        + "SELECT sentence FROM profiled WHERE sentence NOT IN (SELECT sentence FROM dropped)",
        "topic_term_counts": _with("counts", "frequent")
        + "SELECT term, n FROM counts WHERE term IN (SELECT term FROM frequent)",
        "topic_sentences": _with("terms", "frequent")
        + """SELECT doc_id, pos, sentence FROM clean SEMI JOIN
            (SELECT doc_id, pos FROM terms SEMI JOIN frequent USING (term)) USING (doc_id, pos)""",
        "summary_topics_frequent": _near_dup(
            """SELECT DISTINCT sentence FROM clean SEMI JOIN
            (SELECT doc_id, pos FROM terms SEMI JOIN frequent USING (term)) USING (doc_id, pos)""",
            "terms",
            "frequent",
        )
        + "SELECT sentence FROM profiled WHERE sentence NOT IN (SELECT sentence FROM dropped)",
        "lda_corpus_shape": _with("counts").rstrip("\n")
        + """, words AS (SELECT least(50, count(DISTINCT lower(term))) AS n FROM counts)
            SELECT t::INT AS topic, n AS n_terms, n AS n_ranks, 0::BIGINT AS n_unknown
            FROM words, range(4) r(t)""",
        "summary_top_rank": _with("best").rstrip("\n")
        + """, grams AS (SELECT sentence, list_distinct(list_transform(
            range(1, length(sentence) - 1), lambda i: sentence[i:i+2])) AS g FROM best),
            shared AS (SELECT a.sentence, len(a.g) + len(b.g) AS m,
                len(list_intersect(a.g, b.g)) AS s FROM grams a JOIN grams b
                ON b.sentence > a.sentence
                AND 10 * least(len(a.g), len(b.g)) >= 8 * greatest(len(a.g), len(b.g)))
            SELECT score, sentence FROM best WHERE sentence NOT IN (
                SELECT sentence FROM shared WHERE s > 0 AND s >= 0.8 * (m - s))""",
        "lda_cvb0_step": _corpus_model(1) + "\nSELECT term, topic, round(t, 6) AS n FROM t1",
        "lda_cvb0_rounds": _corpus_model(3) + "\nSELECT term, topic, round(t, 6) AS n FROM t3",
        "lda_likelihood_rounds": _corpus_model(3)
        + "\nSELECT * FROM l0 UNION ALL SELECT * FROM l1 UNION ALL SELECT * FROM l2",
        "lda_prior_update": _corpus_model(0)
        + f"""\nSELECT topic, round(0.5::DOUBLE * sum({_digamma("(d + 0.5::DOUBLE)")} - {_digamma("0.5::DOUBLE")})
            / sum({_digamma("(length + 2.0::DOUBLE)")} - {_digamma("2.0::DOUBLE")}), 6) AS alpha
            FROM d0 GROUP BY topic""",
        "lda_topic_terms": _corpus_model(3) + "\nSELECT topic, rank, term, weight FROM topic_terms",
        "lda_cluster_terms": _cluster_model(letters, 3) + "\nSELECT topic, rank, term, weight FROM topic_terms",
        "lda_corpus_terms": _corpus_model(3) + "\nSELECT term FROM topic_set",
        "topic_term_counts_lda": _corpus_model(3)
        + "\nSELECT term, n FROM counts WHERE term IN (SELECT term FROM topic_set)",
        "topic_term_counts_cluster": _cluster_model(letters, 3)
        + "\nSELECT term, n FROM counts WHERE term IN (SELECT term FROM topic_set)",
        "summary_topics_corpus": _near_dup_of(
            _corpus_model(3),
            """SELECT DISTINCT sentence FROM clean SEMI JOIN (SELECT doc_id, pos FROM (
            SELECT doc_id, pos, unnest(tokens) AS term FROM clean) SEMI JOIN topic_set USING (term))
            USING (doc_id, pos) WHERE sentence <> ''""",
        ),
        "summary_topics_cluster": _near_dup_of(
            _cluster_model(letters, 3),
            """SELECT DISTINCT sentence FROM clean SEMI JOIN (SELECT doc_id, pos FROM (
            SELECT doc_id, pos, unnest(tokens) AS term FROM clean) SEMI JOIN topic_terms USING (term))
            USING (doc_id, pos) WHERE sentence <> ''""",
        ),
        "cluster_seeds": _with("weights").rstrip("\n")
        + ",\n"
        + _SPARSE
        + f"seeds AS ({_ctes()['seeds']})\nSELECT cluster::INT AS cluster, doc_id FROM seeds",
        "kmeans_l1_assign": _clustered(_SPARSE, "SELECT * FROM assigned"),
        "kmeans_l1_update": _clustered(
            _SPARSE, "SELECT cluster, term, w FROM means", "means"
        ),
        "kmeans_l1_dense_assign": _clustered(_DENSE, "SELECT * FROM assigned"),
        "kmeans_l1_dense_update": _clustered(
            _DENSE, "SELECT cluster, term AS idx, w FROM means", "means"
        ),
        "kmeans_l1_rounds": _rounds(3),
        "clustering_run": _rounds(3),
        "cluster_seed_representatives": _clustered(
            _SPARSE,
            "SELECT seeds.cluster::INT AS cluster, 1::INT AS rank, doc_id, distance "
            "FROM seeds JOIN assigned USING (doc_id)",
        ),
        "cluster_representatives": _clustered(_SPARSE, "SELECT * FROM reps", "reps"),
        "representative_docs": _clustered(
            _SPARSE, "SELECT doc_id, text FROM documents SEMI JOIN reps USING (doc_id)", "reps"
        ),
    }


def _near_dup(source: str, *names: str) -> str:
    """Exact pass over all sentences: similar pairs share 12 of their rarest shingles.

    With shingles ranked rarest first, sets with Jaccard >= 0.8 share at least 12 of
    their first ``m - ceil(0.8 m) + 12`` ones, or all they must share if that is less.
    """
    return _near_dup_of(_with("clean", *names).rstrip("\n"), source, "")


def _near_dup_of(
    head: str,
    source: str,
    tail: str = "SELECT sentence FROM profiled WHERE sentence NOT IN (SELECT sentence FROM dropped)",
) -> str:
    return (
        head
        + f""",
        distinct_sentences AS ({source}),
        profiled AS (SELECT row_number() OVER (ORDER BY sentence) AS id, sentence,
            list_distinct(list_transform(range(1, length(sentence) - 1),
                lambda i: sentence[i:i+2])) AS g FROM distinct_sentences),
        cells AS (SELECT id, len(g) AS m, unnest(g) AS shingle FROM profiled),
        ranked AS (SELECT id, m, shingle, row_number() OVER (PARTITION BY id ORDER BY f, shingle) AS r
            FROM cells JOIN (SELECT shingle, count(*) AS f FROM cells GROUP BY shingle) USING (shingle)),
        prefix AS (SELECT id, m, shingle FROM ranked WHERE r <= m - ceil(m * 8 / 10.0) + 12),
        pairs AS (SELECT a.id AS a, b.id AS b FROM prefix a JOIN prefix b
            ON a.shingle = b.shingle AND a.id < b.id
            AND 10 * least(a.m, b.m) >= 8 * greatest(a.m, b.m)
            GROUP BY a.id, b.id
            HAVING count(*) >= least(12, ceil(any_value(greatest(a.m, b.m)) * 8 / 10.0))),
        shared AS (SELECT x.sentence, len(x.g) + len(y.g) AS m, len(list_intersect(x.g, y.g)) AS s
            FROM pairs JOIN profiled x ON x.id = a JOIN profiled y ON y.id = b),
        dropped AS (SELECT DISTINCT sentence FROM shared WHERE s >= 0.8 * (m - s))
        {tail}"""
    )
