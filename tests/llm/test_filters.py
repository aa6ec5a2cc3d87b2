"""URL filters, decontamination and the quality classifier."""

import collections
import math
import random
import re
import string

import numpy as np
import pytest

from brevia.llm import decontaminate, kn_quality, url_filters

URLS = [
    (1, "http://WWW.Example.com/en/x?y#z", "www.example.com", "/en/x", "www.example.com/en/", "allow"),
    (2, "https://a.example.com/en/", "a.example.com", "/en/", "example.com/en/", "block"),
    (3, "https://a.example.com/fr", "a.example.com", "/fr", "com/", "allow"),
    (4, "http://x.net/es/1", "x.net", "/es/1", "net/es/", "block"),
    (5, "http://x.com", "x.com", "", None, None),
    (6, "http://xexample.com?en/", "xexample.com", "", None, None),
    (7, None, "", "", None, None),
    (8, "no scheme", "", "", None, None),
    (9, "a://b://c/d", "b:", "//c/d", None, None),
    (9, "a://É.ORG/Ü", "É.org", "/Ü", None, None),
    (None, "://com/", "com", "/", "com/", "allow"),
]
LABELS = "doc_id bigint, quality int, toxic int, host string, n int"


def test_url_rules_and_parts(spark):
    pages = spark.createDataFrame([(i, u, "x") for i, u, *_ in URLS], "page_id bigint, url string, host string")
    labels = spark.createDataFrame([(1, 1, 0, "x", 1), (4, 0, 0, "x", 1), (None, 1, 0, "x", 1), (5, None, 0, "x", 1)], LABELS)
    found = url_filters.filter_urls(pages.drop("host"), labels).collect()
    got = sorted((str(r.page_id), r.host, r.path, str(r.rule)) for r in found)
    assert got == sorted((str(i), h, p, str(r)) for i, _, h, p, r, _ in URLS)
    verdicts = {(r.page_id, r.host): r.verdict for r in found}
    assert all(verdicts[i, h] == v for i, _, h, _, _, v in URLS if v)
    assert set(verdicts.values()) <= {"allow", "block"}


def test_url_reputation_orders_hosts(spark):
    pages = [(k, f"http://{'good' if k % 2 else 'bad'}.site.org/{k}") for k in range(80)]
    pages.append((900, "http://new.other.org/"))
    pages = spark.createDataFrame(pages, "page_id bigint, url string")
    labels = spark.createDataFrame([(k, k % 2, 0, "x", 1) for k in range(80)], LABELS)
    lower = {r.host: (r.lower, r.verdict) for r in url_filters.filter_urls(pages, labels).collect()}
    assert lower["bad.site.org"][0] < lower["new.other.org"][0] < lower["good.site.org"][0]
    assert lower["bad.site.org"][1] == "block" and lower["good.site.org"][1] == "allow"


def test_url_empty_tables(spark):
    none = spark.createDataFrame([], LABELS)
    pages = spark.createDataFrame([(1, "http://a.org/")], "page_id bigint, url string")
    assert url_filters.filter_urls(pages, none).count() == 1
    assert url_filters.filter_urls(pages.limit(0), none).count() == 0


def benchmark_case(seed=4, n_items=30):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(rng.choice((1, 2, 5, 6))))
    items = [
        (k, " ".join(word() for _ in range(rng.randint(8, 40))) + ". " + " ".join(word() for _ in range(6)) + ".")
        for k in range(n_items)
    ]
    items += [(100, None), (101, ""), (102, "single"), (103, items[0][1])]
    docs = [(k, " ".join(word() for _ in range(rng.randint(0, 400)))) for k in range(40)]
    for k in range(20):
        host = docs[k][1].split()
        host[len(host) // 2 : len(host) // 2] = items[k][1].upper().replace(".", "!!").split()
        docs[k] = (k, "\n".join(host))
    return items, docs + [(200, None), (201, ""), (202, "..."), (None, items[3][1]), (0, docs[0][1]), (0, docs[0][1])]


def leaked_by_brute_force(items, docs):
    """(doc_id, item_id) by the rule itself: scores of passages, then n-grams of words as tuples."""

    def words(text):
        return [w for w in (x.strip(string.punctuation).lower() for x in (text or "").split()) if w]

    def grams(ws, n):
        return {tuple(ws[k : k + n]) for k in range(len(ws) - n + 1)}

    def size(ws):
        return min(5, max(1, (len(ws) + 1) // 3))

    tests = []
    for item_id, text in items:
        *question, answer = re.split(r"(?<=[.!?])\s+(?=\S)", (text or "").strip())
        if words(text):
            tests.append((item_id, words(" ".join(question) if question else answer), words(text)))
    texts = [(doc_id, words(text)) for doc_id, text in docs]
    df = collections.Counter(w for _, ws in texts for w in set(ws))
    mean = sum(len(ws) for *_, ws in tests) / len(tests)
    out = set()
    for item_id, question, whole in tests:
        weights = {}
        for w, tf in collections.Counter(whole).items():
            idf = math.log(1 + (len(texts) - df[w] + 0.5) / (df[w] + 0.5))
            weights[w] = idf * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * len(whole) / mean))
        n = 64
        while n < len(whole):
            n *= 2
        for doc_id, ws in texts:
            for s in range(max(1, -(-len(ws) // n) - 1)):
                held = sum(weights.get(w, 0) for w in set(ws[s * n : (s + 2) * n])) / sum(weights.values())
                if abs(held - decontaminate.MIN_SCORE) < 1e-9:
                    raise AssertionError("a tie that rounding decides")
                if held < decontaminate.MIN_SCORE:
                    continue
                near = ws[max(0, s - 1) * n :][: 4 * n]
                share = [len(g & grams(near, size(p))) / len(g) for p in (question, whole) if (g := grams(p, size(p)))]
                if share[1] >= 0.5 or (len(question) >= 5 and share[0] >= 0.5):
                    out.add((doc_id, item_id))
    return out


def edited_case(seed=5):
    """The case above with cut, edited and scattered leaks, and items of several length classes."""
    items, docs = benchmark_case()
    rng = random.Random(seed)
    common = [f"c{k}" for k in range(12)]
    long = [(200 + n, " ".join(rng.choice("pqrst") + str(rng.randint(0, 400)) for _ in range(n)) + ".") for n in (64, 65, 130, 700)]
    items = items + long
    for k in range(60):
        words = rng.choice([t for _, t in items if t]).split()
        cut = words[: len(words) * rng.randint(3, 10) // 10]
        cut = [rng.choice(common) if rng.random() < 0.15 else w for w in cut]
        if k % 4 == 0:
            cut = [x for w in cut for x in (w, *rng.choices(common, k=rng.choice((0, 0, 0, 30))))]
        lead = rng.choices(common, k=rng.randint(0, 300))
        docs.append((300 + k, " ".join(lead + cut + rng.choices(common, k=rng.randint(0, 200)))))
    return items, docs


@pytest.mark.parametrize("case", [benchmark_case, edited_case])
def test_leaks_match_brute_force_bm25(spark, table, case):
    items, docs = case()
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    found = decontaminate.find_leaks(table(docs), bench).collect()
    got = {(r.doc_id, r.item_id) for r in found}
    assert len(got) == len(found)
    assert got == leaked_by_brute_force(items, docs)
    assert {(k, k) for k in range(20)} <= got and (None, 3) in got
    assert not {d for d, _ in got if d is not None and 20 <= d < 300}


def test_leaks_shards_and_empty_tables(spark, table, monkeypatch):
    items, docs = edited_case()
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    rows = lambda bench: sorted(map(tuple, decontaminate.find_leaks(table(docs), bench).collect()), key=str)
    expected = rows(bench)
    monkeypatch.setattr(decontaminate, "SHARD_ITEMS", 20)
    monkeypatch.setattr(decontaminate, "BLOCK", 2)
    assert rows(bench) == expected
    assert decontaminate.find_leaks(table(docs), bench.limit(0)).count() == 0
    assert decontaminate.find_leaks(table([]), bench).count() == 0


def test_other_items_do_not_change_a_leak(spark, table):
    """A scattered item is no hit, whatever longer items the shard holds."""
    item = [f"w{k}" for k in range(30)]
    scattered = " ".join(x for w in item for x in (w, *["noise"] * 33))
    docs = [(1, scattered), (2, " ".join(item))] + [(k, "noise of other texts") for k in range(3, 30)]
    # weights follow the mean length, so both sets of items have the same
    for other in (["x"] * 30, ["x"] * 2000):
        bench = spark.createDataFrame([(1, " ".join(item)), (2, " ".join(other))], "item_id bigint, text string")
        assert {(r.doc_id, r.item_id) for r in decontaminate.find_leaks(table(docs), bench).collect()} == {(2, 1)}


def quality_case(seed=2):
    rng = random.Random(seed)
    words = ["the", "of", "and", "river", "stone", "walks", "under", "light", "old", "house"]
    good = lambda: " ".join(rng.choice(words) for _ in range(60)).capitalize() + "."
    bad = [lambda: "WALKS!! " * 40, lambda: "stone### " * 3 + "qz%%% xv$$$ " * 20, lambda: "zu zu zu zu " * 20]
    rows = [(k, good()) for k in range(200)] + [(1000 + k, bad[k % 3]()) for k in range(30)]
    labels = [(k, 1, 0) for k in range(0, 200, 2)] + [(1000 + k, 0, 0) for k in range(10)]
    return rows + [(5000, None), (5001, ""), (5002, " \n "), (None, good())], labels


def test_quality_held_out(spark, table):
    rows, labels = quality_case()
    labels = spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")
    found = {r.doc_id: r.keep for r in kn_quality.classify(table(rows), labels).collect()}
    assert len(found) == len(rows)
    unseen = [found[k] for k in range(1, 200, 2)]
    assert sum(unseen) >= 95
    assert not any(found[1000 + k] for k in range(30))
    assert found[5000] is found[5001] is found[5002] is False
    kept = kn_quality.keep_good(table(rows), labels)
    assert kept.columns == table(rows).columns
    assert {r.doc_id for r in kept.collect()} == {i for i, k in found.items() if k}


@pytest.mark.parametrize("rows", [[(1, "some words here"), (2, None)], []])
def test_quality_without_trusted_text(spark, table, rows):
    labels = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    assert {r.doc_id: r.keep for r in kn_quality.classify(table(rows), labels).collect()} == {i: t is not None for i, t in rows}


def test_probabilities_sum_to_one(spark, table):
    rows, labels = quality_case()
    import numpy as np

    counts = spark.createDataFrame([("", int(g), int(n)) for g, n in ((5, 3), (700, 1), (701, 2), (9000, 9))], "lang string, gram int, n bigint")
    bits = kn_quality._tables(counts, [""])[""]
    total = (2.0 ** -bits.astype(float)).reshape(-1, kn_quality.SYMBOLS).sum(axis=1)
    assert np.allclose(total, 1, atol=1e-4)


def brute_bits(counts, base):
    """Interpolated modified Kneser-Ney of trigram counts {(a, b, c): n}; ``base`` of unigrams."""

    def order(counts):
        f = [sum(n == k for n in counts.values()) for k in range(5)]
        y = f[1] / (f[1] + 2 * f[2]) if f[1] + 2 * f[2] else None
        d = []
        for k, usual in ((1, 0.5), (2, 1.0), (3, 1.5)):
            found = k - (k + 1) * y * f[k + 1] / f[k] if y is not None and f[k] else usual
            d.append(max(0.1, min(k - 0.1, found)))
        total, back = collections.Counter(), collections.Counter()
        for g, n in counts.items():
            total[g[:-1]] += n
            back[g[:-1]] += d[min(n, 3) - 1]
        share = {g: (n - d[min(n, 3) - 1]) / total[g[:-1]] for g, n in counts.items()}
        return share, {c: back[c] / total[c] for c in total}

    orders = [counts]
    for _ in range(2):
        orders.append(collections.Counter(g[1:] for g in orders[-1]))
    orders = [order(c) for c in reversed(orders)]

    def p(g):
        out = base(g[-1])
        for k, (share, back) in enumerate(orders):
            own = g[2 - k :]
            out = share.get(own, 0.0) + back.get(own[:-1], 1.0) * out
        return out

    return p


@pytest.mark.parametrize("head, partitions", [(1 << 20, 1), (0, 7)])
def test_quality_full_vocabulary_matches_brute_force(spark, monkeypatch, head, partitions):
    """Every word counts, however rare and however rows are dealt."""
    import math

    monkeypatch.setattr(kn_quality, "HEAD", head)
    rng = random.Random(5)
    names = [f"{a}{b}" for a in "abcdefghijkl" for b in "mnopqrstuvwx"]
    text = lambda tag: " ".join(rng.choice(names) + rng.choice(("", "", tag)) for _ in range(12))
    rows = [(k, lang, text(lang)) for k in range(60) for lang in ("en", "fr")]
    rows = [(j, lang, t) for j, (_, lang, t) in enumerate(rows)]
    rows += [(900, "en", "idiot " + rows[0][2]), (901, "xx", rows[0][2]), (None, "en", rows[2][2]), (None, "en", rows[4][2]), (None, "en", rows[4][2])]
    labels = spark.createDataFrame([(k, 1, 0) for k in range(0, 100)], "doc_id bigint, quality int, toxic int")
    docs = spark.createDataFrame(rows, "doc_id bigint, lang string, text string").repartition(partitions)
    scores = kn_quality.score(docs, labels).collect()
    held_out = {r.doc_id for r in scores if r.trusted}
    assert held_out and {r.doc_id for r in scores if r.mixed} == held_out
    grams = {"en": collections.Counter(), "fr": collections.Counter()}
    reader = kn_quality.Reader()
    read = lambda t: list(zip(*[x.tolist() for x in reader.read(t)]))
    for i, lang, t in rows:
        if i is not None and i < 100 and i not in held_out:
            grams[lang].update(read(t))
    every = grams["en"] + grams["fr"]
    symbols = len({g[-1] for g in every}) + 1
    models = {"": brute_bits(every, lambda c: 1 / symbols)}
    # the unigrams of all trusted text are the base of each language
    alone = brute_bits(every, lambda c: 1 / symbols)
    for lang in grams:
        models[lang] = brute_bits(grams[lang], lambda c: alone((-1, -2, c)))
    expected = []
    for i, lang, t in rows:
        found = read(t)
        for model in [lang if lang in grams else ""] + [""] * (i in held_out):
            bits = -sum(math.log2(models[model](g)) for g in found) / len(found)
            expected.append((str(i), model, len(found), round(bits, 5)))
    got = [(str(r.doc_id), r.model, r.n_symbols, round(r.bits, 5)) for r in scores]
    assert [x[:3] for x in sorted(got)] == [x[:3] for x in sorted(expected)]
    assert all(abs(x[3] - y[3]) < 1e-4 for x, y in zip(sorted(got), sorted(expected)))


def test_quality_small_languages(spark):
    """Many languages, most of them small, and one whose only trusted text is held out."""
    rng = random.Random(8)

    def text(lang):
        words = [f"{lang}{k}x" for k in range(12)]
        return " ".join(rng.choice(words) for _ in range(40))

    langs = [f"l{chr(97 + k)}" for k in range(18)]
    rows = [(lang, text(lang)) for lang in langs for _ in range(24)] + [("one", text("one"))] * 3
    rows = [(k, lang, t) for k, (lang, t) in enumerate(rows)]
    rows += [(9000, "la", "idiot pathetic " * 20), (9001, None, rows[0][2]), (9002, "new", "")]
    docs = spark.createDataFrame(rows, "doc_id bigint, lang string, text string")
    labels = [(k, 1, 0) for k, lang, _ in rows if k < 9000 and (k % 24 < 16 or lang == "one")]
    labels = spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")
    found = {r.doc_id: r for r in kn_quality.classify(docs, labels).collect()}
    assert {found[k].lang_model for k, lang, _ in rows if lang in langs} == set(langs)
    assert found[9001].lang_model == ""
    unseen = [found[k].keep for k, lang, _ in rows if lang in langs and k % 24 >= 16 and k < 9000]
    assert sum(unseen) >= 0.95 * len(unseen)
    assert all(found[k].keep for k, lang, _ in rows if lang == "one")
    assert all(r.low is not None and r.high is not None for r in found.values())
    assert not found[9000].keep and not found[9002].keep


def test_quality_counts_do_not_depend_on_slices():
    import pyarrow as pa

    texts = [f"rare word{k} of few texts" for k in range(9)] + ["rare again of few"]

    def counted(size):
        out = collections.Counter()
        rows = pa.record_batch({"m": pa.array([3] * 10, pa.int64()), "text": texts})
        for x in kn_quality._trigrams(iter([rows.slice(k, size) for k in range(0, 10, size)])):
            for r in x.to_pylist():
                out[r["m"], r["a"], r["b"], r["c"]] += r["n"]
        return out

    assert counted(1) == counted(3) == counted(10)
    assert sum(counted(10).values()) == 5 * 9 + 4


def leak_pairs(items, docs):
    parts = [(i, *decontaminate.parts_of(t)) for i, t in items]
    terms = decontaminate.vocabulary(parts)
    ids = [decontaminate.Words(terms).of(t) for t in docs]
    df = {w: sum(k in x for x in ids) for k, w in enumerate(terms)}
    index = decontaminate.Index(parts, df, len(docs), sum(len(q) + len(a) for _, q, a in parts) / len(parts))
    matcher = decontaminate.Matcher(index, decontaminate.MIN_OVERLAP)
    found = matcher.match(np.concatenate(ids), np.cumsum([0, *map(len, ids)]))
    return [{items[k][0] for k, *_ in own} for own in found]


def test_leaks_do_not_depend_on_batches(monkeypatch):
    items, docs = edited_case()
    items, docs = [x for x in items if x[1]], [t or "" for _, t in docs]
    expected = leak_pairs(items, docs)
    assert sum(map(len, expected)) > 30
    for name, value in (("BATCH", 64), ("PIECE", 100), ("KNOWN_WORDS", 3)):
        monkeypatch.setattr(decontaminate, name, value)
        assert leak_pairs(items, docs) == expected


def test_cut_and_edited_leaks():
    item = [f"w{k}" for k in range(40)]
    short = [f"v{k}" for k in range(7)]
    items = [(1, " ".join(item[:34]) + ". " + " ".join(item[34:])), (2, " ".join(short)), (3, "is it. " + " ".join(f"u{k}" for k in range(30)))]
    noise = " noise" * 50
    edited = short[:3] + ["other"] + short[4:]
    docs = [
        " ".join(item[:34]) + noise,  # without the answer
        " ".join(item[:36] + ["x", "y", "z", "q"]) + noise,
        " ".join(edited) + noise,
        " ".join(item[:8]) + noise,  # a fifth of an item
        " ".join(reversed(item)) + noise,
        "is it" + noise,
    ]
    assert leak_pairs(items, docs) == [{1}, {1}, {2}, set(), set(), set()]


def test_leaks_with_any_white_space_and_without_blanks():
    item = [f"w{k}" for k in range(20)]
    han = "".join(chr(0x4E00 + 37 * k) for k in range(40))
    items = [(1, " ".join(item)), (2, han + "。"), (3, "\u30ab\u30bf\u30ab\u30ca" + "".join(chr(0x3041 + 2 * k) for k in range(30)))]
    docs = [
        "noise " * 30 + "\u00a0".join(item[:10]) + "\u2009" + "\u3000".join(item[10:]),
        "".join(chr(0x6000 + k) for k in range(60)) + han + "".join(chr(0x7000 + k) for k in range(60)),
        "noise" + items[2][1] + "noise",
        han[:6] + " noise" * 30,
    ]
    assert leak_pairs(items, docs) == [{1}, {2}, {3}, set()]
