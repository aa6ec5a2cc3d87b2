"""Line dedup, Jaccard join and substring dedup against brute force."""

import collections
import hashlib
import random

import ahocorasick
import pyarrow as pa
import pytest

from brevia.llm import jaccard_join, line_dedup, substring_dedup


def family(seed=5, groups=6, members=7):
    """Texts in groups of copies with more and more changes, shared passages and odd rows."""
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdef") for _ in range(rng.randint(1, 4)))
    passage, out = [word() for _ in range(40)], []
    for _ in range(groups):
        base = [word() for _ in range(rng.randint(30, 120))]
        for m in range(members):
            text = list(base)
            for _ in range(m):
                text[rng.randrange(len(text))] = word()
            if m % 3 == 2:
                text[10:10] = passage
            out.append(" ".join(text) if m % 2 else " ".join(text).upper() if m == 6 else "\n".join(text))
    rng.shuffle(out)
    rows = list(enumerate(out, 10))
    return rows + [
        (1, None), (2, ""), (3, " \t\n"), (4, "two words"), (5, "Two  words"), (6, "a b c d e"), (7, "a b c d e"),
        (8, "w " * 4000), (9, "É é \x0b x"), (900, rows[0][1]), (901, rows[0][1]), (901, rows[0][1]),
    ]


def shingles_of(text, size=5):
    w = (text or "").encode().lower().split()
    return frozenset(tuple(w[k : k + size]) for k in range(max(1, len(w) - size + 1))) if w else frozenset()


def degrees_of(rows, percent):
    """Of every row the number of other sets that its set links with."""
    sets = {shingles_of(t) for _, t in rows}
    linked = lambda a, b: a != b and a & b and 100 * len(a & b) >= percent * len(a | b)
    count = {a: sum(bool(linked(a, b)) for b in sets) for a in sets}
    return sorted((i, count[shingles_of(t)]) for i, t in rows)


def components_of(rows, percent):
    sets = {i: shingles_of(t) for i, t in rows}
    parent = {i: i for i in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for a in ids:
        for b in ids:
            both = len(sets[a] & sets[b])
            if a < b and both and 100 * both >= percent * len(sets[a] | sets[b]):
                x, y = sorted((root(a), root(b)))
                parent[y] = x
    return sorted((i, len(sets[i]), root(i)) for i, _ in rows)


@pytest.mark.parametrize("percent, tile", [(50, 256), (80, 256), (80, 2), (100, 256)])
def test_jaccard_components_and_degrees(table, monkeypatch, percent, tile):
    monkeypatch.setattr(jaccard_join, "TILE", tile)
    monkeypatch.setattr(jaccard_join, "BLOCK", tile)
    monkeypatch.setattr(jaccard_join, "SHORT", 1 if tile == 2 else 16)
    rows = family() + list(enumerate(one_group(), 2000))
    found = jaccard_join.JaccardJoin(table(rows), percent=percent).membership()
    got = sorted(tuple(r) for r in found.select("doc_id", "n_shingles", "component_id", "n_links").collect())
    expected = [(*x, n) for x, (_, n) in zip(components_of(rows, percent), degrees_of(rows, percent))]
    assert got == expected


def test_jaccard_sets_are_sent_in_rounds(table, monkeypatch):
    """Rounds give what one gives, each pair of tiles counted in one, and their sets are dropped behind them."""
    monkeypatch.setattr(jaccard_join, "TILE", 2)
    monkeypatch.setattr(jaccard_join, "BLOCK", 2)
    monkeypatch.setattr(jaccard_join, "SHORT", 1)
    monkeypatch.setattr(jaccard_join, "ROUND_BYTES", 1)
    names, gone = {}, []
    write, drop = jaccard_join.materialise, jaccard_join.discard
    monkeypatch.setattr(jaccard_join, "materialise", lambda df, name: names.setdefault(id(out := write(df, name)), (name, out))[1])
    monkeypatch.setattr(jaccard_join, "discard", lambda *dfs: gone.append({names.get(id(x), ("",))[0] for x in dfs}) or drop(*dfs))
    rows = family() + list(enumerate(one_group(), 2000))
    found = jaccard_join.JaccardJoin(table(rows)).membership()
    got = sorted(tuple(r) for r in found.select("doc_id", "n_shingles", "component_id", "n_links").collect())
    assert got == [(*x, n) for x, (_, n) in zip(components_of(rows, 80), degrees_of(rows, 80))]
    written = [name for name, _ in names.values()]
    assert written.count("counted") == jaccard_join.ROUNDS
    # the index and the lists are gone before sets are sent
    assert {"indexed", "lists", "star-pairs"} <= set().union(*gone[: [i for i, x in enumerate(gone) if "filled" in x][0]])


def one_group(seed=9, members=40):
    """Copies of a text at distances around the threshold, from the text and from each other."""
    rng = random.Random(seed)
    base = [f"w{rng.randrange(500)}" for _ in range(150)]
    out = []
    for m in range(members):
        text = list(base)
        for _ in range(m % 9):
            text[rng.randrange(len(text))] = f"x{rng.randrange(9)}"
        out.append(" ".join(text[: len(text) - m % 5]))
    return out


def test_repeated_ids_join_the_components_of_their_texts(table):
    a, b = (" ".join(f"{x}{k}" for k in range(40)) for x in "ab")
    rows = [(1, a), (1, b), (2, a + " more"), (3, b + " more"), (4, "other words than these five")]
    for order in (rows, rows[::-1]):
        found = jaccard_join.JaccardJoin(table(order)).membership().select("doc_id", "component_id", "n_links")
        assert sorted(map(tuple, found.collect())) == [(1, 1, 1), (1, 1, 1), (2, 1, 1), (3, 1, 1), (4, 4, 0)]


def test_overlaps_in_strips(monkeypatch):
    import numpy as np

    monkeypatch.setattr(jaccard_join, "STRIP", 7)
    rng = np.random.default_rng(4)
    x, y = ([np.unique(np.append(rng.integers(0, 60, 30), [70, 71])).astype(np.uint64) for _ in range(k)] for k in (4, 5))
    expected = [[len(np.intersect1d(a, b)) for b in y] for a in x]
    flat = [f for side in (x, y) for f in (np.concatenate(side), np.array(list(map(len, side))))]
    assert jaccard_join.overlaps(*flat).tolist() == expected


def test_jaccard_null_ids_and_empty_table(table):
    rows = [(None, "a b c d e f"), (1, "a b c d e f"), (2, "a b c d e f")]
    found = jaccard_join.JaccardJoin(table(rows)).membership().select("doc_id", "component_id")
    assert sorted(map(tuple, found.collect()), key=str) == [(1, 1), (2, 1), (None, None)]
    assert jaccard_join.JaccardJoin(table([])).membership().count() == 0


def test_parity_never_exceeds_the_difference():
    import numpy as np

    rng = np.random.default_rng(2)
    for n, m, both in ((10, 12, 9), (300, 700, 200), (5, 2000, 5)):
        items = rng.integers(0, 2**63, n + m - both).astype(np.uint64)
        x, y = items[:n], items[n - both :]
        apart = jaccard_join.parity_distance(jaccard_join.parity(x).tobytes(), jaccard_join.parity(y).tobytes())
        assert apart <= n + m - 2 * both


def repeats_of(rows, window):
    first = {}
    for i, t in rows:
        w = (t or "").encode().split()
        for k in range(len(w) - window + 1):
            g = tuple(w[k : k + window])
            first[g] = min(first.get(g, i), i)
    out = []
    for i, t in rows:
        w = (t or "").encode().split()
        keep = [True] * len(w)
        for k in range(len(w) - window + 1):
            if first[tuple(w[k : k + window])] < i:
                keep[k : k + window] = [False] * window
        kept = b" ".join(x for x, y in zip(w, keep) if y)
        out.append((i, len(w), keep.count(False), hashlib.sha256(kept).hexdigest()))
    return sorted(out)


@pytest.mark.parametrize("rows", [family(), []])
def test_repeated_passages(table, monkeypatch, rows):
    monkeypatch.setattr(substring_dedup, "SHARD_PATTERNS", 50)  # many shards
    got = sorted(tuple(r) for r in substring_dedup.remove_repeats(table(rows)).collect())
    assert got == repeats_of(rows, 13)


def test_words_and_hashes_of_a_slice():
    texts = [" a\tbb  \u00a0c\r\n", None, "", "bb a " * 30, "\x0b\x0c", "x" * 5000 + " \u65e5\u672c ab ba a"]
    rows = pa.record_batch({"text": pa.array(texts, pa.string())})
    own = substring_dedup.Slice(rows, 13, 5)
    words = [w for t in texts for w in (t or "").encode().split()]
    assert [own.data[a:b] for a, b in zip(own.begin, own.end)] == words
    assert own.sizes.tolist() == [len((t or "").encode().split()) for t in texts]
    assert len(set(zip(words, own.hashes.tolist()))) == len(set(words)) == len(set(own.hashes.tolist()))


def test_shards_stream_words_not_characters(monkeypatch):
    automata, streamed = ahocorasick.Automaton, []

    class Spy:
        def __init__(self, *kind):
            self.own = automata(*kind)

        def __len__(self):
            return len(self.own)

        def __getattr__(self, name):
            return getattr(self.own, name)

        def iter(self, letters):
            streamed.append(len(letters))
            return self.own.iter(letters)

    monkeypatch.setattr(ahocorasick, "Automaton", Spy)
    rows = [(0, 0, 1, 0, 0, 0, "aa bb cc dd"), (0, 1, 2, 0, 0, 7, "zz aa bb cc dd"), (1, 1, 2, 0, 0, 0, "aa bb cc")]
    names = ["shard", "kind", "id", "h1", "h2", "at", "text"]
    batch = pa.record_batch([pa.array(c) for c in zip(*rows)], names=names)
    found = [r for b in substring_dedup._locate(3)(iter([batch])) for r in b.to_pylist()]
    assert [(r["id"], r["begin"], r["stop"]) for r in found] == [(2, 8, 12)] and streamed == [5]


def test_null_id_is_the_smallest(table):
    text = " ".join(map(str, range(20)))
    found = substring_dedup.remove_repeats(table([(None, text), (-5, text), (-5, text + " more")])).collect()
    assert sorted((str(r.doc_id), r.n_words, r.n_removed) for r in found) == [("-5", 20, 20), ("-5", 21, 20), ("None", 20, 0)]


LINES = [(i, f"own {i}\n  Shared LINE \t\n\nÉ shared\n" + ("rare\nrare" if i < 3 else "")) for i in range(12)]
LINES += [(50, None), (51, ""), (52, "shared line"), (52, "shared line"), (None, "SHARED LINE\nlast"), (53, "é shared")]


@pytest.mark.parametrize("rows", [LINES, []])
@pytest.mark.parametrize("min_docs, batches", [(10, 4), (3, 1)])
def test_line_dedup(table, rows, min_docs, batches):
    docs = table(rows)
    if batches > 1:  # as the operator does with files
        runs = line_dedup.LineRuns(min_docs)
        for part in docs.randomSplit([1.0] * batches, 7):
            runs.add(line_dedup.key_counts(part))
        found = line_dedup.drop_lines(docs, runs.frequent())
    else:
        found = line_dedup.dedup_lines(docs, min_docs=min_docs)
    lower = str.maketrans(line_dedup.ascii_lower.__globals__["UPPER"], line_dedup.ascii_lower.__globals__["LOWER"])
    key = lambda line: line.strip(" \t\n\x0b\x0c\r").translate(lower)
    counts = collections.Counter(k for _, t in rows for k in {key(x) for x in (t or "").split("\n")})
    expected = []
    for i, t in rows:
        split = (t or "").split("\n")
        kept = [x for x in split if not key(x) or counts[key(x)] < min_docs]
        expected.append((i, len(split), len(split) - len(kept), "\n".join(kept)))
    got = [(r.doc_id, r.n_lines, r.n_dropped, r.kept_text) for r in found.collect()]
    assert sorted(got, key=str) == sorted(expected, key=str)
    assert set(docs.columns) <= set(found.columns)


def test_unseen_lines_anti_join_the_runs(table):
    runs = line_dedup.LineRuns(min_docs=2)
    for batch in ([(1, "a\nb")], [(2, "b\nc")], [(3, "d")]):
        runs.add(line_dedup.key_counts(table(batch)))
    assert runs.unseen(line_dedup.key_counts(table([(4, "a\nb\nc\nd\nnew")]))).count() == 1
