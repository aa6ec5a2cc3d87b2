"""Importance resampling against a plain second implementation."""

import hashlib
import math
import random
import re
import zlib

import numpy as np
import pytest

from brevia.llm import importance_resampling as ir

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words_of(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return WORD.findall(lower)


def features(text, max_words):
    w = words_of(text)
    return [
        zlib.crc32(" ".join(w[i : i + n]).encode()) % 10_000
        for n in range(1, max_words + 1)
        for i in range(len(w) - n + 1)
    ]


def expected(rows, target, max_words=1):
    found = [(i, features(t, max_words), len(words_of(t))) for i, t in rows]
    wanted = [f for t in target for f in features(t, max_words)]
    s, t = [0] * 10_000, [0] * 10_000
    for _, fs, _ in found:
        for f in fs:
            s[f] += 1
    for f in wanted:
        t[f] += 1
    total, goal = sum(s) + 10_000, sum(t) + 10_000
    gain = [math.floor(1000 * math.log((t[b] + 1) * total / ((s[b] + 1) * goal))) for b in range(10_000)]
    out = []
    for i, fs, n in found:
        weight = sum(gain[f] for f in fs) // len(fs) if fs else 0
        name = "" if i is None else i
        h = int(hashlib.sha256(f"2024:{name}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append([i, len(fs), weight, score, None, n])
    able = [r for r in out if r[5] >= 20]
    able.sort(key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    for place, r in enumerate(able[: 10 * len(able) // 100], 1):
        r[4] = place
    return sorted((tuple(r[:5]) for r in out), key=repr)


def rows(seed=3, n=300):
    rng = random.Random(seed)
    vocabulary = ["".join(rng.choice("abcdeéß中9") for _ in range(rng.randint(1, 6))) for _ in range(400)]
    make = lambda k: rng.choice([" ", ", ", "\n", "  "]).join(rng.choices(vocabulary, k=k))
    out = [(i, make(rng.randint(0, 80))) for i in range(n)]
    odd = [(None, make(40)), (None, None), (1000, None), (1001, ""), (1002, "\x00 !?"), (1003, make(30_000)), (5, out[5][1]), (5, make(50))]
    return out + odd + [(1004, "A" * 70_000), (1005, "Zz " * 30 + "x" * 60)], [make(30).upper() for _ in range(20)] + [None, ""]


@pytest.mark.parametrize("max_words, dictionary", [(1, 1 << 16), (1, 0), (3, 50)])
def test_scores_and_ranks(spark, table, max_words, dictionary):
    docs, target = rows()
    goal = spark.createDataFrame([(t, 1) for t in target], "text string, buckets int")
    found = ir.ImportanceResampler(table(docs), goal, max_words=max_words, dictionary=dictionary).ranked()
    got = found.select("doc_id", "n_features", "weight", "score", "rank").collect()
    assert sorted((tuple(r) for r in got), key=repr) == expected(docs, target, max_words)


def test_composed_crcs():
    rng = random.Random(1)
    pairs = [(rng.randbytes(rng.randint(0, 9)), rng.randbytes(rng.choice([0, 1, 5, 300, 70_000]))) for _ in range(50)]
    a, b = (np.array([zlib.crc32(p[k]) for p in pairs], np.uint32) for k in (0, 1))
    got = ir.composed(a, b, np.array([len(p[1]) for p in pairs]))
    assert got.tolist() == [zlib.crc32(x + y) for x, y in pairs]


def test_pieces_of_a_long_text(monkeypatch):
    rng = random.Random(2)
    texts = [b" ".join(rng.choice([b"ab", b"c", b"longer", b"rare%d" % k]) for k in range(500)), b"", b"  x " * 40]
    texts = [ir.delimited(t) for t in texts]
    scanner = ir.WordScanner([b"ab", b"c", b"x"])
    whole = scanner.payloads(texts)
    monkeypatch.setattr(ir, "PIECE", 37)
    for a, b in zip(whole, scanner.payloads(texts)):
        assert a.tolist() == b.tolist()
    assert whole[2].tolist() == [len(t.split()) for t in texts]


def test_drawn_rows_keep_their_columns(spark, table):
    docs, target = rows()
    goal = spark.createDataFrame([(t,) for t in target], "text string")
    sampler = ir.ImportanceResampler(table(docs), goal)
    ranked = {r.doc_id for r in sampler.ranked().where("rank is not null").collect()}
    drawn = sampler.drawn()
    assert drawn.columns == table([]).columns
    assert {r.doc_id for r in drawn.collect()} == ranked


def test_empty_tables(spark, table):
    goal = spark.createDataFrame([], "text string")
    assert ir.ImportanceResampler(table([]), goal).ranked().count() == 0
    one = ir.ImportanceResampler(table([(1, "a b"), (2, None)]), goal).ranked().orderBy("doc_id").collect()
    assert [(r.n_features, r.rank) for r in one] == [(2, None), (0, None)]
