"""Suffix arrays, their shards and the removal of repeated bytes against brute force."""

import collections
import hashlib
import os
import random

import numpy as np
import pytest

from brevia.llm import suffix_dedup as sd

SMALL = "/root/testdata/sf0.001/documents.parquet"


def expected(rows, window):
    texts = [(t or "").encode() for _, t in rows]
    starts = collections.Counter(
        t[k : k + window] for t in texts for k in range(len(t) - window + 1)
    )
    out = []
    for (i, _), t in zip(rows, texts):
        gone = np.zeros(len(t) + 2, bool)
        for k in range(len(t) - window + 1):
            if starts[t[k : k + window]] > 1:
                gone[k + 1 : k + window + 1] = True
        kept = bytes(b for b, g in zip(t, gone[1:-1].tolist()) if not g)
        spans = int((gone[1:] & ~gone[:-1]).sum())
        out.append((i, len(t), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def family(seed):
    rng = random.Random(seed)
    make = lambda n: "".join(rng.choice("abé \n\x00") for _ in range(n))
    passages = [make(rng.randint(8, 60)) for _ in range(4)]
    out = []
    for i in range(60):
        parts = [make(rng.randint(0, 40)) for _ in range(rng.randint(1, 4))]
        for _ in range(rng.randint(0, 2)):
            parts.insert(rng.randint(0, len(parts)), rng.choice(passages))
        out.append((i, "".join(parts)))
    base = make(150)
    for m in range(12):
        text = list(base)
        for _ in range(m):
            text[rng.randrange(len(text))] = "z"
        out.append((100 + m, "".join(text)))
    out += [(200 + k, base) for k in range(4)] + [(None, base[:70]), (None, base[:70] + "q"), (None, None), (200, base + "!")]
    return out + [(300, ""), (301, "a" * 300), (302, "ab" * 100), (303, "\x00" * 90), (304, "x"), (305, base + base[::-1] + base)]


@pytest.mark.parametrize("window, gram, shard_passages", [(16, 6, 2048), (24, 24, 2048), (16, 5, 3)])
def test_removed_bytes(table, window, gram, shard_passages):
    rows = family(window + gram)
    # the small shards deal hot anchors over several, whose runs are merged
    dedup = sd.SuffixDedup(table(rows), window, gram, shard_bytes=4096, shard_passages=shard_passages)
    got = dedup.cleaned().select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256").collect()
    assert sorted((tuple(r) for r in got), key=repr) == expected(rows, window)


@pytest.mark.skipif(not os.path.exists(SMALL), reason="no test tables")
def test_query_on_whole_texts(spark):
    rows = [tuple(r) for r in spark.read.parquet(SMALL).select("doc_id", "text").collect()]
    got = sd.op12_suffix_dedup(spark, os.path.dirname(SMALL)).collect()
    names = ("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
    assert sorted((tuple(r[c] for c in names) for r in got), key=repr) == expected(rows, sd.WINDOW)


def test_empty_table(table):
    assert sd.SuffixDedup(table([])).cleaned().count() == 0


@pytest.mark.parametrize("seed", range(4))
def test_suffix_order_and_common_prefixes(seed):
    rng = random.Random(seed)
    text = bytes(rng.choice(b"ab") for _ in range(400)) + b"abab" * 60 + b"\xff" * 64
    data = np.frombuffer(text, np.uint8)
    order = sd.suffix_order(data)
    assert order.tolist() == sorted(range(len(text)), key=lambda i: text[i:])
    shared = sd.common_prefixes(data, order, 50)
    for k in range(1, len(order)):
        a, b = text[order[k - 1] :], text[order[k] :]
        n = 0
        while n < min(50, len(a), len(b)) and a[n] == b[n]:
            n += 1
        assert shared[k] == n


def test_anchors_meet_in_equal_windows():
    rng = random.Random(2)
    common = bytes(rng.choice(b"abcd") for _ in range(30))
    a = b"xyxyxy" * 5 + common + b"1234" * 9
    b = b"qq" + common + b"zz" * 20
    found = []
    for text in (a, b):
        at, hashes = sd.anchors(np.frombuffer(text, np.uint8), 30, 7)
        begin = text.index(common)
        found.append({(p - begin, h) for p, h in zip(at.tolist(), hashes.tolist()) if begin <= p <= begin + 23})
    assert found[0] & found[1]
