"""Token files, rank codec, token counts and fingerprints against the libraries."""

import base64
import hashlib
import random
import zlib

import numpy as np
import public_tokenizers as P
import pytest
import tiktoken
from tokenizers import Tokenizer

from brevia.llm import bpe_codec, lz_fingerprint, simple8b, token_counts, token_files
from brevia.session import scratch_path

ODD = [
    (None, "no id"), (1, None), (2, ""), (3, "   "), (4, "a  b\n\n c\t"), (5, "x\u00a0 \u00a0y é's don't 12"),
    (6, "日本語 テキスト 🙂🙂"), (7, "<|endoftext|> a<|endoftext|>b"), (8, "q" * 3000), (9, "THE!! the, The."),
    (9, "THE!! the, The."), (9, "other text with one id"), (10, "\x1c a b\x1c c"), (11, "İ Σ ΑΣ ß é ﬁ"),
]


def rows():
    rng = random.Random(3)
    words = ["the", "of", "ration", "Über", "naïve", "x1", "end.", "and,", "###", "<|endoftext|>", "  ", "\n"]
    long = [(20 + k, " ".join(rng.choice(words) for _ in range(rng.randint(1, 900)))) for k in range(12)]
    return ODD + long


def order(row):
    return (row[0] is not None, row[0] or 0, row[1] or "")


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.mark.parametrize(
    "values", [[], [0] * 5000, [2**63, 5, 2**60, 2**60 - 1] * 2000, [2 ** (k % 64) for k in range(9000)], list(range(70000))]
)
def test_simple8b_round_trip(values):
    v = np.array(values, np.uint64)
    words, offsets, raw = simple8b.encode(v)
    assert (simple8b.decode(words, offsets, raw, len(v)) == v).all()
    for block in range(len(offsets)):
        own = simple8b.decode_block(words, offsets, raw, len(v), block)
        assert (own == v[block * simple8b.BLOCK : (block + 1) * simple8b.BLOCK]).all()


@pytest.mark.parametrize("data", [rows(), []])
def test_token_files(spark, table, data):
    path, vocabulary = scratch_path(spark, "t"), P.path(token_files.VOCABULARY)
    token_files.write_tokens(table(data), path, vocabulary)
    library, start, expected = Tokenizer.from_file(vocabulary), 0, []
    for doc_id, text in sorted(data, key=order):
        ids = np.array(library.encode(text or "", add_special_tokens=False).ids + [1], "<u4")
        expected.append((doc_id, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    assert got(token_files.read_tokens(spark, path)) == sorted(expected, key=str)


@pytest.mark.parametrize("data", [rows(), []])
@pytest.mark.parametrize("chunk, overlaps", [(32_768, (256,)), (300, (8, 64)), (64, (2,))])
def test_rank_codec(table, data, chunk, overlaps):
    path, expected = P.path(bpe_codec.VOCABULARY), []
    with open(path, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    library = tiktoken.Encoding("t", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    for doc_id, text in data:
        ids = library.encode_ordinary(text or "")
        listed = hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        expected.append((doc_id, len(ids), listed, hashlib.sha256((text or "").encode()).hexdigest()))
    found = bpe_codec.encode_digests(table(data), path, chunk=chunk, overlaps=overlaps)
    assert got(found) == sorted(expected, key=str)


@pytest.mark.parametrize("data", [rows(), []])
@pytest.mark.parametrize("chunk, overlaps", [(32_768, (256,)), (300, (8, 64)), (64, (2,))])
def test_token_counts(table, data, chunk, overlaps):
    path = P.path(token_counts.VOCABULARY)
    library, expected = Tokenizer.from_file(path), []
    for doc_id, text in data:
        n = len(library.encode(text or "", add_special_tokens=False).ids)
        expected.append((doc_id, len((text or "").encode()), n, n > 400))
    found = token_counts.count_tokens(table(data), path, max_tokens=400, chunk=chunk, overlaps=overlaps)
    assert got(found) == sorted(expected, key=str)


@pytest.mark.parametrize("data", [rows(), [(5, "one text alone in the table")], []])
def test_fingerprints(table, data):
    expected, ordered = [], sorted(data, key=order)
    for k, (doc_id, text) in enumerate(ordered):
        text, successor = text or "", ordered[(k + 1) % len(ordered)][1] or ""
        n = len(text) // 4
        changed = text[: len(text) - n] + successor[:n]
        a, b, c = map(lz_fingerprint.fingerprint, (text, changed, successor))
        digest = hashlib.sha256(changed.encode()).hexdigest()
        near = lz_fingerprint.likeness(a, b), lz_fingerprint.likeness(a, c)
        expected.append((doc_id, len(text), digest, a, b, *near))
    assert got(lz_fingerprint.fingerprints(table(data))) == sorted(expected, key=str)


def test_likeness_follows_shared_phrases():
    rng = random.Random(1)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(4))
    text = " ".join(word() for _ in range(800))
    edited = lz_fingerprint.edited(text, " ".join(word() for _ in range(800)))
    other = " ".join(word() for _ in range(800))
    mark = lz_fingerprint.fingerprint
    assert mark(text) == mark(text)
    assert lz_fingerprint.likeness(mark(text), mark(edited)) > 0.4 > 0.2 > lz_fingerprint.likeness(mark(text), mark(other))
