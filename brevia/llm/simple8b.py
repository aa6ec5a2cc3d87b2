"""Simple-8b: as many integers to a 64-bit word as its four selector bits allow.

Values are packed in blocks of ``BLOCK``; words never span blocks, and the word index at
which each block begins is kept, so any block decodes by itself and all blocks decode
with one array operation per selector. A value of more than 60 bits is an escape: its
word holds an index into a list of raw 64-bit values.
"""

from __future__ import annotations

import numpy as np

BLOCK = 4096
ESCAPE = 1
# fixed values of the format, by selector: values to a word and bits to a value
COUNTS = np.array([240, 1, 60, 30, 20, 15, 12, 10, 8, 7, 6, 5, 4, 3, 2, 1])
BITS = np.array([0, 60, 1, 2, 3, 4, 5, 6, 7, 8, 10, 12, 15, 20, 30, 60])


def _begins(fit: np.ndarray, count: int) -> np.ndarray:
    """Where a word of ``count`` values may begin; rows are blocks with spare columns.

    Spare columns fit always, so a word that the end of its block cuts short is full.
    """
    size = 1
    while 2 * size <= count:
        fit = fit[:, :-size] & fit[:, size:]
        size *= 2
    if size < count:
        fit = fit[:, : size - count] & fit[:, count - size :]
    return fit[:, :BLOCK]


def _bits(v: np.ndarray) -> np.ndarray:
    """Bit lengths; both halves of a value are exact as doubles."""
    high = v >> np.uint64(32)
    low = np.frexp((v & np.uint64(0xFFFFFFFF)).astype(np.float64))[1]
    return np.where(high > 0, np.frexp(high.astype(np.float64))[1] + 32, low)


def encode(values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(words, word index of each block, escaped values)."""
    v = np.asarray(values, np.uint64)
    n = len(v)
    if not n:
        return np.empty(0, np.uint64), np.empty(0, np.int64), np.empty(0, np.uint64)
    bits = _bits(v).astype(np.uint8)
    blocks = -(-n // BLOCK)
    rows = np.zeros((blocks, BLOCK + COUNTS.max()), np.uint8)
    rows[:, :BLOCK] = np.pad(bits, (0, blocks * BLOCK - n)).reshape(blocks, BLOCK)
    selector = np.full((blocks, BLOCK), 15, np.uint8)
    for s in (14, 13, 12, 11, 10, 9, 8, 7, 6, 5, 4, 3, 2, 0):
        selector[_begins(rows <= BITS[s], COUNTS[s])] = s
    selector = selector.ravel()[:n]
    selector[bits > 60] = ESCAPE
    at = np.arange(n)
    step = np.minimum(COUNTS[selector], np.minimum((at // BLOCK + 1) * BLOCK, n) - at)
    steps, first, i = step.tolist(), [], 0
    while i < n:
        first.append(i)
        i += steps[i]
    first = np.array(first)
    chosen = selector[first]
    words = chosen.astype(np.uint64) << np.uint64(60)
    padded = np.concatenate([v, np.zeros(COUNTS.max(), np.uint64)])
    for s in np.unique(chosen).tolist():
        if s in (0, ESCAPE):
            continue
        own = np.flatnonzero(chosen == s)
        begin = first[own]
        taken = step[begin]
        short = taken < COUNTS[s]
        digits = np.zeros(len(own), np.uint64)
        for k in range(COUNTS[s]):
            digit = padded[begin + k] << np.uint64(k * BITS[s])
            digit[short & (k >= taken)] = 0
            digits |= digit
        words[own] |= digits
    raw = v[first[chosen == ESCAPE]]
    words[chosen == ESCAPE] |= np.arange(len(raw), dtype=np.uint64)
    return words, np.searchsorted(first, np.arange(0, n, BLOCK)), raw


def decode(words: np.ndarray, offsets: np.ndarray, raw: np.ndarray, n: int) -> np.ndarray:
    """The ``n`` values of all blocks."""
    out = np.zeros(n, np.uint64)
    if not n:
        return out
    chosen = (words >> np.uint64(60)).astype(np.int64)
    before = np.concatenate([[0], np.cumsum(COUNTS[chosen])])
    block = np.zeros(len(words), np.int64)
    block[offsets[1:]] = 1
    block = np.cumsum(block)
    begin = before[:-1] - before[offsets][block] + block * BLOCK
    end = np.minimum((block + 1) * BLOCK, n)
    for s in np.unique(chosen):
        if s == 0:
            continue
        own = np.flatnonzero(chosen == s)
        mask = np.uint64((1 << int(BITS[s])) - 1)
        for k in range(COUNTS[s]):
            to = begin[own] + k
            ok = to < end[own]
            found = (words[own[ok]] >> np.uint64(k * BITS[s])) & mask
            out[to[ok]] = raw[found.astype(np.int64)] if s == ESCAPE else found
    return out


def decode_block(
    words: np.ndarray, offsets: np.ndarray, raw: np.ndarray, n: int, block: int
) -> np.ndarray:
    """The values of one block, read through its offset alone."""
    begin = offsets[block]
    end = offsets[block + 1] if block + 1 < len(offsets) else len(words)
    size = min(BLOCK, n - block * BLOCK)
    return decode(words[begin:end], np.zeros(1, np.int64), raw, size)
