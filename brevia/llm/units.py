"""Library encodings of white-space units, kept while a task runs.

Natural text repeats its words, and a tokeniser library spends most of its time on
words it has met before. A unit is encoded by the library once per process and looked up
afterwards, once for all its places in a slice. A table of ``LIMIT`` units takes no more: later ones are encoded where they
occur and forgotten, so memory stays bounded and frequent words stay known.
"""

from __future__ import annotations

import os
import re
from array import array
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

LIMIT = 600_000
WORDS = 1_000_000
# white space that ends a unit is looked for beyond this many bytes of a long text
SEGMENT = 1 << 20


@lru_cache(maxsize=4)
def library(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


def gather(values: np.ndarray, starts: np.ndarray, lens: np.ndarray) -> np.ndarray:
    """Concatenation of ``values[s : s + n]`` for all pairs (s, n)."""
    ends = np.cumsum(lens)
    shift = np.repeat(starts - (ends - lens), lens)
    return values[shift + np.arange(len(shift))]


# A word of Latin-1 letters, which no normaliser here changes but for their case, and the
# signs after it, which every splitter here cuts off in one piece.
WORD = re.compile("([A-Za-zÀ-ÖØ-öø-ÿ]+)([.,;:!?*#%&$|]*)")


def _byte_letters() -> list[str]:
    """The letter that stands for each byte in byte-level vocabularies.

    Printable Latin-1 bytes stand for themselves, the others for letters from 256 on.
    """
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return [chr(b) if b in plain else chr(256 + rest.index(b)) for b in range(256)]


BYTE_LETTERS = _byte_letters()


def byte_letters(word: str) -> str:
    return word if word.isascii() else "".join(BYTE_LETTERS[b] for b in word.encode())


class WordUnits:
    """Ids of texts under a tokeniser that drops white space and never joins across it.

    For such a tokeniser the ids of a text are the ids of its units between ASCII white
    space, one after the other: neither normalisation nor matching looks beyond it.
    Words of Latin-1 letters go to the library's model in lower case, which is what its
    normaliser and splitter would hand on; all other units go through both.
    """

    def __init__(self, path: str):
        self.library = library(path)
        self.model = self.library.model
        self.known: dict[str, int] = {}
        self.words: dict[str, bytes] = {}
        self.signs: dict[str, bytes] = {"": b""}
        self.ids = np.empty(0, np.uint32)
        self.starts = self.lens = np.empty(0, np.int64)

    def _whole(self, units: list[str]) -> list[bytes]:
        found = self.library.encode_batch_fast(units, add_special_tokens=False)
        return [array("I", e.ids).tobytes() for e in found]

    def _word(self, word: str) -> bytes:
        ids = self.words.get(word)
        if ids is None:
            ids = array("I", [t.id for t in self.model.tokenize(byte_letters(word))]).tobytes()
            if len(self.words) < WORDS:
                self.words[word] = ids
        return ids

    def _signs(self, signs: str) -> bytes:
        ids = self.signs.get(signs)
        if ids is None:
            ids = self._whole([signs])[0]
            if len(self.signs) < LIMIT:
                self.signs[signs] = ids
        return ids

    def _learn(self, units: list[str]) -> None:
        parts = list(map(WORD.fullmatch, units))
        rest = [u for u, m in zip(units, parts) if m is None]
        rest_ids = iter(self._whole(rest) if rest else ())
        ids = [
            next(rest_ids) if m is None else self._word(m[1].lower()) + self._signs(m[2])
            for m in parts
        ]
        lens = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
        new = np.frombuffer(b"".join(ids), np.uint32)
        self.known.update(zip(units, range(len(self.known), len(self.known) + len(units))))
        self.starts = np.concatenate([self.starts, len(self.ids) + np.cumsum(lens) - lens])
        self.lens = np.concatenate([self.lens, lens])
        self.ids = np.concatenate([self.ids, new])

    def _forget(self, units: list[str], n_units: int, n_ids: int) -> None:
        for u in units:
            del self.known[u]
        self.ids, self.starts = self.ids[:n_ids], self.starts[:n_units]
        self.lens = self.lens[:n_units]

    def _encode(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        # blanks at the ends of a text give empty units, which have no ids
        parts = pc.ascii_split_whitespace(pa.array(texts, pa.binary()).cast(pa.string()))
        flat = parts.values.dictionary_encode()
        units = flat.dictionary.to_numpy(zero_copy_only=False).tolist()
        at = list(map(self.known.get, units))
        n_units, n_ids, new = len(self.known), len(self.ids), []
        if None in at:
            new = [u for u, i in zip(units, at) if i is None]
            self._learn(new)
            later = iter(range(n_units, n_units + len(new)))
            at = [next(later) if i is None else i for i in at]
        at = np.array(at, np.int64)[flat.indices.to_numpy()]
        lens = self.lens[at]
        ids = gather(self.ids, self.starts[at], lens)
        ends = np.concatenate([[0], np.cumsum(lens)])
        per_text = parts.offsets.to_numpy()
        if len(self.known) > LIMIT:
            self._forget(new, n_units, n_ids)
        return ids, np.diff(ends[per_text])

    def encode(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """All ids in order and how many each text has."""
        if max(map(len, texts), default=0) <= 2 * SEGMENT:
            return self._encode(texts)
        ids, lens = [], []
        for text in texts:
            found = [self._encode([piece])[0] for piece in segments(text)]
            lens.append(sum(map(len, found)))
            ids.extend(found)
        return np.concatenate(ids), np.array(lens, np.int64)


@lru_cache(maxsize=2)
def word_units(path: str) -> WordUnits:
    """The table of this process, which outlives its tasks."""
    return WordUnits(path)


def segments(text: bytes) -> list[bytes]:
    """A long text in pieces that end before ASCII white space, where there is any."""
    out, begin = [], 0
    while begin < len(text):
        end = begin + SEGMENT
        while end < len(text) and text[end] not in b" \t\n\x0b\x0c\r":
            end += 1
        out.append(text[begin:end])
        begin = end
    return out or [b""]
