"""Token counts, with long texts encoded in overlapping chunks that are resynchronised.

The library encodes each chunk with offsets. A pre-token boundary that two neighbouring
chunks share splices them (see ``overlap``): the count is the tokens of each chunk between
its cuts, so no text is encoded again. Chunks hold back as much of their end as the longest
special string, which a cut could hide. Overlaps are widened where no boundary is shared.

A short text is cut at single blanks between words; for byte-level splitters a blank
belongs to the word after it, so the units count by themselves and the library encodes
each distinct one once. A text with runs of white space goes to the library as a whole.
A null text has no tokens.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache, reduce
from itertools import chain

import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from brevia.llm import arrow, overlap
from brevia.llm.common import row_key, text_of
from brevia.llm.units import BYTE_LETTERS, LIMIT, WORD, WORDS, byte_letters, library

VOCABULARY = "byte_bpe_50k.json"
MAX_TOKENS = 1024
# a blank beside other white space can't be a cut
CROWDED = re.compile(r"\s | \s")


class BlankUnits:
    """Token counts under a byte-level tokeniser whose pattern keeps a blank with its word."""

    def __init__(self, path: str):
        self.library = library(path)
        self.model = self.library.model
        self.known: dict[str, int] = {}
        self.words: dict[str, int] = {}
        self.signs: dict[str, int] = {"": 0}
        self.blank = BYTE_LETTERS[ord(" ")]

    def whole(self, texts: list[str]) -> list[int]:
        return list(map(len, self.library.encode_batch_fast(texts, add_special_tokens=False)))

    def _word(self, word: str) -> int:
        n = self.words.get(word)
        if n is None:
            n = len(self.model.tokenize(self.blank + byte_letters(word)))
            if len(self.words) < WORDS:
                self.words[word] = n
        return n

    def _signs(self, signs: str) -> int:
        n = self.signs.get(signs)
        if n is None:
            n = self.whole([signs])[0]
            if len(self.signs) < LIMIT:
                self.signs[signs] = n
        return n

    def learn(self, units: list[str]) -> dict[str, int]:
        parts = list(map(WORD.fullmatch, units))
        rest = [u for u, m in zip(units, parts) if m is None]
        counts = iter(self.whole([" " + u for u in rest]) if rest else ())
        found = {
            u: next(counts) if m is None else self._word(m[1]) + self._signs(m[2])
            for u, m in zip(units, parts)
        }
        if len(self.known) < LIMIT:
            self.known.update(found)
        return found

    def count(self, texts: list[str]) -> list[int]:
        out = [0] * len(texts)
        crowded = [i for i, t in enumerate(texts) if CROWDED.search(t)]
        plain = sorted(set(range(len(texts))).difference(crowded))
        for i, n in zip(crowded, self.whole([texts[i] for i in crowded])):
            out[i] = n
        split = [texts[i].split(" ") for i in plain]
        firsts = self.whole([parts[0] for parts in split])
        units = [parts[1:] for parts in split]
        counts = [list(map(self.known.get, u)) for u in units]
        unknown = {u for us, ns in zip(units, counts) if None in ns for u, n in zip(us, ns) if n is None}
        new = self.learn(list(unknown)) if unknown else {}
        for i, first, us, ns in zip(plain, firsts, units, counts):
            if None in ns:
                ns = [new[u] if n is None else n for u, n in zip(us, ns)]
            out[i] = first + sum(ns)
        return out


@lru_cache(maxsize=2)
def blank_units(path: str) -> BlankUnits:
    return BlankUnits(path)


def _short(path: str):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        units = blank_units(path)
        for rows in arrow.slices(batches):
            n = units.count(arrow.texts(rows.column("text")))
            yield rows.drop_columns(["text"]).append_column("n_tokens", pa.array(n, pa.int64()))

    return count


def word_starts(encoding) -> list[tuple[int, int]]:
    """(position, tokens before it) of every pre-token of an encoding."""
    words, offsets = encoding.word_ids, encoding.offsets
    return [
        (offsets[i][0], i) for i in range(len(words)) if not i or words[i] is None or words[i] != words[i - 1]
    ]


def _analyse(path: str):
    def analyse(chunks: DataFrame, chunk: int, width: int) -> DataFrame:
        def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            own = library(path)
            margin = 2 + max((len(t.content) for t in own.get_added_tokens_decoder().values()), default=0)
            for rows in arrow.slices(batches):
                out = []
                for row in rows.to_pylist():
                    text, begin = row.pop("text"), row["begin"]
                    encoding = own.encode(text, add_special_tokens=False)
                    stop = len(text) - margin
                    starts = word_starts(encoding)
                    row["heads"], row["before"] = [], []
                    row["tails"], row["until"] = [], []
                    for at, n in starts:
                        if at <= width:
                            row["heads"].append(begin + at)
                            row["before"].append(n)
                        if chunk <= at <= stop:
                            row["tails"].append(begin + at)
                            row["until"].append(n)
                    row["n"] = len(encoding.ids)
                    out.append(row)
                yield pa.RecordBatch.from_pylist(out, schema=schema)

        many = pa.list_(pa.int64())
        schema = pa.schema(
            [*((c, pa.int64()) for c in overlap.KEY), ("chunk", pa.int32()), ("last", pa.bool_())]
            + [("begin", pa.int64()), ("heads", many), ("before", many), ("tails", many)]
            + [("until", many), ("n", pa.int64())]
        )
        return chunks.mapInArrow(
            mark,
            "doc_id bigint, h1 bigint, h2 bigint, chunk int, last boolean, begin bigint, heads array<bigint>, "
            "before array<bigint>, tails array<bigint>, until array<bigint>, n bigint",
        )

    return analyse


def count_long(docs: DataFrame, path: str, chunk: int, overlaps: tuple[int, ...]) -> DataFrame:
    """(key, n_tokens) of the distinct long texts."""
    cut, rest = overlap.spliced(docs, _analyse(path), chunk, overlaps)
    at = lambda counts, places, cut_at: F.get(
        F.col(counts), (F.array_position(places, F.col(cut_at)) - 1).cast("int")
    )
    own = F.coalesce(at("until", "tails", "hi"), F.col("n")) - F.coalesce(at("before", "heads", "lo"), F.lit(0))
    parts = [c.select(*overlap.KEY, own.alias("n_tokens")) for c in cut]
    if rest is not None:
        parts.append(
            rest.select(*overlap.KEY, "text").mapInArrow(_short(path), "doc_id bigint, h1 bigint, h2 bigint, n_tokens bigint")
        )
    return reduce(DataFrame.unionByName, parts).groupBy(*overlap.KEY).agg(F.sum("n_tokens").alias("n_tokens"))


def count_tokens(
    docs: DataFrame,
    path: str,
    max_tokens: int = MAX_TOKENS,
    chunk: int = overlap.CHUNK,
    overlaps: tuple[int, ...] = overlap.OVERLAPS,
) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) of every row of (doc_id, text)."""
    docs = docs.select("doc_id", "text")
    long = overlap.is_long(chunk)
    size = F.octet_length(text_of()).cast("long").alias("n_bytes")
    short = docs.where(~long).select("doc_id", size, "text")
    short = short.mapInArrow(_short(path), "doc_id bigint, n_bytes bigint, n_tokens bigint")
    rows = docs.where(long)
    sizes = rows.select(*row_key(), size).distinct()
    found = overlap.join_back(rows, count_long(rows, path, chunk, overlaps).join(sizes, overlap.KEY))
    both = short.unionByName(found)
    return both.withColumn("over_limit", F.col("n_tokens") > max_tokens)


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return count_tokens(docs, public_tokenizers.path(VOCABULARY))
