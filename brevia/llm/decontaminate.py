"""Benchmark decontamination: BM25 over test items with block-max WAND.

Test items are indexed in shards of bounded size; each shard is broadcast and meets all
documents, a stated set against all rows. An item belongs to a length class, the least power of
two that holds its words and ``SEGMENT`` at least, and a document is read once for each class: as
passages of two segments of that length which overlap by one, so an item lies whole in some
passage. What else the shard holds changes nothing. A passage is a query of its distinct words.

A shard scans the texts once and writes them as numbers of its words; counting, retrieval and
verification read that table, which is deleted when the shard is done. A word weighs by the share of all
documents that hold it. Weights are divided by the item's score for its own text, so a score is the matched
share of an item and one threshold serves all items.

An item's words are put in order from the most frequent on. The first ones, up to a bound of
``SLACK`` of the threshold, can't bring it there, so its pivot is the next one: only lists from
the pivot on propose it. These lists are in blocks of ``BLOCK`` items with block maxima, and a
block whose maxima and rest stay below the threshold is skipped for the passage. All items of the other
blocks are scored on all their words, all passages of a slice at once.

Hits are verified on word n-grams in the passage and a segment on either side: of the whole item or of its
question (all but the last line or sentence) a share of ``MIN_OVERLAP`` must be there. The overlap
with the answer (the last) is reported and decides nothing. Parts of few words have shorter n-grams, so
that one changed word leaves half of them. N-grams are 64-bit hashes, made once for a slice.

Items and texts are split by one rule: at Unicode white space, and around each character of a
script that is written without blanks. Words are lower-cased and lose their outer punctuation. Null and empty texts and items match
nothing; an item of one sentence is all question; repeated rows give one row for each pair.
"""

from __future__ import annotations

import math
import re
import uuid
from collections import Counter
from collections.abc import Iterator
from functools import reduce
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from brevia.llm import arrow
from brevia.llm.words import grams
from brevia.session import discard, materialise

K1, B = 1.2, 0.75
SEGMENT = 64
BLOCK = 8
SLACK = 0.5
# numbers that one array operation works on
BATCH = 1 << 21
GRAM = 5
MIN_SCORE = 0.35
MIN_OVERLAP = 0.5
SHARD_ITEMS = 1 << 15
SHARD_WORDS = 1 << 20
# words that a process keeps, characters of a long text that are split at once
KNOWN_WORDS = 1_000_000
PIECE = 1 << 20
OUTER = re.compile(r"^[\W_]+|[\W_]+$")
LAST_PART = re.compile(r"(?:\n|[.!?]\s)(?=[^\n]*\S)")
# Thai, Lao, Tibetan, Myanmar, Khmer, Tai scripts, kana, bopomofo, Han
UNSPACED = re.compile(
    "[\u0e00-\u0fff\u1000-\u109f\u1780-\u17ff\u1950-\u19ff\u1a20-\u1aaf\u3005-\u3007\u3021-\u3029\u3031-\u3035"
    "\u3040-\u312f\u31a0-\u31bf\u31f0-\u31ff\u3400-\u4dbf\u4e00-\u9fff\ua9e0-\ua9ff\uaa60-\uaadf\uf900-\ufaff"
    "\uff66-\uff9f\U0001b000-\U0001b16f\U00020000-\U0003ffff]"
)
CUT = re.compile(r"\s|" + UNSPACED.pattern)

HITS = "doc_id bigint, item_id bigint, score double, question_overlap double, answer_overlap double"


def normal(word: str) -> str:
    return OUTER.sub("", word.lower())


def split(text: str) -> list[str]:
    return (text if text.isascii() else UNSPACED.sub(r" \g<0> ", text)).split()


def pieces(text: str) -> Iterator[str]:
    """A long text in pieces that end where it is split anyway."""
    begin = 0
    while len(text) - begin > PIECE:
        cut = CUT.search(text, begin + PIECE)
        if not cut:
            break
        yield text[begin : cut.start()]
        begin = cut.start()
    yield text[begin:]


def terms_of(text: str) -> list[str]:
    return [w for w in map(normal, split(text)) if w]


def parts_of(text: str) -> tuple[list[str], list[str]]:
    """Words of the question and of the answer."""
    text = text.strip()
    cuts = [m.end() for m in LAST_PART.finditer(text)]
    if not cuts:
        return terms_of(text), []
    return terms_of(text[: cuts[-1]]), terms_of(text[cuts[-1] :])


def gram_size(n: int) -> int:
    """Words of an n-gram of a part of ``n`` words."""
    return min(GRAM, max(1, (n + 1) // 3))


def segment_size(n: int) -> int:
    """Words of a segment for an item of ``n`` words."""
    return max(SEGMENT, 1 << (n - 1).bit_length())


def _ranges(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The numbers ``s .. s + n - 1`` of all pairs (s, n), one after the other."""
    ends = np.cumsum(counts)
    return np.repeat(starts - (ends - counts), counts) + np.arange(ends[-1] if len(ends) else 0)


def _batches(sizes: np.ndarray) -> Iterator[slice]:
    """Slices of neighbours whose sizes add up to ``BATCH``, or of one."""
    ends, begin = np.cumsum(sizes), 0
    while begin < len(sizes):
        before = ends[begin - 1] if begin else 0
        end = max(begin + 1, int(np.searchsorted(ends, before + BATCH, side="right")))
        yield slice(begin, end)
        begin = end


class Lists:
    """Inverted lists of the items of one length class."""

    def __init__(self, items: list[int], weights: list[dict[int, float]], df: list[int], least: float):
        self.items, self.least, self.n_terms, self.width = items, least, len(df), BLOCK
        self.blocks = -(-len(items) // BLOCK)
        self.lens = np.array([len(w) for w in weights])
        self.begins = np.cumsum(self.lens) - self.lens
        self.terms = np.fromiter(chain.from_iterable(weights), np.int64, self.lens.sum())
        self.weights = np.fromiter(chain.from_iterable(w.values() for w in weights), float, self.lens.sum())
        self.rest = np.zeros(self.blocks)
        most: dict[tuple[int, int], float] = {}
        for k, own in enumerate(weights):
            block, rest = k // BLOCK, 0.0
            for term in sorted(own, key=lambda t: (-df[t], t)):
                if rest + own[term] < SLACK * least:
                    rest += own[term]
                else:
                    most[term, block] = max(most.get((term, block), 0.0), own[term])
            self.rest[block] = max(self.rest[block], rest)
        postings = sorted(most)
        self.block = np.array([b for _, b in postings], np.int64)
        self.most = np.array([most[x] for x in postings])
        self.ends = np.searchsorted([t for t, _ in postings], np.arange(self.n_terms), side="right")
        self.sizes = np.diff(self.ends, prepend=0)

    def _open(self, passages: np.ndarray, terms: np.ndarray) -> Iterator[np.ndarray]:
        """passage * blocks + block of all blocks that may hold a hit."""
        listed = self.sizes[terms] > 0
        passages, terms = passages[listed], terms[listed]
        if not len(terms):
            return
        begins = np.flatnonzero(np.diff(passages, prepend=-1))
        counts = self.sizes[terms]
        stops = np.append(begins, len(terms))
        for batch in _batches(np.add.reduceat(counts, begins)):
            own = slice(stops[batch.start], stops[batch.stop])
            at = _ranges(self.ends[terms[own]] - counts[own], counts[own])
            keys = np.repeat(passages[own], counts[own]) * self.blocks + self.block[at]
            found, place = np.unique(keys, return_inverse=True)
            bound = np.bincount(place, self.most[at]) + self.rest[found % self.blocks]
            yield found[bound >= self.least - 1e-6]

    def retrieve(self, passages: np.ndarray, terms: np.ndarray) -> Iterator[tuple[int, int, float]]:
        """(passage, item, score) of all pairs with at least ``least``.

        Passages ascend, and the terms of a passage ascend without repeats.
        """
        query = passages * self.n_terms + terms
        for found in self._open(passages, terms):
            passage = np.repeat(found // self.blocks, self.width)
            item = ((found % self.blocks)[:, None] * self.width + np.arange(self.width)).ravel()
            passage, item = passage[item < len(self.items)], item[item < len(self.items)]
            for own in _batches(self.lens[item]):
                p, k = passage[own], item[own]
                at = _ranges(self.begins[k], self.lens[k])
                of = np.repeat(np.arange(len(k)), self.lens[k])
                keys = p[of] * self.n_terms + self.terms[at]
                place = np.minimum(np.searchsorted(query, keys), len(query) - 1)
                score = np.bincount(of, self.weights[at] * (query[place] == keys), len(k))
                good = np.flatnonzero(score >= self.least)
                yield from zip(p[good].tolist(), k[good].tolist(), score[good].tolist())


def vocabulary(items: list[tuple[int, list[str], list[str]]]) -> list[str]:
    """All words of the items in order; a word's place is its number."""
    return sorted({w for _, question, answer in items for w in chain(question, answer)})


class Index:
    """One shard of items: their inverted lists by length class, and their n-grams."""

    def __init__(
        self,
        items: list[tuple[int, list[str], list[str]]],
        df: dict[str, int],
        n: int,
        mean: float,
        least: float = MIN_SCORE,
    ):
        """``df`` has the number of documents, of ``n``, that hold a word."""
        self.item_ids = [i for i, _, _ in items]
        self.terms = {w: k for k, w in enumerate(vocabulary(items))}
        self.parts, self.alone = [], []
        classes: dict[int, list[int]] = {}
        weights: list[dict[int, float]] = []
        for k, (_, question, answer) in enumerate(items):
            words = question + answer
            own = {}
            for word, tf in Counter(words).items():
                held = df.get(word, 0)
                idf = math.log(1 + (n - held + 0.5) / (held + 0.5))
                own[self.terms[word]] = idf * tf * (K1 + 1) / (tf + K1 * (1 - B + B * len(words) / mean))
            total = sum(own.values())
            weights.append({t: w / total for t, w in own.items()})
            self.parts.append([self._part(part) for part in (question, answer, words)])
            # a question of a few words is found anywhere, so it needs the rest of the item
            self.alone.append(len(question) >= GRAM)
            classes.setdefault(segment_size(len(words)), []).append(k)
        held = [df.get(w, 0) for w in self.terms]
        self.classes = {
            size: Lists(own, [weights[k] for k in own], held, least) for size, own in sorted(classes.items())
        }

    def _part(self, words: list[str]) -> tuple[int, np.ndarray] | None:
        n = gram_size(len(words))
        ids = np.array([self.terms[w] for w in words], np.uint64)
        return (n, np.unique(grams(ids, n))) if words else None


class Words:
    """Numbers of the words of texts, kept for words met before."""

    def __init__(self, terms: list[str]):
        self.terms = {w: k for k, w in enumerate(terms)}
        self.known: dict[str, int] = {}

    def _of(self, words: list[str]) -> np.ndarray:
        found = list(map(self.known.get, words))
        if None in found:
            new = {}
            for word, t in zip(words, found):
                if t is None and word not in new:
                    term = normal(word)
                    new[word] = self.terms.get(term, -1) if term else -2
            found = [new[w] if t is None else t for w, t in zip(words, found)]
            if len(self.known) < KNOWN_WORDS:
                self.known.update(new)
        ids = np.array(found, np.int64)
        return ids[ids > -2]

    def of(self, text: str) -> np.ndarray:
        """The number of each word, -1 for words of no item; words that are nothing but signs go."""
        return np.concatenate([self._of(split(piece)) for piece in pieces(text)])


class Matcher:
    """Passages of a slice of texts against an index."""

    def __init__(self, index: Index, min_overlap: float):
        self.index, self.min_overlap = index, min_overlap

    def match(self, ids: np.ndarray, starts: np.ndarray) -> list[list[tuple[int, float, float, float]]]:
        """(item, score, question overlap, answer overlap) of every text, the best of each item.

        ``ids`` are the numbers of all words, text ``k`` has those from ``starts[k]`` to ``starts[k + 1]``.
        """
        hashes, best = {}, [{} for _ in starts[1:]]
        for size, lists in self.index.classes.items():
            # segments are numbered through all texts
            counts = -(-np.diff(starts) // size)
            first = np.concatenate([[0], np.cumsum(counts)])
            for passage, k, score in self._retrieve(ids, starts, first, size, lists):
                text = int(np.searchsorted(first, passage, side="right")) - 1
                begin = starts[text] + max(0, passage - first[text] - 1) * size
                window = (begin, min(starts[text + 1], begin + 4 * size))
                item = lists.items[k]
                hit = self._verify(item, ids, window, hashes)
                if hit:
                    own = (score, *hit)
                    best[text][item] = max(best[text].get(item, own), own)
        return [[(item, *own) for item, own in found.items()] for found in best]

    def _retrieve(self, ids, starts, first, size, lists) -> Iterator[tuple[int, int, float]]:
        known = np.flatnonzero(ids >= 0)
        text = np.searchsorted(starts, known, side="right") - 1
        segment = first[text] + (known - starts[text]) // size
        term = ids[known]
        only = np.diff(first)[text] == 1
        # a passage has its segment and the next; a last segment is in the passage before it
        last = segment == first[text + 1] - 1
        for part in _batches(np.ones(int(first[-1]), np.int64) * size):
            a = slice(*np.searchsorted(segment, [part.start, part.stop]))
            b = slice(*np.searchsorted(segment, [part.start + 1, part.stop + 1]))
            begun, ended = ~last[a] | only[a], segment[b] > first[text[b]]
            passages = np.concatenate([segment[a][begun], segment[b][ended] - 1])
            terms = np.concatenate([term[a][begun], term[b][ended]])
            query = np.unique(passages * lists.n_terms + terms)
            if len(query):
                yield from lists.retrieve(query // lists.n_terms, query % lists.n_terms)

    def _verify(self, item, ids, window, hashes) -> tuple[float, float] | None:
        """Shares of the n-grams of question and answer in the window, if it holds enough of the item."""
        shares: list[float | None] = []
        for part in self.index.parts[item]:
            if part is None:
                shares.append(None)
                continue
            n, own = part
            if n not in hashes:
                hashes[n] = grams(ids.astype(np.uint64), n)
            held = np.isin(own, hashes[n][window[0] : max(window[0], window[1] - n + 1)])
            shares.append(float(held.sum() / len(own)))
        question, answer, whole = shares
        known = question if question is not None else answer or 0.0
        if (self.index.alone[item] and known >= self.min_overlap) or whole >= self.min_overlap:
            return known, known if answer is None else answer
        return None


_words: dict[str, Words] = {}


def _words_of(name: str, terms) -> Words:
    """The table of this process, which outlives its tasks; one at a time."""
    if name not in _words:
        _words.clear()
        _words[name] = Words(terms.value)
    return _words[name]


def _encode(name: str, terms, keys: list[str]):
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = _words_of(name, terms)
        for rows in arrow.slices(batches):
            ids = [words.of(t).astype(np.int32).tobytes() for t in arrow.texts(rows.column("text"))]
            columns = [*[rows.column(k) for k in keys], pa.array(ids, pa.binary())]
            yield pa.record_batch(columns, names=[*keys, "ids"])

    return encode


def _ids(rows: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of all words and where each row begins."""
    lists = rows.column("ids").to_pylist()
    starts = np.cumsum([0, *[len(x) // 4 for x in lists]])
    return np.frombuffer(b"".join(lists), np.int32).astype(np.int64), starts


def _count(n_terms: int):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros(n_terms, np.int64)
        for rows in arrow.slices(batches, "ids"):
            ids, starts = _ids(rows)
            at = np.flatnonzero(ids >= 0)
            text = np.searchsorted(starts, at, side="right") - 1
            np.add.at(held, np.unique(text * n_terms + ids[at]) % n_terms, 1)
        found = np.flatnonzero(held)
        yield pa.record_batch({"term": pa.array(found), "n": pa.array(held[found])})

    return count


def _match(index, min_overlap: float, keys: list[str]):
    def match(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = Matcher(index.value, min_overlap)
        names = [*keys, "item_id", "score", "question_overlap", "answer_overlap"]
        types = [pa.int64()] * (len(keys) + 1) + [pa.float64()] * 3
        for rows in arrow.slices(batches, "ids"):
            of = list(zip(*[rows.column(k).to_pylist() for k in keys]))
            hits = [
                (*key, index.value.item_ids[k], round(s, 6), q, a)
                for key, own in zip(of, matcher.match(*_ids(rows)))
                for k, s, q, a in own
            ]
            columns = list(zip(*hits)) or [[]] * len(names)
            yield pa.record_batch([pa.array(c, t) for c, t in zip(columns, types)], names=names)

    return match


def _items(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        parts = [parts_of(t) for t in arrow.texts(batch.column("text"))]
        kind = pa.list_(pa.string())
        yield pa.record_batch(
            {
                "item_id": batch.column("item_id"),
                "question": pa.array([q for q, _ in parts], kind),
                "answer": pa.array([a for _, a in parts], kind),
            }
        )


def find_leaks(
    docs: DataFrame,
    benchmark: DataFrame,
    min_score: float = MIN_SCORE,
    min_overlap: float = MIN_OVERLAP,
    more_keys: tuple[str, ...] = (),
) -> DataFrame:
    """One row for each document and test item it contains; see ``HITS``.

    ``more_keys`` are bigint columns that tell documents apart besides the id; they follow it.
    """
    keys = ["doc_id", *more_keys]
    schema = HITS.replace("item_id", "".join(f"{k} bigint, " for k in more_keys) + "item_id", 1)
    spark = docs.sparkSession
    items = benchmark.select("item_id", "text").mapInArrow(
        _items, "item_id bigint, question array<string>, answer array<string>"
    )
    words = F.concat("question", "answer")
    items = materialise(items.withColumn("n", F.size(words)).where("n > 0"), "items")
    total = items.agg(F.count(F.lit(1)), F.sum("n")).first()
    n_items, n_words = total[0], total[1] or 0
    docs = docs.select(*keys, "text")
    if not n_items:
        return docs.sparkSession.createDataFrame([], schema)
    mean = n_words / n_items
    shards = max(-(-n_items // SHARD_ITEMS), -(-n_words // SHARD_WORDS))
    shard = F.pmod(F.xxhash64("item_id", "question"), F.lit(shards))
    broadcast = spark.sparkContext.broadcast
    found = []
    for s in range(shards):
        own = items.where(shard == s).orderBy("item_id", "question").collect()
        own = [(r.item_id, r.question, r.answer) for r in own]
        if not own:
            continue
        terms = vocabulary(own)
        encode = _encode(uuid.uuid4().hex, broadcast(terms), keys)
        encoded = docs.mapInArrow(encode, "".join(f"{k} bigint, " for k in keys) + "ids binary")
        encoded = materialise(encoded, "word-numbers")
        counts = encoded.select("ids").mapInArrow(_count(len(terms)), "term bigint, n bigint")
        held = {terms[r.term]: r.n for r in counts.groupBy("term").agg(F.sum("n").alias("n")).collect()}
        index = broadcast(Index(own, held, encoded.count(), mean, min_score))
        found.append(materialise(encoded.mapInArrow(_match(index, min_overlap, keys), schema), "leaks"))
        discard(encoded)
    hits = reduce(DataFrame.unionByName, found).groupBy(*keys, "item_id")
    best = hits.agg(F.max(F.struct("score", "question_overlap", "answer_overlap")).alias("best"))
    return best.select(*keys, "item_id", "best.*")


def op7_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return find_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
