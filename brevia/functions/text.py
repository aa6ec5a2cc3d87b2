"""Cleaning and tokenising as Column expressions (no UDFs)."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from brevia.functions.stopwords import resolve

# Patterns and element names the results depend on.
TAG = r"<[^>]*>"
NON_WORD = r"[^\w\s]"
TOKEN = r"[^ \t\n\r\f]+"
CLEAN_TOKEN = r"[\w\x0B]+"
LETTER_RUN = r"[\p{L}_]+"
NON_LETTER = r"[^a-zA-Z]"
ATTRIBUTED_ELEMENTS = ("catchphrase",)
BARE_ELEMENTS = ("name", "AustLII")


def strip_tags(text: Column) -> Column:
    """Delete ``<...>``; nothing is put in its place, so ``foo<b>bar`` gives ``foobar``."""
    return F.regexp_replace(text, TAG, "")


def punct_to_space(text: Column) -> Column:
    """Each character outside the ASCII word and blank classes becomes one blank."""
    return F.regexp_replace(text, NON_WORD, " ")


def tokenize(text: Column) -> Column:
    """Split on space, tab, newline, return and form feed (not vertical tab)."""
    return F.regexp_extract_all(text, F.lit(TOKEN), 0)


def is_kept(token: Column, stop_words: Iterable[str] | None = None) -> Column:
    """Predicate on one token; the test ignores case, the token keeps its case."""
    words = resolve(stop_words)
    return ~F.lower(token).isin(*words) if words else F.lit(True)


def remove_stop_words(tokens: Column, stop_words: Iterable[str] | None = None) -> Column:
    words = resolve(stop_words)
    return F.filter(tokens, lambda t: is_kept(t, words)) if words else tokens


def clean_tokens(text: Column, stop_words: Iterable[str] | None = None) -> Column:
    """Tags out, other characters to blanks, tokens without stop words.

    What ``punct_to_space`` leaves between token delimiters is a run of word
    characters and vertical tabs, so those runs are extracted in one pass.
    """
    runs = F.regexp_extract_all(strip_tags(text), F.lit(CLEAN_TOKEN), 0)
    return remove_stop_words(runs, stop_words)


def clean_sentence(text: Column, stop_words: Iterable[str] | None = None) -> Column:
    return F.concat_ws(" ", clean_tokens(text, stop_words))


def drop_elements(
    text: Column,
    attributed: Sequence[str] = ATTRIBUTED_ELEMENTS,
    bare: Sequence[str] = BARE_ELEMENTS,
) -> Column:
    """Delete the named elements with their content and every other tag alone.

    ``attributed`` elements need a blank after their name, ``bare`` ones must have
    no attributes; content that crosses a line end is kept.
    """
    parts = [rf"<{e} [^>]*>.*?</{e}>" for e in attributed]
    parts += [rf"<{e}>.*?</{e}>" for e in bare]
    return F.regexp_replace(text, "|".join([*parts, r"<[^>]+>"]), "")


def letter_tokens(text: Column, stop_words: Iterable[str] | None = None) -> Column:
    """Lower-cased runs of Unicode letters or ``_`` without stop words."""
    runs = F.regexp_extract_all(text, F.lit(LETTER_RUN), 0)
    return remove_stop_words(F.transform(runs, F.lower), stop_words)


def letters_only(term: Column) -> Column:
    return F.regexp_replace(term, NON_LETTER, "")


def distinct_letter_terms(text: Column, stop_words: Iterable[str] | None = None) -> Column:
    """Distinct tokens of a line after every non-letter became a blank."""
    tokens = tokenize(F.regexp_replace(text, NON_LETTER, " "))
    return F.array_distinct(remove_stop_words(tokens, stop_words))


def round2(x: Column) -> Column:
    """Two decimals, half up on the binary product: 0.285 gives 0.28, unlike ``round``."""
    return F.floor(x * F.lit(100.0) + F.lit(0.5)).cast("double") / F.lit(100.0)
