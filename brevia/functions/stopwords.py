"""Stop words are a parameter of every text operator.

The list a corpus should be cleaned with is data, not code: pass any sequence of
words as ``stop_words=`` or read one from a file with :func:`load_stop_words`.
When nothing is passed, the English list that ships with Spark ML is used. The
tokeniser turns apostrophes into blanks, so each Spark entry is tokenised the same
way ("don't" becomes "don" and "t").
"""

from __future__ import annotations

import glob
import os
import re
import zipfile
from collections.abc import Iterable
from functools import lru_cache

import pyspark
from pyspark.sql import SparkSession

_SPARK_RESOURCE = "org/apache/spark/ml/feature/stopwords/{}.txt"


def _spark_ml_words(language: str) -> list[str]:
    """The Spark ML stop-word resource, read without needing a running session."""
    home = os.path.dirname(pyspark.__file__)
    for jar in glob.glob(os.path.join(home, "jars", "spark-mllib_*.jar")):
        with zipfile.ZipFile(jar) as z:
            return z.read(_SPARK_RESOURCE.format(language)).decode("utf-8").split("\n")
    from pyspark.ml.feature import StopWordsRemover

    return StopWordsRemover.loadDefaultStopWords(language)


@lru_cache(maxsize=None)
def default_stop_words(language: str = "english") -> tuple[str, ...]:
    tokens: set[str] = set()
    for word in _spark_ml_words(language):
        tokens.update(re.findall(r"\w+", word.lower(), flags=re.ASCII))
    return tuple(sorted(tokens))


def load_stop_words(spark: SparkSession, path: str) -> tuple[str, ...]:
    """A list with one word per line."""
    return resolve(row.value.strip() for row in spark.read.text(path).collect())


def resolve(stop_words: Iterable[str] | None) -> tuple[str, ...]:
    """Lower-cased, distinct, sorted words; ``None`` means the default list."""
    if stop_words is None:
        return default_stop_words()
    return tuple(sorted({w.lower() for w in stop_words if w}))
