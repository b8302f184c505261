"""User-defined functions for SQL: scalar, aggregate and table functions over Arrow batches.

What built-in expressions can say is said by them; these are for what they can't.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Callable

import pandas as pd
from pyspark.sql import SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, StringType, StructType

from lectern.operators.chunking import section_packs, semantic_packs, seventy_cut
from lectern.operators.cleaners import without_consent

_MORE: dict[str, Callable] = {}


def _rows(number: str) -> StructType:
    return StructType().add("chunk_no", IntegerType()).add(number, IntegerType()).add("chunk", StringType())


@F.pandas_udf(StringType())
def nfkd(text: pd.Series) -> pd.Series:
    """Compatibility decomposition, which the JVM side has no function for."""
    return text.map(lambda s: None if s is None else unicodedata.normalize("NFKD", s))


@F.pandas_udf(StringType())
def consent_free(text: pd.Series) -> pd.Series:
    """Text without consent notices."""
    return text.map(without_consent)


@F.pandas_udf(DoubleType())
def geometric_mean(v: pd.Series) -> float:
    """Of the positive values of a group; null for none. Holds the group's column, so it is for groups of bounded size."""
    import numpy as np

    good = v[v > 0]
    return float(np.exp(np.log(good).mean())) if len(good) else None


@F.udtf(returnType=_rows("start"))
class SeventyChunks:
    """Rows (chunk_no, start, chunk) of a text by the seven-tenths rule."""

    def eval(self, text: str, size: int):
        for n, (a, c) in enumerate(seventy_cut(text or "", size)):
            yield n, a, c


@F.udtf(returnType=_rows("words"))
class SectionChunks:
    """Rows (chunk_no, words, chunk) of sentences, given as an array, packed towards a number of words."""

    def eval(self, sentences: list, target: int):
        for n, (w, c) in enumerate(section_packs(list(sentences or []), target)):
            yield n, w, c


@F.udtf(returnType=_rows("sentences"))
class SemanticChunks:
    """Rows (chunk_no, sentences, chunk) of sentences, given as an array, packed into so many characters."""

    def eval(self, sentences: list, size: int, overlap: int):
        for n, (w, c) in enumerate(semantic_packs(list(sentences or []), size, overlap)):
            yield n, w, c


def plug(name: str, function: Callable) -> None:
    """Add a function of one's own to those that :func:`register` makes known, by its name."""
    if name in _MORE:
        raise ValueError(f"{name} is taken")
    _MORE[name] = function


def register(spark: SparkSession) -> list[str]:
    """Make the functions known to SQL in a session; their names."""
    scalar = {"nfkd": nfkd, "consent_free": consent_free, "geometric_mean": geometric_mean}
    table = {"seventy_chunks": SeventyChunks, "section_chunks": SectionChunks, "semantic_chunks": SemanticChunks}
    for name, f in (scalar | _MORE).items():
        spark.udf.register(name, f)
    for name, f in table.items():
        spark.udtf.register(name, f)
    return sorted([*scalar, *table, *_MORE])
