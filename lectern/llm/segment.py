"""Problem 1: split oversized texts at natural boundaries by lexical cohesion.

A text is cut into units at line breaks and sentence ends. Words of a block of
units on either side of a gap are compared by the cosine of their hashed counts;
the depth of a gap is how far its similarity lies below the peaks around it. Each
piece ends at the deepest gap within the window of permitted lengths, and the next
piece begins up to ``overlap`` characters before that end, at a word or sentence
start.

Defined cases: null and empty texts, and texts of at most ``limit`` code points,
give one piece (none for null); units longer than a window are cut at white space,
else at ``limit``, never before a combining mark or joiner; equal depths take the
stronger and then the later boundary; a repeated row gives its pieces once, and of
different texts of one id the greatest gives all pieces; extra columns are ignored. Pieces cover every character of the text.
"""

from __future__ import annotations

import re
import unicodedata
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lectern.operators.dedup import one_per_key
from lectern.session import spread

LIMIT, OVERLAP = 4000, 200
#: Units on either side of a gap, hashed dimensions, and the least filling of a window.
BLOCK, DIMS, FILL = 6, 256, 0.5
#: Units whose counts are held at once.
STRIPE = 4096
#: What a boundary's kind adds to its depth: sentence end, line break, blank line.
KIND_BONUS = (0.0, 0.1, 0.25)

_GAP = re.compile(r"[ \t\r\xa0]*\n\s*|(?<=[.!?…。！？])[\"'”’»)\]]*\s+|(?<=[。！？])")
_WORD = re.compile(r"[^\W\d_]{4,}")
_SPACE = re.compile(r"\s+")
_JOINERS = "‍︎️"


def boundaries(text: str) -> tuple[list[int], list[int]]:
    """Offsets after each natural gap and the kind of each."""
    at, kind = [], []
    for m in _GAP.finditer(text):
        if 0 < m.end() < len(text):
            breaks = m.group().count("\n")
            at.append(m.end())
            kind.append(2 if breaks > 1 else breaks)
    return at, kind


def depths(text: str, at: list[int], block: int = BLOCK) -> np.ndarray:
    """Depth of the similarity valley at each boundary, in 0..2."""
    n = len(at) + 1
    if n < 3:
        return np.zeros(len(at))
    edges = [0, *at, len(text)]
    sims = np.zeros(n - 1)
    codes: dict[str, int] = {}
    for first in range(0, n, STRIPE):
        a, b = max(0, first - block), min(n, first + STRIPE + block)
        units, dims = [], []
        for u in range(a, b):
            for w in _WORD.findall(text[edges[u] : edges[u + 1]].lower()):
                c = codes.get(w)
                if c is None:
                    c = codes[w] = zlib.crc32(w.encode()) % DIMS
                units.append(u - a)
                dims.append(c)
        counts = np.bincount(np.asarray(units, dtype=np.int64) * DIMS + np.asarray(dims, dtype=np.int64), minlength=(b - a) * DIMS).reshape(b - a, DIMS)
        total = np.vstack([np.zeros((1, DIMS)), np.cumsum(counts, axis=0)])
        gaps = np.arange(max(first, 1), min(n, first + STRIPE))
        left = total[gaps - a] - total[np.maximum(gaps - block, a) - a]
        right = total[np.minimum(gaps + block, b) - a] - total[gaps - a]
        norm = np.sqrt((left**2).sum(1) * (right**2).sum(1))
        sims[gaps - 1] = (left * right).sum(1) / np.maximum(norm, 1e-9)
    padded = np.pad(sims, block, mode="edge")
    views = np.lib.stride_tricks.sliding_window_view(padded, block + 1)
    return (views[: len(sims)].max(1) - sims) + (views[block : block + len(sims)].max(1) - sims)


def _hard(text: str, lo: int, hi: int) -> int:
    """The last white space in text[lo:hi], else ``hi`` moved off combining marks."""
    found = None
    for found in _SPACE.finditer(text, lo, hi):  # noqa: B007
        pass
    if found is not None and found.end() > lo:
        return found.end()
    cut = hi
    while cut > lo + 1 and cut < len(text) and (unicodedata.combining(text[cut]) or text[cut] in _JOINERS or text[cut - 1] == "‍"):
        cut -= 1
    return cut if cut > lo + 1 else hi


def split(text: str, limit: int = LIMIT, overlap: int = OVERLAP) -> list[tuple[int, int, int]]:
    """(start, end, overlap) of each piece; end exclusive, overlap counted from start."""
    if len(text) <= limit:
        return [(0, len(text), 0)]
    at, kind = boundaries(text)
    score = depths(text, at) + np.asarray(KIND_BONUS)[kind] if at else np.zeros(0)
    offsets = np.asarray(at, dtype=np.int64)
    pieces, start, shared = [], 0, 0
    while True:
        if len(text) - start <= limit:
            pieces.append((start, len(text), shared))
            return pieces
        core = start + shared
        hi = start + limit
        lo = core + int((limit - shared) * FILL)
        a, b = np.searchsorted(offsets, [lo, hi + 1])
        if a == b:
            a = np.searchsorted(offsets, core + 1)
        if a < b:
            window = score[a:b]
            end = int(offsets[a + len(window) - 1 - int(np.argmax(window[::-1]))])
        else:
            end = _hard(text, max(core, lo), hi)
        pieces.append((start, end, shared))
        back = max(core + 1, end - overlap)
        i = np.searchsorted(offsets, back)
        if i < len(offsets) and offsets[i] < end:
            begin = int(offsets[i])
        else:
            m = _SPACE.search(text, back, end)
            begin = m.end() if m and m.end() < end else end if m else back
        start, shared = begin, end - begin


def pieces_of(texts: DataFrame, text: str = "cleaned_text", limit: int = LIMIT, overlap: int = OVERLAP, with_text: bool = True) -> DataFrame:
    """(id, piece_no, start, end, overlap, n_pieces[, piece]) of each oversized text."""
    schema = "id string, piece_no int, start int, end int, overlap int, n_pieces int" + ", piece string" * with_text

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for key, value in zip(batch["id"], batch["t"], strict=True):
                cut = split(value, limit, overlap)
                for n, (a, b, shared) in enumerate(cut):
                    rows.append((key, n, a, b, shared, len(cut), *([value[a:b]] * with_text)))
            yield pd.DataFrame(rows, columns=[c.split()[0] for c in schema.split(", ")])

    long = texts.select("id", F.col(text).alias("t")).where((F.length("t") > limit) & F.col("id").isNotNull())
    return spread(long).mapInPandas(run, schema)


def pieces(texts: DataFrame, text: str = "cleaned_text", limit: int = LIMIT, overlap: int = OVERLAP) -> DataFrame:
    """Pieces of every text: oversized ones cut, the others as one piece. Of several texts of one id the greatest is cut."""
    one = one_per_key(texts.select("id", text), "id")
    short = one.where(F.length(text) <= limit).select(
        "id", F.lit(0).alias("piece_no"), F.lit(0).alias("start"), F.length(text).alias("end"), F.lit(0).alias("overlap"), F.lit(1).alias("n_pieces"), F.col(text).alias("piece")
    )
    return pieces_of(one, text, limit, overlap).unionByName(short)


def oversized(texts: DataFrame, text: str = "cleaned_text", limit: int = LIMIT, overlap: int = OVERLAP) -> DataFrame:
    """Ids of the texts that came out of the splitter in more than one piece."""
    return pieces_of(texts, text, limit, overlap, with_text=False).where("n_pieces > 1").select("id").distinct()
