"""Problem 9: evaluation texts inside a corpus, by latent semantic retrieval.

Passages of the corpus are compared with passages of the evaluation items in the
space of a randomised singular value decomposition of their TF-IDF matrix; what is
near is verified word by word: a run of consecutive words shared with the item, and
the longest common subsequence for paraphrases.

A run that a document shares with an item consists of words of the items only.
Hence passages are windows of the maximal runs of item vocabulary in a document, of
``WINDOW`` words every ``WINDOW - run + 1`` words, which puts every possible run of
``run`` words whole into some passage: nothing that can match is left out, and a
document without such a run of vocabulary yields no passage. The decomposition
costs two passes over those passages; each task returns sums over its passages,
added up per term by shuffle, so what reaches the driver is bounded by the item
vocabulary times the rank.

A paraphrase may put in words that no item has, so for paraphrases passages are also
cut over all words: the window of ``WINDOW`` words at every offset, if it can match an
item that shares no run with the document, having as many item words as the
subsequence needs and ``OWN_LEAST`` own words of that item. Words that no item has are
left out of such a passage, which changes no common subsequence. It is compared with
every run of ``run`` words of that item, whatever the cosine; the decomposition is
that of the other passages.

Defined cases: null and empty texts have no passage; items with fewer words than
``run`` have no run to share; repeated documents are each reported (by id, once);
repeated items likewise; without items or documents there are no rows; items beyond
``BLOCK_CHARS`` are taken in blocks, words counting as an item's own over all of them.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lectern.session import spread, stored

RUN, WINDOW, STEP = 13, 20, 8
RANK, OVERSAMPLE, POWER, SEED = 64, 16, 1, 20240229
#: Least cosine of a passage and an item window that are compared word by word.
NEAR = 0.3
#: Characters of item text that every task holds at once; more items are taken in blocks.
BLOCK_CHARS = 4_000_000
#: Item windows that a block of passages is compared with at once.
TARGETS = 16_384
#: Items that may share a word for it to count as one item's own, and the share and number of a window's own words that a paraphrase keeps.
OWN, OWN_SHARE, OWN_LEAST = 2, 0.5, 2
_WORD = re.compile(r"[^\W_]+")


def words(text: str | None) -> list[str]:
    """Maximal runs of letters and digits, in lower case."""
    return _WORD.findall(text.lower()) if text else []


class Items:
    """The evaluation items: vocabulary, windows, and the runs of each."""

    def __init__(self, rows: list[tuple[int, str]], run: int = RUN, window: int = WINDOW, step: int = STEP, common: frozenset[str] = frozenset()):
        """``common`` are words that more than ``OWN`` items hold, those of other blocks counted."""
        self.run = run
        self.ids = [i for i, _ in rows]
        self.vocabulary: dict[str, int] = {}
        self.texts = [np.asarray([self.vocabulary.setdefault(w, len(self.vocabulary)) for w in words(t)], dtype=np.int64) for _, t in rows]
        spans = [(n, a) for n, t in enumerate(self.texts) for a in window_starts(len(t), run, step)]
        self.owner = np.asarray([n for n, _ in spans], dtype=np.int64)
        self.windows = [self.texts[n][a : a + run] for n, a in spans]
        held = np.zeros(len(self.vocabulary), dtype=np.int64)
        for t in self.texts:
            held[np.unique(t)] += 1
        held[[n for w, n in self.vocabulary.items() if w in common]] = OWN + 1
        #: Of each word whether at most ``OWN`` items hold it, and those items (else -1).
        self.rare = held <= OWN
        self.holders = np.full((len(self.vocabulary), OWN), -1, dtype=np.int64)
        filled = np.zeros(len(self.vocabulary), dtype=np.int64)
        for n, t in enumerate(self.texts):
            own = np.unique(t[self.rare[t]])
            self.holders[own, filled[own]] = n
            filled[own] += 1
        #: Of each window the words that at most ``OWN`` items hold: what a paraphrase must keep.
        self.answers = [frozenset(w[held[w] <= OWN].tolist()) for w in self.windows]
        self.runs: dict[bytes, list[int]] = {}
        for n, t in enumerate(self.texts):
            for a in range(len(t) - run + 1):
                owners = self.runs.setdefault(t[a : a + run].astype(np.int32).tobytes(), [])
                if n not in owners:
                    owners.append(n)

    def kept(self, n: int, part: np.ndarray, least: float) -> list[tuple[int, int]]:
        """(start, common subsequence) of each run of item ``n`` that ``part`` paraphrases."""
        text, held, out = self.texts[n], set(part.tolist()), []
        size = min(self.run, len(text))
        own = self.rare[text]
        shared = np.fromiter((x in held for x in text.tolist()), dtype=bool, count=len(text))
        for a in np.flatnonzero(np.convolve(shared, np.ones(size, dtype=np.int64), "valid") >= least):
            span = slice(a, a + size)
            both = len(set(text[span][own[span] & shared[span]].tolist()))
            if both >= OWN_LEAST and both >= OWN_SHARE * len(set(text[span][own[span]].tolist())):
                common = common_subsequence(part, text[span])
                if common >= least:
                    out.append((int(a), common))
        return out


def window_starts(n: int, size: int, step: int) -> list[int]:
    """Starts of windows of ``size`` that cover 0..n, the last one flush with the end."""
    if n <= size:
        return [0] if n else []
    starts = list(range(0, n - size + 1, step))
    return starts if starts[-1] == n - size else [*starts, n - size]


def _rows(passages: list[np.ndarray], idf: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows, terms and unit-length TF-IDF weights of passages, as triples."""
    lengths = np.asarray([len(p) for p in passages], dtype=np.int64)
    if not lengths.sum():
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
    row = np.repeat(np.arange(len(passages)), lengths)
    key, n = np.unique(row * len(idf) + np.concatenate(passages), return_counts=True)
    row, term = key // len(idf), key % len(idf)
    value = n * idf[term]
    norm = np.sqrt(np.bincount(row, value**2, minlength=len(passages)))
    return row, term, value / np.maximum(norm[row], 1e-12)


def _times(rows: int, row: np.ndarray, term: np.ndarray, value: np.ndarray, right: np.ndarray) -> np.ndarray:
    """The sparse matrix of the triples (sorted by row) times ``right``."""
    out = np.zeros((rows, right.shape[1]))
    if len(row):
        firsts = np.flatnonzero(np.r_[True, row[1:] != row[:-1]])
        out[row[firsts]] = np.add.reduceat(right[term] * value[:, None], firsts, axis=0)
    return out


def _gram(passages: list[np.ndarray], idf: np.ndarray, right: np.ndarray, block: int = 2048) -> np.ndarray:
    """A' A right, over blocks of passages."""
    total = np.zeros((len(idf), right.shape[1]))
    for a in range(0, len(passages), block):
        part = passages[a : a + block]
        row, term, value = _rows(part, idf)
        left = _times(len(part), row, term, value, right)
        order = np.argsort(term, kind="stable")
        total += _times(len(idf), term[order], row[order], value[order], left)
    return total


def paraphrase_windows(codes: np.ndarray, items: Items, least: int, window: int = WINDOW) -> Iterator[tuple[np.ndarray, list[int]]]:
    """Each window of ``codes`` (-1: in no item) that may paraphrase items, without the -1, and those items."""
    at = np.flatnonzero(codes >= 0)
    if len(at) < least:
        return
    holders = items.holders[codes[at]]
    at, column = np.repeat(at, holders.shape[1])[holders.ravel() >= 0], holders.ravel()[holders.ravel() >= 0]
    order = np.lexsort((at, column))
    where, item, word = at[order], column[order], codes[at[order]]
    # where a window holds two own words of an item, two that follow each other differ
    pair = np.flatnonzero((item[1:] == item[:-1]) & (word[1:] != word[:-1]) & (where[1:] - where[:-1] < window))
    if not len(pair):
        return
    narrow, n = codes.astype(np.int32), items.run
    told = {k for a in range(len(codes) - n + 1) for k in items.runs.get(narrow[a : a + n].tobytes(), ())}
    starts = max(len(codes) - window, 0) + 1
    may: dict[int, set[int]] = {}
    for a, b, k in zip(where[pair].tolist(), where[pair + 1].tolist(), item[pair].tolist(), strict=True):
        if k not in told:
            for s in range(max(b - window + 1, 0), min(a + 1, starts)):
                may.setdefault(s, set()).add(k)
    last = None
    for s in sorted(may):
        part = codes[s : s + window]
        part = part[part >= 0]
        now = (part.tobytes(), sorted(may[s]))
        if len(part) >= least and now != last:
            yield part, now[1]
        last = now


def passages_of(docs: DataFrame, items: Items, run: int = RUN, window: int = WINDOW, step: int = STEP, least: int = 0) -> DataFrame:
    """(doc_id, terms, may) of each window of a maximal run of item vocabulary, with null ``may``, and, for paraphrases of ``least`` words, of each window of all words, with the items it may paraphrase."""
    shared = docs.sparkSession.sparkContext.broadcast(items if least else items.vocabulary)

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known = shared.value.vocabulary if least else shared.value
        for batch in batches:
            ids, terms, may = [], [], []
            for key, text in zip(batch["doc_id"], batch["text"], strict=True):
                found = _WORD.findall(text.lower())
                if len(found) < (min(run, least) if least else run):
                    continue
                codes = np.fromiter(map(known.get, found, _minus), dtype=np.int32, count=len(found))
                other = np.flatnonzero(codes < 0)
                edges = np.r_[-1, other, len(codes)]
                for a in np.flatnonzero(np.diff(edges) > run):
                    part = codes[edges[a] + 1 : edges[a + 1]]
                    for s in window_starts(len(part), window, step):
                        ids.append(key)
                        terms.append(part[s : s + window])
                        may.append(None)
                for part, of in paraphrase_windows(codes, shared.value, least, window) if least else ():
                    ids.append(key)
                    terms.append(part)
                    may.append(of)
            if ids:
                yield pd.DataFrame({"doc_id": ids, "terms": terms, "may": may})

    kind = docs.schema["doc_id"].dataType.simpleString()
    return spread(docs.where("text is not null and doc_id is not null").select("doc_id", "text")).mapInPandas(cut, f"doc_id {kind}, terms array<int>, may array<int>")


class _Minus:
    """An endless -1, the default of each lookup."""

    def __iter__(self):
        return self

    def __next__(self):
        return -1


_minus = _Minus()


def inverse_frequencies(passages: DataFrame, items: Items) -> np.ndarray:
    """Smoothed IDF of each item word over all passages and item windows."""
    n = passages.count() + len(items.windows)
    df = np.zeros(len(items.vocabulary))
    for r in passages.select(F.explode(F.array_distinct("terms")).alias("t")).groupBy("t").agg(F.count("*").alias("n")).collect():  # at most one row a word of the items
        df[r.t] = r.n
    for w in items.windows:
        df[np.unique(w)] += 1
    return np.log((1.0 + n) / (1.0 + df)) + 0.1


def latent_basis(passages: DataFrame, items: Items, idf: np.ndarray, rank: int = RANK, power: int = POWER) -> np.ndarray:
    """Orthonormal basis (vocabulary x rank) of the leading right singular space."""
    size = len(idf)
    k = min(rank + OVERSAMPLE, size)
    basis = np.linalg.qr(np.random.default_rng(SEED).standard_normal((size, k)))[0]
    for _ in range(power + 1):
        right = passages.sparkSession.sparkContext.broadcast(basis)

        def sums(batches: Iterator[pd.DataFrame], right=right) -> Iterator[pd.DataFrame]:
            total = np.zeros((size, k))
            for batch in batches:
                total += _gram(list(batch["terms"]), idf, right.value)
            used = np.flatnonzero(total.any(1))
            if len(used):
                yield pd.DataFrame({"term": used, "part": list(total[used])})

        added = passages.select("terms").mapInPandas(sums, "term bigint, part array<double>")
        total = np.zeros((size, k))
        rows = added.select("term", F.posexplode("part").alias("j", "v")).groupBy("term", "j").agg(F.sum("v").alias("v")).groupBy("term").agg(F.sort_array(F.collect_list(F.struct("j", "v"))).alias("c"))
        for r in rows.select("term", "c.v").collect():  # vocabulary x rank numbers, however many passages
            total[r.term] = r.v
        total += _gram(items.windows, idf, basis)
        basis, inner = np.linalg.qr(total)
    u, _, _ = np.linalg.svd(inner)
    return (basis @ u)[:, :rank]


def common_subsequence(a: np.ndarray, b: np.ndarray) -> int:
    """Length of the longest common subsequence of two short sequences."""
    best = np.zeros(len(b) + 1, dtype=np.int64)
    for x in a:
        prev = best.copy()
        hit = b == x
        for j in range(1, len(b) + 1):
            best[j] = prev[j - 1] + 1 if hit[j - 1] else max(prev[j], best[j - 1])
    return int(best[-1])


def leaks(docs: DataFrame, items_df: DataFrame, run: int = RUN, near: float = NEAR, rank: int = RANK, paraphrases: bool = False, least_lcs: float = 0.7) -> DataFrame:
    """(doc_id, item_id, cosine, longest_run_hits, lcs_share) of each document and item that leaked into it.

    Without ``paraphrases`` a pair needs a shared run of ``run`` words; with it, pairs
    come too, with no run counted, of which ``WINDOW`` words of the document and ``run``
    of the item share a subsequence of ``least_lcs`` of the latter and enough of its own
    words.
    """
    stated = items_df.where("item_text is not null and item_id is not null").select(F.col("item_id").cast("bigint"), "item_text").distinct()
    chars = stated.agg(F.sum(F.length("item_text").cast("bigint"))).first()[0] or 0
    blocks = 1 + chars // BLOCK_CHARS
    common = None
    if blocks > 1:
        stated = stored(stated.withColumn("_words", F.array_distinct(F.regexp_extract_all(F.lower("item_text"), F.lit(r"([\p{L}\p{N}]+)"), 1))), "p9-items")
        common = stored(stated.select("item_id", F.explode("_words").alias("w")).groupBy("w").agg(F.countDistinct("item_id").alias("n")).where(F.col("n") > OWN).select("w"), "p9-common")
    found = None
    for b in range(blocks):
        block = stated.where(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == b)
        words_of = frozenset() if common is None else frozenset(r.w for r in block.select(F.explode("_words").alias("w")).distinct().join(common, "w").collect())  # words of one block
        items = Items(sorted((r.item_id, r.item_text) for r in block.select("item_id", "item_text").collect()), run, common=words_of)  # a stated query set, a block of it
        part = _leaks_of_block(docs, items, run, near, rank, paraphrases, least_lcs)
        found = part if found is None else found.unionByName(part)
    return found


def _leaks_of_block(docs: DataFrame, items: Items, run: int, near: float, rank: int, paraphrases: bool, least_lcs: float) -> DataFrame:
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, item_id bigint, cosine double, run_hits bigint, lcs_share double"
    if not items.windows:
        return docs.sparkSession.createDataFrame([], schema)
    least = max(1, math.ceil(least_lcs * run - 1e-9)) if paraphrases else 0
    cut = stored(passages_of(docs, items, run, least=least), "p9-passages")
    passages = cut.where("may is null").drop("may")
    idf = inverse_frequencies(passages, items)
    basis = latent_basis(passages, items, idf, rank)

    def unit(z: np.ndarray) -> np.ndarray:
        return z / np.maximum(np.sqrt((z**2).sum(1, keepdims=True)), 1e-12)

    row, term, value = _rows(items.windows, idf)
    targets = unit(_times(len(items.windows), row, term, value, basis)).astype(np.float32)
    shared = docs.sparkSession.sparkContext.broadcast((items, idf, basis, targets))

    def search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        items, idf, basis, targets = shared.value
        for batch in batches:
            out = []
            for a in range(0, len(batch), 1024):
                part = [np.asarray(t, dtype=np.int64) for t in batch["terms"].iloc[a : a + 1024]]
                ids = batch["doc_id"].iloc[a : a + 1024].to_numpy()
                row, term, value = _rows(part, idf)
                z = unit(_times(len(part), row, term, value, basis)).astype(np.float32)
                near_ones = []
                for t in range(0, len(targets), TARGETS):
                    cosine = z @ targets[t : t + TARGETS].T
                    which, window = np.nonzero(cosine >= near)
                    near_ones.append((which, window + t, cosine[which, window]))
                which, window, value = (np.concatenate(x) for x in zip(*near_ones, strict=True))
                if not len(which):
                    continue
                pair = pd.DataFrame({"p": which, "item": items.owner[window], "w": window, "c": value})
                best = pair.loc[pair.groupby(["p", "item"], sort=False)["c"].idxmax()]
                owners = {}
                for p in best["p"].unique():
                    hits: dict[int, int] = {}
                    narrow = part[p].astype(np.int32)
                    for s in range(len(narrow) - run + 1):
                        for n in items.runs.get(narrow[s : s + run].tobytes(), ()):
                            hits[n] = hits.get(n, 0) + 1
                    owners[p] = hits
                for p, n, w, c in best.itertuples(index=False):
                    hits = owners[p].get(n, 0)
                    if not hits:
                        own = items.answers[w]
                        kept = len(own.intersection(part[p].tolist()))
                        if not paraphrases or kept < OWN_LEAST or kept < OWN_SHARE * len(own):
                            continue
                    share = common_subsequence(part[p], items.windows[w]) / run
                    if hits or share >= least_lcs:
                        out.append((ids[p], items.ids[n], float(c), hits, share))
            yield pd.DataFrame(out, columns=["doc_id", "item_id", "cosine", "run_hits", "lcs_share"])

    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        items, idf, basis, _ = shared.value
        for batch in batches:
            out = []
            for key, terms, may in zip(batch["doc_id"], batch["terms"], batch["may"], strict=True):
                part = np.asarray(terms, dtype=np.int64)
                for n in may:
                    for a, common in items.kept(n, part, least):
                        row, term, value = _rows([part, items.texts[n][a : a + run]], idf)
                        z = unit(_times(2, row, term, value, basis))
                        out.append((key, items.ids[n], float(z[0] @ z[1]), 0, common / run))
            yield pd.DataFrame(out, columns=["doc_id", "item_id", "cosine", "run_hits", "lcs_share"])

    found = passages.mapInPandas(search, schema)
    if paraphrases:
        found = found.unionByName(cut.where("may is not null").mapInPandas(compare, schema))
    return found.groupBy("doc_id", "item_id").agg(F.max("cosine").alias("cosine"), F.sum("run_hits").alias("run_hits"), F.max("lcs_share").alias("lcs_share"))
