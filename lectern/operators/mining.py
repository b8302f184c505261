"""Phrases, concept pairs, clusters and topics."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lectern.functions import text as T
from lectern.session import dropped, stored

_WORDS = re.compile(r"[a-z0-9]+(?:'[a-z]+)?")

#: Different words that topics are made of at most, the most frequent ones; a million holds those of any language.
VOCABULARY = 1 << 20
#: Words of five letters, digits or underscores and more; runs of fewer have no match.
LONG_WORD = T.WORD.removesuffix("+") + "{5,}"
#: Words that a batch of factors or sums holds, and of documents that are solved at once.
PART = 1 << 16


def phrases(docs: DataFrame, id_col: str = "doc_id", text: str = "text", n: int = 2, least_docs: int = 3) -> DataFrame:
    """(phrase, docs, hits, weight) of runs of ``n`` words of four letters and more, by hits x log inverse frequency."""
    words = F.filter(T.tokens(F.col(text)), lambda w: F.length(w) >= 4)
    grams = docs.where(F.col(text).isNotNull()).select(F.col(id_col).alias("d"), F.explode(T.ngrams(words, n)).alias("phrase"))
    counted = grams.groupBy("phrase", "d").agg(F.count("*").alias("h")).groupBy("phrase").agg(F.count("*").alias("docs"), F.sum("h").alias("hits")).where(F.col("docs") >= least_docs)
    total = docs.count()
    return counted.select("phrase", "docs", "hits", F.round(F.col("hits") * F.log((F.lit(total) + 1.0) / (F.col("docs") + 1.0)), 4).alias("weight"))


def concept_pairs(docs: DataFrame, concepts: list[str], id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """(a, b, docs) of concepts, a < b, that stand in one text.

    The concepts are a stated list, so a text forms at most that many pairs squared.
    """
    low = F.lower(F.col(text))
    found = F.array_sort(F.array_compact(F.array(*[F.when(low.contains(c), F.lit(c)) for c in concepts])))
    held = docs.where(F.col(text).isNotNull()).select(found.alias("c")).where("size(c) > 1")
    pairs = F.flatten(F.transform("c", lambda a, i: F.transform(F.slice("c", i + 2, F.size("c")), lambda b: F.struct(a.alias("a"), b.alias("b")))))
    return held.select(F.explode(pairs).alias("p")).groupBy("p.a", "p.b").agg(F.count("*").alias("docs"))


def _counted(docs: DataFrame, id_col: str, text: str, vocabulary: int):
    from pyspark.ml.feature import IDF, CountVectorizer

    words = F.filter(T.tokens(F.coalesce(F.col(text), F.lit(""))), lambda w: F.length(w) >= 5)
    rows = docs.select(F.col(id_col), words.alias("words"))
    counter = CountVectorizer(inputCol="words", outputCol="counts", vocabSize=vocabulary, minDF=2).fit(rows)
    counted = counter.transform(rows)
    return counter.vocabulary, counted, IDF(inputCol="counts", outputCol="tfidf").fit(counted).transform(counted)


def _read(files: list[str]) -> Iterator[pa.RecordBatch]:
    """The rows of parquet files in the shared folder, a batch at a time: a worker reads there what is too large to pass through the driver."""
    for f in files:
        system, at = pafs.FileSystem.from_uri(f)
        with system.open_input_file(at) as opened:
            yield from pq.ParquetFile(opened).iter_batches()


#: The factors that a worker has, and the shape, seed and steps that led to them.
_HELD: list[tuple] = []


def _factors(shape: tuple[int, int], seed: int, steps: list[tuple[list[str], np.ndarray]]) -> np.ndarray:
    """The topics' weights of each word, v x k, after ``steps``, each with its files of sums and its k x k products.

    A worker goes on from the factors that it has; one that has none, or others, takes all steps.
    """
    names = [files for files, _ in steps]
    held, _HELD[:] = _HELD[:], []  # nothing is held if a step fails
    h, done = next(((h, done) for h, done, *of in held if of == [shape, seed] and done == names[: len(done)]), (None, []))
    held = None
    if h is None:
        rnd, h = np.random.default_rng(seed), np.empty(shape)
        for t in range(shape[1]):
            h[:, t] = rnd.random(shape[0]) + 0.1
    for files, gram in steps[len(done) :]:
        moved = np.zeros(shape)  # a word without sums has no weight any more
        for b in _read(files):
            j = b.column("j").to_numpy()
            s, told = np.array([b.column(f"s{t}").to_numpy() for t in range(shape[1])]).T[j >= 0], j[j >= 0]
            moved[told] = h[told] * (s / np.maximum(h[told] @ gram, 1e-9))
        h = moved
        pa.default_memory_pool().release_unused()
    _HELD.append((h, names, shape, seed))
    return h


def _vocabulary(words: DataFrame, most: int) -> DataFrame:
    """(i, w, df) of the words of two documents and more, numbered with the most common first, in a table."""
    common = words.select(F.explode(F.array_distinct("words")).alias("w")).groupBy("w").agg(F.count("*").alias("df")).where("df >= 2").orderBy(F.col("df").desc(), "w").limit(most)
    place = F.row_number().over(Window.orderBy(F.col("df").desc(), "w"))  # at most the vocabulary, in one task
    return stored(common.select((place - 1).alias("i"), "w", "df"), "nmf-words")


def _entries(words: DataFrame, known: DataFrame, v: int) -> DataFrame:
    """(i, x) of each document with words of the vocabulary: their places in it and their TF-IDF."""
    total, files = words.count(), known.inputFiles()

    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(_read(files)).sort_by("i")
        named, idf = table["w"].combine_chunks(), np.log((total + 1) / (table["df"].to_numpy() + 1))
        for b in batches:
            lists = b.column(0)
            at = pc.fill_null(pc.index_in(lists.flatten().cast(named.type), value_set=named), -1).to_numpy()
            row = np.repeat(np.arange(len(lists)), pc.list_value_length(lists).to_numpy())
            pairs, n = np.unique((row * v + at)[at >= 0], return_counts=True)
            row, i = np.divmod(pairs, v)
            starts = np.r_[np.flatnonzero(np.diff(row, prepend=-1)), len(row)].astype(np.int32)
            yield pa.RecordBatch.from_arrays([pa.ListArray.from_arrays(starts, pa.array(i.astype(np.int32))), pa.ListArray.from_arrays(starts, pa.array(n * idf[i]))], ["i", "x"])
        pa.default_memory_pool().release_unused()  # the worker stays, and needs it for the factors

    return stored(words.mapInArrow(listed, "i array<int>, x array<double>"), "nmf")


def kmeans_topics(docs: DataFrame, k: int = 8, id_col: str = "doc_id", text: str = "text", vocabulary: int = VOCABULARY, seed: int = 42) -> DataFrame:
    """(doc_id, cluster) by k-means on normalised TF-IDF."""
    from pyspark.ml.clustering import KMeans
    from pyspark.ml.feature import Normalizer

    _, _, weighted = _counted(docs, id_col, text, vocabulary)
    unit = Normalizer(inputCol="tfidf", outputCol="features").transform(weighted)
    model = KMeans(k=k, seed=seed, maxIter=10, featuresCol="features", predictionCol="cluster").fit(unit)
    return model.transform(unit).select(id_col, "cluster")


def lda_topics(docs: DataFrame, k: int = 8, top: int = 8, id_col: str = "doc_id", text: str = "text", vocabulary: int = VOCABULARY, seed: int = 42) -> DataFrame:
    """(topic, place, word, weight) of the words that mark each topic."""
    from pyspark.ml.clustering import LDA

    words, counted, _ = _counted(docs, id_col, text, vocabulary)
    model = LDA(k=k, seed=seed, maxIter=8, featuresCol="counts", optimizer="online").fit(counted)
    named = F.array(*[F.lit(w) for w in words])
    flat = model.describeTopics(top).select("topic", F.posexplode(F.arrays_zip("termIndices", "termWeights")).alias("place", "t"))
    return flat.select("topic", "place", F.element_at(named, F.col("t.termIndices") + 1).alias("word"), F.round("t.termWeights", 6).alias("weight"))


def nmf_topics(docs: DataFrame, k: int = 8, top: int = 8, rounds: int = 12, id_col: str = "doc_id", text: str = "text", vocabulary: int = VOCABULARY, seed: int = 42) -> DataFrame:
    """(topic, place, word, weight) by non-negative factors of TF-IDF; each row is a document.

    Multiplicative updates: each task keeps the rows of W of its documents implicit by
    solving them anew, and gives the sums of its words. Vocabulary and sums are tables in
    the shared folder, where tasks read them and move their factors by them; only numbers
    of the size k x k reach the driver. A task holds factors and sums, vocabulary x k each.
    """
    spark = docs.sparkSession
    words = stored(docs.select(F.regexp_extract_all(F.lower(F.coalesce(F.col(text), F.lit(""))), F.lit(LONG_WORD), 0).alias("words")), "nmf-texts")
    known = _vocabulary(words, vocabulary)
    v = known.count()
    if not v:
        return spark.createDataFrame([], "topic int, place int, word string, weight double")
    rows = _entries(words, known, v).coalesce(spark.sparkContext.defaultParallelism)  # each task gives a row for each of its words
    dropped(words)
    hs, ss = [f"h{t}" for t in range(k)], [f"s{t}" for t in range(k)]
    steps: list[tuple[list[str], np.ndarray]] = []
    tables = []
    for _ in range(rounds):

        def sums(batches: Iterator[pa.RecordBatch], steps=tuple(steps)) -> Iterator[pa.RecordBatch]:
            h = _factors((v, k), seed, steps)
            hh = h.T @ h
            up, gram = np.zeros(v * k), np.zeros((k, k))
            for b in batches:
                ends = b.column(0).offsets.to_numpy() - b.column(0).offsets[0].as_py()
                all_i, all_x = b.column(0).flatten().to_numpy(), b.column(1).flatten().to_numpy()
                a = 0
                while a < len(b):  # as many documents as have so many words
                    z = max(a + 1, int(np.searchsorted(ends, ends[a] + PART, "right")) - 1)
                    i, x = all_i[ends[a] : ends[z]], all_x[ends[a] : ends[z], None]
                    xh = np.add.reduceat(h[i] * x, ends[a:z] - ends[a])
                    w = np.full((z - a, k), 0.5)
                    for _ in range(8):
                        w *= xh / np.maximum(w @ hh, 1e-9)
                    np.add.at(up, (i.astype(np.int64)[:, None] * k + np.arange(k)).ravel(), (np.repeat(w, np.diff(ends[a : z + 1]), axis=0) * x).ravel())
                    gram += w.T @ w
                    a = z
            up = up.reshape(v, k)
            used = np.flatnonzero(up.any(1)).astype(np.int32)
            for a in range(0, len(used), PART):
                j = used[a : a + PART]
                yield pa.RecordBatch.from_arrays([pa.array(j), *map(pa.array, up[j].T.copy())], ["j", *ss])
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(-k, 0, dtype=np.int32)), *map(pa.array, gram)], ["j", *ss])  # below the words

        added = rows.mapInArrow(sums, ", ".join(["j int", *[f"{c} double" for c in ss]])).groupBy("j").agg(*[F.sum(c).alias(c) for c in ss])
        tables.append(stored(added, "nmf-sums"))
        steps.append((sorted(tables[-1].inputFiles()), np.array([r[1:] for r in sorted(tables[-1].where("j < 0").collect())])))  # k x k

    def last(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _ in batches:
            h = _factors((v, k), seed, steps)
            for a in range(0, v, PART):
                part = h[a : a + PART]
                yield pa.RecordBatch.from_arrays([pa.array(np.arange(a, a + len(part), dtype=np.int32)), *map(pa.array, part.T.copy())], ["j", *hs])

    factors = stored(spark.range(1).coalesce(1).mapInArrow(last, ", ".join(["j int", *[f"{c} double" for c in hs]])), "nmf-factors")
    for table in tables:
        dropped(table)
    weights = factors.select("j", F.posexplode(F.array(*hs)).alias("topic", "h"))
    falling = F.round(F.log("h"), 9).desc()  # words that always stand together differ in the last digits only, by the order of sums
    tops = weights.withColumn("n", F.row_number().over(Window.partitionBy("topic").orderBy(falling, "j"))).where(F.col("n") <= top)
    return known.join(F.broadcast(tops), known["i"] == tops["j"]).select("topic", (F.col("n") - 1).alias("place"), F.col("w").alias("word"), F.round("h", 6).alias("weight"))


# ---------------------------------------------------------------- topics in words

# Words that no topic begins or ends with.
TOPIC_STOPWORDS = frozenset("a an and are as at be but by for from if in into is it its of on or the to was were will with".split())


def viable_phrase(phrase: str | None) -> bool:
    """Whether a phrase may be a topic: two different words or more, no number, no stop word at an end."""
    words = _WORDS.findall((phrase or "").lower())
    return len(words) >= 2 and len(set(words)) >= 2 and not any(w.isdigit() for w in words) and words[0] not in TOPIC_STOPWORDS and words[-1] not in TOPIC_STOPWORDS


def composed_topic(terms: list[str], most: int = 3) -> str:
    """A topic of at most ``most`` terms, longer ones first, none within another: "a", "a and b", "a, b, and c"."""
    kept: list[str] = []
    sets: list[frozenset[str]] = []
    for term in sorted(terms, key=lambda t: -len(_WORDS.findall(t.lower()))):
        words = list(dict.fromkeys(w for w in _WORDS.findall(term.lower()) if w not in TOPIC_STOPWORDS))
        if not words or any(frozenset(words[:2]) <= s or frozenset(words) <= s for s in sets):
            continue
        kept.append(f"{words[0]} and {words[1]}" if " and " in term.lower() and len(words) >= 2 else " ".join(words[:2]))
        sets.append(frozenset(words))
        if len(kept) == most:
            break
    return kept[0] if len(kept) == 1 else " and ".join(kept) if len(kept) == 2 else ", ".join(kept[:-1]) + f", and {kept[-1]}" if kept else ""


def chosen_topic(rows: DataFrame, *candidates: str, fallback: str = "recent work") -> DataFrame:
    """``rows`` with ``topic``: the first of the columns that is a viable phrase, else the first that isn't blank, else the fallback, and ``topic_from``."""
    import pyspark.sql.types as t

    @F.pandas_udf(t.BooleanType())
    def viable(s: pd.Series) -> pd.Series:
        return s.map(viable_phrase)

    out = rows
    for c in candidates:
        out = out.withColumn(f"_v_{c}", viable(F.coalesce(c, F.lit(""))))
    good = F.coalesce(*[F.when(F.col(f"_v_{c}"), F.struct(F.col(c).alias("t"), F.lit(c).alias("f"))) for c in candidates], *[F.when(F.trim(F.coalesce(c, F.lit(""))) != "", F.struct(F.col(c).alias("t"), F.lit(c).alias("f"))) for c in candidates], F.struct(F.lit(fallback).alias("t"), F.lit("fallback").alias("f")))
    return out.withColumn("_g", good).withColumn("topic", F.col("_g.t")).withColumn("topic_from", F.col("_g.f")).drop("_g", *[f"_v_{c}" for c in candidates])
