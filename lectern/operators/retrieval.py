"""Ranking by vectors and by words."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lectern.functions import text as T


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def norm(a: Column) -> Column:
    return F.sqrt(dot(a, a))


def valid_vector(a: Column, size: int) -> Column:
    """Right size, no nulls, not all zero."""
    return F.coalesce((F.size(a) == size) & ~F.exists(a, lambda x: x.isNull()) & F.exists(a, lambda x: x != 0), F.lit(False))


def cosine_top_k(vectors: DataFrame, queries: DataFrame, k: int, id_col: str = "vec_id", vector: str = "embedding", size: int = 64, same: str | None = None) -> DataFrame:
    """(query_id, vec_id, score, place) of the ``k`` nearest vectors of each stated query; with ``same`` only of those that equal the query in that column.

    The query set is stated and small; its size is checked before it is broadcast
    against all vectors. Each task keeps its own ``k`` best of a query, so the shuffle
    holds k x tasks rows a query. A vector is not its own neighbour; ties go to the
    lower id; invalid vectors are left out.
    """
    n = queries.count()
    if n * size * 8 > 64 * 1024 * 1024:
        raise ValueError("too many queries for one call; pass them in blocks")
    mark = F.col(same) if same else F.lit(0)
    good = vectors.where(valid_vector(F.col(vector), size)).select(id_col, vector, norm(F.col(vector)).alias("_n"), mark.alias("_s"))
    asked = queries.where(valid_vector(F.col(vector), size)).select(F.col(id_col).alias("query_id"), F.col(vector).alias("_q"), norm(F.col(vector)).alias("_qn"), mark.alias("_t"))
    scored = good.join(F.broadcast(asked), (F.col("_s") == F.col("_t")) & (F.col(id_col) != F.col("query_id"))).select("query_id", id_col, F.round(dot(F.col(vector), F.col("_q")) / (F.col("_n") * F.col("_qn")), 6).alias("score"))
    local = scored.withColumn("_task", F.spark_partition_id())
    order = [F.col("score").desc(), F.col(id_col)]
    kept = local.withColumn("_p", F.row_number().over(Window.partitionBy("query_id", "_task").orderBy(*order))).where(F.col("_p") <= k)
    return kept.withColumn("place", F.row_number().over(Window.partitionBy("query_id").orderBy(*order))).where(F.col("place") <= k).select("query_id", id_col, "score", "place")


def overlap_top(texts: DataFrame, sources: DataFrame, id_col: str, source_id: str, text: str, source_text: str, k: int = 3, least_hits: int = 6, least_share: float = 0.12, least_chars: int = 5) -> DataFrame:
    """The ``k`` sources that share the most words with each text.

    score = 0.75 hits / words of the text + 0.25 hits / words of the source; pairs below
    both thresholds are dropped. Inverted index over distinct words, so only pairs that
    share a word are formed; words of fewer than ``least_chars`` letters don't count.
    """

    def index(df: DataFrame, key: str, col: str) -> DataFrame:
        words = F.array_distinct(F.filter(T.tokens(F.col(col)), lambda w: F.length(w) >= least_chars))
        return df.where(F.col(col).isNotNull()).select(F.col(key), words.alias("ws")).select(key, F.size("ws").alias("n"), F.explode("ws").alias("w"))

    a, b = index(texts, id_col, text), index(sources, source_id, source_text).withColumnRenamed("n", "m")
    hits = a.join(b, "w").groupBy(id_col, source_id).agg(F.count("*").alias("hits"), F.first("n").alias("n"), F.first("m").alias("m"))
    share = F.col("hits") / F.col("n")
    kept = hits.where((F.col("hits") >= least_hits) | (share >= least_share)).withColumn("score", F.round(0.75 * share + 0.25 * F.col("hits") / F.col("m"), 6))
    w = Window.partitionBy(id_col).orderBy(F.col("score").desc(), F.col("hits").desc(), source_id)
    return kept.withColumn("place", F.row_number().over(w)).where(F.col("place") <= k).select(id_col, source_id, "hits", "score", "place")


def lexical_score(words: Column, query: Sequence[str]) -> Column:
    """0.7 coverage of the query's words + 0.3 of at most eight hits in all."""
    q = F.array(*[F.lit(w) for w in query])
    covered = F.size(F.array_intersect(F.array_distinct(words), q)) / len(query)
    hits = F.size(F.filter(words, lambda w: F.array_contains(q, w)))
    return 0.7 * covered + 0.3 * F.least(hits, F.lit(8)) / 8


def min_max(value: Column, partition: Sequence[str]) -> Column:
    """``value`` scaled to 0..1 within its partition; 0 where all are equal."""
    w = Window.partitionBy(*partition)
    low, high = F.min(value).over(w), F.max(value).over(w)
    return F.when(high > low, (value - low) / (high - low)).otherwise(0.0)


def recency(age_hours: Column, half: float) -> Column:
    """exp(-age / half), 1 for the future."""
    return F.exp(-F.greatest(age_hours, F.lit(0.0)) / half)


def cosine(a: Column, b: Column) -> Column:
    return dot(a, b) / F.nullif(norm(a) * norm(b), F.lit(0.0))


def passage_words(text: Column, query: Sequence[str]) -> Column:
    """0.7 share of the query's words that a passage has + 0.3 of eight times their share of its words, at most 1."""
    q = F.array(*[F.lit(w) for w in query])

    def score(w: Column) -> Column:
        covered = F.size(F.array_intersect(F.array_distinct(w), q)) / len(query)
        share = F.size(F.filter(w, lambda x: F.array_contains(q, x))) / F.greatest(F.size(w), F.lit(1))
        return 0.7 * covered + 0.3 * F.least(F.lit(1.0), share * 8)

    return T.let(F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit("([a-z]{3,})"), 1), score)


# How much a section is worth by its name.
SECTION_RANK = {"about": 0, "biography": 0, "background_and_work": 1, "milestones": 2, "publications": 3, "misc": 4}


def section_prior(section: Column) -> Column:
    """1 for biographies down to 1/11 for sections without rank."""
    rank = F.lit(99)
    for name, n in SECTION_RANK.items():
        rank = F.when(F.lower(section) == name, n).otherwise(rank)
    return 1.0 / (1.0 + F.least(rank, F.lit(10)))


def hybrid_score(dense: Column, lexical: Column, prior: Column) -> Column:
    return 0.55 * F.greatest(F.coalesce(dense, F.lit(0.0)), F.lit(0.0)) + 0.30 * lexical + 0.15 * prior


def reranked(pool: DataFrame, score: str, cross: str, k: int, id_col: str, weight: float = 0.35) -> DataFrame:
    """The ``k`` best of a pool by its scores scaled to 0..1, blended with a second judge's. The pool is a top-k, so one row of bounds fits every task."""
    ends = pool.agg(F.min(score).alias("_lo"), F.max(score).alias("_hi"))
    scaled = (F.col(score) - F.col("_lo")) / F.greatest(F.col("_hi") - F.col("_lo"), F.lit(1e-9))
    both = pool.join(F.broadcast(ends)).withColumn("blended", F.round((1 - weight) * scaled + weight * F.col(cross), 6)).drop("_lo", "_hi")
    return both.orderBy(F.col("blended").desc(), id_col).limit(k)


def trend_score(dense: Column, lexical: Column, age_hours: Column, cross: Column | None = None) -> Column:
    """How well an issue fits a topic: vectors, words and recency (0.15 without a date), and a second judge's word where there is one."""
    recent = F.when(age_hours.isNull(), 0.15).otherwise(1.0 / (1.0 + F.greatest(age_hours, F.lit(0.0)) / 48.0))
    d = F.greatest(F.coalesce(dense, F.lit(0.0)), F.lit(0.0))
    return 0.55 * d + 0.35 * lexical + 0.10 * recent if cross is None else 0.45 * d + 0.25 * lexical + 0.10 * recent + 0.20 * F.greatest(F.lit(0.0), F.least(F.lit(1.0), cross))
