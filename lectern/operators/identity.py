"""Joins of people by keys, fallback keys and spelled names."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lectern.functions import text as T


def plain_name(name: Column) -> Column:
    """Letters and blanks of a name in lower case: titles, degrees and punctuation gone."""
    bare = F.regexp_replace(F.lower(name), r"(?:^|[ .,])(?:assoc|prof|professor|dr|phd|ph\.d|md|faas|jr|iii)\.?(?=$|[ .,])", " ")
    return T.collapsed(F.regexp_replace(bare, r"[^\p{L} -]", " "))


def plain_place(name: Column) -> Column:
    """An institution's name in lower case without the words that many share."""
    low = F.regexp_replace(F.lower(name), r"[^\p{L} ]", " ")
    return T.collapsed(F.regexp_replace(low, r"(?:^|(?<= ))(?:the|of|at|university|univ|college|state|medical|institute|technology|u|main|campus)(?= |$)", " "))


def with_fallback(left: DataFrame, right: DataFrame, key: tuple[str, str], fallback: tuple[Column, Column], value: str, order: str) -> DataFrame:
    """``left`` with ``value`` of ``right`` by key, else by the fallback expression; the least ``order`` wins."""
    by_key = right.where(F.col(key[1]).isNotNull()).groupBy(F.col(key[1]).alias("_k")).agg(F.min_by(value, order).alias("_by_key"))
    by_name = right.select(fallback[1].alias("_f"), value, order).where("_f is not null and _f <> ''").groupBy("_f").agg(F.min_by(value, order).alias("_by_name"))
    joined = left.withColumn("_f", fallback[0]).join(by_key, F.col(key[0]) == F.col("_k"), "left").join(by_name, "_f", "left")
    found = joined.withColumn(value, F.coalesce("_by_key", "_by_name"))
    return found.withColumn("matched_by", F.when(F.col("_by_key").isNotNull(), "key").when(F.col("_by_name").isNotNull(), "name").otherwise("none")).drop("_k", "_f", "_by_key", "_by_name")


def candidate_status(left: DataFrame, right: DataFrame, variants: Sequence[Column], key: str, right_key: Column, right_id: str) -> DataFrame:
    """(key, candidates, match, status): by the first variant of the name that has any candidate.

    One candidate is a match, more are ambiguous. Variants are exploded and joined once.
    """
    tries = left.select(key, F.posexplode(F.array(*variants)).alias("rank", "v")).where("v is not null and v <> ''")
    pool = right.select(right_key.alias("v"), right_id).where("v is not null and v <> ''").distinct()
    hits = tries.join(pool, "v").groupBy(key, "rank").agg(F.countDistinct(right_id).alias("candidates"), F.min(right_id).alias("match"))
    best = hits.groupBy(key).agg(F.min(F.struct("rank", "candidates", "match")).alias("b")).select(key, "b.candidates", "b.match")
    keys = left.select(key).distinct()
    out = keys.join(best, key, "left")
    status = F.when(F.col("candidates").isNull(), "unmatched").when(F.col("candidates") == 1, "matched").otherwise("ambiguous")
    return out.select(key, F.coalesce("candidates", F.lit(0)).alias("candidates"), F.when(F.col("candidates") == 1, F.col("match")).alias("match"), status.alias("status"))


def any_key_semi(left: DataFrame, right: DataFrame, left_keys: Sequence[str], right_keys: Sequence[str], key: str) -> DataFrame:
    """``left`` rows of which any of ``left_keys`` equals any of ``right_keys``: keys exploded, no OR join."""
    mine = left.select(key, F.explode(F.array(*[F.col(c) for c in left_keys])).alias("k")).where("k is not null and k <> ''")
    theirs = right.select(F.explode(F.array(*[F.col(c) for c in right_keys])).alias("k")).where("k is not null and k <> ''").distinct()
    return left.join(mine.join(theirs, "k", "left_semi").select(key).distinct(), key, "left_semi")


def names_match(a: Column, b: Column) -> Column:
    """Whether two plain names have the same last word and first words that agree or abbreviate each other."""
    x, y = F.split(a, " "), F.split(b, " ")
    first, other = F.try_element_at(x, F.lit(1)), F.try_element_at(y, F.lit(1))
    short = (F.length(first) == 1) | (F.length(other) == 1)
    agree = F.when(short, F.substring(first, 1, 1) == F.substring(other, 1, 1)).otherwise(first == other)
    return F.coalesce((F.try_element_at(x, F.lit(-1)) == F.try_element_at(y, F.lit(-1))) & agree, F.lit(False))


def lookup_status(left: DataFrame, right: DataFrame, key: str, ref: str, right_key: str, value: str) -> DataFrame:
    """(key, status): matched, record_found_no_file, not_found or missing_id, by what a referenced record holds. ``right`` has one row a key."""
    found = right.select(F.col(right_key).alias("_k"), F.col(value).alias("_v"))
    status = (
        F.when(F.coalesce(F.col(ref), F.lit("")) == "", "missing_id").when(F.col("_k").isNull(), "not_found").when(F.coalesce(F.col("_v"), F.lit("")) == "", "record_found_no_file").otherwise("matched")
    )
    return left.join(found, F.col(ref) == F.col("_k"), "left").select(key, status.alias("status"))


def presence(left: DataFrame, key: str, stages: dict[str, DataFrame]) -> DataFrame:
    """``left`` with a flag for each stage: whether its table (of one column) has the key."""
    out = left
    for name, table in stages.items():
        marked = table.toDF("_k").where("_k is not null").distinct().withColumn(name, F.lit(True))
        out = out.join(marked, F.col(key) == F.col("_k"), "left").drop("_k").withColumn(name, F.coalesce(F.col(name), F.lit(False)))
    return out


def resolved_prefixes(rows: DataFrame, ids: DataFrame, cited: str, id_col: str, least: int = 4) -> DataFrame:
    """``rows`` with the id that ``cited`` means: itself, the only one that begins with it, or the only one by letters and digits; else null.

    Distinct cited strings are joined, by their first ``least`` characters with those of
    the ids, so no pair without a common start is formed; shorter ones are not resolved.
    Ids that share a start with a third of all others still are compared by it: the bucket
    is the start of the cited string's own length, one join for each length that occurs.
    """
    tight = lambda c: F.regexp_replace(F.lower(c), "[^a-z0-9]", "")
    one = rows.select(F.col(cited).alias("_c")).where("_c <> ''").distinct()
    exact = one.join(ids.select(F.col(id_col).alias("_c")).distinct(), "_c", "left_semi").select("_c", F.col("_c").alias("_id"), F.lit(0).alias("_r"))
    found = exact
    for rank, form in ((1, lambda c: c), (2, tight)):
        tries = one.select("_c", form(F.col("_c")).alias("_f")).where(F.length("_f") >= least)
        sizes = sorted(r.n for r in tries.select(F.length("_f").alias("n")).distinct().collect())  # lengths of ids: few
        if not sizes:
            continue
        starts = ids.select(F.col(id_col).alias("_id"), form(F.col(id_col)).alias("_g"))
        cut = starts.select("_id", F.explode(F.transform(F.array(*[F.lit(n) for n in sizes]), lambda n: F.when(n <= F.length("_g"), F.substring("_g", F.lit(1), n)))).alias("_f")).where("_f is not null")
        # an index of starts that cited strings have, each with how many ids it may mean
        means = cut.join(tries.select("_f").distinct(), "_f", "left_semi").groupBy("_f").agg(F.countDistinct("_id").alias("_n"), F.min("_id").alias("_id")).where("_n = 1")
        found = found.unionByName(tries.join(means, "_f").select("_c", "_id", F.lit(rank).alias("_r")))
    best = found.groupBy("_c").agg(F.min(F.struct("_r", "_id")).alias("_b")).select("_c", F.col("_b._id").alias(id_col))
    return rows.join(best, F.col(cited) == F.col("_c"), "left").drop("_c")
