"""Ranks, runners-up and merged spans."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def dominant(rows: DataFrame, key: str, name: str, count: str, least: int = 10, times: int = 3) -> DataFrame:
    """(key, name, top, second, dominant): the greatest of each key, and whether it has ``least`` and ``times`` the runner-up.

    ``rows`` has one row a key and name. Ties go to the least name, null first. The
    runner-up comes from a second aggregation without the winners, so no key is sorted.
    """
    order = F.struct((-F.col(count)).alias("m"), F.col(name).alias("x"))
    best = rows.groupBy(key).agg(F.min(order).alias("b"))
    rest = rows.join(best.select(F.col(key), F.col("b.x").alias("_x")), key).where(~F.col(name).eqNullSafe(F.col("_x")))
    second = rest.groupBy(key).agg(F.max(count).alias("second"))
    out = best.join(second, key, "left").select(key, F.col("b.x").alias(name), (-F.col("b.m")).alias("top"), F.coalesce("second", F.lit(0)).alias("second"))
    return out.withColumn("dominant", (F.col("top") >= least) & ((F.col("second") == 0) | (F.col("top") >= times * F.col("second"))))


def disambiguated(rows: DataFrame, key: str, affiliated: Column, exact: Column, works: Column, has_last: Column, order: Sequence[str], most: int = 50, few: int = 5) -> DataFrame:
    """One candidate of each key, by the first rule that tells one, with the rule's name.

    The rules: an affiliation that fits; the only one with works; the exact first name
    with ``few`` works; thrice the works of the runner-up and ten at least; ``most`` works
    and the last name. Keys that no rule settles have no row.
    """
    plain = [c for c in rows.columns if c != key]
    marked = rows.select(key, F.struct(*plain).alias("r"), affiliated.alias("a"), exact.alias("e"), F.coalesce(works, F.lit(0)).alias("w"), has_last.alias("l"), *[F.col(c).alias(f"_o{i}") for i, c in enumerate(order)]).distinct()
    rank = [F.struct((-F.col("w")).alias("w"), *[F.col(f"_o{i}") for i in range(len(order))], F.col("r").alias("r"))]
    firsts = F.struct(*[F.col(f"_o{i}") for i in range(len(order))], F.col("r").alias("r"))
    told = F.col("w") > 0
    s = marked.groupBy(key).agg(
        F.min(F.when(F.col("a"), firsts)).alias("by_place"), F.count_if(told).alias("n"), F.min(F.when(told, rank[0])).alias("top"), F.min(F.when(told & F.col("e") & (F.col("w") >= few), rank[0])).alias("by_first"),
        F.min(F.when(told & F.col("l"), rank[0])).alias("by_last"),
    )
    others = marked.where(told).join(s.select(key, "top"), key).where(rank[0] != F.col("top")).groupBy(key).agg(F.max("w").alias("second"))
    s = s.join(others, key, "left")
    top, second = -F.col("top.w"), F.coalesce("second", F.lit(0))
    rules = [
        ("affiliation", F.col("by_place").isNotNull(), F.col("by_place.r")),
        ("only_one", F.col("n") == 1, F.col("top.r")),
        ("first_name", F.col("by_first").isNotNull(), F.col("by_first.r")),
        ("dominance", (top >= 10) & ((second == 0) | (top >= 3 * second)), F.col("top.r")),
        ("productive", (top >= most) & (F.col("by_last.w") == F.col("top.w")), F.col("top.r")),
    ]
    rule, chosen = F.lit(None).cast("string"), F.lit(None)
    for name, holds, row in reversed(rules):
        holds = F.coalesce(holds, F.lit(False))
        rule, chosen = F.when(holds, name).otherwise(rule), F.when(holds, row).otherwise(chosen)
    return s.select(key, rule.alias("rule"), chosen.alias("_r")).where("rule is not null").select(key, "rule", "_r.*")


def merged_spans(spans: DataFrame, key: str, start: str, end: str, title: str) -> DataFrame:
    """(key, start, end, title, parts): spans of a key that overlap, as one; the longest title names it, of equals the first.

    The spans of one document are folded in order within its row.
    """
    kind = {f.name: f.dataType.simpleString() for f in spans.schema.fields}
    listed = spans.groupBy(key).agg(F.array_sort(F.collect_list(F.struct(F.col(start).alias("s"), F.col(end).alias("e"), F.col(title).alias("t")))).alias("x"))
    empty = F.array().cast(f"array<struct<s:{kind[start]},e:{kind[end]},t:string,n:int>>")

    def join(acc: Column, x: Column) -> Column:
        last = F.try_element_at(acc, F.lit(-1))
        wider = F.struct(last["s"].alias("s"), F.greatest(last["e"], x["e"]).alias("e"), F.when(F.length(x["t"]) > F.length(last["t"]), x["t"]).otherwise(last["t"]).alias("t"), (last["n"] + 1).alias("n"))
        fresh = F.struct(x["s"].alias("s"), x["e"].alias("e"), x["t"].alias("t"), F.lit(1).alias("n"))
        return F.when((F.size(acc) > 0) & (x["s"] < last["e"]), F.concat(F.slice(acc, F.lit(1), F.greatest(F.size(acc) - 1, F.lit(0))), F.array(wider))).otherwise(F.concat(acc, F.array(fresh)))

    return listed.select(key, F.explode(F.aggregate("x", empty, join)).alias("m")).select(key, F.col("m.s").alias(start), F.col("m.e").alias(end), F.col("m.t").alias(title), F.col("m.n").alias("parts"))
