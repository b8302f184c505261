"""Copies, first occurrences, latest versions and ordered unions.

Winners are chosen by an explicit order, never by arrival, so results don't change
from run to run. Where a key may hold a third of all rows, winners come from
aggregates, which combine before the shuffle, not from windows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lectern.operators.joins import sized_semi_join
from lectern.session import stored


def class_of_copies(rows: DataFrame, key: str, order: str, first: str = "first", copies: str = "copies") -> DataFrame:
    """Each row's ``order`` value with the least of its class and the size of the class.

    Null keys form one class. The class table is joined back; AQE splits a hot key.
    """
    classes = rows.groupBy(key).agg(F.min(order).alias(first), F.count("*").alias(copies))
    left, right = rows.alias("l"), classes.alias("r")
    return left.join(right, F.col(f"l.{key}").eqNullSafe(F.col(f"r.{key}"))).select(f"l.{order}", f"r.{first}", f"r.{copies}")


def first_by(rows: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The least row of each key by ``order``, all columns, by aggregation."""
    rest = [c for c in rows.columns if c not in keys and c not in order]
    picked = F.min(F.struct(*order, *rest)).alias("_r")
    return rows.groupBy(*keys).agg(picked).select(*[c if c in keys else F.col(f"_r.{c}").alias(c) for c in rows.columns])


def latest_by(rows: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The greatest row of each key by ``order``; nulls in ``order`` come first, so they lose."""
    rest = [c for c in rows.columns if c not in keys and c not in order]
    maps = {f.name for f in rows.schema.fields if "map" in f.dataType.simpleString()}
    if maps & set(rest):  # maps can't be compared; the order alone decides, ties by the other columns
        plain = [c for c in rest if c not in maps]
        picked = F.max_by(F.struct(*order, *rest), F.struct(*order, *plain)).alias("_r")
    else:
        picked = F.max(F.struct(*order, *rest)).alias("_r")
    return rows.groupBy(*keys).agg(picked).select(*[c if c in keys else F.col(f"_r.{c}").alias(c) for c in rows.columns])


def one_per_key(rows: DataFrame, key: str) -> DataFrame:
    """One row of each key that isn't null, of several the greatest by all other columns.

    Only keys are aggregated over the whole table. Rows of a key that occurs once stay
    where they are, so that long texts are shuffled only where a key repeats. ``rows``
    is read three times; it should be a scan.
    """
    repeated = stored(rows.where(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("n")).where("n > 1").select(key), "repeated")
    once = sized_semi_join(rows.where(F.col(key).isNotNull()), repeated, [key], how="left_anti")
    many = latest_by(sized_semi_join(rows, repeated, [key]), [key], [])
    return once.select(*rows.columns).unionByName(many)


def ordered_union(parts: Sequence[DataFrame], key: str, group: Sequence[str] = ()) -> DataFrame:
    """Rows of all parts, each key once: from the first part that has it."""
    both = None
    for n, p in enumerate(parts):
        marked = p.withColumn("_part", F.lit(n))
        both = marked if both is None else both.unionByName(marked)
    return first_by(both, [*group, key], ["_part"]).drop("_part")


def priority_union(first: DataFrame, second: DataFrame, on: Sequence[str]) -> DataFrame:
    """All of ``first`` and those rows of ``second`` whose key it lacks."""
    return first.unionByName(second.join(first.select(*on).distinct(), list(on), "left_anti"))


def versions(rows: DataFrame, key: str, order: Sequence[str], version: str = "version", before: str = "supersedes") -> DataFrame:
    """Rows numbered within their key in ``order``, each with the number it supersedes."""
    w = Window.partitionBy(key).orderBy(*order)
    numbered = rows.withColumn(version, F.row_number().over(w))
    return numbered.withColumn(before, F.when(F.col(version) > 1, F.col(version) - 1))


def gaps(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Keys of only the left, only the right, and both, counted."""
    a = left.select(key).where(F.col(key).isNotNull()).distinct().withColumn("_a", F.lit(True))
    b = right.select(key).where(F.col(key).isNotNull()).distinct().withColumn("_b", F.lit(True))
    both = a.join(b, key, "full")
    return both.agg(
        F.count_if(F.col("_b").isNull()).alias("only_left"), F.count_if(F.col("_a").isNull()).alias("only_right"), F.count_if(F.col("_a").isNotNull() & F.col("_b").isNotNull()).alias("in_both")
    )


def upsert(table: DataFrame, changes: DataFrame, key: str) -> DataFrame:
    """``table`` with the rows of ``changes`` put in by key; changes win."""
    return changes.unionByName(table.join(changes.select(key), key, "left_anti"))


def delete(table: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """``table`` without the rows whose key is listed."""
    return table.join(keys.select(key).distinct(), key, "left_anti")


def numbered_slugs(rows: DataFrame, slug: Column, order: Sequence[str], out: str = "slug") -> DataFrame:
    """Slugs made unique: the second of its kind in ``order`` ends in -2, and so on."""
    w = Window.partitionBy("_s").orderBy(*order)
    n = F.row_number().over(w)
    made = rows.withColumn("_s", slug).withColumn("_n", n)
    return made.withColumn(out, F.when(F.col("_n") == 1, F.col("_s")).otherwise(F.concat_ws("-", "_s", F.col("_n").cast("string")))).drop("_s", "_n")
