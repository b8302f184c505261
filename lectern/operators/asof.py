"""Joins on positions: the closest row before, and intervals that contain a point."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def asof(left: DataFrame, right: DataFrame, by: Sequence[str], at: str, value: str) -> DataFrame:
    """``left`` with ``value`` of the last ``right`` row of the same key at or before its position.

    One union, one sort within key, one pass; no range join. At equal positions the
    ``right`` row counts, of several the one with the greatest value. Rows without an
    earlier one get null.
    """
    rest = [c for c in left.columns if c not in by and c != at]
    a = left.select(*by, at, F.lit(1).alias("_side"), F.lit(None).cast(right.schema[value].dataType).alias("_v"), F.struct(*rest).alias("_r") if rest else F.struct(F.lit(0)).alias("_r"))
    b = right.select(*by, at, F.lit(0).alias("_side"), F.col(value).alias("_v"), F.lit(None).cast(a.schema["_r"].dataType).alias("_r"))
    w = Window.partitionBy(*by).orderBy(at, "_side", "_v").rowsBetween(Window.unboundedPreceding, 0)
    both = a.unionByName(b).withColumn(value, F.last("_v", ignorenulls=True).over(w)).where("_side = 1")
    return both.select(*by, at, *[F.col(f"_r.{c}").alias(c) for c in rest], value)


def contained(points: DataFrame, spans: DataFrame, by: Sequence[str], at: str, start: str, end: str, value: str, width: int = 1000) -> DataFrame:
    """Points with ``value`` of each span [start, end) of the same key that holds them.

    Spans are filed under the buckets of ``width`` they touch, points under theirs, so
    the join is an equi-join on key and bucket with the bounds checked after.
    """
    filed = spans.where(F.col(end) > F.col(start)).withColumn("_b", F.explode(F.sequence(F.floor(F.col(start) / width), F.floor((F.col(end) - 1) / width))))
    mine = points.withColumn("_b", F.floor(F.col(at) / width))
    hit = mine.join(filed.select(*by, "_b", F.col(start).alias("_s"), F.col(end).alias("_e"), value), [*by, "_b"])
    return hit.where((F.col(at) >= F.col("_s")) & (F.col(at) < F.col("_e"))).drop("_b", "_s", "_e")
