"""Coverage, scores and roll-ups."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def percent(part: Column, whole: Column) -> Column:
    """"12.3%", or "n/a" of nothing."""
    share = F.round(part * F.lit(100.0) / F.nullif(whole, F.lit(0)), 1)
    return F.when(F.coalesce(whole, F.lit(0)) <= 0, "n/a").otherwise(F.concat(F.format_string("%.1f", share), F.lit("%")))


def ladder(value: Column, steps: Sequence[tuple[float, int]]) -> Column:
    """Points of the highest step that ``value`` reaches; 0 below all and for null."""
    out = F.lit(0)
    for least, points in sorted(steps):
        out = F.when(value >= least, points).otherwise(out)
    return out


def modal(rows: DataFrame, key: str, value: str, order: str) -> DataFrame:
    """(key, value, n): the most frequent value of each key, of equals the one seen first by ``order``.

    Two aggregations, so a hot key is combined before the shuffle.
    """
    counted = rows.where(F.col(value).isNotNull()).groupBy(key, value).agg(F.count("*").alias("n"), F.min(order).alias("_o"))
    best = counted.groupBy(key).agg(F.min(F.struct((-F.col("n")).alias("m"), "_o", value)).alias("_x"))
    return best.select(key, F.col(f"_x.{value}").alias(value), (-F.col("_x.m")).alias("n"))


def consistency(values: Column) -> Column:
    """1 - (max - min) / mean of a numeric column in an aggregation; 0 for fewer than two or a mean of 0."""
    return F.when((F.count(values) >= 2) & (F.avg(values) != 0), F.greatest(F.lit(0.0), 1 - (F.max(values) - F.min(values)) / F.avg(values))).otherwise(0.0)


def joined_text(rows: DataFrame, key: Sequence[str], order: str, text: str, sep: str = "\n\n") -> DataFrame:
    """Texts of each key in order, joined."""
    listed = F.array_sort(F.collect_list(F.struct(order, text)))
    return rows.where(F.col(text).isNotNull()).groupBy(*key).agg(F.array_join(F.transform(listed, lambda x: x[text]), sep).alias(text), F.count("*").alias("parts"))


def markdown(title: str, report: DataFrame, most: int = 1000) -> str:
    """A small report as a Markdown table; longer ones are an error."""
    rows = report.limit(most + 1).collect()
    if len(rows) > most:
        raise ValueError("the report is too long for a page")
    head = "| " + " | ".join(report.columns) + " |\n|" + "-|" * len(report.columns)
    cells = ["| " + " | ".join("" if v is None else str(v).replace("|", "\\|") for v in r) + " |" for r in rows]
    return "\n".join([f"# {title}", "", head, *cells, ""])


def run_counters(rows: DataFrame, name: str = "run", **counts: Column) -> tuple[DataFrame, object]:
    """``rows``, and an observation that holds their number and each count once an action has run over them: no pass of its own."""
    from pyspark.sql import Observation

    seen = Observation(name)
    return rows.observe(seen, F.count(F.lit(1)).alias("rows"), *[F.count_if(c).alias(k) for k, c in counts.items()]), seen
