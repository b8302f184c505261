"""Checks of written articles against the passages they cite."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lectern.functions import text as T


def citations(text: Column, pattern: str = r"\[([A-Za-z0-9_:-]{2,64})\]") -> Column:
    """Cited ids in order of first mention."""
    return F.array_distinct(F.regexp_extract_all(text, F.lit(pattern), 1))


def paragraphs(text: Column) -> Column:
    return F.filter(F.transform(F.split(text, r"\n\s*\n"), lambda s: F.trim(s)), lambda s: s != "")


def grounding(articles: DataFrame, passages: DataFrame, article_id: str, passage_id: str, text: str, passage_text: str, least_shared: int = 2, least_share: float = 0.02) -> DataFrame:
    """(article_id, paragraph_no, cited, shared, weak): words that a paragraph shares with what it cites.

    Joins each cited id with its passage, so the work follows the citations.
    """
    long = lambda c: F.array_distinct(F.filter(T.tokens(c), lambda w: F.length(w) >= 4))
    parts = articles.where(F.col(text).isNotNull()).select(F.col(article_id), F.posexplode(paragraphs(F.col(text))).alias("paragraph_no", "p"))
    cited = parts.select(article_id, "paragraph_no", long(F.col("p")).alias("w"), F.explode(citations(F.col("p"))).alias("c"))
    known = passages.where(F.col(passage_text).isNotNull()).select(F.col(passage_id).cast("string").alias("c"), long(F.col(passage_text)).alias("v"))
    met = cited.join(known, "c", "left").withColumn("s", F.coalesce(F.array_intersect("w", "v"), F.array().cast("array<string>")))
    one = met.groupBy(article_id, "paragraph_no").agg(F.count("*").alias("cited"), F.size(F.array_distinct(F.flatten(F.collect_list("s")))).alias("shared"), F.max(F.size("w")).alias("n"))
    weak = (F.col("shared") < least_shared) & (F.col("shared") / F.greatest(F.col("n"), F.lit(1)) < least_share)
    return one.select(article_id, "paragraph_no", "cited", "shared", weak.alias("weak"))


def structure_errors(text: Column, title: Column, least_chars: int = 500, least_title: int = 10, least_paragraphs: int = 2) -> Column:
    """Names of the rules that an article breaks, in order."""
    rules = [
        (F.coalesce(F.length(F.trim(title)), F.lit(0)) < least_title, "short_title"),
        (F.coalesce(F.length(text), F.lit(0)) < least_chars, "short_article"),
        (F.coalesce(F.size(paragraphs(text)), F.lit(0)) < least_paragraphs, "few_paragraphs"),
        (~F.coalesce(text.rlike(r"[.!?]\s*$"), F.lit(False)), "open_end"),
        (F.coalesce(F.lower(text).rlike("(^|[^a-z])(i|my|we) (am|was|have|think)([^a-z]|$)"), F.lit(False)), "first_person"),
    ]
    return F.array_compact(F.array(*[F.when(bad, F.lit(name)) for bad, name in rules]))


def markdown_sections(docs: DataFrame, id_col: str, text: str) -> DataFrame:
    """(id, line_no, heading, line) of each line under the last ``##`` heading above it, by one pass over the lines."""
    from lectern.operators.asof import asof

    lines = docs.where(F.col(text).isNotNull()).select(id_col, F.posexplode(F.split(text, "\n")).alias("line_no", "line"))
    heads = lines.where(F.col("line").rlike("^#{2,4} ")).select(id_col, "line_no", F.trim(F.regexp_replace("line", "^#+", "")).alias("heading"))
    return asof(lines.where(~F.col("line").rlike("^#{2,4} ")), heads, [id_col], "line_no", "heading")
