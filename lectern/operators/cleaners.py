"""Cleaners that need more than a line at a time."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lectern.functions import cleaning as C

# What lines of a consent notice say, what only may belong to one, and what ends it.
CONSENT = re.compile(
    "cookie|privacy policy|terms of service|terms and conditions|by continuing|opens in a new window|gdpr|ccpa|data protection|tracking|analytics|personal data|data collection|browser settings|opt out|opt-out|opt in|opt-in|aviso legal|datenschutz"
)
CONTEXT = re.compile("preferences|consent|third-party|first-party|necessary|functional|performance|advertising|marketing|session|persistent|local storage|always active|anonymous")
CHOICE = re.compile("accept all|reject all|save preferences|customize|always active|allow cookies|block cookies")
ENDING = re.compile(r"^\W*(?:close|accept|agree|continue|save|ok|got it|dismiss)\W*$")


def without_consent(text: str | None, gap: int = 3) -> str | None:
    """A text without its consent notices.

    A notice begins with a line that speaks of cookies, tracking or terms (or offers a
    choice about them), and goes on while such lines, choices and closing words follow
    each other with at most ``gap`` others between two of them. Those between go with
    the notice; those after the last one stay. Of a single line only that line goes.
    """
    if not text:
        return text
    rows = text.split("\n")
    low = [r.strip().lower() for r in rows]
    about = [bool(CONSENT.search(s)) or bool(CONTEXT.search(s) and CHOICE.search(s)) for s in low]
    out, i = [], 0
    while i < len(rows):
        if not about[i]:
            out.append(rows[i])
            i += 1
            continue
        last, j = i, i + 1
        while j < len(rows) and j - last <= gap + 1:
            if about[j] or ENDING.match(low[j]):
                last = j
            j += 1
        i = last + 1
    return re.sub(r"\n{3,}", "\n\n", "\n".join(out)).strip()


def consent_free(docs: DataFrame, id_col: str, text: str) -> DataFrame:
    """(id, text, removed): each text without its consent notices, and the characters that went. Null stays null."""
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            done = [without_consent(t) for t in batch[text]]
            yield pd.DataFrame({id_col: batch[id_col], text: done, "removed": [len(a or "") - len(b or "") for a, b in zip(batch[text], done, strict=True)]})

    return docs.select(id_col, text).mapInPandas(run, f"{id_col} {kind}, {text} string, removed int")


def known_sections(docs: DataFrame, id_col: str, text: str) -> DataFrame:
    """(id, section_no, section, lines, content): what stands under each known header, which has a line of its own with or without colon.

    Empty sections are dropped; a text without header is one section, CONTENT.
    """
    head = F.upper(F.regexp_replace(F.col("s"), r"\s*:$", ""))
    rows = docs.select(id_col, F.posexplode(C.lines(C.plain_text(F.col(text)))).alias("n", "s"))
    marked = rows.select(id_col, "n", "s", F.when(head.isin(C.HEADERS), head).alias("h"))
    # the lines of one text, folded in order within its row
    listed = marked.groupBy(id_col).agg(F.array_sort(F.collect_list(F.struct("n", "s", "h"))).alias("x"))
    at = F.filter("x", lambda x: x["h"].isNotNull())
    spans = F.when(F.size(at) <= 0, F.array(F.struct(F.lit(-1).alias("n"), F.lit("CONTENT").alias("h")))).otherwise(F.transform(at, lambda x: F.struct(x["n"].alias("n"), x["h"].alias("h"))))
    cut = listed.select(id_col, "x", spans.alias("a")).select(id_col, "x", "a", F.posexplode("a").alias("section_no", "k"))
    upto = F.coalesce(F.try_element_at("a", F.col("section_no") + 2)["n"], F.size("x"))
    part = F.slice("x", F.col("k.n") + 2, upto - F.col("k.n") - 1)
    name = F.col("k.h")
    for a, b in C.SAME_HEADER.items():
        name = F.when(F.col("k.h") == a, b).otherwise(name)
    content = C.strip(F.array_join(F.transform(part, lambda x: x["s"]), "\n"))
    return cut.select(id_col, "section_no", name.alias("section"), F.size(part).alias("lines"), content.alias("content")).where("content <> ''")


def by_source(docs: DataFrame, id_col: str, text: str) -> DataFrame:
    """(id, part_no, source, kind, content) of a text whose parts are headed ``--- name ---`` or ``=== Source: name ===``; what precedes is "header", a text without heads "general"."""
    marked = F.regexp_replace(F.col(text), r"(?m)^[ \t]*(?:---[ \t]*(\w+)[ \t]*---|===[ \t]*(?:Source:[ \t]*)?(\w+)[ \t]*===)[ \t]*$", "\x01$1$2\x02")
    parts = F.posexplode(F.split(marked, "\x01")).alias("part_no", "p")
    rows = docs.where(F.col(text).isNotNull()).select(id_col, marked.contains("\x01").alias("has"), parts)
    name = F.when(~F.col("has"), "general").when(F.col("part_no") == 0, "header").otherwise(F.split_part("p", F.lit("\x02"), F.lit(1)))
    content = C.strip(F.when(F.col("p").contains("\x02"), F.split_part("p", F.lit("\x02"), F.lit(2))).otherwise(F.col("p")))
    return rows.select(id_col, "part_no", name.alias("source"), C.source_kind(name).alias("kind"), content.alias("content")).where("content <> ''")


def budgeted(sections: DataFrame, key: str, name: str, text: str, each: int = 6000, total: int = 24000) -> DataFrame:
    """(key, context): labelled sections of a key by name, each cut to ``each`` characters and all to ``total``. Built for a bounded prompt.

    Running sums are folded within the row of a key.
    """
    listed = sections.where(F.coalesce(C.strip(F.col(text)), F.lit("")) != "").groupBy(key).agg(F.array_sort(F.collect_list(F.struct(F.lower(name).alias("o"), F.col(name).alias("n"), F.substring(C.strip(F.col(text)), 1, each).alias("t")))).alias("x"))
    zero = F.struct(F.lit(0).alias("used"), F.array().cast("array<string>").alias("out"))

    def add(acc, x):
        left = F.greatest(F.lit(total) - acc["used"], F.lit(0))
        part = F.substring(x["t"], F.lit(1), left)
        more = F.concat(acc["out"], F.array(F.concat(F.lit("[Section: "), x["n"], F.lit("]\n"), part)))
        return F.struct((acc["used"] + F.length(part)).alias("used"), F.when(left > 0, more).otherwise(acc["out"]).alias("out"))

    return listed.select(key, F.array_join(F.aggregate("x", zero, add)["out"], "\n\n").alias("context"))
