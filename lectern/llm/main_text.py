"""Problem 3: the main text of a page, line by line.

Pages that still have markup are rendered by :func:`lectern.llm.layout.render`, which
builds the element tree with implied tags and emits what is visible. Pages that are
already bare lines get their tree from :func:`lectern.llm.layout.line_tree`, whose lines
imply the elements; the same visibility rules say what of it is main text, and the same
renderer emits it with block spacing, lists and aligned cells. That a site's template
repeats a line is told by counts over all pages (:mod:`lectern.llm.templates`); texts
themselves are not shuffled, but for those of repeated ids.

Defined cases: null, empty and blank texts have no lines; blank lines are neither
main text nor boilerplate; a repeated row counts once; a null name only makes the
person's line harder to find; records that hold residue (problem 6) are left out;
extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lectern.llm import layout, residue, templates
from lectern.operators.dedup import one_per_key
from lectern.session import spread


def page_lines(pages: DataFrame, fetches: DataFrame | None = None, cut: float = residue.CUT, with_text: bool = False) -> DataFrame:
    """(id, main, other[, text]) of each page with content, once: line numbers of what its tree shows and hides[, the rendered text]."""
    pages = pages.select("id", "profile_name", "title", "raw_text", "profile_url")
    lines = templates.Templates(pages)
    numbers = lines.numbers()
    model = pages.sparkSession.sparkContext.broadcast(residue.fit(pages, fetches, lines=lines))
    schema = "id string, main array<int>, other array<int>" + ", text string" * with_text

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for key, text, name, title, recurs in zip(batch["id"], batch["raw_text"], batch["profile_name"], batch["title"], batch["_recurs"], strict=True):
                body, own = text or "", layout.name_words(name or "")
                kinds = layout.elements(body, own, numbers(recurs))
                if model.value.score(*residue.features(body, name, title, kinds)) >= cut:
                    continue
                row = (key, *layout.parted(kinds))
                if with_text:
                    row += (layout.render_lines(layout.line_tree(body, own, kinds=kinds)),)
                rows.append(row)
            yield pd.DataFrame(rows, columns=[c.split()[0] for c in schema.split(", ")])

    return lines.mark(spread(one_per_key(pages, "id"))).drop("profile_url").mapInPandas(run, schema)


def main_text(pages: DataFrame, fetches: DataFrame | None = None) -> DataFrame:
    """(id, text, main_lines, other_lines) of each page with content, once."""
    return page_lines(pages, fetches, with_text=True).select("id", "text", F.size("main").alias("main_lines"), F.size("other").alias("other_lines"))


def boilerplate(pages: DataFrame, fetches: DataFrame | None = None) -> DataFrame:
    """(id, line_no) of each line that is not part of the page's main text."""
    return page_lines(pages, fetches).select("id", F.explode("other").alias("line_no"))
