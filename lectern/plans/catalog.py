"""All named queries outside the optional packages, with their SQL."""

from __future__ import annotations

from lectern.plans import articles, chunks, cleaning, collected, ingest, links, markup, people, persons, ranking, scores, stored, texts, web
from lectern.plans._base import Query

_PARTS = [texts.R, web.R, chunks.R, people.R, ranking.R, links.R, persons.R, cleaning.R, collected.R, scores.R, articles.R, stored.R, markup.R, ingest.R]


def queries() -> dict[str, Query]:
    return {k: v for part in _PARTS for k, v in part.queries.items()}


def oracle_sql() -> dict[str, str]:
    return {k: v for part in _PARTS for k, v in part.sql.items()}
