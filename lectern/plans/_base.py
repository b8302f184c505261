"""Registering queries together with the SQL that says the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from lectern.session import spread
from lectern.sources import read_table

#: Tables of texts: scans with fewer splits than cores are spread before texts are worked on.
TEXTS = frozenset({"documents", "extracted_content"})

Query = Callable[[SparkSession, str], DataFrame]


class Registry:
    """Queries by name, with SQL where SQL can say the same."""

    def __init__(self):
        self.queries: dict[str, Query] = {}
        self.sql: dict[str, str] = {}

    def query(self, sql: str | None = None, *tables: str):
        """Register a function of the named tables; without tables it gets (spark, directory)."""

        def register(fn):
            name = fn.__name__
            if tables:
                self.queries[name] = lambda spark, d: fn(*[spread(read_table(spark, d, t)) if t in TEXTS else read_table(spark, d, t) for t in tables])
            else:
                self.queries[name] = fn
            if sql is not None:
                self.sql[name] = sql
            return fn

        return register
