"""Grouped Python functions over sorted partitions."""

from __future__ import annotations

import itertools
from collections.abc import Callable, Iterable, Iterator, Sequence
from typing import Any

import pandas as pd
from pyspark.sql import DataFrame


def map_sorted_groups(df: DataFrame, keys: Sequence[str], values: Sequence[str], fn: Callable[[tuple, Iterator[tuple]], Iterable[tuple]], schema: str, order: Sequence[str] = ()) -> DataFrame:
    """``fn(key, rows)`` of each group of ``keys``, its rows streamed in ``order``.

    Where groups are many and small this saves the Arrow batch that each group costs
    with ``applyInPandas``: rows are shuffled by key, sorted within partitions, and
    groups are told apart as they stream by, over batch borders too. ``fn`` gets an
    iterator, so a group is held in memory only if ``fn`` holds it. Null keys form a
    group; an empty table gives no rows.
    """
    names = [c.split()[0] for c in schema.split(",")]
    k, size = len(keys), 20_000

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rows = itertools.chain.from_iterable(b.itertuples(index=False, name=None) for b in batches)
        out: list[tuple[Any, ...]] = []
        for key, group in itertools.groupby(rows, key=lambda r: r[:k]):
            out.extend(fn(key, (r[k:] for r in group)))
            if len(out) >= size:
                yield pd.DataFrame(out, columns=names)
                out = []
        if out:
            yield pd.DataFrame(out, columns=names)

    picked = df.select(*keys, *values)
    return picked.repartition(*keys).sortWithinPartitions(*keys, *order).mapInPandas(run, schema)
