"""Connected components of an edge table by alternating stars."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lectern.session import checkpoint, stored

MAX_ROUNDS = 60
#: Edges up to which one task settles all of them; beyond, rounds of joins do, with the same result.
FEW_EDGES = 200_000


def _settled(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Components of few edges by disjoint sets whose root is their least node."""
    up: dict = {}

    def root(x):
        while up.setdefault(x, x) != x:
            up[x] = up[up[x]]
            x = up[x]
        return x

    for batch in batches:
        for u, v in zip(batch["u"], batch["v"], strict=True):
            a, b = root(u), root(v)
            if a != b:
                up[max(a, b)] = min(a, b)
    nodes = list(up)
    if nodes:
        kind = object if isinstance(nodes[0], str) else None
        yield pd.DataFrame({"node": pd.Series(nodes, dtype=kind), "component": pd.Series([root(x) for x in nodes], dtype=kind)})


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component) of each node of ``edges``; the component is its least node.

    Each round links every node to the least of its neighbourhood, once towards larger
    and once towards smaller neighbours, so the depth of trees shrinks geometrically.
    Neighbourhoods are only ever aggregated to their minimum, never collected. Edges
    with a null end and loops are dropped; repeated edges count once; an empty table
    gives an empty table. Lineage is cut by tables in the shared folder. A number of
    edges that is small, which is checked, is settled by one task instead.
    """
    one = edges.select(F.col(a).alias("u"), F.col(b).alias("v")).where("u is not null and v is not null and u <> v")
    current = stored(one.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    if current.count() <= FEW_EDGES:
        kind = current.schema["u"].dataType.simpleString()
        return current.coalesce(1).mapInPandas(_settled, f"node {kind}, component {kind}")
    before = None
    for _ in range(MAX_ROUNDS):
        both = current.unionByName(current.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        # larger neighbours take the least of the neighbourhood
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        # smaller neighbours and the node itself take the least smaller one
        down = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(down, "u").select(F.explode(F.array("u", "v")).alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        current = checkpoint(small)
        now = current.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
    else:
        raise RuntimeError("components did not settle")
    members = current.select(F.col("u").alias("node"), F.col("v").alias("component"))
    roots = current.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return members.unionByName(roots).distinct()
