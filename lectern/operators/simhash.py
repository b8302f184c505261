"""64-bit simhash of words, and classes of texts whose fingerprints are near.

Fingerprints at most three bits apart agree in at least three of six blocks of bits,
so each distinct fingerprint is filed under the 20 choices of three blocks and is
compared only with those that share such a key (about 32 bits): an exact search
without all pairs. Exact copies share a fingerprint and are compared once.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lectern.functions import text as T
from lectern.operators.components import connected_components
from lectern.session import stored

BLOCKS = (0, 11, 22, 33, 43, 53, 64)
NEAR = 3


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, bits, simhash) of each row: the fingerprint as a signed number and in hex.

    Null and empty texts have fingerprint 0.
    """
    # the first eight bytes of each word's digest, one after the other, made in the JVM
    digests = F.unhex(F.array_join(F.transform(F.coalesce(T.tokens(F.col(text)), F.array().cast("array<string>")), lambda w: F.substring(F.md5(w), 1, 16)), ""))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for raw in batch["h"]:
                rows = np.frombuffer(raw, dtype=np.uint8).reshape(-1, 8)
                ones = np.zeros(64, dtype=np.int64)
                for a in range(0, len(rows), 65_536):
                    ones += np.unpackbits(rows[a : a + 65_536], axis=1).sum(0, dtype=np.int64)
                out.append(int.from_bytes(np.packbits(2 * ones > len(rows)).tobytes(), "big") if len(rows) else 0)
            signed = [v - (1 << 64) if v >= 1 << 63 else v for v in out]
            yield pd.DataFrame({id_col: batch[id_col], "bits": signed, "simhash": [f"0x{v:016x}" for v in out]})

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col), digests.alias("h")).mapInPandas(run, f"{id_col} {kind}, bits bigint, simhash string")


def classes(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, class_id, links): the least id of the class, and the number of other fingerprints near."""
    marked = stored(fingerprints(docs, id_col, text), "simhash")
    distinct = marked.select("bits").distinct()
    keys = []
    for chosen in itertools.combinations(range(6), 3):
        mask = sum(((1 << (BLOCKS[b + 1] - BLOCKS[b])) - 1) << BLOCKS[b] for b in chosen)
        mask -= (1 << 64) if mask >= 1 << 63 else 0
        keys.append(F.struct(F.lit(len(keys)).alias("t"), F.col("bits").bitwiseAND(F.lit(mask)).alias("k")))
    filed = distinct.select("bits", F.explode(F.array(*keys)).alias("f")).select("bits", "f.t", "f.k")
    # Spark counts an exploded row once, so its estimate of these 20 rows a fingerprint would let it broadcast them; merged, they aren't held at once
    a, b = filed.select("t", "k", F.col("bits").alias("a")).hint("merge"), filed.select("t", "k", F.col("bits").alias("b")).hint("merge")
    near = stored(a.join(b, ["t", "k"]).where("a < b").where(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= NEAR).select("a", "b").distinct(), "simhash-near")
    links = near.select(F.col("a").alias("bits")).unionByName(near.select(F.col("b").alias("bits"))).groupBy("bits").agg(F.count("*").alias("links"))
    found = connected_components(near).select(F.col("node").alias("bits"), "component")
    placed = marked.select(id_col, "bits").join(found, "bits", "left").join(links, "bits", "left").withColumn("component", F.coalesce("component", "bits"))
    least = placed.groupBy("component").agg(F.min(id_col).alias("class_id"))
    return placed.join(least, "component").select(id_col, "class_id", F.coalesce("links", F.lit(0)).alias("links"))
