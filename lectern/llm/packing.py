"""Problem 8: fill containers of fixed capacity, shortest pack first over the length histogram.

Token lengths are counted once; only their histogram (at most ``capacity`` rows)
reaches the driver, where patterns of lengths are built from the longest length
down, each length going to the pack with the most room. Patterns are handed back
to the documents by rank within length. Ranks are two-phase: counts by (length,
bucket of the id) give each bucket's first rank, so a length that a third of all
documents share is still ranked in many tasks.

Defined cases: null and empty texts have no token and get a null container; a text
longer than the capacity is cut into full containers and a rest that is packed as
an item of its own; repeated texts are separate items; repeated ids too (each row
is placed); empty tables give no rows.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lectern.session import spread, stored

CAPACITY = 2048
VOCABULARY = "byte_bpe_50k.tiktoken"


def vocabulary_path(name: str = VOCABULARY) -> str:
    """Place of a public vocabulary file."""
    import public_tokenizers

    return str(public_tokenizers.path(name))


_ENCODINGS: dict[str, object] = {}


def encoding(path: str):
    """The tokenizer of a rank file, made once in each Python worker."""
    if path not in _ENCODINGS:
        import public_tokenizers
        import tiktoken

        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        _ENCODINGS[path] = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    return _ENCODINGS[path]


def token_counts(docs: DataFrame, path: str | None = None, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_tokens) of each row; the texts are not shuffled."""
    at = path or vocabulary_path()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode = encoding(at).encode_ordinary
        for batch in batches:
            yield pd.DataFrame({id_col: batch[id_col], "n_tokens": [len(encode(t)) if t else 0 for t in batch[text]]})

    kind = docs.schema[id_col].dataType.simpleString()
    return spread(docs.select(id_col, text)).mapInPandas(run, f"{id_col} {kind}, n_tokens int")


def patterns(histogram: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, dict[int, int]]]:
    """(count, {length: slots}) of each packing pattern, shortest pack first.

    Open packs are kept by room; those of equal content form one pattern with a
    count, so the work depends on the number of lengths, not of documents.
    """
    rooms: dict[int, list[list]] = {}
    for length in sorted(histogram, reverse=True):
        left = histogram[length]
        opened: list[tuple[int, int, dict[int, int]]] = []
        for room in sorted((r for r in rooms if r >= length), reverse=True):
            if not left:
                break
            waiting, rooms[room] = rooms[room], []
            for count, content in waiting:
                fits = room // length
                full = min(count, left // fits)
                if full:
                    opened.append((room - fits * length, full, content | {length: fits}))
                    left -= full * fits
                    count -= full
                if count and left and left < fits:
                    opened.append((room - left * length, 1, content | {length: left}))
                    left, count = 0, count - 1
                if count:
                    rooms[room].append([count, content])
            if not rooms[room]:
                del rooms[room]
        if left:
            fits = capacity // length
            if left // fits:
                opened.append((capacity - fits * length, left // fits, {length: fits}))
            if left % fits:
                opened.append((capacity - left % fits * length, 1, {length: left % fits}))
        for room, count, content in opened:
            rooms.setdefault(room, []).append([count, content])
    return [(count, content) for room in sorted(rooms) for count, content in rooms[room]]


def ranked(items: DataFrame, key: str, order: list[str], buckets: int = 64) -> DataFrame:
    """``items`` with ``rank``, 0-based within ``key``, the same in every run.

    Rows with equal ``order`` are interchangeable.
    """
    bucketed = items.withColumn("_bucket", F.pmod(F.xxhash64(*order), F.lit(buckets)).cast("int"))
    counts = bucketed.groupBy(key, "_bucket").agg(F.count("*").alias("_n"))
    before = Window.partitionBy(key).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    firsts = counts.select(key, "_bucket", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_first"))
    local = F.row_number().over(Window.partitionBy(key, "_bucket").orderBy(*order)) - 1
    return bucketed.withColumn("_local", local).join(firsts, [key, "_bucket"]).withColumn("rank", F.col("_first") + F.col("_local")).drop("_bucket", "_local", "_first")


def pack(counts: DataFrame, capacity: int = CAPACITY, id_col: str = "doc_id") -> DataFrame:
    """(doc_id, part, first_token, n_tokens, container, slot) of each item of ``counts``."""
    counts = stored(counts, "p8-counts")
    full = F.coalesce(F.col("n_tokens"), F.lit(0)).cast("bigint")
    parts = F.when(full > 0, F.sequence(F.lit(0).cast("bigint"), F.floor((full - 1) / capacity))).otherwise(F.array(F.lit(0).cast("bigint")))
    items = counts.select(id_col, full.alias("_all"), F.explode(parts).alias("part")).select(
        id_col, F.col("part").cast("int"), (F.col("part") * capacity).alias("first_token"), F.least(F.lit(capacity), F.col("_all") - F.col("part") * capacity).alias("n_tokens")
    )
    none = items.where("n_tokens <= 0").select(id_col, "part", "first_token", F.lit(0).cast("bigint").alias("n_tokens"), F.lit(None).cast("bigint").alias("container"), F.lit(None).cast("int").alias("slot"))
    real = items.where("n_tokens > 0")
    histogram = {int(r.n_tokens): int(r.n) for r in real.groupBy("n_tokens").agg(F.count("*").alias("n")).collect()}  # at most capacity rows

    starts: dict[int, list[tuple[int, int, int, int]]] = {}
    used = dict.fromkeys(histogram, 0)
    base = 0
    for count, content in patterns(histogram, capacity):
        slot = 0
        for length in sorted(content, reverse=True):
            m = content[length]
            starts.setdefault(length, []).append((used[length], base, m, slot))
            used[length] += count * m
            slot += m
        base += count
    plan = {length: np.asarray(rows, dtype=np.int64).T for length, rows in starts.items()}
    shared = items.sparkSession.sparkContext.broadcast(plan)  # bounded by patterns x lengths, not by documents

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            container = np.empty(len(batch), dtype=np.int64)
            slot = np.empty(len(batch), dtype=np.int32)
            lengths, ranks = batch["n_tokens"].to_numpy(), batch["rank"].to_numpy()
            for length in np.unique(lengths):
                rows = np.flatnonzero(lengths == length)
                first, begin, m, s = shared.value[int(length)]
                k = np.searchsorted(first, ranks[rows], side="right") - 1
                within = ranks[rows] - first[k]
                container[rows] = begin[k] + within // m[k]
                slot[rows] = s[k] + within % m[k]
            yield batch.drop(columns="rank").assign(container=container, slot=slot)

    kind = counts.schema[id_col].dataType.simpleString()
    placed = ranked(real, "n_tokens", [id_col, "part"]).select(id_col, "part", "first_token", "n_tokens", "rank")
    return placed.mapInPandas(place, f"{id_col} {kind}, part int, first_token bigint, n_tokens bigint, container bigint, slot int").unionByName(none)
