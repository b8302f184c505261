"""Problem 5: lines that recur on one site's pages, kept as incremental counts.

A :class:`LineCountStore` keeps three tables in buckets under a shared folder: the pages
it knows (host and hash of the text), the countable lines of each page, and the number
of pages of each (host, line). A new partition of pages is one delta: pages that are as
they were are passed over, lines of changed pages are taken off the counts, those of new
ones are added, and only the buckets of the hosts concerned are written anew. Keys that
cross the threshold, in either direction, are found by comparing the count before with
the count after; only pages that are new, changed or hold a key that crossed have to be
rebuilt. A later session opens the folder and goes on from there.

Defined cases: pages without host (null or blank) are left out, and one that comes again
without host stays as it was; null texts have no lines; a page delivered twice counts
once, within a delta and over deltas; a page delivered again with another text or host
replaces its earlier state, also if the new text has no countable line; empty tables
give empty results; extra columns are ignored.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lectern.operators.dedup import one_per_key
from lectern.operators.joins import sized_semi_join
from lectern.session import shared_dir, stored
from lectern.sources.buckets import BucketedTables

#: A line counts if it has this many letters, and is excessive on this many pages.
MIN_LETTERS = 25
THRESHOLD = 8


def page_hosts(meta: DataFrame) -> DataFrame:
    """One (id, host) of each profile with a host, lower-cased."""
    host = F.lower(F.trim("source_host"))
    return meta.select(F.col("profile_id").alias("id"), host.alias("host")).where("id is not null and length(host) > 0").groupBy("id").agg(F.min("host").alias("host"))


def line_index(pages: DataFrame, hosts: DataFrame, min_letters: int = MIN_LETTERS, batch=None) -> DataFrame:
    """(id, batch, doc_hash, host, line_no, key) of each countable line of ``pages``; a page without any has one row of null line and key.

    Texts turn into arrays of (line number, digest) before anything is shuffled.
    ``batch`` is an expression for the delta that a page belongs to.
    """
    digests = f"""filter(transform(split(raw_text, '\\n'),
        (l, i) -> struct(i as line_no, regexp_replace(lower(l), '[^\\\\p{{L}}]+', '') as k)), x -> length(x.k) >= {min_letters})"""
    lines = pages.where("id is not null").select(
        "id",
        (batch if batch is not None else F.lit(0)).cast("int").alias("batch"),
        F.xxhash64("raw_text").alias("doc_hash"),
        F.expr(f"coalesce(transform({digests}, x -> struct(x.line_no as line_no, unhex(md5(x.k)) as key)), array())").alias("lines"),
    )
    one = lines.groupBy("id").agg(F.max_by(F.struct("batch", "doc_hash", "lines"), F.struct("batch", "doc_hash")).alias("d"))
    joined = one.join(hosts, "id").select("id", "d.batch", "d.doc_hash", "host", F.explode_outer("d.lines").alias("l"))
    return joined.select("id", "batch", "doc_hash", "host", "l.line_no", "l.key")


def page_counts(index: DataFrame) -> DataFrame:
    """Number of pages of each (host, key). Aggregated twice, so that a line that a
    third of all pages holds is combined before it reaches one task."""
    return index.groupBy("host", "key", "id").agg(F.lit(1).alias("one")).groupBy("host", "key").agg(F.sum("one").alias("n"))


class LineCountStore:
    """Counts of lines by host, grown delta by delta and kept under ``path``."""

    def __init__(self, spark: SparkSession, path: str | None = None, threshold: int = THRESHOLD, buckets: int = 16):
        self.spark, self.threshold = spark, threshold
        self.path = path or f"{shared_dir(spark).rstrip('/')}/lectern/{spark.sparkContext.applicationId}/p5-store-{uuid.uuid4().hex}"
        tables = {
            "pages": ("id string, host string, doc_hash bigint", ["id"]),
            "lines": ("host string, key binary, id string, line_no int", ["host"]),
            "counts": ("host string, key binary, n bigint", ["host"]),
        }
        self.tables = BucketedTables(spark, self.path, tables, buckets)

    def merge(self, delta: DataFrame) -> DataFrame:
        """Take one delta of :func:`line_index` rows (a stored table); return the ids to rebuild.

        These are the delta's new and changed pages and the earlier pages with a line
        that crossed the threshold.
        """
        kept, was = self.tables, self.tables.generation()
        heads = delta.select("id", "host", "doc_hash").distinct()
        old = kept.read("pages").select("id", F.col("host").alias("old_host"), F.col("doc_hash").alias("old_hash"))
        known = stored(heads.join(old, "id").select("id", "old_host", ((F.col("host") == F.col("old_host")) & (F.col("doc_hash") == F.col("old_hash"))).alias("same")), "p5-known")
        same, changed = known.where("same").select("id"), known.where("not same").select("id", F.col("old_host").alias("host"))
        fresh = stored(sized_semi_join(heads, same, ["id"], how="left_anti"), "p5-fresh")
        added = sized_semi_join(delta.where("key is not null"), same, ["id"], how="left_anti").select("host", "key", "id", "line_no")
        moved = kept.touched(changed, "lines")
        touched = sorted({*moved, *kept.touched(fresh, "counts")})
        if not touched:
            return fresh.select("id")
        gone = sized_semi_join(kept.read("lines", moved), changed.select("id"), ["id"])
        before = kept.read("counts", touched).select("host", "key", F.lit(0).cast("bigint").alias("n"), F.col("n").alias("before"))
        none = F.lit(0).cast("bigint").alias("before")
        change = page_counts(added).select("host", "key", "n", none).unionByName(page_counts(gone).select("host", "key", (-F.col("n")).alias("n"), none)).unionByName(before)
        merged = stored(change.groupBy("host", "key").agg(F.sum("before").alias("before"), F.sum("n").alias("change")), "p5-merged")
        after = F.col("before") + F.col("change")
        turned = merged.where((F.col("before") >= self.threshold) != (after >= self.threshold)).select("host", "key")
        of_changed = kept.touched(changed, "pages")
        pages = sized_semi_join(kept.read("pages", of_changed), changed.select("id"), ["id"], how="left_anti").unionByName(fresh)
        lines = sized_semi_join(kept.read("lines", moved), changed.select("id"), ["id"], how="left_anti").unionByName(added)
        kept.publish({"pages": (pages, of_changed), "lines": (lines, moved), "counts": (merged.select("host", "key", after.alias("n")).where("n > 0"), touched)})
        still = sized_semi_join(kept.read("lines", touched, was), changed.select("id"), ["id"], how="left_anti")
        return fresh.select("id").unionByName(sized_semi_join(still, turned, ["host", "key"]).select("id")).distinct()

    def lines(self, generation: int | None = None) -> DataFrame:
        """(id, line_no) of each line whose key stands on at least ``threshold`` pages of its host, as of a generation."""
        excessive = self.tables.read("counts", generation=generation).where(F.col("n") >= self.threshold).select("host", "key")
        return sized_semi_join(self.tables.read("lines", generation=generation), excessive, ["host", "key"]).select("id", "line_no")


def store_of(pages: DataFrame, meta: DataFrame, deltas: int = 2, threshold: int = THRESHOLD, path: str | None = None) -> tuple[LineCountStore, list[DataFrame]]:
    """A store grown from ``pages`` in ``deltas`` partitions by time of scraping, and what each made necessary to rebuild.

    Texts are read once; the deltas are partitions of the stored index. The first
    holds what was scraped up to the middle of the period, and so on. With ``path`` the
    store of an earlier session is grown further.
    """
    spark = pages.sparkSession
    seconds = F.col("scraped_at").cast("timestamp").cast("double")
    span = pages.agg(F.min(seconds).alias("a"), F.max(seconds).alias("b")).first()
    low, width = span.a or 0.0, max((span.b or 0.0) - (span.a or 0.0), 1.0)
    batch = F.least(F.floor((F.coalesce(seconds, F.lit(low)) - low) / width * deltas), F.lit(deltas - 1))
    index = stored(line_index(pages, page_hosts(meta), batch=batch), "p5-index")
    store = LineCountStore(spark, path, threshold)
    return store, [store.merge(index.where(F.col("batch") == b)) for b in range(deltas)]


def rebuilt_texts(pages: DataFrame, store: LineCountStore, rebuilt: list[DataFrame]) -> DataFrame:
    """(id, raw_text, removed) of each page, written once: by the last delta that made it necessary.

    A page that a later delta doesn't name has the lines that it had, so only the pages
    named are written again. Pages that the store doesn't know (without host) are as they were.
    """
    one = one_per_key(pages.select("id", "raw_text"), "id")
    last = store.tables.generation()
    first = last - len(rebuilt) + 1
    marked = None
    for n, ids in enumerate(rebuilt):
        part = ids.select("id", F.lit(n).alias("delta"))
        marked = part if marked is None else marked.unionByName(part)
    latest = stored(marked.groupBy("id").agg(F.max("delta").alias("delta")), "p5-rebuilt")
    lines = None
    for n in range(len(rebuilt)):
        at = store.lines(first + n).join(latest.where(F.col("delta") == n).select("id"), "id", "left_semi")
        lines = at if lines is None else lines.unionByName(at)
    return without_lines(one, lines)


def without_lines(pages: DataFrame, lines: DataFrame) -> DataFrame:
    """(id, raw_text, removed): the texts, one an id, without ``lines``; texts that lose none keep theirs."""
    gone = lines.groupBy("id").agg(F.collect_set("line_no").alias("gone"))
    kept = F.expr("array_join(filter(split(raw_text, '\\n'), (l, i) -> not array_contains(gone, i)), '\\n')")
    return pages.where("id is not null").select("id", "raw_text").join(gone, "id", "left").select(
        "id",
        F.when(F.col("gone").isNull(), F.col("raw_text")).otherwise(kept).alias("raw_text"),
        F.coalesce(F.size("gone"), F.lit(0)).alias("removed"),
    )
