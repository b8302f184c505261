"""Lines that a site's template repeats, as evidence for the visibility of page elements.

A line is known by its letters (lower case, without the site's own name, so that the
same sentence of two sites is one). It recurs if it stands on the pages of ``PAGES``
persons of its site or, if short, on pages of ``SITES`` sites. Both are counts over all
pages; one person's text under several ids is no template.

Defined cases: pages without address form one site; lines of fewer than ``LETTERS``
letters, of one word or with more than a digit to four letters never recur; a page
delivered twice counts once, pages without a person's name count by id; empty tables
have no recurrent lines.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lectern.operators.joins import BROADCAST_BYTES, sized_semi_join
from lectern.session import spread, stored

PAGES, SITES, LETTERS = 8, 4, 12
#: Letters beyond which a line is prose, which may be alike on several sites; it recurs only within one.
PROSE = 100


def _keyed(pages: DataFrame) -> DataFrame:
    """``pages`` with ``_site`` and ``_keys``: per line a hash of its letters, 0 for one that can't recur, negative for prose.

    Texts are lowered and stripped as a whole, which keeps their line breaks, and split
    then. Each step is a projection of its own, so that a line is hashed once.
    """
    site = F.coalesce(F.regexp_extract(F.lower("profile_url"), r"^\s*(?:[a-z][a-z0-9+.-]*://)?([^/:?#]+)", 1), F.lit(""))
    own = F.regexp_extract(site, r"([^.-]{4,})(?:-[^.]*)?\.[^.]*$", 1)
    named = pages.withColumn("_at", site).withColumn("_own", F.when(own.contains("\n"), "").otherwise(own))  # of two lines it is in no line
    stripped = F.regexp_replace(F.replace(F.lower("raw_text"), F.col("_own"), F.lit("#")), r"[^\p{L}#\n]+", "")
    digits = F.regexp_replace("raw_text", r"[^0-9\n]+", "")
    parts = F.arrays_zip(*(F.split(text, "\n").alias(n) for n, text in (("l", F.col("raw_text")), ("p", stripped), ("d", digits))))
    sized = F.transform(parts, lambda x: F.struct(x["p"].alias("p"), F.length(F.replace(x["p"], F.lit("#"), F.lit(""))).alias("n"), F.length(x["d"]).alias("d"), F.trim(x["l"]).contains(" ").alias("w")))
    positive = F.lit((1 << 63) - 1).cast("bigint")

    def key(x: Column) -> Column:
        h = positive.bitwiseAND(F.xxhash64(x["p"]))
        return F.when(x["w"] & (x["n"] >= LETTERS) & (x["d"] * 4 <= x["n"]), F.when(x["n"] <= PROSE, h).otherwise(-h)).otherwise(F.lit(0).cast("bigint"))

    return named.withColumn("_keys", F.coalesce(F.transform(sized, key), F.array().cast("array<bigint>"))).withColumn("_site", F.xxhash64("_at")).drop("_at", "_own")


def _own(site: Column, key: Column) -> Column:
    return F.xxhash64(site, key)


def recurrent_keys(keyed: DataFrame) -> DataFrame:
    """(key) of the lines that recur: the line's hash, or that of site and line for lines of one site."""
    person = F.coalesce(F.lower(F.trim("profile_name")), "id") if "profile_name" in keyed.columns else F.col("id")
    rows = keyed.where("id is not null").select(F.xxhash64(person).alias("who"), "_site", F.explode(F.array_distinct("_keys")).alias("k")).where("k <> 0")
    by_site = rows.groupBy("_site", "k", "who").agg(F.lit(1).alias("one")).groupBy("_site", "k").agg(F.sum("one").alias("n"))
    by_site = stored(by_site, "p3-lines")
    here = by_site.where(F.col("n") >= PAGES).select(_own(F.col("_site"), F.col("k")).alias("key"))
    everywhere = by_site.where("k > 0").groupBy("k").agg(F.count("*").alias("sites")).where(F.col("sites") >= SITES).select(F.col("k").alias("key"))
    return here.unionByName(everywhere).distinct()


class Templates:
    """The recurrent lines of ``pages``, counted once, and what of them any part of the pages has."""

    def __init__(self, pages: DataFrame):
        self.keys = stored(recurrent_keys(_keyed(spread(pages))), "p3-recurrent")
        self.held = self.keys.count() * 8 <= BROADCAST_BYTES
        known = np.sort(np.asarray([r.key for r in self.keys.collect()], dtype=np.int64)) if self.held else None  # at most BROADCAST_BYTES
        self.shared = pages.sparkSession.sparkContext.broadcast(known)

    def mark(self, pages: DataFrame) -> DataFrame:
        """``pages`` with a column ``_recurs``, which :meth:`numbers` reads.

        The recurrent lines are few beside the lines, so their hashes usually are held by
        every task; their size is checked, and beyond the bound the pages' lines are
        joined with them instead.
        """
        keyed = _keyed(pages)
        if self.held:
            return keyed.withColumn("_recurs", F.concat(F.col("_keys"), F.transform("_keys", lambda k: _own(F.col("_site"), k)))).drop("_keys", "_site")
        lines = keyed.select("id", "_site", F.posexplode("_keys").alias("line_no", "k")).where("k <> 0")
        tries = lines.select("id", "line_no", F.explode(F.array(F.col("k"), _own(F.col("_site"), F.col("k")))).alias("key"))
        found = sized_semi_join(tries, self.keys, ["key"]).groupBy("id").agg(F.collect_set(F.col("line_no").cast("bigint")).alias("_recurs"))
        return keyed.drop("_keys", "_site").join(found, "id", "left")

    def numbers(self) -> Callable:
        """A function from a value of ``_recurs`` to the set of recurrent line numbers, for use in tasks."""
        if not self.held:
            return lambda value: set() if value is None else set(value)
        shared = self.shared

        def read(value) -> set[int]:
            known, v = shared.value, np.asarray(value, dtype=np.int64)
            if not len(known) or not len(v):
                return set()
            hit = known[np.minimum(np.searchsorted(known, v), len(known) - 1)] == v
            half = len(v) // 2
            return set(np.flatnonzero((hit[:half] | hit[half:]) & (v[:half] != 0)).tolist())

        return read
