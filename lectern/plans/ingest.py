"""The whole way of a page: clean, cut, drop what is chrome or repeated, tag, and gate by profile."""

from __future__ import annotations

from pyspark.sql import functions as F

from lectern.functions import cleaning as C
from lectern.operators import chunking, dedup, gates
from lectern.plans._base import Registry
from lectern.plans.chunks import _INTENT, _REQ
from lectern.plans.cleaning import _CLEAN

R = Registry()

_LISTY = r"(length(t) < 120 OR (len(l) >= 6 AND len(list_filter(l, lambda s: regexp_matches(s, '^[-*•>|]') OR length(s) < 30)) / greatest(len(l), 1)::DOUBLE >= 0.6) OR len(regexp_extract_all(t, '\p{L}')) / greatest(length(t), 1)::DOUBLE < 0.5)"
_HIT = " + ".join(f"CAST(({' + '.join(f'''len(regexp_extract_all(lower(t), '{p}'))''' for p in _INTENT[k])}) > 0 AS INTEGER)" for k in _REQ)


def ingested(pages, id_col: str = "id", text: str = "raw_text", size: int = 80):
    """(id, chunk_no, chunk) of the chunks of cleaned pages that are no chrome and that no earlier chunk repeats."""
    clean = pages.select(id_col, C.clean_text(F.col(text)).alias("t"))
    chunks = chunking.word_windows(clean, id_col, "t", size).where(~chunking.listy(F.col("chunk")))
    return dedup.first_by(chunks.select(id_col, "chunk_no", "chunk", F.md5(F.lower("chunk")).alias("h")), ["h"], [id_col, "chunk_no"]).select(id_col, "chunk_no", "chunk")


@R.query(
    rf"""WITH e AS (SELECT id, max(raw_text) AS raw FROM extracted_content WHERE id IS NOT NULL AND raw_text IS NOT NULL GROUP BY 1), c AS (SELECT id, {_CLEAN} AS c FROM e),
    w AS (SELECT id, list_filter(string_split(trim(regexp_replace(c, '[\s\x{{A0}}]+', ' ', 'g')), ' '), lambda x: x <> '') AS w FROM c), s AS (SELECT id, w, unnest(range(1, len(w) + 1, 68)) AS s FROM w WHERE len(w) > 0), k AS (SELECT id, CAST((s - 1) // 68 AS INTEGER) AS chunk_no, array_to_string(w[s:s + 79], ' ') AS t FROM s),
    l AS (SELECT *, [trim(t)] AS l FROM k), f AS (SELECT *, row_number() OVER (PARTITION BY md5(lower(t)) ORDER BY id, chunk_no) AS r FROM l WHERE NOT {_LISTY}), g AS (SELECT id, chunk_no, {_HIT} AS hit FROM f WHERE r = 1)
    SELECT e.id, count(g.chunk_no) AS chunks, count(*) FILTER (hit > 0) AS tagged, count(g.chunk_no) >= 6 AND count(*) FILTER (hit > 0) >= 1 AS passes FROM e LEFT JOIN g ON e.id = g.id GROUP BY 1""",
    "extracted_content",
)
def q180_ingest(pages):
    """Pages through cleaning, cutting, dropping and tagging, and whether each leaves enough."""
    one = pages.where("id is not null and raw_text is not null").groupBy("id").agg(F.max("raw_text").alias("raw_text"))
    kept = ingested(one)
    shown = gates.intent_hits(kept, "id", "chunk_no", text="chunk").where(F.col("intent").isin(list(gates.REQUIRED))).select("id", "chunk_no").distinct().groupBy("id").agg(F.count("*").alias("tagged"))
    counts = kept.groupBy("id").agg(F.count("*").alias("chunks"))
    n, t = F.coalesce("chunks", F.lit(0)), F.coalesce("tagged", F.lit(0))
    return one.select("id").join(counts, "id", "left").join(shown, "id", "left").select("id", n.alias("chunks"), t.alias("tagged"), ((n >= 6) & (t >= 1)).alias("passes"))
