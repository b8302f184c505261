"""The queries of the ten problems and, where SQL can state them, their SQL."""

from __future__ import annotations

import secrets
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lectern.llm import leakage, linkage, main_text, names, packing, pii, quality, repeated_lines, residue, segment
from lectern.sources import read_table


def _pages(spark: SparkSession, d: str) -> DataFrame:
    return read_table(spark, d, "extracted_content")


def _meta(spark: SparkSession, d: str) -> DataFrame:
    return read_table(spark, d, "collected_meta")


def p1_found(spark, d):
    return segment.oversized(_pages(spark, d))


def p1_pieces(spark, d):
    return segment.pieces(_pages(spark, d))


def p1_cover(spark, d):
    """Of each text what its pieces cover, overlaps counted once, and whether each keeps the limits."""
    found = segment.pieces(_pages(spark, d)).groupBy("id").agg(
        F.sum((F.col("end") - F.col("start") - F.col("overlap")).cast("bigint")).alias("chars"),
        ((F.max(F.length("piece")) <= segment.LIMIT) & (F.max("overlap") <= segment.OVERLAP) & (F.min("start") == 0)).alias("fits"),
        (F.count("*") > 1).alias("cut"),
        F.md5(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("piece_no", F.expr("substring(piece, overlap + 1)").alias("p")))), lambda x: x["p"]), "")).alias("text_md5"),
    )
    return found


def _p2_tables(spark, d):
    return _meta(spark, d), read_table(spark, d, "match_decision"), read_table(spark, d, "institution")


def p2_found(spark, d):
    return names.pairs(*_p2_tables(spark, d))


def p2_persons(spark, d):
    return names.linked(*_p2_tables(spark, d))


def p3_found(spark, d):
    return main_text.boilerplate(_pages(spark, d), read_table(spark, d, "source_record"))


def p3_main_text(spark, d):
    return main_text.main_text(_pages(spark, d), read_table(spark, d, "source_record"))


def p4_found(spark, d):
    return pii.found_items(_pages(spark, d), _meta(spark, d))


def _p4_key(spark) -> str:
    """The caller's key; without one a key that nobody keeps, so that pseudonyms can't be undone later."""
    return spark.conf.get("spark.lectern.pii.key", None) or secrets.token_hex(32)


def p4_redacted(spark, d):
    return pii.redacted(_pages(spark, d), _p4_key(spark), _meta(spark, d))


def p4_restored(spark, d):
    """The texts again, from the redacted ones, their key and their tags."""
    pages, meta, key = _pages(spark, d), _meta(spark, d), _p4_key(spark)
    return pii.restored(pii.redacted(pages, key, meta), pages, key, meta).select("id", F.md5("raw_text").alias("text_md5"))


def p5_found(spark, d):
    store, _ = repeated_lines.store_of(_pages(spark, d), _meta(spark, d))
    return store.lines()


def p5_cleaned(spark, d):
    pages = _pages(spark, d)
    store, rebuilt = repeated_lines.store_of(pages, _meta(spark, d))
    return repeated_lines.rebuilt_texts(pages, store, rebuilt)


def p5_rebuilt(spark, d):
    """Pages that each delta made necessary to rebuild."""
    _, rebuilt = repeated_lines.store_of(_pages(spark, d), _meta(spark, d))
    return rebuilt[0].withColumn("delta", F.lit(0)).unionByName(rebuilt[1].withColumn("delta", F.lit(1)))


def p6_found(spark, d):
    return residue.residue(_pages(spark, d), read_table(spark, d, "source_record"))


def p6_scored(spark, d):
    return residue.scored(_pages(spark, d), read_table(spark, d, "source_record"))


def p7_found(spark, d):
    return p7_matches(spark, d).select("image_profile_id", "decision_id")


def p7_matches(spark, d):
    return linkage.matches(*(read_table(spark, d, t) for t in ("image_record", "match_decision", "institution")))


def p8_containers(spark, d):
    return packing.pack(packing.token_counts(read_table(spark, d, "documents")))


def p8_invariants(spark, d):
    """What holds of any packing: each document once, nothing over the capacity, no text cut that fits, little room left."""
    docs = read_table(spark, d, "documents")
    packed = packing.pack(packing.token_counts(docs))
    loads = packed.where("container is not null").groupBy("container").agg(F.sum("n_tokens").alias("load"), F.count("*").alias("n"))
    whole = loads.agg(F.max("load").alias("most"), (F.sum("load") / F.count("*") / packing.CAPACITY).alias("fill"))
    each = packed.groupBy("doc_id").agg(F.count("*").alias("parts"), F.sum("n_tokens").alias("tokens"))
    cut = each.agg(F.count("*").alias("docs"), F.count_if((F.col("parts") > 1) & (F.col("tokens") <= packing.CAPACITY)).alias("needless_cuts"))
    return cut.crossJoin(whole).select("docs", "needless_cuts", (F.col("most") <= packing.CAPACITY).alias("fits"), (F.col("fill") >= 0.99).alias("full"))  # one row each


def p9_found(spark, d):
    return leakage.leaks(read_table(spark, d, "documents"), read_table(spark, d, "eval_item")).select("doc_id", "item_id")


def p9_leaks(spark, d):
    found = leakage.leaks(read_table(spark, d, "documents"), read_table(spark, d, "eval_item"), paraphrases=True)
    return found.select("doc_id", "item_id", F.round("cosine", 3).alias("cosine"), "run_hits", F.round("lcs_share", 3).alias("lcs_share"))


def p10_found(spark, d):
    return quality.not_prose(read_table(spark, d, "documents"), read_table(spark, d, "doc_label"))


def p10_stats(spark, d):
    return quality.scored(read_table(spark, d, "documents"), read_table(spark, d, "doc_label"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = [
        p1_found, p1_pieces, p1_cover, p2_found, p2_persons, p3_found, p3_main_text, p4_found, p4_redacted, p4_restored, p5_found, p5_cleaned, p5_rebuilt,
        p6_found, p6_scored, p7_found, p7_matches, p8_containers, p8_invariants, p9_found, p9_leaks, p10_found, p10_stats,
    ]
    return {f.__name__: f for f in found}


_P5_LINES = r"""
m AS (SELECT profile_id AS id, min(lower(trim(source_host))) AS host FROM collected_meta WHERE length(trim(source_host)) > 0 GROUP BY 1),
e AS (SELECT DISTINCT id, raw_text FROM extracted_content WHERE id IS NOT NULL AND raw_text IS NOT NULL),
l AS (SELECT id, unnest(string_split(raw_text, chr(10))) AS line, unnest(range(0, len(string_split(raw_text, chr(10))))) AS n FROM e),
k AS (SELECT l.id, host, CAST(n AS INTEGER) AS line_no, regexp_replace(lower(line), '[^\p{L}]', '', 'g') AS k FROM l JOIN m ON l.id = m.id),
g AS (SELECT host, k FROM k WHERE length(k) >= 25 GROUP BY 1, 2 HAVING count(DISTINCT id) >= 8)"""


def oracle_sql() -> dict[str, str]:
    return {
        "p1_found": "SELECT DISTINCT id FROM extracted_content WHERE length(cleaned_text) > 4000",
        "p1_cover": "SELECT id, length(max(cleaned_text)) AS chars, true AS fits, length(max(cleaned_text)) > 4000 AS cut, md5(max(cleaned_text)) AS text_md5 FROM extracted_content WHERE id IS NOT NULL AND cleaned_text IS NOT NULL GROUP BY id",
        "p8_invariants": "SELECT count(DISTINCT doc_id) AS docs, 0::BIGINT AS needless_cuts, true AS fits, true AS full FROM documents",
        "p4_restored": "SELECT id, md5(max(raw_text)) AS text_md5 FROM extracted_content WHERE id IS NOT NULL GROUP BY id",
        "p5_found": f"WITH {_P5_LINES} SELECT k.id, k.line_no FROM k JOIN g ON k.host = g.host AND k.k = g.k",
        "p5_cleaned": f"""WITH {_P5_LINES},
            c AS (SELECT DISTINCT k.id, k.line_no FROM k JOIN g ON k.host = g.host AND k.k = g.k),
            r AS (SELECT id, count(*) AS removed FROM c GROUP BY 1),
            t AS (SELECT l.id, string_agg(line, chr(10) ORDER BY n) AS kept FROM l ANTI JOIN c ON l.id = c.id AND l.n = c.line_no GROUP BY 1)
            SELECT e.id, CASE WHEN r.id IS NULL THEN e.raw_text ELSE coalesce(t.kept, '') END AS raw_text, CAST(coalesce(r.removed, 0) AS INTEGER) AS removed
            FROM e LEFT JOIN r ON e.id = r.id LEFT JOIN t ON e.id = t.id""",
        "p5_rebuilt": f"""WITH {_P5_LINES},
            s AS (SELECT min(epoch(scraped_at)) AS a, greatest(max(epoch(scraped_at)) - min(epoch(scraped_at)), 1) AS w FROM extracted_content),
            b AS (SELECT e.id, CAST(max(least(floor((coalesce(epoch(scraped_at), a) - a) / w * 2), 1)) AS INTEGER) AS delta FROM extracted_content e JOIN m ON e.id = m.id, s GROUP BY 1),
            c AS (SELECT host, k FROM k JOIN b ON k.id = b.id WHERE length(k) >= 25 GROUP BY 1, 2 HAVING count(DISTINCT k.id) FILTER (delta = 0) < 8 AND count(DISTINCT k.id) >= 8)
            SELECT id, delta FROM b UNION SELECT k.id, 1 FROM k JOIN c ON k.host = c.host AND k.k = c.k""",
        "p9_found": r"""WITH
            t AS (SELECT doc_id, regexp_extract_all(lower(text), '[\p{L}\p{N}]+') AS w FROM documents),
            u AS (SELECT item_id, regexp_extract_all(lower(item_text), '[\p{L}\p{N}]+') AS w FROM eval_item),
            a AS (SELECT DISTINCT doc_id, array_to_string(w[i:i + 12], ' ') AS r FROM (SELECT doc_id, w, unnest(range(1, len(w) - 11)) AS i FROM t)),
            b AS (SELECT DISTINCT item_id, array_to_string(w[i:i + 12], ' ') AS r FROM (SELECT item_id, w, unnest(range(1, len(w) - 11)) AS i FROM u))
            SELECT DISTINCT doc_id, item_id FROM a JOIN b ON a.r = b.r""",
    }
