"""Queries on stores, snapshots and files, checked against the tables they were made from."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from lectern.functions import links as L
from lectern.plans._base import Registry
from lectern.session import shared_dir
from lectern.sources import files, read_table, stores

R = Registry()


def _place(spark, name: str) -> str:
    return f"{shared_dir(spark).rstrip('/')}/lectern/{name}-{uuid.uuid4().hex}"


@R.query("WITH r AS (SELECT source_id, max(struct_pack(v := record_version, t := recorded_at, s := status)) AS x FROM source_record GROUP BY 1) SELECT source_id, x.v AS record_version, x.s AS status FROM r")
def q162_snapshot(spark, d):
    rows = read_table(spark, d, "source_record").select("source_id", "record_version", "recorded_at", "status")
    return files.snapshot(rows, "source_id", ["record_version", "recorded_at", "status"], _place(spark, "snapshot")).select("source_id", "record_version", "status")


@R.query(
    """WITH e AS (SELECT id, min(cleaning_status) AS status FROM extracted_content WHERE id IS NOT NULL GROUP BY 1), s AS (SELECT profile_context['profile_id'] AS id, max(status) AS st FROM source_record GROUP BY 1) SELECT e.id, coalesce(s.st, e.status) AS status FROM e LEFT JOIN s ON e.id = s.id""",
    "extracted_content",
    "source_record",
)
def q163_written_back(pages, sources):
    """Rows with the status that a later step gave them."""
    e = pages.where("id is not null").groupBy("id").agg(F.min("cleaning_status").alias("status"))
    s = sources.groupBy(F.try_element_at("profile_context", F.lit("profile_id")).alias("id")).agg(F.max("status").alias("status")).where("id is not null")
    return files.written_back(e, s, "id", ["status"])


@R.query("SELECT DISTINCT source_id FROM source_record WHERE starts_with(source_id, 'src_a') AND source_id IN (SELECT source_id FROM source_record WHERE record_version = 2)", "source_record")
def q164_prefix_fetch(sources):
    """Records whose id begins so and is among those asked for."""
    return files.fetched(files.with_prefix(sources, "source_id", "src_a"), sources.where("record_version = 2"), "source_id").select("source_id").distinct()


@R.query("SELECT doc_id, n_chars FROM documents WHERE doc_id < 300")
def q165_copied_store(spark, d):
    """A store copied in pages, broken off once and taken up from the last key."""
    schema = "doc_id bigint, n_chars bigint"
    a, b = (stores.TableStore(spark, _place(spark, "copy"), "doc_id", schema, buckets=2) for _ in range(2))
    a.upsert(read_table(spark, d, "documents").where("doc_id < 300").select("doc_id", "n_chars"))
    files.copy_store(a, b, 150, files.copy_store(a, b, 150, pages=1))
    return b.read()


@R.query(
    """WITH s AS (SELECT DISTINCT source_id, url, coalesce(profile_context['profile_name'], '') AS n FROM source_record WHERE url IS NOT NULL) SELECT source_id, CAST(0 AS INTEGER) AS place, url, trim(regexp_replace('Page of ' || n, '\\s+', ' ', 'g')) AS text FROM s""",
    "source_record",
)
def q166_page_links(sources):
    """Links of made-up pages: one to the source, one mail and one script, of which the first counts."""
    n = F.coalesce(F.try_element_at("profile_context", F.lit("profile_name")), F.lit(""))
    s = sources.where("url is not null").select("source_id", "url", n.alias("n")).distinct()
    html = F.concat(F.lit("<p>See <a class='x' href=\""), "url", F.lit("\"><b>Page of</b>\n "), "n", F.lit("</a>, <A HREF='mailto:a@b.example'>mail</A><a href=\"javascript:x()\">x</a>"))
    return L.page_links(s.select("source_id", html.alias("h")), "h", "source_id").select("source_id", "place", "url", "text")


@R.query(
    """SELECT doc_id, CASE doc_id % 6 WHEN 0 THEN 'pdf' WHEN 1 THEN 'docx' WHEN 2 THEN 'doc' WHEN 3 THEN 'rtf' WHEN 4 THEN 'html' ELSE 'text' END AS kind FROM documents""",
    "documents",
)
def q167_document_kinds(docs):
    """Kinds of files by their first bytes."""
    heads = ["25504446", "504B0304", "D0CF11E0A1B11AE1", "7B5C72746631", "3C21444F43545950452068746D6C3E", "41"]
    start = F.element_at(F.array(*[F.lit(h) for h in heads]), (F.col("doc_id") % 6 + 1).cast("int"))
    content = F.unhex(F.concat(start, F.hex(F.encode(F.coalesce("text", F.lit("")), "UTF-8"))))
    return docs.select("doc_id", files.document_kind(content).alias("kind"))


@R.query(
    """SELECT vec_id, len(embedding) AS size FROM embeddings WHERE len(embedding) = 64 AND vec_id % 10 <> 3 AND len(list_filter(embedding, lambda x: x <> 0)) > 0""",
)
def q168_vector_store(spark, d):
    """Vectors put into a store, without those of the wrong size or all zero."""
    store = stores.TableStore(spark, _place(spark, "vectors"), "vec_id", "vec_id bigint, embedding array<float>", buckets=2)
    v = read_table(spark, d, "embeddings").select(F.col("vec_id").cast("bigint").alias("vec_id"), F.when(F.col("vec_id") % 10 == 3, F.array_repeat(F.lit(0.0), 64)).otherwise(F.col("embedding")).cast("array<float>").alias("embedding"))
    files.upsert_vectors(store, v, "embedding", 64)
    return store.read().select("vec_id", F.size("embedding").cast("bigint").alias("size"))


@R.query("SELECT source, coalesce(section, 'none') AS section, doc_id FROM documents WHERE source IS NOT NULL", "documents")
def q169_nested_sections(docs):
    """Chunks nested by section for each key, and taken apart again."""
    rows = docs.where("source is not null").select("source", F.coalesce("section", F.lit("none")).alias("section"), "doc_id")
    return stores.flattened(stores.nested(rows, "source", "section"), "source", "section").select("source", "section", "doc_id")


@R.query("SELECT c_custkey, CASE WHEN c_custkey % 5 = 0 THEN 'new' ELSE c_mktsegment END AS segment FROM customer WHERE c_custkey % 7 <> 0")
def q170_store_upserts(spark, d):
    """A store after an upsert and a targeted delete, each of which rewrites only the buckets it touches."""
    store = stores.TableStore(spark, _place(spark, "store"), "c_custkey", "c_custkey bigint, segment string", buckets=4)
    rows = read_table(spark, d, "customer").select("c_custkey", F.col("c_mktsegment").alias("segment"))
    store.upsert(rows)
    store.upsert(rows.where("c_custkey % 5 = 0").withColumn("segment", F.lit("new")))
    store.delete(rows.where("c_custkey % 7 = 0"))
    return store.read()


@R.query("SELECT c_custkey, 'kept' AS place FROM customer WHERE c_nationkey = 3 UNION ALL SELECT c_custkey, 'archive' FROM customer WHERE c_nationkey <> 3")
def q171_archived(spark, d):
    """All customers but one nation's moved to an archive, and both stores counted."""
    schema = "c_custkey bigint, c_nationkey int"
    a, b = (stores.TableStore(spark, _place(spark, "archive"), "c_custkey", schema, buckets=2) for _ in range(2))
    a.upsert(read_table(spark, d, "customer").select("c_custkey", F.col("c_nationkey").cast("int")))
    a.archive(F.col("c_nationkey") == 3, b)
    return a.read().select("c_custkey", F.lit("kept").alias("place")).unionByName(b.read().select("c_custkey", F.lit("archive").alias("place")))


@R.query(
    """WITH g AS (SELECT DISTINCT profile_id FROM collected_meta WHERE field IS NOT NULL) SELECT 'meta' AS part, count(*) AS rows FROM collected_meta WHERE profile_id NOT IN (SELECT profile_id FROM g) UNION ALL SELECT 'pages', count(*) FROM extracted_content WHERE id IS NULL OR id NOT IN (SELECT profile_id FROM g)""",
    "collected_meta",
    "extracted_content",
)
def q172_cascade(meta, pages):
    """Rows that are left in each table after profiles were deleted from all."""
    gone = meta.where("field is not null").select("profile_id").distinct()
    left = files.deleted_everywhere({"meta": meta, "pages": pages.withColumnRenamed("id", "profile_id")}, gone, "profile_id")
    counts = [t.agg(F.count("*").alias("rows")).select(F.lit(n).alias("part"), "rows") for n, t in left.items()]
    return counts[0].unionByName(counts[1])


@R.query("SELECT id FROM extracted_content WHERE coalesce(cleaning_status, '') <> 'cleaned' OR trim(coalesce(cleaned_text, '')) = '' GROUP BY 1", "extracted_content")
def q173_pending(pages):
    """Records that still have to be cleaned."""
    return pages.where((F.coalesce("cleaning_status", F.lit("")) != "cleaned") | (F.trim(F.coalesce("cleaned_text", F.lit(""))) == "")).select("id").distinct()


@R.query(
    """WITH c AS (SELECT DISTINCT profile_id FROM documents WHERE profile_id IS NOT NULL), s AS (SELECT DISTINCT id FROM extracted_content WHERE id NOT IN (SELECT profile_id FROM c)) SELECT profile_id, 'chunked' AS stage FROM c UNION ALL SELECT id, 'cache' FROM s WHERE id IS NOT NULL""",
    "documents",
    "extracted_content",
)
def q174_priority_union(docs, pages):
    """Profiles with chunks, and from the stage before those that have none."""
    from lectern.operators import dedup

    chunked = docs.where("profile_id is not null").select("profile_id").distinct().withColumn("stage", F.lit("chunked"))
    cache = pages.where("id is not null").select(F.col("id").alias("profile_id")).distinct().withColumn("stage", F.lit("cache"))
    return dedup.priority_union(chunked, cache, ["profile_id"])


@R.query("SELECT doc_id, 0 AS kind, CAST(length(text) AS BIGINT) AS chars FROM documents WHERE text IS NOT NULL AND length(text) > 0 UNION ALL SELECT o_custkey, 1, CAST(round(exp(avg(ln(o_totalprice)))) AS BIGINT) FROM orders GROUP BY 1")
def q175_udfs_in_sql(spark, d):
    """A table function and an aggregate function of one's own, called in SQL: the pieces of each text add up to it."""
    from lectern.functions.udfs import register

    register(spark)
    read_table(spark, d, "documents").createOrReplaceTempView("lectern_documents")
    read_table(spark, d, "orders").createOrReplaceTempView("lectern_orders")
    return spark.sql(
        """SELECT doc_id, 0 AS kind, max(start + length(chunk)) AS chars FROM lectern_documents, LATERAL seventy_chunks(text, 1000) WHERE length(text) > 0 GROUP BY doc_id
        UNION ALL SELECT o_custkey, 1, CAST(round(geometric_mean(o_totalprice)) AS BIGINT) FROM lectern_orders GROUP BY o_custkey"""
    ).select("doc_id", "kind", F.col("chars").cast("bigint").alias("chars"))
