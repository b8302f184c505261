"""Queries on texts: hashing, quality, cleaning, language, simhash."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lectern.functions import text as T
from lectern.operators import dedup, simhash
from lectern.plans._base import Registry

R = Registry()

_HASH = r"sha256(lower(trim(regexp_replace(text, '[\s\x{A0}]+', ' ', 'g'))))"


@R.query(f"SELECT doc_id, first_value(doc_id) OVER (PARTITION BY h ORDER BY doc_id) AS first_doc, count(*) OVER (PARTITION BY h) AS copies FROM (SELECT doc_id, {_HASH} AS h FROM documents)", "documents")
def q01_exact_duplicates(docs):
    hashed = docs.select("doc_id", T.text_hash(F.col("text")).alias("h"))
    return dedup.class_of_copies(hashed, "h", "doc_id", "first_doc", "copies")


_LINES = r"list_filter(list_transform(string_split(text, chr(10)), lambda s: trim(regexp_replace(s, '^[\s\x{A0}]+|[\s\x{A0}]+$', '', 'g'))), lambda s: s <> '')"


@R.query(
    rf"""SELECT doc_id, CAST(len(regexp_extract_all(text, '[\p{{L}}\p{{N}}_]+')) AS INTEGER) AS word_count, CAST(len({_LINES}) AS INTEGER) AS line_count,
    round(coalesce(len(regexp_extract_all(text, '[\x20-\x7e]')) / nullif(length(text), 0)::DOUBLE, 0), 4) AS ascii_ratio,
    round(len(list_filter({_LINES}, lambda s: regexp_matches(lower(s), '{T.BOILERPLATE}'))) / greatest(len({_LINES}), 1)::DOUBLE, 4) AS boilerplate_ratio FROM documents""",
    "documents",
)
def q02_quality_metrics(docs):
    t = F.col("text")
    return docs.select("doc_id", T.word_count(t).alias("word_count"), F.size(T.lines_of(t)).alias("line_count"), T.ascii_ratio(t).alias("ascii_ratio"), T.boilerplate_ratio(t).alias("boilerplate_ratio"))


@R.query(
    f"""SELECT id, bool_or(coalesce(regexp_matches(raw_text, '{T.EMAIL}'), false)) AS email, bool_or(coalesce(regexp_matches(raw_text, '{T.PHONE}'), false)) AS phone,
    bool_or(coalesce(regexp_matches(raw_text, '{T.ADDRESS}'), false)) AS address FROM extracted_content GROUP BY id""",
    "extracted_content",
)
def q03_pii_flags(pages):
    t = F.col("raw_text")
    return pages.groupBy("id").agg(F.bool_or(T.contains_email(t)).alias("email"), F.bool_or(T.contains_phone(t)).alias("phone"), F.bool_or(T.contains_address(t)).alias("address"))


def _lang_sql(table: str) -> str:
    def counted(k):
        return f"len(list_filter(w, lambda t: t IN ({', '.join(repr(s) for s in T.STOPWORDS[k])})))"

    return rf"""WITH t AS (SELECT *, regexp_extract_all(lower(text), '[\p{{L}}]{{2,}}') AS w FROM {table}),
    c AS (SELECT *, len(w) AS n, {', '.join(f'{counted(k)} AS c_{k}' for k in T.STOPWORDS)} FROM t),
    b AS (SELECT *, greatest(c_en, c_fr, c_es, c_de) AS best FROM c),
    r AS (SELECT *, best / greatest(n, 1)::DOUBLE AS ratio FROM b),
    g AS (SELECT *, CASE WHEN text IS NULL OR length(text) < 40 OR n = 0 OR ratio < 0.10 THEN 'unknown' WHEN c_en = best THEN 'en' WHEN c_fr = best THEN 'fr' WHEN c_es = best THEN 'es' ELSE 'de' END AS detected,
      CASE WHEN text IS NULL OR length(text) < 40 OR n = 0 THEN 0 WHEN ratio < 0.10 THEN round(0.1 * ratio, 4) ELSE round(least(0.85, 0.35 + ratio), 4) END AS confidence FROM r)"""


@R.query(_lang_sql("documents") + " SELECT coalesce(lang, 'none') AS lang, detected, count(*) AS docs, round(avg(confidence), 4) AS confidence FROM g GROUP BY 1, 2", "documents")
def q04_language_confusion(docs):
    found = T.with_language(docs.select("lang", "text"), "text", "detected", "c").select(F.coalesce("lang", F.lit("none")).alias("lang"), "detected", "c")
    return found.groupBy("lang", "detected").agg(F.count("*").alias("docs"), F.round(F.avg("c"), 4).alias("confidence"))


_REASONABLE = r"coalesce(length(text) BETWEEN 50 AND 200000 AND round(coalesce(len(regexp_extract_all(text, '[\x20-\x7e]')) / nullif(length(text), 0)::DOUBLE, 0), 4) >= 0.6, false)"


@R.query(f"SELECT section, count(*) AS docs, count(*) FILTER ({_REASONABLE}) AS kept FROM documents GROUP BY section", "documents")
def q05_reasonable_text(docs):
    return docs.groupBy("section").agg(F.count("*").alias("docs"), F.count_if(T.reasonable(F.col("text"))).alias("kept"))


_NOISE_SQL = rf"""(trim(line) = '' OR regexp_matches(lower(line), '{T.NOISE}') OR regexp_matches(lower(line), 'reference id[:\s-]*[a-z0-9-]{{6,}}')
  OR len(regexp_extract_all(lower(line), 'page\s+[0-9]+\s+of\s+[0-9]+')) >= 2
  OR (len(regexp_extract_all(line, '[0-9]')) >= 12 AND len(regexp_extract_all(line, '\p{{L}}')) <= len(regexp_extract_all(line, '[0-9]'))))"""


@R.query(
    f"""WITH e AS (SELECT DISTINCT id, raw_text FROM extracted_content), s AS (SELECT id, string_split(raw_text, chr(10)) AS a FROM e),
    l AS (SELECT id, unnest(a) AS line, unnest(range(0, len(a))) AS n FROM s),
    k AS (SELECT id, n, lower(trim(line)) AS k FROM l WHERE NOT {_NOISE_SQL}),
    f AS (SELECT id, k, row_number() OVER (PARTITION BY id, k ORDER BY n) AS r FROM k)
    SELECT id, count(*) AS kept, count(*) FILTER (r = 1) AS distinct_lines FROM f GROUP BY id""",
    "extracted_content",
)
def q06_line_filter(pages):
    """Lines kept by the noise filter, and of them the first occurrences in each page."""
    one = pages.select("id", "raw_text").distinct()
    lines = one.select("id", F.explode(F.split("raw_text", "\n")).alias("line")).where(~T.noise_line(F.col("line")))
    return lines.groupBy("id").agg(F.count("*").alias("kept"), F.countDistinct(F.lower(F.trim("line"))).alias("distinct_lines"))


_PLAIN = r"regexp_replace(regexp_replace(regexp_replace(text, '[\\/\n\r\t]', ' ', 'g'), '(?i)(?:page\s+[0-9]+\s+of\s+[0-9]+[\s,;:]*){2,}', ' ', 'g'), '(?i)reference id[:\s-]*[a-z0-9-]{6,}', ' ', 'g')"


@R.query(rf"SELECT doc_id, md5(trim(regexp_replace({_PLAIN}, '[\s\x{{A0}}]+', ' ', 'g'))) AS cleaned_md5 FROM documents", "documents")
def q07_final_cleanup(docs):
    return docs.select("doc_id", F.md5(T.without_symbols(F.col("text"))).alias("cleaned_md5"))


_SIMHASH_SQL = r"""t AS (SELECT doc_id, unnest(regexp_extract_all(lower(text), '[\p{L}\p{N}_]+')) AS w FROM documents),
    h AS (SELECT doc_id, CAST('0x' || substr(md5(w), 1, 16) AS UBIGINT) AS h, count(*) AS n FROM t GROUP BY ALL),
    b AS (SELECT doc_id, i, sum(CASE WHEN (h >> i) & 1 = 1 THEN n ELSE -n END) AS s FROM h, range(0, 64) r(i) GROUP BY doc_id, i),
    f AS (SELECT doc_id, bit_or(CASE WHEN s > 0 THEN CAST(1 AS UBIGINT) << i::UBIGINT ELSE CAST(0 AS UBIGINT) END) AS v FROM b GROUP BY doc_id)"""


@R.query(f"WITH {_SIMHASH_SQL} SELECT d.doc_id, '0x' || lpad(lower(to_hex(coalesce(v, 0))), 16, '0') AS simhash FROM documents d LEFT JOIN f ON d.doc_id = f.doc_id", "documents")
def q08_simhash(docs):
    return simhash.fingerprints(docs).select("doc_id", "simhash")


@R.query(
    f"""WITH RECURSIVE {_SIMHASH_SQL},
    g AS (SELECT v, min(doc_id) AS rep FROM (SELECT d.doc_id, coalesce(v, 0) AS v FROM documents d LEFT JOIN f ON d.doc_id = f.doc_id) GROUP BY v),
    e AS (SELECT a.v AS a, b.v AS b FROM g a JOIN g b ON a.v <> b.v AND bit_count(xor(a.v, b.v)) <= 3),
    c AS (SELECT v, rep FROM g UNION SELECT e.b, c.rep FROM c JOIN e ON c.v = e.a),
    k AS (SELECT v, min(rep) AS class FROM c GROUP BY v), n AS (SELECT a, count(*) AS links FROM e GROUP BY a)
    SELECT d.doc_id, k.class AS class_id, coalesce(n.links, 0) AS links FROM documents d LEFT JOIN f ON d.doc_id = f.doc_id JOIN k ON k.v = coalesce(f.v, 0) LEFT JOIN n ON n.a = coalesce(f.v, 0)""",
    "documents",
)
def q08_simhash_classes(docs):
    """One row a document: its class of near copies (Hamming distance 3 at most) and its links to other fingerprints."""
    return simhash.classes(docs)


@R.query(
    _lang_sql("documents")
    + f""", h AS (SELECT *, {_REASONABLE} AS ok, row_number() OVER (PARTITION BY {_HASH} ORDER BY doc_id) = 1 AS first,
      round(len(list_filter({_LINES}, lambda s: regexp_matches(lower(s), '{T.BOILERPLATE}'))) / greatest(len({_LINES}), 1)::DOUBLE, 4) < 0.3 AS clean FROM g)
    SELECT detected AS language, count(*) AS docs, count(*) FILTER (ok) AS reasonable, count(*) FILTER (ok AND first) AS unique_docs, count(*) FILTER (ok AND first AND clean) AS kept,
      coalesce(CAST(sum(CASE WHEN ok AND first AND clean THEN len(regexp_extract_all(text, '[\\p{{L}}\\p{{N}}_]+')) END) AS BIGINT), 0) AS kept_words FROM h GROUP BY detected""",
    "documents",
)
def q09_curation_funnel(docs):
    """How many documents of each language pass length, uniqueness and page chrome."""
    t = F.col("text")
    seen = T.with_language(docs.select("doc_id", "text")).select(
        "doc_id", "language", T.text_hash(t).alias("h"), T.reasonable(t).alias("ok"), (T.boilerplate_ratio(t) < 0.3).alias("clean"), T.word_count(t).cast("bigint").alias("words")
    )
    firsts = seen.groupBy("h").agg(F.min("doc_id").alias("doc_id"), F.lit(True).alias("first")).select("doc_id", "first")
    joined = seen.join(firsts, "doc_id", "left").withColumn("first", F.coalesce("first", F.lit(False)))
    keep = F.col("ok") & F.col("first") & F.col("clean")
    return joined.groupBy("language").agg(
        F.count("*").alias("docs"), F.count_if("ok").alias("reasonable"), F.count_if(F.col("ok") & F.col("first")).alias("unique_docs"), F.count_if(keep).alias("kept"), F.coalesce(F.sum(F.when(keep, F.col("words"))), F.lit(0)).alias("kept_words")
    )


@R.query(
    rf"""WITH c AS (SELECT doc_id, list_filter({_LINES}, lambda s: length(s) >= 4 AND NOT regexp_matches(lower(s), '^(loading|sign in|log in|search\b|menu|skip to content|cookie|shopping basket|shopping cart|home page|return to top|back to top|site archived|=== ?profile page|=== ?seed url)')) AS l FROM documents)
    SELECT doc_id, coalesce(rtrim(substr(l[1], 1, 120)), '') AS derived_title FROM c""",
    "documents",
)
def q10_derived_title(docs):
    return docs.select("doc_id", T.title_of(F.col("text")).alias("derived_title"))


@R.query(
    r"""WITH w AS (SELECT doc_id, list_transform(regexp_extract_all(lower(text), '[\p{L}\p{N}_]+'), lambda x: x) AS a FROM documents WHERE text IS NOT NULL),
    p AS (SELECT doc_id, unnest(a) AS word, unnest(range(0, len(a))) AS pos FROM w)
    SELECT doc_id, word, string_agg(pos, ',' ORDER BY pos) AS positions FROM p WHERE length(word) >= 9 GROUP BY doc_id, word""",
    "documents",
)
def q11_inverted_index(docs):
    """Positions of each long word in each document."""
    words = docs.select("doc_id", F.posexplode(T.tokens(F.col("text"))).alias("pos", "word")).where("length(word) >= 9")
    return words.groupBy("doc_id", "word").agg(F.array_join(F.transform(F.array_sort(F.collect_list("pos")), lambda p: p.cast("string")), ",").alias("positions"))


@R.query(
    r"""WITH w AS (SELECT doc_id, regexp_extract_all(lower(text), '[\p{L}\p{N}_]+') AS a FROM documents WHERE text IS NOT NULL),
    p AS (SELECT doc_id, unnest(a) AS word, unnest(range(0, len(a))) AS pos FROM w)
    SELECT doc_id, md5(string_agg(word, ' ' ORDER BY pos)) AS rebuilt_md5 FROM p GROUP BY doc_id""",
    "documents",
)
def q12_index_round_trip(docs):
    """Texts put together again from their inverted index."""
    index = docs.select("doc_id", F.posexplode(T.tokens(F.col("text"))).alias("pos", "word")).groupBy("doc_id", "word").agg(F.collect_list("pos").alias("at"))
    back = index.select("doc_id", "word", F.explode("at").alias("pos")).groupBy("doc_id").agg(F.array_sort(F.collect_list(F.struct("pos", "word"))).alias("w"))
    return back.select("doc_id", F.md5(F.array_join("w.word", " ")).alias("rebuilt_md5"))
