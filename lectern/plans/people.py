"""Queries that join people, and reports on them."""

from __future__ import annotations

from pyspark.sql import functions as F

from lectern.functions import text as T
from lectern.operators import dedup, identity, reports
from lectern.plans._base import Registry

R = Registry()


def _plain_name(c: str) -> str:
    return rf"trim(regexp_replace(regexp_replace(list_reduce(list_prepend('', list_filter(string_split_regex(lower({c}), '[ .,]+'), lambda w: w <> '' AND w NOT IN ('assoc','prof','professor','dr','phd','md','faas','jr','iii'))), lambda a, b: a || ' ' || b), '[^\p{{L}} -]', ' ', 'g'), '[\s\x{{A0}}]+', ' ', 'g'))"


@R.query(
    """WITH m AS (SELECT DISTINCT profile_id, source_host FROM collected_meta), d AS (SELECT institution_id, institution_name, web_domain FROM institution),
    j AS (SELECT m.profile_id, d.institution_name FROM m JOIN d ON lower(trim(m.source_host)) = d.web_domain OR lower(trim(m.source_host)) LIKE '%.' || d.web_domain)
    SELECT d.institution_name, count(j.profile_id) AS profiles FROM d LEFT JOIN j ON j.institution_name = d.institution_name GROUP BY 1""",
    "collected_meta",
    "institution",
)
def q36_profiles_by_institution(meta, inst):
    """Profiles of each institution by the end of their host: equi-joins on the host's suffixes, no LIKE join."""
    host = F.split(F.lower(F.trim("source_host")), r"\.")
    ends = F.transform(F.sequence(F.lit(1), F.size(host)), lambda i: F.array_join(F.slice(host, i, F.size(host)), "."))
    keyed = meta.select("profile_id", "source_host").distinct().where("source_host is not null").select("profile_id", F.explode(ends).alias("web_domain"))
    counted = keyed.join(inst.select("institution_name", "web_domain"), "web_domain").groupBy("institution_name").agg(F.count("*").alias("n"))
    return inst.select("institution_name").distinct().join(counted, "institution_name", "left").select("institution_name", F.coalesce("n", F.lit(0)).alias("profiles"))


@R.query(
    """WITH m AS (SELECT DISTINCT profile_id, field FROM collected_meta), d AS (SELECT DISTINCT lower(trim(scholar_department)) AS dept FROM match_decision WHERE trim(scholar_department) <> ''),
    c AS (SELECT lower(field) AS field, count(*) AS profiles FROM m WHERE field IS NOT NULL GROUP BY 1)
    SELECT c.field, c.profiles, d.dept IS NOT NULL AS known FROM c LEFT JOIN d ON c.field = d.dept""",
    "collected_meta",
    "match_decision",
)
def q37_fields_and_unmatched(meta, decisions):
    """Profiles by field, and whether any decision knows the field."""
    counted = meta.select("profile_id", "field").distinct().where("field is not null").groupBy(F.lower("field").alias("field")).agg(F.count("*").alias("profiles"))
    dims = decisions.select(F.lower(F.trim("scholar_department")).alias("field")).where("field <> ''").distinct().withColumn("k", F.lit(True))
    return counted.join(dims, "field", "left").select("field", "profiles", F.coalesce("k", F.lit(False)).alias("known"))


@R.query(
    """WITH s AS (SELECT profile_context['profile_id'] AS pid, count(DISTINCT source_id) AS sources, round(avg(content.language_confidence), 4) AS confidence FROM source_record GROUP BY 1),
    m AS (SELECT profile_id, min(profile_name) AS name FROM collected_meta GROUP BY 1)
    SELECT m.profile_id, m.name, coalesce(s.sources, 0) AS sources, s.confidence FROM m LEFT JOIN s ON m.profile_id = s.pid ORDER BY sources DESC, confidence DESC NULLS LAST, lower(name), m.profile_id LIMIT 25 OFFSET 25""",
    "collected_meta",
    "source_record",
)
def q38_profile_page(meta, sources):
    """The second page of 25 profiles by number of sources, confidence and name."""
    s = sources.groupBy(F.try_element_at("profile_context", F.lit("profile_id")).alias("profile_id")).agg(F.countDistinct("source_id").alias("sources"), F.round(F.avg("content.language_confidence"), 4).alias("confidence"))
    m = meta.groupBy("profile_id").agg(F.min("profile_name").alias("name"))
    listed = m.join(s, "profile_id", "left").select("profile_id", "name", F.coalesce("sources", F.lit(0)).alias("sources"), "confidence")
    return listed.orderBy(F.col("sources").desc(), F.col("confidence").desc_nulls_last(), F.lower("name"), "profile_id").offset(25).limit(25)


@R.query(
    rf"""WITH e AS (SELECT DISTINCT id, profile_name FROM extracted_content), m AS (SELECT DISTINCT profile_id, profile_name, coalesce(field, 'none') AS field FROM collected_meta),
    a AS (SELECT profile_id, min(field) AS f FROM m GROUP BY 1), n AS (SELECT {_plain_name('profile_name')} AS nm, arg_min(field, profile_id) AS f FROM m GROUP BY 1),
    j AS (SELECT e.id, a.f AS by_key, CASE WHEN {_plain_name('e.profile_name')} <> '' THEN n.f END AS by_name FROM e LEFT JOIN a ON e.id = a.profile_id LEFT JOIN n ON {_plain_name('e.profile_name')} = n.nm)
    SELECT id, CASE WHEN by_key IS NOT NULL THEN 'key' WHEN by_name IS NOT NULL THEN 'name' ELSE 'none' END AS matched_by FROM j""",
    "extracted_content",
    "collected_meta",
)
def q39_fallback_join(pages, meta):
    """Pages with their profile by key, else by plain name."""
    left = pages.select("id", "profile_name").distinct()
    right = meta.select("profile_id", F.col("profile_name").alias("n"), F.coalesce("field", F.lit("none")).alias("field")).distinct()
    words = lambda c: F.filter(F.split(F.lower(c), "[ .,]+"), lambda w: (w != "") & ~w.isin("assoc", "prof", "professor", "dr", "phd", "md", "faas", "jr", "iii"))
    name = lambda c: T.collapsed(F.regexp_replace(F.array_join(words(c), " "), r"[^\p{L} -]", " "))
    found = identity.with_fallback(left, right, ("id", "profile_id"), (name(F.col("profile_name")), name(F.col("n"))), "field", "profile_id")
    return found.select("id", "matched_by")


@R.query(
    r"""WITH i AS (SELECT DISTINCT profile_id, lower(trim(name)) AS nm, lower(trim(university)) AS un FROM image_record),
    d AS (SELECT decision_id, min(lower(trim(scholar_name))) AS nm, min(lower(trim(scholar_institution))) AS un FROM match_decision GROUP BY 1),
    v AS (SELECT decision_id, 0 AS rank, nm || '|' || un AS k FROM d UNION ALL SELECT decision_id, 1, regexp_replace(nm, '^(prof\.|dr\.?|professor) +', '') || '|' || un FROM d),
    h AS (SELECT v.decision_id, rank, count(DISTINCT i.profile_id) AS n, min(i.profile_id) AS m FROM v JOIN i ON v.k = i.nm || '|' || i.un GROUP BY 1, 2),
    b AS (SELECT decision_id, arg_min(n, rank) AS n, arg_min(m, rank) AS m FROM h GROUP BY 1)
    SELECT d.decision_id, coalesce(n, 0) AS candidates, CASE WHEN n = 1 THEN m END AS match, CASE WHEN n IS NULL THEN 'unmatched' WHEN n = 1 THEN 'matched' ELSE 'ambiguous' END AS status FROM d LEFT JOIN b ON d.decision_id = b.decision_id""",
    "match_decision",
    "image_record",
)
def q40_match_status(decisions, images):
    """Decisions with their image by name and institution: one candidate matches, more are ambiguous."""
    d = decisions.groupBy("decision_id").agg(F.min(F.lower(F.trim("scholar_name"))).alias("nm"), F.min(F.lower(F.trim("scholar_institution"))).alias("un"))
    variants = [F.concat("nm", F.lit("|"), "un"), F.concat(F.regexp_replace("nm", r"^(prof\.|dr\.?|professor) +", ""), F.lit("|"), "un")]
    return identity.candidate_status(d, images, variants, "decision_id", F.concat(F.lower(F.trim("name")), F.lit("|"), F.lower(F.trim("university"))), "profile_id")


@R.query(
    """WITH m AS (SELECT DISTINCT profile_id, profile_url, lower(email) AS email FROM collected_meta),
    k AS (SELECT profile_context['profile_id'] AS k FROM source_record UNION SELECT url FROM source_record UNION SELECT final_url FROM source_record)
    SELECT DISTINCT profile_id FROM m WHERE profile_id IN (SELECT k FROM k WHERE k <> '') OR profile_url IN (SELECT k FROM k WHERE k <> '')""",
    "collected_meta",
    "source_record",
)
def q41_any_key_semi(meta, sources):
    """Profiles that any source names by id or by link."""
    left = meta.select("profile_id", "profile_url").distinct()
    right = sources.select(F.try_element_at("profile_context", F.lit("profile_id")).alias("p"), "url", "final_url")
    return identity.any_key_semi(left, right, ["profile_id", "profile_url"], ["p", "url", "final_url"], "profile_id").select("profile_id").distinct()


@R.query(
    """SELECT (SELECT count(DISTINCT profile_id) FROM collected_meta WHERE profile_id NOT IN (SELECT id FROM extracted_content WHERE id IS NOT NULL)) AS only_left,
    (SELECT count(DISTINCT id) FROM extracted_content WHERE id NOT IN (SELECT profile_id FROM collected_meta WHERE profile_id IS NOT NULL)) AS only_right,
    (SELECT count(DISTINCT id) FROM extracted_content WHERE id IN (SELECT profile_id FROM collected_meta)) AS in_both""",
    "collected_meta",
    "extracted_content",
)
def q42_gap_counts(meta, pages):
    return dedup.gaps(meta, pages.withColumnRenamed("id", "profile_id"), "profile_id")


@R.query("SELECT DISTINCT id FROM extracted_content WHERE id NOT IN (SELECT profile_id FROM collected_meta WHERE profile_id IS NOT NULL)", "extracted_content", "collected_meta")
def q43_orphans(pages, meta):
    return pages.join(meta.select(F.col("profile_id").alias("id")), "id", "left_anti").select("id").distinct()


@R.query(
    """WITH e AS (SELECT DISTINCT id, cleaning_status, cleaned_text FROM extracted_content)
    SELECT cleaning_status, count(*) AS records, count(*) FILTER (trim(cleaned_text) <> '') AS cleaned, CASE WHEN count(*) <= 0 THEN 'n/a' ELSE printf('%.1f', round(count(*) FILTER (trim(cleaned_text) <> '') * 100.0 / count(*), 1)) || '%' END AS share
    FROM e GROUP BY 1""",
    "extracted_content",
)
def q44_coverage(pages):
    one = pages.select("id", "cleaning_status", "cleaned_text").distinct()
    done = F.count_if(F.trim("cleaned_text") != "")
    return one.groupBy("cleaning_status").agg(F.count("*").alias("records"), done.alias("cleaned"), reports.percent(done, F.count("*")).alias("share"))


@R.query(
    """WITH s AS (SELECT profile_context['profile_id'] AS pid, count(DISTINCT domain) AS domains, count(DISTINCT source_id) AS sources, avg(content.quality.ascii_ratio) AS a,
      CASE WHEN count(content.text_length) >= 2 AND avg(content.text_length) <> 0 THEN greatest(0, 1 - (max(content.text_length) - min(content.text_length)) / avg(content.text_length)) ELSE 0 END AS c FROM source_record GROUP BY 1)
    SELECT pid AS profile_id, CASE WHEN sources >= 3 THEN '3+' ELSE CAST(sources AS VARCHAR) END AS bucket, round(least(1::DOUBLE, 0.4::DOUBLE * least(domains, 3) / 3 + 0.3::DOUBLE * coalesce(a, 0) + 0.3::DOUBLE * c), 4) AS confidence FROM s WHERE pid IS NOT NULL""",
    "source_record",
)
def q45_confidence(sources):
    """Confidence of each profile's sources: how many domains, how clean, how alike in length."""
    length = F.col("content.text_length")
    s = sources.groupBy(F.try_element_at("profile_context", F.lit("profile_id")).alias("profile_id")).agg(
        F.countDistinct("domain").alias("domains"), F.countDistinct("source_id").alias("sources"), F.coalesce(F.avg("content.quality.ascii_ratio"), F.lit(0.0)).alias("a"), reports.consistency(length).alias("c")
    )
    score = F.least(F.lit(1.0), 0.4 * F.least("domains", F.lit(3)) / 3 + 0.3 * F.col("a") + 0.3 * F.col("c"))
    return s.where("profile_id is not null").select("profile_id", F.when(F.col("sources") >= 3, "3+").otherwise(F.col("sources").cast("string")).alias("bucket"), F.round(score, 4).alias("confidence"))


@R.query(
    """WITH e AS (SELECT DISTINCT id, word_count_raw, raw_headings, title FROM extracted_content),
    p AS (SELECT id, CASE WHEN word_count_raw >= 1500 THEN 40 WHEN word_count_raw >= 500 THEN 25 WHEN word_count_raw >= 100 THEN 10 ELSE 0 END + CASE WHEN len(raw_headings) >= 4 THEN 40 WHEN len(raw_headings) >= 2 THEN 25 WHEN len(raw_headings) >= 1 THEN 10 ELSE 0 END
      + CASE WHEN trim(title) <> '' THEN 20 ELSE 0 END AS points FROM e)
    SELECT CASE WHEN points >= 70 THEN 'ready' WHEN points >= 40 THEN 'partial' ELSE 'thin' END AS label, count(*) AS records, round(avg(points), 4) AS points FROM p GROUP BY 1""",
    "extracted_content",
)
def q46_score_ladder(pages):
    one = pages.select("id", "word_count_raw", "raw_headings", "title").distinct()
    words = reports.ladder(F.col("word_count_raw"), [(1500, 40), (500, 25), (100, 10)])
    heads = reports.ladder(F.size("raw_headings"), [(4, 40), (2, 25), (1, 10)])
    points = words + heads + F.when(F.trim("title") != "", 20).otherwise(0)
    label = F.when(F.col("points") >= 70, "ready").when(F.col("points") >= 40, "partial").otherwise("thin")
    return one.select(points.alias("points")).groupBy(label.alias("label")).agg(F.count("*").alias("records"), F.round(F.avg("points"), 4).alias("points"))


@R.query(
    """WITH s AS (SELECT profile_context['profile_id'] AS pid, profile_context['profile_name'] AS nm, count(*) AS n, min(recorded_at) AS t FROM source_record WHERE profile_context['profile_name'] IS NOT NULL GROUP BY 1, 2)
    SELECT pid AS profile_id, arg_min(nm, struct_pack(m := -n, t := t, nm := nm)) AS name, max(n) AS n FROM s GROUP BY 1""",
    "source_record",
)
def q47_modal_name(sources):
    """The name that most of a profile's sources give, of equals the earliest."""
    rows = sources.select(F.try_element_at("profile_context", F.lit("profile_id")).alias("profile_id"), F.try_element_at("profile_context", F.lit("profile_name")).alias("name"), "recorded_at")
    return reports.modal(rows, "profile_id", "name", "recorded_at")


@R.query(
    r"""WITH p AS (SELECT doc_id, string_split(text, chr(10)) AS a FROM documents WHERE text IS NOT NULL), l AS (SELECT doc_id, unnest(a) AS line, unnest(range(0, len(a))) AS n FROM p)
    SELECT doc_id, count(*) AS parts, md5(string_agg(line, chr(10) ORDER BY n)) AS text_md5 FROM l WHERE line <> '' GROUP BY doc_id""",
    "documents",
)
def q48_reassembly(docs):
    """The lines of each text in order, as one again without the empty ones."""
    lines = docs.where("text is not null").select("doc_id", F.posexplode(F.split("text", "\n")).alias("n", "line")).where("line <> ''")
    return reports.joined_text(lines, ["doc_id"], "n", "line", "\n").select("doc_id", "parts", F.md5("line").alias("text_md5"))


@R.query(
    """WITH e AS (SELECT DISTINCT id, raw_headings, all_urls, cleaned_text FROM extracted_content), m AS (SELECT profile_id, min(lower(source_host)) AS host FROM collected_meta GROUP BY 1),
    j AS (SELECT m.host, e.* FROM e JOIN m ON e.id = m.profile_id WHERE m.host IS NOT NULL), h AS (SELECT host, unnest(raw_headings) AS h FROM j), u AS (SELECT host, count(DISTINCT lower(h)) AS headings FROM h GROUP BY 1)
    SELECT j.host, count(*) AS records, coalesce(any_value(u.headings), 0) AS headings, md5(arg_max(cleaned_text, struct_pack(n := length(cleaned_text), id := id))) AS longest_md5 FROM j LEFT JOIN u ON j.host = u.host GROUP BY 1""",
    "extracted_content",
    "collected_meta",
)
def q49_merged_resources(pages, meta):
    """Each host's records as one: the distinct headings and the longest text."""
    m = meta.groupBy(F.col("profile_id").alias("id")).agg(F.min(F.lower("source_host")).alias("host")).where("host is not null")
    j = pages.select("id", "raw_headings", "cleaned_text").distinct().join(m, "id")
    heads = j.select("host", F.explode("raw_headings").alias("h")).groupBy("host").agg(F.countDistinct(F.lower("h")).alias("headings"))
    one = j.groupBy("host").agg(F.count("*").alias("records"), F.max_by("cleaned_text", F.when(F.col("cleaned_text").isNotNull(), F.struct(F.length("cleaned_text"), "id"))).alias("t"))
    return one.join(heads, "host", "left").select("host", "records", F.coalesce("headings", F.lit(0)).alias("headings"), F.md5("t").alias("longest_md5"))


@R.query(
    """SELECT license_type, paywalled, robots_allowed, count(*) AS records, CAST(grouping(license_type) * 4 + grouping(paywalled) * 2 + grouping(robots_allowed) AS BIGINT) AS level
    FROM source_record GROUP BY CUBE (license_type, paywalled, robots_allowed)""",
    "source_record",
)
def q50_cube(sources):
    return sources.cube("license_type", "paywalled", "robots_allowed").agg(F.count("*").alias("records"), F.grouping_id().alias("level"))


@R.query(
    """SELECT l_returnflag, l_linestatus, round(sum(l_quantity), 2) AS quantity, count(*) AS lines, count(DISTINCT l_orderkey) AS orders FROM lineitem GROUP BY ROLLUP (l_returnflag, l_linestatus)""",
    "lineitem",
)
def q50_rollup(lines):
    return lines.rollup("l_returnflag", "l_linestatus").agg(F.round(F.sum("l_quantity"), 2).alias("quantity"), F.count("*").alias("lines"), F.countDistinct("l_orderkey").alias("orders"))


@R.query(
    """WITH o AS (SELECT c_nationkey, o_totalprice, o_orderdate, c_custkey FROM orders JOIN customer ON o_custkey = c_custkey),
    n AS (SELECT n_name, r_name, n_nationkey FROM nation JOIN region ON n_regionkey = r_regionkey)
    SELECT r_name, n_name, count(*) AS orders, count(DISTINCT c_custkey) AS customers, round(sum(o_totalprice), 2) AS total FROM o JOIN n ON c_nationkey = n_nationkey GROUP BY 1, 2""",
    "orders",
    "customer",
    "nation",
    "region",
)
def q50_star_join(orders, customer, nation, region):
    """Facts with two fixed dimensions: 25 and 5 rows, which Spark broadcasts by their size."""
    dims = nation.join(region, nation.n_regionkey == region.r_regionkey).select("n_nationkey", "n_name", "r_name")
    facts = orders.join(customer, orders.o_custkey == customer.c_custkey).select("c_nationkey", "c_custkey", "o_totalprice")
    return facts.join(dims, facts.c_nationkey == dims.n_nationkey).groupBy("r_name", "n_name").agg(F.count("*").alias("orders"), F.countDistinct("c_custkey").alias("customers"), F.round(F.sum("o_totalprice"), 2).alias("total"))
