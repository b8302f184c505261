"""Queries that score and sum up profiles and their sources."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lectern.functions import persons as P
from lectern.operators import scores as S
from lectern.plans._base import Registry
from lectern.plans.persons import norm

R = Registry()

_NAMES = ["openalex", "crossref", "web_search", "unpaywall", "nsf_grants", "arxiv", "youtube_transcripts", "github"]
_SRC = "[" + ", ".join(f"'{n}'" for n in _NAMES) + "]"
_RESULTS = f"""x AS (SELECT profile_context['profile_id'] AS profile_id, {_SRC}[length(url) % 8 + 1] AS source, status = 'accepted' AS success, content.text_length AS chars, record_version % 2 = 1 AS named, contains(domain, 'u') AS affiliated, content.text_length % 40 AS h_index, content.text_length % 3 AS publications FROM source_record WHERE profile_context['profile_id'] IS NOT NULL),
    r AS (SELECT profile_id, source, bool_or(success) AS success, max(chars) AS chars, bool_or(named) AS named, bool_or(affiliated) AS affiliated, max(h_index) AS h_index, max(publications) AS publications FROM x GROUP BY 1, 2)"""


def _results(sources):
    length = F.col("content.text_length")
    rows = sources.select(
        F.try_element_at("profile_context", F.lit("profile_id")).alias("profile_id"), F.element_at(F.array(*[F.lit(n) for n in _NAMES]), F.length("url") % 8 + 1).alias("source"), (F.col("status") == "accepted").alias("success"), length.alias("chars"),
        (F.col("record_version") % 2 == 1).alias("named"), F.col("domain").contains("u").alias("affiliated"), (length % 40).alias("h_index"), (length % 3).alias("publications"),
    ).where("profile_id is not null")
    return rows.groupBy("profile_id", "source").agg(F.bool_or("success").alias("success"), F.max("chars").alias("chars"), F.bool_or("named").alias("named"), F.bool_or("affiliated").alias("affiliated"), F.max("h_index").alias("h_index"), F.max("publications").alias("publications"))


_CONF = f"""WITH {_RESULTS}, p AS (SELECT profile_id, bool_or(success AND source IN ('openalex', 'crossref')) AS parent, bool_or(success AND publications > 0) AS pubs FROM r GROUP BY 1),
    a AS (SELECT r.profile_id, count(*) FILTER (success) AS successful, greatest(count(*) FILTER (source IN ('openalex', 'crossref', 'web_search') OR (source = 'nsf_grants' AND (pubs OR success)) OR (source = 'unpaywall' AND parent) OR (source IN ('arxiv', 'github') AND success)), 1) AS applicable,
      count(*) FILTER (success AND source IN ('youtube_transcripts', 'github', 'arxiv')) AS rare, count(*) FILTER (success AND named) AS names, count(*) FILTER (success AND affiliated) AS homes, coalesce(sum(chars) FILTER (success), 0) AS chars,
      count(*) FILTER (success AND h_index > 0) AS hn, max(h_index) FILTER (success AND h_index > 0) - min(h_index) FILTER (success AND h_index > 0) AS hr, avg(h_index) FILTER (success AND h_index > 0) AS hm FROM r JOIN p ON r.profile_id = p.profile_id GROUP BY 1),
    c AS (SELECT profile_id, successful, applicable, rare, round(0.30::DOUBLE * least(successful / applicable, 1) + 0.20::DOUBLE * least(names / greatest(successful, 1), 1) + 0.15::DOUBLE * least(homes / greatest(successful, 1), 1) + 0.10::DOUBLE * least(chars / 20000, 1)
      + 0.10::DOUBLE * CASE WHEN hn >= 2 AND hm > 0 THEN greatest(0, 1 - hr / hm) ELSE 0 END + 0.15::DOUBLE * least(rare / 6, 1), 3) AS confidence, round(least(rare / 10, 1), 3) AS richness FROM a)"""


@R.query(f"{_CONF} SELECT * FROM c", "source_record")
def q106_confidence(sources):
    """Six weighted signals over the collectors of each profile."""
    return S.confidence(_results(sources))


@R.query(
    f"""{_CONF} SELECT count(*) AS profiles, count(*) FILTER (successful = 0) AS none, count(*) FILTER (successful = 1) AS one, count(*) FILTER (successful = 2) AS two, count(*) FILTER (successful >= 3) AS more, round(avg(confidence), 3) AS confidence,
    count(*) FILTER (successful >= 3) * 100.0 / count(*) >= 70 AS enough_sources, round(count(*) FILTER (successful >= 2) * 100.0::DOUBLE / count(*), 1) AS usable, CASE WHEN count(*) FILTER (successful >= 2) * 100.0 / count(*) >= 60 THEN 'pass' WHEN count(*) FILTER (successful >= 2) * 100.0 / count(*) >= 40 THEN 'warn' ELSE 'fail' END AS verdict FROM c""",
    "source_record",
)
def q107_dashboard(sources):
    return S.dashboard(S.confidence(_results(sources)))


@R.query(f"WITH {_RESULTS} SELECT source, count(*) AS attempted, count(*) FILTER (success) AS succeeded, round(count(*) FILTER (success) * 100.0::DOUBLE / count(*), 1) AS rate FROM r GROUP BY 1", "source_record")
def q108_source_rates(sources):
    return S.rates(_results(sources))


@R.query(
    f"""WITH {_RESULTS} SELECT profile_id, count(*) FILTER (success) AS succeeded, count(*) FILTER (NOT success) AS failed, coalesce(string_agg(source, ',' ORDER BY source) FILTER (success), '') AS names, coalesce(string_agg(source, ',' ORDER BY source) FILTER (NOT success), '') AS failures,
    count(*) FILTER (NOT success) * 2 > count(*) AS again FROM r GROUP BY 1""",
    "source_record",
)
def q109_success_summary(sources):
    """Which collectors succeeded for each profile, and whether most failed, so that it is worth another run."""
    return S.success_summary(_results(sources)).withColumn("again", F.col("failed") * 2 > F.col("failed") + F.col("succeeded"))


@R.query(
    """WITH o AS (SELECT DISTINCT source, section, profile_id FROM documents WHERE coalesce(section, '') <> ''),
    f AS (SELECT source, lower(section) AS key, min(section) AS name, count(*) AS works, coalesce(string_agg(DISTINCT profile_id, ',' ORDER BY profile_id), '') AS awards FROM o GROUP BY 1, 2) SELECT * FROM f""",
    "documents",
)
def q110_funders(docs):
    """Names in any case with how often they occur and their numbers: sections of each source as funders, profiles as awards."""
    return S.funders(docs.select("source", "section", "profile_id").distinct(), "section", "profile_id", "source")


@R.query(
    """WITH c AS (SELECT lang, source, count(*) AS n FROM documents WHERE source IS NOT NULL GROUP BY 1, 2), r AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY n DESC, source) AS place FROM c) SELECT lang, source, n, CAST(place AS INTEGER) AS place FROM r WHERE place <= 10""",
    "documents",
)
def q111_top_by_language(docs):
    return S.most_common(docs, "source", 10, "lang")


@R.query(
    """WITH s AS (SELECT s_nationkey, count(*) AS grants, sum(s_acctbal) AS total, max(s_acctbal) AS most FROM supplier GROUP BY 1) SELECT s_nationkey, grants, round(total, 2) AS total, round(most, 2) AS most FROM s ORDER BY total DESC LIMIT 10""",
    "supplier",
)
def q112_funding_sums(supplier):
    """Amounts added up by group, the ten greatest first."""
    a = supplier.groupBy("s_nationkey").agg(F.count("*").alias("grants"), F.sum("s_acctbal").alias("t"), F.round(F.max("s_acctbal"), 2).alias("most"))
    return a.orderBy(F.col("t").desc()).limit(10).select("s_nationkey", "grants", F.round("t", 2).alias("total"), "most")


_SECTIONS = """WITH s AS (SELECT source, section, lower(trim(section)) AS low, text FROM documents WHERE trim(section) <> ''),
    a AS (SELECT source, count(DISTINCT section) AS sections, count(DISTINCT CASE WHEN regexp_matches(low, 'home|page not found|personal website|website subpage|upcoming events|recent news|news|directions|contact|asset type|technical information|access request') THEN section END) AS generic,
      max(CAST(regexp_matches(low, 'biography|bio|about|life|early life|profile') AS INTEGER)) AS b, max(CAST(regexp_matches(low, 'background|education|career|academic career|positions') AS INTEGER)) AS c, max(CAST(regexp_matches(low, 'legacy|impact|influence|tribute|honor|memorial') AS INTEGER)) AS d,
      max(CAST(regexp_matches(low, 'publications|books|works|writings|articles|papers') AS INTEGER)) AS e, max(CAST(regexp_matches(low, 'interview|oral history|quote|speech|lecture|conversation|keynote') AS INTEGER)) AS f, max(CAST(coalesce(regexp_matches(lower(text), 'interviewer:|interview:|question:|answer:|he said|she said'), false) AS INTEGER)) AS g,
      max(CAST(contains(low, 'biography') AS INTEGER)) + max(CAST(contains(low, 'background') AS INTEGER)) + max(CAST(contains(low, 'legacy') AS INTEGER)) + max(CAST(contains(low, 'publications') AS INTEGER)) AS coverage FROM s GROUP BY 1)"""


@R.query(f"{_SECTIONS} SELECT source, sections, generic, round(generic / greatest(sections, 1), 4) AS generic_share, b + c + d + e + f AS kinds, f + g > 0 AS voice, coverage FROM a", "documents")
def q113_section_stats(docs):
    return S.section_stats(docs, "source", "section", "text")


@R.query(
    f"""{_SECTIONS}, t AS (SELECT source, count(*) AS chunks, count(DISTINCT profile_id) AS urls, count(DISTINCT section) AS domains, count(DISTINCT text) FILTER (section = 'publications') AS works, count(DISTINCT text) FILTER (section = 'award') AS milestones, max(length(text)) AS long_bio, min(length(text)) AS short_bio, max(length(title)) AS summary,
      count(profile_id) / count(*) AS provenance, count(*) - count(DISTINCT text) AS extra, avg(length(text)) AS mean FROM documents GROUP BY 1),
    j AS (SELECT t.*, round(coalesce(generic, 0) / greatest(coalesce(sections, 0), 1), 4) AS g, coalesce(b + c + d + e + f, 0) AS kinds, coalesce(f + a.g > 0, false) AS voice, coalesce(coverage, 0) AS coverage FROM t LEFT JOIN a ON t.source = a.source),
    k AS (SELECT source, chunks, CASE WHEN short_bio >= 180 THEN 22 WHEN short_bio >= 100 THEN 16 WHEN short_bio >= 40 THEN 8 ELSE 0 END + CASE WHEN long_bio >= 700 THEN 18 WHEN long_bio >= 350 THEN 12 WHEN long_bio >= 140 THEN 6 ELSE 0 END + 8 + CASE WHEN summary >= 140 THEN 14 WHEN summary >= 80 THEN 10 WHEN summary >= 40 THEN 5 ELSE 0 END
        + CASE WHEN works >= 4 THEN 14 WHEN works >= 2 THEN 10 WHEN works >= 1 THEN 5 ELSE 0 END + CASE WHEN milestones >= 4 THEN 10 WHEN milestones >= 2 THEN 6 WHEN milestones >= 1 THEN 3 ELSE 0 END + CASE WHEN urls >= 6 THEN 8 WHEN urls >= 3 THEN 5 WHEN urls >= 1 THEN 2 ELSE 0 END + CASE WHEN g <= 0.35 THEN 6 WHEN g <= 0.6 THEN 2 ELSE 0 END AS card,
      CASE WHEN chunks >= 80 THEN 24 WHEN chunks >= 40 THEN 18 WHEN chunks >= 20 THEN 13 WHEN chunks >= 10 THEN 7 ELSE 0 END + CASE WHEN urls >= 10 THEN 18 WHEN urls >= 6 THEN 13 WHEN urls >= 3 THEN 8 WHEN urls >= 1 THEN 4 ELSE 0 END + CASE WHEN domains >= 8 THEN 12 WHEN domains >= 5 THEN 8 WHEN domains >= 3 THEN 5 WHEN domains >= 1 THEN 2 ELSE 0 END
        + CASE WHEN kinds >= 4 THEN 16 WHEN kinds >= 3 THEN 12 WHEN kinds >= 2 THEN 7 WHEN kinds >= 1 THEN 3 ELSE 0 END + CASE WHEN long_bio + summary >= 900 THEN 10 WHEN long_bio + summary >= 450 THEN 7 WHEN long_bio + summary >= 180 THEN 4 ELSE 0 END + CASE WHEN provenance >= 0.95 THEN 10 WHEN provenance >= 0.75 THEN 7 WHEN provenance >= 0.5 THEN 4 ELSE 0 END + CASE WHEN g <= 0.3 THEN 10 WHEN g <= 0.55 THEN 5 ELSE 0 END AS chatbot,
      greatest(CASE WHEN chunks >= 100 THEN 24 WHEN chunks >= 60 THEN 18 WHEN chunks >= 30 THEN 12 WHEN chunks >= 15 THEN 6 ELSE 0 END + CASE WHEN urls >= 12 THEN 18 WHEN urls >= 8 THEN 13 WHEN urls >= 5 THEN 8 WHEN urls >= 2 THEN 4 ELSE 0 END + CASE WHEN kinds >= 4 THEN 20 WHEN kinds >= 3 THEN 14 WHEN kinds >= 2 THEN 8 WHEN kinds >= 1 THEN 3 ELSE 0 END + CASE WHEN voice THEN 14 ELSE 4 END
        + CASE WHEN long_bio + 0 >= 900 THEN 10 WHEN long_bio >= 500 THEN 7 WHEN long_bio >= 180 THEN 4 ELSE 0 END + CASE WHEN provenance >= 0.95 THEN 8 WHEN provenance >= 0.75 THEN 5 WHEN provenance >= 0.5 THEN 3 ELSE 0 END + CASE WHEN g <= 0.25 THEN 10 WHEN g <= 0.5 THEN 4 ELSE 0 END - CASE WHEN extra > 1 THEN 8 ELSE 0 END, 0) AS editorial,
      greatest(CASE WHEN chunks >= 120 THEN 20 WHEN chunks >= 70 THEN 15 WHEN chunks >= 40 THEN 10 WHEN chunks >= 20 THEN 5 ELSE 0 END + CASE WHEN urls >= 15 THEN 14 WHEN urls >= 10 THEN 10 WHEN urls >= 6 THEN 6 WHEN urls >= 3 THEN 3 ELSE 0 END + CASE WHEN voice THEN 22 ELSE 3 END + CASE WHEN kinds >= 4 THEN 18 WHEN kinds >= 3 THEN 13 WHEN kinds >= 2 THEN 7 WHEN kinds >= 1 THEN 3 ELSE 0 END
        + CASE WHEN long_bio >= 750 THEN 10 WHEN long_bio >= 400 THEN 7 WHEN long_bio >= 180 THEN 4 ELSE 0 END + CASE WHEN works + milestones >= 8 THEN 8 WHEN works + milestones >= 5 THEN 5 WHEN works + milestones >= 2 THEN 3 ELSE 0 END + CASE WHEN provenance >= 0.95 THEN 4 WHEN provenance >= 0.75 THEN 3 WHEN provenance >= 0.5 THEN 2 ELSE 0 END + CASE WHEN g <= 0.25 THEN 4 WHEN g <= 0.5 THEN 1 ELSE 0 END - CASE WHEN extra > 1 THEN 10 ELSE 0 END, 0) AS podcast,
      20 + CASE WHEN chunks >= 80 THEN 40 WHEN chunks >= 40 THEN 30 WHEN chunks >= 20 THEN 20 WHEN chunks >= 10 THEN 10 ELSE 0 END + CASE WHEN coverage >= 4 THEN 20 WHEN coverage = 3 THEN 14 WHEN coverage = 2 THEN 8 ELSE 0 END + CASE WHEN mean >= 420 THEN 20 WHEN mean >= 250 THEN 14 WHEN mean >= 140 THEN 8 ELSE 0 END AS quality,
      array_to_string(list_filter([CASE WHEN extra > 1 THEN 'dedupe' END, CASE WHEN chunks < 40 THEN 'evidence_depth' END, CASE WHEN urls < 8 OR domains < 5 THEN 'source_diversity' END, CASE WHEN kinds < 3 OR g > 0.4 THEN 'section_quality' END, CASE WHEN NOT voice THEN 'voice_grounding' END, CASE WHEN works = 0 OR milestones = 0 THEN 'structured_fields' END], lambda x: x IS NOT NULL), ',') AS needs FROM j)
    SELECT source, card, chatbot, editorial, podcast, CASE WHEN round((card + chatbot + editorial + podcast) / 4.0) >= 80 THEN 'demo_ready' WHEN round((card + chatbot + editorial + podcast) / 4.0) >= 65 THEN 'demo_ready_with_guardrails' WHEN round((card + chatbot + editorial + podcast) / 4.0) >= 50 THEN 'limited_demo_use' ELSE 'not_ready' END AS readiness,
      quality, CASE WHEN coalesce(source, '') = '' THEN 'invalid_profile' WHEN quality < 60 OR chunks < 20 THEN 'needs_data_repair' ELSE 'ready' END AS status, array_to_string(list_slice(string_split(needs || CASE WHEN needs = '' THEN '' ELSE ',' END || CASE WHEN podcast < 65 THEN 'podcast_scope,' ELSE '' END || CASE WHEN editorial < 65 THEN 'editorial_scope,' ELSE '' END, ','), 1, 8), ',') AS raw_needs FROM k""",
    "documents",
)
def q114_feature_scores(docs):
    """Each source scored as a profile for four uses, with its quality, status and needs."""
    text, n = F.col("text"), F.length("text")
    t = docs.groupBy("source").agg(
        F.count("*").alias("chunks"), F.countDistinct("profile_id").alias("urls"), F.countDistinct("section").alias("domains"), F.countDistinct(F.when(F.col("section") == "publications", text)).alias("works"), F.countDistinct(F.when(F.col("section") == "award", text)).alias("milestones"),
        F.max(n).alias("long_bio"), F.min(n).alias("short_bio"), F.max(F.length("title")).alias("summary"), (F.count("profile_id") / F.count("*")).alias("provenance"), (F.count("*") - F.countDistinct("text")).alias("extra"), F.avg(n).alias("mean"),
    )
    j = t.join(S.section_stats(docs, "source", "section", "text"), "source", "left")
    col = F.col
    s = {k: col(k) for k in ("chunks", "urls", "domains", "works", "milestones", "long_bio", "short_bio", "summary", "provenance")} | {"copies": col("extra"), "field": F.lit(True), "current": F.lit(0), "voice": F.coalesce("voice", F.lit(False)), "kinds": F.coalesce("kinds", F.lit(0)), "generic_share": F.coalesce("generic_share", F.lit(0.0))}
    scored = j.select("*", *[v.alias(k) for k, v in S.feature_scores(s).items()])
    quality = S.profile_quality(F.lit(True), col("chunks"), F.coalesce("coverage", F.lit(0)), col("mean"))
    overall = F.round((col("card") + col("chatbot") + col("editorial") + col("podcast")) / 4)
    needs = S.recommendations(s | {"education": col("works"), "focus": col("milestones"), "scored": F.lit(True), "podcast": col("podcast"), "editorial": col("editorial")})
    scoped = F.array_join(F.slice(F.concat(F.transform(needs, lambda x: x["category"]), F.array(F.lit(""))), 1, 8), ",")
    return scored.select("source", "card", "chatbot", "editorial", "podcast", S.readiness(overall).alias("readiness"), quality.alias("quality"), S.quality_status(quality, col("chunks"), col("source")).alias("status"), scoped.alias("raw_needs"))


@R.query(
    """WITH m AS (SELECT profile_id, min(profile_name) AS name FROM collected_meta WHERE profile_name IS NOT NULL GROUP BY 1), d AS (SELECT profile_id, count(*) AS docs, max(n_chars) AS chars FROM documents GROUP BY 1),
    j AS (SELECT trim(regexp_replace(lower(trim(name)), '\\s+', ' ', 'g')) AS name, m.profile_id, coalesce(docs, 0) AS docs, coalesce(chars, 0) AS chars FROM m LEFT JOIN d ON m.profile_id = d.profile_id)
    SELECT name, count(*) AS copies, arg_max(profile_id, struct_pack(a := docs, b := chars, c := profile_id)) AS best FROM j GROUP BY 1""",
    "collected_meta",
    "documents",
)
def q115_best_of_name(meta, docs):
    """Profiles of one spelling, and the best of them by documents, length, id."""
    m = meta.where("profile_name is not null").groupBy("profile_id").agg(F.min("profile_name").alias("name"))
    d = docs.groupBy("profile_id").agg(F.count("*").alias("docs"), F.max("n_chars").alias("chars"))
    j = m.join(d, "profile_id", "left").select(F.trim(F.regexp_replace(F.lower(F.trim("name")), r"\s+", " ")).alias("name"), "profile_id", F.coalesce("docs", F.lit(0)).alias("docs"), F.coalesce("chars", F.lit(0)).alias("chars"))
    return j.groupBy("name").agg(F.count("*").alias("copies"), F.max_by("profile_id", F.struct("docs", "chars", "profile_id")).alias("best"))


@R.query(
    """WITH e AS (SELECT DISTINCT id, raw_headings, all_urls, cleaned_text FROM extracted_content), m AS (SELECT profile_id, min(lower(source_host)) AS host FROM collected_meta GROUP BY 1), j AS (SELECT m.host, e.* FROM e JOIN m ON e.id = m.profile_id WHERE m.host IS NOT NULL),
    h AS (SELECT host, lower(trim(h)) AS k, min(trim(h)) AS h FROM (SELECT host, unnest(raw_headings) AS h FROM j) WHERE trim(h) <> '' GROUP BY 1, 2), u AS (SELECT host, lower(trim(u)) AS k, min(trim(u)) AS u FROM (SELECT host, unnest(all_urls) AS u FROM j) WHERE trim(u) <> '' GROUP BY 1, 2),
    hh AS (SELECT host, string_agg(h, '|' ORDER BY h) AS h, count(*) AS n FROM h GROUP BY 1), uu AS (SELECT host, md5(string_agg(u, '|' ORDER BY u)) AS u, count(*) AS n FROM u GROUP BY 1), t AS (SELECT host, arg_max(cleaned_text, struct_pack(a := length(cleaned_text), b := cleaned_text)) FILTER (cleaned_text IS NOT NULL) AS t FROM j GROUP BY 1)
    SELECT t.host, md5(t) AS text_md5, coalesce(hh.h, '') AS headings, coalesce(uu.u, md5('')) AS urls_md5, CASE WHEN length(t) > 100 THEN 20 WHEN length(t) > 0 THEN 10 ELSE 0 END + CASE WHEN coalesce(uu.n, 0) > 10 THEN 20 WHEN coalesce(uu.n, 0) > 5 THEN 15 WHEN coalesce(uu.n, 0) > 0 THEN 10 ELSE 0 END
      + CASE WHEN coalesce(hh.n, 0) > 0 THEN 20 ELSE 0 END + CASE WHEN coalesce(hh.n, 0) > 5 THEN 20 WHEN coalesce(hh.n, 0) > 0 THEN 15 ELSE 0 END AS complete FROM t LEFT JOIN hh ON t.host = hh.host LEFT JOIN uu ON t.host = uu.host""",
    "extracted_content",
    "collected_meta",
)
def q116_merged_records(pages, meta):
    """Each host's records as one, with its lists and how complete it is."""
    m = meta.groupBy(F.col("profile_id").alias("id")).agg(F.min(F.lower("source_host")).alias("host")).where("host is not null")
    j = pages.select("id", "raw_headings", "all_urls", "cleaned_text").distinct().join(m, "id")
    one = S.merged_record(j, "host", ["raw_headings", "all_urls"], "cleaned_text")
    h, u = F.size("raw_headings"), F.size("all_urls")
    return one.select("host", F.md5("cleaned_text").alias("text_md5"), F.array_join("raw_headings", "|").alias("headings"), F.md5(F.array_join("all_urls", "|")).alias("urls_md5"), S.completeness(F.col("cleaned_text"), u, h, h, F.lit(0)).alias("complete"))


@R.query(
    r"""WITH w AS (SELECT max(published_at) AS t FROM documents), d AS (SELECT section, lang, text, title, len(regexp_extract_all(coalesce(text, ''), '[A-Za-z0-9'']+')) AS words, len(regexp_extract_all(coalesce(text, ''), '\[[0-9]+\]')) AS cites, regexp_matches(lower(coalesce(text, '')), '(^|[^\p{L}])(i|my|me|we|our)([^\p{L}]|$)') AS first_person FROM documents, w WHERE published_at > t - INTERVAL 365 DAY AND published_at <= t)
    SELECT count(*) AS stories, round(avg(words), 2) AS avg_words, round(avg(cites), 2) AS avg_citations, round(count(*) FILTER (cites >= 4) / count(*), 4) AS citation_coverage, round(count(*) FILTER (first_person) / count(*), 4) AS first_person_rate, round(count(*) FILTER (trim(title) <> '') / count(*), 4) AS titled,
      (SELECT string_agg(s || ':' || n, ',' ORDER BY s) FROM (SELECT coalesce(section, 'unknown') AS s, count(*) AS n FROM d GROUP BY 1)) AS sections FROM d""",
    "documents",
)
def q117_kpis(docs):
    """Numbers of a year's documents by one aggregation, and how many there are of each section."""
    end = docs.agg(F.max("published_at").alias("t"))
    d = docs.join(F.broadcast(end), (F.col("published_at") > F.col("t") - F.expr("interval 365 days")) & (F.col("published_at") <= F.col("t")))  # one row
    text = F.coalesce("text", F.lit(""))
    cites = F.regexp_count(text, F.lit(r"\[[0-9]+\]"))
    share = lambda c: F.round(F.count_if(c) / F.count("*"), 4)
    a = d.agg(
        F.count("*").alias("stories"), F.round(F.avg(F.regexp_count(text, F.lit("[A-Za-z0-9']+"))), 2).alias("avg_words"), F.round(F.avg(cites), 2).alias("avg_citations"), share(cites >= 4).alias("citation_coverage"),
        share(F.lower(text).rlike(r"(?:^|[^\p{L}])(?:i|my|me|we|our)(?:[^\p{L}]|$)")).alias("first_person_rate"), share(F.trim("title") != "").alias("titled"),
    )
    s = d.groupBy(F.coalesce("section", F.lit("unknown")).alias("s")).agg(F.count("*").alias("n")).agg(F.array_join(F.array_sort(F.collect_list(F.concat_ws(":", "s", F.col("n").cast("string")))), ",").alias("sections"))
    return a.crossJoin(F.broadcast(s))  # one row each


@R.query(
    """SELECT user_id, event_id, round(avg(value) OVER w, 4) AS mean_of_3, round(sum(value) OVER r, 2) AS in_the_hour, CAST(ntile(4) OVER o AS INTEGER) AS quarter, round(percent_rank() OVER o, 6) AS share FROM events
    WINDOW o AS (PARTITION BY user_id ORDER BY ts, event_id), w AS (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN 2 PRECEDING AND CURRENT ROW), r AS (PARTITION BY user_id ORDER BY epoch_us(ts) RANGE BETWEEN 3600000000 PRECEDING AND CURRENT ROW)""",
    "events",
)
def q118_frames(events):
    """Windows by rows and by range, quarters and ranks within each user."""
    o = Window.partitionBy("user_id").orderBy("ts", "event_id")
    r = Window.partitionBy("user_id").orderBy(F.unix_micros(F.col("ts").cast("timestamp"))).rangeBetween(-3_600_000_000, 0)
    return events.select(
        "user_id", "event_id", F.round(F.avg("value").over(o.rowsBetween(-2, 0)), 4).alias("mean_of_3"), F.round(F.sum("value").over(r), 2).alias("in_the_hour"), F.ntile(4).over(o).alias("quarter"), F.round(F.percent_rank().over(o), 6).alias("share")
    )


@R.query(
    """WITH s AS (SELECT id, i * 7 AS a, i * 7 + CASE WHEN i % 3 = 0 THEN 12 ELSE 5 END AS b, h AS t FROM (SELECT id, unnest(raw_headings) AS h, unnest(range(0, len(raw_headings))) AS i FROM (SELECT DISTINCT id, raw_headings FROM extracted_content))),
    o AS (SELECT *, CASE WHEN a >= coalesce(max(b) OVER (PARTITION BY id ORDER BY a, b, t ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), -1) THEN 1 ELSE 0 END AS fresh FROM s), g AS (SELECT *, sum(fresh) OVER (PARTITION BY id ORDER BY a, b, t ROWS UNBOUNDED PRECEDING) AS g FROM o)
    SELECT id, min(a) AS a, max(b) AS b, arg_min(t, struct_pack(m := -length(t), a := a)) AS t, CAST(count(*) AS INTEGER) AS parts FROM g GROUP BY id, g""",
    "extracted_content",
)
def q119_merged_spans(pages):
    """Spans of headings that overlap, merged under the longest of their names."""
    from lectern.operators.ranking import merged_spans

    rows = pages.select("id", "raw_headings").distinct().select("id", F.posexplode("raw_headings").alias("i", "t"))
    i = F.col("i").cast("bigint")
    return merged_spans(rows.select("id", (i * 7).alias("a"), (i * 7 + F.when(i % 3 == 0, 12).otherwise(5)).alias("b"), "t"), "id", "a", "b", "t")


@R.query(
    """WITH i AS (SELECT profile_id, max(s3_uri) AS uri FROM image_record WHERE profile_id IS NOT NULL GROUP BY 1), d AS (SELECT decision_id, min(scholar_name) AS n FROM match_decision GROUP BY 1),
    k AS (SELECT decision_id, CASE WHEN length(n) % 5 = 0 THEN NULL WHEN length(n) % 2 = 0 THEN (SELECT min(profile_id) FROM i) ELSE 'img-' || n END AS image_id FROM d)
    SELECT decision_id, CASE WHEN image_id IS NULL THEN 'missing_id' WHEN i.profile_id IS NULL THEN 'not_found' WHEN coalesce(i.uri, '') = '' THEN 'record_found_no_file' ELSE 'matched' END AS status FROM k LEFT JOIN i ON k.image_id = i.profile_id""",
    "match_decision",
    "image_record",
)
def q120_lookup_status(decisions, images):
    """Decisions with an image by id: matched, found without file, not found, or without id."""
    i = images.where("profile_id is not null").groupBy("profile_id").agg(F.max("s3_uri").alias("uri"))
    d = decisions.groupBy("decision_id").agg(F.min("scholar_name").alias("n")).join(F.broadcast(i.agg(F.min("profile_id").alias("least"))))  # one row
    key = F.when(F.length("n") % 5 == 0, None).when(F.length("n") % 2 == 0, F.col("least")).otherwise(F.concat(F.lit("img-"), "n"))
    from lectern.operators.identity import lookup_status

    return lookup_status(d.select("decision_id", key.alias("image_id")), i, "decision_id", "image_id", "profile_id", "uri")


@R.query(
    """WITH c AS (SELECT source_id AS id FROM source_record GROUP BY 1), t AS (SELECT doc_id, CASE doc_id % 4 WHEN 0 THEN (SELECT min(id) FROM c) WHEN 1 THEN substr((SELECT max(id) FROM c), 1, 24) WHEN 2 THEN 'SRC-' || upper(substr((SELECT max(id) FROM c), 5, 20)) ELSE 'src_' END AS cited FROM documents),
    d AS (SELECT DISTINCT cited FROM t), m AS (SELECT cited, CASE WHEN count(*) FILTER (id = cited) > 0 THEN cited WHEN count(*) FILTER (starts_with(id, cited)) = 1 THEN max(id) FILTER (starts_with(id, cited))
      WHEN count(*) FILTER (starts_with(regexp_replace(lower(id), '[^a-z0-9]', '', 'g'), regexp_replace(lower(cited), '[^a-z0-9]', '', 'g'))) = 1 THEN max(id) FILTER (starts_with(regexp_replace(lower(id), '[^a-z0-9]', '', 'g'), regexp_replace(lower(cited), '[^a-z0-9]', '', 'g'))) END AS id FROM d, c GROUP BY 1)
    SELECT t.doc_id, m.id AS resolved FROM t JOIN m ON t.cited = m.cited""",
    "documents",
    "source_record",
)
def q121_prefix_join(docs, sources):
    """Cited ids, whole or cut short, with the only id that they may mean."""
    from lectern.operators.identity import resolved_prefixes

    ids = sources.select(F.col("source_id").alias("id")).distinct()
    ends = ids.agg(F.min("id").alias("lo"), F.max("id").alias("hi"))
    n = F.col("doc_id") % 4
    cited = F.when(n == 0, F.col("lo")).when(n == 1, F.substring("hi", 1, 24)).when(n == 2, F.concat(F.lit("SRC-"), F.upper(F.substring("hi", 5, 20)))).otherwise("src_")
    rows = docs.select("doc_id").join(F.broadcast(ends)).select("doc_id", cited.alias("cited"))  # one row
    return resolved_prefixes(rows, ids, "cited", "id").select("doc_id", F.col("id").alias("resolved"))


@R.query(
    """WITH m AS (SELECT DISTINCT profile_id FROM collected_meta), e AS (SELECT DISTINCT id FROM extracted_content), c AS (SELECT DISTINCT id FROM extracted_content WHERE trim(cleaned_text) <> ''), s AS (SELECT DISTINCT profile_context['profile_id'] AS id FROM source_record), d AS (SELECT DISTINCT profile_id AS id FROM documents)
    SELECT m.profile_id, e.id IS NOT NULL AS has_text, c.id IS NOT NULL AS has_clean_text, s.id IS NOT NULL AS has_sources, d.id IS NOT NULL AS has_chunks FROM m LEFT JOIN e ON m.profile_id = e.id LEFT JOIN c ON m.profile_id = c.id LEFT JOIN s ON m.profile_id = s.id LEFT JOIN d ON m.profile_id = d.id""",
    "collected_meta",
    "extracted_content",
    "source_record",
    "documents",
)
def q122_presence(meta, pages, sources, docs):
    """Which stages each profile has been through."""
    from lectern.operators.identity import presence

    clean = pages.where("trim(cleaned_text) <> ''")
    who = F.try_element_at("profile_context", F.lit("profile_id"))
    return presence(meta.select("profile_id").distinct(), "profile_id", {"has_text": pages.select("id"), "has_clean_text": clean.select("id"), "has_sources": sources.select(who.alias("id")), "has_chunks": docs.select(F.col("profile_id").alias("id"))})


@R.query(
    """SELECT DISTINCT source_id FROM source_record WHERE len(list_filter(map_values(fetch_info), lambda v: contains(v, '40'))) > 0""",
    "source_record",
)
def q123_marker_in_map(sources):
    """Sources of which any fetch value holds a marker."""
    return sources.where(F.exists(F.map_values("fetch_info"), lambda v: v.contains("40"))).select("source_id").distinct()


@R.query(
    f"""WITH d AS (SELECT decision_id, min(normalized_name) AS was, min(scholar_name) AS typed FROM match_decision GROUP BY 1) SELECT decision_id, was, {norm('typed')} AS name FROM d WHERE was IS DISTINCT FROM {norm('typed')} AND typed IS NOT NULL""",
    "match_decision",
)
def q124_name_repairs(decisions):
    """Decisions whose kept name isn't the typed one in comparable form, with the name to put."""
    d = decisions.groupBy("decision_id").agg(F.min("normalized_name").alias("was"), F.min("scholar_name").alias("typed")).where("typed is not null")
    return d.select("decision_id", "was", P.normalized(F.col("typed")).alias("name")).where(~F.col("was").eqNullSafe(F.col("name")))


@R.query(
    """WITH m AS (SELECT profile_id, min(profile_name) AS name, min(lower(source_host)) AS host, min(field) AS field FROM collected_meta GROUP BY 1), f AS (SELECT * FROM m WHERE regexp_matches(coalesce(name, ''), '(?i)^(prof|dr)') OR (contains(lower(coalesce(name, '')), 'an') AND host IS NOT NULL))
    SELECT profile_id, name, (SELECT count(*) FROM f) AS total FROM f ORDER BY lower(name), profile_id LIMIT 20 OFFSET 20""",
    "collected_meta",
)
def q125_search_page(meta):
    """The second page of a search by expression and part of a name, with how many there are in all."""
    m = meta.groupBy("profile_id").agg(F.min("profile_name").alias("name"), F.min(F.lower("source_host")).alias("host"))
    name = F.coalesce("name", F.lit(""))
    found = m.where(name.rlike("(?i)^(?:prof|dr)") | (F.lower(name).contains("an") & F.col("host").isNotNull()))
    total = found.agg(F.count("*").alias("total"))
    return found.join(F.broadcast(total)).orderBy(F.lower("name"), "profile_id").offset(20).limit(20).select("profile_id", "name", "total")  # one row


@R.query(
    """WITH e AS (SELECT id, max(raw_text) AS t, min(profile_name) AS n FROM extracted_content WHERE id IS NOT NULL GROUP BY 1), d AS (SELECT profile_id, count(*) AS c FROM documents GROUP BY 1), j AS (SELECT e.*, coalesce(c, 0) AS c FROM e LEFT JOIN d ON e.id = d.profile_id)
    SELECT id, CASE WHEN coalesce(t, '') = '' THEN 'no_text' WHEN c = 0 THEN 'no_chunks_after_extraction' WHEN regexp_matches(lower(t), 'request unsuccessful|incapsula incident id|access denied|temporarily unavailable|forbidden') THEN 'blocked_or_error_page_content'
      WHEN n IS NULL OR NOT contains(lower(t), lower(string_split(trim(regexp_replace(n, '[\\s\\x{A0}]+', ' ', 'g')), ' ')[-1])) THEN 'no_strong_identity_match' ELSE 'verified' END AS reason FROM j""",
    "extracted_content",
    "documents",
)
def q126_page_validity(pages, docs):
    """Whether each page holds, by the first rule that it breaks."""
    e = pages.where("id is not null").groupBy("id").agg(F.max("raw_text").alias("t"), F.min("profile_name").alias("n"))
    d = docs.groupBy(F.col("profile_id").alias("id")).agg(F.count("*").alias("c"))
    last = F.lower(F.element_at(F.split(F.trim(F.regexp_replace("n", r"[\s\x{A0}]+", " ")), " "), -1))
    low = F.lower("t")
    reason = (
        F.when(F.coalesce("t", F.lit("")) == "", "no_text").when(F.coalesce("c", F.lit(0)) == 0, "no_chunks_after_extraction").when(low.rlike("request unsuccessful|incapsula incident id|access denied|temporarily unavailable|forbidden"), "blocked_or_error_page_content")
        .when(~F.coalesce(low.contains(last), F.lit(False)), "no_strong_identity_match").otherwise("verified")
    )
    return e.join(d, "id", "left").select("id", reason.alias("reason"))


@R.query("SELECT domain, count(*) AS records, count(*) FILTER (coalesce(robots_allowed, true)) AS allowed, count(*) FILTER (robots_allowed IS NULL) AS untold FROM source_record GROUP BY 1", "source_record")
def q127_robots(sources):
    """Records of each host that its rules for robots allow; what isn't told is allowed."""
    return sources.groupBy("domain").agg(F.count("*").alias("records"), F.count_if(F.coalesce("robots_allowed", F.lit(True))).alias("allowed"), F.count_if(F.col("robots_allowed").isNull()).alias("untold"))


@R.query(
    """WITH t AS (SELECT profile_context['profile_id'] AS profile_id, list_distinct(flatten(list([license_type, language]))) AS u FROM (SELECT profile_context, coalesce(license_type, 'none') AS license_type, coalesce(content.language, 'none') AS language FROM source_record) GROUP BY 1) SELECT profile_id, array_to_string(list_sort(u), ',') AS tags FROM t""",
    "source_record",
)
def q128_tag_union(sources):
    """All tags of each profile's sources, each once: collected as sets, which combine before the shuffle."""
    who = F.try_element_at("profile_context", F.lit("profile_id")).alias("profile_id")
    a, b = F.coalesce("license_type", F.lit("none")), F.coalesce("content.language", F.lit("none"))
    return sources.groupBy(who).agg(F.array_join(F.sort_array(F.array_union(F.collect_set(a), F.collect_set(b))), ",").alias("tags"))


@R.query(
    """WITH o AS (SELECT profile_id, row_number() OVER (ORDER BY profile_id) AS n FROM (SELECT DISTINCT profile_id FROM collected_meta WHERE profile_id IS NOT NULL)) SELECT profile_id, n AS place FROM o WHERE n > 100 AND n <= 150""",
    "collected_meta",
)
def q129_ordinal_slice(meta):
    """Profiles from the 101st to the 150th by id: sort, offset and limit, without numbering all."""
    some = meta.select("profile_id").where("profile_id is not null").distinct().orderBy("profile_id").offset(100).limit(50)
    return some.withColumn("place", F.row_number().over(Window.orderBy("profile_id")).cast("bigint") + 100)  # over fifty rows


@R.query("SELECT event_id, user_id, event_type FROM events WHERE event_type IN ('purchase', 'error') ORDER BY ts DESC, event_id DESC LIMIT 50", "events")
def q130_recent(events):
    """The fifty latest entries of a log."""
    return events.where(F.col("event_type").isin("purchase", "error")).orderBy(F.col("ts").desc(), F.col("event_id").desc()).limit(50).select("event_id", "user_id", "event_type")


@R.query(
    """WITH w AS (SELECT source, doc_id, n_chars AS weight, (CAST(('0x' || substr(sha256('seed:' || source || ':' || doc_id), 1, 12)) AS BIGINT) + 1) / (281474976710656.0::DOUBLE + 1) AS u FROM documents WHERE n_chars > 0 AND source IS NOT NULL)
    SELECT source, arg_min(doc_id, struct_pack(d := -ln(u) / weight, i := doc_id)) AS doc_id FROM w GROUP BY 1""",
    "documents",
)
def q131_weighted_pick(docs):
    """One document of each source by chance in proportion to its length, the same every time."""
    return S.weighted_pick(docs.where("source is not null"), "source", "doc_id", "n_chars", "seed")


@R.query("SELECT source, count(*) AS docs, true AS near FROM documents GROUP BY 1", "documents")
def q132_approx_distinct(docs):
    """Whether the estimated number of different texts lies within 15 % of the true one, or one off."""
    a, b = F.approx_count_distinct("text", 0.02), F.countDistinct("text")
    return docs.groupBy("source").agg(F.count("*").alias("docs"), (F.abs(a - b) <= F.greatest(F.lit(1.0), 0.15 * b)).alias("near"))


@R.query(
    """SELECT source, count(*) AS chunks, round(count(profile_id) / count(*), 4) AS with_profile, round(count(title) / count(*), 4) AS with_title, round(count(published_at) / count(*), 4) AS dated, count(DISTINCT section) AS sections FROM documents GROUP BY 1""",
    "documents",
)
def q133_provenance_coverage(docs):
    """How many of each source's chunks tell where they come from."""
    share = lambda c: F.round(F.count(c) / F.count("*"), 4)
    return docs.groupBy("source").agg(F.count("*").alias("chunks"), share("profile_id").alias("with_profile"), share("title").alias("with_title"), share("published_at").alias("dated"), F.countDistinct("section").alias("sections"))


@R.query(
    """WITH r AS (SELECT unnest(list_filter(string_split(coalesce(status_reason, ''), ','), lambda x: trim(x) <> '')) AS reason, source_id FROM source_record) SELECT trim(reason) AS reason, count(*) AS records, count(DISTINCT source_id) AS sources FROM r GROUP BY 1""",
    "source_record",
)
def q134_reason_counts(sources):
    """How often each reason of a status is given."""
    rows = sources.select("source_id", F.explode(F.split(F.coalesce("status_reason", F.lit("")), ",")).alias("reason")).where("trim(reason) <> ''")
    return rows.groupBy(F.trim("reason").alias("reason")).agg(F.count("*").alias("records"), F.countDistinct("source_id").alias("sources"))
