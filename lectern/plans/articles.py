"""Queries that check articles, made from documents: each cites its neighbours and stands under headings."""

from __future__ import annotations

from pyspark.sql import functions as F

from lectern.operators import articles as A
from lectern.plans._base import Registry
from lectern.plans.cleaning import strip

R = Registry()

_BODY = """'By ' || CASE WHEN doc_id % 4 = 0 THEN 'Dr. ' || name ELSE 'the desk' END || E'\\n\\n## Why This Matters Now\\n\\n' || text || ' [chunk:' || (doc_id - 1) || E'] and so.\\n\\n## Historical Background\\n\\nThis led to much, as ' || name || ' said in 1999 and 2004. [chunk:' || (doc_id // 2) || E']\\n\\n## '
  || CASE WHEN doc_id % 3 = 0 THEN 'Limits' ELSE 'What to Watch Next' END || E'\\n\\n' || coalesce(title, 'untitled') || ' follows because of it all, they hold. [chunk:' || (doc_id * 3) || ']' || CASE WHEN doc_id % 2 = 0 THEN E'\\n\\n## Sources\\n\\nhttps://a.edu/' || doc_id ELSE ' See https://b.com/x' END"""
_ART = f"""n AS (SELECT profile_id, min(profile_name) AS name FROM collected_meta WHERE profile_name IS NOT NULL GROUP BY 1), d0 AS (SELECT doc_id, title, text, section, coalesce(n.name, 'Ann Lee') AS name FROM documents d LEFT JOIN n ON d.profile_id = n.profile_id WHERE text IS NOT NULL),
    a AS (SELECT doc_id, title, section, name, {_BODY} AS body FROM d0)"""


def _articles(docs, meta):
    n = meta.where("profile_name is not null").groupBy("profile_id").agg(F.min("profile_name").alias("name"))
    d = docs.where("text is not null").join(n, "profile_id", "left").withColumn("name", F.coalesce("name", F.lit("Ann Lee")))
    i = F.col("doc_id")
    say = lambda *p: F.concat(*[x if not isinstance(x, str) else F.lit(x) for x in p])
    body = say(
        "By ", F.when(i % 4 == 0, F.concat(F.lit("Dr. "), "name")).otherwise("the desk"), "\n\n## Why This Matters Now\n\n", F.col("text"), " [chunk:", (i - 1).cast("string"), "] and so.\n\n## Historical Background\n\nThis led to much, as ", F.col("name"), " said in 1999 and 2004. [chunk:",
        F.floor(i / 2).cast("string"), "]\n\n## ", F.when(i % 3 == 0, "Limits").otherwise("What to Watch Next"), "\n\n", F.coalesce("title", F.lit("untitled")), " follows because of it all, they hold. [chunk:", (i * 3).cast("string"), "]",
        F.when(i % 2 == 0, F.concat(F.lit("\n\n## Sources\n\nhttps://a.edu/"), i.cast("string"))).otherwise(" See https://b.com/x"),
    )
    return d.select("doc_id", "title", "section", "name", body.alias("body"))


_SECS = rf"""p AS (SELECT *, list_filter(list_transform(string_split(regexp_replace(body, '(?m)^(#{{2,4}}[ \t])', E'\x01\\1', 'g'), E'\x01'), lambda s: struct_pack(h := CASE WHEN regexp_matches(s, '^#{{2,4}}[ \t]') THEN trim(regexp_extract(s, '^#{{2,4}}[ \t]+([^\n]*)', 1)) ELSE 'Introduction' END, t := {strip(r"regexp_replace(s, '^#{2,4}[ \t][^\n]*\n?', '')")})), lambda x: x.t <> '') AS s FROM a),
    m AS (SELECT *, list_filter(s, lambda x: NOT regexp_matches(lower(x.h), 'sources|references|citations|notes')) AS m FROM p)"""


def _w(c: str) -> str:
    return f"len(regexp_extract_all({c}, '[A-Za-z0-9'']+'))"


_G = " ".join(f"CASE WHEN NOT regexp_matches(b, '{p}') THEN 'missing_required_section:{k}' END," for k, p in {"why_now": "why this matters now|what(''s| is) at stake|urgency", "historical": "historical|background|context", "scholar_lens": "scholar|core argument|lens|framework", "counterarguments": "counterargument|objection|tension|limit", "implications": "implication|policy|public debate|takeaway", "watch_next": "what to watch|watch next|next|ahead", "conclusion": "conclusion|closing|final"}.items())
_STRUCT = rf"""g AS (SELECT *, lower(array_to_string(list_transform(m, lambda x: x.h), ' || ')) AS b, list_transform(list_filter(m, lambda x: {_w('x.t')} < 60)[1:6], lambda x: x.h) AS sh, list_transform(list_filter(m, lambda x: {_w('x.t')} >= 60 AND NOT regexp_matches(x.t, '\n\s*\n'))[1:6], lambda x: x.h) AS fl FROM m),
    e AS (SELECT *, list_filter([CASE WHEN {_w('body')} < 900 THEN 'article_word_count_below_minimum:' || {_w('body')} END, CASE WHEN len(m) < 6 THEN 'insufficient_major_sections' END, {_G} CASE WHEN len(sh) > 0 THEN 'underdeveloped_sections:' || array_to_string(sh, ',') END, CASE WHEN len(fl) > 0 THEN 'single_paragraph_sections:' || array_to_string(fl, ',') END,
      CASE WHEN NOT contains(body, '## Sources') THEN 'missing_sources_section' END], lambda x: x IS NOT NULL) AS st FROM g)"""
_LENS = """l AS (SELECT *, lower(trim(name)) AS f, coalesce(list_filter(regexp_extract_all(lower(trim(name)), '[a-z]{3,}'), lambda w: w NOT IN ('sir', 'dr', 'prof', 'professor'))[-1], '') AS sn FROM e),
    o AS (SELECT *, greatest((length(body) - length(replace(lower(body), f, ''))) // greatest(length(f), 1), CASE WHEN sn = '' THEN 0 ELSE (length(body) - length(replace(lower(body), sn, ''))) // length(sn) END) AS times, len(list_filter(m, lambda x: contains(lower(x.t), f) OR (sn <> '' AND contains(lower(x.t), sn)))) AS hits,
      regexp_replace(body, '\\[chunk:[^\\]]*\\]', ' ', 'g') AS plain FROM l),
    z AS (SELECT *, CASE WHEN times < 2 THEN 'insufficient_scholar_specific_grounding' WHEN hits < least(3, greatest(1, len(m))) THEN 'limited_scholar_lens_distribution' ELSE '' END AS lens, len(list_distinct(regexp_extract_all(plain, '(?:^|[^0-9])((?:19|20)[0-9]{2})(?:[^0-9]|$)', 1))) AS ys,
      len(regexp_extract_all(plain, '(?:^|[^0-9A-Za-z_.])[0-9]+(?:\\.[0-9]+)?')) AS nums FROM o),
    v AS (SELECT *, CASE WHEN ys = 0 AND nums < 10 THEN 'insufficient_concrete_details' WHEN ys < 2 THEN 'low_year_specificity' ELSE '' END AS details FROM z)"""


@R.query(f"WITH {_ART}, {_SECS}, {_STRUCT} SELECT doc_id, CAST(len(s) AS INTEGER) AS sections, array_to_string(st, '|') AS errors FROM e", "documents", "collected_meta")
def q145_article_structure(docs, meta):
    a = _articles(docs, meta)
    return a.select("doc_id", F.size(A.sections(F.col("body"))).alias("sections"), F.array_join(A.structure(F.col("body")), "|").alias("errors"))


@R.query(f"WITH {_ART}, {_SECS}, {_STRUCT}, {_LENS} SELECT doc_id, lens, details FROM v", "documents", "collected_meta")
def q146_lens_and_details(docs, meta):
    """Whether each article names its person often enough and throughout, and tells years and numbers."""
    return _articles(docs, meta).select("doc_id", A.lens(F.col("body"), F.col("name")).alias("lens"), A.details(F.col("body")).alias("details"))


_PARAS = rf"""q AS (SELECT doc_id, list_filter(list_transform(string_split_regex(body, '\n\s*\n'), lambda s: {strip(rf"regexp_replace({strip('s')}, '(?m)^#{{1,6}}[ \t][^\n]*\n?', '', 'g')")}), lambda s: s <> '' AND NOT starts_with(s, '>') AND regexp_matches(s, '\[chunk:[^\]\s]+\]')) AS q FROM a),
    r AS (SELECT doc_id, unnest(range(0, len(q))) AS n, unnest(q) AS p FROM q)"""
_CAUSAL = A.CAUSAL


@R.query(
    rf"""WITH {_ART}, {_PARAS}, c AS (SELECT *, lower(regexp_replace(p, '\[chunk:[^\]]+\]', ' ', 'g')) AS t FROM r), f AS (SELECT doc_id, n, unnest(list_distinct(regexp_extract_all(p, '\[chunk:([^\]\s]+)\]', 1))) AS c FROM c WHERE len(regexp_extract_all(t, '[a-z'']+')) >= 6 AND regexp_matches(t, '{_CAUSAL}')),
    k AS (SELECT CAST(doc_id AS VARCHAR) AS c, regexp_matches(lower(coalesce(section, '')), 'publication|early works|later works|bibliography|editorial work') AS w FROM documents), j AS (SELECT f.doc_id, n, count(*) FILTER (w IS NULL) AS u, bool_and(coalesce(w, false)) AS o FROM f LEFT JOIN k ON f.c = k.c GROUP BY 1, 2)
    SELECT doc_id, CASE WHEN u > 0 THEN 'causal_claim_missing_valid_citation' ELSE 'causal_paragraph_publications_only_evidence' END AS error, count(*) AS n FROM j WHERE u > 0 OR o GROUP BY 1, 2""",
    "documents",
    "collected_meta",
)
def q147_causal_evidence(docs, meta):
    """Paragraphs that claim a cause, by what they cite."""
    return A.causal_evidence(_articles(docs, meta), docs, "doc_id", "body", "doc_id", "section")


_TOK4 = r"list_distinct(list_filter(regexp_extract_all(lower({0}), '[\p{{L}}\p{{N}}_]+'), lambda w: length(w) >= 4))"


@R.query(
    rf"""WITH {_ART}, {_SECS}, x AS (SELECT doc_id, unnest(range(0, len(m))) AS n, unnest(m) AS x FROM m), y AS (SELECT doc_id, n, x.h AS heading, x.t AS t FROM x WHERE len(regexp_extract_all(x.t, '[A-Za-z'']+')) >= 80),
    i AS (SELECT *, regexp_extract_all(t, '\[chunk:([^\]\s]+)\]', 1) AS ids, len(regexp_extract_all(substr(t, 1, CAST(floor(length(t) * 0.6) AS INTEGER) + 7), '\[chunk:')) AS early, {_TOK4.format('t')} AS w FROM y),
    u AS (SELECT doc_id, n, w, early, unnest(range(0, len(ids))) AS i, unnest(ids) AS c FROM i), k AS (SELECT CAST(doc_id AS VARCHAR) AS c, {_TOK4.format('text')} AS v FROM documents WHERE text IS NOT NULL),
    j AS (SELECT u.doc_id, n, v IS NULL AS miss, i < early AS soon, v IS NOT NULL AND (len(list_intersect(w, v)) >= 3 OR len(list_intersect(w, v)) / greatest(len(w), 1) >= 0.02) AS strong FROM u LEFT JOIN k ON u.c = k.c),
    g AS (SELECT doc_id, n, count(*) FILTER (miss) AS unknown, bool_or(strong) AS strong, bool_or(strong AND soon) AS soon FROM j GROUP BY 1, 2),
    z AS (SELECT i.doc_id, heading, list_filter([CASE WHEN len(ids) = 0 THEN 'section_missing_citation' END, CASE WHEN len(ids) > 0 AND early = 0 THEN 'section_citation_end_loaded' END, CASE WHEN unknown > 0 THEN 'section_unknown_or_missing_citations' END, CASE WHEN unknown = 0 AND NOT strong THEN 'section_weak_citation_grounding' END, CASE WHEN unknown = 0 AND NOT soon THEN 'section_missing_early_strong_citation' END], lambda q: q IS NOT NULL) AS e
      FROM i LEFT JOIN g ON i.doc_id = g.doc_id AND i.n = g.n) SELECT doc_id, heading, unnest(e) AS error FROM z""",
    "documents",
    "collected_meta",
)
def q148_section_citations(docs, meta):
    """What is wrong with the citations of each longer section."""
    return A.section_citations(_articles(docs, meta), docs, "doc_id", "body", "doc_id", "text")


@R.query(
    rf"""WITH {_ART}, {_PARAS}, s AS (SELECT doc_id, n AS place, trim(regexp_replace(regexp_replace(p, '\[chunk:[^\]]+\]', ' ', 'g'), '[\s\x{{A0}}]+', ' ', 'g')) AS t, list_distinct(regexp_extract_all(p, '\[chunk:([^\]\s]+)\]', 1)) AS ids FROM r WHERE n < 8),
    c AS (SELECT doc_id, place, lower(list_filter(list_transform(string_split(regexp_replace(t, '([.!?])[\s\x{{A0}}]+', E'\\1\n', 'g'), chr(10)), lambda x: trim(x)), lambda x: x <> '')[1]) AS t, ids FROM s), f AS (SELECT * FROM c WHERE length(t) >= 12), u AS (SELECT doc_id, place, t, unnest(ids) AS c FROM f),
    k AS (SELECT CAST(doc_id AS VARCHAR) AS c, regexp_matches(lower(coalesce(section, '')), 'publication|early works|later works|bibliography|editorial work') AS w FROM documents),
    j AS (SELECT u.doc_id, place, any_value(t) AS t, count(*) FILTER (w IS NULL) AS un, bool_and(coalesce(w, false)) AS o FROM u LEFT JOIN k ON u.c = k.c GROUP BY 1, 2),
    e AS (SELECT doc_id, t, CASE WHEN un > 0 THEN 'claim_map_unknown_chunk_ids' WHEN o AND regexp_matches(t, '{_CAUSAL}') THEN 'causal_claim_publications_only_evidence' END AS e FROM j),
    g AS (SELECT e.doc_id, count(*) FILTER (e IS NULL) AS kept, coalesce(string_agg(DISTINCT e, ',' ORDER BY e), '') AS errors, CAST(sum(CASE WHEN e IS NULL AND len(list_filter(list_filter(regexp_extract_all(t, '[\p{{L}}\p{{N}}_]+'), lambda w: length(w) >= 4), lambda w: contains(lower(body), w))) = 0 THEN 1 ELSE 0 END) AS BIGINT) AS warnings FROM e JOIN a ON e.doc_id = a.doc_id GROUP BY 1)
    SELECT doc_id, kept, CASE WHEN kept < 1 THEN CASE WHEN errors = '' THEN '' ELSE errors || ',' END || 'claim_evidence_map_below_minimum_after_normalization' ELSE errors END AS errors, warnings FROM g""",
    "documents",
    "collected_meta",
)
def q149_claim_map(docs, meta):
    """Claims made from the cited paragraphs of each article, checked against what they cite."""
    a = _articles(docs, meta)
    return A.claim_map(A.synthesised_claims(a, "doc_id", "body"), docs, a, "doc_id", "claim", "ids", "doc_id", "section", "body")


@R.query(
    rf"""WITH {_ART}, w AS (SELECT doc_id, body, regexp_extract_all(body, 'https?://[^\s)\]>"'']+') AS w, ['https://a.edu/' || doc_id, 'https://www.c.org/y/'] AS allowed, CASE WHEN doc_id % 3 = 0 THEN ['https://A.edu/' || doc_id || '/?utm_source=x', 'https://zzz.com/'] ELSE ['https://a.edu/' || doc_id] END AS sel FROM a),
    e AS (SELECT doc_id, list_filter([CASE WHEN doc_id % 3 = 0 THEN 'source_urls_not_in_allowed_pool' END, CASE WHEN len(list_filter(w, lambda u: regexp_replace(u, '/+$', '') NOT IN ('https://a.edu/' || doc_id, 'https://www.c.org/y', 'https://c.org/y'))) > 0 THEN 'unknown_article_urls' END, 'insufficient_source_url_citations',
      CASE WHEN NOT contains(body, sel[1]) THEN 'source_url_missing_from_sources_section' END], lambda x: x IS NOT NULL) AS e FROM w) SELECT doc_id, array_to_string(e, ',') AS errors FROM e""",
    "documents",
    "collected_meta",
)
def q150_link_citations(docs, meta):
    """Links of each article against those that it may use."""
    i = F.col("doc_id").cast("string")
    allowed = F.array(F.concat(F.lit("https://a.edu/"), i), F.lit("https://www.c.org/y/"))
    chosen = F.when(F.col("doc_id") % 3 == 0, F.array(F.concat(F.lit("https://A.edu/"), i, F.lit("/?utm_source=x")), F.lit("https://zzz.com/"))).otherwise(F.array(F.concat(F.lit("https://a.edu/"), i)))
    return _articles(docs, meta).select("doc_id", F.array_join(A.link_citations(F.col("body"), chosen, allowed), ",").alias("errors"))


@R.query(
    rf"""WITH {_ART}, {_SECS}, {_STRUCT}, {_LENS}, y AS (SELECT *, doc_id % 4 = 0 AS mine, doc_id % 2 = 0 AS dead, len(list_distinct(regexp_extract_all(body, '\[chunk:([^\]\s]+)\]', 1))) AS cites FROM v),
    x AS (SELECT doc_id, list_distinct(list_concat(list_filter([CASE WHEN length(trim(coalesce(title, ''))) < 10 THEN 'title_too_short' END, CASE WHEN length(trim(body)) < 500 THEN 'article_too_short' END, CASE WHEN lens = 'insufficient_scholar_specific_grounding' THEN lens END, CASE WHEN details = 'insufficient_concrete_details' THEN details END, CASE WHEN cites < 3 THEN 'insufficient_inline_citations' END,
      CASE WHEN regexp_matches(lower(body), 'as i write this today|my latest research|(^|[^a-z])i recently([^a-z]|$)') OR contains(lower(body), 'i am ' || f) OR (dead AND regexp_matches(lower(body), '(^|[^a-z])(i\s+(argue|believe|write|wrote|contend|maintain|have|am|was|will|see|remember|want|think)|my\s+(work|research|life|view|argument|books|career|teaching))([^a-z]|$)')) THEN 'persona_violation' END,
      CASE WHEN dead AND mine THEN 'byline_impersonation' END, CASE WHEN dead AND regexp_matches(lower(body), 'still alive|i am alive|my current office') THEN 'posthumous_violation' END], lambda q: q IS NOT NULL), st)) AS e, mine, len(list_filter(string_split(body, chr(10))[2:25], lambda s: regexp_matches(trim(regexp_replace(trim(s), '^#{{1,6}}\s+', '')), '(?i)^(written )?by\s+.+$'))) > 0 AS other FROM y)
    SELECT doc_id, array_to_string(list_sort(e), '|') AS errors, NOT mine OR other AS byline_kept FROM x""",
    "documents",
    "collected_meta",
)
def q151_story_errors(docs, meta):
    """All errors of each article by itself, and whether its byline stays when those that name its person are taken out."""
    a, body, name = _articles(docs, meta), F.col("body"), F.col("name")
    errors = A.story_errors(F.col("title"), body, name, F.col("doc_id") % 2 == 0, F.array().cast("array<string>"), least=3)
    return a.select("doc_id", F.array_join(F.array_sort(errors), "|").alias("errors"), (F.size(A.bylines(A.without_bylines(body, name))) > 0).alias("byline_kept"))


@R.query(
    """WITH t AS (SELECT doc_id, coalesce(text, '') AS raw, lower(coalesce(text, '')) AS low, regexp_extract_all(lower(coalesce(text, '')), '[a-z]{3,}') AS w FROM documents),
    n AS (SELECT *, list_sum(list_transform(['photo credit', 'loading', 'previous', 'next', 'click', 'subscribe', 'menu', 'copyright', 'all rights reserved', 'share', 'cookie'], lambda k: (length(low) - length(replace(low, k, ''))) // length(k))) AS noise, len(regexp_extract_all(raw, '[0-9]')) / greatest(length(raw), 1) AS dg FROM t)
    SELECT doc_id, round(CASE WHEN len(w) < 18 THEN 0 ELSE greatest(0, least(1, 0.55::DOUBLE * least(1, len(w) / 140.0::DOUBLE) + 0.45::DOUBLE * len(list_distinct(w)) / greatest(len(w), 1) - least(0.65, noise * 0.08) - CASE WHEN dg > 0.09 THEN 0.12 ELSE 0 END)) END, 4) AS score FROM n""",
    "documents",
)
def q152_chunk_quality(docs):
    return docs.select("doc_id", F.round(A.chunk_quality(F.col("text")), 4).alias("score"))
