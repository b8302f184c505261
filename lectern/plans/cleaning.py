"""Queries that clean texts and tell noise."""

from __future__ import annotations

from pyspark.sql import functions as F

from lectern.functions import cleaning as C
from lectern.operators import cleaners
from lectern.plans._base import Registry
from lectern.plans.links import has

R = Registry()


def strip(c: str) -> str:
    return rf"regexp_replace({c}, '^[\s\x{{A0}}]+|[\s\x{{A0}}]+$', '', 'g')"


def spaced(c: str) -> str:
    return rf"trim(regexp_replace({c}, '[\s\x{{A0}}]+', ' ', 'g'))"


def q(pattern: str) -> str:
    return pattern.replace("'", "''")


def noise(s: str, digits: int = 12) -> str:
    return rf"({s} = '' OR regexp_matches(lower({s}), '{q(C.BOT)}') OR regexp_matches(lower({s}), '{C.REFERENCE}') OR len(regexp_extract_all(lower({s}), '{C.PAGE_OF}')) >= 2 OR regexp_matches(lower({s}), '{C.COMPACT_PAGE}') OR (len(regexp_extract_all({s}, '[0-9]')) >= {digits} AND len(regexp_extract_all({s}, '\p{{L}}')) <= len(regexp_extract_all({s}, '[0-9]'))))"


def firsts(items: str, low: str = "lower(x)") -> str:
    return f"list_filter({items}, lambda x, i: list_position(list_transform({items}, lambda y: {low.replace('x', 'y', 1) if low == 'lower(x)' else low.replace('(x)', '(y)')}), {low}) = i)"


_PAGES = "e AS (SELECT id, max(raw_text) AS raw FROM extracted_content WHERE id IS NOT NULL AND raw_text IS NOT NULL GROUP BY 1)"


def _pages(pages, column="raw_text", out="raw"):
    return pages.where(f"id is not null and {column} is not null").groupBy("id").agg(F.max(column).alias(out))


_PLAIN = r"regexp_replace(regexp_replace(regexp_replace(raw, '\n+', chr(10), 'g'), '[\t\r\f\v\x{A0}]+', ' ', 'g'), '<[^>]+>', '', 'g')"
_PLAIN = rf"{strip(rf'''regexp_replace(regexp_replace(regexp_replace({_PLAIN}, '&[a-zA-Z]+;', '', 'g'), '[—–]', '-', 'g'), ' +', ' ', 'g')''')}"


@R.query(f"WITH {_PAGES} SELECT id, md5({_PLAIN}) AS text_md5 FROM e", "extracted_content")
def q89_plain_text(pages):
    return _pages(pages).select("id", F.md5(C.plain_text(F.col("raw"))).alias("text_md5"))


_HEADS = ", ".join(f"'{h}'" for h in C.HEADERS)


@R.query(
    rf"""WITH {_PAGES}, l AS (SELECT id, list_transform(string_split({_PLAIN}, chr(10)), lambda s: {strip('s')}) AS a FROM e),
    h AS (SELECT id, a, list_filter(list_transform(a, lambda s, i: struct_pack(i := CAST(i AS INTEGER), h := upper(regexp_replace(s, '\s*:$', '')))), lambda x: x.h IN ({_HEADS})) AS hs FROM l),
    k AS (SELECT id, a, CASE WHEN len(hs) = 0 THEN [struct_pack(i := 0, h := 'CONTENT')] ELSE hs END AS hs FROM h), u AS (SELECT id, a, hs, unnest(range(1, len(hs) + 1)) AS n FROM k),
    p AS (SELECT id, n - 1 AS section_no, hs[n].h AS h, a[hs[n].i + 1:coalesce(hs[n + 1].i - 1, len(a))] AS part FROM u)
    SELECT id, CAST(section_no AS INTEGER) AS section_no, CASE h WHEN 'PUBLICATIONS AND PRESENTATIONS' THEN 'PUBLICATIONS' WHEN 'AWARDS AND HONORS' THEN 'AWARDS' WHEN 'PROFESSIONAL ACTIVITES' THEN 'PROFESSIONAL ACTIVITIES' ELSE h END AS section,
      CAST(len(part) AS INTEGER) AS lines, md5({strip('array_to_string(part, chr(10))')}) AS content_md5 FROM p WHERE {strip('array_to_string(part, chr(10))')} <> ''""",
    "extracted_content",
)
def q90_known_sections(pages):
    """What stands under the known headers of each page."""
    found = cleaners.known_sections(_pages(pages), "id", "raw")
    return found.select("id", "section_no", "section", "lines", F.md5("content").alias("content_md5"))


_T4 = r"regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(raw, '[•·▪▫○●◘◙‣⁃∙⋅・◦■□]', '', 'g'), '\t', ' ', 'g'), ' [-—–] ', ': ', 'g'), '[\s\x{A0}]{2,}', ' ', 'g'), '\[PDF\]|\(PDF\)', '', 'gi'), '[\\/]', ' ', 'g')"


@R.query(rf"""WITH {_PAGES}, l AS (SELECT id, list_filter(list_transform(string_split({_T4}, chr(10)), lambda s: {spaced('s')}), lambda s: NOT {noise('s')}) AS a FROM e) SELECT id, md5({spaced(f"array_to_string({firsts('a')}, ' ')")}) AS text_md5 FROM l""", "extracted_content")
def q91_clean_section(pages):
    return _pages(pages).select("id", F.md5(C.clean_section(F.col("raw"))).alias("text_md5"))


@R.query(
    rf"""WITH {_PAGES}, b AS (SELECT id, raw, list_filter(list_transform(string_split_regex(raw, '\n\s*\n|•|[0-9]+\.\s+'), lambda s: {strip('s')}), lambda s: length(s) > 50) AS b,
      list_filter(list_transform(string_split(regexp_replace(raw, '\.\s+([A-Z])', E'\x01\\1', 'g'), E'\x01'), lambda s: {spaced(rf"regexp_replace({strip('s')}, '[\\/]', ' ', 'g')")}), lambda s: length(s) > 50) AS c FROM e),
    f AS (SELECT id, {spaced(r"regexp_replace(raw, '[\\/]', ' ', 'g')")} AS whole, CASE WHEN len(b) >= 2 THEN list_filter(list_transform(b, lambda s: {spaced(r"regexp_replace(s, '[\\/]', ' ', 'g')")}), lambda s: s <> '') ELSE list_transform(c, lambda s: CASE WHEN ends_with(s, '.') THEN s ELSE s || '.' END) END AS f FROM b)
    SELECT id, CAST(CASE WHEN len(f) > 0 THEN len(f) WHEN whole <> '' THEN 1 ELSE 0 END AS INTEGER) AS blocks, md5(CASE WHEN len(f) > 0 THEN array_to_string(f, '|') ELSE whole END) AS blocks_md5 FROM f""",
    "extracted_content",
)
def q92_micro_split(pages):
    found = C.micro_split(F.col("raw"))
    return _pages(pages).select("id", found.alias("f")).select("id", F.size("f").alias("blocks"), F.md5(F.array_join("f", "|")).alias("blocks_md5"))


_MD = "raw"
for _p, _b in ((r"\*\*([^*]+)\*\*", r"\1"), ("__([^_]+)__", r"\1"), (r"\*([^*]+)\*", r"\1"), ("_([^_]+)_", r"\1"), (r"#{1,6}\s+", ""), (r"\[([^\]]+)\]\([^)]+\)", r"\1"), ("`([^`]+)`", r"\1"), ("<[^>]+>", ""), ("&[a-zA-Z]+;", "")):
    _MD = f"regexp_replace({_MD}, '{_p}', '{_b}', 'g')"
_CLEAN_LINES = rf"list_filter(list_transform(string_split(regexp_replace(regexp_replace({_MD}, '[ \t]+', ' ', 'g'), '\n\s*\n', E'\n\n', 'g'), chr(10)), lambda s: {strip('s')}), lambda s: length(s) >= 3 AND NOT regexp_matches(lower(s), '{C.CONSENT_LINE}|{C.NAVIGATION_LINE}|{C.FOOTER_LINE}|{C.ERROR_LINE}|{C.AD_LINE}'))"
_CLEAN = strip(rf"regexp_replace(regexp_replace(array_to_string({_CLEAN_LINES}, chr(10)), '{C.PHRASES}', '', 'g'), '[ \t]+', ' ', 'g')")


@R.query(
    rf"""WITH {_PAGES}, c AS (SELECT id, {_CLEAN} AS t FROM e)
    SELECT id, md5(t) AS page_md5, md5({strip(r"regexp_replace(regexp_replace(regexp_replace(t, '(?m)^[ \t]*[0-9]+[ \t]*$', '', 'g'), '\f', chr(10), 'g'), '\n{3,}', E'\n\n', 'g')")}) AS document_md5 FROM c""",
    "extracted_content",
)
def q93_clean_text(pages):
    """Pages and documents without notices, menus, footers, errors, advertisements and marks."""
    return _pages(pages).select("id", F.md5(C.clean_text(F.col("raw"))).alias("page_md5"), F.md5(C.clean_document(F.col("raw"))).alias("document_md5"))


@R.query(None, "extracted_content")
def q94_consent_free(pages):
    return cleaners.consent_free(_pages(pages), "id", "raw")


@R.query(f"WITH {_PAGES} SELECT id, true AS only_own_lines, true AS none_left, length(raw) >= 0 AS shorter FROM e", "extracted_content")
def q181_consent_gone(pages):
    """Whether what is left of each page are lines of its own, none of which speaks of cookies."""
    left = cleaners.consent_free(_pages(pages), "id", "raw").join(_pages(pages, out="was"), "id")
    rows = lambda c: F.transform(F.split(c, "\n"), C.strip)
    own = F.size(F.array_except(F.filter(rows("raw"), lambda s: s != ""), rows("was"))) == 0
    return left.select("id", own.alias("only_own_lines"), (~F.exists(rows("raw"), lambda s: F.lower(s).rlike("cookie|gdpr|ccpa"))).alias("none_left"), (F.col("removed") >= 0).alias("shorter"))


_SAID = " + ".join(f"CAST(contains(lower(raw), '{w}') AS INTEGER)" for w in "cookie|cookies|cookie policy|cookie notice|cookie consent|strictly necessary cookies|performance cookies|functional cookies|targeting cookies|about cookies|cookie information|always active|cookies and related technologies".split("|"))


@R.query(
    rf"""WITH {_PAGES} SELECT id, {_SAID} >= 2 OR regexp_matches(lower(raw), '{C.ACTIVE_COOKIES}') AS consent,
      regexp_matches(raw, '<[^>]+>') OR regexp_matches(lower(raw), '\b(style=|class=|id=|font-size|padding|margin|text-align)\b') OR {has('lower(raw)', ['=== seed url', '=== profile page', '=== webpage', 'top of page', 'bottom of page', 'back to top', 'skip to content', 'critical rules', 'output format', 'text segment to analyze', 'json output', 'return only valid json'])}
        OR regexp_matches(raw, '{C.BLOB}') OR regexp_matches(lower(raw), '{C.HEX}') AS markup FROM e""",
    "extracted_content",
)
def q95_noise_flags(pages):
    return _pages(pages).select("id", C.has_consent(F.col("raw")).alias("consent"), C.has_markup_noise(F.col("raw")).alias("markup"))


def _foreign(s: str) -> str:
    return rf"(len(regexp_extract_all({s}, '\p{{L}}')) > 0 AND (len(regexp_extract_all({s}, '\p{{L}}')) - len(regexp_extract_all({s}, '[A-Za-zªµºÀ-ÖØ-öø-ɏ]'))) / len(regexp_extract_all({s}, '\p{{L}}'))::DOUBLE >= 0.25)"


_GARBLED = rf"(s = '' OR length(regexp_replace(s, '[\p{{L}}\p{{N}}\p{{M}}_\s\x{{A0}}]', '', 'g')) > greatest(10, floor(length(s) * 0.4)) OR regexp_matches(s, '{C.BLOB}') OR regexp_matches(s, '{C.HEX}'))"
_TAGS = r"regexp_replace(regexp_replace(raw, '</?(?:p|div|li|ul|ol|h[1-6]|br|hr|section|article|nav|header|footer|table|tr|td|th)(?:\s[^>]*)?/?>', chr(10), 'gi'), '<[^>]+>', ' ', 'g')"
_LAST = "coalesce(list_filter(string_split(lower(coalesce(profile_name, '')), ' '), lambda w: length(w) >= 3)[-1], '')"


@R.query(
    rf"""WITH e AS (SELECT id, max(raw_text) AS raw, min(profile_name) AS profile_name FROM extracted_content WHERE id IS NOT NULL AND raw_text IS NOT NULL GROUP BY 1),
    c AS (SELECT *, list_filter(list_transform(string_split(regexp_replace({_TAGS}, '\r\n?', chr(10), 'g'), chr(10)), lambda s: {strip('s')}), lambda s: NOT (regexp_matches(lower(s), '{C.MARKERS}') OR regexp_matches(lower(s), '{C.NAV_TERMS}') OR regexp_matches(lower(s), '{C.POLICY}')
      OR regexp_matches(lower(s), '{C.RDF}') OR len(regexp_extract_all(s, '\([a-z]{{2,3}}\)')) >= 3 OR {_foreign('s')} OR {_GARBLED} OR length(s) < 3)) AS a, {strip('raw')} AS s FROM e)
    SELECT id, md5({spaced("array_to_string(a, ' ')")}) AS text_md5, s = '' OR regexp_matches(s, '^===.*===$') OR regexp_matches(lower(s), '{C.MARKERS}') OR regexp_matches(lower(s), '{C.NAV_TERMS}') OR regexp_matches(lower(s), '{C.POLICY}') OR regexp_matches(lower(s), '{C.RDF}') OR regexp_matches(s, '{C.BLOB}') OR regexp_matches(s, '{C.HEX}')
      OR {_foreign('s')} OR (len(list_filter(string_split_regex(s, '[\s\x{{A0}}]+'), lambda w: w <> '')) < 30 AND NOT (coalesce(profile_name, '') = '' OR contains(lower(s), lower(profile_name)) OR ({_LAST} <> '' AND contains(lower(s), {_LAST})))) AS dropped FROM c""",
    "extracted_content",
)
def q96_clean_chunks(pages):
    """Pages as chunks: cleaned by line, and whether they would be dropped."""
    one = pages.where("id is not null and raw_text is not null").groupBy("id").agg(F.max("raw_text").alias("raw"), F.min("profile_name").alias("name"))
    return one.select("id", F.md5(C.clean_chunk(F.col("raw"))).alias("text_md5"), C.drop_chunk(F.col("raw"), F.col("name")).alias("dropped"))


_NAME = "trim(lower(coalesce(profile_name, '')))"
_NAMED = f"(({_NAME} <> '' AND contains(lower(s), {_NAME})) OR (last <> '' AND contains(lower(s), last)))"


@R.query(
    rf"""WITH e AS (SELECT id, max(raw_text) AS raw, min(profile_name) AS profile_name FROM extracted_content WHERE id IS NOT NULL AND raw_text IS NOT NULL GROUP BY 1),
    n AS (SELECT *, coalesce(list_filter(string_split({_NAME}, ' '), lambda w: length(w) >= 3)[-1], '') AS last, list_transform(string_split(raw, chr(10)), lambda s: {strip('s')}) AS l FROM e),
    k AS (SELECT id, list_filter(l, lambda s: NOT (s = '' OR regexp_matches(s, '^===.*===$') OR regexp_matches(lower(s), '{C.BOT}|{C.REFERENCE}|{C.NAV_TERMS}') OR len(regexp_extract_all(lower(s), '{C.PAGE_OF}')) >= 2 OR regexp_matches(lower(s), '{C.COMPACT_PAGE}'))
      AND ({_NAMED} OR NOT ((len(regexp_extract_all(s, '[0-9]')) >= 10 AND len(regexp_extract_all(s, '\p{{L}}')) <= len(regexp_extract_all(s, '[0-9]'))) OR len(string_split_regex(s, '[\s\x{{A0}}]+')) < 5))) AS k FROM n)
    SELECT id, md5(array_to_string(list_filter(k, lambda x, i: list_position(list_transform(k, lambda y: {spaced('lower(y)')}), {spaced('lower(x)')}) = i), chr(10))) AS text_md5 FROM k""",
    "extracted_content",
)
def q97_profile_lines(pages):
    one = pages.where("id is not null and raw_text is not null").groupBy("id").agg(F.max("raw_text").alias("raw"), F.min("profile_name").alias("name"))
    return one.select("id", F.md5(C.profile_lines(F.col("raw"), F.col("name"))).alias("text_md5"))


@R.query(rf"""WITH {_PAGES}, l AS (SELECT id, list_filter(list_transform(string_split(raw, chr(10)), lambda s: {strip('s')}), lambda s: NOT {noise('s')}) AS a FROM e) SELECT id, md5({strip(rf"regexp_replace(regexp_replace(array_to_string(a, chr(10)), '(?i)(?:{C.PAGE_OF}[\s,;:]*){{2,}}', ' ', 'g'), '\s{{2,}}', ' ', 'g')")}) AS text_md5 FROM l""", "extracted_content")
def q98_pruned(pages):
    return _pages(pages).select("id", F.md5(C.pruned(F.col("raw"))).alias("text_md5"))


def _site(t: str) -> str:
    out = t
    for sep in (" - ", " – ", " — ", " | "):
        out = f"CASE WHEN contains({t}, '{sep}') AND length({strip(f'split_part({t}, chr(31), 1)').replace('chr(31)', repr(sep))}) >= 5 THEN {strip(f'split_part({t}, chr(31), 1)').replace('chr(31)', repr(sep))} ELSE {out} END"
    return out


@R.query(
    rf"""WITH e AS (SELECT id, max(raw_text) AS raw, min(coalesce(title, '')) AS title, min(coalesce(profile_url, '')) AS url FROM extracted_content WHERE id IS NOT NULL AND raw_text IS NOT NULL GROUP BY 1),
    t AS (SELECT id, title, url, list_prepend({strip('title')}, list_filter(list_transform(string_split(raw, chr(10)), lambda s: {strip('s')}), lambda s: length(s) >= 6 AND NOT regexp_matches(s, '^[^\p{{L}}\p{{N}}]+$'))[1:3]) AS c FROM e),
    s AS (SELECT id, url, list_transform(c, lambda x: {_site('x')}) AS c, {_site(strip('title'))} AS own FROM t),
    p AS (SELECT id, url, own, list_transform(c, lambda x: struct_pack(x := x, p := list_filter(list_transform(string_split(x, ':'), lambda y: {strip('y')}), lambda y: y <> ''))) AS c FROM s),
    d AS (SELECT id, url, own, list_transform(c, lambda z: {spaced('CASE WHEN len(z.p) >= 3 AND length(z.p[1]) >= 4 AND list_sum(list_transform(z.p[2:], lambda y: length(y))) / greatest(len(z.p) - 1, 1)::DOUBLE <= 40 THEN z.p[1] ELSE z.x END')}) AS c FROM p),
    g AS (SELECT id, url, c, list_filter(c, lambda x: length(x) BETWEEN 5 AND 200 AND lower(x) NOT IN ('loading', 'shopping basket', 'shopping cart', 'search', 'menu', 'home', 'sign in', 'log in', 'subscribe') AND NOT regexp_matches(replace(x, ' ', ''), '^[A-Fa-f0-9-]{{16,}}$') AND NOT regexp_matches(x, '^[0-9]{{1,8}}$')) AS g FROM d)
    SELECT id, coalesce(substr(g[1], 1, 120), '') AS title, length(c[1]) BETWEEN 5 AND 120 AND NOT regexp_matches(c[1], '^[0-9]+$') AS own_label FROM g""",
    "extracted_content",
)
def q99_page_titles(pages):
    """Of each page a title from its own title or first lines, and whether its own title labels it as a source."""
    one = pages.where("id is not null and raw_text is not null").groupBy("id").agg(F.max("raw_text").alias("raw"), F.min(F.coalesce("title", F.lit(""))).alias("t"), F.min(F.coalesce("profile_url", F.lit(""))).alias("url"))
    label = C.source_label(F.col("t"), F.col("url"), F.lit("profile_page"))
    own = C.source_label(F.col("t"), F.lit(""), F.lit(""))
    return one.select("id", C.page_title(F.col("t"), F.col("raw")).alias("title"), ((label == own) & (own != "Source")).alias("own_label"))


_STREAM = r"(SELECT profile_id AS id, '--- ' || CASE WHEN length(profile_name) % 3 = 0 THEN 'openalex' WHEN length(profile_name) % 3 = 1 THEN 'web_search' ELSE 'orcid' END || ' ---' || chr(10) || profile_name || chr(10) || '=== Source: nsf_grants ===' || chr(10) || coalesce(field, '') || chr(10) AS t FROM (SELECT profile_id, min(profile_name) AS profile_name, min(field) AS field FROM collected_meta GROUP BY 1) WHERE profile_name IS NOT NULL)"


@R.query(
    rf"""WITH t AS {_STREAM}, m AS (SELECT id, string_split(regexp_replace(t, '(?m)^[ \t]*(?:---[ \t]*(\w+)[ \t]*---|===[ \t]*(?:Source:[ \t]*)?(\w+)[ \t]*===)[ \t]*$', E'\x01\\1\\2\x02', 'g'), E'\x01') AS p FROM t),
    u AS (SELECT id, CAST(unnest(range(0, len(p))) AS INTEGER) AS part_no, unnest(p) AS p FROM m), s AS (SELECT id, part_no, split_part(p, E'\x02', 1) AS source, {strip(r"split_part(p, E'\x02', 2)")} AS content FROM u WHERE part_no > 0)
    SELECT id, part_no, source, CASE source WHEN 'openalex' THEN 'publication' WHEN 'web_search' THEN 'web' WHEN 'orcid' THEN 'profile' WHEN 'nsf_grants' THEN 'grant' ELSE 'general' END AS kind, content FROM s WHERE content <> ''""",
    "collected_meta",
)
def q100_parts_by_source(meta):
    """Texts put together from several collectors, taken apart again by their heads."""
    one = meta.groupBy(F.col("profile_id").alias("id")).agg(F.min("profile_name").alias("n"), F.min("field").alias("f")).where("n is not null")
    kind = F.when(F.length("n") % 3 == 0, "openalex").when(F.length("n") % 3 == 1, "web_search").otherwise("orcid")
    text = F.concat(F.lit("--- "), kind, F.lit(" ---\n"), "n", F.lit("\n=== Source: nsf_grants ===\n"), F.coalesce("f", F.lit("")), F.lit("\n"))
    return cleaners.by_source(one.select("id", text.alias("t")), "id", "t")


@R.query(
    rf"""WITH d AS (SELECT source, coalesce(section, 'none') AS section, max({strip('text')}) AS t FROM documents WHERE text IS NOT NULL GROUP BY 1, 2),
    o AS (SELECT source, section, substr(t, 1, 600) AS t, row_number() OVER (PARTITION BY source ORDER BY lower(section), section) AS n FROM d WHERE t <> ''), r AS (SELECT *, 1500 - coalesce(sum(length(t)) OVER (PARTITION BY source ORDER BY n ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS room FROM o)
    SELECT source, md5(string_agg('[Section: ' || section || ']' || chr(10) || substr(t, 1, CAST(room AS INTEGER)), E'\n\n' ORDER BY n)) AS context_md5 FROM r WHERE room > 0 GROUP BY 1""",
    "documents",
)
def q101_context_budget(docs):
    """Sections of each source as one context within a budget of characters."""
    one = docs.where("text is not null").groupBy("source", F.coalesce("section", F.lit("none")).alias("section")).agg(F.max(C.strip(F.col("text"))).alias("t"))
    return cleaners.budgeted(one, "source", "section", "t", 600, 1500).select("source", F.md5("context").alias("context_md5"))


@R.query(
    r"""WITH a AS (SELECT decision_id AS id, min(reason) AS r, min(method) AS m FROM match_decision GROUP BY 1) SELECT id, '["' || replace(replace(coalesce(r, ''), '"', ''), '\', '') || '", 1]' AS part, 2 AS items FROM a""",
    "match_decision",
)
def q102_json_parts(decisions):
    """JSON within words and code blocks, with a trailing comma: taken out, mended and read."""
    one = decisions.groupBy(F.col("decision_id").alias("id")).agg(F.min("reason").alias("r"), F.min("method").alias("m"))
    body = F.concat(F.lit('["'), F.translate(F.coalesce("r", F.lit("")), '"\\', ""), F.lit('", 1,]'))
    wrapped = F.when(F.length("r") % 2 == 0, F.concat(F.lit("Here is the result:\n```json\n"), body, F.lit("\n```\nDone."))).otherwise(F.concat(F.lit("Answer: "), body))
    part = C.json_part(wrapped)
    return one.select("id", part.alias("part"), F.json_array_length(part).alias("items"))


@R.query(
    rf"""WITH {_PAGES}, l AS (SELECT id, string_split(raw, chr(10)) AS a FROM e), s AS (SELECT id, a, list_position(list_transform(a, lambda s: regexp_matches(lower(s), 'phd|ph\.d|doctorate|master|bachelor')), true) AS k FROM l),
    r AS (SELECT id, CASE WHEN k > 0 THEN a[k:] ELSE [] END AS r FROM s), t AS (SELECT id, r, list_position(list_transform(r, lambda s: {strip('s')} = ''), true) AS b FROM r)
    SELECT id, md5(array_to_string(CASE WHEN b > 0 THEN r[1:b - 1] ELSE r END, chr(10))) AS part_md5 FROM t""",
    "extracted_content",
)
def q103_keyword_sections(pages):
    """The part of each page that speaks of degrees."""
    return _pages(pages).select("id", F.md5(C.keyword_section(F.col("raw"), r"phd|ph\.d|doctorate|master|bachelor")).alias("part_md5"))


@R.query(
    rf"""WITH m AS (SELECT profile_id, min(profile_name) AS n, min(field) AS f, min(email) AS e, min(profile_url) AS u FROM collected_meta GROUP BY 1), x AS (SELECT id, max(raw_text) AS t FROM extracted_content GROUP BY 1),
    j AS (SELECT m.*, t FROM m LEFT JOIN x ON m.profile_id = x.id), c AS (SELECT profile_id, u, array_to_string(list_filter([CASE WHEN {spaced("coalesce(n, '')")} <> '' THEN 'Name: ' || {spaced('n')} END, CASE WHEN {spaced("coalesce(f, '')")} <> '' THEN 'Department: ' || {spaced('f')} END,
      CASE WHEN {spaced("coalesce(e, '')")} <> '' THEN 'Email: ' || {spaced('e')} END, CASE WHEN {spaced("coalesce(u, '')")} <> '' THEN 'Official profile URL: ' || {spaced('u')} END, CASE WHEN {spaced("coalesce(t, '')")} <> '' THEN 'Profile excerpt: ' || {spaced(f"rtrim(substr({spaced('t')}, 1, 420))")} END], lambda z: z IS NOT NULL), chr(10)) AS c FROM j)
    SELECT profile_id, md5(c) AS facts_md5 FROM c WHERE coalesce(u, '') <> '' AND length(c) >= 40""",
    "collected_meta",
    "extracted_content",
)
def q104_fact_chunks(meta, pages):
    """A chunk of plain facts of each profile, for those that give no other."""
    m = meta.groupBy("profile_id").agg(*[F.min(c).alias(a) for c, a in (("profile_name", "n"), ("field", "f"), ("email", "e"), ("profile_url", "u"))])
    x = pages.groupBy(F.col("id").alias("profile_id")).agg(F.max("raw_text").alias("t"))
    made = C.fact_text(F.col("n"), F.lit(None).cast("string"), F.col("f"), F.col("e"), F.col("u"), F.col("t"))
    return m.join(x, "profile_id", "left").select("profile_id", F.md5(made).alias("facts_md5")).where("facts_md5 is not null")


@R.query(
    """WITH h AS (SELECT DISTINCT unnest(raw_headings) AS h FROM extracted_content) SELECT h AS heading, CASE WHEN regexp_matches(lower(h), 'education|degree|university|school|academic') THEN 'education' WHEN regexp_matches(lower(h), 'experience|employment|work|position|career|appointment') THEN 'experience'
    WHEN regexp_matches(lower(h), 'publication|paper|article|journal|conference') THEN 'publications' WHEN regexp_matches(lower(h), 'research|interest|expertise|area') THEN 'research' WHEN regexp_matches(lower(h), 'award|honor|recognition|achievement') THEN 'awards' WHEN regexp_matches(lower(h), 'contact|email|phone|address') THEN 'contact'
    WHEN regexp_matches(lower(h), 'bio|biography|about|profile|background') THEN 'biography' WHEN regexp_matches(lower(h), 'skill|competence|ability') THEN 'skills' WHEN regexp_matches(lower(h), 'project') THEN 'projects' ELSE 'other' END AS kind FROM h WHERE h IS NOT NULL""",
    "extracted_content",
)
def q105_section_types(pages):
    return pages.select(F.explode("raw_headings").alias("heading")).where("heading is not null").distinct().select("heading", C.section_type(F.col("heading")).alias("kind"))
