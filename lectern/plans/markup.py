"""Queries on markup made from records, and on repairs of articles."""

from __future__ import annotations

from pyspark.sql import functions as F

from lectern.functions import html as H
from lectern.operators import articles as A
from lectern.operators import chunking
from lectern.plans._base import Registry
from lectern.plans.articles import _ART, _PARAS, _articles
from lectern.plans.cleaning import spaced, strip

R = Registry()

_ROWS = rf"""e AS (SELECT id, max(raw_text) AS t, min(profile_name) AS n FROM extracted_content WHERE id IS NOT NULL AND raw_text IS NOT NULL GROUP BY 1),
    l AS (SELECT id, coalesce(n, '') AS n, list_transform(string_split(replace(replace(t, '<', ' '), '&', ' '), chr(10)), lambda s: {spaced(strip('s'))}) AS l FROM e), k AS (SELECT id, n, list_filter(l, lambda s: s <> '') AS l FROM l)"""


def _pages(pages):
    """Records as pages: a menu, a script, a heading, their lines as paragraphs, a footer."""
    e = pages.where("id is not null and raw_text is not null").groupBy("id").agg(F.max("raw_text").alias("t"), F.coalesce(F.min("profile_name"), F.lit("")).alias("n"))
    body = F.array_join(F.transform(F.split(F.translate("t", "<&", "  "), "\n"), lambda s: F.concat(F.lit("<p class=x>"), s, F.lit("</p>"))), "\n")
    html = F.concat(
        F.lit("<html><head><title>Page - Site</title><script>var a = '<p>no</p>';</script></head><body><nav><ul><li>Home</li></ul></nav><!-- <p>no</p> --><main><h1>Menu</h1><h2>"), F.translate("n", "<&", "  "), F.lit("</h2><div class='a department b'>Dept &amp; Co</div><span class=\"rank\">Reader</span>"), body,
        F.lit("</main><footer><p>a@b.example</p></footer></body></html>"),
    )
    return e.select("id", html.alias("html"))


@R.query(
    rf"""WITH {_ROWS}, m AS (SELECT id, list_concat(list_filter(['Menu', {spaced("replace(replace(n, '<', ' '), '&', ' ')")}, 'Dept & Co'], lambda s: s <> ''), CASE WHEN len(l) > 0 THEN list_concat(['Reader'], l) ELSE ['Reader'] END) AS m FROM k)
    SELECT id, md5(array_to_string(m, chr(10))) AS text_md5 FROM m""",
    "extracted_content",
)
def q176_main_of_markup(pages):
    """The text of the main part of each page, without menus, scripts, comments and footers."""
    return _pages(pages).select("id", F.md5(H.main_text(F.col("html"))).alias("text_md5"))


@R.query(
    rf"""WITH {_ROWS}, n AS (SELECT id, {spaced("replace(replace(n, '<', ' '), '&', ' ')")} AS n, l FROM k), f AS (SELECT id, n, regexp_extract(array_to_string(list_append(l, 'a@b.example'), chr(10)), '[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{{2,}}') AS m FROM n)
    SELECT id, CASE WHEN length(n) BETWEEN 3 AND 119 AND NOT regexp_matches(lower(n), 'university|college|school of|menu|navigation') THEN n ELSE 'Page' END AS name, 'Reader' AS position, 'Dept & Co' AS department, CASE WHEN n = '' OR lower(n) = 'menu' THEN 'Menu' ELSE 'Menu|' || n END AS headings FROM f""",
    "extracted_content",
)
def q177_profile_fields(pages):
    """Name, position, department and headings of each page."""
    f = H.profile_fields(F.col("html"))
    return _pages(pages).select("id", f["name"].alias("name"), f["position"].alias("position"), f["department"].alias("department"), F.array_join(H.headings(F.col("html")), "|").alias("headings"))


@R.query(
    rf"""WITH e AS (SELECT id, {strip('max(raw_text)')} AS t FROM extracted_content WHERE id IS NOT NULL AND raw_text IS NOT NULL GROUP BY 1) SELECT id, t = '' OR regexp_matches(lower(t), 'access to this page has been denied|verify you are human|captcha|cloudflare|attention required|press\s*&\s*hold|press and hold|confirm you are a human|checking your browser|proof of work|security check|not a bot')
      OR regexp_matches(lower(t), '\breference id\b[:\s-]*[a-z0-9-]{{6,}}') OR len(regexp_extract_all(lower(t), '\bpage\s+[0-9]+\s+of\s+[0-9]+\b')) >= 6 OR (len(regexp_extract_all(t, '[0-9]')) >= 80 AND len(regexp_extract_all(t, '\p{{L}}')) <= len(regexp_extract_all(t, '[0-9]'))) AS noise FROM e""",
    "extracted_content",
)
def q178_noise_segments(pages):
    return pages.where("id is not null and raw_text is not null").groupBy("id").agg(F.max("raw_text").alias("t")).select("id", chunking.noise_segment(F.col("t")).alias("noise"))


_W4 = r"list_distinct(list_filter(regexp_extract_all(lower({0}), '[\p{{L}}\p{{N}}_]+'), lambda w: length(w) >= 4))"


@R.query(
    rf"""WITH {_ART}, {_PARAS}, p AS (SELECT doc_id, n, {_W4.format(r"regexp_replace(p, '\[chunk:([^\]\s]+)\]', ' ', 'g')")} AS w, list_distinct(regexp_extract_all(p, '\[chunk:([^\]\s]+)\]', 1)) AS ids FROM r),
    k AS (SELECT CAST(doc_id AS VARCHAR) AS c, {_W4.format('text')} AS v FROM documents WHERE text IS NOT NULL), u AS (SELECT DISTINCT doc_id, c FROM (SELECT doc_id, unnest(ids) AS c FROM p)), pool AS (SELECT u.doc_id, u.c, v FROM u JOIN k ON u.c = k.c),
    o AS (SELECT doc_id, n, w, unnest(ids) AS was FROM p), h AS (SELECT o.doc_id, n, w, was, coalesce(len(list_intersect(w, v)), 0) AS had FROM o LEFT JOIN pool ON o.doc_id = pool.doc_id AND o.was = pool.c),
    s AS (SELECT h.doc_id, n, was, c, len(list_intersect(w, v)) AS hits FROM h JOIN pool ON h.doc_id = pool.doc_id WHERE had < 3 AND c <> was AND len(list_intersect(w, v)) >= 3 AND len(list_intersect(w, v)) > had)
    SELECT doc_id, CAST(n AS INTEGER) AS n, was, arg_min(c, struct_pack(h := -hits, c := c)) AS now FROM s GROUP BY 1, 2, 3""",
    "documents",
    "collected_meta",
)
def q179_stronger_citations(docs, meta):
    """Weak citations of each article with the stronger one that it may have instead."""
    return A.stronger_citations(_articles(docs, meta), docs, "doc_id", "body", "doc_id", "text")
