"""Queries on links: what to skip, follow, trust and keep. Real addresses together with stated ones of known hosts."""

from __future__ import annotations

from pyspark.sql import functions as F

from lectern.functions import links as L
from lectern.functions import urls as U
from lectern.plans._base import Registry
from lectern.sources import read_table

R = Registry()

#: Stated links: address, anchor text, title, person.
SAMPLES = [
    ("https://scholar.google.com/citations?user=AbC", "Google Scholar", "", "Ann Lee"),
    ("https://www.researchgate.net/profile/Ann-Lee", "research profile", "", "Ann Lee"),
    ("https://orcid.org/0000-0001-2345-6789", "", "", "Ann Lee"),
    ("https://www.linkedin.com/in/ann-lee", "LinkedIn", "", "Ann Lee"),
    ("https://www.semanticscholar.org/author/1", "", "", "Ann Lee"),
    ("https://pubmed.ncbi.nlm.nih.gov/123/", "", "", "Ann Lee"),
    ("https://arxiv.org/abs/2001.00001", "preprint", "", "Ann Lee"),
    ("https://www.nsf.gov/awardsearch/", "", "", "Ann Lee"),
    ("https://reporter.nih.gov/project-details/1", "", "", "Ann Lee"),
    ("https://experts.uni.example.edu/display/lee", "", "", "Ann Lee"),
    ("https://news.uni.example.edu/2020/lakes", "", "", "Ann Lee"),
    ("https://physics.uni.example.edu/people/lee", "Ann Lee", "", "Ann Lee"),
    ("https://uni.example.edu/visit", "", "", "Ann Lee"),
    ("https://www.ratemyprofessors.com/professor/1", "", "", "Ann Lee"),
    ("https://files.example.org/lee/cv.pdf", "Curriculum Vitae", "CV", "Ann Lee"),
    ("https://files.example.org/course/cv-program.pdf", "programme", "", "Ann Lee"),
    ("https://link.springer.com/chapter/1", "", "", "Ann Lee"),
    ("https://annlee.github.io/", "my website", "", "Ann Lee"),
    ("https://elsewhere.example.net/group", "lab page", "", "Bo Ray"),
    ("https://x.com/annlee", "", "", "Ann Lee"),
    ("https://unix.com/manual", "", "", "Ann Lee"),
    ("https://www.google.com/search?q=ann", "", "", "Ann Lee"),
    ("https://help.pinterest.com/a", "", "", "Ann Lee"),
    ("https://cdn.example.com/a.js", "", "", "Ann Lee"),
    ("https://example.com/slides.pptx", "", "", "Ann Lee"),
    ("https://example.com/search?q=lee", "search", "", "Ann Lee"),
    ("https://example.com/our-team/", "view all", "", "Ann Lee"),
    ("https://example.com/teamwork", "", "", "Ann Lee"),
    ("https://www.congress.gov/hearing", "", "", "Ann Lee"),
    ("https://www.nytimes.com/2020/a", "", "", "Ann Lee"),
    ("https://www.academia.edu/1", "", "", "Ann Lee"),
    ("http://localhost/a", "", "", "Ann Lee"),
    ("http://127.0.0.1/a", "", "", "Ann Lee"),
    ("ftp://example.com/a", "", "", "Ann Lee"),
    ("mailto:ann@uni.example.edu", "mail", "", "Ann Lee"),
    ("HTTPS://Example.COM/Path/?utm_source=x#top", "", "", "Ann Lee"),
    ("https://example.com", "", "", "Ann Lee"),
    ("https://example.com/" + "a" * 700, "", "", "Ann Lee"),
]
_COLUMNS = "url string, text string, title string, name string"
_VALUES = ", ".join("(" + ", ".join(f"'{v}'" for v in row) + ")" for row in SAMPLES)
_LINKS = f"""l AS (SELECT DISTINCT url, '' AS text, '' AS title, coalesce(profile_context['profile_name'], '') AS name FROM source_record WHERE url IS NOT NULL UNION SELECT * FROM (VALUES {_VALUES}) v(url, text, title, name)),
    h AS (SELECT *, lower(url) AS u, lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)', 1)) AS net, regexp_replace(lower(regexp_extract(trim(url), '^(?:[A-Za-z][A-Za-z0-9+.-]*://)?([^/?#]*)', 1)), ':[0-9]+$', '') AS h0,
      lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)', 1)) AS path FROM l),
    k AS (SELECT *, regexp_replace(h0, '^www\\.', '') AS host FROM h)"""


def _links(spark, d):
    real = read_table(spark, d, "source_record").where("url is not null")
    name = F.coalesce(F.try_element_at("profile_context", F.lit("profile_name")), F.lit(""))
    return real.select("url", F.lit("").alias("text"), F.lit("").alias("title"), name.alias("name")).unionByName(spark.createDataFrame(SAMPLES, _COLUMNS)).distinct()


def _q(items) -> str:
    return "[" + ", ".join("'" + i.replace("'", "''") + "'" for i in items) + "]"


def has(col: str, items) -> str:
    return f"(len(list_filter({_q(items)}, lambda i: contains({col}, i))) > 0)"


def under(col: str, items) -> str:
    return f"(len(list_filter({_q(items)}, lambda i: {col} = i OR ends_with({col}, '.' || i))) > 0)"


_OWN = f"(net <> '' AND NOT {has('u', L.SCRAPE_BLOCKED)} AND ({has('lower(text)', L.OWN_SITE_WORDS)} OR {has('lower(title)', L.OWN_SITE_WORDS)} OR {has('net', L.OWN_SITE_HOSTS)} OR (net <> 'uni.example.edu' AND {has('lower(text)', ['website', 'page', 'portfolio', 'lab', 'group'])})))"


@R.query(
    rf"""WITH {_LINKS}
    SELECT url, text, title, name, NOT (starts_with(url, 'http://') OR starts_with(url, 'https://')) OR host = '' OR host IN (SELECT unnest({_q(L.SKIP_HOSTS)})) OR ({under('host', U.NOISE_HOSTS)} AND NOT {under('host', L.NOISE_ALLOWED)}) OR {under('host', L.SKIP_SUFFIXES)} OR length(url) > 600 AS skip,
      {has('CASE WHEN net = \'\' THEN h0 ELSE net END', L.CRAWL_SKIP)} OR len(list_filter({_q(L.CRAWL_SKIP_ENDS)}, lambda i: ends_with(path, i))) > 0 AS crawl_skip,
      len(list_filter({_q(L.LISTING)}, lambda i: list_contains(regexp_extract_all(u, '[a-z0-9]+'), i))) > 0 AS listing,
      len(list_filter(['.pdf', '.doc', '.docx'], lambda i: ends_with(u, i))) > 0 OR {has('u', ['/cv/', '/resume', '/vita'])} AS document,
      (starts_with(trim(url), 'http://') OR starts_with(trim(url), 'https://')) AND net <> '' AND net NOT IN ('localhost', '127.0.0.1') AS external,
      {has('u', L.SCRAPE_BLOCKED)} AS blocked, NOT {has('u', L.NOT_CV)} AND ({has("lower(text || ' ' || title)", L.CV_WORDS)} OR {has('u', L.CV_WORDS)}) AS cv, {_OWN} AS own_site FROM k"""
)
def q75_link_flags(spark, d):
    """Of each link whether to skip it, and what it leads to."""
    url, text, title = F.col("url"), F.col("text"), F.col("title")
    return _links(spark, d).select(
        "url", "text", "title", "name",
        L.should_skip(url).alias("skip"), L.crawl_skip(url).alias("crawl_skip"), L.generic_listing(url).alias("listing"), L.document_like(url).alias("document"), L.external(url).alias("external"),
        L.scrape_blocked(url).alias("blocked"), L.cv_link(url, text, title).alias("cv"), L.own_site(url, text, title, F.lit("uni.example.edu")).alias("own_site"),
    )


_SCORE = f"CASE WHEN host = '' THEN 0 WHEN {under('host', L.BLOCKED)} THEN -3 WHEN ends_with(host, '.gov') OR ends_with(host, '.edu') THEN 3 WHEN {has('host', L.TRUSTED)} THEN 2 WHEN {has('host', ['researchgate.net', 'academia.edu'])} THEN -1 ELSE 0 END"
_QUALITY = f"CASE WHEN host = '' THEN 0 WHEN {under('host', L.LOW_VALUE)} THEN -2 WHEN ends_with(host, '.gov') OR ends_with(host, '.edu') THEN 2 WHEN {has('host', L.HIGH_VALUE)} THEN 1 ELSE 0 END"
_RANK = f"CASE WHEN host = '' THEN 999 WHEN {under('host', ['uni.example.edu', *L.PRIORITY])} THEN list_position(list_transform({_q(['uni.example.edu', *L.PRIORITY])}, lambda i: host = i OR ends_with(host, '.' || i)), true) - 1 WHEN ends_with(host, '.edu') THEN 50 WHEN ends_with(host, '.gov') THEN 60 WHEN ends_with(host, '.org') THEN 70 ELSE 100 END"


@R.query(
    rf"""WITH {_LINKS}
    SELECT url, text, title, name, {_QUALITY} AS quality, {_SCORE} AS score, CAST({_RANK} AS INTEGER) AS rank,
      CASE WHEN host = 'physics.uni.example.edu' OR ends_with(host, '.physics.uni.example.edu') THEN 0 WHEN host = 'uni.example.edu' OR ends_with(host, '.uni.example.edu') THEN 1
        WHEN len(list_filter(['.pdf', '.doc', '.docx'], lambda i: ends_with(u, i))) > 0 OR {has('u', ['/cv/', 'curriculum-vitae', 'resume'])} THEN 2 WHEN ends_with(host, '.edu') THEN 3 WHEN ends_with(host, '.gov') THEN 4
        WHEN {under('host', ['orcid.org'])} THEN 5 WHEN {under('host', ['scholar.google.com'])} THEN 25 ELSE 50 END AS home_rank,
      CASE WHEN {has('net', ['uni.example.edu', *L.HOP_HOSTS])} THEN 3 ELSE 0 END + CASE WHEN {has('path', L.HOP_PATHS)} THEN 4 ELSE 0 END + CASE WHEN ends_with(path, '.pdf') THEN 5 ELSE 0 END
        + CASE WHEN len(list_filter(string_split(lower(name), ' '), lambda w: length(w) > 2 AND contains(u, w))) > 0 THEN 3 ELSE 0 END
        + CASE WHEN text <> '' AND contains(lower(text), lower(string_split(name, ' ')[-1])) THEN 2 ELSE 0 END + CASE WHEN {has('lower(text)', L.HOP_WORDS)} THEN 2 ELSE 0 END + CASE WHEN length(path) > 10 THEN 1 ELSE 0 END AS hop FROM k"""
)
def q76_link_scores(spark, d):
    """Of each link how much its host is trusted, how near it is, and how much it promises."""
    url = F.col("url")
    host = U.host(url)
    last = F.element_at(F.split("name", " "), -1)
    return _links(spark, d).select(
        "url", "text", "title", "name", L.domain_quality(host).alias("quality"), L.source_score(host).alias("score"), L.priority(url, ["uni.example.edu"]).alias("rank"),
        L.home_priority(url, F.lit("physics.uni.example.edu"), F.lit("uni.example.edu")).alias("home_rank"), L.hop_score(url, F.col("text"), F.col("name"), last, ["uni.example.edu"]).alias("hop"),
    )


_PORTAL = has("u", L.PORTALS)


@R.query(
    rf"""WITH {_LINKS}, t AS (SELECT *, lower(text) AS t FROM k)
    SELECT url, text, title, name, CASE WHEN trim(url) = '' THEN 'none' WHEN regexp_matches(u, '\.(pdf|docx?|txt|rtf|odt)([?#]|$)') THEN 'document'
      WHEN {has('u', L.PAPER_PATHS)} OR {has('t', L.PAPER_WORDS)} OR ({_PORTAL} AND NOT {has('u', ['/user/', '/profile/', '/author/'])}) THEN 'research_publication' WHEN {has('u', L.BROWSE_PATHS)} OR {has('t', L.BROWSE_WORDS)} THEN 'browse_page' WHEN {_PORTAL} THEN 'research_portal'
      WHEN net <> '' AND net <> 'uni.example.edu' THEN 'personal_website' WHEN {has('u', ['twitter.com', 'x.com', 'linkedin.com', 'facebook.com', 'instagram.com'])} THEN 'social_media' WHEN net = 'uni.example.edu' THEN 'internal_page' WHEN starts_with(u, 'mailto:') THEN 'email' ELSE 'other' END AS category,
      CASE WHEN contains(net, 'scholar.google') THEN 'scholar_index_profile' WHEN contains(net, 'researchgate.net') THEN 'researchgate_profile' WHEN contains(net, 'orcid.org') THEN 'orcid_profile' WHEN contains(net, 'linkedin.com') THEN 'linkedin_profile'
      WHEN contains(net, 'semanticscholar.org') THEN 'semantic_scholar_profile' WHEN contains(net, 'pubmed') OR contains(net, 'ncbi.nlm.nih.gov') THEN 'pubmed' WHEN contains(net, 'arxiv.org') THEN 'arxiv_paper' WHEN contains(net, 'nsf.gov') THEN 'nsf_grant' WHEN contains(net, 'nih.gov') THEN 'nih_grant'
      WHEN contains(net, 'experts.uni.example.edu') THEN 'home_experts_profile' WHEN contains(net, 'uni.example.edu') AND (contains(net, 'news') OR contains(path, 'news')) THEN 'home_news'
      WHEN contains(net, 'uni.example.edu') AND regexp_matches(path, '/(people|faculty|directory|find-a-doctor|staff)/') THEN 'home_faculty_page' WHEN contains(net, 'uni.example.edu') THEN 'home_page' WHEN contains(net, 'ratemyprofessors') THEN 'ratings' WHEN ends_with(path, '.pdf') THEN 'research_paper_pdf'
      WHEN {has('net', L.PUBLISHERS)} THEN 'journal_publication' WHEN {has('t', ['abstract', 'doi:', '10.', 'journal', 'et al'])} THEN 'academic_publication' WHEN {has('t', ['grant', 'award', 'nsf', 'nih', 'funding'])} THEN 'grant_info'
      WHEN {has('t', ['course', 'syllabus', 'credit hour'])} THEN 'teaching_info' WHEN {has('t', ['curriculum vitae', 'c.v.', 'resume'])} THEN 'cv_resume' ELSE 'web_page' END AS source_class FROM t"""
)
def q77_link_classes(spark, d):
    """Of each link its category for a page of one institution, and its class as a source."""
    return _links(spark, d).select("url", "text", "title", "name", L.category(F.col("url"), F.col("text"), F.lit("uni.example.edu")).alias("category"), L.source_class(F.col("url"), F.col("text"), "uni.example.edu", "experts.uni.example.edu").alias("source_class"))


@R.query(
    rf"""WITH {_LINKS}, s AS (SELECT name, url, {_SCORE} AS s FROM (SELECT DISTINCT name, url, host FROM k)), m AS (SELECT name, max(CASE WHEN s >= 1 THEN 1 ELSE 0 END) AS a, max(CASE WHEN s >= 0 THEN 1 ELSE 0 END) AS b FROM s GROUP BY 1),
    f AS (SELECT s.name, url, row_number() OVER (PARTITION BY s.name ORDER BY url) AS place FROM s JOIN m ON s.name = m.name WHERE s >= CASE WHEN a = 1 THEN 1 WHEN b = 1 THEN 0 ELSE -99 END)
    SELECT name, url, CAST(place AS INTEGER) AS place FROM f WHERE place <= 8"""
)
def q78_quality_filter(spark, d):
    """The best eight links of each person by trust in their hosts, with softer rules where none passes."""
    return L.quality_filter(_links(spark, d).select("name", "url").distinct(), "name", "url", "url").select("name", "url", "place")


@R.query(
    rf"""WITH {_LINKS} SELECT DISTINCT url, lower(regexp_extract(url, '^([A-Za-z][A-Za-z0-9+.-]*)://', 1)) || '://' || net || CASE WHEN regexp_replace(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)', 1), '/+$', '') = '' THEN '/'
      ELSE regexp_replace(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)', 1), '/+$', '') END AS page_key FROM k"""
)
def q79_page_keys(spark, d):
    """One key of each page, whatever its query and fragment."""
    return _links(spark, d).select("url", L.page_key(F.col("url")).alias("page_key")).distinct()


@R.query(
    f"""WITH s AS (SELECT profile_context['profile_id'] AS id, max(TRY_CAST(fetch_info['status'] AS INTEGER)) AS status FROM source_record GROUP BY 1), e AS (SELECT id, max(raw_text) AS t FROM extracted_content WHERE id IS NOT NULL GROUP BY 1)
    SELECT e.id, coalesce(s.status IN (401, 402, 403, 451), false) OR coalesce({has('lower(t)', L.PAYWALL)}, false) AS paywalled, coalesce({has('lower(t)', L.BOT_WALL)}, false) AS bot_wall FROM e LEFT JOIN s ON e.id = s.id""",
    "extracted_content",
    "source_record",
)
def q80_walls(pages, sources):
    """Pages behind a paywall or a check for robots, by their text and the worst status of their fetches."""
    status = sources.groupBy(F.try_element_at("profile_context", F.lit("profile_id")).alias("id")).agg(F.max(F.try_element_at("fetch_info", F.lit("status")).try_cast("int")).alias("status"))
    flags = pages.where("id is not null").groupBy("id").agg(F.max("raw_text").alias("raw_text")).select("id", L.paywalled(F.col("raw_text"), F.lit(None).cast("int")).alias("by_text"), L.bot_wall(F.col("raw_text")).alias("bot_wall"))
    return flags.join(status, "id", "left").select("id", (F.col("by_text") | L.paywalled(F.lit(None).cast("string"), F.col("status"))).alias("paywalled"), "bot_wall")
