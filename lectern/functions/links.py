"""Predicates and classes of links: what to skip, follow, trust or keep. Lists are parameters or fixed values."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lectern.functions import urls as U

# Hosts and paths by what they are good for.
SKIP_SUFFIXES = "facebook.com twitter.com x.com instagram.com tiktok.com pinterest.com reddit.com quora.com linkedin.com amazon.com ebay.com walmart.com play.google.com apps.apple.com wikipedia.org".split()
SKIP_HOSTS = "www.google.com google.com duckduckgo.com www.duckduckgo.com www.bing.com bing.com".split()
NOISE_ALLOWED = "scholar.google.com semanticscholar.org".split()
CRAWL_SKIP = "facebook.com twitter.com x.com instagram.com tiktok.com pinterest.com reddit.com amazon.com ebay.com walmart.com login. signin. accounts. play.google.com apps.apple.com fonts.googleapis.com cdn. static. google.com/recaptcha linkedin.com".split()
CRAWL_SKIP_ENDS = ".doc .docx .ppt .pptx .zip .gz .tar .mp4 .mp3 .wav .jpg .png .gif .svg .exe".split()
PRIORITY = "orcid.org scholar.google.com semanticscholar.org openalex.org researchgate.net arxiv.org biorxiv.org medrxiv.org pubmed.ncbi.nlm.nih.gov ncbi.nlm.nih.gov pmc.ncbi.nlm.nih.gov nsf.gov nih.gov usaspending.gov ieee.org acm.org springer.com sciencedirect.com wiley.com nature.com plos.org frontiersin.org mdpi.com tandfonline.com sagepub.com jstor.org cambridge.org oup.com academic.oup.com patents.google.com uspto.gov".split()
#: How many of :data:`PRIORITY` hold profiles, citations and preprints.
AUTHORITIES = 12
TRUSTED = ".gov .edu nber.org aeaweb.org doi.org jstor.org sciencedirect.com nature.com science.org cambridge.org academic.oup.com wiley.com springer.com".split()
BLOCKED = "reddit.com x.com twitter.com facebook.com instagram.com linkedin.com tiktok.com pinterest.com".split()
LOW_VALUE = "reddit.com x.com twitter.com facebook.com instagram.com linkedin.com tiktok.com pinterest.com".split()
HIGH_VALUE = ".gov .edu nber.org aeaweb.org academic.oup.com wiley.com springer.com cambridge.org jstor.org sciencedirect.com nature.com science.org npr.org nytimes.com theguardian.com".split()
SCRAPE_BLOCKED = "facebook.com twitter.com x.com linkedin.com instagram.com youtube.com google.com/search scholar.google researchgate.net orcid.org ieee.org acm.org springer.com elsevier.com jstor.org".split()
PORTALS = "scholar.google.com researchgate.net pubmed.ncbi.nlm.nih.gov arxiv.org ieee.org acm.org springer.com sciencedirect.com nature.com science.org plos.org biorxiv.org medrxiv.org dblp.org dblp.uni-trier.de academia.edu orcid.org publons.com scopus.com webofscience.com jstor.org".split()
PAPER_PATHS = "/article/ /paper/ /publication/ /pub/ /doi/ /abs/ /pdf/ /eprint/ arxiv.org/abs/ pubmed.ncbi.nlm.nih.gov/ doi.org/ dx.doi.org/".split()
PAPER_WORDS = "paper|publication|article|research|study|journal|conference|proceedings|abstract|doi:|doi |arxiv:|pubmed:|citation".split("|")
BROWSE_PATHS = "/browse /search /results /listing /list /directory /profiles? /people? /faculty? /staff? ?search= ?q= ?query= ?keyword= ?filter= ?category= ?tag= /tag/ /category/".split()
BROWSE_WORDS = "browse|search|results|listing|directory|view all|see all|more|all profiles|all people|all faculty|all staff|find more|show more".split("|")
HOP_HOSTS = "scholar.google.com researchgate.net pubmed.ncbi.nlm.nih.gov ncbi.nlm.nih.gov arxiv.org orcid.org semanticscholar.org acm.org ieee.org springer.com sciencedirect.com wiley.com nature.com plos.org mdpi.com frontiersin.org biorxiv.org medrxiv.org tandfonline.com sagepub.com oup.com cell.com acs.org nsf.gov nih.gov".split()
HOP_PATHS = "/publication /article /paper /abstract /doi/ /abs/ /full/ /pdf /people/ /faculty/ /profile /project /lab /research /grant /award /cv /vita /resume /record/ /works/".split()
HOP_WORDS = "publication|paper|article|research|lab|project|cv|vita|resume|grant|profile|scholar|full text|pdf|doi|abstract|proceedings".split("|")
PUBLISHERS = "springer.com wiley.com nature.com sciencedirect.com ieee.org acm.org plos.org mdpi.com frontiersin.org biorxiv.org medrxiv.org tandfonline.com sagepub.com oup.com cell.com acs.org".split()
LISTING = "team our index directory directories faculty staff people profiles profile former emeritus news".split()
PAYWALL = "subscribe|subscription|sign in to continue|paywall|purchase access".split("|")
BOT_WALL = "access to this page has been denied|verify you are human|captcha|cloudflare|attention required|access denied|proof of work|anubis|jshelter|press & hold|press and hold|confirm you are a human|checking your browser|security check|not a bot|making sure you're not a bot".split("|")
CV_WORDS = "cv|curriculum vitae|curriculum-vitae|vitae|resume|résumé".split("|")
NOT_CV = "curriculum-program course program degree syllabus handbook catalog".split()
OWN_SITE_WORDS = "personal website|personal page|homepage|home page|my website|my site|webpage".split("|")
OWN_SITE_HOSTS = "github.io netlify.app vercel.app people. users. personal. faculty.".split()


def any_of(text: Column, parts: Sequence[str]) -> Column:
    """Whether a text holds any of ``parts``, by one expression."""
    return text.rlike("|".join(re.escape(p) for p in parts))


def under(host: Column, domains: Sequence[str]) -> Column:
    """Whether a host is one of ``domains`` or below one."""
    return host.rlike(r"(?:^|\.)(?:" + "|".join(re.escape(d) for d in domains) + ")$")


def page_key(url: Column) -> Column:
    """One form of a page's address: no query or fragment, host in lower case, no slash at the end."""
    path = F.regexp_replace(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)", 1), "/+$", "")
    return F.concat(F.lower(F.regexp_extract(url, r"^([A-Za-z][A-Za-z0-9+.-]*)://", 1)), F.lit("://"), F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1)), F.when(path == "", "/").otherwise(path))


def should_skip(url: Column, most: int = 600) -> Column:
    """Whether a link isn't worth fetching: no web address, search engines, noise (but for scholarly indexes), shops, or too long."""
    host = U.host(url)
    noise = under(host, U.NOISE_HOSTS) & ~under(host, NOISE_ALLOWED)
    return F.coalesce(~url.rlike("^https?://") | (host == "") | host.isin(SKIP_HOSTS) | noise | under(host, SKIP_SUFFIXES) | (F.length(url) > most), F.lit(True))


def crawl_skip(url: Column) -> Column:
    """Whether a crawler leaves a link out: hosts by part of their name, or a file that holds no page."""
    low = F.lower(url)
    path = F.regexp_extract(low, r"^[a-z][a-z0-9+.-]*://[^/?#]*([^?#]*)", 1)
    return F.coalesce(any_of(U.authority(url), CRAWL_SKIP) | path.rlike("(?:" + "|".join(re.escape(e) for e in CRAWL_SKIP_ENDS) + ")$"), F.lit(True))


def priority(url: Column, home: Sequence[str] = ()) -> Column:
    """Rank of a link: the place of its host in the list of hosts (``home`` first), else 50, 60, 70, 100 by its last label, 999 without host."""
    host = U.host(url)
    rank = F.when(host == "", 999)
    for n, d in enumerate([*home, *PRIORITY]):
        rank = rank.when(under(host, [d]), n)
    return rank.when(host.endswith(".edu"), 50).when(host.endswith(".gov"), 60).when(host.endswith(".org"), 70).otherwise(100)


def home_priority(url: Column, source_host: Column, official_host: Column) -> Column:
    """Rank of a link by how close it is to where the profile stands; documents and academic hosts next, social ones last."""
    host, low = U.host(url), F.lower(url)
    below = lambda h: (h != "") & ((host == h) | host.endswith(F.concat(F.lit("."), h)))
    return (
        F.when(below(source_host), 0)
        .when(below(official_host), 1)
        .when(low.rlike(r"\.(?:pdf|docx?)$|/cv/|curriculum-vitae|resume"), 2)
        .when(host.endswith(".edu"), 3)
        .when(host.endswith(".gov"), 4)
        .when(under(host, ["orcid.org"]), 5)
        .when(under(host, ["scholar.google.com"]), 25)
        .otherwise(50)
    )


def paywalled(text: Column, status: Column) -> Column:
    """Whether a fetch met a paywall, by its status or the words of the page."""
    return F.coalesce(status.isin(401, 402, 403, 451), F.lit(False)) | F.coalesce(any_of(F.lower(text), PAYWALL), F.lit(False))


def bot_wall(text: Column) -> Column:
    """Whether a page only asks whether the reader is human."""
    return F.coalesce(any_of(F.lower(text), BOT_WALL), F.lit(False))


def domain_quality(host: Column) -> Column:
    """-2 for hosts of low value, 2 for public and academic ones, 1 for known publishers, else 0."""
    return F.when(F.coalesce(host, F.lit("")) == "", 0).when(under(host, LOW_VALUE), -2).when(host.rlike(r"\.(?:gov|edu)$"), 2).when(any_of(host, HIGH_VALUE), 1).otherwise(0)


def source_score(host: Column) -> Column:
    """-3 for blocked hosts, 3 for public and academic ones, 2 for trusted publishers, -1 for paper sharing, else 0."""
    return (
        F.when(F.coalesce(host, F.lit("")) == "", 0).when(under(host, BLOCKED), -3).when(host.rlike(r"\.(?:gov|edu)$"), 3).when(any_of(host, TRUSTED), 2).when(any_of(host, ["researchgate.net", "academia.edu"]), -1).otherwise(0)
    )


def quality_filter(links: DataFrame, key: str, url: str, order: str, least: int = 1, most: int = 8) -> DataFrame:
    """The links of each key that are good enough, at most ``most``: those of score ``least``, without any those not below 0, else all.

    What a key has is told by aggregates; the cut by order within key is a window that
    Spark limits before the shuffle.
    """
    scored = links.withColumn("_s", source_score(U.host(F.col(url))))
    have = scored.groupBy(key).agg(F.max((F.col("_s") >= least).cast("int")).alias("_strict"), F.max((F.col("_s") >= 0).cast("int")).alias("_soft"))
    floor = F.when(F.col("_strict") == 1, least).when(F.col("_soft") == 1, 0).otherwise(-99)
    kept = scored.join(have, key).where(F.col("_s") >= floor)
    return kept.withColumn("place", F.row_number().over(Window.partitionBy(key).orderBy(order, url))).where(F.col("place") <= most).drop("_s", "_strict", "_soft")


def document_like(url: Column) -> Column:
    return F.coalesce(F.lower(url).rlike(r"\.(?:pdf|docx?)$|/cv/|/resume|/vita"), F.lit(False))


def generic_listing(url: Column) -> Column:
    """Whether an address speaks of a listing: any of its words is one of lists of people or news."""
    return F.coalesce(F.lower(url).rlike(r"(?:^|[^a-z0-9])(?:" + "|".join(LISTING) + r")(?:[^a-z0-9]|$)"), F.lit(False))


def category(url: Column, link_text: Column, base: Column) -> Column:
    """What a link leads to, by the first rule that fits: document, publication, browse page, portal, own site, social, internal, email, other."""
    u, t = F.lower(url), F.coalesce(F.lower(link_text), F.lit(""))
    host = F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1))
    portal = any_of(u, PORTALS)
    paper = any_of(u, PAPER_PATHS) | any_of(t, PAPER_WORDS) | (portal & ~any_of(u, ["/user/", "/profile/", "/author/"]))
    base_told = F.coalesce(base, F.lit("")) != ""
    return (
        F.when(url.isNull() | (F.trim(url) == ""), "none")
        .when(u.rlike(r"\.(?:pdf|docx?|txt|rtf|odt)(?:[?#]|$)"), "document")
        .when(paper, "research_publication")
        .when(any_of(u, BROWSE_PATHS) | any_of(t, BROWSE_WORDS), "browse_page")
        .when(portal, "research_portal")
        .when(base_told & (host != F.lower(base)) & (host != ""), "personal_website")
        .when(any_of(u, ["twitter.com", "x.com", "linkedin.com", "facebook.com", "instagram.com"]), "social_media")
        .when(base_told & (host == F.lower(base)), "internal_page")
        .when(u.startswith("mailto:"), "email")
        .otherwise("other")
    )


def source_class(url: Column, text: Column, home: str, experts: str) -> Column:
    """What a web source is: 21 labels by host, path, then the words of the page. ``home`` is the institution's domain, ``experts`` its directory."""
    host = F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1))
    path = F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)", 1))
    low = F.lower(F.substring(F.coalesce(text, F.lit("")), 1, 3000))
    at = lambda d: host.contains(d)
    return (
        F.when(at("scholar.google"), "scholar_index_profile")
        .when(at("researchgate.net"), "researchgate_profile")
        .when(at("orcid.org"), "orcid_profile")
        .when(at("linkedin.com"), "linkedin_profile")
        .when(at("semanticscholar.org"), "semantic_scholar_profile")
        .when(at("pubmed") | at("ncbi.nlm.nih.gov"), "pubmed")
        .when(at("arxiv.org"), "arxiv_paper")
        .when(at("nsf.gov"), "nsf_grant")
        .when(at("nih.gov"), "nih_grant")
        .when(at(experts), "home_experts_profile")
        .when(at(home) & (at("news") | path.contains("news")), "home_news")
        .when(at(home) & any_of(path, ["/people/", "/faculty/", "/directory/", "/find-a-doctor/", "/staff/"]), "home_faculty_page")
        .when(at(home), "home_page")
        .when(at("ratemyprofessors"), "ratings")
        .when(path.endswith(".pdf"), "research_paper_pdf")
        .when(any_of(host, PUBLISHERS), "journal_publication")
        .when(any_of(low, ["abstract", "doi:", "10.", "journal", "et al"]), "academic_publication")
        .when(any_of(low, ["grant", "award", "nsf", "nih", "funding"]), "grant_info")
        .when(any_of(low, ["course", "syllabus", "credit hour"]), "teaching_info")
        .when(any_of(low, ["curriculum vitae", "c.v.", "resume"]), "cv_resume")
        .otherwise("web_page")
    )


def scrape_blocked(url: Column) -> Column:
    return F.coalesce(any_of(F.lower(url), SCRAPE_BLOCKED), F.lit(False))


def cv_link(url: Column, text: Column, title: Column) -> Column:
    """Whether a link leads to a curriculum vitae, and not to one of studies."""
    u, blob = F.lower(url), F.lower(F.concat_ws(" ", text, title))
    return F.coalesce(~any_of(u, NOT_CV) & (any_of(blob, CV_WORDS) | any_of(u, CV_WORDS)), F.lit(False))


def own_site(url: Column, text: Column, title: Column, base: Column) -> Column:
    """Whether a link leads to a person's own site, by what it says and where it stands."""
    host, t, ti = U.authority(url), F.coalesce(F.lower(text), F.lit("")), F.coalesce(F.lower(title), F.lit(""))
    says = any_of(t, OWN_SITE_WORDS) | any_of(ti, OWN_SITE_WORDS)
    away = (host != F.lower(F.coalesce(base, F.lit("")))) & any_of(t, ["website", "page", "portfolio", "lab", "group"])
    return F.coalesce((host != "") & ~scrape_blocked(url) & (says | any_of(host, OWN_SITE_HOSTS) | away), F.lit(False))


def hop_score(url: Column, anchor: Column, name: Column, last: Column, home: Sequence[str] = ()) -> Column:
    """How likely a link holds content about a person: points for host, path, document, the name in link and anchor, words, and a real path."""
    host, path = F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1)), F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)", 1))
    a, u = F.coalesce(F.lower(anchor), F.lit("")), F.lower(url)
    named = F.exists(F.split(F.lower(name), " "), lambda w: (F.length(w) > 2) & u.contains(w))
    rules = [(any_of(host, [*home, *HOP_HOSTS]), 3), (any_of(path, HOP_PATHS), 4), (path.endswith(".pdf"), 5), (named, 3), ((a != "") & a.contains(F.lower(last)), 2), (any_of(a, HOP_WORDS), 2), (F.length(path) > 10, 1)]
    return sum((F.when(c, p).otherwise(0) for c, p in rules), F.lit(0))


def external(url: Column) -> Column:
    """Whether a link leads to a web host other than the machine itself."""
    host = F.lower(F.regexp_extract(F.trim(url), r"^https?://([^/?#]*)", 1))
    return F.coalesce((host != "") & ~host.isin("localhost", "127.0.0.1"), F.lit(False))


def page_links(pages: DataFrame, html: str, *keep: str) -> DataFrame:
    """(keep.., place, url, text, title) of each anchor of each page with a link that isn't empty, script or mail."""
    anchors = F.regexp_extract_all(F.col(html), F.lit(r"(?is)(<a\s[^>]*>.*?</a>)"), 1)
    rows = pages.where(F.col(html).isNotNull()).select(*keep, F.posexplode(anchors).alias("place", "a"))
    attr = lambda n: F.regexp_extract("a", rf"(?is)^<a\s(?:[^>]*\s)?{n}\s*=\s*[\"']([^\"']*)[\"']", 1)
    text = F.trim(F.regexp_replace(F.regexp_replace(F.regexp_extract("a", r"(?is)^<a\s[^>]*>(.*)</a>$", 1), r"<[^>]+>", " "), r"\s+", " "))
    found = rows.select(*keep, "place", attr("href").alias("url"), text.alias("text"), attr("title").alias("title"))
    return found.where(r"url <> '' and not url rlike '^(?i:javascript:|mailto:|#)'")
