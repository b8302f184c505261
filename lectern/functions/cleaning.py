"""Column expressions that clean texts line by line, and tell noise. All stay in the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from lectern.functions import links as L
from lectern.functions.persons import looks_like_id
from lectern.functions.text import distinct_by, let

# Headers of sections, and the names that some stand for.
HEADERS = "RESEARCH INTERESTS|RESEARCH EXPERIENCE|EDUCATION|AWARDS|HONORS|AWARDS AND HONORS|TEACHING EXPERIENCE|INDUSTRY EXPERIENCE|PUBLICATIONS|PUBLICATIONS AND PRESENTATIONS|JOURNALS|CONFERENCES|RESEARCH PROJECTS|TECHNICAL REPORTS|BOOKS|PROFESSIONAL ACTIVITIES|PROFESSIONAL ACTIVITES|EDITORIAL BOARD|LANGUAGES|BIO|BIOGRAPHY|ABOUT|EXPERIENCE|SKILLS|CONTACT".split("|")
SAME_HEADER = {"PUBLICATIONS AND PRESENTATIONS": "PUBLICATIONS", "AWARDS AND HONORS": "AWARDS", "PROFESSIONAL ACTIVITES": "PROFESSIONAL ACTIVITIES"}
# What noise lines say.
BOT = r"access to this page has been denied|verify you are human|captcha|cloudflare|attention required|press\s*&\s*hold|press and hold|confirm you are a human|checking your browser|proof of work|security check|not a bot"
REFERENCE = r"\breference id\b[:\s-]*[a-z0-9-]{6,}"
PAGE_OF = r"\bpage\s+[0-9]+\s+of\s+[0-9]+\b"
COMPACT_PAGE = r"^(?:\s*(?:page\s*)?[0-9]+\s*(?:of|/)\s*[0-9]+\s*)+$"
CONSENT_LINE = r"this\s+website\s+uses\s+cookies?|by\s+continuing\s+to\s+(?:browse|use)\s+(?:without|this\s+site)|storing\s+of\s+cookies|(?:first-party|third-party|strictly\s+necessary|performance|functional|targeting|advertising|marketing|manage|about|allow|block)\s+cookies|cookie\s+(?:consent|preferences|settings|policy\s+link)|close\s+cookie\s+notice|opens\s+in\s+(?:a\s+)?new\s+window|privacy\s+policy|terms\s+of\s+service|terms\s+and\s+conditions|gdpr|ccpa|data\s+protection|personal\s+data|data\s+collection|opt\s*-?\s*(?:in|out)|save\s+preferences|customize\s+(?:your\s+)?(?:cookie\s+)?preferences|always\s+active|dismiss|got\s+it"
NAVIGATION_LINE = r"^\s*(?:home|about|contact|menu|search|login|sign\s+in|sign\s+up)\s*$|breadcrumb|you\s+are\s+here|current\s+page|skip\s+to\s+(?:main\s+)?content|skip\s+navigation"
FOOTER_LINE = r"copyright\s+©?\s*[0-9]{4}|all\s+rights\s+reserved|follow\s+us\s+on|share\s+on|social\s+media|subscribe\s+to\s+our\s+newsletter|newsletter\s+signup"
ERROR_LINE = r"page\s+not\s+found|error\s+404|access\s+denied|forbidden|this\s+page\s+could\s+not\s+be\s+found|the\s+requested\s+page\s+does\s+not\s+exist"
AD_LINE = r"advertisement|sponsored\s+content|promoted|ad\s+by"
NAV_TERMS = r"\b(?:home|about|contact|search|menu|navigation|skip to content|privacy|terms|copyright|all rights reserved|sitemap|back to top|top of page|bottom of page|login|sign in|sign up|site map|site navigation|breadcrumb)\b"
MARKERS = r"===\s*(?:seed url|profile page|webpage|source)\s*===|cr[il]tical rules|output format|text segment to analyze|json output|return only valid json"
POLICY = r"\b(?:california(?:n)? residents?|ccpa|gdpr|privacy policy|terms of service|cookie(?:s)?|consent|personal information|data protection|tracking)\b"
RDF = r"\b(?:dbo|dbr|dbp|dbc|rdf|rdfs|owl|foaf|wikidata|schema|prov|dbt|gold|umbel-rc|dct)\b\s*:|\b(?:wikipedia-en|wiki-commons|wikidata)\b|special:filepath|oldid=[0-9]+|\b(?:xsd:date|xsd:integer)\b"
BLOB = r"[A-Za-z0-9+/]{50,}={0,2}"
HEX = r"\b[A-Fa-f0-9]{40,}\b"
COOKIE_WORDS = "cookie|cookies|cookie policy|cookie notice|cookie consent|strictly necessary cookies|performance cookies|functional cookies|targeting cookies|about cookies|cookie information|always active|cookies and related technologies".split("|")
ACTIVE_COOKIES = r"(?:strictly\s+necessary|performance|functional|targeting)\s+cookies\s*[-–]\s*always\s+active"
PHRASES = r"(?i)\b(?:last\s+updated|updated\s+on|published\s+on)\s*:?\s*[0-9]{1,2}[/-][0-9]{1,2}[/-][0-9]{2,4}\b|\b(?:page\s+[0-9]+\s+of\s+[0-9]+)\b|\b(?:showing\s+[0-9]+\s+to\s+[0-9]+\s+of\s+[0-9]+)\b|\b(?:results?\s+[0-9]+\s+to\s+[0-9]+)\b"
CHROME_TITLES = ["loading", "shopping basket", "shopping cart", "search", "menu", "home", "sign in", "log in", "subscribe"]
# Kinds of collected sources.
SOURCE_KINDS = {
    "publication": "semantic_scholar google_scholar openalex crossref opencitations arxiv biorxiv pmc_oa unpaywall core_api".split(),
    "grant": "nsf_grants nih_grants usaspending clinicaltrials patentsview".split(),
    "news": "google_news gdelt campus_news".split(),
    "web": "web_search github huggingface paperswithcode zenodo figshare osf altmetric".split(),
    "profile": "orcid wikidata wikipedia expertise".split(),
    "teaching": "rate_my_professor courses youtube_lectures youtube_transcripts".split(),
}


def strip(text: Column) -> Column:
    return F.regexp_replace(text, r"^[\s\x{A0}]+|[\s\x{A0}]+$", "")


def spaced(text: Column) -> Column:
    """Runs of white space as one blank, ends stripped."""
    return F.trim(F.regexp_replace(text, r"[\s\x{A0}]+", " "))


def lines(text: Column) -> Column:
    return F.transform(F.split(F.coalesce(text, F.lit("")), "\n"), strip)


def _digits(s: Column) -> Column:
    return F.length(s) - F.length(F.translate(s, "0123456789", ""))


def _letters(s: Column) -> Column:
    return F.regexp_count(s, F.lit(r"\p{L}"))


def noise_line(s: Column, digits: int = 12) -> Column:
    """Whether a line is empty, a bot wall, a reference, page counters, or mostly digits."""
    low = F.lower(s)
    pages = F.regexp_count(low, F.lit(PAGE_OF)) >= 2
    return (s == "") | low.rlike(BOT) | low.rlike(REFERENCE) | pages | low.rlike(COMPACT_PAGE) | ((_digits(s) >= digits) & (_letters(s) <= _digits(s)))


def plain_text(text: Column) -> Column:
    """Line breaks and blanks collapsed, tags and entities dropped, dashes plain."""
    t = F.regexp_replace(F.coalesce(text, F.lit("")), "\n+", "\n")
    t = F.regexp_replace(F.regexp_replace(t, r"[\t\r\f\x0B\x{A0}]+", " "), r"<[^>]+>", "")
    t = F.regexp_replace(F.regexp_replace(t, r"&[a-zA-Z]+;", ""), "[—–]", "-")
    return strip(F.regexp_replace(t, " +", " "))


def clean_section(text: Column) -> Column:
    """A section as one line: no bullets, slashes, marks of files, noise lines or repeated lines; dashes between blanks become colons."""
    t = F.regexp_replace(F.coalesce(text, F.lit("")), "[•·▪▫○●◘◙‣⁃∙⋅・◦■□]", "")
    t = F.regexp_replace(F.regexp_replace(t, "\t", " "), " [-—–] ", ": ")
    t = F.regexp_replace(F.regexp_replace(t, r"[\s\x{A0}]{2,}", " "), r"(?i)\[PDF\]|\(PDF\)", "")
    t = F.regexp_replace(t, r"[\\/]", " ")
    kept = F.filter(F.transform(F.split(t, "\n"), spaced), lambda s: ~noise_line(s))
    return spaced(F.array_join(distinct_by(kept, F.lower), " "))


def micro_split(text: Column, least: int = 50) -> Column:
    """Blocks of a section: at blank lines, bullets and numbers, else at sentence ends; those of more than ``least`` characters, else the whole."""
    t = F.coalesce(text, F.lit(""))
    tidy = lambda s: spaced(F.regexp_replace(s, r"[\\/]", " "))
    blocks = F.filter(F.transform(F.split(t, r"\n\s*\n|•|[0-9]+\.\s+"), strip), lambda s: F.length(s) > least)
    sentences = F.filter(F.transform(F.split(F.regexp_replace(t, r"\.\s+([A-Z])", "\x01$1"), "\x01"), lambda s: tidy(strip(s))), lambda s: F.length(s) > least)
    ended = F.transform(sentences, lambda s: F.when(s.endswith("."), s).otherwise(F.concat(s, F.lit("."))))
    found = F.when(F.size(blocks) >= 2, F.filter(F.transform(blocks, tidy), lambda s: s != "")).otherwise(ended)
    whole = tidy(t)
    return F.when(F.size(found) > 0, found).when(whole != "", F.array(whole)).otherwise(F.array().cast("array<string>"))


def unmarked(text: Column) -> Column:
    """Text without the marks of Markdown, tags and entities."""
    t = F.coalesce(text, F.lit(""))
    for pattern, by in ((r"\*\*([^*]+)\*\*", "$1"), (r"__([^_]+)__", "$1"), (r"\*([^*]+)\*", "$1"), (r"_([^_]+)_", "$1"), (r"#{1,6}\s+", ""), (r"\[([^\]]+)\]\([^)]+\)", "$1"), (r"`([^`]+)`", "$1"), (r"<[^>]+>", ""), (r"&[a-zA-Z]+;", "")):
        t = F.regexp_replace(t, pattern, by)
    return t


def clean_text(text: Column) -> Column:
    """The lines of a page that are no consent notice, navigation, footer, error or advertisement, without marks."""
    t = F.regexp_replace(F.regexp_replace(unmarked(text), "[ \t]+", " "), r"\n\s*\n", "\n\n")
    low = F.lower
    noise = lambda s: low(s).rlike(f"{CONSENT_LINE}|{NAVIGATION_LINE}|{FOOTER_LINE}|{ERROR_LINE}|{AD_LINE}")
    kept = F.filter(F.transform(F.split(t, "\n"), strip), lambda s: (F.length(s) >= 3) & ~noise(s))
    return strip(F.regexp_replace(F.regexp_replace(F.array_join(kept, "\n"), PHRASES, ""), "[ \t]+", " "))


def clean_document(text: Column) -> Column:
    """Like :func:`clean_text`, for texts of files: lines of a number alone and form feeds go too."""
    t = F.regexp_replace(clean_text(text), r"(?m)^[ \t]*[0-9]+[ \t]*$", "")
    return strip(F.regexp_replace(F.regexp_replace(t, "\f", "\n"), r"\n{3,}", "\n\n"))


def has_consent(text: Column) -> Column:
    """Whether a text speaks of cookies in two ways, or in the form of their categories."""
    low = F.lower(F.coalesce(text, F.lit("")))
    said = sum((low.contains(w).cast("int") for w in COOKIE_WORDS), F.lit(0))
    return (said >= 2) | low.rlike(ACTIVE_COOKIES)


def has_markup_noise(text: Column) -> Column:
    """Whether a text holds tags, styles, markers of files, instructions or long codes."""
    t, low = F.coalesce(text, F.lit("")), F.lower(F.coalesce(text, F.lit("")))
    return (
        t.rlike(r"<[^>]+>") | low.rlike(r"\b(?:style=|class=|id=|font-size|padding|margin|text-align)\b") | L.any_of(low, ["=== seed url", "=== profile page", "=== webpage", "top of page", "bottom of page", "back to top", "skip to content"])
        | L.any_of(low, ["critical rules", "output format", "text segment to analyze", "json output", "return only valid json"]) | t.rlike(BLOB) | low.rlike(HEX)
    )


def foreign(s: Column) -> Column:
    """Whether a quarter of the letters are beyond the Latin blocks."""
    latin = F.regexp_count(s, F.lit(r"[A-Za-zªµºÀ-ÖØ-öø-ɏ]"))
    letters = _letters(s)
    return (letters > 0) & ((letters - latin) / F.greatest(letters, F.lit(1)) >= 0.25)


def garbled(s: Column) -> Column:
    """Whether a line is mostly signs, or holds a long code."""
    signs = F.length(F.regexp_replace(s, r"[\p{L}\p{N}\p{M}_\s\x{A0}]", ""))
    return (s == "") | (signs > F.greatest(F.lit(10), F.floor(F.length(s) * 0.4))) | s.rlike(BLOB) | s.rlike(HEX)


def graph_noise(s: Column) -> Column:
    """Whether a line is a dump of a knowledge graph, or of names in many languages."""
    return F.lower(s).rlike(RDF) | (F.regexp_count(s, F.lit(r"\([a-z]{2,3}\)")) >= 3)


def clean_chunk(text: Column) -> Column:
    """A chunk as one line without the lines of markers, menus, policies, graphs, foreign scripts and codes."""
    low = F.lower
    drop = lambda s: low(s).rlike(MARKERS) | low(s).rlike(NAV_TERMS) | low(s).rlike(POLICY) | graph_noise(s) | foreign(s) | garbled(s) | (F.length(s) < 3)
    t = F.regexp_replace(F.coalesce(text, F.lit("")), r"(?i)</?(?:p|div|li|ul|ol|h[1-6]|br|hr|section|article|nav|header|footer|table|tr|td|th)(?:\s[^>]*)?/?>", "\n")
    kept = F.filter(lines(F.regexp_replace(F.regexp_replace(t, r"<[^>]+>", " "), "\r\n?", "\n")), lambda s: ~drop(s))
    return spaced(F.array_join(kept, " "))


def drop_chunk(text: Column, name: Column) -> Column:
    """Whether a chunk is noise, or short without the person's name."""
    raw, low = strip(F.coalesce(text, F.lit(""))), F.lower(strip(F.coalesce(text, F.lit(""))))
    n = F.lower(F.coalesce(name, F.lit("")))
    last = F.coalesce(F.try_element_at(F.filter(F.split(n, " "), lambda w: F.length(w) >= 3), F.lit(-1)), F.lit(""))
    names = (n == "") | low.contains(n) | ((last != "") & low.contains(last))
    short = F.size(F.filter(F.split(raw, r"[\s\x{A0}]+"), lambda w: w != "")) < 30
    return (raw == "") | raw.rlike("^===.*===$") | low.rlike(MARKERS) | low.rlike(NAV_TERMS) | low.rlike(POLICY) | low.rlike(RDF) | raw.rlike(BLOB) | raw.rlike(HEX) | foreign(raw) | (short & ~names)


def profile_lines(text: Column, name: Column) -> Column:
    """The lines of a page that may be about its person: no markers, walls, counters, menus, short or digit lines without the name; each once."""
    pages = lambda s: (F.regexp_count(F.lower(s), F.lit(PAGE_OF)) >= 2) | F.lower(s).rlike(COMPACT_PAGE)
    noise = lambda s: (s == "") | s.rlike("^===.*===$") | F.lower(s).rlike(f"{BOT}|{REFERENCE}|{NAV_TERMS}") | pages(s)
    thin = lambda s: ((_digits(s) >= 10) & (_letters(s) <= _digits(s))) | (F.size(F.split(s, r"[\s\x{A0}]+")) < 5)

    def about(w: Column) -> Column:
        named = lambda s: ((w["n"] != "") & F.lower(s).contains(w["n"])) | ((w["last"] != "") & F.lower(s).contains(w["last"]))
        return F.array_join(distinct_by(F.filter(lines(text), lambda s: ~noise(s) & (named(s) | ~thin(s))), lambda s: spaced(F.lower(s))), "\n")

    n = F.lower(F.trim(F.coalesce(name, F.lit(""))))
    last = F.coalesce(F.try_element_at(F.filter(F.split(n, " "), lambda w: F.length(w) >= 3), F.lit(-1)), F.lit(""))
    return let(F.struct(n.alias("n"), last.alias("last")), about)


def pruned(text: Column) -> Column:
    """Lines that are no noise, joined; counters in a row and runs of blanks dropped."""
    kept = F.filter(lines(text), lambda s: ~noise_line(s))
    t = F.regexp_replace(F.array_join(kept, "\n"), rf"(?i)(?:{PAGE_OF}[\s,;:]*){{2,}}", " ")
    return strip(F.regexp_replace(t, r"\s{2,}", " "))


def _without_site(title: Column) -> Column:
    out = title
    for sep in (" - ", " – ", " — ", " | "):
        head = strip(F.split_part(title, F.lit(sep), F.lit(1)))
        out = F.when(title.contains(sep) & (F.length(head) >= 5), head).otherwise(out)

    # a trail of short parts after colons
    def trail(x: Column) -> Column:
        rest = F.slice(x["p"], F.lit(2), F.greatest(F.size(x["p"]) - 1, F.lit(0)))
        average = F.aggregate(rest, F.lit(0), lambda a, s: a + F.length(s)) / F.greatest(F.size(rest), F.lit(1))
        first = F.try_element_at(x["p"], F.lit(1))
        return spaced(F.when((F.size(x["p"]) >= 3) & (F.length(first) >= 4) & (average <= 40), first).otherwise(x["t"]))

    return let(out, lambda t: let(F.struct(t.alias("t"), F.filter(F.transform(F.split(t, ":"), strip), lambda s: s != "").alias("p")), trail))


def page_title(link_text: Column, text: Column) -> Column:
    """The first of link text and three first lines that makes a title, without the site's name; "" if none does."""
    heads = F.slice(F.filter(lines(text), lambda s: (F.length(s) >= 6) & ~s.rlike(r"^[^\p{L}\p{N}]+$")), 1, 3)
    tries = F.transform(F.concat(F.array(strip(F.coalesce(link_text, F.lit("")))), heads), _without_site)
    good = F.filter(tries, lambda s: F.length(s).between(5, 200) & ~F.lower(s).isin(CHROME_TITLES) & ~F.replace(s, F.lit(" "), F.lit("")).rlike("^[A-Fa-f0-9-]{16,}$") & ~s.rlike("^[0-9]{1,8}$"))
    return F.coalesce(F.substring(F.try_element_at(good, F.lit(1)), 1, 120), F.lit(""))


def source_label(link_text: Column, url: Column, kind: Column) -> Column:
    """What to call a source: its link text, the last readable part of its path with the host, the host, or its kind."""
    host = F.regexp_replace(F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1)), r"^www\.", "")
    path = F.regexp_extract(F.coalesce(url, F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)", 1)
    tidy = lambda s: F.trim(F.regexp_replace(F.regexp_replace(s, r"(?i)\.(?:html?|pdf|aspx?|php|json|xml)$", ""), "[-_]+", " "))
    parts = F.filter(F.transform(F.split(path, "/"), tidy), lambda s: (s != "") & ~looks_like_id(s))
    slug = F.try_element_at(parts, F.lit(-1))
    kind_label = F.initcap(F.replace(F.coalesce(F.nullif(kind, F.lit("")), F.lit("Source")), F.lit("_"), F.lit(" ")))
    own = let(_without_site(strip(F.coalesce(link_text, F.lit("")))), lambda t: F.when(F.length(t).between(5, 120) & ~looks_like_id(t), t))
    return F.coalesce(
        own,
        F.when(slug.isNotNull(), F.substring(F.concat(F.initcap(slug), F.when(host != "", F.concat(F.lit(" ("), host, F.lit(")"))).otherwise("")), 1, 120))
        .when(host != "", F.concat(F.lit("Source: "), host))
        .otherwise(kind_label),
    )


def source_kind(name: Column) -> Column:
    """What kind of source a collector is: the rules that its text is cleaned by."""
    out = F.lit("general")
    for kind, names in SOURCE_KINDS.items():
        out = F.when(name.isin(names), kind).otherwise(out)
    return out


def keyword_section(text: Column, words: str) -> Column:
    """The lines from the first that holds one of the words (an expression) to the next blank line, and later ones that hold one; "" if none does."""
    marked = F.transform(F.split(F.coalesce(text, F.lit("")), "\n"), lambda s: F.struct(s.alias("s"), F.lower(s).rlike(words).alias("k"), (strip(s) == "").alias("b")))
    start = F.array_position(F.transform(marked, lambda x: x["k"]), True)
    rest = F.slice(marked, F.greatest(start, F.lit(1)).cast("int"), F.size(marked))
    stop = F.array_position(F.transform(rest, lambda x: x["b"]), True)
    part = F.when(stop > 0, F.slice(rest, F.lit(1), F.greatest(stop - 1, F.lit(0)).cast("int"))).otherwise(rest)
    return F.when(start > 0, F.array_join(F.transform(part, lambda x: x["s"]), "\n")).otherwise("")


def section_type(title: Column) -> Column:
    """What a section is about, by the first kind of word in its title."""
    low = F.lower(title)
    rules = [
        ("education", "education|degree|university|school|academic"), ("experience", "experience|employment|work|position|career|appointment"), ("publications", "publication|paper|article|journal|conference"),
        ("research", "research|interest|expertise|area"), ("awards", "award|honor|recognition|achievement"), ("contact", "contact|email|phone|address"), ("biography", "bio|biography|about|profile|background"),
        ("skills", "skill|competence|ability"), ("projects", "project"),
    ]
    out = F.lit("other")
    for kind, words in reversed(rules):
        out = F.when(low.rlike(words), kind).otherwise(out)
    return out


def fact_text(name: Column, role: Column, department: Column, email: Column, url: Column, text: Column, least: int = 40, excerpt: int = 420) -> Column:
    """A chunk of the plain facts of a profile, for one that has no other; null without address or if too short."""
    said = lambda label, c: F.when(spaced(F.coalesce(c, F.lit(""))) != "", F.concat(F.lit(f"{label}: "), spaced(c)))
    made = F.array_join(F.array_compact(F.array(said("Name", name), said("Role", role), said("Department", department), said("Email", email), said("Official profile URL", url), said("Profile excerpt", F.rtrim(F.substring(spaced(text), 1, excerpt))))), "\n")
    return F.when((F.coalesce(url, F.lit("")) != "") & (F.length(made) >= least), made)


def json_part(text: Column) -> Column:
    """The JSON array or object within a text that wraps it in words or a code block, trailing commas dropped; "" if there is none."""
    t = F.coalesce(text, F.lit(""))
    fenced = F.regexp_extract(t, r"(?s)```(?:json)?\s*([\[{].*?[\]}])\s*```", 1)
    bare = F.regexp_extract(t, r"(?s)([\[{].*[\]}])", 1)
    return F.regexp_replace(F.when(fenced != "", fenced).otherwise(bare), r",(\s*[}\]])", "$1")
