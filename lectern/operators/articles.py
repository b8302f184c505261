"""Checks and repairs of long articles: structure, person, evidence of sections, claims and links."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lectern.functions import links as L
from lectern.functions import persons as P
from lectern.functions import text as T
from lectern.functions import urls as U
from lectern.functions.cleaning import strip

# What the headings of an article speak of, claims of cause, and sections that only list works.
GROUPS = {
    "why_now": r"why this matters now|what(?:'s| is) at stake|urgency",
    "historical": "historical|background|context",
    "scholar_lens": "scholar|core argument|lens|framework",
    "counterarguments": "counterargument|objection|tension|limit",
    "implications": "implication|policy|public debate|takeaway",
    "watch_next": "what to watch|watch next|next|ahead",
    "conclusion": "conclusion|closing|final",
}
SOURCES = "sources|references|citations|notes"
CAUSAL = r"(?:^|[^a-z])(?:because|caus(?:e|es|ed|ing)|lead(?:s|ing)? to|led to|result(?:s|ed|ing)? in|therefore|thus|driv(?:e|es|en|ing)|trigger(?:s|ed|ing)|escalat(?:e|es|ed|ing)|contribut(?:e|es|ed|ing) to|exacerbat(?:e|es|ed|ing))(?:[^a-z]|$)"
WORKS = "publication|early works|later works|bibliography|editorial work"
CITED = r"\[chunk:([^\]\s]+)\]"


def words(text: Column) -> Column:
    return F.regexp_count(text, F.lit("[A-Za-z0-9']+"))


def sections(article: Column) -> Column:
    """(heading, text) of each part of an article under ``##`` to ``####``; what comes first is the Introduction; empty ones are dropped."""
    parts = F.split(F.regexp_replace(article, r"(?m)^(#{2,4}[ \t])", "\x01$1"), "\x01")
    head = lambda s: F.when(s.rlike(r"^#{2,4}[ \t]"), F.trim(F.regexp_extract(s, r"^#{2,4}[ \t]+([^\n]*)", 1))).otherwise("Introduction")
    made = F.transform(parts, lambda s: F.struct(head(s).alias("heading"), strip(F.regexp_replace(s, r"^#{2,4}[ \t][^\n]*\n?", "")).alias("text")))
    return F.filter(made, lambda x: x["text"] != "")


def _major(parts: Column) -> Column:
    return F.filter(parts, lambda x: ~F.lower(x["heading"]).rlike(SOURCES))


def structure(article: Column, least_words: int = 900, least_sections: int = 6, section_words: int = 60) -> Column:
    """Names of what an article's structure lacks, in order: words, sections, each group of headings, developed sections, sources."""

    def check(major: Column) -> Column:
        blob = F.lower(F.array_join(F.transform(major, lambda x: x["heading"]), " || "))
        short = F.transform(F.slice(F.filter(major, lambda x: words(x["text"]) < section_words), 1, 6), lambda x: x["heading"])
        flat = F.transform(F.slice(F.filter(major, lambda x: (words(x["text"]) >= section_words) & ~x["text"].rlike(r"\n\s*\n")), 1, 6), lambda x: x["heading"])
        rules = [
            (words(article) < least_words, F.concat(F.lit("article_word_count_below_minimum:"), words(article).cast("string"))), (F.size(major) < least_sections, F.lit("insufficient_major_sections")),
            *[(~blob.rlike(p), F.lit(f"missing_required_section:{k}")) for k, p in GROUPS.items()],
            (F.size(short) > 0, F.concat(F.lit("underdeveloped_sections:"), F.array_join(short, ","))), (F.size(flat) > 0, F.concat(F.lit("single_paragraph_sections:"), F.array_join(flat, ","))), (~article.contains("## Sources"), F.lit("missing_sources_section")),
        ]
        return F.array_compact(F.array(*[F.when(bad, name) for bad, name in rules]))

    return F.when(F.coalesce(F.trim(article), F.lit("")) == "", F.array(F.lit("article_empty"))).otherwise(T.let(_major(sections(article)), check))


def lens(article: Column, name: Column) -> Column:
    """"insufficient_scholar_specific_grounding", "limited_scholar_lens_distribution", or "": how often and where an article names its person."""
    full = F.lower(F.trim(name))
    surname = F.coalesce(F.try_element_at(F.filter(F.regexp_extract_all(full, F.lit("([a-z]{3,})"), 1), lambda w: ~w.isin("sir", "dr", "prof", "professor")), F.lit(-1)), F.lit(""))

    def check(x: Column) -> Column:
        low, s = F.lower(article), x["s"]
        times = F.greatest(P.occurrences(low, x["f"]), P.occurrences(low, s))
        hits = F.size(F.filter(x["m"], lambda y: F.lower(y["text"]).contains(x["f"]) | ((s != "") & F.lower(y["text"]).contains(s))))
        return F.when(times < 2, "insufficient_scholar_specific_grounding").when(hits < F.least(F.lit(3), F.greatest(F.lit(1), F.size(x["m"]))), "limited_scholar_lens_distribution").otherwise("")

    told = (F.coalesce(F.trim(name), F.lit("")) != "") & (F.coalesce(F.trim(article), F.lit("")) != "")
    return F.when(told, T.let(F.struct(full.alias("f"), surname.alias("s"), _major(sections(article)).alias("m")), check)).otherwise("")


def details(article: Column) -> Column:
    """"insufficient_concrete_details", "low_year_specificity", or "": years and numbers in an article without its citations."""
    plain = F.regexp_replace(F.coalesce(article, F.lit("")), r"\[chunk:[^\]]*\]", " ")
    numbers = F.regexp_count(plain, F.lit(r"(?:^|[^0-9A-Za-z_.])[0-9]+(?:\.[0-9]+)?"))
    return T.let(F.size(P.years(plain)), lambda n: F.when((n == 0) & (numbers < 10), "insufficient_concrete_details").when(n < 2, "low_year_specificity").otherwise(""))


def cited_paragraphs(article: Column) -> Column:
    """The paragraphs with citations, quotes and heading lines left out."""
    blocks = F.transform(F.split(article, r"\n\s*\n"), lambda s: strip(F.regexp_replace(strip(s), r"(?m)^#{1,6}[ \t][^\n]*\n?", "")))
    return F.filter(blocks, lambda s: (s != "") & ~s.startswith(">") & s.rlike(CITED))


def causal_evidence(articles: DataFrame, passages: DataFrame, key: str, article: str, passage: str, section: str) -> DataFrame:
    """(key, error, n): paragraphs that claim a cause without a known citation, or on lists of works alone."""
    p = articles.where(F.col(article).isNotNull()).select(key, F.posexplode(cited_paragraphs(F.col(article))).alias("n", "p"))
    claim = F.lower(F.regexp_replace("p", r"\[chunk:[^\]]+\]", " "))
    said = p.where((F.regexp_count(claim, F.lit("[a-z']+")) >= 6) & claim.rlike(CAUSAL)).select(key, "n", F.explode(F.array_distinct(F.regexp_extract_all("p", F.lit(CITED), 1))).alias("c"))
    known = passages.select(F.col(passage).cast("string").alias("c"), F.lower(F.coalesce(section, F.lit(""))).rlike(WORKS).alias("works"))
    each = said.join(known, "c", "left").groupBy(key, "n").agg(F.count_if(F.col("works").isNull()).alias("unknown"), F.bool_and(F.coalesce("works", F.lit(False))).alias("only"))
    error = F.when(F.col("unknown") > 0, "causal_claim_missing_valid_citation").when(F.col("only"), "causal_paragraph_publications_only_evidence")
    return each.select(key, error.alias("error")).where("error is not null").groupBy(key, "error").agg(F.count("*").alias("n"))


def section_citations(articles: DataFrame, passages: DataFrame, key: str, article: str, passage: str, text: str, ratio: float = 0.6, overlap: float = 0.02, least: int = 80) -> DataFrame:
    """(key, heading, error) of each longer section whose citations are missing, late, unknown or weak.

    Joins each cited id with its passage, so the work follows the citations.
    """
    long = lambda c: F.array_distinct(F.filter(T.tokens(c), lambda w: F.length(w) >= 4))
    s = articles.where(F.col(article).isNotNull()).select(key, F.posexplode(_major(sections(F.col(article)))).alias("n", "x")).select(key, "n", "x.heading", F.col("x.text").alias("t"))
    s = s.where(F.regexp_count("t", F.lit("[A-Za-z']+")) >= least)
    ids = F.regexp_extract_all("t", F.lit(CITED), 1)
    cut = F.floor(F.length("t") * ratio).cast("int")
    early = F.regexp_count(F.expr("t").substr(F.lit(1), cut + 7), F.lit(r"\[chunk:"))
    s = s.select(key, "n", "heading", ids.alias("ids"), early.alias("early"), long(F.col("t")).alias("w"))
    known = passages.where(F.col(text).isNotNull()).select(F.col(passage).cast("string").alias("c"), long(F.col(text)).alias("v"))
    at = s.select(key, "n", "w", "early", F.posexplode("ids").alias("i", "c")).join(known, "c", "left")
    shared = F.size(F.array_intersect("w", "v"))
    strong = F.col("v").isNotNull() & ((shared >= 3) | (shared / F.greatest(F.size("w"), F.lit(1)) >= overlap))
    found = at.groupBy(key, "n").agg(F.count_if(F.col("v").isNull()).alias("unknown"), F.bool_or(strong).alias("strong"), F.bool_or(strong & (F.col("i") < F.col("early"))).alias("soon"))
    j = s.join(found, [key, "n"], "left")
    none = F.size("ids") == 0
    rules = [
        (none, "section_missing_citation"), (~none & (F.col("early") == 0), "section_citation_end_loaded"), (F.col("unknown") > 0, "section_unknown_or_missing_citations"),
        ((F.col("unknown") == 0) & ~F.col("strong"), "section_weak_citation_grounding"), ((F.col("unknown") == 0) & ~F.col("soon"), "section_missing_early_strong_citation"),
    ]
    return j.select(key, "heading", F.explode(F.array_compact(F.array(*[F.when(F.coalesce(c, F.lit(False)), e) for c, e in rules]))).alias("error"))


def claim_map(claims: DataFrame, passages: DataFrame, articles: DataFrame, key: str, claim: str, ids: str, passage: str, section: str, article: str, least: int = 1) -> DataFrame:
    """(key, kept, errors, warnings) of the claims of each article: long enough, with known passages, causes not on lists of works alone; a warning if no word of it stands in the article."""
    rows = claims.where(F.length(F.coalesce(claim, F.lit(""))) >= 12).select(key, F.monotonically_increasing_id().alias("_i"), F.lower(claim).alias("t"), F.explode_outer(ids).alias("c"))
    known = passages.select(F.col(passage).cast("string").alias("c"), F.lower(F.coalesce(section, F.lit(""))).rlike(WORKS).alias("works"))
    at = rows.join(known, "c", "left").groupBy(key, "_i").agg(F.first("t").alias("t"), F.count("c").alias("n"), F.count_if(F.col("c").isNotNull() & F.col("works").isNull()).alias("unknown"), F.bool_and(F.coalesce("works", F.lit(False))).alias("only"))
    error = F.when(F.col("unknown") > 0, "claim_map_unknown_chunk_ids").when(F.col("n") == 0, "claim_map_missing_chunk_ids").when(F.col("only") & F.col("t").rlike(CAUSAL), "causal_claim_publications_only_evidence")
    body = articles.select(key, F.lower(article).alias("_a"))
    seen = F.exists(F.filter(T.tokens(F.col("t")), lambda w: F.length(w) >= 4), lambda w: F.col("_a").contains(w))
    each = at.select(key, "t", error.alias("e")).join(body, key, "left").select(key, "e", F.when(F.col("e").isNull() & ~F.coalesce(seen, F.lit(False)), 1).otherwise(0).alias("w"))
    a = each.groupBy(key).agg(F.count_if(F.col("e").isNull()).alias("kept"), F.array_join(F.sort_array(F.collect_set("e")), ",").alias("errors"), F.sum("w").alias("warnings"))
    few = F.when(F.col("kept") < least, F.concat_ws(",", F.nullif("errors", F.lit("")), F.lit("claim_evidence_map_below_minimum_after_normalization"))).otherwise(F.col("errors"))
    return a.select(key, "kept", few.alias("errors"), "warnings")


def link_citations(article: Column, selected: Column, allowed: Column, least: int = 2) -> Column:
    """Names of what is wrong with an article's links: chosen or written ones outside the pool, too few, or chosen ones that aren't in the text."""
    key = lambda u: U.crawl_key(u)

    def check(x: Column) -> Column:
        chosen = F.filter(x["s"], lambda u: F.array_contains(x["k"], key(u)))
        rules = [
            (F.size(x["s"]) > F.size(chosen), "source_urls_not_in_allowed_pool"), (F.exists(x["w"], lambda u: ~F.array_contains(x["k"], key(u))), "unknown_article_urls"),
            (F.size(F.array_distinct(F.transform(chosen, key))) < F.least(F.lit(least), F.size(x["k"])), "insufficient_source_url_citations"), (F.exists(chosen, lambda u: ~article.contains(u)), "source_url_missing_from_sources_section"),
        ]
        return F.array_compact(F.array(*[F.when(F.coalesce(c, F.lit(False)), e) for c, e in rules]))

    none = F.array().cast("array<string>")
    keys = F.array_distinct(F.filter(F.transform(F.coalesce(allowed, none), key), lambda k: k != ""))
    written = F.regexp_extract_all(F.coalesce(article, F.lit("")), F.lit(r"(https?://[^\s)\]>\"']+)"), 1)
    return T.let(F.struct(keys.alias("k"), F.coalesce(selected, none).alias("s"), written.alias("w")), check)


def bylines(article: Column, within: int = 24) -> Column:
    """Who the first lines of an article say wrote it."""
    heads = F.slice(F.transform(F.split(F.coalesce(article, F.lit("")), "\n"), lambda s: F.trim(F.regexp_replace(F.trim(s), r"^#{1,6}\s+", ""))), 1, within)
    return F.filter(F.transform(heads, lambda s: F.trim(F.regexp_extract(s, r"(?i)^(?:written )?by\s+(.+)$", 1))), lambda s: s != "")


def is_person(candidate: Column, name: Column) -> Column:
    """Whether a byline names the person: in full, by last name and another, by three names, or by title and last name."""
    skip = ["dr", "prof", "professor", "mr", "mrs", "ms", "sir"]
    c, n = F.lower(candidate), F.lower(F.trim(name))
    tokens = lambda x: F.filter(F.regexp_extract_all(x, F.lit("([a-z]{2,})"), 1), lambda w: ~w.isin(skip))

    def check(x: Column) -> Column:
        surname = F.try_element_at(x["n"], F.lit(-1))
        both = F.size(F.array_intersect(x["n"], x["c"]))
        titled = F.regexp_like(c, F.concat(F.lit(r"\b(?:dr|prof|professor|mr|mrs|ms)\.?\s+"), surname, F.lit(r"\b")))
        return (F.array_contains(x["c"], surname) & (both >= 2)) | (both >= 3) | titled

    told = (F.coalesce(c, F.lit("")) != "") & (F.coalesce(n, F.lit("")) != "")
    return F.coalesce(told & (c.contains(n) | T.let(F.struct(tokens(n).alias("n"), tokens(c).alias("c")), check)), F.lit(False))


def without_bylines(article: Column, name: Column) -> Column:
    """An article without the lines that say its person wrote it."""
    rows = F.split(F.coalesce(article, F.lit("")), "\n")
    said = lambda s: F.trim(F.regexp_extract(F.trim(F.regexp_replace(F.trim(s), r"^#{1,6}\s+", "")), r"(?i)^(?:written )?by\s+(.+)$", 1))
    return F.array_join(F.filter(rows, lambda s: (said(s) == "") | ~is_person(said(s), name)), "\n")


def story_errors(title: Column, article: Column, name: Column, deceased: Column, used: Column, least: int = 4, **limits) -> Column:
    """All errors of an article by itself, each once: title, length, structure, person, details, citations, voice and byline."""
    low = F.lower(F.coalesce(article, F.lit("")))
    inline = F.size(F.array_distinct(F.regexp_extract_all(F.coalesce(article, F.lit("")), F.lit(CITED), 1)))
    voice = low.rlike(r"as i write this today|my latest research|(?:^|[^a-z])i recently(?:[^a-z]|$)") | low.contains(F.concat(F.lit("i am "), F.lower(F.trim(name)))) | (deceased & low.rlike(r"(?:^|[^a-z])(?:i\s+(?:argue|believe|write|wrote|contend|maintain|have|am|was|will|see|remember|want|think)|my\s+(?:work|research|life|view|argument|books|career|teaching))(?:[^a-z]|$)"))
    single = lambda c, *bad: F.when(c.isin(*bad), c)
    head = F.array(
        F.when(F.length(F.trim(F.coalesce(title, F.lit("")))) < 10, "title_too_short"), F.when(F.length(F.trim(F.coalesce(article, F.lit("")))) < 500, "article_too_short"), single(lens(article, name), "insufficient_scholar_specific_grounding"), single(details(article), "insufficient_concrete_details"),
        F.when((inline < least) & (F.coalesce(F.size(F.array_distinct(used)), F.lit(0)) < least), "insufficient_inline_citations"), F.when(F.coalesce(voice, F.lit(False)), "persona_violation"),
        F.when(deceased & F.exists(bylines(article), lambda b: is_person(b, name)), "byline_impersonation"), F.when(deceased & low.rlike("still alive|i am alive|my current office"), "posthumous_violation"),
    )
    return F.array_distinct(F.concat(F.array_compact(head), structure(article, **limits)))


def synthesised_claims(articles: DataFrame, key: str, article: str, most: int = 8) -> DataFrame:
    """(key, place, claim, ids) from the cited paragraphs of an article that has no claim map: the first sentence of each with what it cites."""
    p = articles.where(F.col(article).isNotNull()).select(key, F.posexplode(F.slice(cited_paragraphs(F.col(article)), 1, most)).alias("place", "p"))
    plain = T.collapsed(F.regexp_replace("p", r"\[chunk:[^\]]+\]", " "))
    return p.select(key, "place", F.try_element_at(T.sentences(plain), F.lit(1)).alias("claim"), F.array_distinct(F.regexp_extract_all("p", F.lit(CITED), 1)).alias("ids"))


def chunk_quality(text: Column) -> Column:
    """0 to 1: length and variety of words, less noise and digits; 0 for fewer than 18 words."""
    raw = F.coalesce(text, F.lit(""))
    low = F.lower(raw)
    noise = sum((P.occurrences(low, F.lit(w)) for w in ("photo credit", "loading", "previous", "next", "click", "subscribe", "menu", "copyright", "all rights reserved", "share", "cookie")), F.lit(0))
    digits = F.regexp_count(raw, F.lit("[0-9]")) / F.greatest(F.length(raw), F.lit(1))

    def score(w: Column) -> Column:
        n = F.size(w)
        base = 0.55 * F.least(F.lit(1.0), n / 140.0) + 0.45 * F.size(F.array_distinct(w)) / F.greatest(n, F.lit(1)) - F.least(F.lit(0.65), noise * 0.08) - F.when(digits > 0.09, 0.12).otherwise(0.0)
        return F.when(n < 18, 0.0).otherwise(F.greatest(F.lit(0.0), F.least(F.lit(1.0), base)))

    return T.let(F.regexp_extract_all(low, F.lit("([a-z]{3,})"), 1), score)


def trusted_links(article: Column) -> Column:
    """How many of an article's links lead to trusted hosts."""
    return F.size(F.filter(F.regexp_extract_all(F.coalesce(article, F.lit("")), F.lit(r"(https?://[^\s)\]>\"']+)"), 1), lambda u: L.source_score(U.host(u)) >= 2))


def stronger_citations(articles: DataFrame, passages: DataFrame, key: str, article: str, passage: str, text: str, least: int = 3) -> DataFrame:
    """(key, n, was, now): citations of paragraphs that share fewer than ``least`` words with what they cite, each with the cited passage of the same article that shares most.

    Only what an article cites is compared with its paragraphs, so work follows the
    citations; where no passage does better the citation isn't listed.
    """
    long = lambda c: F.array_distinct(F.filter(T.tokens(c), lambda w: F.length(w) >= 4))
    p = articles.where(F.col(article).isNotNull()).select(key, F.posexplode(cited_paragraphs(F.col(article))).alias("n", "p")).select(key, "n", long(F.regexp_replace("p", CITED, " ")).alias("w"), F.array_distinct(F.regexp_extract_all("p", F.lit(CITED), 1)).alias("ids"))
    pool = p.select(key, F.explode("ids").alias("c")).distinct().join(passages.where(F.col(text).isNotNull()).select(F.col(passage).cast("string").alias("c"), long(F.col(text)).alias("v")), "c")
    own = p.select(key, "n", "w", F.explode("ids").alias("was")).join(pool.withColumnRenamed("c", "was"), [key, "was"], "left")
    weak = own.select(key, "n", "w", "was", F.coalesce(F.size(F.array_intersect("w", "v")), F.lit(0)).alias("had")).where(F.col("had") < least)
    scored = weak.join(pool, key).select(key, "n", "was", "had", F.size(F.array_intersect("w", "v")).alias("hits"), "c").where((F.col("c") != F.col("was")) & (F.col("hits") >= least) & (F.col("hits") > F.col("had")))
    best = scored.groupBy(key, "n", "was").agg(F.min(F.struct((-F.col("hits")).alias("h"), "c")).alias("b"))
    return best.select(key, "n", "was", F.col("b.c").alias("now"))


def repaired(article: Column, name: Column, trend_url: Column, expected_url: Column) -> Column:
    """(article, trend_url): an article without its person's bylines, and the link that it must name where it names another or none."""
    return F.struct(without_bylines(article, name).alias("article"), F.when(L.external(trend_url) & (trend_url == expected_url), trend_url).otherwise(expected_url).alias("trend_url"))
