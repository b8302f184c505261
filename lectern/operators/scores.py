"""Scores, roll-ups and readiness of profiles, from aggregates over their sources and sections."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lectern.operators.reports import ladder

# Which collectors apply to whom.
UNIVERSAL = ("web_search", "openalex", "courses", "campus_news", "expertise", "crossref", "orcid", "rate_my_professor", "wikidata", "gdelt")
GRANTS = ("nsf_grants", "nih_grants", "usaspending")
PARENTS = {"unpaywall": ("openalex", "crossref"), "altmetric": ("openalex", "crossref"), "opencitations": ("openalex", "crossref"), "youtube_transcripts": ("youtube_lectures",)}
RARE = ("youtube_transcripts", "patentsview", "clinicaltrials", "github", "huggingface", "wikidata", "altmetric", "pmc_oa", "arxiv", "biorxiv", "zenodo", "usaspending")
# Sections by what their names say.
GENERIC = "home|page not found|personal website|website subpage|upcoming events|recent news|news|directions|contact|asset type|technical information|access request"
SEMANTIC = {"biography": "biography|bio|about|life|early life|profile", "background": "background|education|career|academic career|positions", "legacy": "legacy|impact|influence|tribute|honor|memorial", "works": "publications|books|works|writings|articles|papers", "voice": "interview|oral history|quote|speech|lecture|conversation|keynote"}
CORE = ("biography", "background", "legacy", "publications")


def confidence(results: DataFrame, key: str = "profile_id") -> DataFrame:
    """(key, successful, applicable, rare, confidence, richness): six weighted signals over the results of a profile's collectors.

    ``results`` has one row a key and source: success, chars, named, affiliated, h_index,
    publications. A source counts as applicable if it applies to everyone, to whoever
    has publications (grants), if what it depends on succeeded, or if it succeeded.
    """
    ok = F.coalesce(F.col("success"), F.lit(False))
    s = F.col("source")
    has = lambda names: F.max(F.when(ok & s.isin(list(names)), 1).otherwise(0)) == 1
    h = F.when(ok & (F.col("h_index") > 0), F.col("h_index"))
    parents = sorted({p for ps in PARENTS.values() for p in ps})
    a = results.groupBy(key).agg(
        F.count_if(ok).alias("successful"), F.count_if(ok & F.col("named")).alias("names"), F.count_if(ok & F.col("affiliated")).alias("homes"), F.coalesce(F.sum(F.when(ok, F.col("chars"))), F.lit(0)).alias("chars"),
        F.count(h).alias("hn"), (F.max(h) - F.min(h)).alias("hr"), F.avg(h).alias("hm"), F.count_if(ok & (F.col("publications") > 0)).alias("pubs"), F.count_if(ok & s.isin(list(RARE))).alias("rare"),
        F.count_if(s.isin(list(UNIVERSAL))).alias("universal"), F.count_if(s.isin(list(GRANTS))).alias("grants"), F.count_if(ok & s.isin(list(GRANTS))).alias("grants_ok"),
        F.count_if(ok & ~s.isin([*UNIVERSAL, *GRANTS, *PARENTS])).alias("others"), *[has([p]).alias(f"has_{p}") for p in parents], *[F.count_if(s == c).alias(f"n_{c}") for c in PARENTS],
    )
    dependents = sum((F.when(sum((F.col(f"has_{p}").cast("int") for p in ps), F.lit(0)) > 0, F.col(f"n_{c}")).otherwise(0) for c, ps in PARENTS.items()), F.lit(0))
    applicable = F.greatest(F.col("universal") + F.when(F.col("pubs") > 0, F.col("grants")).otherwise(F.col("grants_ok")) + dependents + F.col("others"), F.lit(1))
    n = F.greatest("successful", F.lit(1))
    share = lambda x, y: F.least(x / y, F.lit(1.0))
    steady = F.when((F.col("hn") >= 2) & (F.col("hm") > 0), F.greatest(F.lit(0.0), 1 - F.col("hr") / F.col("hm"))).otherwise(0.0)
    score = 0.30 * share(F.col("successful"), applicable) + 0.20 * share(F.col("names"), n) + 0.15 * share(F.col("homes"), n) + 0.10 * share(F.col("chars"), F.lit(20000)) + 0.10 * steady + 0.15 * share(F.col("rare"), F.lit(6.0))
    return a.select(key, "successful", applicable.alias("applicable"), "rare", F.round(score, 3).alias("confidence"), F.round(share(F.col("rare"), F.lit(10.0)), 3).alias("richness"))


def success_summary(results: DataFrame, key: str = "profile_id") -> DataFrame:
    """(key, succeeded, failed, names, failures): counts and sorted names of a profile's collectors."""
    ok = F.coalesce(F.col("success"), F.lit(False))
    listed = lambda c: F.array_join(F.sort_array(F.collect_set(F.when(c, F.col("source")))), ",")
    return results.groupBy(key).agg(F.count_if(ok).alias("succeeded"), F.count_if(~ok).alias("failed"), listed(ok).alias("names"), listed(~ok).alias("failures"))


def dashboard(scored: DataFrame) -> DataFrame:
    """One row: how many profiles have no, one, two, three and more sources, the mean confidence, the share with two, and the verdict."""
    n, s = F.greatest(F.count("*"), F.lit(1)), F.col("successful")
    usable = F.count_if(s >= 2) * 100.0 / n
    return scored.agg(
        F.count("*").alias("profiles"), F.count_if(s == 0).alias("none"), F.count_if(s == 1).alias("one"), F.count_if(s == 2).alias("two"), F.count_if(s >= 3).alias("more"), F.round(F.avg("confidence"), 3).alias("confidence"),
        (F.count_if(s >= 3) * 100.0 / n >= 70).alias("enough_sources"), F.round(usable, 1).alias("usable"), F.when(usable >= 60, "pass").when(usable >= 40, "warn").otherwise("fail").alias("verdict"),
    )


def rates(results: DataFrame, by: str = "source") -> DataFrame:
    """(by, attempted, succeeded, rate) of each collector."""
    return results.groupBy(by).agg(F.count("*").alias("attempted"), F.count_if("success").alias("succeeded"), F.round(F.count_if("success") * 100.0 / F.count("*"), 1).alias("rate"))


def funders(works: DataFrame, name: str, award: str, *by: str) -> DataFrame:
    """(by, key, name, works, awards): funders whatever their case, the first spelling, how many works, and their awards in order."""
    return works.where(F.coalesce(F.col(name), F.lit("")) != "").groupBy(*by, F.lower(name).alias("key")).agg(F.min(name).alias("name"), F.count("*").alias("works"), F.array_join(F.sort_array(F.collect_set(award)), ",").alias("awards"))


def most_common(rows: DataFrame, value: str, most: int, *by: str) -> DataFrame:
    """(by, value, n, place): the most frequent values of each group, ties by value."""
    counted = rows.where(F.col(value).isNotNull()).groupBy(*by, value).agg(F.count("*").alias("n"))
    from pyspark.sql.window import Window

    w = Window.partitionBy(*by).orderBy(F.col("n").desc(), value) if by else Window.orderBy(F.col("n").desc(), value)
    return counted.withColumn("place", F.row_number().over(w)).where(F.col("place") <= most)


def section_stats(rows: DataFrame, key: str, section: str, text: str | None = None) -> DataFrame:
    """(key, sections, generic, generic_share, kinds, voice, coverage): what the sections of a key are about, by their names (and voice by their texts)."""
    low = F.lower(F.trim(section))
    said = F.lit(False) if text is None else F.coalesce(F.lower(text).rlike("interviewer:|interview:|question:|answer:|he said|she said"), F.lit(False))
    any_ = {k: F.max(low.rlike(p).cast("int")) for k, p in SEMANTIC.items()}
    one = rows.where(F.coalesce(F.trim(section), F.lit("")) != "").groupBy(key).agg(
        F.countDistinct(section).alias("sections"), F.countDistinct(F.when(low.rlike(GENERIC), F.col(section))).alias("generic"), *[v.alias(f"_{k}") for k, v in any_.items()], F.max(said.cast("int")).alias("_said"),
        *[F.max(low.contains(c).cast("int")).alias(f"_c{i}") for i, c in enumerate(CORE)],
    )
    kinds = sum((F.col(f"_{k}") for k in SEMANTIC), F.lit(0))
    core = sum((F.col(f"_c{i}") for i in range(len(CORE))), F.lit(0))
    return one.select(key, "sections", "generic", F.round(F.col("generic") / F.greatest("sections", F.lit(1)), 4).alias("generic_share"), kinds.alias("kinds"), ((F.col("_voice") + F.col("_said")) > 0).alias("voice"), core.alias("coverage"))


def feature_scores(s: dict[str, Column]) -> dict[str, Column]:
    """Points of the four uses of a profile, from its statistics: card, chatbot, editorial, podcast."""
    g, p = s["generic_share"], s["provenance"]
    at = lambda c, *steps: ladder(c, list(steps))
    below = lambda a, x, b, y, z=0: F.when(g <= a, x).when(g <= b, y).otherwise(z)
    clamp = lambda c: F.greatest(F.lit(0), F.least(F.lit(100), F.round(c).cast("int")))
    twice = s["copies"] > 1
    card = at(s["short_bio"], (180, 22), (100, 16), (40, 8)) + at(s["long_bio"], (700, 18), (350, 12), (140, 6)) + F.when(s["field"], 8).otherwise(0) + at(s["summary"], (140, 14), (80, 10), (40, 5)) + at(s["works"], (4, 14), (2, 10), (1, 5)) + at(s["milestones"], (4, 10), (2, 6), (1, 3)) + at(s["urls"], (6, 8), (3, 5), (1, 2)) + below(0.35, 6, 0.6, 2)
    chatbot = at(s["chunks"], (80, 24), (40, 18), (20, 13), (10, 7)) + at(s["urls"], (10, 18), (6, 13), (3, 8), (1, 4)) + at(s["domains"], (8, 12), (5, 8), (3, 5), (1, 2)) + at(s["kinds"], (4, 16), (3, 12), (2, 7), (1, 3)) + at(s["long_bio"] + s["summary"], (900, 10), (450, 7), (180, 4)) + at(p, (0.95, 10), (0.75, 7), (0.5, 4)) + below(0.3, 10, 0.55, 5)
    editorial = at(s["chunks"], (100, 24), (60, 18), (30, 12), (15, 6)) + at(s["urls"], (12, 18), (8, 13), (5, 8), (2, 4)) + at(s["kinds"], (4, 20), (3, 14), (2, 8), (1, 3)) + F.when(s["voice"], 14).otherwise(4) + at(s["long_bio"] + s["current"], (900, 10), (500, 7), (180, 4)) + at(p, (0.95, 8), (0.75, 5), (0.5, 3)) + below(0.25, 10, 0.5, 4) - F.when(twice, 8).otherwise(0)
    podcast = at(s["chunks"], (120, 20), (70, 15), (40, 10), (20, 5)) + at(s["urls"], (15, 14), (10, 10), (6, 6), (3, 3)) + F.when(s["voice"], 22).otherwise(3) + at(s["kinds"], (4, 18), (3, 13), (2, 7), (1, 3)) + at(s["long_bio"], (750, 10), (400, 7), (180, 4)) + at(s["works"] + s["milestones"], (8, 8), (5, 5), (2, 3)) + at(p, (0.95, 4), (0.75, 3), (0.5, 2)) + below(0.25, 4, 0.5, 1) - F.when(twice, 10).otherwise(0)
    return {"card": clamp(card), "chatbot": clamp(chatbot), "editorial": clamp(editorial), "podcast": clamp(podcast)}


def readiness(score: Column) -> Column:
    return F.when(score >= 80, "demo_ready").when(score >= 65, "demo_ready_with_guardrails").when(score >= 50, "limited_demo_use").otherwise("not_ready")


def profile_quality(named: Column, chunks: Column, coverage: Column, mean_chars: Column) -> Column:
    """20 points for a clean name, up to 40 for chunks, 20 for sections, 20 for their length."""
    return F.when(named, 20).otherwise(0) + ladder(chunks, [(80, 40), (40, 30), (20, 20), (10, 10)]) + ladder(coverage, [(4, 20), (3, 14), (2, 8)]) + ladder(mean_chars, [(420, 20), (250, 14), (140, 8)])


def quality_status(score: Column, chunks: Column, key: Column) -> Column:
    return F.when(F.coalesce(key, F.lit("")) == "", "invalid_profile").when((score < 60) | (chunks < 20), "needs_data_repair").otherwise("ready")


def completeness(bio: Column, works: Column, education: Column, expertise: Column, awards: Column) -> Column:
    """0 to 100: twenty points each for biography, works, education, expertise, and awards or experience."""
    return (
        F.when(F.length(bio) > 100, 20).when(F.length(bio) > 0, 10).otherwise(0) + F.when(works > 10, 20).when(works > 5, 15).when(works > 0, 10).otherwise(0)
        + F.when(education > 0, 20).otherwise(0) + F.when(expertise > 5, 20).when(expertise > 0, 15).otherwise(0) + F.when(awards > 0, 20).otherwise(0)
    )


def recommendations(s: dict[str, Column]) -> Column:
    """What a profile needs, by priority, at most eight: (priority, category)."""
    rules = [
        (10, "dedupe", s["copies"] > 1), (20, "evidence_depth", s["chunks"] < 40), (30, "source_diversity", (s["urls"] < 8) | (s["domains"] < 5)), (40, "section_quality", (s["kinds"] < 3) | (s["generic_share"] > 0.4)),
        (50, "voice_grounding", ~s["voice"]), (60, "structured_fields", (s["education"] == 0) | (s["focus"] == 0)), (70, "operational_readiness", ~s["scored"]), (80, "podcast_scope", s["podcast"] < 65), (90, "editorial_scope", s["editorial"] < 65),
    ]
    return F.slice(F.array_compact(F.array(*[F.when(F.coalesce(c, F.lit(True)), F.struct(F.lit(p).alias("priority"), F.lit(k).alias("category"))) for p, k, c in rules])), 1, 8)


def merged_record(rows: DataFrame, key: str, lists: Sequence[str], text: str) -> DataFrame:
    """(key, text, lists..): each key's resources as one record: the longest text, and its lists joined, each entry once whatever its case, sorted."""
    longest = F.max_by(text, F.when(F.col(text).isNotNull(), F.struct(F.length(text), F.col(text)))).alias(text)
    out = rows.groupBy(key).agg(longest)
    for c in lists:
        entries = rows.select(key, F.explode(c).alias("e")).where("trim(e) <> ''").groupBy(key, F.lower(F.trim("e")).alias("k")).agg(F.min(F.trim("e")).alias("e"))
        out = out.join(entries.groupBy(key).agg(F.sort_array(F.collect_list("e")).alias(c)), key, "left")
    return out.select(key, text, *[F.coalesce(c, F.array().cast("array<string>")).alias(c) for c in lists])


def weighted_pick(rows: DataFrame, key: str, item: str, weight: str, seed: str) -> DataFrame:
    """(key, item): one item of each key, by chance in proportion to its weight, the same for the same seed.

    The item with the least -ln(u) / weight, with u from a hash of seed, key and item: an
    aggregate, so a hot key is combined before the shuffle. Weights of 0 and below, and null, never win.
    """
    u = (F.conv(F.substring(F.sha2(F.concat_ws(":", F.lit(seed), F.col(key).cast("string"), F.col(item).cast("string")), 256), 1, 12), 16, 10).cast("double") + 1) / F.lit(float(1 << 48) + 1)
    drawn = F.struct((-F.ln(u) / F.col(weight)).alias("d"), F.col(item).alias("i"))
    return rows.where(F.col(weight) > 0).groupBy(key).agg(F.min(drawn).alias("m")).select(key, F.col("m.i").alias(item))
