"""Intents of texts and sources, claims in them, and what a profile covers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lectern.functions import text as T

# Words that show what a text is about, two expressions each, in order of rank.
INTENTS = {
    "speech": [r"\b(?:speech|remarks|keynote|lecture|address|talk|commencement|fireside)\b", r"\b(?:prepared remarks|public address|opening remarks)\b"],
    "interview": [r"\b(?:interview|q&a|q and a|conversation|podcast|oral history)\b", r"\b(?:fireside chat|sit down with|in conversation with)\b"],
    "paper": [r"\b(?:working paper|journal|article|doi|abstract|methodology|findings)\b", r"\b(?:nber|repec|econpapers|ssrn|arxiv)\b"],
    "testimony": [r"\b(?:testimony|hearing|committee|congressional|statement for the record)\b", r"\b(?:chrg-|hhrg-|senate hearing|house hearing)\b"],
    "policy_statement": [r"\b(?:policy statement|position paper|white paper|recommendation|policy report)\b", r"\b(?:task force|advisory committee|commission report|public policy)\b"],
    "biography": [r"\b(?:biography|bio|about|profile|awards?|honors?)\b"],
}
TYPE_HINTS = {"speech": "speech|remarks|transcript", "interview": "interview|podcast|oral_history", "paper": "publication|paper|journal", "testimony": "testimony|hearing", "policy_statement": "policy|report", "biography": "profile_page|biography"}
REQUIRED = ("speech", "interview", "paper", "testimony", "policy_statement")
# How claims are worded, what they are about, and what none holds.
VERBS = "is|was|are|were|served|serves|received|earned|joined|appointed|published|authored|wrote|won|led|founded|graduated|completed|holds|born|studied|taught|directed|edited|translated"
YEAR = r"(?:^|[^0-9A-Za-z_])(?:1[6-9]|20)[0-9]{2}(?:[^0-9A-Za-z_]|$)"
NO_CLAIM = r"verify you are human|captcha|cloudflare|attention required|access denied|loading\.\.\.|subscribe|sign in to continue|proof of work|anubis|jshelter|shopping basket|shopping cart|site archived|return to top|(?:^|[^a-z])cookie(?:[^a-z]|$)"
TOPICS = {
    "education": r"ph\.d|phd|m\.a|m\.s|b\.a|b\.s|degree|university|college|graduated|doctorate|alma mater",
    "awards": "award|honor|honorary|prize|medal|fellow|fellowship|laureate|induct",
    "positions": "professor|chair|director|dean|lecturer|assistant|associate|founder|co-founder|president|head of",
    "publications": "published|article|journal|book|paper|monograph|edited volume|author of",
    "speeches": "speech|remarks|keynote|lecture|address|talk",
    "research": "research|study|investigation|experiment|field work",
    "biography": "born|grew up|raised|died|passed away",
}


def claims(docs: DataFrame, id_col: str = "doc_id", text: str = "text", name: Column | None = None, quality: Column | None = None, required: Column | None = None, license_type: Column | None = None, most: int = 3, least: float = 0.4) -> DataFrame:
    """(id, sentence_no, claim, confidence, named, tags) of the first sentences of each text that state something.

    A claim has 40 to 320 characters, no page chrome, and a verb of stating or a year.
    Where the person is known, it names them, or comes from a good source with both.
    """
    zero = lambda c, d: F.lit(d) if c is None else F.coalesce(c, F.lit(d))
    rows = docs.where(F.col(text).isNotNull()).select(
        id_col, F.lower(F.trim(zero(name, ""))).alias("_n"), zero(quality, 0).alias("_q"), zero(required, False).alias("_r"), zero(license_type, "").alias("_l"), F.posexplode(T.sentences(F.col(text))).alias("sentence_no", "claim")
    )
    low = F.lower("claim")
    verb, year = low.rlike(rf"(?:^|[^a-z0-9'])(?:{VERBS})(?:[^a-z0-9']|$)"), F.col("claim").rlike(YEAR)
    last = F.coalesce(F.try_element_at(F.filter(F.split("_n", r"\s+"), lambda w: F.length(w) >= 3), F.lit(-1)), F.lit(""))
    named = (F.col("_n") != "") & (low.contains(F.col("_n")) | ((last != "") & low.contains(last)))
    fit = rows.where(F.length("claim").between(40, 320) & ~low.rlike(NO_CLAIM)).withColumn("_v", verb).withColumn("_y", year).withColumn("named", named).where("_v or _y")
    fit = fit.where((F.col("_n") == "") | F.col("named") | ((F.col("_q") > 0) & F.col("_v") & F.col("_y")))
    points = [(F.col("named"), 0.30), (F.col("_v"), 0.10), (F.col("_y"), 0.10), (F.col("_r"), 0.10), (F.col("_q") >= 2, 0.10), (F.col("_q") == 1, 0.05), (F.col("_q") < 0, -0.20), (~F.col("_l").isin("", "unknown"), 0.05)]
    score = 0.20 + sum((F.when(c, p).otherwise(0.0) for c, p in points), F.lit(0.0))
    tags = F.array_compact(F.array(*[F.when(low.rlike(p), k) for k, p in TOPICS.items()]))
    scored = fit.withColumn("confidence", F.round(F.greatest(F.lit(0.0), F.least(F.lit(1.0), score)), 3)).where(F.col("confidence") >= least).select(id_col, "sentence_no", "claim", "confidence", "named", tags.alias("tags"))
    # the first of each text from an ordered array of its own claims
    firsts = scored.groupBy(id_col).agg(F.slice(F.array_sort(F.collect_list(F.struct("sentence_no", "claim", "confidence", "named", "tags"))), 1, most).alias("c"))
    return firsts.select(id_col, F.explode("c").alias("c")).select(id_col, "c.*")


def _count(text: Column, patterns: Sequence[str]) -> Column:
    return sum((F.regexp_count(text, F.lit(p)) for p in patterns), F.lit(0))


def intent_hits(docs: DataFrame, *keep: str, text: str = "text") -> DataFrame:
    """One row for each intent that a text shows, with its hits and place, ties in the order of the intents."""
    counted = docs.where(F.col(text).isNotNull()).select(*keep, F.lower(text).alias("_t")).select(*keep, F.array(*[_count(F.col("_t"), p) for p in INTENTS.values()]).alias("n"))
    named = F.transform("n", lambda n, i: F.struct((-n).alias("o"), i.alias("i")))
    ranked = counted.select(*keep, F.posexplode(F.array_sort(F.filter(named, lambda x: x["o"] < 0))).alias("p", "x"))
    return ranked.select(*keep, F.element_at(F.array(*[F.lit(k) for k in INTENTS]), F.col("x.i") + 1).alias("intent"), (-F.col("x.o")).alias("hits"), (F.col("p") + 1).alias("place"))


def top_intents(docs: DataFrame, id_col: str = "doc_id", most: int = 2) -> DataFrame:
    """The intents with the most hits of each text."""
    return intent_hits(docs, id_col).where(F.col("place") <= most)


def source_intents(sources: DataFrame, key: str, blob: Column, text: Column, kind: Column, quality: Column, least: float = 0.35) -> DataFrame:
    """(key, scores.., primary, required, gate, reason) of each source: points for its address, text, kind and host.

    ``blob`` is what address and link say. A source passes with a required intent of
    enough confidence.
    """
    u, t, k = F.lower(F.coalesce(blob, F.lit(""))), F.lower(F.coalesce(text, F.lit(""))), F.lower(F.coalesce(kind, F.lit("")))
    rows = sources.select(key, u.alias("u"), t.alias("t"), k.alias("k"), quality.alias("q"))

    def score(intent: str) -> Column:
        hits = lambda c: sum((F.col(c).rlike(p).cast("int") for p in INTENTS[intent]), F.lit(0))
        raw = 0.30 * hits("u") + 0.25 * hits("t") + 0.20 * F.col("k").rlike(TYPE_HINTS[intent]).cast("int") + 0.20 * F.greatest(F.col("q"), F.lit(0)) - F.when(F.col("q") < 0, 0.25).otherwise(0.0)
        return F.round(F.greatest(F.lit(0.0), F.least(F.lit(1.0), raw)), 4)

    s = rows.select(key, *[score(i).alias(i) for i in INTENTS])
    ranked = F.array_sort(F.array(*[F.struct((-F.col(i)).alias("o"), F.lit(n).alias("n"), F.lit(i).alias("i")) for n, i in enumerate(INTENTS)]))
    best = F.greatest(*[F.col(i) for i in REQUIRED])
    return s.select(
        "*", F.when(F.greatest(*[F.col(i) for i in INTENTS]) > 0, F.element_at(ranked, 1)["i"]).otherwise("").alias("primary"), best.alias("required"), (best >= least).alias("gate"),
        F.when(best <= 0, "no_required_intent_match").when(best < least, F.concat(F.lit("low_intent_confidence:"), F.format_string("%.2f", best))).otherwise("").alias("reason"),
    )


def intent_summary(docs: DataFrame, group: str = "source", least_types: int = 2, least_sources: int = 3, least_chunks: int = 6) -> DataFrame:
    """(group, chunks, types, covered, chunk_counts, passes, reason): what each group's texts cover, and whether that is enough.

    Texts with a required intent count as accepted sources. Counts come from one
    projection of the matches of a text, so that each is looked through once.
    """
    shown = docs.where(F.col(text := "text").isNotNull()).select(group, F.lower(text).alias("_t")).select(group, *[_count(F.col("_t"), p).alias(k) for k, p in INTENTS.items()])
    told = lambda k: F.count_if(F.col(k) > 0)
    a = shown.groupBy(group).agg(F.count("*").alias("chunks"), F.count_if(sum((F.col(k) for k in REQUIRED), F.lit(0)) > 0).alias("sources"), *[told(k).alias(f"n_{k}") for k in INTENTS])
    covered = F.array_compact(F.array(*[F.when(F.col(f"n_{k}") > 0, k) for k in sorted(REQUIRED)]))
    counts = F.array_join(F.array_compact(F.array(*[F.when(F.col(f"n_{k}") > 0, F.concat(F.lit(f"{k}:"), F.col(f"n_{k}").cast("string"))) for k in sorted(INTENTS)])), ",")
    types = F.size(covered)
    reason = (
        F.when(types < least_types, F.concat(F.lit("covered_types_"), types.cast("string"), F.lit(f"_lt_{least_types}")))
        .when(F.col("sources") < least_sources, F.concat(F.lit("accepted_sources_"), F.col("sources").cast("string"), F.lit(f"_lt_{least_sources}")))
        .when(F.col("chunks") < least_chunks, F.concat(F.lit("accepted_chunks_"), F.col("chunks").cast("string"), F.lit(f"_lt_{least_chunks}")))
        .otherwise("")
    )
    return a.select(group, "chunks", "sources", types.alias("types"), F.array_join(covered, ",").alias("covered"), counts.alias("chunk_counts"), (reason == "").alias("passes"), reason.alias("reason"))


def with_enrichment(profiles: DataFrame, texts: DataFrame, key: str, text: str, more: str, head: str = "=== Enrichment ===") -> DataFrame:
    """Profiles with the text of their enrichment behind their own, under a heading; unchanged without one."""
    joined = profiles.join(texts.select(key, F.col(more).alias("_m")), key, "left")
    told = F.trim(F.coalesce("_m", F.lit(""))) != ""
    return joined.withColumn(text, F.when(told, F.concat_ws("\n\n", F.nullif(F.trim(F.coalesce(text, F.lit(""))), F.lit("")), F.lit(head), F.trim("_m"))).otherwise(F.col(text))).drop("_m")


def stripped(results: DataFrame, fits: Column, mark: str = "false_positive") -> DataFrame:
    """Results of collectors with those that aren't about the person turned into failures, their text and data gone."""
    bad = F.col("success") & ~F.coalesce(fits, F.lit(False))
    out = results.withColumn("_bad", bad)
    gone = {"success": F.when(F.col("_bad"), False).otherwise(F.col("success")), "raw_text": F.when(F.col("_bad"), "").otherwise(F.col("raw_text")), "error": F.when(F.col("_bad"), mark).otherwise(F.col("error"))}
    if "data" in results.columns:
        gone["data"] = F.when(~F.col("_bad"), F.col("data"))
    return out.withColumns(gone).drop("_bad")


def assembled(results: DataFrame, key: str, order: Sequence[str]) -> DataFrame:
    """(key, text): the texts of a profile's successful collectors under their names, in the order of their worth; others by name after them."""
    rank = F.coalesce(F.nullif(F.array_position(F.array(*[F.lit(o) for o in order]), F.col("source")), F.lit(0)), F.lit(len(order) + 1))
    part = F.concat(F.lit("--- "), "source", F.lit(" ---\n"), "raw_text")
    told = results.where(F.col("success") & (F.coalesce("raw_text", F.lit("")) != ""))
    return told.groupBy(key).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(rank.alias("r"), "source", part.alias("p")))), lambda x: x["p"]), "\n\n").alias("text"))
