"""Column expressions on texts. All stay in the JVM."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Stop words that tell a language.
STOPWORDS = {
    "en": "the and of to in for on with as by at from that this it is are was were be been or an a but if then so than which who whom their there these those its into about".split(),
    "fr": "le la les et de des du un une que qui pour dans sur avec par ses son sa est sont ce ces cette au aux ne pas plus comme".split(),
    "es": "el la los las y de del que en un una por con para como es son su sus no se lo le al este esta".split(),
    "de": "der die das und ist sind ein eine von zu mit den des dem im auf fur nicht auch wird war als".split(),
}

# Lines of page chrome.
BOILERPLATE = r"\bprivacy\b|\bterms\b|\bcookies?\b|\ball rights reserved\b|\bsubscribe\b|\blog\s*in\b|\bmenu\b|\bskip to content\b|\bback to top\b"
# Lines that are no title.
TITLE_NOISE = r"^(?:loading|sign in|log in|search\b|menu|skip to content|cookie|shopping basket|shopping cart|home page|return to top|back to top|site archived|=== ?profile page|=== ?seed url)"
NOISE = "access to this page has been denied|verify you are human|captcha|cloudflare|attention required|press & hold|press and hold|confirm you are a human|checking your browser|proof of work|security check|not a bot|access denied"

WORD = r"[\p{L}\p{N}_]+"
#: White space as the texts have it, no-break space included.
SPACE = r"[\s\x{A0}]+"


def let(value: Column, body) -> Column:
    """``body`` of ``value``, computed once however often the body uses it, also within its lambdas."""
    return F.element_at(F.transform(F.array(value), body), 1)


def distinct_by(items: Column, key) -> Column:
    """The entries of an array, each once by ``key``, in order of first occurrence."""

    def kept(m: Column) -> Column:
        placed = F.transform(m, lambda y, i: F.struct(y.alias("y"), i.alias("i")))
        return let(F.transform(m, lambda y: y["k"]), lambda ks: F.transform(F.filter(placed, lambda z: F.array_position(ks, z["y"]["k"]) == z["i"] + 1), lambda z: z["y"]["x"]))

    return let(F.transform(items, lambda x: F.struct(key(x).alias("k"), x.alias("x"))), kept)


def collapsed(text: Column) -> Column:
    """White space runs as one blank, ends trimmed."""
    return F.trim(F.regexp_replace(text, SPACE, " "))


def text_hash(text: Column) -> Column:
    """SHA-256 of the collapsed lower-case text: texts that differ in case or spacing share it."""
    return F.sha2(F.lower(collapsed(text)), 256)


def word_count(text: Column) -> Column:
    return F.regexp_count(text, F.lit(WORD))


def lines_of(text: Column) -> Column:
    """The lines that aren't blank, trimmed."""
    return F.filter(F.transform(F.split(text, "\n"), lambda s: F.trim(F.regexp_replace(s, r"^[\s\x{A0}]+|[\s\x{A0}]+$", ""))), lambda s: s != "")


def ascii_ratio(text: Column) -> Column:
    """Share of printable ASCII characters; 0 for an empty text."""
    return F.round(F.coalesce(F.regexp_count(text, F.lit(r"[\x20-\x7e]")) / F.nullif(F.length(text), F.lit(0)), F.lit(0.0)), 4)


def boilerplate_ratio(text: Column) -> Column:
    """Share of the lines that hold a phrase of page chrome."""
    lines = lines_of(text)
    hits = F.size(F.filter(lines, lambda s: F.lower(s).rlike(BOILERPLATE)))
    return F.round(hits / F.greatest(F.size(lines), F.lit(1)), 4)


def tokens(text: Column) -> Column:
    """Words in lower case."""
    return F.regexp_extract_all(F.lower(text), F.lit(f"({WORD})"), 1)


def with_language(df: DataFrame, text: str = "text", language: str = "language", confidence: str = "confidence") -> DataFrame:
    """``df`` with a language code and confidence by the share of stop words; ties in the order en, fr, es, de.

    "unknown" for null, for fewer than 40 characters and for less than a tenth of stop
    words. The words are extracted once and counted in one pass over them, in steps of
    their own, so that no later use repeats the work.
    """
    words = df.withColumn("_words", F.regexp_extract_all(F.lower(F.col(text)), F.lit(r"([\p{L}]{2,})"), 1))
    zero = F.struct(*[F.lit(0).alias(k) for k in STOPWORDS])
    counted = words.withColumn("_n", F.size("_words")).withColumn(
        "_hits", F.aggregate("_words", zero, lambda acc, w: F.struct(*[(acc[k] + w.isin(STOPWORDS[k]).cast("int")).alias(k) for k in STOPWORDS]))
    )
    best = F.greatest(*[F.col(f"_hits.{k}") for k in STOPWORDS])
    ratio = counted.withColumn("_best", best).withColumn("_ratio", F.col("_best") / F.greatest(F.col("_n"), F.lit(1)))
    code = F.lit("de")
    for k in ("es", "fr", "en"):
        code = F.when(F.col(f"_hits.{k}") == F.col("_best"), k).otherwise(code)
    short = F.col(text).isNull() | (F.length(text) < 40) | (F.col("_n") <= 0)
    low = F.col("_ratio") < 0.10
    sure = F.when(short, 0.0).when(low, F.round(0.1 * F.col("_ratio"), 4)).otherwise(F.round(F.least(F.lit(0.85), 0.35 + F.col("_ratio")), 4))
    return ratio.withColumn(language, F.when(short | low, "unknown").otherwise(code)).withColumn(confidence, sure).drop("_words", "_n", "_hits", "_best", "_ratio")


def reasonable(text: Column, least: int = 50, most: int = 200_000, ascii_share: float = 0.6) -> Column:
    """Whether a text has a plausible length and is mostly plain characters."""
    return F.coalesce(F.length(text).between(least, most) & (ascii_ratio(text) >= ascii_share), F.lit(False))


def noise_line(line: Column) -> Column:
    """Whether a line is a bot wall, a reference id, a run of page counters or mostly digits."""
    low = F.lower(line)
    digits, letters = F.regexp_count(line, F.lit("[0-9]")), F.regexp_count(line, F.lit(r"\p{L}"))
    return (
        (F.trim(line) == "")
        | low.rlike(NOISE)
        | low.rlike(r"reference id[:\s-]*[a-z0-9-]{6,}")
        | (F.regexp_count(low, F.lit(r"page\s+[0-9]+\s+of\s+[0-9]+")) >= 2)
        | ((digits >= 12) & (letters <= digits))
    )


def without_symbols(text: Column) -> Column:
    """Slashes, backslashes and white space as single blanks; page counters in a row and reference ids dropped."""
    plain = F.regexp_replace(text, r"[\\/\n\r\t]", " ")
    plain = F.regexp_replace(plain, r"(?i)(?:page\s+[0-9]+\s+of\s+[0-9]+[\s,;:]*){2,}", " ")
    plain = F.regexp_replace(plain, r"(?i)reference id[:\s-]*[a-z0-9-]{6,}", " ")
    return collapsed(plain)


def sentences(text: Column) -> Column:
    """Sentences: split after . ! ? before white space, and at line breaks."""
    marked = F.regexp_replace(text, r"([.!?])[\s\x{A0}]+", "$1\n")
    return F.filter(F.transform(F.split(marked, "\n"), lambda s: F.trim(s)), lambda s: s != "")


def ngrams(words: Column, n: int) -> Column:
    """All runs of ``n`` consecutive words, joined by a blank.

    Made by zipping the array with itself shifted, so each word is touched ``n`` times.
    """
    grams = words
    for k in range(1, n):
        left = F.slice(grams, F.lit(1), F.greatest(F.size(words) - k, F.lit(0)))
        right = F.slice(words, F.lit(k + 1), F.greatest(F.size(words) - k, F.lit(0)))
        grams = F.zip_with(left, right, lambda x, y: F.concat(x, F.lit(" "), y))
    return grams


def title_of(text: Column, most: int = 120) -> Column:
    """The first line that may be a title: four characters at least and no page chrome."""
    fit = F.filter(lines_of(text), lambda s: (F.length(s) >= 4) & ~F.lower(s).rlike(TITLE_NOISE))
    return F.coalesce(F.rtrim(F.substring(F.try_element_at(fit, F.lit(1)), 1, most)), F.lit(""))


# Formats of personal details that only need telling, not finding.
EMAIL = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}"
PHONE = r"(?:^|[^0-9])(?:\+?1[ .-])?\(?[0-9]{3}\)?[ .-]?[0-9]{3}[ .-]?[0-9]{4}(?:[^0-9]|$)"
ADDRESS = r"(?i)(?:^|[^0-9A-Za-z])[0-9]{1,6} [A-Za-z]+(?: [A-Za-z]+){0,3} (?:st|street|ave|avenue|rd|road|blvd|boulevard|ln|lane|dr|drive)(?:[^A-Za-z]|$)"


def contains_email(text: Column) -> Column:
    return F.coalesce(text.rlike(EMAIL), F.lit(False))


def contains_phone(text: Column) -> Column:
    return F.coalesce(text.rlike(PHONE), F.lit(False))


def contains_address(text: Column) -> Column:
    return F.coalesce(text.rlike(ADDRESS), F.lit(False))
