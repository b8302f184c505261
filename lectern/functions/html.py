"""Column expressions on markup: dropping what isn't content, picking the main part, and facts of a profile page.

They work by expressions, so that pages stay in the JVM; elements nested in their own
kind end at the first end tag.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from lectern.functions.cleaning import lines, spaced
from lectern.functions.text import distinct_by

# Elements that hold no content, and those that start a line.
DROPPED = "script style noscript template svg nav header footer aside form iframe button".split()
BLOCKS = "p|div|li|ul|ol|h[1-6]|br|hr|section|article|main|table|tr|td|th|blockquote|pre|dd|dt"
# Entities that texts often hold.
ENTITIES = {"&nbsp;": " ", "&lt;": "<", "&gt;": ">", "&quot;": '"', "&#39;": "'", "&apos;": "'", "&ndash;": "–", "&mdash;": "—", "&amp;": "&"}


def without_chrome(html: Column) -> Column:
    """Markup without comments and the elements that hold no content."""
    out = F.regexp_replace(F.coalesce(html, F.lit("")), r"(?s)<!--.*?-->", " ")
    for tag in DROPPED:
        out = F.regexp_replace(out, rf"(?is)<{tag}(?:\s[^>]*)?>.*?</{tag}\s*>", " ")
    return out


def main_part(html: Column) -> Column:
    """What stands in ``main``, else in ``article``, else in ``body``, else all of it."""
    clean = without_chrome(html)
    part = lambda tag: F.nullif(F.regexp_extract(clean, rf"(?is)<{tag}(?:\s[^>]*)?>(.*)</{tag}\s*>", 1), F.lit(""))
    return F.coalesce(part("main"), part("article"), part("body"), clean)


def unescaped(text: Column) -> Column:
    out = text
    for entity, plain in ENTITIES.items():
        out = F.replace(out, F.lit(entity), F.lit(plain))
    return out


def text_lines(html: Column) -> Column:
    """The lines of the text of markup: one a block, without empty ones."""
    broken = F.regexp_replace(html, rf"(?i)</?(?:{BLOCKS})(?:\s[^>]*)?/?>", "\n")
    return F.filter(F.transform(lines(unescaped(F.regexp_replace(broken, r"<[^>]+>", ""))), spaced), lambda s: s != "")


def main_text(html: Column) -> Column:
    return F.array_join(text_lines(main_part(html)), "\n")


def headings(html: Column) -> Column:
    """The texts of the headings, in order, each once."""
    found = F.regexp_extract_all(F.coalesce(html, F.lit("")), F.lit(r"(?is)<h[1-6](?:\s[^>]*)?>(.*?)</h[1-6]\s*>"), 1)
    return distinct_by(F.filter(F.transform(found, lambda s: spaced(unescaped(F.regexp_replace(s, r"<[^>]+>", " ")))), lambda s: s != ""), F.lower)


def paragraphs(html: Column) -> Column:
    found = F.regexp_extract_all(F.coalesce(html, F.lit("")), F.lit(r"(?is)<p(?:\s[^>]*)?>(.*?)</p\s*>"), 1)
    return F.filter(F.transform(found, lambda s: spaced(unescaped(F.regexp_replace(s, r"<[^>]+>", " ")))), lambda s: s != "")


def profile_fields(html: Column) -> Column:
    """(name, email, position, department) of a profile page: the first fit heading or the title's first part, the first address, and elements whose class says so."""
    h = F.coalesce(html, F.lit(""))
    plain = lambda s: spaced(unescaped(F.regexp_replace(s, r"<[^>]+>", " ")))
    tops = F.transform(F.regexp_extract_all(h, F.lit(r"(?is)<h[12](?:\s[^>]*)?>(.*?)</h[12]\s*>"), 1), plain)
    fit = F.filter(tops, lambda s: F.length(s).between(3, 119) & ~F.lower(s).rlike("university|college|school of|menu|navigation"))
    title = F.trim(F.regexp_extract(plain(F.regexp_extract(h, r"(?is)<title(?:\s[^>]*)?>(.*?)</title\s*>", 1)), r"^([^|:-]*)", 1))
    by_class = lambda names, most: F.when(F.length(s := plain(F.regexp_extract(h, rf"(?is)<\w+\s[^>]*class\s*=\s*[\"'][^\"']*\b(?:{names})\b[^\"']*[\"'][^>]*>(.*?)</", 1))) < most, s).otherwise("")
    return F.struct(
        F.coalesce(F.try_element_at(fit, F.lit(1)), F.when(F.length(title).between(3, 119), title), F.lit("")).alias("name"), F.regexp_extract(h, r"([A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,})", 1).alias("email"),
        by_class("title|position|rank", 120).alias("position"), by_class("department", 160).alias("department"),
    )
