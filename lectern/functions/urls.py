"""Column expressions on URLs. They don't fail on what isn't a URL."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Query parameters that only track.
TRACKING = "^(utm_|fbclid|gclid|mc_|ref)"
# Hosts that hold no content about a person.
NOISE_HOSTS = "facebook.com instagram.com tiktok.com pinterest.com x.com twitter.com reddit.com quora.com linkedin.com scribd.com msn.com".split()
DOCUMENT = r"\.(pdf|docx?|txt|rtf|odt)(\?|#|$)"

_PARTS = r"^(?:([A-Za-z][A-Za-z0-9+.-]*)://)?([^/?#]*)([^?#]*)(?:\?([^#]*))?"


def _part(url: Column, n: int) -> Column:
    return F.regexp_extract(F.trim(url), _PARTS, n)


def scheme(url: Column) -> Column:
    s = F.lower(_part(url, 1))
    return F.when(s == "", "https").otherwise(s)


def authority(url: Column) -> Column:
    """Host and port in lower case; the default port of the scheme is dropped."""
    at = F.lower(_part(url, 2))
    default = ((scheme(url) == "http") & at.endswith(":80")) | ((scheme(url) == "https") & at.endswith(":443"))
    return F.when(default, F.regexp_replace(at, r":[0-9]+$", "")).otherwise(at)


def path(url: Column) -> Column:
    """The path without a slash at its end; the root stays."""
    p = _part(url, 3)
    cut = F.regexp_replace(p, "/+$", "")
    return F.when(cut == "", "/").otherwise(cut)


def canonical(url: Column) -> Column:
    """One form of each URL for keys: scheme and host in lower case, no default port, fragment or last slash; the query stays."""
    q = _part(url, 4)
    made = F.concat(scheme(url), F.lit("://"), authority(url), path(url), F.when(q == "", "").otherwise(F.concat(F.lit("?"), q)))
    return F.when(url.isNull() | (F.trim(url) == ""), "").otherwise(made)


def source_key(url: Column) -> Column:
    return F.concat(F.lit("src_"), F.sha2(canonical(url), 256))


def crawl_key(url: Column) -> Column:
    """Like :func:`canonical` without ``www.`` and tracking parameters."""
    kept = F.array_join(F.filter(F.split(_part(url, 4), "&"), lambda kv: (kv != "") & ~F.lower(F.regexp_extract(kv, "^([^=]*)", 1)).rlike(TRACKING)), "&")
    made = F.concat(scheme(url), F.lit("://"), F.regexp_replace(authority(url), r"^www\.", ""), path(url), F.when(kept == "", "").otherwise(F.concat(F.lit("?"), kept)))
    return F.when(url.isNull() | (F.trim(url) == ""), "").otherwise(made)


def host(url: Column) -> Column:
    """Host in lower case without port and ``www.``."""
    return F.regexp_replace(F.regexp_replace(F.lower(_part(url, 2)), r":[0-9]+$", ""), r"^www\.", "")


def root_domain(url: Column) -> Column:
    """The last two labels of the host."""
    return F.array_join(F.slice(F.reverse(F.slice(F.reverse(F.split(host(url), r"\.")), 1, 2)), 1, 2), ".")


def under(of: Column, domains: list[str]) -> Column:
    """Whether a host is one of ``domains`` or below one."""
    return F.exists(F.array(*[F.lit(d) for d in domains]), lambda d: (of == d) | of.endswith(F.concat(F.lit("."), d)))


def is_noise(url: Column) -> Column:
    return under(host(url), NOISE_HOSTS)


def priority(of: Column) -> Column:
    """Rank of a host by its last label: edu 50, gov 60, org 70, others 100."""
    return F.when(of == "", 999).when(of.endswith(".edu"), 50).when(of.endswith(".gov"), 60).when(of.endswith(".org"), 70).otherwise(100)


def quality(of: Column) -> Column:
    """-2 for noise, 2 for public and academic endings, 1 for hosts that speak of a university, else 0."""
    return F.when(under(of, NOISE_HOSTS), -2).when(of.rlike(r"\.(gov|edu)$"), 2).when(of.rlike("edu|univ|uni"), 1).otherwise(0)


def category(url: Column) -> Column:
    """What a URL leads to, by the first rule that fits."""
    u = F.lower(url)
    return (
        F.when(url.isNull() | (F.trim(url) == ""), "none")
        .when(u.startswith("mailto:"), "email")
        .when(u.rlike(DOCUMENT), "document")
        .when(u.rlike("/(pub|publications?|papers?|doi)/"), "publication")
        .when(u.rlike("/(search|browse|list|directory)([/?]|$)"), "listing")
        .when(is_noise(url), "social")
        .when(u.rlike("/(people|staff|faculty|profile|cv|lab)/"), "profile")
        .when(u.rlike("/(news|events?|blog)/"), "news")
        .otherwise("other")
    )
