"""Queries on URLs, sources and their registry."""

from __future__ import annotations

from pyspark.sql import functions as F

from lectern.functions import times
from lectern.functions import urls as U
from lectern.operators import dedup
from lectern.plans._base import Registry

R = Registry()

_U = r"'^(?:([A-Za-z][A-Za-z0-9+.-]*)://)?([^/?#]*)([^?#]*)(?:\?([^#]*))?'"


def _parts(url: str) -> str:
    """SQL of scheme, authority, path and query of a URL column, as columns s, a, p, q."""
    g = [f"regexp_extract(trim({url}), {_U}, {n})" for n in range(1, 5)]
    s = f"CASE WHEN lower({g[0]}) = '' THEN 'https' ELSE lower({g[0]}) END"
    a = f"CASE WHEN ({s} = 'http' AND lower({g[1]}) LIKE '%:80') OR ({s} = 'https' AND lower({g[1]}) LIKE '%:443') THEN regexp_replace(lower({g[1]}), ':[0-9]+$', '') ELSE lower({g[1]}) END"
    p = f"CASE WHEN regexp_replace({g[2]}, '/+$', '') = '' THEN '/' ELSE regexp_replace({g[2]}, '/+$', '') END"
    return f"{s} AS s, {a} AS a, {p} AS p, {g[3]} AS q, regexp_replace(regexp_replace(lower({g[1]}), ':[0-9]+$', ''), '^www\\.', '') AS host"


_CANON = "CASE WHEN url IS NULL OR trim(url) = '' THEN '' ELSE s || '://' || a || p || CASE WHEN q = '' THEN '' ELSE '?' || q END END"
_KEPT = f"array_to_string(list_filter(string_split(q, '&'), lambda x: x <> '' AND NOT regexp_matches(lower(regexp_extract(x, '^([^=]*)', 1)), '{U.TRACKING}')), '&')"
_CRAWL = rf"CASE WHEN url IS NULL OR trim(url) = '' THEN '' ELSE s || '://' || regexp_replace(a, '^www\.', '') || p || CASE WHEN {_KEPT} = '' THEN '' ELSE '?' || {_KEPT} END END"


@R.query(
    f"WITH u AS (SELECT DISTINCT url FROM source_record), c AS (SELECT url, {_parts('url')} FROM u) SELECT url, {_CANON} AS canonical, {_CRAWL} AS crawl_key, 'src_' || sha256({_CANON}) AS source_key FROM c",
    "source_record",
)
def q13_normalized_urls(sources):
    u = F.col("url")
    return sources.select("url").distinct().select("url", U.canonical(u).alias("canonical"), U.crawl_key(u).alias("crawl_key"), U.source_key(u).alias("source_key"))


@R.query(
    f"""WITH c AS (SELECT url, {_parts('url')} FROM source_record), h AS (SELECT *, array_to_string(list_reverse(list_reverse(string_split(host, '.'))[1:2]), '.') AS root FROM c)
    SELECT root, count(*) AS records, count(DISTINCT host) AS hosts, count(DISTINCT {_CANON}) AS pages FROM h GROUP BY root""",
    "source_record",
)
def q14_root_domains(sources):
    u = F.col("url")
    seen = sources.select(U.root_domain(u).alias("root"), U.host(u).alias("host"), U.canonical(u).alias("page"))
    return seen.groupBy("root").agg(F.count("*").alias("records"), F.countDistinct("host").alias("hosts"), F.countDistinct("page").alias("pages"))


_NOISE = "(" + " OR ".join(f"host = '{h}' OR host LIKE '%.{h}'" for h in U.NOISE_HOSTS) + ")"


@R.query(f"WITH c AS (SELECT url, {_parts('url')} FROM source_record) SELECT count(*) AS records, count(*) FILTER (NOT {_NOISE}) AS kept FROM c", "source_record")
def q15_noise_hosts(sources):
    return sources.agg(F.count("*").alias("records"), F.count_if(~U.is_noise(F.col("url"))).alias("kept"))


@R.query(
    f"""WITH c AS (SELECT DISTINCT profile_context['profile_id'] AS pid, url, {_parts('url')} FROM source_record),
    k AS (SELECT DISTINCT pid, {_CRAWL} AS link, CASE WHEN host = '' THEN 999 WHEN host LIKE '%.edu' THEN 50 WHEN host LIKE '%.gov' THEN 60 WHEN host LIKE '%.org' THEN 70 ELSE 100 END AS rank FROM c),
    r AS (SELECT *, row_number() OVER (PARTITION BY pid ORDER BY rank, length(link), link) AS place FROM k WHERE pid IS NOT NULL AND link <> '')
    SELECT pid AS profile_id, link, rank, CAST(place AS INTEGER) AS place FROM r WHERE place <= 3""",
    "source_record",
)
def q16_best_links(sources):
    """The three best links of each profile: by kind of host, then the shortest."""
    u = F.col("url")
    links = sources.select(F.try_element_at("profile_context", F.lit("profile_id")).alias("profile_id"), U.crawl_key(u).alias("link"), U.priority(U.host(u)).alias("rank"))
    kept = links.where("profile_id is not null and link <> ''").distinct()
    from pyspark.sql.window import Window

    w = Window.partitionBy("profile_id").orderBy("rank", F.length("link"), "link")
    return kept.withColumn("place", F.row_number().over(w)).where("place <= 3").select("profile_id", "link", "rank", "place")


_CATEGORY = rf"""CASE WHEN url IS NULL OR trim(url) = '' THEN 'none' WHEN starts_with(lower(url), 'mailto:') THEN 'email' WHEN regexp_matches(lower(url), '{U.DOCUMENT}') THEN 'document'
  WHEN regexp_matches(lower(url), '/(pub|publications?|papers?|doi)/') THEN 'publication' WHEN regexp_matches(lower(url), '/(search|browse|list|directory)([/?]|$)') THEN 'listing' WHEN {_NOISE} THEN 'social'
  WHEN regexp_matches(lower(url), '/(people|staff|faculty|profile|cv|lab)/') THEN 'profile' WHEN regexp_matches(lower(url), '/(news|events?|blog)/') THEN 'news' ELSE 'other' END"""


@R.query(f"WITH c AS (SELECT url, content, {_parts('url')} FROM source_record) SELECT {_CATEGORY} AS category, count(*) AS records, round(avg(content.text_length), 4) AS text_length FROM c GROUP BY 1", "source_record")
def q17_url_categories(sources):
    return sources.groupBy(U.category(F.col("url")).alias("category")).agg(F.count("*").alias("records"), F.round(F.avg("content.text_length"), 4).alias("text_length"))


_PARSED = """coalesce(try_strptime(t, '%Y-%m-%dT%H:%M:%S.%f%z')::TIMESTAMP, try_strptime(t, '%Y-%m-%dT%H:%M:%S%z')::TIMESTAMP, try_strptime(t, '%Y-%m-%dT%H:%M:%S.%f'), try_strptime(t, '%Y-%m-%dT%H:%M:%S'),
  try_strptime(t, '%Y-%m-%d %H:%M:%S.%f'), try_strptime(t, '%Y-%m-%d %H:%M:%S'), try_strptime(t, '%Y-%m-%d'), try_strptime(t, '%d.%m.%Y %H:%M'), try_strptime(t, '%d/%m/%Y %H:%M'), try_strptime(t, '%m/%d/%Y'),
  try_strptime(regexp_replace(t, ' (GMT|UTC|[+]0000)$', ''), '%d %b %Y %H:%M:%S'))"""


@R.query(
    f"""WITH a AS (SELECT accessed_at, regexp_replace(regexp_replace(trim(accessed_at), 'Z$', '+00:00'), '^[A-Z][a-z]{{2}}, ', '') AS t FROM (SELECT DISTINCT accessed_at FROM source_record))
    SELECT accessed_at, {_PARSED} AS parsed FROM a""",
    "source_record",
)
def q18_access_times(sources):
    return sources.select("accessed_at").distinct().select("accessed_at", times.parsed(F.col("accessed_at")).cast("timestamp_ntz").alias("parsed"))


@R.query(
    """WITH r AS (SELECT DISTINCT source_id, record_version, status, recorded_at FROM source_record), k AS (SELECT source_id, record_version, max(struct_pack(a := recorded_at, b := status)) AS x FROM r GROUP BY ALL)
    SELECT source_id, CAST(row_number() OVER w AS INTEGER) AS version, CAST(CASE WHEN row_number() OVER w > 1 THEN row_number() OVER w - 1 END AS INTEGER) AS supersedes, x.a AS recorded_at
    FROM k WINDOW w AS (PARTITION BY source_id ORDER BY record_version)""",
    "source_record",
)
def q19_registry_versions(sources):
    """The append log numbered anew: one row a version, with the version it supersedes."""
    log = sources.groupBy("source_id", "record_version").agg(F.max(F.struct("recorded_at", "status")).alias("x")).select("source_id", "record_version", "x.recorded_at")
    return dedup.versions(log, "source_id", ["record_version"]).select("source_id", "version", "supersedes", "recorded_at")


@R.query(
    r"""WITH d AS (SELECT doc_id, doc_id % 2 AS batch, md5(lower(trim(regexp_replace(text, '[\s\x{A0}]+', ' ', 'g')))) AS h FROM documents WHERE text IS NOT NULL), f AS (SELECT doc_id, first_value(doc_id) OVER (PARTITION BY h ORDER BY batch, doc_id) AS duplicate_of FROM d) SELECT * FROM f WHERE duplicate_of <> doc_id""",
    "documents",
)
def q22_same_content(docs):
    """Texts of a registry (even ids) and of a new batch (odd ids) that an earlier one has: the registry first, then by id."""
    from lectern.functions.text import text_hash

    rows = docs.where("text is not null").select("doc_id", (F.col("doc_id") % 2).alias("batch"), text_hash(F.col("text")).alias("h"))
    firsts = rows.groupBy("h").agg(F.min(F.struct("batch", "doc_id")).alias("f"), F.count("*").alias("n")).where("n > 1").select("h", F.col("f.doc_id").alias("duplicate_of"))
    return rows.join(firsts, "h").where("duplicate_of <> doc_id").select("doc_id", "duplicate_of")
