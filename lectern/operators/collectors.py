"""What collectors make of the responses of public services: filter, project, order, cut, and say in words.

A collector is declared by the shape of its service's response, where in it the items
stand, whom an item must name to be the person's, what is kept of it, and how many.
Responses are rows (profile_id, name, source, payload as JSON); each is worked on within
its row. Nothing is fetched.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lectern.functions import persons as P
from lectern.functions.text import distinct_by, let

#: Columns that shapes are written in: what one item of any service tells.
ITEM = "id string, title string, abstract string, author string, metric int, date string, url string, doi string, place string"


def _all(*parts: Column) -> Column:
    return F.concat_ws(" ", *[F.coalesce(p, F.lit("")) for p in parts])


@dataclass(frozen=True)
class Collector:
    """A service's response and what is taken from it."""

    source: str
    #: Expressions of one item and of the whole response (over ``items``): the shape, and with it the schema.
    item: str
    whole: str
    #: Where the items stand.
    path: str
    #: Output names and expressions over ``r``, an item.
    fields: dict[str, str]
    #: The text of an item that must name the person, and how: "last", "last_first3", "names" (an array of names), "any_last", "mentions", "all" (no test).
    named: Callable[[Column], Column] = field(default=lambda r: F.lit(""))
    rule: str = "all"
    unique: str | None = None
    order: str | None = None
    most: int | None = None
    #: A field to add up.
    total: str | None = None


def _named(c: Collector, r: Column, first: Column, last: Column, name: Column) -> Column:
    said = c.named(r)
    if c.rule == "last":
        return (last != "") & P.normalized(said).contains(last)
    if c.rule == "last_first3":
        return P.in_authors(said, first, last)
    if c.rule == "names":
        return F.coalesce(F.exists(said, lambda a: P.names_match(first, last, a)), F.lit(False))
    if c.rule == "any_last":
        return P.author_among(said, last)
    if c.rule == "instructor":
        return F.coalesce(F.exists(said, lambda a: P.names_match(first, last, a) | P.names_match_loosely(first, last, a)), F.lit(False))
    if c.rule == "mentions":
        return P.mentions([said], name, first, last)
    return F.lit(True)


_A = "array({})".format


def _c(source, item, whole, path, fields, named=lambda r: F.lit(""), rule="all", **more) -> Collector:
    return Collector(source, item, whole, path, dict(f.split(":", 1) for f in fields.split("; ")), named, rule, **more)


COLLECTORS: dict[str, Collector] = {
    c.source: c
    for c in [
        _c("web_search", "named_struct('href', url, 'title', title, 'body', abstract)", "named_struct('results', items)", "results", "url:r.href; title:r.title; snippet:r.body", lambda r: _all(r["title"], r["body"]), "mentions", unique="url", most=60),
        _c("semantic_scholar", "named_struct('paperId', id, 'title', title, 'abstract', abstract, 'year', int(substr(date, 1, 4)), 'citationCount', metric, 'authors', array(named_struct('name', author)))", "named_struct('data', items)", "data", "id:r.paperId; title:r.title; year:r.year; citations:r.citationCount", lambda r: F.transform(r["authors"], lambda a: a["name"]), "names", order="citations", most=100),
        _c("google_scholar", "named_struct('bib', named_struct('title', title, 'pub_year', substr(date, 1, 4), 'venue', place, 'abstract', abstract), 'num_citations', metric)", "named_struct('publications', items)", "publications", "title:r.bib.title; year:r.bib.pub_year; venue:r.bib.venue; citations:r.num_citations", order="citations", most=50),
        _c("opencitations", "named_struct('doi', doi, 'count', string(metric))", "named_struct('counts', items)", "counts", "doi:r.doi; citation_count:try_cast(r.count as int)", order="citation_count", most=30, total="citation_count"),
        _c("nih_grants", "named_struct('project_num', id, 'project_title', title, 'abstract_text', abstract, 'fiscal_year', int(substr(date, 1, 4)), 'award_amount', metric, 'organization', named_struct('org_name', place), 'principal_investigators', array(named_struct('full_name', author)))", "named_struct('results', items)", "results", "project_num:r.project_num; title:trim(r.project_title); fiscal_year:r.fiscal_year; amount:coalesce(r.award_amount, 0); organization:r.organization.org_name", lambda r: F.transform(r["principal_investigators"], lambda a: a["full_name"]), "names", order="amount", total="amount"),
        _c("patentsview", "named_struct('patent_id', id, 'patent_title', title, 'patent_abstract', abstract, 'patent_date', date, 'inventors', array(named_struct('name', author)), 'assignees', array(named_struct('assignee_organization', place)))", "named_struct('patents', items)", "patents", "patent_id:r.patent_id; title:r.patent_title; date:r.patent_date; assignees:r.assignees.assignee_organization", lambda r: F.transform(r["inventors"], lambda a: a["name"]), "any_last"),
        _c("unpaywall", "named_struct('doi', doi, 'title', title, 'year', int(substr(date, 1, 4)), 'is_oa', metric % 2 = 0, 'best_oa_location', named_struct('url', url, 'host_type', place))", "named_struct('works', items)", "works", "doi:r.doi; title:r.title; year:r.year; is_oa:r.is_oa; best_oa_url:r.best_oa_location.url", unique="doi"),
        _c("biorxiv", "named_struct('doi', doi, 'title', title, 'abstract', abstract, 'authors', author, 'date', date, 'category', place)", "named_struct('collection', items)", "collection", "doi:r.doi; title:r.title; date:r.date; category:r.category", lambda r: r["authors"], "last_first3", unique="doi"),
        _c("core_api", "named_struct('id', id, 'title', title, 'abstract', abstract, 'yearPublished', int(substr(date, 1, 4)), 'doi', doi, 'downloadUrl', url, 'authors', array(named_struct('name', author)))", "named_struct('results', items)", "results", "id:r.id; title:r.title; abstract:substr(r.abstract, 1, 1500); year:r.yearPublished; doi:r.doi", lambda r: F.array_join(F.transform(r["authors"], lambda a: a["name"]), " "), "last"),
        _c("huggingface", "named_struct('id', id, 'author', author, 'downloads', metric, 'likes', metric % 7, 'pipeline_tag', place)", "named_struct('models', items)", "models", "id:r.id; author:r.author; downloads:r.downloads; likes:r.likes", lambda r: r["author"], "last", most=25),
        _c("zenodo", "named_struct('id', id, 'metadata', named_struct('doi', doi, 'title', title, 'description', abstract, 'publication_date', date, 'creators', array(named_struct('name', author))), 'links', named_struct('html', url))", "named_struct('hits', named_struct('hits', items))", "hits.hits", "id:r.id; doi:r.metadata.doi; title:r.metadata.title; description:substr(r.metadata.description, 1, 1500); url:r.links.html", lambda r: F.array_join(F.transform(r["metadata"]["creators"], lambda a: a["name"]), " "), "last"),
        _c("osf", "named_struct('id', id, 'attributes', named_struct('title', title, 'description', abstract, 'category', place, 'date_created', date))", "named_struct('data', items)", "data", "id:r.id; title:r.attributes.title; description:substr(r.attributes.description, 1, 1500); category:r.attributes.category"),
        _c("wikidata", "named_struct('propLabel', named_struct('value', place), 'valueLabel', named_struct('value', title))", "named_struct('results', named_struct('bindings', items))", "results.bindings", "property:r.propLabel.value; value:r.valueLabel.value"),
        _c("rate_my_professor", "named_struct('node', named_struct('id', id, 'name', author, 'department', place, 'avgRating', metric / 1000, 'numRatings', metric))", "named_struct('data', named_struct('newSearch', named_struct('teachers', named_struct('edges', items))))", "data.newSearch.teachers.edges", "id:r.node.id; department:r.node.department; num_ratings:r.node.numRatings", lambda r: F.array(r["node"]["name"]), "names", most=1),
        _c("campus_news", "named_struct('title', named_struct('rendered', title), 'excerpt', named_struct('rendered', abstract), 'link', url, 'date', date)", "named_struct('posts', items)", "posts", "title:r.title.rendered; excerpt:substr(r.excerpt.rendered, 1, 500); url:r.link; date:substr(r.date, 1, 10)", lambda r: _all(r["title"]["rendered"], r["excerpt"]["rendered"]), "mentions", unique="url", most=30),
        _c("gdelt", "named_struct('title', title, 'url', url, 'domain', place, 'seendate', date)", "named_struct('articles', items)", "articles", "title:r.title; url:r.url; domain:r.domain; seen_date:r.seendate"),
        _c("youtube_transcripts", "named_struct('video_id', id, 'text', abstract)", "named_struct('videos', items)", "videos", "video_id:r.video_id; transcript:substr(r.text, 1, 15000); length_chars:length(r.text)", unique="video_id", most=20),
        _c("orcid", "named_struct('title', title, 'type', place, 'year', substr(date, 1, 4), 'doi', doi)", "named_struct('works', items)", "works", "title:r.title; type:r.type; year:r.year; doi:r.doi", most=80),
        _c("openalex", "named_struct('id', id, 'title', title, 'publication_year', int(substr(date, 1, 4)), 'cited_by_count', metric, 'doi', doi, 'venue', place)", "named_struct('results', items)", "results", "title:r.title; year:r.publication_year; cited_by_count:r.cited_by_count; doi:r.doi; venue:r.venue", order="cited_by_count", most=100, total="cited_by_count"),
        _c("crossref", "named_struct('DOI', doi, 'title', array(title), 'container-title', array(place), 'is-referenced-by-count', metric, 'abstract', abstract, 'author', array(named_struct('name', author)))", "named_struct('message', named_struct('items', items))", "message.items", "doi:r.DOI; title:try_element_at(r.title, 1); journal:try_element_at(r.`container-title`, 1); citation_count:r.`is-referenced-by-count`; abstract:substr(r.abstract, 1, 800)", lambda r: F.transform(r["author"], lambda a: a["name"]), "names", order="citation_count"),
        _c("nsf_grants", "named_struct('id', id, 'title', title, 'abstractText', abstract, 'startDate', date, 'fundsObligatedAmt', string(metric), 'pi', author, 'awardeeName', place)", "named_struct('response', named_struct('award', items))", "response.award", "award_id:r.id; title:r.title; amount:coalesce(try_cast(regexp_replace(r.fundsObligatedAmt, '[^0-9.]', '') as int), 0); institution:r.awardeeName", lambda r: F.array(r["pi"]), "names", order="amount", total="amount"),
        _c("usaspending", "named_struct('Award ID', id, 'Description', concat(author, ' ', title), 'Award Amount', metric, 'Awarding Agency', place)", "named_struct('results', items)", "results", "award_id:r.`Award ID`; amount:coalesce(r.`Award Amount`, 0); agency:r.`Awarding Agency`; description:r.Description", lambda r: r["Description"], "last", total="amount"),
        _c("clinicaltrials", "named_struct('protocolSection', named_struct('identificationModule', named_struct('nctId', id, 'briefTitle', title), 'statusModule', named_struct('overallStatus', place), 'descriptionModule', named_struct('briefSummary', abstract), 'contactsLocationsModule', named_struct('overallOfficials', array(named_struct('name', author)))))", "named_struct('studies', items)", "studies", "nct_id:r.protocolSection.identificationModule.nctId; title:r.protocolSection.identificationModule.briefTitle; status:r.protocolSection.statusModule.overallStatus", lambda r: F.array_join(F.transform(r["protocolSection"]["contactsLocationsModule"]["overallOfficials"], lambda a: a["name"]), " "), "last"),
        _c("arxiv", "named_struct('id', url, 'title', title, 'summary', abstract, 'published', date, 'authors', array(author), 'category', place)", "named_struct('entries', items)", "entries", "arxiv_id:substring_index(r.id, '/', -1); title:trim(r.title); published:r.published; category:r.category", lambda r: r["authors"], "any_last"),
        _c("pmc_oa", "named_struct('pmcid', id, 'title', title, 'abstract', abstract)", "named_struct('articles', items)", "articles", "pmcid:r.pmcid; title:substr(r.title, 1, 300); abstract:substr(r.abstract, 1, 4000)"),
        _c("github", "named_struct('name', title, 'description', abstract, 'stargazers_count', metric, 'fork', metric % 5 = 0, 'html_url', url)", "named_struct('repos', items)", "repos", "name:r.name; stars:r.stargazers_count; url:r.html_url", order="stars", most=15),
        _c("paperswithcode", "named_struct('id', id, 'title', title, 'abstract', abstract, 'authors', array(author), 'url_abs', url)", "named_struct('results', items)", "results", "id:r.id; title:r.title; abstract:substr(r.abstract, 1, 1500); url_abs:r.url_abs", lambda r: F.array_join(r["authors"], " "), "last"),
        _c("figshare", "named_struct('id', id, 'title', title, 'doi', doi, 'url_public_html', url, 'authors', array(named_struct('full_name', author)))", "named_struct('items', items)", "items", "id:r.id; title:r.title; doi:r.doi; url:r.url_public_html", lambda r: F.array_join(F.transform(r["authors"], lambda a: a["full_name"]), " "), "last"),
        _c("altmetric", "named_struct('doi', doi, 'title', title, 'score', metric, 'details_url', url)", "named_struct('papers', items)", "papers", "doi:r.doi; title:r.title; score:r.score; url:r.details_url", order="score"),
        _c("wikipedia", "named_struct('title', title, 'pageid', id, 'fullurl', url, 'extract', abstract)", "named_struct('query', named_struct('pages', items))", "query.pages", "title:r.title; page_id:r.pageid; url:r.fullurl; extract:substr(r.extract, 1, 8000)", lambda r: _all(r["title"], r["extract"]), "mentions", most=1),
        _c("courses", "named_struct('subject', place, 'catalogNumber', id, 'title', title, 'instructors', array(author))", "named_struct('data', named_struct('courses', items))", "data.courses", "subject:r.subject; catalog_number:r.catalogNumber; title:r.title", lambda r: r["instructors"], "instructor", unique="title"),
        _c("google_news", "named_struct('title', title, 'description', abstract, 'source', place, 'link', url, 'published', date)", "named_struct('articles', items)", "articles", "title:r.title; description:substr(r.description, 1, 500); source:r.source; url:r.link", lambda r: _all(r["title"], r["description"]), "mentions", unique="title", most=40),
        _c("youtube_lectures", "named_struct('id', named_struct('videoId', id), 'snippet', named_struct('title', title, 'description', abstract, 'channelTitle', place, 'publishedAt', date))", "named_struct('items', items)", "items", "video_id:r.id.videoId; title:r.snippet.title; channel:r.snippet.channelTitle; published_at:r.snippet.publishedAt", lambda r: _all(r["snippet"]["title"], r["snippet"]["description"]), "mentions", unique="video_id", most=25),
        _c("expertise", "named_struct('name', named_struct('text', author), 'uuid', id, 'title', title, 'department', place)", "named_struct('items', items)", "items", "uuid:r.uuid; title:r.title; department:r.department", lambda r: F.array(r["name"]["text"]), "names", most=30),
    ]
}


def responses(items: DataFrame, source: str, keys: Sequence[str]) -> DataFrame:
    """(keys, source, payload): items (:data:`ITEM`) as the response of a service, for tests and replays."""
    c = COLLECTORS[source]
    listed = items.select(*keys, F.expr(c.item).alias("_i"), F.col("id").alias("_o")).groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("_o", "_i"))).alias("_l"))
    return listed.select(*keys, F.transform("_l", lambda x: x["_i"]).alias("items")).select(*keys, F.lit(source).alias("source"), F.to_json(F.expr(c.whole)).alias("payload"))


def collected(rows: DataFrame, source: str) -> DataFrame:
    """(profile_id, source, success, items, total, data, raw_text, error) of each response of a source.

    ``rows`` has profile_id, name and payload. A payload that doesn't parse, or in which
    nothing names the person, is a failure with its reason.
    """
    c, spark = COLLECTORS[source], rows.sparkSession
    empty = spark.createDataFrame([], ITEM)
    shape = empty.select(F.array(F.expr(c.item)).alias("items")).select(F.expr(c.whole).alias("w")).schema["w"].dataType
    kept = ", ".join(f"'{k}', {e}" for k, e in c.fields.items())
    ends = P.first_last(F.col("name"))
    read = rows.select("profile_id", "name", ends["first"].alias("first"), ends["last"].alias("last"), F.from_json("payload", shape).alias("d"))
    at = F.col("d")
    for p in c.path.split("."):
        at = at[p]
    # a list that holds a fork or an undescribed repository without stars is no work of the person
    mine = F.filter(F.coalesce(at, F.expr("array()")), lambda r: _named(c, r, F.col("first"), F.col("last"), F.col("name")) & ((~F.coalesce(r["fork"], F.lit(False)) & ((r["stargazers_count"] >= 1) | r["description"].isNotNull())) if source == "github" else F.lit(True)))
    if source in ("opencitations",):
        mine = F.filter(mine, lambda r: F.coalesce(r["count"].try_cast("int"), F.lit(0)) > 0)
    named = read.select("profile_id", "name", mine.alias("mine"))
    made = named.select("profile_id", "name", F.expr(f"transform(mine, r -> named_struct({kept}))").alias("out"))
    out = F.col("out")
    if c.unique:
        out = distinct_by(out, lambda x: x[c.unique])
    whole = let(out, lambda o: F.struct(F.size(o).alias("n"), (F.aggregate(o, F.lit(0).cast("bigint"), lambda a, x: a + F.coalesce(x[c.total], F.lit(0))) if c.total else F.lit(None).cast("bigint")).alias("total"), o.alias("o")))
    step = made.select("profile_id", "name", whole.alias("w")).select("profile_id", "name", "w.n", "w.total", F.col("w.o").alias("out"))
    if c.order:
        ranked = F.array_sort(F.transform("out", lambda x, i: F.struct((-F.coalesce(x[c.order], F.lit(0))).alias("m"), i.alias("i"), x.alias("x"))))
        step = step.withColumn("out", F.transform(ranked, lambda y: y["x"]))
    if c.most:
        step = step.withColumn("out", F.slice("out", 1, c.most))
    title = next((f for f in ("title", "name", "doi", "value", "id", "video_id", "award_id") if f in c.fields), next(iter(c.fields)))
    text = F.concat(F.lit(f"=== {source}: "), "name", F.lit(" ===\nTotal: "), F.col("n").cast("string"), F.lit("\n"), F.array_join(F.transform("out", lambda x: F.concat(F.lit("• "), F.coalesce(x[title].cast("string"), F.lit("")))), "\n"))
    ok = F.col("n") > 0
    return step.select(
        "profile_id", F.lit(source).alias("source"), ok.alias("success"), F.size("out").alias("items"), "total", F.when(ok, F.to_json(F.struct(F.col("n").alias("total"), F.col("out").alias("items")))).alias("data"),
        F.when(ok, text).otherwise("").alias("raw_text"), F.when(~ok, "nothing that names the person").alias("error"),
    )


def dois(results: DataFrame, parents: Sequence[str] = ("openalex", "crossref"), most: int = 40) -> DataFrame:
    """(profile_id, doi, place): the works of the first wave's results whose metrics the second wave asks for, each once, parents in order."""
    rank = F.array_position(F.array(*[F.lit(p) for p in parents]), F.col("source"))
    shape = "struct<items: array<struct<doi: string>>>"
    rows = results.where(F.col("success") & F.col("source").isin(list(parents))).select("profile_id", rank.alias("r"), F.posexplode(F.from_json("data", shape)["items"]).alias("i", "x"))
    one = rows.select("profile_id", "r", "i", F.lower(F.regexp_replace("x.doi", r"^https?://(?:dx\.)?doi\.org/", "")).alias("doi")).where("doi <> ''").groupBy("profile_id", "doi").agg(F.min(F.struct("r", "i")).alias("o"))
    listed = one.groupBy("profile_id").agg(F.slice(F.array_sort(F.collect_list(F.struct("o", "doi"))), 1, most).alias("l"))
    return listed.select("profile_id", F.posexplode("l").alias("place", "x")).select("profile_id", "x.doi", "place")


def cache_key(source: Column, name: Column, profile: Column) -> Column:
    """The key that a successful result is kept under."""
    return F.substring(F.sha2(F.concat_ws(":", source, F.lower(name), profile), 256), 1, 16)
