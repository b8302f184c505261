"""Queries that rank, mine, check and stream."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.types import StructType
from pyspark.sql.window import Window

from lectern.functions import text as T
from lectern.operators import asof, mining, retrieval, validation
from lectern.plans._base import Registry
from lectern.sources import read_table
from lectern.streaming import events as S

R = Registry()

_QUERY = ["grain", "storage", "soil", "carbon", "recharge"]
_CONCEPTS = sorted("bus timetabling|crop rotation|fibre lasers|folk metre|grain storage|housing policy|land tenure|lens coating|memory safety|pension reform|plant science|seismic noise|soil carbon|tax compliance".split("|"))


@R.query(
    """WITH v AS (SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
    s AS (SELECT q.vec_id AS query_id, v.vec_id, round(list_dot_product(q.e, v.e) / (sqrt(list_dot_product(q.e, q.e)) * sqrt(list_dot_product(v.e, v.e))), 6) AS score FROM v q JOIN v ON q.vec_id <> v.vec_id WHERE q.vec_id % 20 = 0),
    r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS place FROM s) SELECT query_id, vec_id, score, CAST(place AS INTEGER) AS place FROM r WHERE place <= 10""",
    "embeddings",
)
def q51_cosine_top_k(vectors):
    """The ten nearest vectors of each stated query: the rows whose id is divisible by 20."""
    return retrieval.cosine_top_k(vectors, vectors.where("vec_id % 20 = 0").select("vec_id", "embedding"), 10)


@R.query(
    r"""WITH a AS (SELECT doc_id, list_distinct(list_filter(regexp_extract_all(lower(text), '[\p{L}\p{N}_]+'), lambda w: length(w) >= 5)) AS w FROM documents WHERE text IS NOT NULL),
    b AS (SELECT item_id, list_distinct(list_filter(regexp_extract_all(lower(item_text), '[\p{L}\p{N}_]+'), lambda w: length(w) >= 5)) AS v FROM eval_item WHERE item_text IS NOT NULL),
    x AS (SELECT doc_id, len(w) AS n, unnest(w) AS t FROM a), y AS (SELECT item_id, len(v) AS m, unnest(v) AS t FROM b),
    h AS (SELECT doc_id, item_id, count(*) AS hits, any_value(n) AS n, any_value(m) AS m FROM x JOIN y ON x.t = y.t GROUP BY 1, 2),
    k AS (SELECT doc_id, item_id, hits, round(0.75::DOUBLE * (hits / n::DOUBLE) + 0.25::DOUBLE * hits / m, 6) AS score FROM h WHERE hits >= 6 OR hits / n::DOUBLE >= 0.12::DOUBLE),
    r AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY score DESC, hits DESC, item_id) AS place FROM k) SELECT doc_id, item_id, hits, score, CAST(place AS INTEGER) AS place FROM r WHERE place <= 3""",
    "documents",
    "eval_item",
)
def q52_provenance_top3(docs, items):
    """The three passages that share the most words with each document."""
    return retrieval.overlap_top(docs, items, "doc_id", "item_id", "text", "item_text")


_LEX = f"(0.7::DOUBLE * (len(list_intersect(list_distinct(w), {_QUERY})) / {len(_QUERY)}::DOUBLE) + 0.3::DOUBLE * least(len(list_filter(w, lambda x: list_contains({_QUERY}, x))), 8) / 8)"


@R.query(
    rf"""WITH t AS (SELECT doc_id, published_at, regexp_extract_all(lower(text), '[\p{{L}}\p{{N}}_]+') AS w FROM documents WHERE text IS NOT NULL),
    s AS (SELECT doc_id, {_LEX} AS lexical, exp(-greatest(coalesce(date_diff('second', published_at, TIMESTAMP '2026-01-01 00:00:00') / 3600::DOUBLE, 20000), 0) / 8760) AS recent FROM t)
    SELECT doc_id, round(lexical, 6) AS lexical, round(recent, 6) AS recent, round(0.75::DOUBLE * lexical + 0.25::DOUBLE * recent, 6) AS score FROM s WHERE lexical > 0 ORDER BY score DESC, doc_id LIMIT 50""",
    "documents",
)
def q53_hybrid_rank(docs):
    """The fifty best documents for a stated topic, by words and recency at a stated time."""
    age = F.coalesce((F.lit("2026-01-01 00:00:00").cast("timestamp").cast("double") - F.floor(F.col("published_at").cast("timestamp").cast("double"))) / 3600, F.lit(20000.0))
    scored = docs.where("text is not null").select("doc_id", retrieval.lexical_score(T.tokens(F.col("text")), _QUERY).alias("lexical"), retrieval.recency(age, 8760.0).alias("recent")).where("lexical > 0")
    out = scored.select("doc_id", F.round("lexical", 6).alias("lexical"), F.round("recent", 6).alias("recent"), F.round(0.75 * F.col("lexical") + 0.25 * F.col("recent"), 6).alias("score"))
    return out.orderBy(F.col("score").desc(), "doc_id").limit(50)


@R.query(
    """WITH n AS (SELECT vec_id, label, sqrt(list_dot_product(embedding::DOUBLE[], embedding::DOUBLE[])) AS x FROM embeddings)
    SELECT vec_id, label, round(CASE WHEN max(x) OVER w > min(x) OVER w THEN (x - min(x) OVER w) / (max(x) OVER w - min(x) OVER w) ELSE 0 END, 4) AS scaled FROM n WINDOW w AS (PARTITION BY label)""",
    "embeddings",
)
def q54_min_max(vectors):
    """Lengths of vectors scaled to 0..1 within their label; bounds come from an aggregate, so a hot label is no hot task."""
    lengths = vectors.select("vec_id", "label", retrieval.norm(F.col("embedding")).alias("x"))
    bounds = lengths.groupBy("label").agg(F.min("x").alias("lo"), F.max("x").alias("hi"))
    scaled = F.when(F.col("hi") > F.col("lo"), (F.col("x") - F.col("lo")) / (F.col("hi") - F.col("lo"))).otherwise(0.0)
    return lengths.join(bounds, "label").select("vec_id", "label", F.round(scaled, 4).alias("scaled"))


@R.query(
    r"""WITH t AS (SELECT doc_id, list_filter(regexp_extract_all(lower(text), '[\p{L}\p{N}_]+'), lambda w: length(w) >= 4) AS w FROM documents WHERE text IS NOT NULL),
    g AS (SELECT doc_id, w[i] || ' ' || w[i + 1] AS phrase FROM (SELECT doc_id, w, unnest(range(1, len(w))) AS i FROM t)),
    c AS (SELECT phrase, count(DISTINCT doc_id) AS docs, count(*) AS hits FROM g GROUP BY 1)
    SELECT phrase, docs, hits, round(hits * ln(((SELECT count(*) FROM documents) + 1.0::DOUBLE) / (docs + 1.0::DOUBLE)), 4) AS weight FROM c WHERE docs >= 3""",
    "documents",
)
def q55_phrases(docs):
    return mining.phrases(docs)


@R.query(
    f"""WITH c AS (SELECT doc_id, list_sort(list_filter({_CONCEPTS}, lambda c: contains(lower(text), c))) AS c FROM documents WHERE text IS NOT NULL),
    p AS (SELECT doc_id, unnest(c) AS a, c FROM c), q AS (SELECT doc_id, a, unnest(c) AS b FROM p) SELECT a, b, count(*) AS docs FROM q WHERE a < b GROUP BY 1, 2""",
    "documents",
)
def q56_concept_pairs(docs):
    return mining.concept_pairs(docs, _CONCEPTS)


@R.query(None, "documents")
def q57_kmeans_topics(docs):
    return mining.kmeans_topics(docs)


@R.query(None, "documents")
def q58_lda_topics(docs):
    return mining.lda_topics(docs)


@R.query(None, "documents")
def q59_nmf_topics(docs):
    return mining.nmf_topics(docs)


_SENT = r"list_filter(list_transform(string_split(regexp_replace(text, '([.!?])[\s\x{A0}]+', E'\\1\n', 'g'), chr(10)), lambda s: trim(s)), lambda s: s <> '')"


@R.query(
    rf"""WITH s AS (SELECT source, {_SENT} AS s, regexp_extract_all(lower(text), '[\p{{L}}\p{{N}}_]+') AS w FROM documents WHERE text IS NOT NULL),
    a AS (SELECT source, CAST(sum(len(s)) AS BIGINT) AS sentences, sum(len(w)) / greatest(sum(len(s)), 1)::DOUBLE AS per, CAST(sum(len(list_filter(w, lambda x: x IN ('because', 'although', 'whereas', 'unless', 'since', 'while', 'provided')))) AS BIGINT) AS connectors FROM s GROUP BY 1)
    SELECT source, sentences, round(per, 4) AS words_per_sentence, CASE WHEN per < 16 THEN 'short' WHEN per < 26 THEN 'medium' ELSE 'long' END AS cadence, connectors FROM a""",
    "documents",
)
def q60_style_profile(docs):
    """How long the sentences of each source are, and how often clauses are joined."""
    words = T.tokens(F.col("text"))
    joined = F.size(F.filter(words, lambda w: w.isin("because", "although", "whereas", "unless", "since", "while", "provided")))
    one = docs.where("text is not null").select("source", F.size(T.sentences(F.col("text"))).alias("s"), F.size(words).alias("w"), joined.alias("c"))
    per = F.sum("w") / F.greatest(F.sum("s"), F.lit(1))
    a = one.groupBy("source").agg(F.sum("s").alias("sentences"), per.alias("per"), F.sum("c").alias("connectors"))
    return a.select("source", "sentences", F.round("per", 4).alias("words_per_sentence"), F.when(F.col("per") < 16, "short").when(F.col("per") < 26, "medium").otherwise("long").alias("cadence"), "connectors")


_ART = "(SELECT doc_id, text || ' [' || (doc_id - 1) || '] as noted.' || chr(10) || chr(10) || coalesce(title, 'untitled') || ' follows [' || (doc_id // 2) || '].' AS body FROM documents WHERE text IS NOT NULL)"
_TOK4 = r"list_distinct(list_filter(regexp_extract_all(lower({0}), '[\p{{L}}\p{{N}}_]+'), lambda w: length(w) >= 4))"


@R.query(
    rf"""WITH a AS {_ART}, p AS (SELECT doc_id, list_filter(list_transform(string_split_regex(body, '\n\s*\n'), lambda s: trim(s)), lambda s: s <> '') AS p FROM a),
    x AS (SELECT doc_id, CAST(unnest(range(0, len(p))) AS INTEGER) AS n, unnest(p) AS t FROM p),
    c AS (SELECT doc_id, n, {_TOK4.format('t')} AS w, unnest(list_distinct(regexp_extract_all(t, '\[([A-Za-z0-9_:-]{{2,64}})\]', 1))) AS c FROM x),
    k AS (SELECT CAST(doc_id AS VARCHAR) AS c, {_TOK4.format('text')} AS v FROM documents WHERE text IS NOT NULL),
    m AS (SELECT c.doc_id, c.n, len(c.w) AS nw, list_intersect(c.w, coalesce(k.v, [])) AS s FROM c LEFT JOIN k ON c.c = k.c),
    g AS (SELECT doc_id, n, count(*) AS cited, CAST(len(list_distinct(flatten(list(s)))) AS INTEGER) AS shared, max(nw) AS nw FROM m GROUP BY 1, 2)
    SELECT doc_id, n AS paragraph_no, cited, shared, shared < 2 AND shared / greatest(nw, 1)::DOUBLE < 0.02 AS weak FROM g""",
    "documents",
)
def q61_grounding(docs):
    """Paragraphs of made-up articles (each cites its predecessor) and the words they share with what they cite."""
    body = F.concat("text", F.lit(" ["), (F.col("doc_id") - 1).cast("string"), F.lit("] as noted.\n\n"), F.coalesce("title", F.lit("untitled")), F.lit(" follows ["), F.floor(F.col("doc_id") / 2).cast("string"), F.lit("]."))
    articles = docs.where("text is not null").select("doc_id", body.alias("body"))
    return validation.grounding(articles, docs, "doc_id", "doc_id", "body", "text")


_ERR = r"""list_filter([CASE WHEN coalesce(length(trim(title)), 0) < 10 THEN 'short_title' END, CASE WHEN coalesce(length(text), 0) < 500 THEN 'short_article' END,
  CASE WHEN coalesce(len(list_filter(list_transform(string_split_regex(text, '\n\s*\n'), lambda s: trim(s)), lambda s: s <> '')), 0) < 2 THEN 'few_paragraphs' END,
  CASE WHEN NOT coalesce(regexp_matches(text, '[.!?]\s*$'), false) THEN 'open_end' END,
  CASE WHEN coalesce(regexp_matches(lower(text), '(^|[^a-z])(i|my|we) (am|was|have|think)([^a-z]|$)'), false) THEN 'first_person' END], lambda x: x IS NOT NULL)"""


@R.query(f"SELECT doc_id, array_to_string({_ERR}, ',') AS errors FROM documents", "documents")
def q62_structure_checks(docs):
    return docs.select("doc_id", F.array_join(validation.structure_errors(F.col("text"), F.col("title")), ",").alias("errors"))


@R.query(
    f"""WITH e AS (SELECT section, {_ERR} AS e, length(text) AS n, published_at FROM documents), x AS (SELECT section, unnest(e) AS err FROM e), c AS (SELECT section, count(*) AS errors FROM x GROUP BY 1)
    SELECT e.section, count(*) AS docs, count(*) FILTER (len(e) = 0) AS sound, coalesce(any_value(c.errors), 0) AS errors, round(avg(n), 4) AS chars, count(published_at) AS dated
    FROM e LEFT JOIN c ON e.section IS NOT DISTINCT FROM c.section GROUP BY e.section""",
    "documents",
)
def q63_kpi_rollup(docs):
    one = docs.select("section", validation.structure_errors(F.col("text"), F.col("title")).alias("e"), F.length("text").alias("n"), "published_at")
    return one.groupBy("section").agg(F.count("*").alias("docs"), F.count_if(F.size("e") == 0).alias("sound"), F.coalesce(F.sum(F.size("e").cast("bigint")), F.lit(0)).alias("errors"), F.round(F.avg("n"), 4).alias("chars"), F.count("published_at").alias("dated"))


@R.query(
    r"""WITH e AS (SELECT DISTINCT id, raw_text FROM extracted_content), a AS (SELECT id, string_split(raw_text, chr(10)) AS a FROM e), l AS (SELECT id, unnest(a) AS line, CAST(unnest(range(0, len(a))) AS INTEGER) AS line_no FROM a),
    h AS (SELECT id, line_no, trim(regexp_replace(line, '^#+', '')) AS heading FROM l WHERE regexp_matches(line, '^#{2,4} ')), b AS (SELECT id, line_no FROM l WHERE NOT regexp_matches(line, '^#{2,4} ')),
    j AS (SELECT b.id, b.line_no, h.heading FROM b ASOF JOIN h ON b.id = h.id AND b.line_no >= h.line_no) SELECT heading, count(*) AS lines, count(DISTINCT id) AS records FROM j GROUP BY 1""",
    "extracted_content",
)
def q64_asof_heading(pages):
    """Lines by the closest heading above them."""
    under = validation.markdown_sections(pages.select("id", "raw_text").distinct(), "id", "raw_text")
    return under.where("heading is not null").groupBy("heading").agg(F.count("*").alias("lines"), F.countDistinct("id").alias("records"))


@R.query(
    """WITH s AS (SELECT user_id, ts AS a, ts + INTERVAL 6 HOUR AS b, event_id AS span FROM events WHERE event_type = 'purchase') SELECT span, count(*) AS inside, round(sum(value), 2) AS total
    FROM s JOIN events e ON e.user_id = s.user_id AND e.ts >= s.a AND e.ts < s.b GROUP BY 1""",
    "events",
)
def q65_contained_points(events):
    """Events within six hours from each purchase of their user: an interval join by buckets of time."""
    seconds = F.unix_micros(F.col("ts").cast("timestamp"))
    rows = events.select("user_id", "event_id", "event_type", "value", seconds.alias("at"))
    spans = rows.where("event_type = 'purchase'").select("user_id", F.col("event_id").alias("span"), F.col("at").alias("a"), (F.col("at") + 6 * 3_600_000_000).alias("b"))
    hit = asof.contained(rows, spans, ["user_id"], "at", "a", "b", "span", width=6 * 3_600_000_000)
    return hit.groupBy("span").agg(F.count("*").alias("inside"), F.round(F.sum("value"), 2).alias("total"))


# ---------------------------------------------------------------- streams


def _events(spark, d):
    """The event table as a stream, its times as instants."""
    schema: StructType = read_table(spark, d, "events").schema
    return S.file_stream(spark, f"{d}/events*.parquet", schema).withColumn("ts", F.col("ts").cast("timestamp"))


_WHEN = "SELECT CAST(a AS TIMESTAMP) AS start, CAST(b AS TIMESTAMP) AS \"end\", event_type, n, round(total, 2) AS total"
#: Windows that the watermark has closed: those that end an hour or more before the latest row.
_CLOSED = "b <= (SELECT max(ts) - INTERVAL 1 HOUR FROM events)"


def _shown(df):
    return df.select(F.col("start").cast("timestamp_ntz").alias("start"), F.col("end").cast("timestamp_ntz").alias("end"), "event_type", "n", F.round("total", 2).alias("total"))


@R.query(f"WITH w AS (SELECT time_bucket(INTERVAL 1 DAY, ts) AS a, time_bucket(INTERVAL 1 DAY, ts) + INTERVAL 1 DAY AS b, event_type, count(*) AS n, sum(value) AS total FROM events GROUP BY ALL) {_WHEN} FROM w WHERE {_CLOSED}")
def q66_tumbling_stream(spark, d):
    """Days that are over, each given out once; the watermark drops their state."""
    return _shown(S.drained(S.tumbling(_events(spark, d), "ts", "1 day", "1 hour", "event_type")))


@R.query(
    f"""WITH w AS (SELECT time_bucket(INTERVAL 6 HOUR, ts) - i * INTERVAL 6 HOUR AS a, time_bucket(INTERVAL 6 HOUR, ts) - i * INTERVAL 6 HOUR + INTERVAL 12 HOUR AS b, event_type, count(*) AS n, sum(value) AS total
    FROM events, range(0, 2) r(i) GROUP BY ALL) {_WHEN} FROM w WHERE {_CLOSED}"""
)
def q67_sliding_stream(spark, d):
    return _shown(S.drained(S.sliding(_events(spark, d), "ts", "12 hours", "6 hours", "1 hour", "event_type")))


@R.query(
    f"""WITH o AS (SELECT *, CASE WHEN ts - lag(ts) OVER w >= INTERVAL 2 HOUR OR lag(ts) OVER w IS NULL THEN 1 ELSE 0 END AS s FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts)),
    g AS (SELECT *, sum(s) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS k FROM o), x AS (SELECT user_id, min(ts) AS a, max(ts) + INTERVAL 2 HOUR AS b, count(*) AS n FROM g GROUP BY user_id, k)
    SELECT user_id, a AS start, b AS "end", n FROM x WHERE {_CLOSED}"""
)
def q68_session_stream(spark, d):
    found = S.drained(S.sessions(_events(spark, d), "ts", "2 hours", "1 hour", "user_id"))
    return found.select("user_id", F.col("start").cast("timestamp_ntz").alias("start"), F.col("end").cast("timestamp_ntz").alias("end"), "n")


@R.query(
    """WITH h AS (SELECT event_id < (SELECT max(event_id) // 2 FROM events) AS early, * FROM events), w AS (SELECT time_bucket(INTERVAL 1 DAY, ts) AS a, time_bucket(INTERVAL 1 DAY, ts) + INTERVAL 1 DAY AS b, event_type, count(*) AS n, sum(value) AS total FROM h GROUP BY ALL)
    SELECT CAST(a AS TIMESTAMP) AS start, event_type, n, round(total, 2) AS total FROM w WHERE b <= (SELECT max(ts) - INTERVAL 1 DAY FROM events)"""
)
def q153_late_rows_stream(spark, d):
    """Three deliveries, the third of which repeats the first days' rows: they are later than the watermark, so no day counts them twice."""
    import uuid

    from lectern.session import shared_dir

    rows = read_table(spark, d, "events")
    half = rows.agg(F.max("event_id").alias("m"))
    at = f"{shared_dir(spark).rstrip('/')}/lectern/late-{uuid.uuid4().hex}"
    marked = rows.join(F.broadcast(half)).withColumn("early", F.col("event_id") < F.floor(F.col("m") / 2)).drop("m")  # one row
    first = rows.agg(F.min("ts").alias("t"))
    late = rows.join(F.broadcast(first)).where(F.col("ts") < F.col("t") + F.expr("interval 5 days")).drop("t")  # one row
    for n, part in enumerate((marked.where("early").drop("early"), marked.where("not early").drop("early"), late)):
        part.coalesce(1).write.parquet(f"{at}/{n}")
    stream = S.file_stream(spark, f"{at}/*", rows.schema, files_per_batch=1).withColumn("ts", F.col("ts").cast("timestamp"))
    found = S.drained(S.tumbling(stream, "ts", "1 day", "1 day", "event_type"))
    return found.select(F.col("start").cast("timestamp_ntz").alias("start"), "event_type", "n", F.round("total", 2).alias("total"))


@R.query("SELECT DISTINCT user_id, event_type FROM events")
def q69_first_seen_stream(spark, d):
    return S.drained(S.first_seen(_events(spark, d), "ts", "90 days", "user_id", "event_type")).select("user_id", "event_type")


@R.query("SELECT user_id, max(ts) AS ts, CAST(count(*) AS INTEGER) AS version FROM events GROUP BY user_id")
def q70_latest_state_stream(spark, d):
    """The latest row of each user, kept as state with a time to live."""
    out = S.drained(S.latest_state(_events(spark, d), "user_id", "ts", "value", 24 * 365), "update")
    last = out.groupBy("user_id").agg(F.max(F.struct("batch", "ts", "version")).alias("r"))
    return last.select("user_id", F.col("r.ts").cast("timestamp_ntz").alias("ts"), "r.version")


@R.query(
    """WITH k AS (SELECT user_id, max(ts) AS ts FROM events GROUP BY 1) SELECT user_id, ts FROM k WHERE date_diff('microsecond', ts, TIMESTAMP '2024-01-30 00:00:00') <= 72 * 3600000000""",
    "events",
)
def q71_ttl_cache(events):
    """Users whose latest row is no older than 72 hours at a stated time."""
    last = events.groupBy("user_id").agg(F.max("ts").alias("ts"))
    return S.expired(last, F.col("ts"), F.lit("2024-01-30 00:00:00"), 72)


@R.query(
    """WITH s AS (SELECT DISTINCT id, md5(coalesce(raw_text, '')) AS signature, scraped_at FROM extracted_content), m AS (SELECT (min(epoch_us(scraped_at)) + max(epoch_us(scraped_at))) / 2 AS t FROM s)
    SELECT id FROM s, m WHERE NOT EXISTS (SELECT 1 FROM s o WHERE o.id = s.id AND o.signature = s.signature AND epoch_us(o.scraped_at) <= m.t)""",
    "extracted_content",
)
def q72_resume_by_signature(pages):
    """What a run has left that was broken off in the middle of the period."""
    rows = pages.select("id", F.md5(F.coalesce("raw_text", F.lit(""))).alias("signature"), "scraped_at").distinct()
    at = F.unix_micros(F.col("scraped_at").cast("timestamp"))
    ends = rows.agg(((F.min(at) + F.max(at)) / 2).alias("t"))
    done = rows.join(F.broadcast(ends)).where(at <= F.col("t")).drop("t")  # one row
    return S.changed(rows, done, "id", "signature").select("id")


@R.query(
    """WITH e AS (SELECT user_id AS job, ts, CASE event_type WHEN 'purchase' THEN 'done' WHEN 'signup' THEN 'queued' ELSE event_type END AS ev FROM events)
    SELECT job, coalesce(arg_min(ev, ts) FILTER (ev IN ('done', 'failed', 'rejected', 'terminated')), arg_max(ev, struct_pack(a := ts, b := ev))) AS state, count(*) AS steps FROM e GROUP BY 1""",
    "events",
)
def q73_job_states(events):
    mapped = F.when(F.col("event_type") == "purchase", "done").when(F.col("event_type") == "signup", "queued").otherwise(F.col("event_type"))
    return S.job_states(events.select(F.col("user_id").alias("job"), "ts", mapped.alias("ev")), "job", "ts", "ev")


@R.query(
    """WITH o AS (SELECT user_id, event_id, ts, event_type = 'click' AS mark, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS n FROM events),
    f AS (SELECT *, lag(mark) OVER (PARTITION BY user_id ORDER BY n) AS before FROM o) SELECT event_id FROM f WHERE mark OR coalesce(before, false)""",
    "events",
)
def q74_adjacent_keep(events):
    """Rows that are marked, and those right after a marked one."""
    w = Window.partitionBy("user_id").orderBy("ts", "event_id")
    marked = events.select("user_id", "event_id", "ts", (F.col("event_type") == "click").alias("mark"))
    return marked.withColumn("before", F.lag("mark").over(w)).where(F.col("mark") | F.coalesce("before", F.lit(False))).select("event_id")


_VEC = "SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x <> 0)) > 0"
_COS = "list_dot_product({a}, {b}) / (sqrt(list_dot_product({a}, {a})) * sqrt(list_dot_product({b}, {b})))"


@R.query(
    f"""WITH v AS ({_VEC}), s AS (SELECT q.vec_id AS query_id, v.vec_id, round({_COS.format(a='q.e', b='v.e')}, 6) AS score FROM v q JOIN v ON q.vec_id <> v.vec_id AND q.label = v.label WHERE q.vec_id % 20 = 0),
    r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS place FROM s) SELECT query_id, vec_id, score, CAST(place AS INTEGER) AS place FROM r WHERE place <= 5""",
    "embeddings",
)
def q154_filtered_top_k(vectors):
    """The five nearest vectors of each stated query among those of its label."""
    return retrieval.cosine_top_k(vectors, vectors.where("vec_id % 20 = 0").select("vec_id", "embedding", "label"), 5, same="label")


_PW = f"(0.7::DOUBLE * (len(list_intersect(list_distinct(w), {_QUERY})) / {len(_QUERY)}::DOUBLE) + 0.3::DOUBLE * least(1, 8 * len(list_filter(w, lambda x: list_contains({_QUERY}, x))) / greatest(len(w), 1)::DOUBLE))"
_DENSE = f"q AS (SELECT e AS q FROM ({_VEC}) ORDER BY vec_id LIMIT 1), v AS (SELECT vec_id, {_COS.format(a='e', b='q')} AS dense FROM ({_VEC}), q), t AS (SELECT doc_id, section, published_at, regexp_extract_all(lower(text), '[a-z]{{3,}}') AS w FROM documents WHERE text IS NOT NULL)"
_HYB = f"""{_DENSE}, s AS (SELECT doc_id, published_at, dense, {_PW} AS lexical, 1.0::DOUBLE / (1 + least(CASE lower(coalesce(section, '')) WHEN 'about' THEN 0 WHEN 'biography' THEN 0 WHEN 'background_and_work' THEN 1 WHEN 'milestones' THEN 2 WHEN 'publications' THEN 3 WHEN 'misc' THEN 4 ELSE 99 END, 10)) AS prior FROM t LEFT JOIN v ON doc_id = vec_id),
    h AS (SELECT doc_id, round(0.55::DOUBLE * greatest(coalesce(dense, 0), 0) + 0.30::DOUBLE * lexical + 0.15::DOUBLE * prior, 6) AS score, lexical, dense, published_at FROM s ORDER BY score DESC, doc_id LIMIT 40)"""


def _dense(docs, vectors):
    """Documents with the cosine of their vector and the stated one: that of the first vector."""
    good = vectors.where(retrieval.valid_vector(F.col("embedding"), 64))
    asked = good.agg(F.min_by("embedding", "vec_id").alias("_q"))
    v = good.join(F.broadcast(asked)).select(F.col("vec_id").alias("doc_id"), retrieval.cosine(F.col("embedding"), F.col("_q")).alias("dense"))  # one row
    return docs.where("text is not null").join(v, "doc_id", "left")


def _pool(docs, vectors):
    lexical = retrieval.passage_words(F.col("text"), _QUERY)
    rows = _dense(docs, vectors).select("doc_id", "published_at", "dense", lexical.alias("lexical"), retrieval.section_prior(F.coalesce("section", F.lit(""))).alias("prior"))
    scored = rows.select("doc_id", F.round(retrieval.hybrid_score(F.col("dense"), F.col("lexical"), F.col("prior")), 6).alias("score"), "lexical", "dense", "published_at")
    return scored.orderBy(F.col("score").desc(), "doc_id").limit(40)


@R.query(f"WITH {_HYB} SELECT doc_id, score FROM h", "documents", "embeddings")
def q155_hybrid(docs, vectors):
    """The forty best passages by vector, words and section."""
    return _pool(docs, vectors).select("doc_id", "score")


@R.query(f"WITH {_HYB}, b AS (SELECT min(score) AS lo, max(score) AS hi FROM h) SELECT doc_id, round(0.65::DOUBLE * ((score - lo) / greatest(hi - lo, 1e-9)) + 0.35::DOUBLE * (doc_id % 7) / 7, 6) AS blended FROM h, b ORDER BY blended DESC, doc_id LIMIT 10", "documents", "embeddings")
def q156_reranked(docs, vectors):
    """The ten best of that pool after a second judge's word, which enters as a column."""
    pool = _pool(docs, vectors).withColumn("cross", F.col("doc_id") % 7 / 7.0)
    return retrieval.reranked(pool, "score", "cross", 10, "doc_id").select("doc_id", "blended")


@R.query(
    f"""WITH {_DENSE}, s AS (SELECT doc_id, dense, {_PW} AS lexical, published_at FROM t LEFT JOIN v ON doc_id = vec_id) SELECT doc_id, round(0.55::DOUBLE * greatest(coalesce(dense, 0), 0) + 0.35::DOUBLE * lexical + 0.10::DOUBLE * CASE WHEN published_at IS NULL THEN 0.15 ELSE 1.0::DOUBLE / (1 + greatest(date_diff('second', published_at, TIMESTAMP '2026-01-01 00:00:00') / 3600::DOUBLE, 0) / 48) END, 6) AS score FROM s ORDER BY score DESC, doc_id LIMIT 5""",
    "documents",
    "embeddings",
)
def q157_trend_choice(docs, vectors):
    """The five documents that fit a topic best by vector, words and recency."""
    age = (F.lit("2026-01-01 00:00:00").cast("timestamp").cast("double") - F.floor(F.col("published_at").cast("timestamp").cast("double"))) / 3600
    rows = _dense(docs, vectors)
    score = retrieval.trend_score(F.col("dense"), retrieval.passage_words(F.col("text"), _QUERY), age)
    return rows.select("doc_id", F.round(score, 6).alias("score")).orderBy(F.col("score").desc(), "doc_id").limit(5)


@R.query(
    """WITH k AS (SELECT user_id, max(struct_pack(t := ts, i := event_id)) AS x FROM events WHERE date_diff('microsecond', ts, TIMESTAMP '2024-01-30 00:00:00') <= 72 * 3600000000 GROUP BY 1) SELECT user_id, x.i AS event_id FROM k ORDER BY x.t DESC, user_id LIMIT 40""",
    "events",
)
def q158_cache(events):
    """The forty latest keys of a cache that keeps 72 hours."""
    return S.cached(events.select("user_id", "ts", "event_id"), "user_id", "ts", F.lit("2024-01-30 00:00:00"), 72, 40).select("user_id", "event_id")


@R.query(
    """WITH r AS (SELECT user_id, max(CAST(event_type <> 'error' AS INTEGER)) = 1 AND user_id % 3 <> 0 AS success FROM events GROUP BY 1) SELECT user_id, success OR user_id % 2 = 0 AS success, CASE WHEN success THEN 1 WHEN user_id % 2 = 0 THEN 2 ELSE 1 END AS attempt FROM r""",
    "events",
)
def q159_retried(events):
    """Failed keys run again, of which the even ones succeed."""
    results = events.groupBy("user_id").agg(F.bool_or(F.col("event_type") != "error").alias("s")).select("user_id", (F.col("s") & (F.col("user_id") % 3 != 0)).alias("success"), F.lit(1).alias("attempt"))
    return S.retried(results, lambda keys: keys.where("user_id % 2 = 0").select("user_id", F.lit(True).alias("success"), F.lit(2).alias("attempt")), "user_id")


@R.query(
    """WITH v AS (SELECT DISTINCT vec_id AS doc_id FROM embeddings), d AS (SELECT doc_id FROM documents WHERE doc_id IN (SELECT doc_id FROM v)) SELECT doc_id FROM d""",
    "documents",
    "embeddings",
)
def q160_two_stages(docs, vectors):
    """Documents that have a vector, and so may go on to the next store."""
    return S.advanced(docs.select("doc_id"), vectors.select(F.col("vec_id").alias("doc_id")), "doc_id")


@R.query(
    """WITH m AS (SELECT profile_id, min(profile_name) AS n FROM collected_meta WHERE profile_name IS NOT NULL GROUP BY 1), i AS (SELECT d.profile_id, '10.1/' || (doc_id // 2) AS doi, min(CAST(doc_id AS VARCHAR)) AS o, max(n_chars % 997) AS c, row_number() OVER (PARTITION BY d.profile_id ORDER BY max(n_chars % 997) DESC) AS r FROM documents d JOIN m ON d.profile_id = m.profile_id GROUP BY 1, 2)
    SELECT profile_id, count(*) AS works FROM i GROUP BY 1"""
)
def q161_two_waves(spark, d):
    """Works of the first wave's collectors that the second wave asks about: each profile's, once."""
    from lectern.operators import collectors as K
    from lectern.plans.collected import _items
    from lectern.session import stored

    items = _items(spark, d)
    first = lambda i: K.collected(K.responses(i, "openalex", ["profile_id", "name"]), "openalex")
    second = lambda i, one: K.collected(K.responses(i.join(K.dois(one, most=1000).select("profile_id", "doi"), ["profile_id", "doi"], "left_semi"), "unpaywall", ["profile_id", "name"]), "unpaywall")
    found = S.in_two_waves(items, first, second, lambda r: stored(r, "wave"))
    return found.where("source = 'unpaywall'").select("profile_id", F.col("items").cast("bigint").alias("works"))
