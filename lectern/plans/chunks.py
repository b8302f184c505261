"""Queries that cut texts and work on the pieces."""

from __future__ import annotations

from pyspark.sql import functions as F

from lectern.functions import text as T
from lectern.operators import chunking, dedup, gates
from lectern.plans._base import Registry

R = Registry()

_WINDOWS = r"""w AS (SELECT doc_id, list_filter(string_split(trim(regexp_replace(text, '[\s\x{A0}]+', ' ', 'g')), ' '), lambda x: x <> '') AS w FROM documents WHERE text IS NOT NULL),
    s AS (SELECT doc_id, w, unnest(range(1, len(w) + 1, 277)) AS s FROM w WHERE len(w) > 0),
    c AS (SELECT doc_id, CAST((s - 1) // 277 AS INTEGER) AS chunk_no, w[s:s + 324] AS part FROM s)"""


@R.query(f"WITH {_WINDOWS} SELECT doc_id, chunk_no, CAST(len(part) AS INTEGER) AS words, md5(array_to_string(part, ' ')) AS chunk_md5 FROM c", "documents")
def q23_word_windows(docs):
    return chunking.word_windows(docs).select("doc_id", "chunk_no", "words", F.md5("chunk").alias("chunk_md5"))


@R.query(
    f"""WITH RECURSIVE {_WINDOWS}, k AS (SELECT doc_id, chunk_no AS n, len(part) AS words, row_number() OVER (PARTITION BY doc_id ORDER BY chunk_no) AS r FROM c),
    m AS (SELECT doc_id, n AS chunk_no, words, r FROM k WHERE r = 1
      UNION ALL SELECT k.doc_id, CASE WHEN k.words < 250 AND m.words + k.words <= 400 THEN m.chunk_no ELSE k.n END, CASE WHEN k.words < 250 AND m.words + k.words <= 400 THEN m.words + k.words ELSE k.words END, k.r
      FROM m JOIN k ON k.doc_id = m.doc_id AND k.r = m.r + 1)
    SELECT doc_id, chunk_no, CAST(max(words) AS INTEGER) AS words FROM m GROUP BY doc_id, chunk_no""",
    "documents",
)
def q24_merged_tails(docs):
    return chunking.merged_tail(chunking.word_windows(docs)).select("doc_id", "chunk_no", "words")


@R.query(
    """WITH n AS (SELECT doc_id, text, CASE WHEN length(text) <= 1000 THEN 1 ELSE CAST(ceil((length(text) - 1000) / 880.0) AS INTEGER) + 1 END AS k FROM documents WHERE length(text) > 0),
    s AS (SELECT doc_id, text, unnest(range(0, k)) AS i FROM n) SELECT doc_id, CAST(i AS INTEGER) AS chunk_no, CAST(i * 880 AS INTEGER) AS start, md5(substr(text, i * 880 + 1, 1000)) AS chunk_md5 FROM s""",
    "documents",
)
def q25_char_windows(docs):
    return chunking.char_windows(docs).select("doc_id", "chunk_no", "start", F.md5("chunk").alias("chunk_md5"))


_LISTY = r"""(length(part) < 120 OR (len(l) >= 6 AND len(list_filter(l, lambda s: regexp_matches(s, '^[-*•>|]') OR length(s) < 30)) / greatest(len(l), 1)::DOUBLE >= 0.6)
  OR len(regexp_extract_all(part, '\p{L}')) / greatest(length(part), 1)::DOUBLE < 0.5)"""


@R.query(
    rf"""WITH n AS (SELECT doc_id, text, CASE WHEN length(text) <= 1000 THEN 1 ELSE CAST(ceil((length(text) - 1000) / 880.0) AS INTEGER) + 1 END AS k FROM documents WHERE length(text) > 0),
    s AS (SELECT doc_id, text, unnest(range(0, k)) AS i FROM n), c AS (SELECT doc_id, substr(text, i * 880 + 1, 1000) AS part FROM s),
    d AS (SELECT doc_id, part, list_filter(list_transform(string_split(part, chr(10)), lambda s: trim(regexp_replace(s, '^[\s\x{{A0}}]+|[\s\x{{A0}}]+$', '', 'g'))), lambda s: s <> '') AS l FROM c)
    SELECT doc_id, count(*) AS chunks, count(*) FILTER ({_LISTY}) AS listy FROM d GROUP BY doc_id""",
    "documents",
)
def q26_listy_chunks(docs):
    return chunking.char_windows(docs).groupBy("doc_id").agg(F.count("*").alias("chunks"), F.count_if(chunking.listy(F.col("chunk"))).alias("listy"))


@R.query(
    f"""WITH {_WINDOWS}, h AS (SELECT doc_id, chunk_no, md5(lower(array_to_string(part, ' '))) AS h FROM c),
    f AS (SELECT *, row_number() OVER (PARTITION BY h ORDER BY doc_id, chunk_no) AS r FROM h)
    SELECT doc_id, chunk_no, row_number() OVER (PARTITION BY doc_id ORDER BY chunk_no) - 1 AS place FROM f WHERE r = 1""",
    "documents",
)
def q27_chunk_dedup(docs):
    """The first of equal chunks anywhere, and its place among those its text keeps."""
    from pyspark.sql.window import Window

    hashed = chunking.word_windows(docs).select("doc_id", "chunk_no", F.md5(F.lower("chunk")).alias("h"))
    firsts = dedup.first_by(hashed, ["h"], ["doc_id", "chunk_no"])
    return firsts.select("doc_id", "chunk_no", (F.row_number().over(Window.partitionBy("doc_id").orderBy("chunk_no")) - 1).cast("bigint").alias("place"))


_SENT = r"list_filter(list_transform(string_split(regexp_replace(text, '([.!?])[\s\x{A0}]+', E'\\1\n', 'g'), chr(10)), lambda s: trim(s)), lambda s: s <> '')"


@R.query(f"WITH s AS (SELECT doc_id, {_SENT} AS s FROM documents WHERE text IS NOT NULL) SELECT doc_id, CAST(len(s) AS INTEGER) AS sentences, md5(array_to_string(s, chr(10))) AS joined_md5 FROM s", "documents")
def q28_sentences(docs):
    s = T.sentences(F.col("text"))
    return docs.where("text is not null").select("doc_id", F.size(s).alias("sentences"), F.md5(F.array_join(s, "\n")).alias("joined_md5"))


_HEADS = r"""list_filter(list_transform(a, lambda s, i: struct_pack(line := CAST(i - 1 AS INTEGER), s := trim(replace(s, chr(13), '')))),
  lambda x: x.s <> '' AND len(string_split(x.s, ' ')) <= 5 AND (regexp_matches(x.s, '^#{1,4} ') OR regexp_matches(x.s, '^[^.:]{3,40}:$') OR regexp_matches(x.s, '^[A-Z][A-Z &]{3,40}$')))"""


@R.query(
    rf"""WITH e AS (SELECT DISTINCT id, raw_text FROM extracted_content), a AS (SELECT id, string_split(raw_text, chr(10)) AS a FROM e), h AS (SELECT id, len(a) AS n, {_HEADS} AS h FROM a),
    x AS (SELECT id, n, unnest(range(0, len(h))) AS k, h FROM h),
    s AS (SELECT id, CAST(k AS INTEGER) AS section_no, lower(trim(regexp_replace(h[k + 1].s, '^#+|:$', '', 'g'))) AS heading, h[k + 1].line AS first_line, CAST(coalesce(h[k + 2].line, n) - 1 AS INTEGER) AS last_line FROM x)
    SELECT *, CASE WHEN regexp_matches(heading, 'publication|papers|books') THEN 'publications' WHEN regexp_matches(heading, 'award|honou?r|prize') THEN 'awards'
      WHEN regexp_matches(heading, 'education|degree|parcours|trayectoria|lebenslauf') THEN 'education' WHEN regexp_matches(heading, 'teach|course|lehre|docencia|enseignement') THEN 'teaching'
      WHEN regexp_matches(heading, 'research|project|forschung|investigaci|recherche') THEN 'research' WHEN regexp_matches(heading, 'bio|about|overview|zur person') THEN 'biography'
      WHEN regexp_matches(heading, 'service') THEN 'service' WHEN regexp_matches(heading, 'contact') THEN 'contact' ELSE 'other' END AS kind FROM s""",
    "extracted_content",
)
def q29_sections(pages):
    return chunking.section_spans(pages.select("id", "raw_text").distinct())


@R.query(None, "documents")
def q31_boundary_windows(docs):
    return chunking.boundary_windows(docs)


@R.query(None, "documents")
def q32_chunk_offsets(docs):
    return chunking.offsets(chunking.word_windows(docs), docs)


_MAIN = "m AS (SELECT profile_id, min(profile_name) AS name FROM collected_meta GROUP BY 1)"
_VERBS = "is|was|are|were|served|serves|received|earned|joined|appointed|published|authored|wrote|won|led|founded|graduated|completed|holds|born|studied|taught|directed|edited|translated"


@R.query(
    rf"""WITH {_MAIN}, s AS (SELECT doc_id, lower(trim(coalesce(name, ''))) AS nm, CASE WHEN ends_with(source, '.edu') OR ends_with(source, '.gov') THEN 2 ELSE 0 END AS q, {_SENT} AS s FROM documents d LEFT JOIN m ON d.profile_id = m.profile_id WHERE text IS NOT NULL),
    x AS (SELECT doc_id, nm, q, unnest(range(0, len(s))) AS n, unnest(s) AS c FROM s), f AS (SELECT *, regexp_matches(lower(c), '(^|[^a-z0-9''])({_VERBS})([^a-z0-9'']|$)') AS v, regexp_matches(c, '(^|[^0-9A-Za-z_])(1[6-9]|20)[0-9]{{2}}([^0-9A-Za-z_]|$)') AS y,
      nm <> '' AND (contains(lower(c), nm) OR (coalesce(list_filter(string_split_regex(nm, '\s+'), lambda w: length(w) >= 3)[-1], '') <> '' AND contains(lower(c), list_filter(string_split_regex(nm, '\s+'), lambda w: length(w) >= 3)[-1]))) AS named
      FROM x WHERE length(c) BETWEEN 40 AND 320 AND NOT regexp_matches(lower(c), 'verify you are human|captcha|cloudflare|attention required|access denied|loading\.\.\.|subscribe|sign in to continue|proof of work|anubis|jshelter|shopping basket|shopping cart|site archived|return to top|(^|[^a-z])cookie([^a-z]|$)')),
    g AS (SELECT *, round(0.2::DOUBLE + CASE WHEN named THEN 0.3 ELSE 0 END + CASE WHEN v THEN 0.1 ELSE 0 END + CASE WHEN y THEN 0.1 ELSE 0 END + CASE WHEN q >= 2 THEN 0.1 ELSE 0 END, 3) AS confidence FROM f WHERE (v OR y) AND (nm = '' OR named OR (q > 0 AND v AND y))),
    r AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY n) AS r FROM g WHERE confidence >= 0.4)
    SELECT doc_id, CAST(n AS INTEGER) AS sentence_no, c AS claim, confidence, named, regexp_matches(lower(c), 'award|honor|honorary|prize|medal|fellow|fellowship|laureate|induct') AS about_awards FROM r WHERE r <= 3""",
    "documents",
    "collected_meta",
)
def q33_claims(docs, meta):
    """The first three claims of each text about its person."""
    m = meta.groupBy("profile_id").agg(F.min("profile_name").alias("name"))
    d = docs.join(m, "profile_id", "left")
    quality = F.when(F.col("source").rlike(r"\.(?:edu|gov)$"), 2).otherwise(0)
    found = gates.claims(d, name=F.col("name"), quality=quality)
    return found.select("doc_id", "sentence_no", "claim", "confidence", "named", F.array_contains("tags", "awards").alias("about_awards"))


_INTENT = {
    "speech": [r"\b(speech|remarks|keynote|lecture|address|talk|commencement|fireside)\b", r"\b(prepared remarks|public address|opening remarks)\b"],
    "interview": [r"\b(interview|q&a|q and a|conversation|podcast|oral history)\b", r"\b(fireside chat|sit down with|in conversation with)\b"],
    "paper": [r"\b(working paper|journal|article|doi|abstract|methodology|findings)\b", r"\b(nber|repec|econpapers|ssrn|arxiv)\b"],
    "testimony": [r"\b(testimony|hearing|committee|congressional|statement for the record)\b", r"\b(chrg-|hhrg-|senate hearing|house hearing)\b"],
    "policy_statement": [r"\b(policy statement|position paper|white paper|recommendation|policy report)\b", r"\b(task force|advisory committee|commission report|public policy)\b"],
    "biography": [r"\b(biography|bio|about|profile|awards?|honors?)\b"],
}
_COUNTS = ", ".join(" + ".join(f"len(regexp_extract_all(lower(text), '{p}'))" for p in ps) + f" AS {k}" for k, ps in _INTENT.items())
_RANKED = " UNION ALL ".join(f"SELECT doc_id, {n} AS i, '{k}' AS intent, {k} AS hits FROM t" for n, k in enumerate(_INTENT))


@R.query(f"WITH t AS (SELECT doc_id, {_COUNTS} FROM documents WHERE text IS NOT NULL), u AS ({_RANKED}), r AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY hits DESC, i) AS r FROM u WHERE hits > 0) SELECT doc_id, intent, CAST(hits AS INTEGER) AS hits, CAST(r AS INTEGER) AS place FROM r WHERE r <= 2", "documents")
def q34_intents(docs):
    return gates.top_intents(docs)


_REQ = ["speech", "interview", "paper", "testimony", "policy_statement"]


@R.query(
    f"""WITH t AS (SELECT source, {_COUNTS} FROM documents WHERE text IS NOT NULL), a AS (SELECT source, count(*) AS chunks, count(*) FILTER ({' + '.join(_REQ)} > 0) AS sources, {', '.join(f'count(*) FILTER ({k} > 0) AS {k}' for k in _INTENT)} FROM t GROUP BY 1),
    b AS (SELECT *, list_filter([{', '.join(f"CASE WHEN {k} > 0 THEN '{k}' END" for k in sorted(_REQ))}], lambda x: x IS NOT NULL) AS c, list_filter([{', '.join(f"CASE WHEN {k} > 0 THEN '{k}:' || {k} END" for k in sorted(_INTENT))}], lambda x: x IS NOT NULL) AS n FROM a),
    d AS (SELECT source, chunks, sources, CAST(len(c) AS INTEGER) AS types, array_to_string(c, ',') AS covered, array_to_string(n, ',') AS chunk_counts, CASE WHEN len(c) < 2 THEN 'covered_types_' || len(c) || '_lt_2' WHEN sources < 3 THEN 'accepted_sources_' || sources || '_lt_3' WHEN chunks < 6 THEN 'accepted_chunks_' || chunks || '_lt_6' ELSE '' END AS reason FROM b)
    SELECT *, reason = '' AS passes FROM d""",
    "documents",
)
def q35_intent_summary(docs):
    """What each source covers of the required intents, and whether that is enough."""
    return gates.intent_summary(docs)


def _points(k: str) -> str:
    u = " + ".join(f"CAST(regexp_matches(u, '{p}') AS INTEGER)" for p in _INTENT[k])
    t = " + ".join(f"CAST(regexp_matches(t, '{p}') AS INTEGER)" for p in _INTENT[k])
    hint = {"speech": "speech|remarks|transcript", "interview": "interview|podcast|oral_history", "paper": "publication|paper|journal", "testimony": "testimony|hearing", "policy_statement": "policy|report", "biography": "profile_page|biography"}[k]
    return f"round(greatest(0, least(1, 0.30::DOUBLE * ({u}) + 0.25::DOUBLE * ({t}) + 0.20::DOUBLE * CAST(regexp_matches(k, '{hint}') AS INTEGER) + 0.20::DOUBLE * greatest(q, 0) - CASE WHEN q < 0 THEN 0.25 ELSE 0 END)), 4) AS {k}"


@R.query(
    f"""WITH d AS (SELECT doc_id, lower(coalesce(source, '') || ' ' || coalesce(title, '')) AS u, lower(coalesce(text, '')) AS t, lower(coalesce(section, '')) AS k, CASE WHEN doc_id % 5 = 0 THEN -2 WHEN doc_id % 5 = 1 THEN 1 ELSE 0 END AS q FROM documents),
    s AS (SELECT doc_id, {', '.join(_points(k) for k in _INTENT)} FROM d), b AS (SELECT *, greatest({', '.join(_REQ)}) AS required FROM s)
    SELECT doc_id, required, required >= 0.35 AS gate, CASE WHEN greatest({', '.join(_INTENT)}) <= 0 THEN '' {' '.join(f"WHEN {k} = greatest({', '.join(_INTENT)}) THEN '{k}'" for k in _INTENT)} END AS "primary",
      CASE WHEN required <= 0 THEN 'no_required_intent_match' WHEN required < 0.35 THEN 'low_intent_confidence:' || printf('%.2f', required) ELSE '' END AS reason FROM b""",
    "documents",
)
def q135_source_intents(docs):
    """Each document as a source: points for each intent, and whether it passes."""
    quality = F.when(F.col("doc_id") % 5 == 0, -2).when(F.col("doc_id") % 5 == 1, 1).otherwise(0)
    found = gates.source_intents(docs, "doc_id", F.concat_ws(" ", F.coalesce("source", F.lit("")), F.coalesce("title", F.lit(""))), F.col("text"), F.col("section"), quality)
    return found.select("doc_id", "required", "gate", "primary", "reason")


@R.query(
    rf"""WITH s AS (SELECT doc_id, {_SENT} AS s FROM documents WHERE text IS NOT NULL), x AS (SELECT doc_id, list_filter(list_transform(s, lambda x: trim(regexp_replace(x, '[\s\x{{A0}}]+', ' ', 'g'))), lambda x: length(x) BETWEEN 50 AND 280) AS s FROM s) SELECT doc_id, CAST(len(s) AS INTEGER) AS sentences, md5(array_to_string(s, '|')) AS joined_md5 FROM x""",
    "documents",
)
def q136_mid_sentences(docs):
    s = chunking.mid_sentences(F.col("text"))
    return docs.where("text is not null").select("doc_id", s.alias("s")).select("doc_id", F.size("s").alias("sentences"), F.md5(F.array_join("s", "|")).alias("joined_md5"))


_STEPS = r"s AS (SELECT doc_id, list_filter(list_transform(%s, lambda x: len(list_filter(string_split_regex(x, '[\s\x{A0}]+'), lambda w: w <> ''))), lambda n: n > 0) AS w FROM documents WHERE text IS NOT NULL), x AS (SELECT doc_id, unnest(w) AS n, unnest(range(1, len(w) + 1)) AS r FROM s)" % _SENT


@R.query(
    f"""WITH RECURSIVE {_STEPS}, f AS (SELECT doc_id, r, n AS c, 0 AS k FROM x WHERE r = 1 UNION ALL SELECT x.doc_id, x.r, CASE WHEN f.c + x.n > 400 OR (f.c + x.n >= 325 AND f.c >= 250) THEN x.n ELSE f.c + x.n END, CASE WHEN f.c + x.n > 400 OR (f.c + x.n >= 325 AND f.c >= 250) THEN f.k + 1 ELSE f.k END FROM f JOIN x ON x.doc_id = f.doc_id AND x.r = f.r + 1),
    p AS (SELECT doc_id, k, max(c) AS words FROM f GROUP BY 1, 2), l AS (SELECT *, lag(words) OVER w AS before, lead(k) OVER w IS NULL AS tail FROM p WINDOW w AS (PARTITION BY doc_id ORDER BY k)),
    j AS (SELECT doc_id, CASE WHEN tail AND before IS NOT NULL AND words < 250 AND before + words <= 400 THEN k - 1 ELSE k END AS k, words FROM l) SELECT doc_id, CAST(k AS INTEGER) AS chunk_no, CAST(sum(words) AS INTEGER) AS words FROM j GROUP BY 1, 2""",
    "documents",
)
def q137_section_packs(docs):
    """Sentences of each text packed towards 325 words."""
    return chunking.section_combined(docs).select("doc_id", "chunk_no", "words")


@R.query(
    f"""WITH RECURSIVE y AS (SELECT doc_id, unnest(s) AS s, unnest(range(1, len(s) + 1)) AS r FROM (SELECT doc_id, {_SENT} AS s FROM documents WHERE text IS NOT NULL)), x AS (SELECT doc_id, s, r, len(list_filter(string_split_regex(s, '[\\s\\x{{A0}}]+'), lambda w: w <> '')) AS n FROM y),
    f AS (SELECT doc_id, r, s, n AS c, 0 AS k FROM x WHERE r = 1 UNION ALL SELECT x.doc_id, x.r, x.s, CASE WHEN f.c > 0 AND f.c + x.n > 400 THEN x.n ELSE f.c + x.n END, CASE WHEN f.c > 0 AND f.c + x.n > 400 THEN f.k + 1 ELSE f.k END FROM f JOIN x ON x.doc_id = f.doc_id AND x.r = f.r + 1)
    SELECT doc_id, CAST(k AS INTEGER) AS chunk_no, CAST(max(c) AS INTEGER) AS words, md5(string_agg(s, ' ' ORDER BY r)) AS chunk_md5 FROM f GROUP BY 1, 2""",
    "documents",
)
def q30_sentence_packs(docs):
    """Whole sentences of each text packed up to 400 words."""
    return chunking.sentence_packs(docs).select("doc_id", "chunk_no", "words", F.md5("chunk").alias("chunk_md5"))


def _cut(size: int, rule: str) -> str:
    return f"""WITH RECURSIVE d AS (SELECT doc_id, text, length(text) AS n FROM documents WHERE length(text) > 0), c AS (
      SELECT doc_id, text, n, 0 AS k, 0 AS a, CASE WHEN n <= {size} THEN n ELSE {rule.format(a='0')} END AS b FROM d UNION ALL
      SELECT doc_id, text, n, k + 1, {{next}}, CASE WHEN n - ({{next}}) <= {size} THEN n ELSE {rule.format(a='({next})')} END FROM c WHERE b < n)"""


def _rfind(s: str, a: str, size: int) -> str:
    """0-based place of the last occurrence in the window, -1 without."""
    part = f"substr(text, CAST({a} AS INTEGER) + 1, {size})"
    return f"(CASE WHEN contains({part}, {s}) THEN {size} - length({s}) - (instr(reverse({part}), reverse({s})) - 1) ELSE -1 END)"


_EIGHT = "greatest(" + ", ".join(_rfind(s, "{a}", 1000) for s in ("'. '", "'! '", "'? '", "E'\\n\\n'")) + ")"


@R.query(
    _cut(1000, "{{a}} + CASE WHEN {e} > 700 THEN {e} + 1 ELSE 1000 END".replace("{e}", _EIGHT).replace("{{a}}", "{a}")).replace("{next}", "b")
    + r" SELECT doc_id, CAST(a AS INTEGER) AS start, md5(substr(text, CAST(a AS INTEGER) + 1, CAST(b - a AS INTEGER))) AS chunk_md5 FROM c WHERE regexp_matches(substr(text, CAST(a AS INTEGER) + 1, CAST(b - a AS INTEGER)), '[^\s\x{A0}]')",
    "documents",
)
def q139_seventy_chunks(docs):
    """Windows of 1,000 characters that end with a sentence beyond seven tenths."""
    return chunking.seventy_chunks(docs).select("doc_id", "start", F.md5("chunk").alias("chunk_md5"))


@R.query(None, "extracted_content")
def q140_semantic_chunks(pages):
    return chunking.semantic_chunks(pages.select("id", "raw_text").distinct())


_NARR = r"(?:^|[.\n!?])\s*([A-Z][a-z]+(?:\s+[A-Z][a-z]+){1,3})\s+(?:is|was|wrote|serves?|served|teaches?|taught|argues?|argued|studies|studied|founded|leads?|led|directs?|directed|holds?|earned|graduated|published|received|focuses?|works?|joined)\b"
_OTHER = r"(?:^|[.\n])\s*([A-Z][a-z]+(?:\s+[A-Z][a-z]+)+)\s+(?:was|is|earned|served|founded|published|received|wrote|graduated|holds|completed)\b"


@R.query(
    rf"""WITH e AS (SELECT id, max(raw_text) AS text, min(profile_name) AS name FROM extracted_content WHERE id IS NOT NULL GROUP BY 1), w0 AS (SELECT id, name, list_filter(string_split(trim(regexp_replace(text, '[\s\x{{A0}}]+', ' ', 'g')), ' '), lambda x: x <> '') AS w FROM e WHERE text IS NOT NULL),
    s0 AS (SELECT id, name, w, unnest(range(1, len(w) + 1, 68)) AS s FROM w0 WHERE len(w) > 0), k AS (SELECT id, CAST((s - 1) // 68 AS INTEGER) AS chunk_no, array_to_string(w[s:s + 79], ' ') AS t, lower(trim(coalesce(name, ''))) AS nm, length(id) % 7 = 0 AS low FROM s0),
    p AS (SELECT *, list_filter(string_split(nm, ' '), lambda w: length(w) >= 3) AS p, list_transform(regexp_extract_all(t, '{_NARR}', 1), lambda x: lower(x)) AS ls FROM k), o AS (SELECT *, list_filter(ls, lambda x: NOT contains(x, p[-1]) AND NOT contains(x, nm)) AS o FROM p),
    sj AS (SELECT *, coalesce(nm <> '' AND len(p) > 0 AND (contains(lower(t), nm) OR contains(lower(t), p[-1]) OR (contains(lower(t), p[1]) AND len(list_filter(p[2:], lambda w: contains(lower(t), w))) > 0))
      AND NOT (coalesce(list_max(list_transform(o, lambda x: len(list_filter(o, lambda y: y = x)))), 0) >= 2 AND coalesce(list_max(list_transform(o, lambda x: len(list_filter(o, lambda y: y = x)))), 0) - (len(ls) - len(o)) >= 2), false) AS subject, lower(regexp_extract(t, '{_OTHER}', 1)) AS other FROM o),
    nr AS (SELECT *, chunk_no - coalesce(max(CASE WHEN subject THEN chunk_no END) OVER (PARTITION BY id ORDER BY chunk_no ROWS UNBOUNDED PRECEDING), -10) <= 1 AS near FROM sj)
    SELECT id, chunk_no, subject FROM nr WHERE subject OR (near AND NOT low AND NOT (other <> '' AND NOT contains(nm, other) AND len(list_filter(string_split_regex(other, '\s+'), lambda x: contains(nm, x))) = 0) AND regexp_matches(lower(t), '(^|[^a-z])(he|she|his|her|him|hers)([^a-z]|$)'))""",
    "extracted_content",
)
def q141_subject_chunks(pages):
    """Word windows of each page that are about its person."""
    one = pages.where("id is not null").groupBy("id").agg(F.max("raw_text").alias("raw_text"), F.min("profile_name").alias("name"))
    chunks = chunking.word_windows(one, "id", "raw_text", 80).join(one.select("id", F.coalesce("name", F.lit("")).alias("name")), "id")
    return chunking.subject_chunks(chunks, "id", "name", F.when(F.length("id") % 7 == 0, -1).otherwise(0)).select("id", "chunk_no", "subject")


@R.query(f"WITH {_WINDOWS} SELECT doc_id, chunk_no, true AS found FROM c", "documents")
def q142_offsets_hold(docs):
    """Whether the text between the offsets of each chunk is that chunk."""
    chunks = chunking.word_windows(docs)
    at = chunking.offsets(chunks, docs).join(docs.select("doc_id", "text"), "doc_id").join(chunks, ["doc_id", "chunk_no"])
    part = F.expr("substring(text, start + 1, end - start)")
    return at.select("doc_id", "chunk_no", ((F.col("start") >= 0) & (T.collapsed(part) == F.col("chunk"))).alias("found"))


@R.query("SELECT doc_id, true AS covers, true AS fits, md5(text) AS text_md5 FROM documents WHERE length(text) > 0", "documents")
def q143_boundary_cover(docs):
    """Whether the windows of each text cover it, none longer than stated, and give it again when put together."""
    w = chunking.boundary_windows(docs)
    listed = w.groupBy("doc_id").agg(F.array_sort(F.collect_list(F.struct("chunk_no", "start", "chunk"))).alias("c"))
    zero = F.lit("")
    again = F.aggregate("c", zero, lambda acc, x: F.concat(acc, F.substring(x["chunk"], F.length(acc) - x["start"] + 1, F.length(x["chunk"]))))
    fits = F.forall("c", lambda x: F.length(x["chunk"]) <= 2000)
    return listed.join(docs.select("doc_id", "text"), "doc_id").select("doc_id", (again == F.col("text")).alias("covers"), fits.alias("fits"), F.md5(again).alias("text_md5"))


@R.query(
    """WITH r AS (SELECT profile_context['profile_id'] AS profile_id, CASE length(url) % 3 WHEN 0 THEN 'orcid' WHEN 1 THEN 'openalex' ELSE 'gdelt' END AS source, max(url) AS raw_text, bool_or(status = 'accepted') AS success, bool_or(domain LIKE '%u%') AS fits FROM source_record WHERE profile_context['profile_id'] IS NOT NULL GROUP BY 1, 2),
    t AS (SELECT profile_id, source, raw_text FROM r WHERE success AND fits), a AS (SELECT profile_id, string_agg('--- ' || source || ' ---' || chr(10) || raw_text, E'\\n\\n' ORDER BY CASE source WHEN 'openalex' THEN 1 WHEN 'orcid' THEN 2 ELSE 3 END) AS t FROM t GROUP BY 1),
    m AS (SELECT profile_id, min(profile_name) AS n FROM collected_meta GROUP BY 1)
    SELECT m.profile_id, md5(CASE WHEN a.t IS NULL THEN n ELSE trim(n) || E'\\n\\n' || '=== Enrichment ===' || E'\\n\\n' || trim(a.t) END) AS text_md5 FROM m LEFT JOIN a ON m.profile_id = a.profile_id""",
    "collected_meta",
    "source_record",
)
def q144_enriched_texts(meta, sources):
    """Profiles with the texts of those collectors that are about them, in the order of their worth."""
    n = F.length("url") % 3
    rows = sources.select(F.try_element_at("profile_context", F.lit("profile_id")).alias("profile_id"), F.when(n == 0, "orcid").when(n == 1, "openalex").otherwise("gdelt").alias("source"), "url", "status", "domain").where("profile_id is not null")
    r = rows.groupBy("profile_id", "source").agg(F.max("url").alias("raw_text"), F.bool_or(F.col("status") == "accepted").alias("success"), F.bool_or(F.col("domain").contains("u")).alias("fits"), F.lit("").alias("error"))
    texts = gates.assembled(gates.stripped(r, F.col("fits")), "profile_id", ["openalex", "orcid"])
    m = meta.groupBy("profile_id").agg(F.min("profile_name").alias("n"))
    return gates.with_enrichment(m, texts.withColumnRenamed("text", "t"), "profile_id", "n", "t").select("profile_id", F.md5("n").alias("text_md5"))
