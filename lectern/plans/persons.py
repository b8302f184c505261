"""Queries on names of persons and on texts about them."""

from __future__ import annotations

from pyspark.sql import functions as F

from lectern.functions import persons as P
from lectern.plans._base import Registry

R = Registry()


def norm(c: str) -> str:
    return rf"trim(regexp_replace(regexp_replace(strip_accents(lower(coalesce({c}, ''))), '[.,;:''\"()-]', ' ', 'g'), '[\s\x{{A0}}]+', ' ', 'g'))"


def words(c: str) -> str:
    return f"list_filter(string_split({c}, ' '), lambda w: w <> '')"


def first_of(c: str) -> str:
    return f"coalesce(CASE WHEN contains({c}, ',') THEN {words(norm(f'regexp_extract({c}, chr(94) || chr(91) || chr(94) || chr(44) || chr(93) || chr(42) || chr(44) || chr(40) || chr(46) || chr(42) || chr(41), 1)'))}[1] ELSE {words(norm(c))}[1] END, '')"


def last_of(c: str) -> str:
    return f"coalesce(CASE WHEN contains({c}, ',') THEN {words(norm(f'split_part({c}, chr(44), 1)'))}[-1] WHEN len({words(norm(c))}) < 2 THEN '' ELSE {words(norm(c))}[-1] END, '')"


_BANNED = ", ".join(f"'{b}'" for b in "academic african american center college department foundation history institute interview museum news part professor resource school society supplies university www".split())


@R.query(
    rf"""WITH n AS (SELECT DISTINCT scholar_name AS name FROM match_decision WHERE scholar_name IS NOT NULL),
    t AS (SELECT name, CASE WHEN starts_with(name, 'Dr.') THEN 'Dr.' WHEN starts_with(name, 'Dr') THEN 'Dr' WHEN starts_with(name, 'Professor') THEN 'Professor' WHEN starts_with(name, 'Prof.') THEN 'Prof.' ELSE '' END AS title FROM n),
    w AS (SELECT *, list_filter(string_split_regex(trim(CASE WHEN title = '' THEN name ELSE trim(replace(name, title, '')) END), '[\s\x{{A0}}]+'), lambda x: x <> '') AS w,
      trim(regexp_replace(replace(lower(name), '.', ' '), '\s+', ' ', 'g')) AS whole FROM t),
    p AS (SELECT *, regexp_extract_all(whole, '[a-z0-9]+') AS p FROM w),
    v AS (SELECT *, coalesce(p[1], '') AS f, CASE WHEN len(p) >= 2 THEN p[-1] ELSE '' END AS l FROM p)
    SELECT name, title, coalesce(w[1], '') AS first, CASE WHEN len(w) > 2 THEN array_to_string(w[2:len(w) - 1], ' ') ELSE '' END AS middle, CASE WHEN len(w) > 1 THEN w[-1] ELSE '' END AS last,
      CASE WHEN coalesce(w[1], '') <> '' THEN upper(w[1][1]) ELSE '?' END AS monogram, {norm('name')} AS plain, {first_of('name')} AS q_first, {last_of('name')} AS q_last,
      array_to_string(list_filter([whole, CASE WHEN array_to_string(p, ' ') <> whole THEN array_to_string(p, ' ') END, CASE WHEN f <> '' AND l <> '' AND f || ' ' || l NOT IN (whole, array_to_string(p, ' ')) THEN f || ' ' || l END,
        CASE WHEN f <> '' AND l <> '' AND array_to_string(list_append(list_transform(p[1:len(p) - 1], lambda x: x[1]), l), ' ') NOT IN (whole, array_to_string(p, ' '), f || ' ' || l) THEN array_to_string(list_append(list_transform(p[1:len(p) - 1], lambda x: x[1]), l), ' ') END], lambda x: coalesce(x, '') <> ''), '|') AS variants,
      len(regexp_extract_all(trim(name), '[A-Za-z][A-Za-z.''-]*')) BETWEEN 2 AND 5 AND NOT regexp_matches(lower(name), 'https?://|\.com|\.org|\.edu') AND NOT regexp_matches(trim(name), '[;|/\\]| - ')
        AND len(list_filter(regexp_extract_all(trim(name), '[A-Za-z][A-Za-z.''-]*'), lambda x: trim(lower(x), '.') IN ({_BANNED}))) = 0 AND len(list_filter(regexp_extract_all(trim(name), '[A-Za-z][A-Za-z.''-]*'), lambda x: regexp_matches(x, '^[A-Z]'))) >= 2 AS clean,
      len(regexp_extract_all(name, '[A-Za-z]+')) >= 2 AND len(list_filter(regexp_extract_all(name, '[A-Za-z]+'), lambda x: lower(x) IN ('program', 'office', 'department', 'school', 'center', 'centre', 'committee', 'services'))) = 0 AS person FROM v""",
    "match_decision",
)
def q81_name_parts(decisions):
    """Names taken apart, in comparable form, and how else they may be written."""
    name = F.col("name")
    who, parts, ends = P.identity_parts(name), P.name_parts(name), P.first_last(name)
    rows = decisions.select(F.col("scholar_name").alias("name")).where("name is not null").distinct()
    return rows.select(
        "name", parts["title"].alias("title"), parts["first"].alias("first"), parts["middle"].alias("middle"), parts["last"].alias("last"), P.monogram(parts["first"], parts["last"]).alias("monogram"), P.normalized(name).alias("plain"),
        ends["first"].alias("q_first"), ends["last"].alias("q_last"), F.array_join(who["variants"], "|").alias("variants"), P.clean_name(name).alias("clean"), P.person_words(name).alias("person"),
    )


_PAIRS = """pairs AS (SELECT DISTINCT scholar_name AS a, normalized_name AS b FROM match_decision UNION SELECT * FROM (VALUES ('Ann Lee', 'Lee, A.'), ('Jonathan Roe', 'Jon Roe'), ('Ann Lee', 'Bo Lee'), ('José Núñez', 'JOSE NUNEZ'), ('Ann Smith-Jones', 'Ann Smith Jones'), ('Ann Lee', 'Lee,Ann'), ('Ann Lee', 'Lee'), ('Lee', 'Ann Lee'), ('Ann Lee Jr', 'Ann Lee'), ('', 'x'), ('Ann Lee', NULL)) v(a, b))"""
_SAMPLE_PAIRS = [("Ann Lee", "Lee, A."), ("Jonathan Roe", "Jon Roe"), ("Ann Lee", "Bo Lee"), ("José Núñez", "JOSE NUNEZ"), ("Ann Smith-Jones", "Ann Smith Jones"), ("Ann Lee", "Lee,Ann"), ("Ann Lee", "Lee"), ("Lee", "Ann Lee"), ("Ann Lee Jr", "Ann Lee"), ("", "x"), ("Ann Lee", None)]


@R.query(
    rf"""WITH {_PAIRS}, q AS (SELECT a, b, {first_of('a')} AS f, {last_of('a')} AS l, {first_of('b')} AS g, {last_of('b')} AS k, {first_of("replace(b, ',', ', ')")} AS g2, {last_of("replace(b, ',', ', ')")} AS k2 FROM pairs)
    SELECT a, b, l <> '' AND k <> '' AND l = k AND f <> '' AND g <> '' AND (starts_with(f, g) OR starts_with(g, f)) AS strict, l <> '' AND k <> '' AND l = k AS by_last,
      l <> '' AND k2 <> '' AND replace(l, ' ', '') = k2 AND (f = '' OR g2 = '' OR starts_with(f, g2) OR starts_with(g2, f)) AS loose, l <> '' AND k <> '' AND l = k AND f <> '' AND g <> '' AND (starts_with(f, g) OR starts_with(g, f)) AND contains(lower(coalesce(b, '')), 'e') AS at_home FROM q""",
    "match_decision",
)
def q82_names_match(decisions):
    """Typed names against the names that an earlier run made of them."""
    spark = decisions.sparkSession
    rows = decisions.select(F.col("scholar_name").alias("a"), F.col("normalized_name").alias("b")).unionByName(spark.createDataFrame(_SAMPLE_PAIRS, "a string, b string")).distinct()
    q = P.first_last(F.col("a"))
    b, first, last = F.col("b"), q["first"], q["last"]
    return rows.select("a", "b", P.names_match(first, last, b).alias("strict"), P.names_match(first, last, b, False).alias("by_last"), P.names_match_loosely(first, last, b).alias("loose"), P.matches_person(first, last, b, F.array(b), "e", True).alias("at_home"))


_ABOUT = """d AS (SELECT doc_id, text, title, source, m.name FROM documents JOIN (SELECT profile_id, min(profile_name) AS name FROM collected_meta GROUP BY 1) m ON documents.profile_id = m.profile_id WHERE text IS NOT NULL AND m.name IS NOT NULL)"""


def _about(docs, meta):
    m = meta.groupBy("profile_id").agg(F.min("profile_name").alias("name")).where("name is not null")
    return docs.where("text is not null").join(m, "profile_id").select("doc_id", "text", "title", "source", "name")


@R.query(
    rf"""WITH {_ABOUT}, t AS (SELECT *, lower(trim(regexp_replace(text, '[\s\x{{A0}}]+', ' ', 'g'))) AS t, lower(trim(regexp_replace(name, '[\s\x{{A0}}]+', ' ', 'g'))) AS n, {norm('text')} AS nt, {first_of('name')} AS f, {last_of('name')} AS l FROM d),
    p AS (SELECT *, list_filter(regexp_extract_all(n, '[a-z0-9]+'), lambda w: length(w) >= 2) AS p, list_filter(string_split_regex(trim(lower(name)), '\s+'), lambda w: length(w) >= 3) AS w, trim(regexp_replace(replace(n, '.', ' '), '\s+', ' ', 'g')) AS bare FROM t),
    o AS (SELECT *, CASE WHEN w[-1] <> '' THEN (length(text) - length(replace(lower(text), w[-1], ''))) // length(w[-1]) ELSE 0 END AS times, contains(lower(text), trim(lower(name))) AS whole, len(regexp_extract_all(lower(text), '[0-9A-Za-z_]+')) AS words,
      array_to_string(list_append(list_transform(p[1:len(p) - 1], lambda x: x[1]), p[-1]), ' ') AS inits FROM p)
    SELECT doc_id, name, t <> '' AND (n = '' OR contains(t, n) OR (bare <> '' AND contains(t, bare)) OR (len(p) >= 2 AND (regexp_matches(t, '\b' || p[1] || '\b.*\b' || p[-1] || '\b') OR contains(t, inits)))) AS relevant,
      CASE WHEN text = '' OR name = '' OR len(w) = 0 THEN true ELSE (whole OR times >= 2 OR (times >= 1 AND contains(lower(text), w[1])) OR (len(w) > 1 AND contains(lower(text), array_to_string(list_transform(w[1:len(w) - 1], lambda x: x[1]), '.') || '.') AND times >= 1))
        AND (words <= 4000 OR whole OR times >= greatest(2, words // 2500)) END AS about,
      contains({norm('title')} || ' ' || nt, {norm('name')}) OR (contains({norm('title')} || ' ' || nt, f) AND contains({norm('title')} || ' ' || nt, l)) AS mentions,
      text <> '' AND l <> '' AND (contains(nt, ' ' || l || ' ') OR contains(nt, l || ' ')) AND (contains(nt, f || ' ' || l) OR contains(nt, l || ' ' || f) OR f = '' OR contains(nt, f[1] || ' ' || l) OR contains(nt, l || ' ' || f[1]) OR regexp_matches(nt, f || ' [a-z] ' || l)) AND contains(nt, 'university') AS strict,
      CAST(times AS INTEGER) AS times FROM o""",
    "documents",
    "collected_meta",
)
def q83_texts_about_persons(docs, meta):
    """Of each text with a person whether it names them, is about them, and belongs to them."""
    text, name, ends = F.col("text"), F.col("name"), P.first_last(F.col("name"))
    last_word = F.try_element_at(F.filter(F.split(F.trim(F.lower(name)), r"\s+"), lambda w: F.length(w) >= 3), F.lit(-1))
    return _about(docs, meta).select(
        "doc_id", "name", P.relevant(text, name).alias("relevant"), P.about_person(text, name).alias("about"), P.mentions([F.col("title"), text], name, ends["first"], ends["last"]).alias("mentions"),
        P.strict_identity(text, ends["first"], ends["last"], "university").alias("strict"), P.occurrences(F.lower(text), last_word).alias("times"),
    )


_IGNORED = ", ".join(f"'{w}'" for w in P.NOT_NEAR)
_CLASH = "len(list_filter(range(1, len(t) + 1), lambda i: t[i] = l AND len(list_filter([i - 2, i - 1, i + 1, i + 2], lambda j: j >= 1 AND j <= len(t) AND (t[j] = f OR (length(t[j]) <= 2 AND t[j][1] = f[1])))) = 0 AND len(list_filter([i - 2, i - 1, i + 1, i + 2], lambda j: j >= 1 AND j <= len(t) AND length(t[j]) >= 3 AND t[j] NOT IN (%s))) > 0)) > 0" % _IGNORED


@R.query(
    rf"""WITH {_ABOUT}, w AS (SELECT *, trim(regexp_replace(replace(lower(name), '.', ' '), '\s+', ' ', 'g')) AS whole FROM d), p AS (SELECT *, regexp_extract_all(whole, '[a-z0-9]+') AS p FROM w),
    v AS (SELECT *, coalesce(p[1], '') AS f, CASE WHEN len(p) >= 2 THEN p[-1] ELSE '' END AS l, regexp_extract_all(lower(coalesce(title, '')), '[a-z]+') AS t, trim(regexp_replace(regexp_replace(lower(title), '[_/-]+', ' ', 'g'), '\s+', ' ', 'g')) AS low FROM p),
    x AS (SELECT *, list_filter([whole, array_to_string(p, ' '), CASE WHEN f <> '' AND l <> '' THEN f || ' ' || l END, CASE WHEN f <> '' AND l <> '' THEN array_to_string(list_append(list_transform(p[1:len(p) - 1], lambda x: x[1]), l), ' ') END], lambda z: coalesce(z, '') <> '') AS vs FROM v)
    SELECT doc_id, f <> '' AND l <> '' AND {_CLASH} AS clash,
      coalesce(len(list_filter(vs, lambda z: contains(low, z) OR contains(regexp_replace(low, '[^a-z0-9]+', '', 'g'), regexp_replace(z, '[^a-z0-9]+', '', 'g')))) > 0 OR (f <> '' AND l <> '' AND contains(low, f) AND contains(low, l)), false) AS told,
      len(list_filter(vs, lambda z: instr(lower(trim(regexp_replace(text, '[\s\x{{A0}}]+', ' ', 'g'))), z) BETWEEN 1 AND 31)) > 0 AS in_front FROM x""",
    "documents",
    "collected_meta",
)
def q84_identity_in_titles(docs, meta):
    """Titles that tell the person or another of the same last name, and texts that open with the name."""
    who = P.identity_parts(F.col("name"))
    rows = _about(docs, meta).withColumn("who", who)
    w = F.col("who")
    return rows.select("doc_id", P.conflicts(F.coalesce("title", F.lit("")), w["first"], w["last"]).alias("clash"), P.tells_person(F.col("title"), w).alias("told"), P.front_matter(F.col("text"), w).alias("in_front"))


#: Stated search results about look-alikes of scholars: url, title, snippet, name, first, last, field, department, expected.
RESULTS = [
    ("https://mae.uni.example.edu/people/vedarelli.1", "Ravi Vedarelli | Mechanical Engineering", "Professor at Example State University for control systems.", "Ravi Vedarelli", "Ravi", "Vedarelli", "Control Systems", "Department of Mechanical Engineering", True),
    ("https://scholar.google.com/citations?user=abc", "Ravi Vedarelli - Scholar", "Example State University. Robust control.", "Ravi Vedarelli", "Ravi", "Vedarelli", "Control Systems", "", True),
    ("https://business.uni.example.edu/people/tu.123", "Max Tu | College of Business", "Marketing professor at Example State.", "Max Tu", "Max", "Tu", "Marketing", "College of Business", True),
    ("https://example.com/blog/12345", "Kevin Broun signs new record deal", "Pop star Kevin Broun announces world tour.", "Kevin Broun", "Kevin", "Broun", "Law", "School of Law", False),
    ("https://example.com/article", "Different person Vedarelli", "Some unrelated content about a chef.", "Ravi Vedarelli", "Ravi", "Vedarelli", "Control Systems", "", False),
    ("https://mae.uni.example.edu/people/vedarelli.1", "Vedarelli", "Faculty profile, robust control.", "Ravi Vedarelli", "Ravi", "Vedarelli", "", "", True),
    ("https://www.someuniversity.edu/news/2021", "Andre Palmeri keynote", "Andre Palmeri presented research.", "Andre Palmeri", "Andre", "Palmeri", "", "", True),
    ("https://example.com/tutorials/marketing-101", "Marketing tutorials", "Learn marketing fundamentals.", "Max Tu", "Max", "Tu", "Marketing", "", False),
    ("https://random.com/tu-cafe", "Tu Cafe", "A nice cafe.", "Max Tu", "Max", "Tu", "Marketing", "", False),
    ("https://other.edu/news/vedarelli-talk-2023", "Vedarelli talk at 2023 conference", "Robust control session.", "Ravi Vedarelli", "Ravi", "Vedarelli", "", "", True),
    ("https://example.com/law/broun", "Kevin Broun on contracts", "Notes on law.", "Kevin Broun", "Kevin", "Broun", "Law", "", True),
]
_EXPECTED = ", ".join(f"({n}, {str(r[8]).lower()})" for n, r in enumerate(RESULTS))


@R.query(f"SELECT n, keep, keep AS expected FROM (VALUES {_EXPECTED}) v(n, keep)")
def q85_result_fits(spark, d):
    """Stated search results, each with what is expected of it."""
    rows = spark.createDataFrame([(n, *r) for n, r in enumerate(RESULTS)], "n int, url string, title string, snippet string, name string, first string, last string, field string, department string, expected boolean")
    fits = P.result_fits(*[F.col(c) for c in ("url", "title", "snippet", "name", "first", "last", "field", "department")], "uni.example.edu", ["example state", " exu "])
    return rows.select("n", fits.alias("keep"), "expected")


@R.query(
    rf"""WITH r AS (SELECT DISTINCT decision_id, scholar_name, normalized_name, scholar_institution, normalized_institution FROM match_decision WHERE scholar_name IS NOT NULL AND normalized_name IS NOT NULL),
    q AS (SELECT *, {first_of('scholar_name')} AS f, {last_of('scholar_name')} AS l, list_distinct(list_filter(regexp_extract_all(lower(coalesce(scholar_institution, '')), '[a-z0-9]+'), lambda w: length(w) > 2 AND w NOT IN ('the', 'and', 'university', 'college', 'institute'))) AS a,
      list_distinct(list_filter(regexp_extract_all(lower(coalesce(normalized_institution, '')), '[a-z0-9]+'), lambda w: length(w) > 2 AND w NOT IN ('the', 'and', 'university', 'college', 'institute'))) AS b FROM r)
    SELECT decision_id, CAST(max(CASE WHEN {norm('normalized_name')} <> '' AND {norm('normalized_name')} = {norm('scholar_name')} THEN 100 ELSE 0 END + CASE WHEN f <> '' AND l <> '' AND contains(lower(normalized_name), f) AND contains(lower(normalized_name), l) THEN 30 ELSE 0 END
      + least(len(list_intersect(a, b)), 5) * 15 + CASE WHEN coalesce(scholar_institution, '') <> '' THEN 10 ELSE 0 END + least(length(scholar_name) * 7, 200) // 20) AS INTEGER) AS score FROM q GROUP BY 1""",
    "match_decision",
)
def q86_author_scores(decisions):
    """Points of each decision's name and institution against those an earlier run made of them."""
    ends = P.first_last(F.col("scholar_name"))
    rows = decisions.where("scholar_name is not null and normalized_name is not null")
    score = P.author_score(F.col("normalized_name"), F.array(F.coalesce("scholar_institution", F.lit(""))), F.length("scholar_name") * 7, F.col("scholar_institution"), F.col("scholar_name"), ends["first"], ends["last"], F.coalesce("normalized_institution", F.lit("")))
    return rows.groupBy("decision_id").agg(F.max(score).alias("score"))


_HEAD = "substr(coalesce(t, ''), 1, 500)"
_AFTER = r"(?:Professor|Associate Professor|Assistant Professor|Instructor|Lecturer|Research (?:Associate|Scientist|Fellow)|Fellow|Graduate (?:Research|Teaching) (?:Associate|Assistant)|Visiting (?:Scholar|Fellow|Professor|Assistant Professor)),?\s+([A-Z][A-Za-z\s&,]+?)(?:\n|\.|$)"
_IN = r"(\b(?:assistant|associate|adjunct|clinical|visiting|research|distinguished|emeritus|teaching|full|endowed)?\s*professor(?:\s+of\s+practice)?\b|\bscholar\b)"
_OUT = r"(\b(?:staff|student|undergraduate|graduate|phd candidate|doctoral candidate|postdoc|postdoctoral|administrator|coordinator|manager|specialist|technician)\b)"
_DROP = "|".join(d.replace(".", r"\.") for d in P.DROP_ROLE if d != "research assistant")


@R.query(
    rf"""WITH e AS (SELECT id, max(raw_text) AS t FROM extracted_content WHERE id IS NOT NULL GROUP BY 1), r AS (SELECT id, t, trim(regexp_replace(regexp_extract(lower(coalesce(t, '')), '{_IN}', 1), '[\s\x{{A0}}]+', ' ', 'g')) AS hit, trim(regexp_replace(regexp_extract(lower(coalesce(t, '')), '{_OUT}', 1), '[\s\x{{A0}}]+', ' ', 'g')) AS miss FROM e)
    SELECT id, hit <> '' AS include, CASE WHEN hit <> '' THEN 'matched_role:' || hit WHEN miss <> '' THEN 'non_target_role:' || miss ELSE 'no_professor_or_scholar_title_detected' END AS reason,
      coalesce(t, '') = '' OR regexp_matches(lower(t), 'professor|lecturer|instructor|faculty|dean|chair|director|endowed') OR NOT (regexp_matches(lower(t), '{_DROP}') OR (contains(lower(t), 'research assistant') AND NOT contains(lower(t), 'research assistant professor'))) AS professor,
      CASE WHEN trim(regexp_extract({_HEAD}, '(?:[Dd]epartment|[Dd]ept\.?)\s+(?:of\s+)?([A-Z][A-Za-z\s&,]+?)(?:\n|\.|\|)', 1)) <> '' THEN trim(regexp_extract({_HEAD}, '(?:[Dd]epartment|[Dd]ept\.?)\s+(?:of\s+)?([A-Z][A-Za-z\s&,]+?)(?:\n|\.|\|)', 1))
        ELSE regexp_replace(trim(regexp_extract({_HEAD}, '{_AFTER}', 1)), '[, ]+$', '') END AS department,
      coalesce(TRY_CAST(regexp_extract(coalesce(t, ''), '[0-9]+') AS INTEGER), 0) AS number, list_sort(list_distinct(list_transform(regexp_extract_all(coalesce(t, ''), '(?:^|[^0-9])((?:19|20)[0-9]{{2}})(?:[^0-9]|$)', 1), lambda y: CAST(y AS INTEGER))))[1] AS first_year FROM r""",
    "extracted_content",
)
def q87_roles(pages):
    """Whose page it is by position, and the department and numbers that it names."""
    one = pages.where("id is not null").groupBy("id").agg(F.max("raw_text").alias("t"))
    t = F.col("t")
    role = P.role(t)
    return one.select("id", role["include"].alias("include"), role["reason"].alias("reason"), P.professor_level(t).alias("professor"), P.department_of(t).alias("department"), P.first_int(t).alias("number"), F.try_element_at(P.years(t), F.lit(1)).alias("first_year"))


@R.query(
    """WITH c AS (SELECT scholar_institution AS place, normalized_name AS name, count(DISTINCT decision_id) AS n FROM match_decision WHERE scholar_institution IS NOT NULL GROUP BY 1, 2),
    r AS (SELECT *, row_number() OVER (PARTITION BY place ORDER BY n DESC, name NULLS FIRST) AS r FROM c), t AS (SELECT place, max(n) FILTER (r = 1) AS top, coalesce(max(n) FILTER (r = 2), 0) AS second, any_value(name) FILTER (r = 1) AS name FROM r GROUP BY 1)
    SELECT place, name, top, second, top >= 3 AND (second = 0 OR top >= 2 * second) AS dominant FROM t""",
    "match_decision",
)
def q88_dominant_candidates(decisions):
    """Of each institution the name with most decisions, and whether it leads the runner-up twofold: two struct maxima, no window."""
    from lectern.operators.ranking import dominant

    counted = decisions.where("scholar_institution is not null").groupBy(F.col("scholar_institution").alias("place"), F.col("normalized_name").alias("name")).agg(F.countDistinct("decision_id").alias("n"))
    return dominant(counted, "place", "name", "n", least=3, times=2)
