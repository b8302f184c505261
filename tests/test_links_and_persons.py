import pytest
from pyspark.sql import functions as F

from lectern.functions import links as L
from lectern.functions import persons as P
from lectern.operators import collectors as K
from lectern.operators import ranking


def one(spark, column, **values):
    row = spark.range(1).select(*[F.lit(v).alias(k) for k, v in values.items()]) if values else spark.range(1)
    return row.select(column.alias("x")).first().x


@pytest.mark.parametrize(
    ("url", "skip"),
    [
        ("https://www.linkedin.com/in/ann-lee", True),
        ("https://twitter.com/somebody", True),
        ("https://www.facebook.com/profile", True),
        ("https://www.uni.example.edu/faculty/lee", False),
        ("https://scholar.google.com/citations?user=xx", False),
        ("https://orcid.org/0000-0001-2345-6789", False),
        ("https://unix.com/a", False),
        ("ftp://a.org/", True),
        ("", True),
        (None, True),
        ("https://a.org/" + "x" * 600, True),
    ],
)
def test_skipped_links(spark, url, skip):
    assert one(spark, L.should_skip(F.lit(url).cast("string"))) is skip


def test_link_ranks_and_classes(spark):
    urls = ["https://www.uni.edu/faculty/lee", "https://scholar.google.com/citations?user=x", "https://orcid.org/abc", "https://arxiv.org/abs/1", "https://www.blog.com/post", "https://www.other.edu/people/y", "https://a.gov/", "https://a.org/", "x"]
    df = spark.createDataFrame([(n, u) for n, u in enumerate(urls)], "n int, u string")
    assert [r.p for r in df.select("n", L.priority(F.col("u"), ["uni.edu"]).alias("p")).orderBy("n").collect()] == [0, 2, 1, 6, 100, 50, 60, 70, 100]
    assert one(spark, L.category(F.lit("https://a.org/x.pdf"), F.lit(""), F.lit("a.org"))) == "document"
    assert one(spark, L.category(F.lit("https://a.org/lab"), F.lit(None).cast("string"), F.lit("a.org"))) == "internal_page"
    assert one(spark, L.category(F.lit(None).cast("string"), F.lit(""), F.lit(""))) == "none"
    assert one(spark, L.source_class(F.lit("https://a.org/p"), F.lit("see the syllabus"), "uni.edu", "experts.uni.edu")) == "teaching_info"
    assert one(spark, L.hop_score(F.lit("https://arxiv.org/pdf/lee.pdf"), F.lit("Lee's paper"), F.lit("Ann Lee"), F.lit("Lee"))) == 3 + 4 + 5 + 3 + 2 + 2 + 1
    assert one(spark, L.page_key(F.lit("HTTPS://A.org/Path/?q=1#x"))) == "https://a.org/Path"
    assert [one(spark, L.paywalled(F.lit(t).cast("string"), F.lit(s).cast("int"))) for t, s in ((None, 403), ("Please Subscribe", None), ("free", 200), (None, None))] == [True, True, False, False]


def test_quality_filter_softens(spark):
    rows = [("a", "https://x.edu/1"), ("a", "https://b.com/1"), ("b", "https://b.com/2"), ("b", "https://x.com/2"), ("c", "https://x.com/3")]
    got = L.quality_filter(spark.createDataFrame(rows, "k string, u string"), "k", "u", "u").select("k", "u").collect()
    assert {tuple(r) for r in got} == {("a", "https://x.edu/1"), ("b", "https://b.com/2"), ("c", "https://x.com/3")}
    assert L.quality_filter(spark.createDataFrame([], "k string, u string"), "k", "u", "u").count() == 0


@pytest.mark.parametrize(
    ("first", "last", "found", "strict", "loose"),
    [
        ("John", "Smith", "J. Smith", True, True),
        ("J", "Smith", "Smith, John", True, True),
        ("Chris", "Smith", "Christopher Smith", True, True),
        ("John", "Smith", "Jane Smith", False, False),
        ("John", "Smith", "John Smyth", False, False),
        ("José", "Núñez", "NUNEZ,JOSE", True, True),
        ("", "Smith", "Ann Smith", False, True),
        ("John", "Smith", None, False, False),
        ("John", "", "John Smith", False, False),
    ],
)
def test_names_match(spark, first, last, found, strict, loose):
    f = F.lit(found).cast("string")
    assert (one(spark, P.names_match(F.lit(first), F.lit(last), f)), one(spark, P.names_match_loosely(F.lit(first), F.lit(last), f))) == (strict, loose)


def test_names_in_parts(spark):
    p = one(spark, P.name_parts(F.lit("Dr. Ann Mary Lee")))
    assert (p.title, p.first, p.middle, p["last"]) == ("Dr.", "Ann", "Mary", "Lee")
    assert one(spark, P.identity_parts(F.lit("W. E. B. Du Bois")))["variants"] == ["w e b du bois", "w bois", "w e b d bois"]
    assert one(spark, P.name_variants(F.lit("JK Lee"))) == ["JK Lee", "J Lee"] and one(spark, P.name_variants(F.lit(None).cast("string"))) == []
    assert [one(spark, P.looks_like_id(F.lit(v))) for v in ("12345", "deadbeefdeadbeef", "2019.12_a", "Research", "", "cafe")] == [True, True, True, False, True, False]
    assert [one(spark, P.clean_name(F.lit(v))) for v in ("Ann Lee", "Lee", "Department of Physics", "Ann Lee - News", "https://a.org Ann Lee")] == [True, False, False, False, False]
    assert one(spark, P.years(F.lit("in 1999, 2004-2004 and 12345"))) == [1999, 2004]
    assert one(spark, P.money(F.lit("about $1,250.50 a year"))) == 1250.5 and one(spark, P.money(F.lit("none"))) is None
    assert one(spark, P.keywords(F.array(*[F.lit(x) for x in (" A", "a", "", "B")]))) == ["A", "B"]
    assert one(spark, P.ascii_only(F.lit("Café – 名刺"))) == "Cafe  "


def test_identity_conflicts(spark):
    at = lambda text: one(spark, P.conflicts(F.lit(text), F.lit("kevin"), F.lit("brown")))
    assert [at(t) for t in ("Kevin Brown", "Kevin M Brown", "Michael Brown", "Professor Brown", "K Brown and Sue", "")] == [False, False, True, False, False, False]
    fits = lambda kind, url, label, text: one(spark, P.source_fits(F.lit(kind), F.lit(url), F.lit(label), F.lit(text), F.lit("Ann Lee")))
    assert fits("web", "https://a.org/x", "Ann Lee", "Ann Lee studies lakes. Lee also teaches.") is True
    assert fits("web", "https://a.org/x", "Bob Lee", "Ann Lee studies lakes. Lee also teaches.") is False
    assert fits("cv", "https://a.org/x", "", "x " * 30 + "Ann Lee studies lakes") is False
    assert fits("cv", "https://a.org/x", "", "Ann Lee, curriculum vitae") is True
    assert fits("web", "https://a.org/x", "", "") is False


def test_roles(spark):
    role = lambda t: tuple(one(spark, P.role(F.lit(t))))
    assert role("Associate Professor and student adviser") == (True, "matched_role:associate professor")
    assert role("PhD student") == (False, "non_target_role:student") and role("") == (False, "no_professor_or_scholar_title_detected")
    assert [one(spark, P.professor_level(F.lit(t))) for t in ("Research Assistant Professor", "Research Assistant", "Postdoctoral", "", "Artist")] == [True, False, False, True, True]
    assert one(spark, P.department_of(F.lit("Ann Lee\nProfessor, Soil Science\nmore"))) == "Soil Science" and one(spark, P.department_of(F.lit("Department of Physics. x"))) == "Physics"


def test_candidates(spark):
    rows = [("a", "x", True, False, 3), ("a", "y", False, True, 90), ("b", "x", False, False, 1), ("c", "x", False, True, 6), ("c", "y", False, False, 40), ("d", "x", False, False, 30), ("d", "y", False, False, 9), ("e", "x", False, False, 60), ("e", "y", False, False, 50), ("f", "x", False, False, 4), ("f", "y", False, False, 3), ("g", "x", False, False, 0)]
    df = spark.createDataFrame(rows, "k string, id string, home boolean, exact boolean, works int")
    got = ranking.disambiguated(df, "k", F.col("home"), F.col("exact"), F.col("works"), F.lit(True), ["id"])
    assert {(r.k, r.rule, r.id) for r in got.collect()} == {("a", "affiliation", "x"), ("b", "only_one", "x"), ("c", "first_name", "x"), ("d", "dominance", "x"), ("e", "productive", "x")}
    assert ranking.disambiguated(df.limit(0), "k", F.col("home"), F.col("exact"), F.col("works"), F.lit(True), ["id"]).count() == 0


def test_merged_spans(spark):
    df = spark.createDataFrame([("a", 0, 10, "x"), ("a", 5, 7, "long"), ("a", 10, 12, "y"), ("b", 1, 2, "z")], "k string, s int, e int, t string")
    assert {tuple(r) for r in ranking.merged_spans(df, "k", "s", "e", "t").collect()} == {("a", 0, 10, "long", 2), ("a", 10, 12, "y", 1), ("b", 1, 2, "z", 1)}


def test_collectors_on_odd_payloads(spark):
    good = '{"results": [{"project_num": "1", "project_title": " Ice ", "award_amount": 5, "principal_investigators": [{"full_name": "LEE, ANN"}]}, {"project_num": "2", "award_amount": 9, "principal_investigators": [{"full_name": "Bo Lee"}]}, {"project_num": "3", "award_amount": 7, "principal_investigators": [{"full_name": "A Lee"}]}]}'
    rows = spark.createDataFrame([("p", "Ann Lee", good), ("q", "Ann Lee", "not json"), ("r", "Ann Lee", None), ("s", None, good), ("t", "Ann Lee", '{"results": null}')], "profile_id string, name string, payload string")
    got = {r.profile_id: r for r in K.collected(rows, "nih_grants").collect()}
    assert (got["p"].success, got["p"]["items"], got["p"].total) == (True, 2, 12) and got["p"].data.index('"3"') < got["p"].data.index('"1"') and "• Ice" in got["p"].raw_text
    assert all(not got[k].success and got[k].error and got[k].data is None for k in "qrst")
    assert K.collected(rows.limit(0), "nih_grants").count() == 0
    assert one(spark, K.cache_key(F.lit("a"), F.lit("Ann"), F.lit("p"))) == one(spark, K.cache_key(F.lit("a"), F.lit("ANN"), F.lit("p")))
