import pytest

from lectern.llm import linkage, names, person


@pytest.mark.parametrize(
    ("typed", "want"),
    [
        ("Prof. Dr. James Q. Lee, PhD", (("james", "q"), ("lee",))),
        ("Duvaregawíck,Helga", (("helga",), ("duvaregawick",))),
        ("Dekorotum Lucia", (("lucia",), ("dekorotum",))),
        ("UE Sekomafiton", (("u", "e"), ("sekomafiton",))),
        ("LufubunraButesokaski, W.", (("w",), ("lufubunra", "butesokaski"))),
        ("Gesovatirt U.", (("u",), ("gesovatirt",))),
        ("Olga Michael Kitutanel III", (("olga", "michael"), ("kitutanel",))),
        ("", ((), ())),
        (None, ((), ())),
        ("123 !", ((), ())),
    ],
)
def test_parse(typed, want):
    assert person.parse(typed) == want


def test_similarity():
    assert person.jaro_winkler("martha", "marhta") == pytest.approx(0.9611, abs=1e-4)
    assert person.jaro_winkler("", "a") == 0 and person.jaro_winkler("a", "a") == 1
    assert names.family_alike("gomezozth", "goomezozth") and not names.family_alike("gomezozth", "padupizwick")
    assert not names.given_alike("james", "jana")


META = "profile_id string, profile_name string, profile_url string, email string, source_host string, field string, node string"
DECISION = "decision_id string, scholar_name string, scholar_institution string, scholar_department string, key string"
INST = "institution_name string, web_domain string"


def tables(spark):
    meta = [
        ("c1", "Katherine Dekorotum", "https://x.susuburg.example/a/kd", "kd@susuburg.example", "x.susuburg.example", None, "n"),
        ("c1", "Katherine Dekorotum", "https://x.susuburg.example/a/kd", "kd@susuburg.example", "x.susuburg.example", None, "n"),
        ("c2", "DEKOROTUM, Kate", "https://y.susuburg.example/a/1", "", "Y.SUSUBURG.example", None, "n"),
        ("c3", "Katherine Dekorotum", "https://x.bereport.example/a", None, "x.bereport.example", None, "n"),
        ("c4", None, None, None, None, None, None),
        (None, "Lost Key", None, None, None, None, None),
        ("c5", "", "", "", "", "", ""),
        ("c6", "Xavier Padupizwick", "https://x.bereport.example/b", None, "x.bereport.example", "Optics", "n"),
    ]
    decisions = [
        ("d1", "K. Dekorotum", "University of Susuburg", None, "k"),
        ("d2", "Prof. Katherine Dekorotmu", "Susuburg Univ", "Optics", "k"),
        ("d3", "Xavier Padupizwick", None, "Dept. of Optics", "k"),
        ("d4", "Xavier Padupizwick", "", "Nursing", "k"),
        ("d5", None, "University of Susuburg", None, "k"),
    ]
    inst = [("University of Susuburg", "susuburg.example"), ("Bereport Institute of Technology", "bereport.example"), (None, None)]
    return spark.createDataFrame(meta, META), spark.createDataFrame(decisions, DECISION), spark.createDataFrame(inst, INST)


def test_persons(spark):
    got = {tuple(r) for r in names.pairs(*tables(spark)).collect()}
    group = ["c1", "c2", "d1", "d2"]
    assert got == {(a, b) for a in group for b in group if a < b} | {("c6", "d3")}
    links = {r.key: r.links for r in names.linked(*tables(spark)).collect()}
    assert links["c1"] == 3 and links["c3"] == 0 and "c4" not in links and "c5" not in links


def test_misspelt_names_without_institution(spark):
    meta, _, inst = tables(spark)
    decisions = [
        ("p1", "Wilma Penegarmos", "University of Susuburg", "Optics", "k"),
        ("l1", "Wilma Peengarmos", None, None, "k"),  # no other has such a name
        ("l2", "Wilmaa Penegarmos", "", "Optics", "k"),
        ("l3", "Wilma Peengarmos", "", "Nursing", "k"),  # another department
        ("p2", "Otto Vobodelder Kinamu", "University of Susuburg", "Chemistry", "k"),
        ("l4", "Otto Voboodelder", None, "Chemistry", "k"),  # one of two family names left out
        ("l5", "Lena Mufatesamar", None, "History", "k"),  # none of these has an institution
        ("l6", "Lena Muffatesamar", None, "History", "k"),
        ("l7", "L. Mufatesamarr", "", "History", "k"),
        ("l8", "Lena Mufatesamar", None, "Law", "k"),
        ("p3", "Ida Bemoretas", "University of Susuburg", None, "k"),
        ("p4", "Ida Bemoretas", "Bereport Institute of Technology", None, "k"),
        ("l9", "Ida Bemoretass", None, None, "k"),  # may be either
        ("l0", "Padupizwick", None, None, "k"),  # no given name
    ]
    got = {tuple(r) for r in names.pairs(meta.limit(0), spark.createDataFrame(decisions, DECISION), inst).collect()}
    assert got == {(a, b) for g in (["l1", "l2", "p1"], ["l4", "p2"], ["l5", "l6", "l7"]) for a in g for b in g if a < b}


def test_a_hot_name_and_empty_tables(spark):
    _, _, inst = tables(spark)
    many = spark.range(300).selectExpr("concat('c', id) as profile_id", "'Mira Begukunes' as profile_name", "'https://a.susuburg.example/x' as profile_url", "null as email", "'a.susuburg.example' as source_host", "null as field")
    none = spark.createDataFrame([], DECISION)
    assert names.pairs(many, none, inst).count() == 300 * 299 // 2
    assert names.pairs(many.limit(0), none, inst).count() == 0
    assert names.pairs(many.limit(0), none, inst.limit(0)).count() == 0


IMAGE = "profile_id string, name string, university string, source_url string, s3_key string, caption string, key string"


def test_matches(spark):
    _, decisions, inst = tables(spark)
    images = [
        ("i1", "Katherine Dekorotum", "U. Susuburg", "https://x.susuburg.example/img/1", "faculty/susuburg/abc.jpg", "Professor, Optics", "z"),
        ("i1", "Katherine Dekorotum", "U. Susuburg", "https://x.susuburg.example/img/1", "faculty/susuburg/abc.jpg", "Professor, Optics", "z"),
        ("i2", "K. Dekorotum", None, "https://x.susuburg.example/img/2", "faculty/susuburg/katherine-dekorotum.jpg", None, "z"),
        ("i3", "Katherine Dekorotum", None, "https://x.bereport.example/img/2", None, "", "z"),
        ("i4", "Xavier Padupizwick", "Bereport", "https://bereport.example/img/9", None, "Optics", "z"),
        ("i5", None, None, None, None, None, None),
        (None, "A B", None, None, None, None, None),
    ]
    got = linkage.matches(spark.createDataFrame(images, IMAGE), decisions, inst)
    assert {(r.image_profile_id, r.decision_id) for r in got.collect()} == {("i1", "d1"), ("i1", "d2"), ("i2", "d1"), ("i2", "d2"), ("i4", "d3")}
    assert all(0 < r.confidence < 1 for r in got.collect())
    assert linkage.matches(spark.createDataFrame([], IMAGE), decisions, inst).count() == 0
