import pytest
from pyspark.sql import functions as F

from lectern.functions import html as H
from lectern.operators import articles as A
from lectern.operators import chunking, reports, retrieval


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first().x


PAGE = """<html><head><title>Ann Lee | Physics</title><style>p {}</style></head><body><nav>Home</nav><main><h1>University of X</h1><p>First &amp; <b>best</b><br>line<p>Second</p>
<div class="profile department">Dept of <i>Ice</i></div></main><footer>foot</footer></body></html>"""


def test_markup(spark):
    assert one(spark, H.main_text(F.lit(PAGE))) == "University of X\nFirst & best\nline\nSecond\nDept of Ice"
    f = one(spark, H.profile_fields(F.lit(PAGE + "mail a.b@c.org")))
    assert (f.name, f.email, f.position) == ("Ann Lee", "a.b@c.org", "")
    assert one(spark, H.headings(F.lit(PAGE + "<h2>university OF x</h2><h3></h3>"))) == ["University of X"]
    assert one(spark, H.main_text(F.lit("no tags"))) == "no tags" and one(spark, H.main_text(F.lit(None).cast("string"))) == "" and one(spark, H.paragraphs(F.lit(None).cast("string"))) == []


def test_embedding_seam(spark):
    df = spark.createDataFrame([(1, "abc"), (2, None), (3, " "), (4, "z")], "k int, t string")
    got = {r.k: r.embedding for r in chunking.embedded(df, "t", lambda texts: [[float(len(t)), 1.0] for t in texts], 2, batch=1).collect()}
    assert got == {1: [3.0, 1.0], 2: None, 3: None, 4: [1.0, 1.0]}
    with pytest.raises(Exception, match="expected"):
        chunking.embedded(df, "t", lambda texts: [[1.0] for _ in texts], 2).collect()
    assert chunking.semantic_cuts(["a", "b", "c", "d"], [[1, 0], [1, 0.1], [0, 1], [0, 1]]) == [2] and chunking.semantic_cuts(["a"], [[1]]) == []


def test_counters_cost_no_pass(spark):
    rows, seen = reports.run_counters(spark.range(10), "n", even=F.col("id") % 2 == 0)
    assert rows.agg(F.sum("id")).first()[0] == 45 and seen.get == {"rows": 10, "even": 5}


def test_stronger_citations(spark):
    text = "lakes freeze slowly over winter nights here [chunk:1]\n\nother words of verse and metre [chunk:2]"
    arts = spark.createDataFrame([(7, text), (8, None)], "k int, a string")
    passages = spark.createDataFrame([("1", "verse metre words other"), ("2", "lakes freeze slowly winter")], "c string, t string")
    assert {tuple(r) for r in A.stronger_citations(arts, passages, "k", "a", "c", "t").collect()} == {(7, 0, "1", "2"), (7, 1, "2", "1")}
    fixed = one(spark, A.repaired(F.lit("By Ann Lee\nText"), F.lit("Ann Lee"), F.lit("https://a.org/"), F.lit("https://b.org/")))
    assert (fixed.article, fixed.trend_url) == ("Text", "https://b.org/")


def test_ranking_seams(spark):
    pool = spark.createDataFrame([(1, 0.2, 0.9), (2, 0.8, 0.0), (3, 0.5, 1.0)], "id int, s double, c double")
    assert [r.id for r in retrieval.reranked(pool, "s", "c", 2, "id").collect()] == [3, 2]
    assert retrieval.reranked(pool.limit(0), "s", "c", 2, "id").count() == 0
    assert one(spark, retrieval.cosine(F.array(F.lit(0.0)), F.array(F.lit(1.0)))) is None
    assert round(one(spark, retrieval.trend_score(F.lit(None).cast("double"), F.lit(0.0), F.lit(None).cast("double"))), 4) == 0.015
