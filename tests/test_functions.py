from datetime import datetime

from pyspark.sql import functions as F

from lectern.functions import text as T
from lectern.functions import times
from lectern.functions import urls as U


def one(spark, value, *columns):
    row = spark.createDataFrame([(value,)], "x string").select(*[c(F.col("x")).alias(f"c{n}") for n, c in enumerate(columns)]).first()
    return row[0] if len(columns) == 1 else tuple(row)


def test_hash_ignores_case_and_spacing(spark):
    assert one(spark, " A  b\n", T.text_hash) == one(spark, "a B", T.text_hash)
    assert one(spark, "a b", T.text_hash) == one(spark, "A\xa0\tb", T.text_hash)


def test_quality_of_empty_and_null(spark):
    assert one(spark, "", T.ascii_ratio, T.word_count, T.boilerplate_ratio) == (0.0, 0, 0.0)
    assert one(spark, None, T.reasonable) is False


def test_words_are_unicode(spark):
    assert one(spark, "Café élan naïve", T.word_count) == 3


def test_languages(spark):
    texts = {
        "en": "The study of the lake and the river was done with the help of the town that is near.",
        "de": "Die Arbeit und die Lehre sind mit dem Projekt von der Stiftung nicht im Haus auf dem Berg.",
        "fr": "Les résultats de la recherche sont dans le livre que les collègues ont écrit pour une école.",
        "es": "El proyecto de los autores es para una escuela que no está en la ciudad por las obras con el río.",
    }
    for code, t in texts.items():
        assert T.with_language(spark.createDataFrame([(t,)], "text string")).first().language == code
    assert [r.language for r in T.with_language(spark.createDataFrame([("short",), (None,), ("",)], "text string")).collect()] == ["unknown"] * 3


def test_sentences_and_ngrams(spark):
    assert one(spark, "One. Two!  Three\nFour", T.sentences) == ["One.", "Two!", "Three", "Four"]
    assert one(spark, "a b c", lambda c: T.ngrams(T.tokens(c), 2)) == ["a b", "b c"]
    assert one(spark, "a", lambda c: T.ngrams(T.tokens(c), 2)) == []


def test_noise_lines(spark):
    for line in ("", "Checking your browser", "Page 1 of 3 Page 2 of 3", "123456789012 ab", "Reference ID: 12ab34cd"):
        assert one(spark, line, T.noise_line) is True
    assert one(spark, "A line about 2019", T.noise_line) is False


def test_urls(spark):
    assert one(spark, "HTTPS://Ex.ORG:443/a/b/?q=1#top", U.canonical) == "https://ex.org/a/b?q=1"
    assert one(spark, "www.ex.org/a/?utm_source=x&id=2&ref=y", U.crawl_key) == "https://ex.org/a?id=2"
    assert one(spark, None, U.canonical) == ""
    assert one(spark, "https://m.facebook.com/x", U.is_noise) is True
    assert one(spark, "https://a.b.uni.edu/", U.root_domain, lambda c: U.priority(U.host(c))) == ("uni.edu", 50)
    assert one(spark, "https://x.org/cv/a.PDF?d=1", U.category) == "document"


def test_times(spark):
    want = datetime(2023, 1, 31, 1, 8, 49)
    for t in ("2023-01-31 01:08:49", "2023-01-31T01:08:49Z", "2023-01-31T03:08:49+02:00", "Tue, 31 Jan 2023 01:08:49 GMT"):
        assert one(spark, t, lambda c: times.parsed(c).cast("timestamp_ntz")) == want
    assert one(spark, "yesterday", times.parsed) is None
