import io
import random
import zipfile
import zlib
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from lectern.functions import cleaning as C
from lectern.functions import udfs
from lectern.operators import articles as A
from lectern.operators import chunking, cleaners, gates, mining, scores
from lectern.sources import files, stores
from lectern.streaming import events as S


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first().x


def test_consent_notices():
    t = "Ann Lee\nWe use cookies to measure visits.\nAccept all\nSome words between\nManage your cookies here\nClose\nShe studies lakes.\nMore of it."
    assert cleaners.without_consent(t) == "Ann Lee\nShe studies lakes.\nMore of it."
    assert cleaners.without_consent("A\nprivacy policy\nB") == "A\nB"
    far = "cookie\n" + "\n".join(f"line {n}" for n in range(9)) + "\ncookie"
    assert cleaners.without_consent(far) == "\n".join(f"line {n}" for n in range(9))
    assert cleaners.without_consent(None) is None and cleaners.without_consent("") == ""
    cleaners.without_consent("cookie\nx\n" * 50_000)


def test_line_cleaners(spark):
    section = "• Ice (PDF)\nIce\nice\nPage 1 of 2 page 2 of 2\n\nA - B / C\n123456789012 x"
    assert one(spark, C.clean_section(F.lit(section))) == "Ice"
    assert one(spark, C.clean_text(F.lit("**Ann** Lee\nHome\nThis website uses cookies\n© x\nAll rights reserved\n# About\nShe _works_."))) == "Ann Lee\n© x\nShe works."
    assert one(spark, C.clean_document(F.lit("Text here\n123\nmore text"))) == "Text here\n\nmore text"
    assert one(spark, C.clean_chunk(F.lit("<p>Lakes freeze</p>\nSkip to content\nполный текст здесь\nxx"))) == "Lakes freeze"
    assert [one(spark, C.drop_chunk(F.lit(t), F.lit("Ann Lee"))) for t in ("", "=== x ===", "short text", "short text of Lee", "cookie of Lee")] == [True, True, True, False, True]
    assert one(spark, C.profile_lines(F.lit("Menu\nAnn Lee\nshort line\nThis line has more than five words\nthis  line has more than five words"), F.lit("Ann Lee"))) == "Ann Lee\nThis line has more than five words"
    assert one(spark, C.micro_split(F.lit(None).cast("string"))) == [] and one(spark, C.micro_split(F.lit("short"))) == ["short"]
    assert one(spark, C.page_title(F.lit("Menu"), F.lit("x\nA study of lakes | Site\n"))) == "A study of lakes"
    assert one(spark, C.page_title(F.lit("Kevin Lee: Directory: Faculty: About us"), F.lit(""))) == "Kevin Lee"
    assert one(spark, C.source_label(F.lit(""), F.lit("https://www.a.org/research/lake-ice.html"), F.lit(""))) == "Lake Ice (a.org)"
    assert one(spark, C.source_label(F.lit(""), F.lit("https://a.org/12345"), F.lit(""))) == "Source: a.org" and one(spark, C.source_label(F.lit(""), F.lit(""), F.lit("profile_page"))) == "Profile Page"
    assert one(spark, C.json_part(F.lit('ok ```json\n[1, {"a": 2,},]\n``` bye'))) == '[1, {"a": 2}]' and one(spark, C.json_part(F.lit("none"))) == ""
    for f in (C.plain_text, C.clean_section, C.clean_text, C.clean_document, C.clean_chunk, C.pruned):
        assert one(spark, f(F.lit(None).cast("string"))) == "" and one(spark, f(F.lit(""))) == ""


def test_known_sections(spark):
    df = spark.createDataFrame([("a", "Intro\nEducation:\nPhD 1999\nAwards and Honors\nPrize\nBOOKS\n"), ("b", "no heads"), ("c", None), ("d", "")], "id string, t string")
    got = {(r.id, r.section, r.content) for r in cleaners.known_sections(df, "id", "t").collect()}
    assert got == {("a", "EDUCATION", "PhD 1999"), ("a", "AWARDS", "Prize"), ("b", "CONTENT", "no heads")}


def test_budget(spark):
    df = spark.createDataFrame([("k", "B", "y" * 10), ("k", "a", "x" * 10), ("k", "c", "z" * 10), ("e", "a", " ")], "k string, n string, t string")
    assert [tuple(r) for r in cleaners.budgeted(df, "k", "n", "t", 8, 12).collect()] == [("k", f"[Section: a]\n{'x' * 8}\n\n[Section: B]\n{'y' * 4}")]


def test_offsets_of_repeated_words():
    text = "one two three four five six seven and so on then one two three four five six seven at the end"
    assert chunking.placed(text, ["one two three four five six seven", "one two three four five six seven at the end"]) == [(0, 33), (49, 93)]
    assert chunking.placed("a b", ["x"]) == [(-1, -1)] and chunking.placed("", ["a", ""]) == [(-1, -1), (-1, -1)]
    assert chunking.placed("a b  c d", ["a b", "c d"]) == [(0, 3), (5, 8)]


def test_packs():
    s = [" ".join(["w"] * n) for n in (200, 100, 100, 50)]
    assert [n for n, _ in chunking.section_packs(s)] == [300, 150] and [n for n, _ in chunking.section_packs([" ".join(["w"] * 390), "w w"])] == [392]
    assert chunking.semantic_packs(["aaaa", "bb", "cccc"], 8, 3) == [(2, "aaaa bb"), (2, "bb cccc")] and chunking.semantic_packs([]) == []
    assert chunking.seventy_cut("a" * 80 + ". " + "b" * 60, 100) == [(0, "a" * 80 + "."), (81, " " + "b" * 60)]


def test_tokens_round_trip(spark):
    df = spark.createDataFrame([(1, "abc. def ghi jkl mno. pqr"), (2, None)], "doc_id bigint, text string")
    got = chunking.token_chunks(df, lambda t: [ord(c) for c in t], lambda c: "".join(map(chr, c)), most=10, overlap=2, search=8).orderBy("chunk_no").collect()
    whole = "abc. def ghi jkl mno. pqr"
    assert all(whole[r.first_token : r.first_token + r.tokens] == r.chunk and r.tokens <= 10 for r in got) and got[-1].first_token + got[-1].tokens == len(whole)


def test_subjects(spark):
    m = lambda t: one(spark, chunking.mentions_subject(F.lit(t).cast("string"), F.lit("Ann Lee")))
    other = "Bob Ray was here. Bob Ray wrote it. Bob Ray led it. Lee came."
    assert [m(t) for t in ("Lee studies ice", other, "nobody", None, "")] == [True, False, False, False, False]
    c = lambda t: one(spark, chunking.continues_subject(F.lit(t), F.lit("Ann Lee")))
    assert [c(t) for t in ("She went on", "Bob Ray was there. He left", "Ann Lee was there, and she left", "No one")] == [True, False, True, False]


def test_claims(spark):
    df = spark.createDataFrame([(1, "Ann Lee received the medal of the lake society in 1999. Nothing at all here of any interest to anyone. Lee is. Subscribe: Ann Lee received the medal of the society in 2001.", "Ann Lee"), (2, None, None)], "doc_id int, text string, name string")
    got = gates.claims(df, name=F.col("name")).collect()
    assert [(r.sentence_no, r.confidence, r.named, r.tags) for r in got] == [(0, 0.7, True, ["awards"])]


def test_article_checks(spark):
    a = "By Ann Lee\n\n## Why this matters now\n\nIt did so because of ice, and all that followed then. [chunk:1]\n\n## Sources\n\nhttps://a.edu/x"
    errors = one(spark, A.structure(F.lit(a), 5, 1, 2))
    assert "missing_required_section:conclusion" in errors and "missing_required_section:why_now" not in errors and "missing_sources_section" not in errors
    assert one(spark, A.structure(F.lit(None).cast("string"))) == ["article_empty"]
    assert one(spark, A.without_bylines(F.lit(a), F.lit("Ann Lee"))).startswith("\n## Why") and one(spark, A.bylines(F.lit(a))) == ["Ann Lee"]
    assert [one(spark, A.is_person(F.lit(x), F.lit("Ann Q. Lee"))) for x in ("Dr. Lee", "Ann Lee", "Bo Lee", "Bo Ray", "")] == [True, True, False, False, False]
    arts = spark.createDataFrame([(1, a), (2, None)], "k int, a string")
    passages = spark.createDataFrame([("1", "ice followed then because", "Publications")], "c string, t string, s string")
    assert [tuple(r) for r in A.causal_evidence(arts, passages, "k", "a", "c", "s").collect()] == [(1, "causal_paragraph_publications_only_evidence", 1)]
    assert one(spark, A.chunk_quality(F.lit(None).cast("string"))) == 0.0


def test_scores(spark):
    assert one(spark, scores.readiness(F.lit(65))) == "demo_ready_with_guardrails"
    rows = spark.createDataFrame([("k", "a", 1.0), ("k", "b", 0.0), ("j", "a", None)], "k string, i string, w double")
    assert [tuple(r) for r in scores.weighted_pick(rows, "k", "i", "w", "s").collect()] == [("k", "a")]
    many = spark.range(3000).selectExpr("id as k", "explode(array(struct('a' as i, 1.0D as w), struct('b' as i, 3.0D as w))) as x").select("k", "x.*")
    assert 0.7 < scores.weighted_pick(many, "k", "i", "w", "s").where("i = 'b'").count() / 3000 < 0.8
    empty = spark.createDataFrame([], "profile_id string, source string, success boolean, chars int, named boolean, affiliated boolean, h_index int, publications int")
    assert scores.confidence(empty).count() == 0 and scores.dashboard(scores.confidence(empty)).first().profiles == 0


def test_topics(spark):
    assert [mining.viable_phrase(p) for p in ("soil carbon", "soil", "the soil", "soil soil", "soil 2020", None)] == [True, False, False, False, False, False]
    assert mining.composed_topic(["soil carbon", "soil", "ice and lakes"]) == "ice and lakes and soil carbon" and mining.composed_topic([]) == ""
    df = spark.createDataFrame([("soil", "lake ice"), (None, ""), ("x", None)], "a string, b string")
    assert [(r.topic, r.topic_from) for r in mining.chosen_topic(df, "a", "b").collect()] == [("lake ice", "b"), ("recent work", "fallback"), ("x", "a")]


def test_planted_topics(spark):
    words = [["lakes", "freeze", "water", "frozen", "rivers"], ["verses", "metre", "rhyme", "stanza", "poets"]]
    docs = spark.createDataFrame([(n, " ".join(words[n % 2][k % 5] for k in range(n, n + 30))) for n in range(40)] + [(99, None)], "doc_id bigint, text string")
    clusters = {r.doc_id: r.cluster for r in mining.kmeans_topics(docs, k=2).collect()}
    assert len({clusters[n] for n in range(0, 40, 2)}) == 1 and len({clusters[n] for n in range(1, 40, 2)}) == 1 and clusters[0] != clusters[1]
    tops: dict[int, set] = {}
    for r in mining.nmf_topics(docs, k=2, top=4).collect():
        tops.setdefault(r.topic, set()).add(r.word)
    assert all(t <= set(words[0]) or t <= set(words[1]) for t in tops.values())


def test_topic_factors_stay_off_the_driver(spark, monkeypatch):
    rnd = random.Random(3)
    texts = [" ".join(rnd.choice(("lakes", "rivers", "verses")) + str(rnd.randrange(60)) for _ in range(rnd.randrange(1, 50))) for _ in range(80)]
    docs = spark.createDataFrame([*enumerate(texts), (98, None), (99, "no word")], "doc_id int, text string")
    held = []
    collect = type(docs).collect
    monkeypatch.setattr(type(docs), "collect", lambda df: held.append(collect(df)) or held[-1])
    got = mining.nmf_topics(docs, k=2, top=500, rounds=3)
    assert max(map(len, held), default=0) <= 2  # neither words nor factors
    n = [Counter(t.split()) for t in texts]
    df = Counter(w for c in n for w in c)
    words = sorted((w for w in df if df[w] >= 2), key=lambda w: (-df[w], w))
    x = np.array([[c[w] * np.log((len(texts) + 3) / (df[w] + 1)) for w in words] for c in n])
    h = np.random.default_rng(42).random((2, len(words))) + 0.1
    for _ in range(3):
        w = np.full((len(x), 2), 0.5)
        for _ in range(8):
            w *= (x @ h.T) / np.maximum(w @ (h @ h.T), 1e-9)
        h *= (w.T @ x) / np.maximum(w.T @ w @ h, 1e-9)
    want = {(t, words[j]): h[t, j] for t in range(2) for j in range(len(words))}
    rows = collect(got)
    assert {(r.topic, r.word) for r in rows} == set(want) and all(abs(r.weight - want[r.topic, r.word]) < 1e-5 for r in rows)
    assert [r.weight for r in sorted(rows, key=lambda r: (r.topic, r.place)) if r.topic == 0] == sorted((r.weight for r in rows if r.topic == 0), reverse=True)
    assert collect(mining.nmf_topics(docs.limit(0))) == []


def test_documents(spark, tmp_path):
    at = tmp_path / "docs"
    at.mkdir()
    body = io.BytesIO()
    with zipfile.ZipFile(body, "w") as z:
        z.writestr("word/document.xml", "<w:document><w:p><w:r><w:t>Ann Lee</w:t></w:r></w:p><w:p><w:r><w:t xml:space='preserve'>ice &amp; </w:t></w:r><w:r><w:t>lakes</w:t></w:r></w:p></w:document>")
    (at / "a.docx").write_bytes(body.getvalue())
    stream = zlib.compress(b"BT (Ann) Tj [(L) -5 (ee)] TJ T* (ice \\(cold\\)) Tj ET")
    (at / "b.pdf").write_bytes(b"%PDF-1.4\n1 0 obj<<>>stream\n" + stream + b"\nendstream endobj")
    (at / "c.txt").write_bytes("caf\xe9 \x93x\x94".encode("latin-1"))
    (at / "d.txt").write_bytes(b"\xff\xfe" + "né".encode("utf-16-le"))
    (at / "e.rtf").write_bytes(b"{\\rtf1 {\\b Ann} Lee}")
    (at / "f.docx").write_bytes(b"PK\x03\x04broken")
    got = {r.path.rsplit("/", 1)[-1]: r.text for r in files.read_documents_text(spark, str(at)).collect()}
    assert got == {"a.docx": "Ann Lee\nice & lakes", "b.pdf": "AnnLee\nice (cold)", "c.txt": "café “x”", "d.txt": "né", "e.rtf": "Ann Lee", "f.docx": ""}
    assert files.docx_text(body.getvalue()) == "Ann Lee\nice & lakes" and files.docx_text(b"PK") == ""


def test_sheets_and_feeds(spark, tmp_path):
    (tmp_path / "s").mkdir()
    (tmp_path / "s/u.csv").write_text("Name,Web Site,E Mail\nAnn,https://a.org/1,nan\nBo,,b@x\n")
    sheet = files.read_any_sheet(spark, str(tmp_path / "s"))
    assert files.link_column(sheet) == "Web Site" and [r.url for r in files.with_links(sheet).collect()] == ["https://a.org/1"]
    got = files.normalised_columns(sheet, {"name": [], "email": ["e-mail"], "field": []})
    assert {tuple(r) for r in got.collect()} == {("Ann", "", ""), ("Bo", "b@x", "")}
    assert files.header_errors(sheet, ["Name", "Field"]) == ["missing:Field", "unexpected:Web Site", "unexpected:E Mail"]
    assert {r.id for r in files.ids_of(spark, str(tmp_path / "s"), "Name").collect()} == {"Ann", "Bo"}
    assert files.link_column(sheet.select("Name")) is None and files.with_links(sheet.select("Name")).count() == 0
    (tmp_path / "f.xml").write_text("<rss><channel><item><title>T</title><link> https://a.org/1 </link><pubDate>Thu, 01 Jan 2026</pubDate></item><item><title>U</title><link>https://a.org/1</link></item><item><title>V</title></item></channel></rss>")
    assert [(r.title, r.url) for r in files.read_feed(spark, str(tmp_path / "f.xml")).collect()] == [("T", "https://a.org/1")]


def test_copies_resume(spark, tmp_path):
    a, b = (stores.TableStore(spark, str(tmp_path / n), "k", "k int, v string", buckets=2) for n in "ab")
    assert files.copy_store(a, b, 2) is None
    a.upsert(spark.createDataFrame([(k, "x") for k in range(5)], "k int, v string"))
    at = files.copy_store(a, b, 2, pages=1)
    assert at == 1 and b.read().count() == 2 and files.copy_store(a, b, 2, at) == 4 and b.read().count() == 5


def test_retries_and_functions(spark):
    r = spark.createDataFrame([(1, True, "a"), (2, False, "b"), (3, None, "c")], "k int, success boolean, v string")
    got = S.retried(r, lambda keys: keys.where("k = 2").selectExpr("k", "true as success", "'new' as v"), "k")
    assert {tuple(x) for x in got.collect()} == {(1, True, "a"), (2, True, "new"), (3, None, "c")}
    assert {"nfkd", "seventy_chunks"} <= set(udfs.register(spark))
    assert spark.sql("select nfkd('é') as a, nfkd(null) as b").first().a == "é"
    assert spark.sql("select * from section_chunks(array('a b', 'c'), 325)").collect()[0].chunk == "a b c"
