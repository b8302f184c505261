import re

import pytest
from pyspark.sql import functions as F

from lectern.llm import layout, main_text, queries, repeated_lines, residue, templates

LONG = "This legal notice stands on every page of the site"


def pages(spark, texts, day=1):
    rows = [(i, t, f"2024-01-{day:02d}") for i, t in texts]
    return spark.createDataFrame(rows, "id string, raw_text string, d string").select("id", "raw_text", F.col("d").cast("timestamp_ntz").alias("scraped_at"), F.lit("clash").alias("host"), F.lit("clash").alias("key"))


def hosts(spark, ids, host="A.example"):
    return repeated_lines.page_hosts(spark.createDataFrame([(i, host) for i in ids] + [("nohost", None), ("blank", " ")], "profile_id string, source_host string"))


def brute(texts, least=8):
    keys: dict[str, set] = {}
    at = []
    for i, t in dict(texts).items():
        for n, line in enumerate((t or "").split("\n")):
            k = "".join(c for c in line.lower() if c.isalpha())
            if len(k) >= 25:
                keys.setdefault(k, set()).add(i)
                at.append((i, n, k))
    return {(i, n) for i, n, k in at if len(keys[k]) >= least}


def test_lines_against_brute_force_in_deltas(spark):
    texts = [(f"p{k}", f"own line number of page {k} {'abc' * k}\n{LONG.upper() if k % 2 else LONG + '!'}\n\n{LONG if k == 3 else ''}") for k in range(10)]
    h = hosts(spark, [i for i, _ in texts])
    store = repeated_lines.LineCountStore(spark)
    first = repeated_lines.line_index(pages(spark, texts[:7] + texts[:2]), h)
    assert {r.id for r in store.merge(first).collect()} == {i for i, _ in texts[:7]}
    assert store.lines().count() == 0
    rebuilt = store.merge(repeated_lines.line_index(pages(spark, texts[7:] + texts[:1], 2), h))
    assert {r.id for r in rebuilt.collect()} == {i for i, _ in texts}  # the line crossed on all of them
    assert {tuple(r) for r in store.lines().collect()} == brute(texts)
    # again the same pages: nothing to rebuild
    assert store.merge(repeated_lines.line_index(pages(spark, texts[:3], 3), h)).count() == 0
    # three pages lose the line: it falls below the threshold
    store.merge(repeated_lines.line_index(pages(spark, [(i, "now some other text that is quite long, page " + "xyz" * n) for n, (i, _) in enumerate(texts[:3])], 4), h))
    assert store.lines().count() == 0


def test_a_later_session_goes_on_and_stale_lines_go(spark, tmp_path):
    texts = [(f"p{k}", f"own line number of page {k} {'abc' * k}\n{LONG}") for k in range(9)]
    h, at = hosts(spark, [i for i, _ in texts]), str(tmp_path / "store")
    repeated_lines.LineCountStore(spark, at).merge(repeated_lines.line_index(pages(spark, texts), h))
    # another session: two pages come again without the line, and without any line that counts
    other = spark.newSession()
    store = repeated_lines.LineCountStore(other, at)
    assert store.lines().count() == 9
    again = [("p0", "short"), ("p1", None)]
    rebuilt = store.merge(repeated_lines.line_index(pages(other, again, 2), hosts(other, ["p0", "p1"])))
    assert {r.id for r in rebuilt.collect()} == {i for i, _ in texts} and store.lines().count() == 0
    assert store.merge(repeated_lines.line_index(pages(other, again, 3), hosts(other, ["p0", "p1"]))).count() == 0


def test_only_named_pages_are_rebuilt(spark):
    meta = spark.createDataFrame([(f"p{k}", "A.example") for k in range(12)], "profile_id string, source_host string")
    one = pages(spark, [(f"p{k}", f"own text of page number {k}\n{LONG}") for k in range(8)] + [("solo", LONG)])
    two = pages(spark, [(f"p{k}", f"own text of page number {k}\n{LONG}\nmore") for k in range(8, 12)], 9)
    both = one.unionByName(two)
    store, rebuilt = repeated_lines.store_of(both, meta)
    assert [r.count() for r in rebuilt] == [8, 4]
    got = {r.id: (r.raw_text, r.removed) for r in repeated_lines.rebuilt_texts(both, store, rebuilt).collect()}
    assert got["p0"] == ("own text of page number 0", 1) and got["p9"] == ("own text of page number 9\nmore", 1) and got["solo"] == (LONG, 0) and len(got) == 13


def test_lines_edge_cases(spark):
    meta = spark.createDataFrame([("a", "H.example")], "profile_id string, source_host string")
    none = pages(spark, [("a", None), ("a", ""), (None, LONG)])
    store, rebuilt = repeated_lines.store_of(none, meta)
    assert store.lines().count() == 0 and len(rebuilt) == 2
    store, _ = repeated_lines.store_of(none.limit(0), meta)
    assert store.lines().count() == 0
    cleaned = repeated_lines.without_lines(pages(spark, [("a", "x\ny\nz")]), spark.createDataFrame([("a", 1)], "id string, line_no int"))
    assert [(r.raw_text, r.removed) for r in cleaned.collect()] == [("x\nz", 1)]


def test_render_markup():
    page = """<html><head><title>t</title><script>x()</script></head><body><nav>Home | News</nav><div class="cookie-banner">We use cookies</div>
    <h1>Ann Lee</h1><p>First paragraph<p>Second &amp; last<ul><li>one<li>two <b>bold</b></ul><ol><li>a<li>b</ol>
    <table><tr><th>Year<th>Title<tr><td>2019<td>Long title</table><p style="display: none">secret</p><footer>Impressum</footer></body>"""
    out = layout.render(page)
    assert out.split("\n") == ["Ann Lee", "", "First paragraph", "", "Second & last", "", "- one", "- two bold", "", "1. a", "2. b", "", "Year  Title", "2019  Long title"]
    assert layout.render(None) == "" and layout.render("plain & simple") == "plain & simple"
    layout.render("</p></div><li><td>" * 300)


PROFILE = """Skip to content
Home | News | People | Library
People » Physics » Lee
Latest news
Open day May 3: guests and visitors in Town →
Dr. Ann Lee
Senior Lecturer, Physics, Quark group
E-mail ann.lee@uni.example

Research
They study how lakes freeze and have followed twelve of them for many years, with help of volunteers.
%%QUOTE%%
Subscribe to the monthly bulletin of Uni
Teaching:
PHY 101 Introduction to lakes
© 2020 Uni. All rights reserved.
Home
News"""


def test_main_lines():
    kept, other = layout.main_lines(PROFILE, layout.name_words("Lee, Ann"))
    assert kept == [5, 6, 7, 9, 10, 13, 14]
    assert other == [0, 1, 2, 3, 4, 11, 12, 15, 16, 17]
    assert layout.main_lines("", []) == ([], []) and layout.main_lines(" \n\xa0\n") == ([], [])
    layout.elements("x" * 300_000)
    layout.elements("\n".join(["Menu"] * 20_000))


def test_lines_make_a_tree_that_is_rendered():
    text = "Home\nNews\nPeople\n\nAnn Lee\nReader in Physics\nResearch:\n- lakes\n  - deep ones\n- ice\nYear | Title\n2019 | On ice\n\nThey study how lakes freeze.\nAnd how they thaw.\n© 2020 Uni"
    root = layout.line_tree(text, ["ann", "lee"])
    assert [c.tag for c in root.children] == ["nav", "article", "footer"] or [c.tag for c in root.children] == ["nav", "article", "notice"]
    assert layout.lines_of(root) == ([4, 5, 6, 7, 8, 9, 10, 11, 13, 14], [0, 1, 2, 15])
    assert layout.render_lines(root).split("\n") == ["Ann Lee", "", "Reader in Physics", "", "Research:", "", "- lakes", "  - deep ones", "- ice", "", "Year  Title", "2019  On ice", "", "They study how lakes freeze.", "And how they thaw."]


def test_recurrent_lines_are_hidden_without_any_phrase(spark):
    def page(n):
        return f"Wander our halls with a brass lantern tonight\nAnn Lee\nReader in Physics\nResearch Interests\nPage {'xyz' * n} is about lakes and how they freeze over the years.\n- lakes and rivers\n- number {'abc' * n} of it"

    rows = [(f"p{n}", f"https://a-u.example/{n}", page(n)) for n in range(8)] + [("q", "https://b.example/", "Wander our halls with a brass lantern tonight\nx"), ("n", None, None)]
    pages = spark.createDataFrame(rows + rows[:1], "id string, profile_url string, raw_text string")
    lines = templates.Templates(pages)
    got = {r.id: lines.numbers()(r._recurs) for r in lines.mark(pages).collect()}
    assert 0 in got["p1"] and 4 not in got["p1"] and got["q"] == set() and got["n"] == set()
    kept, other = layout.main_lines(page(3), ["ann", "lee"], got["p3"])
    assert other == [0] and kept == [1, 2, 3, 4, 5, 6]
    # beyond the bound of what tasks hold, lines are joined instead: the same numbers
    templates.BROADCAST_BYTES, held = 0, templates.BROADCAST_BYTES
    try:
        lines = templates.Templates(pages)
        assert {r.id: lines.numbers()(r._recurs) for r in lines.mark(pages).collect()} == got
    finally:
        templates.BROADCAST_BYTES = held


def test_residue_of_a_sample_without_content(spark):
    rows = [(f"r{n}", "Ann Lee", "Error", t, "https://a.example/x") for n, t in enumerate(RESIDUE)]
    few = spark.createDataFrame(rows + [("g", "Ann Lee", None, "Zorb blint quaffle", None)], "id string, profile_name string, title string, raw_text string, profile_url string")
    assert isinstance(residue.fit(few), residue.WeakLabels)
    assert {r.id for r in residue.residue(few).collect()} >= {"r0", "r2"} and residue.residue(few).where("id = 'g'").count() == 0
    # the sample has its bound, whatever the number of pages
    assert len(residue.sample_rows(few, max_train=3)) == 3


RESIDUE = ["404\nThe page you are looking for could not be located.", "Dr. {{ last_name }} joined the Department of {{ department }}", "", "Lorem ipsum dolor sit amet, consectetur adipiscing elit.", "Please turn on JavaScript and reload this page"]


@pytest.fixture(scope="module")
def records(spark):
    rows = [(f"r{n}", "Ann Lee", "Error", t, "https://a.example/x") for n, t in enumerate(RESIDUE)]
    rows += [(f"g{n}", "Ann Lee", "Ann Lee", PROFILE + f"\nMore text of page {n} about the lakes and the rivers of the country.", "https://b.example/y") for n in range(12)]
    rows += [("null", None, None, None, None), rows[0], ("marker", "Ann Lee", None, PROFILE.replace("Teaching:", "TODO: add portrait\nTeaching:"), None)]
    return spark.createDataFrame(rows, "id string, profile_name string, title string, raw_text string, profile_url string").withColumn("dense", F.lit(1)).withColumn("host", F.lit("h"))


def test_residue(spark, records):
    assert {r.id for r in residue.residue(records).collect()} == {f"r{n}" for n in range(len(RESIDUE))} | {"null"}
    assert residue.residue(records.limit(0)).count() == 0
    fetches = spark.createDataFrame([({"status": "404"}, {"profile_id": "r0"}), ({"status": "x"}, {}), (None, None)], "fetch_info map<string,string>, profile_context map<string,string>")
    assert residue.residue(records, fetches).count() == len(RESIDUE) + 1


def test_unseen_hosts(spark, records):
    found = residue.validate(residue.sample_rows(records))
    assert found["accuracy"] > 0.9


def test_main_text_leaves_residue_out(spark, records):
    lines = {tuple(r) for r in main_text.boilerplate(records).where("id in ('r0', 'g0', 'null')").collect()}
    assert {i for i, _ in lines} == {"g0"} and ("g0", 0) in lines and ("g0", 10) not in lines
    text = main_text.main_text(records).where("id = 'g1'").first().text
    assert "lakes freeze" in text and "Subscribe" not in text
    assert main_text.boilerplate(records.limit(0)).count() == 0


def test_pages_and_residue_share_a_model(spark, data, monkeypatch):
    fitted, fit = [], residue.fit

    def kept(*args, **more):
        fitted.append(fit(*args, **more))
        return fitted[-1]

    monkeypatch.setattr(residue, "fit", kept)
    # pages of unclear wording whose fetches failed: only the fetch records tell their labels
    read = queries.read_table
    pages, fetches = read(spark, data, "extracted_content"), read(spark, data, "source_record")
    odd = [(f"odd{n}", "Zyx Qwv", None, "Zorb blint quaffle", "https://odd.example/a") for n in range(40)]
    odd = spark.createDataFrame(odd, "id string, profile_name string, title string, raw_text string, profile_url string")
    failed = odd.selectExpr("map('status', '503') as fetch_info", "map('profile_id', id) as profile_context")
    tables = {"extracted_content": pages.select(*odd.columns).unionByName(odd), "source_record": fetches.select(*failed.columns).unionByName(failed)}
    monkeypatch.setattr(queries, "read_table", lambda s, d, t: tables[t])
    for q in ("p6_found", "p3_found", "p3_main_text"):
        queries.queries()[q](spark, data)
    assert len(fitted) == 3 and all((m.hashed == fitted[0].hashed).all() and (m.dense == fitted[0].dense).all() for m in fitted)


class Counted:
    """An expression that counts how often it is tried."""

    def __init__(self, pattern):
        self.pattern, self.tried = pattern, 0

    def search(self, s):
        self.tried += 1
        return self.pattern.search(s)


def test_positions_are_sought_only_in_lines_that_hold_a_stem(monkeypatch):
    counted = Counted(layout._POSITION)
    for m in (layout, residue):
        if hasattr(m, "_POSITION"):
            monkeypatch.setattr(m, "_POSITION", counted)
    plain = "\n".join(f"The river rose in spring {n} and fell again." for n in range(200))
    residue.features(plain, "Ada Quill", "River notes")
    assert counted.tried < 10  # each of the 200 lines before
    for s in ("Profeſſor of law", "DİRECTOR", "CATEDRÁTICO", "wıssenschaftliche Hilfe", "Professeure émérite", "Profesor", "profesora", "Investigador", "maîtresse de conférences", "Chercheuse"):
        assert layout.has_position(s) and counted.pattern.search(s), s
    assert not layout.has_position("subreaders professorial")


def test_words_and_parts_are_those_of_the_plain_forms(spark, data):
    odd = ["", "a_b __ c1²½٣ {x}$%<>@#[]", "straße éa_1 naïve２", "𝐀bc é 𠀀x ſıK", "x" * 50 + "1998"]
    texts = queries.read_table(spark, data, "extracted_content").limit(60).collect()
    for s in odd + [(r.raw_text or "").lower() for r in texts]:
        assert residue.words_of(s) == residue._WORD.findall(s)
    for r in texts:
        own = layout.name_words(r.profile_name or "")
        kinds = layout.elements(r.raw_text or "", own)
        assert layout.parted(kinds) == layout.lines_of(layout.line_tree(r.raw_text or "", own, kinds=kinds))


def test_lines_are_stripped_as_a_whole_text(spark):
    rows = [
        ("a", "Great River University\n\n12 ΟΔΟΣ Straße 7\n  one \nA Β C d e f g h i j k l", "https://www.greatriver.edu/p"),
        ("b", "ab\ncdefgh everywhere and always\nlong " + "word " * 40, "https://ab\ncdefgh.edu/x"),
        ("c", None, None),
        ("d", "", ""),
    ]
    pages = spark.createDataFrame(rows, "id string, raw_text string, profile_url string")
    keyed = templates._keyed(pages)
    plan = keyed._jdf.queryExecution().optimizedPlan().toString()
    assert "regexp_replace(" in plan and not re.search(r"lambdafunction\((?:named_struct|struct)\([^\n]*?(?:regexp_replace|translate)\(", plan)  # once for a text, not for each line
    own = {"a": "greatriver", "b": "", "c": "", "d": ""}
    found = {r.id: r for r in keyed.collect()}
    for key, text, _ in rows:
        lines = [] if text is None else text.split("\n")
        letters = spark.createDataFrame([(n, re.sub(r"[^\w#]|[\d_]", "", s.lower().replace(own[key], "#") if own[key] else s.lower()), s) for n, s in enumerate(lines)] or [(-1, "", "")], "n int, p string, s string")
        hashed = {r.n: r for r in letters.selectExpr("n", "p", "s", f"{(1 << 63) - 1} & xxhash64(p) as h").collect()}
        expected = []
        for n in range(len(lines)):
            p, s, h = hashed[n].p, hashed[n].s, hashed[n].h
            size, digits = len(p.replace("#", "")), sum(c in "0123456789" for c in s)
            expected.append((h if size <= templates.PROSE else -h) if " " in s.strip(" ") and size >= templates.LETTERS and digits * 4 <= size else 0)
        assert found[key]["_keys"] == expected, key
