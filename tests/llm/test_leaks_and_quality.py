import random
import re

import numpy as np

from lectern.llm import leakage, quality


def runs(text, n=13):
    w = re.findall(r"[^\W_]+", (text or "").lower())
    return {tuple(w[i : i + n]) for i in range(len(w) - n + 1)}


def corpus(seed=3):
    rnd = random.Random(seed)
    vocabulary = [f"word{i}" for i in range(400)]
    items = [(k, " ".join(rnd.choice(vocabulary) for _ in range(rnd.randint(10, 60)))) for k in range(25)]
    items += [(100, None), (101, ""), (102, items[5][1]), (103, "too short to share")]
    docs = []
    for d in range(250):
        w = [rnd.choice([*vocabulary, "other", "filler", "text"]) for _ in range(rnd.randint(5, 150))]
        if d % 4 == 0:
            own = items[d % 25][1].split()
            a = rnd.randint(0, max(0, len(own) - 13))
            w[len(w) // 2 : len(w) // 2] = own[a : a + rnd.choice([12, 13, 20])]
        docs.append((d, (", " if d % 2 else " ").join(x.upper() if d % 3 == 0 else x for x in w)))
    docs += [(1000, None), (1001, ""), (1002, items[0][1]), (1002, items[0][1])]
    return items, docs


def test_leaks_against_brute_force(spark):
    items, docs = corpus()
    want = {(d, i) for d, t in docs for i, s in items if runs(t) & runs(s)}
    ds = spark.createDataFrame(docs, "doc_id bigint, text string").selectExpr("*", "1 as terms", "2 as item_id")
    es = spark.createDataFrame(items, "item_id bigint, item_text string").selectExpr("*", "3 as doc_id")
    assert {(r.doc_id, r.item_id) for r in leakage.leaks(ds, es).collect()} == want and len(want) > 30
    assert leakage.leaks(ds.limit(0), es).count() == 0 and leakage.leaks(ds, es.limit(0)).count() == 0


def test_paraphrases(spark):
    item = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi"
    doc = item.replace("eta theta", "eta xi theta", 1)
    ds, es = spark.createDataFrame([(1, doc)], "doc_id bigint, text string"), spark.createDataFrame([(1, item)], "item_id bigint, item_text string")
    assert leakage.leaks(ds, es).count() == 0
    assert [(r.doc_id, r.run_hits) for r in leakage.leaks(ds, es, paraphrases=True).collect()] == [(1, 0)]


def test_paraphrases_with_words_of_no_item(spark):
    vocabulary = [f"w{i}" for i in range(60)]
    items = [(k, " ".join(random.Random(k).sample(vocabulary, 30) + [f"own{k}x{i}" for i in range(10)])) for k in range(8)]
    docs = []
    for d in range(160):
        rnd = random.Random(1000 + d)
        own = items[d % 8][1].split()
        a = rnd.randint(18, len(own) - 13)
        part = own[a : a + 13]
        for i in rnd.sample(range(13), rnd.randint(1, 5)):
            part[i] = f"strange{rnd.randint(0, 9)}"
        docs.append((d, " ".join([f"other{rnd.randint(0, 99)}" for _ in range(rnd.randint(0, 30))] + part + ["outside"] * (d % 5))))

    def lcs(a, b):
        row = [0] * (len(b) + 1)
        for x in a:
            last = row
            row = [0]
            for j, y in enumerate(b, 1):
                row.append(last[j - 1] + 1 if x == y else max(last[j], row[-1]))
        return row[-1]

    want = {}
    for d, t in docs:
        w = t.split()
        for k, s in items:
            u = s.split()
            for b in range(len(u) - 12):
                own = {x for x in u[b : b + 13] if sum(x in i.split() for _, i in items) <= 2}
                for a in range(max(len(w) - 20, 0) + 1):
                    kept, n = len(own & set(w[a : a + 20])), lcs(w[a : a + 20], u[b : b + 13])
                    if kept >= 2 and kept >= len(own) / 2 and n >= 10:
                        want[d, k] = max(want.get((d, k), 0), n)
    ds, es = spark.createDataFrame(docs, "doc_id bigint, text string"), spark.createDataFrame(items, "item_id bigint, item_text string")
    assert leakage.leaks(ds, es).count() == 0 and 20 < len(want) < 140
    assert {(r.doc_id, r.item_id): round(r.lcs_share * 13) for r in leakage.leaks(ds, es, paraphrases=True).collect()} == want


def test_subsequence():
    assert leakage.common_subsequence(np.array([1, 2, 3, 4]), np.array([2, 4, 3])) == 2
    assert leakage.common_subsequence(np.array([], dtype=int), np.array([1])) == 0


PROSE = "The group of the lake has been at work for years, and it is with the help of many that the results are known to all of us. "


def test_repeats_behind_a_varied_start():
    sets = {k: frozenset(v) for k, v in quality.COMMON.items()}
    rnd = random.Random(5)
    varied = " ".join("".join(rnd.choices("abcdefghijklmnopqrstuvwxyzäé", k=rnd.randint(2, 9))) for _ in range(40_000))
    at = quality.STATS.index("repeat_share")
    assert len(varied) > 200_000 and quality.stats(varied, sets)[2][at] == 0
    text = varied + " the same again" * 400_000
    assert quality.stats(text, sets)[2][at] > 0.3
    for t in (varied, PROSE * 3, PROSE * 3000, "é\ud800" * 70_000):
        raw = t.encode("utf-8", "replace")
        assert quality._compressed_share(t) == len(quality.zlib.compress(raw, 1)) / len(raw)


def test_not_prose(spark):
    docs = [(n, PROSE * (1 + n % 3)) for n in range(40)] + [(100 + n, "\n".join(f"CODE{n}{i} | Hall | 3{i}" for i in range(12))) for n in range(20)]
    docs += [(200, None), (201, " \n"), (202, PROSE.upper()), (203, "x" * 300_000), (204, "1.5 2.5\n" * 50), (0, PROSE)]
    labels = [(n, 1) for n in range(30)] + [(100 + n, 0) for n in range(15)] + [(5, 1), (None, 1), (7, None), (9999, 0)]
    d = spark.createDataFrame(docs, "doc_id bigint, text string").selectExpr("*", "1 as distance", "2 as is_prose")
    lab = spark.createDataFrame(labels, "doc_id bigint, is_prose int")
    assert {r.doc_id for r in quality.not_prose(d, lab).collect()} == {*range(100, 120), 200, 201, 203, 204}
    r = quality.scored(d, lab).where("doc_id = 110").first()
    assert abs(sum(r[f"{s}_part"] for s in quality.STATS) - r.distance) < 1e-6 * max(1, r.distance)
    assert quality.not_prose(d.limit(0), lab).count() == 0
    assert {r.doc_id for r in quality.not_prose(d, lab.limit(0)).collect()} == {200, 201, 204}


def test_items_in_blocks_give_the_same(spark, monkeypatch):
    words = [f"{a}{b}" for a in ("lake", "river", "glass", "stone", "wind", "moss") for b in ("a", "e", "i", "o", "u", "y")]
    rng = np.random.default_rng(7)
    items = [(n, " ".join(rng.choice(words, 30))) for n in range(8)]
    docs = [(n, "before that came " + " ".join(items[n % 8][1].split()[5:20]) + " and so on") for n in range(16)] + [(99, "nothing of it"), (100, None)]
    d, i = spark.createDataFrame(docs, "doc_id bigint, text string"), spark.createDataFrame(items, "item_id bigint, item_text string")
    for paraphrases in (False, True):
        whole = {(r.doc_id, r.item_id, r.run_hits) for r in leakage.leaks(d, i, paraphrases=paraphrases).collect()}
        monkeypatch.setattr(leakage, "BLOCK_CHARS", 200)
        monkeypatch.setattr(leakage, "TARGETS", 3)
        parts = {(r.doc_id, r.item_id, r.run_hits) for r in leakage.leaks(d, i, paraphrases=paraphrases).collect()}
        monkeypatch.undo()
        assert parts == whole and {(n, n % 8) for n in range(16)} <= {(a, b) for a, b, _ in whole}
