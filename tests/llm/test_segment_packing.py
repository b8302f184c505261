import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from lectern.llm import packing, segment


def check(text, limit, overlap):
    pieces = segment.split(text, limit, overlap)
    assert pieces[0][0] == 0 and pieces[-1][1] == len(text)
    for (a, b, s), (c, d, o) in zip(pieces, pieces[1:], strict=False):
        assert c == b - o and 0 <= o <= overlap and d > b, (a, b, c, d)
    assert all(b - a <= limit for a, b, _ in pieces)
    assert "".join(text[a + s : b] for a, b, s in pieces) == text
    return pieces


@settings(max_examples=120, deadline=None)
@given(st.text(alphabet=st.sampled_from("ab. \n!é́\U0001f600‍。"), max_size=400), st.integers(8, 60))
def test_pieces_cover_and_stay_under_the_limit(text, limit):
    check(text, limit, limit // 4)


def test_long_texts_of_every_kind():
    check("x" * 250_000, 4000, 200)
    check("word " * 60_000, 4000, 200)
    check("One sentence here. " * 20_000, 4000, 200)
    assert check("", 4000, 200) == [(0, 0, 0)]


def test_cuts_between_topics():
    a = "Grain storage barns keep barley harvest dry. " * 30
    b = "Violin concert music orchestra melody plays. " * 30
    pieces = segment.split(a + b, 2000, 100)
    assert abs(pieces[0][1] - len(a)) <= 45


def test_table_of_pieces(spark):
    rows = [("a", "s. " * 2000, "x"), ("a", "s. " * 2000, "x"), ("b", "short", "y"), ("c", None, "z"), ("d", "", "w"), (None, "n" * 5000, "q")]
    pages = spark.createDataFrame(rows, "id string, cleaned_text string, piece_no string")
    assert [r.id for r in segment.oversized(pages).collect()] == ["a"]
    got = segment.pieces(pages)
    assert {r.id for r in got.collect()} == {"a", "b", "d"}
    assert got.where("id = 'a'").count() == len(segment.split("s. " * 2000))
    assert segment.pieces(pages.limit(0)).count() == 0


def brute(histogram, capacity):
    return sum(n * k for k, n in histogram.items()) / capacity


@pytest.mark.parametrize("seed", range(6))
def test_patterns_place_each_length_once(seed):
    rnd = random.Random(seed)
    histogram = {rnd.randint(1, 100): rnd.randint(1, 400) for _ in range(rnd.randint(1, 60))}
    found = packing.patterns(histogram, 100)
    placed: dict[int, int] = {}
    for n, content in found:
        assert n > 0 and sum(k * m for k, m in content.items()) <= 100
        for k, m in content.items():
            placed[k] = placed.get(k, 0) + n * m
    assert placed == histogram
    least = brute(histogram, 100)
    if sum(n for k, n in histogram.items() if k <= 20) > sum(histogram.values()) / 2:
        assert sum(n for n, _ in found) <= 1.12 * least + 1


def test_packing_of_documents(spark):
    counts = [(i, n) for i, n in enumerate([5000, 2048, 2047, 1, 0, *[700] * 500, *[3] * 50])] + [(9999, 700), (9999, 700), (10_000, None)]
    df = spark.createDataFrame(counts, "doc_id bigint, n_tokens int")
    got = packing.pack(df).collect()
    fill: dict[int, int] = {}
    for r in got:
        if r.container is not None:
            fill[r.container] = fill.get(r.container, 0) + r.n_tokens
    assert max(fill.values()) <= 2048 and sum(fill.values()) == sum(n or 0 for _, n in counts)
    assert sorted((r.part, r.first_token, r.n_tokens) for r in got if r.doc_id == 0) == [(0, 0, 2048), (1, 2048, 2048), (2, 4096, 904)]
    assert [r.container for r in got if r.doc_id in (4, 10_000)] == [None, None]
    slots = [(r.container, r.slot) for r in got if r.container is not None]
    assert len(slots) == len(set(slots))
    assert packing.pack(df.limit(0)).count() == 0


def test_token_counts(spark):
    df = spark.createDataFrame([(1, "Hello world"), (2, ""), (3, None)], "doc_id bigint, text string")
    assert {tuple(r) for r in packing.token_counts(df).collect()} == {(1, 2), (2, 0), (3, 0)}


def test_two_texts_of_one_id_give_the_pieces_of_one(spark):
    a, b = "first text here. " * 600, "some other words. " * 500
    rows = [("x", a), ("x", b), ("x", a), ("y", "short"), (None, a), ("z", None)]
    got = segment.pieces(spark.createDataFrame(rows, "id string, cleaned_text string")).collect()
    parts = sorted((r.piece_no, r.piece[r.overlap :]) for r in got if r.id == "x")
    assert "".join(p for _, p in parts) == max(a, b) and {r.id for r in got} == {"x", "y"}
