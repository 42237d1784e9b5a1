"""Periodic runs against brute force."""

import random

import pytest
from hypothesis import given, settings as options
from hypothesis import strategies as st

from daybook.llm import runs


def brute(w, least):
    found = {}
    for q in range(1, len(w) // 2 + 1):
        i = 0
        while i + q < len(w):
            start = i
            while i + q < len(w) and w[i] == w[i + q]:
                i += 1
            if i - start + q >= max(2 * q, least):
                found.setdefault((start, i - start + q), q)
            i += 1
    return sorted(((s, n, q) for (s, n), q in found.items()), key=lambda r: (r[0], r[2]))


def same(documents, least):
    got = [[tuple(r) for r in found.tolist()] for found in runs.find_runs(documents, least)]
    assert got == [brute(d, least) for d in documents]


@pytest.mark.parametrize("seed", range(40))
def test_random_words(seed):
    draw = random.Random(seed)
    documents = []
    for _ in range(5):
        w = [draw.randrange(draw.choice([1, 2, 3, 30])) for _ in range(draw.choice([0, 1, 7, 40, 150]))]
        if w and draw.random() < 0.5:
            start, p = draw.randrange(len(w)), draw.randrange(1, 30)
            w = w[:start] + [w[start + i % p] if start + i % p < len(w) else 0 for i in range(len(w) - start)]
        documents.append(w)
    same(documents, draw.choice([1, 2, 12]))


@options(max_examples=150, deadline=None)
@given(st.lists(st.lists(st.integers(0, 2), max_size=40), max_size=4))
def test_small_alphabets(documents):
    same(documents, 2)


def test_words_with_many_runs():
    a, b = [0], [0, 1]
    while len(b) < 400:
        a, b = b, b + a
    same([b, [0] * 300, [i % 7 for i in range(200)], ([0] * 9 + [1]) * 12], 2)


def test_blocks_looked_up_in_parts(monkeypatch):
    monkeypatch.setattr(runs, "LOOKUPS", 3)
    same([[0, 1, 0, 1, 0, 1, 2] * 9], 2)


def test_columns(spark):
    text = "x " + "a b c " * 5 + "y"
    rows = [(1, text, 5, "k"), (2, None, None, "k"), (3, " \n ", 1, None), (1, text, 5, "k")]
    df = spark.createDataFrame(rows, "doc_id long, text string, runs int, _runs string")
    got = {r["doc_id"]: r for r in runs.with_runs(df).collect()}
    assert [tuple(r) for r in got[1]["runs"]] == [(1, 15, 3)]
    assert got[1]["collapsed"] == "x a b c y" and got[1]["text"] == text and got[1]["_runs"] == "k"
    assert got[2]["runs"] == got[3]["runs"] == [] and got[2]["collapsed"] == got[3]["collapsed"] == ""
    assert runs.with_runs(df).count() == 4
    assert runs.with_runs(df.where("doc_id > 9")).collect() == []


def test_long_text_stands_alone(spark, monkeypatch):
    text = "u v w " * 40_000
    df = spark.createDataFrame([(1, "a " * 20), (2, text), (3, "b c " * 9)], "doc_id long, text string")
    got = {r["doc_id"]: [tuple(x) for x in r["runs"]] for r in runs.with_runs(df).collect()}
    assert got == {1: [(0, 20, 1)], 2: [(0, 120_000, 3)], 3: [(0, 18, 2)]}
