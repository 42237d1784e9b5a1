"""Removal of repeated passages against brute force, on every way through the operator."""

import random
from collections import Counter

import pytest

from daybook.llm import bits, repeats

SCHEMA = "doc_id long, text string, t1 string, n_words string, _row int"


def frame(spark, texts):
    return spark.createDataFrame([(i, t, "theirs", "old", 7) for i, t in enumerate(texts)], SCHEMA)


def brute(texts, window):
    words = [(t or "").split() for t in texts]
    seen = Counter(tuple(w[i : i + window]) for w in words for i in range(len(w) - window + 1))
    out = []
    for w in words:
        gone = {
            i + j
            for i in range(len(w) - window + 1)
            if seen[tuple(w[i : i + window])] > 1
            for j in range(window)
        }
        out.append((len(w), len(gone), " ".join(x for i, x in enumerate(w) if i not in gone)))
    return out


def corpus(seed, window, n=60):
    """Copies, near copies, shared passages in other surroundings, repeats inside a text, few different words."""
    draw = random.Random(seed)
    word = lambda: draw.choice(["a", "b", "zoë", "x1", "", "  "]) + str(draw.randrange(draw.choice([2, 400])))
    passage = [word() for _ in range(window * 2)]
    texts = [None, "", " \t\n", "one", " ".join(passage[: window - 1])]
    for _ in range(n):
        kind = draw.randrange(6)
        own = [word() for _ in range(draw.randrange(0, 3 * window))]
        if kind == 0 and len(texts) > 6:
            texts.append(draw.choice(texts[5:]))
        elif kind == 1:
            cut = draw.randrange(window)
            texts.append(" ".join(own + passage[cut : cut + window + draw.randrange(-1, 3)] + own[::-1]))
        elif kind == 2:
            texts.append("\n".join(own + own))
        elif kind == 3:
            texts.append(" ".join(["same"] * draw.randrange(0, 3 * window)))
        else:
            texts.append(" ".join(own))
    return texts


def result(df):
    rows = sorted(df.collect(), key=lambda r: r["doc_id"])
    return [(r["n_words"], r["n_removed"], r["text"]) for r in rows]


@pytest.mark.parametrize("seed", range(3))
@pytest.mark.parametrize("window", [12, 35])
def test_as_brute_force(spark, seed, window):
    texts = corpus(seed, window)
    assert result(repeats.drop_repeats(frame(spark, texts), window=window)) == brute(texts, window)


@pytest.mark.parametrize("keys", [0, 1 << 20])
@pytest.mark.parametrize("segments", [1, 3])
def test_hot_anchors_and_large_sets(spark, monkeypatch, keys, segments):
    monkeypatch.setattr(repeats, "ANCHOR_SEGMENTS", segments)
    monkeypatch.setattr(repeats, "BITMAP_KEYS", keys)
    passage = [f"p{i}" for i in range(40)]
    texts = [" ".join([f"l{i}", f"m{i % 3}", *passage[i % 6 :], f"r{i % 4}", f"s{i}"]) for i in range(60)]
    texts += corpus(5, 35, 20)
    assert result(repeats.drop_repeats(frame(spark, texts))) == brute(texts, 35)


def test_repeated_rows_and_columns(spark):
    long_ = " ".join(map(str, range(50)))
    df = frame(spark, [long_]).unionByName(frame(spark, [long_]))
    found = repeats.drop_repeats(df)
    assert found.columns == ["doc_id", "text", "t1", "_row", "n_words", "n_removed"]
    assert [tuple(r) for r in found.collect()] == [(0, "", "theirs", 7, 50, 50)] * 2
    assert [tuple(r) for r in repeats.drop_repeats(frame(spark, [long_])).collect()] == [(0, long_, "theirs", 7, 50, 0)]


def test_empty_table(spark):
    assert repeats.drop_repeats(frame(spark, []).where("doc_id > 0")).collect() == []


def test_automaton_counts_ends():
    draw = random.Random(1)
    for _ in range(200):
        texts = [[draw.randrange(draw.choice([1, 2, 5])) for _ in range(draw.randrange(25))] for _ in range(4)]
        for window in (1, 2, 5):
            seen = Counter(tuple(t[i : i + window]) for t in texts for i in range(len(t) - window + 1))
            automaton = repeats.Automaton(texts)
            for t in texts:
                want = [i for i in range(len(t) - window + 1) if seen[tuple(t[i : i + window])] > 1]
                assert automaton.repeated(t, window) == want


def test_bitmap_holds_every_key(spark):
    keys = spark.range(0, 5000, 7).selectExpr("(id * 1000003) & %d AS i" % bits.MASK)
    found = bits.bitmap(keys["i"], keys)
    import numpy as np

    index = np.array([r["i"] for r in keys.collect()], dtype=np.uint64)
    assert bits.has(np.frombuffer(found.value, dtype=np.uint8), index).all()
    assert sum(bin(b).count("1") for b in found.value) == len(set(index.tolist()))
