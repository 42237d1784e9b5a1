"""Phrase mining against brute force."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from daybook.llm import phrases

SCHEMA = "text string, lang string, shard string, n int"


def frame(spark, rows):
    return spark.createDataFrame([(*r, "theirs", 1) for r in rows], SCHEMA)


def counted_of(rows):
    counts = defaultdict(Counter)
    for text, lang in rows:
        low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", low):
            w = re.findall(r"[^\x20\x09]+", piece)
            for n in range(1, 5):
                counts["und" if lang is None else lang].update(" ".join(w[i : i + n]) for i in range(len(w) - n + 1))
    return counts


def brute(rows, support, top):
    out = []
    for lang, counts in counted_of(rows).items():
        n = sum(c for p, c in counts.items() if " " not in p)
        many = {p: c for p, c in counts.items() if " " in p and c >= support}
        found = []
        for p, a in many.items():
            w = p.split(" ")
            cuts = [(counts[" ".join(w[:k])], counts[" ".join(w[k:])], k) for k in range(1, len(w))]
            score, _, left, right = min((2_000_000 * a // (x + y), k, x, y) for x, y, k in cuts)
            if not any(f" {p} " in f" {q} " and q != p and 100 * b >= 80 * a for q, b in many.items()):
                found.append((-score, -a, p.encode(), left, right))
        for rank, (score, a, p, left, right) in enumerate(sorted(found)[:top], 1):
            out.append((lang, rank, p.decode(), -a, left, right, n, -score))
    return sorted(out)


def corpus(seed):
    draw = random.Random(seed)
    words = ["The", "the", "of", "É", "zoë", "x", "new", "York", "city", "a-b"]
    rows = [(None, "en"), ("", None), (" ,.; \t", "en")]
    for _ in range(80):
        text = "".join(
            draw.choice(words) + draw.choice([" ", " ", "  ", "\t", ". ", "\n", ", new york city ", "\x0b"])
            for _ in range(draw.randrange(60))
        )
        rows.append((text, draw.choice(["en", "en", "de", None, "und", ""])))
    return rows + rows[5:9]


@pytest.mark.parametrize("seed", range(3))
@pytest.mark.parametrize("support, top, shards", [(1, 40, 8), (7, 5, 8), (30, 2000, 3), (30, None, 8), (5, None, 1)])
def test_as_brute_force(spark, seed, support, top, shards):
    rows = corpus(seed)
    deal_by = None if seed else "n"
    got = phrases.collocations(frame(spark, rows), support=support, top=top, shards=shards, deal_by=deal_by)
    assert sorted(map(tuple, got.collect())) == brute(rows, support, top)


def test_overlaps_and_repeated_rows(spark):
    rows = [("a a a a", "en")] * 3
    got = phrases.phrase_counts(frame(spark, rows), support=3)
    assert {(r["phrase"], r["f"]) for r in got.collect()} == {
        ("", 12),
        ("a", 12),
        ("a a", 9),
        ("a a a", 6),
        ("a a a a", 3),
    }


def test_phrases_of_one_hash_are_told_apart():
    block = phrases._Block()
    for text in ("p q. p q. r s", "P Q\tr"):
        block.add(text, "en", 0)
    block.close(2)
    counts = phrases._Counts(2)
    assert counts.add(block, block.ok[1]) and counts.merge() and sorted(counts.f.tolist()) == [1, 1, 3]
    other = phrases._Block(block.vocabulary)
    other.add("q r q r", "en", 0)
    other.close(2)
    other.keys[1][:] = block.keys[1][0]
    only = np.array([True, False, False, False])
    assert counts.add(other, only) and not counts.merge()
    assert sorted(counts.f.tolist()) == [1, 1, 1, 3]
    block.keys[1][:] = 7
    assert not phrases._Counts(2).add(block, block.ok[1])
    found = phrases._one_by_one(block, 2, block.ok[1])
    assert sorted(map(tuple, found.values.tolist())) == [("en", "p q", 2, 3), ("en", "q r", 2, 1), ("en", "r s", 2, 1)]


@pytest.mark.parametrize("block, counted, waiting", [(20, 10, 5), (50, 10**9, 30), (50, 10**9, 10**9)])
def test_a_task_of_many_blocks(monkeypatch, block, counted, waiting):
    """Without Spark: a task's frames add up, whatever its blocks are."""
    import pandas as pd

    monkeypatch.setattr(phrases, "BLOCK", block)
    monkeypatch.setattr(phrases, "COUNTED", counted)
    monkeypatch.setattr(phrases, "WAITING", waiting)
    monkeypatch.setattr(phrases, "HANDED", 7)
    rows = corpus(3)
    frame_ = pd.DataFrame([(t or "", "und" if lang is None else lang, 0) for t, lang in rows], columns=["text", "lang", "shard"])

    class All:
        value = b"\xff" * (1 << 24)

    got = pd.concat(phrases._phrases(All)(iter([frame_[:40], frame_[40:]])))
    sums = got[got.words > 0].groupby(["lang", "phrase"]).f.sum().to_dict()
    assert sums == {(lang, p): c for lang, counts in counted_of(rows).items() for p, c in counts.items()}


def test_empty_and_rare(spark):
    assert phrases.collocations(frame(spark, []).where("n > 1")).collect() == []
    assert phrases.collocations(frame(spark, [("one two three", "en")])).collect() == []


def test_numbers_beyond_64_bits(spark):
    row = spark.range(1).selectExpr("CAST(9223372036854775807 AS DECIMAL(38,0)) a", "CAST(18446744073709551613 AS DECIMAL(38,0)) w")
    assert row.selectExpr(f"({phrases.SCALE}BD * a) div w AS s").first()["s"] == 2_000_000 * (2**63 - 1) // (2**64 - 3)


def test_few_texts_of_a_batch_are_python_texts_at_a_time():
    texts = ["big red dog", None, "", "big red"] * 1_000
    batch = pa.RecordBatch.from_pydict({"text": texts})
    seen = []

    def count(frames):
        for frame in frames:
            seen.append(len(frame))
            yield phrases._rows([("en", t or "", 1) for t in frame["text"]], [1] * len(frame))

    out = list(phrases._in_arrow(count, phrases._WORDED)(iter([batch])))
    assert max(seen) <= phrases.TEXTS and sum(seen) == len(texts)
    assert [p for b in out for p in b.column("phrase").to_pylist()] == [t or "" for t in texts]


def test_counts_of_blocks_are_added_by_words():
    counts = phrases._Counts(2)
    shared = phrases._Vocabulary()
    for text in ("a b a b c", "b c a b", "x y"):
        block = phrases._Block(shared)
        block.add(text, "en", 0)
        block.close(2)
        assert counts.add(block, block.ok[1])
    assert counts.merge() and counts.merge()
    found = {r.phrase: r.f for frame in counts.rows(shared) for r in frame.itertuples()}
    assert found == {"a b": 3, "b a": 1, "b c": 2, "c a": 1, "x y": 1}


def test_a_task_keeps_the_words_of_candidates_only():
    block, kept = phrases._Block(), phrases._Vocabulary()
    block.add("once upon a time, a time once", "en", 0)
    block.close(2)
    a, words = block.a, block.vocabulary.words
    is_time = np.array([words[x] == b"a" and words[y] == b"time" for x, y in zip(a, a[1:])])
    block.renumber(kept, [np.zeros(len(a), dtype=bool), is_time])
    assert set(kept.words) == {b"\n", b"a", b"time"} and list(kept.langs) == ["en"]
    counts = phrases._Counts(2)
    assert counts.add(block, is_time) and counts.merge()
    assert [tuple(r) for f in counts.rows(kept) for r in f.itertuples(index=False)] == [("en", "a time", 2, 2)]


def test_more_partitions_do_not_hand_on_more_rows(spark, monkeypatch):
    """The rows of the last count are bounded by its tasks times the candidates, not by the input's partitions."""

    def one_row_a_task(candidates):
        def count(batches):
            rows = sum(len(batch) for batch in batches)
            yield phrases._rows([("en", "tasks", 2), ("en", "rows", 2)], [1, rows])

        return count

    docs = frame(spark, [("new york city", "en")] * 60).repartition(30)
    assert phrases.phrase_counts(docs, support=5, tasks=2).where("words = 3").first()["f"] == 60
    monkeypatch.setattr(phrases, "_phrases", one_row_a_task)
    for tasks, most in ((3, 3), (None, spark.sparkContext.defaultParallelism)):
        found = {r["phrase"]: r["f"] for r in phrases.phrase_counts(docs, support=1, tasks=tasks).collect()}
        assert found == {"tasks": most, "rows": 60}
    # 120 word pairs, of which a task is to read 10 at most.
    monkeypatch.setattr(phrases, "TASK_PAIRS", 10)
    assert phrases.phrase_counts(docs, support=1).where("phrase = 'tasks'").first()["f"] == 12
