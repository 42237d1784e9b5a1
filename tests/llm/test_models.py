"""Nearest neighbours, classifiers, language model."""

import math
import random
from collections import Counter
from dataclasses import replace

import numpy as np
import pytest

from daybook.llm import ann, katz, linear, quality, toxicity


def exact(vectors, queries, k):
    out = {}
    for q, v in queries.items():
        scores = []
        for i, x in vectors:
            if i != q:
                scores.append((-float(np.dot(v, x) / (np.linalg.norm(v) * np.linalg.norm(x))), i))
        out[q] = sorted(scores)[:k]
    return out


def test_nearest_by_brute_force(spark):
    rng = np.random.default_rng(4)
    centres = rng.standard_normal((20, 16))
    rows = [(i, (centres[i % 20] + 0.4 * rng.standard_normal(16)).tolist(), 1) for i in range(600)]
    rows += [(1000 + i, rows[7][1], 1) for i in range(300)]
    bad = [(2000, None, 1), (2001, [0.0] * 16, 1), (2002, [math.nan] * 16, 1), (2003, [None] + [1.0] * 15, 1),
           (2004, [math.inf] * 16, 1), (2005, [], 1), (None, rows[0][1], 1), (50, rows[50][1], 1)]
    vectors = spark.createDataFrame(rows + bad, "vec_id long, embedding array<double>, score int")
    got = {}
    for r in ann.nearest(vectors, vectors.where("vec_id % 50 = 0")).collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    plain = [(i, np.array(v)) for i, v, _ in rows]
    want = exact(plain, {i: v for i, v in plain if i % 50 == 0}, 5)
    assert set(got) == set(want)
    hits = 0
    for q, near in want.items():
        mine = sorted(got[q])
        assert [r for r, _, _ in mine] == list(range(1, len(mine) + 1))
        hits += len({i for _, i, _ in mine} & {i for _, i in near})
    assert hits >= 0.9 * 5 * len(want)
    # Copies of one vector: ties go to the smaller id, and the query itself is left out.
    assert [i for _, i, _ in sorted(got[1050])] == [7, 1000, 1001, 1002, 1003]


def test_nearest_of_few(spark):
    rows = [(0, [1.0, 0.0]), (50, [0.0, 2.0]), (3, [1.0, 1.0, 1.0])]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = [tuple(r) for r in ann.nearest(vectors, vectors.where("vec_id % 50 = 0")).collect()]
    assert all(i != q and i != 3 for q, _, i, _ in got)
    assert ann.nearest(vectors.limit(0), vectors.limit(0)).count() == 0


def test_nearest_of_very_small_and_large_numbers(spark):
    """No size of the components makes a cosine fail or come out as no number."""
    rows = [(0, [1e-200, 0.0]), (50, [1e200, 0.0]), (1, [1e-200, 1e-200]), (2, [1e200, 1e200]), (3, [1.0, 0.0]),
            (4, [5e-324, 0.0]), (5, [1.7e308, 1e-300])]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = {}
    for r in ann.nearest(vectors, vectors.where("vec_id % 50 = 0"), k=6).collect():
        got.setdefault(r["query_id"], {})[r["vec_id"]] = r["score"]
    for q, other in ((0, 50), (50, 0)):
        assert {i: got[q][i] for i in (3, 4, 5, other)} == {3: 1.0, 4: 1.0, 5: 1.0, other: 1.0}
        assert all(got[q][i] == pytest.approx(math.sqrt(0.5)) for i in (1, 2) if i in got[q])


# --- classifiers ---


def test_the_look_of_a_word_is_that_of_all_of_it():
    ends = ["x0" * 40 + "!", "x0" * 40 + "?"]
    looks = [quality._look(w) for w in ends]
    assert looks[0] != looks[1]


def test_the_sample_has_one_row_of_an_id(spark):
    docs = spark.range(1000).selectExpr("CAST(1 AS LONG) AS doc_id", "'copy ' || id AS text")
    docs = docs.unionByName(spark.createDataFrame([(2, "two"), (None, "x"), (3, None)], "doc_id long, text string"))
    labels = spark.createDataFrame([(1, 1), (2, 0), (3, 0)], "doc_id long, label int")
    got = [tuple(r) for r in linear.labelled_sample(docs, labels, linear.Settings()).collect()]
    assert sorted(got, key=str) == sorted([("copy 0", 1), ("two", 0), (None, 0)], key=str)


def sentences(draw, n, word):
    words = ["the", "of", "and", "water", "house", "tree", "light", "stone"]
    out = []
    for i in range(n):
        text = [draw.choice(words) for _ in range(draw.randint(3, 30))]
        if i % 3 == 0:
            text.insert(draw.randrange(len(text)), word)
        out.append((" ".join(text), int(i % 3 == 0)))
    return out


@pytest.mark.parametrize("module, fit, score", [
    (quality, quality.fit_quality, quality.score_quality), (toxicity, toxicity.fit_toxicity, toxicity.score_toxicity)])
def test_classifier_on_held_out_rows(spark, module, fit, score):
    rows = [(i, t, y) for i, (t, y) in enumerate(sentences(random.Random(1), 600, "horrid!!"))]
    docs = spark.createDataFrame([(i, t, 0.5) for i, t, _ in rows] + [(900, None, 1.0), (901, "", 1.0), (901, "", 1.0)], "doc_id long, text string, score double")
    labels = spark.createDataFrame([(i, y) for i, _, y in rows if i < 400] + [(None, 1), (5, None), (77777, 1)], "doc_id long, label int")
    settings = replace(module.SETTINGS, dims=1 << 14)
    model = fit(docs, labels, settings)
    got = {r["doc_id"]: r for r in score(docs, model, settings).collect()}
    right = sum(got[i]["predicted"] == y for i, _, y in rows if i >= 400)
    assert right >= 195
    assert all(0 <= r["score"] <= 1 for r in got.values())
    assert got[900]["score"] == got[901]["score"]
    assert score(docs, model, settings).count() == len(rows) + 3


def test_fit_without_both_labels(spark):
    for labels, want in (([], 0.5), ([(1, 1)], 1.0), ([(1, 0)], 0.0)):
        docs = spark.createDataFrame([(1, "some text")], "doc_id long, text string")
        model = quality.fit_quality(docs, spark.createDataFrame(labels, "doc_id long, label int"))
        assert quality.score_quality(docs, model).first()["score"] == pytest.approx(want, abs=0.01)


def test_the_sample_is_bounded(spark):
    docs = spark.range(3000).selectExpr("id AS doc_id", "'x' AS text")
    labels = docs.selectExpr("doc_id", "CAST(doc_id % 10 = 0 AS INT) AS label")
    sizes = Counter(r["label"] for r in linear.labelled_sample(docs, labels, linear.Settings(per_class=400)).collect())
    assert sizes[1] == 300 and 330 < sizes[0] < 470


# --- language model ---


def plain_katz(texts, trained):
    tokens = [[w for w in (t or "").translate({c: c + 32 for c in range(65, 91)}).split()] + [""] for t in texts]
    single, pairs = Counter(), Counter()
    for row, yes in zip(tokens, trained, strict=True):
        if yes:
            single.update(row)
            pairs.update(zip([None, *row[:-1]], row, strict=True))
    n = sum(single.values())

    def discounted(counts):
        of = Counter(counts.values())
        d = katz.discounts([of[r] for r in range(1, katz.GOOD_TURING + 2)])
        return lambda c: d[c - 1] * c if c <= katz.GOOD_TURING else c - katz.LARGE_DISCOUNT

    d1, d2 = discounted(single), discounted(pairs)
    kept = sum(map(d1, single.values()))
    unknown = max(1 - kept / n, 1 / (n + 1)) if n else 1.0
    share = lambda w: d1(single[w]) * (1 - unknown) / kept if single[w] else unknown
    total, mass, low = Counter(), Counter(), Counter()
    for (v, w), c in pairs.items():
        total[v] += c
        mass[v] += d2(c)
        low[v] += share(w)
    weight = {v: (1 - mass[v] / total[v]) / (1 - low[v]) for v in total}
    for v in weight:
        whole = sum(d2(pairs[v, w]) / total[v] if pairs[v, w] else weight[v] * share(w) for w in single)
        assert whole + weight[v] * unknown == pytest.approx(1)
    out = []
    for row in tokens:
        score = 0.0
        for v, w in zip([None, *row[:-1]], row, strict=True):
            c = pairs[v, w]
            score += math.log10(d2(c) / total[v]) if c else math.log10(weight.get(v, 1.0) * share(w))
        base = sum(math.log10((single[w] + 0.1) / (n + 0.1 * (len(single) + 1))) for w in row)
        out.append((len(row), sum(single[w] > 0 for w in row), n, base, score))
    return out


@pytest.mark.parametrize("parts", [1, 5])
def test_scores_by_brute_force(spark, monkeypatch, parts):
    monkeypatch.setattr(katz, "MIN_PARTS", parts)
    monkeypatch.setattr(katz, "BLOCK_TOKENS", 500)
    draw = random.Random(6)
    words = ["The", "of", "x"] * 20 + [f"w{i}" for i in range(200)]
    texts = [" ".join(draw.choice(words) for _ in range(draw.randrange(60))) for _ in range(120)] + [None, "", "the " * 3000]
    rows = [(i, t, i % 4 != 0) for i, t in enumerate(texts)]
    rows.append(rows[5])
    docs = spark.createDataFrame(rows, "doc_id long, text string, yes boolean")
    want = plain_katz([r[1] for r in rows], [r[2] for r in rows])
    got = {r["doc_id"]: r for r in katz.scores(docs, docs["yes"]).collect()}
    for (i, _, _), (n, known, train, base, score) in zip(rows, want, strict=True):
        r = got[i]
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (n, known, train)
        assert r["base_score"] == pytest.approx(base, rel=1e-9)
        assert r["score"] == pytest.approx(score, rel=1e-9)


def test_language_model_edge_cases(spark):
    docs = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string")
    none = katz.scores(docs, docs["doc_id"] > 5).collect()
    assert {r["score"] for r in none} == {0.0} and {r["train_tokens"] for r in none} == {0}
    assert katz.scores(docs.limit(0), docs["doc_id"] > 0).count() == 0


# --- the fit itself ---


def _problem(seed, n=60, dims=24):
    rng = np.random.default_rng(seed)
    rows = [np.unique(rng.integers(0, dims, 6)).astype(np.int32) for _ in range(n)]
    labels = np.array([int((r < dims // 3).sum() + rng.random() > 2.2) for r in rows])
    return rows, labels


def _objective(rows, labels, ratio, w, b, cost):
    y = np.where(labels == 1, 1.0, -1.0)
    loss = sum(max(0.0, 1 - y[i] * (float(w[r] @ ratio[r]) + b)) for i, r in enumerate(rows))
    return 0.5 * (float(w @ w) + b * b) + cost * loss


@pytest.mark.parametrize("seed", range(3))
@pytest.mark.parametrize("cost", [0.05, 1.0])
def test_descent_reaches_the_minimum_of_a_plain_solver(seed, cost):
    """The bias is a constant feature, so the plain solver is subgradient descent on the same sum."""
    rows, labels = _problem(seed)
    ratio = linear._ratios(rows, labels, np.arange(len(rows)), 1, 0.0, 24)
    settings = linear.Settings(cost=cost, epochs=300)
    weights, b = linear._descend(rows, labels, np.arange(len(rows)), ratio, settings, np.random.default_rng(1))
    with np.errstate(invalid="ignore", divide="ignore"):
        w = np.where(ratio != 0, weights / ratio, 0.0)
    mine = _objective(rows, labels, ratio, w, b, cost)
    y, plain, bias, best = np.where(labels == 1, 1.0, -1.0), np.zeros(24), 0.0, math.inf
    for step in range(1, 4000):
        grad, grad_b = plain.copy(), bias
        for i, r in enumerate(rows):
            if y[i] * (float(plain[r] @ ratio[r]) + bias) < 1:
                grad[r] -= cost * y[i] * ratio[r]
                grad_b -= cost * y[i]
        plain, bias = plain - grad / (step + 10), bias - grad_b / (step + 10)
        best = min(best, _objective(rows, labels, ratio, plain, bias, cost))
    assert mine <= best * 1.001


def test_the_best_floor_is_chosen():
    """With few examples a high floor sees nothing; the fit must take the low one."""
    rng = np.random.default_rng(3)
    rows = [np.unique(np.r_[rng.integers(10, 4000, 40), [1, 2] if i % 10 == 0 else []]).astype(np.int32) for i in range(120)]
    labels = np.array([int(i % 10 == 0) for i in range(120)])
    settings = linear.Settings(dims=4096, cost=0.1, choices=((50, 1.0), (4, 1.0)))
    model = linear.fit_arrays(rows, labels, settings)
    scores = np.array([model.score(float(model.weights[r].sum())) for r in rows])
    assert ((scores >= 0.7) == (labels == 1)).mean() > 0.97
    assert linear._average_precision(np.array([3.0, 2.0, 1.0]), np.array([1, 0, 1])) == pytest.approx((1 + 2 / 3) / 2)
