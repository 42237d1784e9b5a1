"""Linear text classifiers on naive Bayes support vectors.

Indicators of hashed n-grams are scaled by the log-count ratio of the two classes;
a hinge-loss model is fitted to them by dual coordinate descent. It is fitted on a
bounded sample of the labelled documents, in one task; scoring is a map over all
documents.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daybook.llm.text import unit_interval
from daybook.scratch import stored

#: Labels of so many documents are broadcast to the texts; beyond it both are shuffled by id.
BROADCAST_LABELS = 2_000_000
FOLDS = 3


@dataclass(frozen=True)
class Settings:
    """Parameters of a fit.

    per_class: about so many documents of each label are fitted on, the bound of the
    sample. dims: hashed n-grams, the bound of the model. min_docs: n-grams in fewer
    sampled documents, or with a log-count ratio nearer to zero than min_ratio, weigh
    nothing. cost: of the hinge loss. choices: pairs (min_docs, min_ratio) of which the fit
    takes the one that ranks sampled documents best in cross-validation, which depends on how
    many examples there are; without choices the two above hold.
    """

    per_class: int = 4000
    dims: int = 1 << 18
    min_docs: int = 8
    min_ratio: float = 0.0
    cost: float = 1.0
    epochs: int = 12
    seed: str = "fit"
    choices: tuple[tuple[int, float], ...] = ()


@dataclass(frozen=True)
class Model:
    """score(x) = sigmoid(slope * (sum of weights of the n-grams present + bias) + offset)."""

    weights: np.ndarray
    bias: float
    slope: float
    offset: float

    def score(self, margin: float) -> float:
        z = min(max(self.slope * (margin + self.bias) + self.offset, -500.0), 500.0)
        return float(1.0 / (1.0 + np.exp(-z)))


class Distinct:
    """Distinct values of small integer arrays, without sorting them."""

    def __init__(self, dims: int):
        self._last = np.zeros(dims, dtype=np.int32)

    def __call__(self, values: np.ndarray) -> np.ndarray:
        places = np.arange(len(values), dtype=np.int32)
        self._last[values] = places
        return values[self._last[values] == places]


def fit_arrays(rows: list[np.ndarray], labels: np.ndarray, settings: Settings) -> Model:
    """The model of n-gram rows (arrays of distinct buckets) with labels 0 or 1.

    Without rows of both labels the model is constant: the share of label 1, and
    one half without any rows.
    """
    dims, n = settings.dims, len(rows)
    positive = labels == 1
    if not 0 < positive.sum() < n:
        share = 0.5 if n == 0 else float(positive.mean())
        odds = np.log((share + 1e-3) / (1 - share + 1e-3))
        return Model(np.zeros(dims, np.float32), 0.0, 1.0, float(odds))
    if settings.choices:
        return _fit_chosen(rows, labels, settings)
    rng = np.random.default_rng(7)
    order = rng.permutation(n)
    ratio = _ratios(rows, labels, order, settings.min_docs, settings.min_ratio, dims)
    kept = [row[ratio[row] != 0.0] for row in rows]
    check, train = order[: n // 5], order[n // 5 :]
    w, b = _descend(kept, labels, train, ratio, settings, rng)
    margins = np.array([w[kept[i]].sum() + b for i in check])
    slope, offset = _platt(margins, labels[check])
    w, b = _descend(kept, labels, order, ratio, settings, rng)
    return Model(w.astype(np.float32), float(b), slope, offset)


def _ratios(rows, labels, chosen, min_docs: int, min_ratio: float, dims: int) -> np.ndarray:
    """Log-count ratios of the chosen rows' n-grams, zero where they are too few or too near to zero."""
    counts = np.zeros((2, dims))
    for i in chosen.tolist():
        counts[int(labels[i]), rows[i]] += 1
    of_label = np.array([[(labels[chosen] == 0).sum()], [(labels[chosen] == 1).sum()]])
    share = (counts + 1.0) / (of_label + 2.0)
    ratio = np.log(share[1] / share[0])
    ratio[(counts.sum(axis=0) < min_docs) | (np.abs(ratio) < min_ratio)] = 0.0
    return ratio


def _fit_chosen(rows: list[np.ndarray], labels: np.ndarray, settings: Settings) -> Model:
    """The fit of the best choice; its logistic curve goes through margins of rows it was not fitted on."""
    order = np.random.default_rng(7).permutation(len(rows))
    # Every fold has its share of the rarer label.
    order = order[np.argsort(labels[order], kind="stable")]

    def fitted(chosen: np.ndarray, choice: tuple[int, float]) -> tuple[np.ndarray, float]:
        ratio = _ratios(rows, labels, chosen, *choice, settings.dims)
        kept = {i: rows[i][ratio[rows[i]] != 0.0] for i in chosen.tolist()}
        return _descend(kept, labels, chosen, ratio, settings, np.random.default_rng(7))

    best = None
    for choice in settings.choices:
        margins = np.zeros(len(rows))
        for fold in range(FOLDS):
            inside = np.arange(len(order)) % FOLDS == fold
            w, b = fitted(order[~inside], choice)
            for i in order[inside].tolist():
                margins[i] = w[rows[i]].sum() + b
        precision = _average_precision(margins, labels)
        if best is None or precision > best[0]:
            best = precision, choice, margins
    slope, offset = _platt(best[2], labels)
    w, b = fitted(order, best[1])
    return Model(w.astype(np.float32), float(b), slope, offset)


def _average_precision(margins: np.ndarray, labels: np.ndarray) -> float:
    """Mean, over the rows of label 1, of the share of label 1 among those ranked no lower."""
    ranked = labels[np.argsort(-margins, kind="stable")] == 1
    return float((np.cumsum(ranked) / np.arange(1, len(ranked) + 1))[ranked].mean())


def _descend(rows, labels, chosen, ratio, settings, rng) -> tuple[np.ndarray, float]:
    """Dual coordinate descent for the squared-norm hinge-loss problem.

    A row holds the log-count ratios of its n-grams, scaled to unit length, and a
    constant for the bias. Returned weights apply to indicators, so a margin is
    the plain sum of weights; rows are weighted by their length in the fit alone.
    """
    w, b = np.zeros(len(ratio)), 0.0
    alpha = dict.fromkeys(chosen.tolist(), 0.0)
    values = {i: ratio[rows[i]] for i in chosen.tolist()}
    norm = {i: float(v @ v) + 1.0 for i, v in values.items()}
    for _ in range(settings.epochs):
        for i in rng.permutation(chosen).tolist():
            y = 1.0 if labels[i] == 1 else -1.0
            idx, v = rows[i], values[i]
            gradient = y * (float(w[idx] @ v) + b) - 1.0
            new = min(max(alpha[i] - gradient / norm[i], 0.0), settings.cost)
            step = (new - alpha[i]) * y
            if step:
                alpha[i] = new
                w[idx] += step * v
                b += step
    return w * ratio, b


def _platt(margins: np.ndarray, labels: np.ndarray) -> tuple[float, float]:
    """Slope and offset of the logistic curve through held-back margins, by Newton steps."""
    y = np.where(labels == 1, 0.999, 0.001)
    scale = max(float(np.abs(margins).mean()), 1e-9)
    x, theta = margins / scale, np.array([1.0, 0.0])
    for _ in range(50):
        p = 1.0 / (1.0 + np.exp(-np.clip(theta[0] * x + theta[1], -30, 30)))
        g = np.array([((p - y) * x).sum() + 1e-3 * theta[0], (p - y).sum()])
        s = p * (1 - p)
        h = np.array([[(s * x * x).sum() + 1e-3, (s * x).sum()], [(s * x).sum(), s.sum() + 1e-3]])
        move = np.linalg.solve(h, g)
        theta = theta - np.clip(move, -1.0, 1.0)
        if np.abs(move).max() < 1e-6:
            break
    return float(max(theta[0], 1e-3) / scale), float(theta[1])


def labelled_sample(docs: DataFrame, labels: DataFrame, settings: Settings) -> DataFrame:
    """text and label of about ``per_class`` documents of each label, chosen by a hash of the id.

    ``labels`` has doc_id and label; rows without either are ignored, and of several
    labels of one document the largest counts. Of several rows with one doc_id the least
    text counts, so there are no more rows than labels.
    """
    clean = labels.where("doc_id IS NOT NULL AND label IN (0, 1)").groupBy("doc_id").agg(F.max("label").alias("label"))
    sizes = {r["label"]: r["n"] for r in clean.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    share = F.lit(0.0)
    for label, n in sizes.items():
        share = F.when(F.col("label") == label, settings.per_class / n).otherwise(share)
    chosen = clean.where(unit_interval(settings.seed, F.col("doc_id")) < share)
    if sum(min(n, settings.per_class) for n in sizes.values()) <= BROADCAST_LABELS:
        chosen = F.broadcast(chosen)
    found = docs.select("doc_id", "text").join(chosen, "doc_id")
    return found.groupBy("doc_id", "label").agg(F.min("text").alias("text")).select("text", "label")


def fit(
    docs: DataFrame,
    labels: DataFrame,
    features: Callable[[int], Callable[[str | None], np.ndarray]],
    settings: Settings,
) -> Model:
    """Fit on the labelled documents; ``features(dims)`` gives the function from text to buckets."""

    def extract(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        of = features(settings.dims)
        for batch in batches:
            packed = [of(t).astype(np.int32).tobytes() for t in batch["text"]]
            yield pd.DataFrame({"label": batch["label"], "row": packed})

    def train(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rows, labels = [], []
        for batch in batches:
            rows += [np.frombuffer(r, dtype=np.int32) for r in batch["row"]]
            labels += batch["label"].tolist()
        order = sorted(range(len(rows)), key=lambda i: (labels[i], len(rows[i]), rows[i].tobytes()))
        model = fit_arrays([rows[i] for i in order], np.array([labels[i] for i in order], dtype=int), settings)
        yield pd.DataFrame(
            {"w": [model.weights.tobytes()], "b": [model.bias], "s": [model.slope], "o": [model.offset]}
        )

    sample = labelled_sample(docs, labels, settings)
    rows = stored(sample.mapInPandas(extract, "label int, row binary"))
    # One task reads the sample: its size is bounded by per_class, not by the corpus.
    fitted = rows.repartition(1).mapInPandas(train, "w binary, b double, s double, o double").first()
    return Model(np.frombuffer(fitted["w"], dtype=np.float32), fitted["b"], fitted["s"], fitted["o"])


def score_column(model: Model, features, dims: int, docs: DataFrame):
    """The score of a text column, as a function for use in ``select``."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def score(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        model, of = shared.value, features(dims)
        for batch in texts:
            yield pd.Series([model.score(float(model.weights[of(t)].sum(dtype=np.float64))) for t in batch], dtype=float)

    # The annotations are texts in this module, so the kind is stated by type.
    return score


def classify(docs: DataFrame, model: Model, features, dims: int, threshold: float) -> DataFrame:
    """All rows and columns with score (0 to 1) and predicted; columns of these names are replaced.

    A null or empty text has no n-grams and gets the score of the bias.
    """
    kept = [c for c in docs.columns if c not in ("score", "predicted")]
    scored = docs.select(*kept, score_column(model, features, dims, docs)(F.col("text")).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
