"""Toxicity: a linear classifier over character n-grams scaled by naive Bayes log-count ratios."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame

from daybook.llm import linear

SETTINGS = linear.Settings(dims=1 << 20, cost=0.01, choices=((20, 1.0), (10, 1.5), (5, 1.0), (3, 1.5)))
#: A document is toxic from this score on.
THRESHOLD = 0.7
ORDERS = (4, 5, 6)

_MIX = np.uint64(0x9E3779B97F4A7C15)
_FOLD = np.arange(128, dtype=np.uint64)
_FOLD[65:91] += 32


def char_ngrams(dims: int):
    """A function from text to its distinct n-gram buckets; A-Z count as a-z, blanks as one blank."""
    distinct = linear.Distinct(dims)
    shift = np.uint64(64 - (dims.bit_length() - 1))

    def of(text: str | None) -> np.ndarray:
        padded = " " + " ".join((text or "").split()) + " "
        points = np.frombuffer(padded.encode("utf-32-le", "surrogatepass"), dtype=np.uint32).astype(np.uint64)
        ascii_ = points < 128
        points[ascii_] = _FOLD[points[ascii_]]
        found, rolled = [], points
        for order in range(2, max(ORDERS) + 1):
            if len(points) < order:
                break
            rolled = rolled[:-1] * _MIX + points[order - 1 :]
            if order in ORDERS:
                mixed = (rolled ^ (rolled >> np.uint64(31))) * _MIX
                found.append(((mixed ^ (mixed >> np.uint64(29))) * _MIX >> shift).astype(np.int32))
        return distinct(np.concatenate(found)) if found else np.zeros(0, dtype=np.int32)

    return of


def fit_toxicity(docs: DataFrame, labels: DataFrame, settings=SETTINGS) -> linear.Model:
    """Fit on documents with a label: ``labels`` has doc_id and label (1 is toxic)."""
    return linear.fit(docs, labels, char_ngrams, settings)


def score_toxicity(docs: DataFrame, model: linear.Model, settings=SETTINGS) -> DataFrame:
    return linear.classify(docs, model, char_ngrams, settings.dims, THRESHOLD)
