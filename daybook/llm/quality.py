"""Text quality: naive Bayes support vectors over word n-grams.

Besides words and word pairs the n-grams run over what words look like (case,
digits, trailing marks) and over whether a word repeats the one before it, so that
junk is known by its pattern in vocabulary never seen in training.
"""

from __future__ import annotations

import re

import numpy as np
import xxhash
from pyspark.sql import DataFrame

from daybook.llm import linear

SETTINGS = linear.Settings()
#: A document is good from this score on.
THRESHOLD = 0.7

_RUNS = re.compile(r"(.)\1+")
#: Words a task remembers; the memory is emptied beyond it.
_MEMORY = 500_000


def _look(word: str) -> str:
    """Letters and digits become their class, runs become one sign."""
    signs = "".join(
        "A" if c.isupper() else "a" if c.isalpha() else "0" if c.isdigit() else c for c in word
    )
    return _RUNS.sub(r"\1", signs)


class _Known(dict):
    def __missing__(self, word: str) -> int:
        if len(self) >= _MEMORY:
            self.clear()
        low = xxhash.xxh32_intdigest(word)
        value = self[word] = low | xxhash.xxh32_intdigest(_look(word), 1) << 32
        return value


_ODD = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9], dtype=np.uint64)


def word_ngrams(dims: int):
    """A function from text to its distinct n-gram buckets."""
    known, distinct = _Known(), linear.Distinct(dims)
    shift = np.uint64(64 - (dims.bit_length() - 1))

    def bucket(values: np.ndarray, order: int) -> np.ndarray:
        mixed = (values ^ (values >> np.uint64(29))) * _ODD[order % 3] + np.uint64(order)
        return ((mixed ^ (mixed >> np.uint64(32))) * _ODD[0] >> shift).astype(np.int32)

    def of(text: str | None) -> np.ndarray:
        words = (text or "").split()
        if not words:
            return np.zeros(0, dtype=np.int32)
        packed = np.fromiter(map(known.__getitem__, words), dtype=np.uint64, count=len(words))
        word, look = packed & np.uint64(0xFFFFFFFF), packed >> np.uint64(32)
        again = np.concatenate([[0], word[1:] == word[:-1]]).astype(np.uint64)
        found = [bucket(word, 0)]
        if len(words) > 1:
            found.append(bucket(word[:-1] * _ODD[1] + word[1:], 1))
            found.append(bucket(look[:-1] * _ODD[1] + look[1:] * _ODD[2] + again[1:], 2))
        if len(words) > 7:
            eight = sum(again[i : len(again) - 7 + i] << np.uint64(i) for i in range(8))
            found.append(bucket(eight, 3))
        return distinct(np.concatenate(found))

    return of


def fit_quality(docs: DataFrame, labels: DataFrame, settings=SETTINGS) -> linear.Model:
    """Fit on documents with a label: ``labels`` has doc_id and label (1 is good)."""
    return linear.fit(docs, labels, word_ngrams, settings)


def score_quality(docs: DataFrame, model: linear.Model, settings=SETTINGS) -> DataFrame:
    return linear.classify(docs, model, word_ngrams, settings.dims, THRESHOLD)
