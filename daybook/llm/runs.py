"""Periodic runs of words, by internal pattern matching.

A run is a stretch of words with smallest period q and length 2 q at least that no
neighbouring word extends. Its first period contains a dyadic block, a stretch of
2^k words that starts at a multiple of 2^k, with 2^(k+1) - 1 <= q <= 2^(k+2) - 2; the
same block occurs q words later. So every dyadic block is looked up in the window
where such a copy may start. A wavelet matrix over the suffix array answers that:
the suffixes that begin with the block are an interval of the array, and the first
of them in the window is the interval's successor of the window's start.

Occurrences that overlap or touch form a progression, whose length is known from
the first two and one longest common extension. Each distance is a candidate
period; it is a run if the common extensions of block and copy to both sides make it
long enough. If block and copies lie in one stretch whose period is the difference
of the progression, larger distances are multiples of that period and are left out.

The suffix array is built by doubling: words are ranked by their first 2^k words,
k = 0, 1, ..., until all ranks differ. These ranks are kept, and give the interval of
each block and the common extensions. Words of other documents never match, so many
documents are worked on as one array. With n words in hand, documents of at least
BLOCK words apart, memory is O(n log n), time O(n log^2 n).
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daybook.llm.text import or_empty

MIN_LENGTH = 12
#: Words of several documents that are worked on together; a longer document stands alone.
BLOCK = 80_000
#: Dyadic blocks looked up at a time.
LOOKUPS = 1 << 18


class _Wavelet:
    """Order statistics of any interval of an array of numbers below ``size``."""

    def __init__(self, values: np.ndarray, size: int):
        self.bits = range(max(1, int(size - 1).bit_length()) - 1, -1, -1)
        self.zeros, self.split = [], []
        for bit in self.bits:
            one = (values >> bit) & 1
            before = np.zeros(len(values) + 1, dtype=np.int32)
            np.cumsum(1 - one, out=before[1:], dtype=np.int32)
            self.zeros.append(before)
            self.split.append(int(before[-1]))
            values = np.concatenate([values[one == 0], values[one == 1]])

    def successor(self, lo: np.ndarray, hi: np.ndarray, least: np.ndarray, none: int) -> np.ndarray:
        """The smallest value >= ``least`` among the values lo to hi - 1; ``none`` if there is none."""
        smaller, left, right = np.zeros(len(lo), dtype=np.int64), lo, hi
        for bit, zeros, split in zip(self.bits, self.zeros, self.split, strict=True):
            left0, right0 = zeros[left], zeros[right]
            one = ((least >> bit) & 1).astype(bool)
            smaller += np.where(one, right0 - left0, 0)
            left, right = np.where(one, split + left - left0, left0), np.where(one, split + right - right0, right0)
        found = smaller < hi - lo
        rank, left, right = smaller[found], lo[found], hi[found]
        value = np.zeros(len(rank), dtype=np.int64)
        for bit, zeros, split in zip(self.bits, self.zeros, self.split, strict=True):
            left0, right0 = zeros[left], zeros[right]
            n_zeros = (right0 - left0).astype(np.int64)
            one = rank >= n_zeros
            value += one.astype(np.int64) << bit
            rank = np.where(one, rank - n_zeros, rank)
            left, right = np.where(one, split + left - left0, left0), np.where(one, split + right - right0, right0)
        out = np.full(len(lo), none, dtype=np.int64)
        out[found] = value
        return out


class _Suffixes:
    """Suffix array of an array in which no two documents share a symbol, each ended by one of its own."""

    def __init__(self, symbols: np.ndarray):
        n = len(symbols)
        sa = np.argsort(symbols, kind="stable")
        in_order = symbols[sa]
        first = np.r_[True, in_order[1:] != in_order[:-1]]
        rank = np.empty(n, dtype=np.int64)
        rank[sa] = np.flatnonzero(first)[np.cumsum(first) - 1]
        self.ranks, self.sizes, step = [], [], 1
        while True:
            size = np.bincount(rank, minlength=n)
            slots = np.flatnonzero(size[rank[sa]] > 1)
            if not len(slots):
                break
            self.ranks.append(rank.astype(np.int32))
            self.sizes.append(size.astype(np.int32))
            at = sa[slots]
            key = rank[at] * n + rank[at + step]
            order = np.argsort(key, kind="stable")
            at, key = at[order], key[order]
            sa[slots] = at
            first = np.r_[True, key[1:] != key[:-1]]
            rank = rank.copy()
            rank[at] = slots[first][np.cumsum(first) - 1]
            step *= 2
        self.array = sa

    def forward(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """How many symbols from i and from j on are equal; i and j differ."""
        i, j, start = i.copy(), j.copy(), i
        for k in range(len(self.ranks) - 1, -1, -1):
            step = (self.ranks[k][i] == self.ranks[k][j]).astype(np.int64) << k
            i += step
            j += step
        return i - start

    def backward(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """How many symbols before i and before j are equal; i < j."""
        i, j, start = i.copy(), j.copy(), i
        for k in range(len(self.ranks) - 1, -1, -1):
            inside = i >= (1 << k)
            back = np.where(inside, i - (1 << k), 0)
            same = inside & (self.ranks[k][back] == self.ranks[k][np.where(inside, j - (1 << k), 1)])
            step = same.astype(np.int64) << k
            i -= step
            j -= step
        return start - i


def _candidates(suffixes: _Suffixes, wavelet: _Wavelet, k: int, block: np.ndarray) -> Iterator[tuple]:
    """Pairs (start of a block, distance of a copy in its window)."""
    none, width = len(suffixes.array), 1 << k
    lo = suffixes.ranks[k][block].astype(np.int64)
    hi = lo + suffixes.sizes[k][lo]
    end = np.minimum(block + 4 * width - 2, none - 1)
    at = wavelet.successor(lo, hi, block + 2 * width - 1, none)
    while True:
        here = at <= end
        if not here.any():
            return
        block, lo, hi, end, at = (x[here] for x in (block, lo, hi, end, at))
        after = wavelet.successor(lo, hi, at + 1, none)
        step = after - at
        series = (after <= end) & (step <= width)
        count = np.ones(len(at), dtype=np.int64)
        s_at, s_step, s_block = at[series], step[series], block[series]
        reach = suffixes.forward(s_at, s_at + s_step)
        s_count = np.minimum(2 + (reach - width) // s_step, 1 + (end[series] - s_at) // s_step)
        count[series] = s_count
        own = s_block + s_step
        one_stretch = ((s_at - s_block) % s_step == 0) & (
            own + suffixes.forward(s_block, own) >= s_at + width
        )
        emitted = count.copy()
        emitted[series] = np.where(one_stretch, (s_at == own).astype(np.int64), s_count)
        number = np.arange(emitted.sum()) - np.repeat(np.cumsum(emitted) - emitted, emitted)
        yield np.repeat(block, emitted), np.repeat(at - block, emitted) + number * np.repeat(step, emitted)
        last = at + (count - 1) * np.where(series, step, 0)
        at = np.where(series, wavelet.successor(lo, hi, last + 1, none), after)


def find_runs(documents: list[list], min_length: int = MIN_LENGTH) -> list[np.ndarray]:
    """Of each document, a list of words, its runs: rows (start, length, period) by start, then period."""
    numbers: dict = {}
    lengths = np.array([len(d) + 1 for d in documents], dtype=np.int64)
    if lengths.sum() == len(documents):
        return [np.zeros((0, 3), dtype=np.int64) for _ in documents]
    owner = np.repeat(np.arange(len(documents)), lengths)
    words = np.array([x for d in documents for x in (*(numbers.setdefault(w, len(numbers) + 1) for w in d), 0)])
    suffixes = _Suffixes(owner * (len(numbers) + 1) + words)
    found = []
    if suffixes.ranks:
        wavelet = _Wavelet(suffixes.array, len(words))
        for k in range(len(suffixes.ranks)):
            blocks = np.arange(0, len(words), 1 << k)
            blocks = blocks[suffixes.sizes[k][suffixes.ranks[k][blocks]] > 1]
            for part in range(0, len(blocks), LOOKUPS):
                for block, period in _candidates(suffixes, wavelet, k, blocks[part : part + LOOKUPS]):
                    left = suffixes.backward(block, block + period)
                    length = left + period + suffixes.forward(block, block + period)
                    good = length >= np.maximum(2 * period, min_length)
                    found.append(np.stack([block[good] - left[good], length[good], period[good]], 1))
    runs = np.concatenate(found) if found else np.zeros((0, 3), dtype=np.int64)
    runs = runs[np.lexsort((runs[:, 2], runs[:, 1], runs[:, 0]))]
    if len(runs):  # of one stretch the smallest period
        runs = runs[np.r_[True, (runs[1:, :2] != runs[:-1, :2]).any(axis=1)]]
        runs = runs[np.lexsort((runs[:, 2], runs[:, 0]))]
    starts = np.r_[0, np.cumsum(lengths)]
    cuts = np.searchsorted(runs[:, 0], starts)
    return [runs[a:b] - [s, 0, 0] for a, b, s in zip(cuts[:-1], cuts[1:], starts[:-1], strict=True)]


def _collapsed(words: list[bytes], runs: np.ndarray) -> str:
    if len(runs):
        edge = np.zeros(len(words) + 1, dtype=np.int64)
        np.add.at(edge, runs[:, 0] + runs[:, 2], 1)
        np.add.at(edge, runs[:, 0] + runs[:, 1], -1)
        words = [words[i] for i in np.flatnonzero(np.cumsum(edge[:-1]) == 0)]
    return b" ".join(words).decode()


def _columns(min_length: int) -> Callable:
    def columns(texts: pd.Series) -> pd.DataFrame:
        rows, waiting, size = [], [], 0

        def work():
            for words, runs in zip(waiting, find_runs(waiting, min_length), strict=True):
                rows.append((*(runs[:, i].tolist() for i in range(3)), _collapsed(words, runs)))

        for text in texts:
            words = text.encode("utf-8", "replace").split()
            if waiting and size + len(words) > BLOCK:
                work()
                waiting, size = [], 0
            waiting.append(words)
            size += len(words)
        if waiting:
            work()
        return pd.DataFrame(rows, columns=["start", "length", "period", "collapsed"])

    return columns


def with_runs(docs: DataFrame, text: str = "text", min_length: int = MIN_LENGTH) -> DataFrame:
    """All rows and columns with ``runs`` and ``collapsed``; columns of these names are replaced.

    ``runs`` lists (start, length, period) of every run of max(min_length, 2 * period) words or more,
    by start, then period; words are numbered from 0. ``collapsed`` is the text without the words that
    some run contains after its first period, joined by blanks. Words are runs of characters other
    than the blank and the controls 9 to 13. Null and blank texts have no words, no runs and an
    empty ``collapsed``. One map stage; nothing is shuffled, repeated rows are treated alike.
    """
    fields = "start array<long>, length array<long>, period array<long>, collapsed string"
    # Not deterministic, so that the optimizer neither copies nor inlines it.
    columns = F.pandas_udf(_columns(min_length), fields).asNondeterministic()
    kept = [c for c in docs.columns if c not in ("runs", "collapsed")]
    name = "_runs"
    while name in kept:
        name = f"_{name}"
    found = docs.select(*kept, columns(or_empty(F.col(text))).alias(name))
    of = [F.col(f"`{name}`.{c}").alias(c) for c in ("start", "length", "period")]
    zipped = F.arrays_zip(*of).cast("array<struct<start:bigint,length:bigint,period:bigint>>")
    return found.select(*[F.col(f"`{c}`") for c in kept], zipped.alias("runs"), F.col(f"`{name}`.collapsed").alias("collapsed"))
