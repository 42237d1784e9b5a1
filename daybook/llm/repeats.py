"""Removal of repeated passages by suffix automata of reference shards.

A window is ``window`` words in a row; every word of a window that occurs twice goes.

If each automaton met each document, the work would grow with the square of the
corpus. So shards are dealt by content. The anchor of a window is its M-gram of least
hash; equal windows have equal anchors. Windows in a row with one anchor are a
segment, and an anchor that occurs once in the corpus cannot belong to a repeated
window. All segments of an anchor go to one shard:

* equal segments are merged first, with their number; a segment that occurs twice
  repeats as a whole, and its text is needed only as reference for others;
* a task takes the segments of a shard, whole anchors up to SHARD_WORDS words at a
  time, builds the suffix automaton of them and counts the ends of each state. The
  segments are streamed through it; the state that holds the last ``window`` words
  says how often they occur. Windows that occur twice make maximal spans;
* an anchor with very many different segments would be a shard too large for a task;
  its windows go one by one instead, dealt by the whole window.

Spans of segments are joined to the places of the segments, gathered for each text,
and the words are removed where the texts are.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daybook.llm import bits
from daybook.llm.text import or_empty
from daybook.scratch import stored

WINDOW = 35
#: Words of an anchor.
M = 8
#: Words of documents worked on together, and of an automaton.
BLOCK_WORDS = 300_000
SHARD_WORDS = 60_000
#: Different segments of an anchor that one automaton takes; at most HOT_ANCHORS anchors have more.
ANCHOR_SEGMENTS = 1_000
HOT_ANCHORS = 100_000
#: Keys up to which a bitmap is used; beyond, it would hold too many bits to save work, and keys are joined.
BITMAP_KEYS = 1 << (bits.BITS - 2)

_B = 0xD6E8_FEB8_6659_FD93
_B_INVERSE = pow(_B, -1, 1 << 64)
_OCCURRENCE = "a long, h long, t1 long, t2 long, start int, windows int, n long"
_SEGMENT = "a long, h long, text string"


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8_FEB8_6659_FD93)
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58_476D_1CE4_E5B9)
    return h ^ (h >> np.uint64(32))


def _powers(base: int, n: int) -> np.ndarray:
    steps = np.full(n, base, dtype=np.uint64)
    steps[:1] = 1
    return np.multiply.accumulate(steps)


class _Block:
    """Different texts, word by word in one array, and the segments of their windows."""

    def __init__(self, window: int):
        self.window, self.size = window, 0
        self.texts: dict[tuple[int, int], list] = {}

    def add(self, text: str, key: tuple[int, int]) -> None:
        known = self.texts.get(key)
        if known:
            known[1] += 1
            return
        words = text.encode("utf-8", "replace").split()
        if len(words) >= self.window:
            self.texts[key] = [words, 1]
            self.size += len(words)

    def close(self) -> None:
        """Arrays by segment: ``a``, ``h``, ``first`` word, number of ``windows``, ``doc``."""
        window = self.window
        self.words = [w for words, _ in self.texts.values() for w in words]
        lengths = np.array([len(words) for words, _ in self.texts.values()], dtype=np.int64)
        self.begin = np.cumsum(lengths) - lengths
        of = np.repeat(np.arange(len(lengths)), lengths)
        seen: dict[bytes, int] = {}
        numbers = np.array([seen.setdefault(w, len(seen)) for w in self.words], dtype=np.int64)
        hashes = np.array([xxhash.xxh64_intdigest(w) for w in seen], dtype=np.uint64)[numbers]
        self.sums = np.zeros(len(hashes) + 1, dtype=np.uint64)
        np.cumsum(hashes * _powers(_B, len(hashes)), out=self.sums[1:])
        self.back = _powers(_B_INVERSE, len(hashes))
        m = min(M, window)
        grams = self.hash(np.arange(len(hashes) - m + 1), m)
        least, at, length, wanted = grams, np.arange(len(grams)), 1, window - m + 1
        while length < wanted:  # the leftmost least gram of each stretch of ``length`` grams
            step = min(length, wanted - length)
            right = least[step:]
            left = least[: len(right)]
            first = left <= right
            at = np.where(first, at[: len(right)], at[step:])
            least, length = np.where(first, left, right), length + step
        starts = np.flatnonzero(of[: len(at)] == of[window - 1 :])
        anchor = at[starts]
        new = np.r_[True, (np.diff(anchor) != 0) | (np.diff(starts) != 1)]
        heads = np.flatnonzero(new)
        self.first, self.doc = starts[heads], of[starts[heads]]
        self.windows = np.diff(np.r_[heads, len(starts)])
        self.a = grams[anchor[heads]]
        self.h = self.hash(self.first, self.windows + window - 1)

    def hash(self, first: np.ndarray, length: np.ndarray | int) -> np.ndarray:
        return _mix((self.sums[first + length] - self.sums[first]) * self.back[first] + np.asarray(length).astype(np.uint64))

    def keep(self, chosen: np.ndarray) -> None:
        for name in ("a", "h", "first", "windows", "doc"):
            setattr(self, name, getattr(self, name)[chosen])

    def cut(self, chosen: np.ndarray) -> None:
        """Each window of the chosen segments becomes a segment of its own, dealt by its words."""
        parts = np.where(chosen, self.windows, 1)
        which = np.repeat(np.arange(len(parts)), parts)
        offset = np.arange(len(which)) - np.repeat(np.cumsum(parts) - parts, parts)
        chosen = chosen[which]
        self.keep(which)
        self.first = self.first + offset
        self.windows = np.where(chosen, 1, self.windows)
        own = self.hash(self.first, self.windows + self.window - 1)
        self.h = np.where(chosen, own, self.h)
        self.a = np.where(chosen, _mix(own + np.uint64(0x5851_F42D_4C95_7F2D)), self.a)

    def places(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        t = np.array(list(self.texts), dtype=np.int64).reshape(-1, 2)[self.doc]
        return t[:, 0], t[:, 1], (self.first - self.begin[self.doc]).astype(np.int32)

    def text(self, i: int) -> str:
        return b" ".join(self.words[self.first[i] : self.first[i] + self.windows[i] + self.window - 1]).decode()


def _blocks(batches: Iterator[pd.DataFrame], window: int, repeated=None, hot=None) -> Iterator[_Block]:
    """Blocks with the segments of repeated anchors; those of hot anchors are cut into windows."""
    block = _Block(window)

    def closed() -> _Block:
        block.close()
        if repeated is not None:
            set_ = np.frombuffer(repeated.value, dtype=np.uint8)
            block.keep(bits.has(set_, block.a & np.uint64(bits.MASK)))
        if hot is not None:
            block.cut(np.isin(block.a.view(np.int64), hot.value))
        return block

    for batch in batches:
        for text, t1, t2 in zip(batch["text"], batch["t1"], batch["t2"], strict=True):
            block.add(text, (t1, t2))
            if block.size >= BLOCK_WORDS:
                yield closed()
                block = _Block(window)
    if block.size:
        yield closed()


def _segments(window: int) -> Callable:
    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for block in _blocks(batches, window):
            if not len(block.a):
                continue
            order = np.lexsort((block.h, block.a))
            a, h = block.a[order], block.h[order]
            weight = np.array([n for _, n in block.texts.values()], dtype=np.int64)[block.doc][order]
            new = np.flatnonzero(np.r_[True, (a[1:] != a[:-1]) | (h[1:] != h[:-1])])
            n = np.add.reduceat(weight, new)
            yield pd.DataFrame({"a": a[new].view(np.int64), "h": h[new].view(np.int64), "n": n})

    return count


def _occurrences(window: int, repeated, hot) -> Callable:
    def find(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for block in _blocks(batches, window, repeated, hot):
            weight = np.array([n for _, n in block.texts.values()], dtype=np.int64)
            t1, t2, start = block.places()
            yield pd.DataFrame(
                {
                    "a": block.a.view(np.int64),
                    "h": block.h.view(np.int64),
                    "t1": t1,
                    "t2": t2,
                    "start": start,
                    "windows": block.windows.astype(np.int32),
                    "n": weight[block.doc],
                }
            )

    return find


def _place_index(t1: np.ndarray, start: np.ndarray) -> np.ndarray:
    return _mix(t1.view(np.uint64) + start.astype(np.uint64)) & np.uint64(bits.MASK)


def _index_of_place(t1: pd.Series, start: pd.Series) -> pd.Series:
    return pd.Series(_place_index(t1.to_numpy(dtype=np.int64), start.to_numpy(dtype=np.int64)).view(np.int64))


def _texts_at(window: int, repeated, hot, places) -> Callable:
    """The segments that start at the places of a bitmap, with their texts, once in a block."""

    def find(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        set_ = np.frombuffer(places.value, dtype=np.uint8)
        for block in _blocks(batches, window, repeated, hot):
            t1, _, start = block.places()
            block.keep(bits.has(set_, _place_index(t1, start.astype(np.int64))))
            if not len(block.a):
                continue
            order = np.lexsort((block.h, block.a))
            a, h = block.a[order], block.h[order]
            new = np.r_[True, (a[1:] != a[:-1]) | (h[1:] != h[:-1])]
            yield pd.DataFrame(
                {
                    "a": a[new].view(np.int64),
                    "h": h[new].view(np.int64),
                    "text": [block.text(i) for i in order[new]],
                }
            )

    return find


def _texts_of(window: int) -> Callable:
    """The listed segments of each text."""

    def find(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for text, wanted in zip(batch["text"], batch["wanted"], strict=True):
                words = text.encode("utf-8", "replace").split()
                for w in wanted:
                    end = w["start"] + w["windows"] + window - 1
                    rows.append((w["a"], w["h"], b" ".join(words[w["start"] : end]).decode()))
            if rows:
                yield pd.DataFrame(rows, columns=["a", "h", "text"])

    return find


class Automaton:
    """The suffix automaton of several sequences; ``ends`` counts where the words of a state end."""

    def __init__(self, sequences: list[list]):
        self.next, self.link, self.length, self.ends = [{}], [-1], [0], [0]
        for sequence in sequences:
            last = 0
            for c in sequence:
                last = self._extend(last, c)
                self.ends[last] += 1
        link, ends = self.link, self.ends
        for state in np.argsort(np.array(self.length), kind="stable")[:0:-1].tolist():
            ends[link[state]] += ends[state]

    def _state(self, length: int) -> int:
        self.next.append({})
        self.link.append(0)
        self.length.append(length)
        self.ends.append(0)
        return len(self.length) - 1

    def _clone(self, p: int, c, q: int) -> int:
        new = self._state(self.length[p] + 1)
        self.next[new] = self.next[q].copy()
        self.link[new], self.link[q] = self.link[q], new
        while p != -1 and self.next[p].get(c) == q:
            self.next[p][c] = new
            p = self.link[p]
        return new

    def _extend(self, last: int, c) -> int:
        following, link, length = self.next, self.link, self.length
        q = following[last].get(c)
        if q is not None:
            return q if length[q] == length[last] + 1 else self._clone(last, c, q)
        new, p = self._state(length[last] + 1), last
        while p != -1 and c not in following[p]:
            following[p][c] = new
            p = link[p]
        if p != -1:
            q = following[p][c]
            link[new] = q if length[q] == length[p] + 1 else self._clone(p, c, q)
        return new

    def repeated(self, sequence: list, window: int) -> list[int]:
        """Starts of the windows of a sequence that end in two places of the reference or more."""
        following, link, length, ends = self.next, self.link, self.length, self.ends
        state, matched, found = 0, 0, []
        for i, c in enumerate(sequence):
            while state and c not in following[state]:
                state = link[state]
                matched = length[state]
            if c in following[state]:
                state = following[state][c]
                matched += 1
            while state and length[link[state]] >= window:  # the state that holds the last ``window`` words
                state = link[state]
                matched = length[state]
            if matched >= window and ends[state] > 1:
                found.append(i - window + 1)
        return found


def _spans(starts: list[int]) -> tuple[list[int], list[int]]:
    """First and last window of each stretch of windows in a row."""
    firsts = [s for i, s in enumerate(starts) if not i or starts[i - 1] != s - 1]
    lasts = [s for i, s in enumerate(starts) if i + 1 == len(starts) or starts[i + 1] != s + 1]
    return firsts, lasts


def _streamed(window: int) -> Callable:
    """Rows (a, h, first, last) of the segments with repeated windows; the input is sorted by a, h."""

    def work(keys: list[tuple[int, int]], sequences: list[list]) -> pd.DataFrame:
        automaton = Automaton(sequences)
        rows = []
        for key, sequence in zip(keys, sequences, strict=True):
            starts = automaton.repeated(sequence, window)
            if starts:
                rows.append((*key, *_spans(starts)))
        return pd.DataFrame(rows, columns=["a", "h", "first", "last"])

    def stream(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        keys, sequences, numbers, size = [], [], {}, 0
        for batch in batches:
            for a, h, text in zip(batch["a"], batch["h"], batch["text"], strict=True):
                if keys and keys[-1] == (a, h):
                    continue
                if size >= SHARD_WORDS and keys[-1][0] != a:
                    yield work(keys, sequences)
                    keys, sequences, numbers, size = [], [], {}, 0
                sequence = [numbers.setdefault(w, len(numbers)) for w in text.split(" ")]
                keys.append((a, h))
                sequences.append(sequence)
                size += len(sequence)
        if keys:
            yield work(keys, sequences)

    return stream


def _removed(texts: pd.Series, firsts: pd.Series, ends: pd.Series) -> pd.DataFrame:
    rows = []
    for text, first, end in zip(texts, firsts, ends, strict=True):
        words = text.encode("utf-8", "replace").split()
        n = len(words)
        if first is not None and len(first):
            edge = np.zeros(n + 1, dtype=np.int64)
            np.add.at(edge, first, 1)
            np.add.at(edge, end, -1)
            words = [words[i] for i in np.flatnonzero(np.cumsum(edge[:-1]) == 0)]
        rows.append((n, n - len(words), b" ".join(words).decode()))
    return pd.DataFrame(rows, columns=["n_words", "n_removed", "kept"])


def _representatives(occurrences: DataFrame) -> DataFrame:
    """Each different segment with its number and one of its places."""
    place = ("t1", "t2", "start", "windows")
    return occurrences.groupBy("a", "h").agg(F.sum("n").alias("n"), *[F.first(c).alias(c) for c in place])


def _segment_texts(texts: DataFrame, found: DataFrame, window: int, repeated, hot) -> DataFrame:
    """(a, h, text) of the representatives ``found``; a row may come more than once."""
    if found.count() <= BITMAP_KEYS:
        index = F.pandas_udf(_index_of_place, "long")(F.col("t1"), F.col("start").cast("long"))
        places = bits.bitmap(F.col("index"), found.select(index.alias("index")))
        return texts.mapInPandas(_texts_at(window, repeated, hot, places), _SEGMENT)
    wanted = found.groupBy("t1", "t2").agg(F.collect_list(F.struct("a", "h", "start", "windows")).alias("wanted"))
    joined = texts.dropDuplicates(["t1", "t2"]).join(wanted, ["t1", "t2"])
    return joined.select("text", "wanted").mapInPandas(_texts_of(window), _SEGMENT)


def repeated_spans(texts: DataFrame, window: int = WINDOW) -> DataFrame:
    """(t1, t2, first, end): for each text key, where the words of repeated windows begin and end.

    ``texts`` has text, not null, and t1, t2, hashes that tell different texts apart.
    """
    counted = texts.mapInPandas(_segments(window), "a long, h long, n long").groupBy("a", "h").agg(F.sum("n").alias("n"))
    anchors = counted.groupBy("a").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("segments"))
    twice = stored(anchors.where("n > 1").select("a", "segments"))
    n_anchors, n_segments = twice.agg(F.count(F.lit(1)), F.sum("segments")).first()
    few = n_anchors <= BITMAP_KEYS
    repeated = bits.bitmap(F.col("a").bitwiseAND(F.lit(bits.MASK)), twice) if few else None
    limit = max(ANCHOR_SEGMENTS, (n_segments or 0) // HOT_ANCHORS)
    large = twice.where(F.col("segments") > limit).select("a")  # HOT_ANCHORS rows at most
    hot_list = np.array([r["a"] for r in large.toLocalIterator()], dtype=np.int64)
    hot = texts.sparkSession.sparkContext.broadcast(hot_list) if len(hot_list) else None
    occurrences = texts.mapInPandas(_occurrences(window, repeated, hot), _OCCURRENCE)
    if not few:  # windows of hot anchors have keys of their own
        known = occurrences.join(twice, "a", "left").where("segments IS NOT NULL OR windows = 1")
        occurrences = known.drop("segments")
    places = stored(occurrences)
    found = stored(_representatives(places))
    segments = _segment_texts(texts, found, window, repeated, hot)
    streamed = segments.repartition("a").sortWithinPartitions("a", "h")
    spans = stored(streamed.mapInPandas(_streamed(window), "a long, h long, first array<int>, last array<int>"))
    whole = found.where("n > 1").select(
        "a", "h", F.array(F.lit(0)).alias("first"), F.array((F.col("windows") - 1).cast("int")).alias("last")
    )
    once = spans.join(found.where("n = 1").select("a", "h"), ["a", "h"], "left_semi")
    met = places.select("a", "h", "t1", "t2", "start").join(whole.unionByName(once), ["a", "h"])
    each = met.withColumn("span", F.explode(F.arrays_zip("first", "last")))
    return each.select(
        "t1",
        "t2",
        (F.col("start") + F.col("span.first")).alias("first"),
        (F.col("start") + F.col("span.last") + window).alias("end"),
    )


def drop_repeats(docs: DataFrame, text: str = "text", window: int = WINDOW) -> DataFrame:
    """All rows and columns, the text without words of repeated windows, and n_words, n_removed.

    A window, ``window`` words in a row of one text, repeats if its words also begin anywhere else,
    in the same text or another; all copies go, the first one too. Kept words are joined by
    one blank. Words are runs of characters other than the blank and the controls 9 to 13.
    Null and blank texts have no words and give an empty text. Repeated rows repeat each
    other. Columns n_words and n_removed are replaced; other columns are passed on.
    """
    whole = or_empty(F.col(text))
    keys = [F.xxhash64(whole), F.xxhash64(F.lit("second"), whole)]
    texts = docs.select(keys[0].alias("t1"), keys[1].alias("t2"), whole.alias("text"))
    each = repeated_spans(texts, window)
    spans = each.groupBy("t1", "t2").agg(F.collect_set(F.struct("first", "end")).alias("spans"))
    spans = stored(spans.select(F.col("t1").alias("_t1"), F.col("t2").alias("_t2"), "spans.first", "spans.end").toDF(
        "_t1", "_t2", "_first", "_end"
    ))
    kept = [c for c in docs.columns if c not in ("n_words", "n_removed")]
    row = docs.select(F.struct(*[F.col(f"`{c}`") for c in kept]).alias("_row"), keys[0].alias("_t1"), keys[1].alias("_t2"))
    joined = row.join(spans, ["_t1", "_t2"], "left")
    remove = F.pandas_udf(_removed, "n_words long, n_removed long, kept string")
    done = joined.select("_row", remove(or_empty(F.col("_row").getField(text)), "_first", "_end").alias("_done"))
    columns = [F.col("_done.kept" if c == text else f"_row.`{c}`").alias(c) for c in kept]
    return done.select(*columns, F.col("_done.n_words").alias("n_words"), F.col("_done.n_removed").alias("n_removed"))
