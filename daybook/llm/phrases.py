"""Phrase collocations by SON partitioning.

A phrase is frequent if it occurs ``support`` times in its language. Documents are
dealt into SHARDS shards by a hash of their id, so that copies spread evenly, and a phrase that is frequent over
all occurs at least support / SHARDS times in one shard or other. So every shard
is mined completely at that lower support, the phrases frequent in some shard are
united, and exactly those are counted over all documents.

A shard is a share of the corpus, not what one task holds: its tasks count
phrases block by block, and the counts of a shard are summed by a shuffle. Mining
is level by level: longer phrases are counted only where all their word pairs are
frequent in the shard. That set and the united candidates are passed on as bitmaps
of hashed phrases whose size is fixed. A false hit costs a count that is thrown away
later; it never changes the result, since the last count is by the words themselves.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterator
from itertools import islice

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from daybook.llm.bits import MASK, bitmap, has
from daybook.llm.text import or_empty
from daybook.scratch import stored

SUPPORT = 30
LONGEST = 4
SHARDS = 2
#: A phrase goes if a longer one accounts for this share of its occurrences, in percent.
COVERED = 80
SCALE = 2_000_000
TOP = 2_000
#: Tokens that a task counts at a time.
BLOCK = 200_000
#: Phrases that a task counts before it hands them on.
COUNTED = 1_000_000
#: Counts of blocks that wait to be added up, and rows handed on at a time.
WAITING, HANDED = 150_000, 20_000
#: Word pairs of a task that counts candidates, beyond which there are more tasks than cores.
TASK_PAIRS = 1 << 26
#: Documents of a batch that are made Python texts at a time.
TEXTS = 200
#: Parts in which the best phrases of a language are looked for before they are ranked together.
RANK_PARTS = 256

_FOLD = bytes.maketrans(
    bytes(range(65, 91)) + b".,;:!?\n\x0b\x0c\r\t",
    bytes(range(97, 123)) + b"\n" * 10 + b" ",
)
_MULTIPLIER = np.uint64(0x9E37_79B9_7F4A_7C15)
_SHARD_KEYS = [xxhash.xxh64_intdigest(bytes([s])) & MASK for s in range(256)]


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58_476D_1CE4_E5B9)
    return h ^ (h >> np.uint64(27))


class _Vocabulary:
    """Words and languages, numbered in order of appearance; 0 stands between pieces."""

    def __init__(self):
        self.ids: dict[bytes, int] = {b"\n": 0}
        self.langs: dict[str, int] = {}
        self.words: list[bytes] = []
        self.hashes = np.zeros(0, dtype=np.uint64)

    def listed(self) -> list[bytes]:
        """The words that came since it was asked last, now in ``words`` too."""
        new = list(islice(self.ids, len(self.words), None))
        self.words += new
        return new

    def hashed(self) -> tuple[np.ndarray, np.ndarray]:
        new = self.listed()
        self.hashes = np.r_[self.hashes, np.array([xxhash.xxh64_intdigest(w) for w in new], dtype=np.uint64)]
        names = [xxhash.xxh64_intdigest(x.encode("utf-8", "replace"), 1) for x in self.langs]
        return self.hashes, np.array(names, dtype=np.uint64)


class _Block:
    """Documents as word numbers, 0 between pieces."""

    def __init__(self, vocabulary: _Vocabulary | None = None):
        self.vocabulary = vocabulary or _Vocabulary()
        self.parts: list[np.ndarray] = []
        self.owners: list[tuple[int, int, int]] = []
        self.size = 0

    def add(self, text: str, lang: str, shard: int) -> None:
        ids, langs = self.vocabulary.ids, self.vocabulary.langs
        tokens = text.encode("utf-8", "replace").translate(_FOLD).replace(b"\n", b" \n ").split(b" ")
        part = np.array([ids.setdefault(w, len(ids)) for w in tokens if w] + [0], dtype=np.int32)
        self.parts.append(part)
        self.owners.append((len(part), langs.setdefault(lang, len(langs)), shard))
        self.size += len(part)

    def close(self, longest: int) -> None:
        self.a = np.concatenate(self.parts)
        lengths, langs, shards = (np.array(x) for x in zip(*self.owners, strict=True))
        self.parts, self.owners = [], []
        self.lang = np.repeat(langs.astype(np.int32), lengths)
        self.shard = np.repeat(shards.astype(np.uint8), lengths)
        word, name = self.vocabulary.hashed()
        hashed = word[self.a]
        #: keys[n - 1][i]: hash of the n words from i on, with their language; ok: they are of one piece.
        self.keys, self.ok = [_mix(hashed + name[self.lang])], [self.a > 0]
        for n in range(2, longest + 1):
            last = self.keys[-1][:-1]
            self.keys.append(_mix(last * _MULTIPLIER + hashed[n - 1 :]))
            self.ok.append(self.ok[-1][:-1] & (self.a[n - 1 :] > 0))


    def renumber(self, vocabulary: _Vocabulary, chosen: list[np.ndarray]) -> None:
        """Number the words of the chosen starts as in ``vocabulary``; all others are 0 then."""
        words = self.vocabulary.words
        used = np.zeros(len(words), dtype=bool)
        for i, starts in enumerate(map(np.flatnonzero, chosen)):
            for j in range(i + 1):
                used[self.a[starts + j]] = True
        ids, langs = vocabulary.ids, vocabulary.langs
        number = np.zeros(len(words), dtype=np.int32)
        for w in np.flatnonzero(used).tolist():
            number[w] = ids.setdefault(words[w], len(ids))
        self.a = number[self.a]
        self.lang = np.array([langs.setdefault(x, len(langs)) for x in self.vocabulary.langs], dtype=np.int32)[self.lang]
        vocabulary.listed()
        self.vocabulary = vocabulary


def _blocks(batches: Iterator[pd.DataFrame], longest: int = LONGEST) -> Iterator[_Block]:
    block = _Block()
    for batch in batches:
        for text, lang, shard in zip(batch["text"], batch["lang"], batch["shard"], strict=True):
            block.add(text, lang, shard)
            if block.size >= BLOCK:
                block.close(longest)
                yield block
                block = _Block()
    if block.size:
        block.close(longest)
        yield block


def _in_arrow(count: Callable, schema: pa.Schema) -> Callable:
    """``count`` over Arrow batches, of which few rows at a time are Python texts."""

    def texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for at in range(0, batch.num_rows, TEXTS):
                yield batch.slice(at, TEXTS).to_pandas()

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for frame in count(texts(batches)):
            yield pa.RecordBatch.from_pandas(frame, schema, preserve_index=False)

    return counted


_KEYED = pa.schema([("key", pa.int64()), ("shard", pa.int32()), ("n", pa.int64())])
_WORDED = pa.schema([("lang", pa.string()), ("phrase", pa.string()), ("words", pa.int32()), ("f", pa.int64())])


def _shard_counts(block: _Block, n: int, chosen: np.ndarray) -> Iterator[pd.DataFrame]:
    """Rows (key, shard, n) of the chosen starts of n words."""
    shards, keys = block.shard[: len(chosen)][chosen], block.keys[n - 1][chosen]
    for shard in np.unique(shards):
        key, count = np.unique(keys[shards == shard], return_counts=True)
        yield pd.DataFrame({"key": key.view(np.int64), "shard": np.int32(shard), "n": count.astype(np.int64)})


def _pairs(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for block in _blocks(batches, 2):
        yield from _shard_counts(block, 2, block.ok[1])


def _longer(frequent, local_support: int) -> Callable:
    """Counts of longer phrases, and the words of frequent pairs, with a count that lets them pass."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        bits = np.frombuffer(frequent.value, dtype=np.uint8)
        salt = np.array(_SHARD_KEYS, dtype=np.uint64)
        for block in _blocks(batches):
            index = (block.keys[1] & np.uint64(MASK)) ^ salt[block.shard[:-1]]
            pair = chosen = block.ok[1] & has(bits, index)
            used = np.r_[pair, False] | np.r_[False, pair]
            words = np.unique(block.keys[0][used])
            yield pd.DataFrame({"key": words.view(np.int64), "shard": np.int32(0), "n": np.int64(local_support)})
            for n in range(3, LONGEST + 1):
                chosen = chosen[:-1] & pair[n - 2 :]
                yield from _shard_counts(block, n, chosen)

    return count


class _Counts:
    """Occurrences of phrases of n words over the blocks of a task, by hash, each hash with its words."""

    def __init__(self, n: int):
        self.n = n
        self.keys, self.f = np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.int64)
        #: The language and the words of each.
        self.ids = np.zeros((0, n + 1), dtype=np.int32)
        self.waiting: list[tuple] = []
        self.n_waiting = 0

    def add(self, block: _Block, chosen: np.ndarray) -> bool:
        """Count the chosen starts; False, and nothing is counted, if two phrases of the block have one hash."""
        starts = np.flatnonzero(chosen)
        keys, first, which, f = np.unique(
            block.keys[self.n - 1][starts], return_index=True, return_inverse=True, return_counts=True
        )
        ids = np.stack([block.lang[starts], *[block.a[starts + j] for j in range(self.n)]], axis=1)
        own = ids[first]
        if (ids != own[which]).any():
            return False
        self.waiting.append((keys, own, f))
        self.n_waiting += len(keys)
        return True

    def merge(self) -> bool:
        """Add up what waits; False, and what waits is kept apart, if two of its phrases have one hash."""
        keys = np.concatenate([self.keys, *[w[0] for w in self.waiting]])
        ids = np.concatenate([self.ids, *[w[1] for w in self.waiting]])
        f = np.concatenate([self.f, *[w[2] for w in self.waiting]])
        self.waiting, self.n_waiting = [], 0
        self.keys, self.ids, self.f = keys, ids, f
        order = np.argsort(keys, kind="stable")
        keys = keys[order]
        again = keys[1:] == keys[:-1]
        # A column at a time, and only where a hash comes again, so that nothing is held twice.
        later, earlier = order[1:][again], order[:-1][again]
        if any((ids[later, c] != ids[earlier, c]).any() for c in range(self.n + 1)):
            return False  # not added up: handed on as they are
        starts = np.flatnonzero(np.r_[True, ~again][: len(keys)])
        self.keys = keys[starts]
        self.f = np.add.reduceat(f[order], starts) if len(starts) else f
        self.ids = ids[order[starts]]
        return True

    def rows(self, vocabulary: _Vocabulary) -> Iterator[pd.DataFrame]:
        words, langs = vocabulary.words, list(vocabulary.langs)
        for at in range(0, len(self.keys), HANDED):
            ids = self.ids[at : at + HANDED].tolist()
            phrases = [(langs[i[0]], b" ".join([words[w] for w in i[1:]]).decode(), self.n) for i in ids]
            yield _rows(phrases, self.f[at : at + HANDED])


def _rows(phrases: list[tuple], f) -> pd.DataFrame:
    frame = pd.DataFrame(phrases, columns=["lang", "phrase", "words"])
    frame["f"] = np.array(f, dtype=np.int64)
    return frame


def _one_by_one(block: _Block, n: int, chosen: np.ndarray) -> pd.DataFrame:
    words, langs = block.vocabulary.words, list(block.vocabulary.langs)
    found = Counter(
        (langs[block.lang[i]], b" ".join([words[w] for w in block.a[i : i + n]]).decode(), n)
        for i in np.flatnonzero(chosen).tolist()
    )
    return _rows(list(found), list(found.values()))


def _phrases(candidates) -> Callable:
    """Rows (lang, phrase, words, f) of the candidates; phrase '' with words 0 stands for all words."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        bits = np.frombuffer(candidates.value, dtype=np.uint8)
        # Of the words of the task only those of candidates are kept.
        vocabulary, sizes = _Vocabulary(), Counter()
        counts = [_Counts(n) for n in range(1, LONGEST + 1)]

        def handed_on(i: int) -> Iterator[pd.DataFrame]:
            counts[i].merge()
            yield from counts[i].rows(vocabulary)
            counts[i] = _Counts(i + 1)

        for block in _blocks(batches):
            langs = list(block.vocabulary.langs)
            for lang, size in enumerate(np.bincount(block.lang[block.ok[0]], minlength=len(langs)).tolist()):
                sizes[langs[lang], "", 0] += size
            chosen = [ok & has(bits, key & np.uint64(MASK)) for ok, key in zip(block.ok, block.keys, strict=True)]
            block.renumber(vocabulary, chosen)
            for i, of_size in enumerate(counts):
                if chosen[i].any() and not of_size.add(block, chosen[i]):
                    yield _one_by_one(block, i + 1, chosen[i])
                if of_size.n_waiting > WAITING and not of_size.merge():
                    yield from handed_on(i)
            if sum(len(c.keys) for c in counts) >= COUNTED:
                for i in range(LONGEST):
                    yield from handed_on(i)
        for i in range(LONGEST):
            yield from handed_on(i)
        if sizes:
            yield _rows(list(sizes), list(sizes.values()))

    return count


def phrase_counts(
    docs: DataFrame,
    text: str = "text",
    lang: str = "lang",
    support: int = SUPPORT,
    shards: int = SHARDS,
    deal_by: str | None = None,
    tasks: int | None = None,
) -> DataFrame:
    """(lang, phrase, words, f): all phrases of 2 to LONGEST words with f >= support, and the words in them.

    Words and pieces as in ``collocations``; f counts all occurrences, overlapping ones too. A row
    of each language with an empty phrase and words 0 has the number of all its words.

    Candidates are counted by at most ``tasks`` tasks, by default one for each core that Spark knows of
    then, and more only where one would read over TASK_PAIRS word pairs. Each task hands on the candidates
    that it has met, so the partitions of a larger input would multiply the rows by tasks as well as by
    candidates. The result does not depend on it.
    """
    if not 1 <= shards <= len(_SHARD_KEYS):
        raise ValueError(f"shards must be 1 to {len(_SHARD_KEYS)}")
    whole = or_empty(F.col(text))
    dealt_by = F.xxhash64(whole) if deal_by is None else F.xxhash64(F.col(deal_by), F.length(whole))
    source = docs.select(
        whole.alias("text"),
        F.coalesce(F.col(lang).cast("string"), F.lit("und")).alias("lang"),
        F.pmod(dealt_by, F.lit(shards)).cast("int").alias("shard"),
    )
    local_support = -(-support // shards)

    def summed_up(count: Callable) -> DataFrame:
        counted = source.mapInArrow(_in_arrow(count, _KEYED), "key long, shard int, n long")
        return counted.groupBy("key", "shard").agg(F.sum("n").alias("n"))

    def frequent(summed: DataFrame) -> DataFrame:
        return stored(summed.where(F.col("n") >= local_support).select("key", "shard"))

    low = F.col("key").bitwiseAND(F.lit(MASK))
    salts = F.array(*[F.lit(k).cast("long") for k in _SHARD_KEYS[:shards]])
    all_pairs = Observation()
    pairs = frequent(summed_up(_pairs).observe(all_pairs, F.sum("n").alias("n")))
    in_shard = low.bitwiseXOR(F.get(salts, F.col("shard")))
    longer = _longer(bitmap(in_shard, pairs), local_support)
    longer = frequent(summed_up(longer))
    candidates = bitmap(low, pairs.unionByName(longer).select("key"))
    if tasks is None:
        tasks = max(docs.sparkSession.sparkContext.defaultParallelism, (all_pairs.get["n"] or 0) // TASK_PAIRS)
    counting = source.coalesce(tasks)
    counted = counting.mapInArrow(
        _in_arrow(_phrases(candidates), _WORDED), "lang string, phrase string, words int, f long"
    )
    summed = counted.groupBy("lang", "phrase", "words").agg(F.sum("f").alias("f"))
    return stored(summed.where((F.col("words") == 0) | (F.col("f") >= support)))


def _exact_number(column: Column | str) -> Column:
    return (F.col(column) if isinstance(column, str) else column).cast("decimal(38,0)")


def collocations(
    docs: DataFrame,
    text: str = "text",
    lang: str = "lang",
    support: int = SUPPORT,
    top: int | None = TOP,
    shards: int = SHARDS,
    deal_by: str | None = None,
    tasks: int | None = None,
) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the best phrases of each language, all of them if ``top`` is None.

    A-Z are lower-cased, texts cut at ``.,;:!?`` and the controls 10 to 13 into pieces, and these
    into words at blanks and tabs. a is how often the phrase occurs, n how many words the language
    has. Of the ways to cut the phrase in two the one with the least score counts (ties: the
    shortest first part); l and r count its parts. A phrase inside a longer one that accounts for
    COVERED percent of its occurrences goes.

    ``deal_by`` names the column that deals documents to shards, by default the text, and ``tasks`` how many
    tasks count the candidates at most; the result depends on neither. A null text is empty, a null language
    is ``und``. Repeated rows count as often as they come. An empty table, and one without frequent phrases,
    gives no rows. Other columns are not read.
    """
    counts = phrase_counts(docs, text, lang, support, shards, deal_by, tasks)
    known = counts.where("words > 0")
    phrases = known.where("words > 1").select("lang", "phrase", "words", F.col("f").alias("a"))
    parts = phrases.withColumn("w", F.split("phrase", " ")).withColumn(
        "k", F.explode(F.expr("sequence(1, words - 1)"))
    )
    first, rest = F.expr("slice(w, 1, k)"), F.expr("slice(w, k + 1, words - k)")
    cuts = parts.select(
        "lang", "phrase", "a", "k", F.array_join(first, " ").alias("first"), F.array_join(rest, " ").alias("rest")
    )
    left = known.select("lang", F.col("phrase").alias("first"), F.col("f").alias("l"))
    right = known.select("lang", F.col("phrase").alias("rest"), F.col("f").alias("r"))
    both = cuts.join(left, ["lang", "first"]).join(right, ["lang", "rest"])
    both = both.withColumn("wide_a", _exact_number("a")).withColumn("wide", _exact_number("l") + _exact_number("r"))
    score = F.expr(f"({SCALE}BD * wide_a) div wide").cast("long")
    scored = (
        both.withColumn("score", score)
        .groupBy("lang", "phrase", "a")
        .agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    )
    inner = (
        phrases.where("words > 2")
        .withColumn("w", F.split("phrase", " "))
        .withColumn("size", F.explode(F.expr("sequence(2, words - 1)")))
        .withColumn("at", F.explode(F.expr("sequence(1, words - size + 1)")))
        .select("lang", F.expr("array_join(slice(w, at, size), ' ')").alias("phrase"), F.col("a").alias("longer"))
        .groupBy("lang", "phrase")
        .agg(F.max("longer").alias("longer"))
    )
    covered = _exact_number("longer") * F.lit(100) >= _exact_number("a") * F.lit(COVERED)
    kept = scored.join(inner, ["lang", "phrase"], "left").where(~F.coalesce(covered, F.lit(False)))
    found = kept.select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score")
    best = [F.col("score").desc(), F.col("a").desc(), F.col("phrase").asc()]
    if top is not None:
        part = F.pmod(F.xxhash64("phrase"), F.lit(RANK_PARTS))
        in_part = F.row_number().over(Window.partitionBy("lang", "part").orderBy(*best))
        found = found.withColumn("part", part).withColumn("rank", in_part).where(F.col("rank") <= top)
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(*best)).cast("long")
    ranked = found.withColumn("rank", rank)
    if top is not None:
        ranked = ranked.where(F.col("rank") <= top)
    sizes = counts.where("words = 0").select("lang", F.col("f").alias("n"))
    return ranked.join(sizes, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
