"""Katz backoff over word pairs.

The counts of a pair are discounted by Good and Turing; what that frees goes to
the words that did not follow a context in training, in proportion to their own
discounted share, and the backoff weight of a context makes its probabilities sum
to one. Unknown words are one class that has the freed share of single words.

Texts are cut into pairs once. Every pair goes to the partition of its second word,
packed by the task that read it; there its counts and the share of the word are
known, so a partition gives sums per document and sums per context, and lists what
backs off. With the discounts, which follow from the sums, documents and contexts
are added up, and what backs off is joined with the weight of its context:

    log P(w | v) = log d(c(v w)) c(v w) - log c(v)      if v w was seen
                 = log weight(v) + log P(w)             else
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daybook.llm.text import or_empty
from daybook.scratch import stored

#: Counts up to this number are discounted by Good and Turing, larger ones by LARGE_DISCOUNT.
GOOD_TURING = 5
LARGE_DISCOUNT = 0.5
#: Pairs go to at least so many partitions, and to more when one would hold more than PART_TOKENS.
MIN_PARTS = 24
PART_TOKENS = 4_000_000
#: Tokens that a task packs at a time, and words it remembers.
BLOCK_TOKENS = 4_000_000
MEMORY = 1_000_000
#: Rows whose tokens are texts at a time; beyond that they are numbers.
ROWS = 500

_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
_START = np.uint64(0x53A5_7A27_0000_0001)
_COUNTS = [f"n{r}" for r in range(1, GOOD_TURING + 2)]


class _Words(dict):
    """Word to a number in order of appearance; ``hashes`` has the hash of each number. b"" is the end."""

    def __init__(self):
        super().__init__()
        self.hashes: list[int] = []

    def __missing__(self, word: bytes) -> int:
        self.hashes.append(xxhash.xxh64_intdigest(word, 11))
        number = self[word] = len(self.hashes) - 1
        return number

    def table(self) -> np.ndarray:
        return np.array(self.hashes, dtype=np.uint64)


_END = np.uint64(xxhash.xxh64_intdigest(b"", 11))


def _tokens(texts) -> tuple[list[bytes], list[int]]:
    """All tokens of some texts in a row, each closed by b"", and their numbers."""
    tokens, sizes = [], []
    for text in texts:
        words = (text or "").encode("utf-8", "surrogatepass").translate(_LOWER).split()
        words.append(b"")
        tokens += words
        sizes.append(len(words))
    return tokens, sizes


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    return x ^ (x >> np.uint64(29))


def unigrams(docs: DataFrame) -> DataFrame:
    """(w, c): hash (signed) and count of every training token."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        words, counts = _Words(), np.zeros(0, dtype=np.int64)

        def out():
            return pd.DataFrame({"w": words.table().view(np.int64), "c": counts})

        for batch in batches:
            for start in range(0, len(batch), ROWS):
                tokens, _ = _tokens(batch["text"].iloc[start : start + ROWS])
                numbers = np.fromiter(map(words.__getitem__, tokens), dtype=np.int64, count=len(tokens))
                found = np.bincount(numbers, minlength=len(words.hashes))
                found[: len(counts)] += counts
                counts = found
                if len(counts) > MEMORY:
                    yield out()
                    words, counts = _Words(), np.zeros(0, dtype=np.int64)
        yield out()

    return docs.select("text").mapInPandas(count, "w long, c long").groupBy("w").agg(F.sum("c").alias("c"))


def discounts(of_counts: list[int]) -> list[float]:
    """d(r) for r from 1 to GOOD_TURING, from the numbers of types seen 1, 2, ... times.

    Where the counts are too few for Good and Turing's estimate to lie between 0 and 1
    the discount is that of large counts.
    """
    n = [0.0, *map(float, of_counts)]
    k = GOOD_TURING
    found = []
    last = (k + 1) * n[k + 1] / n[1] if n[1] else 1.0
    for r in range(1, k + 1):
        d = ((r + 1) * n[r + 1] / (r * n[r]) - last) / (1 - last) if n[r] and last < 1 else -1.0
        found.append(d if 0 < d < 1 else (r - LARGE_DISCOUNT) / r)
    return found


def discounted(counts: np.ndarray, d: list[float]) -> np.ndarray:
    table = np.array([0.0, *[(r + 1) * x for r, x in enumerate(d)]])
    small = counts <= GOOD_TURING
    return np.where(small, table[np.where(small, counts, 0)], counts - LARGE_DISCOUNT)


class _Unigram:
    """Shares of single words: share(c) of a word with count c, zero for the unknown class."""

    def __init__(self, total: int, of_counts: list[int], mass: dict[str, float]):
        self.d = discounts(of_counts)
        small = sum((r + 1) * d * n for r, (d, n) in enumerate(zip(self.d, of_counts[:GOOD_TURING], strict=True)))
        kept = small + mass["large"]
        unknown = max(1.0 - kept / total, 1.0 / (total + 1)) if total else 1.0
        self.unknown = unknown
        self.scale = (1.0 - unknown) / kept if kept else 0.0

    def share(self, counts: np.ndarray) -> np.ndarray:
        return np.where(counts > 0, discounted(counts, self.d) * self.scale, self.unknown)


def _packed(arrays: list[np.ndarray]) -> bytes:
    """Arrays one after the other, each as planes of bytes, compressed."""
    squeeze = zstandard.ZstdCompressor(level=1)
    out = []
    for a in arrays:
        planes = a.view(np.uint8).reshape(len(a), -1).T.tobytes()
        body = squeeze.compress(planes)
        out.append(struct.pack("<2sqq", a.dtype.str[1:].encode(), len(a), len(body)) + body)
    return b"".join(out)


def _unpacked(blob: bytes) -> list[np.ndarray]:
    expand, at, out = zstandard.ZstdDecompressor(), 0, []
    head = struct.calcsize("<2sqq")
    while at < len(blob):
        kind, n, size = struct.unpack_from("<2sqq", blob, at)
        dtype = np.dtype("<" + kind.decode())
        planes = expand.decompress(blob[at + head : at + head + size]) if n else b""
        flat = np.frombuffer(planes, dtype=np.uint8).reshape(dtype.itemsize, n).T
        out.append(np.ascontiguousarray(flat).view(dtype).reshape(n))
        at += head + size
    return out


def _pairs(parts: int, large: dict[int, tuple[int, int]]):
    """Task that packs the pairs of its texts by partition.

    ``large`` has the words that one partition should not hold alone: hash to count and
    number of shares; they are dealt over several partitions by the word before.
    """
    large_hashes = np.array(sorted(large), dtype=np.uint64)
    shares = np.array([large[int(h)][1] for h in large_hashes], dtype=np.uint64)

    def part_of(w: np.ndarray, v: np.ndarray) -> np.ndarray:
        salt = np.zeros(len(w), dtype=np.uint64)
        if len(large_hashes):
            at = np.minimum(np.searchsorted(large_hashes, w), len(large_hashes) - 1)
            is_large = large_hashes[at] == w
            salt[is_large] = _mixed(v[is_large]) % shares[at[is_large]]
        return (_mixed(w + salt * np.uint64(0xC2B2AE3D27D4EB4F)) % np.uint64(parts)).astype(np.int32)

    def subset(numbers: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        used = np.zeros(len(table), dtype=bool)
        used[numbers] = True
        place = (np.cumsum(used) - 1).astype(np.uint32)
        return table[used], place[numbers]

    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        words, pending = _Words(), []

        def flush() -> pd.DataFrame:
            w = np.concatenate([p[0] for p in pending])
            sizes = np.concatenate([p[1] for p in pending])
            keys = np.concatenate([p[2] for p in pending])
            train = np.concatenate([p[3] for p in pending])
            table = np.append(words.table(), _START)
            v = np.concatenate([[0], w[:-1]]).astype(np.uint32)
            v[np.concatenate([[0], np.cumsum(sizes)[:-1]])] = len(table) - 1
            doc = np.repeat(np.arange(len(sizes), dtype=np.uint32), sizes)
            part = part_of(table[w], table[v])
            order = np.argsort(part, kind="stable")
            ends = np.searchsorted(part[order], np.arange(parts + 1))
            rows = []
            for p in range(parts):
                mine = order[ends[p] : ends[p + 1]]
                if len(mine):
                    table_w, in_w = subset(w[mine], table)
                    table_v, in_v = subset(v[mine], table)
                    docs, in_d = subset(doc[mine], np.arange(len(sizes)))
                    rows.append((p, _packed([table_w, in_w, table_v, in_v, keys[docs], train[docs], in_d])))
            return pd.DataFrame(rows, columns=["part", "blob"])

        waiting = 0
        for batch in batches:
            for start in range(0, len(batch), ROWS):
                some = batch.iloc[start : start + ROWS]
                tokens, sizes = _tokens(some["text"])
                numbers = np.fromiter(map(words.__getitem__, tokens), dtype=np.uint32, count=len(tokens))
                pending.append((numbers, np.array(sizes), some["key"].to_numpy(), some["train"].to_numpy().astype(np.uint8)))
                waiting += len(tokens)
                if waiting > BLOCK_TOKENS or len(words.hashes) > MEMORY:
                    yield flush()
                    words, pending, waiting = _Words(), [], 0
        if pending:
            yield flush()

    return pack


def _numbered(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where each different value is first, values ascending, and the number of the value at each place.

    As numpy's unique, in two thirds of the memory.
    """
    order = np.argsort(x, kind="stable")
    in_order = x[order]
    new = np.ones(len(x), dtype=bool)
    np.not_equal(in_order[1:], in_order[:-1], out=new[1:])
    del in_order
    numbers = np.empty(len(x), dtype=np.uint32)
    numbers[order] = np.cumsum(new, dtype=np.uint32) - np.uint32(1)
    return order[new], numbers


def _summed(model: _Unigram, large: dict[int, tuple[int, int]]):
    """All pairs of a partition to sums per document (kind 0), per context (1), and what backs off (2)."""

    def total(group: pd.DataFrame) -> pd.DataFrame:
        # Arrays as long as the partition has tokens are narrow, and dropped once they are used.
        blobs = [_unpacked(b) for b in group["blob"]]
        offsets = np.cumsum([0, *[len(b[4]) for b in blobs]])
        doc = np.concatenate([b[6] + np.uint32(o) for b, o in zip(blobs, offsets[:-1], strict=True)])
        keys = np.concatenate([b[4] for b in blobs])
        train = np.concatenate([b[5] for b in blobs]).astype(bool)[doc]
        w = np.concatenate([b[0][b[1]] for b in blobs])
        v = np.concatenate([b[2][b[3]] for b in blobs])
        del blobs
        pair = _mixed(_mixed(w) + v)
        first, in_w = _numbered(w)
        words = w[first]
        del w
        count = np.bincount(in_w[train], minlength=len(words))
        for h, (c, _) in large.items():
            at = np.searchsorted(words, np.uint64(h))
            if at < len(words) and words[at] == np.uint64(h):
                count[at] = c
        first, in_pair = _numbered(pair)
        del pair
        pair_w, pair_v = in_w[first], v[first]
        pair_count = np.bincount(in_pair[train], minlength=len(first)).astype(np.int32)
        seen = pair_count[in_pair]
        del in_pair, first, train
        share = model.share(count)

        n_docs = len(keys)
        own = np.where((count > 0) & (words != _END), np.log10(np.maximum(count, 1)), 0.0)
        low = np.log10(share)
        gain = -own[in_w]
        many, off = np.flatnonzero(seen > GOOD_TURING), np.flatnonzero(seen == 0)
        gain[many] += np.log10(seen[many] - LARGE_DISCOUNT)
        gain[off] += low[in_w[off]]
        of_doc = lambda some: np.bincount(doc[some], minlength=n_docs).astype(np.int32)
        per_doc = {"kind": 0, "key": keys, "v": 0, "total": np.bincount(doc, minlength=n_docs)}
        per_doc["known"] = of_doc((count > 0)[in_w])
        for r, name in enumerate(_COUNTS, 1):
            per_doc[name] = of_doc(seen == r)
        per_doc["b"] = np.bincount(doc, weights=gain, minlength=n_docs)
        del gain
        per_doc["a"] = np.bincount(doc, weights=np.log10(count + 0.1)[in_w], minlength=n_docs)
        back = {"kind": 2, "key": keys[doc[off]], "v": v[off].view(np.int64), "total": 1, "known": 0, "a": 0.0, "b": 0.0}
        back |= dict.fromkeys(_COUNTS, 0)
        del in_w, v, seen, doc

        known_pairs = pair_count > 0
        pair_v, pair_c = pair_v[known_pairs], pair_count[known_pairs]
        contexts, in_v = np.unique(pair_v, return_inverse=True)
        n_v = len(contexts)
        add = lambda x: np.bincount(in_v, weights=x, minlength=n_v)
        per_v = {"kind": 1, "key": contexts.view(np.int64), "v": 0, "total": add(pair_c).astype(np.int64), "known": 0}
        for r, name in enumerate(_COUNTS, 1):
            per_v[name] = np.bincount(in_v[pair_c == r], minlength=n_v)
        per_v["a"] = add(np.where(pair_c > GOOD_TURING, pair_c - LARGE_DISCOUNT, 0.0))
        per_v["b"] = add(share[pair_w[known_pairs]])

        return pd.concat([pd.DataFrame(x) for x in (per_doc, per_v, back)], ignore_index=True)

    return total


def scores(docs: DataFrame, train: Column) -> DataFrame:
    """doc_id, n_tokens, n_known, train_tokens, base_score and score of every row of ``docs``.

    ``docs`` has doc_id and text; the model learns from the rows where ``train`` holds (null:
    not). Tokens are words, A-Z lower-cased, and one end; a null text has the end
    alone. base_score sums log10((c + 0.1) / (N + 0.1 (V + 1))), score is the log10
    probability by the model. Without training rows all words are unknown: the score
    is 0, and base_score follows its formula. Repeated rows get the same scores.

    A frequent word is dealt over partitions by the word before it. Sums of documents
    and contexts are shuffled, texts are not.
    """
    is_train = F.coalesce(train, F.lit(False))
    keyed = docs.select(
        "doc_id",
        or_empty(F.col("text")).alias("text"),
        F.xxhash64("doc_id", or_empty(F.col("text"))).alias("key"),
        is_train.alias("train"),
    )
    words = stored(unigrams(keyed.where("train")))
    r = [F.sum((F.col("c") == i).cast("long")).alias(f"n{i}") for i in range(1, GOOD_TURING + 2)]
    large_mass = F.sum(F.when(F.col("c") > GOOD_TURING, F.col("c") - LARGE_DISCOUNT)).alias("large")
    stats = words.agg(F.sum("c").alias("total"), F.count(F.lit(1)).alias("types"), large_mass, *r).first()
    n_tokens, n_types = stats["total"] or 0, stats["types"]
    model = _Unigram(n_tokens, [stats[n] or 0 for n in _COUNTS], {"large": stats["large"] or 0.0})

    parts = max(MIN_PARTS, -(-n_tokens // PART_TOKENS))
    limit = n_tokens / parts / 2
    # At most 2 * parts words can have so many of the tokens.
    frequent = words.where(F.col("c") > limit).collect() if n_tokens else []
    large = {row["w"] % (1 << 64): (row["c"], int(row["c"] // limit) + 1) for row in frequent}

    pairs = keyed.select("text", "key", "train").mapInPandas(_pairs(parts, large), "part int, blob binary")
    counts = ", ".join(f"{n} long" for n in _COUNTS)
    schema = f"kind int, key long, v long, total long, known long, {counts}, a double, b double"
    summed = stored(pairs.groupBy("part").applyInPandas(_summed(model, large), schema), "kind", compression="zstd")
    return _put_together(keyed, summed, n_tokens, n_types)


def _put_together(keyed: DataFrame, summed: DataFrame, n_tokens: int, n_types: int) -> DataFrame:
    of = lambda kind: summed.where(F.col("kind") == kind)
    found = of(1).agg(*[F.sum(n).alias(n) for n in _COUNTS]).first()
    d = discounts([found[n] or 0 for n in _COUNTS])
    small = _COUNTS[:GOOD_TURING]
    mass = sum((F.col(n) * (i + 1) * x for i, (n, x) in enumerate(zip(small, d, strict=True))), F.col("a"))
    contexts = (
        of(1)
        .select("key", "total", mass.alias("mass"), "b")
        .groupBy("key")
        .agg(F.sum("total").alias("c"), F.sum("mass").alias("mass"), F.sum("b").alias("low"))
    )
    left = 1 - F.col("mass") / F.col("c")
    # log10 of the weight, and of c(v), which the sums have taken off as for a seen pair.
    weight = contexts.select(
        F.col("key").alias("v"), (F.log10(left / (1 - F.col("low"))) + F.log10(F.col("c").cast("double"))).alias("add")
    )
    off = of(2).select("key", "v").join(weight, "v", "left")
    backed = off.groupBy("key").agg(F.sum(F.coalesce("add", F.lit(0.0))).alias("add"))

    gains = sum((F.col(n) * float(np.log10((i + 1) * x)) for i, (n, x) in enumerate(zip(small, d, strict=True))), F.col("b"))
    documents = (
        of(0)
        .select("key", "total", "known", "a", gains.alias("gain"))
        .groupBy("key")
        .agg(*[F.sum(c).alias(c) for c in ("total", "known", "a", "gain")])
    )
    rows = keyed.select("doc_id", "key", "train")
    copies = rows.groupBy("key").agg(F.count(F.lit(1)).alias("copies"), F.max("train").alias("trained"))
    start = F.log10(F.greatest(F.lit(1.0), _starts(rows)))
    per_key = documents.join(copies, "key").join(backed, "key", "left")
    each = lambda c: F.col(c) / F.col("copies")
    base = each("a") - each("total") * float(np.log10(n_tokens + 0.1 * (n_types + 1)))
    score = each("gain") + F.coalesce(each("add"), F.lit(0.0)) - start
    scored = per_key.select(
        "key",
        each("total").cast("long").alias("n_tokens"),
        each("known").cast("long").alias("n_known"),
        F.lit(n_tokens).cast("long").alias("train_tokens"),
        base.alias("base_score"),
        score.alias("score"),
    )
    return rows.join(scored, "key").drop("key", "train")


def _starts(rows: DataFrame) -> Column:
    """The count of the start, the context of every first word: the number of training rows."""
    return F.lit(float(rows.where("train").count()))
