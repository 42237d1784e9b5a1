"""Benchmark decontamination: size-partitioned MinHash containment search.

A document is sketched by one-permutation MinHash: the hash space is cut into bins,
and the least shingle hash of each bin is kept. Short items vanish in a sketch
of fixed size of a long document, so documents are partitioned by size and the
number of bins follows the size of the partition; an item has one sketch per
partition. Document and item are candidates if a bin agrees, and candidates are
verified by exact containment of their word shingles.

A shingle is the least of its bin with a probability of 0.79 at least (bins hold at
most half a shingle on average), so an item of which m shingles are contained is
missed with 0.21 ** m at most: below 1e-6 from SURE shingles on. Shingles that many
items share, such as those of a question template, would make a candidate of each of
these items and each document that holds the template; they are left out of the
sketches. An item that could then be found by fewer than SURE shingles is not sketched.
It is looked up among all shingles of the documents, by its rarest ones: of m
shingles with c to be contained, any m - c + 1 have one in the document.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daybook.llm.text import or_empty
from daybook.scratch import stored

SHINGLE = 5
CONTAINMENT = 0.8
#: Items of which fewer shingles are sure to tell are not sketched.
SURE = 10
#: Shingles of more items than this tell nothing in a sketch.
COMMON_ITEMS = 16
#: Partitions hold documents of up to 2 ** 0, 2 ** 1, ... shingles; the last one all larger.
PARTITIONS = 25
#: Item hashes and candidate pairs up to this number are broadcast; beyond it both sides are shuffled.
BROADCAST_ROWS = 2_000_000
#: The partition of what is not sketched.
_ALL = -1


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once."""
    return F.transform(F.array(value), body)[0]


def normal_words(text: Column) -> Column:
    """Runs of letters and digits, lower-cased."""
    return F.array_remove(F.split(F.lower(or_empty(text)), r"[^\p{L}\p{N}]+"), "")


def _windows(size: Column) -> Column:
    return F.sequence(F.lit(0), size - SHINGLE)


def shingle_hashes(text: Column) -> Column:
    """Sorted distinct hashes of the shingles; with fewer words than a shingle, of all words together."""

    def of(hashes: Column) -> Column:
        long_ = F.transform(
            _windows(F.size(hashes)),
            lambda i: F.xxhash64(*[F.get(hashes, i + j) for j in range(SHINGLE)]),
        )
        short = F.when(F.size(hashes) > 0, F.array(F.xxhash64(hashes))).otherwise(F.array().cast("array<bigint>"))
        return F.when(F.size(hashes) >= SHINGLE, long_).otherwise(short)

    hashed = F.transform(normal_words(text), lambda w: F.xxhash64(w))
    return F.sort_array(F.array_distinct(_let(hashed, of)))


def shingles(text: Column) -> Column:
    """The distinct shingles themselves, words joined by blanks."""

    def of(words: Column) -> Column:
        long_ = F.transform(_windows(F.size(words)), lambda i: F.array_join(F.slice(words, i + 1, SHINGLE), " "))
        short = F.when(F.size(words) > 0, F.array(F.array_join(words, " "))).otherwise(F.array().cast("array<string>"))
        return F.when(F.size(words) >= SHINGLE, long_).otherwise(short)

    return F.array_distinct(_let(normal_words(text), of))


def _partition(size: Column) -> Column:
    return F.least(F.ceil(F.log2(F.greatest(size, F.lit(1)))).cast("int"), F.lit(PARTITIONS - 1))


def _bin(value: Column, partition: Column) -> Column:
    """The upper bits of a hash: 2 ** (partition + 1) bins."""
    return F.call_function("shiftright", value, F.lit(63) - partition)


def _sketch(sorted_hashes: Column, partition: Column) -> Column:
    """The first hash of each bin."""
    return _let(
        sorted_hashes,
        lambda all_: F.filter(
            all_, lambda x, i: (i == 0) | (_bin(x, partition) != _bin(F.get(all_, i - 1), partition))
        ),
    )


def _item_keys(items: DataFrame, threshold: float) -> DataFrame:
    """(item_id, part, h): the sketch of each item for each partition; of items not sketched, their rarest shingles."""
    hashed = items.select("item_id", shingle_hashes(F.col("text")).alias("hs")).where(F.size("hs") > 0)
    single = hashed.select("item_id", "hs", F.explode("hs").alias("h"))
    shared = single.groupBy("h").agg(F.count(F.lit(1)).alias("f"))
    ranked = (
        single.join(shared, "h")
        .groupBy("item_id", "hs")
        .agg(F.sort_array(F.collect_list(F.struct("f", "h"))).alias("ranked"))
    )
    n = F.size("hs")
    needed = F.ceil(n * F.lit(threshold) - F.lit(1e-9)).cast("int")
    rare = F.filter("ranked", lambda x: x["f"] <= COMMON_ITEMS)
    known = stored(
        ranked.select(
            "item_id",
            F.sort_array(F.transform(rare, lambda x: x["h"])).alias("rare"),
            F.transform(F.slice("ranked", F.lit(1), F.greatest(n - needed + 1, F.lit(1))), lambda x: x["h"]).alias("first"),
            (needed - (n - F.size(rare)) >= SURE).alias("sketched"),
        )
    )
    per_part = known.where("sketched").withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(PARTITIONS - 1))))
    sketches = per_part.select("item_id", "part", F.explode(_sketch(F.col("rare"), F.col("part"))).alias("h"))
    whole = known.where("NOT sketched").select("item_id", F.lit(_ALL).alias("part"), F.explode("first").alias("h"))
    return sketches.union(whole)


def _fitting(df: DataFrame, rows: int) -> DataFrame:
    return F.broadcast(df) if rows <= BROADCAST_ROWS else df


def contaminated(docs: DataFrame, benchmark: DataFrame, threshold: float = CONTAINMENT) -> DataFrame:
    """(doc_id, text_hash, item_id, n_shingles, n_found, containment), one row per pair.

    ``benchmark`` has item_id and text. A pair is reported if at least ``threshold`` of the
    item's distinct shingles occur in the document. Items without words are in no
    document; an item of fewer words than a shingle is only in a document of just these
    words. Rows of equal doc_id and text, and equal items, are reported once. Null
    ids are reported as null. Whole texts are read, once for the sketch and once more
    for the candidates.
    """
    items = benchmark.select("item_id", "text").distinct()
    keys = stored(_item_keys(items, threshold))
    small = not keys.where(F.col("part") == _ALL).isEmpty()
    hashed = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), shingle_hashes(F.col("text")).alias("hs"))
    part = _partition(F.size("hs"))
    entries = _let(F.struct("hs", part.alias("part")), lambda d: F.transform(_sketch(d["hs"], d["part"]), lambda h: F.struct(d["part"].alias("part"), h.alias("h"))))
    if small:
        entries = F.concat(entries, F.transform("hs", lambda h: F.struct(F.lit(_ALL).alias("part"), h.alias("h"))))
    sketched = hashed.select("doc_id", "text_hash", F.inline(entries))
    hits = sketched.join(_fitting(keys, keys.count()), ["part", "h"])
    pairs = hits.groupBy("doc_id", "text_hash").agg(F.collect_set(F.coalesce("item_id", F.lit(-1))).alias("found"))
    return _verified(docs, items, stored(pairs), threshold)


def _verified(docs: DataFrame, items: DataFrame, pairs: DataFrame, threshold: float) -> DataFrame:
    pairs = pairs.toDF("found_id", "found_hash", "found")
    n = pairs.agg(F.coalesce(F.sum(F.size("found") + 1), F.lit(0))).first()[0]
    same = F.xxhash64("text").eqNullSafe(F.col("found_hash")) & F.col("doc_id").eqNullSafe(F.col("found_id"))
    candidates = docs.select("doc_id", "text").join(_fitting(pairs, n), same).dropDuplicates(["doc_id", "found_hash"])
    whole = candidates.select("doc_id", F.col("found_hash").alias("text_hash"), "found", shingles(F.col("text")).alias("in_doc"))
    wanted = items.select(F.coalesce("item_id", F.lit(-1)).alias("item_key"), "item_id", shingles(F.col("text")).alias("in_item"))
    each = whole.withColumn("item_key", F.explode("found")).join(wanted, "item_key")
    counted = each.select(
        "doc_id",
        "text_hash",
        "item_id",
        F.size("in_item").cast("long").alias("n_shingles"),
        F.size(F.array_intersect("in_item", "in_doc")).cast("long").alias("n_found"),
    )
    share = F.col("n_found") / F.col("n_shingles")
    return counted.withColumn("containment", share).where(F.col("containment") >= threshold)


def decontaminate(docs: DataFrame, benchmark: DataFrame, threshold: float = CONTAINMENT) -> DataFrame:
    """The rows of ``docs`` that contain no item, unchanged. No items keep all rows."""
    found = contaminated(docs, benchmark, threshold).select(
        F.col("doc_id").alias("_found_id"), F.col("text_hash").alias("_found_hash")
    )
    found = stored(found.distinct())
    same = F.xxhash64("text").eqNullSafe(F.col("_found_hash")) & docs["doc_id"].eqNullSafe(F.col("_found_id"))
    return docs.join(_fitting(found, found.count()), same, "left_anti")
