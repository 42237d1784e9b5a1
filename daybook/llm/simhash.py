"""SimHash near-duplicates by multi-index hashing.

A fingerprint is cut into segments. Two fingerprints within the distance agree in
some segment up to a small radius, so every fingerprint looks up the Hamming
ball of each of its segments in the table of all segments, and full distances
are verified among those that meet.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daybook.llm.components import components
from daybook.scratch import stored

BITS = 64
#: Fingerprints link up to this distance.
MAX_BITS = 3
SEGMENTS = 2
SHINGLE = 3
#: A bucket with more fingerprints is split into blocks of about this size; every two blocks are compared.
BLOCK = 1024
#: Documents to remove up to this number are broadcast; beyond it both sides are shuffled.
BROADCAST_ROWS = 2_000_000

_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """Majority bits of the XXH64 (seed 42) of the word shingles, as a signed integer.

    A-Z count as a-z; shingles keep repeats and are joined by spaces; with fewer words
    than a shingle the whole sequence is one; without words it is zero.
    """
    words = (text or "").encode("utf-8", "surrogatepass").translate(_LOWER).split()
    if not words:
        return 0
    line, n = b" ".join(words), max(1, len(words) - shingle + 1)
    sizes = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    ends = np.cumsum(sizes + 1) - 1
    starts = ends - sizes
    last = ends[min(shingle, len(words)) - 1 :]
    digest = xxhash.xxh64_intdigest
    found = [digest(line[a:b], 42) for a, b in zip(starts[:n].tolist(), last[:n].tolist(), strict=True)]
    hashes = np.array(found, dtype="<u8")
    ones = np.zeros(BITS, dtype=np.int64)
    for i in range(0, n, 4096):
        part = hashes[i : i + 4096].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<i8")[0])


def with_fingerprint(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """All columns and ``fp`` (long)."""

    @F.pandas_udf("long")
    def of(texts: pd.Series) -> pd.Series:
        return pd.Series([fingerprint(t, shingle) for t in texts], dtype="int64")

    return docs.withColumn("fp", of(F.col("text")))


def _balls(max_bits: int, segments: int) -> list[tuple[int, int, list[int]]]:
    """(shift, width, flips) of each segment: the patterns of its Hamming ball without the centre.

    With max_bits = q * segments + r, some of the first r + 1 segments differs in at
    most q bits or some other one in at most q - 1; a negative radius needs no lookup.
    """
    q, r = divmod(max_bits, segments)
    edges = [BITS * i // segments for i in range(segments + 1)]
    found = []
    for i in range(segments):
        width, radius = edges[i + 1] - edges[i], q if i <= r else q - 1
        if radius >= 0:
            flips = [
                sum(1 << bit for bit in bits)
                for size in range(1, radius + 1)
                for bits in combinations(range(width), size)
            ]
            found.append((edges[i], width, flips))
    return found


def _met(fps: DataFrame, max_bits: int, segments: int) -> DataFrame:
    """(segment, value, fp): the fingerprints that meet in a table entry, two at least.

    Only lookups that hit an entry of the table, and entries that are hit or hold
    more than one fingerprint, are returned.
    """
    value = lambda shift, width: F.shiftrightunsigned("fp", shift).bitwiseAND(F.lit((1 << width) - 1))
    tables, probes = [], []
    for i, (shift, width, flips) in enumerate(_balls(max_bits, segments)):
        entry = fps.select(F.lit(i).alias("segment"), value(shift, width).alias("value"), "fp")
        tables.append(entry)
        if flips:
            ball = F.explode(F.array(*[F.lit(x).cast("long") for x in flips]))
            probes.append(entry.select("segment", "value", "fp", ball.alias("flip")).select("segment", F.col("value").bitwiseXOR(F.col("flip")).alias("value"), "fp"))

    def joined(frames):
        out = frames[0]
        for frame in frames[1:]:
            out = out.union(frame)
        return out

    table = joined(tables)
    sizes = table.groupBy("segment", "value").agg(F.count(F.lit(1)).alias("n"))
    if not probes:
        return table.join(sizes.where("n > 1"), ["segment", "value"], "left_semi")
    hits = stored(joined(probes).join(sizes, ["segment", "value"], "left_semi"))
    live = sizes.where("n > 1").select("segment", "value").union(hits.select("segment", "value")).distinct()
    return table.join(live, ["segment", "value"], "left_semi").union(hits)


def _links(max_bits: int):
    def least_linked(fps: np.ndarray) -> np.ndarray:
        """For each fingerprint the index of the least one it is connected with inside the group."""
        near = np.bitwise_count(fps[:, None] ^ fps[None, :]) <= max_bits
        label = np.arange(len(fps))
        while True:
            seen = np.where(near, label[None, :], len(fps)).min(axis=1)
            seen = seen[seen]
            if (seen == label).all():
                return label
            label = seen

    def links(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Spanning links of each bucket; rows come sorted by bucket, a bucket may span batches."""
        rest = pd.DataFrame({"bucket": np.zeros(0, np.int64), "fp": np.zeros(0, np.int64)})

        def spanned(frame):
            fps, bucket = frame["fp"].to_numpy(), frame["bucket"].to_numpy()
            cuts = np.flatnonzero(np.diff(bucket)) + 1
            out = []
            for group in np.split(fps, cuts):
                group = np.unique(group)
                if len(group) > 1:
                    label = least_linked(group.view(np.uint64))
                    other = label != np.arange(len(group))
                    out.append(np.stack([group[other], group[label[other]]]))
            a, b = np.concatenate(out, axis=1) if out else np.zeros((2, 0), np.int64)
            return pd.DataFrame({"a": a, "b": b})

        for batch in batches:
            rows = pd.concat([rest, batch[["bucket", "fp"]]], ignore_index=True)
            if not len(rows):
                continue
            open_ = rows["bucket"] == rows["bucket"].iloc[-1]
            rest = rows[open_]
            yield spanned(rows[~open_])
        yield spanned(rest)

    return links


def fingerprint_links(fps: DataFrame, max_bits: int = MAX_BITS, segments: int = SEGMENTS) -> DataFrame:
    """Links (a, b) between distinct fingerprints that span the same components as all pairs within ``max_bits``.

    A bucket of n fingerprints gives at most n - 1 links, not all pairs. A large bucket is
    dealt over blocks by a hash of the fingerprint, and every two blocks are compared in
    a task of their own, so no task holds more than about two blocks of a bucket.
    """
    met = stored(_met(fps, max_bits, segments))
    sizes = met.groupBy("segment", "value").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    blocks = F.ceil(F.col("n") / BLOCK).cast("int")
    mine = F.pmod(F.xxhash64("fp"), F.col("blocks")).cast("int")
    dealt = (
        met.join(sizes.withColumn("blocks", blocks), ["segment", "value"])
        .withColumn("mine", mine)
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select(
            F.xxhash64("segment", "value", F.least("mine", "other"), F.greatest("mine", "other")).alias("bucket"),
            "fp",
        )
    )
    grouped = dealt.repartition("bucket").sortWithinPartitions("bucket")
    return grouped.mapInPandas(_links(max_bits), "a long, b long").distinct()


def near_duplicates(
    docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS, segments: int = SEGMENTS
) -> DataFrame:
    """One row per row of ``docs``: doc_id, text_hash, fp, component_id, kept.

    Documents link if their fingerprints differ in at most ``max_bits`` bits; component_id
    is the least doc_id that can be reached (null ids are passed over; null if there is no
    other), kept is the least (doc_id, text_hash), null first. Null and blank texts have
    fingerprint zero, linked like any other. Repeated rows are returned as often as they
    come. An empty table gives no rows.

    Copies share a fingerprint and are reduced to one row of it before anything else.
    """
    hashed = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), "text")
    marked = stored(with_fingerprint(hashed, shingle).drop("text"))
    fps = marked.groupBy("fp").agg(
        F.min("doc_id").alias("first"), F.min(F.struct("doc_id", "text_hash")).alias("kept")
    )
    roots = components(fingerprint_links(fps.select("fp"), max_bits, segments))
    placed = fps.join(roots.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", F.coalesce("root", "fp").alias("root"), "first", "kept"
    )
    least = placed.groupBy("root").agg(F.min("first").alias("component_id"), F.min("kept").alias("kept"))
    ids = stored(placed.select("fp", "root").join(least, "root").drop("root"))
    return marked.join(ids, "fp").select("doc_id", "text_hash", "fp", "component_id", "kept")


def keep_one(
    docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS, segments: int = SEGMENTS
) -> DataFrame:
    """The rows of ``docs`` without near-duplicates: one document of each component stays, unchanged.

    It is the one of least doc_id, then text hash, null first; of rows equal in both, one
    stays. Texts are not shuffled while the documents to remove are at most BROADCAST_ROWS.
    """
    return keep_first(docs, near_duplicates(docs, shingle, max_bits, segments))


def keep_first(docs: DataFrame, found: DataFrame) -> DataFrame:
    """The rows of ``docs`` that ``found`` (doc_id, text_hash, kept; one row each) keeps, as in ``keep_one``."""
    here = F.struct("doc_id", "text_hash")
    keys = found.groupBy("doc_id", "text_hash").agg(
        F.count(F.lit(1)).alias("_rows"), F.first(here.eqNullSafe(F.col("kept"))).alias("_stays")
    )
    odd = stored(keys.where("NOT _stays OR _rows > 1").toDF("_key_id", "_key_hash", "_rows", "_stays"))
    if odd.count() <= BROADCAST_ROWS:
        odd = F.broadcast(odd)
    same = docs["doc_id"].eqNullSafe(F.col("_key_id")) & F.xxhash64("text").eqNullSafe(F.col("_key_hash"))
    single = docs.join(odd, same, "left_anti")
    repeated = docs.join(odd.where("_stays"), same).dropDuplicates(["_key_id", "_key_hash"])
    return single.unionByName(repeated.select(docs.columns))
