"""Nearest neighbours by cosine with multiprobe p-stable hashing.

Unit vectors are projected on Gaussian directions and cut into cells; several
directions form the bucket of a table. A query visits its own bucket and those
that a few coordinates, moved to a neighbouring cell, lead to, in the order of
the squared distances to the cell borders, that is of their estimated success.
What the tables yield is merged and ranked by the exact cosine.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from itertools import combinations, product

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from daybook.llm.text import unit_interval
from daybook.scratch import stored

TABLES = 6
#: Width of a cell; unit vectors project with a deviation of 1.
WIDTH = 3.0
#: Directions are added until a bucket would hold about this many vectors.
BUCKET = 128
MIN_DIRECTIONS, MAX_DIRECTIONS = 4, 16
#: Buckets a query may visit in a table.
PROBES = (1, 2, 4, 8, 12, 16, 24, 32, 48, 64)
#: The index is fitted on about so many vectors, searched for the neighbours of QUERIES of them.
SAMPLE, QUERIES = 12_000, 300
#: Share of true neighbours that the fit must find in the sample.
RECALL = 0.95
#: Finds a task gathers before it keeps the best of each query.
GATHERED = 100_000
#: A bucket with more vectors is searched in parts of about this size.
PART = 4096
BROADCAST_ROWS = 500_000


@dataclass(frozen=True)
class Index:
    directions: int
    probes: int
    tables: int = TABLES
    width: float = WIDTH


@lru_cache(maxsize=8)
def _projections(dim: int, index: Index) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng([dim, index.directions, index.tables])
    a = rng.standard_normal((dim, index.tables, index.directions))
    return a, rng.uniform(0, index.width, (index.tables, index.directions))


@lru_cache(maxsize=8)
def _moves(directions: int) -> np.ndarray:
    """Perturbations: rows of -1, 0 and 1, at most four coordinates moved (three for many directions)."""
    rows = []
    for size in range(5 if directions <= 10 else 4):
        for places in combinations(range(directions), size):
            for signs in product((-1, 1), repeat=size):
                row = np.zeros(directions, dtype=np.int64)
                row[list(places)] = signs
                rows.append(row)
    return np.array(rows)


def _cells(x: np.ndarray, index: Index) -> tuple[np.ndarray, np.ndarray]:
    """Cell of each vector, table and direction, and the place inside it from 0 to 1."""
    a, b = _projections(x.shape[1], index)
    at = (np.einsum("nd,dtm->ntm", x, a, optimize=True) + b) / index.width
    cells = np.floor(at)
    return cells.astype(np.int64), at - cells


def _costs(inside: np.ndarray, moves: np.ndarray) -> np.ndarray:
    """Summed squared distances to the borders that each move crosses."""
    return inside**2 @ (moves < 0).T + (1 - inside) ** 2 @ (moves > 0).T


def _buckets(cells: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the last axis."""
    with np.errstate(over="ignore"):
        h = np.full(cells.shape[:-1], 0x9E3779B97F4A7C15, dtype=np.uint64)
        for i in range(cells.shape[-1]):
            h = (h ^ cells[..., i].astype(np.uint64)) * np.uint64(0xD6E8FEB86659FD93)
            h ^= h >> np.uint64(32)
    return h.view(np.int64)


def fit_index(vectors: np.ndarray, n: int, k: int) -> Index:
    """Directions and probes for ``n`` vectors, from a sample of them (rows of unit length).

    Starts with as many directions as buckets of the wanted size need, and takes
    the fewest probes that find the share RECALL of the sample's true k nearest;
    with too little found, it does with a direction less. Neighbours are nearer among
    all vectors than in a sample, so recall on all of them is rather higher.
    """
    directions = int(np.clip(np.ceil(np.log(max(n, 1) / BUCKET) / np.log(2.2)) + 2, MIN_DIRECTIONS, MAX_DIRECTIONS))
    if len(vectors) <= k + 1:
        return Index(MIN_DIRECTIONS, PROBES[-1])
    queries = vectors[:QUERIES]
    near = queries @ vectors.T
    near[np.arange(len(queries)), np.arange(len(queries))] = -2.0
    nearest = np.argpartition(-near, k, axis=1)[:, :k]
    for m in range(directions, MIN_DIRECTIONS - 1, -1):
        index, moves = Index(m, 0), _moves(m)
        cells, inside = _cells(vectors, index)
        best = np.full((len(queries), k), np.inf)
        for t in range(index.tables):
            costs = np.sort(_costs(inside[: len(queries), t], moves), axis=1)
            for q in range(len(queries)):
                move = cells[nearest[q], t] - cells[q, t]
                reach = np.abs(move).max(axis=1) <= 1
                cost = (np.where(move < 0, inside[q, t], 1 - inside[q, t]) ** 2 * (move != 0)).sum(axis=1)
                rank = np.searchsorted(costs[q], cost - 1e-12)
                best[q] = np.minimum(best[q], np.where(reach, rank, np.inf))
        for probes in PROBES:
            if (best < probes).mean() >= RECALL:
                return Index(m, probes)
    return Index(MIN_DIRECTIONS, 3**MIN_DIRECTIONS)


def _matrix(column: pd.Series) -> np.ndarray:
    return np.frombuffer(b"".join(column), dtype=np.float64).reshape(len(column), -1)


def _by_dim(batch: pd.DataFrame) -> Iterator[pd.DataFrame]:
    for _, rows in batch.groupby(batch["vec"].str.len(), sort=True):
        yield rows


def _hashed(index: Index, probing: bool):
    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for whole in batches:
            for batch in _by_dim(whole):
                for start in range(0, len(batch), 256):
                    part = batch.iloc[start : start + 256]
                    cells, inside = _cells(_matrix(part["vec"]), index)
                    for t in range(index.tables):
                        at = cells[:, t]
                        if probing:
                            moves = _moves(index.directions)
                            order = np.argsort(_costs(inside[:, t], moves), axis=1, kind="stable")[:, : index.probes]
                            at = (at[:, None, :] + moves[order]).reshape(-1, index.directions)
                        repeat = len(at) // len(part)
                        out = part.loc[part.index.repeat(repeat)]
                        yield out.assign(table=t, bucket=_buckets(at))

    return rows


def _searched(k: int):
    """The k best of a bucket for each probe; rows come sorted by bucket, vectors before probes."""

    def best(block: list[pd.DataFrame], probes: pd.DataFrame) -> Iterator[pd.DataFrame]:
        x = np.concatenate([_matrix(b["vec"]) for b in block])
        ids = np.concatenate([b["vid"].to_numpy() for b in block])
        first = np.concatenate([b["first"].to_numpy() for b in block])
        for start in range(0, len(probes), 512):
            part = probes.iloc[start : start + 512]
            scores = _matrix(part["vec"]) @ x.T
            if len(ids) > k:
                worst = -np.partition(-scores, k - 1, axis=1)[:, k - 1 : k]
                row, col = np.nonzero(scores >= worst)
            else:
                row, col = (i.ravel() for i in np.indices(scores.shape))
            order = np.lexsort((first[col], -scores[row, col], row))
            row, col = row[order], col[order]
            place = np.arange(len(row)) - np.searchsorted(row, row)
            row, col = row[place < k], col[place < k]
            qid = part["vid"].to_numpy()[row]
            yield pd.DataFrame({"qid": qid, "vid": ids[col], "first": first[col], "near": scores[row, col].round(12)})

    def kept(found: list[pd.DataFrame]) -> pd.DataFrame:
        """The k best of each query among the finds of a task."""
        rows = pd.concat(found, ignore_index=True).drop_duplicates(["qid", "vid"])
        rows = rows.sort_values(["qid", "near", "first"], ascending=[True, False, True])
        return rows[rows.groupby("qid").cumcount() < k]

    def search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        current, block, found, limit = None, [], [], GATHERED
        for batch in batches:
            for key, rows in batch.groupby(["dim", "table", "bucket", "part"], sort=False):
                if key != current:
                    current, block = key, []
                stored_rows, probes = rows[~rows["probe"]], rows[rows["probe"]]
                if len(stored_rows):
                    block.append(stored_rows)
                if len(probes) and block:
                    found += best(block, probes)
            if sum(map(len, found)) > limit:
                found = [kept(found)]
                limit = GATHERED + len(found[0])
        if found:
            yield kept(found)

    return search


def unit_vectors(vectors: DataFrame, column: str = "embedding") -> DataFrame:
    """(vec_id, embedding) of the vectors that take part, components as doubles.

    Null and zero vectors, and vectors with null or non-finite components, do not;
    nor do rows without vec_id.
    """
    e = F.col(column).cast("array<double>")
    usable = F.forall(e, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return vectors.select("vec_id", e.alias("embedding")).where(
        F.col("vec_id").isNotNull() & F.coalesce(usable, F.lit(False)) & F.exists("embedding", lambda x: x != 0)
    )


def _packed(df: DataFrame, schema: str) -> DataFrame:
    """``embedding`` as ``vec``: unit length, float64 bytes."""

    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            vecs = []
            for e in batch["embedding"]:
                x = np.asarray(e, dtype=np.float64)
                x = x / np.abs(x).max()
                vecs.append((x / np.linalg.norm(x)).tobytes())
            yield batch.drop(columns="embedding").assign(vec=vecs)

    return df.mapInPandas(pack, schema)


def _fitted(c: str):
    """The vector; divided by its largest component where squares would leave the range of doubles."""
    largest = F.array_max(F.transform(c, F.abs))
    scaled = F.transform(F.array(F.struct(F.col(c).alias("v"), largest.alias("m"))), lambda s: F.transform(s["v"], lambda x: x / s["m"]))
    return F.when(largest.between(1e-100, 1e100), F.col(c)).otherwise(scaled[0])


def _cosine(a: str, b: str):
    zero = F.lit(0.0)
    dot = F.aggregate(F.zip_with(a, b, lambda x, y: x * y), zero, lambda s, x: s + x)
    norm = lambda c: F.sqrt(F.aggregate(F.transform(c, lambda x: x * x), zero, lambda s, x: s + x))
    return dot / (norm(a) * norm(b))


def nearest(vectors: DataFrame, queries: DataFrame, k: int = 5, index: Index | None = None) -> DataFrame:
    """(query_id, rank, vec_id, score): for each row of ``queries`` its k nearest found in ``vectors``.

    Both have vec_id and embedding. Rows of the query's own vec_id are not candidates.
    score is the cosine in double precision; ties go to the smaller vec_id. Vectors of
    different length are never compared. Repeated vec_ids of queries count once. A
    query of which fewer candidates are found gets fewer rows.

    Equal vectors are searched as one, with their k + 1 least ids, which is all that
    a ranking of k without the query itself can hold.
    """
    usable = unit_vectors(vectors)
    n_first = W.partitionBy("embedding").orderBy("vec_id")
    least = usable.distinct().withColumn("n", F.row_number().over(n_first)).where(F.col("n") <= k + 1)
    known = stored(
        least.groupBy("embedding")
        .agg(F.sort_array(F.collect_list("vec_id")).alias("ids"))
        .select(F.monotonically_increasing_id().alias("vid"), "ids", "embedding")
    )
    asked = unit_vectors(queries).distinct().join(known.select("embedding", "vid"), "embedding")
    asked = stored(asked.select(F.col("vec_id").alias("query_id"), "vid"))

    n = known.count()
    if index is None:
        index = _fit(known, n, k)
    packed = stored(_packed(known.select("vid", F.element_at("ids", 1).alias("first"), "embedding"), "vid long, first long, vec binary"))
    schema = "vid long, first long, vec binary, table int, bucket long"
    stored_rows = packed.mapInPandas(_hashed(index, False), schema)
    probes = packed.join(asked.select("vid").distinct(), "vid", "left_semi").mapInPandas(_hashed(index, True), schema)
    dim = F.length("vec").alias("dim")
    entries = stored_rows.select("*", dim, F.lit(False).alias("probe"))
    lookups = probes.select("*", dim, F.lit(True).alias("probe"))

    bucket = ["dim", "table", "bucket"]
    large = stored(entries.groupBy(*bucket).agg(F.ceil(F.count(F.lit(1)) / PART).cast("int").alias("parts")).where("parts > 1"))
    if large.count() <= BROADCAST_ROWS:
        large = F.broadcast(large)
    parts = F.coalesce("parts", F.lit(1))
    mine = F.pmod(F.xxhash64("vid"), parts).cast("int")
    entries = entries.join(large, bucket, "left").withColumn("part", mine).drop("parts")
    lookups = lookups.join(large, bucket, "left").withColumn("part", F.explode(F.sequence(F.lit(0), parts - 1))).drop("parts")
    dealt = entries.unionByName(lookups).repartition(*bucket, "part").sortWithinPartitions(*bucket, "part", "probe")
    found = dealt.mapInPandas(_searched(k + 1), "qid long, vid long, first long, near double").distinct()
    nearest_first = W.partitionBy("qid").orderBy(F.desc("near"), "first")
    found = found.withColumn("place", F.row_number().over(nearest_first)).where(F.col("place") <= k + 1).drop("first", "near", "place")

    a = known.select(F.col("vid").alias("qid"), F.col("embedding").alias("a"))
    b = known.select("vid", "ids", F.col("embedding").alias("b"))
    scored = found.join(a, "qid").join(b, "vid").select("qid", "ids", _fitted("a").alias("a"), _fitted("b").alias("b"))
    scored = scored.select("qid", "ids", _cosine("a", "b").alias("score"))
    each = scored.select("qid", F.explode("ids").alias("vec_id"), "score")
    place = W.partitionBy("qid").orderBy(F.desc("score"), "vec_id")
    top = each.withColumn("place", F.row_number().over(place)).where(F.col("place") <= k + 1)
    ranked = asked.withColumnRenamed("vid", "qid").join(top, "qid").where("vec_id <> query_id")
    final = W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        ranked.withColumn("rank", F.row_number().over(final))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )


def _fit(known: DataFrame, n: int, k: int) -> Index:
    """Fit on about SAMPLE distinct vectors of the most common length, chosen by a hash."""
    chosen = known.where(unit_interval("fit", F.col("ids")[0]) < SAMPLE / max(n, 1)).select("embedding").toPandas()
    if not len(chosen):
        return Index(MIN_DIRECTIONS, PROBES[-1])
    sizes = chosen["embedding"].str.len()
    same = chosen["embedding"][sizes == sizes.mode()[0]]
    x = np.array(sorted(map(tuple, same)))
    x = x[np.random.default_rng(3).permutation(len(x))]
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return fit_index(x / np.linalg.norm(x, axis=1, keepdims=True), n, k)
