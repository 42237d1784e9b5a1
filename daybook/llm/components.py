"""Connected components by alternating large and small stars.

Every round replaces the neighbours of a node by its least neighbour, first the
larger ones, then the smaller ones, until each component is a star around its
least node. Minima are combined before the shuffle and joined back, so a node
with very many neighbours is neither grouped nor collected.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daybook.scratch import stored


def _to_least(edges: DataFrame) -> DataFrame:
    """(u, v) with the least of u and its neighbours v."""
    least = edges.groupBy("u").agg(F.least("u", F.min("v")).alias("m"))
    return edges.join(least, "u")


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select("v", "u"))
    return _to_least(both.toDF("u", "v")).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    joined = _to_least(down)
    return joined.select("v", "m").union(joined.select("u", "m")).toDF("u", "v").where("u <> v")


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges``, two columns of one ordered type.

    root is the least node of the component; roots are listed too. Loops and repeated
    edges are ignored. No edges give no rows.
    """
    a, b = edges.columns
    current = stored(edges.toDF("u", "v").where("u <> v").distinct())
    before = None
    while True:
        mark = current.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if mark == before:
            break
        before = mark
        current = stored(_small_star(stored(_large_star(current).distinct())).distinct())
    roots = current.select("v", "v").distinct()
    return current.union(roots).toDF("node", "root")
