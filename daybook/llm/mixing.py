"""Mixing sources to target weights by repetition rates.

Tokens are summed per source; a source's target over its size is its rate; every
document is emitted floor(rate) times, and once more if a draw seeded by its id
falls below the fraction.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from daybook.llm.text import n_words, unit_interval
from daybook.scratch import stored

#: Weights of the sources in order, repeating.
WEIGHTS = (5, 2, 1)
#: No source is repeated more often than this.
MAX_REPEATS = 3
#: Rates of up to so many sources are broadcast; beyond it they are joined by key.
BROADCAST_SOURCES = 100_000
#: Parts a source is dealt over in that join.
SALTS = 64


def source_rates(
    docs: DataFrame, weights=WEIGHTS, max_repeats: int = MAX_REPEATS
) -> DataFrame:
    """One row per source: source, source_size, target, rate.

    Sources are taken by code point, null last, and weigh ``weights`` in turn. They
    share all tokens by weight; a target stops at ``max_repeats`` times its source,
    and what is left over goes to the others by weight. With sources in the order
    of cap over weight, the targets that stop form a prefix, so one pass of running
    sums finds the level of the rest.

    The windows run over the aggregated sources, one row each, not over documents.
    A source without tokens has target and rate zero. No documents give no rows.
    """
    sizes = docs.groupBy("source").agg(F.sum(n_words(F.col("text"))).alias("source_size"))
    by_name = W.orderBy(F.col("source").asc_nulls_last())
    place = F.pmod(F.row_number().over(by_name) - 1, F.lit(len(weights)))
    weight = F.element_at(F.array(*[F.lit(int(w)) for w in weights]), place + 1)
    ranked = sizes.withColumn("weight", weight.cast("long")).withColumn(
        "cap", F.col("source_size") * max_repeats
    )
    by_cap = W.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    before, all_rows = by_cap.rowsBetween(W.unboundedPreceding, -1), W.partitionBy()
    left_tokens = F.sum("source_size").over(all_rows) - F.coalesce(F.sum("cap").over(before), F.lit(0))
    left_weight = F.sum("weight").over(all_rows) - F.coalesce(F.sum("weight").over(before), F.lit(0))
    shared = ranked.withColumn("level", left_tokens.cast("double") / left_weight.cast("double"))
    open_level = F.when(F.col("level") <= F.col("cap") / F.col("weight"), F.struct("cap_rank", "level"))
    shared = shared.withColumn("cap_rank", F.row_number().over(by_cap))
    level = F.min(open_level).over(all_rows)["level"]
    target = F.least(F.col("cap").cast("double"), F.col("weight") * level)
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size"))
    return shared.withColumn("target", target).select(
        "source", "source_size", "target", F.coalesce(rate, F.lit(0.0)).alias("rate")
    )


def mix_plan(docs: DataFrame, weights=WEIGHTS, seed: str = "mix") -> DataFrame:
    """All documents with size, source_size, target and copies.

    Columns of ``docs`` with these names are replaced; the rest is kept. Copies
    depend on the source's rate, ``seed`` and ``doc_id`` alone, so repeated rows are
    copied alike and reruns agree. Null texts have size 0; null sources form one
    source. The documents are not shuffled: the rates are broadcast while there
    are at most ``BROADCAST_SOURCES``; beyond it both sides are joined by source
    and a salt, so that a large source is dealt over many tasks.
    """
    rates = stored(source_rates(docs, weights)).select(
        F.col("source").alias("_mix_source"),
        F.col("source_size").alias("_mix_source_size"),
        F.col("target").alias("_mix_target"),
        F.col("rate").alias("_mix_rate"),
    )
    sized = docs.drop("size", "source_size", "target", "copies").withColumn(
        "size", n_words(F.col("text"))
    )
    same = F.col("source").eqNullSafe(F.col("_mix_source"))
    if rates.count() <= BROADCAST_SOURCES:
        joined = sized.join(F.broadcast(rates), same)
    else:
        salts = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))
        salted = sized.withColumn("_mix_salt", F.pmod(F.xxhash64("doc_id"), F.lit(SALTS)).cast("int"))
        dealt = rates.withColumn("_mix_part", salts)
        joined = salted.join(dealt, same & (F.col("_mix_salt") == F.col("_mix_part")))
    whole = F.floor("_mix_rate")
    extra = unit_interval(seed, F.col("doc_id")) < F.col("_mix_rate") - whole
    return joined.select(
        *sized.columns,
        F.col("_mix_source_size").alias("source_size"),
        F.col("_mix_target").alias("target"),
        (whole + extra.cast("long")).alias("copies"),
    )


def mix(docs: DataFrame, weights=WEIGHTS, seed: str = "mix") -> DataFrame:
    """The mixture itself: each document as often as planned, numbered by ``copy`` from 1."""
    keep = [c for c in docs.columns if c != "copy"]
    plan = mix_plan(docs.select(*keep).withColumn("_mix_row", F.struct(*keep)), weights, seed)
    copies = plan.where(F.col("copies") > 0).withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))))
    return copies.select("_mix_row.*", "copy")
