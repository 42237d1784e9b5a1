"""From raw documents to a training mixture: five corpus operators in a row.

Every stage takes (spark, docs, sf_dir), works on all documents that the stage before
has kept, and returns the columns of documents; the last one returns each document
as often as the mixture takes it, numbered by ``copy``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daybook.llm import decontaminate, lines, mixing, quality, simhash
from daybook.scratch import stored

#: A document goes if its quality score is lower; between this and the classifier's own
#: threshold it is doubtful, and stays.
REJECT_BELOW = 0.5
#: Words in a shingle of the near-duplicate stage, and the bits in which linked fingerprints differ at most.
SHINGLE = 3
MAX_BITS = 3


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject."""
    labels = _table(spark, sf_dir, "labels").select("doc_id", F.col("quality").alias("label"))
    scored = quality.score_quality(docs, quality.fit_quality(docs, labels))
    return scored.where(F.col("score") >= REJECT_BELOW).select(docs.columns)


def without_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents; of lines that repeat, the first one stays. n_chars follows the text."""
    cleaned = lines.drop_repeated_lines(docs)
    changed = F.col("n_dropped") > 0
    n_chars = F.when(changed, F.length("text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars"))
    return cleaned.withColumn("n_chars", n_chars).select(docs.columns)


def without_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that SimHash fingerprints link."""
    return simhash.keep_one(docs, SHINGLE, MAX_BITS)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain no benchmark item."""
    return decontaminate.decontaminate(docs, _table(spark, sf_dir, "benchmark"))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mixture: each document floor(rate) times, and once more by chance."""
    return mixing.mix(docs)


STAGES = [
    ("quality", good_quality),
    ("line_dedup", without_repeated_lines),
    ("simhash", without_near_duplicates),
    ("decontaminate", without_benchmark),
    ("mix", mixed),
]

#: A trained classifier and edit distances are not SQL; the tests compare with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over documents; what each returns is stored and read again by the next."""
    docs = _table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
