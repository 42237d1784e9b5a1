"""Intermediate tables, in a folder that the driver and all executors share."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


def scratch_dir(spark: SparkSession) -> str:
    """A fresh folder name below ``spark.checkpoint.dir``.

    A cluster names its shared folder there; where that is unset the folder is
    below the warehouse, which executors share as well.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None) or (
        f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_scratch"
    )
    return f"{shared.rstrip('/')}/daybook-{uuid.uuid4().hex}"


def stored(df: DataFrame, *partition_by: str, compression: str = "snappy") -> DataFrame:
    """The rows of ``df``, written once and read back.

    Cuts the lineage: whatever reads the result again reads files, and a lost
    executor costs no more than the tasks it was running.
    """
    spark = df.sparkSession
    path = scratch_dir(spark)
    writer = df.write.option("compression", compression)
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)
    # The schema is given: a table without rows may have no file that tells it.
    return spark.read.schema(df.schema).parquet(path)
