"""Where registered queries keep the files and tables they write."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession

from daybook.scratch import scratch_dir

__all__ = ["scratch_database", "scratch_dir"]


def scratch_database(spark: SparkSession, folder: str) -> str:
    """A fresh database whose tables live in ``folder``."""
    name = f"daybook_{uuid.uuid4().hex}"
    spark.sql(f"CREATE DATABASE {name} LOCATION '{folder}/db'")
    return name
