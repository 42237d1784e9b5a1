"""Dated JSON input and output."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from daybook.schemas import BOOKINGS_RAW, CUSTOMERS_RAW


def read_json(
    spark: SparkSession, path: str, schema: StructType, multi_line: bool = False
) -> DataFrame:
    """Read one day's records with a declared schema; nothing is inferred.

    ``path`` may be a file or a folder of part files. Both layouts work without
    ``multi_line``: one record per line, which Spark splits over tasks, and one
    array per line, where each line is read by a single task. ``read_flat_json``
    splits long arrays too.
    """
    return spark.read.schema(schema).option("multiLine", multi_line).json(path)


#: A text up to a closing brace that holds one flat record, from its opening brace on, or its end.
_STRING = r'"(?:[^"\\]++|\\.)*+"'
_VALUE = rf"(?:{_STRING}|-?[0-9][0-9.eE+-]*+|true|false|null)"
_FIELD = rf"{_STRING}\s*+:\s*+{_VALUE}\s*+"
_RECORD = rf"(?s)\A\s*+(?:(?:\]\s*+)?\[|,)?\s*+\{{\s*+(?:{_FIELD}(?:,\s*+{_FIELD})*+)?\Z"
_NO_RECORD = r"\A\s*+\]?(?:\s*+\[\s*+\])*+\s*+\z"


def read_flat_json(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """The records of ``read_json``, read by many tasks even if all are one array on one line.

    The text is cut after every closing brace, which Spark's text source does in parallel,
    and each piece is parsed on its own. That is right if records are flat and no value
    holds a brace. A first pass, as parallel, looks for pieces that are not one flat record;
    if there is one, for those reasons or because a record is malformed, or if an array is
    not closed, the file is read line by line as in ``read_json``. (Of one record per line,
    a last record that lacks nothing but its brace is taken as whole.) Arrays, one record per line, and records
    spread over lines all work; compressed files are not split.
    """
    pieces = spark.read.option("lineSep", "}").text(path)
    record, nothing = F.col("value").rlike(_RECORD), F.col("value").rlike(_NO_RECORD)
    before = F.substring_index("value", "{", 1)
    seen = pieces.agg(
        F.count_if(~record & ~nothing).alias("odd"),
        F.sum(F.length(before) - F.length(F.replace(before, F.lit("[")))).alias("opened"),
        F.sum(F.length(before) - F.length(F.replace(before, F.lit("]")))).alias("closed"),
    ).first()
    if seen["odd"] or seen["opened"] != seen["closed"]:
        return read_json(spark, path, schema)
    text = F.concat(F.expr("substring(value, instr(value, '{'))"), F.lit("}"))
    # No piece is odd, so the records are those with an opening brace. A record is inlined, so that it is
    # parsed once: filters that follow would otherwise move below, each with a parser of its own.
    records = pieces.filter(F.instr("value", "{") > 0)
    return records.select(F.inline(F.array(F.from_json(text, schema))))


def _read(spark: SparkSession, path: str, schema: StructType, multi_line: bool, split_arrays: bool) -> DataFrame:
    if split_arrays:
        return read_flat_json(spark, path, schema)
    return read_json(spark, path, schema, multi_line)


def read_bookings(
    spark: SparkSession, path: str, multi_line: bool = False, split_arrays: bool = False
) -> DataFrame:
    return _read(spark, path, BOOKINGS_RAW, multi_line, split_arrays)


def read_customers(
    spark: SparkSession, path: str, multi_line: bool = False, split_arrays: bool = False
) -> DataFrame:
    return _read(spark, path, CUSTOMERS_RAW, multi_line, split_arrays)


def write_json(df: DataFrame, path: str) -> None:
    """Write a day's records, one per line, every key present."""
    df.write.mode("overwrite").option("ignoreNullFields", False).json(path)
