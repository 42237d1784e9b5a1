"""The two staging jobs."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from daybook.operators.clean import clean_bookings, clean_customers
from daybook.operators.merge import BOOKINGS_RULE, CUSTOMERS_RULE
from daybook.operators.quality import BOOKINGS_CHECK, CUSTOMERS_CHECK, metrics
from daybook.operators.reshape import reshape_bookings, reshape_customers
from daybook.params import DATE_TIME_FORMAT, PipelineParams
from daybook.sources.json_files import read_bookings, read_customers
from daybook.sources.tables import adopt, overwrite_table, publish, write_snapshot

# Called with a label and a frame. Looking at the frame costs a job of its own,
# so the plans take a hook only on request.
Preview = Callable[[str, DataFrame], None]


@dataclass(frozen=True)
class Staged:
    """A written staging table and the row counts around the cleaning (A1)."""

    table: str
    rows_read: int
    rows_kept: int


def bookings_plan(
    raw: DataFrame, fmt: str = DATE_TIME_FORMAT, time_zone: str | None = None
) -> DataFrame:
    """Raw bookings to staged bookings; no shuffle, no Python worker."""
    return reshape_bookings(clean_bookings(raw, fmt, time_zone), fmt, time_zone)


def customers_plan(raw: DataFrame, as_of_date: str | None = None) -> DataFrame:
    """Raw customers to staged customers; no shuffle, no Python worker."""
    return reshape_customers(clean_customers(raw), as_of_date)


def stage_bookings(
    spark: SparkSession, params: PipelineParams, preview: Preview | None = None
) -> Staged:
    raw = read_bookings(spark, params.input_path("bookings"), params.multi_line, params.split_arrays)
    return _stage(
        raw,
        lambda df: bookings_plan(df, params.date_time_format, params.time_zone),
        params.staging_bookings_delta,
        BOOKINGS_RULE.key,
        BOOKINGS_CHECK,
        params,
        preview,
    )


def stage_customers(
    spark: SparkSession, params: PipelineParams, preview: Preview | None = None
) -> Staged:
    raw = read_customers(spark, params.input_path("customers"), params.multi_line, params.split_arrays)
    return _stage(
        raw,
        lambda df: customers_plan(df, params.as_of_date),
        params.staging_customers_delta,
        CUSTOMERS_RULE.key,
        CUSTOMERS_CHECK,
        params,
        preview,
    )


def first_rows(df: DataFrame, rows: int = 5) -> DataFrame:
    """What a preview shows (L1); which rows these are is left open."""
    return df.limit(rows)


def show_preview(rows: int = 5, truncate: bool = False) -> Preview:
    """A hook that prints the schema and the first rows (L1, L2)."""

    def look(label: str, df: DataFrame) -> None:
        print(label)
        df.printSchema()
        first_rows(df, rows).show(rows, truncate=truncate)

    return look


def _stage(raw, plan, table, key, check, params, preview) -> Staged:
    if preview:
        preview(f"{table}: input", raw)
        preview(f"{table}: staged", plan(raw))
    # All counts ride on the write, those of the checks too, so the input is read once
    # and what is staged need not be read to be checked.
    spark, read, kept = raw.sparkSession, Observation(), Observation()
    rows = F.count(F.lit(1)).alias("rows")
    counts = [count.alias(label) for label, count in metrics(check).items()]
    staged = plan(raw.observe(read, rows)).observe(kept, *counts)
    if params.target_mode == "row_level":  # the format commits by itself
        overwrite_table(staged, table, params.table_format)
        return Staged(table, read.get["rows"], kept.get["rows"])
    # Readers see the day before until all of this one is there. In the targets' buckets,
    # staged rows are dealt once, here, and a merge deals neither side.
    adopt(spark, table)
    snapshot = write_snapshot(spark, staged, table, params.table_format, params.buckets, key)
    if kept.get["rows"] == snapshot.rows:  # a task that ran twice may have counted twice
        snapshot = replace(snapshot, metrics=dict(kept.get))
    publish(spark, snapshot)
    return Staged(table, read.get["rows"], snapshot.rows)
