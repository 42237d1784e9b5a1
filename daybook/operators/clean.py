"""Cleaning filters (F1-F9) and the row funnel over them (A1).

A stage is a name and a predicate. The same list drives the filters and the
funnel, so the two cannot drift apart.
"""

from __future__ import annotations

from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daybook.functions.times import parse_date, parse_time
from daybook.params import DATE_TIME_FORMAT

# Required columns, accepted statuses, accepted e-mail shape.
BOOKING_KEYS = ("booking_id", "customer_id", "car_id", "booking_date")
CUSTOMER_KEYS = ("customer_id", "name", "email")
BOOKING_STATUSES = ("completed", "cancelled", "pending")
CUSTOMER_STATUSES = ("active", "inactive")
EMAIL_PATTERN = r"^[a-zA-Z0-9._]+@[a-z0-9._]+\.[a-z]{2,}"


class Stage(NamedTuple):
    name: str
    keep: Column
    costly: bool = False


def all_present(columns) -> Column:
    return reduce(Column.__and__, [F.col(c).isNotNull() for c in columns])


def booking_stages(
    fmt: str = DATE_TIME_FORMAT, time_zone: str | None = None
) -> list[Stage]:
    dates = (
        parse_time(F.col("start_time"), fmt, time_zone).isNotNull()
        & parse_date(F.col("booking_date")).isNotNull()
        & parse_time(F.col("end_time"), fmt, time_zone).isNotNull()
    )
    return [
        Stage("null_keys", all_present(BOOKING_KEYS)),
        Stage("dates", dates, costly=True),
        Stage("status", F.col("status").isin(*BOOKING_STATUSES)),
    ]


def customer_stages(email_pattern: str = EMAIL_PATTERN) -> list[Stage]:
    return [
        Stage("null_keys", all_present(CUSTOMER_KEYS)),
        Stage("status", F.col("status").isin(*CUSTOMER_STATUSES)),
        Stage("email", F.col("email").rlike(email_pattern), costly=True),
        Stage("signup_date", parse_date(F.col("signup_date")).isNotNull(), costly=True),
    ]


def keep_valid(df: DataFrame, stages: list[Stage]) -> DataFrame:
    """Rows that pass every stage; unknown counts as failed.

    The order does not matter to the result, so rows the cheap tests reject are
    gone before anything is parsed.
    """
    ordered = sorted(stages, key=lambda stage: stage.costly)
    return reduce(lambda rest, stage: rest.filter(stage.keep), ordered, df)


def clean_bookings(
    df: DataFrame, fmt: str = DATE_TIME_FORMAT, time_zone: str | None = None
) -> DataFrame:
    return keep_valid(df, booking_stages(fmt, time_zone))


def clean_customers(df: DataFrame, email_pattern: str = EMAIL_PATTERN) -> DataFrame:
    return keep_valid(df, customer_stages(email_pattern))


def funnel(df: DataFrame, stages: list[Stage]) -> DataFrame:
    """Rows left after each stage, in one pass: columns step, stage, rows."""
    passed = F.lit(True)
    counts = [F.count(F.lit(1))]
    for stage in stages:
        passed = passed & stage.keep
        counts.append(F.count_if(passed))
    names = ["raw", *(stage.name for stage in stages)]
    totals = df.agg(*[c.alias(f"n{i}") for i, c in enumerate(counts)])
    steps = [
        F.struct(
            F.lit(i).alias("step"), F.lit(name).alias("stage"), F.col(f"n{i}").alias("rows")
        )
        for i, name in enumerate(names)
    ]
    return totals.select(F.inline(F.array(*steps)))
