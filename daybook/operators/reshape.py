"""From cleaned rows to staged rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daybook.functions.phone import phone_format
from daybook.functions.times import (
    date_part_of,
    hours_between,
    parse_date,
    tenure_days,
    time_part_of,
)
from daybook.params import DATE_TIME_FORMAT


def reshape_bookings(
    df: DataFrame, fmt: str = DATE_TIME_FORMAT, time_zone: str | None = None
) -> DataFrame:
    """Split the two times into date and time, add the duration in hours."""
    start, end = F.col("start_time"), F.col("end_time")
    return df.withColumns(
        {
            "start_date": date_part_of(start),
            "starting_time": time_part_of(start),
            "end_date": date_part_of(end),
            "ending_time": time_part_of(end),
            "total_duration": hours_between(start, end, fmt, time_zone),
        }
    ).drop("start_time", "end_time")


def reshape_customers(df: DataFrame, as_of_date: str | None = None) -> DataFrame:
    """Normalise the phone number, type the signup date, add the tenure."""
    signup = parse_date(F.col("signup_date"))
    return df.withColumns(
        {
            "phone_number": phone_format(F.col("phone_number")),
            "signup_date": signup,
            "tenure_in_days": tenure_days(signup, as_of_date),
        }
    )
