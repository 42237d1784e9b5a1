"""Mock feeds at any size.

Each record is a pure function of its id and the seed, so a lost task is redone
with the same result and the rows do not depend on the partitioning.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# What the mock feeds contain.
BOOKING_STATUSES = ["completed", "pending", "canceled", "null"]
CUSTOMER_STATUSES = ["active", "inactive", "null"]
BOOKING_DATE = "2024-07-20"
BOOKING_START = "2024-07-21T10:00:00Z"
BOOKING_END = "2024-07-21T18:00:00Z"
SIGNUP_DATE = "2024-01-15"

FIRST_NAMES = ["Ada", "Ben", "Chloe", "Dev", "Elena", "Farid", "Grace", "Hugo"]
LAST_NAMES = ["Abbott", "Brown", "Chen", "Diaz", "Evans", "Fischer", "Gupta"]
EMAIL_DOMAINS = ["example.com", "example.net", "example.org"]

# Multiplier, second multiplier and modulus of a Lehmer generator. The products
# stay far below the range of a bigint, and any SQL engine gives the same draws.
_LEHMER = (48271, 16807, 2147483647)


def draw(ids: Column, seed: int, choices: int) -> Column:
    """A number in ``[0, choices)``, fixed by id and seed."""
    first, second, modulus = _LEHMER
    state = (F.pmod(ids, F.lit(modulus)) * first + F.lit(seed * 69621)) % modulus
    return (state * second % modulus) % choices


def pick(ids: Column, seed: int, values: list[str]) -> Column:
    return F.get(
        F.array(*[F.lit(v) for v in values]),
        draw(ids, seed, len(values)).cast("int"),
    )


def numbered(ids: Column, letter: str) -> Column:
    """``letter`` and the id, padded to three digits."""
    return F.format_string(f"{letter}%03d", ids)


def ids_from(spark: SparkSession, start: int, count: int) -> DataFrame:
    """``count`` sequential ids in one bigint column ``id``."""
    return spark.range(start, start + count)


def mock_bookings(
    ids: DataFrame, seed: int = 0, status_values: list[str] | None = None
) -> DataFrame:
    """One raw booking per row of ``ids`` (a bigint column ``id``)."""
    n = F.col("id")
    return ids.select(
        numbered(n, "B").alias("booking_id"),
        numbered(n, "C").alias("customer_id"),
        F.concat(F.lit("CARS"), draw(n, seed + 1, 900) + 100).alias("car_id"),
        F.lit(BOOKING_DATE).alias("booking_date"),
        F.lit(BOOKING_START).alias("start_time"),
        F.lit(BOOKING_END).alias("end_time"),
        pick(n, seed + 2, status_values or BOOKING_STATUSES).alias("status"),
        ((draw(n, seed + 3, 25001) + 5000) / F.lit(100.0)).alias("total_amount"),
    )


def mock_customers(
    ids: DataFrame, seed: int = 0, status_values: list[str] | None = None
) -> DataFrame:
    """One raw customer per row of ``ids`` (a bigint column ``id``)."""
    n = F.col("id")
    first = pick(n, seed + 1, FIRST_NAMES)
    last = pick(n, seed + 2, LAST_NAMES)
    return ids.select(
        numbered(n, "C").alias("customer_id"),
        F.concat_ws(" ", first, last).alias("name"),
        F.concat(
            F.lower(first), F.lit("."), n, F.lit("@"), pick(n, seed + 3, EMAIL_DOMAINS)
        ).alias("email"),
        F.lit(SIGNUP_DATE).alias("signup_date"),
        _mock_phone(n, seed).alias("phone_number"),
        pick(n, seed + 4, status_values or CUSTOMER_STATUSES).alias("status"),
    )


def _mock_phone(n: Column, seed: int) -> Column:
    """21 shapes: five layouts with an extension of 0, 3, 4 or 5 digits, or plain."""
    a = draw(n, seed + 5, 700) + 200
    b = draw(n, seed + 6, 900) + 100
    c = draw(n, seed + 7, 9000) + 1000
    shape = draw(n, seed + 8, 21)
    dashed = F.concat_ws("-", a, b, c)
    base = (
        F.when(shape >= 20, F.concat(a, b, c))
        .when(shape % 5 == 0, F.concat(F.lit("("), a, F.lit(")"), b, F.lit("-"), c))
        .when(shape % 5 == 1, dashed)
        .when(shape % 5 == 2, F.concat_ws(".", a, b, c))
        .when(shape % 5 == 3, F.concat(F.lit("+1-"), dashed))
        .otherwise(F.concat(F.lit("001-"), dashed))
    )
    digits = F.format_string("%05d", draw(n, seed + 9, 100000))
    extension = (
        F.when((shape < 5) | (shape >= 20), F.lit(""))
        .when(shape < 10, F.concat(F.lit("x"), F.substring(digits, 1, 3)))
        .when(shape < 15, F.concat(F.lit("x"), F.substring(digits, 1, 4)))
        .otherwise(F.concat(F.lit("x"), digits))
    )
    return F.concat(base, extension)
