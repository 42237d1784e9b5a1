"""Raw feeds made from the test tables, over all their rows.

The tables hold no bookings, e-mails or phone numbers, so each feed derives them
from a row's key, with every defect the cleaning has to catch.

A feed has two days for the merges. Day 1 numbers its records by twice the key
and day 2 by three times the key, so a third of the ids of a day come back in
the other one; day 2 also moves every status on and raises the amounts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed end of the tenure, so that results do not depend on the run day.
AS_OF_DATE = "2025-01-01"

# Factor from table key to record number, by day; None is the plain feed.
ID_FACTOR = {None: 1, 1: 2, 2: 3}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tagged(letter: str, number: Column) -> Column:
    return F.concat(F.lit(letter), number.cast("string"))


def _is(k: Column, divisor: int, rest: int) -> Column:
    return k % divisor == rest


def _iso(ts: Column) -> Column:
    """Timestamp as text, read off without any time zone."""
    text = ts.cast("timestamp_ntz").cast("string")
    return F.concat(F.replace(text, F.lit(" "), F.lit("T")), F.lit("Z"))


def raw_bookings(spark: SparkSession, sf_dir: str, day: int | None = None) -> DataFrame:
    k, ordered = F.col("o_orderkey"), F.col("o_orderdate").cast("timestamp_ntz")
    start = ordered + F.expr("INTERVAL 34 HOURS")
    hours = (k % 17 + 42).cast("int")
    end = ordered + F.make_dt_interval(F.lit(0), hours)
    kinds = ["cancelled", "completed", "pending"] if day == 2 else ["completed", "pending", "cancelled"]
    status = F.when(_is(k, 109, 19), F.lit(None)).when(_is(k, 11, 4), "null").when(_is(k, 13, 6), "canceled")
    for letter, kind in zip("FOP", kinds, strict=True):
        status = status.when(F.col("o_orderstatus") == letter, kind)
    return table(spark, sf_dir, "orders").select(
        F.when(~_is(k, 101, 17), tagged("B", k * ID_FACTOR[day])).alias("booking_id"),
        F.when(~_is(k, 97, 13), tagged("C", F.col("o_custkey"))).alias("customer_id"),
        F.when(~_is(k, 103, 7), tagged("CARS", k % 900 + 100)).alias("car_id"),
        F.when(_is(k, 107, 11), F.lit(None))
        .when(_is(k, 89, 5), "2024-MAY-15")
        .otherwise(F.substring(ordered.cast("string"), 1, 10))
        .alias("booking_date"),
        F.when(_is(k, 83, 3), start.cast("string")).otherwise(_iso(start)).alias("start_time"),
        F.when(~_is(k, 79, 2), _iso(end)).alias("end_time"),
        status.alias("status"),
        (F.col("o_totalprice") + F.lit(1.0 if day == 2 else 0.0)).alias("total_amount"),
    )


def raw_rentals(spark: SparkSession, sf_dir: str, hot: bool = False) -> DataFrame:
    """Bookings from line items: ids repeat, and late ones end before they start.

    With ``hot``, all returned items share one id: about a third of the rows.
    """
    number = F.col("l_orderkey")
    if hot:
        number = F.when(F.col("l_returnflag") == "R", F.lit(0)).otherwise(number)
    return table(spark, sf_dir, "lineitem").select(
        tagged("B", number).alias("booking_id"),
        tagged("C", F.col("l_suppkey")).alias("customer_id"),
        tagged("CARS", F.col("l_partkey") % 900 + 100).alias("car_id"),
        F.substring(F.col("l_shipdate").cast("timestamp_ntz").cast("string"), 1, 10).alias("booking_date"),
        _iso(F.col("l_shipdate")).alias("start_time"),
        F.lit("1999-06-01T00:00:00Z").alias("end_time"),
        F.lit("completed").alias("status"),
        F.col("l_extendedprice").alias("total_amount"),
    )


def raw_customers(spark: SparkSession, sf_dir: str, day: int | None = None) -> DataFrame:
    k = F.col("c_custkey")
    u = F.concat(F.lit("u"), k)
    email = (
        F.when(_is(k, 103, 7), F.lit(None))
        .when(_is(k, 31, 3), F.concat(u, F.lit("@exa-mple.net")))
        .when(_is(k, 37, 5), F.concat(F.lit("u%x"), k, F.lit("@example.net")))
        .when(_is(k, 41, 2), F.concat(u, F.lit("@example.o-1rg")))
        .when(_is(k, 43, 1), F.concat(u, F.lit("@example.com!!")))
        .otherwise(F.concat(F.lit("u."), k, F.lit("@example.org")))
    )
    signup = (
        F.when(_is(k, 107, 11), F.lit(None))
        .when(_is(k, 89, 5), "2024-MAY-15")
        .when(_is(k, 83, 3), "2024-1-5")
        .otherwise(F.date_add(F.lit("2023-01-01").cast("date"), (k % 700).cast("int")).cast("string"))
    )
    home, away = ("inactive", "active") if day != 2 else ("active", "inactive")
    status = (
        F.when(_is(k, 109, 19), F.lit(None))
        .when(_is(k, 5, 4), "null")
        .when(F.col("c_mktsegment").isin("BUILDING", "HOUSEHOLD"), home)
        .otherwise(away)
    )
    return table(spark, sf_dir, "customer").select(
        F.when(~_is(k, 101, 17), tagged("C", k * ID_FACTOR[day])).alias("customer_id"),
        F.when(~_is(k, 97, 13), F.col("c_name")).alias("name"),
        email.alias("email"),
        signup.alias("signup_date"),
        _phone(k).alias("phone_number"),
        status.alias("status"),
    )


def _phone(k: Column) -> Column:
    """Twelve layouts, by key."""
    a = (k % 700 + 200).cast("string")
    b = ((k * 7) % 900 + 100).cast("string")
    c = ((k * 13) % 9000 + 1000).cast("string")
    x = ((k * 3) % 900 + 100).cast("string")
    text = F.lit
    dashes = F.concat_ws("-", a, b, c)
    dots = F.concat_ws(".", a, b, c)
    bracket = F.concat(text("("), a, text(")"), b, text("-"), c)
    us = F.concat(text("+1-"), dashes)
    zeros = F.concat(text("001-"), dashes)
    layouts = [
        dots,
        F.concat(a, b, c),
        dashes,
        bracket,
        us,
        F.concat(us, text("x"), x),
        zeros,
        F.concat(dots, text("x"), x),
        F.concat(bracket, text("x45")),
        F.concat(text("+"), bracket),
        F.concat_ws("-", b, c),
    ]
    chosen = F.when(k % 12 == 11, F.concat(zeros, text("x"), x, text("7")))
    for i, layout in enumerate(layouts):
        chosen = chosen.when(k % 12 == i, layout)
    return chosen
