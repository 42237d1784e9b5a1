"""Small frames and plan texts."""

from collections import Counter

from pyspark.sql import DataFrame

from daybook.schemas import BOOKINGS_RAW, BOOKINGS_STAGED, CUSTOMERS_RAW

GOOD_BOOKING = {
    "booking_id": "B1",
    "customer_id": "C1",
    "car_id": "CARS100",
    "booking_date": "2024-07-20",
    "start_time": "2024-07-21T10:00:00Z",
    "end_time": "2024-07-21T18:00:00Z",
    "status": "completed",
    "total_amount": 99.5,
}
GOOD_CUSTOMER = {
    "customer_id": "C1",
    "name": "Ada Chen",
    "email": "ada@example.com",
    "signup_date": "2024-01-15",
    "phone_number": "2025550143",
    "status": "active",
}


def _frame(spark, schema, good, changes):
    rows = [{**good, **change} for change in changes]
    return spark.createDataFrame([tuple(r[f.name] for f in schema) for r in rows], schema)


def bookings(spark, *changes) -> DataFrame:
    return _frame(spark, BOOKINGS_RAW, GOOD_BOOKING, changes)


def customers(spark, *changes) -> DataFrame:
    return _frame(spark, CUSTOMERS_RAW, GOOD_CUSTOMER, changes)


def staged_bookings(spark, *rows) -> DataFrame:
    """Staged bookings from (id, status, amount)."""
    full = [
        (i, "C1", "CARS100", "2024-07-20", status, amount)
        + ("2024-07-21", "10:00:00", "2024-07-21", "18:00:00", 8.0)
        for i, status, amount in rows
    ]
    return spark.createDataFrame(full, BOOKINGS_STAGED)


def ids(df: DataFrame, column: str) -> list:
    return sorted(r[column] for r in df.select(column).collect())


def bag(df: DataFrame) -> Counter:
    return Counter(tuple(r) for r in df.collect())


def plan(df: DataFrame, mode: str = "formatted") -> str:
    """The physical plan before execution."""
    jvm = df.sparkSession._jvm
    query = df._jdf.queryExecution()
    return query.explainString(
        jvm.org.apache.spark.sql.execution.ExplainMode.fromString(mode)
    )
