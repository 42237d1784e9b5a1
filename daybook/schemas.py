"""Fixed input schemas and the columns each stage produces."""

from pyspark.sql.types import (
    DateType,
    DoubleType,
    IntegerType,
    StringType,
    StructField,
    StructType,
)


def _struct(*fields):
    return StructType([StructField(name, dtype, True) for name, dtype in fields])


BOOKINGS_RAW = _struct(
    ("booking_id", StringType()),
    ("customer_id", StringType()),
    ("car_id", StringType()),
    ("booking_date", StringType()),
    ("start_time", StringType()),
    ("end_time", StringType()),
    ("status", StringType()),
    ("total_amount", DoubleType()),
)

BOOKINGS_STAGED = _struct(
    ("booking_id", StringType()),
    ("customer_id", StringType()),
    ("car_id", StringType()),
    ("booking_date", StringType()),
    ("status", StringType()),
    ("total_amount", DoubleType()),
    ("start_date", StringType()),
    ("starting_time", StringType()),
    ("end_date", StringType()),
    ("ending_time", StringType()),
    ("total_duration", DoubleType()),
)

CUSTOMERS_RAW = _struct(
    ("customer_id", StringType()),
    ("name", StringType()),
    ("email", StringType()),
    ("signup_date", StringType()),
    ("phone_number", StringType()),
    ("status", StringType()),
)

CUSTOMERS_STAGED = _struct(
    ("customer_id", StringType()),
    ("name", StringType()),
    ("email", StringType()),
    ("signup_date", DateType()),
    ("phone_number", StringType()),
    ("status", StringType()),
    ("tenure_in_days", IntegerType()),
)
