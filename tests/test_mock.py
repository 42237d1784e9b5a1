from pyspark.sql import functions as F

from daybook.functions.phone import phone_format
from daybook.operators.clean import clean_customers
from daybook.plans.staging import bookings_plan
from daybook.schemas import BOOKINGS_RAW, CUSTOMERS_RAW
from daybook.sources.mock import ids_from, mock_bookings, mock_customers
from tests.helpers import bag


def test_bookings(spark):
    df = mock_bookings(ids_from(spark, 176, 500))
    assert df.schema.simpleString() == BOOKINGS_RAW.simpleString()
    rows = df.collect()
    assert rows[0].booking_id == "B176" and rows[-1].customer_id == "C675"
    assert {r.status for r in rows} == {"completed", "pending", "canceled", "null"}
    assert all(50 <= r.total_amount <= 300 for r in rows)
    assert len({r.car_id for r in rows}) > 100
    assert all(100 <= int(r.car_id.removeprefix("CARS")) <= 999 for r in rows)
    assert {r.total_duration for r in bookings_plan(df).collect()} == {8.0}


def test_ids_are_padded(spark):
    df = mock_bookings(ids_from(spark, 7, 1).union(ids_from(spark, 12345, 1)))
    assert [r.booking_id for r in df.collect()] == ["B007", "B12345"]


def test_customers(spark):
    df = mock_customers(ids_from(spark, 1, 2000))
    assert df.schema.simpleString() == CUSTOMERS_RAW.simpleString()
    assert {r.status for r in df.select("status").distinct().collect()} == {"active", "inactive", "null"}
    assert clean_customers(df).count() == df.filter("status <> 'null'").count()
    shape = F.regexp_replace("phone_number", r"\d", "9")
    assert df.select(shape).distinct().count() == 21
    assert df.filter(phone_format(F.col("phone_number")) == F.col("phone_number")).count() == 0


def test_rows_do_not_depend_on_partitioning(spark):
    once = mock_customers(ids_from(spark, 1, 300))
    again = mock_customers(ids_from(spark, 1, 300).repartition(7))
    assert bag(once) == bag(again)


def test_seed_and_status_values(spark):
    base, other = mock_bookings(ids_from(spark, 1, 50)), mock_bookings(ids_from(spark, 1, 50), seed=9)
    assert bag(base) != bag(other)
    only = mock_bookings(ids_from(spark, 1, 50), status_values=["cancelled"])
    assert {r.status for r in only.collect()} == {"cancelled"}


def test_huge_ids_do_not_overflow(spark):
    assert mock_bookings(ids_from(spark, 9_000_000_000_000_000_000, 3)).count() == 3
    assert len(mock_customers(ids_from(spark, 9_000_000_000_000_000_000, 3)).collect()) == 3


def test_the_mock_job_writes_a_day_the_other_jobs_read(spark, database, tmp_path):
    from daybook.__main__ import JOBS, parse

    job, params, preview = parse(
        ["mock", "--date", "20241016", "--path", str(tmp_path), "--staging_bookings_delta", f"{database}.b",
         "--staging_customers_delta", f"{database}.c"]
    )
    assert (job, preview) == ("mock", False)
    assert JOBS[job](spark, params) == str(tmp_path)
    assert JOBS["bookings"](spark, params).rows_read == 175
    assert JOBS["customers"](spark, params).rows_read == 150
