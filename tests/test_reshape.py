import datetime

import pytest

from daybook.operators.reshape import reshape_bookings, reshape_customers
from daybook.schemas import BOOKINGS_STAGED, CUSTOMERS_STAGED
from tests.helpers import bookings, customers


def test_staged_schemas(spark):
    assert reshape_bookings(bookings(spark, {})).schema.simpleString() == BOOKINGS_STAGED.simpleString()
    assert reshape_customers(customers(spark, {})).schema.simpleString() == CUSTOMERS_STAGED.simpleString()


def test_times_are_split_and_measured(spark):
    row = reshape_bookings(bookings(spark, {})).first()
    assert (row.start_date, row.starting_time) == ("2024-07-21", "10:00:00")
    assert (row.end_date, row.ending_time) == ("2024-07-21", "18:00:00")
    assert row.total_duration == 8.0
    assert row.booking_date == "2024-07-20"


@pytest.mark.parametrize(
    "end, hours",
    [
        ("2024-07-21T09:30:00Z", -0.5),
        ("2024-07-21T10:00:00Z", 0.0),
        ("2024-07-21T10:00:01Z", 1 / 3600),
        ("2024-07-23T10:00:00Z", 48.0),
    ],
)
def test_durations(spark, end, hours):
    assert reshape_bookings(bookings(spark, {"end_time": end})).first().total_duration == hours


def test_text_without_marks_does_not_abort(spark):
    row = reshape_bookings(bookings(spark, {"start_time": "2024-07-21", "end_time": None})).first()
    assert (row.start_date, row.starting_time) == ("2024-07-21", None)
    assert (row.end_date, row.ending_time, row.total_duration) == (None, None, None)


def test_duration_follows_the_session_zone_unless_told(spark, settings):
    df = bookings(spark, {"start_time": "2024-03-09T12:00:00Z", "end_time": "2024-03-10T12:00:00Z"})
    assert reshape_bookings(df).first().total_duration == 24.0
    settings(spark__sql__session__timeZone="America/New_York")
    assert reshape_bookings(df).first().total_duration == 23.0
    assert reshape_bookings(df, time_zone="UTC").first().total_duration == 24.0


def test_customer_columns(spark):
    row = reshape_customers(customers(spark, {}), "2025-01-01").first()
    assert row.signup_date == datetime.date(2024, 1, 15)
    assert row.phone_number == "(202) 555-0143"
    assert row.tenure_in_days == 352


def test_tenure_can_be_negative_and_defaults_to_today(spark):
    df = customers(spark, {"signup_date": "2025-01-02"})
    assert reshape_customers(df, "2025-01-01").first().tenure_in_days == -1
    today = datetime.datetime.now(datetime.timezone.utc).date()
    tenure = reshape_customers(df).first().tenure_in_days
    assert tenure in {(today - datetime.date(2025, 1, 2)).days + d for d in (0, 1)}


def test_bad_signup_gives_nulls(spark):
    row = reshape_customers(customers(spark, {"signup_date": "2024-MAY-15", "phone_number": None})).first()
    assert (row.signup_date, row.tenure_in_days, row.phone_number) == (None, None, None)
