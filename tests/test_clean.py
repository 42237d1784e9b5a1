import pytest

from daybook.operators.clean import (
    booking_stages,
    clean_bookings,
    clean_customers,
    customer_stages,
    funnel,
)
from tests.helpers import bookings, customers, ids


@pytest.mark.parametrize("column", ["booking_id", "customer_id", "car_id", "booking_date"])
def test_a_booking_needs_its_keys(spark, column):
    df = bookings(spark, {"car_id": "kept"}, {column: None})
    assert ids(clean_bookings(df), "car_id") == ["kept"]


@pytest.mark.parametrize("column", ["customer_id", "name", "email"])
def test_a_customer_needs_its_keys(spark, column):
    df = customers(spark, {"phone_number": "kept"}, {column: None})
    assert ids(clean_customers(df), "phone_number") == ["kept"]


BAD_TIMES = [
    None,
    "",
    "2024-07-21 10:00:00",
    "2024-7-21T10:00:00Z",
    "2024-02-30T10:00:00Z",
    "2024-07-21T24:00:00Z",
    "2024-07-21T10:00:00.5Z",
    "2024-07-21T10:00:00+00:00",
    "2024-07-21T10:00:00Zx",
]


@pytest.mark.parametrize("column", ["start_time", "end_time"])
def test_times_must_follow_the_format(spark, column):
    changes = [{"booking_id": f"bad{i}", column: t} for i, t in enumerate(BAD_TIMES)]
    df = bookings(spark, {"booking_id": "good"}, *changes)
    assert ids(clean_bookings(df), "booking_id") == ["good"]


def test_letters_of_a_time_match_in_either_case(spark):
    df = bookings(spark, {"start_time": "2024-07-21t10:00:00z"})
    assert clean_bookings(df).count() == 1


def test_another_time_format(spark):
    df = bookings(
        spark, {"start_time": "21/07/2024 10:00", "end_time": "21/07/2024 11:00"}, {}
    )
    assert clean_bookings(df, "dd/MM/yyyy HH:mm").count() == 1


BAD_DATES = ["", "2024-7-2", "2024-02-30", "20240720", "2024-07-20x", "2024-MAY-15"]


def test_booking_date_must_be_a_date(spark):
    changes = [{"booking_id": d, "booking_date": d} for d in BAD_DATES]
    df = bookings(spark, {"booking_id": "good"}, *changes)
    assert ids(clean_bookings(df), "booking_id") == ["good"]


def test_signup_date_must_be_a_date(spark):
    changes = [{"customer_id": f"bad {d}", "signup_date": d} for d in [*BAD_DATES, None]]
    df = customers(spark, {"customer_id": "good"}, *changes)
    assert ids(clean_customers(df), "customer_id") == ["good"]


def test_booking_status_whitelist(spark):
    statuses = ["completed", "cancelled", "pending", "canceled", "Completed", "null", None, ""]
    df = bookings(spark, *[{"status": s} for s in statuses])
    assert ids(clean_bookings(df), "status") == ["cancelled", "completed", "pending"]


def test_customer_status_whitelist(spark):
    df = customers(spark, *[{"status": s} for s in ["active", "inactive", "null", "ACTIVE", None]])
    assert ids(clean_customers(df), "status") == ["active", "inactive"]


def test_email_pattern(spark):
    good = ["a@b.co", "a@b.co!!junk", "a@b..co", "A.b_9@x.y.org", "a@b.c.dd"]
    bad = ["a+b@c.com", "a-b@c.com", "a@my-host.com", "a@B.com", "a@b.c", "@b.co", " a@b.co", "a%b@c.com"]
    df = customers(spark, *[{"email": e} for e in good + bad])
    assert ids(clean_customers(df), "email") == sorted(good)


def test_columns_are_unchanged(spark):
    df = bookings(spark, {})
    assert clean_bookings(df).schema == df.schema


def test_bad_text_does_not_abort_under_ansi(spark):
    assert spark.conf.get("spark.sql.ansi.enabled") == "true"
    assert clean_bookings(bookings(spark, {"start_time": "x", "booking_date": "y"})).count() == 0


def test_bookings_funnel(spark):
    df = bookings(
        spark,
        {},
        {"booking_id": None},
        {"start_time": "x"},
        {"status": "null"},
        {"status": None},
        {"booking_id": None, "status": "null"},
    )
    rows = [tuple(r) for r in funnel(df, booking_stages()).collect()]
    assert rows == [(0, "raw", 6), (1, "null_keys", 4), (2, "dates", 3), (3, "status", 1)]


def test_customers_funnel(spark):
    df = customers(
        spark, {}, {"email": None}, {"status": "null"}, {"email": "a+b@c.com"}, {"signup_date": None}
    )
    rows = [tuple(r)[1:] for r in funnel(df, customer_stages()).collect()]
    assert rows == [
        ("raw", 5), ("null_keys", 4), ("status", 3), ("email", 2), ("signup_date", 1),
    ]


def test_funnel_of_nothing(spark):
    rows = funnel(bookings(spark, {}).limit(0), booking_stages()).collect()
    assert [r["rows"] for r in rows] == [0, 0, 0, 0]
