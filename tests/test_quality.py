import pytest

from daybook.operators.quality import (
    BOOKINGS_CHECK,
    CUSTOMERS_CHECK,
    Check,
    CheckLevel,
    QualityError,
    Verification,
    require_passed,
    roll_up,
    verify,
)
from daybook.plans.staging import customers_plan
from tests.helpers import customers, plan, staged_bookings


def status_of(spark_df, check):
    return {r.constraint: r.constraint_status for r in verify(spark_df, check).collect()}


def test_good_bookings_pass_all_twelve(spark):
    rows = verify(staged_bookings(spark, ("B1", "completed", 1.0)), BOOKINGS_CHECK).collect()
    assert len(rows) == 12
    assert {r.constraint_status for r in rows} == {"Success"}
    assert {r.check_status for r in rows} == {"Success"}
    assert {r.constraint_message for r in rows} == {""}
    assert {r.check_level for r in rows} == {"Error"}


def test_good_customers_pass_all_eight(spark):
    rows = verify(customers_plan(customers(spark, {}), "2025-01-01"), CUSTOMERS_CHECK).collect()
    assert [r.constraint_status for r in rows] == ["Success"] * 8


def test_result_columns(spark):
    df = verify(staged_bookings(spark, ("B1", "completed", 1.0)), BOOKINGS_CHECK)
    assert df.columns == [
        "check", "check_level", "check_status",
        "constraint", "constraint_status", "constraint_message",
    ]
    assert {f.dataType.simpleString() for f in df.schema} == {"string"}


def test_one_failure_fails_its_check_only_in_that_row(spark):
    df = staged_bookings(spark, ("B1", "completed", 1.0), ("B2", "completed", -1.0))
    rows = verify(df, BOOKINGS_CHECK).collect()
    failed = [r for r in rows if r.constraint_status == "Failure"]
    assert [r.constraint for r in failed] == ["NonNegative(total_amount)"]
    assert failed[0].constraint_message == "Value: 0.5 does not meet the constraint requirement!"
    assert {r.check_status for r in rows} == {"Error"}


def test_null_is_incomplete_but_non_negative(spark):
    df = staged_bookings(spark, ("B1", None, None))
    statuses = status_of(df, BOOKINGS_CHECK)
    assert statuses["Completeness(status)"] == "Failure"
    assert statuses["NonNegative(total_amount)"] == "Success"


def test_empty_table_fails_everything(spark):
    df = staged_bookings(spark, ("B1", "completed", 1.0)).limit(0)
    assert set(status_of(df, BOOKINGS_CHECK).values()) == {"Failure"}
    message = verify(df, BOOKINGS_CHECK).collect()[1].constraint_message
    assert message == "Value: none does not meet the constraint requirement!"


def test_size_assertion(spark):
    df = staged_bookings(spark, *[(f"B{i}", "completed", 1.0) for i in range(5)])
    between = Check(CheckLevel.ERROR, "size").has_size(lambda n: (n > 3) & (n < 9))
    assert status_of(df, between) == {"Size": "Success"}
    exact = Check(CheckLevel.ERROR, "size").has_size(lambda n: n == 4)
    assert status_of(df, exact) == {"Size": "Failure"}


def test_levels_and_roll_up(spark):
    df = staged_bookings(spark, ("B1", None, -1.0))
    good = Check(CheckLevel.ERROR, "good").is_complete("booking_id")
    warn = Check(CheckLevel.WARNING, "warn").is_complete("status")
    bad = Check(CheckLevel.ERROR, "bad").is_non_negative("total_amount")
    for checks, status in (
        ([good], "Success"), ([good, warn], "Warning"), ([bad, warn, good], "Error"),
    ):
        assert Verification(df, *checks).status == status
        assert [tuple(r) for r in roll_up(verify(df, *checks)).collect()] == [(status,)]


def test_gate(spark):
    good = Verification(staged_bookings(spark, ("B1", "completed", 1.0)), BOOKINGS_CHECK)
    require_passed(good, "bookings")
    bad = Verification(staged_bookings(spark, ("B1", "completed", -1.0)), BOOKINGS_CHECK)
    with pytest.raises(QualityError, match=r"bookings: NonNegative\(total_amount\)"):
        require_passed(bad, "bookings")
    assert issubclass(QualityError, ValueError)


def test_a_warning_also_stops_the_run(spark):
    check = Check(CheckLevel.WARNING, "warn").is_complete("status")
    with pytest.raises(QualityError):
        require_passed(Verification(staged_bookings(spark, ("B1", None, 1.0)), check), "bookings")


def test_all_constraints_share_one_scan(spark, tmp_path):
    path = f"{tmp_path}/staged"
    staged_bookings(spark, ("B1", "completed", 1.0)).write.parquet(path)
    text = plan(verify(spark.read.parquet(path), BOOKINGS_CHECK), "simple")
    assert text.count("FileScan") == 1
    assert text.count("Exchange") == 1


def test_a_check_without_constraints_passes(spark):
    run = Verification(spark.range(3), Check(CheckLevel.ERROR, "empty"))
    assert run.status == "Success" and run.rows == []
    assert roll_up(run.results).first()["status"] == "Success"
