import pytest

from daybook.__main__ import main, parse
from daybook.operators.quality import BOOKINGS_CHECK, QualityError, Verification, metrics
from daybook.params import PipelineParams
from daybook.plans.daily import Merged, check_and_merge, run_day
from daybook.plans.staging import Staged, show_preview, stage_bookings, stage_customers
from daybook.schemas import BOOKINGS_STAGED, CUSTOMERS_STAGED
from daybook.sources.json_files import write_json
from daybook.sources.tables import current_slot, overwrite_table, table_exists, written_metrics
from tests.helpers import bookings, customers, ids, staged_bookings


@pytest.fixture
def params(database, tmp_path):
    def of(date="20241017", **changes):
        return PipelineParams(
            date=date,
            path=f"{tmp_path}/in",
            staging_bookings_delta=f"{database}.staging_bookings",
            staging_customers_delta=f"{database}.staging_customers",
            bookings_delta_table=f"{database}.bookings",
            customers_delta_table=f"{database}.customers",
            as_of_date="2025-01-01",
            **changes,
        )

    return of


def feed(spark, params, booking_changes, customer_changes=({},)):
    write_json(bookings(spark, *booking_changes), params.input_path("bookings"))
    write_json(customers(spark, *customer_changes), params.input_path("customers"))


def test_staging_counts_and_tables(spark, params):
    feed(spark, params(), [{}, {"status": "null"}], [{}, {"email": None}, {"status": "x"}])
    assert stage_bookings(spark, params()) == Staged(params().staging_bookings_delta, 2, 1)
    assert stage_customers(spark, params()) == Staged(params().staging_customers_delta, 3, 1)
    for table, schema in (
        (params().staging_bookings_delta, BOOKINGS_STAGED),
        (params().staging_customers_delta, CUSTOMERS_STAGED),
    ):
        assert spark.table(table).schema.simpleString() == schema.simpleString()


def test_staging_a_day_without_valid_rows(spark, params):
    feed(spark, params(), [{"status": "null"}])
    staged = stage_bookings(spark, params())
    assert (staged.rows_read, staged.rows_kept) == (1, 0)
    stage_customers(spark, params())
    with pytest.raises(QualityError, match="bookings: Size"):
        check_and_merge(spark, params())


def test_two_days(spark, params):
    first, second = params("20241016"), params("20241017")
    feed(
        spark, first,
        [{"booking_id": "keep"}, {"booking_id": "drop", "status": "cancelled"}, {"booking_id": "turn"}],
        [{"customer_id": "keep"}, {"customer_id": "drop", "status": "inactive"}],
    )
    feed(
        spark, second,
        [{"booking_id": "drop"}, {"booking_id": "turn", "status": "cancelled"}, {"booking_id": "new"}],
        [{"customer_id": "drop"}, {"customer_id": "keep", "name": "Changed"}],
    )
    assert run_day(spark, first).merged == Merged(bookings=3, customers=2)
    assert run_day(spark, second).merged == Merged(bookings=3, customers=1)
    assert ids(spark.table(second.bookings_delta_table), "booking_id") == ["keep", "new", "turn"]
    assert ids(spark.table(second.customers_delta_table), "name") == ["Changed"]
    # Again: what the day cancelled is deleted, what it deleted is inserted.
    assert run_day(spark, second).merged == Merged(bookings=3, customers=2)
    assert ids(spark.table(second.bookings_delta_table), "booking_id") == ["drop", "keep", "new"]


def test_a_failed_check_on_either_side_merges_nothing(spark, params):
    negative = {"end_time": "2024-07-21T09:00:00Z"}
    feed(spark, params(), [{}, negative])
    with pytest.raises(QualityError, match="total_duration"):
        run_day(spark, params())
    feed(spark, params(), [{}], [{"phone_number": None}])
    with pytest.raises(QualityError, match=r"customers: Completeness\(phone_number\)"):
        run_day(spark, params())
    assert not table_exists(spark, params().bookings_delta_table)
    assert not table_exists(spark, params().customers_delta_table)


def test_an_ambiguous_day_changes_neither_target(spark, params):
    feed(spark, params(), [{"booking_id": "a"}], [{"customer_id": "a"}])
    run_day(spark, params())
    feed(spark, params(), [{"booking_id": "b"}], [{"customer_id": "a"}, {"customer_id": "a"}])
    with pytest.raises(ValueError, match="customer_id such as: a"):
        run_day(spark, params())
    assert ids(spark.table(params().bookings_delta_table), "booking_id") == ["a"]
    assert ids(spark.table(params().customers_delta_table), "customer_id") == ["a"]


def test_an_existing_plain_target_is_merged_into(spark, params):
    feed(spark, params(), [{"booking_id": "a"}], [{"customer_id": "a"}])
    stage_bookings(spark, params())
    overwrite_table(spark.table(params().staging_bookings_delta), params().bookings_delta_table)
    feed(spark, params(), [{"booking_id": "b"}], [{"customer_id": "a"}])
    assert run_day(spark, params()).merged == Merged(2, 1)
    assert current_slot(spark, params().bookings_delta_table).endswith("__a")


def test_large_days_take_the_shuffle_path(spark, params):
    tiny = params(broadcast_limit_bytes=1)
    feed(spark, tiny, [{"booking_id": "a"}], [{"customer_id": "a"}])
    run_day(spark, tiny)
    feed(spark, tiny, [{"booking_id": "b"}], [{"customer_id": "b"}])
    assert run_day(spark, tiny).merged == Merged(2, 2)


def test_row_level_first_load(spark, params):
    """Without a target both modes just create it."""
    level = params(target_mode="row_level")
    feed(spark, level, [{}])
    assert run_day(spark, level).merged == Merged(1, 1)
    assert spark.catalog.getTable(level.bookings_delta_table).tableType == "MANAGED"


def test_previews_only_on_request(spark, params, capsys):
    feed(spark, params(), [{}])
    run_day(spark, params())
    assert capsys.readouterr().out == ""
    run_day(spark, params(), show_preview())
    out = capsys.readouterr().out
    assert "root" in out and "Quality check on customers" in out


def test_another_time_format_and_prefix(spark, params):
    other = params(file_prefix="cars_", date_time_format="yyyy-MM-dd HH:mm'Z'")
    feed(spark, other, [{"start_time": "2024-07-21 10:00Z", "end_time": "2024-07-21 11:30Z"}])
    stage_bookings(spark, other)
    row = spark.table(other.staging_bookings_delta).first()
    assert (row.total_duration, row.starting_time) == (1.5, None)


def test_command_line(spark, params, capsys):
    p = params()
    feed(spark, p, [{}])
    argv = [
        "--date", p.date, "--path", p.path, "--as_of_date", p.as_of_date,
        "--staging_bookings_delta", p.staging_bookings_delta,
        "--staging_customers_delta", p.staging_customers_delta,
        "--bookings_delta_table", p.bookings_delta_table,
        "--customers_delta_table", p.customers_delta_table,
    ]
    assert parse(["day", *argv]) == ("day", p, False)
    for job, printed in (
        ("bookings", "'rows_kept': 1"), ("customers", "'rows_read': 1"),
        ("merge", "{'bookings': 1, 'customers': 1}"), ("day", "'merged'"),
    ):
        main([job, *argv])
        assert printed in capsys.readouterr().out


def test_command_line_needs_date_and_path():
    with pytest.raises(SystemExit):
        parse(["day", "--date", "20241017"])


# --- staging: swapped in whole, checked while it is written ---


def test_a_killed_staging_job_leaves_the_staged_day(spark, params, monkeypatch):
    feed(spark, params(), [{"booking_id": "a"}])
    stage_bookings(spark, params())
    before = spark.table(params().staging_bookings_delta).collect()
    feed(spark, params(), [{"booking_id": "b"}, {"booking_id": "c"}])

    def killed(*_, **__):
        raise KeyboardInterrupt

    with monkeypatch.context() as patch:
        patch.setattr("daybook.plans.staging.publish", killed)
        with pytest.raises(KeyboardInterrupt):
            stage_bookings(spark, params())
    assert spark.table(params().staging_bookings_delta).collect() == before
    assert stage_bookings(spark, params()).rows_kept == 2
    assert ids(spark.table(params().staging_bookings_delta), "booking_id") == ["b", "c"]


def test_a_plain_staging_table_is_taken_over(spark, params):
    name = params().staging_bookings_delta
    overwrite_table(bookings(spark, {"booking_id": "old"}), name)
    feed(spark, params(), [{"booking_id": "a"}])
    for _ in range(3):
        stage_bookings(spark, params())
        assert ids(spark.table(name), "booking_id") == ["a"]
    assert not table_exists(spark, f"{name}__adopted")


def _checked_without_reading(spark, params, monkeypatch):
    """The check results of a run, and whether a staging table was read for them."""
    from daybook.operators import quality

    read, real = [], quality.verify
    with monkeypatch.context() as patch:
        patch.setattr(quality, "verify", lambda df, *checks: read.append(1) or real(df, *checks))
        try:
            check_and_merge(spark, params)
            said = "passed"
        except QualityError as error:
            said = str(error)
    return said, len(read)


def test_checks_ride_on_the_staging_write(spark, params, monkeypatch):
    p = params()
    feed(spark, p, [{"booking_id": "a"}, {"booking_id": "b", "total_amount": -1.0}])
    stage_bookings(spark, p)
    stage_customers(spark, p)
    said, read = _checked_without_reading(spark, p, monkeypatch)
    assert read == 0 and "NonNegative(total_amount): Value: 0.5" in said
    measured = written_metrics(spark, p.staging_bookings_delta)
    fresh = spark.table(p.staging_bookings_delta).agg(*[c.alias(k) for k, c in metrics(BOOKINGS_CHECK).items()])
    assert measured == fresh.first().asDict()


def test_staged_rows_that_changed_are_read(spark, params, monkeypatch):
    p = params()
    feed(spark, p, [{"booking_id": "a"}])
    stage_bookings(spark, p)
    stage_customers(spark, p)
    slot = current_slot(spark, p.staging_bookings_delta)
    staged_bookings(spark, ("z", "pending", -5.0)).write.insertInto(slot)
    assert written_metrics(spark, p.staging_bookings_delta) is None
    said, read = _checked_without_reading(spark, p, monkeypatch)
    assert read == 1 and "NonNegative(total_amount): Value: 0.5" in said


def test_a_check_of_other_constraints_reads_the_table(spark, params):
    p = params()
    feed(spark, p, [{"booking_id": "a"}])
    stage_bookings(spark, p)
    df, measured = spark.table(p.staging_bookings_delta), written_metrics(spark, p.staging_bookings_delta)
    other = BOOKINGS_CHECK.is_complete("total_amount")
    with_and_without = [Verification(df, other, measured=m).rows for m in (measured, None)]
    assert with_and_without[0] == with_and_without[1] and len(with_and_without[0]) == 13
    assert Verification(df, BOOKINGS_CHECK, measured=measured).rows == Verification(df, BOOKINGS_CHECK).rows
