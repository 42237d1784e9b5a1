"""Targets stored in parts: what a day writes, what readers see, what is left behind."""

from pathlib import Path
from urllib.parse import urlparse

import pytest

from daybook.operators.merge import BOOKINGS_RULE, AmbiguousMergeError, merge_rows
from daybook.plans import daily
from daybook.plans.daily import DayPublishedError, check_and_merge, run_day
from daybook.sources import parts as parts_module, tables
from daybook.sources.parts import (
    part_folders,
    part_of,
    parts_in,
    read_parts,
    touched_parts,
    write_parts,
)
from daybook.sources.tables import PublishError, current_slot, folder_of, overwrite_table, publish, published_day
from tests.helpers import bag, ids, plan, staged_bookings
from tests.test_daily import feed, params  # noqa: F401

PARTS = 16


def rows(spark, keys, amount=1.0, status="completed"):
    return staged_bookings(spark, *[(k, status, amount) for k in keys])


def merged_day(spark, target, updates):
    slot = current_slot(spark, target)
    touched = touched_parts(spark.table(target), updates, "booking_id", PARTS)
    contents = merge_rows(read_parts(spark, slot, touched), updates, BOOKINGS_RULE)
    return write_parts(spark, contents, target, "booking_id", PARTS, touched)


def numbers(spark, keys):
    df = rows(spark, keys)
    return {r["p"] for r in df.select(part_of(df["booking_id"], PARTS).alias("p")).collect()}


@pytest.fixture
def target(spark, database):
    name = f"{database}.bookings"
    keys = [f"B{i}" for i in range(400)] + [None, None]
    publish(spark, write_parts(spark, rows(spark, keys), name, "booking_id", PARTS))
    return name


def test_a_target_in_parts_looks_like_any_other(spark, target):
    assert parts_in(spark, current_slot(spark, target)) == PARTS
    assert bag(spark.table(target)) == bag(rows(spark, [f"B{i}" for i in range(400)] + [None, None]))
    assert spark.table(target).columns == rows(spark, []).columns
    assert set(part_folders(spark, current_slot(spark, target))) == numbers(spark, [f"B{i}" for i in range(400)] + [None])


def test_a_small_day_writes_the_parts_it_touches(spark, target):
    """A day of 1 % of the keys."""
    before = part_folders(spark, current_slot(spark, target))
    whole = bag(merge_rows(spark.table(target), rows(spark, ["B7", "B9", "B300", "new"], 2.0), BOOKINGS_RULE))
    snapshot = merged_day(spark, target, rows(spark, ["B7", "B9", "B300", "new"], 2.0))
    assert ids(spark.table(target).where("total_amount = 2"), "booking_id") == []
    publish(spark, snapshot)
    assert bag(spark.table(target)) == whole and snapshot.rows == 403
    after = part_folders(spark, current_slot(spark, target))
    moved = {n for n in after if after[n] != before.get(n)}
    assert moved == numbers(spark, ["B7", "B9", "B300", "new"]) and len(moved) <= 4 < len(after)


def test_days_in_a_row_equal_whole_merges(spark, target):
    expected = spark.table(target).collect()
    schema = spark.table(target).schema
    for day, (keys, status) in enumerate(
        [(["B1", "B2", "x"], "cancelled"), (["B1", "x", None], "completed"), (["y"], "pending"), (["B2", "y"], "completed")]
    ):
        updates = rows(spark, keys, float(day), status)
        expected = merge_rows(spark.createDataFrame(expected, schema), updates, BOOKINGS_RULE).collect()
        publish(spark, merged_day(spark, target, updates))
        assert bag(spark.table(target)) == bag(spark.createDataFrame(expected, schema))


def test_a_part_that_loses_all_rows_is_gone(spark, database):
    name = f"{database}.t"
    publish(spark, write_parts(spark, rows(spark, ["a"], status="cancelled"), name, "booking_id", PARTS))
    publish(spark, merged_day(spark, name, rows(spark, ["a"])))
    assert spark.table(name).count() == 0 and part_folders(spark, current_slot(spark, name)) == {}
    publish(spark, merged_day(spark, name, rows(spark, ["a"])))
    assert ids(spark.table(name), "booking_id") == ["a"]


def test_only_touched_parts_are_read(spark, target):
    touched = touched_parts(spark.table(target), rows(spark, ["B7"]), "booking_id", PARTS)
    df = read_parts(spark, current_slot(spark, target), touched)
    assert len(touched) == 1 and "__part" not in df.columns
    assert {f"__part={touched[0]}" in f for f in df.inputFiles()} == {True}
    assert "PartitionFilters: [__part" in plan(df, "formatted") or "__part" in plan(df, "formatted")


def _stored_folders(spark, target):
    root = Path(urlparse(folder_of(spark, target + "__parts")).path)
    return {str(p) for p in root.glob("v-*/__part=*")}


def test_two_states_of_a_part_are_kept_at_most(spark, target):
    for i in range(4):
        publish(spark, merged_day(spark, target, rows(spark, ["B7"], float(i))))
        assert len(_stored_folders(spark, target)) <= len(part_folders(spark, current_slot(spark, target))) + 2
        assert spark.table(target).count() == 402


@pytest.mark.parametrize("step", ["_make", "_folders"])
def test_a_killed_run_changes_nothing_and_leaves_nothing(spark, target, monkeypatch, step):
    before, whole = bag(spark.table(target)), len(_stored_folders(spark, target))

    def killed(*_):
        raise KeyboardInterrupt

    with monkeypatch.context() as patch:
        if step == "_make":
            patch.setattr(parts_module, "_make", killed)
        else:
            patch.setattr(parts_module, "row_count", killed)
        with pytest.raises(KeyboardInterrupt):
            merged_day(spark, target, rows(spark, ["B7", "B8"], 5.0))
    assert bag(spark.table(target)) == before
    publish(spark, merged_day(spark, target, rows(spark, ["B7"], 6.0)))
    assert spark.table(target).where("total_amount = 6").count() == 1
    assert spark.table(target).count() == 402
    publish(spark, merged_day(spark, target, rows(spark, ["B7"], 7.0)))
    assert len(_stored_folders(spark, target)) <= whole + 2


def test_rows_of_other_parts_are_refused(spark, target):
    with pytest.raises(PublishError, match="not touched"):
        write_parts(spark, rows(spark, ["B1", "B2", "B3"]), target, "booking_id", PARTS, [])


def test_a_hot_part_is_written_by_several_tasks(spark, database, settings):
    settings(spark__sql__adaptive__advisoryPartitionSizeInBytes="64k")
    hot = spark.range(0, 40_000, 1, 8).selectExpr("'hot' AS booking_id", "sha2(string(id), 512) AS status")
    publish(spark, write_parts(spark, hot, f"{database}.t", "booking_id", PARTS))
    slot = current_slot(spark, f"{database}.t")
    assert len(part_folders(spark, slot)) == 1 and len(spark.table(slot).inputFiles()) > 3
    assert spark.table(f"{database}.t").count() == 40_000


def test_names_and_keys_of_other_types(spark, database):
    df = spark.range(20).selectExpr("id AS `a b``c`", "cast(null AS string) AS status", "decimal(id) AS amount")
    publish(spark, write_parts(spark, df, f"{database}.`odd`".replace("`", ""), "`a b``c`", 4))
    assert bag(spark.table(f"{database}.odd")) == bag(df)
    assert touched_parts(df.withColumnRenamed("a b`c", "k"), spark.sql("SELECT '7' AS k"), "k", 4) == touched_parts(
        df.withColumnRenamed("a b`c", "k"), spark.sql("SELECT 7 AS k"), "k", 4
    )


# --- the daily run ---


def test_days_in_parts(spark, params):  # noqa: F811
    first, second = params("20241016", parts=8), params("20241017", parts=8)
    feed(spark, first, [{"booking_id": f"B{i}"} for i in range(30)])
    feed(spark, second, [{"booking_id": "B3", "total_amount": 1.0}, {"booking_id": "z"}])
    assert run_day(spark, first).merged.bookings == 30
    before = part_folders(spark, current_slot(spark, first.bookings_delta_table))
    assert run_day(spark, second).merged.bookings == 31
    after = part_folders(spark, current_slot(spark, first.bookings_delta_table))
    assert sum(after[n] != before.get(n) for n in after) <= 2
    assert spark.table(first.bookings_delta_table).where("total_amount = 1").count() == 1


def test_a_plain_target_goes_over_to_parts_and_back(spark, params):  # noqa: F811
    for date, how in (("20241016", {}), ("20241017", {"parts": 4}), ("20241018", {"parts": 8}), ("20241019", {})):
        p = params(date, **how)
        feed(spark, p, [{"booking_id": f"B{date}"}, {"booking_id": "same"}])
        run_day(spark, p)
        assert parts_in(spark, current_slot(spark, p.bookings_delta_table)) == how.get("parts", 0)
    found = ids(spark.table(p.bookings_delta_table), "booking_id")
    assert found == ["B20241016", "B20241017", "B20241018", "B20241019", "same"]


def test_an_ambiguous_day_in_parts_changes_nothing(spark, params):  # noqa: F811
    first, second = params("20241016", parts=4), params("20241017", parts=4)
    feed(spark, first, [{"booking_id": "a"}])
    feed(spark, second, [{"booking_id": "a"}, {"booking_id": "a"}])
    run_day(spark, first)
    with pytest.raises(AmbiguousMergeError):
        run_day(spark, second)
    assert published_day(spark, first.bookings_delta_table) == "20241016"
    assert spark.table(first.bookings_delta_table).count() == 1


# --- a day that is retried ---


def _loaded(spark, params, **how):  # noqa: F811
    first, second = params("20241016", **how), params("20241017", **how)
    feed(spark, first, [{"booking_id": "a", "status": "cancelled"}, {"booking_id": "b"}], [{"status": "inactive"}])
    feed(spark, second, [{"booking_id": "b", "status": "cancelled"}, {"booking_id": "c"}], [{}, {"customer_id": "C2"}])
    run_day(spark, first)
    return second


@pytest.mark.parametrize("how", [{}, {"parts": 4}])
def test_a_driver_lost_after_publishing(spark, params, monkeypatch, how):  # noqa: F811
    second = _loaded(spark, params, on_published="skip", **how)
    real = daily.publish

    def lost(*args, **more):
        real(*args, **more)
        raise KeyboardInterrupt

    with monkeypatch.context() as patch:
        patch.setattr(daily, "publish", lost)
        with pytest.raises(KeyboardInterrupt):
            run_day(spark, second)
    tables_ = (second.bookings_delta_table, second.customers_delta_table)
    published = [bag(spark.table(t)) for t in tables_]
    again = run_day(spark, second)
    assert [bag(spark.table(t)) for t in tables_] == published
    assert (again.merged.bookings, again.merged.customers) == tuple(b.total() for b in published)


def test_a_driver_lost_between_the_two_targets(spark, params, monkeypatch):  # noqa: F811
    """The retry merges the target that was not reached, and that one alone."""
    second = _loaded(spark, params, on_published="skip")
    real = tables._point

    def lost(session, name, *rest):
        if name == second.customers_delta_table:
            raise KeyboardInterrupt
        real(session, name, *rest)

    with monkeypatch.context() as patch:
        patch.setattr(tables, "_point", lost)
        with pytest.raises(KeyboardInterrupt):
            run_day(spark, second)
    days = [published_day(spark, t) for t in (second.bookings_delta_table, second.customers_delta_table)]
    assert days == ["20241017", "20241016"]
    merged = run_day(spark, second).merged
    assert (merged.bookings, merged.customers) == (3, 1)
    assert ids(spark.table(second.customers_delta_table), "customer_id") == ["C2"]


def test_refused_and_repeated(spark, params):  # noqa: F811
    second = _loaded(spark, params)
    run_day(spark, second)
    refusing = params("20241017", on_published="refuse")
    with pytest.raises(DayPublishedError, match="20241017"):
        check_and_merge(spark, refusing)
    # By default a day may be merged again, with all that follows: b was cancelled, and goes.
    run_day(spark, second)
    assert ids(spark.table(second.bookings_delta_table), "booking_id") == ["a", "c"]


def test_a_failed_publish_restores_the_day(spark, params, monkeypatch):  # noqa: F811
    second = _loaded(spark, params)
    real = tables._point

    def failing(session, name, *rest):
        if name == second.customers_delta_table:
            raise RuntimeError("no")
        real(session, name, *rest)

    with monkeypatch.context() as patch:
        patch.setattr(tables, "_point", failing)
        with pytest.raises(RuntimeError):
            run_day(spark, second)
    assert published_day(spark, second.bookings_delta_table) == "20241016"


def test_neither_side_of_a_bucketed_merge_is_shuffled(spark, params, settings):  # noqa: F811
    settings(spark__sql__autoBroadcastJoinThreshold="-1")
    second = _loaded(spark, params, buckets=4)
    daily.stage_bookings(spark, second)
    sides = spark.table(second.bookings_delta_table), spark.table(second.staging_bookings_delta)
    merged = merge_rows(*sides, BOOKINGS_RULE, "shuffle")
    text = plan(merged, "simple")
    assert text.count("SortMergeJoin") == 2 and "Exchange" not in text
    assert ids(merged, "booking_id") == ["a", "b", "c"]


def test_unfit_parameters(params):  # noqa: F811
    for how in ({"parts": 2, "buckets": 2}, {"parts": 2, "table_format": "orc"}, {"on_published": "no"},
                {"on_published": "skip", "target_mode": "row_level"}):
        with pytest.raises(ValueError):
            params(**how)
