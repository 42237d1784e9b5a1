"""Check, merge and publish; and the whole day."""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

from daybook.operators.merge import (
    BOOKINGS_RULE,
    CUSTOMERS_RULE,
    MergeRule,
    merge_into,
    merge_rows,
)
from daybook.operators.quality import (
    BOOKINGS_CHECK,
    CUSTOMERS_CHECK,
    Verification,
    require_passed,
)
from daybook.params import PipelineParams
from daybook.plans.staging import Preview, Staged, stage_bookings, stage_customers
from daybook.sources.parts import parts_in, read_parts, touched_parts, write_parts
from daybook.sources.tables import (
    Snapshot,
    adopt,
    create_table,
    current_slot,
    publish,
    published_day,
    read_table,
    row_count,
    table_exists,
    write_snapshot,
    written_metrics,
)


@dataclass(frozen=True)
class Merged:
    """Row counts of the two targets after a run."""

    bookings: int
    customers: int


class DayPublishedError(RuntimeError):
    """A target holds the day already, and merging it again was to be refused."""


@dataclass(frozen=True)
class Day:
    staged_bookings: Staged
    staged_customers: Staged
    merged: Merged


def check_and_merge(
    spark: SparkSession, params: PipelineParams, preview: Preview | None = None
) -> Merged:
    """Check both staging tables, then merge both; a failed check merges neither."""
    bookings = read_table(spark, params.staging_bookings_delta)
    customers = read_table(spark, params.staging_customers_delta)
    if preview:
        preview(params.staging_bookings_delta, bookings)
        preview(params.staging_customers_delta, customers)

    # Counted when they were written, if nothing has changed since.
    measured = [
        written_metrics(spark, name) if params.target_mode == "snapshot" else None
        for name in (params.staging_bookings_delta, params.staging_customers_delta)
    ]
    on_bookings = Verification(bookings, BOOKINGS_CHECK, measured=measured[0])
    on_customers = Verification(customers, CUSTOMERS_CHECK, measured=measured[1])
    # Both are computed before either is tested.
    side_by_side(spark, lambda: on_bookings.rows, lambda: on_customers.rows)
    if preview:
        preview("checks on bookings", on_bookings.results)
        preview("checks on customers", on_customers.results)
    require_passed(on_bookings, "bookings")
    require_passed(on_customers, "customers")

    sides = (
        (bookings, params.bookings_delta_table, BOOKINGS_RULE),
        (customers, params.customers_delta_table, CUSTOMERS_RULE),
    )
    if params.target_mode == "row_level":
        for side in sides:
            _merge_in_place(spark, params, *side)
        counts = [row_count(spark, target) for _, target, _ in sides]
    else:
        done = [params.on_published != "merge" and _holds_day(spark, params, side[1]) for side in sides]
        open_ = [side for side, is_done in zip(sides, done, strict=True) if not is_done]
        # Both results exist in full before either target changes.
        snapshots = side_by_side(
            spark,
            *[lambda s=side: _merge_to_snapshot(spark, params, *s) for side in open_],
        )
        publish(spark, *snapshots, day=params.date)
        rows = {s.target: s.rows for s in snapshots}
        counts = [
            row_count(spark, target) if is_done else rows[target]
            for (_, target, _), is_done in zip(sides, done, strict=True)
        ]
    return Merged(*counts)


def run_day(
    spark: SparkSession, params: PipelineParams, preview: Preview | None = None
) -> Day:
    """Stage both feeds, then check and merge."""
    bookings, customers = side_by_side(
        spark,
        lambda: stage_bookings(spark, params, preview),
        lambda: stage_customers(spark, params, preview),
    )
    return Day(bookings, customers, check_and_merge(spark, params, preview))


def _merge_to_snapshot(
    spark: SparkSession,
    params: PipelineParams,
    updates: DataFrame,
    target: str,
    rule: MergeRule,
) -> Snapshot:
    adopt(spark, target)
    if not table_exists(spark, target):
        if params.parts:
            return write_parts(spark, updates, target, rule.key, params.parts)
        return write_snapshot(spark, updates, target, params.table_format, params.buckets, rule.key)
    slot = current_slot(spark, target)
    rows, touched = read_table(spark, target), None
    if params.parts and parts_in(spark, slot) == params.parts:
        touched = touched_parts(rows, updates, rule.key, params.parts)
        rows = read_parts(spark, slot, touched)
    contents = merge_rows(rows, updates, rule, broadcast_limit_bytes=params.broadcast_limit_bytes)
    if params.parts:
        return write_parts(spark, contents, target, rule.key, params.parts, touched)
    return write_snapshot(spark, contents, target, params.table_format, params.buckets, rule.key)


def _holds_day(spark: SparkSession, params: PipelineParams, target: str) -> bool:
    if published_day(spark, target) != params.date:
        return False
    if params.on_published == "refuse":
        raise DayPublishedError(f"{target} holds {params.date} already")
    return True


def _merge_in_place(
    spark: SparkSession,
    params: PipelineParams,
    updates: DataFrame,
    target: str,
    rule: MergeRule,
) -> None:
    if table_exists(spark, target):
        merge_into(updates, target, rule)
    else:
        create_table(updates, target, params.table_format)


def side_by_side(spark: SparkSession, *jobs: Callable[[], object]) -> list:
    """Run independent jobs side by side, so that one fills the other's gaps."""
    inherit = inheritable_thread_target(spark)
    with ThreadPoolExecutor(max(1, len(jobs))) as pool:
        return [done.result() for done in [pool.submit(inherit(j)) for j in jobs]]
