"""Registered queries against SQL on DuckDB, and known results at one size."""

from collections import Counter
from threading import Barrier

import pytest
from pyspark.sql import functions as F

from __spark_entry__ import entry, oracle_sql, queries
from compare import connect, difference
from daybook.operators.clean import booking_stages, customer_stages, funnel
from daybook.operators.merge import BOOKINGS_RULE, CUSTOMERS_RULE, merge_rows
from daybook.schemas import BOOKINGS_STAGED
from daybook.sources.json_files import write_json
from workload.feeds import raw_bookings, raw_customers
from workload.oracle import ORACLE
from workload.queries import QUERIES, staged_bookings, staged_customers
from workload.scratch import scratch_dir

SMALL, MEDIUM = "/root/testdata/sf0.001", "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def con():
    return connect(SMALL)


@pytest.mark.parametrize("name", QUERIES)
def test_query_equals_its_sql(spark, con, name):
    assert difference(QUERIES[name](spark, SMALL), con, ORACLE[name]) is None


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(queries()) and set(ORACLE) <= set(oracle_sql())


@pytest.mark.parametrize("name", ["bookings_staged", "bookings_duration", "bookings_quality_failing"])
def test_queries_do_not_depend_on_the_sessions_zone(spark, con, settings, name):
    settings(spark__sql__session__timeZone="America/New_York")
    assert difference(QUERIES[name](spark, SMALL), con, ORACLE[name]) is None


def test_entry(spark):
    df = entry(spark)
    assert df.schema.simpleString() == BOOKINGS_STAGED.simpleString()
    assert df.count() > 0


# Rows left after each cleaning step.
def test_known_funnels(spark):
    b = funnel(raw_bookings(spark, MEDIUM), booking_stages())
    assert [r.rows for r in b.collect()] == [15000, 14418, 13903, 11557]
    c = funnel(raw_customers(spark, MEDIUM), customer_stages())
    assert [r.rows for r in c.collect()] == [1500, 1456, 1154, 1060, 1023]


# Merging two overlapping thirds of the staged rows.
@pytest.mark.parametrize("strategy", ["auto", "shuffle"])
def test_known_merges(spark, strategy):
    def days(df, key, rotated):
        part = F.substring(key, 2, 20).cast("long") % 3
        status = F.create_map(*[F.lit(x) for pair in rotated.items() for x in pair])[F.col("status")]
        return df.filter(part < 2), df.filter(part > 0).withColumn("status", status)

    target, updates = days(
        staged_bookings(spark, MEDIUM),
        "booking_id",
        {"completed": "cancelled", "cancelled": "pending", "pending": "completed"},
    )
    updates = updates.withColumn("total_amount", F.col("total_amount") + 1.0)
    merged = merge_rows(target, updates, BOOKINGS_RULE, strategy)
    assert (target.count(), updates.count()) == (7703, 7708)
    assert Counter(r.status for r in merged.select("status").collect()) == {
        "cancelled": 3853, "completed": 3810, "pending": 2570,
    }

    target, updates = days(
        staged_customers(spark, MEDIUM), "customer_id", {"active": "inactive", "inactive": "active"}
    )
    merged = merge_rows(target, updates, CUSTOMERS_RULE, strategy)
    assert (target.count(), updates.count()) == (685, 682)
    assert Counter(r.status for r in merged.select("status").collect()) == {
        "active": 323, "inactive": 563,
    }


def test_scratch_is_in_the_shared_folder(spark):
    shared = spark.conf.get("spark.checkpoint.dir")
    assert scratch_dir(spark).startswith(shared + "/")
    assert scratch_dir(spark) != scratch_dir(spark)


@pytest.mark.parametrize("name", ["bookings_merge_broadcast", "customers_merge_broadcast", "merge_number_keys"])
def test_broadcast_queries_give_all_rows_beyond_the_limit(spark, con, monkeypatch, name):
    def limited(*sides, broadcast_limit_bytes=None, **how):
        return merge_rows(*sides, broadcast_limit_bytes=1000, **how)

    monkeypatch.setattr("workload.queries.merge_rows", limited)
    assert difference(QUERIES[name](spark, SMALL), con, ORACLE[name]) is None


def test_the_two_feeds_of_a_day_are_written_side_by_side(spark, monkeypatch):
    both = Barrier(2)

    def met(df, path):
        both.wait(timeout=60)
        write_json(df, path)

    monkeypatch.setattr("workload.queries.write_json", met)
    assert QUERIES["run_day_counts"](spark, SMALL).count() == 2
