"""Time the daily jobs; print one JSON line.

The raw feeds are written as JSON first, outside the timing. Each job is then
run once to warm up and timed on its next two runs; the better one counts.
``comparators`` times the same work in another shape: a script that looks at the
data after every step and formats phone numbers in a Python function per row,
and a merge by one full outer join.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time
from pathlib import Path

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parent))

from daybook.functions.phone import phone_format  # noqa: E402
from daybook.operators.clean import booking_stages, clean_customers, funnel  # noqa: E402
from daybook.operators.merge import BOOKINGS_RULE, CUSTOMERS_RULE, merge_rows  # noqa: E402
from daybook.operators.quality import BOOKINGS_CHECK, CUSTOMERS_CHECK, verify  # noqa: E402
from daybook.params import PipelineParams  # noqa: E402
from daybook.plans.daily import check_and_merge, run_day  # noqa: E402
from daybook.plans.staging import bookings_plan, stage_bookings, stage_customers  # noqa: E402
from daybook.sources.json_files import read_bookings, read_customers, write_json  # noqa: E402
from daybook.sources.tables import overwrite_table, publish, write_snapshot  # noqa: E402
from workload.feeds import AS_OF_DATE, raw_bookings, raw_customers  # noqa: E402
from workload.scratch import scratch_database, scratch_dir  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
FILES = int(CPUS)


def session() -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("daybook-bench")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        # Plans are built in many small calls; do not record where each was made.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def seconds(job, before=lambda: None) -> float:
    before()
    job()
    times = []
    for _ in range(2):
        before()
        began = time.perf_counter()
        job()
        times.append(time.perf_counter() - began)
    return round(min(times), 3)


def drain(df) -> None:
    df.write.format("noop").mode("overwrite").save()


# --- the other shape ------------------------------------------------------------


def format_per_row(phone):
    """The phone rules on plain strings, for one row at a time."""
    kept = re.sub(r"(?<!\+)\D", "", phone or "")
    size = len(kept)
    if size < 10:
        return phone
    start = 0 if size == 10 else 1 if kept[0] == "1" else size - 10
    area, exchange, line = kept[start : start + 3], kept[start + 3 : start + 6], kept[start + 6 :]
    text = f"({area}) {exchange}-{line}"
    if size == 10:
        return text
    if kept[0] == "1":
        return f"+1 {text}" + (f" (Ext: {kept[11:]})" if size > 11 else "")
    return f"+{kept[:start]} {text} (Ext: {kept[-3:]})"


def look(df) -> None:
    """What a notebook prints between two steps."""
    df.limit(5).collect()
    df.count()


def stepwise_customers(spark, params) -> None:
    raw = read_customers(spark, params.input_path("customers"))
    look(raw)
    valid = clean_customers(raw)
    look(valid)
    udf = F.udf(format_per_row, "string")
    signup = F.try_to_date("signup_date", "yyyy-MM-dd")
    staged = valid.withColumns(
        {
            "phone_number": udf("phone_number"),
            "signup_date": signup,
            "tenure_in_days": F.date_diff(F.lit(AS_OF_DATE).cast("date"), signup),
        }
    )
    staged.limit(10).collect()
    overwrite_table(staged, params.staging_customers_delta + "_plain")


def stepwise_bookings(spark, params) -> None:
    raw = read_bookings(spark, params.input_path("bookings"))
    look(raw)
    staged = bookings_plan(raw)
    look(staged)
    overwrite_table(staged, params.staging_bookings_delta + "_plain")


def full_outer(target, updates, key, delete_status):
    t, u = target.alias("t"), updates.alias("u")
    joined = t.join(u, F.col(f"t.{key}") == F.col(f"u.{key}"), "full_outer")
    old, new = F.col(f"t.{key}"), F.col(f"u.{key}")
    status = F.col("t.status")
    deleted = old.isNotNull() & new.isNotNull() & (status == delete_status)
    take_new = new.isNotNull() & (old.isNull() | (status != delete_status))
    columns = [
        F.when(take_new, F.col(f"u.{c}")).otherwise(F.col(f"t.{c}")).alias(c)
        for c in target.columns
    ]
    return joined.filter(~F.coalesce(deleted, F.lit(False))).select(*columns)


def main() -> None:
    spark = session()
    folder = scratch_dir(spark)
    database = scratch_database(spark, folder)

    def params(date):
        return PipelineParams(
            date=date,
            path=f"{folder}/in",
            staging_bookings_delta=f"{database}.staging_bookings",
            staging_customers_delta=f"{database}.staging_customers",
            bookings_delta_table=f"{database}.bookings",
            customers_delta_table=f"{database}.customers",
            as_of_date=AS_OF_DATE,
        )

    first, second = params("20241016"), params("20241017")
    for day, p in ((1, first), (2, second)):
        write_json(raw_bookings(spark, SF_DIR, day).repartition(FILES), p.input_path("bookings"))
        write_json(raw_customers(spark, SF_DIR, day).repartition(FILES), p.input_path("customers"))

    # Day 1 is the target of every merge below, day 2 is what is staged. Both are
    # copied, since the timed jobs replace the staging tables; jobs that change the
    # targets get day 1 again before each call, outside the clock.
    copies = {}
    for day, p in ((1, first), (2, second)):
        for stage, name in (
            (stage_bookings, p.staging_bookings_delta),
            (stage_customers, p.staging_customers_delta),
        ):
            stage(spark, p)
            overwrite_table(spark.table(name), f"{name}_{day}")
            copies[name, day] = spark.table(f"{name}_{day}")
    bookings1, bookings2 = (copies[first.staging_bookings_delta, day] for day in (1, 2))
    customers1, customers2 = (copies[first.staging_customers_delta, day] for day in (1, 2))
    # A third of a target under one key, and a day with a third of its keys staged three times.
    third = F.xxhash64("booking_id") % 3 == 0
    overwrite_table(
        bookings1.withColumn("booking_id", F.when(third, F.lit("hot")).otherwise(F.col("booking_id"))), f"{database}.hot"
    )
    new = bookings2.join(bookings1, "booking_id", "left_anti").where(third)
    overwrite_table(bookings2.unionByName(new).unionByName(new), f"{database}.again")
    hot, again = spark.table(f"{database}.hot"), spark.table(f"{database}.again")
    raw2 = read_bookings(spark, second.input_path("bookings"))
    raw_phones = read_customers(spark, second.input_path("customers"))

    jobs = {
        "stage_bookings": lambda: stage_bookings(spark, second),
        "stage_customers": lambda: stage_customers(spark, second),
        "bookings_funnel": lambda: drain(funnel(raw2, booking_stages())),
        "customers_phone": lambda: drain(raw_phones.select(phone_format(F.col("phone_number")))),
        "bookings_quality": lambda: drain(verify(bookings2, BOOKINGS_CHECK)),
        "customers_quality": lambda: drain(verify(customers2, CUSTOMERS_CHECK)),
        "bookings_merge": lambda: drain(merge_rows(bookings1, bookings2, BOOKINGS_RULE)),
        "customers_merge": lambda: drain(merge_rows(customers1, customers2, CUSTOMERS_RULE)),
        "bookings_merge_shuffle": lambda: drain(
            merge_rows(bookings1, bookings2, BOOKINGS_RULE, "shuffle")
        ),
        "bookings_merge_hot_target": lambda: drain(merge_rows(hot, bookings2, BOOKINGS_RULE, "shuffle")),
        "bookings_merge_repeated_keys": lambda: drain(merge_rows(bookings1, again, BOOKINGS_RULE, "shuffle")),
        "check_and_merge": lambda: check_and_merge(spark, second),
        "run_day": lambda: run_day(spark, second),
    }
    comparators = {
        "stage_bookings_stepwise": lambda: stepwise_bookings(spark, second),
        "stage_customers_stepwise": lambda: stepwise_customers(spark, second),
        "customers_phone_row_udf": lambda: drain(
            raw_phones.select(F.udf(format_per_row, "string")("phone_number"))
        ),
        "bookings_merge_full_outer": lambda: drain(
            full_outer(bookings1, bookings2, "booking_id", "cancelled")
        ),
        "bookings_merge_hot_target_full_outer": lambda: drain(full_outer(hot, bookings2, "booking_id", "cancelled")),
        "bookings_merge_repeated_keys_full_outer": lambda: drain(
            full_outer(bookings1, again, "booking_id", "cancelled")
        ),
    }

    def load_first_day():
        """The targets hold day 1 alone, the staging tables day 2."""
        for target in (second.bookings_delta_table, second.customers_delta_table):
            spark.sql(f"DROP VIEW IF EXISTS {target}")
        publish(
            spark,
            write_snapshot(spark, bookings1, second.bookings_delta_table),
            write_snapshot(spark, customers1, second.customers_delta_table),
        )
        stage_bookings(spark, second)
        stage_customers(spark, second)

    changing = ("check_and_merge", "run_day")
    times = {
        name: seconds(job, load_first_day) if name in changing else seconds(job) for name, job in jobs.items()
    }
    others = {name: seconds(job) for name, job in comparators.items()}
    result = {
        "metric": "total seconds of the daily jobs",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": SF_DIR.rstrip("/").rsplit("sf", 1)[-1],
        "cpus": int(CPUS),
        "comparators": others,
    }
    print(json.dumps(result), flush=True)


if __name__ == "__main__":
    main()
