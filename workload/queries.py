"""The registered queries: every operator over whole test tables.

Each takes (spark, sf_dir) and returns a DataFrame; ``workload.oracle`` holds the
SQL that must give the same rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daybook.functions.times import (
    date_part_of,
    hours_between,
    parse_date,
    tenure_days,
    time_part_of,
)
from daybook.functions.phone import phone_format
from daybook.operators.clean import booking_stages, customer_stages, funnel, keep_valid
from daybook.operators.merge import (
    BOOKINGS_RULE,
    CUSTOMERS_RULE,
    MergeRule,
    ambiguous_keys,
    FILTER_BYTES,
    merge_rows,
)
from daybook.operators.quality import (
    BOOKINGS_CHECK,
    CUSTOMERS_CHECK,
    Check,
    CheckLevel,
    roll_up,
    verify,
)
from daybook.params import DATE_TIME_FORMAT, PipelineParams
from daybook.plans.daily import run_day, side_by_side
from daybook.plans.staging import bookings_plan, customers_plan, first_rows
from daybook.sources.json_files import read_bookings, read_customers, write_json
from daybook.sources import mock
from daybook.sources.tables import publish, write_snapshot
from workload.feeds import AS_OF_DATE, raw_bookings, raw_customers, raw_rentals, table
from workload.scratch import scratch_database, scratch_dir

QUERIES = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def staged_bookings(spark, sf_dir, day=None) -> DataFrame:
    return bookings_plan(raw_bookings(spark, sf_dir, day), time_zone="UTC")


def staged_customers(spark, sf_dir, day=None) -> DataFrame:
    return customers_plan(raw_customers(spark, sf_dir, day), AS_OF_DATE)


def _stage(stages, name):
    return [s for s in stages if s.name == name]


# --- cleaning, one filter at a time -----------------------------------------


@query
def bookings_drop_null_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return keep_valid(raw_bookings(spark, sf_dir), _stage(booking_stages(), "null_keys"))


@query
def bookings_valid_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return keep_valid(raw_bookings(spark, sf_dir), _stage(booking_stages(), "dates"))


@query
def bookings_valid_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    return keep_valid(raw_bookings(spark, sf_dir), _stage(booking_stages(), "status"))


@query
def customers_drop_null_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return keep_valid(raw_customers(spark, sf_dir), _stage(customer_stages(), "null_keys"))


@query
def customers_valid_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    return keep_valid(raw_customers(spark, sf_dir), _stage(customer_stages(), "status"))


@query
def customers_valid_email(spark: SparkSession, sf_dir: str) -> DataFrame:
    return keep_valid(raw_customers(spark, sf_dir), _stage(customer_stages(), "email"))


@query
def customers_valid_signup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return keep_valid(raw_customers(spark, sf_dir), _stage(customer_stages(), "signup_date"))


# --- expressions, over uncleaned rows ---------------------------------------


@query
def bookings_split_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    start, end = F.col("start_time"), F.col("end_time")
    return raw_bookings(spark, sf_dir).select(
        "booking_id",
        "start_time",
        "end_time",
        date_part_of(start).alias("start_date"),
        time_part_of(start).alias("starting_time"),
        date_part_of(end).alias("end_date"),
        time_part_of(end).alias("ending_time"),
    )


@query
def bookings_duration(spark: SparkSession, sf_dir: str) -> DataFrame:
    hours = hours_between(F.col("start_time"), F.col("end_time"), DATE_TIME_FORMAT, "UTC")
    return raw_bookings(spark, sf_dir).select(
        "booking_id", "start_time", "end_time", hours.alias("total_duration")
    )


@query
def bookings_duration_utc(spark: SparkSession, sf_dir: str) -> DataFrame:
    hours = hours_between(F.col("start_time"), F.col("end_time"), DATE_TIME_FORMAT, "UTC")
    return raw_rentals(spark, sf_dir).select(
        "booking_id", "start_time", "end_time", hours.alias("total_duration")
    )


@query
def customers_phone(spark: SparkSession, sf_dir: str) -> DataFrame:
    phone = F.col("phone_number")
    return raw_customers(spark, sf_dir).select(
        "customer_id", phone.alias("phone_raw"), phone_format(phone).alias("phone_number")
    )


@query
def customers_tenure(spark: SparkSession, sf_dir: str) -> DataFrame:
    signup = parse_date(F.col("signup_date"))
    return raw_customers(spark, sf_dir).select(
        "customer_id",
        signup.alias("signup_date"),
        tenure_days(signup, AS_OF_DATE).alias("tenure_in_days"),
    )


# --- staged tables and the row funnel ---------------------------------------


@query
def bookings_staged(spark: SparkSession, sf_dir: str) -> DataFrame:
    return staged_bookings(spark, sf_dir)


@query
def customers_staged(spark: SparkSession, sf_dir: str) -> DataFrame:
    return staged_customers(spark, sf_dir)


@query
def bookings_funnel(spark: SparkSession, sf_dir: str) -> DataFrame:
    return funnel(raw_bookings(spark, sf_dir), booking_stages())


@query
def customers_funnel(spark: SparkSession, sf_dir: str) -> DataFrame:
    return funnel(raw_customers(spark, sf_dir), customer_stages())


# --- JSON files: written, then read back with the fixed schema ---------------


@query
def bookings_json_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{scratch_dir(spark)}/bookings.json"
    write_json(raw_bookings(spark, sf_dir), path)
    return read_bookings(spark, path)


@query
def customers_json_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{scratch_dir(spark)}/customers.json"
    write_json(raw_customers(spark, sf_dir), path)
    return read_customers(spark, path)


@query
def bookings_json_array_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_bookings(spark, _array_lines(spark, sf_dir))


@query
def bookings_json_split_array_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same lines, cut into records before they are dealt to tasks."""
    return read_bookings(spark, _array_lines(spark, sf_dir), split_arrays=True)


def _array_lines(spark: SparkSession, sf_dir: str) -> str:
    """Lines that each hold an array of up to 100 records."""
    path = f"{scratch_dir(spark)}/arrays.json"
    raw = raw_bookings(spark, sf_dir)
    record = F.to_json(F.struct(*raw.columns))
    lines = (
        raw.select(record.alias("record"), F.monotonically_increasing_id().alias("n"))
        .groupBy(F.floor(F.col("n") / 100))
        .agg(F.concat(F.lit("["), F.concat_ws(",", F.collect_list("record")), F.lit("]")).alias("line"))
    )
    lines.select("line").write.text(path)
    return path


@query
def bookings_json_undeclared_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Undeclared keys are ignored, missing ones null, and a key in text form."""
    path = f"{scratch_dir(spark)}/orders.json"
    orders = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("booking_id"),
        F.col("o_orderstatus").alias("status"),
        F.col("o_orderpriority").alias("total_amount"),
        "o_custkey",
    )
    write_json(orders, path)
    return read_bookings(spark, path)


# --- quality checks ----------------------------------------------------------


@query
def bookings_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return verify(staged_bookings(spark, sf_dir), BOOKINGS_CHECK)


@query
def customers_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return verify(staged_customers(spark, sf_dir), CUSTOMERS_CHECK)


@query
def bookings_quality_failing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rentals that end before they start fail the duration constraint."""
    return verify(bookings_plan(raw_rentals(spark, sf_dir), time_zone="UTC"), BOOKINGS_CHECK)


@query
def bookings_quality_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two checks of different levels on uncleaned rows, in one pass."""
    complete = (
        Check(CheckLevel.ERROR, "keys")
        .has_size(lambda rows: rows > 1000)
        .is_complete("booking_id")
        .is_complete("end_time")
    )
    amounts = Check(CheckLevel.WARNING, "amounts").is_non_negative("total_amount")
    return verify(raw_bookings(spark, sf_dir), complete, amounts)


@query
def quality_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    runs = {
        "bookings": (staged_bookings(spark, sf_dir), BOOKINGS_CHECK),
        "customers": (staged_customers(spark, sf_dir), CUSTOMERS_CHECK),
        "rentals": (bookings_plan(raw_rentals(spark, sf_dir), time_zone="UTC"), BOOKINGS_CHECK),
    }
    statuses = [
        roll_up(verify(df, check)).select(F.lit(name).alias("run"), "status")
        for name, (df, check) in runs.items()
    ]
    return statuses[0].union(statuses[1]).union(statuses[2])


# --- merge -------------------------------------------------------------------
# A merge reads its sides more than once, so they are stored first, as in the
# daily run.


def _stored(spark: SparkSession, *frames: DataFrame) -> list[DataFrame]:
    folder = scratch_dir(spark)
    for i, df in enumerate(frames):
        df.write.parquet(f"{folder}/side{i}")
    return [spark.read.parquet(f"{folder}/side{i}") for i in range(len(frames))]


def _merged_bookings(spark, sf_dir, rule=BOOKINGS_RULE, **how) -> DataFrame:
    days = (staged_bookings(spark, sf_dir, day) for day in (1, 2))
    return merge_rows(*_stored(spark, *days), rule, **how)


def _merged_customers(spark, sf_dir, **how) -> DataFrame:
    days = (staged_customers(spark, sf_dir, day) for day in (1, 2))
    return merge_rows(*_stored(spark, *days), CUSTOMERS_RULE, **how)


@query
def bookings_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _merged_bookings(spark, sf_dir)


@query
def customers_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _merged_customers(spark, sf_dir)


@query
def bookings_merge_broadcast(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Broadcasts a larger day than usual; beyond the limit it is shuffled."""
    return _merged_bookings(
        spark, sf_dir, strategy="broadcast", broadcast_limit_bytes=256 << 20, beyond_limit="shuffle"
    )


@query
def customers_merge_broadcast(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _merged_customers(
        spark, sf_dir, strategy="broadcast", broadcast_limit_bytes=256 << 20, beyond_limit="shuffle"
    )


@query
def bookings_merge_shuffle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _merged_bookings(spark, sf_dir, strategy="shuffle")


@query
def customers_merge_shuffle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _merged_customers(spark, sf_dir, strategy="shuffle")


@query
def bookings_merge_delete_on_incoming(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _merged_bookings(
        spark, sf_dir, MergeRule("booking_id", "cancelled", delete_on="incoming")
    )


@query
def bookings_merge_null_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Uncleaned sides: null keys match nothing, null statuses stay as they are."""
    days = (raw_bookings(spark, sf_dir, day) for day in (1, 2))
    return merge_rows(*_stored(spark, *days), BOOKINGS_RULE)


@query
def bookings_merge_repeated_inserts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Repeated new keys are all inserted: the ids of rentals are not in the target."""
    rentals = _renamed(bookings_plan(raw_rentals(spark, sf_dir), time_zone="UTC"))
    return merge_rows(*_stored(spark, staged_bookings(spark, sf_dir), rentals), BOOKINGS_RULE)


@query
def bookings_merge_hot_inserts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One new key holds a third of the staged rows."""
    rentals = _renamed(bookings_plan(raw_rentals(spark, sf_dir, hot=True), time_zone="UTC"))
    sides = _stored(spark, staged_bookings(spark, sf_dir), rentals)
    return merge_rows(*sides, BOOKINGS_RULE, strategy="shuffle")


@query
def bookings_merge_hot_target(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One key holds a third of the target, and is staged once."""
    rentals = bookings_plan(raw_rentals(spark, sf_dir, hot=True), time_zone="UTC")
    sides = _stored(spark, rentals, staged_bookings(spark, sf_dir))
    return merge_rows(*sides, BOOKINGS_RULE, strategy="shuffle")


def _renamed(rentals: DataFrame) -> DataFrame:
    return rentals.withColumn("booking_id", F.concat(F.lit("R"), "booking_id"))


@query
def merge_number_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The target's keys are int, the staged ones bigint; the result has the target's type."""
    return _merged_orders(spark, sf_dir, "broadcast")


@query
def merge_number_keys_shuffle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _merged_orders(spark, sf_dir, "shuffle")


def _merged_orders(spark, sf_dir, strategy) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").cast("bigint").alias("order_key"), F.col("o_orderstatus").alias("status"), "o_totalprice"
    )
    key = F.col("order_key")
    target = orders.where(key % 3 != 0).withColumn("order_key", key.cast("int"))
    updates = orders.where(key % 2 == 0).withColumn("o_totalprice", F.lit(0.0))
    sides = _stored(spark, target, updates)
    return merge_rows(*sides, MergeRule("order_key", "F"), strategy=strategy, beyond_limit="shuffle")


@query
def merge_ambiguous_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ambiguous_keys(
        staged_bookings(spark, sf_dir), bookings_plan(raw_rentals(spark, sf_dir), time_zone="UTC"), BOOKINGS_RULE
    )


@query
def bookings_first_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _first_load(spark, staged_bookings(spark, sf_dir), "bookings")


@query
def customers_first_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _first_load(spark, staged_customers(spark, sf_dir), "customers")


def _first_load(spark, staged, name) -> DataFrame:
    target = f"{scratch_database(spark, scratch_dir(spark))}.{name}"
    publish(spark, write_snapshot(spark, staged, target))
    return spark.table(target)


# --- the daily run: JSON in, two days merged ---------------------------------


def _two_days(spark: SparkSession, sf_dir: str, retried: bool = False, **how) -> PipelineParams:
    folder = scratch_dir(spark)
    database = scratch_database(spark, folder)
    for day, date in ((1, "20241016"), (2, "20241017")):
        params = PipelineParams(
            date=date,
            path=f"{folder}/in/",
            staging_bookings_delta=f"{database}.staging_bookings",
            staging_customers_delta=f"{database}.staging_customers",
            bookings_delta_table=f"{database}.bookings",
            customers_delta_table=f"{database}.customers",
            as_of_date=AS_OF_DATE,
            time_zone="UTC",
            **how,
        )
        side_by_side(
            spark,
            lambda day=day, path=params.input_path("bookings"): write_json(raw_bookings(spark, sf_dir, day), path),
            lambda day=day, path=params.input_path("customers"): write_json(raw_customers(spark, sf_dir, day), path),
        )
        run_day(spark, params)
    if retried:
        run_day(spark, params)
    return params


@query
def run_day_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    params = _two_days(spark, sf_dir)
    return spark.sql(
        f"SELECT 'bookings' AS target, count(*) AS rows FROM {params.bookings_delta_table} "
        f"UNION ALL "
        f"SELECT 'customers' AS target, count(*) AS rows FROM {params.customers_delta_table}"
    )


@query
def run_day_bookings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.table(_two_days(spark, sf_dir).bookings_delta_table)


@query
def run_day_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.table(_two_days(spark, sf_dir).customers_delta_table)


@query
def run_day_bookings_in_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Targets in parts; a large merge of the parts that the second day touches."""
    params = _two_days(spark, sf_dir, parts=16, broadcast_limit_bytes=1000, split_arrays=True)
    return spark.table(params.bookings_delta_table)


@query
def run_day_bookings_in_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Staging and target in the same buckets."""
    params = _two_days(spark, sf_dir, buckets=8, broadcast_limit_bytes=1000)
    return spark.table(params.bookings_delta_table)


@query
def run_day_customers_retried(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The second day run twice, as after a lost driver; the second run leaves the targets alone."""
    return spark.table(_two_days(spark, sf_dir, retried=True, on_published="skip").customers_delta_table)


@query
def bookings_merge_filtered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A merge too large to broadcast, with the staged keys' filter on the target's keys."""
    return _merged_bookings(spark, sf_dir, broadcast_limit_bytes=FILTER_BYTES)


# --- mock feeds, numbered by the tables' keys --------------------------------


@query
def mock_bookings(spark: SparkSession, sf_dir: str) -> DataFrame:
    ids = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"))
    return mock.mock_bookings(ids)


@query
def mock_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    ids = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"))
    return mock.mock_customers(ids)


# --- inspection --------------------------------------------------------------


@query
def preview_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many rows the previews show; which rows is left open by design."""
    previews = [
        ("bookings", first_rows(raw_bookings(spark, sf_dir))),
        ("customers", first_rows(raw_customers(spark, sf_dir))),
        ("staged customers", first_rows(staged_customers(spark, sf_dir), 10)),
    ]
    sizes = [
        df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("preview"), "rows")
        for name, df in previews
    ]
    return sizes[0].union(sizes[1]).union(sizes[2])
