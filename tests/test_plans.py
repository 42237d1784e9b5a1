"""What the plans must and must not contain."""

from daybook.operators.clean import booking_stages, clean_bookings, funnel
from daybook.plans.staging import bookings_plan, customers_plan
from daybook.sources.json_files import read_bookings, read_customers, write_json
from tests.helpers import bookings, customers, plan


def test_staging_is_one_stage_on_the_jvm(spark, tmp_path):
    write_json(bookings(spark, {}), f"{tmp_path}/b.json")
    write_json(customers(spark, {}), f"{tmp_path}/c.json")
    for df in (
        bookings_plan(read_bookings(spark, f"{tmp_path}/b.json")),
        customers_plan(read_customers(spark, f"{tmp_path}/c.json")),
    ):
        text = plan(df, "simple")
        assert "Exchange" not in text
        assert "Python" not in text and "Arrow" not in text
        # Every operator above the scan is compiled.
        operators = [line for line in text.splitlines() if "Project [" in line or "Filter (" in line]
        assert operators and all("*(" in line for line in operators)


def test_status_list_reaches_the_scan(spark, tmp_path):
    write_json(bookings(spark, {}), f"{tmp_path}/b.json")
    text = plan(clean_bookings(read_bookings(spark, f"{tmp_path}/b.json")))
    assert "In(status, [cancelled,completed,pending])" in text
    assert "IsNotNull(booking_id)" in text


def test_cheap_tests_come_before_parsing(spark, tmp_path):
    bookings(spark, {}).write.parquet(f"{tmp_path}/b")
    text = plan(clean_bookings(spark.read.parquet(f"{tmp_path}/b")))
    condition = next(line for line in text.splitlines() if line.startswith("Condition"))
    assert condition.index("completed") < condition.index("gettimestamp")


def test_scan_reads_the_needed_columns(spark, tmp_path):
    bookings(spark, {}).write.parquet(f"{tmp_path}/b")
    df = bookings_plan(spark.read.parquet(f"{tmp_path}/b")).select("booking_id")
    schema = next(line for line in plan(df).splitlines() if line.startswith("ReadSchema"))
    assert "total_amount" not in schema


def test_funnel_is_one_pass(spark, tmp_path):
    bookings(spark, {}).write.parquet(f"{tmp_path}/b")
    text = plan(funnel(spark.read.parquet(f"{tmp_path}/b"), booking_stages()), "simple")
    assert text.count("FileScan") == 1
