"""Run a job: ``spark-submit ... -m daybook`` or ``python -m daybook day --date ...``."""

from __future__ import annotations

import argparse
import sys
from dataclasses import MISSING, asdict, fields, is_dataclass

from pyspark.sql import SparkSession

from daybook.params import PipelineParams
from daybook.plans.daily import check_and_merge, run_day
from daybook.plans.staging import show_preview, stage_bookings, stage_customers
from daybook.sources.json_files import write_json
from daybook.sources.mock import ids_from, mock_bookings, mock_customers

# Rows of a mock day, and the first id.
MOCK_BOOKINGS, MOCK_CUSTOMERS, MOCK_START = 175, 150, 176


def write_mock_day(spark: SparkSession, params: PipelineParams, preview=None) -> str:
    """Write the day's two feeds with made-up records; returns their folder."""
    bookings = mock_bookings(ids_from(spark, MOCK_START, MOCK_BOOKINGS))
    customers = mock_customers(ids_from(spark, MOCK_START, MOCK_CUSTOMERS))
    for entity, feed in (("bookings", bookings), ("customers", customers)):
        if preview:
            preview(f"mock {entity}", feed)
        write_json(feed, params.input_path(entity))
    return params.path


JOBS = {
    "bookings": stage_bookings,
    "customers": stage_customers,
    "merge": check_and_merge,
    "day": run_day,
    "mock": write_mock_day,
}


def parse(argv: list[str]) -> tuple[str, PipelineParams, bool]:
    parser = argparse.ArgumentParser(prog="daybook")
    parser.add_argument("job", choices=JOBS)
    parser.add_argument("--preview", action="store_true", help="print schemas and rows")
    for f in fields(PipelineParams):
        parser.add_argument(
            f"--{f.name}", required=f.default is MISSING, default=argparse.SUPPRESS
        )
    values = vars(parser.parse_args(argv))
    job, preview = values.pop("job"), values.pop("preview")
    return job, PipelineParams.from_mapping(values), preview


def main(argv: list[str] | None = None) -> None:
    job, params, preview = parse(sys.argv[1:] if argv is None else argv)
    spark = SparkSession.builder.appName(f"daybook-{job}").getOrCreate()
    result = JOBS[job](spark, params, show_preview() if preview else None)
    print(asdict(result) if is_dataclass(result) else result)


if __name__ == "__main__":
    main()
