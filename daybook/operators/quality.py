"""Declarative quality checks.

All constraints of all checks on a table become one aggregate over it, so a
table is scanned once however many constraints there are.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from enum import Enum
from functools import cached_property, reduce

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

SUCCESS = "Success"


class QualityError(ValueError):
    """A quality gate did not pass."""


class CheckLevel(Enum):
    WARNING = "Warning"
    ERROR = "Error"


# Worst status of a run wins.
_SEVERITY = [SUCCESS, CheckLevel.WARNING.value, CheckLevel.ERROR.value]


@dataclass(frozen=True)
class Constraint:
    """A label, which rows comply (None: the table size), and the assertion.

    Columns are built on use: a check may be declared before a session exists.
    """

    label: str
    compliant: Callable[[], Column] | None
    holds: Callable[[Column], Column]


@dataclass(frozen=True)
class Check:
    """A named group of constraints; the methods return an extended check."""

    level: CheckLevel
    name: str
    constraints: tuple[Constraint, ...] = field(default=())

    def _with(self, label, compliant, holds) -> Check:
        added = Constraint(label, compliant, holds)
        return Check(self.level, self.name, (*self.constraints, added))

    def has_size(self, assertion: Callable[[Column], Column]) -> Check:
        """The row count, given to ``assertion`` as a column, satisfies it."""
        return self._with("Size", None, assertion)

    def is_complete(self, column: str) -> Check:
        """No value is null."""
        return self._with(
            f"Completeness({column})",
            lambda: F.col(column).isNotNull(),
            lambda v: v == 1.0,
        )

    def is_non_negative(self, column: str) -> Check:
        """Every value is zero or more; null counts as zero."""
        return self._with(
            f"NonNegative({column})",
            lambda: F.coalesce(F.col(column), F.lit(0)) >= 0,
            lambda v: v == 1.0,
        )


_RESULT = (
    "check string, check_level string, check_status string, "
    "constraint string, constraint_status string, constraint_message string"
)


def metrics(*checks: Check) -> dict[str, Column]:
    """The counts that the checks need, by label: aggregates over the table's rows.

    They may ride on any job that sees the rows once, such as the write of the table.
    """
    # Constraints that look at the same rows share their count.
    counts = {"rows": F.count(F.lit(1))}
    for c in (c for check in checks for c in check.constraints):
        if c.compliant is not None and c.label not in counts:
            counts[c.label] = F.count_if(c.compliant())
    return counts


def verify(df: DataFrame, *checks: Check) -> DataFrame:
    """One row per constraint: check, check_level, check_status, constraint,
    constraint_status, constraint_message.

    A fraction over an empty table is null, and null counts as failed. Checks without
    constraints give no rows, and pass.
    """
    return judge(df.agg(*[count.alias(label) for label, count in metrics(*checks).items()]), *checks)


def judge(totals: DataFrame, *checks: Check) -> DataFrame:
    """The same rows from the one row of ``metrics`` of a table."""
    tests = [(i, c) for i, check in enumerate(checks) for c in check.constraints]
    if not tests:
        return totals.sparkSession.createDataFrame([], _RESULT)
    size = F.col("rows")
    values, passed = [], []
    for n, (_, c) in enumerate(tests):
        value = size if c.compliant is None else F.try_divide(F.col(f"`{c.label}`"), size)
        values.append(value.cast("double").alias(f"value{n}"))
        passed.append(F.coalesce(c.holds(value), F.lit(False)).alias(f"ok{n}"))
    statuses = []
    for i, check in enumerate(checks):
        all_passed = reduce(
            Column.__and__, [F.col(f"ok{n}") for n, (j, _) in enumerate(tests) if i == j], F.lit(True)
        )
        statuses.append(F.when(all_passed, SUCCESS).otherwise(check.level.value).alias(f"status{i}"))
    measured = totals.select(*values, *passed).select("*", *statuses)

    # One array per result column, then one row per position.
    rows = measured.select(
        F.inline(
            F.arrays_zip(
                F.lit([checks[i].name for i, _ in tests]).alias("check"),
                F.lit([checks[i].level.value for i, _ in tests]).alias("check_level"),
                F.array(*[f"status{i}" for i, _ in tests]).alias("check_status"),
                F.lit([c.label for _, c in tests]).alias("constraint"),
                F.array(*[f"ok{n}" for n in range(len(tests))]).alias("ok"),
                F.array(*[f"value{n}" for n in range(len(tests))]).alias("value"),
            )
        )
    )
    problem = F.concat(
        F.lit("Value: "),
        F.coalesce(F.col("value").cast("string"), F.lit("none")),
        F.lit(" does not meet the constraint requirement!"),
    )
    return rows.select(
        "check",
        "check_level",
        "check_status",
        "constraint",
        F.when(F.col("ok"), SUCCESS).otherwise("Failure").alias("constraint_status"),
        F.when(F.col("ok"), "").otherwise(problem).alias("constraint_message"),
    )


def roll_up(results: DataFrame) -> DataFrame:
    """The status of a run, worst check first: one row, column status."""
    rank = reduce(
        lambda tested, name: tested.when(F.col("check_status") == name, _SEVERITY.index(name)),
        _SEVERITY[1:],
        F.when(F.col("check_status") == SUCCESS, 0),
    )
    names = F.array(*[F.lit(name) for name in _SEVERITY])
    return results.agg(F.get(names, F.coalesce(F.max(rank), F.lit(0))).alias("status"))


class Verification:
    """The results of a verified table, computed once when first needed.

    Only the constraint rows reach the driver, and there are as many as the
    checks declare. ``measured`` are the metrics of the same rows, taken when they were
    written; if they have all counts the checks need, the table is not read.
    """

    def __init__(self, df: DataFrame, *checks: Check, measured: dict[str, int] | None = None):
        labels = list(metrics(*checks))
        if measured is not None and set(labels) <= set(measured):
            schema = StructType([StructField(label, LongType()) for label in labels])
            row = tuple(int(measured[label]) for label in labels)
            self.results = judge(df.sparkSession.createDataFrame([row], schema), *checks)
        else:
            self.results = verify(df, *checks)

    @cached_property
    def rows(self) -> list[Row]:
        return self.results.collect()

    @property
    def status(self) -> str:
        return max((r["check_status"] for r in self.rows), key=_SEVERITY.index, default=SUCCESS)

    @property
    def failures(self) -> list[Row]:
        return [r for r in self.rows if r["constraint_status"] != SUCCESS]


def require_passed(verification: Verification, subject: str) -> None:
    """Stop the run unless every check passed."""
    if verification.status != SUCCESS:
        details = "; ".join(
            f"{r['constraint']}: {r['constraint_message']}" for r in verification.failures
        )
        raise QualityError(f"Quality checks failed for {subject}: {details}")


# The gate of the daily run.
BOOKINGS_CHECK = (
    Check(CheckLevel.ERROR, "Quality check on bookings")
    .has_size(lambda rows: rows > 0)
    .is_complete("booking_id")
    .is_complete("customer_id")
    .is_complete("car_id")
    .is_complete("booking_date")
    .is_complete("status")
    .is_non_negative("total_amount")
    .is_complete("start_date")
    .is_complete("starting_time")
    .is_complete("end_date")
    .is_complete("ending_time")
    .is_non_negative("total_duration")
)
CUSTOMERS_CHECK = (
    Check(CheckLevel.ERROR, "Quality check on customers")
    .has_size(lambda rows: rows > 0)
    .is_complete("customer_id")
    .is_complete("name")
    .is_complete("email")
    .is_complete("signup_date")
    .is_complete("phone_number")
    .is_complete("status")
    .is_non_negative("tenure_in_days")
)
