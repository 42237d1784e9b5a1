"""Job parameters."""

from __future__ import annotations

import re
from collections.abc import Mapping
from dataclasses import dataclass, fields

# The text layouts of the feed.
DATE_TIME_FORMAT = "yyyy-MM-dd'T'HH:mm:ss'Z'"
DATE_FORMAT = "yyyy-MM-dd"

# Updates whose measured size stays below this may be broadcast in the merge.
BROADCAST_LIMIT_BYTES = 64 * 1024 * 1024

_TRUE = {"true", "1", "yes"}
_FALSE = {"false", "0", "no"}


@dataclass(frozen=True)
class PipelineParams:
    """One run of the pipeline.

    ``date`` and ``path`` pick the day's input; they have no default, so that a
    run never quietly reads an old day. The other fields follow the job's own
    parameter names, then come the switches this library adds.
    """

    date: str
    path: str
    date_time_format: str = DATE_TIME_FORMAT
    staging_bookings_delta: str = "default.staging_bookings_delta"
    staging_customers_delta: str = "default.staging_customers_delta"
    bookings_delta_table: str = "default.bookings_delta"
    customers_delta_table: str = "default.customers_delta"
    # Text before the entity in a file name: "<prefix>bookings_20241017.json".
    file_prefix: str = ""
    # Reads pretty-printed files; such files are not splittable.
    multi_line: bool = False
    # Reads arrays of flat records by many tasks, however long a line is.
    split_arrays: bool = False
    # End date of the customer tenure; None means the day of the run.
    as_of_date: str | None = None
    # Zone the time texts are read in; None means the session's zone.
    time_zone: str | None = None
    table_format: str = "parquet"
    # "snapshot" rewrites the target and repoints its name; "row_level" uses the
    # table format's own MERGE (needs a format that has one).
    target_mode: str = "snapshot"
    broadcast_limit_bytes: int = BROADCAST_LIMIT_BYTES
    # Snapshots are stored in so many hash buckets of the merge key, and the target is
    # then not shuffled by a merge; 0 stores them as they come. A bucket is read by one
    # task, so this is for keys that are unique, or nearly so.
    buckets: int = 0
    # Snapshots are stored in so many parts by a hash of the merge key, and a day writes only
    # the parts that hold its keys; 0 writes the whole target. Not together with buckets.
    parts: int = 0
    # What a run does with a target that says it holds this day already: "merge" again (which
    # deletes and updates again), "skip" the target, or "refuse" the run.
    on_published: str = "merge"

    def __post_init__(self):
        if not re.fullmatch(r"\d{8}", self.date):
            raise ValueError(f"date must be yyyyMMdd, got {self.date!r}")
        if self.target_mode not in ("snapshot", "row_level"):
            raise ValueError(f"unknown target_mode {self.target_mode!r}")
        if self.split_arrays and self.multi_line:
            raise ValueError("split_arrays reads records over several lines by itself")
        if self.on_published not in ("merge", "skip", "refuse"):
            raise ValueError(f"unknown on_published {self.on_published!r}")
        if self.parts and (self.buckets or self.table_format != "parquet"):
            raise ValueError("parts are parquet, and not bucketed")
        if self.on_published != "merge" and self.target_mode != "snapshot":
            raise ValueError("only snapshots say which day they hold")

    @classmethod
    def from_mapping(cls, values: Mapping[str, str]) -> PipelineParams:
        """Build from string key/values, as a job definition passes them."""
        known = {f.name: f.type for f in fields(cls)}
        unknown = sorted(set(values) - set(known))
        if unknown:
            raise ValueError(f"unknown parameters: {', '.join(unknown)}")
        return cls(**{k: _parse(known[k], k, v) for k, v in values.items()})

    def input_path(self, entity: str) -> str:
        """The day's file of one entity (S3)."""
        name = f"{self.file_prefix}{entity}_{self.date}.json"
        return f"{self.path.rstrip('/')}/{name}" if self.path else name


def _parse(kind: str, name: str, value):
    if not isinstance(value, str):
        return value
    if kind == "int":
        return int(value)
    if kind == "bool":
        lowered = value.strip().lower()
        if lowered in _TRUE | _FALSE:
            return lowered in _TRUE
        raise ValueError(f"{name} must be true or false, got {value!r}")
    return value
