"""Catalog tables: staging, targets, and publishing a target.

A target in snapshot mode is a view over one of two slot tables. A run writes
the slot the view does not use, verifies it, and then repoints the view, which
is a single catalog change. A run that dies earlier leaves the view as it was,
and the next run overwrites the unfinished slot: every table has a fixed folder
below its database, so files without a catalog entry are overwritten too. Readers
see the old rows or the new ones, never a mix. Two copies are kept; an adopted
table is a third one until the publish after the first, which drops it (the files
of an adopted external table are not the catalog's, and stay).
"""

from __future__ import annotations

import hashlib
import json
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

SLOT_SUFFIXES = ("__a", "__b")
ADOPTED_SUFFIX = "__adopted"
SLOT_PROPERTY = "daybook.slot"
DAY_PROPERTY = "daybook.day"
METRICS_PROPERTY = "daybook.metrics"
FILES_PROPERTY = "daybook.files"
#: The column that a slot stored in parts is partitioned by; targets do not show it.
PART = "__part"


class PublishError(RuntimeError):
    """A target could not be written or repointed."""


def quoted(name: str) -> str:
    """A possibly multi-part table name, safe to put into SQL text."""
    return ".".join(f"`{part.replace('`', '``')}`" for part in name.split("."))


def table_exists(spark: SparkSession, name: str) -> bool:
    return spark.catalog.tableExists(name)


def read_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.read.table(name)


def overwrite_table(
    df: DataFrame, name: str, table_format: str = "parquet", buckets: int = 0, key: str | None = None
) -> None:
    """Replace the contents of ``name`` (S6), whatever an earlier run left in its folder.

    With ``buckets`` the rows are stored in so many hash buckets of ``key``, sorted by it.
    """
    writer = df.write.format(table_format).mode("overwrite").option("path", folder_of(df.sparkSession, name))
    if buckets:
        writer = writer.bucketBy(buckets, key).sortBy(key)
    writer.saveAsTable(name)


def create_table(df: DataFrame, name: str, table_format: str = "parquet") -> None:
    """Create a table that the catalog manages, for formats that commit by themselves."""
    df.write.format(table_format).saveAsTable(name)


def folder_of(spark: SparkSession, name: str) -> str:
    """The table's folder below its database."""
    *database, table = name.split(".")
    database = ".".join(database) or spark.catalog.currentDatabase()
    return f"{spark.catalog.getDatabase(database).locationUri.rstrip('/')}/{table.lower()}"


def row_count(spark: SparkSession, name: str) -> int:
    """Number of rows (A2); no column is read."""
    return spark.table(name).count()


def current_slot(spark: SparkSession, name: str) -> str | None:
    """The table a target's view reads; None for an absent or plain table."""
    if not table_exists(spark, name) or not _is_view(spark, name):
        return None
    slot = _properties(spark, name).get(SLOT_PROPERTY)
    if slot is None:
        raise PublishError(f"{name} is a view this library did not create")
    return slot


def unused_slot(spark: SparkSession, target: str) -> str:
    """The slot that the target's view does not read."""
    in_use = current_slot(spark, target)
    return next(target + s for s in SLOT_SUFFIXES if target + s != in_use)


def published_day(spark: SparkSession, name: str) -> str | None:
    """The day whose rows were merged into a target last; None if it does not say."""
    if not table_exists(spark, name) or not _is_view(spark, name):
        return None
    return _properties(spark, name).get(DAY_PROPERTY)


def _properties(spark: SparkSession, name: str) -> dict[str, str]:
    rows = spark.sql(f"SHOW TBLPROPERTIES {quoted(name)}").collect()
    return {r["key"]: r["value"] for r in rows}


def adopt(spark: SparkSession, name: str) -> None:
    """Turn an existing plain table into a target: rename it, put a view over it.

    Called before every merge. If a run died between the two steps, the renamed
    table is found again, so its rows are not mistaken for a missing target.
    """
    adopted = name + ADOPTED_SUFFIX
    if table_exists(spark, name):
        if _is_view(spark, name):
            return
        # The new name stays in the catalog of the old one and must not repeat it.
        renamed = adopted.split(".", 1)[1] if adopted.count(".") > 1 else adopted
        spark.sql(f"ALTER TABLE {quoted(name)} RENAME TO {quoted(renamed)}")
    elif not table_exists(spark, adopted):
        return
    _point(spark, name, adopted)


@dataclass(frozen=True)
class Snapshot:
    """A finished, verified slot that its target does not use yet."""

    target: str
    slot: str
    rows: int
    #: Counts over its rows, for whoever checks them.
    metrics: dict[str, int] | None = None


def write_snapshot(
    spark: SparkSession,
    df: DataFrame,
    target: str,
    table_format: str = "parquet",
    buckets: int = 0,
    key: str | None = None,
) -> Snapshot:
    """Write ``df`` to the unused slot of ``target`` and verify its row count.

    With ``buckets``, later merges by ``key`` do not shuffle the target. The rows are
    dealt by bucket first, so that there is one file for each.
    """
    slot = unused_slot(spark, target)
    written = Observation()
    dealt = df.repartition(buckets, key) if buckets else df
    counted = dealt.observe(written, F.count(F.lit(1)).alias("rows"))
    overwrite_table(counted, slot, table_format, buckets, key)
    rows = row_count(spark, slot)
    if rows != written.get["rows"]:
        raise PublishError(f"{slot}: wrote {written.get['rows']} rows, found {rows}")
    return Snapshot(target, slot, rows)


def publish(spark: SparkSession, *snapshots: Snapshot, day: str | None = None) -> None:
    """Repoint every target to its snapshot; on failure repoint those done back.

    A target remembers ``day`` and the snapshot's metrics from the same catalog change
    that repoints it.
    """
    done: list[tuple[str, dict[str, str]]] = []
    try:
        for snapshot in snapshots:
            before = {}
            if current_slot(spark, snapshot.target) is not None:
                before = _properties(spark, snapshot.target)
            _point(spark, snapshot.target, snapshot.slot, _notes(spark, snapshot, day))
            done.append((snapshot.target, before))
    except Exception:
        for target, before in reversed(done):
            if not before:
                spark.sql(f"DROP VIEW IF EXISTS {quoted(target)}")
            else:
                notes = {k: v for k, v in before.items() if k in (DAY_PROPERTY, METRICS_PROPERTY, FILES_PROPERTY)}
                _point(spark, target, before[SLOT_PROPERTY], notes)
        raise
    for target, before in done:
        if before.get(SLOT_PROPERTY, "").endswith(SLOT_SUFFIXES):
            # Both slots are live now.
            spark.sql(f"DROP TABLE IF EXISTS {quoted(target + ADOPTED_SUFFIX)}")


def _notes(spark: SparkSession, snapshot: Snapshot, day: str | None) -> dict[str, str]:
    notes = {} if day is None else {DAY_PROPERTY: day}
    if snapshot.metrics is not None:
        notes[METRICS_PROPERTY] = json.dumps(snapshot.metrics)
        notes[FILES_PROPERTY] = _files(spark, snapshot.slot)
    return notes


def _files(spark: SparkSession, table: str) -> str:
    """A digest of the names of a table's files; no file is read."""
    return hashlib.sha256("\n".join(sorted(spark.table(table).inputFiles())).encode()).hexdigest()


def written_metrics(spark: SparkSession, name: str) -> dict[str, int] | None:
    """The metrics taken when a table's rows were written; None if it has none, or other files by now."""
    slot = current_slot(spark, name)
    if slot is None:
        return None
    noted = _properties(spark, name)
    if METRICS_PROPERTY not in noted or noted.get(FILES_PROPERTY) != _files(spark, slot):
        return None
    return json.loads(noted[METRICS_PROPERTY])


def _is_view(spark: SparkSession, name: str) -> bool:
    return spark.catalog.getTable(name).tableType == "VIEW"


def _point(spark: SparkSession, name: str, slot: str, notes: dict[str, str] | None = None) -> None:
    def literal(text: str) -> str:
        return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"

    properties = {SLOT_PROPERTY: slot} | (notes or {})
    listed = ", ".join(f"{literal(k)} = {literal(v)}" for k, v in properties.items())
    hidden = f" EXCEPT ({PART})" if PART in spark.table(slot).columns else ""
    spark.sql(
        f"CREATE OR REPLACE VIEW {quoted(name)} "
        f"TBLPROPERTIES ({listed}) "
        f"AS SELECT *{hidden} FROM {quoted(slot)}"
    )
