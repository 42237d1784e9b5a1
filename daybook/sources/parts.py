"""Targets stored in parts, of which a day writes only those it touches.

A target in parts is a view over one of two slot tables, as any other target, but a
slot is partitioned by a hash of the merge key, and each of its partitions names the
folder where it is. A run writes the parts that hold staged keys, each into a new
folder, and makes the unused slot anew: touched parts name the new folders, all
others the folders they have in the slot in use. Then the view is repointed, so
readers see the old rows or the new ones. A part's folder is never written twice.

Folders that neither slot names are left behind by earlier runs, finished or killed;
the next run removes them first. So two states of each part are kept at most.
"""

from __future__ import annotations

import re
import uuid

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from daybook.sources.tables import (
    PART,
    SLOT_SUFFIXES,
    PublishError,
    Snapshot,
    current_slot,
    folder_of,
    quoted,
    row_count,
    table_exists,
    unused_slot,
)

_ROOT_SUFFIX = "__parts"
_PARTS_PROPERTY = "daybook.parts"
_PATTERN = re.compile(rf"^(.*/v-[0-9a-f]+/{PART}=(\d+))/[^/]+$")


def part_of(key: Column, parts: int) -> Column:
    """The part of a key; keys of one value and type share it, and rows without a key share one too."""
    return F.pmod(F.xxhash64(key), F.lit(parts)).cast("int")


def parts_in(spark: SparkSession, slot: str | None) -> int:
    """Into how many parts a slot is dealt; 0 for a plain table, or none."""
    if slot is None or not table_exists(spark, slot) or PART not in spark.table(slot).columns:
        return 0
    rows = spark.sql(f"SHOW TBLPROPERTIES {quoted(slot)}").collect()
    return int({r["key"]: r["value"] for r in rows}.get(_PARTS_PROPERTY, 0))


def part_folders(spark: SparkSession, slot: str | None) -> dict[int, str]:
    """Where the parts of a slot are; parts without rows are nowhere."""
    if not parts_in(spark, slot):
        return {}
    return _folders(spark.table(slot))


def touched_parts(target: DataFrame, updates: DataFrame, key: str, parts: int) -> list[int]:
    """The parts that hold a staged key, or would. At most ``parts`` numbers come to the driver."""
    stored_key = F.col(key).try_cast(target.schema[key].dataType)
    rows = updates.select(part_of(stored_key, parts).alias("part")).distinct().collect()
    return sorted(r["part"] for r in rows)


def read_parts(spark: SparkSession, slot: str, numbers: list[int]) -> DataFrame:
    """The rows of some parts; the others are not read."""
    return spark.table(slot).where(F.col(PART).isin(numbers)).drop(PART)


def write_parts(
    spark: SparkSession,
    df: DataFrame,
    target: str,
    key: str,
    parts: int,
    touched: list[int] | None = None,
) -> Snapshot:
    """Write ``df`` as the touched parts of ``target``'s unused slot, and verify the row count.

    The other parts stay where they are; None means that ``df`` is the whole target.
    A part of many rows is written by several tasks.
    """
    in_use, slot = current_slot(spark, target), unused_slot(spark, target)
    kept = part_folders(spark, in_use) if touched is not None else {}
    remove_unused(spark, target)
    root = folder_of(spark, target + _ROOT_SUFFIX)
    folder = f"{root}/v-{uuid.uuid4().hex}"
    written = Observation()
    dealt = df.withColumn(PART, part_of(F.col(key), parts)).hint("rebalance", PART)
    counted = dealt.observe(written, F.count(F.lit(1)).alias("rows"))
    counted.write.partitionBy(PART).parquet(folder)
    schema = counted.schema
    fresh = _folders(spark.read.schema(schema).parquet(folder))
    outside = set(fresh) - set(touched) if touched is not None else set()
    if outside:
        raise PublishError(f"{target}: rows of parts that are not touched: {sorted(outside)[:5]}")
    unchanged = {n: f for n, f in kept.items() if n not in set(touched or ())}
    _make(spark, slot, schema, f"{root}/none", parts, {**unchanged, **fresh})
    found = spark.table(slot).where(F.col(PART).isin(sorted(fresh))).count() if fresh else 0
    if found != written.get["rows"]:
        raise PublishError(f"{slot}: wrote {written.get['rows']} rows, found {found}")
    return Snapshot(target, slot, row_count(spark, slot))


def remove_unused(spark: SparkSession, target: str) -> None:
    """Delete the part folders that neither slot names."""
    root = folder_of(spark, target + _ROOT_SUFFIX)
    slots = [target + suffix for suffix in SLOT_SUFFIXES]
    named = {_path_of(f) for slot in slots for f in part_folders(spark, slot).values()}
    hadoop = spark._jvm.org.apache.hadoop.fs
    fs = hadoop.Path(root).getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(hadoop.Path(root)):
        return
    for version in fs.listStatus(hadoop.Path(root)):
        of_version = list(fs.listStatus(version.getPath())) if version.isDirectory() else []
        unused = [p for p in of_version if p.getPath().toUri().getPath() not in named]
        if len(unused) == len(of_version):
            fs.delete(version.getPath(), True)
        else:
            for part in unused:
                if part.isDirectory():
                    fs.delete(part.getPath(), True)


def _path_of(folder: str) -> str:
    """A folder without scheme and host."""
    return re.sub(r"^[a-z0-9+.-]+:(//[^/]*)?", "", folder)


def _folders(df: DataFrame) -> dict[int, str]:
    found = (_PATTERN.match(f) for f in df.inputFiles())
    return {int(m[2]): m[1] for m in found if m}


def _make(spark: SparkSession, slot: str, schema, nowhere: str, parts: int, folders: dict[int, str]) -> None:
    """The slot table with its parts; what it was before goes, files stay."""
    spark.sql(f"DROP TABLE IF EXISTS {quoted(slot)}")
    columns = ", ".join(f"{_quoted_column(f.name)} {f.dataType.simpleString()}" for f in schema)
    spark.sql(
        f"CREATE TABLE {quoted(slot)} ({columns}) USING parquet PARTITIONED BY ({PART}) "
        f"LOCATION '{_literal(nowhere)}' TBLPROPERTIES ('{_PARTS_PROPERTY}' = '{parts}')"
    )
    if folders:
        places = " ".join(f"PARTITION ({PART} = {n}) LOCATION '{_literal(f)}'" for n, f in sorted(folders.items()))
        spark.sql(f"ALTER TABLE {quoted(slot)} ADD {places}")


def _quoted_column(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _literal(text: str) -> str:
    return text.replace("\\", "\\\\").replace("'", "\\'")
