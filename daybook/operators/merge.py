"""Keyed merge of a day's staged rows into a target.

The merge is a DataFrame of the target's new contents. Staged rows are brought to
the target's types and counted per key first, then both ways of computing it do
the same:

* the target is left-joined to the staged rows, and the staged rows whose key it
  does not hold are added. Rows without a key match nothing on either side, and
  take part in no join;
* keys that several staged rows carry are asked for in the target before anything
  is written. If one meets a row that would change, the merge is refused; if
  not, its rows are inserted or do nothing, and the target's rows are not joined to
  them. The keys of a large merge that are staged once are then asked for too, so that
  the wide rows are shuffled only if the target holds some. Without
  such keys, the usual case, nothing is asked and nothing is stored.

Staged rows that are small enough, by measure, are broadcast, and the target is
not shuffled. Otherwise both sides are shuffled by key, or the staged side alone
if the target is bucketed by it; if the staged side is too, neither is. Which keys
the target holds is read from its key column: keys are reduced to one a task before
they are shuffled, and a bitmap of the staged keys' hashes, of fixed size, leaves out
nearly all that are not staged.

Joins in which a key of the target may be hot are left outer or inner by the target's
rows with the exchanges right below, so adaptive execution splits them over tasks;
the other side holds a key once. No list of hot keys is needed.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    BinaryType,
    BooleanType,
    DataType,
    DatetimeType,
    NumericType,
    StringType,
)

from daybook.params import BROADCAST_LIMIT_BYTES
from daybook.scratch import stored

_MATCHED, _NEW = "__matched", "__new_"
_COPIES, _BYTES, _ACTS = "__copies", "__bytes", "__acts"
_WORD, _BIT, _BITS = "__word", "__bit", "__bits"

#: Rows of 64 bits in the filter of staged keys, what they take in a hash table, and
#: the staged rows up to which the filter lets few others pass.
FILTER_WORDS = 1 << 18
FILTER_BYTES = FILTER_WORDS * 64
FILTER_KEYS = 1 << 22


class AmbiguousMergeError(ValueError):
    """Several staged rows would change the same target row."""


@dataclass(frozen=True)
class MergeRule:
    """Key, and the status that deletes a matched row.

    ``delete_on="target"``: the status the row has in the target before the merge
    decides, so a row that turns into the delete status stays until it is matched
    again. ``delete_on="incoming"``: the staged status decides.
    """

    key: str
    delete_status: str
    delete_on: str = "target"
    status: str = "status"

    def __post_init__(self):
        if self.delete_on not in ("target", "incoming"):
            raise ValueError(f"unknown delete_on {self.delete_on!r}")


BOOKINGS_RULE = MergeRule("booking_id", "cancelled")
CUSTOMERS_RULE = MergeRule("customer_id", "inactive")


@dataclass(frozen=True)
class UpdateProfile:
    """Measured facts about the staged rows."""

    rows: int
    bytes: int | None
    repeated_keys: int
    null_keys: int


def profile_updates(updates: DataFrame, key: str) -> UpdateProfile:
    """Row count, an upper bound of the size in memory, repeated and null keys.

    One aggregate, combined per key before the shuffle. The size is None if a
    column's type has no simple bound.
    """
    return _totals(_per_key(updates, key), key)


def _per_key(updates: DataFrame, key: str) -> DataFrame:
    size = _row_bytes(updates)
    return updates.groupBy(key).agg(
        F.count(F.lit(1)).alias(_COPIES),
        F.sum(size if size is not None else F.lit(None).cast("long")).alias(_BYTES),
    )


def _totals(per_key: DataFrame, key: str) -> UpdateProfile:
    copies, null = F.col(_COPIES), F.col(key).isNull()
    total = per_key.agg(
        F.coalesce(F.sum(copies), F.lit(0)).alias("rows"),
        F.sum(_BYTES).alias("bytes"),
        F.count_if((copies > 1) & ~null).alias("repeated"),
        F.coalesce(F.sum(F.when(null, copies)), F.lit(0)).alias("nulls"),
    ).first()
    known = 0 if total["rows"] == 0 else total["bytes"]
    return UpdateProfile(total["rows"], known, total["repeated"], total["nulls"])


def repeated_keys(updates: DataFrame, key: str) -> DataFrame:
    """Keys that more than one staged row carries: columns key, copies."""
    return (
        updates.filter(F.col(key).isNotNull())
        .groupBy(key)
        .agg(F.count(F.lit(1)).alias("copies"))
        .filter(F.col("copies") > 1)
    )


def ambiguous_keys(target: DataFrame, updates: DataFrame, rule: MergeRule) -> DataFrame:
    """Repeated staged keys that meet a target row the merge would change (M6).

    When the incoming status decides, a repeated key may not meet any target row.
    """
    staged = _storable(updates.select(rule.key), target, rule.key)
    if rule.delete_on == "target":
        target = target.filter(F.col(rule.status).isNotNull())
    met = target.select(rule.key).join(repeated_keys(staged, rule.key), rule.key)
    return met.distinct()


def merge_rows(
    target: DataFrame,
    updates: DataFrame,
    rule: MergeRule,
    strategy: str = "auto",
    broadcast_limit_bytes: int = BROADCAST_LIMIT_BYTES,
    beyond_limit: str = "raise",
) -> DataFrame:
    """The target's contents after merging ``updates`` into it.

    Matched rows take every staged column but the key; target columns that are
    not staged keep their value, and are null in inserted rows. Null keys match
    nothing. The result has the target's columns and types; a staged key that
    the target's key type cannot hold raises.

    ``auto`` measures the staged rows and broadcasts them if they stay below the
    limit; ``broadcast`` raises if they do not, or shuffles them if ``beyond_limit``
    is ``shuffle``; ``shuffle`` never broadcasts anything. The result is the same. A merge with repeated keys writes these, and a
    large one the staged rows that change the target, to scratch tables; it raises before anything
    else is written if a target row would be changed twice. ``updates`` is read
    several times: pass a table.
    """
    if strategy not in ("auto", "broadcast", "shuffle"):
        raise ValueError(f"unknown strategy {strategy!r}")
    if beyond_limit not in ("raise", "shuffle"):
        raise ValueError(f"unknown beyond_limit {beyond_limit!r}")
    unknown = [c for c in updates.columns if c not in target.columns]
    if unknown:
        raise ValueError(f"staged columns missing in the target: {', '.join(unknown)}")

    key = rule.key
    updates = _storable(updates, target, key)
    per_key = _per_key(updates, key)
    profile = _totals(per_key, key)
    fits = profile.bytes is not None and profile.bytes <= broadcast_limit_bytes
    if strategy == "broadcast" and not fits and beyond_limit == "raise":
        raise ValueError(f"staged rows of {profile.bytes} bytes exceed {broadcast_limit_bytes}")
    small = fits and strategy != "shuffle"
    place = F.broadcast if small else lambda side: side

    acting, added = updates.filter(F.col(key).isNotNull()), []
    if profile.null_keys:
        added.append(updates.filter(F.col(key).isNull()))
    filtered = strategy != "shuffle" and not small and profile.rows <= FILTER_KEYS
    filtered = filtered and FILTER_BYTES <= broadcast_limit_bytes

    def held(staged: DataFrame) -> DataFrame:
        """The target's keys, at least those that are staged."""
        if filtered:
            return _possible(target.select(key), staged.select(key), key)
        if small:
            return target.select(key).join(F.broadcast(staged.select(key)), key, "left_semi")
        return target.select(key)

    if profile.repeated_keys:
        repeated = stored(per_key.filter((F.col(_COPIES) > 1) & F.col(key).isNotNull()).select(key))
        met = _met(target, repeated, rule, small)
        _reject_ambiguous(met.filter(_ACTS), key)
        # A repeated key may still meet target rows without a status. They are
        # not changed, and the key is not new, so its staged rows do nothing.
        if small:
            new = repeated.join(F.broadcast(met.select(key)), key, "left_anti")
            added.append(updates.join(F.broadcast(new), key, "left_semi"))
            acting = acting.join(F.broadcast(repeated), key, "left_anti")
        else:
            # Which keys are held is settled by the keys alone. Staged rows are shuffled to set those
            # of held keys apart, and once more to leave these out; neither if no key is held.
            once = per_key.filter((F.col(_COPIES) == 1) & F.col(key).isNotNull()).select(key)
            met_once = stored(held(once).distinct().join(once, key, "left_semi"))
            known = met.select(key).unionByName(met_once)
            added.append(acting if known.isEmpty() else acting.join(known, key, "left_anti"))
            none = met_once.isEmpty()
            kept = target if none else _apply(target, stored(acting.join(met_once, key, "left_semi")), rule, place)
            return _united(target, kept, added)
    added.append(acting.join(place(held(acting).distinct()), key, "left_anti"))
    return _united(target, _apply(target, acting, rule, place), added)


def _united(target: DataFrame, kept: DataFrame, added: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, [_like(rows, target) for rows in added], kept)


def _met(target, repeated, rule: MergeRule, small: bool) -> DataFrame:
    """The repeated keys that the target holds, once each, and whether a row would change.

    Reads the target's key and status. Large matches are stored before they are
    combined per key: an aggregate right above the join would keep its partitions
    together, and so a hot key in one task.
    """
    key = rule.key
    acts = F.col(rule.status).isNotNull() if rule.delete_on == "target" else F.lit(True)
    matches = target.select(key, acts.alias(_ACTS)).join(F.broadcast(repeated) if small else repeated, key)
    each = (matches if small else stored(matches)).groupBy(key).agg(F.bool_or(_ACTS).alias(_ACTS))
    return stored(each)


def _possible(held: DataFrame, staged: DataFrame, key: str) -> DataFrame:
    """The rows of ``held`` whose key may be staged: all that are, and few others.

    A bit is set for each staged key, 64 of them to a broadcast row, FILTER_WORDS rows at most.
    """

    def word(df: DataFrame) -> Column:
        return F.xxhash64(df[key]).bitwiseAND(F.lit(FILTER_WORDS - 1)).alias(_WORD)

    def bit(df: DataFrame) -> Column:
        # Other bits of the hash than those that choose the word.
        return F.shiftrightunsigned(F.xxhash64(df[key]), 58).cast("int").alias(_BIT)

    words = (
        staged.select(word(staged), bit(staged))
        .groupBy(_WORD)
        .agg(F.bit_or(F.expr(f"shiftleft(1L, {_BIT})")).alias(_BITS))
    )
    probed = held.select(key, word(held), bit(held)).join(F.broadcast(words), _WORD)
    return probed.filter(F.expr(f"getbit({_BITS}, {_BIT}) = 1")).select(key)


def _storable(updates: DataFrame, target: DataFrame, key: str) -> DataFrame:
    """Staged columns in the target's types; a key that does not fit raises."""
    types = {f.name: f.dataType for f in target.schema}

    def value(c: str) -> Column:
        column = F.col(c)
        if updates.schema[c].dataType == types[c]:
            return column
        if c != key:
            return column.cast(types[c]).alias(c)
        problem = F.concat(F.lit(f"{c} does not fit the target's type: "), column.cast("string"))
        fitted = F.coalesce(column.try_cast(types[c]), F.raise_error(problem).cast(types[c]))
        return F.when(column.isNotNull(), fitted).alias(c)

    return updates.select(*[value(c) for c in updates.columns])


def merge_into(updates: DataFrame, target_name: str, rule: MergeRule) -> None:
    """The same merge through the table format's own MERGE.

    For catalogs with row-level operations: only the files that hold matched
    rows are rewritten, and the format itself rejects ambiguous matches.
    """
    def of(side: str, column: str) -> Column:
        return F.col(f"`{side}`.`{column}`")

    tgt, upd = target_name.split(".")[-1], "upd"
    decides = of(tgt if rule.delete_on == "target" else upd, rule.status)
    values = {c: of(upd, c) for c in updates.columns}
    changes = {c: v for c, v in values.items() if c != rule.key}
    (
        updates.alias(upd)
        .mergeInto(target_name, of(tgt, rule.key) == of(upd, rule.key))
        .whenMatched(decides != rule.delete_status)
        .update(changes)
        .whenMatched(decides == rule.delete_status)
        .delete()
        .whenNotMatched()
        .insert(values)
        .merge()
    )


def _as_new(updates: DataFrame, key: str) -> DataFrame:
    """Staged rows under names that cannot clash, with a presence marker.

    The marker tells a missing match from a match with null columns.
    """
    renamed = [F.col(c).alias(c if c == key else _NEW + c) for c in updates.columns]
    return updates.select(*renamed, F.lit(True).alias(_MATCHED))


def _apply(target, updates, rule: MergeRule, place) -> DataFrame:
    """Every target row, updated, deleted or left alone."""
    joined = target.join(place(_as_new(updates, rule.key)), rule.key, "left_outer")
    matched = F.coalesce(F.col(_MATCHED), F.lit(False))
    prefix = "" if rule.delete_on == "target" else _NEW
    decides = F.col(prefix + rule.status)
    # A null status makes both tests unknown: the row is neither updated nor deleted.
    deleted = matched & F.coalesce(decides == rule.delete_status, F.lit(False))
    updated = matched & F.coalesce(decides != rule.delete_status, F.lit(False))

    def value(c: str) -> Column:
        if c == rule.key or c not in updates.columns:
            return F.col(c)
        return F.when(updated, F.col(_NEW + c)).otherwise(F.col(c)).alias(c)

    return joined.filter(~deleted).select(*[value(c) for c in target.columns])


def _like(updates: DataFrame, target: DataFrame) -> DataFrame:
    """Staged rows in the target's columns and types."""
    return updates.select(
        *[
            (F.col(f.name) if f.name in updates.columns else F.lit(None))
            .cast(f.dataType)
            .alias(f.name)
            for f in target.schema
        ]
    )


def _reject_ambiguous(conflicts: DataFrame, key: str) -> None:
    sample = conflicts.limit(5).collect()
    if sample:
        keys = ", ".join(str(r[key]) for r in sample)
        raise AmbiguousMergeError(
            f"several staged rows match one target row; {key} such as: {keys}"
        )


def _row_bytes(df: DataFrame) -> Column | None:
    """Upper bound of a row's size in Spark's row format; None if there is none."""
    sizes = [_value_bytes(f.name, f.dataType) for f in df.schema]
    if any(size is None for size in sizes):
        return None
    # Row header, null bits, and the pointers a hash table adds.
    fixed = F.lit(64 + 8 * ((len(sizes) + 63) // 64)).cast("long")
    return reduce(Column.__add__, sizes, fixed)


def _value_bytes(name: str, dtype: DataType) -> Column | None:
    if isinstance(dtype, (StringType, BinaryType)):
        # Eight bytes of offset and length, then the text padded to eight bytes.
        length = F.coalesce(F.octet_length(F.col(name)), F.lit(0))
        return length.cast("long") + 15
    fixed = isinstance(dtype, (NumericType, BooleanType, DatetimeType))
    return F.lit(24).cast("long") if fixed else None
