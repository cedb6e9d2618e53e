"""What differs between two snapshots of a keyed table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opinio.functions.rows import fingerprint

HASH = "row_hash"


class InvalidKey(ValueError):
    """A table that must have a unique, non-NULL key does not."""


def with_row_hash(rows: DataFrame, but: str | None = None) -> DataFrame:
    """Fingerprint of all columns (``but`` one) in 16 bytes, independent of their order."""
    columns = sorted(c for c in rows.columns if c != but)
    return rows.withColumn(HASH, F.unhex(fingerprint(rows, columns)))


def change_set(old: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """``(key, change)`` with change one of insert, update, delete.

    Both sides carry ``row_hash``. Only keys and fingerprints are shuffled, never
    the rows themselves, and unchanged keys leave no row.
    """
    before = old.select(key, F.col(HASH).alias("_before"))
    after = new.select(key, F.col(HASH).alias("_after"))
    change = (
        F.when(F.col("_before").isNull(), "insert")
        .when(F.col("_after").isNull(), "delete")
        .when(F.col("_before") != F.col("_after"), "update")
    )
    return (
        before.join(after, key, "full_outer")
        .select(key, change.alias("change"))
        .where(F.col("change").isNotNull())
    )


def apply_changes(old: DataFrame, new: DataFrame, changes: DataFrame, key: str) -> DataFrame:
    """The old snapshot with the changed keys taken from the new one."""
    kept = old.join(changes.select(key), key, "left_anti")
    fresh = new.join(changes.where("change != 'delete'").select(key), key, "left_semi")
    return kept.unionByName(fresh)


def latest_per_key(changes: DataFrame, key: str, order: str) -> DataFrame:
    """The last change of every key, combined map-side."""
    others = [name for name in changes.columns if name not in (key, order)]
    last = F.max(F.struct(order, *others)).alias("_last")
    return changes.groupBy(key).agg(last).select(key, "_last.*")


def check_key(rows: DataFrame, key: str) -> None:
    """Refuse NULL and repeated keys; stops at the first offender."""
    wrong = rows.groupBy(key).count().where(F.col(key).isNull() | (F.col("count") > 1))
    found = wrong.limit(1).collect()
    if found:
        raise InvalidKey(f"{key}={found[0][0]!r} occurs {found[0][1]} times")
