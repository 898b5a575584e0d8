"""Slowly changing history (type 2) by comparing the current table with the open versions."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SPAN = ("valid_from", "valid_to")


def start_history(current: DataFrame, run_ts: Column, key: str | None = None) -> DataFrame:
    """First run: every row (with ``key`` given, every row that has one) becomes an open version."""
    if key is not None:
        current = current.filter(F.col(key).isNotNull())
    return current.withColumn("valid_from", run_ts).withColumn("valid_to", F.lit(None).cast("timestamp"))


def scd2_step(opened: DataFrame, current: DataFrame, key: str, check_cols: Sequence[str], run_ts: Column) -> DataFrame:
    """What becomes of the open versions: those that stay open, those that close at ``run_ts``, and new ones.

    A new key opens a version; a change in any checked column (NULL-safe) closes the open one at
    ``run_ts`` and opens another; other changes, and keys missing from ``current``, leave the
    open version as it is.

    A row of ``current`` without a key opens no version, and a version without a key stays as it is. A
    column that only ``current`` has is added, NULL in older versions; one that it no longer has is NULL
    in newer ones.
    """
    known = [f for f in opened.schema.fields if f.name not in SPAN]
    added = [f for f in current.schema.fields if f.name not in opened.columns]
    now = set(current.columns)

    def value(side: str, field, there: bool) -> Column:
        return (F.col(f"{side}.{field.name}") if there else F.lit(None).cast(field.dataType)).alias(field.name)

    old = opened.withColumn("_side", F.lit(True)).alias("o")
    new = current.filter(F.col(key).isNotNull()).withColumn("_side", F.lit(True)).alias("n")
    paired = old.join(new, F.col(f"o.{key}") == F.col(f"n.{key}"), "full")
    in_old, in_new = F.col("o._side").isNotNull(), F.col("n._side").isNotNull()
    differs = reduce(lambda a, b: a | b, [~F.col(f"o.{c}").eqNullSafe(F.col(f"n.{c}")) for c in check_cols])
    changed = in_old & in_new & differs
    old_version = F.struct(
        *[value("o", f, True) for f in known],
        *[value("o", f, False) for f in added],
        F.col("o.valid_from").alias("valid_from"),
        F.when(changed, run_ts).otherwise(F.col("o.valid_to")).alias("valid_to"),
    )
    new_version = F.struct(
        *[value("n", f, f.name in now) for f in known],
        *[value("n", f, True) for f in added],
        run_ts.alias("valid_from"),
        F.lit(None).cast("timestamp").alias("valid_to"),
    )
    versions = F.array_compact(F.array(F.when(in_old, old_version), F.when(~in_old | changed, new_version)))
    return paired.select(F.explode(versions).alias("v")).select("v.*")


def scd2_apply(
    history: DataFrame, current: DataFrame, key: str, check_cols: Sequence[str], run_ts: Column
) -> DataFrame:
    """Next state of a whole history, see ``scd2_step``.

    Only open versions, one per key, take part in the join, so a key with a long past costs nothing
    extra. The input is read, never updated in place.
    """
    closed = history.filter(F.col("valid_to").isNotNull())
    stepped = scd2_step(history.filter(F.col("valid_to").isNull()), current, key, check_cols, run_ts)
    return closed.unionByName(stepped, allowMissingColumns=True).select(*stepped.columns)
