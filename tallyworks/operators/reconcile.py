"""Compare two results of the same question, key by key."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def reconcile(a: DataFrame, b: DataFrame, key: str, cols: Sequence[str], scale: int = 2) -> DataFrame:
    """Cells that differ after rounding to ``scale`` places.

    A missing key or NULL counts as 0, so a key on one side only matters if its value is not 0.
    """

    def settled(side: str, column: str) -> Column:
        value = F.round(F.col(f"{side}.{column}").cast(f"decimal(28,{scale + 4})"), scale)
        return F.coalesce(value, F.lit(0)).cast(f"decimal(28,{scale})")

    pairs = a.alias("a").join(b.alias("b"), F.col(f"a.{key}") == F.col(f"b.{key}"), "full")
    cells = [
        F.struct(
            F.coalesce(f"a.{key}", f"b.{key}").alias(key),
            F.lit(c).alias("column_name"),
            settled("a", c).alias("left_value"),
            settled("b", c).alias("right_value"),
        )
        for c in cols
    ]
    return (
        pairs.select(F.explode(F.array(*cells)).alias("cell"))
        .select("cell.*")
        .filter(F.col("left_value") != F.col("right_value"))
    )


def reconcile_all(pairs: Sequence[tuple[str, DataFrame, DataFrame, str, Sequence[str]]]) -> DataFrame:
    """Mismatches of several comparisons ``(name, a, b, key, cols)`` in one frame, keys as dates."""
    return reduce(
        DataFrame.unionByName,
        [
            reconcile(a, b, key, cols).select(
                F.lit(name).alias("metric"),
                F.col(key).cast("date").alias("key_date"),
                "column_name",
                "left_value",
                "right_value",
            )
            for name, a, b, key, cols in pairs
        ],
    )


def reconcile_summary(pairs: Sequence[tuple[str, DataFrame, DataFrame, str, Sequence[str]]]) -> DataFrame:
    """One row per comparison: keys of the second side, and cells that differ."""
    rows = []
    for name, a, b, key, cols in pairs:
        differing = reconcile(a, b, key, cols).agg(F.count("*")).scalar()
        compared = b.agg(F.count("*").alias("keys_compared"))
        rows.append(compared.select(F.lit(name).alias("metric"), "keys_compared", differing.alias("mismatches")))
    return reduce(DataFrame.unionByName, rows)
