"""Joins of facts to one row per key, where one key may own a large share of the facts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def join_hot(facts: DataFrame, keyed: DataFrame, key: str, how: str = "inner") -> DataFrame:
    """Join ``facts`` (many rows per key) to ``keyed`` (one row per key), ready to be split.

    AQE splits an oversized partition only if both inputs come straight from an exchange. A side
    that was just aggregated, windowed or joined by the same key would reuse that partitioning
    and rule the split out, sending a hot key to one task. The redundant second key, a hash of
    the first, gives each side an exchange of its own; for ``keyed`` that is one more shuffle of
    one row per key. It changes no match: equal keys have equal hashes, and NULL still meets none.
    """
    left = facts.withColumn("_spread", F.xxhash64(key))
    right = keyed.withColumn("_spread", F.xxhash64(key))
    return left.join(right, [key, "_spread"], how).drop("_spread")
