"""Parent rows with totals of their children, without fan-out."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def net_children(
    parent: DataFrame,
    child: DataFrame,
    key: str,
    aggregates: Mapping[str, Column],
    defaults: Mapping[str, Column],
) -> DataFrame:
    """Left-join ``parent`` to the per-key aggregates of ``child``.

    The child is reduced to one row per key first (partial aggregation on the map side), so a
    key with very many children reaches the join as a single row and nothing is multiplied.
    ``defaults`` fills parents without children; columns not listed there stay NULL.
    """
    totals = child.groupBy(key).agg(*[expr.alias(name) for name, expr in aggregates.items()])
    kept = [name for name in parent.columns if name != key]
    filled = [
        (F.coalesce(F.col(name), defaults[name]) if name in defaults else F.col(name)).alias(name)
        for name in aggregates
    ]
    return parent.join(totals, key, "left").select(key, *kept, *filled)
