"""Table contracts, schema drift and source freshness."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


class ContractViolation(ValueError):
    """A table does not keep its contract; nothing is published."""


@dataclass(frozen=True)
class Contract:
    """Exact columns and types (matched by name, in any order), primary key and required columns."""

    columns: Mapping[str, str]
    primary_key: tuple[str, ...]
    not_null: tuple[str, ...] = field(default=())


def schema_violations(schema: T.StructType, contract: Contract) -> list[str]:
    actual = {f.name: f.dataType.simpleString() for f in schema.fields}
    found = [f"missing column {c}" for c in contract.columns if c not in actual]
    found += [f"unexpected column {c}" for c in actual if c not in contract.columns]
    found += [
        f"column {c} is {actual[c]}, contract says {wanted}"
        for c, wanted in contract.columns.items()
        if c in actual and actual[c] != wanted
    ]
    return found


def data_violations(df: DataFrame, contract: Contract) -> list[str]:
    """NULLs in required columns (one pass) and repeated primary keys (one aggregation)."""
    required = tuple(dict.fromkeys(contract.primary_key + contract.not_null))
    nulls = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in required]).first()
    found = [f"{nulls[c]} NULLs in required column {c}" for c in required if nulls[c]]
    keys = df.groupBy(*contract.primary_key).agg(F.count("*").alias("n"))
    repeated = keys.filter(F.col("n") > 1).agg(F.count("*").alias("n")).first()["n"]
    if repeated:
        found.append(f"{repeated} repeated primary keys {contract.primary_key}")
    return found


def contract_status(df: DataFrame, contract: Contract, name: str) -> DataFrame:
    """One row, ``table_name, status``: whether the table keeps its contract now (``enforced``) or not (``violated``).

    The rows are judged by one aggregation: a key that repeats or a required value that is missing.
    """
    if schema_violations(df.schema, contract):
        return df.agg(F.count("*")).select(F.lit(name).alias("table_name"), F.lit("violated").alias("status"))
    required = tuple(dict.fromkeys(contract.primary_key + contract.not_null))
    missing = F.count_if(F.greatest(*[F.col(c).isNull().cast("int") for c in required], F.lit(0)) > 0)
    keys = df.groupBy(*contract.primary_key).agg(F.count("*").alias("_rows"), missing.alias("_missing"))
    broken = F.count_if((F.col("_rows") > 1) | (F.col("_missing") > 0)) > 0
    return keys.agg(broken.alias("_broken")).select(
        F.lit(name).alias("table_name"), F.when(F.col("_broken"), "violated").otherwise("enforced").alias("status")
    )


def assert_contract(df: DataFrame, contract: Contract, data: bool = True) -> DataFrame:
    """Return ``df`` in contract column order or raise ``ContractViolation``.

    The schema part reads no data. To check the rows without computing an expensive plan twice,
    write to an unpublished location first and assert on that (see ``sources.tables``).
    """
    found = schema_violations(df.schema, contract)
    if not found and data:
        found = data_violations(df, contract)
    if found:
        raise ContractViolation("; ".join(found))
    return df.select(*contract.columns)


def table_columns(spark: SparkSession, tables: Mapping[str, DataFrame]) -> DataFrame:
    """Catalog rows ``(table_name, column_name, data_type)`` of live DataFrames; reads no data."""
    rows = [
        (name, f.name, f.dataType.simpleString())
        for name, df in sorted(tables.items())
        for f in df.schema.fields
    ]
    return spark.createDataFrame(rows, "table_name string, column_name string, data_type string")


def schema_snapshot(tables: Mapping[str, DataFrame]) -> dict[str, dict[str, str]]:
    """JSON-ready snapshot with sorted keys, to be checked in and compared later."""
    return {
        name: {f.name: f.dataType.simpleString() for f in sorted(df.schema.fields, key=lambda f: f.name)}
        for name, df in sorted(tables.items())
    }


def snapshot_columns(spark: SparkSession, snapshot: Mapping[str, Mapping[str, str]]) -> DataFrame:
    rows = [(t, c, kind) for t, columns in snapshot.items() for c, kind in columns.items()]
    return spark.createDataFrame(rows, "table_name string, column_name string, data_type string")


def schema_drift(expected: DataFrame, live: DataFrame) -> DataFrame:
    """Differences between two catalogs; a table on one side only is one finding, not one per column."""
    e, l = expected.alias("e"), live.alias("l")
    same = (F.col("e.table_name") == F.col("l.table_name")) & (F.col("e.column_name") == F.col("l.column_name"))
    pairs = e.join(l, same, "full").select(
        F.coalesce("e.table_name", "l.table_name").alias("table_name"),
        F.coalesce("e.column_name", "l.column_name").alias("column_name"),
        F.col("e.data_type").alias("expected_type"),
        F.col("l.data_type").alias("live_type"),
    )
    sides = pairs.groupBy("table_name").agg(
        F.count("expected_type").alias("_expected"), F.count("live_type").alias("_live")
    )
    columns = pairs.join(sides.filter((F.col("_expected") > 0) & (F.col("_live") > 0)), "table_name", "left_semi")
    column_findings = columns.select(
        "table_name",
        "column_name",
        F.when(F.col("live_type").isNull(), "MISSING COLUMN")
        .when(F.col("expected_type").isNull(), "NEW COLUMN")
        .when(F.col("expected_type") != F.col("live_type"), "TYPE CHANGED")
        .alias("finding"),
        "expected_type",
        "live_type",
    ).filter(F.col("finding").isNotNull())
    table_findings = sides.filter((F.col("_expected") == 0) | (F.col("_live") == 0)).select(
        "table_name",
        F.lit(None).cast("string").alias("column_name"),
        F.when(F.col("_live") == 0, "MISSING TABLE").otherwise("NEW TABLE").alias("finding"),
        F.lit(None).cast("string").alias("expected_type"),
        F.lit(None).cast("string").alias("live_type"),
    )
    return table_findings.unionByName(column_findings).orderBy("table_name", "finding", "column_name")


def freshness(
    df: DataFrame, name: str, as_of: Column, warn_days: int = 1, error_days: int = 3, loaded_at: str = "_loaded_at"
) -> DataFrame:
    """One row: newest load time of a source and whether its age passes, warns or errs."""
    newest = df.agg(F.max(loaded_at).alias("max_loaded_at"))
    return newest.select(F.lit(name).alias("source_name"), "max_loaded_at", age_status(as_of, warn_days, error_days))


def age_status(as_of: Column, warn_days: int = 1, error_days: int = 3) -> Column:
    """``status`` of a source by the age of its ``max_loaded_at``."""
    newest = F.col("max_loaded_at")
    age = F.unix_micros(as_of) - F.unix_micros(newest)
    day = 86_400_000_000
    return (
        F.when(newest.isNull() | (age > error_days * day), "error")
        .when(age > warn_days * day, "warn")
        .otherwise("pass")
        .alias("status")
    )
