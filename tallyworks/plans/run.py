"""One run of the warehouse: land the extracts, check staging, keep the customers' history, build and check the marts.

Each step starts from tables the step before has written. A check that fails on a staging table
stops the run before any later table is replaced; one that fails on a mart keeps that mart, and those
made from it, from being published. Readers of these stay on the versions of the last sound run.
"""

from __future__ import annotations

from collections import ChainMap
from collections.abc import Collection, Mapping
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyworks.operators.checks import Check, RowsExpectedEmpty, run_checks
from tallyworks.operators.contracts import age_status
from tallyworks.operators.history import scd2_step, start_history
from tallyworks.plans.checkbook import generic_checks, write_counts
from tallyworks.plans.named_checks import NAMED_CHECKS
from tallyworks.plans.warehouse import SAME_ROWS, STAGING, Warehouse, held_by, stage
from tallyworks.sources.ingest import LOADED_AT, LOADED_MICROS, SOURCES, load_tables, with_load_micros
from tallyworks.sources.tables import footer_maximum, publish_table, read_part, read_part_names, read_parts, replace_table, table_exists, write_parts

#: The columns whose change makes a new version of a customer.
HISTORY_COLUMNS = ("region", "email")


class ChecksFailed(ValueError):
    """Tables break checks; nothing built on them was replaced."""


def land(
    spark: SparkSession,
    folders: Mapping[str, str],
    root: str,
    loaded_at: Column | datetime,
    schemas: Mapping[str, Mapping[str, str]] | None = None,
    line_breaks: Mapping[str, Mapping[str, bool]] | None = None,
) -> dict[str, DataFrame]:
    """Write the extracts of each source system once as typed tables: ``{"source.table": DataFrame}``.

    ``folders`` maps a source system to the folder of its CSV files. The text is parsed once, by as many tasks
    as a file has splits, into Parquet under ``root/text``; types are found and cast from there, and what follows
    reads the typed tables. ``line_breaks`` tells of a source's tables whether their quoted text holds line
    breaks, which makes a file one task; without it the lines themselves tell.
    """
    landed = {}
    for source, folder in folders.items():
        tables = load_tables(
            spark, source, folder, loaded_at, None, (schemas or {}).get(source), f"{root}/text/{source}", (line_breaks or {}).get(source)
        )
        for table, df in tables.items():
            landed[f"{source}.{table}"] = replace_table(with_load_micros(df), f"{root}/landed/{source}/{table}").drop(LOADED_MICROS)
    return landed


def landed_freshness(spark: SparkSession, root: str, as_of: Column) -> DataFrame:
    """``source_name, max_loaded_at, status`` of every landed table, from the footers of its files alone."""
    found = []
    for source, tables in SOURCES.items():
        for table in tables:
            path = f"{root}/landed/{source}/{table}"
            if table_exists(spark, path):
                newest = footer_maximum(spark, path, LOADED_MICROS).select(F.timestamp_micros(LOADED_MICROS).alias("max_loaded_at"))
                found.append(newest.select(F.lit(f"{source}.{table}").alias("source_name"), "max_loaded_at", age_status(as_of)))
    return reduce(DataFrame.unionByName, found)


def _of_staging(check: Check) -> bool:
    return check.table in STAGING and getattr(check, "parent", check.table) in STAGING


def check_staging(warehouse: Warehouse) -> None:
    """Raise ``ChecksFailed`` with the failing checks of the staging tables and their counts, if there are any."""
    checks = [c for c in generic_checks() if _of_staging(c)]
    failing = run_checks(warehouse, checks).filter("status = 'fail'").orderBy("check").collect()
    if failing:
        raise ChecksFailed("; ".join(f"{r['check']}: {r.failing_rows} rows" for r in failing))


def keep_history(customers: DataFrame, root: str, loaded_at: Column) -> DataFrame:
    """Compare the customers with their open versions of earlier runs and publish the new history.

    Versions that close in a run make a partition, and so do those that are open after it; partitions of
    earlier runs are neither read (but for the open versions) nor written. A run repeated with its load
    time starts from the open versions before it, and so replaces its own partitions.
    """
    spark, path = customers.sparkSession, f"{root}/history/customers"
    current = customers.drop(LOADED_AT)
    run_name = customers.sparkSession.range(1).select(F.date_format(loaded_at, "yyyyMMdd'T'HHmmssSSSSSS").alias("r")).first()["r"]
    is_open, part = F.col("valid_to").isNull(), "part"
    if table_exists(spark, path):
        published = read_part_names(spark, path)
        before = [p for p in published if p.startswith("open_") and p != f"open_{run_name}"][0]
        stepped = scd2_step(read_part(spark, path, part, before), current, "customer_id", HISTORY_COLUMNS, loaded_at)
    else:
        before, stepped = None, start_history(current, loaded_at, "customer_id")
    dealt = stepped.withColumn(part, F.when(is_open, f"open_{run_name}").otherwise(f"closed_{run_name}"))
    write_parts(dealt, path, part, stepped.schema, lambda old: _next_parts(old, run_name, before))
    return read_history(spark, path)


def _next_parts(published: list[str], run_name: str, before: str | None) -> list[str]:
    """Open versions of this run, those they were made from (for a repeated run), and all closed ones."""
    closed = [p for p in published if p.startswith("closed_") and p != f"closed_{run_name}"]
    return [f"open_{run_name}", *([before] if before else []), *closed, f"closed_{run_name}"]


def read_history(spark: SparkSession, path: str) -> DataFrame:
    """All versions of the customers, closed ones and those open now."""
    now = read_part_names(spark, path)[0]
    return read_parts(spark, path, "part", lambda name: name == now or name.startswith("closed_"))


def audit(built: Warehouse, counted: Mapping[str, int]) -> dict[str, tuple[set[str], int]]:
    """Failing checks beyond those of staging, with the tables they look at and their failing rows.

    Row checks come from the writes' own counts, key checks share one aggregation a key, and a hand-written
    check is held against every table that it reads.
    """
    staging = {c.name for c in generic_checks() if _of_staging(c)}
    checks = [c for c in generic_checks() if c.name not in staging]
    tables = {c.name: {c.table, getattr(c, "parent", c.table)} for c in checks}
    named = {}
    for name, make in NAMED_CHECKS.items():
        reads = _Reads(built)
        named[name] = make(reads)
        tables[name] = reads.names
    rows = [RowsExpectedEmpty(name, name) for name in named]
    results = run_checks(ChainMap(named, built), [*checks, *rows], counted, SAME_ROWS).filter("status = 'fail'").collect()
    return {r["check"]: (tables[r["check"]], r["failing_rows"]) for r in results}


class _Reads(Mapping):
    """Tables, and the names of those that were asked for."""

    def __init__(self, tables: Mapping[str, DataFrame]):
        self._tables, self.names = tables, set()

    def __getitem__(self, name: str) -> DataFrame:
        self.names.add(name)
        return self._tables[name]

    def __iter__(self):
        return iter(self._tables)

    def __len__(self) -> int:
        return len(self._tables)


def run(warehouse: Warehouse, root: str, loaded_at: Column | datetime, warn_only: Collection[str] = ()) -> Warehouse:
    """Check staging, keep the history, build, check what was built, publish what is sound.

    New versions are checked before readers see them. A check that fails holds back the tables it looks at
    and all that are made from them, which stay at their old versions; the others are published. Then
    ``ChecksFailed`` says which checks failed and what was held back. Checks in ``warn_only`` hold nothing
    back. Returns a warehouse over what is published.
    """
    stamp = (loaded_at if isinstance(loaded_at, Column) else F.lit(loaded_at)).cast("timestamp")
    check_staging(warehouse)
    keep_history(warehouse["raw.customers"], root, stamp)
    built, staged = stage(warehouse, root, write_counts())
    counted = {name: n for table in staged.values() for name, n in table.counts.items()}
    failing = {name: found for name, found in audit(built, counted).items() if name not in warn_only}
    looked_at = set().union(*[tables for tables, _ in failing.values()])
    held = {t for t in staged if t in looked_at or {SAME_ROWS[n][0] for n in looked_at if n in SAME_ROWS} & {t}}
    held |= held_by(held | (looked_at - set(STAGING)), staged)
    for name, table in staged.items():
        if name not in held:
            publish_table(table)
    if failing:
        counts = "; ".join(f"{name}: {n} rows" for name, (_, n) in sorted(failing.items()))
        raise ChecksFailed(f"{counts}; held back: {', '.join(sorted(held))}")
    return built
