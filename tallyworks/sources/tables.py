"""Versioned Parquet tables that are replaced as a whole.

A new version is written next to the old one, checked, and published by moving one small
pointer file. Readers see the old rows or the new rows, never a mixture, and a job that dies
half-way leaves the published version untouched.
"""

from __future__ import annotations

from collections.abc import Callable, Collection, Mapping
from dataclasses import dataclass
from datetime import date
from uuid import uuid4

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyworks.operators.contracts import Contract, ContractViolation, assert_contract, schema_violations
from tallyworks.session import scratch_root
from tallyworks.sources.ingest import LOADED_AT, LOADED_MICROS

POINTER = "_current"


def _filesystem(spark: SparkSession, path: str):
    location = spark._jvm.org.apache.hadoop.fs.Path(path)
    return location.getFileSystem(spark._jsc.hadoopConfiguration()), location


def _read_pointers(spark: SparkSession, path: str) -> list[str]:
    """The published version and the one before it, as far as there are any."""
    fs, pointer = _filesystem(spark, f"{path}/{POINTER}")
    if not fs.exists(pointer):
        return []
    stream = fs.open(pointer)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8").split()
    finally:
        stream.close()


def _read_pointer(spark: SparkSession, path: str) -> str | None:
    return next(iter(_read_pointers(spark, path)), None)


def _write_pointer(spark: SparkSession, path: str, versions: list[str]) -> None:
    """Write a new pointer beside the old one and rename it over: a reader sees the old or the new."""
    fs, new = _filesystem(spark, f"{path}/{POINTER}.{uuid4().hex}")
    stream = fs.create(new, True)
    try:
        stream.write(bytearray("\n".join(versions), "utf-8"))
    finally:
        stream.close()
    hadoop = spark._jvm.org.apache.hadoop.fs
    rename = getattr(hadoop, "Options$Rename")
    options = spark.sparkContext._gateway.new_array(rename, 1)
    options[0] = rename.OVERWRITE
    context = hadoop.FileContext.getFileContext(new.toUri(), spark._jsc.hadoopConfiguration())
    context.rename(new, hadoop.Path(f"{path}/{POINTER}"), options)


def table_exists(spark: SparkSession, path: str) -> bool:
    return _read_pointer(spark, path) is not None


def _read_version(spark: SparkSession, path: str, version: str) -> DataFrame:
    df = spark.read.option("basePath", f"{path}/{version}").parquet(f"{path}/{version}")
    return df.drop(MONTH)


def read_table(spark: SparkSession, path: str) -> DataFrame:
    version = _read_pointer(spark, path)
    if version is None:
        raise FileNotFoundError(f"no table published at {path}")
    return _read_version(spark, path, version)


def read_months(spark: SparkSession, path: str, layout: Layout, first: date, last: date) -> DataFrame:
    """The rows of a table written in that layout whose date lies between two days; other months are not read."""
    version = _read_pointer(spark, path)
    if version is None:
        raise FileNotFoundError(f"no table published at {path}")
    df = spark.read.option("basePath", f"{path}/{version}").parquet(f"{path}/{version}")
    day = F.col(layout.date).cast("date")
    inside = F.col(MONTH).between(first.year * 100 + first.month, last.year * 100 + last.month) & day.between(F.lit(first), F.lit(last))
    return df.filter(inside).drop(MONTH)


def footer_maximum(spark: SparkSession, path: str, column: str) -> DataFrame:
    """One row, ``column``: its largest value in the published table, from the footers of the files alone.

    For whole numbers and dates. The v2 reader answers the aggregate from the statistics of the row groups, so
    no row is read, however large the table is. Its settings hold in a session of their own.
    """
    version = _read_pointer(spark, path)
    if version is None:
        raise FileNotFoundError(f"no table published at {path}")
    footers = spark.newSession()
    footers.conf.set("spark.sql.sources.useV1SourceList", "")
    footers.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    return footers.read.parquet(f"{path}/{version}").agg(F.max(column).alias(column))


def _keep_columns(df: DataFrame, published: DataFrame) -> DataFrame:
    """Columns of the published table stay, as NULL if the new rows lack them.

    Unknown columns are refused, except the load time, which older tables may not have had.
    """
    known = set(published.columns) | {LOADED_AT, LOADED_MICROS}
    unknown = [c for c in df.columns if c not in known]
    if unknown:
        raise ContractViolation(f"columns not in the published table: {', '.join(unknown)}")
    missing = [f for f in published.schema.fields if f.name not in df.columns]
    return df.withColumns({f.name: F.lit(None).cast(f.dataType) for f in missing}) if missing else df


@dataclass(frozen=True)
class Layout:
    """How the files of a table lie: a folder for each month of ``date``, rows sorted by ``sort`` within them.

    Readers of some months list only their folders; readers of some keys skip row groups by their least and
    largest values. The month is derived and no column of the table.
    """

    date: str
    sort: tuple[str, ...]


MONTH = "_month"


def _laid_out(df: DataFrame, layout: Layout) -> DataFrame:
    """Rows of a month side by side and sorted. The rebalance shuffle cuts a month with very many rows in several
    files and lets small months share a task, by what the shuffle has measured."""
    month = (F.year(layout.date) * 100 + F.month(layout.date)).alias(MONTH)
    return df.select("*", month).hint("rebalance", MONTH).sortWithinPartitions(MONTH, *layout.sort)


@dataclass
class Staged:
    """A new version of a table that nobody reads yet."""

    path: str
    version: str
    written: DataFrame
    counts: dict[str, int]


def stage_table(
    df: DataFrame,
    path: str,
    contract: Contract | None = None,
    keep_columns: bool = False,
    layout: Layout | None = None,
    counting: Mapping[str, Column] | None = None,
) -> Staged:
    """Write ``df`` as a new version of the table without publishing it.

    The contract's schema is checked before anything is written and its rows on the written files, so the
    plan runs once. ``counting`` are aggregates that the write itself works out, with no pass of their own.
    """
    spark = df.sparkSession
    before = _read_pointer(spark, path)
    if keep_columns and before is not None:
        df = _keep_columns(df, _read_version(spark, path, before))
    if contract is not None:
        found = schema_violations(df.schema, contract)
        if found:
            raise ContractViolation("; ".join(found))
    version = f"v_{uuid4().hex}"
    written, counts = _write_counted(df, f"{path}/{version}", counting, layout)
    if contract is not None:
        assert_contract(written, contract)
    return Staged(path, version, written, counts)


def _write_counted(
    df: DataFrame, path: str, counting: Mapping[str, Column] | None, layout: Layout | None = None, keep: Collection[str] | None = None
) -> tuple[DataFrame, dict[str, int]]:
    """Write and read back; the observation is taken of the very rows that are written."""
    rows, seen = (_laid_out(df, layout) if layout else df), None
    if counting:
        seen = Observation()
        rows = rows.observe(seen, *[count.alias(name) for name, count in counting.items()])
    if keep is not None:
        rows = rows.select(*keep)
    writer = rows.write.partitionBy(MONTH) if layout else rows.write
    writer.parquet(path)
    schema = df.schema if keep is None else rows.schema
    written = with_columns_of(df.sparkSession.read.schema(schema).parquet(path), df.schema)
    return written, dict(seen.get) if seen else {}


def with_columns_of(df: DataFrame, schema: T.StructType) -> DataFrame:
    """``df`` with the columns of ``schema``. Reading one that it lacks is an error; to carry it along unread is none."""
    held = set(df.columns)

    def column(f: T.StructField) -> Column:
        return F.col(f.name) if f.name in held else F.raise_error(F.lit(f"column {f.name} was not kept")).cast(f.dataType).alias(f.name)

    return df.select(*[column(f) for f in schema.fields])


def publish_table(staged: Staged) -> DataFrame:
    """Move the pointer to the new version; returns the published table.

    The version published before stays on disk for readers that are still on it; the one before that is
    removed. Versions that were never published are left alone, as another writer may be at work on them;
    of two writers the one that ends last is read.
    """
    spark, path = staged.written.sparkSession, staged.path
    published = [v for v in _read_pointers(spark, path) if v != staged.version]
    _write_pointer(spark, path, [staged.version, *published[:1]])
    for old in published[1:]:
        fs, folder = _filesystem(spark, f"{path}/{old}")
        fs.delete(folder, True)
    return staged.written


def replace_table(
    df: DataFrame, path: str, contract: Contract | None = None, keep_columns: bool = False, layout: Layout | None = None
) -> DataFrame:
    """Write ``df`` as the table's new content and publish it; nothing that fails its contract is ever published.

    Running the same load again gives the same rows.
    """
    return publish_table(stage_table(df, path, contract, keep_columns, layout))


def write_parts(df: DataFrame, path: str, part: str, schema: T.StructType, keep: Callable[[list[str]], list[str]]) -> None:
    """Write the rows of each value of ``part`` as a partition of its own and publish a new list of partitions.

    Only the partitions that ``df`` holds are written, by dynamic partition overwrite: a run that is
    repeated replaces its own ones, no other file is touched. ``keep`` makes the published list from the
    one before; readers see either list. A partition that got no rows is written empty, as the first one
    of the list tells the columns (``schema``).
    """
    spark = df.sparkSession
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(part).parquet(path)
    parts = keep(_read_pointers(spark, path))
    fs, first = _filesystem(spark, f"{path}/{part}={parts[0]}")
    if not fs.exists(first):
        spark.createDataFrame([], schema).write.parquet(first.toString())
    found = [p for p in parts if fs.exists(_filesystem(spark, f"{path}/{part}={p}")[1])]
    _write_pointer(spark, path, found)


def read_part_names(spark: SparkSession, path: str) -> list[str]:
    """The partitions published at ``path``."""
    return _read_pointers(spark, path)


def read_part(spark: SparkSession, path: str, part: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{path}/{part}={name}")


def read_parts(spark: SparkSession, path: str, part: str, wanted: Callable[[str], bool] = lambda name: True) -> DataFrame:
    """The published partitions that are wanted, with the columns of the first one; older ones may lack some."""
    parts = _read_pointers(spark, path)
    if not parts:
        raise FileNotFoundError(f"no table published at {path}")
    schema = spark.read.parquet(f"{path}/{part}={parts[0]}").schema
    chosen = [f"{path}/{part}={p}" for p in parts if wanted(p)]
    return spark.read.schema(schema).parquet(*chosen)


def write_scratch(df: DataFrame) -> DataFrame:
    """Cut the lineage: write ``df`` to the session's shared checkpoint folder and read it back.

    Unlike an RDD checkpoint this runs the plan once and keeps column pruning. The folder is the
    cluster's to clean, like any checkpoint. On a cluster without one, ``df`` is returned as it is.
    """
    return write_scratch_counted(df)[0]


def write_scratch_counted(
    df: DataFrame, counting: Mapping[str, Column] | None = None, keep: Collection[str] | None = None
) -> tuple[DataFrame, dict[str, int]]:
    """``write_scratch`` with aggregates that the write works out on the way; none where nothing is written.

    ``keep`` are the columns that are read later, if not all are: the others are left out of the files.
    """
    folder = scratch_root(df.sparkSession)
    if not folder:
        return df, {}
    return _write_counted(df, f"{folder}/tallyworks/{uuid4().hex}", counting, keep=keep)


def write_csv(df: DataFrame, path: str) -> None:
    """Hand a result to another process as CSV with a header."""
    df.write.mode("overwrite").option("header", True).csv(path)
