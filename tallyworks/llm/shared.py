"""What the corpus operators share: shared scratch tables, prefix sums over many rows, components."""

from __future__ import annotations

import os
import tempfile
import zipfile
from collections.abc import Callable
from functools import reduce
from uuid import uuid4

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyworks.operators.joins import join_hot
from tallyworks.session import scratch_root

#: Stands for a missing doc_id: such a row counts as the last document.
LAST_ID = (1 << 63) - 1
#: Rows of an Arrow batch.
BATCH_ROWS = 2_000
#: Bytes of an Arrow batch after which it ends, fewer rows or not.
BATCH_BYTES = 2 << 20
#: A file of fewer rows of documents, or of links, is not worth what it costs to make and to open.
FILE_ROWS = 1_000
FILE_LINKS = 20_000
_shipped: set[str] = set()
_kept: dict[tuple, object] = {}


def ship(spark: SparkSession) -> None:
    """Give this package to the executors' Python, once for each application, like ``--py-files``.

    Batches of whole texts are kept to ``BATCH_ROWS`` rows and to ``BATCH_BYTES`` and a row, as they are held by both sides.
    """
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    if int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) > BATCH_ROWS:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    target = os.path.join(tempfile.mkdtemp(prefix="package-"), "tallyworks_package.zip")
    with zipfile.ZipFile(target, "w") as archive:
        for folder, _, names in os.walk(package):
            for name in names:
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    archive.write(full, os.path.relpath(full, os.path.dirname(package)))
    spark.sparkContext.addPyFile(target)
    _shipped.add(app)


def kept(key: tuple, make: Callable[[], object]) -> object:
    """What this worker keeps from task to task: one thing, made on first use, until another or another step takes its place."""
    if key not in _kept:
        _kept.clear()
        _kept[key] = make()
    return _kept[key]


def release(keep: bool = False) -> None:
    """Give memory that is held but not used back to the machine: a Python worker lives on from stage to stage,
    and what Arrow and the C library keep for it is missing to the executor beside it. So is what the worker
    keeps for an earlier step, unless the caller is that step and says ``keep``."""
    import ctypes

    import pyarrow as pa

    if not keep:
        _kept.clear()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        pass


def scratch_folder(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``; on a single machine without it, one of our own."""
    folder = scratch_root(spark)
    if not folder:
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return folder


def scratch(df: DataFrame, files: int | None = None) -> DataFrame:
    """Cut the lineage: write ``df`` to the shared scratch folder, to at most ``files`` files, and read it back."""
    path = f"{scratch_folder(df.sparkSession)}/corpus/{uuid4().hex}"
    (df.coalesce(files) if files else df).write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def with_fields(schema: T.StructType, *fields: T.StructField) -> T.StructType:
    """``schema`` with ``fields`` behind it; a column of the same name gives way to the new one."""
    new = {f.name.lower() for f in fields}
    return T.StructType([f for f in schema.fields if f.name.lower() not in new] + list(fields))


def text_size(docs: DataFrame, text: str) -> int:
    """Bytes of all texts together, from one pass over the column."""
    return docs.agg(F.coalesce(F.sum(F.octet_length(text)), F.lit(0))).first()[0]


def pieces_for(total: int, each: int, least: int = 1) -> int:
    """How many parts of ``each`` a whole of ``total`` has; grows with the input."""
    return max(least, -(-int(total) // each))


def running_total(df: DataFrame, group: list[str], order: str, value: str, out: str, fan: int = 4096) -> DataFrame:
    """Sum of ``value`` over the rows before this one by integer ``order``, within ``group``.

    Two levels: windows over ``fan`` consecutive numbers each, and one over the totals of those, so
    that no task sorts more than the square root of a long series. ``order`` is unique in its group.
    """
    parts = df.withColumn("_total_part", F.floor(F.col(order) / fan))
    inner = Window.partitionBy(*group, "_total_part").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    outer = Window.partitionBy(*group).orderBy("_total_part").rowsBetween(Window.unboundedPreceding, -1)
    heads = parts.groupBy(*group, "_total_part").agg(F.sum(value).alias("_total_sum"))
    heads = heads.select(*group, "_total_part", F.coalesce(F.sum("_total_sum").over(outer), F.lit(0)).alias("_total_before"))
    heads = heads.toDF(*[f"_of_{c}" for c in (*group, "_total_part")], "_total_before")
    within = parts.withColumn("_total_within", F.coalesce(F.sum(value).over(inner), F.lit(0)))
    met = [F.col(k).eqNullSafe(F.col(f"_of_{k}")) for k in (*group, "_total_part")]
    joined = within.join(heads, reduce(lambda x, y: x & y, met))
    return joined.select(*df.columns, (F.col("_total_within") + F.col("_total_before")).cast("long").alias(out))


def _stars(links: DataFrame) -> bool:
    """Whether every node of the distinct ``links`` from ``u`` down to ``v`` has either one link down or links from above alone."""
    ends = F.array(F.struct(F.col("u").alias("node"), F.lit(1).alias("down")), F.struct(F.col("v").alias("node"), F.lit(0).alias("down")))
    nodes = links.select(F.explode(ends).alias("e")).groupBy("e.node").agg(F.sum("e.down").alias("down"), F.min("e.down").alias("least"))
    return not nodes.agg(F.max((F.col("down") > 1) | (F.col("down") == 1) & (F.col("least") == 0))).first()[0]


def components(edges: DataFrame, a: str = "a", b: str = "b", most: int | None = None) -> DataFrame:
    """Connected components of an undirected graph: ``node``, ``component`` (its smallest node).

    Large-star and small-star turns until only stars are left; each turn joins edges to one minimum per
    node, so a hub costs one row per edge and is split by AQE. Lineage is cut every turn, and no turn has
    more edges than the one before: where the caller knows that there are at most ``most``, each is
    written to as few files as that many need. Nodes without a link to another node are not returned.
    """
    files = None if most is None else pieces_for(most, FILE_LINKS)
    now = scratch(edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).filter("u <> v").distinct(), files)
    while not _stars(now):
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = join_hot(both, least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.filter("u <> v").distinct()
        small_least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = join_hot(large, small_least, "u").select(
            F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct("u", F.col("m").alias("v")))).alias("e")
        )
        now = scratch(small.select("e.u", "e.v").filter("u <> v").distinct(), files)
    roots = now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)


def rule_column(condition: Column) -> Column:
    """A condition whose unknown outcome counts as false."""
    return F.coalesce(condition, F.lit(False))


def numbered(df: DataFrame, order: list[Column], out: str) -> DataFrame:
    """``df`` with each row's number, from 0, in the order of ``order``; no task holds more than its range of rows.

    Rows are range-partitioned and sorted, so a hot value is cut as long as later columns of ``order``
    tell its rows apart. What is broadcast is one row a partition.
    """
    ranged = df.repartitionByRange(*order).sortWithinPartitions(*order)
    marked = scratch(ranged.withColumn("_mark", F.monotonically_increasing_id()))
    part, place = F.shiftright("_mark", 33), F.col("_mark").bitwiseAND(F.lit((1 << 33) - 1))
    sizes = marked.groupBy(part.alias("_of_part")).agg((F.max(place) + 1).alias("_rows"))
    earlier = Window.orderBy("_of_part").rowsBetween(Window.unboundedPreceding, -1)
    before = sizes.select("_of_part", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_before"))
    placed = marked.join(F.broadcast(before), part == F.col("_of_part"))
    return placed.select(*df.columns, (F.col("_before") + place).alias(out))
