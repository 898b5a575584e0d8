"""Session settings the jobs are written for."""

from __future__ import annotations

import tempfile
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

_own_folders: dict[str, str] = {}

#: Runtime settings. Every one is a stock Spark option; a cluster's own defaults win for
#: anything not listed here (memory, cores, shuffle service, checkpoint folder).
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Hot join keys: AQE splits the oversized partition of the streamed side. Forcing it keeps
    # the split even where it costs one more exchange further down.
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}


def rely_on_aqe(spark: SparkSession) -> None:
    """Switch on the adaptive options the plans count on against hot keys, whatever the session."""
    for key, value in SETTINGS.items():
        if key.startswith("spark.sql.adaptive."):
            spark.conf.set(key, value)


#: Shuffle files go when the action that wrote them ends, instead of whenever the driver's collector finds them.
DROP_SHUFFLES = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}

#: A join by several keys is satisfied with two sides that are both dealt by the first of them.
JOIN_AS_DEALT = {"spark.sql.requireAllClusterKeysForCoPartition": "false"}


@contextmanager
def settings(spark: SparkSession, values: dict[str, str]) -> Iterator[None]:
    """Runtime settings for the actions inside."""
    before = {key: spark.conf.get(key, None) for key in values}
    for key, value in values.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def checkpoint_dir(spark: SparkSession) -> str | None:
    """The shared folder the session names for checkpoints, if any; never a folder of our own."""
    return spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()


def scratch_root(spark: SparkSession) -> str | None:
    """The shared folder for scratch tables; on a single machine, where none is set, one of our own.

    On a cluster without the setting there is none: a folder on one machine would be missing on others.
    """
    folder = checkpoint_dir(spark)
    if folder or not spark.sparkContext.master.split("[")[0] == "local":
        return folder
    app = spark.sparkContext.applicationId
    if app not in _own_folders:
        _own_folders[app] = tempfile.mkdtemp(prefix="tallyworks-")
    return _own_folders[app]


def tune(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to an existing session."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def local_session(cores: int | str = 8, shuffle_partitions: int = 8, memory: str = "16g") -> SparkSession:
    """A single-machine session for tests and the benchmark."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("tallyworks")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        # Recording the call site of every Python expression triples the time to build a plan.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
