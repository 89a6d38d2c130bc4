"""Session settings and the shared scratch folder."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Joins and aggregations are planned at run time from measured sizes: small sides are
# broadcast, small partitions merged and skewed join partitions split.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    # Lets the linear algebra of the factorisation use SIMD; set it for executors on a cluster too.
    "spark.driver.extraJavaOptions": "--add-modules=jdk.incubator.vector",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}

# Rows of ids and numbers that a small batch may keep on the driver, some megabytes at most.
LOCAL_ROWS = 10_000

# Holds a local session's own choice; Spark's setting cannot be changed once it runs.
OWN_DIR = "basketry.scratch.dir"


def local_session(cores: int | str = 8, memory: str = "8g", **extra: str) -> SparkSession:
    """A session for tests and the benchmark; on a cluster the caller brings their own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("basketry")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", "8")
    )
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors can reach, as named by ``spark.checkpoint.dir``.

    Only a local session may fall back to a folder of its own; the choice is kept in the
    session so later calls agree on it.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get(OWN_DIR, None)
    if configured:
        return configured
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
    chosen = tempfile.mkdtemp(prefix="basketry-")
    spark.conf.set(OWN_DIR, chosen)
    return chosen


def fresh_path(spark: SparkSession, label: str) -> str:
    """A path under the shared folder that no earlier run has used."""
    return os.path.join(shared_dir(spark), f"{label}-{uuid.uuid4().hex}")


def scratch_path(spark: SparkSession, label: str) -> str:
    """As :func:`fresh_path`; goes with the tables stored in the same :func:`scratch` block."""
    path = fresh_path(spark, label)
    if _scopes:
        _scopes[-1].append(path)
    return path


def stored(df: DataFrame, label: str) -> DataFrame:
    """The rows written to the shared folder and read back.

    For results that several later steps read: they are worked out once, outlive lost executors,
    and each reader scans only the columns it needs.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def remove(spark: SparkSession, path: str) -> None:
    """Deletes a folder wherever it is, by the file system of its scheme."""
    target, system = _file_system(spark, path)
    system.delete(target, True)


def gathered(df: DataFrame, label: str, rows: int = LOCAL_ROWS, source: DataFrame | None = None) -> DataFrame:
    """As :func:`stored`, but at most ``rows`` rows go through the driver and become a local table instead.

    For steps of small batches, where a write and a scan cost more than the rows; more rows are stored. To see how
    many there are, they are worked out once more; ``source`` is the batch they come from, and if that is no local
    table, it is large and they are stored at once.
    """
    if source is not None and not source.isLocal():
        return stored(df, label)
    found = df.limit(rows + 1).toArrow()
    return df.sparkSession.createDataFrame(found, df.schema) if found.num_rows <= rows else stored(df, label)


def _file_system(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target, target.getFileSystem(spark._jsc.hadoopConfiguration())


def children(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder wherever it is; none if there is no such folder."""
    target, system = _file_system(spark, path)
    return sorted(x.getPath().getName() for x in system.listStatus(target)) if system.exists(target) else []


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small file that is there as a whole or not at all."""
    target, system = _file_system(spark, path)
    draft = spark._jvm.org.apache.hadoop.fs.Path(target.getParent(), f"_{uuid.uuid4().hex}")
    out = system.create(draft)
    out.write(bytearray(text.encode()))
    out.close()
    if not system.rename(draft, target):
        system.delete(draft, False)
        raise FileExistsError(path)


def read_text(spark: SparkSession, path: str) -> str:
    target, system = _file_system(spark, path)
    stream = system.open(target)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


# The stored tables of the jobs that are running, the innermost last.
_scopes: list[list[str]] = []


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Removes the tables stored inside when the block ends; for jobs that have written their results by then."""
    _scopes.append([])
    try:
        yield
    finally:
        for path in _scopes.pop():
            remove(spark, path)


def use_checkpoints(spark: SparkSession) -> None:
    """Point the context's checkpoints at the shared folder unless one is already set."""
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_dir(spark))
