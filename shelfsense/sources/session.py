"""Session settings, the shared folder, and the two ways this library fixes an intermediate result."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

RUNTIME_SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Many-to-one joins here are often followed by an aggregation on the join key. Without this
    # setting Spark leaves a hot key unsplit when splitting it costs one more shuffle.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}

SMALL_SIDE_ROWS = 100_000


def tune(spark: SparkSession) -> SparkSession:
    """Switch on the runtime re-planning that the operators rely on for hot keys."""
    for name, value in RUNTIME_SETTINGS.items():
        spark.conf.set(name, value)
    return spark


def release_shuffles(spark: SparkSession) -> SparkSession:
    """Delete the shuffle files of every query as soon as it is over.

    Otherwise they stay until the driver's JVM happens to collect the plan, so a job of many stored steps fills the local
    disks with those of all steps. A plan that runs a second time after that computes its shuffles again.
    """
    spark.conf.set("spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors can reach; ``spark.checkpoint.dir`` names it.

    Only a local-mode session without that setting gets a folder of its own.
    """
    context = spark.sparkContext
    current = context.getCheckpointDir()
    if current:
        return current
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors can reach")
        named = tempfile.mkdtemp(prefix="shelfsense-")
    context.setCheckpointDir(named)
    return context.getCheckpointDir()


_scopes: list[list[str]] = []


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Delete what ``fresh_path`` and ``stored`` name inside the block, when the block ends.

    Results that read such tables must have been read or written elsewhere by then.
    """
    paths: list[str] = []
    _scopes.append(paths)
    try:
        yield
    finally:
        _scopes.remove(paths)
        for path in paths:
            delete(spark, path)


def delete(spark: SparkSession, path: str) -> None:
    """Remove a folder below the shared folder; one that is not there does no harm."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def fresh_path(spark: SparkSession, name: str) -> str:
    """A path below the shared folder that no other run uses; ``scratch`` cleans up after a job."""
    path = f"{shared_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    for paths in _scopes:
        paths.append(path)
    return path


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared folder and go on from there: stable rows, no recomputation."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a Parquet table in the shared folder, for results that are read several times.

    Unlike a checkpoint it is columnar: a pass over one key reads one column.
    """
    path = fresh_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def small_side(df: DataFrame, max_rows: int = SMALL_SIDE_ROWS) -> DataFrame:
    """Mark ``df`` for broadcast if it has been counted and is small, else leave the join to Spark."""
    fixed = cut_lineage(df)
    return F.broadcast(fixed) if fixed.count() <= max_rows else fixed
