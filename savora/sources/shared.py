"""The folder that driver and executors share, and files that appear there only when whole."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"


def folder(spark: SparkSession) -> str:
    """As ``spark.checkpoint.dir`` names it; only a local session without that setting gets a temporary one."""
    configured = spark.conf.get(CHECKPOINT_DIR, None) or spark.sparkContext.getCheckpointDir()
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(f"set {CHECKPOINT_DIR} to a folder every executor can reach")
    made = tempfile.mkdtemp(prefix="savora-shared-")
    spark.conf.set(CHECKPOINT_DIR, made)
    return made


def fresh_path(spark: SparkSession, name: str) -> str:
    return f"{folder(spark)}/{uuid.uuid4().hex}-{name}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """The table written to the shared folder and read again: later jobs see the same rows, whatever happens to executors."""
    path = fresh_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _file(spark: SparkSession, path: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()), path


def delete(spark: SparkSession, path: str) -> None:
    system, target = _file(spark, path)
    system.delete(target, True)


def publish(spark: SparkSession, attempt: str, path: str) -> None:
    """Give a finished attempt its final name; what had that name before goes last."""
    system, source = _file(spark, attempt)
    _, target = _file(spark, path)
    _, aside = _file(spark, beside(path, "replaced"))
    replaced = system.exists(target) and system.rename(target, aside)
    if not system.rename(source, target):
        if replaced:
            system.rename(aside, target)
        raise OSError(f"{attempt} could not be renamed to {path}")
    if replaced:
        system.delete(aside, True)


def beside(path: str, kind: str) -> str:
    """A name of its own in the same folder, which readers of that folder skip."""
    parent, _, name = path.rstrip("/").rpartition("/")
    return f"{parent}/_{kind}-{uuid.uuid4().hex}-{name}" if parent else f"_{kind}-{uuid.uuid4().hex}-{name}"
