"""Stored intermediate tables and small expression helpers."""

from __future__ import annotations

import ctypes
import gc
import sys
import tempfile
import uuid
from typing import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

CHECKPOINT_DIR = "spark.checkpoint.dir"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors share, as ``spark.checkpoint.dir`` names it.

    Only a local session without that setting gets a temporary folder.
    """
    configured = spark.conf.get(CHECKPOINT_DIR, None) or spark.sparkContext.getCheckpointDir()
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(f"set {CHECKPOINT_DIR} to a folder every executor can reach")
    made = tempfile.mkdtemp(prefix="savora-shared-")
    spark.conf.set(CHECKPOINT_DIR, made)
    return made


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """The table written to the shared folder and read again: its lineage ends there."""
    path = new_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def kept_by_worker(name: str, make: Callable[[], object]) -> object:
    """What ``make`` gives, once per Python worker.

    Functions travel to the tasks by value, and their module's variables with them, so those would be new in every task.
    """
    kept = sys.__dict__.setdefault("_savora_kept", {})
    if name not in kept:
        kept[name] = make()
    return kept[name]


def tidy(batches: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """The same stage of a Python worker, which gives its free memory back to the system at the end.

    A worker lives through many stages; what one of them leaves unused lies beside the memory of the next ones.
    """
    def run(parts: Iterator) -> Iterator:
        yield from batches(parts)
        gc.collect()
        pa.default_memory_pool().release_unused()
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # only the GNU library has it
        if trim:
            trim(0)
    return run


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` computed once per row, also inside lambda functions."""
    return F.transform(F.array(value), use)[0]


def slots(rows: int, per_task: int, least: int = 1) -> int:
    """Tasks that ``rows`` need at ``per_task`` each."""
    return max(least, -(-rows // per_task))
