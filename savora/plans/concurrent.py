"""Independent jobs of one driver at the same time."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from typing import Callable, Sequence, TypeVar

from pyspark import inheritable_thread_target
from pyspark.sql import SparkSession

T = TypeVar("T")
AT_ONCE = 8


def side_by_side(jobs: Sequence[Callable[[], T]], at_once: int = AT_ONCE) -> list[T]:
    """Results in the order of the jobs.  A small iterative fit leaves most of a cluster idle between its passes; several
    of them share it.  The first failure is raised once the others have ended."""
    if len(jobs) < 2:
        return [job() for job in jobs]
    spark = SparkSession.getActiveSession()
    with ThreadPoolExecutor(min(at_once, len(jobs))) as pool:
        return [f.result() for f in [pool.submit(inheritable_thread_target(spark)(job)) for job in jobs]]
