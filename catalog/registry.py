"""Registration of queries and access to the tables they read."""

from __future__ import annotations

from functools import cached_property
from typing import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from catalog import bindings


class Tables:
    """The given tables and the review tables bound to them."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    @cached_property
    def documents(self) -> DataFrame:
        return self.dealt("documents", "doc_id")

    def dealt(self, name: str, key: str) -> DataFrame:
        """A table whose rows are much work each.  A test file is one split however much that is, so it is dealt to the cores; a
        table that has as many splits as cores is read as it is."""
        df, cores = self.spark.read.parquet(f"{self.folder}/{name}.parquet"), self.spark.sparkContext.defaultParallelism
        return df.repartition(cores, key) if df.rdd.getNumPartitions() < cores else df

    @cached_property
    def texts(self) -> DataFrame:
        return bindings.texts(self)

    @cached_property
    def scored(self) -> DataFrame:
        return bindings.scored(self)

    @cached_property
    def judged(self) -> DataFrame:
        return bindings.judged(self)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None, uses: str = ""):
    """Register a query.  ``uses`` names the bound tables its SQL reads."""
    def register(build: Callable[[Tables], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"{name} is registered twice")
        QUERIES[name] = lambda spark, folder: build(Tables(spark, folder))
        if sql is not None:
            ORACLE[name] = bindings.with_tables(uses.split(), sql)
        return build
    return register


def r6(column: Column | str, name: str | None = None) -> Column:
    """Six decimals: what the comparison of doubles can bear."""
    base = F.col(column) if isinstance(column, str) else column
    label = name or (column if isinstance(column, str) else None)
    rounded = F.round(base.cast("double"), 6)
    return rounded.alias(label) if label else rounded
