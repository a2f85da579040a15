"""Row numbers and running totals over a whole table without a single-task window.

The order is cut into buckets.  Counting per bucket gives a small table whose
running sum says how many rows come before each bucket; inside a bucket an
ordinary window finishes the job.  Every task sees one bucket.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window, functions as F

BUCKET = "_bucket"


def keep_first(df: DataFrame, keys: Sequence[str | Column], order: Sequence[str | Column],
               n: int = 1) -> DataFrame:
    """First ``n`` rows per key.

    Spark limits each group before the shuffle, so a key that holds a third of
    all rows sends at most ``n`` rows per input task.
    """
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(window)).filter(F.col("_rank") <= n).drop("_rank")


ROWS_PER_BUCKET = 1_000_000


def bucket_count(df: DataFrame, least: int = 256) -> int:
    """Buckets for the rows of a table; results do not depend on their number."""
    return max(least, -(-df.count() // ROWS_PER_BUCKET))


def range_buckets(df: DataFrame, column: str, buckets: int | None = None) -> DataFrame:
    """Add the bucket of a numeric column, cut at its approximate quantiles."""
    buckets = buckets or bucket_count(df)
    numeric = df.select(F.col(column).cast("double").alias(column))
    probabilities = [i / buckets for i in range(1, buckets)]
    cuts = sorted(set(numeric.approxQuantile(column, probabilities, 0.5 / buckets)))
    splits = [float("-inf"), *cuts, float("inf")]
    if len(splits) < 3:
        return df.withColumn(BUCKET, F.lit(0.0))
    scratch = "_order_value"
    return (Bucketizer(splits=splits, inputCol=scratch, outputCol=BUCKET)
            .transform(df.withColumn(scratch, F.col(column).cast("double")))
            .drop(scratch))


def hash_buckets(df: DataFrame, digest: str, digits: int = 3) -> DataFrame:
    """Add the bucket of a hex digest: its leading digits, which follow its order."""
    return df.withColumn(BUCKET, F.substring(digest, 1, digits))


def _before(totals: DataFrame, by: Sequence[str], descending: bool) -> DataFrame:
    order = F.col(BUCKET).desc() if descending else F.col(BUCKET)
    earlier = (Window.partitionBy(*by).orderBy(order)
               .rowsBetween(Window.unboundedPreceding, -1))
    return totals.select(*by, BUCKET,
                         F.coalesce(F.sum("_total").over(earlier), F.lit(0)).alias("_before"))


def number_rows(df: DataFrame, order: Sequence[Column | str], name: str,
                by: Sequence[str] = (), descending: bool = False) -> DataFrame:
    """Number the rows of a bucketed table 1, 2, 3 ... per ``by``.

    ``order`` must agree with the bucket order and leave no ties.
    """
    totals = df.groupBy(*by, BUCKET).agg(F.count("*").alias("_total"))
    inside = Window.partitionBy(*by, BUCKET).orderBy(*order)
    return (df.join(_before(totals, by, descending), [*by, BUCKET])
            .withColumn(name, F.col("_before") + F.row_number().over(inside))
            .drop("_before", BUCKET))


def running_total(df: DataFrame, measure: str, order: Sequence[Column | str], name: str,
                  by: Sequence[str] = (), descending: bool = False) -> DataFrame:
    """Sum of ``measure`` over all rows up to and including each one."""
    totals = df.groupBy(*by, BUCKET).agg(F.sum(measure).alias("_total"))
    inside = (Window.partitionBy(*by, BUCKET).orderBy(*order)
              .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return (df.join(_before(totals, by, descending), [*by, BUCKET])
            .withColumn(name, F.col("_before") + F.sum(measure).over(inside))
            .drop("_before", BUCKET))


def surrogate_key(df: DataFrame, order: str, name: str = "row_id", buckets: int | None = None) -> DataFrame:
    """Sequential key from 1 in the order of a unique numeric column."""
    return number_rows(range_buckets(df, order, buckets), [order], name)


def dense_rank(df: DataFrame, value: str, name: str, buckets: int | None = None) -> DataFrame:
    """Dense rank of the distinct values, highest first; NULL stays unranked."""
    distinct = df.select(value).filter(F.col(value).isNotNull()).distinct()
    ranked = number_rows(range_buckets(distinct, value, buckets),
                         [F.col(value).desc()], name, descending=True)
    return df.join(ranked, value, "left")


def sized_partitions(df: DataFrame, rows: int, rows_per_partition: int = 50_000) -> DataFrame:
    """As many partitions as the rows fill: an iterative fit pays for each one in every pass."""
    return df.repartition(max(1, -(-rows // rows_per_partition)))
