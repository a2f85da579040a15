"""Repeatable stratified samples, hold-outs and folds.

Rows are put in the order of a seeded digest of their id.  The digest's leading
digits are the buckets, so a class that holds most rows is numbered by many tasks.
"""

from __future__ import annotations

from math import ceil, floor

from pyspark.sql import DataFrame, functions as F

from savora.operators.ordering import hash_buckets, number_rows

SEED = 42


def shuffle_rank(df: DataFrame, label: str, id_column: str, seed: int = SEED,
                 name: str = "_place", digits: int = 3) -> DataFrame:
    """Number the rows of each class in the order of their digest."""
    digest = F.md5(F.concat_ws(":", F.col(id_column).cast("string"), F.lit(str(seed))))
    keyed = hash_buckets(df.withColumn("_digest", digest), "_digest", digits)
    return number_rows(keyed, ["_digest", id_column], name, by=[label]).drop("_digest")


def quotas(counts: dict[str, int], wanted: int) -> dict[str, int]:
    """Split ``wanted`` over the classes in proportion; largest remainders first."""
    total = sum(counts.values())
    exact = {c: wanted * n / total for c, n in counts.items()}
    share = {c: floor(x) for c, x in exact.items()}
    by_remainder = sorted(counts, key=lambda c: (share[c] - exact[c], c))
    for c in by_remainder[:wanted - sum(share.values())]:
        share[c] += 1
    return share


def _class_counts(df: DataFrame, label: str) -> dict[str, int]:
    return {r[label]: r["n"] for r in df.groupBy(label).agg(F.count("*").alias("n")).collect()}


def stratified_sample(df: DataFrame, label: str, id_column: str, size: int, seed: int = SEED) -> DataFrame:
    """Exactly ``size`` rows in the class proportions; all rows when there are fewer."""
    counts = _class_counts(df, label)
    if size >= sum(counts.values()):
        return df
    quota = None
    for c, n in quotas(counts, size).items():
        hit = F.col(label) == c
        quota = F.when(hit, n) if quota is None else quota.when(hit, n)
    return shuffle_rank(df, label, id_column, seed).filter(F.col("_place") <= quota).drop("_place")


def hold_out(df: DataFrame, label: str, id_column: str, test_size: float = 0.25,
             seed: int = SEED) -> tuple[DataFrame, DataFrame]:
    """(train, test) with the class proportions kept."""
    size = ceil(test_size * sum(_class_counts(df, label).values()))
    test = stratified_sample(df, label, id_column, size, seed)
    return rows_outside(df, test, id_column), test


def rows_outside(df: DataFrame, sample: DataFrame, id_column: str) -> DataFrame:
    return df.join(sample.select(id_column), id_column, "left_anti")


def folds(df: DataFrame, label: str, id_column: str, k: int = 5, seed: int = SEED) -> DataFrame:
    """Fold number 0..k-1, dealt out in turn within each class."""
    ranked = shuffle_rank(df, label, id_column, seed)
    return ranked.withColumn("fold", ((F.col("_place") - 1) % k).cast("int")).drop("_place")
