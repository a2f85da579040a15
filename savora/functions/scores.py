"""Scores, buckets and labels derived from per-aspect columns."""

from __future__ import annotations

from functools import reduce
from operator import add
from typing import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from savora import fixed_values as fixed


def score_col(aspect: str) -> str:
    return f"sentiment_{aspect}_score"


def mention_col(aspect: str) -> str:
    return f"mentions_{aspect}"


def label_col(aspect: str) -> str:
    return f"sentiment_{aspect}"


def label_score(label: Column, unknown: float | None = 0.0) -> Column:
    """positive / neutral / negative as 1 / 0 / -1."""
    lowered = F.lower(label)
    score = None
    for name, value in fixed.LABEL_SCORES.items():
        score = F.when(lowered == name, value) if score is None else score.when(lowered == name, value)
    return score.otherwise(F.lit(unknown).cast("double"))


def row_mean(columns: Sequence[Column]) -> Column:
    """Mean of the non-null columns of a row; NULL when all are null."""
    total = reduce(add, [F.coalesce(c.cast("double"), F.lit(0.0)) for c in columns])
    present = reduce(add, [c.isNotNull().cast("int") for c in columns])
    return F.try_divide(total, present.cast("double"))


def mention_flag(df: DataFrame, aspect: str) -> Column:
    """True where the review discussed the aspect; an absent column counts every row."""
    name = mention_col(aspect)
    if name not in df.columns:
        return F.lit(True)
    column = F.col(name)
    if dict(df.dtypes)[name] == "boolean":
        return F.coalesce(column, F.lit(False))
    text = F.lower(F.trim(column.cast("string")))
    return F.coalesce(text.isin("true", "1", "yes"), F.lit(False))


def present_aspects(df: DataFrame, aspects: Sequence[str] = fixed.ASPECTS) -> list[str]:
    return [a for a in aspects if score_col(a) in df.columns]


def overall_sentiment(df: DataFrame, aspects: Sequence[str] = fixed.ASPECTS) -> Column:
    """Mean over the mentioned aspects, or over all of them when none is mentioned."""
    present = present_aspects(df, aspects)
    scores = [F.col(score_col(a)).cast("double") for a in present]
    flags = [mention_flag(df, a) for a in present]
    weighted = reduce(add, [F.when(f, F.coalesce(s, F.lit(0.0))).otherwise(0.0)
                            for s, f in zip(scores, flags)])
    mentioned = reduce(add, [f.cast("int") for f in flags])
    return F.coalesce(F.try_divide(weighted, mentioned.cast("double")), row_mean(scores))


def sentiment_bucket(score: Column, missing: str = fixed.BUCKET_NEUTRAL) -> Column:
    return (F.when(score.isNull(), missing)
            .when(score > fixed.BUCKET_EDGE, fixed.BUCKET_POSITIVE)
            .when(score < -fixed.BUCKET_EDGE, fixed.BUCKET_NEGATIVE)
            .otherwise(fixed.BUCKET_NEUTRAL))


def rating_tone(rating: Column) -> Column:
    """Band of a rating: high from 4.5, medium from 4, else low; missing apart."""
    return (F.when(rating.isNull(), "missing").when(rating >= 4.5, "high")
            .when(rating >= 4, "medium").otherwise("low"))


def match_tone(score: Column) -> Column:
    return F.when(score >= 80, "high").when(score >= 60, "medium").otherwise("low")


def overall_tone(score: Column) -> Column:
    """Label of an average: here the lower edge itself is already negative."""
    return (F.when(score > fixed.BUCKET_EDGE, fixed.BUCKET_POSITIVE)
            .when(score > -fixed.BUCKET_EDGE, fixed.BUCKET_NEUTRAL)
            .otherwise(fixed.BUCKET_NEGATIVE))


def rating_class(rating: Column) -> Column:
    """Binary class of a reviewer's own rating; no rating, no class."""
    return F.when(rating >= fixed.POSITIVE_FROM_RATING, fixed.POSITIVE_CLASS).when(
        rating.isNotNull(), fixed.MINORITY_CLASS)
