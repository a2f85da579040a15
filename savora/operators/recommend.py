"""Content-based recommendations: entity profiles scored against preferences."""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce
from operator import add
from typing import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from savora import fixed_values as fixed
from savora.functions import parse, scores
from savora.operators.explore import first_value

# The weight of each criterion.
CATEGORY_WEIGHT, PRICE_WEIGHT, ZONE_WEIGHT, ASPECT_WEIGHT, RATING_WEIGHT = 3.0, 2.0, 2.0, 3.0, 2.0
EXPLAINED_ASPECTS = ("comida", "servicio", "ambiente")


@dataclass(frozen=True)
class Preferences:
    category: str | None = None
    max_price: str | None = None
    location: str | None = None
    priority_aspects: Sequence[str] = field(default_factory=tuple)


def restaurant_profiles(df: DataFrame, order: str = "row_idx") -> DataFrame:
    """First attributes, mean rating, reviews and plain mean of every aspect score."""
    count = (first_value("review_count", order) if "review_count" in df.columns
             else F.count("review_text").alias("review_count"))
    attributes = [c for c in ("restaurant_name", "category", "price_range", "location") if c in df.columns]
    return df.groupBy("restaurant_id").agg(
        *[first_value(c, order) for c in attributes],
        F.avg("overall_rating").alias("overall_rating"), count,
        *[F.avg(scores.score_col(a)).alias(scores.score_col(a)) for a in scores.present_aspects(df)])


def match_score(profiles: DataFrame, wanted: Preferences) -> Column:
    """Share of the weights in play that the entity earns, from 0 to 100.

    Price, aspects and rating only count when both sides are known.
    """
    earned, weights = [], []

    def criterion(weight: float, fraction: Column, known: Column | None = None, of: float = 1.0) -> None:
        known = F.lit(True) if known is None else known
        earned.append(F.when(known, F.lit(weight) * fraction / F.lit(of)).otherwise(0.0))
        weights.append(F.when(known, F.lit(weight)).otherwise(0.0))

    def contains(column: str, text: str) -> Column:
        return F.coalesce(F.contains(F.lower(column), F.lit(text.lower())), F.lit(False)).cast("double")

    if wanted.category:
        criterion(CATEGORY_WEIGHT, contains("category", wanted.category))
    if wanted.max_price:
        price, budget = parse.price_level(F.col("price_range")), parse.price_level(F.lit(wanted.max_price))
        fraction = F.greatest(F.lit(0.0), F.lit(1.0) - F.greatest(price - budget, F.lit(0.0)) / F.lit(3.0))
        criterion(PRICE_WEIGHT, fraction, price.isNotNull() & budget.isNotNull())
    if wanted.location:
        criterion(ZONE_WEIGHT, contains("location", wanted.location))
    for aspect in wanted.priority_aspects or ():
        name = scores.score_col(aspect)
        if name in profiles.columns:
            criterion(ASPECT_WEIGHT, F.col(name) + 1.0, F.col(name).isNotNull(), of=2.0)
    criterion(RATING_WEIGHT, F.col("overall_rating"), F.col("overall_rating").isNotNull(), of=5.0)
    share = F.try_divide(reduce(add, earned), reduce(add, weights))
    return F.coalesce(F.rint(share * 100.0 * 10.0) / 10.0, F.lit(0.0))


def explanation(profiles: DataFrame, wanted: Preferences) -> Column:
    rating = F.col("overall_rating")
    parts = [F.when(rating >= 4.5, F.format_string(fixed.EXPLAIN_EXCELLENT, rating))
             .when(rating >= 4.0, F.format_string(fixed.EXPLAIN_GOOD, rating))]
    if wanted.category:
        hit = F.contains(F.lower("category"), F.lit(wanted.category.lower()))
        parts.append(F.when(hit, F.format_string(fixed.EXPLAIN_CATEGORY, "category")))
    for aspect in EXPLAINED_ASPECTS:
        name = scores.score_col(aspect)
        if name in profiles.columns:
            parts.append(F.when(F.col(name) > 0.5, F.lit(fixed.EXPLAIN_ASPECT % aspect)))
    joined = F.coalesce(F.nullif(F.concat_ws(". ", *parts), F.lit("")), F.lit(fixed.EXPLAIN_DEFAULT))
    return F.concat(joined, F.lit("."))


def recommend(df: DataFrame, wanted: Preferences, top_n: int = 5, min_rating: float = 0.0,
              order: str = "row_idx") -> DataFrame:
    """Best matches first.  The rating floor drops reviews before profiles are built."""
    if min_rating > 0 and "overall_rating" in df.columns:
        df = df.filter(F.col("overall_rating") >= min_rating)
    return recommend_from(restaurant_profiles(df, order), wanted, top_n)


def recommend_from(profiles: DataFrame, wanted: Preferences, top_n: int = 5) -> DataFrame:
    """The same over profiles that were computed before."""
    return (profiles.withColumn("match_score", match_score(profiles, wanted))
            .filter(F.col("match_score") > 0)
            .orderBy(F.desc("match_score"), "restaurant_id").limit(top_n)
            .select("restaurant_id", "restaurant_name", "category",
                    F.coalesce("overall_rating", F.lit(0.0)).alias("overall_rating"), "price_range",
                    "match_score", explanation(profiles, wanted).alias("explanation")))
