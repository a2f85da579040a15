"""Ratings that contradict the reviews behind them."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from savora import fixed_values as fixed
from savora.functions import scores
from savora.operators import ordering
from savora.sources import shared


def name_summary(df: DataFrame, order: str = "row_idx") -> DataFrame:
    """Per name: first rating, mean rating and how many rows have one, mean tone, rows.

    The tone of a row is the mean of all its aspect scores, mentioned or not.
    """
    present = scores.present_aspects(df)
    tone = scores.row_mean([F.col(scores.score_col(a)) for a in present]) if present else F.lit(None).cast("double")
    rating = F.col("overall_rating").cast("double")
    return (df.filter(F.col("restaurant_name").isNotNull())
            .groupBy("restaurant_name").agg(
                F.min_by(rating, F.when(rating.isNotNull(), F.col(order))).alias("rating"),
                F.avg(rating).alias("nota"), F.count(rating).alias("rated"),
                F.avg(tone).alias("sentimiento"), F.count("*").alias("resenas")))


def contradictions(names: DataFrame, low: float = fixed.LOW_RATING,
                   favourable: float = fixed.FAVOURABLE_SENTIMENT) -> DataFrame:
    """Names rated strictly below ``low`` whose reviews read well on average."""
    return (names.filter((F.col("rating") < low) & (F.col("sentimiento") >= favourable))
            .select("restaurant_name", "rating", "sentimiento", "resenas")
            .orderBy("rating", "restaurant_name"))


def suspicious_ratings(df: DataFrame, order: str = "row_idx",
                       low: float = fixed.LOW_RATING,
                       favourable: float = fixed.FAVOURABLE_SENTIMENT) -> DataFrame:
    """The contradictions of a review table; none without ratings or scores."""
    if not {"restaurant_name", "overall_rating"} <= set(df.columns):
        return df.sparkSession.createDataFrame(
            [], "restaurant_name string, rating double, sentimiento double, resenas long")
    return contradictions(name_summary(df, order), low, favourable)


def suspicious_names(df: DataFrame, order: str = "row_idx") -> DataFrame:
    return suspicious_ratings(df, order).select("restaurant_name").distinct()


def without_suspicious(df: DataFrame, flagged: DataFrame) -> DataFrame:
    """Rows whose name is not flagged."""
    return df.join(flagged.select("restaurant_name"), "restaurant_name", "left_anti")


def flagged_list(flagged: DataFrame) -> DataFrame:
    """Every flagged name with its place, lowest rating first: (rank, restaurant_name, rating, sentimiento, resenas)."""
    numbered = ordering.number_rows(ordering.range_buckets(shared.stored(flagged, "flagged"), "rating"), ["rating", "restaurant_name"], "rank")
    return numbered.select("rank", "restaurant_name", "rating", "sentimiento", "resenas")


def top_names(df: DataFrame, order: Sequence[str], name: str, most: int | None = None) -> DataFrame:
    """One row: the number of rows ``n``, and all ``names`` in order, joined by commas; with ``most``, the first ones and a count of the others."""
    first = df if most is None else df.orderBy(*order).limit(most)
    joined = first.agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(*order, F.col(name).alias("_name")))), lambda x: x["_name"]), ", ")).scalar()
    total = df.agg(F.count("*").cast("int").alias("n"))
    if most is None:
        return total.select("n", joined.alias("names"))
    return total.select("n", F.concat(joined, F.when(F.col("n") > most, F.format_string(fixed.MORE_NAMES, F.col("n") - most)).otherwise("")).alias("names"))


def quality_note(flagged: DataFrame, most: int | None = None) -> DataFrame:
    """One row with the warning, or with '' when nothing is flagged.  It spells out all names, or counts them and spells out the first ``most``."""
    return top_names(flagged, ["rating", "restaurant_name"], "restaurant_name", most).select(
        F.when(F.col("n") > 0, F.format_string(fixed.QUALITY_NOTE, "n", "names")).otherwise("").alias("note"))
