"""Explicit schemas: one list of fields per stage."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame, functions as F, types as T

SOURCE_SCHEMA = T.StructType([
    T.StructField("restaurant_id", T.StringType()),
    T.StructField("restaurant_name", T.StringType()),
    T.StructField("category", T.StringType()),
    T.StructField("location", T.StringType()),
    T.StructField("address", T.StringType()),
    T.StructField("price_range", T.StringType()),
    T.StructField("overall_rating", T.DoubleType()),
    T.StructField("review_rating", T.DoubleType()),
    T.StructField("food_rating", T.DoubleType()),
    T.StructField("service_rating", T.DoubleType()),
    T.StructField("ambiance_rating", T.DoubleType()),
    T.StructField("review_text", T.StringType()),
    T.StructField("review_date", T.StringType()),
    T.StructField("reviewer_name", T.StringType()),
    T.StructField("source", T.StringType()),
])

# Order of the unified table's columns.
RAW_COLUMNS = (
    "restaurant_id", "restaurant_key", "restaurant_name", "category", "location",
    "address", "price_range", "overall_rating", "review_rating",
    "food_rating", "service_rating", "ambiance_rating",
    "review_text", "review_date", "reviewer_name", "source", "source_restaurant_id",
    "aspect_sentiments", "aspect_mentions",
)

# Entity attributes that one source may complete from another.
META_COLUMNS = (
    "restaurant_name", "category", "location", "address", "price_range",
    "overall_rating", "food_rating", "service_rating", "ambiance_rating",
)

REQUIRED_COLUMNS = ("restaurant_id", "restaurant_name", "source")

_DOUBLES = {"overall_rating", "review_rating", "food_rating", "service_rating", "ambiance_rating"}


def conform(df: DataFrame, columns: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """Project onto ``columns`` in order; absent ones become NULL."""
    def column(name: str):
        if name in df.columns:
            return F.col(name)
        return F.lit(None).cast("double" if name in _DOUBLES else "string").alias(name)
    return df.select(*keep, *[column(c) for c in columns])


def missing_columns(df: DataFrame, required: Sequence[str] = REQUIRED_COLUMNS) -> list[str]:
    return [c for c in required if c not in df.columns]
