"""Cleaning: required fields, texts, numbers, dates, prices, categories."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from savora.functions import parse, text

TEXT_FIELDS = ("review_text", "restaurant_name", "category", "location")
RATING_FIELDS = ("overall_rating", "food_rating", "service_rating", "ambiance_rating", "rating")


def require_fields(df: DataFrame, fields: Sequence[str] = ("restaurant_id", "restaurant_name")) -> DataFrame:
    present = [f for f in fields if f in df.columns]
    return df.dropna(subset=present) if present else df


def coerce_ratings(df: DataFrame, fields: Sequence[str] = RATING_FIELDS) -> DataFrame:
    return df.withColumns({f: parse.to_number(F.col(f)) for f in fields if f in df.columns})


def add_price_band(df: DataFrame) -> DataFrame:
    if "price_range" not in df.columns:
        return df
    return (df.withColumn("price_level", parse.price_level(F.col("price_range")))
            .withColumn("price_band", parse.price_band(F.col("price_level"))))


def add_primary_category(df: DataFrame) -> DataFrame:
    if "category" not in df.columns:
        return df
    return df.withColumn("category_primary", parse.primary_category(F.col("category")))


def clean_reviews(df: DataFrame, reference_date: Column) -> DataFrame:
    """All cleaning steps.  ``reference_date`` anchors relative dates, so that the
    same input always gives the same output."""
    out = require_fields(df)
    if "category" in out.columns:  # before clean_text, which would drop the separators
        out = out.withColumn("category", parse.split_categories(F.col("category")))
    out = out.withColumns({f: text.clean_text(F.col(f)) for f in TEXT_FIELDS if f in out.columns})
    out = coerce_ratings(out)
    if "price_range" in out.columns:
        out = out.withColumn("price_range", text.strip(F.col("price_range")))
    if "review_date" in out.columns:
        out = out.withColumn("review_date", parse.mixed_date(F.col("review_date"), reference_date))
    return add_primary_category(add_price_band(out))


def blanks_to_null(df: DataFrame) -> DataFrame:
    """What a blank cell becomes once a table is stored and read back."""
    strings = [name for name, kind in df.dtypes if kind == "string"]
    return df.withColumns({c: text.blank_to_null(F.col(c)) for c in strings})
