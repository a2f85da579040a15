"""Per-entity statistics and model-ready columns."""

from __future__ import annotations

from functools import reduce
from operator import add
from typing import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from savora import fixed_values as fixed
from savora.functions import parse, scores, sentiment, text
from savora.operators.explore import top_values


def restaurant_stats(df: DataFrame) -> DataFrame:
    return df.groupBy("restaurant_id", "restaurant_name").agg(
        F.count("review_text").alias("review_count"),
        F.bround(F.avg("overall_rating"), 2).alias("avg_rating"),
        F.bround(F.avg("word_count"), 2).alias("avg_word_count"),
        F.bround(F.avg("char_count"), 2).alias("avg_char_count"))


def add_restaurant_stats(df: DataFrame) -> DataFrame:
    """Left join of the entity statistics back onto the reviews.

    Adaptive execution splits an entity that holds too many rows.
    """
    return df.join(restaurant_stats(df), ["restaurant_id", "restaurant_name"], "left")


def category_columns(slugs: Sequence[tuple[str, str]]) -> dict[str, str]:
    """Column name per (category, slug); a name already taken gets _2, _3 ..."""
    names: dict[str, str] = {}
    for category, slug in slugs:
        name, suffix = f"cat_{slug}", 2
        while name in names:
            name, suffix = f"cat_{slug}_{suffix}", suffix + 1
        names[name] = category
    return names


def encode_categories(df: DataFrame, categories: Sequence[str] | None = None,
                      top_n: int = 10) -> DataFrame:
    """Numeric price level and one indicator per frequent category.

    Only the ``top_n`` category names come back to the driver.
    """
    if "price_range" in df.columns:
        level = F.coalesce(parse.price_level(F.col("price_range")), F.lit(fixed.DEFAULT_PRICE_LEVEL))
        df = df.withColumn("price_range_encoded", level)
    source = "category_primary" if "category_primary" in df.columns else "category"
    if source not in df.columns:
        return df
    if categories is None:
        chosen = top_values(df, source, top_n).select(source)
    else:
        chosen = df.sparkSession.createDataFrame([(c,) for c in categories], f"{source} string").coalesce(1)
    slugs = [tuple(row) for row in chosen.select(source, text.slug(F.col(source))).collect()]
    lowered = F.lower(F.coalesce(F.col(source).cast("string"), F.lit("nan")))
    return df.withColumns({
        name: F.contains(lowered, F.lit(category.lower())).cast("int")
        for name, category in category_columns(slugs).items()})


def sentiment_features(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Scores of the label columns, their mean, and how many are above or below zero.

    A label outside the known three scores NULL here, not zero.
    """
    columns = columns or [scores.label_col(a) for a in fixed.ASPECTS]
    present = [c for c in columns if c in df.columns]
    if not present:
        return df
    kinds = dict(df.dtypes)
    new = {f"{c}_score": F.when(F.col(c) == F.lower(F.col(c)), scores.label_score(F.col(c), None))
           for c in present if kinds[c] == "string"}
    df = df.withColumns(new)
    values = [F.col(f"{c}_score") for c in present if f"{c}_score" in df.columns]
    if not values:
        return df

    def count_where(test) -> Column:
        return reduce(add, [F.coalesce(test(v), F.lit(False)).cast("int") for v in values])

    out = df
    if len(values) == len(present):
        out = out.withColumn("overall_sentiment_score", scores.row_mean(values))
    return (out.withColumn("positive_aspect_count", count_where(lambda v: v > 0))
            .withColumn("negative_aspect_count", count_where(lambda v: v < 0)))


def add_sentiment_scores(df: DataFrame, prefix: str = "sentiment") -> DataFrame:
    """Numeric score per aspect label (unknown scores zero) and the row mean."""
    new = {}
    for aspect in fixed.ASPECTS:
        source = f"{prefix}_{aspect}" if f"{prefix}_{aspect}" in df.columns else scores.label_col(aspect)
        if source in df.columns:
            new[scores.score_col(aspect)] = scores.label_score(F.col(source))
    df = df.withColumns(new) if new else df
    present = [F.col(scores.score_col(a)) for a in scores.present_aspects(df)]
    return df.withColumn("overall_sentiment_score", scores.row_mean(present)) if present else df


def score_aspects(df: DataFrame, lexicon: sentiment.Lexicon = sentiment.RESTAURANT_LEXICON,
                  body: str = "review_text") -> DataFrame:
    """Label, score and mention column per aspect straight from the texts, without maps."""
    detailed = df.withColumn("_details", sentiment.aspect_details(F.col(body), lexicon))
    new = {}
    for a in lexicon.aspects:
        new[scores.label_col(a)] = F.col(f"_details.{a}.label")
        new[scores.score_col(a)] = scores.label_score(F.col(f"_details.{a}.label"))
        new[scores.mention_col(a)] = F.col(f"_details.{a}.mentioned")
    return detailed.withColumns(new).drop("_details")


def derive_aspect_columns(df: DataFrame) -> DataFrame:
    """Label, score and mention column per aspect, from the two stored maps.

    Native maps are read directly, text cells through the tolerant parser.
    Columns that already exist are left as they are.
    """
    aspects = fixed.ASPECTS
    have_scores = all(scores.score_col(a) in df.columns for a in aspects)
    have_mentions = all(scores.mention_col(a) in df.columns for a in aspects)
    if (have_scores and have_mentions) or "aspect_sentiments" not in df.columns:
        return df
    kinds = dict(df.dtypes)

    def label(aspect: str) -> Column:
        cell = F.col("aspect_sentiments")
        if kinds["aspect_sentiments"].startswith("map"):
            return F.lower(F.coalesce(F.try_element_at(cell, F.lit(aspect)), F.lit("neutral")))
        return parse.stored_label(cell, aspect)

    def mention(aspect: str) -> Column:
        if "aspect_mentions" not in df.columns:
            return F.lit(True)
        cell = F.col("aspect_mentions")
        if kinds["aspect_mentions"].startswith("map"):
            return F.coalesce(F.try_element_at(cell, F.lit(aspect)), F.lit(True))
        return parse.stored_flag(cell, aspect)

    if not have_scores:
        df = df.withColumns({scores.label_col(a): label(a) for a in aspects})
        df = df.withColumns({scores.score_col(a): scores.label_score(F.col(scores.label_col(a)))
                             for a in aspects})
    if not have_mentions:
        df = df.withColumns({scores.mention_col(a): mention(a) for a in aspects})
    return df


def impute_means(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Fill each column's gaps with its mean; one pass takes all means."""
    means = df.agg(*[F.avg(c).alias(c) for c in columns]).first()
    return df.withColumns({c: F.coalesce(F.col(c).cast("double"), F.lit(means[c]).cast("double")) for c in columns})


def clustering_columns(df: DataFrame) -> tuple[DataFrame, list[str]]:
    """Row-level feature columns with their gaps filled, and their names."""
    names = ["overall_rating", "avg_word_count", "price_range_encoded"]
    names += [c for c in df.columns if c.startswith("cat_")]
    names += ["overall_sentiment_score", "positive_aspect_count", "negative_aspect_count"]
    names = [c for c in names if c in df.columns]
    kinds = dict(df.dtypes)
    numeric = [c for c in names if kinds[c] in ("double", "bigint")]
    return impute_means(df, numeric) if numeric else df, names
