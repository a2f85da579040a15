"""Normalised copies of the texts, language and word statistics."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame, functions as F

from savora.functions import text


def normalize_reviews(df: DataFrame, stopwords: Sequence[str] = ()) -> DataFrame:
    """The texts are already folded when stop words are removed, so a stop word
    written with an accent never matches."""
    new = {}
    if "review_text" in df.columns:
        new["review_text_normalized"] = text.remove_stopwords(
            text.normalize_text(F.col("review_text")), stopwords)
        new["review_language"] = text.detect_language(F.col("review_text"))
    for name in ("restaurant_name", "category"):
        if name in df.columns:
            new[f"{name}_normalized"] = text.normalize_text(F.col(name))
    return df.withColumns(new) if new else df


def add_text_features(df: DataFrame) -> DataFrame:
    if "review_text" not in df.columns:
        return df
    body = F.col("review_text")
    return df.withColumns({"word_count": text.word_count(body),
                           "char_count": text.char_count(body),
                           "avg_word_length": text.avg_word_length(body)})
