"""The batch chain from source tables to the clustered review table."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame

from savora import schemas
from savora.functions import sentiment
from savora.operators import clean, cluster, features, normalize, unify
from savora.sources import shared


def unified(sources: DataFrame, lexicon: sentiment.Lexicon = sentiment.RESTAURANT_LEXICON) -> DataFrame:
    """Identity, then duplicates, then metadata (a dropped copy donates nothing), then sentiment."""
    named = unify.unify_restaurants(sources)
    distinct = shared.stored(unify.deduplicate_reviews(named), "distinct")  # read twice: for what is carried and for the rows
    filled = unify.fill_metadata(distinct)
    labelled = unify.add_aspect_sentiments(filled, lexicon)
    return schemas.conform(labelled, schemas.RAW_COLUMNS, keep=("row_idx",))


def cleaned(raw: DataFrame, reference_date: Column) -> DataFrame:
    return clean.blanks_to_null(clean.clean_reviews(unify.remove_duplicates(raw), reference_date))


def normalized(clean_df: DataFrame, stopwords: Sequence[str] = ()) -> DataFrame:
    return normalize.add_text_features(normalize.normalize_reviews(clean_df, stopwords))


def featured(normal: DataFrame) -> DataFrame:
    """Feature table of the reviews; nothing later reads it."""
    return features.sentiment_features(features.encode_categories(features.add_restaurant_stats(normal)))


def clustered(normal: DataFrame, restarts: int = cluster.RESTARTS) -> DataFrame:
    return cluster.cluster_reviews(features.derive_aspect_columns(normal), restarts=restarts)


def run(sources: DataFrame, reference_date: Column,
        lexicon: sentiment.Lexicon = sentiment.RESTAURANT_LEXICON,
        restarts: int = cluster.RESTARTS) -> tuple[DataFrame, DataFrame]:
    """(features, clustered).  The normalised reviews feed both, so they are stored once, in the shared folder."""
    normal = shared.stored(normalized(cleaned(unified(sources, lexicon), reference_date)), "normalized")
    return featured(normal), clustered(normal, restarts)
