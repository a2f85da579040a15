"""One identity per entity, one copy per review, metadata shared between sources."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from savora import schemas
from savora.functions import sentiment, text
from savora.operators.ordering import keep_first

MIN_REVIEW_LENGTH = 10
ROWS_PER_CHUNK = 10_000  # consecutive ordinals: what a task fills at once of an entity, however many rows that has


def unify_restaurants(df: DataFrame) -> DataFrame:
    """Give every entity one id built from its normalised name.

    An entity whose name normalises to nothing keeps its source id as key.
    """
    source_id = F.col("restaurant_id")
    key = F.coalesce(text.blank_to_null(text.name_key(F.col("restaurant_name"))),
                     source_id.cast("string"), F.lit(""))
    return (df.withColumn("source_restaurant_id", source_id)
            .withColumn("restaurant_key", key)
            .withColumn("restaurant_id", text.stable_id(F.col("restaurant_key"))))


def shared_entities(df: DataFrame) -> DataFrame:
    """Keys that more than one source id maps to."""
    return (df.groupBy("restaurant_key")
            .agg(F.count_distinct("source_restaurant_id").alias("source_ids"))
            .filter(F.col("source_ids") > 1))


def long_enough(df: DataFrame, key: Column, minimum: int = MIN_REVIEW_LENGTH) -> DataFrame:
    return df.filter(F.length(key) >= minimum)


def deduplicate_reviews(df: DataFrame, order: str = "row_idx",
                        minimum: int = MIN_REVIEW_LENGTH) -> DataFrame:
    """Keep the first copy of every text of an entity; drop texts too short to tell.

    The window groups by the digest of the key, so the shuffle carries 32 bytes
    instead of a second copy of the text.  Length is a property of the key, so it
    can be tested after the window; tested before, the key would be built twice.
    """
    keyed = df.withColumn("_text_key", text.review_key(F.col("review_text")))
    digested = keyed.withColumns({"_text_key": F.unhex(F.sha2("_text_key", 256)),
                                  "_key_length": F.length("_text_key")})
    first = keep_first(digested, ["restaurant_id", "_text_key"], [order])
    return first.filter(F.col("_key_length") >= minimum).drop("_text_key", "_key_length")


def remove_duplicates(df: DataFrame, subset: Sequence[str] = ("restaurant_id", "review_text"),
                      order: str = "row_idx") -> DataFrame:
    """Keep the first row of every combination of values; strings are compared by their digest."""
    kinds = dict(df.dtypes)
    keys = {f"_key_{c}": F.unhex(F.sha2(c, 256)) if kinds[c] == "string" else F.col(c) for c in subset}
    return keep_first(df.withColumns(keys), list(keys), [order]).drop(*keys)


def fill_metadata(df: DataFrame, columns: Sequence[str] = schemas.META_COLUMNS,
                  entity: str = "restaurant_id", order: str = "row_idx",
                  rows_per_chunk: int = ROWS_PER_CHUNK) -> DataFrame:
    """Fill each column forward within its entity, then backward.

    A row keeps its own value, else takes the last one before it, else the first
    one after it.  An entity may hold a third of all rows, so its rows are cut
    into chunks of consecutive ordinals: a window fills inside a chunk, and a
    small table per (entity, chunk) carries values across chunks.
    """
    present = [c for c in columns if c in df.columns and c != entity]
    absent = [c for c in columns if c not in df.columns]
    rows = df.withColumn("_chunk", F.floor(F.col(order) / rows_per_chunk))

    ends = rows.groupBy(entity, "_chunk").agg(*[
        agg for c in present for agg in (
            F.min_by(c, F.when(F.col(c).isNotNull(), F.col(order))).alias(f"_first_{c}"),
            F.max_by(c, F.when(F.col(c).isNotNull(), F.col(order))).alias(f"_last_{c}"))])
    chunks = Window.partitionBy(entity).orderBy("_chunk")
    earlier = chunks.rowsBetween(Window.unboundedPreceding, -1)
    # the first value from here on is the last one met in reversed order: a growing frame, computed once
    later = Window.partitionBy(entity).orderBy(F.desc("_chunk")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    carried = ends.select(entity, "_chunk", *[
        F.coalesce(F.last(f"_last_{c}", ignorenulls=True).over(earlier),
                   F.last(f"_first_{c}", ignorenulls=True).over(later)).alias(f"_carried_{c}")
        for c in present])

    inside = (Window.partitionBy(entity, "_chunk").orderBy(order)
              .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    filled = rows.select(*[c for c in rows.columns if c not in present], *[
        F.last(c, ignorenulls=True).over(inside).alias(c) for c in present])
    # same keys as the window, so the rows are shuffled once for both
    same_chunk = (filled[entity] == carried[entity]) & (filled["_chunk"] == carried["_chunk"])
    joined = filled.join(carried, same_chunk, "left")
    names = [c for c in df.columns]
    return joined.select(
        *[F.coalesce(filled[c], carried[f"_carried_{c}"]).alias(c) if c in present else filled[c]
          for c in names],
        *[F.lit(None).cast("string").alias(c) for c in absent])


def add_aspect_sentiments(df: DataFrame,
                          lexicon: sentiment.Lexicon = sentiment.RESTAURANT_LEXICON) -> DataFrame:
    """Attach the labels and the mention flags of every aspect as native maps."""
    details = sentiment.aspect_details(F.col("review_text"), lexicon)
    scored = df.withColumn("_details", details)

    def as_map(part: str) -> Column:
        return F.create_map(*[x for a in lexicon.aspects
                              for x in (F.lit(a), F.col(f"_details.{a}.{part}"))])

    return (scored.withColumn("aspect_sentiments", as_map("label"))
            .withColumn("aspect_mentions", as_map("mentioned"))
            .drop("_details"))


def field_coverage(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Non-null count and percentage per column, in one pass."""
    totals = df.agg(F.count("*").alias("_rows"),
                    *[F.count(c).alias(f"_n_{c}") for c in columns])
    lines = F.array(*[F.struct(F.lit(c).alias("field"), F.col(f"_n_{c}").alias("present"),
                               F.col("_rows").alias("total")) for c in columns])
    return (totals.select(F.inline(lines))
            .withColumn("pct", F.try_divide(F.col("present") * 100.0, F.col("total").cast("double"))))
