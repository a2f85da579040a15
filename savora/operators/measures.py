"""Business measures over the star schema.

A filter context is a filter on the inputs; the row headers of a visual are the
``by`` columns.  Every sentiment measure is a ratio of sums, so the aspect fact
is reduced once to additive parts per (entity, aspect, ...) and only that small
table meets the entity dimension.  The reduction combines on the map side, which
also takes the heat out of an entity that holds a third of the fact.
"""

from __future__ import annotations

from functools import reduce
from typing import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from savora import fixed_values as fixed
from savora.operators import ordering
from savora.operators.ordering import keep_first

PARTS = ("rows", "mentions", "score_sum", "scored", "positive", "negative")


# --- base measures -----------------------------------------------------------

def base_measures(reviews: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Volume and coverage of the review fact."""
    return reviews.groupBy(*by).agg(
        F.count("*").alias("total_reviews"),
        F.count_distinct("RestauranteID").alias("total_restaurants"),
        F.avg("CalificaciónReseña").alias("avg_rating"),
        F.count("CalificaciónReseña").alias("rated_reviews"),
        F.avg("Palabras").alias("words_per_review"))


# --- sentiment measures ------------------------------------------------------

def aspect_parts(aspects: DataFrame, by: Sequence[str]) -> DataFrame:
    """Additive parts of the sentiment measures per ``by``."""
    said = F.coalesce(F.col("Mencionado"), F.lit(False))
    return aspects.groupBy(*by).agg(
        F.count("*").alias("rows"),
        F.count_if(said).alias("mentions"),
        F.sum(F.when(said, F.col("Puntaje"))).alias("score_sum"),
        F.count(F.when(said, F.col("Puntaje"))).alias("scored"),
        F.count_if(said & (F.col("Sentimiento") == fixed.BUCKET_POSITIVE)).alias("positive"),
        F.count_if(said & (F.col("Sentimiento") == fixed.BUCKET_NEGATIVE)).alias("negative"))


def regroup(parts: DataFrame, by: Sequence[str], *more: Column) -> DataFrame:
    return parts.groupBy(*by).agg(*[F.sum(p).alias(p) for p in PARTS], *more)


def _ratio(a: str | Column, b: str | Column) -> Column:
    a = F.col(a) if isinstance(a, str) else a
    b = F.col(b) if isinstance(b, str) else b
    return F.try_divide(a.cast("double"), b.cast("double"))


def mean_sentiment() -> Column:
    return _ratio("score_sum", "scored")


def sentiment_measures(aspects: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """The nine sentiment measures per ``by``; a division by zero is NULL."""
    entity = ["RestauranteID"] if "RestauranteID" not in by else []
    parts = aspect_parts(aspects, [*by, *entity])
    complaint = (F.count_distinct(F.when(F.col("negative") > 0, F.col("RestauranteID")))
                 if not entity else F.count_if((F.col("negative") > 0) & F.col("RestauranteID").isNotNull()))
    return measures_of(regroup(parts, by, complaint.alias("restaurants_with_complaints")))


def measures_of(grouped: DataFrame) -> DataFrame:
    """Turn additive parts into the measures, keeping the other columns."""
    keep = [c for c in grouped.columns if c not in PARTS]
    positive, negative = _ratio("positive", "mentions"), _ratio("negative", "mentions")
    return grouped.select(
        *keep, mean_sentiment().alias("mean_sentiment"), "mentions",
        _ratio("mentions", "rows").alias("coverage"),
        F.col("positive").alias("positive_mentions"), F.col("negative").alias("negative_mentions"),
        positive.alias("pct_positive"), negative.alias("pct_negative"),
        (positive - negative).alias("opinion_balance"))


def entity_parts(aspects: DataFrame, restaurants: DataFrame, attributes: Sequence[str],
                 extra: Sequence[str] = ("Aspecto",)) -> DataFrame:
    """Parts per entity joined with the entity's attributes."""
    parts = aspect_parts(aspects, ["RestauranteID", *extra])
    return parts.join(restaurants.select("RestauranteID", *attributes), "RestauranteID", "left")


def attribute_matrix(aspects: DataFrame, restaurants: DataFrame, attribute: str,
                     measure: str = "mean_sentiment") -> DataFrame:
    """Attribute by aspect matrix of one measure, with the four aspects as columns."""
    grouped = measures_of(regroup(entity_parts(aspects, restaurants, [attribute]), [attribute, "Aspecto"]))
    labels = [fixed.ASPECT_LABELS[a] for a in fixed.ASPECTS]
    return grouped.groupBy(attribute).pivot("Aspecto", labels).agg(F.first(measure))


def negative_share(aspects: DataFrame, by: Sequence[str] = ("Aspecto",)) -> DataFrame:
    return measures_of(aspect_parts(aspects, list(by))).select(*by, "mentions", "negative_mentions", "pct_negative")


# --- imbalance ---------------------------------------------------------------

def aspect_gap(aspects: DataFrame, by: Sequence[str] = ("RestauranteID",)) -> DataFrame:
    """Distance between the best and the worst aspect, and their names.

    The gap needs two aspects with data.  Ties are all named, in aspect order.
    A group holds at most one value per aspect.
    """
    means = aspect_parts(aspects, [*by, "Aspecto"]).withColumn("mean", mean_sentiment())
    place = F.array_position(F.array(*[F.lit(name) for name, _, _ in fixed.ASPECT_DIM_ROWS]), F.col("Aspecto"))
    valid = F.col("mean").isNotNull()
    grouped = means.groupBy(*by).agg(
        F.max("mean").alias("_best"), F.min("mean").alias("_worst"), F.count_if(valid).alias("_n"),
        F.array_sort(F.collect_list(F.when(valid, F.struct(place.alias("place"), "Aspecto", "mean")))).alias("_a"))

    def named(extreme: str) -> Column:
        ties = F.filter("_a", lambda a: a["mean"] == F.col(extreme))
        return F.nullif(F.array_join(F.transform(ties, lambda a: a["Aspecto"]), ", "), F.lit(""))

    return grouped.select(
        *by, F.when(F.col("_n") > 1, F.col("_best") - F.col("_worst")).alias("gap"),
        named("_best").alias("best_aspect"), named("_worst").alias("worst_aspect"))


# --- comparison --------------------------------------------------------------

def peer_benchmark(aspects: DataFrame, restaurants: DataFrame,
                   peers: dict[str, str] = {"cuisine": "CocinaPrincipal", "zone": "Zona"}) -> DataFrame:
    """Entity sentiment next to that of all entities with the same cuisine or zone.

    The peer figure weights every mention alike.  It is an aggregate joined back,
    not a window, so a cuisine that holds a third of the entities is no hot task.
    A difference without own mentions is NULL.
    """
    own = entity_parts(aspects, restaurants, list(peers.values()), extra=())
    out = own
    for name, attribute in peers.items():
        means = (own.groupBy(attribute)
                 .agg(F.sum("score_sum").alias("_s"), F.sum("scored").alias("_n"))
                 .select(F.col(attribute).alias("_peer"), _ratio("_s", "_n").alias(f"{name}_sentiment")))
        out = out.join(means, F.col(attribute).eqNullSafe(F.col("_peer")), "left").drop("_peer")
    return out.select("RestauranteID", *peers.values(), mean_sentiment().alias("mean_sentiment"), *[
        c for name in peers for c in (
            F.col(f"{name}_sentiment"), (mean_sentiment() - F.col(f"{name}_sentiment")).alias(f"diff_{name}"))])


def sentiment_rank(aspects: DataFrame, by: str = "RestauranteID", buckets: int | None = None) -> DataFrame:
    """Dense rank of the entities in the current selection, best first.

    An entity without mentions stays unranked but competes as zero, so it pushes
    down those below zero.
    """
    means = aspect_parts(aspects, [by]).select(by, mean_sentiment().alias("mean_sentiment"),
                                               F.coalesce(mean_sentiment(), F.lit(0.0)).alias("_value"))
    means = means.persist()  # one row per entity; the quantiles of the buckets read it before the ranks do
    ranked = ordering.dense_rank(means, "_value", "_rank", buckets)
    return ranked.select(by, "mean_sentiment",
                         F.when(F.col("mean_sentiment").isNotNull(), F.col("_rank")).alias("rank"))


def share_of_total(counted: DataFrame, measure: str = "total_reviews", name: str = "share") -> DataFrame:
    """Part of the selected total; the total is a scalar subquery."""
    total = counted.agg(F.sum(measure).alias("t"))
    return counted.withColumn(name, F.try_divide(F.col(measure).cast("double"), total.scalar().cast("double")))


def volume_against_sentiment(aspects: DataFrame, restaurants: DataFrame, reviews: DataFrame,
                             min_reviews: int = 5) -> DataFrame:
    """Entities with enough reviews: volume, sentiment and distance to their cuisine."""
    volume = reviews.groupBy("RestauranteID").agg(F.count("*").alias("total_reviews")).filter(
        F.col("total_reviews") >= min_reviews)
    return (peer_benchmark(aspects, restaurants, {"cuisine": "CocinaPrincipal"})
            .join(volume, "RestauranteID"))


def decomposition_tree(aspects: DataFrame, restaurants: DataFrame,
                       levels: Sequence[str] = ("Zona", "CocinaPrincipal", "BandaPrecio", "Aspecto"),
                       children: int = 3) -> DataFrame:
    """Negative mentions from the root down, the largest children of every node.

    ``levels`` is the drill order.  Counts are grouped by every level once; each
    level is then read from those below the nodes kept above it, at most
    ``children ** depth`` rows.
    """
    spark = aspects.sparkSession
    attributes = [c for c in levels if c != "Aspecto"]
    leaves = (entity_parts(aspects, restaurants, attributes).groupBy(*levels)
              .agg(F.sum("negative").alias("_n")).filter(F.col("_n") > 0)
              .select(*[F.coalesce(F.col(c).cast("string"), F.lit("(blank)")).alias(c) for c in levels], "_n")).persist()
    schema = ", ".join(["depth int", *[f"`{c}` string" for c in levels], "rank int", "negative_mentions long"])
    try:
        total = leaves.agg(F.sum("_n")).first()[0]
        rows = [] if total is None else [(0, *[None] * len(levels), 1, total)]
        kept: list[tuple] = []
        for d in range(1, len(levels) + 1 if rows else 1):
            path, above = list(levels[:d]), list(levels[:d - 1])
            below = leaves
            if above:
                parents = spark.createDataFrame(kept, ", ".join(f"`{c}` string" for c in above))
                below = leaves.join(F.broadcast(parents), above, "left_semi")
            siblings = Window.partitionBy(*above).orderBy(F.desc("_n"), path[-1])
            found = (below.groupBy(*path).agg(F.sum("_n").alias("_n")).withColumn("rank", F.row_number().over(siblings))
                     .filter(F.col("rank") <= children).collect())
            kept = [tuple(r[c] for c in path) for r in found]
            rows += [(d, *own, *[None] * (len(levels) - d), r["rank"], r["_n"]) for own, r in zip(kept, found)]
    finally:
        leaves.unpersist()
    return spark.createDataFrame(rows, schema)
