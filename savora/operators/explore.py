"""Filters, summaries, top lists and the other aggregates behind the dashboard."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from typing import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from savora import fixed_values as fixed
from savora.functions import parse, scores, text
from savora.operators import quality
from savora.operators.ordering import keep_first
from savora.sources import shared

ALL = "Todos"


def category_column(df: DataFrame) -> str:
    return "category_primary" if "category_primary" in df.columns else "category"


def price_column(df: DataFrame) -> str:
    return "price_band" if "price_band" in df.columns else "price_range"


# --- filters -----------------------------------------------------------------

@dataclass(frozen=True)
class Filters:
    """What the filter bar can ask for; the defaults filter nothing."""

    query: str = ""
    category: str = ALL
    price: str = ALL
    zone: str = ALL
    cluster: int | None = None
    min_rating: float = 0.0


def search(df: DataFrame, query: str) -> DataFrame:
    """Literal, case-insensitive substring of name and category."""
    needle = (query or "").strip().lower()
    if not needle:
        return df
    names = [c for c in ("restaurant_name", "category") if c in df.columns]
    haystack = F.concat_ws(" ", *[F.lower(F.coalesce(F.col(c).cast("string"), F.lit(""))) for c in names])
    return df.filter(F.contains(haystack, F.lit(needle)))


def apply_filters(df: DataFrame, filters: Filters) -> DataFrame:
    out = search(df, filters.query)
    chosen = ((category_column(df), filters.category), (price_column(df), filters.price),
              ("location", filters.zone))
    for column, value in chosen:
        if value != ALL and column in df.columns:
            out = out.filter(F.col(column) == value)
    if filters.cluster is not None and "cluster" in df.columns:
        out = out.filter(F.col("cluster") == filters.cluster)
    if filters.min_rating > 0 and "overall_rating" in df.columns:
        out = out.filter(F.col("overall_rating") >= filters.min_rating)
    return out


def filter_coverage(df: DataFrame, predicate: Column) -> DataFrame:
    """Reviews, entities and share of the total that a predicate keeps, in one pass."""
    hit = F.coalesce(predicate, F.lit(False))
    return df.agg(F.count_if(hit).alias("reviews"),
                  F.count_distinct(F.when(hit, F.col("restaurant_id"))).alias("restaurants"),
                  F.count("*").alias("total")).withColumn(
        "pct", F.coalesce(F.try_divide(F.col("reviews") * 100.0, F.col("total").cast("double")), F.lit(0.0)))


def options(df: DataFrame, column: str) -> DataFrame:
    """Sorted distinct values for a selector."""
    value = F.col(column).cast("string")
    return (df.select(value.alias(column))
            .filter(F.col(column).isNotNull() & (F.lower(column) != "nan"))
            .distinct().orderBy(column))


def options_by_level(df: DataFrame, label: str = "price_range", level: str = "price_level") -> DataFrame:
    """Labels in the order of their smallest level; labels without any level last."""
    return (df.filter(F.col(label).isNotNull()).groupBy(label)
            .agg(F.min(level).alias("level"))
            .orderBy(F.col("level").asc_nulls_last(), label))


def members_of(df: DataFrame, column: str, values: Sequence) -> DataFrame:
    return df.filter(F.col(column).isin(list(values)))


def review_list(df: DataFrame, bucket: str = ALL, query: str = "", order: str = "row_idx") -> DataFrame:
    """Reviews of a detail page: filtered by tone and text, newest first."""
    tone = scores.overall_sentiment(df)
    out = (df.filter(F.col("review_text").isNotNull())
           .withColumn("sentiment_score", tone)
           .withColumn("sentiment_label",
                       scores.sentiment_bucket(F.col("sentiment_score"), fixed.BUCKET_MISSING)))
    if bucket != ALL:
        out = out.filter(F.col("sentiment_label") == bucket)
    needle = (query or "").strip().lower()
    if needle:
        out = out.filter(F.contains(F.lower("review_text"), F.lit(needle)))
    return out.orderBy(F.col("review_date").desc_nulls_last(), order)


# --- aspects -----------------------------------------------------------------

def _opinions(df: DataFrame, aspect: str) -> Column:
    """Score where the review mentions the aspect, else NULL."""
    return F.when(scores.mention_flag(df, aspect), F.col(scores.score_col(aspect)).cast("double"))


def aspect_summaries(df: DataFrame, with_data_only: bool = True) -> DataFrame:
    """Mean over mentions and the coverage behind it, one row per aspect."""
    present = scores.present_aspects(df)
    totals = df.agg(F.count("*").alias("_total"), *[
        agg for a in present for agg in (F.avg(_opinions(df, a)).alias(f"_mean_{a}"),
                                         F.count(_opinions(df, a)).alias(f"_n_{a}"))])
    lines = F.array(*[F.struct(
        F.lit(a).alias("aspect"), F.lit(fixed.ASPECT_LABELS.get(a, a.capitalize())).alias("label"),
        F.col(f"_mean_{a}").alias("mean"), F.col(f"_n_{a}").alias("mentions"),
        F.col("_total").alias("total")) for a in present])
    out = totals.select(F.inline(lines)).withColumn("coverage", F.coalesce(
        F.try_divide(F.col("mentions").cast("double"), F.col("total").cast("double")), F.lit(0.0)))
    return out.filter(F.col("mentions") > 0) if with_data_only else out


def kpis(df: DataFrame) -> DataFrame:
    row = df.agg(F.count_distinct("restaurant_id").alias("restaurants"),
                 F.count("*").alias("reviews"),
                 F.avg("overall_rating").alias("avg_rating"),
                 F.count("overall_rating").alias("rated_reviews"),
                 F.coalesce(F.avg(scores.overall_sentiment(df)), F.lit(0.0)).alias("avg_sentiment"))
    return (row.withColumn("rating_tone", scores.rating_tone(F.col("avg_rating")))
            .withColumn("sentiment_label", scores.overall_tone(F.col("avg_sentiment"))))


def sentiment_split(df: DataFrame) -> DataFrame:
    """Count and percentage of the three tones, and the mean score."""
    scored = df.select(scores.overall_sentiment(df).alias("_s"))
    bucket = scores.sentiment_bucket(F.col("_s"))
    names = {"positive": fixed.BUCKET_POSITIVE, "neutral": fixed.BUCKET_NEUTRAL,
             "negative": fixed.BUCKET_NEGATIVE}
    counted = scored.agg(F.count("*").alias("total"), F.avg("_s").alias("avg_sentiment"), *[
        F.count_if(bucket == label).alias(f"n_{name}") for name, label in names.items()])
    return counted.withColumns({
        f"pct_{name}": F.coalesce(F.try_divide(F.col(f"n_{name}") * 100.0, F.col("total").cast("double")),
                                  F.lit(0.0)) for name in names})


def unpivot_scores(df: DataFrame, *keys: str) -> DataFrame:
    """One row per review and aspect in a single scan: keys, aspect, score, mentioned."""
    rows = F.array(*[F.struct(F.lit(a).alias("aspect"),
                              F.col(scores.score_col(a)).cast("double").alias("score"),
                              scores.mention_flag(df, a).alias("mentioned"))
                     for a in scores.present_aspects(df)])
    return df.select(*keys, F.inline(rows))


def aspect_breakdown(df: DataFrame) -> DataFrame:
    """Mentions per aspect and tone."""
    long = unpivot_scores(df).filter("mentioned").withColumn(
        "bucket", scores.sentiment_bucket(F.col("score")))
    labels = [fixed.BUCKET_POSITIVE, fixed.BUCKET_NEUTRAL, fixed.BUCKET_NEGATIVE]
    return (long.groupBy("aspect").pivot("bucket", labels).agg(F.count(F.lit(1)))
            .na.fill(0, labels))


def category_heatmap(df: DataFrame, min_reviews: int = 5, top: int = 12) -> DataFrame:
    """Mean over mentions and their number per category and aspect, for the most
    reviewed categories.  One aggregation: the top list comes from the same counts."""
    column = category_column(df)
    present = scores.present_aspects(df)
    return (df.filter(F.col(column).isNotNull()).groupBy(F.col(column).alias("category"))
            .agg(F.count("*").alias("reviews"), *[
                agg for a in present for agg in (F.avg(_opinions(df, a)).alias(f"{a}_mean"),
                                                 F.count(_opinions(df, a)).alias(f"{a}_n"))])
            .filter(F.col("reviews") >= min_reviews)
            .orderBy(F.desc("reviews"), "category").limit(top))


def qualifying_rows(df: DataFrame, min_reviews: int = 5, top: int = 12) -> DataFrame:
    """Rows whose category is in the heatmap's list (at most ``top`` names)."""
    column = category_column(df)
    names = (df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("_n"))
             .filter(F.col("_n") >= min_reviews).orderBy(F.desc("_n"), column).limit(top))
    return df.join(F.broadcast(names.select(column)), column, "left_semi")


def radar(df: DataFrame) -> DataFrame:
    """Entity by aspect; an aspect nobody mentions shows 0."""
    return df.groupBy("restaurant_id").agg(*[
        F.coalesce(F.avg(_opinions(df, a)), F.lit(0.0)).alias(a) for a in scores.present_aspects(df)])


# --- entities ----------------------------------------------------------------

def first_value(column: str, order: str) -> Column:
    """First non-null value in row order."""
    return F.min_by(column, F.when(F.col(column).isNotNull(), F.col(order))).alias(column)


def restaurant_directory(df: DataFrame, order: str = "row_idx",
                         attributes: Sequence[str] = ("category", "price_range", "price_band", "location"),
                         ) -> DataFrame:
    """One row per entity: most frequent name, mean rating, reviews, first attributes.

    Counting per (entity, name) first keeps the state of every group small.
    """
    attributes = [c for c in attributes if c in df.columns]
    seen = {c: F.when(F.col(c).isNotNull(), F.col(order)) for c in attributes}
    per_name = df.groupBy("restaurant_id", "restaurant_name").agg(
        F.count("*").alias("_n"),
        F.sum("overall_rating").alias("_sum"), F.count("overall_rating").alias("_rated"),
        *[agg for c in attributes for agg in (F.min_by(c, seen[c]).alias(c), F.min(seen[c]).alias(f"_at_{c}"))])
    named = F.when(F.col("restaurant_name").isNotNull(), F.struct(-F.col("_n"), "restaurant_name"))
    return per_name.groupBy("restaurant_id").agg(
        F.coalesce(F.min_by("restaurant_name", named), F.lit("Sin nombre")).alias("restaurant_name"),
        F.try_divide(F.sum("_sum"), F.sum("_rated").cast("double")).alias("rating"),
        F.sum("_n").alias("resenas"),
        *[F.min_by(c, f"_at_{c}").alias(c) for c in attributes])


def restaurant_label(rating: Column, name: Column, reviews: Column | None = None) -> Column:
    """'4.9 - Name (5 reseñas)'."""
    shown = F.coalesce(F.format_string("%.1f", rating), F.lit("s/c"))
    shown = F.when(rating.isNull(), "s/c").otherwise(shown)
    label = F.concat(shown, F.lit(" - "), name)
    if reviews is None:
        return label
    counted = F.concat(label, F.lit(" ("), reviews.cast("long").cast("string"), F.lit(" reseñas)"))
    return F.when(reviews.isNull(), label).otherwise(counted)


def summarisable(df: DataFrame, minimum: int = 2) -> DataFrame:
    return restaurant_directory(df).filter(F.col("resenas") >= minimum)


def comparison_cards(df: DataFrame, order: str = "row_idx",
                     columns: Sequence[str] = ("restaurant_name", "category", "price_range", "overall_rating"),
                     ) -> DataFrame:
    return df.groupBy("restaurant_id").agg(*[first_value(c, order) for c in columns])


def with_directory_names(aggregate: DataFrame, directory: DataFrame) -> DataFrame:
    """Inner join of a per-entity aggregate with the entity names."""
    return aggregate.join(directory.select("restaurant_id", "restaurant_name"), "restaurant_id")


def badges(df: DataFrame) -> DataFrame:
    """Attributes to show; the price band replaces the price range."""
    shown = {c: text.clean_display(F.col(c)) for c in ("category", "price_band", "price_range", "location")}
    price = F.when(shown["price_band"].isNull(), shown["price_range"])
    return df.withColumn("badges", F.array_compact(F.array(
        shown["category"], shown["price_band"], price, shown["location"])))


def site_ratings(df: DataFrame, pairs: Sequence[tuple[str, str]] = (
        ("food_rating", "comida"), ("service_rating", "servicio"), ("ambiance_rating", "ambiente"))) -> DataFrame:
    """Published aspect rating against the computed sentiment."""
    pairs = [(c, a) for c, a in pairs if c in df.columns]
    totals = df.agg(*[agg for c, a in pairs for agg in (
        F.avg(c).alias(f"_site_{a}"), F.avg(_opinions(df, a)).alias(f"_mean_{a}"),
        F.count_if(scores.mention_flag(df, a)).alias(f"_n_{a}"))])
    lines = F.array(*[F.struct(F.lit(fixed.ASPECT_LABELS[a]).alias("aspect"),
                               F.bround(f"_site_{a}", 2).alias("site_rating"),
                               F.bround(f"_mean_{a}", 2).alias("sentiment"),
                               F.col(f"_n_{a}").alias("mentions")) for _, a in pairs])
    return totals.select(F.inline(lines)).filter(F.col("site_rating").isNotNull())


# --- distributions and top lists ---------------------------------------------

def value_counts(df: DataFrame, column: str) -> DataFrame:
    return df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("n"))


def top_values(df: DataFrame, column: str, n: int = 10) -> DataFrame:
    return value_counts(df, column).orderBy(F.desc("n"), column).limit(n)


def histogram(df: DataFrame, column: str, low: float, high: float, bins: int = 20) -> DataFrame:
    """Counts of equal bins over [low, high]; the top edge belongs to the last bin."""
    width = (high - low) / bins
    place = F.floor((F.col(column) - low) / width)
    inside = df.filter(F.col(column).between(low, high))
    return (inside.groupBy(F.least(place, F.lit(bins - 1)).cast("int").alias("bin"))
            .agg(F.count("*").alias("n"))
            .withColumn("bin_from", F.lit(low) + F.col("bin") * width))


def top_rated(df: DataFrame, n: int = 10) -> DataFrame:
    """By id and name: two spellings are two rows."""
    return (df.filter(F.col("overall_rating").isNotNull())
            .groupBy("restaurant_id", "restaurant_name")
            .agg(F.avg("overall_rating").alias("rating"))
            .orderBy(F.desc("rating"), "restaurant_id", "restaurant_name").limit(n))


def rated_names(names: DataFrame) -> DataFrame:
    """Mean rating per name over the rows that have one, from a name summary."""
    return names.filter(F.col("rated") > 0).select("restaurant_name", "nota", F.col("rated").alias("resenas"))


def best_names(names: DataFrame, n: int = 12) -> DataFrame:
    return rated_names(names).orderBy(F.desc("nota"), "restaurant_name").limit(n)


def worst_names(names: DataFrame, flagged: DataFrame, n: int = 6) -> DataFrame:
    """Lowest rated names, without those whose rating is not to be trusted."""
    kept = quality.without_suspicious(rated_names(names), flagged)
    return kept.orderBy("nota", "restaurant_name").limit(n)


def extreme_reviews(df: DataFrame, n: int = 5, order: str = "row_idx") -> DataFrame:
    """The most positive reviews and the most negative ones below zero."""
    scored = df.withColumn("sentiment_score", scores.overall_sentiment(df)).filter(
        F.col("sentiment_score").isNotNull())
    best = scored.orderBy(F.desc("sentiment_score"), order).limit(n).withColumn("side", F.lit("positive"))
    worst = (scored.filter(F.col("sentiment_score") < 0).orderBy("sentiment_score", order)
             .limit(n).withColumn("side", F.lit("negative")))
    return best.unionByName(worst)


def sample_reviews(df: DataFrame, n: int = 2, order: str = "row_idx",
                   skip_blank: bool = False) -> DataFrame:
    """First ``n`` reviews of every entity."""
    kept = df.filter(F.col("review_text").isNotNull())
    if skip_blank:
        kept = kept.filter(text.strip(F.col("review_text")) != "")
    return keep_first(kept, ["restaurant_id"], [order], n)


def summary_input(df: DataFrame, limit: int = 25, order: str = "row_idx") -> DataFrame:
    """The reviews a summary is written from: one line each, and how many there are.

    At most ``limit`` rows per entity reach the list.
    """
    sample = sample_reviews(df, limit, order, skip_blank=True)
    pairs = F.array_sort(F.collect_list(F.struct(order, text.strip(F.col("review_text")).alias("t"))))
    return sample.groupBy("restaurant_id").agg(
        F.count("*").alias("reviews"),
        F.array_join(F.transform(pairs, lambda p: F.concat(F.lit("- "), p["t"])), "\n").alias("lines"))


# --- clusters ----------------------------------------------------------------

def cluster_labels(df: DataFrame, order: str = "row_idx") -> DataFrame:
    """Display label per cluster: its name, or its number when it has none."""
    clustered = df.filter(F.col("cluster").isNotNull())
    name = (F.min_by("cluster_name", F.when(F.col("cluster_name").isNotNull(), F.col(order)))
            if "cluster_name" in df.columns else F.max(F.lit(None).cast("string")))
    number = F.col("cluster").cast("int").cast("string")
    return clustered.groupBy("cluster").agg(name.alias("_name")).select(
        "cluster", F.coalesce(F.concat(number, F.lit(" - "), F.col("_name")),
                              F.concat(F.lit("Grupo "), number)).alias("label"))


def cluster_table(df: DataFrame) -> DataFrame:
    """Entities, reviews, rating, price level and mention-only means per cluster."""
    present = scores.present_aspects(df)
    extra = [F.bround(F.avg("price_level"), 2).alias("price_level")] if "price_level" in df.columns else []
    return df.filter(F.col("cluster").isNotNull()).groupBy("cluster").agg(
        F.count_distinct("restaurant_id").alias("restaurants"), F.count("*").alias("reviews"),
        F.bround(F.avg("overall_rating"), 2).alias("rating"), *extra,
        *[F.bround(F.avg(_opinions(df, a)), 2).alias(a) for a in present])


def cluster_points(df: DataFrame) -> DataFrame:
    """Entity points of the rating against sentiment map."""
    scored = df.withColumn("_s", scores.overall_sentiment(df))
    return (scored.groupBy("restaurant_id", "restaurant_name", "cluster")
            .agg(F.avg("overall_rating").alias("rating"), F.avg("_s").alias("sentiment"),
                 F.count("*").alias("reviews"))
            .dropna(subset=["restaurant_id", "restaurant_name", "cluster", "rating", "sentiment"]))


def cluster_members(df: DataFrame, cluster: int, query: str = "", order: str = "row_idx") -> DataFrame:
    """Entities of a cluster by rating, with a search on the name."""
    subset = df.filter(F.col("cluster") == cluster)
    needle = (query or "").strip().lower()
    if needle:
        subset = subset.filter(F.contains(F.lower("restaurant_name"), F.lit(needle)))
    return (restaurant_directory(subset, order).select("restaurant_id", "restaurant_name", "rating", "resenas")
            .orderBy(F.col("rating").desc_nulls_last(), "restaurant_id"))


LABELS_IN_PROFILE = 50


def cluster_value_counts(df: DataFrame, column: str = "price_range") -> DataFrame:
    """(cluster, value, n) of every value of a column."""
    return df.filter(F.col("cluster").isNotNull() & F.col(column).isNotNull()).groupBy("cluster", F.col(column).alias("value")).agg(F.count("*").alias("n"))


def cluster_profiles(df: DataFrame, top: int = 3) -> DataFrame:
    """Profile per cluster: counts, review-weighted means over all rows, price
    distribution and most frequent categories.  The distribution holds the ``LABELS_IN_PROFILE`` most
    frequent labels; ``cluster_value_counts`` has all of them as rows."""
    level = parse.price_level(F.col("price_range"))
    base = df.filter(F.col("cluster").isNotNull())
    means = base.groupBy("cluster").agg(
        F.count_distinct("restaurant_id").alias("count"), F.count("*").alias("review_count"),
        F.avg("overall_rating").alias("avg_rating"),
        *[F.avg(scores.score_col(a)).alias(f"avg_{a}_sentiment") for a in scores.present_aspects(df)],
        F.avg(level).alias("avg_price_level"))

    def counted(column: str) -> DataFrame:
        return (base.filter(F.col(column).isNotNull()).groupBy("cluster", column)
                .agg(F.count("*").alias("n")))

    labels = keep_first(counted("price_range"), ["cluster"], [F.desc("n"), "price_range"], LABELS_IN_PROFILE)
    prices = labels.groupBy("cluster").agg(
        F.map_from_entries(F.collect_list(F.struct("price_range", "n"))).alias("price_distribution"))
    categories = keep_first(counted("category"), ["cluster"], [F.desc("n"), "category"], top)
    tops = categories.groupBy("cluster").agg(
        F.map_from_entries(F.collect_list(F.struct("category", "n"))).alias("top_categories"))
    return means.join(prices, "cluster", "left").join(tops, "cluster", "left")


# --- digest ------------------------------------------------------------------

def digest(df: DataFrame, rows: int = 12, order: str = "row_idx") -> DataFrame:
    """The dataset in a few dozen lines: (section_no, section, rank, line).

    Every section is an aggregate; no review text is read.  The sections about names share one summary per name,
    those about counts one table of counts.  All sources and flagged names are named.
    """
    def numbered(source: DataFrame, keys: Sequence[Column], line: Column, no: int, title: str) -> DataFrame:
        # ranked inside one sorted array
        names = [f"k{i}" for i in range(len(keys))]
        few = source.select(*[k.alias(n) for k, n in zip(keys, names)], line.alias("line"))
        return few.agg(F.array_sort(F.collect_list(F.struct(*names, "line"))).alias("_l")).select(
            F.posexplode(F.transform("_l", lambda x: x["line"])).alias("rank", "line")).select(
            F.lit(no).alias("section_no"), F.lit(title).alias("section"),
            (F.col("rank") + 1).alias("rank"), "line")

    sections = []
    sources = df.filter(F.col("source").isNotNull()).groupBy("source").agg(F.lit(1).alias("_one"))
    named = quality.top_names(sources, ["source"], "source").select("names").scalar()
    totals = df.agg(F.count("*").alias("n"), F.count_distinct("restaurant_id").alias("r"), F.avg("overall_rating").alias("m")).withColumn("s", named)
    general = F.array_compact(F.array(
        F.concat(F.lit("- Resenas: "), F.col("n").cast("string")),
        F.concat(F.lit("- Restaurantes: "), F.col("r").cast("string")),
        F.concat(F.lit("- Fuentes: "), F.col("s")),
        F.when(F.col("m").isNotNull(),
               F.concat(F.lit("- Calificacion promedio: "), F.format_string("%.2f", "m"), F.lit(" de 5")))))
    sections.append(totals.select(F.posexplode(general).alias("rank", "line")).select(
        F.lit(1).alias("section_no"), F.lit("RESUMEN GENERAL").alias("section"),
        (F.col("rank") + 1).alias("rank"), "line"))

    places = F.array(*[F.lit(a) for a in fixed.ASPECTS])
    aspects = aspect_summaries(df)
    sections.append(numbered(
        aspects, [F.array_position(places, F.col("aspect"))],
        F.concat(F.lit("  "), F.col("label"), F.lit(": sentimiento "), F.format_string("%+.2f", "mean"),
                 F.lit(", lo mencionan "), F.col("mentions").cast("string"), F.lit(" resenas ("),
                 F.format_string("%.0f", F.col("coverage") * 100), F.lit("%)")),
        2, "SENTIMIENTO POR ASPECTO"))

    rated_line = F.concat(F.lit("  "), F.col("restaurant_name"), F.lit(": "), F.format_string("%.1f", "nota"),
                          F.lit(" ("), F.col("resenas").cast("string"), F.lit(" resenas)"))
    names = shared.stored(quality.name_summary(df, order), "names")
    flagged = quality.contradictions(names)
    sections.append(numbered(best_names(names, rows), [-F.col("nota"), F.col("restaurant_name")], rated_line,
                             3, "MEJOR CALIFICADOS"))
    sections.append(numbered(worst_names(names, flagged), [F.col("nota"), F.col("restaurant_name")], rated_line,
                             4, "PEOR CALIFICADOS"))
    sections.append(quality.quality_note(flagged).filter(F.col("note") != "").select(
        F.lit(5).alias("section_no"), F.lit("LIMITACION CONOCIDA DE LOS DATOS").alias("section"),
        F.posexplode(F.array(F.concat(F.lit("  "), F.col("note")), F.lit(f"  {fixed.QUALITY_ADVICE}"))).alias("rank", "line"))
        .withColumn("rank", F.col("rank") + 1))

    counted = [c for c in (category_column(df), "location", "price_band") if c in df.columns]
    cells = shared.stored(df.groupBy(*counted).agg(F.count("*").alias("n")), "cells")

    def counts(column: str, top: int | None, no: int, title: str, unit: str = "", by_value: bool = False) -> DataFrame:
        source = cells.filter(F.col(column).isNotNull()).groupBy(column).agg(F.sum("n").alias("n"))
        source = source.orderBy(F.desc("n"), column).limit(top) if top else source
        keys = [F.col(column)] if by_value else [-F.col("n"), F.col(column)]
        line = F.concat(F.lit("  "), F.col(column), F.lit(": "), F.col("n").cast("string"), F.lit(unit))
        return numbered(source, keys, line, no, title)

    if category_column(df) in df.columns:
        sections.append(counts(category_column(df), 10, 6, "COCINAS CON MAS RESENAS"))
    if "location" in df.columns:
        sections.append(counts("location", 10, 7, "ZONAS CON MAS RESENAS"))
    if "price_band" in df.columns:
        sections.append(counts("price_band", None, 8, "RANGOS DE PRECIO", " resenas", by_value=True))
    if "cluster_name" in df.columns:
        groups = (df.filter(F.col("cluster_name").isNotNull()).groupBy("cluster_name")
                  .agg(F.count_distinct("restaurant_id").alias("n")))
        sections.append(numbered(
            groups, [-F.col("n"), F.col("cluster_name")],
            F.concat(F.lit("  "), F.col("cluster_name"), F.lit(": "), F.col("n").cast("string"),
                     F.lit(" restaurantes")), 9, "GRUPOS DEL CLUSTERING"))
    return reduce(DataFrame.unionByName, sections)


def digest_text(lines: DataFrame) -> DataFrame:
    """The digest as one text."""
    ordered = F.array_sort(F.collect_list(F.struct("section_no", "section", "rank", "line")))
    body = F.transform(ordered, lambda x: F.when(
        x["rank"] == 1, F.concat(F.when(x["section_no"] > 1, "\n").otherwise(""), x["section"], F.lit("\n"), x["line"]))
        .otherwise(x["line"]))
    return lines.agg(F.array_join(body, "\n").alias("digest"))
