"""Filters, star schema, measures, top lists and recommendations over scored reviews."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.bindings import OVERALL_SQL
from catalog.registry import query, r6
from savora import fixed_values as fixed
from savora.functions import parse, scores, text
from savora.operators import explore, features, measures, quality, recommend, star, timeseries, unify
from savora.operators.explore import Filters

ASPECTS = fixed.ASPECTS
LABELS = fixed.ASPECT_LABELS


def _round(columns, *plain):
    return [*plain, *[r6(c) for c in columns]]


def _star(t):
    return star.aspects(t.scored), star.restaurants(t.scored), star.reviews(t.scored)


# --- P10-P17 filters ---------------------------------------------------------

@query("p10_search", "SELECT review_id FROM scored WHERE contains(lower(restaurant_name) || ' ' || coalesce(lower(category), ''), 'mach')", "scored")
def _(t):
    return explore.search(t.scored, " MACH ").select("review_id")


CHOSEN = Filters(query="customer", category="MACHINERY", price="$$ ($15-$25)", zone="NATION_3", min_rating=2.0)


@query("p11_filter_bar", """SELECT review_id FROM scored WHERE contains(lower(restaurant_name), 'customer') AND category_primary = 'MACHINERY'
  AND price_band = '$$ ($15-$25)' AND location = 'NATION_3' AND overall_rating >= 2.0""", "scored")
def _(t):
    return explore.apply_filters(t.scored, CHOSEN).select("review_id")


@query("p12_filter_coverage", """
SELECT count(*) FILTER (overall_rating >= 4) AS reviews, count(DISTINCT restaurant_id) FILTER (overall_rating >= 4) AS restaurants,
  count(*) AS total, round(count(*) FILTER (overall_rating >= 4) * 100.0 / count(*), 6) AS pct FROM scored""", "scored")
def _(t):
    out = explore.filter_coverage(t.scored, F.col("overall_rating") >= 4)
    return out.select("reviews", "restaurants", "total", r6("pct"))


@query("p13_options", "SELECT DISTINCT location FROM scored WHERE location IS NOT NULL AND lower(location) <> 'nan' ORDER BY 1", "scored")
def _(t):
    return explore.options(t.scored, "location")


@query("p14_options_by_level", "SELECT price_range, min(price_level) AS level FROM scored WHERE price_range IS NOT NULL GROUP BY 1 ORDER BY 2", "scored")
def _(t):
    return explore.options_by_level(t.scored)


@query("p15_members_of", "SELECT review_id FROM scored WHERE location IN ('NATION_1', 'NATION_2')", "scored")
def _(t):
    return explore.members_of(t.scored, "location", ["NATION_1", "NATION_2"]).select("review_id")


@query("p16_review_list", """
SELECT review_id, round(s, 6) AS sentiment_score, 'Negativo' AS sentiment_label FROM toned
WHERE review_text IS NOT NULL AND s < -0.1 AND contains(lower(review_text), 'nation_1') ORDER BY review_date DESC NULLS LAST, row_idx""", "toned")
def _(t):
    out = explore.review_list(t.scored, fixed.BUCKET_NEGATIVE, "Nation_1")
    return out.select("review_id", r6("sentiment_score"), "sentiment_label")


@query("p17_mention_predicate", """
SELECT review_id, mentions_comida AS flag, CASE WHEN review_id % 5 = 0 THEN false ELSE mentions_precio END AS parsed, true AS absent FROM scored""", "scored")
def _(t):
    cells = t.scored.withColumn("mentions_precio", F.when(F.col("review_id") % 5 == 0, F.lit(None)).when(
        F.col("mentions_precio"), " True ").otherwise("no"))
    return cells.select("review_id", scores.mention_flag(cells, "comida").alias("flag"),
                        scores.mention_flag(cells, "precio").alias("parsed"), scores.mention_flag(cells.drop("mentions_ambiente"), "ambiente").alias("absent"))


@query("p21_label_scores", """SELECT review_id, sentiment_comida_score, sentiment_precio_score, round(s_all, 6) AS overall_sentiment_score FROM toned""", "toned")
def _(t):
    labels = t.scored.select("review_id", *[scores.label_col(a) for a in ASPECTS])
    out = features.add_sentiment_scores(labels)
    return out.select("review_id", "sentiment_comida_score", "sentiment_precio_score", r6("overall_sentiment_score"))


@query("p22_sentiment_features", """
SELECT review_id, round(s_all, 6) AS overall_sentiment_score,
  CAST((sentiment_comida_score > 0)::INT + (sentiment_servicio_score > 0)::INT + (sentiment_precio_score > 0)::INT + (sentiment_ambiente_score > 0)::INT AS INT) AS positive_aspect_count,
  CAST((sentiment_comida_score < 0)::INT + (sentiment_servicio_score < 0)::INT + (sentiment_precio_score < 0)::INT + (sentiment_ambiente_score < 0)::INT AS INT) AS negative_aspect_count FROM toned""", "toned")
def _(t):
    labels = t.scored.select("review_id", *[scores.label_col(a) for a in ASPECTS])
    out = features.sentiment_features(labels)
    return out.select("review_id", r6("overall_sentiment_score"), "positive_aspect_count", "negative_aspect_count")


# --- star schema -------------------------------------------------------------

@query("p25_restaurant_dimension", 'SELECT * REPLACE (round("Calificación", 6) AS "Calificación") FROM restaurants', "restaurants")
def _(t):
    return star.restaurants(t.scored).withColumn("Calificación", r6("Calificación"))


@query("p26_review_fact", """
SELECT review_id AS "ReseñaID", restaurant_id AS "RestauranteID", CAST(review_date AS DATE) AS "Fecha", review_rating AS "CalificaciónReseña",
  review_text AS "Texto", reviewer_name AS "Autor", source AS "Fuente", review_language AS "Idioma", word_count AS "Palabras", char_count AS "Caracteres" FROM scored""", "scored")
def _(t):
    return star.reviews(t.scored)


@query("p27_aspect_fact", "SELECT * FROM aspects", "aspects")
def _(t):
    return star.aspects(t.scored)


@query("u02_union_of_aspects", 'SELECT "Aspecto", count(*) AS n, round(sum("Puntaje"), 6) AS total FROM aspects GROUP BY 1', "aspects")
def _(t):
    """Four stacked projections must give what the single-scan unpivot gives."""
    from functools import reduce
    parts = [t.scored.select(F.lit(LABELS[a]).alias("Aspecto"), F.col(scores.score_col(a)).alias("Puntaje")) for a in ASPECTS]
    stacked = reduce(lambda a, b: a.unionByName(b), parts)
    return stacked.groupBy("Aspecto").agg(F.count("*").alias("n"), r6(F.sum("Puntaje"), "total"))


@query("p28_aspect_dimension", """
SELECT "Aspecto", CASE "Aspecto" WHEN 'Comida' THEN 1 WHEN 'Servicio' THEN 2 WHEN 'Precio' THEN 3 ELSE 4 END::BIGINT AS "Orden", count(*) AS n FROM aspects GROUP BY 1""", "aspects")
def _(t):
    """The four rows of the dimension, each with its facts."""
    dim = star.aspect_dimension(t.spark)
    return (star.aspects(t.scored).join(F.broadcast(dim), "Aspecto").groupBy("Aspecto", "Orden").agg(F.count("*").alias("n")))


@query("p29_calendar", """
WITH d AS (SELECT unnest(generate_series(date_trunc('year', min(o_orderdate)), date_trunc('year', max(o_orderdate)) + INTERVAL 1 YEAR - INTERVAL 1 DAY, INTERVAL 1 DAY))::DATE AS x FROM orders)
SELECT x AS "Date", CAST(year(x) AS INT) AS "Año", CAST(month(x) AS INT) AS "NúmeroMes",
  list_extract(['enero','febrero','marzo','abril','mayo','junio','julio','agosto','septiembre','octubre','noviembre','diciembre'], month(x)) AS "Mes",
  strftime(x, '%Y-%m') AS "AñoMes", 'T' || quarter(x) AS "Trimestre", year(x) || '-T' || quarter(x) AS "AñoTrimestre" FROM d""")
def _(t):
    return star.calendar(t.orders, "o_orderdate")


@query("p30_restaurant_labels", """
SELECT c_custkey, CASE WHEN c_custkey % 13 = 0 THEN 's/c' ELSE printf('%.1f', (c_custkey * 37 % 41) / 10.0::DOUBLE) END || ' - ' || c_name
  || CASE WHEN c_custkey % 3 = 0 THEN '' ELSE ' (' || c_nationkey || ' reseñas)' END AS label FROM customer""")
def _(t):
    rating = F.when(F.col("c_custkey") % 13 != 0, (F.col("c_custkey") * 37 % 41) / 10.0)
    reviews = F.when(F.col("c_custkey") % 3 != 0, F.col("c_nationkey"))
    return t.customer.select("c_custkey", explore.restaurant_label(rating, F.col("c_name"), reviews).alias("label"))


@query("p31_badges", """
SELECT review_id, concat_ws('|', category, price_band, CASE WHEN price_band IS NULL THEN price_range END, location) AS badges FROM scored""", "scored")
def _(t):
    return explore.badges(t.scored).select("review_id", F.array_join("badges", "|").alias("badges"))


@query("p32_threshold_bands", """
SELECT review_id, CASE WHEN overall_rating IS NULL THEN 'missing' WHEN overall_rating >= 4.5 THEN 'high' WHEN overall_rating >= 4 THEN 'medium' ELSE 'low' END AS rating_tone,
  CASE WHEN word_count >= 80 THEN 'high' WHEN word_count >= 60 THEN 'medium' ELSE 'low' END AS match_tone FROM scored""", "scored")
def _(t):
    return t.scored.select("review_id", scores.rating_tone(F.col("overall_rating")).alias("rating_tone"),
                           scores.match_tone(F.col("word_count")).alias("match_tone"))


# --- joins -------------------------------------------------------------------

STATS_SQL = """stats AS (SELECT restaurant_id, restaurant_name, count(review_text) AS review_count, round_even(avg(overall_rating), 2) AS avg_rating,
  round_even(avg(word_count), 2) AS avg_word_count, round_even(avg(char_count), 2) AS avg_char_count FROM scored GROUP BY 1, 2)"""


@query("a01_restaurant_stats", f"WITH {STATS_SQL} SELECT * FROM stats", "scored")
def _(t):
    return features.restaurant_stats(t.scored)


@query("j01_stats_onto_reviews", f"WITH {STATS_SQL} SELECT review_id, review_count, avg_rating, avg_word_count FROM scored LEFT JOIN stats USING (restaurant_id, restaurant_name)", "scored")
def _(t):
    return features.add_restaurant_stats(t.scored).select("review_id", "review_count", "avg_rating", "avg_word_count")


@query("j02_profiles_with_sentiment", """
SELECT p.restaurant_id, p.reviews, round(s.comida, 6) AS comida FROM (SELECT restaurant_id, count(review_text) AS reviews FROM scored GROUP BY 1) p
JOIN (SELECT restaurant_id, avg(sentiment_comida_score) AS comida FROM scored GROUP BY 1) s USING (restaurant_id)""", "scored")
def _(t):
    """Both sides are grouped by the join key, so the join adds no shuffle."""
    profiles = t.scored.groupBy("restaurant_id").agg(F.count("review_text").alias("reviews"))
    tone = t.scored.groupBy("restaurant_id").agg(F.avg("sentiment_comida_score").alias("comida"))
    return profiles.join(tone, "restaurant_id").select("restaurant_id", "reviews", r6("comida"))


DIRECTORY_SQL = """directory AS (SELECT n.restaurant_id, n.restaurant_name, d.rating, d.resenas, d.category, d.location FROM
  (SELECT restaurant_id, restaurant_name FROM (SELECT restaurant_id, restaurant_name, count(*) AS c FROM scored GROUP BY 1, 2)
   QUALIFY row_number() OVER (PARTITION BY restaurant_id ORDER BY c DESC, restaurant_name) = 1) n
  JOIN (SELECT restaurant_id, avg(overall_rating) AS rating, count(*) AS resenas, first(category ORDER BY row_idx) FILTER (category IS NOT NULL) AS category,
   first(location ORDER BY row_idx) FILTER (location IS NOT NULL) AS location FROM scored GROUP BY 1) d USING (restaurant_id))"""


@query("a05_restaurant_directory", f"WITH {DIRECTORY_SQL} SELECT restaurant_id, restaurant_name, round(rating, 6) AS rating, resenas, category, location FROM directory", "scored")
def _(t):
    out = explore.restaurant_directory(t.scored)
    return out.select("restaurant_id", "restaurant_name", r6("rating"), "resenas", "category", "location").orderBy("restaurant_name", "restaurant_id")


@query("j03_aggregates_with_names", f"""WITH {DIRECTORY_SQL} SELECT restaurant_id, restaurant_name, n FROM directory
JOIN (SELECT restaurant_id, count(*) AS n FROM scored WHERE location IN ('NATION_1', 'NATION_2') GROUP BY 1) USING (restaurant_id)""", "scored")
def _(t):
    chosen = explore.members_of(t.scored, "location", ["NATION_1", "NATION_2"])
    counts = chosen.groupBy("restaurant_id").agg(F.count("*").alias("n"))
    return explore.with_directory_names(counts, explore.restaurant_directory(t.scored)).select("restaurant_id", "restaurant_name", "n")


@query("j04_cluster_labels_onto_reviews", """
SELECT review_id, CASE WHEN c_custkey % 3 = 0 THEN NULL ELSE CAST(c_nationkey % 5 AS INT) END AS cluster FROM scored JOIN customer ON restaurant_id = 'r' || c_custkey""", "scored")
def _(t):
    from savora.operators.cluster import add_cluster_labels
    labels = t.customer.filter("c_custkey % 3 <> 0").select(
        F.concat(F.lit("r"), F.col("c_custkey").cast("string")).alias("restaurant_id"), (F.col("c_nationkey") % 5).cast("int").alias("cluster"))
    return add_cluster_labels(t.scored.drop("cluster"), labels).select("review_id", "cluster")


@query("j05_star_join", """
SELECT r."Zona" AS zone, strftime(a."Fecha", '%Y-%m') AS month, a."Aspecto" AS aspect, count(*) AS n, round(avg(a."Puntaje") FILTER (a."Mencionado"), 6) AS mean_sentiment
FROM aspects a LEFT JOIN restaurants r USING ("RestauranteID") GROUP BY 1, 2, 3""", "aspects restaurants")
def _(t):
    fact, entities, _ = _star(t)
    dims = {"calendar": ("Fecha", star.calendar(fact).select("Date", "AñoMes"), "Date"),
            "aspect": ("Aspecto", star.aspect_dimension(t.spark), "Aspecto"),
            "restaurant": ("RestauranteID", entities.select("RestauranteID", "Zona"), "RestauranteID")}
    # reduced to one row per entity, day and aspect before it meets the dimensions
    parts = measures.aspect_parts(fact, ["RestauranteID", "Fecha", "Aspecto"])
    joined = star.star_join(parts, dims)
    grouped = measures.regroup(joined, ["Zona", "AñoMes", "Aspecto"])
    return grouped.select(F.col("Zona").alias("zone"), F.col("AñoMes").alias("month"), F.col("Aspecto").alias("aspect"),
                          F.col("rows").alias("n"), r6(measures.mean_sentiment(), "mean_sentiment"))


@query("j06_without_suspicious", """
SELECT restaurant_name, count(*) AS n FROM scored WHERE restaurant_name NOT IN (SELECT restaurant_name FROM suspicious) GROUP BY 1""", "suspicious")
def _(t):
    kept = quality.without_suspicious(t.scored, quality.suspicious_names(t.scored))
    return kept.groupBy("restaurant_name").agg(F.count("*").alias("n"))


@query("j08_qualifying_rows", """
SELECT review_id FROM scored WHERE category_primary IN (SELECT category_primary FROM (SELECT category_primary, count(*) AS n FROM scored
  WHERE category_primary IS NOT NULL GROUP BY 1 HAVING count(*) >= 5 ORDER BY n DESC, category_primary LIMIT 3))""", "scored")
def _(t):
    return explore.qualifying_rows(t.scored, 5, 3).select("review_id")


# --- aggregations ------------------------------------------------------------

@query("a04_value_counts", "SELECT source, count(*) AS n FROM scored GROUP BY 1", "scored")
def _(t):
    return explore.value_counts(t.scored, "source")


PROFILE_SQL = """profiles AS (SELECT restaurant_id, first(restaurant_name ORDER BY row_idx) AS restaurant_name, first(category ORDER BY row_idx) FILTER (category IS NOT NULL) AS category,
  first(price_range ORDER BY row_idx) FILTER (price_range IS NOT NULL) AS price_range, first(location ORDER BY row_idx) FILTER (location IS NOT NULL) AS location,
  avg(overall_rating) AS overall_rating, count(review_text) AS review_count, avg(sentiment_comida_score) AS c, avg(sentiment_servicio_score) AS s,
  avg(sentiment_precio_score) AS p, avg(sentiment_ambiente_score) AS a FROM {0} GROUP BY 1)"""


@query("a06_restaurant_profiles", f"""WITH {PROFILE_SQL.format('scored')}
SELECT restaurant_id, restaurant_name, category, price_range, location, round(overall_rating, 6) AS overall_rating, review_count,
  round(c, 6) AS sentiment_comida_score, round(p, 6) AS sentiment_precio_score FROM profiles""", "scored")
def _(t):
    out = recommend.restaurant_profiles(t.scored)
    return out.select("restaurant_id", "restaurant_name", "category", "price_range", "location", "review_count",
                      r6("overall_rating"), r6("sentiment_comida_score"), r6("sentiment_precio_score"))


_SUMMARY = "\nUNION ALL ".join(
    f"SELECT '{a}' AS aspect, '{LABELS[a]}' AS label, round(avg(sentiment_{a}_score) FILTER (mentions_{a}), 6) AS mean, count(*) FILTER (mentions_{a}) AS mentions, "
    f"count(*) AS total, round(count(*) FILTER (mentions_{a}) / count(*), 6) AS coverage FROM scored" for a in ASPECTS)


@query("a08_aspect_summaries", _SUMMARY, "scored")
def _(t):
    return explore.aspect_summaries(t.scored).select("aspect", "label", "mentions", "total", r6("mean"), r6("coverage"))


@query("a09_kpis", """
SELECT count(DISTINCT restaurant_id) AS restaurants, count(*) AS reviews, round(avg(overall_rating), 6) AS avg_rating, count(overall_rating) AS rated_reviews,
  round(avg(s), 6) AS avg_sentiment, CASE WHEN avg(overall_rating) >= 4.5 THEN 'high' WHEN avg(overall_rating) >= 4 THEN 'medium' ELSE 'low' END AS rating_tone,
  CASE WHEN avg(s) > 0.1 THEN 'Positivo' WHEN avg(s) > -0.1 THEN 'Neutral' ELSE 'Negativo' END AS sentiment_label FROM toned""", "toned")
def _(t):
    return explore.kpis(t.scored).select("restaurants", "reviews", "rated_reviews", "rating_tone", "sentiment_label", r6("avg_rating"), r6("avg_sentiment"))


@query("a10_sentiment_split", """
SELECT count(*) AS total, round(avg(s), 6) AS avg_sentiment, count(*) FILTER (s > 0.1) AS n_positive, count(*) FILTER (abs(s) <= 0.1) AS n_neutral, count(*) FILTER (s < -0.1) AS n_negative,
  round(count(*) FILTER (s > 0.1) * 100.0 / count(*), 6) AS pct_positive, round(count(*) FILTER (abs(s) <= 0.1) * 100.0 / count(*), 6) AS pct_neutral,
  round(count(*) FILTER (s < -0.1) * 100.0 / count(*), 6) AS pct_negative FROM toned""", "toned")
def _(t):
    out = explore.sentiment_split(t.scored)
    return out.select("total", "n_positive", "n_neutral", "n_negative", *[r6(c) for c in ("avg_sentiment", "pct_positive", "pct_neutral", "pct_negative")])


@query("a11_aspect_breakdown", "\nUNION ALL ".join(
    f"SELECT '{a}' AS aspect, count(*) FILTER (sentiment_{a}_score > 0) AS \"Positivo\", count(*) FILTER (sentiment_{a}_score = 0) AS \"Neutral\", "
    f"count(*) FILTER (sentiment_{a}_score < 0) AS \"Negativo\" FROM scored WHERE mentions_{a}" for a in ASPECTS), "scored")
def _(t):
    return explore.aspect_breakdown(t.scored)


@query("a12_category_heatmap", "SELECT category_primary AS category, count(*) AS reviews, " + ", ".join(
    f"round(avg(sentiment_{a}_score) FILTER (mentions_{a}), 6) AS {a}_mean, count(*) FILTER (mentions_{a}) AS {a}_n" for a in ASPECTS)
    + " FROM scored WHERE category_primary IS NOT NULL GROUP BY 1 HAVING count(*) >= 5 ORDER BY 2 DESC, 1 LIMIT 12", "scored")
def _(t):
    out = explore.category_heatmap(t.scored)
    return out.select("category", "reviews", *[f"{a}_n" for a in ASPECTS], *[r6(f"{a}_mean") for a in ASPECTS])


@query("a13_radar", "SELECT restaurant_id, " + ", ".join(f"round(coalesce(avg(sentiment_{a}_score) FILTER (mentions_{a}), 0), 6) AS {a}" for a in ASPECTS)
       + " FROM scored GROUP BY 1", "scored")
def _(t):
    return explore.radar(t.scored).select("restaurant_id", *[r6(a) for a in ASPECTS])


@query("a14_comparison_cards", """
SELECT restaurant_id, first(restaurant_name ORDER BY row_idx) AS restaurant_name, first(category ORDER BY row_idx) FILTER (category IS NOT NULL) AS category,
  first(price_range ORDER BY row_idx) FILTER (price_range IS NOT NULL) AS price_range, round(first(overall_rating ORDER BY row_idx) FILTER (overall_rating IS NOT NULL), 6) AS overall_rating
FROM scored GROUP BY 1""", "scored")
def _(t):
    out = explore.comparison_cards(t.scored)
    return out.select("restaurant_id", "restaurant_name", "category", "price_range", r6("overall_rating"))


@query("a15_site_ratings", "\nUNION ALL ".join(
    f"SELECT '{LABELS[a]}' AS aspect, round_even(avg({c}), 2) AS site_rating, round_even(avg(sentiment_{a}_score) FILTER (mentions_{a}), 2) AS sentiment, "
    f"count(*) FILTER (mentions_{a}) AS mentions FROM scored" for c, a in (("food_rating", "comida"), ("service_rating", "servicio"), ("ambiance_rating", "ambiente"))), "scored")
def _(t):
    return explore.site_ratings(t.scored)


@query("a16_cluster_table", "SELECT cluster, count(DISTINCT restaurant_id) AS restaurants, count(*) AS reviews, round_even(avg(overall_rating), 2) AS rating, round_even(avg(price_level), 2) AS price_level, "
       + ", ".join(f"round_even(avg(sentiment_{a}_score) FILTER (mentions_{a}), 2) AS {a}" for a in ASPECTS) + " FROM scored WHERE cluster IS NOT NULL GROUP BY 1", "scored")
def _(t):
    return explore.cluster_table(t.scored)


@query("a17_cluster_profiles", """
WITH base AS (SELECT * FROM scored WHERE cluster IS NOT NULL),
prices AS (SELECT cluster, string_agg(price_range || '=' || n, ';' ORDER BY price_range) AS price_distribution FROM (SELECT cluster, price_range, count(*) AS n FROM base WHERE price_range IS NOT NULL GROUP BY 1, 2) GROUP BY 1),
cats AS (SELECT cluster, string_agg(category || '=' || n, ';' ORDER BY n DESC, category) AS top_categories FROM (SELECT cluster, category, count(*) AS n FROM base WHERE category IS NOT NULL GROUP BY 1, 2
  QUALIFY row_number() OVER (PARTITION BY cluster ORDER BY n DESC, category) <= 3) GROUP BY 1)
SELECT cluster, count(DISTINCT restaurant_id) AS count, count(*) AS review_count, round(avg(overall_rating), 6) AS avg_rating, round(avg(sentiment_comida_score), 6) AS avg_comida_sentiment,
  round(avg(price_level), 6) AS avg_price_level, any_value(price_distribution) AS price_distribution, any_value(top_categories) AS top_categories
FROM base JOIN prices USING (cluster) JOIN cats USING (cluster) GROUP BY 1""", "scored")
def _(t):
    out = explore.cluster_profiles(t.scored)
    entry = lambda e: F.concat(e["key"], F.lit("="), e["value"].cast("string"))
    by_key = F.array_sort(F.map_entries("price_distribution"))
    by_count = F.array_sort(F.transform(F.map_entries("top_categories"), lambda e: F.struct((-e["value"]).alias("o"), e["key"].alias("key"), e["value"].alias("value"))))
    return out.select("cluster", "count", "review_count", r6("avg_rating"), r6("avg_comida_sentiment"), r6("avg_price_level"),
                      F.array_join(F.transform(by_key, entry), ";").alias("price_distribution"),
                      F.array_join(F.transform(by_count, entry), ";").alias("top_categories"))


@query("a18_cluster_points", """
SELECT restaurant_id, restaurant_name, cluster, round(avg(overall_rating), 6) AS rating, round(avg(s), 6) AS sentiment, count(*) AS reviews FROM toned
WHERE cluster IS NOT NULL GROUP BY 1, 2, 3 HAVING avg(overall_rating) IS NOT NULL""", "toned")
def _(t):
    return explore.cluster_points(t.scored).select("restaurant_id", "restaurant_name", "cluster", "reviews", r6("rating"), r6("sentiment"))


@query("a17_price_labels", "SELECT cluster, price_range AS value, count(*) AS n FROM scored WHERE cluster IS NOT NULL AND price_range IS NOT NULL GROUP BY 1, 2", "scored")
def _(t):
    return explore.cluster_value_counts(t.scored)


@query("a19_suspicious_ratings", "SELECT restaurant_name, round(rating, 6) AS rating, round(sentimiento, 6) AS sentimiento, resenas FROM suspicious", "suspicious")
def _(t):
    return quality.suspicious_ratings(t.scored).select("restaurant_name", r6("rating"), r6("sentimiento"), "resenas")


def note_sql(most: int | None = None) -> str:
    """All flagged names counted and spelt out, or only the first ``most`` spelt out."""
    if most is None:
        return "SELECT CASE WHEN count(*) = 0 THEN '' ELSE printf('" + fixed.QUALITY_NOTE + "', count(*), string_agg(restaurant_name, ', ' ORDER BY rating, restaurant_name)) END AS note FROM suspicious"
    return ("SELECT CASE WHEN count(*) = 0 THEN '' ELSE printf('" + fixed.QUALITY_NOTE + "', max(n), string_agg(restaurant_name, ', ' ORDER BY rating, restaurant_name) || CASE WHEN max(n) > "
            + f"{most} THEN printf('{fixed.MORE_NAMES}', max(n) - {most}) ELSE '' END) END AS note FROM (SELECT *, count(*) OVER () AS n FROM suspicious "
            + f"QUALIFY row_number() OVER (ORDER BY rating, restaurant_name) <= {most})")


@query("a20_quality_note", note_sql(), "suspicious")
def _(t):
    return quality.quality_note(quality.suspicious_ratings(t.scored))


@query("a20_flagged_list", "SELECT row_number() OVER (ORDER BY rating, restaurant_name) AS rank, restaurant_name, round(rating, 6) AS rating, resenas FROM suspicious", "suspicious")
def _(t):
    return quality.flagged_list(quality.suspicious_ratings(t.scored)).select("rank", "restaurant_name", r6("rating"), "resenas")


@query("a20_note_of_five", note_sql(5), "suspicious")
def _(t):
    """All flagged names counted, five of them spelt out."""
    return quality.quality_note(quality.suspicious_ratings(t.scored), 5)


@query("a21_histogram", """
SELECT CAST(least(floor((overall_rating - 0.0) / 0.25), 19) AS INT) AS bin, count(*) AS n, round(least(floor(overall_rating / 0.25), 19) * 0.25, 6) AS bin_from FROM scored
WHERE overall_rating BETWEEN 0 AND 5 GROUP BY 1, 3""", "scored")
def _(t):
    return explore.histogram(t.scored, "overall_rating", 0.0, 5.0).select("bin", "n", r6("bin_from"))


@query("a21_star_counts", "SELECT review_rating, count(*) AS n FROM scored WHERE review_rating IS NOT NULL GROUP BY 1", "scored")
def _(t):
    return explore.value_counts(t.scored, "review_rating").orderBy("review_rating")


@query("a22_cluster_labels", """
SELECT cluster, coalesce(cluster || ' - ' || max(cluster_name), 'Grupo ' || cluster) AS label FROM scored WHERE cluster IS NOT NULL GROUP BY cluster""", "scored")
def _(t):
    return explore.cluster_labels(t.scored)


_DIGEST = f"""
WITH rated AS (SELECT restaurant_name, avg(overall_rating) AS nota, count(*) AS resenas FROM scored WHERE overall_rating IS NOT NULL GROUP BY 1),
summary AS ({_SUMMARY.replace("round(avg", "(avg").replace(", 6) AS mean", ") AS mean").replace("round(count", "(count").replace(", 6) AS coverage", ") AS coverage")})
SELECT 1 AS section_no, 'RESUMEN GENERAL' AS section, 1 AS rank, '- Resenas: ' || count(*) AS line FROM scored
UNION ALL SELECT 1, 'RESUMEN GENERAL', 2, '- Restaurantes: ' || count(DISTINCT restaurant_id) FROM scored
UNION ALL SELECT 1, 'RESUMEN GENERAL', 3, '- Fuentes: ' || string_agg(DISTINCT source, ', ' ORDER BY source) FROM scored
UNION ALL SELECT 1, 'RESUMEN GENERAL', 4, '- Calificacion promedio: ' || printf('%.2f', avg(overall_rating)) || ' de 5' FROM scored
UNION ALL SELECT 2, 'SENTIMIENTO POR ASPECTO', CASE aspect WHEN 'comida' THEN 1 WHEN 'servicio' THEN 2 WHEN 'precio' THEN 3 ELSE 4 END,
  '  ' || label || ': sentimiento ' || printf('%+.2f', mean) || ', lo mencionan ' || mentions || ' resenas (' || printf('%.0f', coverage * 100) || '%)' FROM summary
UNION ALL SELECT 3, 'MEJOR CALIFICADOS', row_number() OVER (ORDER BY nota DESC, restaurant_name), '  ' || restaurant_name || ': ' || printf('%.1f', nota) || ' (' || resenas || ' resenas)' FROM rated QUALIFY row_number() OVER (ORDER BY nota DESC, restaurant_name) <= 12
UNION ALL SELECT 4, 'PEOR CALIFICADOS', row_number() OVER (ORDER BY nota, restaurant_name), '  ' || restaurant_name || ': ' || printf('%.1f', nota) || ' (' || resenas || ' resenas)' FROM rated
  WHERE restaurant_name NOT IN (SELECT restaurant_name FROM suspicious) QUALIFY row_number() OVER (ORDER BY nota, restaurant_name) <= 6
UNION ALL SELECT 5, 'LIMITACION CONOCIDA DE LOS DATOS', 1, '  ' || note FROM ({note_sql()}) WHERE note <> ''
UNION ALL SELECT 5, 'LIMITACION CONOCIDA DE LOS DATOS', 2, '  {fixed.QUALITY_ADVICE}' FROM suspicious HAVING count(*) > 0
UNION ALL SELECT 6, 'COCINAS CON MAS RESENAS', row_number() OVER (ORDER BY n DESC, category_primary), '  ' || category_primary || ': ' || n FROM (SELECT category_primary, count(*) AS n FROM scored WHERE category_primary IS NOT NULL GROUP BY 1) QUALIFY row_number() OVER (ORDER BY n DESC, category_primary) <= 10
UNION ALL SELECT 7, 'ZONAS CON MAS RESENAS', row_number() OVER (ORDER BY n DESC, location), '  ' || location || ': ' || n FROM (SELECT location, count(*) AS n FROM scored WHERE location IS NOT NULL GROUP BY 1) QUALIFY row_number() OVER (ORDER BY n DESC, location) <= 10
UNION ALL SELECT 8, 'RANGOS DE PRECIO', row_number() OVER (ORDER BY price_band), '  ' || price_band || ': ' || n || ' resenas' FROM (SELECT price_band, count(*) AS n FROM scored WHERE price_band IS NOT NULL GROUP BY 1)
UNION ALL SELECT 9, 'GRUPOS DEL CLUSTERING', row_number() OVER (ORDER BY n DESC, cluster_name), '  ' || cluster_name || ': ' || n || ' restaurantes' FROM (SELECT cluster_name, count(DISTINCT restaurant_id) AS n FROM scored WHERE cluster_name IS NOT NULL GROUP BY 1)"""


@query("a23_digest", "SELECT CAST(section_no AS INT) AS section_no, section, CAST(rank AS INT) AS rank, line FROM (" + _DIGEST.replace("\nWITH ", "WITH ") + ")", "suspicious")
def _(t):
    return explore.digest(t.scored)


@query("a23_digest_text", "SELECT string_agg(CASE WHEN rank = 1 THEN CASE WHEN section_no > 1 THEN chr(10) ELSE '' END || section || chr(10) ELSE '' END || line, chr(10) ORDER BY section_no, rank) AS digest FROM ("
       + _DIGEST.replace("\nWITH ", "WITH ") + ")", "suspicious")
def _(t):
    return explore.digest_text(explore.digest(t.scored))


# --- BI measures -------------------------------------------------------------

BASE = """count(*) AS total_reviews, count(DISTINCT restaurant_id) AS total_restaurants, round(avg(review_rating), 6) AS avg_rating,
  count(review_rating) AS rated_reviews, round(avg(word_count), 6) AS words_per_review"""


@query("a24_base_measures", f"SELECT {BASE} FROM scored", "scored")
def _(t):
    out = measures.base_measures(star.reviews(t.scored))
    return out.select("total_reviews", "total_restaurants", "rated_reviews", r6("avg_rating"), r6("words_per_review"))


SENTIMENT = """round(avg("Puntaje") FILTER ("Mencionado"), 6) AS mean_sentiment, count(*) FILTER ("Mencionado") AS mentions, round(count(*) FILTER ("Mencionado") / count(*), 6) AS coverage,
  count(*) FILTER ("Mencionado" AND "Sentimiento" = 'Positivo') AS positive_mentions, count(*) FILTER ("Mencionado" AND "Sentimiento" = 'Negativo') AS negative_mentions,
  round(count(*) FILTER ("Mencionado" AND "Sentimiento" = 'Positivo') / nullif(count(*) FILTER ("Mencionado"), 0), 6) AS pct_positive,
  round(count(*) FILTER ("Mencionado" AND "Sentimiento" = 'Negativo') / nullif(count(*) FILTER ("Mencionado"), 0), 6) AS pct_negative,
  round((count(*) FILTER ("Mencionado" AND "Sentimiento" = 'Positivo') - count(*) FILTER ("Mencionado" AND "Sentimiento" = 'Negativo')) / nullif(count(*) FILTER ("Mencionado"), 0), 6) AS opinion_balance,
  count(DISTINCT a."RestauranteID") FILTER ("Mencionado" AND "Sentimiento" = 'Negativo') AS restaurants_with_complaints"""
SENTIMENT_DOUBLES = ("mean_sentiment", "coverage", "pct_positive", "pct_negative", "opinion_balance")
SENTIMENT_COUNTS = ("mentions", "positive_mentions", "negative_mentions", "restaurants_with_complaints")


@query("a25_sentiment_measures", f'SELECT "Aspecto", {SENTIMENT} FROM aspects a GROUP BY 1', "aspects")
def _(t):
    out = measures.sentiment_measures(star.aspects(t.scored), ["Aspecto"])
    return out.select("Aspecto", *SENTIMENT_COUNTS, *[r6(c) for c in SENTIMENT_DOUBLES])


@query("a25_sentiment_measures_total", f"SELECT {SENTIMENT} FROM aspects a", "aspects")
def _(t):
    out = measures.sentiment_measures(star.aspects(t.scored))
    return out.select(*SENTIMENT_COUNTS, *[r6(c) for c in SENTIMENT_DOUBLES])


@query("a26_aspect_gap", """
WITH m AS (SELECT "RestauranteID", "Aspecto", avg("Puntaje") FILTER ("Mencionado") AS s, CASE "Aspecto" WHEN 'Comida' THEN 1 WHEN 'Servicio' THEN 2 WHEN 'Precio' THEN 3 ELSE 4 END AS o FROM aspects GROUP BY 1, 2),
x AS (SELECT *, max(s) OVER e AS hi, min(s) OVER e AS lo FROM m WINDOW e AS (PARTITION BY "RestauranteID"))
SELECT "RestauranteID", round(CASE WHEN count(s) > 1 THEN any_value(hi) - any_value(lo) END, 6) AS gap, string_agg("Aspecto", ', ' ORDER BY o) FILTER (s = hi) AS best_aspect,
  string_agg("Aspecto", ', ' ORDER BY o) FILTER (s = lo) AS worst_aspect FROM x GROUP BY 1""", "aspects")
def _(t):
    return measures.aspect_gap(star.aspects(t.scored)).select("RestauranteID", r6("gap"), "best_aspect", "worst_aspect")


def _matrix(column: str, value: str) -> str:
    return (f'SELECT "{column}", ' + ", ".join(
        f"round({value.format(n)}, 6) AS \"{n}\"" for n in LABELS.values()) + f' FROM aspects JOIN restaurants USING ("RestauranteID") GROUP BY 1')


@query("a27_zone_by_aspect", _matrix("Zona", "avg(\"Puntaje\") FILTER (\"Mencionado\" AND \"Aspecto\" = '{0}')"), "aspects restaurants")
def _(t):
    fact, entities, _ = _star(t)
    return measures.attribute_matrix(fact, entities, "Zona").select("Zona", *[r6(n) for n in LABELS.values()])


@query("a27_cuisine_balance", _matrix("CocinaPrincipal", "(count(*) FILTER (\"Mencionado\" AND \"Aspecto\" = '{0}' AND \"Sentimiento\" = 'Positivo') - count(*) FILTER (\"Mencionado\" AND \"Aspecto\" = '{0}' AND \"Sentimiento\" = 'Negativo')) / nullif(count(*) FILTER (\"Mencionado\" AND \"Aspecto\" = '{0}'), 0)"), "aspects restaurants")
def _(t):
    fact, entities, _ = _star(t)
    return measures.attribute_matrix(fact, entities, "CocinaPrincipal", "opinion_balance").select("CocinaPrincipal", *[r6(n) for n in LABELS.values()])


_LEVELS = ("Zona", "CocinaPrincipal", "BandaPrecio", "Aspecto")


def _tree_sql() -> str:
    """Leaf counts, then at each level the three largest children of the nodes kept above."""
    blank = ", ".join(f"""coalesce("{c}", '(blank)') AS "{c}\"""" for c in _LEVELS[:-1])
    parts = [f"""leaf AS (SELECT {blank}, "Aspecto" FROM aspects JOIN restaurants USING ("RestauranteID") WHERE "Mencionado" AND "Sentimiento" = 'Negativo')"""]
    shown = ["SELECT 0 AS depth, " + ", ".join(f'NULL AS "{c}"' for c in _LEVELS) + ", 1 AS rank, count(*) AS negative_mentions FROM leaf"]
    for d in range(1, len(_LEVELS) + 1):
        path, above = [f'"{c}"' for c in _LEVELS[:d]], [f'"{c}"' for c in _LEVELS[:d - 1]]
        inside = f"PARTITION BY {', '.join(above)} " if above else ""
        below = f" WHERE ({', '.join(above)}) IN (SELECT ({', '.join(above)}) FROM l{d - 1})" if len(above) > 1 else f" WHERE {above[0]} IN (SELECT {above[0]} FROM l1)" if above else ""
        parts.append(f"l{d} AS (SELECT {', '.join(path)}, count(*) AS n, row_number() OVER ({inside}ORDER BY count(*) DESC, {path[-1]}) AS rank FROM leaf{below} "
                     f"GROUP BY {', '.join(path)} QUALIFY rank <= 3)")
        shown.append(f"SELECT {d}, {', '.join(path + ['NULL'] * (len(_LEVELS) - d))}, CAST(rank AS INT), n FROM l{d}")
    return "WITH " + ",\n".join(parts) + "\n" + "\nUNION ALL ".join(shown)


@query("a28_decomposition_tree", _tree_sql(), "aspects restaurants")
def _(t):
    fact, entities, _ = _star(t)
    return measures.decomposition_tree(fact, entities)


@query("a29_negative_share", """
SELECT "Aspecto", count(*) FILTER ("Mencionado") AS mentions, count(*) FILTER ("Mencionado" AND "Sentimiento" = 'Negativo') AS negative_mentions,
  round(count(*) FILTER ("Mencionado" AND "Sentimiento" = 'Negativo') / count(*) FILTER ("Mencionado"), 6) AS pct_negative FROM aspects GROUP BY 1""", "aspects")
def _(t):
    return measures.negative_share(star.aspects(t.scored)).select("Aspecto", "mentions", "negative_mentions", r6("pct_negative"))


PEERS_SQL = """own AS (SELECT "RestauranteID", sum("Puntaje") FILTER ("Mencionado") AS ss, count(*) FILTER ("Mencionado") AS nn FROM aspects GROUP BY 1),
peers AS (SELECT "RestauranteID", "CocinaPrincipal", "Zona", ss / nullif(nn, 0) AS m, sum(ss) OVER (PARTITION BY "CocinaPrincipal") / sum(nn) OVER (PARTITION BY "CocinaPrincipal") AS c,
  sum(ss) OVER (PARTITION BY "Zona") / sum(nn) OVER (PARTITION BY "Zona") AS z FROM own JOIN restaurants USING ("RestauranteID"))"""


@query("a29_volume_against_sentiment", f"""WITH {PEERS_SQL}
SELECT "RestauranteID", "CocinaPrincipal", round(m, 6) AS mean_sentiment, round(c, 6) AS cuisine_sentiment, round(m - c, 6) AS diff_cuisine, total_reviews
FROM peers JOIN (SELECT restaurant_id AS "RestauranteID", count(*) AS total_reviews FROM scored GROUP BY 1 HAVING count(*) >= 5) USING ("RestauranteID")""", "aspects restaurants")
def _(t):
    out = measures.volume_against_sentiment(*_star(t))
    return out.select("RestauranteID", "CocinaPrincipal", "total_reviews", *[r6(c) for c in ("mean_sentiment", "cuisine_sentiment", "diff_cuisine")])


@query("w09_peer_benchmark", f"""WITH {PEERS_SQL}
SELECT "RestauranteID", "CocinaPrincipal", "Zona", round(m, 6) AS mean_sentiment, round(c, 6) AS cuisine_sentiment, round(m - c, 6) AS diff_cuisine, round(z, 6) AS zone_sentiment, round(m - z, 6) AS diff_zone FROM peers""", "aspects restaurants")
def _(t):
    fact, entities, _ = _star(t)
    out = measures.peer_benchmark(fact, entities)
    return out.select("RestauranteID", "CocinaPrincipal", "Zona", *[r6(c) for c in ("mean_sentiment", "cuisine_sentiment", "diff_cuisine", "zone_sentiment", "diff_zone")])


@query("w10_sentiment_rank", """
SELECT "RestauranteID", round(m, 6) AS mean_sentiment, CASE WHEN m IS NOT NULL THEN dense_rank() OVER (ORDER BY coalesce(m, 0) DESC) END AS rank
FROM (SELECT "RestauranteID", sum("Puntaje") FILTER ("Mencionado") / nullif(count(*) FILTER ("Mencionado"), 0) AS m FROM aspects GROUP BY 1)""", "aspects")
def _(t):
    return measures.sentiment_rank(star.aspects(t.scored)).select("RestauranteID", r6("mean_sentiment"), "rank")


@query("w11_share_of_all", """
SELECT "Zona", total_reviews, round(total_reviews / sum(total_reviews) OVER (), 6) AS share FROM (SELECT location AS "Zona", count(*) AS total_reviews FROM scored GROUP BY 1)""", "scored")
def _(t):
    counted = t.scored.groupBy(F.col("location").alias("Zona")).agg(F.count("*").alias("total_reviews"))
    return measures.share_of_total(counted).select("Zona", "total_reviews", r6("share"))


@query("w11_share_of_total", """
SELECT "Zona", total_reviews, round(total_reviews / sum(total_reviews) OVER (), 6) AS share FROM (SELECT location AS "Zona", count(*) AS total_reviews FROM scored WHERE category_primary = 'MACHINERY' GROUP BY 1)""", "scored")
def _(t):
    counted = t.scored.filter("category_primary = 'MACHINERY'").groupBy(F.col("location").alias("Zona")).agg(F.count("*").alias("total_reviews"))
    return measures.share_of_total(counted).select("Zona", "total_reviews", r6("share"))


# --- time --------------------------------------------------------------------

GAPS = "month(review_date) NOT IN (3, 4, 8)"  # months without reviews, in every year
MONTHS_SQL = f"""daily AS (SELECT CAST(review_date AS DATE) AS d, count(*) AS n FROM scored WHERE review_date IS NOT NULL AND {{0}} GROUP BY 1),
months AS (SELECT CAST(unnest(generate_series(date_trunc('month', min(d)), date_trunc('month', max(d)), INTERVAL 1 MONTH)) AS DATE) AS month FROM daily),
volume AS (SELECT month, CAST(coalesce(sum(n), 0) AS BIGINT) AS reviews, count(d) AS active_days FROM months LEFT JOIN daily ON date_trunc('month', d) = month GROUP BY 1)"""
TREND_SQL = """SELECT month, reviews, nullif(lag(reviews) OVER w, 0) AS previous_month, round((reviews - nullif(lag(reviews) OVER w, 0)) / nullif(lag(reviews) OVER w, 0), 6) AS monthly_change,
  nullif(lag(reviews, 12) OVER w, 0) AS same_month_last_year, CAST(sum(reviews) OVER (ORDER BY month) AS BIGINT) AS running_total,
  round(sum(reviews) OVER t / nullif(sum(active_days) OVER t, 0), 6) AS per_active_day_3m, round(avg(reviews) OVER t, 6) AS avg_monthly_3m
FROM volume WINDOW w AS (ORDER BY month), t AS (ORDER BY month ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)"""
_TREND = ("month", "reviews", "previous_month", "same_month_last_year", "running_total")


def _trend(t, condition: str):
    out = timeseries.volume_trend(star.reviews(t.scored.filter(condition)))
    return out.select(*_TREND, r6("monthly_change"), r6("per_active_day_3m"), r6("avg_monthly_3m"))


@query("w04_w08_volume_trend", f"WITH {MONTHS_SQL.format('true')} {TREND_SQL}", "scored")
def _(t):
    return _trend(t, "true")


@query("w05_volume_trend_with_gaps", f"WITH {MONTHS_SQL.format(GAPS)} {TREND_SQL}", "scored")
def _(t):
    return _trend(t, GAPS)


@query("w06_same_month_last_year", f"WITH {MONTHS_SQL.format('true')} SELECT month, reviews, nullif(lag(reviews, 12) OVER (ORDER BY month), 0) AS same_month_last_year FROM volume", "scored")
def _(t):
    return _trend(t, "true").select("month", "reviews", "same_month_last_year")


@query("w07_running_total", f"WITH {MONTHS_SQL.format('true')} SELECT month, CAST(sum(reviews) OVER (ORDER BY month) AS BIGINT) AS running_total FROM volume", "scored")
def _(t):
    return _trend(t, "true").select("month", "running_total")


@query("w08_daily_moving_average", f"""WITH {MONTHS_SQL.format(GAPS)}, spine AS (SELECT CAST(unnest(generate_series(min(d), max(d), INTERVAL 1 DAY)) AS DATE) AS day FROM daily)
SELECT day, round((SELECT sum(n) / count(*) FROM daily WHERE d > day - INTERVAL 3 MONTH AND d <= day), 6) AS moving_average FROM spine""", "scored")
def _(t):
    return timeseries.daily_moving_average(star.reviews(t.scored.filter(GAPS))).select("day", r6("moving_average"))


@query("w08_daily_moving_average_all_months", f"""WITH {MONTHS_SQL.format('true')}, spine AS (SELECT CAST(unnest(generate_series(min(d), max(d), INTERVAL 1 DAY)) AS DATE) AS day FROM daily)
SELECT day, round((SELECT sum(n) / count(*) FROM daily WHERE d > day - INTERVAL 3 MONTH AND d <= day), 6) AS moving_average FROM spine""", "scored")
def _(t):
    return timeseries.daily_moving_average(star.reviews(t.scored)).select("day", r6("moving_average"))


ASPECT_TREND = """
WITH p AS (SELECT CAST(date_trunc('month', "Fecha") AS DATE) AS month, "Aspecto", avg("Puntaje") FILTER ("Mencionado") AS m, count(*) FILTER ("Mencionado") AS k FROM aspects
  JOIN restaurants USING ("RestauranteID") WHERE "Fecha" IS NOT NULL {0} GROUP BY 1, 2),
g AS (SELECT DISTINCT "Aspecto", x.month FROM p, (SELECT CAST(unnest(generate_series(min(month), max(month), INTERVAL 1 MONTH)) AS DATE) AS month FROM p) x),
d AS (SELECT g.month, g."Aspecto", m, coalesce(k, 0) AS k, lag(m) OVER (PARTITION BY g."Aspecto" ORDER BY g.month) AS prev FROM g LEFT JOIN p ON g.month = p.month AND g."Aspecto" = p."Aspecto")
SELECT month, "Aspecto", round(m, 6) AS mean_sentiment, k AS mentions, round(prev, 6) AS previous_month, round(CASE WHEN prev IS NOT NULL THEN coalesce(m, 0) - prev END, 6) AS change FROM d"""


def _aspect_trend(fact):
    out = timeseries.aspect_trend(fact)
    return out.select("month", "Aspecto", "mentions", *[r6(c) for c in ("mean_sentiment", "previous_month", "change")])


@query("w12_sentiment_change", ASPECT_TREND.format(""), "aspects restaurants")
def _(t):
    return _aspect_trend(star.aspects(t.scored))


@query("w13_monthly_series_with_gaps", ASPECT_TREND.format("AND month(\"Fecha\") NOT IN (3, 4, 8)"), "aspects restaurants")
def _(t):
    return _aspect_trend(star.aspects(t.scored).filter(~F.month("Fecha").isin(3, 4, 8)))


@query("w13_monthly_volume", f"WITH {MONTHS_SQL.format('true')} SELECT * FROM volume", "scored")
def _(t):
    return timeseries.monthly_volume(star.reviews(t.scored))


# --- top lists ---------------------------------------------------------------

@query("k01_top_rated", """
SELECT restaurant_id, restaurant_name, round(avg(overall_rating), 6) AS rating FROM scored WHERE overall_rating IS NOT NULL GROUP BY 1, 2 ORDER BY avg(overall_rating) DESC, 1, 2 LIMIT 10""", "scored")
def _(t):
    return explore.top_rated(t.scored).select("restaurant_id", "restaurant_name", r6("rating"))


@query("k02_best_and_worst", """
SELECT * FROM (SELECT 'best' AS side, restaurant_name, round(avg(overall_rating), 6) AS nota, count(*) AS resenas FROM scored WHERE overall_rating IS NOT NULL GROUP BY 2 ORDER BY avg(overall_rating) DESC, 2 LIMIT 12)
UNION ALL SELECT * FROM (SELECT 'worst', restaurant_name, round(avg(overall_rating), 6), count(*) FROM scored WHERE overall_rating IS NOT NULL AND restaurant_name NOT IN (SELECT restaurant_name FROM suspicious)
  GROUP BY 2 ORDER BY avg(overall_rating), 2 LIMIT 6)""", "suspicious")
def _(t):
    names = quality.name_summary(t.scored)
    best = explore.best_names(names).withColumn("side", F.lit("best"))
    worst = explore.worst_names(names, quality.contradictions(names)).withColumn("side", F.lit("worst"))
    return best.unionByName(worst).select("side", "restaurant_name", r6("nota"), "resenas")


@query("k03_top_values", "SELECT location, count(*) AS n FROM scored WHERE location IS NOT NULL GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10", "scored")
def _(t):
    return explore.top_values(t.scored, "location", 10)


@query("k04_extreme_reviews", """
SELECT * FROM (SELECT 'positive' AS side, review_id, round(s, 6) AS sentiment_score FROM toned ORDER BY s DESC, row_idx LIMIT 5)
UNION ALL SELECT * FROM (SELECT 'negative', review_id, round(s, 6) FROM toned WHERE s < 0 ORDER BY s, row_idx LIMIT 5)""", "toned")
def _(t):
    return explore.extreme_reviews(t.scored).select("side", "review_id", r6("sentiment_score"))


@query("k05_sample_reviews", """
SELECT review_id FROM scored WHERE review_text IS NOT NULL QUALIFY row_number() OVER (PARTITION BY restaurant_id ORDER BY row_idx) <= 2""", "scored")
def _(t):
    return explore.sample_reviews(t.scored).select("review_id")


@query("f32_summary_input", r"""
SELECT conv_id::VARCHAR AS restaurant_id, count(*) AS reviews, string_agg('- ' || regexp_replace(text, '^\s+|\s+$', '', 'g'), chr(10) ORDER BY turn) AS lines
FROM conversations WHERE trim(text) <> '' GROUP BY 1""")
def _(t):
    rows = t.conversations.select(F.col("conv_id").cast("string").alias("restaurant_id"), F.col("turn").alias("row_idx"), F.col("text").alias("review_text"))
    return explore.summary_input(rows)


@query("f32_summary_input_limited", r"""
SELECT conv_id::VARCHAR AS restaurant_id, count(*) AS reviews, string_agg('- ' || regexp_replace(text, '^\s+|\s+$', '', 'g'), chr(10) ORDER BY turn) AS lines
FROM (SELECT * FROM conversations WHERE trim(text) <> '' QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY turn) <= 2) GROUP BY 1""")
def _(t):
    rows = t.conversations.select(F.col("conv_id").cast("string").alias("restaurant_id"), F.col("turn").alias("row_idx"), F.col("text").alias("review_text"))
    return explore.summary_input(rows, limit=2)


@query("k07_summarisable", f"WITH {DIRECTORY_SQL} SELECT restaurant_id, resenas FROM directory WHERE resenas >= 2", "scored")
def _(t):
    return explore.summarisable(t.scored).select("restaurant_id", "resenas")


@query("k09_cluster_members", """
SELECT restaurant_id, round(avg(overall_rating), 6) AS rating, count(*) AS resenas FROM scored WHERE cluster = 2 AND contains(lower(restaurant_name), '00001') GROUP BY 1""", "scored")
def _(t):
    return explore.cluster_members(t.scored, 2, "00001").select("restaurant_id", r6("rating"), "resenas")


@query("u03_distinct_names", "SELECT restaurant_name FROM suspicious", "suspicious")
def _(t):
    return quality.suspicious_names(t.scored)


# --- row scores --------------------------------------------------------------

@query("f19_overall_sentiment", "SELECT review_id, round(s, 6) AS sentiment FROM toned", "toned")
def _(t):
    return t.scored.select("review_id", r6(scores.overall_sentiment(t.scored), "sentiment"))


@query("f20_sentiment_bucket", "SELECT review_id, CASE WHEN s > 0.1 THEN 'Positivo' WHEN s < -0.1 THEN 'Negativo' ELSE 'Neutral' END AS bucket FROM toned", "toned")
def _(t):
    return t.scored.select("review_id", scores.sentiment_bucket(scores.overall_sentiment(t.scored)).alias("bucket"))


@query("f17_encode_categories", """
SELECT review_id, CAST(coalesce(price_level, 2.0) AS DOUBLE) AS price_range_encoded, CAST(contains(lower(coalesce(category_primary, 'nan')), 'machinery') AS INT) AS cat_machinery,
  CAST(contains(lower(coalesce(category_primary, 'nan')), 'building') AS INT) AS cat_building FROM scored""", "scored")
def _(t):
    return features.encode_categories(t.scored).select("review_id", "price_range_encoded", "cat_machinery", "cat_building")


@query("f18_clustering_columns", """
SELECT review_id, round(coalesce(overall_rating, avg(overall_rating) OVER ()), 6) AS overall_rating, round(CAST(word_count AS DOUBLE), 6) AS avg_word_count,
  round(coalesce(price_level, avg(price_level) OVER ()), 6) AS price_range_encoded, CAST(o % 2 AS BIGINT) AS cat_x, round(coalesce(s, avg(s) OVER ()), 6) AS overall_sentiment_score FROM
  (SELECT *, review_id AS o, CASE WHEN review_id % 9 <> 0 THEN sentiment_comida_score END AS s FROM scored)""", "scored")
def _(t):
    """Row-level columns for clustering, gaps filled with the mean; columns that are absent are left out."""
    rows = t.scored.select("review_id", "overall_rating", F.col("word_count").cast("double").alias("avg_word_count"), F.col("price_level").alias("price_range_encoded"),
                           (F.col("review_id") % 2).cast("long").alias("cat_x"), F.when(F.col("review_id") % 9 != 0, F.col("sentiment_comida_score")).alias("overall_sentiment_score"))
    out, names = features.clustering_columns(rows)
    return out.select("review_id", *[F.col(c).cast("long").alias(c) if c == "cat_x" else r6(c) for c in names])


@query("f18_impute_means", """
SELECT review_id, round(coalesce(overall_rating, avg(overall_rating) OVER ()), 6) AS overall_rating, round(coalesce(price_level, avg(price_level) OVER ()), 6) AS price_level FROM scored""", "scored")
def _(t):
    return features.impute_means(t.scored, ["overall_rating", "price_level"]).select("review_id", r6("overall_rating"), r6("price_level"))


# --- recommendations ---------------------------------------------------------

WANTED = recommend.Preferences(category="machinery", max_price="$$", location="nation_1", priority_aspects=("comida", "servicio"))
PROFILE_LEVEL = "CASE price_range WHEN '$$$$' THEN 4 WHEN 'Desde $25 hasta $35' THEN 3 WHEN '$$' THEN 2 WHEN 'Hasta $15' THEN 1 END"
MATCH_SQL = f"""matched AS (SELECT *, round_even((CASE WHEN contains(lower(category), 'machinery') THEN 3 ELSE 0 END
  + CASE WHEN {PROFILE_LEVEL} IS NULL THEN 0 ELSE 2 * greatest(0, 1 - greatest({PROFILE_LEVEL} - 2, 0) / 3) END
  + CASE WHEN contains(lower(location), 'nation_1') THEN 2 ELSE 0 END + 3 * (c + 1) / 2 + 3 * (s + 1) / 2 + CASE WHEN overall_rating IS NULL THEN 0 ELSE 2 * overall_rating / 5 END)
  / (3 + CASE WHEN {PROFILE_LEVEL} IS NULL THEN 0 ELSE 2 END + 2 + 3 + 3 + CASE WHEN overall_rating IS NULL THEN 0 ELSE 2 END) * 100, 1) AS match_score FROM profiles)"""


@query("f28_match_score", f"WITH {PROFILE_SQL.format('scored')}, {MATCH_SQL} SELECT restaurant_id, match_score FROM matched", "scored")
def _(t):
    profiles = recommend.restaurant_profiles(t.scored)
    return profiles.select("restaurant_id", recommend.match_score(profiles, WANTED).alias("match_score"))


EXPLAIN_SQL = """coalesce(nullif(concat_ws('. ', CASE WHEN overall_rating >= 4.5 THEN printf('Excelente calificación de %.1f/5.0', overall_rating) WHEN overall_rating >= 4.0 THEN printf('Buena calificación de %.1f/5.0', overall_rating) END,
  CASE WHEN contains(lower(category), 'machinery') THEN 'Categoría: ' || category END, CASE WHEN c > 0.5 THEN 'Muy buenas reseñas sobre comida' END,
  CASE WHEN s > 0.5 THEN 'Muy buenas reseñas sobre servicio' END, CASE WHEN a > 0.5 THEN 'Muy buenas reseñas sobre ambiente' END), ''), 'Combina bien con tus preferencias') || '.' AS explanation"""


@query("f29_recommend", f"""WITH eligible AS (SELECT * FROM scored WHERE overall_rating >= 3.0), {PROFILE_SQL.format('eligible')}, {MATCH_SQL}
SELECT restaurant_id, restaurant_name, category, round(coalesce(overall_rating, 0), 6) AS overall_rating, price_range, match_score, {EXPLAIN_SQL} FROM matched WHERE match_score > 0 ORDER BY match_score DESC, restaurant_id LIMIT 5""", "scored")
def _(t):
    return recommend.recommend(t.scored, WANTED, 5, min_rating=3.0).withColumn("overall_rating", r6("overall_rating"))


@query("f30_explanation", f"WITH {PROFILE_SQL.format('scored')} SELECT restaurant_id, {EXPLAIN_SQL} FROM profiles", "scored")
def _(t):
    profiles = recommend.restaurant_profiles(t.scored)
    return profiles.select("restaurant_id", recommend.explanation(profiles, WANTED).alias("explanation"))


@query("k06_top_recommendations", f"WITH {PROFILE_SQL.format('scored')}, {MATCH_SQL} SELECT restaurant_id, match_score FROM matched WHERE match_score > 0 ORDER BY match_score DESC, restaurant_id LIMIT 25", "scored")
def _(t):
    return recommend.recommend(t.scored, WANTED, 25).select("restaurant_id", "match_score")
