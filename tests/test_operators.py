import random

import pytest
from pyspark.sql import functions as F

from savora import schemas
from savora.functions import scores
from savora.operators import clean, explore, features, measures, ordering, quality, recommend, star, timeseries, unify
from savora.operators.explore import Filters
from savora.operators.recommend import Preferences

SOURCES = [
    ("dg_1", "Faro Azul Restaurant", "Pan tibio y queso de cabra", "a", "Panameña", None),
    ("rg_abc", "Faro  Azul Restaurante", "Media hora hasta la carta", "b", None, "$$"),
    ("dg_2", "La Veleta", "Ñoquis como los de casa", "a", "Italiana", "$"),
    ("rg_abc", "Faro Azul Restaurante", "pan tibio y QUESO de cabra...", "b", None, "$$")]
SOURCE_SCHEMA = "restaurant_id string, restaurant_name string, review_text string, source string, category string, price_range string"


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


# --- unify -------------------------------------------------------------------

def test_unify_and_fill(frame):
    out = unify.fill_metadata(unify.unify_restaurants(frame(SOURCES, SOURCE_SCHEMA)))
    rows = out.collect()
    assert len({r.restaurant_id for r in rows}) == 2
    assert {r.source_restaurant_id for r in rows} == {"dg_1", "rg_abc", "dg_2"}
    assert all(r.price_range for r in rows if r.restaurant_key == "faro azul")
    assert set(schemas.META_COLUMNS) <= set(out.columns)


def test_shared_entities(frame):
    rows = unify.shared_entities(unify.unify_restaurants(frame(SOURCES, SOURCE_SCHEMA))).collect()
    assert [(r.restaurant_key, r.source_ids) for r in rows] == [("faro azul", 2)]


def test_deduplicate(frame):
    df = frame([("r1", "Pan tibio y queso de cabra"), ("r1", "pan tibio y QUESO de cabra..."), ("r2", "Pan tibio y queso de cabra"), ("r1", "ok")],
               "restaurant_id string, review_text string")
    assert sorted(r.row_idx for r in unify.deduplicate_reviews(df).collect()) == [0, 2]


def test_deduplicate_limits_groups_before_the_shuffle(frame):
    df = frame([("r1", "Pan tibio y queso de cabra")], "restaurant_id string, review_text string")
    assert plan_of(unify.deduplicate_reviews(df)).count("WindowGroupLimit") == 2


@pytest.mark.parametrize("rows_per_chunk", [1, 3, 1000])
def test_fill_forward_then_backward(spark, rows_per_chunk):
    rng = random.Random(3)
    rows = [(i, rng.choice("ab"), rng.choice([None, None, "x", "y", "z"])) for i in range(60)]
    df = spark.createDataFrame(rows, "row_idx long, restaurant_id string, category string")
    got = {r.row_idx: r.category for r in unify.fill_metadata(df, ["category"], rows_per_chunk=rows_per_chunk).collect()}
    for i, entity, _ in rows:
        mine = [(j, c) for j, e, c in rows if e == entity and c is not None]
        before = [c for j, c in mine if j <= i]
        after = [c for j, c in mine if j > i]
        assert got[i] == (before[-1] if before else after[0] if after else None)


def test_field_coverage(frame):
    rows = {r.field: r for r in unify.field_coverage(frame(SOURCES, SOURCE_SCHEMA), ["category", "price_range"]).collect()}
    assert (rows["category"].present, rows["category"].pct) == (2, 50.0)


# --- clean -------------------------------------------------------------------

def test_clean_reviews(frame):
    df = frame([("r1", "Casa <b>X</b>", "Vasca · Peruana", " $$ ", "4.5", "Rico http://a.b ya", "hace un mes"),
                (None, "Y", "a", "$", "3", "texto", "2025-03-12"), ("r2", "Z", None, None, "malo", None, "ayer")],
               "restaurant_id string, restaurant_name string, category string, price_range string, overall_rating string, review_text string, review_date string")
    rows = clean.blanks_to_null(clean.clean_reviews(df, F.lit("2026-07-19"))).orderBy("row_idx").collect()
    assert [r.restaurant_id for r in rows] == ["r1", "r2"]
    first, second = rows
    assert (first.restaurant_name, first.category, first.category_primary) == ("Casa X", "Vasca, Peruana", "Vasca")
    assert (first.price_range, first.price_band, first.overall_rating, first.review_text) == ("$$", "$$ ($15-$25)", 4.5, "Rico ya")
    assert str(first.review_date)[:10] == "2026-06-19"
    assert (second.overall_rating, second.review_text, second.category_primary, second.review_date) == (None, None, None, None)


def test_category_encoding(frame):
    df = frame([("Bar (Rooftop)", "$$"), ("Café", "raro"), ("Cafe!", None)], "category string, price_range string")
    out = features.encode_categories(df, ["Bar (Rooftop)", "Café", "Cafe!"])
    rows = out.orderBy("row_idx").collect()
    assert [r.cat_bar_rooftop for r in rows] == [1, 0, 0]
    assert "cat_cafe" in out.columns and "cat_cafe_2" in out.columns
    assert [r.price_range_encoded for r in rows] == [2.0, 2.0, 2.0]


# --- ordering ----------------------------------------------------------------

def test_numbering_and_ranks(spark):
    rng = random.Random(1)
    values = [rng.choice([0.1, 0.5, 0.5, 0.9, None, -3.0]) for _ in range(200)]
    df = spark.createDataFrame(list(enumerate(values)), "id long, v double")
    numbered = ordering.surrogate_key(df, "id", buckets=7).collect()
    assert all(r.row_id == r.id + 1 for r in numbered) and len(numbered) == 200
    order = sorted({v for v in values if v is not None}, reverse=True)
    for r in ordering.dense_rank(df, "v", "rank", buckets=3).collect():
        assert r["rank"] == (None if r.v is None else order.index(r.v) + 1)


def test_no_window_runs_over_a_whole_table(spark):
    df = spark.range(1000)
    assert "SinglePartition" not in plan_of(ordering.number_rows(
        ordering.range_buckets(df, "id", 8), ["id"], "n", by=[])).split("Project")[0]


# --- filters and aspects -----------------------------------------------------

FILTER_ROWS = [
    ("r1", "Kai Ramen", "Japonesa, Sushi", "Japonesa", "$$", "Puerto", 4.9, "a", 1.0, 1.0, True, True),
    ("r1", "Kai Ramen", "Japonesa, Sushi", "Japonesa", "$$", "Puerto", 4.9, "b", 1.0, 0.0, True, False),
    ("r2", "Forno Sud", "Italiana", "Italiana", "$", "Colina", 4.1, "c", 0.0, 0.0, True, False),
    ("r3", "Grano Fino", "Cafe", "Cafe", "$", "Puerto", 3.2, "d", -1.0, 0.0, True, False),
    ("r3", "Grano Fino", "Cafe", "Cafe", "$", "Puerto", 3.2, "e", -1.0, 0.0, False, False)]
FILTER_SCHEMA = ("restaurant_id string, restaurant_name string, category string, category_primary string, price_band string, location string, overall_rating double, "
                 "review_text string, sentiment_comida_score double, sentiment_precio_score double, mentions_comida boolean, mentions_precio boolean")


@pytest.fixture
def reviews(frame):
    return frame(FILTER_ROWS, FILTER_SCHEMA)


@pytest.mark.parametrize("query,count", [("sushi", 2), ("italiana", 1), ("SUSHI", 2), ("  ", 5), ("zzzz", 0)])
def test_search(reviews, query, count):
    assert explore.search(reviews, query).count() == count


def test_filters_compose(reviews):
    assert explore.apply_filters(reviews, Filters()).count() == 5
    assert explore.apply_filters(reviews, Filters(zone="Puerto", min_rating=4.0)).count() == 2
    assert explore.apply_filters(reviews, Filters(category="Cafe", price="$")).count() == 2


def test_means_count_mentions_only(reviews):
    by = {r.aspect: r for r in explore.aspect_summaries(reviews).collect()}
    assert (by["precio"].mean, by["precio"].mentions, by["precio"].coverage) == (1.0, 1, 0.2)
    every = {r.aspect: r for r in explore.aspect_summaries(reviews.drop("mentions_precio")).collect()}
    assert every["precio"].mean == pytest.approx(0.2) and every["precio"].mentions == 5


def test_overall_sentiment_falls_back_to_all_aspects(reviews):
    rows = {r.review_text: r.s for r in reviews.select("review_text", scores.overall_sentiment(reviews).alias("s")).collect()}
    assert rows["a"] == 1.0 and rows["b"] == 1.0 and rows["e"] == -0.5


def test_buckets(spark):
    df = spark.createDataFrame([(0.1,), (0.11,), (-0.1,), (-0.2,), (None,)], "s double")
    assert [r.b for r in df.select(scores.sentiment_bucket(F.col("s")).alias("b")).collect()] == ["Neutral", "Positivo", "Neutral", "Negativo", "Neutral"]
    assert df.select(scores.sentiment_bucket(F.col("s"), "Sin datos").alias("b")).collect()[-1].b == "Sin datos"


DIRECTORY = [("r1", "El Faro (Bella Vista)", 4.9), ("r1", "El Faro (Bella Vista)", 4.9), ("r1", "Restaurante El Faro", 4.9), ("r2", None, None)]


def test_directory(frame):
    df = frame(DIRECTORY, "restaurant_id string, restaurant_name string, overall_rating double")
    rows = {r.restaurant_id: r for r in explore.restaurant_directory(df).collect()}
    assert (rows["r1"].restaurant_name, rows["r1"].resenas) == ("El Faro (Bella Vista)", 3)
    assert (rows["r2"].restaurant_name, rows["r2"].rating) == ("Sin nombre", None)


def test_labels(spark):
    df = spark.createDataFrame([(None, "Sin Nota", None), (4.9, "Kai Ramen", 5)], "rating double, name string, n long")
    short = [r.x for r in df.select(explore.restaurant_label(F.col("rating"), F.col("name")).alias("x")).collect()]
    assert short == ["s/c - Sin Nota", "4.9 - Kai Ramen"]
    assert df.select(explore.restaurant_label(F.col("rating"), F.col("name"), F.col("n")).alias("x")).collect()[1].x == "4.9 - Kai Ramen (5 reseñas)"


# --- quality -----------------------------------------------------------------

@pytest.mark.parametrize("rating,score,flagged", [(3.0, 0.9, 0), (1.1, 0.9, 1), (1.5, -0.8, 0)])
def test_suspicious(frame, rating, score, flagged):
    df = frame([("X", rating, score), ("X", rating, score - 0.2)], "restaurant_name string, overall_rating double, sentiment_comida_score double")
    found = quality.suspicious_ratings(df)
    assert found.count() == flagged
    assert (quality.quality_note(found).first().note != "") is bool(flagged)


def test_no_sentiment_nothing_suspicious(frame):
    assert quality.suspicious_ratings(frame([("X", 1.0)], "restaurant_name string, overall_rating double")).count() == 0


# --- digest ------------------------------------------------------------------

def test_digest(frame):
    df = frame([("r1", "Uno", "texto secreto", 4.5, "a", "Italiana", "Puerto", "$", 1.0, True), ("r1", "Uno", "texto secreto", 4.5, "b", "Italiana", "Puerto", "$", 1.0, True),
                ("r2", "Dos", "texto secreto", 4.0, "a", "Cafe", None, "$", 0.0, False)],
               "restaurant_id string, restaurant_name string, review_text string, overall_rating double, source string, category_primary string, location string, price_band string, sentiment_comida_score double, mentions_comida boolean")
    text = explore.digest_text(explore.digest(df)).first().digest
    for part in ("Resenas: 3", "Restaurantes: 2", "Fuentes: a, b", "Comida: sentimiento +1.00, lo mencionan 2 resenas (67%)"):
        assert part in text
    assert "secreto" not in text
    assert text.startswith("RESUMEN GENERAL\n- Resenas: 3\n")


# --- recommend ---------------------------------------------------------------

SCORING = [("r1", "Kai Ramen", "Japonesa", "Desde $25 hasta $35", "Puerto", 4.9, "t", 0.9, 0.8, -0.5, 0.6),
           ("r2", "Forno Sud", "Italiana", "Desde $15 hasta $25", "Colina", 4.2, "t", 0.4, 0.3, 0.4, 0.2),
           ("r3", "Grano Fino", "Cafe", "Hasta $15", "Puerto", 4.0, "t", 0.1, 0.2, 0.9, 0.1)]


@pytest.fixture
def restaurants(frame):
    return frame(SCORING, "restaurant_id string, restaurant_name string, category string, price_range string, location string, overall_rating double, review_text string, "
                          "sentiment_comida_score double, sentiment_servicio_score double, sentiment_precio_score double, sentiment_ambiente_score double")


def ranked(df, **wanted):
    return [(r.restaurant_name, r.match_score) for r in recommend.recommend(df, Preferences(**wanted)).collect()]


def test_recommendations(restaurants):
    full = ranked(restaurants, category="japonesa", max_price="Desde $25 hasta $35", location="Puerto", priority_aspects=["comida"])
    assert full[0][0] == "Kai Ramen" and full[0][1] >= 80
    assert all(0 <= s <= 100 for _, s in full) and [s for _, s in full] == sorted((s for _, s in full), reverse=True)
    budget = dict(ranked(restaurants, max_price="Hasta $15"))
    assert budget["Grano Fino"] > budget["Kai Ramen"]
    assert dict(ranked(restaurants, location="Colina"))["Forno Sud"] > dict(ranked(restaurants))["Forno Sud"] - 1e-9
    assert ranked(restaurants, priority_aspects=["precio"])[0][0] != "Kai Ramen"
    assert ranked(restaurants, priority_aspects=["comida"])[0][0] == "Kai Ramen"


def test_match_score_by_hand(restaurants):
    # (3 category + 2 * (1 - 2/3) price + 2 zone + 2 * 4.9 / 5 rating) of 9
    assert dict(ranked(restaurants, category="japonesa", max_price="$", location="puerto"))["Kai Ramen"] == 84.7


def test_explanation(restaurants):
    first = recommend.recommend(restaurants, Preferences(category="japonesa")).first()
    assert first.explanation == ("Excelente calificación de 4.9/5.0. Categoría: Japonesa. Muy buenas reseñas sobre comida. "
                                 "Muy buenas reseñas sobre servicio. Muy buenas reseñas sobre ambiente.")


# --- measures ----------------------------------------------------------------

FACT = "`ReseñaID` long, RestauranteID string, Fecha date, Aspecto string, Sentimiento string, Puntaje double, Mencionado boolean"


@pytest.fixture
def fact(spark):
    from datetime import date
    rows = [(1, "a", date(2024, 1, 5), "Comida", "Positivo", 1.0, True), (1, "a", date(2024, 1, 5), "Precio", "Positivo", 1.0, True),
            (2, "a", date(2024, 3, 5), "Servicio", "Negativo", -1.0, True), (3, "b", date(2024, 3, 6), "Comida", "Negativo", -1.0, True),
            (4, "c", date(2024, 4, 1), "Comida", "Neutral", 0.0, False), (5, "d", date(2024, 4, 1), "Comida", "Neutral", 0.0, True)]
    return spark.createDataFrame(rows, FACT)


def test_gap(fact):
    rows = {r.RestauranteID: r for r in measures.aspect_gap(fact).collect()}
    assert (rows["a"].gap, rows["a"].best_aspect, rows["a"].worst_aspect) == (2.0, "Comida, Precio", "Servicio")
    assert (rows["b"].gap, rows["b"].best_aspect, rows["b"].worst_aspect) == (None, "Comida", "Comida")
    assert (rows["c"].gap, rows["c"].best_aspect) == (None, None)


def test_rank_blank_competes_as_zero(fact):
    rows = {r.RestauranteID: r["rank"] for r in measures.sentiment_rank(fact, buckets=4).collect()}
    assert rows == {"a": 1, "d": 2, "b": 3, "c": None}


def test_peer_difference_without_mentions_is_null(spark, fact):
    dims = spark.createDataFrame([("a", "x", "z"), ("b", "x", "z"), ("c", "x", "z"), ("d", None, "w")], "RestauranteID string, CocinaPrincipal string, Zona string")
    rows = {r.RestauranteID: r for r in measures.peer_benchmark(fact, dims).collect()}
    assert rows["c"].diff_cuisine is None and rows["c"].cuisine_sentiment == 0.0
    assert rows["a"].mean_sentiment == pytest.approx(1 / 3)
    assert rows["d"].cuisine_sentiment == 0.0


def test_complaints_and_division_by_zero(fact):
    row = measures.sentiment_measures(fact).first()
    assert (row.restaurants_with_complaints, row.mentions) == (2, 5)
    nobody = measures.sentiment_measures(fact.filter("RestauranteID = 'c'")).first()
    assert nobody.pct_positive is None and nobody.mean_sentiment is None and nobody.coverage == 0.0


def test_empty_month_is_not_skipped(spark):
    from datetime import date
    days = [date(2024, 1, 1)] * 4 + [date(2024, 3, 1), date(2024, 3, 2)] + [date(2024, 4, 9)] * 3
    rows = timeseries.volume_trend(spark.createDataFrame([(d,) for d in days], "Fecha date")).orderBy("month").collect()
    assert [r.reviews for r in rows] == [4, 0, 2, 3]
    assert [r.previous_month for r in rows] == [None, 4, None, 2]
    assert [r.monthly_change for r in rows] == [None, -1.0, None, 0.5]
    assert [r.running_total for r in rows] == [4, 4, 6, 9]
    assert rows[3].per_active_day_3m == pytest.approx(5 / 3)


def test_sentiment_change_in_an_empty_month(fact):
    rows = {(str(r.month)[:7], r.Aspecto): r for r in timeseries.aspect_trend(fact).collect()}
    assert rows["2024-02", "Comida"].change == -1.0      # blank now counts as zero
    assert rows["2024-03", "Comida"].change is None      # nothing before
    assert len(rows) == 4 * 3


def test_calendar(spark):
    from datetime import date
    days = star.calendar(spark.createDataFrame([(date(2023, 5, 1),), (date(2024, 2, 1),)], "Fecha date"))
    assert days.count() == 365 + 366
    row = days.filter("Date = DATE '2024-02-29'").first()
    assert (row["Mes"], row["AñoMes"], row["Trimestre"], row["AñoTrimestre"]) == ("febrero", "2024-02", "T1", "2024-T1")
    empty = star.calendar(spark.createDataFrame([], "Fecha date"), empty_to=2020)
    assert empty.count() == 365 + 366


def test_sample_reviews_limit_before_the_shuffle(frame):
    df = frame([("r1", str(i)) for i in range(20)], "restaurant_id string, review_text string")
    out = explore.sample_reviews(df)
    assert plan_of(out).count("WindowGroupLimit") == 2
    assert sorted(r.review_text for r in out.collect()) == ["0", "1"]


# --- bounded texts, full lists -----------------------------------------------

def flagged_names(spark, n):
    return spark.createDataFrame([(f"n{i:03d}", 1.0 + (i * 7 % 5) / 10, 0.9, 2) for i in range(n)], "restaurant_name string, rating double, sentimiento double, resenas long")


def test_note_counts_all_and_names_some(spark):
    found = flagged_names(spark, 8)
    whole = quality.quality_note(found).first().note
    assert whole.count("n0") == 8 and " mas" not in whole
    short = quality.quality_note(found, 3).first().note
    assert short.startswith("Aviso de calidad de datos: 8 ") and "(n000, n005, n003 y 5 mas)" in short
    assert quality.quality_note(found.limit(0), 3).first().note == ""


def test_flagged_list_has_every_name(spark):
    rows = quality.flagged_list(flagged_names(spark, 40)).orderBy("rank").collect()
    assert [r["rank"] for r in rows] == list(range(1, 41))
    assert [(r.rating, r.restaurant_name) for r in rows] == sorted((r.rating, r.restaurant_name) for r in rows)
    assert quality.flagged_list(flagged_names(spark, 1)).count() == 1


def test_profile_maps_are_bounded(spark, monkeypatch):
    rows = [("r1", 0, f"${i % 6}", "a", 4.0) for i in range(60)] + [("r2", 1, "$1", None, None), ("r3", None, "$1", "a", 1.0)]
    df = spark.createDataFrame(rows, "restaurant_id string, cluster int, price_range string, category string, overall_rating double")
    monkeypatch.setattr(explore, "LABELS_IN_PROFILE", 2)
    profile = {r["cluster"]: r["price_distribution"] for r in explore.cluster_profiles(df).collect()}
    assert profile == {0: {"$0": 10, "$1": 10}, 1: {"$1": 1}}
    assert explore.cluster_value_counts(df).filter("cluster = 0").count() == 6
