import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from savora.functions.scores import rating_class
from savora.operators import cluster, metrics, splits, textmodel


# --- clustering --------------------------------------------------------------

def silhouette(points, labels):
    total = 0.0
    for p, c in zip(points, labels):
        by = {}
        for q, d in zip(points, labels):
            by.setdefault(d, []).append(float(np.linalg.norm(np.subtract(p, q))))
        if len(by[c]) == 1:
            continue
        inside = sum(by[c]) / (len(by[c]) - 1)
        near = min(sum(v) / len(v) for d, v in by.items() if d != c)
        total += (near - inside) / max(near, inside)
    return total / len(points)


@pytest.mark.parametrize("slice_bytes", [1 << 26, 400])
def test_euclidean_silhouette(spark, slice_bytes):
    rng = random.Random(5)
    points = [[rng.gauss(c * 3, 1), rng.gauss(-c, 1)] for c in (0, 1, 2) for _ in range(15)] + [[50.0, 50.0]]
    labels = [c for c in (0, 1, 2) for _ in range(15)] + [9]
    df = spark.createDataFrame([(i, p, c) for i, (p, c) in enumerate(zip(points, labels))], "id long, v array<double>, c int")
    got = cluster.euclidean_silhouette(df, "id", "v", "c", slice_bytes).first()
    assert got.silhouette == pytest.approx(silhouette(points, labels))
    assert got.points == 46


def test_one_cluster_has_no_silhouette(spark):
    df = spark.createDataFrame([(1, [0.0], 0), (2, [1.0], 0)], "id long, v array<double>, c int")
    assert cluster.euclidean_silhouette(df, "id", "v", "c").first().silhouette is None


def blobs(spark):
    rng = random.Random(2)
    rows = [(f"r{g}{i}", g * 10 + rng.random(), rng.random()) for g in range(3) for i in range(12)]
    return spark.createDataFrame(rows, "restaurant_id string, a double, b double")


def test_choose_k(spark):
    choice = cluster.choose_k(cluster.feature_vectors(blobs(spark).drop("b").withColumn("b", F.lit(1.0)), ["a"]), range(2, 5), restarts=2)
    assert choice.k == 3 and choice.score > 0.8


def test_choose_k_without_data(spark):
    one = cluster.feature_vectors(blobs(spark).limit(2), ["a", "b"])
    assert cluster.choose_k(one) == cluster.Choice(2, -1.0)


def test_entity_features(frame):
    df = frame([("r1", 4.0, None, "a"), ("r2", None, None, "b"), ("r2", None, None, None)], "restaurant_id string, overall_rating double, price_level double, review_text string")
    out, names = cluster.entity_features(df)
    assert names == ["avg_rating", "review_count"]
    assert {r.restaurant_id: (r.avg_rating, r.review_count) for r in out.collect()} == {"r1": (4.0, 1.0), "r2": (4.0, 1.0)}


PROFILES = "cluster int, avg_rating double, avg_price_level double, avg_comida_sentiment double, avg_servicio_sentiment double, avg_ambiente_sentiment double, review_count long"


def test_cluster_names(spark):
    df = spark.createDataFrame([(0, 4.9, 3.5, 0.8, 0.7, 0.6, 100), (1, 3.9, 1.2, 0.3, 0.2, 0.1, 300), (2, 4.2, 2.0, 0.5, 0.4, 0.3, 50)], PROFILES)
    names = cluster.cluster_names(df)
    assert len(set(names.values())) == 3
    assert names[0] == "Mejor calificados" and names[1] != "Alta gama"


def test_cluster_names_without_spread(spark):
    same = spark.createDataFrame([(0, 4.0, 1.0, 0.1, 0.1, 0.1, 5), (1, 4.0, 1.0, 0.1, 0.1, 0.1, 5)], PROFILES)
    assert cluster.cluster_names(same) == {0: "Grupo 0", 1: "Grupo 1"}
    assert cluster.cluster_names(same.limit(0)) == {}


# --- metrics -----------------------------------------------------------------

def judged(spark, rows):
    return spark.createDataFrame(rows, "actual string, predicted string, score double")


def test_constant_predictor(spark):
    df = judged(spark, [("positiva", "positiva", 0.1)] * 90 + [("no positiva", "positiva", 0.1)] * 10)
    row = metrics.evaluate(df).first()
    assert row.accuracy == 0.90 and row.recall_minority == 0.0 and row.f1_macro < 0.5
    assert metrics.roc_auc(df).first().auc == 0.5


def test_auc_with_ties_and_single_class(spark):
    rng = random.Random(4)
    rows = [(rng.choice(["positiva", "no positiva"]), "positiva", round(rng.random(), 1)) for _ in range(120)]
    found = [s for a, _, s in rows if a == "no positiva"]
    others = [s for a, _, s in rows if a == "positiva"]
    expected = sum((f > o) + 0.5 * (f == o) for f in found for o in others) / (len(found) * len(others))
    assert metrics.roc_auc(judged(spark, rows), buckets=5).first().auc == pytest.approx(expected)
    assert metrics.roc_auc(judged(spark, [("positiva", "positiva", 0.3)])).first().auc is None


def test_thresholds_against_brute_force(spark):
    rng = random.Random(9)
    delta = (0.10 + 0.01) - 0.10
    edges = [0.10 + i * delta for i in range(81)]
    rows = [(rng.choice(["positiva", "no positiva"]), "", rng.choice(edges + [rng.random(), 0.0, 1.0])) for _ in range(300)]
    got = {round(r.threshold, 6): (r.tp, r.fp) for r in metrics.threshold_metrics(judged(spark, rows)).collect()}
    assert len(got) == 81
    for edge in edges:
        assert got[round(edge, 6)] == (sum(a == "no positiva" and s >= edge for a, _, s in rows), sum(a == "positiva" and s >= edge for a, _, s in rows))


def test_rating_classes(spark):
    df = spark.createDataFrame([(5.0,), (4.0,), (3.0,), (None,)], "r double")
    assert [r.c for r in df.select(rating_class(F.col("r")).alias("c")).collect()] == ["positiva", "positiva", "no positiva", None]


# --- splits ------------------------------------------------------------------

def test_quotas():
    assert splits.quotas({"a": 7, "b": 3}, 5) in ({"a": 4, "b": 1}, {"a": 3, "b": 2})
    assert sum(splits.quotas({"a": 333, "b": 666}, 80).values()) == 80


def test_split_and_folds(spark):
    df = spark.createDataFrame([(i, "positiva" if i % 4 else "no positiva") for i in range(100)], "id long, actual string")
    train, test = splits.hold_out(df, "actual", "id")
    ids = {r.id for r in test.collect()}
    assert len(ids) == 25 and ids.isdisjoint({r.id for r in train.collect()}) and train.count() == 75
    folded = splits.folds(df, "actual", "id").groupBy("fold", "actual").count().collect()
    assert {r["count"] for r in folded} == {5, 15}


# --- terms and classifier ----------------------------------------------------

def test_terms(value):
    assert value(textmodel.terms, "La comida ÉPICA y no-muy lenta") == ["comida", "epica", "no", "lenta", "comida epica", "epica no", "no lenta"]
    assert value(textmodel.terms, None) == []


def test_run_lengths(value):
    got = value(lambda c: textmodel.run_lengths(F.split(c, " ")), "b a b c a b")
    assert [(r.term, r.tf) for r in got] == [("a", 2), ("b", 3), ("c", 1)]


TEXTS = [("comida excelente y servicio muy bueno", 5.0), ("excelente lugar comida buena", 5.0), ("comida fria servicio lento malo", 2.0)] * 15


@pytest.fixture
def labelled(spark):
    return spark.createDataFrame([(i, t + f" visita{i % 5}", r) for i, (t, r) in enumerate(TEXTS)] + [(98, "  ", 5.0), (99, "algo", None)],
                                 "review_id long, review_text string, review_rating double")


def test_labelled_reviews(labelled):
    assert textmodel.labelled_reviews(labelled).count() == 45


def test_vectors_match_the_aggregates(labelled):
    data = textmodel.labelled_reviews(labelled)
    vectoriser, _ = textmodel.fit_vectoriser(data)
    weights = {(r.review_id, r.term): r.weight for r in textmodel.tfidf(data, "review_id").collect()}
    rows = vectoriser.transform(data).select("review_id", "features").collect()
    seen = {(r.review_id, vectoriser.counter.vocabulary[i]): v for r in rows for i, v in zip(r.features.indices, r.features.values)}
    assert seen.keys() == weights.keys()
    assert all(math.isclose(seen[k], weights[k], rel_tol=1e-9) for k in seen)


def test_train_and_evaluate(labelled):
    out = textmodel.train_and_evaluate(labelled)
    assert 0.1 <= out.threshold <= 0.91
    rows = {r.approach: r for r in out.results.collect()}
    assert rows["model_half"].accuracy == 1.0 and rows["model_half"].auc == 1.0
    assert rows["lexicon_all"].tp + rows["lexicon_all"].fn == 15
    assert textmodel.cross_validation(textmodel.out_of_fold(textmodel.labelled_reviews(labelled), "review_id")).first().folds == 5
    words = {r.label: r.term for r in out.terms.filter("rank <= 3").collect()}
    assert set(words) == {"positiva", "no positiva"}


def test_fit_is_bounded_and_scores_all_rows(labelled):
    data = textmodel.labelled_reviews(labelled)
    model = textmodel.fit_model(data, max_rows=20)
    assert model.score(data).count() == 45
    full = textmodel.fit_model(data)
    assert set(model.vectoriser.counter.vocabulary) <= set(full.vectoriser.counter.vocabulary)


def test_compare_approaches(spark, labelled):
    answers = spark.createDataFrame([(i, '{"comida": "negative"}') for i in range(0, 45, 2)], "review_id long, response string")
    rows = {r.approach: r for r in textmodel.compare_approaches(labelled, sample_size=20, responses=answers).collect()}
    assert set(rows) == {"lexicon", "supervised", "external"}
    assert all(r.tp + r.fn + r.fp + r.tn == 20 for r in rows.values())


# --- silhouettes, fits side by side, evidence of a fit ------------------------

def plain_silhouette(points, labels, squared):
    import numpy as np
    gaps = ((points[:, None] - points[None]) ** 2).sum(axis=2)
    gaps = gaps if squared else np.sqrt(gaps)
    out = []
    for i, own in enumerate(labels):
        same = [j for j, c in enumerate(labels) if c == own and j != i]
        if not same:
            out.append(0.0)
            continue
        inside = gaps[i, same].mean()
        nearest = min(gaps[i, [j for j, c in enumerate(labels) if c == o]].mean() for o in set(labels) - {own})
        out.append((nearest - inside) / max(nearest, inside) if max(nearest, inside) else 0.0)
    return sum(out) / len(out)


def test_silhouettes_follow_the_definition(spark):
    import numpy as np
    points = np.random.default_rng(3).normal(size=(90, 4))
    points[:5] = points[0]  # repeated points
    first, second = [i % 3 for i in range(90)], [0 if i else 7 for i in range(90)]
    df = spark.createDataFrame([(i, p.tolist(), a, b, 1) for i, (p, a, b) in enumerate(zip(points, first, second))], "id long, v array<double>, a int, b int, one int")
    table = {r["clustering"]: (r["clusters"], r["points"], r["silhouette"]) for r in cluster.silhouette_table(df, "v", ["a", "b", "one"]).collect()}
    assert table["a"][:2] == (3, 90) and abs(table["a"][2] - plain_silhouette(points, first, True)) < 1e-9
    assert table["b"][:2] == (2, 90) and abs(table["b"][2] - plain_silhouette(points, second, True)) < 1e-9
    assert table["one"] == (1, 90, None)
    for per_block in (1000, 25):
        row = cluster.euclidean_silhouette(df, "id", "v", "a", points_per_block=per_block).first()
        assert row["points"] == 90 and abs(row["silhouette"] - plain_silhouette(points, first, False)) < 1e-9
    assert cluster.euclidean_silhouette(df, "id", "v", "one").first()["silhouette"] is None
    assert cluster.silhouette_table(df.limit(0), "v", ["a"]).collect() == []


def test_starts_side_by_side_give_what_they_give_in_turn(spark):
    import numpy as np
    from pyspark.ml.functions import array_to_vector
    points = np.random.default_rng(4).normal(size=(200, 3))
    vectors = spark.createDataFrame([(i, p.tolist()) for i, p in enumerate(points)], "id long, v array<double>").select("id", array_to_vector("v").alias("features")).coalesce(1).persist()
    costs = [cluster._start(vectors, 3, cluster.SEED + i).summary.trainingCost for i in range(4)]
    together = cluster.fit_kmeans(vectors, 3, restarts=4)
    assert together.summary.trainingCost == min(costs)
    vectors.unpersist()


def test_jobs_side_by_side_keep_their_order_and_raise(spark):
    from savora.plans.concurrent import side_by_side
    assert side_by_side([lambda i=i: spark.range(i).count() for i in range(12)]) == list(range(12))

    def broken():
        raise ValueError("no")
    with pytest.raises(ValueError):
        side_by_side([lambda: 1, broken])


def test_gradient_vanishes_at_the_fit(spark):
    """From the coefficients as a table, joined with the terms: the penalised, class-weighted gradient."""
    from pyspark.sql import functions as F
    rows = [(i, " ".join(["rico", "lento", "caro", "bonito", "frio"][j] for j in range(5) if (i * 7 + j * 3) % (4 + j) < 2) or "nada", "positiva" if (i * 7) % 5 < 3 else "no positiva") for i in range(60)]
    df = spark.createDataFrame(rows, "review_id long, review_text string, actual string")
    model = textmodel.fit_model(df, tol=1e-12)
    weights = textmodel.tfidf(df, "review_id")
    scores = model.score(df).select("review_id", "score", "actual")
    counts = {r["actual"]: r["n"] for r in df.groupBy("actual").agg(F.count("*").alias("n")).collect()}
    miss = F.col("score") - (F.col("actual") == textmodel.MINORITY).cast("double")
    weight = F.when(F.col("actual") == textmodel.MINORITY, 60 / (2 * counts[textmodel.MINORITY])).otherwise(60 / (2 * counts[textmodel.POSITIVE]))
    per_row = scores.withColumn("g", miss * weight / 60)
    pulled = weights.withColumnRenamed("weight", "x").join(per_row, "review_id").groupBy("term").agg(F.sum(F.col("x") * F.col("g")).alias("g"))
    worst = pulled.join(textmodel.coefficients(model), "term").agg(F.max(F.abs(F.col("g") + F.col("weight") / 60)), F.count("*")).first()
    assert worst[0] < 1e-6 and worst[1] == textmodel.coefficients(model).count()
    assert abs(per_row.agg(F.sum("g")).first()[0]) < 1e-6


def test_cross_validation_is_that_of_its_folds(spark):
    rows = [(i, "comida rica " * (i % 3) + "servicio lento " * (i % 2) + "precio justo", "positiva" if i % 3 else "no positiva") for i in range(50)]
    oof = textmodel.out_of_fold(spark.createDataFrame(rows, "review_id long, review_text string, actual string"), "review_id")
    table = textmodel.fold_table(oof).collect()
    assert sum(r.tp + r.fn + r.fp + r.tn for r in table) == 50 and sorted(r.fold for r in table) == [0, 1, 2, 3, 4]
    whole = textmodel.cross_validation(oof).first()
    mean = sum(r.f1_macro for r in table) / 5
    assert abs(whole.f1_macro_mean - mean) < 1e-12 and whole.folds == 5


def test_a_tight_fit_takes_few_passes(spark):
    """Many rare terms: a fit on columns scaled to equal deviation takes hundreds of passes over them."""
    rng = random.Random(6)
    rows = []
    for i in range(600):
        words = [f"w{int(rng.paretovariate(0.7)) % 3000}x" for _ in range(25)]
        rows.append((i, " ".join(words), "positiva" if (i % 4 or "w1x" in words[:9]) else "no positiva"))
    df = spark.createDataFrame([*rows, (600, "zzz", "positiva")], "review_id long, review_text string, actual string")
    model = textmodel.fit_model(df, tol=1e-10)
    assert model.classifier.passes < 100
    scored = {r.review_id: r.score for r in model.score(df).collect()}
    truth = {r.review_id: r.actual == textmodel.MINORITY for r in df.collect()}
    n, m = len(truth), sum(truth.values())
    pull = {i: (scored[i] - t) * (n / (2 * m) if t else n / (2 * (n - m))) / n for i, t in truth.items()}
    assert abs(sum(pull.values())) < 1e-7
    own = dict(zip(model.vectoriser.counter.vocabulary, model.classifier.coefficients))
    by_term = {}
    for r in textmodel.tfidf(df, "review_id").collect():
        by_term[r.term] = by_term.get(r.term, 0.0) + r.weight * pull[r.review_id]
    assert max(abs(g + own[t] / n) for t, g in by_term.items()) < 1e-7
    alone = textmodel.fit_model(df.filter("actual = 'positiva'"))
    assert {r.score for r in alone.score(df.limit(9)).collect()} == {0.0}


def test_starts_share_their_passes(spark, monkeypatch):
    from pyspark import RDD
    vectors = cluster.feature_vectors(blobs(spark), ["a"]).coalesce(1).persist()
    jobs, plain = [], RDD.collect
    monkeypatch.setattr(RDD, "collect", lambda self: jobs.append(1) or plain(self))
    choice = cluster.choose_k(vectors, range(2, 6))
    assert choice.k == 3 and 0 < len(jobs) < 80  # forty starts of several passes each
    rows = choice.model.transform(vectors).select("restaurant_id", "cluster").collect()
    assert len({(r.restaurant_id[1], r.cluster) for r in rows}) == 3
    few = cluster.fit_kmeans(spark.createDataFrame([("a", 1.0), ("b", 1.0), ("c", 2.0)], "id string, a double").transform(lambda d: cluster.feature_vectors(d, ["a"], "id")), 3)
    assert len(few.clusterCenters()) == 2 and few.summary.trainingCost < 1e-12


def test_match_scores_at_the_edge_of_a_rounding(spark):
    from savora.operators import recommend
    rows = [(10 * i + j, 1 + i / 10, j / 7 - 0.5) for i in range(41) for j in range(10)] + [(1000 + i, 1 + i / 10, x / 4) for i in range(41) for x in (-3, -1, 1, 3)]
    df = spark.createDataFrame(rows, "i long, overall_rating double, sentiment_comida_score double")
    got = [r.s for r in df.select(recommend.match_score(df, recommend.Preferences(priority_aspects=("comida",))).alias("s"), "i").orderBy("i", "s").collect()]
    want = [(i, round((3.0 * (c + 1) / 2 + 2.0 * r / 5) / 5.0 * 100 * 10) / 10) for i, r, c in rows]
    assert got == [s for _, s in sorted(want)]


def test_the_note_names_everything_flagged(spark):
    from savora.operators import quality
    flagged = spark.createDataFrame([(f"r{i:03}", 1.0 + i % 2, 0.5, 3) for i in range(130)], "restaurant_name string, rating double, sentimiento double, resenas long")
    note = quality.quality_note(flagged).first()["note"]
    assert all(f"r{i:03}" in note for i in range(130)) and note.index("r128") < note.index("r001")


def test_the_digest_lists_every_group_and_source(spark):
    from savora.operators import explore
    df = spark.createDataFrame([(i, f"r{i}", f"n{i}", f"s{i:02}", f"g{i:02}", 4.0) for i in range(60)],
                               "row_idx long, restaurant_id string, restaurant_name string, source string, cluster_name string, overall_rating double")
    df = df.withColumns({**{f"sentiment_{a}_score": F.lit(0.0) for a in ("comida", "servicio", "precio", "ambiente")},
                         **{f"mentions_{a}": F.lit(True) for a in ("comida", "servicio", "precio", "ambiente")}, "category_primary": F.lit("x")})
    lines = explore.digest(df).collect()
    assert sum(r.section_no == 9 for r in lines) == 60 and any("s59" in r.line for r in lines)


def test_match_scores_on_a_rounding_edge_follow_the_sql(spark):
    from savora.operators import recommend
    rows = [(0, 1.2, -0.8333333333333334, 0.125, '$$', 'q', 'b'), (1, 1.2000000000000002, -0.8333333333333334, 0.125, '$$', 'q', 'b'), (2, 1.2, -0.625, -0.08333333333333333, '$$', 'q', 'b'), (3, 1.2000000000000002, -0.625, -0.08333333333333333, '$$', 'q', 'b'), (4, 1.1999999999999997, 0.6666666666666666, 0.875, '$$', 'q', 'b'), (5, 1.1999999999999997, 0.9166666666666666, 0.625, '$$', 'q', 'b')]
    df = spark.createDataFrame(rows, "i long, overall_rating double, sentiment_comida_score double, sentiment_servicio_score double, price_range string, category string, location string")
    wanted = recommend.Preferences(category="x", max_price="$$", location="y", priority_aspects=("comida", "servicio"))
    got = [r.s for r in df.select("i", recommend.match_score(df, wanted).alias("s")).orderBy("i").collect()]
    assert got == [29.4, 29.4, 29.4, 29.4, 52.0, 52.0]  # before: [29.5, 29.5, 29.5, 29.5, 51.9, 51.9]


def test_plane_by_steps_follows_the_iteration(spark):
    """variances nearly agree, so the steps end short of the axes; both sides must stop at the same place."""
    from pyspark.ml.functions import array_to_vector
    rng = np.random.default_rng(3)
    points = rng.normal(size=(400, 3)) * [1.0, 0.99, 0.98]
    df = spark.createDataFrame([(i, p) for i, p in enumerate(points.tolist())], "id long, v array<double>").select("id", array_to_vector("v").alias("features"))
    starts, left, expected = ([1.0, 0.9, 0.8], [0.3, -0.4, 0.5]), points.T @ points / 399, []
    for u in map(np.array, starts):
        for _ in range(5):
            u = left @ u / np.linalg.norm(left @ u)
        left = left - (u @ left @ u) * np.outer(u, u)
        expected.append(points @ u)
    got = sorted(cluster.principal_plane(df, starts, 5).collect())
    assert np.allclose([r[1:] for r in got], np.transpose(expected))
    exact = sorted(cluster.principal_plane(df).collect())
    assert not np.allclose(np.abs([r[1:] for r in exact]), np.abs(np.transpose(expected)), atol=1e-2)
    wide = df.select("id", array_to_vector(F.transform(F.expr("sequence(0, 2)"), lambda i: F.lit(3.0) * (F.col("id") % (i + 2)) + i * F.col("id"))).alias("features"))
    both = zip(sorted(cluster.principal_plane(centred(wide), starts, 3000).collect()), sorted(cluster.principal_plane(centred(wide)).collect()))
    assert all(abs(a.pc1) == pytest.approx(abs(b.pc1), abs=1e-6) for a, b in both)


def centred(df):
    from pyspark.ml.feature import StandardScaler
    return StandardScaler(inputCol="features", outputCol="s", withMean=True).fit(df).transform(df).select("id", F.col("s").alias("features"))


def test_folds_fitted_together_score_as_folds_fitted_alone(spark, monkeypatch):
    """F4 to F7: five fits went over the terms one by one; they share their passes, also when they learn from samples."""
    from pyspark import RDD
    rng = random.Random(8)
    rows = [(i, " ".join(f"w{int(rng.paretovariate(0.9)) % 40}x" for _ in range(12)), "positiva" if (i * 7) % 5 < 3 else "no positiva") for i in range(120)] + [(120, "!", "positiva")]
    df = spark.createDataFrame(rows, "review_id long, review_text string, actual string")
    folded = splits.folds(df, "actual", "review_id").cache()
    passes, plain = [], RDD.collect
    monkeypatch.setattr(RDD, "collect", lambda self: passes.append(1) or plain(self))
    for most in (1000, 60):
        passes.clear()
        together = {r.review_id: (r.fold, r.score) for r in textmodel.out_of_fold(df, "review_id", tol=1e-10, max_rows=most).collect()}
        shared_passes = len(passes)
        passes.clear()
        assert len(together) == 121
        for f in range(5):
            model = textmodel.fit_model(folded.filter(F.col("fold") != f), tol=1e-10, max_rows=most)
            for r in model.score(folded.filter(F.col("fold") == f)).collect():
                assert together[r.review_id] == (f, pytest.approx(r.score, abs=1e-6))
        assert shared_passes < len(passes) / 2
    alone = textmodel.out_of_fold(df.filter("actual = 'positiva'"), "review_id")
    assert {r.score for r in alone.collect()} == {0.0}


def test_blocks_meet_once_and_small_distances_keep_their_digits(spark):
    """every block met every other one twice, point by point; far from the origin, inner products lose near copies."""
    points = np.random.default_rng(4).normal(size=(60, 3)) + 1e6
    points[1::2] = points[::2] + 1e-4  # near copies
    labels = [i // 2 % 3 for i in range(60)]
    df = spark.createDataFrame([(i, p.tolist(), c) for i, (p, c) in enumerate(zip(points, labels))], "id long, v array<double>, c int")
    expected = plain_silhouette(points, labels, False)
    for per_block in (60, 16):
        row = cluster.euclidean_silhouette(df, "id", "v", "c", per_block)
        assert abs(row.first().silhouette - expected) < 1e-9 and row.first().points == 60
        plan = row._jdf.queryExecution().optimizedPlan().toString()
        assert "least(" in plan and "greatest(" in plan


@pytest.mark.parametrize("words_per_chunk", [3, 40, 2_000_000])
def test_tfidf_does_not_depend_on_its_chunks(spark, monkeypatch, words_per_chunk):
    """Against a count in plain Python; the terms met one by one before, now only chunks of packed terms do."""
    monkeypatch.setattr(textmodel, "BUCKETS", 3)  # several terms share a bucket
    rng = random.Random(8)
    texts = [" ".join(rng.choice(["el", "Épica", "casa_1", "ñandú", "w7", "x", "½", f"solo{i}"]) for _ in range(rng.randrange(25))) for i in range(30)]
    rows = [(f"d{i}", None if i == 7 else t) for i, t in enumerate([*texts, "el el", "raro"])]
    df = spark.createDataFrame(rows, "name string, body string").repartition(3)
    plain = str.maketrans({"é": "e", "ñ": "n", "ú": "u", "½": "1⁄2"})
    counted = {}
    for name, body in rows:
        ws = [w for w in ((body or "").lower().translate(plain).replace("⁄", " ").split()) if len(w) > 1 and w not in textmodel.fixed.MODEL_STOPWORDS]
        grams = [*ws, *(f"{a} {b}" for a, b in zip(ws, ws[1:]))]
        counted[name] = {t: grams.count(t) for t in grams}
    df_of = {}
    for own in counted.values():
        for t in own:
            df_of[t] = df_of.get(t, 0) + 1
    expected = {}
    for name, own in counted.items():
        w = {t: (1 + math.log(n)) * (math.log((1 + len(rows)) / (1 + df_of[t])) + 1) for t, n in own.items() if 2 <= df_of[t] <= 0.9 * len(rows)}
        length = math.sqrt(sum(x * x for x in w.values()))
        expected.update({(name, t): x / length for t, x in w.items()})
    got = textmodel.tfidf(df, "name", "body", words_per_chunk=words_per_chunk).collect()
    assert {(r.name, r.term): pytest.approx(r.weight, abs=1e-12) for r in got} == expected and len(got) == len(expected)


def test_a_term_crosses_the_shuffle_once_per_chunk(spark):
    """40 documents of one vocabulary: before, each brought its own row of every term."""
    df = spark.createDataFrame([(i, "mesa silla plato vaso") for i in range(40)], "review_id long, review_text string").coalesce(1)
    rows = textmodel.term_chunks(df, "review_id").filter("bucket >= 0").collect()
    found = [t for r in rows for t in r.terms.split("\n")]
    assert len(found) == len(set(found)) == 7 and sum(len(r.cells) for r in rows) == 40 * 7 * 8
    empty = df.filter("review_id < 0")
    assert textmodel.tfidf(empty, "review_id").count() == 0


def labelled_words(spark, n, seed=9):
    rng = random.Random(seed)
    rows = [(i, " ".join(f"w{int(rng.paretovariate(0.9)) % 40}x" for _ in range(12)), "positiva" if (i * 7) % 5 < 3 else "no positiva") for i in range(n)]
    return spark.createDataFrame([*rows, (n, "!", "positiva")], "review_id long, review_text string, actual string")


def test_terms_stay_out_of_the_driver(spark, monkeypatch):
    """F1, F3, F4, F6: the vocabulary of a fit was collected, and sent back to score."""
    monkeypatch.setattr(textmodel.CountVectorizer, "fit", lambda *a: pytest.fail("vocabulary on the driver"))
    df = labelled_words(spark, 80)
    model = textmodel.fit_model(df, tol=1e-10)
    assert model.score(df).columns == [*df.columns, "score"] and textmodel.influential_terms(model, 3).count() == 6
    assert {r.review_id for r in model.score(df).collect()} == set(range(81))
    assert "classifier" not in vars(model) and "vectoriser" not in vars(model)


def test_large_sums_are_added_up_before_the_driver(spark, monkeypatch):
    """every task sent its sums for all rows and fits to the driver, which held the vectors of all fits."""
    from savora.operators import logistic
    df = labelled_words(spark, 120).repartition(3)
    usual = {r.review_id: r.score for r in textmodel.out_of_fold(df, "review_id", tol=1e-10).collect()}
    for name, few in (("NUMBERS_TO_DRIVER", 0), ("NUMBERS_AT_ONCE", 1), ("CELLS_PER_TASK", 50), ("CELLS_PER_BLOCK", 100)):
        monkeypatch.setattr(logistic, name, few)
    cut = {r.review_id: r.score for r in textmodel.out_of_fold(df, "review_id", tol=1e-10).collect()}
    assert cut == {i: pytest.approx(s, abs=1e-6) for i, s in usual.items()} and len(cut) == 121


def test_a_model_learns_from_every_row(spark):
    """F8 to F14: from more than 200,000 rows only a sample of that size was learnt from."""
    n = 200_060
    ids = spark.range(n).select(F.col("id").alias("review_id"), F.when(F.col("id") % 4 == 0, textmodel.MINORITY).otherwise(textmodel.POSITIVE).alias("actual"))
    left = ids.join(splits.stratified_sample(ids, "actual", "review_id", 200_000), "review_id", "left_anti").select("review_id", F.lit(True).alias("left"))
    rows = ids.join(F.broadcast(left), "review_id", "left").select("review_id", "actual", F.when(F.col("left"), "rareza").otherwise(
        F.concat(F.lit("casa"), (F.col("review_id") % 5).cast("string"))).alias("review_text"))
    terms = {r.term for r in textmodel.coefficients(textmodel.fit_model(rows)).collect()}
    assert terms == {"rareza", *(f"casa{i}" for i in range(5))}


def test_folds_learn_from_every_row(spark, monkeypatch):
    """of 250,100 rows four folds are more than the old sample."""
    from savora.operators import logistic
    seen, plain = [], logistic.fit_parts
    monkeypatch.setattr(logistic, "fit_parts", lambda cells, y, learns, *a: seen.append(learns.sum(axis=0).tolist()) or plain(cells, y, learns, *a))
    n = 250_100
    rows = spark.range(n).select(F.col("id").alias("review_id"), F.concat(F.lit("casa"), (F.col("id") % 5).cast("string")).alias("review_text"),
                                 F.when(F.col("id") % 4 == 0, textmodel.MINORITY).otherwise(textmodel.POSITIVE).alias("actual"))
    assert textmodel.out_of_fold(rows, "review_id").count() == n
    assert sum(seen[0]) == 4 * n and min(seen[0]) > 200_000


def test_training_shares_counts_and_passes_and_keeps_its_results(spark, monkeypatch):
    """the terms of the training part were counted twice, and the fit to all of it had passes of its own."""
    from savora.operators import logistic
    texts = labelled_words(spark, 100).withColumn("review_rating", F.when(F.col("actual") == textmodel.MINORITY, 1.0).otherwise(5.0)).drop("actual").cache()
    fits, plain = [], logistic.fit_parts
    monkeypatch.setattr(logistic, "fit_parts", lambda *a: fits.append(a[2].shape) or plain(*a))
    out = textmodel.train_and_evaluate(texts, tol=1e-10)
    assert fits == [(101, 6)]
    data = textmodel.labelled_reviews(texts).select("review_id", "review_text", "actual")
    train, test = splits.hold_out(data, "actual", "review_id")
    oof = textmodel.out_of_fold(train, "review_id", tol=1e-10)
    model = textmodel.fit_model(train, tol=1e-10)
    assert out.threshold == textmodel.metrics.best_threshold(oof).first()["threshold"]
    assert sorted(out.folds.collect()) == sorted(textmodel.fold_table(oof).collect())
    half = textmodel.metrics.evaluate(model.predict(test)).first()
    got = {r.approach: r for r in out.results.collect()}["model_half"]
    assert (got.tp, got.fn, got.fp, got.tn) == (half.tp, half.fn, half.fp, half.tn)
    alone = {r.term: r.weight for r in textmodel.coefficients(model).collect()}
    assert {r.term: r.weight for r in textmodel.coefficients(out.model).collect()} == {t: pytest.approx(w, abs=1e-6) for t, w in alone.items()}


def test_starts_of_a_seed_begin_alike(spark):
    """each size drew its first centres apart, with the same numbers; blocks now have points as columns, above a row of ones."""
    from savora.operators import kmeans
    vectors = cluster.feature_vectors(blobs(spark), ["a"]).coalesce(1).persist()
    together = kmeans.fit(vectors, [(k, 5) for k in (2, 3, 4)], 0)
    alone = [kmeans.fit(vectors, [(k, 5)], 0)[0] for k in (2, 3, 4)]
    assert all(np.array_equal(a.centres, b.centres) for a, b in zip(together, alone))
    assert np.array_equal(together[2].centres[:3], together[1].centres)
    x = np.array([v[0] for v in vectors.rdd.map(lambda r: (r.features.toArray(),)).collect()])
    for m in together:
        gaps = ((x[:, None] - m.centres[None]) ** 2).sum(axis=2)
        assert m.cost == pytest.approx(gaps.min(axis=1).sum())
    block = np.vstack([np.array([[0.0, 1.0, 2.0]]), np.ones(3)])  # the middle point is as near to both centres: the first has it
    (moved,), (cost,) = kmeans._moved(spark.sparkContext.parallelize([block], 1), [np.array([[0.0], [2.0]])], 0.0, 1)
    assert moved.tolist() == [[0.5], [2.0]] and cost == pytest.approx(0.5)
    vectors.unpersist()
