"""Review tables bound to the given tables, once for Spark and once as SQL.

None of the given tables is a review table.  ``texts`` takes its reviews from the
documents, ``scored`` takes one review per order, ``judged`` the labelled
documents as rated and predicted rows.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame, functions as F

# --- reviews with a text: one per document -----------------------------------

_TEXT_COLUMNS = {
    "row_idx": "doc_id",
    "review_id": "doc_id",
    "restaurant_id": "source",
    "restaurant_name": "CASE doc_id % 3 WHEN 0 THEN concat('Café ', source) WHEN 1 THEN concat('CAFE  ', source) "
                       "ELSE concat(source, ' Restaurante') END",
    "category": "CASE lang WHEN 'en' THEN 'Grill / Burgers' WHEN 'fr' THEN 'French · Bistro' "
                "WHEN 'de' THEN 'German, Beer' ELSE NULL END",
    "location": "CASE WHEN doc_id % 7 = 0 THEN NULL ELSE concat('Zona ', CAST(doc_id % 5 AS {string})) END",
    "address": "CASE doc_id % 4 WHEN 0 THEN concat('Calle ', CAST(doc_id % 50 AS {string}), ' - Bella Vista - Panamá') "
               "WHEN 1 THEN concat('Local ', CAST(doc_id % 9 AS {string}), ' - Zona ', CAST(doc_id % 5 AS {string})) "
               "WHEN 2 THEN 'Panamá' ELSE NULL END",
    "price_range": "CASE doc_id % 6 WHEN 0 THEN 'Hasta $15' WHEN 1 THEN '$$' WHEN 2 THEN 'Desde $25 hasta $35' "
                   "WHEN 3 THEN ' $$$$ ' WHEN 4 THEN NULL ELSE 'Mid-Range' END",
    "overall_rating": "CASE WHEN doc_id % 11 = 0 THEN NULL ELSE 1 + (n_chars % 41) / {ten} END",
    "review_rating": "CASE WHEN quality = 1 AND toxic = 0 THEN {five} WHEN quality = 1 THEN {three} "
                     "WHEN quality = 0 THEN {one} ELSE NULL END",
    "review_text": "text",
    "review_date": "CASE doc_id % 4 WHEN 0 THEN concat('hace ', CAST(doc_id % 30 AS {string}), ' meses') "
                   "WHEN 1 THEN CAST({day} AS {string}) WHEN 2 THEN 'Hace un año' ELSE 'unknown' END",
    "lang": "lang",
    "n_chars": "n_chars",
    "source": "concat('site', CAST(doc_id % 2 AS {string}))",
}

_SPARK = {"string": "STRING", "ten": "10.0D", "five": "5.0D", "three": "3.0D", "one": "1.0D",
          "day": "date_add(DATE '2019-01-01', CAST(doc_id % 2500 AS INT))"}
_DUCK = {"string": "VARCHAR", "ten": "CAST(10 AS DOUBLE)", "five": "CAST(5 AS DOUBLE)", "three": "CAST(3 AS DOUBLE)",
         "one": "CAST(1 AS DOUBLE)", "day": "(DATE '2019-01-01' + CAST(doc_id % 2500 AS INTEGER))"}


def texts(tables) -> DataFrame:
    joined = tables.documents.join(tables.labels, "doc_id", "left")
    return joined.select(*[F.expr(e.format(**_SPARK)).alias(c) for c, e in _TEXT_COLUMNS.items()])


TEXTS_SQL = "texts AS (SELECT {} FROM (SELECT d.*, l.quality, l.toxic FROM documents d LEFT JOIN labels l USING (doc_id)))".format(
    ", ".join(f"{e.format(**_DUCK)} AS {c}" for c, e in _TEXT_COLUMNS.items()))

# --- scored reviews: one per order -------------------------------------------

_SCORED_COLUMNS = {
    "row_idx": "o_orderkey",
    "review_id": "o_orderkey",
    "restaurant_id": "concat('r', CAST(o_custkey AS {string}))",
    "restaurant_name": "CASE WHEN o_orderkey % 3 = 0 THEN upper(c_name) ELSE c_name END",
    "category": "CASE WHEN o_custkey % 17 = 0 THEN NULL ELSE concat(c_mktsegment, ', ', o_orderstatus) END",
    "category_primary": "CASE WHEN o_custkey % 17 = 0 THEN NULL ELSE c_mktsegment END",
    "location": "CASE WHEN o_custkey % 19 = 0 THEN NULL ELSE n_name END",
    "address": "concat(n_name, ' - ', c_name)",
    "price_range": "CASE o_orderpriority WHEN '1-URGENT' THEN '$$$$' WHEN '2-HIGH' THEN 'Desde $25 hasta $35' "
                   "WHEN '3-MEDIUM' THEN '$$' WHEN '5-LOW' THEN 'Hasta $15' ELSE NULL END",
    "price_level": "CASE o_orderpriority WHEN '1-URGENT' THEN {four} WHEN '2-HIGH' THEN {three} "
                   "WHEN '3-MEDIUM' THEN {two} WHEN '5-LOW' THEN {one} ELSE NULL END",
    "price_band": "CASE o_orderpriority WHEN '1-URGENT' THEN '$$$$ (mas de $35)' WHEN '2-HIGH' THEN '$$$ ($25-$35)' "
                  "WHEN '3-MEDIUM' THEN '$$ ($15-$25)' WHEN '5-LOW' THEN '$ (hasta $15)' ELSE NULL END",
    "overall_rating": "CASE WHEN o_custkey % 13 = 0 THEN NULL ELSE 1 + (o_custkey * 37 % 41) / {ten} END",
    "review_rating": "CASE WHEN o_orderkey % 8 = 0 THEN NULL ELSE {one} * (1 + ({c} {div} 19) % 5) END",
    "food_rating": "CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE {one} * (({c} {div} 23) % 6) END",
    "service_rating": "{one} * (({c} {div} 29) % 6)",
    "ambiance_rating": "{one} * (({c} {div} 31) % 6)",
    "review_text": "CASE WHEN o_orderkey % 10 = 0 THEN NULL ELSE concat('Order of ', c_name, ' in ', n_name, ': ', o_orderpriority) END",
    "review_date": "CASE WHEN o_orderkey % 14 = 0 THEN NULL ELSE o_orderdate END",
    "reviewer_name": "CASE WHEN o_orderkey % 4 = 0 THEN NULL ELSE c_name END",
    "source": "concat('site', o_orderstatus)",
    "review_language": "CASE WHEN o_orderkey % 2 = 0 THEN 'spanish' ELSE 'english' END",
    "word_count": "({c} {div} 5) % 97",
    "char_count": "({c} {div} 5) % 971",
    "sentiment_comida_score": "{one} * ({c} % 3 - 1)",
    "sentiment_servicio_score": "{one} * (({c} {div} 3) % 3 - 1)",
    "sentiment_precio_score": "{one} * (({c} {div} 9) % 3 - 1)",
    "sentiment_ambiente_score": "{one} * (({c} {div} 27) % 3 - 1)",
    "mentions_comida": "({c} {div} 7) % 4 <> 0",
    "mentions_servicio": "({c} {div} 11) % 3 <> 0",
    "mentions_precio": "({c} {div} 13) % 5 = 0",
    "mentions_ambiente": "({c} {div} 17) % 2 = 0",
    "cluster": "CASE WHEN o_custkey % 10 = 0 THEN NULL ELSE CAST(o_custkey % 4 AS {int}) END",
    "cluster_name": "CASE WHEN o_custkey % 10 = 0 THEN NULL WHEN o_custkey % 4 = 0 THEN 'Alta gama' "
                    "WHEN o_custkey % 4 = 1 THEN 'Economicos' WHEN o_custkey % 4 = 2 THEN 'Mejor calificados' ELSE NULL END",
}
for _aspect in ("comida", "servicio", "precio", "ambiente"):
    _SCORED_COLUMNS[f"sentiment_{_aspect}"] = (
        "CASE " + _SCORED_COLUMNS[f"sentiment_{_aspect}_score"].replace("{one} * ", "")
        + " WHEN 1 THEN 'positive' WHEN 0 THEN 'neutral' ELSE 'negative' END")

_SPARK_SCORED = {**_SPARK, "two": "2.0D", "four": "4.0D", "int": "INT", "div": "div", "c": "CAST(round(o_totalprice * 100) AS BIGINT)"}
_DUCK_SCORED = {**_DUCK, "two": "CAST(2 AS DOUBLE)", "four": "CAST(4 AS DOUBLE)", "int": "INTEGER", "div": "//",
                "c": "CAST(round(o_totalprice * 100) AS BIGINT)"}


def scored(tables) -> DataFrame:
    # the nations are 25 by definition; customers grow and are left to the planner
    joined = (tables.orders
              .join(tables.customer, F.col("o_custkey") == F.col("c_custkey"))
              .join(F.broadcast(tables.nation), F.col("c_nationkey") == F.col("n_nationkey")))
    return joined.select(*[F.expr(e.format(**_SPARK_SCORED)).alias(c) for c, e in _SCORED_COLUMNS.items()])


SCORED_SQL = "scored AS (SELECT {} FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey)".format(
    ", ".join(f"{e.format(**_DUCK_SCORED)} AS {c}" for c, e in _SCORED_COLUMNS.items()))

# --- aspect fact: four rows per scored review --------------------------------

_BUCKET = "CASE sentiment_{0} WHEN 'positive' THEN 'Positivo' WHEN 'negative' THEN 'Negativo' ELSE 'Neutral' END"
ASPECTS_SQL = "aspects AS (" + " UNION ALL ".join(
    f'SELECT review_id AS "ReseñaID", restaurant_id AS "RestauranteID", CAST(review_date AS DATE) AS "Fecha", '
    f"'{name}' AS \"Aspecto\", {_BUCKET.format(a)} AS \"Sentimiento\", sentiment_{a}_score AS \"Puntaje\", "
    f'mentions_{a} AS "Mencionado" FROM scored'
    for a, name in (("comida", "Comida"), ("servicio", "Servicio"), ("precio", "Precio"), ("ambiente", "Ambiente"))) + ")"

RESTAURANTS_SQL = (
    'restaurants AS (SELECT restaurant_id AS "RestauranteID", restaurant_name AS "Restaurante", category AS "Cocina", '
    'category_primary AS "CocinaPrincipal", location AS "Zona", address AS "Dirección", price_band AS "BandaPrecio", '
    'price_level AS "NivelPrecio", overall_rating AS "Calificación", CAST(cluster AS BIGINT) AS "GrupoID", '
    'cluster_name AS "Grupo", source AS "Fuente" FROM scored '
    "QUALIFY row_number() OVER (PARTITION BY restaurant_id ORDER BY row_idx) = 1)")

# --- predictions: a score and a class per labelled document ------------------

_JUDGED = {
    "row_id": "doc_id",
    "actual": "CASE WHEN quality = 1 THEN 'positiva' ELSE 'no positiva' END",
    "score": "{one} * ((n_chars * 7 + doc_id * 13) % 101) / 101 * 0.6 + CASE WHEN quality = 0 THEN 0.3 ELSE 0.1 END",
}


def judged(tables) -> DataFrame:
    joined = tables.documents.join(tables.labels, "doc_id")
    base = joined.select(*[F.expr(e.format(**_SPARK)).cast("double" if c == "score" else t).alias(c)
                           for c, e, t in ((c, e, "string" if c == "actual" else "long") for c, e in _JUDGED.items())])
    return base.withColumn("predicted", F.when(F.col("score") >= 0.5, "no positiva").otherwise("positiva"))


JUDGED_SQL = ("judged AS (SELECT *, CASE WHEN score >= 0.5 THEN 'no positiva' ELSE 'positiva' END AS predicted FROM (SELECT "
              + ", ".join(f"CAST({e.format(**_DUCK)} AS DOUBLE) AS {c}" if c == "score" else f"{e.format(**_DUCK)} AS {c}"
                          for c, e in _JUDGED.items())
              + " FROM documents JOIN labels USING (doc_id)))")

# --- small SQL helpers over ``scored`` ---------------------------------------

OVERALL_SQL = (
    "coalesce((CASE WHEN mentions_comida THEN sentiment_comida_score ELSE 0 END + CASE WHEN mentions_servicio THEN sentiment_servicio_score ELSE 0 END"
    " + CASE WHEN mentions_precio THEN sentiment_precio_score ELSE 0 END + CASE WHEN mentions_ambiente THEN sentiment_ambiente_score ELSE 0 END)"
    " / nullif(CAST(mentions_comida AS INT) + CAST(mentions_servicio AS INT) + CAST(mentions_precio AS INT) + CAST(mentions_ambiente AS INT), 0),"
    " (sentiment_comida_score + sentiment_servicio_score + sentiment_precio_score + sentiment_ambiente_score) / 4)")
TONED_SQL = ("toned AS (SELECT *, " + OVERALL_SQL + " AS s, (sentiment_comida_score + sentiment_servicio_score + "
             "sentiment_precio_score + sentiment_ambiente_score) / 4 AS s_all FROM scored)")
SUSPICIOUS_SQL = (
    "suspicious AS (SELECT restaurant_name, first(overall_rating ORDER BY row_idx) FILTER (overall_rating IS NOT NULL) AS rating, "
    "avg(s_all) AS sentimiento, count(*) AS resenas FROM toned GROUP BY 1 HAVING rating < 3.0 AND sentimiento >= 0.1)")

_ALL = {"texts": ((), TEXTS_SQL), "scored": ((), SCORED_SQL), "aspects": (("scored",), ASPECTS_SQL),
        "restaurants": (("scored",), RESTAURANTS_SQL), "judged": ((), JUDGED_SQL), "toned": (("scored",), TONED_SQL),
        "suspicious": (("toned",), SUSPICIOUS_SQL)}


def with_tables(names: Sequence[str], sql: str) -> str:
    """Prefix ``sql`` with the bound tables it reads."""
    ordered: list[str] = []

    def add(name: str) -> None:
        if name not in ordered:
            for needed in _ALL[name][0]:
                add(needed)
            ordered.append(name)

    for name in names:
        add(name)
    if not ordered:
        return sql
    rest = sql.strip()
    tables = ", ".join(_ALL[n][1] for n in ordered)
    for start in ("WITH RECURSIVE ", "WITH "):
        if rest.upper().startswith(start):
            return f"{start}{tables}, {rest[len(start):]}"
    return f"WITH {tables} {rest}"
