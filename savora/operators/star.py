"""The star schema: two facts, three dimensions, and their joins."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from savora import fixed_values as fixed
from savora.functions import scores
from savora.operators.ordering import keep_first

# The display names of the model's columns.
RESTAURANT_NAMES = {
    "restaurant_id": "RestauranteID", "restaurant_name": "Restaurante", "category": "Cocina",
    "category_primary": "CocinaPrincipal", "location": "Zona", "address": "Dirección",
    "price_band": "BandaPrecio", "price_level": "NivelPrecio", "overall_rating": "Calificación",
    "cluster": "GrupoID", "cluster_name": "Grupo", "source": "Fuente",
}
REVIEW_NAMES = {
    "review_id": "ReseñaID", "restaurant_id": "RestauranteID", "review_date": "Fecha",
    "review_rating": "CalificaciónReseña", "review_text": "Texto", "reviewer_name": "Autor",
    "source": "Fuente", "review_language": "Idioma", "word_count": "Palabras",
    "char_count": "Caracteres",
}

_TYPES = {"Calificación": "double", "NivelPrecio": "double", "GrupoID": "bigint",
          "Fecha": "date", "CalificaciónReseña": "double", "Palabras": "bigint", "Caracteres": "bigint"}


def _renamed(df: DataFrame, names: dict[str, str]) -> DataFrame:
    def column(source: str, target: str) -> Column:
        value = F.col(source) if source in df.columns else F.lit(None).cast("string")
        return (value.cast(_TYPES[target]) if target in _TYPES else value).alias(target)
    return df.select(*[column(s, t) for s, t in names.items()])


def restaurants(df: DataFrame, order: str = "row_idx") -> DataFrame:
    """Dimension: the first row of every entity."""
    wanted = [c for c in RESTAURANT_NAMES if c in df.columns]
    pruned = df.select(*wanted, F.col(order).alias("_order"))
    return _renamed(keep_first(pruned, ["restaurant_id"], ["_order"]), RESTAURANT_NAMES)


def reviews(df: DataFrame) -> DataFrame:
    """Fact: one row per review, nothing dropped."""
    return _renamed(df, REVIEW_NAMES)


def aspects(df: DataFrame) -> DataFrame:
    """Fact: one row per review and aspect, unpivoted in a single scan."""
    def line(aspect: str) -> Column:
        label = F.col(scores.label_col(aspect))
        shown = (F.when(label == "positive", fixed.BUCKET_POSITIVE)
                 .when(label == "negative", fixed.BUCKET_NEGATIVE).otherwise(fixed.BUCKET_NEUTRAL))
        return F.struct(F.lit(fixed.ASPECT_LABELS[aspect]).alias("Aspecto"),
                        shown.alias("Sentimiento"),
                        F.col(scores.score_col(aspect)).cast("double").alias("Puntaje"),
                        scores.mention_flag(df, aspect).alias("Mencionado"))
    present = [a for a in fixed.ASPECTS if scores.label_col(a) in df.columns]
    return df.select(F.col("review_id").alias("ReseñaID"), F.col("restaurant_id").alias("RestauranteID"),
                     F.col("review_date").cast("date").alias("Fecha"),
                     F.inline(F.array(*[line(a) for a in present])))


def aspect_dimension(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(fixed.ASPECT_DIM_ROWS),
                                 "Aspecto string, Orden bigint, Descripcion string")


def calendar(dates: DataFrame, column: str = "Fecha", empty_from: int = 2019,
             empty_to: Column | int | None = None) -> DataFrame:
    """Dimension: every day of the years the data touches.

    Without data it spans ``empty_from`` to ``empty_to`` (the current year).
    """
    last_year = F.year(F.current_date()) if empty_to is None else (
        F.lit(empty_to) if isinstance(empty_to, int) else empty_to)
    span = dates.agg(F.coalesce(F.year(F.min(column)), F.lit(empty_from)).alias("a"),
                     F.coalesce(F.year(F.max(column)), last_year).alias("b"))
    days = span.select(F.explode(F.sequence(F.make_date("a", F.lit(1), F.lit(1)),
                                            F.make_date("b", F.lit(12), F.lit(31)))).alias("Date"))
    month_names = F.array(*[F.lit(m) for m in fixed.MONTH_NAMES])
    quarter = F.concat(F.lit("T"), F.quarter("Date").cast("string"))
    return days.select(
        "Date", F.year("Date").alias("Año"), F.month("Date").alias("NúmeroMes"),
        F.get(month_names, F.month("Date") - 1).alias("Mes"),
        F.date_format("Date", "yyyy-MM").alias("AñoMes"), quarter.alias("Trimestre"),
        F.concat(F.date_format("Date", "yyyy"), F.lit("-"), quarter).alias("AñoTrimestre"))


def star_join(fact: DataFrame, dims: dict[str, tuple[str, DataFrame, str]]) -> DataFrame:
    """Many-to-one left joins of a fact with its dimensions.

    ``dims`` maps a name to (fact key, dimension, dimension key).  No side is
    forced to broadcast: the entity dimension grows with the data, and Spark
    broadcasts the fixed ones by their size.
    """
    out = fact
    for name, (fact_key, dim, dim_key) in dims.items():
        attributes = [c for c in dim.columns if c != dim_key]
        clash = set(attributes) & set(out.columns)
        renamed = dim.select(F.col(dim_key).alias(f"_key_{name}"),
                             *[F.col(c).alias(f"{name}_{c}" if c in clash else c) for c in attributes])
        out = out.join(renamed, out[fact_key] == renamed[f"_key_{name}"], "left").drop(f"_key_{name}")
    return out
