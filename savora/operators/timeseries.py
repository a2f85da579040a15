"""Monthly measures on a gap-free calendar.

Reviews are reduced to months first; the windows then run over the months of the
calendar, a number that does not grow with the data.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from savora.operators.measures import aspect_parts, mean_sentiment


def month_spine(facts: DataFrame, date: str, whole_years: bool = False) -> DataFrame:
    """Every month between the first and the last one with data."""
    first, last = F.trunc(F.min(date), "month"), F.trunc(F.max(date), "month")
    if whole_years:
        first, last = F.trunc(F.min(date), "year"), F.add_months(F.trunc(F.max(date), "year"), 11)
    return facts.agg(first.alias("a"), last.alias("b")).select(
        F.explode(F.sequence("a", "b", F.expr("INTERVAL 1 MONTH"))).alias("month"))


def monthly_volume(reviews: DataFrame, date: str = "Fecha") -> DataFrame:
    """Reviews and active days per month; months without reviews show 0."""
    daily = reviews.filter(F.col(date).isNotNull()).groupBy(F.to_date(date).alias("day")).agg(F.count("*").alias("n"))
    monthly = daily.groupBy(F.trunc("day", "month").alias("month")).agg(
        F.sum("n").alias("n"), F.count("*").alias("days"))
    spine = month_spine(daily, "day")
    return spine.join(monthly, "month", "left").select(
        "month", F.coalesce("n", F.lit(0)).alias("reviews"), F.coalesce("days", F.lit(0)).alias("active_days"))


def volume_trend(reviews: DataFrame, date: str = "Fecha") -> DataFrame:
    """Previous month, monthly change, same month last year, running total and the
    two three-month averages (per active day, and of the monthly figures)."""
    months = Window.orderBy("month")
    three = months.rowsBetween(-2, 0)
    n = F.col("reviews")

    def blank_if_zero(column):
        return F.nullif(column, F.lit(0))

    previous = blank_if_zero(F.lag("reviews", 1).over(months))
    return monthly_volume(reviews, date).select(
        "month", "reviews", previous.alias("previous_month"),
        F.try_divide((n - previous).cast("double"), previous.cast("double")).alias("monthly_change"),
        blank_if_zero(F.lag("reviews", 12).over(months)).alias("same_month_last_year"),
        F.sum("reviews").over(months.rowsBetween(Window.unboundedPreceding, 0)).alias("running_total"),
        F.try_divide(F.sum("reviews").over(three).cast("double"),
                     F.sum("active_days").over(three).cast("double")).alias("per_active_day_3m"),
        F.avg("reviews").over(three).alias("avg_monthly_3m"))


def daily_moving_average(reviews: DataFrame, date: str = "Fecha", months: int = 3) -> DataFrame:
    """Mean reviews of the active days in the ``months`` months up to each day.

    The exact day window: after ``add_months(day, -months)`` and up to the day.
    It runs over one row per calendar day.
    """
    daily = reviews.filter(F.col(date).isNotNull()).groupBy(F.to_date(date).alias("day")).agg(F.count("*").alias("n"))
    spine = daily.agg(F.min("day").alias("a"), F.max("day").alias("b")).select(
        F.explode(F.sequence("a", "b")).alias("day"))
    days = spine.join(daily, "day", "left").select("day", F.coalesce("n", F.lit(0)).alias("n"),
                                                   F.col("n").isNotNull().cast("int").alias("active"))
    upto = Window.orderBy("day").rowsBetween(Window.unboundedPreceding, 0)
    totals = days.select("day", F.sum("n").over(upto).alias("n_to"), F.sum("active").over(upto).alias("a_to"))
    start = totals.select(F.col("day").alias("from_day"), F.col("n_to").alias("n_from"), F.col("a_to").alias("a_from"))
    joined = totals.join(start, F.add_months("day", -months) == F.col("from_day"), "left")
    return joined.select("day", F.try_divide(
        (F.col("n_to") - F.coalesce("n_from", F.lit(0))).cast("double"),
        (F.col("a_to") - F.coalesce("a_from", F.lit(0))).cast("double")).alias("moving_average"))


def aspect_trend(aspects: DataFrame, by: Sequence[str] = ("Aspecto",), date: str = "Fecha") -> DataFrame:
    """Monthly sentiment per aspect, the month before, and the change.

    A month without mentions counts as zero in the change, provided the month
    before has data; without a month before there is no change.
    """
    dated = aspects.filter(F.col(date).isNotNull()).withColumn("month", F.trunc(date, "month"))
    parts = aspect_parts(dated, ["month", *by]).select(
        "month", *by, mean_sentiment().alias("mean_sentiment"), "mentions")
    dense = _grid(parts, by).join(parts, ["month", *by], "left")
    order = Window.partitionBy(*by).orderBy("month")
    previous = F.lag("mean_sentiment", 1).over(order)
    return dense.select("month", *by, "mean_sentiment", F.coalesce("mentions", F.lit(0)).alias("mentions"),
                        previous.alias("previous_month"),
                        F.when(previous.isNotNull(), F.coalesce("mean_sentiment", F.lit(0.0)) - previous).alias("change"))


def _grid(parts: DataFrame, by: Sequence[str]) -> DataFrame:
    """Every month of the data for every ``by``: each key explodes the same span."""
    span = parts.agg(F.min("month").alias("a"), F.max("month").alias("b"))
    months = F.sequence(span.select("a").scalar(), span.select("b").scalar(), F.expr("INTERVAL 1 MONTH"))
    return parts.select(*by).distinct().select(*by, F.explode(months).alias("month"))
