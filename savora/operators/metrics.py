"""Classification metrics as aggregates."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from savora import fixed_values as fixed
from savora.operators import ordering
from savora.sources import shared

MINORITY, POSITIVE = fixed.MINORITY_CLASS, fixed.POSITIVE_CLASS


def _over(a: Column, b: Column) -> Column:
    """a / b, and 0 where b is 0."""
    return F.coalesce(F.try_divide(a.cast("double"), b.cast("double")), F.lit(0.0))


def confusion(df: DataFrame, actual: str = "actual", predicted: str = "predicted",
              by: Sequence[str] = ()) -> DataFrame:
    """The four cells.  The minority class is the one to find: tp are minority rows
    predicted as such."""
    a, p = F.col(actual) == MINORITY, F.col(predicted) == MINORITY
    return df.groupBy(*by).agg(F.count_if(a & p).alias("tp"), F.count_if(a & ~p).alias("fn"),
                               F.count_if(~a & p).alias("fp"), F.count_if(~a & ~p).alias("tn"))


def metrics_of(cells: DataFrame) -> DataFrame:
    """Accuracy, precision, recall and F1 of both classes, macro F1."""
    tp, fn, fp, tn = (F.col(c) for c in ("tp", "fn", "fp", "tn"))
    f1_minority, f1_positive = _over(2 * tp, 2 * tp + fp + fn), _over(2 * tn, 2 * tn + fp + fn)
    # as in the usual report, a class absent from both sides takes no part in the mean
    n_classes = ((tp + fn + fp) > 0).cast("int") + ((tn + fn + fp) > 0).cast("int")
    return cells.withColumns({
        "accuracy": _over(tp + tn, tp + fn + fp + tn),
        "precision_minority": _over(tp, tp + fp), "recall_minority": _over(tp, tp + fn),
        "f1_minority": f1_minority,
        "precision_positive": _over(tn, tn + fn), "recall_positive": _over(tn, tn + fp),
        "f1_positive": f1_positive,
        "f1_macro": _over(f1_minority + f1_positive, n_classes)})


def evaluate(df: DataFrame, actual: str = "actual", predicted: str = "predicted",
             by: Sequence[str] = ()) -> DataFrame:
    return metrics_of(confusion(df, actual, predicted, by))


def class_report(df: DataFrame, actual: str = "actual", predicted: str = "predicted") -> DataFrame:
    """Precision, recall, F1 and support per class."""
    row = evaluate(df, actual, predicted)

    def line(label: str, side: str, support: Column) -> Column:
        return F.struct(F.lit(label).alias("label"), F.col(f"precision_{side}").alias("precision"),
                        F.col(f"recall_{side}").alias("recall"), F.col(f"f1_{side}").alias("f1"),
                        support.alias("support"))

    return row.select(F.inline(F.array(line(MINORITY, "minority", F.col("tp") + F.col("fn")),
                                       line(POSITIVE, "positive", F.col("tn") + F.col("fp")))))


def label_counts(df: DataFrame, label: str = "actual") -> DataFrame:
    return df.groupBy(label).agg(F.count("*").alias("n"))


def roc_auc(df: DataFrame, actual: str = "actual", score: str = "score", buckets: int = 256) -> DataFrame:
    """Exact area under the curve for the minority class; NULL with a single class.

    The probability that a minority row scores above another, ties counting half.
    Rows collapse to one per distinct score; the running count of the other class
    comes from bucket totals, never from a window over the whole table.
    """
    per_score = df.groupBy(F.col(score).cast("double").alias("score")).agg(
        F.count_if(F.col(actual) == MINORITY).alias("found"),
        F.count_if(F.col(actual) != MINORITY).alias("others"))
    per_score = shared.stored(per_score, "scores")  # read for the cuts, the bucket totals and the sums
    bucketed = ordering.range_buckets(per_score, "score", buckets)
    below = ordering.running_total(bucketed, "others", ["score"], "others_to")
    won = F.col("found") * (F.col("others_to") - F.col("others") + F.col("others") * 0.5)
    return below.agg(F.try_divide(
        F.sum(won), F.sum("found").cast("double") * F.sum("others")).alias("auc"))


# --- decision threshold ------------------------------------------------------

FIRST_THRESHOLD, THRESHOLD_STEP, THRESHOLDS = 0.10, 0.01, 81


def threshold_metrics(df: DataFrame, actual: str = "actual", score: str = "score",
                      first: float = FIRST_THRESHOLD, step: float = THRESHOLD_STEP,
                      count: int = THRESHOLDS) -> DataFrame:
    """Metrics at every threshold from one pass over the scores.

    A row is only filed under the number of thresholds it reaches; the cells of a
    threshold are then suffix sums over at most ``count + 1`` groups.
    """
    delta = (first + step) - first

    def threshold(i: Column) -> Column:
        return F.lit(first) + i * F.lit(delta)

    s = F.col(score).cast("double")
    guess = F.floor((s - first) / delta).cast("int")
    # the division may be off by one step either way
    reached = (F.when(s >= threshold(guess + 1), guess + 2).when(s >= threshold(guess), guess + 1)
               .otherwise(guess))
    groups = df.groupBy(F.least(F.greatest(reached, F.lit(0)), F.lit(count)).alias("reached")).agg(
        F.count_if(F.col(actual) == MINORITY).alias("a"), F.count_if(F.col(actual) != MINORITY).alias("b"))
    steps = df.sparkSession.range(0, count + 1).select(F.col("id").cast("int").alias("reached"))
    dense = steps.join(groups, "reached", "left").na.fill(0, ["a", "b"])
    above = Window.orderBy(F.desc("reached")).rowsBetween(Window.unboundedPreceding, 0)
    below = Window.orderBy("reached").rowsBetween(Window.unboundedPreceding, -1)
    cells = dense.select(
        (F.col("reached") - 1).alias("i"), F.sum("a").over(above).alias("tp"),
        F.coalesce(F.sum("a").over(below), F.lit(0)).alias("fn"), F.sum("b").over(above).alias("fp"),
        F.coalesce(F.sum("b").over(below), F.lit(0)).alias("tn")).filter(F.col("i") >= 0)
    return metrics_of(cells).withColumn("threshold", threshold(F.col("i"))).drop("i")


def best_threshold(df: DataFrame, actual: str = "actual", score: str = "score") -> DataFrame:
    """Lowest threshold with the highest macro F1."""
    return (threshold_metrics(df, actual, score).select("threshold", "f1_macro")
            .orderBy(F.desc("f1_macro"), "threshold").limit(1))
