"""Evaluation of predictions. All measures come from small grouped counts or from mergeable sums."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlens.operators.ordered import add_running_total
from ledgerlens.session import stage


def confusion(df: DataFrame, truth: str, prediction: str, by: list[str] | None = None) -> DataFrame:
    """Counts per pair of true and predicted class."""
    keys = [F.col(c) for c in by or []]
    return df.groupBy(*keys, F.col(truth).alias("truth"), F.col(prediction).alias("prediction")).agg(
        F.count(F.lit(1)).alias("n")
    )


def _ratio(top: Column, bottom: Column) -> Column:
    return F.when(bottom == 0, 0.0).otherwise(F.try_divide(top, bottom))


def class_report(counts: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Precision, recall, F1 and support of every class that is true or predicted anywhere; 0 / 0 counts as 0."""
    by = by or []
    sides = F.array(
        F.struct(F.col("truth").alias("class"), F.col("n").alias("support"), F.lit(0).cast("long").alias("predicted")),
        F.struct(F.col("prediction").alias("class"), F.lit(0).cast("long").alias("support"), F.col("n").alias("predicted")),
    )
    hits = F.when(F.col("truth") == F.col("prediction"), F.col("n")).otherwise(0)
    rows = counts.select(*by, hits.alias("_hit"), F.inline(sides))
    # Each count appears once for its true and once for its predicted class; take the hits from the first.
    grouped = rows.groupBy(*by, "class").agg(
        F.sum("support").alias("support"),
        F.sum("predicted").alias("predicted"),
        F.sum(F.when(F.col("support") > 0, F.col("_hit")).otherwise(0)).alias("hit"),
    )
    precision, recall = _ratio(F.col("hit"), F.col("predicted")), _ratio(F.col("hit"), F.col("support"))
    measured = grouped.select(*by, "class", precision.alias("precision"), recall.alias("recall"), "support", "hit")
    f1 = _ratio(2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall"))
    return measured.select(*by, "class", "precision", "recall", f1.alias("f1"), "support", "hit")


def classification_report(df: DataFrame, truth: str, prediction: str) -> DataFrame:
    """Report rows ``(name, precision, recall, f1, support)`` for classes, accuracy, macro and weighted mean."""
    classes = class_report(confusion(df, truth, prediction))
    total = F.sum("support")
    weighted = [(F.sum(F.col(c) * F.col("support")) / total).alias(c) for c in ("precision", "recall", "f1")]
    macro = [F.avg(c).alias(c) for c in ("precision", "recall", "f1")]
    accuracy = F.sum("hit") / total
    summary = classes.agg(
        F.array(
            F.struct(
                F.lit("accuracy").alias("name"),
                accuracy.alias("precision"),
                accuracy.alias("recall"),
                accuracy.alias("f1"),
                total.alias("support"),
            ),
            F.struct(F.lit("macro avg").alias("name"), *macro, total.alias("support")),
            F.struct(F.lit("weighted avg").alias("name"), *weighted, total.alias("support")),
        ).alias("rows")
    )
    per_class = classes.select(F.col("class").cast("string").alias("name"), "precision", "recall", "f1", "support")
    return per_class.unionByName(summary.select(F.inline("rows")))


def classifier_metrics(df: DataFrame, truth: str, prediction: str, by: list[str] | None = None) -> DataFrame:
    """Accuracy and macro precision, recall and F1 (I20, K4), optionally per group such as a fold."""
    by = by or []
    classes = class_report(confusion(df, truth, prediction, by), by)
    return classes.groupBy(*by).agg(
        (F.sum("hit") / F.sum("support")).alias("accuracy"),
        F.avg("precision").alias("precision_macro"),
        F.avg("recall").alias("recall_macro"),
        F.avg("f1").alias("f1_macro"),
    )


def regression_metrics(df: DataFrame, truth: str, prediction: str, by: list[str] | None = None) -> DataFrame:
    """MSE, RMSE, MAE and R2 in one pass."""
    y, error = F.col(truth), F.col(truth) - F.col(prediction)
    sse = F.sum(error * error)
    sst = F.var_pop(y) * F.count(y)
    return df.groupBy(*(by or [])).agg(
        F.avg(error * error).alias("mse"),
        F.sqrt(F.avg(error * error)).alias("rmse"),
        F.avg(F.abs(error)).alias("mae"),
        (1 - F.try_divide(sse, sst)).alias("r2"),
    )


def roc_auc(df: DataFrame, score: str, label: str) -> DataFrame:
    """Exact area under the ROC curve with half credit for ties (D17); NULL when only one class is present.

    Rows are first reduced to one per distinct score, then the negatives below each score come from a running total
    over score ranges.
    """
    # Rows without a score count nowhere. A filter would say the same, but it would compute a costly score twice.
    known = F.col(score).isNotNull()
    by_score = df.groupBy(F.col(score).cast("double").alias("score")).agg(
        F.count_if(known & (F.col(label) == 1)).alias("pos"), F.count_if(known & (F.col(label) != 1)).alias("neg")
    )
    # The scores may come from costly text work and are read three times.
    running = add_running_total(stage(by_score, "scores"), "score", "neg", "below")
    wins = F.sum(F.col("pos") * (F.col("below") + F.col("neg") / 2))
    pos, neg = F.sum("pos").cast("double"), F.sum("neg").cast("double")
    return running.agg(
        F.try_divide(wins, pos * neg).alias("roc_auc"), F.sum("pos").alias("positives"), F.sum("neg").alias("negatives")
    )


def summarise_folds(scores: DataFrame) -> DataFrame:
    """Mean, population deviation and values of each metric over the folds.

    Input ``(metric, fold, value)`` has one row per fold. Metrics named ``neg_...`` are also given with the sign turned.
    """
    turned = scores.where(F.col("metric").startswith("neg_")).select(
        F.substr("metric", F.lit(5)).alias("metric"), "fold", (-F.col("value")).alias("value")
    )
    both = scores.select("metric", "fold", "value").unionByName(turned)
    values = F.transform(F.sort_array(F.collect_list(F.struct("fold", "value"))), lambda p: p["value"])
    return both.groupBy("metric").agg(
        F.avg("value").alias("mean"), F.stddev_pop("value").alias("std"), values.alias("values")
    )


def best_model(results: DataFrame, name: str = "model", score: str = "test_f1_macro") -> DataFrame:
    """Model with the best score (E6); ties go to the first name."""
    best = F.max(score)
    tied = F.min_by(name, F.struct(-F.col(score), F.col(name)))
    return results.agg(tied.alias(name), best.alias(score))
