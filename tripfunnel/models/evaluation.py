"""Classifier quality from scored rows."""

from __future__ import annotations

from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripfunnel.functions.scalar import ratio


def area_under_roc(scored: DataFrame, label: str, score: str) -> float:
    """Exact area (every distinct score is a threshold); equal scores count half."""
    pairs = scored.select(F.col(score).cast("double").alias("s"), F.col(label).cast("double").alias("y"))
    return BinaryClassificationEvaluator(
        rawPredictionCol="s", labelCol="y", numBins=0
    ).evaluate(pairs)


def classifier_metrics(
    scored: DataFrame, label: str, prediction: str, score: str | None = None
) -> DataFrame:
    """Accuracy, precision, recall and F1 of the positive class 1; AUC with a score."""
    y, p = F.col(label) == 1, F.col(prediction) == 1
    counts = scored.agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(y & p).alias("_tp"),
        F.count_if(~y & p).alias("_fp"),
        F.count_if(y & ~p).alias("_fn"),
        F.count_if(y == p).alias("_right"),
    )
    tp, fp, fn = F.col("_tp"), F.col("_fp"), F.col("_fn")
    result = counts.select(
        "rows",
        ratio(F.col("_right"), F.col("rows")).alias("accuracy"),
        ratio(tp, tp + fp).alias("precision"),
        ratio(tp, tp + fn).alias("recall"),
        ratio(2 * tp, 2 * tp + fp + fn).alias("f1"),
    )
    if score is None:
        return result
    return result.withColumn("auc", F.lit(area_under_roc(scored, label, score)))
