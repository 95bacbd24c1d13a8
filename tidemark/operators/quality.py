"""Model-quality metrics: classification (label and probability) and regression.

Every metric comes from one small aggregate: the confusion matrix has at most k*k rows, so the
label metrics are a handful of partial aggregations whatever the input size. One rule for rows with gaps: a metric
uses the rows that have both of its columns (neither null nor NaN).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..plans.ordered import present, running_totals


def join_truth(truth: DataFrame, predictions: DataFrame, series_id: str = "series_id",
               target: str = "target") -> DataFrame:
    """Inner equi-join of ground truth and predictions on the series id only.

    A series with several prediction dates fans out, as in the original job. Target and prediction
    are cast to int strictly (ANSI: a malformed value raises). The join strategy is left to AQE.
    """
    t = truth.withColumn(target, F.col(target).cast("int"))
    p = predictions.withColumn("prediction", F.col("prediction").cast("int"))
    if "series_id" != series_id and "series_id" in p.columns:
        p = p.withColumnRenamed("series_id", series_id)
    return t.join(p, series_id, "inner")


def _groups(group_cols) -> list[str]:
    if group_cols is None:
        return []
    return [group_cols] if isinstance(group_cols, str) else list(group_cols)


def confusion_matrix(df: DataFrame, target: str = "target", prediction: str = "prediction",
                     group_cols=None) -> DataFrame:
    """Rows per (group, target, prediction), of the rows that have both."""
    g = _groups(group_cols)
    return (
        df.where(present(df, target) & present(df, prediction)).groupBy(*g, F.col(target).alias("target"), F.col(prediction).alias("prediction"))
        .agg(F.count(F.lit(1)).alias("n"))
    )


def _per_class(cm: DataFrame, g: list[str]) -> DataFrame:
    """Per (group, class): true support, predicted count, true positives (classes = union of both sides).

    Each matrix cell is emitted twice by a generator - once as truth, once as prediction - and one
    aggregate over at most groups * k * k * 2 rows folds them; the matrix is computed once.
    """
    as_truth = F.struct(F.col("target").alias("cls"), F.col("n").alias("support"), F.lit(0).cast("long").alias("predicted"),
                        F.when(F.col("target") == F.col("prediction"), F.col("n")).otherwise(0).cast("long").alias("tp"))
    as_pred = F.struct(F.col("prediction").alias("cls"), F.lit(0).cast("long").alias("support"),
                       F.col("n").alias("predicted"), F.lit(0).cast("long").alias("tp"))
    cells = cm.select(*g, F.explode(F.array(as_truth, as_pred)).alias("c")).select(*g, "c.*")
    return cells.groupBy(*g, "cls").agg(*[F.sum(c).cast("long").alias(c) for c in ("support", "predicted", "tp")])


def weighted_report(df: DataFrame, target: str = "target", prediction: str = "prediction",
                    group_cols=None) -> DataFrame:
    """Accuracy and support-weighted precision / recall / f1 (a never-predicted class has precision 0)."""
    g = _groups(group_cols)
    pc = _per_class(confusion_matrix(df, target, prediction, g), g)
    prec = F.coalesce(F.try_divide(F.col("tp").cast("double"), F.col("predicted")), F.lit(0.0))
    rec = F.coalesce(F.try_divide(F.col("tp").cast("double"), F.col("support")), F.lit(0.0))
    f1 = F.coalesce(F.try_divide(2 * prec * rec, prec + rec), F.lit(0.0))
    n = F.sum("support")
    return pc.groupBy(*g).agg(
        (F.sum("tp") / n).alias("accuracy"),
        (F.sum(prec * F.col("support")) / n).alias("precision"),
        (F.sum(rec * F.col("support")) / n).alias("recall"),
        (F.sum(f1 * F.col("support")) / n).alias("f1score"),
    )


def binary_quality(df: DataFrame, target: str = "target", prediction: str = "prediction",
                   pos_label: int = 1, group_cols=None) -> DataFrame:
    """Label-based binary quality in one aggregate over the per-class table: accuracy,
    positive-class precision / recall / f1, tpr / tnr / fpr / fnr, and the support-weighted
    precision / recall / f1."""
    g = _groups(group_cols)
    pc = _per_class(confusion_matrix(df, target, prediction, g), g)
    pos = F.col("cls") == F.lit(pos_label)
    n = F.sum("support")
    tp = F.sum(F.when(pos, F.col("tp")).otherwise(0))
    fp = F.sum(F.when(pos, F.col("predicted") - F.col("tp")).otherwise(0))
    fn = F.sum(F.when(pos, F.col("support") - F.col("tp")).otherwise(0))
    tn = n - tp - fp - fn

    def ratio(a, b):
        return F.coalesce(F.try_divide(a.cast("double"), b.cast("double")), F.lit(0.0))

    cprec = ratio(F.col("tp"), F.col("predicted"))
    crec = ratio(F.col("tp"), F.col("support"))
    cf1 = F.coalesce(F.try_divide(2 * cprec * crec, cprec + crec), F.lit(0.0))
    prec, rec = ratio(tp, tp + fp), ratio(tp, tp + fn)
    return pc.groupBy(*g).agg(
        (F.sum("tp") / n).alias("accuracy"),
        prec.alias("precision"),
        rec.alias("recall"),
        F.coalesce(F.try_divide(2 * prec * rec, prec + rec), F.lit(0.0)).alias("f1"),
        ratio(tp, tp + fn).alias("tpr"),
        ratio(tn, tn + fp).alias("tnr"),
        ratio(fp, fp + tn).alias("fpr"),
        ratio(fn, fn + tp).alias("fnr"),
        (F.sum(cprec * F.col("support")) / n).alias("precision_weighted"),
        (F.sum(crec * F.col("support")) / n).alias("recall_weighted"),
        (F.sum(cf1 * F.col("support")) / n).alias("f1_weighted"),
    )


def threshold_predictions(df: DataFrame, proba: str, threshold: float = 0.7, out: str = "prediction") -> DataFrame:
    """Probabilistic classification: label 1 when probability >= threshold."""
    return df.withColumn(out, (F.col(proba) >= F.lit(threshold)).cast("int"))


def roc_auc(df: DataFrame, target: str, score: str, group_cols=None, n_buckets: int | None = None) -> DataFrame:
    """ROC AUC by the rank formula: P(score_pos > score_neg) + 0.5 P(tie), via bucketed running counts. Rows
    without a label or without a score take no part."""
    g = [] if group_cols is None else ([group_cols] if isinstance(group_cols, str) else list(group_cols))
    vc = (
        df.where(present(df, score) & F.col(target).isNotNull())
        .groupBy(*g, score)
        .agg(
            F.sum(F.when(F.col(target) == 1, 1).otherwise(0)).cast("long").alias("pos"),
            F.sum(F.when(F.col(target) == 1, 0).otherwise(1)).cast("long").alias("neg"),
        )
    )
    rows = running_totals(vc, score, ["neg"], g, n_buckets)
    part = rows.groupBy(*g).agg(
        F.sum(F.col("pos") * (F.col("neg_before") + 0.5 * F.col("neg"))).alias("_s"),
        F.sum("pos").alias("_p"),
        F.sum("neg").alias("_n"),
    )
    return part.select(*g, F.try_divide(F.col("_s"), F.col("_p") * F.col("_n")).alias("roc_auc"))


def regression_quality(df: DataFrame, target: str, prediction: str, group_cols=None) -> DataFrame:
    """rmse, mae, r2 in one pass over the rows that have both numbers (r2 = 1 - SSE / SST of those rows)."""
    pair = [F.col(c).cast("double") for c in (target, prediction)]
    df = df.where(~F.isnan(F.coalesce(pair[0], F.lit(float("nan")))) & ~F.isnan(F.coalesce(pair[1], F.lit(float("nan")))))
    e = F.col(prediction).cast("double") - F.col(target).cast("double")
    y = F.col(target).cast("double")
    return df.groupBy(*_groups(group_cols)).agg(
        F.sqrt(F.avg(e * e)).alias("rmse"),
        F.avg(F.abs(e)).alias("mae"),
        (1 - F.try_divide(F.sum(e * e), F.var_pop(y) * F.count(y))).alias("r2"),
        F.avg(e).alias("mean_error"),
    )
