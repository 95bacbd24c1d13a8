"""Registered queries: prediction history, quality, alerts (inventory D1, D2, C1, C4, J3-J6, J10)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import alerts, history, quality
from . import domain
from .queries import (SQL_BQ_COLUMNS, SQL_HISTORY, SQL_LABELLED, SQL_LATEST, SQL_TRUTH, register, rounded,
                      sql_binary_quality)


def _latest(spark, sf_dir):
    return history.latest_per_series(
        domain.inference_history(spark, sf_dir), as_of=domain.AS_OF,
        lookback_days=domain.LOOKBACK_PREDICTION_DRIFT_DAYS, model_version=domain.MODEL_VERSION,
        tiebreak="insert_seq",
    )


@register("latest_prediction_quality", f"""
WITH {SQL_LATEST}, {SQL_TRUTH},
j AS (SELECT t.target, l.prediction FROM truth t JOIN latest l ON t.series_id = l.series_id),
{sql_binary_quality('j')}
SELECT {SQL_BQ_COLUMNS}, accuracy < 0.7 AS performance_alert FROM bqf
""")
def latest_prediction_quality(spark, sf_dir):
    """Flagship: newest prediction per series and day (D1), joined to truth (C1), classification
    quality (J3), threshold alert (J10)."""
    joined = quality.join_truth(domain.ground_truth(spark, sf_dir), _latest(spark, sf_dir))
    metrics = quality.binary_quality(joined)
    return rounded(alerts.with_alert_flag(metrics, alerts.DEFAULT_PERFORMANCE_RULES, "performance_alert"))


@register("latest_inference_history", f"""
WITH {SQL_LATEST}
SELECT series_id, prediction, "timestamp" FROM latest
""")
def latest_inference_history(spark, sf_dir):
    """D1 alone: latest prediction per (series, day), version 2, 730-day look-back."""
    return _latest(spark, sf_dir)


@register("newest_insert_batch", f"""
WITH {SQL_HISTORY}
SELECT series_id, "timestamp", prediction, model_version, insert_seq FROM hist
WHERE inserted_at = (SELECT max(inserted_at) FROM hist)
""")
def newest_insert_batch(spark, sf_dir):
    """C4: rows of the newest insert batch (scalar subquery), all columns but ``inserted_at``."""
    return history.newest_batch(domain.inference_history(spark, sf_dir))


@register("default_model_version", f"""
WITH {SQL_HISTORY}
SELECT CAST(max(model_version) AS VARCHAR) AS model_version FROM hist
""")
def default_model_version(spark, sf_dir):
    """Highest model version as text."""
    return history.default_model_version(domain.inference_history(spark, sf_dir))


@register("truth_prediction_join", f"""
WITH {SQL_LATEST}, {SQL_TRUTH}
SELECT t.series_id, t.target, l.prediction, l."timestamp" FROM truth t JOIN latest l ON t.series_id = l.series_id
""")
def truth_prediction_join(spark, sf_dir):
    """Inner join of truth and latest predictions on series id (fans out over dates)."""
    return quality.join_truth(domain.ground_truth(spark, sf_dir), _latest(spark, sf_dir)).select(
        "series_id", "target", "prediction", "timestamp")


@register("confusion_matrix_documents", f"""
WITH {SQL_LABELLED}
SELECT target, prediction, count(*) AS n FROM labelled GROUP BY 1, 2
""")
def confusion_matrix_documents(spark, sf_dir):
    """J3 building block: confusion matrix of the labelled documents."""
    return quality.confusion_matrix(domain.labelled_documents(spark, sf_dir))


@register("weighted_report_documents", f"""
WITH {SQL_LABELLED}, {sql_binary_quality('labelled')}
SELECT round(accuracy, 6) AS accuracy, round(precision_weighted, 6) AS precision,
       round(recall_weighted, 6) AS recall, round(f1_weighted, 6) AS f1score FROM bqf
""")
def weighted_report_documents(spark, sf_dir):
    """Accuracy and support-weighted precision / recall / f1 of the labelled documents."""
    return rounded(quality.weighted_report(domain.labelled_documents(spark, sf_dir)))


@register("classification_quality_documents", f"""
WITH {SQL_LABELLED}, {sql_binary_quality('labelled')}
SELECT {SQL_BQ_COLUMNS}, accuracy < 0.7 AS performance_alert FROM bqf
""")
def classification_quality_documents(spark, sf_dir):
    """J3 + J10 on the labelled documents."""
    m = quality.binary_quality(domain.labelled_documents(spark, sf_dir))
    return rounded(alerts.with_alert_flag(m, alerts.DEFAULT_PERFORMANCE_RULES))


@register("probabilistic_quality_documents", f"""
WITH {SQL_LABELLED},
th AS (SELECT target, CAST(proba >= 0.7 AS INTEGER) AS prediction FROM labelled),
{sql_binary_quality('th')}
SELECT {SQL_BQ_COLUMNS} FROM bqf
""")
def probabilistic_quality_documents(spark, sf_dir):
    """Probability threshold 0.7, then the label metrics."""
    lab = domain.labelled_documents(spark, sf_dir)
    return rounded(quality.binary_quality(quality.threshold_predictions(lab, "proba", 0.7)))


@register("roc_auc_documents", f"""
WITH {SQL_LABELLED},
vc AS (SELECT proba, sum(CASE WHEN target = 1 THEN 1 ELSE 0 END) AS pos,
              sum(CASE WHEN target = 1 THEN 0 ELSE 1 END) AS neg FROM labelled GROUP BY proba),
cum AS (SELECT pos, neg, coalesce(sum(neg) OVER (ORDER BY proba ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
               AS neg_before FROM vc)
SELECT round(sum(pos * (neg_before + 0.5 * neg)) / (sum(pos) * sum(neg)), 6) AS roc_auc FROM cum
""")
def roc_auc_documents(spark, sf_dir):
    """ROC AUC of the probability by the rank formula (bucketed running counts, no global window)."""
    return rounded(quality.roc_auc(domain.labelled_documents(spark, sf_dir), "target", "proba"))


@register("regression_quality_orders", """
WITH rev AS (
  SELECT l_orderkey, sum(l_extendedprice * (1 - l_discount) * (1 + l_tax)) AS predicted
  FROM lineitem GROUP BY l_orderkey),
j AS (SELECT o.o_totalprice AS target, r.predicted AS prediction FROM orders o JOIN rev r ON o.o_orderkey = r.l_orderkey)
SELECT round(sqrt(avg((prediction - target) * (prediction - target))), 6) AS rmse,
       round(avg(abs(prediction - target)), 6) AS mae,
       round(1 - sum((prediction - target) * (prediction - target)) / (var_pop(target) * count(target)), 6) AS r2,
       round(avg(prediction - target), 6) AS mean_error
FROM j
""")
def regression_quality_orders(spark, sf_dir):
    """Regression quality of a line-item revenue estimate against the order total."""
    from ..sources.testdata import table

    li = table(spark, sf_dir, "lineitem")
    est = li.groupBy("l_orderkey").agg(
        F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount")) * (1 + F.col("l_tax"))).alias("prediction"))
    o = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("l_orderkey"), F.col("o_totalprice").alias("target"))
    return rounded(quality.regression_quality(o.join(est, "l_orderkey", "inner"), "target", "prediction"))
