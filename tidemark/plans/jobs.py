"""End-to-end jobs composed from the operators: performance monitoring, training, inference.

Each job is one Spark application step; data moves between steps as tables, and nothing but the
final one-row results reaches the driver.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import alerts, drift, history, model, profile, quality, registry, sample
from ..session import pin
from ..sources import catalog, commits


# The monitoring tables of the inference job.
FEATURE_DRIFT_TABLE, PREDICTION_DRIFT_TABLE = "monitor_feature_drift", "monitor_prediction_drift"
METRIC_POINTS_TABLE = "metric_points"
COMMITS_TABLE = "job_commits"


def performance_monitoring(history_df: DataFrame, truth: DataFrame, as_of: str, model_name: str,
                           model_version=None, lookback_days: int = 1200, rules=None,
                           tiebreak: str | None = None, metrics_table: str | None = None,
                           points_table: str | None = None, project: str = "project",
                           location: str = "location", task_id: str = "task", commits_table: str | None = None) -> DataFrame | None:
    """Resolve the version (highest when none is given), read the newest prediction per series and
    day, join the truth, compute quality and the alert flag. Returns the metrics row, or ``None``
    when there is no history or nothing joins (the original early exits). With table names given,
    the row is appended to the metrics table (new metric columns are added) and its long gauge
    points to the points table; with ``commits_table`` as one commit, so that a rerun replaces its own rows."""
    if model_version is None:  # a literal, so that the read below prunes partitions
        model_version = history_df.agg(F.max("model_version")).first()[0]
        if model_version is None:
            return None
    h = history_df.where(F.col("model_version") == F.lit(int(model_version)))
    joined = quality.join_truth(truth, history.latest_per_series(h, as_of, lookback_days, None, tiebreak))
    m = alerts.with_alert_flag(quality.binary_quality(joined), rules or alerts.DEFAULT_PERFORMANCE_RULES)
    row = m.select(F.lit(model_name).alias("model_name"), F.lit(str(model_version)).alias("model_version"),
                   F.lit(as_of).cast("timestamp_ntz").alias("timestamp"), *m.columns)
    # one pass: the row itself says whether anything joined
    row = pin(row, "metrics")
    if row.where(F.col("accuracy").isNotNull()).isEmpty():
        return None
    _write_row(row, f"performance/{model_name}/{model_version}", as_of, metrics_table, points_table, commits_table,
               registry.metric_points(row, project, location, task_id))
    return row


def _write_row(row: DataFrame, job: str, as_of: str, metrics_table: str | None, points_table: str | None,
               commits_table: str | None, points: DataFrame) -> None:
    """A monitoring row and its gauge points, appended or (with ``commits_table``) committed."""
    if commits_table:
        outputs = {name: df for name, df in ((metrics_table, row), (points_table, points)) if name}
        commits.run_commit(row.sparkSession, commits_table, commits.commit_name(job, as_of), outputs)
        return
    if metrics_table:
        catalog.write_metrics(row, metrics_table)
    if points_table:
        catalog.append_table(points, points_table)


def drift_monitoring(report: DataFrame, features, model_name: str, model_version, as_of: str, prefix: str,
                     metrics_table: str | None = None, points_table: str | None = None, project: str = "project",
                     location: str = "location", task_id: str = "task", commits_table: str | None = None) -> DataFrame:
    """The monitoring row of a drift report (dataset drift and one pair of columns per feature). With table names it is
    appended to the metrics table, and its gauge points, named ``prefix/<key>``, to the points table; with
    ``commits_table`` as one commit."""
    m = drift.drift_metrics(report, features)
    row = m.select(F.lit(model_name).alias("model_name"), F.lit(str(model_version)).alias("model_version"),
                   F.lit(as_of).cast("timestamp_ntz").alias("timestamp"), *m.columns)
    if metrics_table or points_table:
        row = pin(row, "drift-row")
        _write_row(row, f"{prefix}/{model_name}/{model_version}", as_of, metrics_table, points_table, commits_table,
                   registry.metric_points(row, project, location, task_id, prefix))
    return row


def training(spark: SparkSession, source: DataFrame, label: str, key: str, features, database: str,
             model_root: str, model_name: str, as_of: dt.datetime, registry_table: str,
             evaluations_table: str) -> dict:
    """Build the tagged training table, train on TRAIN, evaluate on TEST, register the version,
    attach evaluations, compare with the champion, rename the snapshot to carry the version."""
    catalog.create_namespace(spark, database)
    tagged = sample.exact_split(profile.require_rows(source, "training data"), key, 0.2, 42)
    snapshot = catalog.unique_table_name(f"{database}.training_data_", as_of)
    catalog.append_table(tagged, snapshot)
    stored = spark.table(snapshot)
    train = stored.where("split = 'TRAIN'").drop("split")
    test = stored.where("split = 'TEST'").drop("split")
    fitted = model.train_classifier(train, label, features)
    report = quality.weighted_report(model.score(fitted, test).withColumn("prediction", F.col("prediction").cast("int")),
                                     label)
    metrics = report.first().asDict()  # one row; read before the snapshot is renamed
    if spark.catalog.tableExists(registry_table):
        reg = spark.table(registry_table)
    else:
        reg = registry.empty_registry(spark)
    next_version = (reg.where(F.col("model") == model_name).agg(F.max("version")).first()[0] or 0) + 1
    path = f"{model_root}/{model_name}/v{next_version}"
    model.save_model(fitted, path)
    upload = spark.createDataFrame([(model_name, path, as_of)], "model string, path string, uploaded_at timestamp")
    new_reg = registry.register_versions(reg, upload)
    if reg.where(F.col("model") == model_name).isEmpty():
        new_reg = registry.set_default(new_reg)  # the first version of a model becomes its default
    new_reg = new_reg.checkpoint(eager=True)  # the table is overwritten below: cut the lineage to it first
    new_reg.write.mode("overwrite").format("parquet").saveAsTable(registry_table)
    evals = registry.evaluation_rows(
        spark.createDataFrame([(model_name, next_version, metrics["f1score"], metrics["precision"], metrics["recall"],
                                metrics["accuracy"])],
                              "model string, version int, f1Score double, precision double, recall double, "
                              "accuracy double"), ["model", "version"])
    catalog.append_table(evals, evaluations_table)
    ev = spark.table(evaluations_table).join(spark.table(registry_table).select("model", "version", "is_default"),
                                             ["model", "version"], "inner")
    rules = spark.createDataFrame(alerts.CLASSIFICATION_CHALLENGE_RULES, "metric_name string, op string")
    improved = alerts.champion_challenger(ev.where(F.col("model") == model_name), rules) \
        .where(F.col("version") == next_version).select("improved").first()
    final_name = f"{database}.training_data_history_model_version_{next_version}"
    catalog.rename_table(spark, snapshot, final_name)
    return {"version": next_version, "path": path, "metrics": metrics,
            "improved": None if improved is None else improved["improved"], "training_table": final_name}


def inference(spark: SparkSession, batch: DataFrame, key: str, features, registry_table: str, model_name: str,
              history_table: str, training_table: str, as_of: dt.datetime, database: str,
              expire_days: int = 30) -> dict:
    """Store the batch (with expiry), score the stored rows with the default model, store the predictions (with expiry),
    compute prediction drift against the history and feature drift against the training data, then append to the history.
    Everything is named after ``as_of``: a rerun replaces what it wrote, also after a run that broke on the way."""
    reg = spark.table(registry_table)
    fitted, version = model.load_default_model(reg, model_name)
    stored = catalog.unique_table_name(f"{database}.inference_data_", as_of)
    catalog.replace_table(batch, stored)
    catalog.set_expiry(spark, stored, as_of, expire_days)
    batch = spark.table(stored)
    scored = model.batch_predictions(fitted, batch, key, as_of.date().isoformat(), version)
    snap = catalog.unique_table_name(f"{database}.predictions_", as_of)
    catalog.replace_table(scored, snap)
    catalog.set_expiry(spark, snap, as_of, expire_days)
    preds = spark.table(snap)
    hist = history.read_history(spark, history_table)
    out = {"inference_table": stored, "predictions_table": snap, "version": version}
    at = as_of.strftime("%Y-%m-%d %H:%M:%S")
    if "inserted_at" in hist.columns:  # a rerun isn't compared with its own rows
        hist = hist.where(F.col("inserted_at") != F.lit(at).cast("timestamp"))
    done = f"{database}.{COMMITS_TABLE}"
    points = f"{database}.{METRIC_POINTS_TABLE}"
    if "model_version" in hist.columns:
        ref = history.latest_per_series(hist, at, 730, version, tiebreak="prediction")
        if not ref.isEmpty():  # the first batch of a version has nothing to compare with
            cur = preds.select(F.col("prediction_value").alias("prediction"))
            pd_rep = pin(drift.drift_report(ref.select("prediction"), cur, categorical=["prediction"]), "drift")
            drift_monitoring(pd_rep, ["prediction"], model_name, version, at, "prediction_drift",
                             f"{database}.{PREDICTION_DRIFT_TABLE}", points, commits_table=done)
            out["prediction_drift"] = [r.asDict() for r in pd_rep.collect()]  # one row
    train = spark.table(training_table)
    fd = pin(drift.drift_report(train, batch, numerical=list(features)), "drift")
    drift_monitoring(fd, list(features), model_name, version, at, "feature_drift", f"{database}.{FEATURE_DRIFT_TABLE}", points,
                     commits_table=done)
    out["feature_drift"] = drift.dataset_drift(fd).first().asDict()
    rows = history.to_history_rows(preds, "series_id", F.to_timestamp("prediction_timestamp"), "prediction_value",
                                   "model_version", F.lit(at).cast("timestamp"))
    history.append_history(rows, history_table, once=True)
    return out
