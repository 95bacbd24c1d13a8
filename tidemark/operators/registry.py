"""Metric tables, model-version registry, evaluation rows, run log, metric points.

These are tables, kept and updated with DataFrame jobs: a new version is ``max + 1`` per model,
the default flag is a column recomputed per model, metric rows are long
``(model, version, metric, value)``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

REGISTRY_SCHEMA = "model string, version int, path string, is_default boolean"
POINTS_COLUMNS = ["metric", "project", "model", "task_id", "location", "end_time", "bool_value", "double_value"]


def metric_points(metrics: DataFrame, project: str, location: str, task_id, prefix: str = "custom.metrics",
                  model_col: str = "model_name", time_col: str = "timestamp", id_cols=("model_version",)) -> DataFrame:
    """Metrics rows (one per model and time, one column per metric) to long gauge points.

    The point type is ``prefix/<metric>``; bool metrics stay bool, int and float become double, other
    column types are skipped (with their names returned nowhere: they are simply not metrics).
    """
    skip = {model_col, time_col, *id_cols}
    bool_cols, num_cols = [], []
    for f in metrics.schema.fields:
        if f.name in skip:
            continue
        if isinstance(f.dataType, T.BooleanType):
            bool_cols.append(f.name)
        elif isinstance(f.dataType, T.NumericType):
            num_cols.append(f.name)
    task = F.lit(task_id) if isinstance(task_id, str) else task_id
    base = [F.lit(project).alias("project"), F.col(model_col).cast("string").alias("model"), task.alias("task_id"),
            F.lit(location).alias("location"), F.col(time_col).alias("end_time")]
    parts = []
    if bool_cols:
        b = metrics.select(*base, *bool_cols).unpivot(["project", "model", "task_id", "location", "end_time"],
                                                      bool_cols, "metric", "bool_value")
        parts.append(b.select(F.concat(F.lit(prefix + "/"), "metric").alias("metric"), "project", "model", "task_id",
                              "location", "end_time", "bool_value", F.lit(None).cast("double").alias("double_value")))
    if num_cols:
        n = metrics.select(*base, *[F.col(c).cast("double").alias(c) for c in num_cols]).unpivot(
            ["project", "model", "task_id", "location", "end_time"], num_cols, "metric", "double_value")
        parts.append(n.select(F.concat(F.lit(prefix + "/"), "metric").alias("metric"), "project", "model", "task_id",
                              "location", "end_time", F.lit(None).cast("boolean").alias("bool_value"), "double_value"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def evaluation_rows(metrics: DataFrame, id_cols=("model", "version")) -> DataFrame:
    """Wide metrics per model version to the long evaluation table ``(ids..., metric, value)``."""
    ids = list(id_cols)
    vals = [c for c in metrics.columns if c not in ids]
    wide = metrics.select(*ids, *[F.col(c).cast("double").alias(c) for c in vals])
    return wide.unpivot(ids, vals, "metric", "value")


def register_versions(registry: DataFrame, uploads: DataFrame) -> DataFrame:
    """Append uploads ``(model, path, uploaded_at)`` as new versions: max existing version + rank of
    the upload within its model; a first upload creates version 1. New versions are never default.

    The current maximum travels with the uploads in one union (one row per model), so the numbering
    is a window per model over that model's uploads only; no join is needed.
    """
    current = registry.groupBy("model").agg(F.max("version").alias("_max")).select(
        "model", F.lit(None).cast("string").alias("path"), F.lit(None).cast("timestamp").alias("uploaded_at"),
        "_max", F.lit(False).alias("_new"))
    new = uploads.select("model", "path", F.col("uploaded_at").cast("timestamp").alias("uploaded_at"),
                         F.lit(None).cast("int").alias("_max"), F.lit(True).alias("_new"))
    both = current.unionByName(new)
    base = F.coalesce(F.max("_max").over(Window.partitionBy("model")), F.lit(0))
    numbered = both.withColumn("_base", base).where("_new").select(
        "model", (F.col("_base") + F.row_number().over(Window.partitionBy("model").orderBy("uploaded_at", "path")))
        .cast("int").alias("version"), "path", F.lit(False).alias("is_default"))
    return registry.unionByName(numbered)


def set_default(registry: DataFrame, chosen: DataFrame | None = None) -> DataFrame:
    """Mark one version per model as default: the chosen ``(model, version)`` rows (other models
    keep their flags), or the latest version of every model. The previous default loses the flag. A chosen version absent from the registry raises,
    and so does an empty registry (reads at most one row to check)."""
    if registry.isEmpty():
        raise LookupError("no model versions to label")
    if chosen is None:  # latest version per model: a window over each model's versions, no join
        latest = F.max("version").over(Window.partitionBy("model"))
        return registry.withColumn("is_default", F.coalesce(F.col("version") == latest, F.lit(False)))
    else:
        pick = chosen.select("model", F.col("version").alias("_pick"))
        known = pick.join(registry, (pick["model"] == registry["model"]) & (F.col("_pick") == registry["version"]),
                          "left_anti")
        pick = pick.join(known.select("model", F.lit(True).alias("_unknown")), "model", "left").withColumn(
            "_pick", F.when(F.assert_true(F.col("_unknown").isNull(), F.lit("unknown model version")).isNull(),
                            F.col("_pick"))).drop("_unknown")
    # models without a chosen version keep their flags
    return (
        registry.join(pick, "model", "left")
        .withColumn("is_default", F.when(F.col("_pick").isNull(), F.coalesce(F.col("is_default"), F.lit(False)))
                    .otherwise(F.col("version") == F.col("_pick")))
        .drop("_pick")
    )


def latest_version(registry: DataFrame) -> DataFrame:
    """Newest version per model."""
    return registry.groupBy("model").agg(F.max_by("version", "version").alias("version"))


def default_versions(registry: DataFrame) -> DataFrame:
    """The default (model, version, path) per model; used to load the serving model."""
    return registry.where("is_default").select("model", "version", "path")


def run_log(runs: DataFrame, experiment: str, run_col: str = "run", param_cols=(), metric_cols=(),
            artifact_col: str | None = None) -> DataFrame:
    """Experiment run log in long form ``(experiment, run, kind, key, value)``."""
    parts = []
    if param_cols:
        p = runs.select(F.col(run_col).cast("string").alias("run"), *[F.col(c).cast("string").alias(c) for c in param_cols])
        parts.append(p.unpivot(["run"], list(param_cols), "key", "value").withColumn("kind", F.lit("param")))
    if metric_cols:
        m = runs.select(F.col(run_col).cast("string").alias("run"), *[F.col(c).cast("string").alias(c) for c in metric_cols])
        parts.append(m.unpivot(["run"], list(metric_cols), "key", "value").withColumn("kind", F.lit("metric")))
    if artifact_col:
        parts.append(runs.select(F.col(run_col).cast("string").alias("run"), F.lit("model").alias("key"),
                                 F.col(artifact_col).cast("string").alias("value"), F.lit("artifact").alias("kind")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.select(F.lit(experiment).alias("experiment"), "run", "kind", "key", "value")


def empty_registry(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], REGISTRY_SCHEMA)
