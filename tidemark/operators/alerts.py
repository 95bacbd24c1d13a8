"""Threshold rules, alert flags, champion/challenger comparison, policy reconciliation, alert windows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# Comparison operator names (as in Python's ``operator`` module) and the shipped rule.
OPERATORS = ("lt", "le", "eq", "ne", "ge", "gt")
DEFAULT_PERFORMANCE_RULES = [("accuracy", "lt", 0.7)]
CLASSIFICATION_CHALLENGE_RULES = [("f1Score", "ge"), ("precision", "ge")]
REGRESSION_CHALLENGE_RULES = [("meanAbsoluteError", "le"), ("rSquared", "le")]

RULES_SCHEMA = "metric_name string, op string, threshold_value double"


def rules_frame(spark: SparkSession, rules=None) -> DataFrame:
    return spark.createDataFrame(list(rules or DEFAULT_PERFORMANCE_RULES), RULES_SCHEMA)


def compare(left: Column, op: Column | str, right: Column) -> Column:
    """``left <op> right`` with the operator given by name (a column or a literal name)."""
    o = F.lit(op) if isinstance(op, str) else op
    return (
        F.when(o == "lt", left < right)
        .when(o == "le", left <= right)
        .when(o == "eq", left == right)
        .when(o == "ne", left != right)
        .when(o == "ge", left >= right)
        .when(o == "gt", left > right)
        .otherwise(F.raise_error(F.concat(F.lit("unknown operator "), o)))
    )


def metrics_long(metrics_row: DataFrame, id_cols=()) -> DataFrame:
    """One-row-per-entity metrics frame to ``(ids..., metric, value double)``."""
    ids = list(id_cols)
    vals = [c for c in metrics_row.columns if c not in ids]
    wide = metrics_row.select(*ids, *[F.col(c).cast("double").alias(c) for c in vals])
    return wide.unpivot(ids, vals, "metric", "value")


def evaluate_rules(metrics_row: DataFrame, rules: DataFrame, id_cols=()) -> DataFrame:
    """Per rule: the metric value and whether the rule fires. A rule naming an absent metric raises.

    The rules table is literal and tiny; it is broadcast to the metric rows.
    """
    ids = list(id_cols)
    long = metrics_long(metrics_row, ids)
    j = long.join(F.broadcast(rules), long["metric"] == rules["metric_name"], "right")
    present = F.assert_true(F.col("metric").isNotNull(), F.concat(F.lit("missing metric "), F.col("metric_name")))
    return j.select(
        *ids, "metric_name", "op", "threshold_value",
        F.when(present.isNull(), F.col("value")).alias("value"),
        F.coalesce(compare(F.col("value"), F.col("op"), F.col("threshold_value")), F.lit(False)).alias("fired"),
    )


def with_alert_flag(metrics: DataFrame, rules=None, flag: str = "performance_alert") -> DataFrame:
    """Add ``flag`` = any rule fires, as one column expression per row of metrics.

    ``rules`` are literal ``(metric_name, op, threshold)`` tuples, as in the original job; a rule
    naming a metric absent from the frame raises ``KeyError`` before anything runs. A null metric
    never fires.
    """
    expr = F.lit(False)
    for name, op, threshold in (rules or DEFAULT_PERFORMANCE_RULES):
        if name not in metrics.columns:
            raise KeyError(name)
        expr = expr | F.coalesce(compare(F.col(name).cast("double"), op, F.lit(float(threshold))), F.lit(False))
    return metrics.withColumn(flag, expr)


def champion_challenger(evaluations: DataFrame, rules: DataFrame, model_col: str = "model",
                        version_col: str = "version", default_col: str = "is_default") -> DataFrame:
    """Compare each challenger version's metrics with its model's default (champion) version.

    ``evaluations`` is long: ``(model, version, is_default, metric, value)``. ``rules`` holds
    ``(metric_name, op)``. A challenger improves if ANY rule passes: ``challenger <op> champion``.
    A model without a default version raises.
    """
    champ = (
        evaluations.where(F.col(default_col))
        .select(F.col(model_col).alias("_m"), F.col("metric").alias("_metric"), F.col("value").alias("champion_value"))
    )
    chal = evaluations.where(~F.col(default_col))
    r = F.broadcast(rules.select(F.col("metric_name"), F.col("op")))
    j = (
        chal.join(r, chal["metric"] == r["metric_name"], "inner")
        .join(champ, (F.col(model_col) == F.col("_m")) & (F.col("metric") == F.col("_metric")), "left")
    )
    checked = F.assert_true(F.col("_m").isNotNull(), F.concat(F.lit("no champion evaluation for "), F.col(model_col)))
    return (
        j.withColumn("_ok", checked)
        .groupBy(model_col, version_col)
        .agg(F.bool_or(F.coalesce(compare(F.col("value"), F.col("op"), F.col("champion_value")), F.lit(False))).alias("improved"))
    )


def reconcile(desired: DataFrame, existing: DataFrame, key: str = "intent") -> DataFrame:
    """Full outer reconcile by key: create (only desired), update (both), delete (only existing).

    Existing rows without the key are ignored.
    """
    d = desired.select(F.col(key).alias("_dk"), *[F.col(c).alias(f"desired_{c}") for c in desired.columns if c != key])
    e = existing.where(F.col(key).isNotNull()).select(
        F.col(key).alias("_ek"), *[F.col(c).alias(f"existing_{c}") for c in existing.columns if c != key]
    )
    j = d.join(e, F.col("_dk") == F.col("_ek"), "full_outer")
    return j.select(
        F.coalesce("_dk", "_ek").alias(key),
        F.when(F.col("_ek").isNull(), "create").when(F.col("_dk").isNull(), "delete").otherwise("update").alias("action"),
        *[c for c in j.columns if c.startswith("desired_") or c.startswith("existing_")],
    )


def alert_periods(points: DataFrame, ts: str = "end_time", value: str = "bool_value",
                  series_cols=("model", "metric"), period: str = "60 seconds") -> DataFrame:
    """Per series and aligned period, the count of TRUE points; the period fires when the count > 0."""
    return (
        points.groupBy(*series_cols, F.window(ts, period).alias("period"))
        .agg(F.count_if(F.col(value)).alias("true_points"))
        .select(*series_cols, F.col("period.start").alias("period_start"), F.col("period.end").alias("period_end"),
                "true_points", (F.col("true_points") > 0).alias("fires"))
    )


def incidents(fired_periods: DataFrame, series_cols=("model", "metric"), auto_close: str = "7 days",
              chunk: str = "30 days") -> DataFrame:
    """Group firing periods into incidents that close after ``auto_close`` without a firing period.

    Series are cut into chunks of time (longer than ``auto_close``), and gaps are found by ``lag`` inside them, so a
    series of any length is spread over tasks. Each chunk's runs are reduced to their ends; the first and the last run of
    a chunk may go on in a neighbouring one, and only these are compared across chunks: at most two rows
    a chunk, in a window per series.
    """
    keys = list(series_cols)
    micros = lambda c: F.unix_micros(F.col(c).cast("timestamp"))
    span = lambda text: F.expr(f"unix_micros(timestamp'1970-01-01 00:00:00 UTC' + interval {text})")
    close, width = span(auto_close), F.greatest(span(chunk), span(auto_close))
    f = fired_periods.where("fires").select(*keys, "period_start", "period_end", micros("period_start").alias("_at"))
    f = f.withColumn("_chunk", F.floor(F.col("_at") / width))
    inside = Window.partitionBy(*keys, "_chunk").orderBy("_at")
    begins = F.coalesce(F.col("_at") - F.lag("_at").over(inside) >= close, F.lit(True))
    f = f.withColumn("_begins", begins.cast("long"))
    f = f.withColumn("_run", F.sum("_begins").over(inside.rowsBetween(Window.unboundedPreceding, 0)))
    runs = f.groupBy(*keys, "_chunk", "_run").agg(
        F.count(F.lit(1)).alias("firing_periods"), F.min("period_start").alias("opened_at"), F.max("period_end").alias("last_firing_end"),
        F.min("_at").alias("_first"), F.max("_at").alias("_last"), F.max("period_start").alias("_last_start"))
    # only the runs at a chunk's two ends can join others
    ends = Window.partitionBy(*keys, "_chunk")
    runs = runs.withColumn("_edge", (F.col("_run") == 1) | (F.col("_run") == F.max("_run").over(ends)))
    across = Window.partitionBy(*keys).orderBy("_first")
    edge = runs.where("_edge").withColumn("_new", F.coalesce(
        F.col("_first") - F.lag("_last").over(across) >= close, F.lit(True)).cast("long"))
    edge = edge.withColumn("_incident", F.sum("_new").over(across.rowsBetween(Window.unboundedPreceding, 0)))
    joined = edge.groupBy(*keys, "_incident").agg(
        F.sum("firing_periods").alias("firing_periods"), F.min("opened_at").alias("opened_at"),
        F.max("last_firing_end").alias("last_firing_end"), F.max("_last_start").alias("_last_start")).drop("_incident")
    whole = joined.unionByName(runs.where(~F.col("_edge")).select(*joined.columns))
    return whole.select(*keys, "opened_at", "last_firing_end", F.col("firing_periods").cast("long").alias("firing_periods"),
                        (F.col("_last_start") + F.expr(f"interval {auto_close}")).alias("closes_at"))
