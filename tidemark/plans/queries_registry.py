"""Registered queries: metric tables, registry, champion / challenger, alert windows, run log
(inventory A13, C5-C7, E3, J10-J13, K6-K8)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import alerts, quality, registry
from . import domain
from .domain import SQL_SCORED, sql_grouped_quality
from .queries import register, rounded

EVAL_METRICS = {"precision_weighted": "precision", "recall_weighted": "recall", "f1_weighted": "f1Score"}


def _quality_by_version(spark, sf_dir):
    s = domain.scored_history(spark, sf_dir)
    return quality.binary_quality(s, group_cols="model_version")


@register("quality_by_model_version", f"""
WITH {SQL_SCORED}, {sql_grouped_quality('scored', 'model_version')}
SELECT model_version, round(accuracy, 6) AS accuracy, round(precision_weighted, 6) AS precision_weighted,
       round(recall_weighted, 6) AS recall_weighted, round(f1_weighted, 6) AS f1_weighted,
       round(CASE WHEN pred1 = 0 THEN 0.0 ELSE tp1 / pred1 END, 6) AS precision,
       round(CASE WHEN sup1 = 0 THEN 0.0 ELSE tp1 / sup1 END, 6) AS recall,
       accuracy < 0.7 AS performance_alert
FROM gq
""")
def quality_by_model_version(spark, sf_dir):
    """J3 + J10 per model version over every scored history row."""
    q = _quality_by_version(spark, sf_dir)
    q = alerts.with_alert_flag(q, alerts.DEFAULT_PERFORMANCE_RULES)
    return rounded(q.select("model_version", "accuracy", "precision_weighted", "recall_weighted", "f1_weighted",
                            "precision", "recall", "performance_alert"))


def _evaluations(spark, sf_dir):
    q = _quality_by_version(spark, sf_dir).select(
        F.lit("classifier").alias("model"), (F.col("model_version") + 1).cast("int").alias("version"),
        *[F.col(k).alias(v) for k, v in EVAL_METRICS.items()])
    return registry.evaluation_rows(q, ["model", "version"])


SQL_EVALS = f"""
{SQL_SCORED}, {sql_grouped_quality('scored', 'model_version')},
evals AS (
  SELECT 'classifier' AS model, CAST(model_version + 1 AS INTEGER) AS version, metric, value FROM (
    UNPIVOT (SELECT model_version, precision_weighted AS precision, recall_weighted AS recall, f1_weighted AS "f1Score"
             FROM gq) ON precision, recall, "f1Score" INTO NAME metric VALUE value))"""


@register("evaluation_rows_by_version", f"""
WITH {SQL_EVALS}
SELECT model, version, metric, round(value, 6) AS value FROM evals
""")
def evaluation_rows_by_version(spark, sf_dir):
    """Evaluation rows attached to model versions, long form."""
    return rounded(_evaluations(spark, sf_dir))


def _registry(spark, sf_dir):
    h = domain.inference_history(spark, sf_dir)
    uploads = h.groupBy("model_version").agg(F.min("inserted_at").alias("uploaded_at")).select(
        F.lit("classifier").alias("model"), F.concat(F.lit("models/classifier/build-"), F.col("model_version")).alias("path"),
        "uploaded_at")
    return registry.register_versions(registry.empty_registry(spark), uploads)


SQL_REGISTRY = """
uploads AS (SELECT 'classifier' AS model, 'models/classifier/build-' || CAST(event_id % 3 AS VARCHAR) AS path, min(ts) AS uploaded_at
            FROM events GROUP BY event_id % 3),
reg AS (SELECT model, CAST(row_number() OVER (PARTITION BY model ORDER BY uploaded_at, path) AS INTEGER) AS version,
               path, false AS is_default FROM uploads)"""


@register("model_registry_versions", f"""
WITH {SQL_REGISTRY} SELECT * FROM reg
""")
def model_registry_versions(spark, sf_dir):
    """K6: each upload becomes version max + 1 of its model, never default on upload."""
    return _registry(spark, sf_dir)


@register("model_registry_default", f"""
WITH {SQL_REGISTRY}
SELECT model, version, path, version = (SELECT max(version) FROM reg r2 WHERE r2.model = reg.model) AS is_default FROM reg
""")
def model_registry_default(spark, sf_dir):
    """K7 + E3: the latest version becomes the default; the old default loses it."""
    return registry.set_default(_registry(spark, sf_dir))


@register("model_registry_chosen_default", f"""
WITH {SQL_REGISTRY}
SELECT model, version, path, version = 2 AS is_default FROM reg
""")
def model_registry_chosen_default(spark, sf_dir):
    """K7 with a chosen version."""
    reg = _registry(spark, sf_dir)
    chosen = reg.where(F.col("version") == 2).select("model", "version")
    return registry.set_default(reg, chosen)


@register("champion_challenger_versions", f"""
WITH {SQL_EVALS}, {SQL_REGISTRY},
dflt AS (SELECT model, version, version = (SELECT max(version) FROM reg r2 WHERE r2.model = reg.model) AS is_default FROM reg),
ev AS (SELECT e.*, d.is_default FROM evals e JOIN dflt d ON e.model = d.model AND e.version = d.version),
rules AS (SELECT * FROM (VALUES ('f1Score', 'ge'), ('precision', 'ge')) t(metric_name, op)),
champ AS (SELECT model, metric, value AS cv FROM ev WHERE is_default)
SELECT c.model, c.version,
       bool_or(CASE WHEN r.op = 'ge' THEN c.value >= ch.cv WHEN r.op = 'le' THEN c.value <= ch.cv END) AS improved
FROM ev c JOIN rules r ON c.metric = r.metric_name JOIN champ ch ON c.model = ch.model AND c.metric = ch.metric
WHERE NOT c.is_default GROUP BY 1, 2
""")
def champion_challenger_versions(spark, sf_dir):
    """J11 + C5 + C6: each challenger against its model's default; improved if any rule passes."""
    reg = registry.set_default(_registry(spark, sf_dir)).select("model", "version", "is_default")
    ev = _evaluations(spark, sf_dir).join(reg, ["model", "version"], "inner")
    rules = spark.createDataFrame(alerts.CLASSIFICATION_CHALLENGE_RULES, "metric_name string, op string")
    return alerts.champion_challenger(ev, rules)


def _daily_metrics(spark, sf_dir):
    s = domain.scored_history(spark, sf_dir)
    q = quality.binary_quality(s, group_cols=["model_version", "timestamp"])
    q = alerts.with_alert_flag(q.select("model_version", "timestamp", "accuracy"), alerts.DEFAULT_PERFORMANCE_RULES)
    return q.select(F.lit("classifier").alias("model_name"), "model_version",
                    (F.col("timestamp") + F.expr("INTERVAL 9 HOURS")).alias("timestamp"), "accuracy",
                    "performance_alert")


SQL_DAILY = f"""
{SQL_SCORED}, {sql_grouped_quality('scored', 'model_version, "timestamp"')},
daily AS (SELECT 'classifier' AS model_name, model_version, "timestamp" + INTERVAL 9 HOUR AS "timestamp", accuracy,
                 accuracy < 0.7 AS performance_alert FROM gq)"""


@register("metric_points_by_day", f"""
WITH {SQL_DAILY}
SELECT 'custom.metrics/accuracy' AS metric, 'demo-project' AS project, model_name AS model,
       'v' || CAST(model_version AS VARCHAR) AS task_id, 'region-1' AS location, "timestamp" AS end_time,
       CAST(NULL AS BOOLEAN) AS bool_value, round(accuracy, 6) AS double_value FROM daily
UNION ALL
SELECT 'custom.metrics/performance_alert', 'demo-project', model_name, 'v' || CAST(model_version AS VARCHAR),
       'region-1', "timestamp", performance_alert, CAST(NULL AS DOUBLE) FROM daily
""")
def metric_points_by_day(spark, sf_dir):
    """Daily metrics rows to long gauge points (bool stays bool, numbers become double)."""
    d = _daily_metrics(spark, sf_dir)
    pts = registry.metric_points(d, "demo-project", "region-1",
                                 F.concat(F.lit("v"), F.col("model_version").cast("string")))
    return rounded(pts)


@register("alert_periods_by_day", f"""
WITH {SQL_DAILY},
pts AS (SELECT model_name AS model, 'performance_alert' AS metric, "timestamp" AS end_time, performance_alert AS v
        FROM daily)
SELECT model, metric, time_bucket(INTERVAL 60 SECOND, end_time) AS period_start,
       time_bucket(INTERVAL 60 SECOND, end_time) + INTERVAL 60 SECOND AS period_end,
       count(*) FILTER (WHERE v) AS true_points, count(*) FILTER (WHERE v) > 0 AS fires
FROM pts GROUP BY 1, 2, 3
""")
def alert_periods_by_day(spark, sf_dir):
    """J12 batch twin: TRUE points per 60-second aligned period; a period with any fires."""
    d = _daily_metrics(spark, sf_dir).select(F.col("model_name").alias("model"), F.lit("performance_alert").alias("metric"),
                                             F.col("timestamp").alias("end_time"), F.col("performance_alert").alias("v"))
    return alerts.alert_periods(d, "end_time", "v", ["model", "metric"], "60 seconds")


@register("alert_incidents_by_day")
def alert_incidents_by_day(spark, sf_dir):
    """Firing periods grouped into incidents that close after 7 days without firing."""
    d = _daily_metrics(spark, sf_dir).select(F.col("model_name").alias("model"), F.lit("performance_alert").alias("metric"),
                                             F.col("timestamp").alias("end_time"), F.col("performance_alert").alias("v"))
    return alerts.incidents(alerts.alert_periods(d, "end_time", "v", ["model", "metric"]), ["model", "metric"])


@register("rules_evaluation_by_version", f"""
WITH {SQL_SCORED}, {sql_grouped_quality('scored', 'model_version')},
m AS (SELECT model_version, accuracy, f1_weighted FROM gq),
long AS (UNPIVOT m ON accuracy, f1_weighted INTO NAME metric VALUE value),
rules AS (SELECT * FROM (VALUES ('accuracy', 'lt', 0.7), ('f1_weighted', 'lt', 0.55)) t(metric_name, op, threshold_value))
SELECT model_version, metric_name, op, CAST(threshold_value AS DOUBLE) AS threshold_value, round(value, 6) AS value,
       coalesce(CASE op WHEN 'lt' THEN value < threshold_value END, false) AS fired
FROM long JOIN rules ON long.metric = rules.metric_name
""")
def rules_evaluation_by_version(spark, sf_dir):
    """C6 with a rules table: every rule against every version's metric."""
    q = _quality_by_version(spark, sf_dir).select("model_version", "accuracy", "f1_weighted")
    rules = alerts.rules_frame(spark, [("accuracy", "lt", 0.7), ("f1_weighted", "lt", 0.55)])
    return rounded(alerts.evaluate_rules(q, rules, ["model_version"]))


@register("policy_reconcile", """
WITH d AS (SELECT DISTINCT 'alert/' || event_type AS intent, event_type AS metric FROM events WHERE ts >= TIMESTAMP '2024-01-16'),
e AS (SELECT DISTINCT 'alert/' || event_type AS intent, 'existing' AS state FROM events
      WHERE ts < TIMESTAMP '2024-01-16' AND event_type <> 'signup')
SELECT coalesce(d.intent, e.intent) AS intent,
       CASE WHEN e.intent IS NULL THEN 'create' WHEN d.intent IS NULL THEN 'delete' ELSE 'update' END AS action,
       d.metric AS desired_metric, e.state AS existing_state
FROM d FULL OUTER JOIN e ON d.intent = e.intent
""")
def policy_reconcile(spark, sf_dir):
    """Desired alert policies against existing ones by key: create / update / delete."""
    from ..sources.testdata import table

    ev = table(spark, sf_dir, "events")
    cut = F.lit("2024-01-16").cast("timestamp_ntz")
    desired = ev.where(F.col("ts") >= cut).select(F.concat(F.lit("alert/"), "event_type").alias("intent"),
                                                  F.col("event_type").alias("metric")).distinct()
    existing = ev.where((F.col("ts") < cut) & (F.col("event_type") != "signup")).select(
        F.concat(F.lit("alert/"), "event_type").alias("intent"), F.lit("existing").alias("state")).distinct()
    return alerts.reconcile(desired, existing, "intent")


@register("run_log_versions", f"""
WITH {SQL_SCORED}, {sql_grouped_quality('scored', 'model_version')},
runs AS (SELECT 'run-' || CAST(model_version AS VARCHAR) AS run, CAST(model_version AS VARCHAR) AS build,
                '0.8' AS train_split, CAST(round(accuracy, 6) AS VARCHAR) AS accuracy,
                'models/classifier/build-' || CAST(model_version AS VARCHAR) AS artifact FROM gq)
SELECT 'model-experiment' AS experiment, run, 'param' AS kind, 'build' AS key, build AS value FROM runs
UNION ALL SELECT 'model-experiment', run, 'param', 'train_split', train_split FROM runs
UNION ALL SELECT 'model-experiment', run, 'metric', 'accuracy', accuracy FROM runs
UNION ALL SELECT 'model-experiment', run, 'artifact', 'model', artifact FROM runs
""")
def run_log_versions(spark, sf_dir):
    """K8: experiment run log (parameters, metrics, artifact path per run), long form."""
    q = _quality_by_version(spark, sf_dir)
    runs = q.select(F.concat(F.lit("run-"), F.col("model_version").cast("string")).alias("run"),
                    F.col("model_version").cast("string").alias("build"), F.lit("0.8").alias("train_split"),
                    F.round("accuracy", 6).alias("accuracy"),
                    F.concat(F.lit("models/classifier/build-"), F.col("model_version").cast("string")).alias("artifact"))
    return registry.run_log(runs, "model-experiment", "run", ["build", "train_split"], ["accuracy"], "artifact")


@register("latest_model_version", f"""
WITH {SQL_REGISTRY} SELECT model, max(version) AS version FROM reg GROUP BY 1
""")
def latest_model_version(spark, sf_dir):
    """The newest version per model."""
    return registry.latest_version(_registry(spark, sf_dir))


ORACLE_INCIDENTS = f"""
WITH {SQL_DAILY},
fired AS (SELECT model_name AS model, 'performance_alert' AS metric,
                 time_bucket(INTERVAL 60 SECOND, "timestamp") AS period_start,
                 time_bucket(INTERVAL 60 SECOND, "timestamp") + INTERVAL 60 SECOND AS period_end
          FROM daily GROUP BY 1, 2, 3 HAVING count(*) FILTER (WHERE performance_alert) > 0),
marked AS (SELECT *, CASE WHEN lag(period_start) OVER (PARTITION BY model, metric ORDER BY period_start)
                             > period_start - INTERVAL 7 DAY THEN 0 ELSE 1 END AS new_incident FROM fired),
numbered AS (SELECT *, sum(new_incident) OVER (PARTITION BY model, metric ORDER BY period_start
                                              ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS incident FROM marked)
SELECT model, metric, min(period_start) AS opened_at, max(period_end) AS last_firing_end, count(*) AS firing_periods,
       max(period_start) + INTERVAL 7 DAY AS closes_at
FROM numbered GROUP BY model, metric, incident
"""
from .queries import ORACLE_SQL  # noqa: E402

ORACLE_SQL["alert_incidents_by_day"] = ORACLE_INCIDENTS.strip()
