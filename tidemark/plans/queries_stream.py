"""Registered queries: streaming scoring and alert windows, performance job (inventory K9, J12, J14, H11)."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import alerts, model
from ..session import ensure_checkpoint_dir, pin, unpin
from ..sources.testdata import table
from ..streaming import alerts as stream_alerts
from ..streaming import scoring
from . import domain, jobs
from .queries import SQL_HISTORY, SQL_TRUTH, register, rounded, sql_binary_quality, SQL_BQ_COLUMNS


def _scratch(spark, name: str) -> str:
    """A fresh folder under the shared checkpoint location named by the session."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


INSTANCE = T.StructType([T.StructField("doc_id", T.LongType())] +
                        [T.StructField(c, T.DoubleType()) for c in domain.DOC_FEATURES])


@register("stream_scoring_documents", """
SELECT doc_id, true AS label_is_the_batch_label FROM documents
""")
def stream_scoring_documents(spark, sf_dir):
    """K9 + H11: request payloads (derived from the documents) arrive as JSON lines; a file stream
    parses, scores and writes them with a checkpoint; the sink is read back and held against batch scores."""
    feats = domain.document_features(spark, sf_dir)
    labelled = feats.where(F.col("label").isNotNull())
    fitted = model.train_classifier(labelled, "label", domain.DOC_FEATURES)
    src, sink, ckpt = _scratch(spark, "requests"), _scratch(spark, "scores"), _scratch(spark, "scores-ckpt")
    inst = feats.select("doc_id", *[F.col(c).cast("double").alias(c) for c in domain.DOC_FEATURES])
    # requests of at most 100 instances each (consecutive ids), however large the table grows
    reqs = scoring.to_requests(inst.withColumn("_batch", F.floor(F.col("doc_id") / 100)), ["doc_id", *domain.DOC_FEATURES],
                               "_batch")
    reqs.select("value").write.mode("overwrite").text(src)
    q = scoring.start_scoring(spark, src, INSTANCE, fitted, "doc_id", sink, ckpt)
    q.awaitTermination()
    out = pin(spark.read.parquet(sink), "scores")
    unpin(spark, src, sink, ckpt)
    batch = model.score(fitted, inst).select(F.col("doc_id").alias("_id"), F.col("prediction").cast("int").alias("batch_label"))
    return out.join(batch, F.col("doc_id") == F.col("_id"), "left").select(
        "doc_id", (F.col("label") == F.col("batch_label")).alias("label_is_the_batch_label"))


SQL_ALERT_PERIODS = """
SELECT event_type AS metric, time_bucket(INTERVAL 60 SECOND, ts) AS period_start,
       time_bucket(INTERVAL 60 SECOND, ts) + INTERVAL 60 SECOND AS period_end,
       count(*) FILTER (WHERE value > 400) AS true_points, count(*) FILTER (WHERE value > 400) > 0 AS fires
FROM events GROUP BY 1, 2
"""


@register("stream_alert_periods_events", SQL_ALERT_PERIODS)
def stream_alert_periods_events(spark, sf_dir):
    """J12 streaming: events as metric points (value above 400 is a TRUE point), 60-second windows
    per event type with a 10-minute watermark, appended to a sink with checkpoint; windows still open at the
    end of the input are flushed from the state."""
    schema = table(spark, sf_dir, "events").schema
    pts = (spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf_dir)
           .select(F.col("event_type").alias("metric"), F.col("ts").alias("end_time"), (F.col("value") > 400).alias("v")))
    sink, ckpt = _scratch(spark, "alerts"), _scratch(spark, "alerts-ckpt")
    q = stream_alerts.start_alert_stream(pts, "end_time", "v", ["metric"], sink, ckpt)
    q.awaitTermination()
    closed = spark.read.parquet(sink)
    out = pin(closed.unionByName(stream_alerts.open_periods(spark, ckpt, ["metric"])), "alert-periods")
    unpin(spark, sink, ckpt)
    zone_free = lambda c: F.col(c).cast("timestamp_ntz").alias(c)
    return out.select("metric", zone_free("period_start"), zone_free("period_end"), "true_points", "fires")


@register("alert_periods_events", SQL_ALERT_PERIODS)
def alert_periods_events(spark, sf_dir):
    """J12 batch twin of the stream: TRUE points per event type and 60-second period."""
    ev = table(spark, sf_dir, "events").select(F.col("event_type").alias("metric"), "ts", (F.col("value") > 400).alias("v"))
    return alerts.alert_periods(ev, "ts", "v", ["metric"], "60 seconds")


@register("performance_monitoring_job", f"""
WITH {SQL_HISTORY},
latest AS (
  SELECT series_id, arg_max(prediction, row(inserted_at, insert_seq)) AS prediction, "timestamp"
  FROM hist
  WHERE "timestamp" > TIMESTAMP '2024-02-01 00:00:00' - INTERVAL 1200 DAY
    AND model_version = (SELECT max(model_version) FROM hist)
  GROUP BY series_id, "timestamp"),
{SQL_TRUTH},
j AS (SELECT t.target, l.prediction FROM truth t JOIN latest l ON t.series_id = l.series_id),
{sql_binary_quality('j')}
SELECT 'classifier' AS model_name, (SELECT CAST(max(model_version) AS VARCHAR) FROM hist) AS model_version,
       TIMESTAMP '2024-02-01 00:00:00' AS "timestamp", {SQL_BQ_COLUMNS}, accuracy < 0.7 AS performance_alert FROM bqf
""")
def performance_monitoring_job(spark, sf_dir):
    """Default version (highest), latest history (1200-day look-back), truth, guards, join,
    quality, alert; one metrics row."""
    out = jobs.performance_monitoring(domain.inference_history(spark, sf_dir), domain.ground_truth(spark, sf_dir),
                                      domain.AS_OF, "classifier", None, domain.LOOKBACK_PERFORMANCE_DAYS,
                                      tiebreak="insert_seq")
    return rounded(out)


@register("parse_event_props", """
SELECT event_id, CAST(json_extract(props, '$.k') AS INTEGER) AS k FROM events
""")
def parse_event_props(spark, sf_dir):
    """H11 batch twin: JSON text column parsed into typed fields with ``from_json``."""
    ev = table(spark, sf_dir, "events")
    return ev.select("event_id", F.from_json("props", "k int").getField("k").alias("k"))


SQL_INCIDENTS = """
WITH fired AS (SELECT DISTINCT event_type AS metric, time_bucket(INTERVAL 60 SECOND, ts) AS period_start FROM events WHERE value > 200),
marked AS (SELECT *, CASE WHEN lag(period_start) OVER (PARTITION BY metric ORDER BY period_start)
                             > period_start - INTERVAL 6 HOUR THEN 0 ELSE 1 END AS opens FROM fired),
numbered AS (SELECT *, sum(opens) OVER (PARTITION BY metric ORDER BY period_start
                                        ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS incident FROM marked)
SELECT metric, min(period_start) AS opened_at, max(period_start) + INTERVAL 60 SECOND AS last_firing_end, count(*) AS firing_periods,
       max(period_start) + INTERVAL 6 HOUR AS closes_at
FROM numbered GROUP BY metric, incident
"""


@register("stream_incidents_events", SQL_INCIDENTS)
def stream_incidents_events(spark, sf_dir):
    """J12 streaming: incidents of the events above 200 that close after 6 hours, by session windows with a watermark; those
    still open at the end of the input are read from the stream's state."""
    schema = table(spark, sf_dir, "events").schema
    pts = (spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf_dir)
           .select(F.col("event_type").alias("metric"), F.col("ts").alias("end_time"), (F.col("value") > 200).alias("v")))
    sink, ckpt = _scratch(spark, "incidents"), _scratch(spark, "incidents-ckpt")
    stream_alerts.start_incident_stream(pts, "end_time", "v", ["metric"], sink, ckpt, "6 hours").awaitTermination()
    closed = spark.read.parquet(sink)
    out = pin(closed.unionByName(stream_alerts.open_incidents(spark, ckpt, ["metric"])), "incidents")
    unpin(spark, sink, ckpt)
    return _zone_free(out)


@register("incidents_events", SQL_INCIDENTS)
def incidents_events(spark, sf_dir):
    """J12 batch twin of the incident stream, by chunks of time."""
    ev = table(spark, sf_dir, "events").select(F.col("event_type").alias("metric"), "ts", (F.col("value") > 200).alias("v"))
    return _zone_free(alerts.incidents(alerts.alert_periods(ev, "ts", "v", ["metric"], "60 seconds"), ["metric"], "6 hours", "5 days"))


def _zone_free(incidents):
    return incidents.select("metric", *[F.col(c).cast("timestamp_ntz").alias(c) for c in ("opened_at", "last_firing_end")],
                            "firing_periods", F.col("closes_at").cast("timestamp_ntz").alias("closes_at"))
