"""Registered queries: tables that jobs keep from run to run, and rerun (daily drift states, latest values, commits)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import drift_state, model
from ..session import pin, unpin
from ..sources import commits
from ..sources.testdata import table
from ..streaming import latest, scoring
from . import domain, jobs
from . import queries_drift as qd
from .queries import ORACLE_SQL, SQL_BQ_COLUMNS, SQL_HISTORY, SQL_TRUTH, register, rounded, sql_binary_quality
from .queries_catalog import _database
from .queries_stream import INSTANCE, _scratch


@register("drift_from_daily_states_lineitem", "\nUNION ALL\n".join(
    f"({ORACLE_SQL[name]})" for name in ("psi_drift_lineitem", "psi_drift_categorical", "jensenshannon_drift_categorical",
                                         "chisquare_drift_categorical")))
def drift_from_daily_states_lineitem(spark, sf_dir):
    """Drift of two ranges of days from merged daily states. The later days arrive incomplete first and are
    replaced when their late rows are in; the reports equal those of the raw rows."""
    reference, current = qd._sides(spark, sf_dir)
    name = f"{_database(spark)}.drift_states"
    bins = drift_state.reference_bins(reference, qd.NUM_FEATURES)
    drift_state.create_states(spark, name, bins)
    bins = spark.table(drift_state.bins_table(name))
    for rows in (reference, current.where("l_linenumber = 1"), current):
        drift_state.put_days(drift_state.daily_states(rows, F.col("l_shipdate"), bins, qd.NUM_FEATURES, qd.CAT_FEATURES), name)
    states, cut = spark.table(name), qd.SPLIT_DATE[:10]
    before, after = drift_state.merged(states, None, cut), drift_state.merged(states, cut, None)
    out = drift_state.drift_report(before, after, "psi", "psi", 0.2, 0.2)
    categorical = [m.where("kind = 'cat'") for m in (before, after)]
    for test in ("jensenshannon", "chisquare"):
        out = out.unionByName(drift_state.drift_report(*categorical, cat_stattest=test))
    return rounded(out)


@register("stream_latest_history_events", ORACLE_SQL["latest_inference_history"])
def stream_latest_history_events(spark, sf_dir):
    """D1, J15 as a stream: history rows arrive in three files, the newest first, and each micro-batch is merged into a
    bucketed table of latest values; the table equals the latest values of the whole history."""
    name = f"{_database(spark)}.latest"
    latest.create_latest(spark, name, 8)
    src, ckpt = _scratch(spark, "history-in"), _scratch(spark, "history-ckpt")
    rows = domain.inference_history(spark, sf_dir)
    days = rows.agg(F.min("timestamp").alias("lo"), F.max("timestamp").alias("hi")).first()
    third = F.floor(F.datediff("timestamp", F.lit(days.lo)) * 3 / (F.datediff(F.lit(days.hi), F.lit(days.lo)) + 1))
    for part in (2, 0, 1):
        rows.where(third == part).write.mode("append").parquet(f"{src}/{part}")
        arrived = spark.readStream.schema(rows.schema).option("recursiveFileLookup", True).parquet(src)
        latest.start_latest(arrived, name, ckpt).awaitTermination()  # each time it goes on from its checkpoint
    unpin(spark, src, ckpt)
    return latest.read_latest(spark, name, domain.AS_OF, domain.LOOKBACK_PREDICTION_DRIFT_DAYS, domain.MODEL_VERSION)


def _sql_performance(version: int) -> str:
    return f"""(
WITH {SQL_HISTORY},
latest AS (
  SELECT series_id, arg_max(prediction, row(inserted_at, insert_seq)) AS prediction, "timestamp" FROM hist
  WHERE "timestamp" > TIMESTAMP '2024-02-01 00:00:00' - INTERVAL 1200 DAY AND model_version = {version}
  GROUP BY series_id, "timestamp"),
{SQL_TRUTH},
j AS (SELECT t.target, l.prediction FROM truth t JOIN latest l ON t.series_id = l.series_id),
{sql_binary_quality('j')}
SELECT '{version}' AS model_version, {SQL_BQ_COLUMNS}, accuracy < 0.7 AS performance_alert, CAST(12 AS BIGINT) AS points FROM bqf)"""


@register("monitoring_job_rerun", "\nUNION ALL\n".join(_sql_performance(v) for v in (1, 2)))
def monitoring_job_rerun(spark, sf_dir):
    """J14, A8, A13 run again: the job of version 2 breaks after its first table, then runs twice; version 1 breaks and isn't
    repeated before version 1 runs too. One metrics row and one set of points a version is left."""
    db = _database(spark)
    tables = {"metrics_table": f"{db}.monitor_performance", "points_table": f"{db}.metric_points",
              "commits_table": f"{db}.job_commits"}
    h, t = domain.inference_history(spark, sf_dir), domain.ground_truth(spark, sf_dir)

    def run(version, **kept):
        return jobs.performance_monitoring(h, t, domain.AS_OF, "classifier", version, domain.LOOKBACK_PERFORMANCE_DAYS,
                                           tiebreak="insert_seq", **kept)

    def broken(version):  # what a run leaves that dies between its two tables: the first one written, nothing finished
        commits.write_commit(run(version), tables["metrics_table"],
                             commits.commit_name(f"performance/classifier/{version}", domain.AS_OF))

    broken(2)
    run(2, **tables)
    run(2, **tables)
    broken(0)  # never repeated: its row stays out of what is read
    broken(1)
    run(1, **tables)
    m = commits.committed(spark, tables["metrics_table"], tables["commits_table"])
    points = commits.committed(spark, tables["points_table"], tables["commits_table"]).groupBy("commit_id") \
        .agg(F.count(F.lit(1)).alias("points"))
    return rounded(m.join(points, "commit_id", "left").drop("commit_id", "model_name", "timestamp"))


@register("stream_requests_once_documents", """
SELECT CAST(doc_id // 100 AS VARCHAR) AS request_id, doc_id, CAST(1 AS BIGINT) AS times, 'scored' AS outcome FROM documents
UNION ALL
SELECT NULL, NULL, count(DISTINCT floor(doc_id / 100)), 'broken' FROM documents
""")
def stream_requests_once_documents(spark, sf_dir):
    """K9, H11 with restarts: requests arrive twice, the second time after a restart and together with broken records (each
    request cut short); every document is scored once, every broken record kept apart."""
    feats = domain.document_features(spark, sf_dir)
    fitted = model.train_classifier(feats.where(F.col("label").isNotNull()), "label", domain.DOC_FEATURES)
    inst = feats.select("doc_id", *[F.col(c).cast("double").alias(c) for c in domain.DOC_FEATURES])
    inst = inst.withColumn("request_id", F.floor(F.col("doc_id") / 100).cast("string"))
    sent = F.timestamp_seconds(F.lit(1706745600) + F.col("request_id").cast("long") % 60)  # within a minute
    body = F.collect_list(F.struct("doc_id", *domain.DOC_FEATURES)).alias("instances")  # at most 100 documents a request
    requests = pin(inst.groupBy("request_id").agg(body).select(F.to_json(F.struct(
        "request_id", sent.alias("sent_at"), "instances")).alias("value")), "requests")
    src, sink, bad, ckpt = (_scratch(spark, n) for n in ("requests", "scores", "broken", "scores-ckpt"))
    cut_short = requests.select(F.expr("substring(value, 1, cast(length(value) / 2 as int))").alias("value"))
    for arrived in (requests, requests.unionByName(cut_short)):
        arrived.write.mode("append").text(src)
        for q in scoring.start_scoring_once(spark, src, INSTANCE, fitted, "doc_id", sink, bad, ckpt):
            q.awaitTermination()
    scores = spark.read.parquet(sink).groupBy("request_id", "doc_id").agg(F.count(F.lit(1)).alias("times"))
    broken = spark.read.parquet(bad).agg(F.count(F.lit(1)).alias("times"))
    out = scores.withColumn("outcome", F.lit("scored")).unionByName(broken.select(
        F.lit(None).cast("string").alias("request_id"), F.lit(None).cast("long").alias("doc_id"), "times", F.lit("broken").alias("outcome")))
    out = pin(out, "requests-once")
    unpin(spark, src, sink, bad, ckpt)
    return out
