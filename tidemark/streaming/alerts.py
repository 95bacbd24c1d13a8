"""Streaming alert windows: TRUE metric points per 60-second period, with a watermark for late points."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def alert_period_stream(points: DataFrame, ts: str, value: str, series_cols, period: str = "60 seconds",
                        watermark: str = "10 minutes") -> DataFrame:
    """Windowed count of TRUE points per series; points later than the watermark are dropped.

    ``ts`` must be a TIMESTAMP (a zone-free column is cast, as watermarks require it).
    """
    p = points.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, watermark)
    return (
        p.groupBy(*series_cols, F.window(ts, period).alias("period"))
        .agg(F.count_if(F.col(value)).alias("true_points"))
        .select(*series_cols, F.col("period.start").alias("period_start"), F.col("period.end").alias("period_end"),
                "true_points", (F.col("true_points") > 0).alias("fires"))
    )


def start_alert_stream(points: DataFrame, ts: str, value: str, series_cols, sink_dir: str, checkpoint_dir: str,
                       period: str = "60 seconds", watermark: str = "10 minutes"):
    out = alert_period_stream(points, ts, value, series_cols, period, watermark)
    return (out.writeStream.format("parquet").option("path", sink_dir).option("checkpointLocation", checkpoint_dir)
            .outputMode("append").trigger(availableNow=True).start())


def open_periods(spark: SparkSession, checkpoint_dir: str, series_cols) -> DataFrame:
    """The windows that a finished stream still holds in its state (the watermark hasn't passed them): with the
    sink's rows they are the whole result of a finite input."""
    state = spark.read.format("statestore").load(checkpoint_dir)
    keys = state.schema["key"].dataType.fieldNames()          # the series columns, then the window
    count = state.schema["value"].dataType.fieldNames()[0]
    window = F.col("key").getField(keys[-1])
    n = F.col("value").getField(count)
    return state.select(*[F.col("key").getField(k).alias(c) for k, c in zip(keys, series_cols)],
                        window.getField("start").alias("period_start"), window.getField("end").alias("period_end"),
                        n.alias("true_points"), (n > 0).alias("fires"))


# ------------------------------------------------------------------ incidents


def incident_stream(points: DataFrame, ts: str, value: str, series_cols, auto_close: str = "7 days",
                    watermark: str = "10 minutes") -> DataFrame:
    """Incidents of TRUE points as :func:`operators.alerts.incidents` of their 60-second periods: a period counts once however
    many points it has, and an incident is emitted when the watermark has passed its close. State: the periods within the
    watermark, and one open session per series."""
    start = F.date_trunc("minute", F.col(ts).cast("timestamp"))
    fired = points.where(F.col(value)).select(*series_cols, start.alias("period_start")).withWatermark("period_start", watermark) \
        .dropDuplicates([*series_cols, "period_start"])
    return fired.groupBy(*series_cols, F.session_window("period_start", auto_close).alias("incident")).agg(
        F.count(F.lit(1)).alias("firing_periods"), F.max("period_start").alias("last_start")).select(
        *series_cols, F.col("incident.start").alias("opened_at"), (F.col("last_start") + F.expr("interval 60 seconds")).alias("last_firing_end"),
        "firing_periods", F.col("incident.end").alias("closes_at"))


def start_incident_stream(points: DataFrame, ts: str, value: str, series_cols, sink_dir: str, checkpoint_dir: str,
                          auto_close: str = "7 days", watermark: str = "10 minutes"):
    out = incident_stream(points, ts, value, series_cols, auto_close, watermark)
    return (out.writeStream.format("parquet").option("path", sink_dir).option("checkpointLocation", checkpoint_dir)
            .outputMode("append").trigger(availableNow=True).start())


def open_incidents(spark: SparkSession, checkpoint_dir: str, series_cols) -> DataFrame:
    """The incidents that a finished stream still holds open in its state: with the sink's rows, all of a finite input."""
    metadata = spark.read.format("state-metadata").load(checkpoint_dir)
    operator = metadata.where(F.col("operatorName").startswith("sessionWindow")).first().operatorId
    state = spark.read.format("statestore").option("operatorId", operator).load(checkpoint_dir)
    keys = state.schema["key"].dataType.fieldNames()     # the series columns, then the session's start
    fields = state.schema["value"].dataType.fields       # as many, then the two sums in the plan's order: told apart by type
    value = lambda n: F.col("value").getField(n)
    session = value(fields[len(keys) - 1].name)
    sums = {f.dataType.typeName(): value(f.name) for f in fields[len(keys):]}
    count, last = sums["long"], sums["timestamp"]
    return state.select(*[F.col("key").getField(k).alias(c) for k, c in zip(keys, series_cols)],
                        session.getField("start").alias("opened_at"), (last + F.expr("interval 60 seconds")).alias("last_firing_end"),
                        count.alias("firing_periods"), session.getField("end").alias("closes_at"))
