"""Prediction history: build rows, append, read the latest value per series and date."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.scalar import days_before
from ..session import pin

HISTORY_SCHEMA = T.StructType([
    T.StructField("inserted_at", T.TimestampType()),
    T.StructField("series_id", T.StringType()),
    T.StructField("timestamp", T.TimestampType()),
    T.StructField("prediction", T.IntegerType()),
    T.StructField("model_version", T.IntegerType()),
])

EMPTY_HISTORY_READ = "series_id string, prediction double, timestamp timestamp"


def to_history_rows(predictions: DataFrame, series_id: str | Column, timestamp: str | Column,
                    prediction: str | Column, model_version, inserted_at) -> DataFrame:
    """Cast + rename a scored batch into history shape.

    ``inserted_at`` is passed in (a literal time for a batch, or a column) so runs are reproducible.
    """
    def _col(c):
        return F.col(c) if isinstance(c, str) else c

    ins = _col(inserted_at) if isinstance(inserted_at, (str, Column)) else F.lit(inserted_at)
    ver = _col(model_version) if isinstance(model_version, (str, Column)) else F.lit(int(model_version))
    return predictions.select(
        ins.cast("timestamp").alias("inserted_at"),
        _col(series_id).cast("string").alias("series_id"),
        _col(timestamp).cast("timestamp").alias("timestamp"),
        _col(prediction).cast("int").alias("prediction"),
        ver.cast("int").alias("model_version"),
    )


def latest_per_series(history: DataFrame, as_of, lookback_days: int | None, model_version=None,
                      tiebreak: str | None = None) -> DataFrame:
    """Per (series_id, timestamp), the prediction of the newest insert.

    Look-back is strict (``timestamp > as_of - lookback``). Ties on ``inserted_at`` are broken by
    ``tiebreak`` (largest wins) so the result is deterministic. ``max_by`` aggregates partially on
    the map side, so a series holding a large share of rows is collapsed before the shuffle.
    """
    h = history
    if lookback_days is not None:
        ts = F.col("timestamp")
        h = h.where(ts > days_before(F.lit(as_of).cast(h.schema["timestamp"].dataType), lookback_days))
    if model_version is not None:
        h = h.where(F.col("model_version") == F.lit(int(model_version)))
    order_key = _newest_first_key(h, "inserted_at", tiebreak)
    return h.groupBy("series_id", "timestamp").agg(
        F.max_by("prediction", order_key).alias("prediction")
    ).select("series_id", "prediction", "timestamp")


# Packing (time, tie-break) into one DECIMAL(38, 0) keeps the max_by buffer fixed-width, so the
# aggregate stays a hash aggregate (a struct ordering falls back to sort-based aggregation).
_TIE_SPAN = 2 ** 64          # a long tie-break shifted by 2^63 lies in [0, 2^64)
_TIE_SHIFT = 2 ** 63


def _newest_first_key(df: DataFrame, time_col: str, tiebreak: str | None) -> Column:
    t = df.schema[time_col].dataType
    if tiebreak is None:
        return F.col(time_col)
    tb = df.schema[tiebreak].dataType
    if isinstance(t, (T.TimestampType, T.TimestampNTZType)) and isinstance(tb, (T.IntegerType, T.LongType,
                                                                                 T.ShortType, T.ByteType)):
        if isinstance(t, T.TimestampNTZType):  # zone-free micros, no session time zone involved
            micros = F.expr(f"timestampdiff(MICROSECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', `{time_col}`)")
        else:
            micros = F.unix_micros(F.col(time_col))
        dec = "decimal(38,0)"
        return (micros.cast(dec) * F.lit(str(_TIE_SPAN)).cast(dec)
                + (F.col(tiebreak).cast(dec) + F.lit(str(_TIE_SHIFT)).cast(dec))).cast(dec)
    return F.struct(time_col, tiebreak)


def newest_batch(history: DataFrame) -> DataFrame:
    """Rows of the newest insert batch, without ``inserted_at`` (scalar subquery form)."""
    newest = history.agg(F.max("inserted_at").alias("_newest"))
    return (
        history.join(F.broadcast(newest), F.col("inserted_at") == F.col("_newest"), "left_semi")
        .drop("inserted_at")
    )


def default_model_version(history: DataFrame) -> DataFrame:
    """Highest model version, as text (used when no version is given)."""
    return history.agg(F.max("model_version").cast("string").alias("model_version"))


def empty_history(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], EMPTY_HISTORY_READ)


def read_history(spark: SparkSession, table_name: str) -> DataFrame:
    """Read a history table; a missing table reads as an empty frame of the history-read shape."""
    if not spark.catalog.tableExists(table_name):
        return empty_history(spark)
    return spark.table(table_name)


def append_history(rows: DataFrame, table_name: str, buckets: int | None = None, once: bool = False) -> None:
    """Append scored rows; the table is partitioned by model version so version reads prune.

    With ``buckets``, the table is created bucketed (and sorted) by ``series_id``: the latest-value
    aggregate per (series, day) and joins on the series id then read co-located buckets without a
    shuffle of the history.

    With ``once``, a batch (the rows of one ``inserted_at`` and model version) that the table already holds in part or whole
    is completed, not doubled: rows whose insert time, version, series and day are there are left out. A broken append
    leaves no rows behind (the write is committed as a whole), so this covers reruns.
    """
    spark = rows.sparkSession
    rows = rows.select([f.name for f in HISTORY_SCHEMA.fields])
    if once and spark.catalog.tableExists(table_name):
        keys = ["inserted_at", "model_version", "series_id", "timestamp"]
        batch = [r.model_version for r in rows.select("model_version").distinct().collect()]  # versions in the batch: one
        there = spark.table(table_name).where(F.col("model_version").isin(batch)).select(*keys)
        newest = rows.agg(F.min("inserted_at").alias("lo"), F.max("inserted_at").alias("hi")).first()
        there = there.where(F.col("inserted_at").between(F.lit(newest.lo), F.lit(newest.hi)))  # pushed down to the scan
        rows = pin(rows.join(there.distinct(), keys, "left_anti").select(rows.columns), "history-batch")
    if spark.catalog.tableExists(table_name):
        rows.write.mode("append").insertInto(table_name)
        return
    w = rows.write.mode("append").partitionBy("model_version").format("parquet")
    if buckets:
        w = w.bucketBy(int(buckets), "series_id").sortBy("series_id", "timestamp")
    w.saveAsTable(table_name)
