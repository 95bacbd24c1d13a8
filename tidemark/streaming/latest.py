"""The latest prediction per series and day, kept up to date batch by batch in a bucketed table.

The table holds one row per (model version, series, day): the newest insert so far. It is partitioned by version and
month and bucketed and sorted by series, so reading it needs no aggregate, and joining it with a truth table bucketed
alike needs no exchange. A batch is reduced to its own latest rows (combined before the shuffle), merged with the partitions
that it touches, and these are written again; the newest insert wins in whatever order batches arrive, so a
batch that runs twice, or comes late, changes nothing that it shouldn't.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.scalar import days_before
from ..operators.history import _newest_first_key
from ..session import pin
from ..sources import catalog

KEYS = ["model_version", "month", "series_id", "timestamp"]
PARTITIONS = ["model_version", "month"]
SCHEMA = ("series_id string, timestamp timestamp_ntz, prediction int, inserted_at timestamp_ntz, insert_seq long, "
          "model_version int, month date")
BUCKETS = 16


def create_latest(spark: SparkSession, table_name: str, buckets: int = BUCKETS) -> None:
    """An empty table; ``buckets`` should grow with the number of series (some 100 MB a bucket and month)."""
    (spark.createDataFrame([], SCHEMA).write.format("parquet").partitionBy(*PARTITIONS).bucketBy(buckets, "series_id")
     .sortBy("series_id", "timestamp").saveAsTable(table_name))


def _bucket_count(spark: SparkSession, table_name: str) -> int:
    rows = spark.sql(f"DESCRIBE EXTENDED {catalog.quote(table_name)}").where("col_name = 'Num Buckets'").collect()
    return int(rows[0].data_type)


def newest(rows: DataFrame) -> DataFrame:
    """The newest insert per key (ties by ``insert_seq``), by hash aggregates with fixed-width buffers."""
    key = _newest_first_key(rows, "inserted_at", "insert_seq")
    return rows.groupBy(*KEYS).agg(*[F.max_by(c, key).alias(c) for c in ("prediction", "inserted_at", "insert_seq")])


def merge_latest(batch: DataFrame, table_name: str) -> None:
    """Merge history rows (series_id, timestamp, prediction, inserted_at, insert_seq, model_version) into the table."""
    spark = batch.sparkSession
    fresh = pin(newest(batch.withColumn("month", F.trunc(F.col("timestamp").cast("date"), "month"))), "fresh")
    touched = fresh.select(*PARTITIONS).distinct()
    old = spark.table(table_name).join(F.broadcast(touched), PARTITIONS, "left_semi")  # some partitions of the table
    merged = pin(newest(old.select(*fresh.columns).unionByName(fresh)), "merged")  # its source is overwritten below
    # rows go to the task of their bucket: a file for each bucket of a partition
    out = merged.repartition(_bucket_count(spark, table_name), "series_id")
    catalog.overwrite_partitions(out, table_name)


def start_latest(rows: DataFrame, table_name: str, checkpoint_dir: str):
    """Merge a stream of history rows into the table; resumes from its checkpoint."""
    return (rows.writeStream.foreachBatch(lambda batch, _: merge_latest(batch, table_name))
            .option("checkpointLocation", checkpoint_dir).trigger(availableNow=True).start())


def read_latest(spark: SparkSession, table_name: str, as_of, lookback_days: int | None, model_version=None) -> DataFrame:
    """(series_id, prediction, timestamp), as :func:`history.latest_per_series`, by a filter on the table."""
    h = spark.table(table_name)
    if lookback_days is not None:
        first = days_before(F.lit(as_of).cast("timestamp_ntz"), lookback_days)
        h = h.where((F.col("timestamp") > first) & (F.col("month") >= F.trunc(first.cast("date"), "month")))
    if model_version is not None:
        h = h.where(F.col("model_version") == F.lit(int(model_version)))
    return h.select("series_id", "prediction", "timestamp")


def write_truth(truth: DataFrame, table_name: str, buckets: int = BUCKETS) -> None:
    """Ground truth bucketed and sorted by series like the latest table, for joins without an exchange."""
    (truth.repartition(buckets, "series_id").write.format("parquet").bucketBy(buckets, "series_id").sortBy("series_id")
     .saveAsTable(table_name))
