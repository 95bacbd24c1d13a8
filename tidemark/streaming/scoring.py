"""Streaming scoring of arriving request records (``{"instances": [{...}]}`` JSON lines).

File source -> ``from_json`` + ``explode`` -> ``PipelineModel.transform`` -> parquet sink with a
checkpoint, so a restarted query resumes exactly where it stopped.
"""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def request_schema(instance: T.StructType) -> T.StructType:
    return T.StructType([T.StructField("instances", T.ArrayType(instance))])


def parse_requests(raw: DataFrame, instance: T.StructType, payload_col: str = "value") -> DataFrame:
    """One row per instance of each request payload (JSON text column)."""
    parsed = raw.select(F.from_json(F.col(payload_col), request_schema(instance)).alias("r"))
    return parsed.select(F.explode("r.instances").alias("i")).select("i.*")


def to_requests(df: DataFrame, cols, batch_col: str) -> DataFrame:
    """Group rows into request payloads (one JSON line per ``batch_col`` value). The caller's batch
    key must bound the rows per request (a request is one record)."""
    return df.groupBy(batch_col).agg(F.to_json(F.struct(F.collect_list(F.struct(*cols)).alias("instances"))).alias("value"))


def predictions_payload(scored: DataFrame, id_col: str) -> DataFrame:
    """Response rows ``{"predictions": [{"label": p}]}`` per id (kept flat: id, label)."""
    return scored.select(F.col(id_col), F.col("prediction").cast("int").alias("label"))


def start_scoring(spark: SparkSession, source_dir: str, instance: T.StructType, model: PipelineModel, id_col: str,
                  sink_dir: str, checkpoint_dir: str, available_now: bool = True):
    """Start the scoring stream; returns the ``StreamingQuery``."""
    raw = spark.readStream.format("text").load(source_dir)
    rows = parse_requests(raw, instance)
    out = predictions_payload(model.transform(rows), id_col)
    w = out.writeStream.format("parquet").option("path", sink_dir).option("checkpointLocation", checkpoint_dir) \
        .outputMode("append")
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="10 seconds")
    return w.start()


# Bytes of request files in one micro-batch. Every micro-batch costs a task per state partition, whatever it holds.
BATCH_BYTES = 256 << 20


# ------------------------------------------------------------------ requests with an id: duplicates, broken records, restarts


def read_requests(raw: DataFrame, instance: T.StructType, payload_col: str = "value") -> DataFrame:
    """Text records ``{"request_id": .., "sent_at": .., "instances": [..]}`` as (request_id, sent_at, instances, record);
    what isn't such a record has no ``request_id``."""
    schema = T.StructType([T.StructField("request_id", T.StringType()), T.StructField("sent_at", T.TimestampType()),
                           T.StructField("instances", T.ArrayType(instance))])
    r = F.from_json(F.col(payload_col), schema)
    whole = r["sent_at"].isNotNull() & r["instances"].isNotNull()
    return raw.select(F.when(whole, r["request_id"]).alias("request_id"), r["sent_at"].alias("sent_at"),
                      r["instances"].alias("instances"), F.col(payload_col).alias("record"))


def start_scoring_once(spark: SparkSession, source_dir: str, instance: T.StructType, model: PipelineModel, id_col: str,
                       sink_dir: str, broken_dir: str, checkpoint_dir: str, delay: str = "1 hour", batch_bytes: int = BATCH_BYTES):
    """Score every request once: a request id that comes again within ``delay`` of event time is dropped, also after a
    restart (the ids seen are in the checkpoint). Broken records go to ``broken_dir``. Runs over what has arrived; returns
    the two queries (scores, broken records), each with its own checkpoint. Micro-batches take files up to ``BATCH_BYTES``."""
    def source():
        return read_requests(spark.readStream.format("text").option("maxBytesPerTrigger", batch_bytes).load(source_dir), instance)

    once = source().where(F.col("request_id").isNotNull()).withWatermark("sent_at", delay) \
        .dropDuplicatesWithinWatermark(["request_id"])
    rows = once.select("request_id", F.explode("instances").alias("i")).select("request_id", "i.*")
    scored = model.transform(rows).select("request_id", F.col(id_col), F.col("prediction").cast("int").alias("label"))
    broken = source().where(F.col("request_id").isNull()).select("record")

    def start(out, sink, name):
        return (out.writeStream.format("parquet").option("path", sink).option("checkpointLocation", f"{checkpoint_dir}/{name}")
                .outputMode("append").trigger(availableNow=True).start())

    return start(scored, sink_dir, "scores"), start(broken, broken_dir, "broken")
