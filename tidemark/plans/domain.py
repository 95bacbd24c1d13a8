"""Domain tables of the monitoring jobs, derived by Spark from the given test tables.

All are lazy DataFrames over the parquet scans, so their size grows with the input.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.testdata import table

# Fixed values of the test mapping.
AS_OF = "2024-02-01 00:00:00"
MODEL_VERSION = 2
LOOKBACK_PREDICTION_DRIFT_DAYS = 730
LOOKBACK_PERFORMANCE_DAYS = 1200
POSITIVE_VALUE = 50.0
LONG_DOCUMENT_CHARS = 2000


def inference_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """History rows from ``events``: series = user, date of the event, prediction = value > 50,
    inserted at the event time (``event_id`` kept as the tie-break), version = event_id % 3."""
    ev = table(spark, sf_dir, "events")
    return ev.select(
        F.col("ts").alias("inserted_at"),
        F.col("user_id").cast("string").alias("series_id"),
        F.to_date("ts").cast("timestamp_ntz").alias("timestamp"),
        (F.col("value") > POSITIVE_VALUE).cast("int").alias("prediction"),
        (F.col("event_id") % 3).cast("int").alias("model_version"),
        F.col("event_id").alias("insert_seq"),
    )


def ground_truth(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Truth per user: mean event value above 50."""
    ev = table(spark, sf_dir, "events")
    return ev.groupBy(F.col("user_id").cast("string").alias("series_id")).agg(
        (F.avg("value") > POSITIVE_VALUE).cast("int").alias("target")
    )


def labelled_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labelled rows: quality label as target, a length rule as the model's prediction, and a
    length-derived probability for the probabilistic metrics."""
    lab = table(spark, sf_dir, "labels").select("doc_id", F.col("quality").cast("int").alias("target"))
    docs = table(spark, sf_dir, "documents").select("doc_id", "n_chars")
    return lab.join(docs, "doc_id", "inner").select(
        "doc_id", "target",
        (F.col("n_chars") >= LONG_DOCUMENT_CHARS).cast("int").alias("prediction"),
        F.least(F.col("n_chars") / F.lit(5000.0), F.lit(1.0)).alias("proba"),
    )


LINEITEM_NUMERIC = ("l_quantity", "l_extendedprice", "l_discount", "l_tax")


def lineitem_with_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``lineitem`` numeric columns with deterministic holes: quantity missing when
    ``l_orderkey % 7 = 0``, discount missing on line 3, tax NaN when ``l_orderkey % 11 = 0``."""
    li = table(spark, sf_dir, "lineitem")
    return li.select(
        "l_orderkey", "l_linenumber", "l_shipdate", "l_returnflag",
        F.when(F.col("l_orderkey") % 7 != 0, F.col("l_quantity")).alias("l_quantity"),
        "l_extendedprice",
        F.when(F.col("l_linenumber") != 3, F.col("l_discount")).alias("l_discount"),
        F.when(F.col("l_orderkey") % 11 == 0, F.lit(float("nan"))).otherwise(F.col("l_tax")).alias("l_tax"),
    )


SQL_GAPS = """
gaps AS (
  SELECT l_orderkey, l_linenumber, l_shipdate, l_returnflag,
         CASE WHEN l_orderkey % 7 <> 0 THEN l_quantity END AS l_quantity,
         l_extendedprice,
         CASE WHEN l_linenumber <> 3 THEN l_discount END AS l_discount,
         CASE WHEN l_orderkey % 11 = 0 THEN CAST('NaN' AS DOUBLE) ELSE l_tax END AS l_tax
  FROM lineitem)"""


def events_with_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``events`` with the value missing on every fifth event id."""
    ev = table(spark, sf_dir, "events")
    return ev.select("event_id", "user_id", "ts", "event_type",
                     F.when(F.col("event_id") % 5 != 0, F.col("value")).alias("value"))


SQL_EVENT_GAPS = """
egaps AS (SELECT event_id, user_id, ts, event_type, CASE WHEN event_id % 5 <> 0 THEN value END AS value FROM events)"""


def scored_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every history row joined to its series' truth: (model_version, day, target, prediction)."""
    h = inference_history(spark, sf_dir)
    t = ground_truth(spark, sf_dir)
    return h.join(t, "series_id", "inner").select("model_version", "timestamp", "series_id", "target", "prediction",
                                                  "inserted_at")


SQL_SCORED = """
scored AS (
  SELECT CAST(event_id % 3 AS INTEGER) AS model_version, CAST(CAST(ts AS DATE) AS TIMESTAMP) AS "timestamp",
         CAST(user_id AS VARCHAR) AS series_id, t.target, CAST(value > 50 AS INTEGER) AS prediction, ts AS inserted_at
  FROM events e JOIN (SELECT user_id AS uid, CAST(avg(value) > 50 AS INTEGER) AS target FROM events GROUP BY 1) t
    ON e.user_id = t.uid)"""


def sql_grouped_quality(rel: str, g: str) -> str:
    """Grouped accuracy / weighted and positive-class metrics of ``rel(<g>, target, prediction)``."""
    return f"""
gcm AS (SELECT {g}, target, prediction, count(*) AS n FROM {rel} GROUP BY ALL),
gpc AS (SELECT {g}, cls, sum(support) AS support, sum(predicted) AS predicted, sum(tp) AS tp FROM (
          SELECT {g}, target AS cls, n AS support, 0 AS predicted, CASE WHEN target = prediction THEN n ELSE 0 END AS tp
          FROM gcm
          UNION ALL SELECT {g}, prediction, 0, n, 0 FROM gcm) GROUP BY ALL),
gpm AS (SELECT *, CASE WHEN predicted = 0 THEN 0.0 ELSE tp / predicted END AS cprec,
                  CASE WHEN support = 0 THEN 0.0 ELSE tp / support END AS crec FROM gpc),
gq AS (SELECT {g}, sum(tp) / sum(support) AS accuracy,
              sum(cprec * support) / sum(support) AS precision_weighted,
              sum(crec * support) / sum(support) AS recall_weighted,
              sum(CASE WHEN cprec + crec = 0 THEN 0.0 ELSE 2 * cprec * crec / (cprec + crec) END * support) / sum(support)
                AS f1_weighted,
              sum(CASE WHEN cls = 1 THEN tp ELSE 0 END) AS tp1, sum(CASE WHEN cls = 1 THEN predicted ELSE 0 END) AS pred1,
              sum(CASE WHEN cls = 1 THEN support ELSE 0 END) AS sup1
       FROM gpm GROUP BY ALL)"""


DOC_FEATURES = ["n_chars", "n_lines", "n_words", "digit_share", "is_en"]


def document_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document, over the whole text: characters, lines, words, share of digits, English flag;
    with the quality label where one exists (null otherwise)."""
    d = table(spark, sf_dir, "documents")
    lab = table(spark, sf_dir, "labels").select("doc_id", F.col("quality").cast("int").alias("label"))
    text = F.col("text")
    feats = d.select(
        "doc_id",
        F.length(text).cast("long").alias("n_chars"),
        F.size(F.split(text, "\n")).cast("long").alias("n_lines"),
        F.size(F.split(F.trim(text), "[ \t\n\r]+")).cast("long").alias("n_words"),
        F.try_divide(F.length(F.regexp_replace(text, "[^0-9]", "")).cast("double"), F.length(text)).alias("digit_share"),
        (F.col("lang") == "en").cast("int").alias("is_en"),
    )
    return feats.join(lab, "doc_id", "left")


SQL_DOC_FEATURES = """
docf AS (
  SELECT d.doc_id, CAST(length(text) AS BIGINT) AS n_chars, CAST(len(string_split(text, chr(10))) AS BIGINT) AS n_lines,
         CAST(len(regexp_split_to_array(trim(text), '[ \\t\\n\\r]+')) AS BIGINT) AS n_words,
         CASE WHEN length(text) = 0 THEN NULL ELSE length(regexp_replace(text, '[^0-9]', '', 'g')) / length(text) END
           AS digit_share,
         CAST(lang = 'en' AS INTEGER) AS is_en, CAST(l.quality AS INTEGER) AS label
  FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id)"""
