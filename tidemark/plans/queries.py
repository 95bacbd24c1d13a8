"""Registered queries: one per operator of the inventory, each over whole test tables.

Every entry is ``(spark, sf_dir) -> DataFrame``; most have an SQL twin (DuckDB dialect) computing
the same result independently. Floating results are rounded to 6 decimals on both sides.
"""

from __future__ import annotations

from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}

DIGITS = 6


def rounded(df: DataFrame, digits: int = DIGITS) -> DataFrame:
    """Round every double column (both engines differ in the last bits of sums and roots)."""
    return df.select(*[
        F.round(F.col(f.name), digits).alias(f.name)
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)) else F.col(f.name)
        for f in df.schema.fields
    ])


def register(name: str, sql: str | None = None):
    def deco(fn):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLE_SQL[name] = sql.strip()
        return fn
    return deco


# --------------------------------------------------------------------------------------------
# SQL fragments shared by several oracle statements (DuckDB dialect)

SQL_HISTORY = """
hist AS (
  SELECT ts AS inserted_at, CAST(user_id AS VARCHAR) AS series_id,
         CAST(CAST(ts AS DATE) AS TIMESTAMP) AS "timestamp",
         CAST(value > 50 AS INTEGER) AS prediction, CAST(event_id % 3 AS INTEGER) AS model_version,
         event_id AS insert_seq
  FROM events)"""

SQL_LATEST = SQL_HISTORY + """,
latest AS (
  SELECT series_id, arg_max(prediction, row(inserted_at, insert_seq)) AS prediction, "timestamp"
  FROM hist
  WHERE "timestamp" > TIMESTAMP '2024-02-01 00:00:00' - INTERVAL 730 DAY AND model_version = 2
  GROUP BY series_id, "timestamp")"""

SQL_TRUTH = """
truth AS (SELECT CAST(user_id AS VARCHAR) AS series_id, CAST(avg(value) > 50 AS INTEGER) AS target
          FROM events GROUP BY 1)"""

SQL_LABELLED = """
labelled AS (
  SELECT l.doc_id, CAST(l.quality AS INTEGER) AS target, CAST(d.n_chars >= 2000 AS INTEGER) AS prediction,
         least(d.n_chars / 5000.0, 1.0) AS proba
  FROM labels l JOIN documents d ON l.doc_id = d.doc_id)"""


def sql_binary_quality(rel: str) -> str:
    """SELECT computing the binary_quality columns from relation ``rel(target, prediction)``."""
    return f"""
cm AS (SELECT target, prediction, count(*) AS n FROM {rel} GROUP BY 1, 2),
pc AS (
  SELECT cls,
         coalesce((SELECT sum(n) FROM cm WHERE cm.target = c.cls), 0) AS support,
         coalesce((SELECT sum(n) FROM cm WHERE cm.prediction = c.cls), 0) AS predicted,
         coalesce((SELECT sum(n) FROM cm WHERE cm.target = c.cls AND cm.prediction = c.cls), 0) AS tp
  FROM (SELECT target AS cls FROM cm UNION SELECT prediction FROM cm) c),
pcm AS (
  SELECT *, CASE WHEN predicted = 0 THEN 0.0 ELSE tp / predicted END AS cprec,
            CASE WHEN support = 0 THEN 0.0 ELSE tp / support END AS crec FROM pc),
pcf AS (SELECT *, CASE WHEN cprec + crec = 0 THEN 0.0 ELSE 2 * cprec * crec / (cprec + crec) END AS cf1 FROM pcm),
agg AS (
  SELECT sum(support) AS n, sum(tp) AS tp_all,
         sum(CASE WHEN cls = 1 THEN tp ELSE 0 END) AS tp,
         sum(CASE WHEN cls = 1 THEN predicted - tp ELSE 0 END) AS fp,
         sum(CASE WHEN cls = 1 THEN support - tp ELSE 0 END) AS fn,
         sum(cprec * support) / sum(support) AS precision_weighted,
         sum(crec * support) / sum(support) AS recall_weighted,
         sum(cf1 * support) / sum(support) AS f1_weighted
  FROM pcf),
bq AS (
  SELECT tp_all / n AS accuracy,
         CASE WHEN tp + fp = 0 THEN 0.0 ELSE tp / (tp + fp) END AS precision,
         CASE WHEN tp + fn = 0 THEN 0.0 ELSE tp / (tp + fn) END AS recall,
         CASE WHEN tp + fn = 0 THEN 0.0 ELSE tp / (tp + fn) END AS tpr,
         CASE WHEN n - tp - fp - fn + fp = 0 THEN 0.0 ELSE (n - tp - fp - fn) / (n - tp - fn) END AS tnr,
         CASE WHEN n - tp - fn = 0 THEN 0.0 ELSE fp / (n - tp - fn) END AS fpr,
         CASE WHEN tp + fn = 0 THEN 0.0 ELSE fn / (tp + fn) END AS fnr,
         precision_weighted, recall_weighted, f1_weighted
  FROM agg),
bqf AS (
  SELECT *, CASE WHEN precision + recall = 0 THEN 0.0 ELSE 2 * precision * recall / (precision + recall) END AS f1
  FROM bq)"""


SQL_BQ_COLUMNS = ("round(accuracy, 6) AS accuracy, round(precision, 6) AS precision, round(recall, 6) AS recall, "
                  "round(f1, 6) AS f1, round(tpr, 6) AS tpr, round(tnr, 6) AS tnr, round(fpr, 6) AS fpr, "
                  "round(fnr, 6) AS fnr, round(precision_weighted, 6) AS precision_weighted, "
                  "round(recall_weighted, 6) AS recall_weighted, round(f1_weighted, 6) AS f1_weighted")
