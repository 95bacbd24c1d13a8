"""Registered queries: catalog sources and sinks, history and model round trips (inventory A5-A12, A14-A16, J15, H7).

Each writes whole tables to a fresh database under the session's shared folder and returns what is read back.
"""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import functions as F

from ..functions.scalar import to_timestamp_if_text
from ..operators import history, model, registry
from ..session import ensure_checkpoint_dir
from ..sources import catalog
from ..sources.testdata import table
from . import domain
from .queries import SQL_HISTORY, register, rounded

AS_OF = dt.datetime(2024, 2, 1, 9, 30, 0, 123456)


def _folder(spark, name: str) -> str:
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def _database(spark) -> str:
    """A fresh database whose tables lie in the shared folder."""
    name = f"tm_{uuid.uuid4().hex[:12]}"
    spark.sql(f"CREATE DATABASE {catalog.quote(name)} LOCATION '{_folder(spark, name)}'")
    return name


@register("csv_round_trip_customer", """
SELECT c_custkey, c_name, round(c_acctbal, 6) AS c_acctbal, c_mktsegment FROM customer
""")
def csv_round_trip_customer(spark, sf_dir):
    """A5: a CSV file with header, read with an explicit schema."""
    path = _folder(spark, "csv")
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_acctbal", "c_mktsegment")
    c.write.option("header", True).csv(path)
    return rounded(catalog.read_csv(spark, path, c.schema))


@register("append_table_orders", """
SELECT o_orderkey, CAST(o_custkey AS VARCHAR) AS o_custkey, o_orderstatus, round(o_totalprice, 6) AS o_totalprice FROM orders
""")
def append_table_orders(spark, sf_dir):
    """A6 + A7: two appends to one table with an explicit column type, the second in another column order."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice")
    name = f"{_database(spark)}.orders"
    catalog.append_table(o.where("o_orderstatus = 'O'"), name, {"o_custkey": "string"})
    catalog.append_table(o.where("o_orderstatus <> 'O'").select("o_totalprice", "o_orderstatus", "o_custkey", "o_orderkey"),
                         name, {"o_custkey": "string"})
    return rounded(spark.table(name))


@register("metrics_table_by_segment", """
SELECT c_mktsegment AS model_name, '1' AS model_version, TIMESTAMP '2024-02-01 00:00:00' AS "timestamp", count(*) AS n,
       CAST(NULL AS DOUBLE) AS mean_balance FROM customer GROUP BY 1
UNION ALL
SELECT c_mktsegment, '2', TIMESTAMP '2024-02-01 00:00:00', count(*), round(avg(c_acctbal), 6) FROM customer GROUP BY 1
""")
def metrics_table_by_segment(spark, sf_dir):
    """Metrics rows appended twice; the second batch brings a new column."""
    name = f"{_database(spark)}.metrics"
    c = table(spark, sf_dir, "customer").groupBy(F.col("c_mktsegment").alias("model_name"))
    at = F.lit("2024-02-01 00:00:00").cast("timestamp_ntz").alias("timestamp")
    first = c.agg(F.count(F.lit(1)).alias("n")).select("model_name", F.lit("1").alias("model_version"), at, "n")
    second = c.agg(F.count(F.lit(1)).alias("n"), F.avg("c_acctbal").alias("mean_balance")) \
        .select("model_name", F.lit("2").alias("model_version"), at, "n", "mean_balance")
    catalog.write_metrics(first, name)
    catalog.write_metrics(second, name)
    return rounded(spark.table(name))


@register("snapshot_renamed_suppliers", """
SELECT 'suppliers_2024_02_01T09_30_00_123Z' AS snapshot, s_suppkey, s_name FROM supplier
""")
def snapshot_renamed_suppliers(spark, sf_dir):
    """A9 + A10 + A11: a snapshot with a time-stamped name, in a new namespace, renamed and read back."""
    db = f"{_database(spark)}_ns"
    catalog.create_namespace(spark, db)
    snapshot = catalog.unique_table_name("suppliers_", AS_OF, db)
    catalog.append_table(table(spark, sf_dir, "supplier").select("s_suppkey", "s_name"), snapshot)
    final = f"{db}.suppliers_{uuid.uuid4().hex[:8]}"
    catalog.rename_table(spark, snapshot, final)
    return spark.table(final).select(F.lit(snapshot.split(".")[1]).alias("snapshot"), "s_suppkey", "s_name")


@register("expired_snapshots_of_parts", """
SELECT 'fresh' AS kept, p_partkey, p_name FROM part
""")
def expired_snapshots_of_parts(spark, sf_dir):
    """Two snapshots with expiry times; the purge drops the old one, the other is read back."""
    db = _database(spark)
    p = table(spark, sf_dir, "part").select("p_partkey", "p_name")
    for name, days in (("old", 1), ("fresh", 30)):
        catalog.append_table(p, f"{db}.{name}")
        catalog.set_expiry(spark, f"{db}.{name}", AS_OF, days)
    catalog.purge_expired(spark, db, AS_OF + dt.timedelta(days=2))
    left = sorted(t.name for t in spark.catalog.listTables(db) if not t.isTemporary)
    out = spark.table(f"{db}.{left[0]}").select(F.lit(left[0]).alias("kept"), "p_partkey", "p_name")
    for name in left[1:]:
        out = out.unionByName(spark.table(f"{db}.{name}").select(F.lit(name).alias("kept"), "p_partkey", "p_name"))
    return out


@register("history_appended_events", f"""
WITH {SQL_HISTORY}
SELECT inserted_at, series_id, "timestamp", prediction, model_version FROM hist
""")
def history_appended_events(spark, sf_dir):
    """A14 + J15: predictions appended to the history by version, after a read of the missing table (empty)."""
    name = f"{_database(spark)}.history"
    h = domain.inference_history(spark, sf_dir)
    missing = history.read_history(spark, name)
    if not missing.isEmpty():
        raise AssertionError("a missing history table reads as empty")
    for part in (h.where("model_version = 0"), h.where("model_version > 0")):
        rows = history.to_history_rows(part, "series_id", "timestamp", "prediction", F.col("model_version"), F.col("inserted_at"))
        history.append_history(rows, name)
    back = history.read_history(spark, name)
    zone_free = lambda c: F.col(c).cast("timestamp_ntz").alias(c)
    return back.select(zone_free("inserted_at"), "series_id", zone_free("timestamp"), "prediction", "model_version")


@register("model_round_trip_documents", """
SELECT doc_id, 2 AS version, true AS same_prediction FROM documents
""")
def model_round_trip_documents(spark, sf_dir):
    """A15 + A16: a model saved, registered as default and loaded again predicts the same for every document."""
    feats = domain.document_features(spark, sf_dir)
    fitted = model.train_classifier(feats.where(F.col("label").isNotNull()), "label", domain.DOC_FEATURES, num_trees=5)
    path = _folder(spark, "model")
    model.save_model(fitted, path)
    reg = spark.createDataFrame([("docs", 1, "nowhere", False), ("docs", 2, path, True)], registry.REGISTRY_SCHEMA)
    loaded, version = model.load_default_model(reg, "docs")
    both = model.score(loaded, model.score(fitted, feats).select("doc_id", *domain.DOC_FEATURES, F.col("prediction").alias("first")))
    return both.select("doc_id", F.lit(version).alias("version"), (F.col("first") == F.col("prediction")).alias("same_prediction"))


@register("order_dates_parsed_if_text", """
SELECT o_orderkey, CAST(o_orderdate AS TIMESTAMP) AS parsed, CAST(o_orderdate AS TIMESTAMP) AS kept FROM orders
""")
def order_dates_parsed_if_text(spark, sf_dir):
    """H7: a text column is parsed to timestamps, a timestamp column stays as it is."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_orderdate").cast("timestamp_ntz").alias("d"))
    o = o.withColumn("t", F.date_format(F.col("d"), "yyyy-MM-dd HH:mm:ss"))
    one = lambda c: to_timestamp_if_text(c, o.schema[c].dataType).cast("timestamp_ntz")
    return o.select("o_orderkey", one("t").alias("parsed"), one("d").alias("kept"))


@register("champion_challenger_regression", """
WITH rev AS (SELECT l_orderkey, sum(l_extendedprice * (1 - l_discount)) AS p FROM lineitem GROUP BY 1),
v AS (SELECT * FROM (VALUES (1), (2), (3)) t(version)),
j AS (SELECT version, o_totalprice AS y, p * (1 + version * 0.02) AS p FROM orders JOIN rev ON o_orderkey = l_orderkey, v),
m AS (SELECT version, avg(abs(p - y)) AS mae, 1 - sum((p - y) * (p - y)) / (var_pop(y) * count(y)) AS r2 FROM j GROUP BY 1),
c AS (SELECT mae AS cm, r2 AS cr FROM m WHERE version = 3)
SELECT 'revenue' AS model, version, mae <= cm OR r2 <= cr AS improved FROM m, c WHERE version <> 3
""")
def champion_challenger_regression(spark, sf_dir):
    """J11 for regression: versions of a revenue estimate against the default one by the regression rules."""
    from ..operators import alerts, quality

    li = table(spark, sf_dir, "lineitem")
    est = li.groupBy("l_orderkey").agg(F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("p"))
    o = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("l_orderkey"), F.col("o_totalprice").alias("y"))
    j = o.join(est, "l_orderkey", "inner").withColumn("version", F.explode(F.array(F.lit(1), F.lit(2), F.lit(3))))
    j = j.withColumn("p", F.col("p") * (1 + F.col("version") * 0.02))
    q = quality.regression_quality(j, "y", "p", ["version"]).select(
        "version", F.lit("revenue").alias("model"), (F.col("version") == 3).alias("is_default"),
        F.col("mae").alias("meanAbsoluteError"), F.col("r2").alias("rSquared"))
    long = alerts.metrics_long(q, ["model", "version", "is_default"])
    rules = spark.createDataFrame(alerts.REGRESSION_CHALLENGE_RULES, "metric_name string, op string")
    return alerts.champion_challenger(long, rules)
