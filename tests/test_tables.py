"""Catalog sources / sinks, registry, model persistence, jobs and streams (temporary warehouse)."""

import datetime as dt
import os
import uuid

import pytest
from pyspark.sql import functions as F

from tidemark.operators import history, model, registry
from tidemark.plans import domain, jobs
from tidemark.session import ensure_checkpoint_dir
from tidemark.sources import catalog

HERE = os.path.dirname(os.path.abspath(__file__))


def _db(spark):
    name = "t_" + uuid.uuid4().hex[:8]
    catalog.create_namespace(spark, name)
    return name


def test_csv_source(spark):
    df = catalog.read_csv(spark, os.path.join(HERE, "resources", "test-resource.csv"), "id int, label int")
    assert df.count() == 10 and df.where("label = 1").count() == 6


def test_sql_with_casts_and_args(spark):
    spark.range(5).createOrReplaceTempView("nums")
    df = catalog.run_sql(spark, "SELECT id, id * 1.5 AS x FROM nums WHERE id > :lo", {"x": "int"}, {"lo": 1})
    assert [r["x"] for r in df.orderBy("id").collect()] == [3, 4, 6]


def test_sql_file_drops_bom():
    text = catalog.query_text("sample_query.sql")
    assert text.startswith("SELECT")


def test_two_table_template_shifts_arguments(spark):
    spark.createDataFrame([(1, 1), (2, 0)], "p2 int, x int").createOrReplaceTempView("p1")
    spark.createDataFrame([(1, 1), (2, 0)], "p3 int, y int").createOrReplaceTempView("p2")
    first, second = catalog.train_test_sources(spark, "p1", "p2", "p3")
    assert first.count() == 1 and second.columns == ["p3", "y"] and second.count() == 1


def test_append_and_metrics_schema_evolution(spark):
    db = _db(spark)
    t = f"{db}.monitor_performance"
    ts = dt.datetime(2024, 2, 1, 9, 0)
    catalog.write_metrics(catalog.metrics_row(spark, "classifier", 2, ts, {"accuracy": 0.8}), t)
    catalog.write_metrics(catalog.metrics_row(spark, "classifier", 2, ts, {"accuracy": 0.7, "performance_alert": False}), t)
    got = spark.table(t)
    assert "performance_alert" in got.columns and got.count() == 2
    with pytest.raises(TypeError):
        catalog.write_metrics(catalog.metrics_row(spark, "classifier", 2, ts, {"accuracy": "high"}), t)
    with pytest.raises(TypeError):
        catalog.python_type_to_spark(object())


def test_unique_name_rename_expiry(spark):
    db = _db(spark)
    as_of = dt.datetime(2024, 2, 1, 9, 30, 15, 123456)
    name = catalog.unique_table_name(f"{db}.training_data_", as_of)
    assert name.endswith("training_data_2024_02_01T09_30_15_123Z")
    catalog.append_table(spark.range(3), name)
    catalog.rename_table(spark, name, f"{db}.renamed")
    catalog.set_expiry(spark, f"{db}.renamed", as_of, 30)
    assert catalog.purge_expired(spark, db, as_of + dt.timedelta(days=10)) == []
    assert catalog.purge_expired(spark, db, as_of + dt.timedelta(days=31)) == [f"{db}.renamed"]


def test_history_missing_table_and_append(spark):
    db = _db(spark)
    t = f"{db}.inference_data_history"
    empty = history.read_history(spark, t)
    assert empty.count() == 0 and empty.columns == ["series_id", "prediction", "timestamp"]
    batch = spark.createDataFrame([(1, 1, "2024-01-01")], "id long, p int, d string")
    rows = history.to_history_rows(batch, "id", F.to_timestamp("d"), "p", 3, dt.datetime(2024, 1, 2))
    history.append_history(rows, t)
    history.append_history(rows, t)
    assert spark.table(t).where("model_version = 3").count() == 2


def test_registry_versions_and_default(spark):
    reg = registry.empty_registry(spark)
    up = spark.createDataFrame([("m", "p1", dt.datetime(2024, 1, 1)), ("m", "p2", dt.datetime(2024, 1, 2))],
                               "model string, path string, uploaded_at timestamp")
    reg = registry.register_versions(reg, up)
    assert sorted(r["version"] for r in reg.collect()) == [1, 2] and reg.where("is_default").count() == 0
    d = registry.set_default(reg)
    assert [r["version"] for r in d.where("is_default").collect()] == [2]
    bad = spark.createDataFrame([("m", 9)], "model string, version int")
    with pytest.raises(Exception):
        registry.set_default(reg, bad).collect()


def test_model_round_trip(spark, sf_small, tmp_path):
    feats = domain.document_features(spark, sf_small).where("label IS NOT NULL")
    fitted = model.train_classifier(feats, "label", domain.DOC_FEATURES, num_trees=5)
    path = os.path.join(ensure_checkpoint_dir(spark), "model-" + uuid.uuid4().hex)
    model.save_model(fitted, path)
    again = model.load_model(path)
    a = fitted.transform(feats).select("doc_id", "prediction").orderBy("doc_id").collect()
    b = again.transform(feats).select("doc_id", "prediction").orderBy("doc_id").collect()
    assert a == b


def test_performance_job_early_exit(spark):
    empty = spark.createDataFrame([], "inserted_at timestamp_ntz, series_id string, timestamp timestamp_ntz, "
                                      "prediction int, model_version int")
    truth = spark.createDataFrame([("1", 1)], "series_id string, target int")
    assert jobs.performance_monitoring(empty, truth, "2024-02-01 00:00:00", "classifier", 2) is None


def test_training_and_inference_jobs(spark, sf_small):
    db = _db(spark)
    feats = domain.document_features(spark, sf_small)
    labelled = feats.where("label IS NOT NULL")
    as_of = dt.datetime(2024, 2, 1, 9, 0)
    root = os.path.join(ensure_checkpoint_dir(spark), "models-" + uuid.uuid4().hex)
    out = jobs.training(spark, labelled, "label", "doc_id", domain.DOC_FEATURES, db, root, "docs", as_of,
                        f"{db}.registry", f"{db}.evaluations")
    assert out["version"] == 1 and spark.catalog.tableExists(out["training_table"])
    out2 = jobs.training(spark, labelled, "label", "doc_id", domain.DOC_FEATURES, db, root, "docs",
                         as_of + dt.timedelta(days=1), f"{db}.registry", f"{db}.evaluations")
    assert out2["version"] == 2 and out2["improved"] in (True, False)
    inf = jobs.inference(spark, feats.drop("label"), "doc_id", domain.DOC_FEATURES, f"{db}.registry", "docs",
                         f"{db}.history", out["training_table"], as_of + dt.timedelta(days=2), db)
    assert spark.table(f"{db}.history").count() == feats.count()
    inf2 = jobs.inference(spark, feats.drop("label"), "doc_id", domain.DOC_FEATURES, f"{db}.registry", "docs",
                          f"{db}.history", out["training_table"], as_of + dt.timedelta(days=3), db)
    assert "prediction_drift" in inf2 and inf2["feature_drift"]["number_of_columns"] == len(domain.DOC_FEATURES)


def test_alert_stream_drops_late_points(spark):
    from tidemark.streaming.alerts import start_alert_stream

    base = ensure_checkpoint_dir(spark) + "/stream-" + uuid.uuid4().hex
    pts = spark.createDataFrame(
        [("m", dt.datetime(2024, 1, 1, 0, 0, 5), True), ("m", dt.datetime(2024, 1, 1, 1, 0, 5), False)],
        "metric string, end_time timestamp, v boolean")
    pts.write.parquet(base + "/src")
    src = spark.readStream.schema(pts.schema).parquet(base + "/src")
    q = start_alert_stream(src, "end_time", "v", ["metric"], base + "/sink", base + "/ckpt")
    q.awaitTermination()
    got = spark.read.parquet(base + "/sink").collect()
    assert len(got) == 1 and got[0]["fires"] is True


def test_incident_stream_over_restarts(spark):
    """Points of one incident arrive in three runs; repeated points of a period count once; the open one is read from state."""
    from tidemark.streaming import alerts as stream

    base, schema = ensure_checkpoint_dir(spark) + "/incidents-" + uuid.uuid4().hex, "m string, t timestamp, v boolean"
    at = lambda h, s=0: dt.datetime(2024, 1, 1) + dt.timedelta(hours=h, seconds=s)
    for rows in ([("a", at(0), True), ("a", at(0, 30), True), ("a", at(1), False)], [("a", at(2), True), ("b", at(2), True)],
                 [("a", at(9), True), ("b", at(9), False)]):
        spark.createDataFrame(rows, schema).write.mode("append").parquet(base + "/src")
        src = spark.readStream.schema(schema).parquet(base + "/src")
        stream.start_incident_stream(src, "t", "v", ["m"], base + "/sink", base + "/ckpt", "3 hours").awaitTermination()
    done = spark.read.parquet(base + "/sink").unionByName(stream.open_incidents(spark, base + "/ckpt", ["m"]))
    got = sorted((r.m, r.opened_at, r.last_firing_end, r.firing_periods, r.closes_at) for r in done.collect())
    assert got == [("a", at(0), at(2, 60), 2, at(5)), ("a", at(9), at(9, 60), 1, at(12)), ("b", at(2), at(2, 60), 1, at(5))]


def test_performance_job_writes_metrics_and_points(spark, sf_small):
    db = _db(spark)
    row = jobs.performance_monitoring(domain.inference_history(spark, sf_small), domain.ground_truth(spark, sf_small),
                                      domain.AS_OF, "classifier", 2, 730, tiebreak="insert_seq",
                                      metrics_table=f"{db}.monitor_performance", points_table=f"{db}.metric_points")
    got = row.first()
    assert got["accuracy"] == pytest.approx(0.508621, abs=1e-6) and got["performance_alert"] is True
    assert spark.table(f"{db}.monitor_performance").count() == 1
    pts = spark.table(f"{db}.metric_points")
    assert pts.where("metric LIKE '%performance_alert' AND bool_value").count() == 1
    assert pts.where("double_value IS NOT NULL").count() == 11


def test_set_default_on_empty_registry_raises(spark):
    with pytest.raises(LookupError):
        registry.set_default(registry.empty_registry(spark))


def test_bucketed_history_reads_without_shuffle(spark, sf_small):
    db = _db(spark)
    t = f"{db}.history_bucketed"
    h = domain.inference_history(spark, sf_small)
    rows = history.to_history_rows(h, "series_id", "timestamp", "prediction", "model_version", "inserted_at")
    history.append_history(rows, t, buckets=4)
    history.append_history(rows, t)  # appends keep the bucketing
    latest = history.latest_per_series(spark.table(t), domain.AS_OF, 730, 2)
    plan = latest._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning" not in plan
    assert latest.count() == history.latest_per_series(rows, domain.AS_OF, 730, 2).count()


def test_reconcile_actions_ignore_keyless_rows(spark):
    from tidemark.operators import alerts

    desired = spark.createDataFrame([("a", 1), ("b", 2)], "intent string, x int")
    existing = spark.createDataFrame([("b", 9), ("c", 3), (None, 4)], "intent string, x int")
    got = {r["intent"]: r["action"] for r in alerts.reconcile(desired, existing).collect()}
    assert got == {"a": "create", "b": "update", "c": "delete"}


def test_metric_points_types(spark):
    row = catalog.metrics_row(spark, "m", 3, dt.datetime(2024, 2, 1, 9), {"accuracy": 0.8, "n": 10,
                                                                       "performance_alert": True, "note": "x"})
    pts = {r["metric"]: r for r in registry.metric_points(row, "p", "loc", "task").collect()}
    assert pts["custom.metrics/accuracy"]["double_value"] == 0.8
    assert pts["custom.metrics/n"]["double_value"] == 10.0
    assert pts["custom.metrics/performance_alert"]["bool_value"] is True
    assert "custom.metrics/note" not in pts  # other types are not metrics


def test_set_default_chosen_version(spark):
    reg = spark.createDataFrame([("m", 1, "p1", True), ("m", 2, "p2", False), ("k", 1, "q1", True)],
                                "model string, version int, path string, is_default boolean")
    out = registry.set_default(reg, spark.createDataFrame([("m", 2)], "model string, version int"))
    got = {(r["model"], r["version"]): r["is_default"] for r in out.collect()}
    assert got == {("m", 1): False, ("m", 2): True, ("k", 1): True}
