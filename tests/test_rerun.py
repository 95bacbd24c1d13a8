"""Jobs and streams that run again: commits, the table of latest values, incidents across chunks."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tidemark.operators import alerts, history
from tidemark.sources import commits
from tidemark.streaming import latest

T0 = dt.datetime(2024, 1, 1)


@pytest.fixture()
def db(spark):
    spark.sql("CREATE DATABASE rerundb")
    yield "rerundb"
    spark.sql("DROP DATABASE rerundb CASCADE")


def test_commits_replace_themselves(spark, db):
    a = spark.createDataFrame([("x", 1.0), ("y", 2.0)], "k string, v double")
    for _ in range(2):
        commits.write_commit(a, f"{db}.t", "job@it's day 1")
    commits.write_commit(a.limit(1).withColumn("w", F.lit(5)), f"{db}.t", "job@day 2")  # a new column
    assert sorted((r.commit_id, r.k, r.w) for r in spark.table(f"{db}.t").collect()) == [
        ("job@day 2", "x", 5), ("job@it's day 1", "x", None), ("job@it's day 1", "y", None)]
    commits.write_commit(a.limit(0), f"{db}.t", "job@it's day 1")  # the rerun has no rows
    assert [r.commit_id for r in spark.table(f"{db}.t").collect()] == ["job@day 2"]
    with pytest.raises(TypeError):
        commits.write_commit(a.withColumn("v", F.lit("text")), f"{db}.t", "job@day 3")


def test_a_broken_run_isnt_read_until_it_is_repeated(spark, db):
    rows = spark.createDataFrame([(1,)], "v int")
    tables = {f"{db}.a": rows, f"{db}.b": rows}
    commits.run_commit(spark, f"{db}.done", "job@1", tables)
    commits.write_commit(rows, f"{db}.a", "job@2")  # broken before the second table
    read = lambda t: [r.commit_id for r in commits.committed(spark, t, f"{db}.done").orderBy("commit_id").collect()]
    assert read(f"{db}.a") == read(f"{db}.b") == ["job@1"]
    for _ in range(2):
        commits.run_commit(spark, f"{db}.done", "job@2", tables)
    assert read(f"{db}.a") == read(f"{db}.b") == ["job@1", "job@2"]


def test_history_append_completes_a_batch_once(spark, db):
    batch = spark.createDataFrame([(T0, f"s{i}", T0, i % 2, 3) for i in range(6)], history.HISTORY_SCHEMA)
    history.append_history(batch.where("series_id < 's4'"), f"{db}.h", once=True)
    for _ in range(2):
        history.append_history(batch, f"{db}.h", once=True)
    assert sorted(r.series_id for r in spark.table(f"{db}.h").collect()) == [f"s{i}" for i in range(6)]


def history_rows(spark, n, seed):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        series = "hot" if i % 3 == 0 else f"s{rnd.randrange(20)}"
        day = T0 + dt.timedelta(days=rnd.randrange(70))
        rows.append((series, day, rnd.randrange(2), T0 + dt.timedelta(minutes=rnd.randrange(200)), i, rnd.randrange(2)))
    return spark.createDataFrame(rows, "series_id string, timestamp timestamp_ntz, prediction int, inserted_at timestamp_ntz, "
                                       "insert_seq long, model_version int")


def test_latest_table_of_batches_in_any_order(spark, db):
    rows = history_rows(spark, 600, 4)
    latest.create_latest(spark, f"{db}.latest", 4)
    for part in (2, 0, 1, 0):  # one batch comes twice
        latest.merge_latest(rows.where(F.col("insert_seq") % 3 == part), f"{db}.latest")
    want = {(r.series_id, r.timestamp): r.prediction for r in
            history.latest_per_series(rows, "2024-03-20 00:00:00", 30, 1, "insert_seq").collect()}
    got = latest.read_latest(spark, f"{db}.latest", "2024-03-20 00:00:00", 30, 1).collect()
    assert len(got) == len(want) and {(r.series_id, r.timestamp): r.prediction for r in got} == want
    latest.merge_latest(rows.limit(0), f"{db}.latest")
    assert spark.table(f"{db}.latest").count() == rows.select("model_version", "series_id", "timestamp").distinct().count()


def test_truth_joins_the_latest_table_without_an_exchange(spark, db, monkeypatch):
    latest.create_latest(spark, f"{db}.latest", 4)
    latest.merge_latest(history_rows(spark, 200, 1), f"{db}.latest")
    truth = spark.createDataFrame([("hot", 1)] + [(f"s{i}", i % 2) for i in range(20)], "series_id string, target int")
    latest.write_truth(truth, f"{db}.truth", 4)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = spark.table(f"{db}.truth").join(latest.read_latest(spark, f"{db}.latest", "2024-03-20 00:00:00", 90, 1), "series_id")
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert "Join" in plan and "Exchange" not in plan
        assert "PartitionFilters" in plan and joined.count() > 0
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def brute_incidents(starts, close):
    out = []
    for t in sorted(starts):
        if out and t - out[-1][-1] < close:
            out[-1].append(t)
        else:
            out.append([t])
    return sorted((i[0], i[-1] + dt.timedelta(seconds=60), len(i), i[-1] + close) for i in out)


@pytest.mark.parametrize("chunk", ["7 days", "30 days", "1 hour"])
def test_incidents_across_chunks(spark, chunk):
    rnd, close = random.Random(8), dt.timedelta(days=7)
    series = {"hot": set(), "rare": set(), "exact": {0, 7 * 1440, 14 * 1440 - 1}}
    at = 0
    for _ in range(1500):  # a hot series: long runs, and gaps around the limit
        at += rnd.choice([1, 5, 600, 3000, 7 * 1440 - 1, 7 * 1440, 7 * 1440 + 1])
        series["hot"].add(at)
    for _ in range(12):
        series["rare"].add(rnd.randrange(400_000))
    rows = [(s, T0 + dt.timedelta(minutes=m)) for s, times in series.items() for m in times]
    f = spark.createDataFrame(rows, "m string, period_start timestamp_ntz").selectExpr(
        "m", "period_start", "period_start + interval 60 seconds as period_end", "true as fires")
    quiet = f.limit(5).selectExpr("m", "period_start + interval 1 day as period_start", "period_end", "false as fires")
    got = {}
    for r in alerts.incidents(f.unionByName(quiet).repartition(5), ["m"], "7 days", chunk).collect():
        got.setdefault(r.m, []).append((r.opened_at, r.last_firing_end, r.firing_periods, r.closes_at))
    for s, times in series.items():
        assert sorted(got[s]) == brute_incidents([T0 + dt.timedelta(minutes=m) for m in times], close), s
    assert alerts.incidents(f.limit(0), ["m"]).collect() == []
