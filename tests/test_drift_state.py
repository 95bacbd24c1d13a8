"""Daily drift states: merging, late and repeated days, and the rules for values without a bin."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidemark.operators import drift, drift_state

D = dt.date
NAN, INF = float("nan"), float("inf")


@pytest.fixture()
def db(spark):
    spark.sql("CREATE DATABASE statedb")
    yield "statedb"
    spark.sql("DROP DATABASE statedb CASCADE")


def rows(spark, n, start=0, shift=0.0):
    return spark.range(start, start + n).selectExpr(
        "date_add(DATE'2024-01-20', cast(id % 40 as int)) as day", f"cast(id * 7919 % 101 as double) + {shift} as x",
        "if(id % 13 = 0, null, id % 5) as k", "concat('c', id % 3) as c")


def build(spark, name, ref, batches):
    drift_state.create_states(spark, name, drift_state.reference_bins(ref, ["x", "k"], 10))
    bins = spark.table(drift_state.bins_table(name))
    for b in batches:
        drift_state.put_days(drift_state.daily_states(b, F.col("day"), bins, ["x", "k"], ["c"]), name)
    return spark.table(name)


def test_merged_states_equal_the_raw_rows(spark, db):
    ref, cur = rows(spark, 2000), rows(spark, 900, 5000, 30.0).withColumn("day", F.date_add("day", 40))
    states = build(spark, f"{db}.s", ref, [ref, cur])
    a, b = drift_state.merged(states, None, "2024-02-29"), drift_state.merged(states, "2024-02-29", "2025-01-01")
    got = {r.feature: r for r in drift_state.drift_report(a, b, "psi", "chisquare").collect()}
    long = drift.stack_sides(ref, cur, ["x", "k"])
    for r in drift.psi_numeric(long, n_bins=10).collect():
        assert got[r.feature].drift_score == pytest.approx(r.drift_score, abs=1e-12)
    cat = drift.chisquare_test(drift.stack_sides(ref, cur, ["c"], numeric=False)).first()
    assert got["c"].drift_score == pytest.approx(cat.drift_score, abs=1e-12)
    js = {r.feature: r.drift_score for r in drift_state.drift_report(a, b, "jensenshannon").collect()}
    assert js["x"] > 0.1 and 0 <= js["c"] < 0.1
    plan = a._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(quarter" in plan  # quarters outside the range aren't read


def test_late_corrected_and_repeated_days(spark, db):
    all_rows = rows(spark, 2000)
    part = all_rows.where("x < 50")
    once = build(spark, f"{db}.a", all_rows, [all_rows]).orderBy("day", "feature", "cell").collect()
    late = build(spark, f"{db}.b", all_rows, [part, all_rows, all_rows, all_rows.where("day < '2024-02-03'")])
    assert late.orderBy("day", "feature", "cell").collect() == once
    # days that have no rows any more disappear, the others of their months stay
    gone = spark.createDataFrame([(D(2024, 1, 20),), (D(2024, 1, 21),)], "day date")
    empty = drift_state.daily_states(all_rows.limit(0), F.col("day"), spark.table(drift_state.bins_table(f"{db}.b")), ["x", "k"], ["c"])
    drift_state.put_days(empty, f"{db}.b", gone)
    left = {r.day for r in spark.table(f"{db}.b").select("day").distinct().collect()}
    assert min(left) == D(2024, 1, 22) and len(left) == 38
    assert {r.quarter for r in spark.table(f"{db}.b").select("quarter").distinct().collect()} == {D(2024, 1, 1)}
    drift_state.put_days(empty, f"{db}.b", all_rows)
    assert spark.table(f"{db}.b").collect() == []


def test_values_without_a_bin(spark, db):
    day = D(2024, 5, 1)
    ref = spark.createDataFrame([(day, 1.0, None, "a"), (day, 3.0, None, None), (day, INF, None, "a")], "day date, x double, k int, c string")
    cur = spark.createDataFrame([(day, v, 5, "b") for v in (NAN, None, -INF, 0.0, 1.0, 2.0, 3.0, INF)], ref.schema)
    states = build(spark, f"{db}.s", ref, [cur])
    got = {(r.feature, r.cell): r.n for r in states.collect()}
    assert got == {("x", "-"): 2, ("x", "0"): 1, ("x", "5"): 1, ("x", "9"): 1, ("x", "+"): 1, ("k", "+"): 8, ("c", "b"): 8}
    with pytest.raises(Exception, match="without a day"):
        drift_state.put_days(drift_state.daily_states(cur.withColumn("day", F.lit(None)), F.col("day"),
                                                      spark.table(drift_state.bins_table(f"{db}.s")), ["x"]), f"{db}.s")


def test_total_rules_of_statistics(spark):
    """inf, NaN, null and empty sides: every statistic is a number or null, and null is never drift."""
    from tidemark.operators import profile, quality

    hole = spark.createDataFrame([(v,) for v in (1.0, 2.0, 3.0, INF, -INF, NAN, None)], "x double")
    for test in drift.NUMERIC_TESTS:
        r = drift.drift_report(hole, hole, ["x"], num_stattest=test, cat_stattest="psi").first()
        assert r.drift_detected is False and (r.drift_score is None or r.drift_score == r.drift_score), test
        void = drift.drift_report(hole.limit(0), hole, ["x"], num_stattest=test, cat_stattest="psi").collect()
        assert [(v.feature, v.drift_score, v.drift_detected) for v in void] == [("x", None, False)], test
        assert drift.drift_metrics(drift.drift_report(hole.limit(0), hole, ["x"], num_stattest=test, cat_stattest="psi"), ["x"]) \
            .first().number_of_columns == 1
    bins = {r.bin: (r.bin_start, r.bin_end, r["count"]) for r in profile.histogram(hole, "x", 2).collect()}
    assert bins == {-1: (-INF, 1.0, 1), 0: (1.0, 2.0, 1), 1: (2.0, 3.0, 2), 2: (3.0, INF, 1)}
    pairs = spark.createDataFrame([(1, 1), (None, 1), (0, None), (0, 0)], "target int, prediction int")
    assert quality.binary_quality(pairs).first().accuracy == 1.0 and quality.weighted_report(pairs).first().accuracy == 1.0
    assert quality.confusion_matrix(pairs).count() == 2
    none = quality.binary_quality(pairs.limit(0)).first()
    assert none.accuracy is None and none.precision == 0.0
