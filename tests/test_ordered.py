"""The ordered plan and the null, NaN and empty-side rules of the statistics on it."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from tidemark.operators import clean, drift, profile, quality
from tidemark.plans import ordered, quantiles
from tidemark.sources import catalog

NAN = float("nan")
ORDERED_QUERIES = [
    "train_test_split_orders", "split_sizes_orders", "train_rows_without_split", "train_test_concat", "fraction_sample_customers",
    "blank_first_rows_orders", "training_table_documents", "roc_auc_documents", "interpolate_order_prices", "interpolate_event_series",
    "modified_zscore_outliers_events", "impute_outliers_median", "remove_outliers_iqr", "box_stats_event_value", "describe_lineitem",
    "central_values_lineitem", "quantiles_totalprice_by_status", "ks_drift_lineitem", "wasserstein_drift_lineitem"]


@pytest.mark.parametrize("buckets", [None, 1, 2, 16])
def test_rank_of_null_keys_and_groups(spark, buckets):
    df = spark.createDataFrame([(1, 3), (1, None), (1, 5), (None, 2), (None, None), (2, 9)], "g int, k int")
    got = {(r.g, r.k): (r._rank, r.n) for r in ordered.global_rank(df, ["k"], ["g"], buckets, total_col="n").collect()}
    assert got == {(1, None): (1, 3), (1, 3): (2, 3), (1, 5): (3, 3), (None, None): (1, 2), (None, 2): (2, 2), (2, 9): (1, 1)}
    whole = [r.k for r in ordered.global_rank(df, ["k", "g"], n_buckets=buckets).orderBy("_rank").collect()]
    assert whole == [None, None, 2, 3, 5, 9]


def test_equal_first_column_and_long_strings_spread(spark):
    df = spark.range(4000).selectExpr("1 as a", "concat('customer-', id) as s")
    rows = ordered.ranged(df, ["a", "s"], 8)
    sizes = [r["count"] for r in rows.groupBy(ordered.BUCKET).count().collect()]
    assert len(sizes) == 8 and max(sizes) < 4000 / 8 * 2
    ranked = ordered.global_rank(df, ["a", "s"], n_buckets=8).select("s", "_rank").collect()
    assert [r.s for r in sorted(ranked, key=lambda r: r._rank)] == sorted(f"customer-{i}" for i in range(4000))


def test_quantiles_skip_nan_and_keep_null_groups(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 2.0), ("a", 3.0), ("a", NAN), ("a", None), (None, 7.0), (None, 9.0)], "g string, v double")
    got = {r.g: r.m for r in quantiles.exact_quantiles(df, "v", {"m": 0.5}, ["g"]).collect()}
    assert got == {"a": 2.0, None: 8.0}


@pytest.mark.parametrize("buckets", [1, 3, 20])
def test_running_totals_and_next_values(spark, buckets):
    rows = [(None, 1.0, 2), (None, 4.0, 1), ("x", 2.0, 5), ("z", 0.5, 1)] + [("y", float(i), i % 3) for i in range(60)]
    vc = spark.createDataFrame(rows, "g string, v double, n int")
    got = {(r.g, r.v): (r.n_before, r.n_upto, r.n_total, r.next) for r in
           ordered.running_totals(vc, "v", ["n"], ["g"], buckets, next_col="next").collect()}
    want = {}
    for g in (None, "x", "y", "z"):
        values, sofar = sorted((v, n) for k, v, n in rows if k == g), 0
        total = sum(n for _, n in values)
        for i, (v, n) in enumerate(values):
            want[g, v] = (sofar, sofar + n, total, values[i + 1][0] if i + 1 < len(values) else None)
            sofar += n
    assert got == want


def test_one_exchange_of_data_rows(spark, sf_small):
    """What the ordered table is read for afterwards: no exchange but of ranges' edges and sums."""
    li = spark.read.parquet(f"{sf_small}/lineitem.parquet")
    plans = {
        "rank": ordered.global_rank(li, ["l_orderkey", "l_linenumber"], ["l_returnflag"], total_col="n"),
        "totals": ordered.running_totals(li.groupBy("l_returnflag", "l_extendedprice").count(), "l_extendedprice", ["count"],
                                         ["l_returnflag"], next_col="next"),
        "interpolation": clean.interpolate_linear(li, "l_quantity", ["l_orderkey", "l_linenumber"], "l_returnflag")}
    for name, df in plans.items():
        main = []  # the path from the result down to the widest scan, without what is broadcast
        for line in df._jdf.queryExecution().executedPlan().toString().splitlines():
            if "BroadcastExchange" in line:
                break
            main.append(line)
        assert any("Window" in x for x in main) and not any("Exchange" in x for x in main), name
        assert "Bucketed: true" in df._jdf.queryExecution().executedPlan().toString()


def test_tasks_of_100_terabytes():
    assert 100 * 10 ** 12 / ordered.buckets_for(100 * 10 ** 12) <= 10 ** 9
    assert ordered.buckets_for(10 ** 12) == 10 ** 12 // (64 << 20) and ordered.buckets_for(0) == 8


def _lines(df):
    return [x.strip() for x in df._jdf.queryExecution().executedPlan().toString().splitlines()]


@pytest.mark.parametrize("name", ORDERED_QUERIES)
def test_no_data_rows_go_to_one_partition(spark, sf_small, name):
    lines = _lines(entry.queries()[name](spark, sf_small))
    for line, below in zip(lines, lines[1:]):
        if "Exchange SinglePartition" in line:  # only sums of what tasks have added up
            assert "Aggregate" in below or "Project" in below and "Aggregate" in lines[lines.index(below) + 1], (name, below)


def test_interpolation_keeps_null_series(spark):
    df = spark.createDataFrame([(None, 1, 1.0), (None, 2, None), (None, 3, 3.0), ("a", 1, 5.0)], "s string, t int, v double")
    got = {(r.s, r.t): r.v for r in clean.interpolate_linear(df, "v", "t", "s").collect()}
    assert got == {(None, 1): 1.0, (None, 2): 2.0, (None, 3): 3.0, ("a", 1): 5.0}


def test_one_nan_is_no_outlier_and_makes_none(spark):
    df = spark.createDataFrame([(float(i % 5),) for i in range(50)] + [(NAN,), (100.0,)], "v double")
    assert [r.v for r in clean.zscore_outliers(df, "v").collect()] == [100.0]
    assert [r.v for r in clean.modified_zscore_outliers(df, "v").collect()] == [100.0]
    assert clean.remove_outliers(df, "v").count() == 50 and clean.remove_outliers(df, "v", "std", 3.0).count() == 50
    assert profile.box_stats(df, "v").first()["outliers"] == 1
    grouped = df.withColumn("g", F.lit(None).cast("string"))
    assert [r.v for r in clean.zscore_outliers(grouped, "v", "g").collect()] == [100.0]
    assert [r.v for r in clean.modified_zscore_outliers(grouped, "v", "g").collect()] == [100.0]


def test_correlation_is_pairwise_complete(spark):
    df = spark.createDataFrame([(1.0, 2.0, 1.0), (2.0, 4.0, 1.0), (3.0, NAN, 1.0), (4.0, 8.0, 1.0)], "a double, b double, c double")
    got = {(r.col_a, r.col_b): r["corr"] for r in profile.correlation_matrix(df).collect()}
    assert got["a", "b"] == pytest.approx(1.0) and got["a", "a"] == pytest.approx(1.0)
    assert got["c", "c"] is None or got["c", "c"] != got["c", "c"]


def test_describe_of_counts(spark):
    values = [1.0, 2.0, 2.0, 5.0, None, NAN]
    df = spark.createDataFrame([(v, 7) for v in values], "v double, w int")
    got = {r["column"]: r for r in profile.describe(df).collect()}
    assert got["v"]["count"] == 4 and got["v"]["mean"] == 2.5 and got["v"]["std"] == pytest.approx(3 ** 0.5)
    assert got["w"]["count"] == 6 and got["w"]["std"] == 0 and got["w"]["50%"] == 7


def test_filled_whole_numbers_become_double(spark):
    df = spark.createDataFrame([(1, 5), (2, 5), (None, 5), (2, 5)], "a int, b int")
    out = clean.fill_missing(df, method="mean")
    assert dict(out.dtypes) == {"a": "double", "b": "int"}
    assert sorted(r.a for r in out.collect()) == pytest.approx([1.0, 5 / 3, 2.0, 2.0])
    assert dict(clean.impute(df, "most_frequent").dtypes)["a"] == "int"


def test_quality_of_labelled_pairs_only(spark):
    auc = spark.createDataFrame([(1, 0.9), (0, 0.1), (None, 0.95)], "y int, s double")
    assert quality.roc_auc(auc, "y", "s").first()["roc_auc"] == 1.0
    reg = spark.createDataFrame([(1.0, 1.5), (2.0, 1.5), (30.0, None), (None, 4.0)], "y double, p double")
    assert quality.regression_quality(reg, "y", "p").first()["r2"] == pytest.approx(0.0)


@pytest.mark.parametrize("empty", ["reference", "current"])
def test_drift_of_an_empty_side_is_none(spark, empty):
    full = spark.createDataFrame([(1.0, "a"), (2.0, "b"), (3.0, "a")], "x double, c string")
    void = spark.createDataFrame([(None, None)], "x double, c string")
    ref, cur = (void, full) if empty == "reference" else (full, void)
    for num in drift.NUMERIC_TESTS:
        for r in drift.drift_report(ref, cur, ["x"], num_stattest=num, cat_stattest="psi").collect():
            assert r.drift_score is None and r.drift_detected is False, num
    for cat in drift.CATEGORICAL_TESTS:
        for r in drift.drift_report(ref, cur, categorical=["c"], num_stattest="ks", cat_stattest=cat).collect():
            assert r.drift_score is None and r.drift_detected is False, cat


def test_z_test_needs_two_categories(spark):
    three = spark.createDataFrame([("a",), ("b",), ("c",)], "c string")
    with pytest.raises(Exception, match="two categories"):
        drift.drift_report(three, three, categorical=["c"], cat_stattest="z").collect()


def test_drift_keys(spark):
    rep = spark.createDataFrame([("x", "ks", 0.5, 0.1, True), ("y", "ks", 0.01, 0.1, False)],
                                "feature string, stattest string, drift_score double, threshold double, drift_detected boolean")
    row = drift.drift_metrics(rep, ["x", "y"]).first().asDict()
    assert row == {"drift_detected": True, "drift_score": 0.5, "number_of_drifted_columns": 1, "number_of_columns": 2,
                   "x__drift_score": 0.5, "x__drift_detected": True, "y__drift_score": 0.01, "y__drift_detected": False}


def test_append_with_other_columns_is_an_error(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS appenddb")
    catalog.append_table(spark.range(2).toDF("a"), "appenddb.t")
    with pytest.raises(ValueError, match="columns"):
        catalog.append_table(spark.range(2).selectExpr("id as a", "id as b"), "appenddb.t")
    spark.sql("DROP DATABASE appenddb CASCADE")


def test_no_frame_is_computed_anew_for_every_row(spark):
    df = spark.createDataFrame([("a", 1, 1.0), ("a", 2, None), ("b", 1, 3.0)], "s string, t int, v double")
    plans = [clean.interpolate_linear(df, "v", "t"), clean.interpolate_linear(df, "v", "t", "s"),
             ordered.global_rank(df, ["t"], ["s"], total_col="n"),
             ordered.running_totals(df.groupBy("s", "t").count(), "t", ["count"], ["s"], next_col="next")]
    for df in plans:
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "specifiedwindowframe(RowFrame" in plan
        assert not any(f"{lower}, unboundedfollowing$()" in plan for lower in ("currentrow$()", "1", "0"))


@pytest.mark.parametrize("buckets", [1, 3, 16])
def test_interpolation_across_ranges(spark, buckets):
    """Gaps at both ends of a series, inside a range and over whole ranges."""
    known = {i: float(i * i % 97) for i in range(200) if 20 <= i < 180 and i % 50 < 4}
    df = spark.createDataFrame([(i, known.get(i)) for i in range(200)], "t int, v double")
    got = {r.t: r.v for r in clean.interpolate_linear(df, "v", "t", n_buckets=buckets).collect()}
    at = sorted(known)
    for i in range(200):
        before, after = [k for k in at if k <= i], [k for k in at if k >= i]
        if not before:
            assert got[i] is None
        elif not after:
            assert got[i] == known[before[-1]]
        else:
            a, b = before[-1], after[0]
            assert got[i] == pytest.approx(known[a] if a == b else known[a] + (known[b] - known[a]) * (i - a) / (b - a))


def test_ranges_hold_unpacked_rows(spark, tmp_path, monkeypatch):
    """A range is sized by its rows in memory, not by their bytes in the file."""
    monkeypatch.setattr(ordered, "BYTES_PER_BUCKET", 64 << 10)
    spark.range(200_000).select(F.rand(1).alias("v")).write.parquet(str(tmp_path / "t"))
    n = ordered.bucket_count(spark.read.parquet(str(tmp_path / "t")))
    assert 200_000 / n * 100 <= 64 << 10
