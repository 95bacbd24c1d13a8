"""Exact quantiles from a sketch and the values that it leaves open; correlations of many columns."""

import numpy as np
import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import __spark_entry__ as entry
from tidemark.operators import clean, profile
from tidemark.plans import quantiles

INF, NAN = float("inf"), float("nan")
PROBS = {"a": 0.0, "b": 0.1, "c": 0.5, "d": 0.501, "e": 0.99, "f": 1.0}


def check(df, pdf, cols, group=None):
    got = {(r[group] if group else None, r["column"]): r for r in quantiles.column_profile(df, cols, PROBS, group).collect()}
    for key, part in (pdf.groupby(group, dropna=False) if group else [(None, pdf)]):
        for c in cols:
            row, values = got[None if key is None or key != key else key, c], part[c].dropna().astype("float64")
            assert row["count"] == len(values)
            for name, p in PROBS.items():
                if len(values):
                    assert row[name] == pytest.approx(values.quantile(p), rel=1e-12)
                else:
                    assert row[name] is None


@pytest.fixture(scope="module")
def numbers(spark):
    rng = np.random.default_rng(2)
    n = 30_000
    pdf = pd.DataFrame({"g": rng.choice(["x", "y", "z"], n, p=[0.9, 0.0995, 0.0005]), "skewed": np.exp(rng.normal(0, 4, n)),
                        "ties": rng.integers(0, 4, n).astype(float), "whole": rng.integers(-5, 2 ** 40, n),
                        "hot": np.where(rng.random(n) < 0.4, 7.0, rng.normal(7, 1, n))})
    pdf.loc[pdf.index % 11 == 0, "skewed"] = np.nan
    pdf["g"] = pdf["g"].astype(object).where(pdf.index % 17 != 0, None)
    df = spark.createDataFrame(pdf).repartition(6)
    return df.withColumn("skewed", F.nanvl("skewed", F.lit(None))), pdf


@pytest.mark.parametrize("accuracy", [100, 10_000])
def test_against_pandas(numbers, monkeypatch, accuracy):
    df, pdf = numbers
    monkeypatch.setattr(quantiles, "ACCURACY", accuracy)
    monkeypatch.setattr(quantiles, "MARGIN", 3 / accuracy)
    check(df, pdf, ["skewed", "ties", "whole", "hot"])
    check(df, pdf, ["skewed", "hot", "whole"], "g")


def test_missed_brackets_are_widened(numbers, monkeypatch):
    df, pdf = numbers
    monkeypatch.setattr(quantiles, "ACCURACY", 20)  # rough, and no margin for it
    monkeypatch.setattr(quantiles, "MARGIN", 1e-9)
    margins, inner = [], quantiles._quantiles
    monkeypatch.setattr(quantiles, "_quantiles", lambda *a: margins.append(a[-1]) or inner(*a))
    check(df, pdf, ["skewed", "hot"])
    assert len(margins) > 1


def test_infinite_values_and_names_that_clash(spark):
    rows = [(g, v, v) for g in (1, None) for v in (-INF, -INF, 1.0, 2.0, 3.0, INF, NAN, None)]
    df = spark.createDataFrame(rows, "value int, n double, cell double")
    for r in quantiles.exact_quantiles(df, "n", {"lo": 0.0, "m": 0.5, "hi": 1.0}, "value").collect():
        assert (r.lo, r.m, r.hi) == (-INF, 1.5, INF)
    assert {r["column"] for r in quantiles.column_quantiles(df, ["n", "cell"], {"m": 0.5}, ["value"]).collect()} == {"n", "cell"}


def test_whole_numbers_beyond_doubles_stay_apart(spark):
    big = 2 ** 53
    df = spark.createDataFrame([(big,), (big + 1,), (big + 1,)], "v long")
    assert clean.column_stats(df, ["v"], "mode") == {"v": big + 1}
    side = profile.data_quality(df, df, ["v"]).collect()
    assert {r["distinct"] for r in side} == {2}


def test_empty_and_all_null_columns(spark):
    void = spark.createDataFrame([], "v double, g string")
    assert quantiles.exact_quantiles(void, "v", {"m": 0.5}).first().m is None
    assert quantiles.exact_quantiles(void, "v", {"m": 0.5}, "g").collect() == []
    nulls = spark.createDataFrame([(None, "a")], "v double, g string")
    assert profile.describe(nulls, ["v"]).first()["count"] == 0
    assert quantiles.column_quantiles(nulls, ["v"], {"m": 0.5}).collect() == []


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.one_of(st.none(), st.floats(-1e6, 1e6), st.sampled_from([0.0, 1.0])), min_size=1, max_size=40))
def test_any_values(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "v double")
    check(df, pd.DataFrame({"v": pd.Series(values, dtype="float64")}), ["v"])


def test_describe_scans_twice_and_writes_no_values(spark, sf_small, monkeypatch):
    written = []
    monkeypatch.setattr(quantiles, "pin", lambda df, name: written.append((name, df)) or entry_pin(df, name))
    from tidemark.session import pin as entry_pin

    li = spark.range(0, 400_000, numPartitions=4).selectExpr("id * 1.5 as a", "cast(hash(id) as double) as b")
    q = profile.describe(li, ["a", "b"])
    assert [name for name, _ in written] == ["brackets"]
    kept = written[0][1].where("value is not null").count()
    assert kept < 2 * 3 * 400_000 * 12 / quantiles.ACCURACY
    plan = q._jdf.queryExecution().executedPlan().toString()
    assert "Range (" not in plan and "rangepartitioning" not in plan
    row = {r["column"]: r for r in q.collect()}["a"]
    assert (row["25%"], row["50%"], row["75%"]) == (1.5 * 399_999 / 4, 1.5 * 399_999 / 2, 1.5 * 399_999 * 3 / 4)


def test_correlation_of_100_columns_is_one_aggregate(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(300, 100)) + rng.normal(size=(300, 1))
    x[:, 7] = 4.0
    x[rng.random(x.shape) < 0.05] = np.nan
    pdf = pd.DataFrame(x, columns=[f"c{i}" for i in range(100)])
    out = profile.correlation_matrix(spark.createDataFrame(pdf))
    assert out._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 1
    want = pdf.corr()
    got = out.collect()
    assert len(got) == 100 * 100
    for r in got:
        w = want.loc[r.col_a, r.col_b]
        assert r["corr"] is None and (w != w or "c7" in (r.col_a, r.col_b)) or r["corr"] == pytest.approx(w, abs=1e-9)
        if r.col_a == r.col_b and r.col_a != "c7":
            assert r["corr"] == 1.0
