"""Every registered query against its SQL twin (DuckDB) on the smallest tables."""

import pytest

import __spark_entry__ as entry
from tests.oracle import compare, duck

SQL = entry.oracle_sql()
QUERIES = entry.queries()


@pytest.fixture(scope="module")
def con(sf_small):
    return duck(sf_small)


@pytest.mark.parametrize("name", sorted(SQL))
def test_matches_sql(spark, sf_small, con, name):
    r = compare(spark, sf_small, name, QUERIES[name], SQL[name], con)
    assert r["cols"], (r["spark_cols"], r["sql_cols"])
    assert r["rows"][0] == r["rows"][1]
    assert r["values"], r["sample"]
    assert not r["types"], r["types"]


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_rows_only(spark, sf_small, name):
    assert QUERIES[name](spark, sf_small).count() >= 1


def test_entry(spark):
    df = entry.entry(spark)
    rows = df.collect()
    assert len(rows) == 1 and "performance_alert" in df.columns


@pytest.mark.parametrize("sf,accuracy,precision", [("sf0.01", 0.549128, 0.541048), ("sf0.001", 0.508621, 0.577453)])
def test_flagship_matches_surveyed_values(spark, sf, accuracy, precision):
    """Values probed independently when the build was planned (accuracy, weighted precision, alert)."""
    r = QUERIES["latest_prediction_quality"](spark, f"/root/testdata/{sf}").first()
    assert r["accuracy"] == pytest.approx(accuracy, abs=1e-6)
    assert r["precision_weighted"] == pytest.approx(precision, abs=1e-6)
    assert r["performance_alert"] is True
