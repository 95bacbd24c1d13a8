"""Selections by counting: exact sizes on ties, nulls and hot keys, and no exchange of data rows."""

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import __spark_entry__ as entry
from tidemark.functions.scalar import seeded_hash
from tidemark.operators import sample
from tidemark.plans import selection

SELECTING = ["train_test_split_orders", "train_rows_without_split", "fraction_sample_customers", "sample_complement_customers",
             "blank_first_rows_orders", "training_table_documents"]


@pytest.mark.parametrize("name", SELECTING)
def test_no_exchange_of_data_rows(spark, sf_small, name):
    plan = entry.queries()[name](spark, sf_small)._jdf.queryExecution().executedPlan().toString()
    if name != "training_table_documents":  # that one joins its two tables
        assert "Exchange" not in plan and "Join" not in plan
    assert "Sort [" not in plan.replace("SortMergeJoin [", "") or name == "training_table_documents"


def test_split_equals_the_sorted_order(spark):
    df = spark.range(0, 5000, numPartitions=5).selectExpr("id as k", "concat('row ', id) as t")
    want = [r.k for r in df.withColumn("h", seeded_hash(3, F.col("k"))).orderBy("h", "k").collect()]
    for fraction in (0.0, 0.0001, 0.2, 0.5, 0.9999, 1.0):
        got = {r.k for r in sample.exact_split(df, "k", fraction, 3).where("split = 'TEST'").collect()}
        n = -(-len(want) * fraction // 1)
        assert got == set(want[:int(n)])


@pytest.mark.parametrize("few", [1, 7, 10_000])
def test_small_steps_find_the_same_rows(spark, monkeypatch, few):
    monkeypatch.setattr(selection, "FEW", few)
    monkeypatch.setattr(selection, "SAMPLE", 40)
    df = spark.range(0, 3000, numPartitions=3).selectExpr("id as k", "id % 10 as g", "if(id % 4 = 0, null, concat('s', id % 300)) as s")
    test = [r.k for r in sample.exact_split(df, "k", 0.31, 9).where("split = 'TEST'").collect()]
    want = [r.k for r in df.withColumn("h", seeded_hash(9, F.col("k"))).orderBy("h", "k").limit(930).collect()]
    assert sorted(test) == sorted(want)
    for n in (0, 1, 17, 750, 751, 1500, 2999, 3000, 4000):
        cut = selection.key_cut(df, [F.col("s"), F.col("k")], n)
        want = {r.k for r in df.orderBy(F.col("s").asc_nulls_first(), "k").limit(n).collect()}
        assert cut.rows == 3000 and {r.k for r in df.where(cut.taken).collect()} == want


def test_repeated_and_null_keys_keep_the_exact_size(spark):
    # a third of the rows without a key, another third with one key; their other columns differ
    df = spark.range(0, 900, numPartitions=4).selectExpr(
        "case when id % 3 = 0 then null when id % 3 = 1 then 7L else id end as k", "id as v")
    for fraction in (0.1, 0.34, 0.5, 0.9):
        flagged = sample.fraction_sample(df, "k", fraction)
        assert flagged.where("in_sample").count() == round(900 * fraction)
        taken, rest = sample.sample_and_rest(df, "k", fraction)
        assert sorted(r.v for r in taken.union(rest).collect()) == list(range(900))
    same = spark.range(10).selectExpr("1 as k", "2 as v")  # equal rows stay together
    assert sample.exact_split(same, "k", 0.2).where("split = 'TEST'").count() in (0, 10)


def test_empty_tables(spark):
    void = spark.createDataFrame([], "k int, v string")
    assert sample.exact_split(void, "k").collect() == [] and sample.fraction_sample(void, "k", 0.5).collect() == []
    assert sample.blank_first_rows(void, 3, ["v"], "k").collect() == []


@settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(st.one_of(st.none(), st.integers(-3, 3)), st.one_of(st.none(), st.sampled_from(["a", "b", ""]))),
                min_size=1, max_size=30), st.integers(0, 31))
def test_first_rows_of_any_keys(spark, rows, n):
    df = spark.createDataFrame([(a, b, i) for i, (a, b) in enumerate(rows)], "a int, b string, i int")
    got = [r.i for r in df.where(selection.key_cut(df, [F.col("a"), F.col("b")], n).taken).collect()]
    key = lambda i: tuple((x is not None, x) for x in rows[i])
    order = sorted(range(len(rows)), key=key)
    assert len(got) == min(n, len(rows)) and sorted(map(key, got)) == [key(i) for i in order[:n]]
