"""Physical-plan properties: pruning, pushdown, no sort aggregation in the flagship, bounded broadcasts."""

import __spark_entry__ as entry

# the core's own queries: those of the optional subpackage have tests of their own
Q = {name: fn for name, fn in entry.queries().items() if name != "pipeline" and not name.startswith("op")}


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_flagship_prunes_columns_and_pushes_lookback(spark, sf_small):
    plan = _plan(Q["latest_prediction_quality"](spark, sf_small))
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz,user_id:bigint,value:double>" in plan or \
        "event_id:bigint,ts:timestamp_ntz,user_id:bigint,value:double" in plan
    assert "props" not in plan and "event_type" not in plan  # unused columns never read
    assert "GreaterThan" in plan or "GreaterThanOrEqual" in plan  # look-back reaches the scan
    assert "SortAggregate" not in plan


def test_lookback_filter_pushed(spark, sf_small):
    plan = _plan(Q["lookback_version_rows"](spark, sf_small))
    assert "PushedFilters: [IsNotNull(ts)" in plan


def test_membership_pushed(spark, sf_small):
    plan = _plan(Q["membership_filters"](spark, sf_small))
    assert "PushedFilters" in plan and "In(c_nationkey" in plan


def test_no_cartesian_products_or_sort_aggregates_anywhere(spark, sf_small):
    """No registered query plans a cross product, and every aggregate is a hash aggregate
    (streams excluded: they run when built)."""
    for name, fn in Q.items():
        if name.startswith("stream_"):
            continue
        plan = _plan(fn(spark, sf_small))
        assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan, name
        assert "SortAggregate" not in plan, name
