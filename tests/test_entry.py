"""The driver contract: names, SQL twins and registry shape."""

import __spark_entry__ as entry
from tidemark.plans.registry import load_all


def test_every_sql_twin_has_a_query():
    q, s = entry.queries(), entry.oracle_sql()
    assert set(s) <= set(q)
    assert len(q) >= 100 and len(s) >= 100


def test_queries_are_documented_and_named():
    for name, fn in entry.queries().items():
        assert fn.__doc__, name
    core, _ = load_all()
    assert not [name for name in core if name.startswith("op") or "pipeline" in name]
