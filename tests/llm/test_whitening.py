import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tidemark.llm import whitening

SCHEMA = "vec_id long, embedding array<float>, label int, v string, id int, deviation string"


def check(df, count=8, dims=None):
    """Against numpy on all vectors: exact deviations, whitened up to the sign of the component."""
    rows = whitening.whiten(df, count).collect()
    kept = [(r.vec_id, r.embedding) for r in df.collect()
            if r.embedding and all(c is not None and np.isfinite(c) for c in r.embedding) and len(r.embedding) == dims]
    x = np.array([[int(np.floor(float(c) * 1024)) + 100000 for c in v] for _, v in kept], object)
    n, total = len(x), x.sum(axis=0)
    centred = (n * x - total).astype(float) / n
    values, vectors = np.linalg.eigh(centred.T @ centred / n)
    order = np.argsort(-values)[:count]
    order = order[values[order] > 1e-9]
    white = centred @ vectors[:, order] / np.sqrt(values[order])
    deviation = ((n * x - total) ** 2).sum(axis=1)
    assert len(rows) == n * len(order)
    assert {r.n for r in rows} == {n} and max(r.identity_error for r in rows) < 1e-9
    for c in range(len(order)):
        got = sorted((str(r.vec_id), int(r.deviation), r.whitened, r.explained) for r in rows if r.component == c + 1)
        best = min((max(abs(g[2] - w[2]) for g, w in zip(got, want)), want) for want in (
            sorted((str(i), int(d), s * w) for (i, _), d, w in zip(kept, deviation, white[:, c])) for s in (1, -1)))
        assert best[0] < 1e-8 and [g[:2] for g in got] == [w[:2] for w in best[1]]
        assert abs(got[0][3] - values[order[c]] / values.sum()) < 1e-9
    return rows


@pytest.fixture(scope="module")
def vectors(spark):
    rng = np.random.default_rng(5)
    base = rng.normal(size=(700, 6)) * [5, 4, 3, 2, 1, 0.5] + [0, 100, -3, 0, 0, 1e4]
    rows = [(i, [float(c) for c in v], 0, "x", 1, "y") for i, v in enumerate(base)]
    rows += [(7000, None, 0, None, 0, None), (7001, [1.0] * 5 + [None], 0, "", 0, ""), (7002, [float("nan")] * 6, 0, "", 0, ""),
             (7003, [float("inf")] + [0.0] * 5, 0, "", 0, ""), (7004, [], 0, "", 0, ""), (7005, [1.0, 2.0], 0, "", 0, ""),
             (None, rows[0][1], 0, "", 0, "")]
    return spark.createDataFrame(rows, SCHEMA).repartition(5)


def test_against_numpy(vectors, monkeypatch):
    check(vectors, 8, 6)
    monkeypatch.setattr(whitening, "BLOCK_BYTES", 1)  # blocks of 64 rows
    check(vectors, 3, 6)


def test_given_table(spark, sf_small):
    check(spark.read.parquet(f"{sf_small}/embeddings.parquet"), 8, 64)


def test_no_variance_and_empty_tables(spark):
    same = spark.createDataFrame([(i, [1.0, 2.0, float(i % 2)], 0, "", 0, "") for i in range(10)], SCHEMA)
    assert {r.component for r in check(same, 8, 3)} == {1}
    for rows in ([], [(1, [1.0, 2.0], 0, "", 0, "")], [(1, None, 0, "", 0, "")], [(i, [3.0], 0, "", 0, "") for i in range(5)]):
        assert whitening.whiten(spark.createDataFrame(rows, SCHEMA)).collect() == []


def test_huge_entries_stay_exact(spark):
    rows = [(i, [float(i) * 2.0 ** 30, float(i * i % 7), 1e30 if i == 3 else 0.0], 0, "", 0, "") for i in range(9)]
    out = whitening.whiten(spark.createDataFrame(rows, SCHEMA)).collect()
    assert len({r.vec_id for r in out}) == 9 and all(r.deviation is not None for r in out)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.integers(0, 2 ** 40), min_size=3, max_size=3), min_size=1, max_size=150))
def test_bit_sliced_products_are_exact(rows):
    y = np.array(rows, np.int64)
    cross = whitening.cross_products(whitening.bit_planes(y, max(1, int(y.max()).bit_length())))
    want = y.astype(object).T @ y.astype(object)
    assert all(cross[i, j] == want[i, j] for i in range(3) for j in range(i, 3))
