import numpy as np
import pytest

from tidemark.llm import ann


def brute(ids, x, q, k=10):
    d = np.sqrt(((x - x[q]) ** 2).sum(1))
    return [(int(ids[j]), d[j]) for j in np.lexsort((ids, d)) if ids[j] != ids[q]][:k]


def frame(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int, id int, v string, part int, score string")


def test_recall_and_scores(spark, sf_small):
    df = spark.read.parquet(f"{sf_small}/embeddings.parquet")
    rows = df.collect()
    ids, x = np.array([r.vec_id for r in rows]), np.array([r.embedding for r in rows], float)
    found = {}
    for r in ann.nearest(df, lambda i: i % 100 == 0).collect():
        found.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    assert set(found) == {i for i in ids.tolist() if i % 100 == 0}
    hits = 0
    for q, got in found.items():
        want = brute(ids, x, int(np.flatnonzero(ids == q)[0]))
        got.sort()
        assert [g[0] for g in got] == list(range(1, 11))
        hits += len({g[1] for g in got} & {w[0] for w in want})
    assert hits / (10 * len(found)) >= 0.9


def test_learned_partitions(spark, monkeypatch):
    """Clustered vectors with many parts: recall, balance, and blocks of a hot vector."""
    monkeypatch.setattr(ann, "PART_ROWS", 100)
    monkeypatch.setattr(ann, "PART_SAMPLE", 60)
    monkeypatch.setattr(ann, "BLOCK_ROWS", 150)
    monkeypatch.setattr(ann, "BLOCK_QUERIES", 10)
    rng = np.random.default_rng(0)
    centres = rng.standard_normal((16, 12)) * 2
    x = centres[rng.integers(0, 16, 1500)] + rng.standard_normal((1500, 12)) * 0.5
    x[:500] = x[0]
    x = x.astype(np.float32)
    ids = np.arange(1500)
    df = frame(spark, [(i, x[i].tolist(), None, 0, "", 1, "") for i in range(1500)]).repartition(5)
    found = {}
    for r in ann.nearest(df, lambda i: i % 50 == 0).collect():
        found.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    hits = 0
    for q in range(0, 1500, 50):
        want, got = brute(ids, x.astype(float), q), sorted(found[q])
        if q < 500:  # all ties at distance 0: the smallest ids
            assert [g[1] for g in got] == [w[0] for w in want] and all(g[2] == 0 for g in got)
        hits += len({g[1] for g in got} & {w[0] for w in want})
    assert hits >= 0.9 * 300


def test_parts_are_balanced():
    rng = np.random.default_rng(0)
    x = rng.standard_normal((640, 8))
    part = ann.balanced_parts(ann.neighbour_graph(x, 10), 8, rng)
    sizes = np.bincount(part)
    assert len(sizes) == 8 and sizes.min() == sizes.max() == 80


def test_edge_vectors(spark):
    nan, inf = float("nan"), float("inf")
    vectors = [None, [], [0.0, 0.0], [1.0, None], [nan, 1.0], [inf, 1.0], [1.0, 2.0, 3.0], [1.0, 0.0], [1.0, 0.0], [0.0, 1.0], [2.0, 0.0]]
    rows = [(i * 100, v, None, 0, None, None, None) for i, v in enumerate(vectors)] + [(None, [1.0, 1.0], 1, 1, "", 1, "")]
    rows.append((700, [1.0, 0.0], None, None, None, None, None))  # a repeated row
    got = sorted((r.query_id, r["rank"], r.vec_id) for r in ann.nearest(frame(spark, rows), lambda i: i % 100 == 0).collect())
    per = {}
    for q, _, v in got:
        per.setdefault(q, []).append(v)
    assert set(per) == {700, 800, 900, 1000}
    assert per[1000] == [700, 700, 800, 900] and per[800] == [700, 700, 1000, 900]
    assert ann.nearest(frame(spark, []), lambda i: i % 100 == 0).collect() == []


def test_huge_numbers(spark):
    rows = [(i, [1e30 * i, 1.0], None, 0, None, None, None) for i in range(1, 6)]
    got = [r.vec_id for r in ann.nearest(frame(spark, rows), lambda i: i == 1).orderBy("rank").collect()]
    assert got == [2, 3, 4, 5]


@pytest.mark.parametrize("kind", ["clusters", "gaussian"])
def test_recall_of_the_production_constants(spark, kind):
    """6000 vectors are enough for several parts; nothing is set smaller than the registered query has it."""
    rng = np.random.default_rng(9)
    x = rng.standard_normal((6000, 64)) * 0.12
    if kind == "clusters":
        x += (rng.standard_normal((40, 64)) * 0.3)[rng.integers(0, 40, 6000)]
    x = x.astype(np.float32)
    df = frame(spark, [(i, v, None, 0, "", 1, "") for i, v in enumerate(x.tolist())]).repartition(6)
    found = {}
    for r in ann.nearest(df, lambda i: i % 100 == 0).collect():
        found.setdefault(r.query_id, set()).add(r.vec_id)
    hits = sum(len(found[q] & {w[0] for w in brute(np.arange(6000), x.astype(float), q)}) for q in range(0, 6000, 100))
    assert hits / 600 >= 0.9
