"""Approximate nearest neighbours with learned partitions.

1. A bounded sample of the vectors (smallest hash of the id) gets its exact neighbour graph.
2. The graph is cut into parts of equal size by recursive bisection: the second eigenvector of the normalised
   adjacency, split at its median, then swaps across the cut that keep more neighbours together.
3. A small network (one hidden layer) learns, from a vector alone, the share of its neighbours in each part.
4. Every row is indexed under its most probable part. A query goes to its most probable parts, as many as the
   sample's own neighbours need for ``recall``, and on until they hold enough rows; candidates there are
   reranked by exact distance in double precision.

Parts are searched in blocks of bounded numbers of rows and queries, so a vector that a third of all rows share
costs more blocks, not a larger one. Results per query and block are its best ``k``; a window merges them.

Defined cases: vectors that are null, zero, hold null or non-finite numbers, or have another length than most
take no part; ties go to the smaller id; a query never finds rows of its own id; with fewer candidates than ``k``
all are found; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import col, pin

SAMPLE = 8192        # vectors that the graph and the network are fitted on, at most
PART_ROWS = 512      # rows a part is meant to hold
PART_SAMPLE = 64     # least sample vectors of a part
NEIGHBOURS = 10
HIDDEN = 64
BLOCK_ROWS, BLOCK_QUERIES = 20_000, 5_000


def neighbour_graph(x: np.ndarray, k: int) -> np.ndarray:
    """Indices of each row's k nearest other rows."""
    n = len(x)
    out = np.empty((n, k), np.int64)
    sq = (x * x).sum(1)
    for a in range(0, n, 1024):
        d = sq[None, :] - 2.0 * (x[a:a + 1024] @ x.T)
        d[np.arange(len(d)), np.arange(a, a + len(d))] = np.inf
        out[a:a + 1024] = np.argpartition(d, k - 1, axis=1)[:, :k]
    return out


def _bisect(rows: np.ndarray, cols: np.ndarray, n: int, rng) -> np.ndarray:
    """A mask of floor(n / 2) vertices: spectral split of the symmetric edges (rows, cols), then swaps."""
    degree = np.bincount(rows, minlength=n) + 1e-9
    scale = 1.0 / np.sqrt(degree)
    first = np.sqrt(degree)
    first /= np.linalg.norm(first)
    v = rng.standard_normal(n)
    for _ in range(60):
        v -= first * (first @ v)
        v = scale * np.bincount(rows, weights=(v * scale)[cols], minlength=n) + v
        v /= np.linalg.norm(v) + 1e-30
    side = np.zeros(n, bool)
    side[np.argsort(v * scale, kind="stable")[: n // 2]] = True
    for _ in range(10):  # swap equal numbers of vertices that have more neighbours on the other side
        other = np.bincount(rows, weights=(side[cols] != side[rows]).astype(float), minlength=n)
        gain = 2 * other - degree
        a, b = np.flatnonzero(side), np.flatnonzero(~side)
        a, b = a[np.argsort(-gain[a], kind="stable")], b[np.argsort(-gain[b], kind="stable")]
        m = min(len(a), len(b))
        good = int(np.argmax(np.append(gain[a[:m]] + gain[b[:m]] <= 2, True))) // 2  # half: moved neighbours interact
        if not good:
            break
        side[a[:good]], side[b[:good]] = False, True
    return side


def balanced_parts(graph: np.ndarray, n_parts: int, rng) -> np.ndarray:
    """Part of every vertex; parts of a power of two in number differ by at most one vertex a level."""
    n, k = graph.shape
    src = np.repeat(np.arange(n), k)
    rows, cols = np.concatenate([src, graph.ravel()]), np.concatenate([graph.ravel(), src])
    part = np.zeros(n, np.int64)
    for _ in range(int(np.log2(n_parts))):
        new = part * 2
        for p in np.unique(part):
            members = np.flatnonzero(part == p)
            index = np.full(n, -1)
            index[members] = np.arange(len(members))
            inner = (index[rows] >= 0) & (index[cols] >= 0)
            new[members[_bisect(index[rows[inner]], index[cols[inner]], len(members), rng)]] += 1
        part = new
    return part


class Router:
    """Probabilities of the parts for vectors."""

    def __init__(self, dim: int, parts: int, rng):
        self.mean, self.spread = np.zeros(dim), np.ones(dim)
        self.w = [rng.standard_normal((dim, HIDDEN)) / np.sqrt(dim), np.zeros(HIDDEN),
                  rng.standard_normal((HIDDEN, parts)) / np.sqrt(HIDDEN), np.zeros(parts),
                  rng.standard_normal((dim, parts)) / np.sqrt(dim)]  # the last: straight from the input

    def _forward(self, x):
        z = (x - self.mean) / self.spread
        h = np.maximum(z @ self.w[0] + self.w[1], 0.0)
        o = h @ self.w[2] + self.w[3] + z @ self.w[4]
        o -= o.max(1, keepdims=True)
        e = np.exp(o)
        return z, h, e / e.sum(1, keepdims=True)

    def __call__(self, x: np.ndarray) -> np.ndarray:
        return np.concatenate([self._forward(x[a:a + 4096])[2] for a in range(0, len(x), 4096)]) if len(x) else np.zeros((0, len(self.w[3])))

    def fit(self, x: np.ndarray, target: np.ndarray, rng, epochs: int = 30) -> None:
        """Cross entropy with Adam steps."""
        self.mean, self.spread = x.mean(0), x.std(0) + 1e-9
        m, v, t = [np.zeros_like(a) for a in self.w], [np.zeros_like(a) for a in self.w], 0
        for epoch in range(epochs):
            order = rng.permutation(len(x))
            rate = 0.01 * (1 - epoch / epochs) + 0.0005
            for a in range(0, len(x), 128):
                i = order[a:a + 128]
                z, h, p = self._forward(x[i])
                d = (p - target[i]) / len(i)
                dh = (d @ self.w[2].T) * (h > 0)
                grads = [z.T @ dh, dh.sum(0), h.T @ d, d.sum(0), z.T @ d]
                t += 1
                for j, g in enumerate(grads):
                    g = g + 1e-4 * self.w[j]
                    m[j] = 0.9 * m[j] + 0.1 * g
                    v[j] = 0.999 * v[j] + 0.001 * g * g
                    self.w[j] -= rate * (m[j] / (1 - 0.9 ** t)) / (np.sqrt(v[j] / (1 - 0.999 ** t)) + 1e-8)


def fit_router(x: np.ndarray, n_rows: int, recall: float, seed: int = 7) -> tuple[Router, int]:
    """The router, and how many parts a query must see for the sample's neighbours to be found."""
    rng = np.random.default_rng(seed)
    wanted = max(1, min(len(x) // PART_SAMPLE, n_rows // PART_ROWS))
    parts = 1 << (wanted.bit_length() - 1)
    router = Router(x.shape[1], parts, rng)
    if parts == 1:
        return router, 1
    scaled = x / max(1e-300, float(np.abs(x).max()))
    k = min(NEIGHBOURS, len(x) - 1)
    graph = neighbour_graph(scaled, k)
    part = balanced_parts(graph, parts, rng)
    target = np.zeros((len(x), parts))
    np.add.at(target, (np.repeat(np.arange(len(x)), k), part[graph].ravel()), 1.0)
    target[np.arange(len(x)), part] += 1.0
    target /= target.sum(1, keepdims=True)
    router.mean, router.spread = x.mean(0), x.std(0) + 1e-9
    # parts seen by vectors that the network was not fitted on: two halves, each judged by the other's network
    halves = np.arange(len(x)) % 2
    covered = np.zeros((len(x), parts))
    for half in (0, 1):
        trial = Router(x.shape[1], parts, rng)
        trial.fit(x[halves != half], target[halves != half], rng)
        mine = np.flatnonzero(halves == half)
        p = trial(x)
        home = p.argmax(1)  # rows are indexed where the network puts them
        order = np.argsort(-p[mine], axis=1, kind="stable")
        place = np.empty_like(order)
        np.put_along_axis(place, order, np.arange(parts)[None, :].repeat(len(mine), 0), 1)
        seen = np.take_along_axis(place, home[graph[mine]], 1)
        for m in range(parts):
            covered[mine, m] = (seen <= m).mean(1)
    share = covered.mean(0)
    probes = int(np.argmax(share >= recall)) + 1 if (share >= recall).any() else parts
    router.fit(x, target, rng)
    return router, max(2, probes)


def usable(df: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """(id, v) of the rows whose vector takes part, v in double precision."""
    v = col(df, vec_col).cast("array<double>")
    rows = df.select(col(df, id_col).cast("long").alias("id"), v.alias("v")).filter(
        F.col("id").isNotNull() & F.col("v").isNotNull() & (F.size("v") > 0)
        & F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
        & F.exists("v", lambda x: x != 0))
    rows = pin(rows, "ann-vectors")
    common = rows.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), "d").first()
    return rows.filter(F.size("v") == common.d) if common else rows


def _matrix(column: pa.ChunkedArray, dim: int) -> np.ndarray:
    flat = [c.flatten().to_numpy(zero_copy_only=False) for c in column.chunks]
    return (np.concatenate(flat) if flat else np.zeros(0)).reshape(-1, dim)


def best_of(q: np.ndarray, q_id: np.ndarray, c: np.ndarray, c_id: np.ndarray, k: int):
    """For each query the k nearest candidates of another id: (query row, candidate row, distance) arrays."""
    out = []
    big = max(np.abs(q).max(initial=0.0), np.abs(c).max(initial=0.0))
    rough = 0 < big < 1e100
    sq = (c * c).sum(1) if rough else None
    for a in range(0, len(q), 64):
        for i in range(a, min(a + 64, len(q))):
            if i == a and rough:
                block = sq[None, :] - 2.0 * (q[a:a + 64] @ c.T)
            keep = np.flatnonzero(c_id != q_id[i])
            if not len(keep):
                continue
            if rough and len(keep) > k:
                d = block[i - a][keep]
                # rounding of the expanded square is far below this tolerance
                edge = np.partition(d, k - 1)[k - 1] + 1e-9 * big * big * c.shape[1]
                keep = keep[d <= edge]
            exact = np.sqrt(((c[keep] - q[i]) ** 2).sum(1))
            first = np.lexsort((c_id[keep], exact))[:k]
            out.append((np.full(len(first), i), keep[first], exact[first]))
    if not out:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
    return tuple(np.concatenate(x) for x in zip(*out))


def nearest(df: DataFrame, is_query, id_col: str = "vec_id", vec_col: str = "embedding", k: int = 10,
            recall: float = 0.95) -> DataFrame:
    """For the rows where ``is_query`` (a function of the id column) holds: query_id, rank, id, score."""
    spark = df.sparkSession
    rows = usable(df, id_col, vec_col)
    schema = f"query_id long, `{id_col}` long, score double"
    sample = rows.orderBy(F.xxhash64("id"), "id").limit(SAMPLE).toArrow()  # bounded by SAMPLE
    if not sample.num_rows:
        return spark.createDataFrame([], f"query_id long, rank int, `{id_col}` long, score double")
    dim = len(sample.column("v")[0])
    router, probes = fit_router(_matrix(sample.column("v"), dim), rows.count(), recall)

    def index(batches):
        for b in batches:
            p = router(_matrix(pa.chunked_array([b.column(1)]), dim))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(p.argmax(1).astype(np.int32))], ["id", "v", "part"])

    placed = pin(rows.mapInArrow(index, "id long, v array<double>, part int"), "ann-index")
    sizes = {r.part: r["count"] for r in placed.groupBy("part").count().collect()}  # one row per part
    held = np.array([sizes.get(p, 0) for p in range(len(router.w[3]))])
    twice = placed.groupBy("id").count().agg(F.max("count")).first()[0]
    blocks = [max(1, -(-int(n) // BLOCK_ROWS)) for n in held]

    def route(batches):
        for b in batches:
            p = router(_matrix(pa.chunked_array([b.column(1)]), dim))
            order = np.argsort(-p, axis=1, kind="stable")
            full = np.cumsum(held[order], axis=1) >= k + twice
            stop = np.maximum(probes, np.where(full.any(1), full.argmax(1) + 1, p.shape[1]))
            which, part, sub = [], [], []
            for i, s in enumerate(stop):
                for x in order[i, :s]:
                    for y in range(blocks[x]):
                        which.append(i), part.append(int(x)), sub.append(y)
            at = pa.array(which, pa.int64())
            yield pa.RecordBatch.from_arrays([b.column(0).take(at), b.column(1).take(at), pa.array(part, pa.int32()), pa.array(sub, pa.int32())],
                                             ["id", "v", "part", "sub"])

    queries = placed.filter(is_query(F.col("id"))).select("id", "v").mapInArrow(route, "id long, v array<double>, part int, sub int")
    # query blocks: as many as there are queries for one block of rows
    n_queries = placed.filter(is_query(F.col("id"))).count()
    groups = max(1, -(-n_queries // BLOCK_QUERIES))
    queries = queries.withColumn("turn", F.pmod(F.xxhash64("id"), F.lit(groups)).cast("int"))
    n_blocks = F.array(*[F.lit(int(x)) for x in blocks])
    candidates = placed.withColumn("sub", F.pmod(F.xxhash64("id", F.lit(1)), F.get(n_blocks, F.col("part"))).cast("int"))
    candidates = candidates.withColumn("turn", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))))

    def search(q: pa.Table, c: pa.Table) -> pa.Table:
        q_id, c_id = (t.column("id").to_numpy() for t in (q, c))
        i, j, d = best_of(_matrix(q.column("v"), dim), q_id, _matrix(c.column("v"), dim), c_id, k) if q.num_rows and c.num_rows else ([], [], [])
        return pa.table({"query_id": pa.array(q_id[i] if len(i) else [], pa.int64()), id_col: pa.array(c_id[j] if len(i) else [], pa.int64()),
                         "score": pa.array(d, pa.float64())})

    keys = ["part", "sub", "turn"]
    found = queries.groupBy(*keys).cogroup(candidates.groupBy(*keys)).applyInArrow(search, schema)
    order = Window.partitionBy("query_id").orderBy("score", id_col)
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("query_id", "rank", id_col, "score")
