"""Embedding whitening from a bit-sliced scatter matrix.

Every entry c becomes the whole number x = floor(1024 c) + 100000. One pass finds each dimension's least and
largest x; the next packs the bit planes of x minus the least, over blocks of rows, into 64-bit words: the number
of ones in the AND of two planes is the sum of products of these bits, and weighted by the planes' powers of two
these counts give exact cross-products. Blocks, partitions and tasks add whole numbers, so the scatter matrix is the same for every
partitioning. It is centred as whole numbers, n * sum(x_i x_j) - S_i S_j, before it becomes floating point; its
eigenvectors are found on the driver (dimensions squared entries, whatever the number of rows). A last pass
projects every row.

Defined cases: vectors that are null, empty or hold a null or non-finite entry take no part, nor do vectors of
another length than the commonest one (of equally common lengths the longest); repeated rows and ids count as rows; a null id is
kept; a component without variance can't be whitened and is left out, so equal rows (or a single one) give an empty
result, as does an empty table; x beyond +-2^50 is held there;
a deviation of more than 38 digits is null; extra columns are ignored.
"""

from __future__ import annotations

import decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import col, pin

# The scale and the shift of whole numbers.
SCALE, SHIFT = 1024.0, 100_000
LIMIT = float(1 << 50)
BLOCK_BYTES = 8 << 20   # of numbers a block (rows times dimensions), rounded to 64 rows
LEAST_SHARE = 1e-13     # of the largest eigenvalue: below it a component has no variance


def whole_numbers(flat: np.ndarray) -> np.ndarray:
    return np.clip(np.floor(flat * SCALE), -LIMIT, LIMIT).astype(np.int64) + SHIFT


def matrix(column: pa.Array, dims: int) -> np.ndarray:
    """An Arrow list column of equal lengths as rows of whole numbers."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return whole_numbers(flat).reshape(-1, dims)


def bit_planes(y: np.ndarray, bits: int) -> np.ndarray:
    """``(dims, bits, words)``: bit p of dimension d over all rows, 64 rows a word."""
    rows, dims = y.shape
    padded = np.zeros((-(-rows // 64) * 64, dims), np.uint64)
    padded[:rows] = y
    planes = np.empty((dims, bits, len(padded) // 64), np.uint64)
    for p in range(bits):
        ones = ((padded >> np.uint64(p)) & np.uint64(1)).astype(np.uint8)
        planes[:, p] = np.ascontiguousarray(np.packbits(ones, axis=0, bitorder="little").T).view(np.uint64)
    return planes


def cross_products(planes: np.ndarray) -> np.ndarray:
    """Exact sums of y_i * y_j for i <= j over the rows of the planes, as Python integers."""
    dims, bits, words = planes.shape
    out = np.zeros((dims, dims), object)
    weights = [1 << p for p in range(bits)]
    narrow = words * 64 << (2 * bits) < 1 << 62  # the sums of a block fit machine words
    for i in range(dims):
        row = np.zeros(dims - i, np.int64 if narrow else object)
        for p in range(bits):
            if not planes[i, p].any():
                continue
            counts = np.bitwise_count(planes[i:] & planes[i, p]).sum(axis=2, dtype=np.int64)
            if narrow:
                row += (counts @ np.array(weights, np.int64)) << p
            else:
                row += counts.astype(object) @ np.array(weights, object) << p
        out[i, i:] = row.astype(object)
    return out


def usable(df: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """Id and vector (doubles) of the rows that take part, but for the rule on lengths."""
    v = col(df, vector_col).cast("array<double>")
    bad = F.exists(v, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == F.lit(float("inf"))))
    return df.select(col(df, id_col).alias("id"), v.alias("v")).where(v.isNotNull() & (F.size(v) > 0) & ~bad)


def scatter(vectors: DataFrame, dims: int) -> tuple[int, list[int], list[list[int]]]:
    """Number of rows, sums of x, and sums of x_i * x_j (i <= j), all exact."""
    def extremes(batches):
        low = high = None
        for b in batches:
            if b.num_rows:
                x = matrix(b.column(0), dims)
                lo, hi = x.min(axis=0), x.max(axis=0)
                low = lo if low is None else np.minimum(low, lo)
                high = hi if high is None else np.maximum(high, hi)
        if low is not None:
            yield pa.RecordBatch.from_arrays([pa.array(range(dims), pa.int32()), pa.array(low), pa.array(high)],
                                             ["i", "low", "high"])

    ends = vectors.mapInArrow(extremes, "i int, low long, high long").groupBy("i") \
        .agg(F.min("low").alias("low"), F.max("high").alias("high")).collect()  # a row for each dimension
    base, top = np.zeros(dims, np.int64), np.zeros(dims, np.int64)
    for r in ends:
        base[r.i], top[r.i] = r.low, r.high
    bits = max(1, int((top - base).max()).bit_length())
    block = max(64, BLOCK_BYTES // (8 * dims) // 64 * 64)

    def products(batches):
        n, sums, cross = 0, np.zeros(dims, object), np.zeros((dims, dims), object)

        def add(y):
            nonlocal n
            n += len(y)
            planes = bit_planes(y, bits)
            ones = np.bitwise_count(planes).sum(axis=2, dtype=np.int64).astype(object)
            sums[:] += ones @ np.array([1 << p for p in range(bits)], object)
            cross[:] += cross_products(planes)

        held, rows = [], 0
        for b in batches:
            if not b.num_rows:
                continue
            y = matrix(b.column(0), dims) - base
            while len(y):
                part = y[:block - rows]
                held.append(part)
                rows += len(part)
                y = y[len(part):]
                if rows == block:
                    add(np.concatenate(held))
                    held, rows = [], 0
        if rows:
            add(np.concatenate(held))
        if n:
            exact = lambda values: pa.array([decimal.Decimal(int(v)) for v in values], pa.decimal128(38, 0))
            for i in range(dims):  # row -1 of a dimension: its sum; -1 of both: the number of rows
                yield pa.RecordBatch.from_arrays(
                    [pa.array([i] * (dims - i + 1), pa.int32()), pa.array([-1, *range(i, dims)], pa.int32()),
                     exact([sums[i], *cross[i, i:]])], ["i", "j", "s"])
            yield pa.RecordBatch.from_arrays([pa.array([-1], pa.int32()), pa.array([-1], pa.int32()), exact([n])],
                                             ["i", "j", "s"])

    found = {(r.i, r.j): int(r.s) for r in vectors.mapInArrow(products, "i int, j int, s decimal(38,0)")
             .groupBy("i", "j").agg(F.sum("s").alias("s")).collect()}  # dimensions squared, not rows
    n = found.get((-1, -1), 0)
    low = [int(b) for b in base]
    part = [found.get((i, -1), 0) for i in range(dims)]
    total = [part[i] + n * low[i] for i in range(dims)]
    cross = [[found.get((i, j), 0) + low[i] * part[j] + low[j] * part[i] + n * low[i] * low[j] if j >= i else 0
              for j in range(dims)] for i in range(dims)]
    return n, total, cross


def components(n: int, total: list[int], cross: list[list[int]], count: int) -> tuple[np.ndarray, np.ndarray, float]:
    """The first ``count`` unit eigenvectors (columns) of the covariance with variance, their eigenvalues, its trace."""
    dims = len(total)
    v = np.empty((dims, dims))
    for i in range(dims):
        for j in range(i, dims):
            v[i, j] = v[j, i] = (n * cross[i][j] - total[i] * total[j]) / (n * n)  # whole numbers up to the division
    values, vectors = np.linalg.eigh(v)
    order = np.argsort(-values, kind="stable")[:count]
    order = order[values[order] > max(values.max(), 0.0) * LEAST_SHARE]
    return vectors[:, order], values[order], float(np.trace(v))


def whiten(df: DataFrame, count: int = 8, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """One row for each vector that takes part and component: the id, ``component`` (from 1, by falling variance),
    ``n`` (vectors), ``deviation`` (sum over dimensions of (n x - S)^2, an exact decimal), ``whitened``,
    ``explained`` (share of the trace) and ``identity_error`` (largest entry of the measured covariance of
    ``whitened`` minus the identity)."""
    id_type = df.select(col(df, id_col)).schema[0].dataType.simpleString()
    schema = (f"`{id_col}` {id_type}, component int, n long, deviation decimal(38,0), whitened double, explained double, "
              "identity_error double")
    vectors = usable(df, id_col, vector_col)
    lengths = vectors.groupBy(F.size("v").alias("d")).agg(F.count(F.lit(1)).alias("n"))
    common = lengths.orderBy(F.desc("n"), F.desc("d")).first()
    if common is None:
        return df.sparkSession.createDataFrame([], schema)
    dims = common.d
    vectors = vectors.where(F.size("v") == dims)
    n, total, cross = scatter(vectors.select("v"), dims)
    axes, values, trace = components(n, total, cross, count)
    k = len(values)
    if not k:
        return df.sparkSession.createDataFrame([], schema)
    whole = np.array([t // n for t in total], np.int64)                # x - S/n = (x - whole) - rest/n
    rest = [t - n * int(w) for t, w in zip(total, whole)]
    fraction, scaled = np.array([r / n for r in rest]), axes / np.sqrt(values)

    def project(batches):
        for b in batches:
            x = matrix(b.column(1), dims) - whole
            white = (x - fraction) @ scaled
            if dims * (n * max(int(np.abs(x).max(initial=0)), 1) + n) ** 2 < 1 << 62:
                away = ((n * x - np.array(rest, np.int64)) ** 2).sum(axis=1)
            else:
                away = ((n * x.astype(object) - np.array(rest, object)) ** 2).sum(axis=1)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array([decimal.Decimal(int(a)) if a < 10 ** 38 else None for a in away],
                                         pa.decimal128(38, 0)),
                 pa.ListArray.from_arrays(np.arange(0, len(white) * k + 1, k, dtype=np.int32), white.ravel())],
                ["id", "deviation", "w"])

    white = pin(vectors.mapInArrow(project, f"id {id_type}, deviation decimal(38,0), w array<double>"), "white")
    # the covariance as measured: means first, then products of what is centred
    means = white.agg(*[F.avg(F.col("w")[a]) for a in range(k)]).first()
    centred = [F.col("w")[a] - F.lit(float(means[a])) for a in range(k)]
    pairs = [(a, b) for a in range(k) for b in range(a, k)]
    error = white.agg(F.greatest(F.lit(0.0), *[F.abs(F.avg(centred[a] * centred[b]) - float(a == b)) for a, b in pairs])
                      .alias("e")).first().e
    share = F.array(*[F.lit(float(v / trace)) for v in values])
    rows = white.select(F.col("id").alias(id_col), "deviation", F.posexplode("w").alias("at", "whitened"))
    return rows.select(id_col, (F.col("at") + 1).alias("component"), F.lit(n).cast("long").alias("n"), "deviation", "whitened",
                       F.get(share, F.col("at")).alias("explained"), F.lit(float(error)).alias("identity_error"))
