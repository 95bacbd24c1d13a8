"""Global-order statistics without a single-partition window; one plan for every size, one exchange of data rows.

1. The rows are exchanged by range on the full order key (group columns first, nulls first), sorted in their
   partitions, and written once to the shared folder with their range ``_bucket`` and position ``_at``, as a table bucketed by
   ``_bucket``: windows inside a range then read it without another exchange.
2. Of each range, only its first and its last group can go on in a neighbouring one. Their sums (at most two rows a range)
   give what lies before the first and behind the last group; this table has one row a range and is broadcast.
3. Row numbers, running weights and totals of a group are what a window inside the range finds, plus these.

Rows that are equal on the whole key share a range; equal first columns don't have to. Nulls are a value
of their own, in groups and in order. No split point enters an expression.

Used by KS / Wasserstein / ROC AUC, row numbers and row-position interpolation.
"""

from __future__ import annotations

import uuid
from typing import Iterable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import ensure_checkpoint_dir

BUCKET = "_bucket"
POS = "_at"
SHIFT = 33  # monotonically_increasing_id holds the partition above this bit, the row below

BYTES_PER_BUCKET = 64 << 20
MIN_BUCKETS, MAX_BUCKETS = 8, 100_000  # as many as Spark lets a bucketed table have: 1 GB a range at 100 TB
ROW_EXPANSION = 16  # bytes of unpacked rows, in the sorts and windows of a task, for a byte of the scanned columnar files
UNKNOWN_BYTES = 1 << 60  # leaves without size statistics report more than this


def _as_list(cols) -> list[str]:
    if cols is None:
        return []
    return [cols] if isinstance(cols, str) else list(cols)


def bucket_count(df: DataFrame) -> int:
    """Partitions for the range exchange: by the size of the scanned tables (planning statistics, no
    job) as unpacked rows, between 8 and 100,000. It only sets the size of the tasks."""
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    sizes = [int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size())]
    least = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")) if any(s > UNKNOWN_BYTES for s in sizes) else MIN_BUCKETS
    return buckets_for(ROW_EXPANSION * sum(s for s in sizes if s <= UNKNOWN_BYTES), least)


def buckets_for(size: int, least: int = MIN_BUCKETS) -> int:
    return max(MIN_BUCKETS, min(MAX_BUCKETS, max(least, size // BYTES_PER_BUCKET)))


def null_safe_join(left: DataFrame, right: DataFrame, cols: Sequence[str], how: str = "inner") -> DataFrame:
    """Join on equal columns where null equals null; keeps the left one's."""
    cols = list(cols)
    r = right.withColumnsRenamed({c: f"_r_{c}" for c in cols})
    on = [F.col(c).eqNullSafe(F.col(f"_r_{c}")) for c in cols]
    return left.join(r, on, how).drop(*[f"_r_{c}" for c in cols])


def ranged(df: DataFrame, keys: Sequence[str], n_buckets: int | None = None) -> DataFrame:
    """``df`` pinned in range partitions of ``keys``, with ``_bucket`` and the position ``_at`` inside it, read back
    partitioned by ``_bucket``."""
    spark, n = df.sparkSession, n_buckets or bucket_count(df)
    order = [F.col(c).asc_nulls_first() for c in keys]
    rows = df.repartitionByRange(n, *order).sortWithinPartitions(*order).withColumn(POS, F.monotonically_increasing_id()) \
        .withColumn(BUCKET, F.shiftright(POS, SHIFT)).withColumn(POS, F.col(POS).bitwiseAND(F.lit((1 << SHIFT) - 1)))
    name = f"ordered_{uuid.uuid4().hex}"
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}"
    # a task holds one range, so it writes one file; the sort keeps the range in order
    rows.write.format("parquet").option("compression", "zstd").option("path", path).bucketBy(n, BUCKET).sortBy(BUCKET, POS).saveAsTable(name)
    out = spark.table(name)
    spark.sql(f"DROP TABLE {name}")  # the name only: the files lie in the shared folder, and ``out`` knows them
    return out


def _edges(rows: DataFrame, g: list[str], sums: dict[str, Column], value: str | None = None) -> DataFrame:
    """One row per range: ``_end`` (its last position), ``_o_k`` (sums of its first group in earlier ranges), ``_a_k`` (of its
    last group in later ranges) and, with ``value``, ``_next_first`` (the last group's first value in the next range)."""
    per = rows.groupBy(*g, BUCKET).agg(F.min(POS).alias("_lo"), F.max(POS).alias("_hi"), *[c.alias(f"_t_{k}") for k, c in sums.items()],
                                       *([F.min(value).alias("_v")] if value else []))
    if g:
        per = per.withColumn("_end", F.max("_hi").over(Window.partitionBy(BUCKET)))
        per = per.where((F.col("_lo") == 0) | (F.col("_hi") == F.col("_end")))  # first or last group of their range
    else:  # all ranges are one group's: as many rows as there are ranges
        per = per.withColumn("_end", F.col("_hi"))
    of = Window.partitionBy(*g) if g else Window.partitionBy(F.lit(1))
    w = of.orderBy(BUCKET)
    # later ranges are read backwards: a frame that ends at the last row is computed anew for every row
    before, after = (x.rowsBetween(Window.unboundedPreceding, -1) for x in (w, of.orderBy(F.desc(BUCKET))))
    per = per.select(BUCKET, "_lo", "_hi", "_end", *[F.coalesce(F.sum(f"_t_{k}").over(before), F.lit(0)).alias(f"_o_{k}") for k in sums],
                     *[F.coalesce(F.sum(f"_t_{k}").over(after), F.lit(0)).alias(f"_a_{k}") for k in sums],
                     *([F.lead("_v").over(w).alias("_next_first")] if value else []))
    first, last = F.col("_lo") == 0, F.col("_hi") == F.col("_end")
    return per.groupBy(F.col(BUCKET).alias("_b")).agg(
        F.max("_end").alias("_end"), *[F.max(F.when(first, F.col(f"_o_{k}"))).alias(f"_o_{k}") for k in sums],
        *[F.max(F.when(last, F.col(f"_a_{k}"))).alias(f"_a_{k}") for k in sums],
        *([F.max(F.when(last, F.col("_next_first"))).alias("_next_first")] if value else []))


def with_edges(rows: DataFrame, g: list[str], sums: dict[str, Column], value: str | None = None) -> DataFrame:
    """``rows`` with the columns of their range's edges, and ``_first`` / ``_last``: whether the row's group is the first or the
    last one of its range."""
    j = rows.join(F.broadcast(_edges(rows, g, sums, value)), F.col(BUCKET) == F.col("_b"), "inner").drop("_b")  # a row a range
    w = Window.partitionBy(*g, BUCKET)
    return j.withColumn("_lo", F.min(POS).over(w)).withColumn("_first", F.col("_lo") == 0) \
        .withColumn("_last", F.max(POS).over(w) == F.col("_end"))


def running_totals(vc: DataFrame, value_col: str, weight_cols: Iterable[str], group_cols=None,
                   n_buckets: int | None = None, next_col: str | None = None) -> DataFrame:
    """Cumulative weights over distinct values.

    ``vc`` holds one row per (group, value) and numeric weight columns. The rows gain ``<w>_upto`` (weights of values <=
    this one), ``<w>_before`` (strictly smaller) and ``<w>_total`` (the group's total); with ``next_col`` also the next
    larger value of the group.
    """
    g, ws = _as_list(group_cols), list(weight_cols)
    sums = {w: F.sum(w) for w in ws}
    j = with_edges(ranged(vc, [*g, value_col], n_buckets), g, sums, value_col if next_col else None)
    inside = Window.partitionBy(*g, BUCKET)
    upto = inside.orderBy(POS).rowsBetween(Window.unboundedPreceding, 0)
    before = lambda w: F.when(F.col("_first"), F.col(f"_o_{w}")).otherwise(0)
    after = lambda w: F.when(F.col("_last"), F.col(f"_a_{w}")).otherwise(0)
    if next_col:
        j = j.withColumn(next_col, F.coalesce(F.lead(value_col).over(inside.orderBy(POS)), F.when(F.col("_last"), F.col("_next_first"))))
    for w in ws:
        j = j.withColumn(f"{w}_upto", before(w) + F.sum(w).over(upto))
        j = j.withColumn(f"{w}_total", before(w) + F.sum(w).over(inside) + after(w))
        j = j.withColumn(f"{w}_before", F.col(f"{w}_upto") - F.col(w))
    return j.drop(*[f"_{x}_{w}" for x in "oa" for w in ws], POS, BUCKET, "_lo", "_end", "_first", "_last", "_next_first")


def global_rank(df: DataFrame, order_cols: Sequence[str], group_cols=None,
                n_buckets: int | None = None, rank_col: str = "_rank", total_col: str | None = None) -> DataFrame:
    """1-based row number per group ordered by ``order_cols`` (nulls first; ties broken by the later
    columns). With ``total_col`` the group's row count is kept as well."""
    return drop_order(ranked_ranges(df, order_cols, group_cols, n_buckets, rank_col, total_col))


def drop_order(rows: DataFrame) -> DataFrame:
    return rows.drop(BUCKET, POS, "_lo", "_end", "_first", "_last", "_o_n", "_a_n")


def ranked_ranges(df: DataFrame, order_cols, group_cols=None, n_buckets: int | None = None, rank_col: str = "_rank",
                  total_col: str | None = None) -> DataFrame:
    """:func:`global_rank`, still with the columns of its ranges, for windows on (group, ``_bucket``)."""
    g = _as_list(group_cols)
    rows = with_edges(ranged(df, [*g, *_as_list(order_cols)], n_buckets), g, {"n": F.count(F.lit(1))})
    before = F.when(F.col("_first"), F.col("_o_n")).otherwise(0)
    out = rows.withColumn(rank_col, F.col(POS) - F.col("_lo") + 1 + before)
    if total_col:
        inside = F.count(F.lit(1)).over(Window.partitionBy(*g, BUCKET))
        out = out.withColumn(total_col, inside + before + F.when(F.col("_last"), F.col("_a_n")).otherwise(0))
    return out


def present(df: DataFrame, col: str) -> Column:
    """Neither null nor NaN."""
    x = F.col(col)
    ok = x.isNotNull()
    return ok & ~F.isnan(x) if isinstance(df.schema[col].dataType, (T.DoubleType, T.FloatType)) else ok
