"""Table profiles: describe, nulls, central values, quantiles, correlations, counts, histograms,
box-plot statistics, schema info, duplicate keys.

Statistics are computed as aggregates (partial on the map side). Exact quantiles take two scans: a sketch, then
the values that it leaves open (plans/quantiles.py). Whole-table scalars enter row expressions as scalar subqueries
(computed once, no join).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..plans.ordered import null_safe_join, present
from ..plans.quantiles import column_profile, exact_quantiles, number

QUARTILES = {"p25": 0.25, "p50": 0.5, "p75": 0.75}


def numeric_columns(df: DataFrame, exclude=()) -> list[str]:
    """Columns of a numeric type (booleans excluded, as numpy does not count them as numbers)."""
    return [f.name for f in df.schema.fields
            if isinstance(f.dataType, T.NumericType) and f.name not in set(exclude)]


def select_numeric(df: DataFrame, exclude=()) -> DataFrame:
    return df.select(*numeric_columns(df, exclude))


def _nan_to_null(c: str, dtype) -> Column:
    x = F.col(c)
    if isinstance(dtype, (T.DoubleType, T.FloatType)):
        return F.when(F.isnan(x), F.lit(None)).otherwise(x)
    return x


def long_values(df: DataFrame, cols=None, column_name: str = "column", value_name: str = "value") -> DataFrame:
    """Numeric columns to ``(column, value double)`` rows; NaN becomes null."""
    cols = list(cols or numeric_columns(df))
    types = {f.name: f.dataType for f in df.schema.fields}
    wide = df.select(*[_nan_to_null(c, types[c]).cast("double").alias(c) for c in cols])
    return wide.unpivot([], cols, column_name, value_name)


def describe(df: DataFrame, cols=None) -> DataFrame:
    """count, mean, sample std, min, exact 25/50/75 % (linear), max per numeric column."""
    q = column_profile(df, list(cols or numeric_columns(df)), QUARTILES)
    return q.select("column", "count", "mean", "std", "min", F.col("p25").alias("25%"), F.col("p50").alias("50%"),
                    F.col("p75").alias("75%"), "max")


def null_percentage(df: DataFrame, cols=None) -> DataFrame:
    """Share of missing values per column, in percent (NaN counts as missing)."""
    cols = list(cols or df.columns)
    types = {f.name: f.dataType for f in df.schema.fields}

    def missing(c):
        x = F.col(c).isNull()
        if isinstance(types[c], (T.DoubleType, T.FloatType)):
            x = x | F.isnan(F.col(c))
        return x

    row = df.agg(*[(F.avg(F.when(missing(c), 1.0).otherwise(0.0)) * 100).alias(c) for c in cols])
    return row.unpivot([], cols, "column", "null_pct")


def kinds(df: DataFrame, cols) -> list[list[str]]:
    """The columns by kind: whole numbers, others."""
    whole = [c for c in cols if isinstance(df.schema[c].dataType, T.IntegralType)]
    return [k for k in (whole, [c for c in cols if c not in whole]) if k]


def column_counts(df: DataFrame, cols, by=()) -> list[DataFrame]:
    """Rows per (``by``, column, value), one frame for each kind of number (whole, double); nulls and NaN are one value."""
    by = list(by)
    return [df.select(*by, *[number(c, df.schema[c].dataType).alias(c) for c in names]).unpivot(by, names, "column", "value")
            .groupBy(*by, "column", "value").agg(F.count(F.lit(1)).alias("n")) for names in kinds(df, list(cols))]


def modes(counts: DataFrame) -> DataFrame:
    """The commonest value of each column, the smallest of several: hash aggregates only."""
    known = counts.where(F.col("value").isNotNull())
    top = known.groupBy("column").agg(F.max("n").alias("_top"))  # one row per column, broadcast back
    return (known.join(F.broadcast(top), "column", "inner").where(F.col("n") == F.col("_top"))
            .groupBy("column").agg(F.min("value").alias("mode")))


def central_values(df: DataFrame, cols=None) -> DataFrame:
    """Mean, median and mode per numeric column; among several modes the smallest."""
    cols = list(cols or numeric_columns(df))
    mode = None
    for counts in column_counts(df, cols):
        m = modes(counts).withColumn("mode", F.col("mode").cast("double"))
        mode = m if mode is None else mode.unionByName(m)
    both = column_profile(df, cols, {"median": 0.5}).where(F.col("count") > 0).select("column", "mean", "median")
    return both.join(mode, "column", "left")


def quantiles(df: DataFrame, col: str, probs: dict[str, float], group_cols=None) -> DataFrame:
    return exact_quantiles(df, col, probs, group_cols)


def spread(df: DataFrame, cols=None) -> DataFrame:
    """Population std (ddof 0) and mean per column, nulls skipped."""
    long = long_values(df, cols)
    return long.groupBy("column").agg(F.avg("value").alias("mean"), F.stddev_pop("value").alias("std_pop"))


def date_range(df: DataFrame, date_col: str, group_col: str | None = None) -> DataFrame:
    """Min and max date overall or per group; rows with a null group key are dropped."""
    if group_col is None:
        return df.agg(F.min(date_col).alias("min_date"), F.max(date_col).alias("max_date"))
    return (df.where(F.col(group_col).isNotNull()).groupBy(group_col)
            .agg(F.min(date_col).alias("min_date"), F.max(date_col).alias("max_date")))


PAIRS = 64  # of columns in one aggregate's row


def correlation_matrix(df: DataFrame, cols=None) -> DataFrame:
    """Pearson correlation of every column pair, pairwise-complete (NaN counts as missing), long form
    ``(col_a, col_b, corr)``; a column that is constant over the pair's rows has no correlation (null).

    ``regr_r2`` and ``covar_pop`` keep mergeable co-moments and skip rows that lack one of the two (``corr`` has the same
    sums, but divides by zero on constant columns). The pairs are dealt into blocks of 64; each row goes to every block with
    its numbers, and one aggregate by block holds 64 pairs, however many columns there are.
    """
    cols = list(cols or numeric_columns(df))
    n = len(cols)
    pairs = [(i, j) for i in range(n) for j in range(i, n)]
    blocks = [pairs[i:i + PAIRS] for i in range(0, len(pairs), PAIRS)]
    x = [_nan_to_null(c, df.schema[c].dataType).cast("double") for c in cols]

    def corr(a: Column, b: Column) -> Column:
        square, cov = F.regr_r2(a, b), F.covar_pop(a, b)  # of a constant: null on one side, 1 with covariance 0 on the other
        return F.when((cov != 0) | (square == 0), F.least(F.lit(1.0), F.sqrt(square)) * F.signum(cov))

    if len(blocks) == 1:
        wide = df.select(*[v.alias(f"x{i}") for i, v in enumerate(x)])
        rows = wide.agg(F.array(*[corr(F.col(f"x{i}"), F.col(f"x{j}")) for i, j in pairs]).alias("c")) \
            .select(F.lit(0).alias("block"), "c")
    else:
        index = lambda side: F.array(*[F.array(*[F.lit(p[side]) for p in b]) for b in blocks])
        wide = df.select(F.array(*x).alias("x"), F.explode(F.sequence(F.lit(0), F.lit(len(blocks) - 1))).alias("block"))
        wide = wide.select("x", "block", F.get(index(0), F.col("block")).alias("a"), F.get(index(1), F.col("block")).alias("b"))
        at = lambda side, k: F.get("x", F.get(side, F.lit(k)))
        rows = wide.groupBy("block").agg(F.array(*[corr(at("a", k), at("b", k)) for k in range(PAIRS)]).alias("c"))
    at = F.col("block") * PAIRS + F.col("k")
    named = lambda side: F.get(F.array(*[F.lit(cols[p[side]]) for p in pairs]), at.cast("int"))
    half = rows.select("block", F.posexplode("c").alias("k", "corr")).where(at < len(pairs)).select(
        named(0).alias("col_a"), named(1).alias("col_b"), F.when(~F.isnan("corr"), F.col("corr")).alias("corr"))
    half = half.withColumn("corr", F.when((F.col("col_a") == F.col("col_b")) & F.col("corr").isNotNull(), 1.0).otherwise(F.col("corr")))
    mirrored = F.array(F.struct("col_a", "col_b"), F.struct(F.col("col_b").alias("col_a"), F.col("col_a").alias("col_b")))
    return half.select(F.explode(F.when(F.col("col_a") == F.col("col_b"), F.slice(mirrored, 1, 1)).otherwise(mirrored)).alias("p"), "corr") \
        .select("p.col_a", "p.col_b", "corr")


def value_counts(df: DataFrame, col: str) -> DataFrame:
    return df.groupBy(col).agg(F.count(F.lit(1)).alias("count"))


def histogram(df: DataFrame, col: str, bins: int = 10) -> DataFrame:
    """Equal-width bins over [min, max] of the finite values; the last bin is closed. Empty bins are not listed. Infinite
    values are counted apart, in bin -1 and bin ``bins``, which end at the range and are open outwards."""
    x, inf = F.col(col).cast("double"), F.lit(float("inf"))
    clean = df.where(x.isNotNull() & ~F.isnan(x))
    ends = clean.where(F.abs(x) != inf).select(F.struct(F.min(x).alias("lo"), F.max(x).alias("hi"))).scalar()
    lo, hi = ends["lo"], ends["hi"]
    width = (hi - lo) / F.lit(float(bins))
    b = F.when(x == inf, F.lit(bins)).when(x == -inf, F.lit(-1)).when(hi == lo, F.lit(0)) \
        .otherwise(F.least(F.floor((x - lo) / width), F.lit(bins - 1)))
    start, end = F.col("_lo") + F.col("bin") * F.col("_w"), F.col("_lo") + (F.col("bin") + 1) * F.col("_w")
    return (
        clean.select(b.cast("int").alias("bin"), lo.alias("_lo"), width.alias("_w"))
        .groupBy("bin")
        .agg(F.count(F.lit(1)).alias("count"), F.first("_lo").alias("_lo"), F.first("_w").alias("_w"))
        .select("bin", F.when(F.col("bin") == -1, -inf).otherwise(start).alias("bin_start"),
                F.when(F.col("bin") == bins, inf).otherwise(end).alias("bin_end"), "count")
    )


def box_stats(df: DataFrame, col: str, group_col: str | None = None, whisker: float = 1.5) -> DataFrame:
    """Quartiles, whiskers at the furthest points within ``whisker`` IQR, outlier count."""
    g = [group_col] if group_col else []
    d = df.where(present(df, col)).select(*g, F.col(col).alias("_v"))
    q = exact_quantiles(d, "_v", {"q1": 0.25, "median": 0.5, "q3": 0.75}, g)
    v = F.col("_v").cast("double")
    if g:
        j = null_safe_join(d, q, g)
    else:
        s = q.select(F.struct("q1", "median", "q3")).scalar()
        j = d.withColumn("_q", s).select("_v", "_q.*")
    iqr = F.col("q3") - F.col("q1")
    inside = (v >= F.col("q1") - whisker * iqr) & (v <= F.col("q3") + whisker * iqr)
    return j.groupBy(*g).agg(
        F.first("q1").alias("q1"), F.first("median").alias("median"), F.first("q3").alias("q3"),
        F.min(F.when(inside, v)).alias("whisker_low"), F.max(F.when(inside, v)).alias("whisker_high"),
        F.count(F.when(~inside, 1)).alias("outliers"))


def info(df: DataFrame) -> DataFrame:
    """Schema with non-null counts: ``(position, column, dtype, non_null, rows)``."""
    cols = df.columns
    row = df.agg(F.count(F.lit(1)).alias("\u0001rows"), *[F.count(F.col(c)).alias(c) for c in cols])
    long = row.select(F.col("\u0001rows").alias("rows"), *[F.col(c).cast("long").alias(c) for c in cols]) \
        .unpivot(["rows"], cols, "column", "non_null")
    types = {f.name: (i, f.dataType.simpleString()) for i, f in enumerate(df.schema.fields)}
    pos = F.create_map(*[x for c in cols for x in (F.lit(c), F.lit(types[c][0]))])
    dt = F.create_map(*[x for c in cols for x in (F.lit(c), F.lit(types[c][1]))])
    return long.select(pos[F.col("column")].alias("position"), "column", dt[F.col("column")].alias("dtype"),
                       "non_null", "rows")


def preview(df: DataFrame, n: int = 10, order_by=None) -> DataFrame:
    """First ``n`` rows; ordered by ``order_by`` for a deterministic preview (top-k, no full sort)."""
    return (df.orderBy(*([order_by] if isinstance(order_by, str) else order_by)) if order_by else df).limit(n)


def duplicate_keys(df: DataFrame, key_cols) -> DataFrame:
    """Keys that occur more than once, with their counts."""
    keys = [key_cols] if isinstance(key_cols, str) else list(key_cols)
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("count")).where(F.col("count") > 1)


def is_empty(df: DataFrame) -> bool:
    """Emptiness guard (reads at most one row)."""
    return df.isEmpty()


def require_rows(df: DataFrame, what: str = "data") -> DataFrame:
    """Raise when ``df`` is empty (the training-table guard); returns ``df`` otherwise."""
    if df.isEmpty():
        raise ValueError(f"no rows in {what}")
    return df


def category_quality(reference: DataFrame, current: DataFrame, cols) -> DataFrame:
    """Reference and current side by side for categorical columns: per (side, column, value) the rows, with the
    side's rows and number of distinct values (null is a value of its own, not counted as distinct)."""
    cols = list(cols)

    def tagged(df, side):
        return df.select(*[F.col(c).cast("string").alias(c) for c in cols]).unpivot([], cols, "column", "value") \
            .withColumn("side", F.lit(side))

    counts = tagged(reference, "reference").unionByName(tagged(current, "current")).groupBy("side", "column", "value") \
        .agg(F.count(F.lit(1)).alias("count"))
    totals = counts.groupBy("side", "column").agg(F.sum("count").alias("rows"), F.count("value").alias("distinct"))
    return counts.join(F.broadcast(totals), ["side", "column"], "inner")  # one row per side and column


def data_quality(reference: DataFrame, current: DataFrame, cols=None) -> DataFrame:
    """Reference and current profiled side by side: per (side, column) rows, missing values,
    distinct values, mean, sample std, min, exact quartiles, max (numeric columns)."""
    cols = list(cols or numeric_columns(reference))
    both = reference.select(*cols).withColumn("side", F.lit("reference")).unionByName(
        current.select(*cols).withColumn("side", F.lit("current")))
    keys, rows = ["side", "column"], None
    for counts in column_counts(both, cols, ["side"]):
        r = counts.groupBy(*keys).agg(
            F.sum("n").alias("rows"), F.coalesce(F.sum(F.when(F.col("value").isNull(), F.col("n"))), F.lit(0)).alias("missing"),
            F.count("value").alias("distinct"))
        rows = r if rows is None else rows.unionByName(r)
    return rows.join(column_profile(both, cols, QUARTILES, ["side"]).drop("count", "std_pop"), keys, "inner").select(
        *keys, "rows", "missing", "distinct", "mean", "std", "min", "max", *QUARTILES)
