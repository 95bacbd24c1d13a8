"""Cleaning: missing values, interpolation, missing dates, outliers, transforms.

Per-column statistics are a bounded summary (one value per column) and enter the row expressions
as literals or scalar subqueries. Group statistics are aggregated and joined back on the group key
(no window over a whole group, so a hot group is not pinned to one task).
"""

from __future__ import annotations

from typing import Callable, Iterable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.scalar import log1p_safe, sqrt_safe
from ..plans.ordered import BUCKET, drop_order, null_safe_join, ranked_ranges
from ..plans.quantiles import column_quantiles, exact_quantiles
from ..session import pin
from .profile import column_counts, modes, numeric_columns

# ------------------------------------------------------------------ missing values


def drop_missing(df: DataFrame, axis: int = 0, thresh: int | None = None) -> DataFrame:
    """Drop rows (axis 0) or columns (axis 1) with a missing value, or with fewer than ``thresh``
    non-missing values. NaN counts as missing."""
    types = {f.name: f.dataType for f in df.schema.fields}

    def present(c) -> Column:
        x = F.col(c).isNotNull()
        if isinstance(types[c], (T.DoubleType, T.FloatType)):
            x = x & ~F.isnan(F.col(c))
        return x

    if axis == 0:
        n_present = sum((present(c).cast("int") for c in df.columns), F.lit(0))
        need = len(df.columns) if thresh is None else int(thresh)
        return df.where(n_present >= need)
    if axis == 1:
        rows = df.agg(F.count(F.lit(1)).alias("\u0001n"),
                      *[F.count(F.when(present(c), 1)).alias(c) for c in df.columns]).first()
        n = rows["\u0001n"]
        need = n if thresh is None else int(thresh)
        return df.select(*[c for c in df.columns if rows[c] >= need])
    raise ValueError("axis must be 0 or 1")


def column_stats(df: DataFrame, cols: Iterable[str], how: str) -> dict:
    """One value per column: mean, median (exact) or mode (smallest on ties). Bounded summary."""
    cols = list(cols)
    if not cols:
        return {}
    if how == "mean":
        row = df.agg(*[F.avg(F.when(~F.isnan(F.col(c).cast("double")), F.col(c))).alias(c) for c in cols]).first()
        return {c: row[c] for c in cols}
    if how == "median":
        q = column_quantiles(df, cols, {"m": 0.5})
        got = {r["column"]: r["m"] for r in q.collect()}  # one row per column
        return {c: got.get(c) for c in cols}
    if how == "mode":
        types = {f.name: f.dataType for f in df.schema.fields}
        kept = (T.IntegralType, T.FloatType, T.DoubleType)  # these keep their values as bigint or double
        num, out = [c for c in cols if isinstance(types[c], kept)], {}
        for counts in column_counts(df, num):  # one job a kind, one row per column
            out.update({r["column"]: r["mode"] for r in modes(counts).collect()})
        for c in cols:  # other types keep their own values (no lossy cast): one small job each
            if c in num:
                out.setdefault(c, None)
                continue
            counts = df.where(F.col(c).isNotNull()).groupBy(c).agg(F.count(F.lit(1)).alias("n"))
            top = counts.agg(F.max("n").alias("m")).first()["m"]
            out[c] = counts.where(F.col("n") == top).agg(F.min(c).alias("v")).first()["v"] if top else None
        return out
    raise ValueError(f"unknown statistic {how}")


def _with_gaps(df: DataFrame, cols) -> set[str]:
    """The whole-number columns among ``cols`` that have a null (one row from one aggregate)."""
    types = {f.name: f.dataType for f in df.schema.fields}
    whole = [c for c in cols if isinstance(types[c], T.IntegralType)]
    row = df.agg(*[F.count(F.when(F.col(c).isNull(), 1)).alias(c) for c in whole]).first() if whole else {}
    return {c for c in whole if row[c]}


def _fill_with(df: DataFrame, values: dict, widen=()) -> DataFrame:
    types = {f.name: f.dataType for f in df.schema.fields}
    exprs = []
    for f in df.schema.fields:
        c = f.name
        if c in values and values[c] is not None:
            x = F.col(c)
            missing = x.isNull()
            if isinstance(types[c], (T.DoubleType, T.FloatType)):
                missing = missing | F.isnan(x)
            # a mean or median of whole numbers isn't one: a filled column becomes double, as in pandas
            kind = T.DoubleType() if c in widen else types[c]
            exprs.append(F.when(missing, F.lit(values[c]).cast(kind)).otherwise(x.cast(kind)).alias(c))
        else:
            exprs.append(F.col(c))
    return df.select(*exprs)


def fill_missing(df: DataFrame, value=None, method: str | None = None) -> DataFrame:
    """Fill with a value (wins over method), or with column mean / median / mode."""
    if value is not None:
        if isinstance(value, dict):
            return _fill_with(df, value)
        cols = [f.name for f in df.schema.fields if _compatible(value, f.dataType)]
        return _fill_with(df, {c: value for c in cols})
    if method is None:
        raise ValueError("fill_missing needs value= or method=")
    if method in ("mean", "median"):
        cols = numeric_columns(df)
        return _fill_with(df, column_stats(df, cols, method), _with_gaps(df, cols))
    if method == "mode":
        return _fill_with(df, column_stats(df, df.columns, "mode"))
    raise ValueError(f"fill_missing knows mean, median and mode, not {method!r}")


def _compatible(value, dtype) -> bool:
    if isinstance(value, bool):
        return isinstance(dtype, T.BooleanType)
    if isinstance(value, (int, float)):
        return isinstance(dtype, T.NumericType)
    if isinstance(value, str):
        return isinstance(dtype, T.StringType)
    return False


def impute(df: DataFrame, strategy: str = "mean", fill_value=None) -> DataFrame:
    """Imputer strategies: mean, median, most_frequent, constant (0 / 'missing_value' by default)."""
    if strategy in ("mean", "median"):
        cols = numeric_columns(df)
        return _fill_with(df, column_stats(df, cols, strategy), _with_gaps(df, cols))
    if strategy == "most_frequent":
        return _fill_with(df, column_stats(df, df.columns, "mode"))
    if strategy == "constant":
        vals = {}
        for f in df.schema.fields:
            if fill_value is not None:
                if _compatible(fill_value, f.dataType):
                    vals[f.name] = fill_value
            elif isinstance(f.dataType, T.NumericType):
                vals[f.name] = 0
            elif isinstance(f.dataType, T.StringType):
                vals[f.name] = "missing_value"
        return _fill_with(df, vals)
    raise ValueError(f"unknown strategy {strategy}")


# ------------------------------------------------------------------ interpolation


def interpolate_linear(df: DataFrame, value_col: str, order_cols, series_cols=None,
                       n_buckets: int | None = None, out_col: str | None = None) -> DataFrame:
    """Linear interpolation by row position inside each series (ordered by ``order_cols``).

    Leading gaps stay null, trailing gaps take the last value (pandas ``interpolate()``). Rows are put in global order
    (series, then ``order_cols``) once. A window finds the known points around a gap inside the row's range; the last known
    point before a range and the first one behind it are carried in through a table of at most two rows a range, so no
    window spans more than one range of one series.
    """
    s = [] if series_cols is None else ([series_cols] if isinstance(series_cols, str) else list(series_cols))
    order = [order_cols] if isinstance(order_cols, str) else list(order_cols)
    out = out_col or value_col
    v = F.col(value_col).cast("double")
    ranked = ranked_ranges(df, order, s, n_buckets, rank_col="_pos")
    is_known = v.isNotNull() & ~F.isnan(v)
    known = F.when(is_known, F.struct(F.col("_pos").alias("p"), v.alias("v")))
    kpos = F.when(is_known, F.col("_pos"))
    # fixed-width aggregation buffers (hash aggregate); the structs are built on the small result
    ends = ranked.where("_first OR _last").groupBy(*s, BUCKET).agg(
        F.max(kpos).alias("_lp"), F.max_by(F.when(is_known, v), kpos).alias("_lv"),
        F.min(kpos).alias("_fp"), F.min_by(F.when(is_known, v), kpos).alias("_fv"), F.bool_or("_first").alias("_first"),
        F.bool_or("_last").alias("_last"),
    ).select(*s, BUCKET, "_first", "_last",
             F.when(F.col("_lp").isNotNull(), F.struct(F.col("_lp").alias("p"), F.col("_lv").alias("v"))).alias("_lk"),
             F.when(F.col("_fp").isNotNull(), F.struct(F.col("_fp").alias("p"), F.col("_fv").alias("v"))).alias("_fk"))
    wc = Window.partitionBy(*s) if s else Window.partitionBy(F.lit(1))  # without series: a row a range
    # what follows is read backwards: a frame that ends at the last row is computed anew for every row
    earlier = lambda *order: wc.orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    ends = ends.select(BUCKET, "_first", "_last", F.last("_lk", ignorenulls=True).over(earlier(BUCKET)).alias("_before"),
                       F.last("_fk", ignorenulls=True).over(earlier(F.desc(BUCKET))).alias("_behind"))
    carry = ends.where("_first").select(F.col(BUCKET).alias("_b1"), "_before").join(
        ends.where("_last").select(F.col(BUCKET).alias("_b2"), "_behind"), F.col("_b1") == F.col("_b2"), "inner").drop("_b2")
    j = ranked.join(F.broadcast(carry), F.col(BUCKET) == F.col("_b1"), "inner").drop("_b1")  # a row a range
    upto = lambda order: Window.partitionBy(*s, BUCKET).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    prev = F.coalesce(F.last(known, ignorenulls=True).over(upto(F.asc("_pos"))), F.when(F.col("_first"), F.col("_before")))
    nxt = F.coalesce(F.last(known, ignorenulls=True).over(upto(F.desc("_pos"))), F.when(F.col("_last"), F.col("_behind")))
    j = j.withColumn("_prev", prev).withColumn("_next", nxt)
    filled = (
        F.when(is_known, v)
        .when(F.col("_prev").isNull(), F.lit(None).cast("double"))
        .when(F.col("_next").isNull(), F.col("_prev.v"))
        .otherwise(F.col("_prev.v") + (F.col("_next.v") - F.col("_prev.v"))
                   * (F.col("_pos") - F.col("_prev.p")) / (F.col("_next.p") - F.col("_prev.p")))
    )
    return drop_order(j.withColumn(out, filled)).drop("_before", "_behind", "_prev", "_next")


# ------------------------------------------------------------------ missing dates


def missing_dates(df: DataFrame, date_col: str, group_col: str | None = None) -> DataFrame:
    """Days between first and last date (stepping from the first one's time of day) that are not
    present. Whole table: ``(missing_date)``; per group: ``(group, missing_date)``."""
    spark = df.sparkSession
    dtype = df.schema[date_col].dataType
    d = F.col(date_col) if not isinstance(dtype, T.StringType) else F.to_timestamp(F.col(date_col))
    # distinct days first: a day (or group) with very many rows collapses on the map side
    present = df.select(*([group_col] if group_col else []), d.alias("missing_date")).where(
        F.col("missing_date").isNotNull()).distinct()
    dt = present.schema["missing_date"].dataType
    if group_col is None:
        b = present.agg(F.min("missing_date").alias("lo"), F.max("missing_date").alias("hi")).first()
        if b["lo"] is None:
            return present.limit(0)
        span = (b["hi"] - b["lo"]).days  # two bounds of the calendar, not data
        lo = F.lit(b["lo"].isoformat()).cast(dt)
        step = F.col("id").cast("int")
        day = F.date_add(lo, step) if isinstance(dt, T.DateType) else (lo + F.make_interval(days=step)).cast(dt)
        days = spark.range(0, span + 1).select(day.alias("missing_date"))
        return days.join(present, "missing_date", "left_anti")
    present = present.where(F.col(group_col).isNotNull())
    bounds = present.groupBy(group_col).agg(F.min("missing_date").alias("lo"), F.max("missing_date").alias("hi"))
    days = bounds.select(group_col, F.explode(F.sequence("lo", "hi", F.expr("INTERVAL 1 DAY"))).alias("missing_date"))
    return days.join(present, [group_col, "missing_date"], "left_anti")


# ------------------------------------------------------------------ outliers


def _number(col: str) -> Column:
    """The column as double, NaN as null."""
    x = F.col(col).cast("double")
    return F.when(~F.isnan(x), x)


def _whole_stats(df: DataFrame, col: str) -> tuple[Column, Column]:
    x = _number(col)
    both = df.select(F.struct(F.avg(x).alias("mean"), F.stddev_pop(x).alias("std"))).scalar()
    return both["mean"], both["std"]


def _group_stats(df: DataFrame, col: str, group_col: str) -> DataFrame:
    x = _number(col)
    return df.groupBy(group_col).agg(F.avg(x).alias("_mean"), F.stddev_pop(x).alias("_std"))


def with_zscore(df: DataFrame, col: str, group_col: str | None = None, out: str = "zscore") -> DataFrame:
    """z = (x - mean) / std_pop, whole table or per group (null is a group); zero std, null and NaN give null."""
    x = _number(col)
    if group_col is None:
        mean, std = _whole_stats(df, col)
        return df.withColumn(out, F.try_divide(x - mean, std))
    st = _group_stats(df, col, group_col)
    return null_safe_join(df, st, [group_col], "left").withColumn(out, F.try_divide(x - F.col("_mean"), F.col("_std"))) \
        .drop("_mean", "_std")


def zscore_outliers(df: DataFrame, col: str, group_col: str | None = None, threshold: float = 3.0) -> DataFrame:
    """Rows with abs(z) > threshold (null never counts)."""
    return with_zscore(df, col, group_col).where(F.abs(F.col("zscore")) > F.lit(threshold))


def modified_zscore_outliers(df: DataFrame, col: str, group_col: str | None = None,
                             threshold: float = 3.0) -> DataFrame:
    """Modified z = 0.6745 (x - median) / MAD; rows above ``threshold`` in absolute value."""
    # Fixed value: 0.6745, the normal quantile factor of the published definition.
    g = [group_col] if group_col else []
    x = df.select(*g, _number(col).alias("_x")).where(F.col("_x").isNotNull())
    med = pin(exact_quantiles(x, "_x", {"_med": 0.5}, g), "median")  # one row a group
    if g:
        dev = null_safe_join(x, med, g)
    else:
        dev = x.withColumn("_med", F.lit(med.first()["_med"]).cast("double"))
    mad = exact_quantiles(dev.select(*g, F.abs(F.col("_x") - F.col("_med")).alias("_dev")), "_dev", {"_mad": 0.5}, g)
    if g:
        k = null_safe_join(df, null_safe_join(med, mad, g), g, "left")
    else:
        k = df.withColumns({"_med": med.select("_med").scalar(), "_mad": mad.select("_mad").scalar()})
    mz = F.try_divide(F.lit(0.6745) * (_number(col) - F.col("_med")), F.col("_mad"))
    return k.withColumn("modified_zscore", mz).where(F.abs(F.col("modified_zscore")) > F.lit(threshold)) \
        .drop("_med", "_mad")


def remove_outliers(df: DataFrame, col: str, method: str = "iqr", multiplier: float = 1.5) -> DataFrame:
    """iqr: keep q1 - m*iqr <= x <= q3 + m*iqr; std: keep abs(z) <= m. Nulls and NaN are dropped by both."""
    x = _number(col)
    if method == "iqr":
        both = exact_quantiles(df.select(x.alias("_x")), "_x", {"q1": 0.25, "q3": 0.75}).select(F.struct("q1", "q3")).scalar()
        q1, q3 = both["q1"], both["q3"]
        iqr = q3 - q1
        return df.where((x >= q1 - multiplier * iqr) & (x <= q3 + multiplier * iqr))
    if method == "std":
        mean, std = _whole_stats(df, col)
        return df.where(F.abs(F.try_divide(x - mean, std)) <= F.lit(multiplier))
    raise ValueError(f"remove_outliers knows iqr and std, not {method!r}")


def transform_outliers(df: DataFrame, col: str, method: str = "log") -> DataFrame:
    if method == "log":
        return df.withColumn(col, log1p_safe(col))
    if method == "sqrt":
        return df.withColumn(col, sqrt_safe(col))
    raise ValueError(f"transform_outliers knows log and sqrt, not {method!r}")


def impute_outliers(df: DataFrame, col: str, method: str = "mean") -> DataFrame:
    """mean: abs(x - mean) > 2 std_pop becomes the mean. median: abs(x - median) > 2 * median becomes
    the median; any null in the column makes the median NaN, so nothing changes then."""
    x = F.col(col).cast("double")
    if method == "mean":
        mean, std = _whole_stats(df, col)
        return df.withColumn(col, F.when(F.abs(_number(col) - mean) > 2 * std, mean).otherwise(x))
    if method == "median":
        q = exact_quantiles(df.withColumn("_x", x), "_x", {"m": 0.5})
        med = q.select("m").scalar()
        nulls = df.select(F.count(F.when(x.isNull() | F.isnan(x), 1))).scalar()
        hit = (nulls == 0) & (F.abs(x - med) > 2 * med)
        return df.withColumn(col, F.when(hit, med).otherwise(x))
    raise ValueError(f"impute_outliers knows mean and median, not {method!r}")


# ------------------------------------------------------------------ hooks and text


def clean_chain(df: DataFrame, steps: Iterable[Callable[[DataFrame], DataFrame]] = ()) -> DataFrame:
    """Apply cleaning steps in order; no step means identity."""
    for step in steps:
        df = df.transform(step)
    return df


def clean_data(df: DataFrame) -> DataFrame:
    """Default cleaning hook: identity."""
    return df


def fill_missing_data(df: DataFrame) -> DataFrame:
    """Default fill hook: identity."""
    return df
