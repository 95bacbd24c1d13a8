"""Exact quantiles of numeric columns in two scans, without writing or sorting the values.

1. A mergeable sketch (``approx_percentile``, rank error at most 1 / ``ACCURACY``) gives every quantile a bracket: two
   values between which it lies. Columns (and groups) of at most ``ACCURACY`` rows take their whole range.
2. The next scan counts rows: values inside a bracket one by one, those between brackets as one row. What is kept is a
   share of about 6 / ``ACCURACY`` of the values for each quantile; it is pinned.
3. A bracket is divided into cells by value; totals of cells tell the cell that holds the wanted row, and a window inside
   this cell finds the value. So no task holds more than one cell of one column and group.

Should a bracket miss (it is checked by the counts), the brackets are widened and the scan is repeated. Nulls and NaN
are skipped; null groups are groups. Whole-number columns are compared as whole numbers, others as doubles; results
are doubles, interpolated linearly (pandas ``quantile``, SQL ``quantile_cont``).
"""

from __future__ import annotations

import math
from typing import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import pin
from .ordered import null_safe_join

ACCURACY = 10_000
MARGIN = 3.0 / ACCURACY     # of the rows, on either side of a quantile
CELLS = 256                 # of a bracket
WIDEN = 16

COLUMN = "column"


def number(c: str, dtype: T.DataType) -> Column:
    """The column as bigint (whole numbers) or double, NaN as null."""
    x = F.col("`" + c.replace("`", "``") + "`")
    if isinstance(dtype, T.IntegralType):
        return x.cast("long")
    x = x.cast("double")
    return F.when(~F.isnan(x), x)


def _sketch(x: Column, probs: Sequence[float], margin: float) -> list[Column]:
    """Aggregates of one column: rows, moments, least, largest, and the values around the quantiles (lower, upper)."""
    points = [p for q in probs for p in (max(0.0, q - margin), min(1.0, q + margin))]
    return [F.count(x).alias("n"), F.avg(x).alias("mean"), F.stddev_samp(x).alias("std"), F.stddev_pop(x).alias("std_pop"),
            F.min(x).alias("lo"), F.max(x).alias("hi"), F.percentile_approx(x, [float(p) for p in points], ACCURACY).alias("points")]


def column_profile(df: DataFrame, cols: Sequence[str], probs: dict[str, float], group_cols=None) -> DataFrame:
    """One row per group and column: count, mean, std (sample), std_pop, min, max of its values, and one double for each
    entry of ``probs`` (name -> probability). Everything comes from the same two scans."""
    g = [group_cols] if isinstance(group_cols, str) else list(group_cols or [])
    inner = [f"_g{i}" for i in range(len(g))]  # no name of a group column meets one used here
    margin = MARGIN
    while True:
        stats, found, missed = _quantiles(df, list(cols), probs, dict(zip(inner, g)), margin)
        if not missed:
            return null_safe_join(stats, found, [*inner, COLUMN], "left").withColumnsRenamed(dict(zip(inner, g)))
        margin = min(1.0, margin * WIDEN)


def column_quantiles(df: DataFrame, cols: Sequence[str], probs: dict[str, float], group_cols=None) -> DataFrame:
    """:func:`column_profile`, the quantiles only, of groups and columns that have a value."""
    return column_profile(df, cols, probs, group_cols).where(F.col("count") > 0) \
        .drop("count", "mean", "std", "std_pop", "min", "max")


def _quantiles(df: DataFrame, cols: list[str], probs: dict[str, float], groups: dict[str, str], margin: float):
    """Statistics of the sketch, quantiles, and whether a bracket missed."""
    names = [f"_x{i}" for i in range(len(cols))]
    order = sorted(probs, key=lambda name: (probs[name], name))
    g, spark = list(groups), df.sparkSession
    wide = df.select(*[F.col("`" + c.replace("`", "``") + "`").alias(n) for n, c in groups.items()],
                     *[number(c, df.schema[c].dataType).alias(n) for c, n in zip(cols, names)])
    sketch = wide.groupBy(*g).agg(*[F.struct(*_sketch(F.col(n), [probs[k] for k in order], margin)).alias(n) for n in names])
    if g:
        sketch = pin(sketch, "sketch")  # one row a group
        stats = sketch.select(*g, F.explode(F.array(*[F.struct(
            F.lit(c).alias(COLUMN), F.col(f"{n}.n").alias("count"), F.col(f"{n}.mean").alias("mean"), F.col(f"{n}.std").alias("std"),
            F.col(f"{n}.std_pop").alias("std_pop"), F.col(f"{n}.lo").cast("double").alias("min"),
            F.col(f"{n}.hi").cast("double").alias("max")) for c, n in zip(cols, names)])).alias("s")).select(*g, "s.*")
    else:  # one row
        one = sketch.first()
        real = lambda x: None if x is None else float(x)
        stats = spark.createDataFrame(
            [(c, x.n, x.mean, x.std, x.std_pop, real(x.lo), real(x.hi)) for c, x in ((c, one[n]) for c, n in zip(cols, names))],
            f"{COLUMN} string, count long, mean double, std double, std_pop double, min double, max double")

    # brackets per column: ascending (lower, upper), the whole range when there are few rows
    ends = [(k, i, end) for k in range(len(order)) for i, end in enumerate(("lo", "hi"))]
    if g:
        rows = null_safe_join(wide, sketch.select(*g, *[
            F.when(F.col(f"{n}.n") <= ACCURACY, F.col(f"{n}.{end}")).otherwise(F.col(f"{n}.points")[2 * k + i]).alias(f"{n}_{2 * k + i}")
            for n in names for k, i, end in ends]), g)
    else:
        bound = lambda x, k, i, end: x[end] if x.n <= ACCURACY else x.points[2 * k + i]
        rows = wide.withColumns({f"{n}_{2 * k + i}": F.lit(bound(one[n], k, i, end)).cast(wide.schema[n].dataType)
                                 for n in names for k, i, end in ends})

    def cell(n: str) -> Column:
        """0 below the first bracket, 1 to CELLS inside it, the next number above it, and so on: rising with the value."""
        x, out = F.col(n), None
        for k in range(len(order)):
            lo, hi = F.col(f"{n}_{2 * k}"), F.col(f"{n}_{2 * k + 1}")
            width = hi.cast("double") - lo.cast("double")
            share = F.when(width > 0, (x.cast("double") - lo.cast("double")) / width).otherwise(0.0)  # NaN at infinite ends
            part = F.when(F.isnan(share), 0).otherwise(F.least(F.lit(CELLS - 1), F.floor(share * CELLS)))
            base = k * (CELLS + 1)
            out = (F.when(x < lo, base) if out is None else out.when(x < lo, base)).when(x <= hi, base + 1 + part)
        return F.when(x.isNotNull(), out.otherwise(len(order) * (CELLS + 1)).cast("int"))

    # whole numbers and doubles in columns of their own: one scan for both
    whole = [isinstance(wide.schema[n].dataType, T.LongType) for n in names]
    celled = rows.select(*g, *[F.col(n) for n in names], *[cell(n).alias(f"{n}_c") for n in names])
    inside = lambda n: F.when(F.col(f"{n}_c") % (CELLS + 1) != 0, F.col(n))
    entries = celled.select(*g, F.inline(F.array(*[F.struct(
        F.lit(i).alias("_i"), F.col(f"{n}_c").alias("cell"),
        (inside(n) if w else F.lit(None).cast("long")).alias("whole"), (F.lit(None).cast("double") if w else inside(n)).alias("value"))
        for i, (n, w) in enumerate(zip(names, whole))])))
    kept = entries.where(F.col("cell").isNotNull()).groupBy(*g, "_i", "cell", "whole", "value").agg(F.count(F.lit(1)).alias("n"))
    kept = pin(kept.select(*g, F.get(F.array(*[F.lit(c) for c in cols]), F.col("_i")).alias(COLUMN), "cell", "whole", "value", "n"), "brackets")

    keys = [*g, COLUMN]
    per_cell = kept.groupBy(*keys, "cell").agg(F.sum("n").alias("n"))  # at most (quantiles + 1) * (CELLS + 1) a column and group
    targets = _targets(per_cell, keys, order, probs) if g else _targets_of_columns(spark, per_cell.collect(), order, probs)
    missed = bool(targets.where(F.col("cell") % (CELLS + 1) == 0).limit(1).count()) if g else \
        any(t.cell % (CELLS + 1) == 0 for t in targets.collect())
    if missed:
        return stats, None, True

    upto = Window.partitionBy(*keys, "cell").orderBy("whole", "value").rowsBetween(Window.unboundedPreceding, 0)
    last = F.col("before") + F.sum("n").over(upto)
    running = null_safe_join(kept, targets, [*keys, "cell"]).select(
        *keys, F.coalesce(F.col("whole").cast("double"), "value").alias("value"), "n", last.alias("last"), "total", "wanted")
    hits = running.select(*keys, "value", "total", F.explode(F.filter("wanted", lambda t: (t["rank"] <= F.col("last")) & (
        t["rank"] > F.col("last") - F.col("n")))).alias("t")).select(*keys, "value", "total", "t.name", "t.side")
    if not g:  # two rows for each column and quantile
        return stats, spark.createDataFrame(list(_interpolated(hits.collect(), probs)), f"{COLUMN} string, " + ", ".join(
            f"`{name}` double" for name in probs)), False
    pick = lambda name, i: F.max(F.when((F.col("name") == name) & (F.col("side") == i), F.col("value")))
    sides = hits.groupBy(*keys).agg(F.max("total").alias("total"), *[pick(name, i).alias(f"_{i}{name}") for name in order for i in (0, 1)])

    def interpolated(name):
        at = (F.col("total") - 1) * F.lit(float(probs[name]))
        low, high = F.col(f"_0{name}"), F.col(f"_1{name}")
        return F.when(low == high, low).otherwise(low + (high - low) * (at - F.floor(at))).alias(name)

    return stats, sides.select(*keys, *[interpolated(name) for name in probs]), False


def _targets(per_cell: DataFrame, keys: list[str], order: list[str], probs: dict[str, float]) -> DataFrame:
    """The cells that hold wanted rows (the two around every quantile): (keys, cell, before, total, wanted), where wanted
    lists (name, rank, side)."""
    w = Window.partitionBy(*keys)
    upto = F.sum("n").over(w.orderBy("cell").rowsBetween(Window.unboundedPreceding, 0))
    cells = per_cell.select(*keys, "cell", (upto - F.col("n")).alias("before"), upto.alias("upto"), F.sum("n").over(w).alias("total"))
    wanted = F.array(*[F.struct(F.lit(name).alias("name"), (f((F.col("total") - 1) * F.lit(float(probs[name]))).cast("long") + 1).alias("rank"),
                                F.lit(side).alias("side")) for name in order for side, f in enumerate((F.floor, F.ceil))])
    found = cells.select(*keys, "cell", "before", "total", F.explode(F.filter(
        wanted, lambda t: (t["rank"] > F.col("before")) & (t["rank"] <= F.col("upto")))).alias("t"))
    per = found.groupBy(*keys, "cell").agg(F.max("before").alias("before"), F.max("total").alias("total"), F.collect_list("t").alias("wanted"))
    return pin(per, "targets")


def _targets_of_columns(spark, cells, order: list[str], probs: dict[str, float]) -> DataFrame:
    """:func:`_targets` without groups: the cells of a few columns, read off on the driver."""
    rows, totals, sofar = [], {}, {}
    for c in cells:
        totals[c[COLUMN]] = totals.get(c[COLUMN], 0) + c.n
    for c in sorted(cells, key=lambda c: c.cell):
        column, before, mine = c[COLUMN], sofar.get(c[COLUMN], 0), []
        sofar[column] = before + c.n
        for name in order:
            at = (totals[column] - 1) * float(probs[name])
            ranks = enumerate((math.floor(at) + 1, math.ceil(at) + 1))
            mine.extend((name, rank, side) for side, rank in ranks if before < rank <= before + c.n)
        if mine:
            rows.append((column, c.cell, before, totals[column], mine))
    return spark.createDataFrame(rows, f"{COLUMN} string, cell int, before long, total long, "
                                       "wanted array<struct<name:string,rank:long,side:int>>")


def _interpolated(hits, probs: dict[str, float]):
    """One tuple per column: its name and quantiles."""
    found, totals = {}, {}
    for h in hits:
        found[h[COLUMN], h.name, h.side] = h.value
        totals[h[COLUMN]] = h.total
    for column, total in totals.items():
        out = [column]
        for name, p in probs.items():
            at, low, high = (total - 1) * float(p), found[column, name, 0], found[column, name, 1]
            out.append(low if low == high else low + (high - low) * (at - math.floor(at)))
        yield tuple(out)


def exact_quantiles(df: DataFrame, value_col: str, probs: dict[str, float], group_cols=None) -> DataFrame:
    """Exact quantiles of one column: one row per group that has a value (one row, nulls if there is none, without
    groups), one column per entry of ``probs``."""
    g = [group_cols] if isinstance(group_cols, str) else list(group_cols or [])
    q = column_quantiles(df, [value_col], probs, g)
    if g:
        return q.drop(COLUMN)
    return q.agg(*[F.max(name).alias(name) for name in probs])
