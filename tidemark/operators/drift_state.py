"""Drift from daily states: small counts per day and feature, merged over any range of days.

A state row is ``(quarter, day, feature, kind, cell, n)``: the rows of that day whose feature lies in ``cell``, a category or
the number of an equal-width bin (``-`` and ``+`` below and above the bins). The bins of a numeric feature are fixed when the
table is made, from its reference data, and kept in a table beside it, so states of different days add up. A day has at
most features * (bins + 2) numeric rows and one row for each category, whatever the number of raw rows; a look-back of 730 days
reads some ten thousand rows instead of the raw tables.

The table is partitioned by quarter. ``put_days`` replaces whole days: the quarters that hold them are written again with
these days' rows exchanged and the others' kept, so late or corrected days, and reruns, end with the same table.

PSI, Jensen-Shannon and chi-square of merged states are those of the raw rows (the same counts enter). Nulls and NaN are not
counted; infinite values lie outside the bins; rows without a day are an error.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import pin
from ..sources import catalog
from . import drift

STATE_COLUMNS = ["day", "feature", "kind", "cell", "n", "quarter"]
BELOW, ABOVE = "-", "+"


def bins_table(table_name: str) -> str:
    return f"{table_name}_bins"


def reference_bins(reference: DataFrame, numerical, n_bins: int = drift.N_BINS) -> DataFrame:
    """One row per numeric feature: the finite range of the reference and the number of bins."""
    rows = drift.finite(drift.stack_sides(reference, reference.limit(0), numerical)).groupBy("feature") \
        .agg(F.min("value").alias("lo"), F.max("value").alias("hi"))
    return rows.withColumn("bins", F.lit(n_bins))


def daily_states(rows: DataFrame, day: Column, bins: DataFrame, numerical=(), categorical=()) -> DataFrame:
    """States of the days in ``rows``: one scan, combined before the shuffle."""
    numerical, categorical = list(numerical), list(categorical)
    known = {r.feature: r for r in bins.collect()}  # one row per numeric feature
    cells = []
    for c in numerical:
        x, r = F.col(c).cast("double"), known.get(c)
        if r is None:
            cell = F.lit(ABOVE)  # the reference has no finite value: everything lies outside
        else:
            lo, hi = F.lit(r.lo), F.lit(r.hi)
            cell = F.coalesce(drift.bin_of(x, lo, hi, r.bins).cast("string"), F.when(x < lo, BELOW).otherwise(ABOVE))
        cells.append(F.struct(F.lit(c).alias("feature"), F.lit("num").alias("kind"),
                              F.when(x.isNotNull() & ~F.isnan(x), cell).alias("cell")))
    for c in categorical:
        cells.append(F.struct(F.lit(c).alias("feature"), F.lit("cat").alias("kind"), F.col(c).cast("string").alias("cell")))
    dated = F.when(day.isNotNull(), day.cast("date")).otherwise(F.raise_error(F.lit("a row without a day")).cast("date"))
    long = rows.select(dated.alias("day"), F.inline(F.array(*cells)))
    states = long.where(F.col("cell").isNotNull()).groupBy("day", "feature", "kind", "cell").agg(F.count(F.lit(1)).alias("n"))
    return states.withColumn("quarter", F.trunc("day", "quarter")).select(*STATE_COLUMNS)


def create_states(spark: SparkSession, table_name: str, bins: DataFrame) -> None:
    """An empty state table and the table of its bins."""
    bins.write.format("parquet").saveAsTable(bins_table(table_name))
    spark.createDataFrame([], "day date, feature string, kind string, cell string, n long, quarter date") \
        .write.format("parquet").partitionBy("quarter").saveAsTable(table_name)


def put_days(states: DataFrame, table_name: str, days: DataFrame | None = None) -> None:
    """Replace the days of ``states`` (or ``days``, a column ``day``: also those that have no rows any more) in the table."""
    spark = states.sparkSession
    states = pin(states, "states")
    days = (states if days is None else days).select("day").distinct()
    quarters = days.select(F.trunc("day", "quarter").alias("quarter")).distinct()
    old = spark.table(table_name)
    kept = old.join(F.broadcast(quarters), "quarter", "left_semi").join(F.broadcast(days), "day", "left_anti")  # some thousand days
    new = pin(kept.select(*STATE_COLUMNS).unionByName(states.select(*STATE_COLUMNS)), "quarters")  # its source is overwritten below
    # one task writes a quarter's file (days * features * cells rows); a quarter that loses its last row is dropped
    catalog.overwrite_partitions(new.repartition("quarter").sortWithinPartitions("quarter", "day", "feature"), table_name)
    gone = quarters.join(F.broadcast(new.select("quarter").distinct()), "quarter", "left_anti")
    for r in gone.collect():  # quarters, not rows
        spark.sql(f"ALTER TABLE {catalog.quote(table_name)} DROP IF EXISTS PARTITION (quarter = DATE'{r.quarter}')")
    spark.catalog.refreshTable(table_name)


def merged(states: DataFrame, first, last) -> DataFrame:
    """Counts per (feature, kind, cell) of the days from ``first`` up to and without ``last`` (None: open)."""
    out = states
    if first is not None:
        first = F.lit(first).cast("date")
        out = out.where((F.col("day") >= first) & (F.col("quarter") >= F.trunc(first, "quarter")))  # prunes partitions
    if last is not None:
        last = F.lit(last).cast("date")
        out = out.where((F.col("day") < last) & (F.col("quarter") <= F.trunc(last, "quarter")))
    return out.groupBy("feature", "kind", "cell").agg(F.sum("n").alias("n"))


def drift_report(reference: DataFrame, current: DataFrame, num_stattest: str = "psi", cat_stattest: str = "jensenshannon",
                 num_threshold: float | None = None, cat_threshold: float | None = None) -> DataFrame:
    """Per-feature drift rows, as :func:`drift.drift_report`, from two merged states. Numeric features: psi over the bins
    (values outside count in the totals), or jensenshannon over the bins and the two cells outside."""
    sides = reference.select("feature", "kind", F.col("cell").alias("value"), F.col("n").alias("ref_n"), F.lit(0).cast("long").alias("cur_n")) \
        .unionByName(current.select("feature", "kind", F.col("cell").alias("value"), F.lit(0).cast("long").alias("ref_n"), F.col("n").alias("cur_n")))
    counts = sides.groupBy("feature", "kind", "value").agg(F.sum("ref_n").alias("ref_n"), F.sum("cur_n").alias("cur_n"))
    parts = []
    for kind, test, threshold in (("num", num_stattest, num_threshold), ("cat", cat_stattest, cat_threshold)):
        shares = drift.count_shares(counts.where(F.col("kind") == kind))
        if test == "psi":
            inside = shares if kind == "cat" else shares.where(~F.col("value").isin(BELOW, ABOVE))
            part = drift._report(drift._psi(inside), "psi", F.col("score"), threshold)
        elif test == "jensenshannon":
            part = drift._report(drift._js(shares), "jensenshannon", F.col("score"), threshold)
        elif test == "chisquare" and kind == "cat":
            part = drift.chisquare_report(drift.chisquare_of_shares(shares), threshold)
        else:
            raise ValueError(f"no {test} of merged states of kind {kind}")
        parts.append(part)
    return parts[0].unionByName(parts[1])
