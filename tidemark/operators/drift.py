"""Drift statistics between a reference and a current sample, per feature, on whole tables.

Both sides are stacked into one long frame ``(feature, value, side)`` so that every statistic is
one grouped plan over all features:

* numeric: counts per distinct value, bucketed running totals (no global window) for KS and
  Wasserstein; equal-width bins for PSI and Jensen-Shannon;
* categorical: counts per category for PSI, Jensen-Shannon, chi-square and the two-proportion z test.

Published definitions are used (see README); the automatic choice of test and the thresholds are
parameters with defaults, so they can be corrected in one place.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.scalar import ks_pvalue, std_normal_cdf
from ..plans.ordered import running_totals

# Default thresholds and bin counts of the drift tests.
DEFAULT_THRESHOLDS = {
    "ks": 0.05, "psi": 0.1, "wasserstein": 0.1, "jensenshannon": 0.1, "chisquare": 0.05, "z": 0.05,
}
P_VALUE_TESTS = ("ks", "chisquare", "z")  # drift when p < threshold; the others when score >= threshold
PSI_EMPTY_SHARE = 0.0001
N_BINS = 30
WASSERSTEIN_MIN_STD = 0.001
DEFAULT_TESTS = {"num": "wasserstein", "cat": "jensenshannon"}
DATASET_DRIFT_SHARE = 0.5

REPORT_COLUMNS = ["feature", "stattest", "drift_score", "threshold", "drift_detected"]


# ---------------------------------------------------------------------- stacking


def stack_sides(reference: DataFrame, current: DataFrame, features, numeric: bool = True) -> DataFrame:
    """Long frame ``(feature, value, side)``; side 0 = reference, 1 = current. Nulls and NaN dropped."""
    feats = list(features)
    cast = "double" if numeric else "string"

    def side(df, s):
        wide = df.select(*[F.col(c).cast(cast).alias(c) for c in feats])
        long = wide.unpivot([], feats, "feature", "value").withColumn("side", F.lit(s))
        ok = F.col("value").isNotNull()
        if numeric:
            ok = ok & ~F.isnan("value")
        return long.where(ok)

    return side(reference, 0).unionByName(side(current, 1))


def _side_counts(long: DataFrame, keys) -> DataFrame:
    return long.groupBy(*keys).agg(
        F.count(F.when(F.col("side") == 0, 1)).alias("ref_n"),
        F.count(F.when(F.col("side") == 1, 1)).alias("cur_n"),
    )


def _with_totals(counts: DataFrame, by: str = "feature") -> DataFrame:
    """Side totals per feature, aggregated and broadcast back (one row per feature), so a feature
    with very many categories is never gathered into one task."""
    tot = counts.groupBy(by).agg(F.sum("ref_n").alias("ref_total"), F.sum("cur_n").alias("cur_total"))
    return counts.join(F.broadcast(tot), by, "inner")


def _report(df: DataFrame, test: str, score: Column, threshold: float | None) -> DataFrame:
    thr = DEFAULT_THRESHOLDS[test] if threshold is None else float(threshold)
    # a side without rows, and a score that is no number, is no score and no drift
    score = F.when(~F.isnan(score), score)
    detected = F.coalesce((score < F.lit(thr)) if test in P_VALUE_TESTS else (score >= F.lit(thr)), F.lit(False))
    return df.select("feature", F.lit(test).alias("stattest"), score.alias("drift_score"),
                     F.lit(thr).alias("threshold"), detected.alias("drift_detected"))


def finite(long: DataFrame) -> DataFrame:
    """Rows with finite values: distances and bins have no place for infinite ones."""
    return long.where(F.abs("value") != F.lit(float("inf")))


# ---------------------------------------------------------------------- numeric tests


def ks_test(long: DataFrame, threshold: float | None = None, n_buckets: int | None = None) -> DataFrame:
    """Two-sample KS per feature: D = max |F_ref - F_cur|, asymptotic p-value."""
    vc = _side_counts(long, ["feature", "value"])
    rows = running_totals(vc, "value", ["ref_n", "cur_n"], ["feature"], n_buckets)
    d = rows.groupBy("feature").agg(
        F.max(F.abs(F.try_divide("ref_n_upto", "ref_n_total") - F.try_divide("cur_n_upto", "cur_n_total")))
        .alias("d"),
        F.first("ref_n_total").alias("n"), F.first("cur_n_total").alias("m"))
    return _report(d, "ks", F.when(F.col("d").isNotNull(), ks_pvalue(F.col("d"), F.col("n"), F.col("m"))), threshold)


def ks_statistic(long: DataFrame, n_buckets: int | None = None) -> DataFrame:
    vc = _side_counts(long, ["feature", "value"])
    rows = running_totals(vc, "value", ["ref_n", "cur_n"], ["feature"], n_buckets)
    return rows.groupBy("feature").agg(
        F.max(F.abs(F.try_divide("ref_n_upto", "ref_n_total") - F.try_divide("cur_n_upto", "cur_n_total")))
        .alias("ks_d"),
        F.first("ref_n_total").alias("ref_rows"), F.first("cur_n_total").alias("cur_rows"))


def wasserstein_test(long: DataFrame, threshold: float | None = None, n_buckets: int | None = None) -> DataFrame:
    """W1 distance between the empirical distributions of the finite values, divided by max(std_pop(reference), 0.001)."""
    long = finite(long)
    vc = _side_counts(long, ["feature", "value"])
    rows = running_totals(vc, "value", ["ref_n", "cur_n"], ["feature"], n_buckets, next_col="_next")
    gap = F.coalesce(F.col("_next") - F.col("value"), F.lit(0.0))
    cdf_gap = F.abs(F.try_divide("ref_n_upto", "ref_n_total") - F.try_divide("cur_n_upto", "cur_n_total"))
    w = rows.groupBy("feature").agg(F.sum(cdf_gap * gap).alias("w"))
    sd = long.groupBy("feature").agg(F.stddev_pop(F.when(F.col("side") == 0, F.col("value"))).alias("sd"))
    j = w.join(sd, "feature", "inner")
    score = F.col("w") / F.greatest(F.col("sd"), F.lit(WASSERSTEIN_MIN_STD))
    return _report(j, "wasserstein", score, threshold)


def _numeric_bins(long: DataFrame, n_bins: int, range_side: int | None) -> DataFrame:
    """Equal-width bin per value over the finite range of the reference (``range_side=0``; values outside it get no
    bin) or of both sides (``None``; infinite values go to the end bins); the last bin is closed."""
    src = finite(long if range_side is None else long.where(F.col("side") == range_side))
    rng = src.groupBy("feature").agg(F.min("value").alias("lo"), F.max("value").alias("hi"))
    j = long.join(F.broadcast(rng), "feature", "inner")  # one row per feature
    if range_side is None:
        j = j.withColumn("value", F.greatest("lo", F.least("hi", "value")))
    return j.withColumn("bin", bin_of(F.col("value"), F.col("lo"), F.col("hi"), n_bins)).drop("lo", "hi")


def bin_of(value: Column, lo: Column, hi: Column, n_bins: int) -> Column:
    """Number of the equal-width bin of [lo, hi], the last one closed; null outside."""
    width = (hi - lo) / F.lit(float(n_bins))
    b = F.when(hi == lo, F.lit(0)).otherwise(F.least(F.floor((value - lo) / width), F.lit(n_bins - 1)))
    return F.when((value >= lo) & (value <= hi), b.cast("int"))


def _binned_shares(long: DataFrame, n_bins: int, range_side: int | None) -> DataFrame:
    """Shares per (feature, bin) of each side; side totals include values outside every bin.

    One aggregate over (feature, bin) - the null bin holds the out-of-range values - and the totals
    come from a window over that small table (at most features * (n_bins + 1) rows).
    """
    counts = _side_counts(_numeric_bins(long, n_bins, range_side), ["feature", "bin"])
    w = Window.partitionBy("feature")
    return (
        counts.select("feature", "bin", "ref_n", "cur_n",
                      F.sum("ref_n").over(w).alias("ref_total"), F.sum("cur_n").over(w).alias("cur_total"))
        .where(F.col("bin").isNotNull())
        .select("feature", "bin", F.try_divide("ref_n", "ref_total").alias("p"),
                F.try_divide("cur_n", "cur_total").alias("q"))
    )


def _psi(shares: DataFrame) -> DataFrame:
    p = F.when(F.col("p") == 0, F.lit(PSI_EMPTY_SHARE)).otherwise(F.col("p"))
    q = F.when(F.col("q") == 0, F.lit(PSI_EMPTY_SHARE)).otherwise(F.col("q"))
    return shares.groupBy("feature").agg(F.sum((q - p) * F.log(q / p)).alias("score"))


def _js(shares: DataFrame) -> DataFrame:
    m = (F.col("p") + F.col("q")) / 2
    kl_p = F.when(F.col("p") > 0, F.col("p") * F.log(F.col("p") / m)).otherwise(F.lit(0.0))
    kl_q = F.when(F.col("q") > 0, F.col("q") * F.log(F.col("q") / m)).otherwise(F.lit(0.0))
    known = F.bool_and(F.col("p").isNotNull() & F.col("q").isNotNull())
    return shares.groupBy("feature").agg(
        F.when(known, F.sqrt(F.greatest((F.sum(kl_p) + F.sum(kl_q)) / 2, F.lit(0.0)))).alias("score"))


def psi_numeric(long: DataFrame, threshold: float | None = None, n_bins: int = N_BINS) -> DataFrame:
    """PSI over equal-width bins of the reference range; empty shares become 0.0001."""
    s = _psi(_binned_shares(long, n_bins, 0))
    return _report(s, "psi", F.col("score"), threshold)


def jensenshannon_numeric(long: DataFrame, threshold: float | None = None, n_bins: int = N_BINS) -> DataFrame:
    """Jensen-Shannon distance (natural log) over equal-width bins of the joint range."""
    s = _js(_binned_shares(long, n_bins, None))
    return _report(s, "jensenshannon", F.col("score"), threshold)


# ---------------------------------------------------------------------- categorical tests


def _category_shares(long: DataFrame) -> DataFrame:
    return count_shares(_side_counts(long, ["feature", "value"]))


def count_shares(counts: DataFrame) -> DataFrame:
    """Counts per (feature, value) of both sides with the sides' totals and shares."""
    c = _with_totals(counts)
    return c.select("feature", "value", "ref_n", "cur_n", "ref_total", "cur_total",
                    F.try_divide("ref_n", "ref_total").alias("p"), F.try_divide("cur_n", "cur_total").alias("q"))


def psi_categorical(long: DataFrame, threshold: float | None = None) -> DataFrame:
    return _report(_psi(_category_shares(long)), "psi", F.col("score"), threshold)


def jensenshannon_categorical(long: DataFrame, threshold: float | None = None) -> DataFrame:
    return _report(_js(_category_shares(long)), "jensenshannon", F.col("score"), threshold)


def chisquare_statistic(long: DataFrame) -> DataFrame:
    """Chi-square of current counts against reference shares scaled to the current size, over the
    categories seen in the reference; dof = categories - 1."""
    return chisquare_of_shares(_category_shares(long))


def chisquare_of_shares(shares: DataFrame) -> DataFrame:
    s = shares.where(F.col("ref_n") > 0)
    e = F.col("p") * F.col("cur_total")
    return s.groupBy("feature").agg(
        F.sum(F.try_divide((F.col("cur_n") - e) * (F.col("cur_n") - e), e)).alias("chi2"),
        (F.count(F.lit(1)) - 1).alias("dof"))


def _erfc_sqrt(z: Column) -> Column:
    """erfc(sqrt(z)) as one minus the series of the lower tail; its number of terms follows ``z`` (beyond 1000 the
    tail is below the smallest double)."""
    first = F.log(z) / 2 - z - F.lit(math.lgamma(1.5))
    near = F.least(z, F.lit(1000.0))
    steps = F.sequence(F.lit(1), F.ceil(near + 12 * F.sqrt(near) + 60).cast("int"))
    lower = F.aggregate(
        steps, F.struct(first.alias("t"), F.exp(first).alias("s")),
        lambda a, n: F.struct((a["t"] + F.log(z) - F.log(n + 0.5)).alias("t"),
                              (a["s"] + F.exp(a["t"] + F.log(z) - F.log(n + 0.5))).alias("s")))["s"]
    return F.when(z > 1000, F.lit(0.0)).otherwise(1 - lower)


def chi2_pvalue(x: Column, k: Column) -> Column:
    """Upper tail of the chi-square distribution with ``k`` (whole) degrees of freedom: the finite series of the
    regularised gamma function, its terms carried as logarithms. One term for every two degrees."""
    z, half = x / 2, F.floor(k / 2).cast("int")
    odd = k % 2 == 1
    first = F.when(odd, F.lit(0.5 * math.log(4 / math.pi)) + F.log(z) / 2).otherwise(F.lit(0.0)) - z
    shift = F.when(odd, F.lit(0.5)).otherwise(F.lit(0.0))
    # the term of i over the one before: z / (i + shift)
    steps = F.when(half > 1, F.sequence(F.lit(1), half - 1)).otherwise(F.array().cast("array<int>"))
    series = F.aggregate(
        steps, F.struct(first.alias("t"), F.exp(first).alias("s")),
        lambda a, i: F.struct((a["t"] + F.log(z) - F.log(i + shift)).alias("t"),
                              (a["s"] + F.exp(a["t"] + F.log(z) - F.log(i + shift))).alias("s")))["s"]
    tail = F.when(odd, _erfc_sqrt(z)).otherwise(F.lit(0.0)) + F.when(half > 0, series).otherwise(F.lit(0.0))
    return F.when((k <= 0) | x.isNull() | F.isnan(x), F.lit(float("nan"))).when(x <= 0, F.lit(1.0)) \
        .otherwise(F.least(F.lit(1.0), F.greatest(F.lit(0.0), tail)))


def chisquare_test(long: DataFrame, threshold: float | None = None) -> DataFrame:
    return chisquare_report(chisquare_statistic(long), threshold)


def chisquare_report(st: DataFrame, threshold: float | None = None) -> DataFrame:
    p = F.when(F.col("chi2").isNotNull(), chi2_pvalue(F.col("chi2"), F.col("dof")))
    return _report(st, "chisquare", p, threshold)


def z_test(long: DataFrame, threshold: float | None = None) -> DataFrame:
    """Two-proportion z test on the share of the larger of two categories; more categories are an error."""
    s = _category_shares(long)
    kinds = s.groupBy("feature").agg(F.count(F.lit(1)).alias("_k"))  # one row per feature
    few = F.coalesce(F.when(F.col("_k") > 2, F.raise_error(F.concat(
        F.lit("the z test needs a feature of two categories: "), F.col("feature"))).cast("boolean")), F.lit(True))
    two = s.join(F.broadcast(kinds), "feature", "inner").where(few)  # at most two rows per feature from here on
    j = two.withColumn("_top", F.max("value").over(Window.partitionBy("feature"))).where(F.col("value") == F.col("_top"))
    pooled = F.try_divide(F.col("ref_n") + F.col("cur_n"), F.col("ref_total") + F.col("cur_total"))
    se = F.sqrt(pooled * (1 - pooled) * (F.try_divide(F.lit(1), F.col("ref_total")) + F.try_divide(F.lit(1), F.col("cur_total"))))
    z = F.try_divide(F.col("p") - F.col("q"), se)
    p_value = F.when(z.isNull(), F.lit(1.0)).otherwise(2 * (1 - std_normal_cdf(F.abs(z))))
    empty = (F.col("ref_total") == 0) | (F.col("cur_total") == 0)
    return _report(j, "z", F.when(~empty, p_value), threshold)


# ---------------------------------------------------------------------- reports

NUMERIC_TESTS = {"ks": ks_test, "wasserstein": wasserstein_test, "psi": psi_numeric,
                 "jensenshannon": jensenshannon_numeric}
CATEGORICAL_TESTS = {"psi": psi_categorical, "jensenshannon": jensenshannon_categorical,
                     "chisquare": chisquare_test, "z": z_test}


def choose_tests(reference: DataFrame, features, numeric_hint: dict | None = None) -> dict:
    """The default test of each feature's kind: numeric by type unless ``numeric_hint`` says otherwise. Neither row
    counts nor distinct counts play a part, so a job behaves alike at every size; other tests are named."""
    types = {f.name: f.dataType for f in reference.schema.fields}
    out = {}
    for c in features:
        numeric = isinstance(types[c], T.NumericType)
        if numeric_hint and c in numeric_hint:
            numeric = numeric_hint[c]
        kind = "num" if numeric else "cat"
        out[c] = (kind, DEFAULT_TESTS[kind])
    return out


def drift_report(reference: DataFrame, current: DataFrame, numerical=(), categorical=(),
                 num_stattest: str | None = None, cat_stattest: str | None = None,
                 num_threshold: float | None = None, cat_threshold: float | None = None) -> DataFrame:
    """Per-feature drift rows ``(feature, stattest, drift_score, threshold, drift_detected)``.

    With a test named per kind, it is used for all features of that kind; otherwise the default of the
    kind applies. Every feature has its row: one without rows on a side has a null score, and never drift.
    """
    plan = {}
    if num_stattest is None or cat_stattest is None:
        auto = choose_tests(reference, list(numerical) + list(categorical),
                            {**{c: True for c in numerical}, **{c: False for c in categorical}})
    for c in numerical:
        plan[c] = ("num", num_stattest) if num_stattest else auto[c]
    for c in categorical:
        plan[c] = ("cat", cat_stattest) if cat_stattest else auto[c]
    parts = []
    for kind in ("num", "cat"):
        by_test: dict[str, list[str]] = {}
        for c, (k, t) in plan.items():
            if k == kind:
                by_test.setdefault(t, []).append(c)
        for t, cols in sorted(by_test.items()):
            long = stack_sides(reference, current, cols, numeric=(kind == "num"))
            if kind == "num":
                parts.append(NUMERIC_TESTS[t](long, num_threshold))
            else:
                parts.append(CATEGORICAL_TESTS[t](long, cat_threshold))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    given = {"num": num_threshold, "cat": cat_threshold}
    return every_feature(out, [(c, t, float(DEFAULT_THRESHOLDS[t] if given[k] is None else given[k])) for c, (k, t) in plan.items()])


def every_feature(report: DataFrame, wanted) -> DataFrame:
    """The report with a row for each of ``wanted`` (feature, stattest, threshold), also those that no value reached."""
    all_ = report.sparkSession.createDataFrame(list(wanted), "feature string, stattest string, threshold double")
    found = report.select(F.col("feature").alias("_f"), F.col("stattest").alias("_t"), "drift_score", "drift_detected")
    j = all_.join(F.broadcast(found), (F.col("feature") == F.col("_f")) & (F.col("stattest") == F.col("_t")), "left")  # a row a feature
    return j.select("feature", "stattest", "drift_score", "threshold",
                    F.coalesce("drift_detected", F.lit(False)).alias("drift_detected"))


def dataset_drift(report: DataFrame, share: float = DATASET_DRIFT_SHARE) -> DataFrame:
    """Summary row: number of columns, drifted columns, their share, dataset drift flag."""
    return report.agg(
        F.count(F.lit(1)).alias("number_of_columns"),
        F.count(F.when(F.col("drift_detected"), 1)).alias("number_of_drifted_columns"),
    ).select(
        "number_of_columns", "number_of_drifted_columns",
        (F.col("number_of_drifted_columns") / F.col("number_of_columns")).alias("share_of_drifted_columns"),
        (F.col("number_of_drifted_columns") / F.col("number_of_columns") >= F.lit(share)).alias("dataset_drift"),
    )


def drift_metrics(report: DataFrame, features, share: float = DATASET_DRIFT_SHARE) -> DataFrame:
    """One row with the keys of the monitoring table: drift_detected, drift_score (share of drifted columns),
    number_of_drifted_columns, number_of_columns, and ``{col}__drift_score``, ``{col}__drift_detected``."""
    one = lambda c, x: F.max(F.when(F.col("feature") == c, F.col(x)))
    n, drifted = F.count(F.lit(1)), F.count(F.when(F.col("drift_detected"), 1))
    wide = report.agg(n.alias("number_of_columns"), drifted.alias("number_of_drifted_columns"),
                      *[one(c, "drift_score").alias(f"{c}__drift_score") for c in features],
                      *[one(c, "drift_detected").alias(f"{c}__drift_detected") for c in features])
    ratio = F.try_divide(F.col("number_of_drifted_columns"), F.col("number_of_columns"))
    return wide.select(F.coalesce(ratio >= F.lit(share), F.lit(False)).alias("drift_detected"), ratio.alias("drift_score"),
                       "number_of_drifted_columns", "number_of_columns",
                       *[x for c in features for x in (f"{c}__drift_score", f"{c}__drift_detected")])
