"""Registered queries: every statistic on columns with made holes (infinite, NaN, null, an empty side); see README, "One rule
for holes". The key rules only change values: all rows take part."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import clean, drift, profile, quality
from ..sources.testdata import table
from . import domain
from .queries import SQL_BQ_COLUMNS, SQL_LABELLED, register, rounded, sql_binary_quality
from .queries_drift import SQL_JS, SQL_PSI, SQL_VC, _sql_bins, _sql_report, sql_ks_pvalue

CUT = "2024-01-16 00:00:00"


def holed_events(spark, sf_dir):
    """``events`` values with holes: inf, -inf, NaN and null on some event ids; ``void`` has no value before the cut."""
    ev = table(spark, sf_dir, "events")
    i, inf = F.col("event_id"), F.lit(float("inf"))
    x = F.when(i % 97 == 0, inf).when(i % 101 == 0, -inf).when(i % 89 == 0, F.lit(float("nan"))).when(i % 83 != 0, F.col("value"))
    return ev.select("event_id", "event_type", "ts", x.alias("x"),
                     F.when(F.col("ts") >= F.lit(CUT).cast("timestamp_ntz"), F.col("value")).alias("void"))


SQL_HOLES = f"""
holed AS (
  SELECT event_id, event_type, CASE WHEN ts < TIMESTAMP '{CUT}' THEN 0 ELSE 1 END AS side,
         CASE WHEN event_id % 97 = 0 THEN CAST('inf' AS DOUBLE) WHEN event_id % 101 = 0 THEN CAST('-inf' AS DOUBLE)
              WHEN event_id % 89 = 0 THEN CAST('nan' AS DOUBLE) WHEN event_id % 83 <> 0 THEN value END AS x
  FROM events),
known AS (SELECT 'x' AS feature, x AS value, side FROM holed WHERE x IS NOT NULL AND NOT isnan(x))"""


def _void(test: str, threshold: float) -> str:
    return (f"SELECT 'void', '{test}', CAST(NULL AS DOUBLE), CAST({threshold!r} AS DOUBLE), false")


SQL_FINITE = "long AS (SELECT * FROM known WHERE isfinite(value))"
SQL_HOLED_DRIFT = "\nUNION ALL\n".join([
    f"""(WITH {SQL_HOLES}, long AS (SELECT * FROM known), {SQL_VC},
d AS (SELECT feature, max(abs(fr - fc)) AS d, any_value(n) AS n, any_value(m) AS m FROM cum GROUP BY 1)
{_sql_report('ks', sql_ks_pvalue('d', 'n', 'm'), 0.05, True)} FROM d)""",
    f"""(WITH {SQL_HOLES}, {SQL_FINITE}, {SQL_VC},
w AS (SELECT feature, sum(abs(fr - fc) * coalesce(nxt - value, 0)) AS w FROM cum GROUP BY 1),
sd AS (SELECT feature, stddev_pop(value) AS sd FROM long WHERE side = 0 GROUP BY 1),
j AS (SELECT w.feature, w / greatest(sd, 0.001) AS s FROM w JOIN sd ON w.feature = sd.feature)
{_sql_report('wasserstein', 's', 0.1, False)} FROM j)""",
    f"""(WITH {SQL_HOLES}, long AS (SELECT * FROM known), {_sql_bins('WHERE side = 0 AND isfinite(value)')}, {SQL_PSI}
{_sql_report('psi', 's', 0.1, False)} FROM psi)""",
    f"""(WITH {SQL_HOLES}, ends AS (SELECT min(value) AS lo0, max(value) AS hi0 FROM known WHERE isfinite(value)),
long AS (SELECT feature, greatest(lo0, least(hi0, value)) AS value, side FROM known, ends), {_sql_bins('')}, {SQL_JS}
{_sql_report('jensenshannon', 's', 0.1, False)} FROM js)""",
    *[f"({_void(t, drift.DEFAULT_THRESHOLDS[t])})" for t in ("ks", "wasserstein", "psi", "jensenshannon")]])


@register("drift_with_holes_events", SQL_HOLED_DRIFT)
def drift_with_holes_events(spark, sf_dir):
    """2.12 on holes: four numeric tests; a feature without a reference value has its row, no score and no drift."""
    ev, cut = holed_events(spark, sf_dir), F.lit(CUT).cast("timestamp_ntz")
    ref, cur = ev.where(F.col("ts") < cut), ev.where(F.col("ts") >= cut)
    out = None
    for test in ("ks", "wasserstein", "psi", "jensenshannon"):
        rep = drift.drift_report(ref, cur, ["x", "void"], num_stattest=test, cat_stattest="psi")
        out = rep if out is None else out.unionByName(rep)
    return rounded(out)


@register("histogram_with_holes_events", f"""
WITH {SQL_HOLES},
ends AS (SELECT min(value) AS lo, max(value) AS hi FROM known WHERE isfinite(value)),
b AS (SELECT lo, hi, CASE WHEN value = CAST('inf' AS DOUBLE) THEN 10 WHEN value = CAST('-inf' AS DOUBLE) THEN -1
                          ELSE CAST(least(floor((value - lo) / ((hi - lo) / 10)), 9) AS INTEGER) END AS bin FROM known, ends)
SELECT bin, CASE WHEN bin = -1 THEN CAST('-inf' AS DOUBLE) ELSE round(any_value(lo) + bin * ((any_value(hi) - any_value(lo)) / 10), 6) END AS bin_start,
       CASE WHEN bin = 10 THEN CAST('inf' AS DOUBLE) ELSE round(any_value(lo) + (bin + 1) * ((any_value(hi) - any_value(lo)) / 10), 6) END AS bin_end,
       count(*) AS count
FROM b GROUP BY bin
""")
def histogram_with_holes_events(spark, sf_dir):
    """D11 on holes: bins over the finite range, infinite values counted apart."""
    return rounded(profile.histogram(holed_events(spark, sf_dir), "x", 10))


@register("quantiles_with_holes_events", f"""
WITH {SQL_HOLES}
SELECT event_type, round(quantile_cont(x, 0.25), 6) AS q1, round(quantile_cont(x, 0.5), 6) AS median,
       round(quantile_cont(x, 0.75), 6) AS q3
FROM holed WHERE x IS NOT NULL AND NOT isnan(x) GROUP BY 1
""")
def quantiles_with_holes_events(spark, sf_dir):
    """D6 on holes: null and NaN skipped, infinite values in their place in the order."""
    return rounded(profile.quantiles(holed_events(spark, sf_dir), "x", {"q1": 0.25, "median": 0.5, "q3": 0.75}, "event_type"))


@register("quality_with_holes_documents", f"""
WITH {SQL_LABELLED},
holed AS (SELECT CASE WHEN doc_id % 7 <> 0 THEN target END AS target, CASE WHEN doc_id % 5 <> 0 THEN prediction END AS prediction FROM labelled),
pairs AS (SELECT * FROM holed WHERE target IS NOT NULL AND prediction IS NOT NULL),
{sql_binary_quality('pairs')}
SELECT {SQL_BQ_COLUMNS} FROM bqf
""")
def quality_with_holes_documents(spark, sf_dir):
    """J3, J4 on holes: rows without a label or without a prediction take no part."""
    lab = domain.labelled_documents(spark, sf_dir)
    holed = lab.select(F.when(F.col("doc_id") % 7 != 0, F.col("target")).alias("target"),
                       F.when(F.col("doc_id") % 5 != 0, F.col("prediction")).alias("prediction"))
    return rounded(quality.binary_quality(holed))


@register("outliers_with_holes_events", f"""
WITH {SQL_HOLES},
f AS (SELECT event_id, CASE WHEN isfinite(x) THEN x END AS x FROM holed),
s AS (SELECT avg(x) AS m, stddev_pop(x) AS sd FROM f)
SELECT event_id, round(x, 6) AS x, round((x - m) / sd, 6) AS zscore FROM f, s WHERE abs((x - m) / sd) > 3
""")
def outliers_with_holes_events(spark, sf_dir):
    """I7 on holes: the finite values' z-scores."""
    ev = holed_events(spark, sf_dir)
    finite = ev.select("event_id", F.when(F.abs("x") != F.lit(float("inf")), F.col("x")).alias("x"))
    return rounded(clean.zscore_outliers(finite, "x"))
