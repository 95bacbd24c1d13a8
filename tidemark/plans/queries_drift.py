"""Registered queries: drift statistics and reports (inventory J1, J2, J7-J9, section 2.12)."""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from ..operators import drift, history
from ..sources.testdata import table
from . import domain, jobs
from .queries import ORACLE_SQL, SQL_LABELLED, SQL_LATEST, register, rounded


def domain_sql_labelled() -> str:
    return SQL_LABELLED.strip()

SPLIT_DATE = "1998-04-01 00:00:00"
NUM_FEATURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
CAT_FEATURES = ["l_returnflag", "l_linestatus"]


def _sides(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    cut = F.lit(SPLIT_DATE).cast("timestamp_ntz")
    return li.where(F.col("l_shipdate") < cut), li.where(F.col("l_shipdate") >= cut)


SQL_SIDE = f"CASE WHEN l_shipdate < TIMESTAMP '{SPLIT_DATE}' THEN 0 ELSE 1 END AS side"

SQL_NUM_LONG = f"""
long AS (
  SELECT feature, value, side FROM (
    UNPIVOT (SELECT CAST(l_quantity AS DOUBLE) AS l_quantity, CAST(l_extendedprice AS DOUBLE) AS l_extendedprice,
                    CAST(l_discount AS DOUBLE) AS l_discount, CAST(l_tax AS DOUBLE) AS l_tax, {SQL_SIDE} FROM lineitem)
    ON l_quantity, l_extendedprice, l_discount, l_tax INTO NAME feature VALUE value)
  WHERE value IS NOT NULL AND NOT isnan(value))"""

SQL_CAT_LONG = f"""
long AS (
  SELECT feature, value, side FROM (
    UNPIVOT (SELECT CAST(l_returnflag AS VARCHAR) AS l_returnflag, CAST(l_linestatus AS VARCHAR) AS l_linestatus,
                    {SQL_SIDE} FROM lineitem)
    ON l_returnflag, l_linestatus INTO NAME feature VALUE value)
  WHERE value IS NOT NULL)"""


def _lit(x: float) -> str:
    return f"CAST({x!r} AS DOUBLE)"


def sql_ks_pvalue(d: str, n: str, m: str, terms: int = 10) -> str:
    lam = f"({d} * sqrt(CAST({n} AS DOUBLE) * {m} / ({n} + {m})))"
    small = " + ".join(f"exp({_lit(-((2 * k - 1) ** 2) * math.pi ** 2 / 8.0)} / ({lam} * {lam}))"
                       for k in range(1, terms + 1))
    large = " + ".join(f"{_lit(float((-1) ** (k - 1)))} * exp({_lit(-2.0 * k * k)} * {lam} * {lam})"
                       for k in range(1, terms + 1))
    p = (f"CASE WHEN {lam} < 1.18 THEN 1.0 - {_lit(math.sqrt(2 * math.pi))} / {lam} * ({small}) "
         f"ELSE 2.0 * ({large}) END")
    return f"CASE WHEN {lam} <= 0 THEN 1.0 ELSE least(greatest({p}, 0.0), 1.0) END"


def _sql_report(test: str, score: str, thr: float, p_value: bool) -> str:
    det = f"{score} < {_lit(thr)}" if p_value else f"{score} >= {_lit(thr)}"
    return (f"SELECT feature, '{test}' AS stattest, round({score}, 6) AS drift_score, {_lit(thr)} AS threshold, "
            f"{det} AS drift_detected")


SQL_VC = """
vc AS (SELECT feature, value, count(*) FILTER (WHERE side = 0) AS r, count(*) FILTER (WHERE side = 1) AS c
       FROM long GROUP BY 1, 2),
cum AS (SELECT feature, value,
               sum(r) OVER w / sum(r) OVER (PARTITION BY feature) AS fr,
               sum(c) OVER w / sum(c) OVER (PARTITION BY feature) AS fc,
               sum(r) OVER (PARTITION BY feature) AS n, sum(c) OVER (PARTITION BY feature) AS m,
               lead(value) OVER (PARTITION BY feature ORDER BY value) AS nxt
        FROM vc WINDOW w AS (PARTITION BY feature ORDER BY value ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))"""


@register("ks_drift_lineitem", f"""
WITH {SQL_NUM_LONG}, {SQL_VC},
d AS (SELECT feature, max(abs(fr - fc)) AS d, any_value(n) AS n, any_value(m) AS m FROM cum GROUP BY 1)
{_sql_report('ks', sql_ks_pvalue('d', 'n', 'm'), 0.05, True)} FROM d
""")
def ks_drift_lineitem(spark, sf_dir):
    """KS test per numeric feature, line items shipped before vs after 1998-04-01."""
    ref, cur = _sides(spark, sf_dir)
    return rounded(drift.ks_test(drift.stack_sides(ref, cur, NUM_FEATURES)))


@register("ks_statistic_totalprice", """
WITH long AS (SELECT 'o_totalprice' AS feature, o_totalprice AS value,
                     CASE WHEN o_orderdate < TIMESTAMP '1998-04-01' THEN 0 ELSE 1 END AS side FROM orders),
""" + SQL_VC.lstrip() + """
SELECT feature, round(max(abs(fr - fc)), 6) AS ks_d, CAST(any_value(n) AS BIGINT) AS ref_rows,
       CAST(any_value(m) AS BIGINT) AS cur_rows
FROM cum GROUP BY 1
""")
def ks_statistic_totalprice(spark, sf_dir):
    """KS distance of order totals before / after 1998-04-01 (bucketed running counts)."""
    o = table(spark, sf_dir, "orders")
    cut = F.lit(SPLIT_DATE).cast("timestamp_ntz")
    long = drift.stack_sides(o.where(F.col("o_orderdate") < cut), o.where(F.col("o_orderdate") >= cut), ["o_totalprice"])
    return rounded(drift.ks_statistic(long).withColumn("ref_rows", F.col("ref_rows").cast("long"))
                   .withColumn("cur_rows", F.col("cur_rows").cast("long")))


@register("wasserstein_drift_lineitem", f"""
WITH {SQL_NUM_LONG}, {SQL_VC},
w AS (SELECT feature, sum(abs(fr - fc) * coalesce(nxt - value, 0)) AS w FROM cum GROUP BY 1),
sd AS (SELECT feature, stddev_pop(value) AS sd FROM long WHERE side = 0 GROUP BY 1),
j AS (SELECT w.feature, w / greatest(sd, 0.001) AS s FROM w JOIN sd ON w.feature = sd.feature)
{_sql_report('wasserstein', 's', 0.1, False)} FROM j
""")
def wasserstein_drift_lineitem(spark, sf_dir):
    """Normed Wasserstein distance per numeric feature."""
    ref, cur = _sides(spark, sf_dir)
    return rounded(drift.wasserstein_test(drift.stack_sides(ref, cur, NUM_FEATURES)))


def _sql_bins(range_filter: str, n_bins: int = drift.N_BINS) -> str:
    return f"""
rng AS (SELECT feature, min(value) AS lo, max(value) AS hi FROM long {range_filter} GROUP BY 1),
binned AS (
  SELECT l.feature, l.side,
         CASE WHEN l.value >= lo AND l.value <= hi THEN
           CAST(CASE WHEN hi = lo THEN 0 ELSE least(floor((l.value - lo) / ((hi - lo) / {n_bins}.0)), {n_bins - 1}) END AS INTEGER)
         END AS bin
  FROM long l JOIN rng ON l.feature = rng.feature),
tot AS (SELECT feature, count(*) FILTER (WHERE side = 0) AS rt, count(*) FILTER (WHERE side = 1) AS ct FROM binned GROUP BY 1),
shares AS (
  SELECT b.feature, b.bin, count(*) FILTER (WHERE side = 0) / any_value(rt) AS p,
         count(*) FILTER (WHERE side = 1) / any_value(ct) AS q
  FROM binned b JOIN tot ON b.feature = tot.feature WHERE bin IS NOT NULL GROUP BY 1, 2)"""


SQL_PSI = """
psi AS (SELECT feature, sum((CASE WHEN q = 0 THEN 0.0001 ELSE q END - CASE WHEN p = 0 THEN 0.0001 ELSE p END)
                            * ln(CASE WHEN q = 0 THEN 0.0001 ELSE q END / CASE WHEN p = 0 THEN 0.0001 ELSE p END)) AS s
        FROM shares GROUP BY 1)"""

SQL_JS = """
js AS (SELECT feature, sqrt(greatest((sum(CASE WHEN p > 0 THEN p * ln(p / ((p + q) / 2)) ELSE 0 END)
                                      + sum(CASE WHEN q > 0 THEN q * ln(q / ((p + q) / 2)) ELSE 0 END)) / 2, 0)) AS s
       FROM shares GROUP BY 1)"""


@register("psi_drift_lineitem", f"""
WITH {SQL_NUM_LONG}, {_sql_bins('WHERE side = 0')}, {SQL_PSI}
{_sql_report('psi', 's', 0.2, False)} FROM psi
""")
def psi_drift_lineitem(spark, sf_dir):
    """PSI per numeric feature (30 bins of the reference range), threshold 0.2 as in the preset."""
    ref, cur = _sides(spark, sf_dir)
    return rounded(drift.psi_numeric(drift.stack_sides(ref, cur, NUM_FEATURES), 0.2))


@register("jensenshannon_drift_lineitem", f"""
WITH {SQL_NUM_LONG}, {_sql_bins('')}, {SQL_JS}
{_sql_report('jensenshannon', 's', 0.1, False)} FROM js
""")
def jensenshannon_drift_lineitem(spark, sf_dir):
    """Jensen-Shannon distance per numeric feature (30 bins of the joint range)."""
    ref, cur = _sides(spark, sf_dir)
    return rounded(drift.jensenshannon_numeric(drift.stack_sides(ref, cur, NUM_FEATURES)))


SQL_CAT_SHARES = """
cnt AS (SELECT feature, value, count(*) FILTER (WHERE side = 0) AS rn, count(*) FILTER (WHERE side = 1) AS cn
        FROM long GROUP BY 1, 2),
shares AS (SELECT feature, value, rn, cn, sum(rn) OVER (PARTITION BY feature) AS rt, sum(cn) OVER (PARTITION BY feature) AS ct,
                  rn / sum(rn) OVER (PARTITION BY feature) AS p, cn / sum(cn) OVER (PARTITION BY feature) AS q FROM cnt)"""


@register("psi_drift_categorical", f"""
WITH {SQL_CAT_LONG}, {SQL_CAT_SHARES}, {SQL_PSI}
{_sql_report('psi', 's', 0.2, False)} FROM psi
""")
def psi_drift_categorical(spark, sf_dir):
    """PSI per categorical feature over the union of categories."""
    ref, cur = _sides(spark, sf_dir)
    return rounded(drift.psi_categorical(drift.stack_sides(ref, cur, CAT_FEATURES, numeric=False), 0.2))


@register("jensenshannon_drift_categorical", f"""
WITH {SQL_CAT_LONG}, {SQL_CAT_SHARES}, {SQL_JS}
{_sql_report('jensenshannon', 's', 0.1, False)} FROM js
""")
def jensenshannon_drift_categorical(spark, sf_dir):
    """Jensen-Shannon distance per categorical feature over the union of categories."""
    ref, cur = _sides(spark, sf_dir)
    return rounded(drift.jensenshannon_categorical(drift.stack_sides(ref, cur, CAT_FEATURES, numeric=False)))


@register("chisquare_statistic_categorical", f"""
WITH {SQL_CAT_LONG}, {SQL_CAT_SHARES}
SELECT feature, round(sum((cn - p * ct) * (cn - p * ct) / (p * ct)), 6) AS chi2, count(*) - 1 AS dof
FROM shares WHERE rn > 0 GROUP BY 1
""")
def chisquare_statistic_categorical(spark, sf_dir):
    """Chi-square statistic of current counts against scaled reference shares."""
    ref, cur = _sides(spark, sf_dir)
    return rounded(drift.chisquare_statistic(drift.stack_sides(ref, cur, CAT_FEATURES, numeric=False)))


@register("chisquare_drift_categorical", f"""
WITH {SQL_CAT_LONG}, {SQL_CAT_SHARES},
st AS (SELECT feature, sum((cn - p * ct) * (cn - p * ct) / (p * ct)) AS chi2, count(*) - 1 AS dof
       FROM shares WHERE rn > 0 GROUP BY 1),
-- upper tail Q(k/2, x/2) = 1 - sum_n exp(-z + (a + n) ln z - lgamma(a + n + 1)), z = x/2, a = k/2
terms AS (SELECT feature, chi2, dof, n FROM st, range(0, 3000) t(n)),
pv AS (SELECT feature, CASE WHEN any_value(chi2) <= 0 THEN 1.0 WHEN any_value(chi2) / 2 > 1200 THEN 0.0
                       ELSE greatest(0.0, 1 - sum(exp(-chi2 / 2 + (dof / 2.0 + n) * ln(chi2 / 2)
                                                       - lgamma(dof / 2.0 + n + 1)))) END AS pv
       FROM terms GROUP BY feature)
{_sql_report('chisquare', 'pv', 0.05, True)} FROM pv
""")
def chisquare_drift_categorical(spark, sf_dir):
    """Chi-square test with p-value (regularized incomplete gamma in an Arrow UDF, one row per feature)."""
    ref, cur = _sides(spark, sf_dir)
    return rounded(drift.chisquare_test(drift.stack_sides(ref, cur, CAT_FEATURES, numeric=False)))


def _phi(z: str) -> str:
    t = f"(1.0 / (1.0 + 0.2316419 * abs({z})))"
    poly = (f"{t} * (0.319381530 + {t} * (-0.356563782 + {t} * (1.781477937 + {t} * (-1.821255978 + {t} * 1.330274429))))")
    upper = f"(exp(-abs({z}) * abs({z}) / 2.0) / 2.5066282746310002 * {poly})"
    return f"CASE WHEN {z} >= 0 THEN 1.0 - {upper} ELSE {upper} END"


SQL_PRED_SIDES = SQL_LATEST.replace("AND model_version = 2", "AND model_version = 2 AND \"timestamp\" < TIMESTAMP '2024-01-24'") + """,
cur AS (SELECT CAST(value > 50 AS INTEGER) AS prediction FROM events WHERE ts >= TIMESTAMP '2024-01-24'),
long AS (SELECT 'prediction' AS feature, CAST(prediction AS VARCHAR) AS value, 0 AS side FROM latest
         UNION ALL SELECT 'prediction', CAST(prediction AS VARCHAR), 1 FROM cur)"""


def _prediction_sides(spark, sf_dir):
    """Reference = latest history predictions before the newest week; current = the newest week's batch."""
    hist = domain.inference_history(spark, sf_dir).where(F.col("timestamp") < F.lit("2024-01-24").cast("timestamp_ntz"))
    ref = history.latest_per_series(hist, domain.AS_OF, domain.LOOKBACK_PREDICTION_DRIFT_DAYS, domain.MODEL_VERSION,
                                    tiebreak="insert_seq")
    ev = table(spark, sf_dir, "events")
    cur = ev.where(F.col("ts") >= F.lit("2024-01-24").cast("timestamp_ntz")).select(
        (F.col("value") > domain.POSITIVE_VALUE).cast("int").alias("prediction"))
    return ref.select("prediction"), cur


@register("prediction_drift_z", f"""
WITH {SQL_PRED_SIDES}, {SQL_CAT_SHARES},
top AS (SELECT * FROM shares WHERE value = (SELECT max(value) FROM shares s2 WHERE s2.feature = shares.feature)),
z AS (SELECT feature, (p - q) / sqrt(((rn + cn) / (rt + ct)) * (1 - (rn + cn) / (rt + ct)) * (1.0 / rt + 1.0 / ct)) AS z
      FROM top),
pv AS (SELECT feature, CASE WHEN z IS NULL OR isnan(z) THEN 1.0 ELSE 2 * (1 - ({_phi('abs(z)')})) END AS pv FROM z)
{_sql_report('z', 'pv', 0.05, True)} FROM pv
""")
def prediction_drift_z(spark, sf_dir):
    """Prediction drift of the newest batch against the history, two-proportion z test."""
    ref, cur = _prediction_sides(spark, sf_dir)
    return rounded(drift.drift_report(ref, cur, categorical=["prediction"], cat_stattest="z"))


@register("prediction_drift_jensenshannon", f"""
WITH {SQL_PRED_SIDES}, {SQL_CAT_SHARES}, {SQL_JS}
{_sql_report('jensenshannon', 's', 0.1, False)} FROM js
""")
def prediction_drift_jensenshannon(spark, sf_dir):
    """J2 with the large-sample categorical default (Jensen-Shannon)."""
    ref, cur = _prediction_sides(spark, sf_dir)
    return rounded(drift.drift_report(ref, cur, categorical=["prediction"], cat_stattest="jensenshannon"))


@register("feature_drift_report_lineitem", f"""
WITH {SQL_NUM_LONG}, {SQL_VC},
d AS (SELECT feature, max(abs(fr - fc)) AS d, any_value(n) AS n, any_value(m) AS m FROM cum GROUP BY 1)
{_sql_report('ks', sql_ks_pvalue('d', 'n', 'm'), 0.2, True)} FROM d
UNION ALL (
WITH {SQL_CAT_LONG}, {SQL_CAT_SHARES}, {SQL_PSI}
{_sql_report('psi', 's', 0.2, False)} FROM psi)
""")
def feature_drift_report_lineitem(spark, sf_dir):
    """Data drift with chosen tests, KS for numeric and PSI for categorical, both at 0.2."""
    ref, cur = _sides(spark, sf_dir)
    rep = drift.drift_report(ref, cur, NUM_FEATURES, CAT_FEATURES, num_stattest="ks", cat_stattest="psi",
                             num_threshold=0.2, cat_threshold=0.2)
    return rounded(rep)


@register("dataset_drift_summary_lineitem", f"""
WITH rep AS (
  WITH {SQL_NUM_LONG}, {SQL_VC},
  d AS (SELECT feature, max(abs(fr - fc)) AS d, any_value(n) AS n, any_value(m) AS m FROM cum GROUP BY 1)
  {_sql_report('ks', sql_ks_pvalue('d', 'n', 'm'), 0.2, True)} FROM d
  UNION ALL (
  WITH {SQL_CAT_LONG}, {SQL_CAT_SHARES}, {SQL_PSI}
  {_sql_report('psi', 's', 0.2, False)} FROM psi))
SELECT count(*) AS number_of_columns, count(*) FILTER (WHERE drift_detected) AS number_of_drifted_columns,
       round(count(*) FILTER (WHERE drift_detected) / count(*), 6) AS share_of_drifted_columns,
       count(*) FILTER (WHERE drift_detected) / count(*) >= 0.5 AS dataset_drift
FROM rep
""")
def dataset_drift_summary_lineitem(spark, sf_dir):
    """J1 summary: number of columns, drifted columns, share, dataset drift."""
    ref, cur = _sides(spark, sf_dir)
    rep = drift.drift_report(ref, cur, NUM_FEATURES, CAT_FEATURES, num_stattest="ks", cat_stattest="psi",
                             num_threshold=0.2, cat_threshold=0.2)
    return rounded(drift.dataset_drift(rep))


SQL_REPORT = f"""
  WITH {SQL_NUM_LONG}, {SQL_VC},
  d AS (SELECT feature, max(abs(fr - fc)) AS d, any_value(n) AS n, any_value(m) AS m FROM cum GROUP BY 1)
  {_sql_report('ks', sql_ks_pvalue('d', 'n', 'm'), 0.2, True)} FROM d
  UNION ALL (
  WITH {SQL_CAT_LONG}, {SQL_CAT_SHARES}, {SQL_PSI}
  {_sql_report('psi', 's', 0.2, False)} FROM psi)"""


def _sql_monitoring_row(report: str, features, model: str, version: str) -> str:
    keys = ", ".join(f"max(drift_score) FILTER (WHERE feature = '{c}') AS {c}__drift_score, "
                     f"bool_or(drift_detected) FILTER (WHERE feature = '{c}') AS {c}__drift_detected" for c in features)
    return f"""WITH rep AS ({report})
SELECT '{model}' AS model_name, '{version}' AS model_version, TIMESTAMP '2024-02-01 00:00:00' AS "timestamp",
       count(*) FILTER (WHERE drift_detected) / count(*) >= 0.5 AS drift_detected,
       round(count(*) FILTER (WHERE drift_detected) / count(*), 6) AS drift_score,
       count(*) FILTER (WHERE drift_detected) AS number_of_drifted_columns, count(*) AS number_of_columns, {keys} FROM rep"""


@register("feature_drift_monitoring_rows", _sql_monitoring_row(SQL_REPORT, NUM_FEATURES + CAT_FEATURES, "classifier", "2"))
def feature_drift_monitoring_rows(spark, sf_dir):
    """The row that feature drift monitoring writes, with the keys of every feature."""
    ref, cur = _sides(spark, sf_dir)
    rep = drift.drift_report(ref, cur, NUM_FEATURES, CAT_FEATURES, num_stattest="ks", cat_stattest="psi",
                             num_threshold=0.2, cat_threshold=0.2)
    return rounded(jobs.drift_monitoring(rep, NUM_FEATURES + CAT_FEATURES, "classifier", 2, domain.AS_OF, "feature_drift"))


@register("prediction_drift_monitoring_rows", _sql_monitoring_row(
    ORACLE_SQL["prediction_drift_jensenshannon"], ["prediction"], "classifier", "2"))
def prediction_drift_monitoring_rows(spark, sf_dir):
    """The row that prediction drift monitoring writes."""
    ref, cur = _prediction_sides(spark, sf_dir)
    rep = drift.drift_report(ref, cur, categorical=["prediction"])
    return rounded(jobs.drift_monitoring(rep, ["prediction"], "classifier", 2, domain.AS_OF, "prediction_drift"))


@register("auto_drift_report_lineitem")
def auto_drift_report_lineitem(spark, sf_dir):
    """J1 with the default test of each kind."""
    ref, cur = _sides(spark, sf_dir)
    return rounded(drift.drift_report(ref, cur, NUM_FEATURES, CAT_FEATURES))


@register("target_drift_orders", f"""
WITH long AS (SELECT 'o_totalprice' AS feature, o_totalprice AS value,
                     CASE WHEN o_orderdate < TIMESTAMP '1998-04-01' THEN 0 ELSE 1 END AS side FROM orders),
{SQL_VC.lstrip()},
d AS (SELECT feature, max(abs(fr - fc)) AS d, any_value(n) AS n, any_value(m) AS m FROM cum GROUP BY 1)
{_sql_report('ks', sql_ks_pvalue('d', 'n', 'm'), 0.05, True)} FROM d
""")
def target_drift_orders(spark, sf_dir):
    """Numeric target drift (order totals) with the KS test."""
    o = table(spark, sf_dir, "orders")
    cut = F.lit(SPLIT_DATE).cast("timestamp_ntz")
    return rounded(drift.drift_report(o.where(F.col("o_orderdate") < cut), o.where(F.col("o_orderdate") >= cut),
                                      numerical=["o_totalprice"], num_stattest="ks"))


@register("target_drift_label_documents", """
WITH lab AS (SELECT CAST(l.quality AS VARCHAR) AS value, CASE WHEN d.lang = 'en' THEN 0 ELSE 1 END AS side
             FROM labels l JOIN documents d ON l.doc_id = d.doc_id),
long AS (SELECT 'quality' AS feature, value, side FROM lab),
""" + SQL_CAT_SHARES.lstrip() + """,
top AS (SELECT * FROM shares WHERE value = (SELECT max(value) FROM shares s2 WHERE s2.feature = shares.feature)),
z AS (SELECT feature, (p - q) / sqrt(((rn + cn) / (rt + ct)) * (1 - (rn + cn) / (rt + ct)) * (1.0 / rt + 1.0 / ct)) AS z
      FROM top),
pv AS (SELECT feature, CASE WHEN z IS NULL OR isnan(z) THEN 1.0 ELSE 2 * (1 - (""" + _phi("abs(z)") + """)) END AS pv FROM z)
""" + _sql_report('z', 'pv', 0.05, True) + """ FROM pv
""")
def target_drift_label_documents(spark, sf_dir):
    """J9 binary label: quality label drift between English and other documents, z test."""
    lab = table(spark, sf_dir, "labels").join(table(spark, sf_dir, "documents").select("doc_id", "lang"), "doc_id")
    lab = lab.select(F.col("quality").alias("quality"), "lang")
    return rounded(drift.drift_report(lab.where(F.col("lang") == "en"), lab.where(F.col("lang") != "en"),
                                      categorical=["quality"], cat_stattest="z"))


@register("target_drift_probability_documents", f"""
WITH {domain_sql_labelled()},
long AS (SELECT 'proba' AS feature, CAST(proba AS DOUBLE) AS value, CASE WHEN l2.lang = 'en' THEN 0 ELSE 1 END AS side
         FROM labelled JOIN documents l2 ON labelled.doc_id = l2.doc_id),
{SQL_VC},
d AS (SELECT feature, max(abs(fr - fc)) AS d, any_value(n) AS n, any_value(m) AS m FROM cum GROUP BY 1)
{_sql_report('ks', sql_ks_pvalue('d', 'n', 'm'), 0.05, True)} FROM d
""")
def target_drift_probability_documents(spark, sf_dir):
    """J9 binary probability: drift of the class-1 probability between English and other documents, KS."""
    lab = domain.labelled_documents(spark, sf_dir).join(table(spark, sf_dir, "documents").select("doc_id", "lang"), "doc_id")
    return rounded(drift.drift_report(lab.where(F.col("lang") == "en"), lab.where(F.col("lang") != "en"),
                                      numerical=["proba"], num_stattest="ks"))


# The defaults: Wasserstein for the numeric features and Jensen-Shannon for the categorical ones.
ORACLE_SQL["auto_drift_report_lineitem"] = (
    "(" + ORACLE_SQL["wasserstein_drift_lineitem"] + ")\nUNION ALL\n(" + ORACLE_SQL["jensenshannon_drift_categorical"] + ")"
)


@register("target_drift_multiclass_customers", f"""
WITH long AS (SELECT 'c_mktsegment' AS feature, c_mktsegment AS value, CASE WHEN c_acctbal < 0 THEN 0 ELSE 1 END AS side
              FROM customer),
{SQL_CAT_SHARES.lstrip()}, {SQL_JS}
{_sql_report('jensenshannon', 's', 0.1, False)} FROM js
""")
def target_drift_multiclass_customers(spark, sf_dir):
    """J9 multiclass: market-segment distribution of customers in debt against the others."""
    c = table(spark, sf_dir, "customer")
    return rounded(drift.drift_report(c.where(F.col("c_acctbal") < 0), c.where(F.col("c_acctbal") >= 0),
                                      categorical=["c_mktsegment"], cat_stattest="jensenshannon"))
