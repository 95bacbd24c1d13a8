"""Registered queries: cleaning, interpolation, missing dates, outliers (inventory I1-I12, E1, E2, H1, H4, H5)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.scalar import blank_control_chars
from ..operators import clean
from ..sources.testdata import table
from . import domain
from .domain import SQL_EVENT_GAPS, SQL_GAPS
from .queries import register, rounded

GAP_COLS = ("l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax")


def _gaps(spark, sf_dir):
    return domain.lineitem_with_gaps(spark, sf_dir).select(*GAP_COLS)


@register("drop_missing_rows", f"""
WITH {SQL_GAPS}
SELECT l_orderkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax FROM gaps
WHERE l_quantity IS NOT NULL AND l_discount IS NOT NULL AND NOT isnan(l_tax)
""")
def drop_missing_rows(spark, sf_dir):
    """Drop rows with any missing value (NaN counts)."""
    return clean.drop_missing(_gaps(spark, sf_dir))


@register("drop_missing_thresh", f"""
WITH {SQL_GAPS}
SELECT l_orderkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax FROM gaps
WHERE (CASE WHEN l_quantity IS NULL THEN 0 ELSE 1 END) + (CASE WHEN l_discount IS NULL THEN 0 ELSE 1 END)
      + (CASE WHEN isnan(l_tax) THEN 0 ELSE 1 END) + 3 >= 5
""")
def drop_missing_thresh(spark, sf_dir):
    """Keep rows with at least 5 non-missing values."""
    return clean.drop_missing(_gaps(spark, sf_dir), thresh=5)


@register("drop_missing_columns", f"""
WITH {SQL_GAPS}
SELECT l_orderkey, l_linenumber, l_extendedprice FROM gaps
""")
def drop_missing_columns(spark, sf_dir):
    """I1 axis=1: drop columns holding a missing value."""
    return clean.drop_missing(_gaps(spark, sf_dir), axis=1)


@register("fill_missing_value", f"""
WITH {SQL_GAPS}
SELECT l_orderkey, l_linenumber, coalesce(l_quantity, 0) AS l_quantity, l_extendedprice,
       coalesce(l_discount, 0) AS l_discount, CASE WHEN isnan(l_tax) THEN 0 ELSE l_tax END AS l_tax FROM gaps
""")
def fill_missing_value(spark, sf_dir):
    """Fill with a value."""
    return clean.fill_missing(_gaps(spark, sf_dir), value=0)


def _sql_fill(stat: str) -> str:
    return f"""
WITH {SQL_GAPS},
s AS (SELECT {stat.format(c='l_quantity')} AS q, {stat.format(c='l_discount')} AS d,
             {stat.format(c="CASE WHEN isnan(l_tax) THEN NULL ELSE l_tax END")} AS t FROM gaps)
SELECT l_orderkey, l_linenumber, round(coalesce(l_quantity, q), 6) AS l_quantity, round(l_extendedprice, 6) AS l_extendedprice,
       round(coalesce(l_discount, d), 6) AS l_discount, round(CASE WHEN isnan(l_tax) THEN t ELSE l_tax END, 6) AS l_tax
FROM gaps, s"""


@register("fill_missing_mean", _sql_fill("avg({c})"))
def fill_missing_mean(spark, sf_dir):
    """Fill numeric columns with their mean."""
    return rounded(clean.fill_missing(_gaps(spark, sf_dir), method="mean"))


@register("fill_missing_median", _sql_fill("quantile_cont({c}, 0.5)"))
def fill_missing_median(spark, sf_dir):
    """Fill numeric columns with their exact median."""
    return rounded(clean.fill_missing(_gaps(spark, sf_dir), method="median"))


@register("impute_most_frequent", f"""
WITH {SQL_GAPS},
mq AS (SELECT l_quantity AS v FROM gaps WHERE l_quantity IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, v LIMIT 1),
md AS (SELECT l_discount AS v FROM gaps WHERE l_discount IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, v LIMIT 1),
mt AS (SELECT l_tax AS v FROM gaps WHERE NOT isnan(l_tax) GROUP BY 1 ORDER BY count(*) DESC, v LIMIT 1)
SELECT l_orderkey, l_linenumber, coalesce(l_quantity, (SELECT v FROM mq)) AS l_quantity, l_extendedprice,
       coalesce(l_discount, (SELECT v FROM md)) AS l_discount,
       CASE WHEN isnan(l_tax) THEN (SELECT v FROM mt) ELSE l_tax END AS l_tax
FROM gaps
""")
def impute_most_frequent(spark, sf_dir):
    """I5 / I3 mode: fill with the most frequent value (smallest on ties)."""
    return rounded(clean.impute(_gaps(spark, sf_dir), "most_frequent"))


@register("impute_constant", f"""
WITH {SQL_GAPS}
SELECT l_orderkey, l_linenumber, coalesce(l_quantity, 0) AS l_quantity, l_extendedprice,
       coalesce(l_discount, 0) AS l_discount, CASE WHEN isnan(l_tax) THEN 0 ELSE l_tax END AS l_tax FROM gaps
""")
def impute_constant(spark, sf_dir):
    """I5 constant strategy (0 for numbers)."""
    return clean.impute(_gaps(spark, sf_dir), "constant")


SQL_INTERP_SERIES = f"""
WITH {SQL_EVENT_GAPS},
r AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS pos FROM egaps),
k AS (SELECT *, max(CASE WHEN value IS NOT NULL THEN pos END)
                  OVER (PARTITION BY user_id ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS pp,
                min(CASE WHEN value IS NOT NULL THEN pos END)
                  OVER (PARTITION BY user_id ORDER BY pos ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS np
      FROM r)
SELECT k.event_id, k.user_id,
       round(CASE WHEN k.value IS NOT NULL THEN k.value WHEN pp IS NULL THEN NULL WHEN np IS NULL THEN a.value
                  ELSE a.value + (b.value - a.value) * (k.pos - pp) / (np - pp) END, 6) AS value
FROM k LEFT JOIN r a ON a.user_id = k.user_id AND a.pos = k.pp LEFT JOIN r b ON b.user_id = k.user_id AND b.pos = k.np
"""


@register("interpolate_event_series", SQL_INTERP_SERIES)
def interpolate_event_series(spark, sf_dir):
    """Linear interpolation by row position per user series, ordered by time."""
    ev = domain.events_with_gaps(spark, sf_dir)
    out = clean.interpolate_linear(ev, "value", ["ts", "event_id"], "user_id")
    return rounded(out.select("event_id", "user_id", "value"))


@register("interpolate_order_prices", """
WITH g AS (SELECT o_orderkey, CASE WHEN o_orderkey % 9 <> 0 THEN o_totalprice END AS v FROM orders),
r AS (SELECT *, row_number() OVER (ORDER BY o_orderkey) AS pos FROM g),
k AS (SELECT *, max(CASE WHEN v IS NOT NULL THEN pos END) OVER (ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS pp,
                min(CASE WHEN v IS NOT NULL THEN pos END) OVER (ORDER BY pos ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS np
      FROM r)
SELECT k.o_orderkey, round(CASE WHEN k.v IS NOT NULL THEN k.v WHEN pp IS NULL THEN NULL WHEN np IS NULL THEN a.v
                  ELSE a.v + (b.v - a.v) * (k.pos - pp) / (np - pp) END, 6) AS o_totalprice
FROM k LEFT JOIN r a ON a.pos = k.pp LEFT JOIN r b ON b.pos = k.np
""")
def interpolate_order_prices(spark, sf_dir):
    """E1 ungrouped: one long series ordered by key, cut into 4096-row chunks with carried neighbours."""
    o = table(spark, sf_dir, "orders").select(
        "o_orderkey", F.when(F.col("o_orderkey") % 9 != 0, F.col("o_totalprice")).alias("o_totalprice"))
    return rounded(clean.interpolate_linear(o, "o_totalprice", ["o_orderkey"])
                   .select("o_orderkey", "o_totalprice"))


@register("missing_order_dates", """
WITH b AS (SELECT min(o_orderdate) AS lo, max(o_orderdate) AS hi FROM orders),
d AS (SELECT unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS missing_date FROM b)
SELECT missing_date FROM d WHERE NOT EXISTS (SELECT 1 FROM orders o WHERE o.o_orderdate = d.missing_date)
""")
def missing_order_dates(spark, sf_dir):
    """I6 whole table: days without any order."""
    return clean.missing_dates(table(spark, sf_dir, "orders"), "o_orderdate")


@register("missing_order_dates_by_priority", """
WITH b AS (SELECT o_orderpriority, min(o_orderdate) AS lo, max(o_orderdate) AS hi FROM orders GROUP BY 1),
d AS (SELECT o_orderpriority, unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS missing_date FROM b)
SELECT o_orderpriority, missing_date FROM d
WHERE NOT EXISTS (SELECT 1 FROM orders o WHERE o.o_orderdate = d.missing_date AND o.o_orderpriority = d.o_orderpriority)
""")
def missing_order_dates_by_priority(spark, sf_dir):
    """I6 per group."""
    return clean.missing_dates(table(spark, sf_dir, "orders"), "o_orderdate", "o_orderpriority")


@register("zscore_outliers_events", """
WITH s AS (SELECT avg(value) AS m, stddev_pop(value) AS sd FROM events)
SELECT event_id, value, round((value - m) / sd, 6) AS zscore FROM events, s WHERE abs((value - m) / sd) > 3
""")
def zscore_outliers_events(spark, sf_dir):
    """I7 whole table: abs(z) > 3 with population std."""
    return rounded(clean.zscore_outliers(table(spark, sf_dir, "events").select("event_id", "value"), "value"))


@register("zscore_outliers_by_type", """
WITH s AS (SELECT event_type, avg(value) AS m, stddev_pop(value) AS sd FROM events GROUP BY 1)
SELECT e.event_type, event_id, value, round((value - m) / sd, 6) AS zscore
FROM events e JOIN s ON e.event_type = s.event_type WHERE abs((value - m) / sd) > 3
""")
def zscore_outliers_by_type(spark, sf_dir):
    """I7 / E2 per group: group statistics aggregated and joined back."""
    ev = table(spark, sf_dir, "events").select("event_type", "event_id", "value")
    return rounded(clean.zscore_outliers(ev, "value", "event_type"))


@register("modified_zscore_outliers_events", """
WITH m AS (SELECT quantile_cont(value, 0.5) AS med FROM events),
d AS (SELECT quantile_cont(abs(value - med), 0.5) AS mad FROM events, m)
SELECT event_id, value, round(0.6745 * (value - med) / mad, 6) AS modified_zscore
FROM events, m, d WHERE abs(0.6745 * (value - med) / mad) > 3
""")
def modified_zscore_outliers_events(spark, sf_dir):
    """I8: modified z-score with median and MAD."""
    return rounded(clean.modified_zscore_outliers(table(spark, sf_dir, "events").select("event_id", "value"), "value"))


@register("remove_outliers_iqr", """
WITH q AS (SELECT quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.75) AS q3 FROM events)
SELECT event_id, value FROM events, q WHERE value >= q1 - 1.5 * (q3 - q1) AND value <= q3 + 1.5 * (q3 - q1)
""")
def remove_outliers_iqr(spark, sf_dir):
    """I9 iqr: keep values inside the 1.5 IQR fences."""
    return clean.remove_outliers(table(spark, sf_dir, "events").select("event_id", "value"), "value", "iqr")


@register("remove_outliers_std", f"""
WITH {SQL_EVENT_GAPS}, s AS (SELECT avg(value) AS m, stddev_pop(value) AS sd FROM egaps)
SELECT event_id, value FROM egaps, s WHERE abs((value - m) / sd) <= 1.5
""")
def remove_outliers_std(spark, sf_dir):
    """I9 std with the default multiplier 1.5; nulls are dropped."""
    ev = domain.events_with_gaps(spark, sf_dir).select("event_id", "value")
    return clean.remove_outliers(ev, "value", "std")


@register("transform_log_values", """
SELECT event_id, round(ln(1 + value), 6) AS value FROM events
""")
def transform_log_values(spark, sf_dir):
    """I10 log: log1p."""
    return rounded(clean.transform_outliers(table(spark, sf_dir, "events").select("event_id", "value"), "value", "log"))


@register("transform_sqrt_values", """
SELECT event_id, round(sqrt(value), 6) AS value FROM events
""")
def transform_sqrt_values(spark, sf_dir):
    """I10 sqrt."""
    return rounded(clean.transform_outliers(table(spark, sf_dir, "events").select("event_id", "value"), "value", "sqrt"))


@register("impute_outliers_mean", """
WITH s AS (SELECT avg(value) AS m, stddev_pop(value) AS sd FROM events)
SELECT event_id, round(CASE WHEN abs(value - m) > 2 * sd THEN m ELSE value END, 6) AS value FROM events, s
""")
def impute_outliers_mean(spark, sf_dir):
    """I11 mean: values beyond 2 std become the mean."""
    return rounded(clean.impute_outliers(table(spark, sf_dir, "events").select("event_id", "value"), "value", "mean"))


@register("impute_outliers_median", """
WITH s AS (SELECT quantile_cont(value, 0.5) AS med FROM events)
SELECT event_id, round(CASE WHEN abs(value - med) > 2 * med THEN med ELSE value END, 6) AS value FROM events, s
""")
def impute_outliers_median(spark, sf_dir):
    """I11 median: values farther than 2 * median from the median become the median."""
    return rounded(clean.impute_outliers(table(spark, sf_dir, "events").select("event_id", "value"), "value", "median"))


@register("impute_outliers_median_with_nulls", f"""
WITH {SQL_EVENT_GAPS}
SELECT event_id, value FROM egaps
""")
def impute_outliers_median_with_nulls(spark, sf_dir):
    """I11 median with a null in the column: the median is NaN in numpy, so nothing changes."""
    ev = domain.events_with_gaps(spark, sf_dir).select("event_id", "value")
    return clean.impute_outliers(ev, "value", "median")


@register("blank_control_chars_documents", """
SELECT doc_id, regexp_replace(text, '[\\x00-\\x1e]', ' ', 'g') AS text FROM documents
""")
def blank_control_chars_documents(spark, sf_dir):
    """H1: characters 0-30 become spaces (31 kept), over whole document texts."""
    d = table(spark, sf_dir, "documents")
    return d.select("doc_id", blank_control_chars("text").alias("text"))


@register("clean_chain_identity", """
SELECT * FROM customer
""")
def clean_chain_identity(spark, sf_dir):
    """The default cleaning and fill hooks leave the table unchanged."""
    return clean.clean_chain(table(spark, sf_dir, "customer"), [clean.clean_data, clean.fill_missing_data])
