"""Registered queries: profiles (inventory B14-B16, D3-D13, D15)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import profile
from ..sources.testdata import table
from . import domain
from .domain import SQL_GAPS
from .queries import register, rounded

NUM = domain.LINEITEM_NUMERIC

SQL_LONG = SQL_GAPS + """,
long AS (
  UNPIVOT (SELECT CAST(l_quantity AS DOUBLE) AS l_quantity, CAST(l_extendedprice AS DOUBLE) AS l_extendedprice,
                  CAST(l_discount AS DOUBLE) AS l_discount,
                  CASE WHEN isnan(l_tax) THEN NULL ELSE CAST(l_tax AS DOUBLE) END AS l_tax FROM gaps)
  ON l_quantity, l_extendedprice, l_discount, l_tax INTO NAME "column" VALUE value)"""


@register("describe_lineitem", f"""
WITH {SQL_LONG}
SELECT "column", count(value) AS count, round(avg(value), 6) AS mean, round(stddev_samp(value), 6) AS std,
       round(min(value), 6) AS min, round(quantile_cont(value, 0.25), 6) AS p25,
       round(quantile_cont(value, 0.5), 6) AS p50, round(quantile_cont(value, 0.75), 6) AS p75,
       round(max(value), 6) AS max
FROM long WHERE value IS NOT NULL GROUP BY "column"
""")
def describe_lineitem(spark, sf_dir):
    """D3: describe the numeric line-item columns (with made holes), exact quartiles."""
    d = profile.describe(domain.lineitem_with_gaps(spark, sf_dir), list(NUM))
    return rounded(d.withColumnsRenamed({"25%": "p25", "50%": "p50", "75%": "p75"}))


@register("null_percentage_lineitem", f"""
WITH {SQL_GAPS}
UNPIVOT (
  SELECT round(avg(CASE WHEN l_orderkey IS NULL THEN 1.0 ELSE 0.0 END) * 100, 6) AS l_orderkey,
         round(avg(CASE WHEN l_linenumber IS NULL THEN 1.0 ELSE 0.0 END) * 100, 6) AS l_linenumber,
         round(avg(CASE WHEN l_shipdate IS NULL THEN 1.0 ELSE 0.0 END) * 100, 6) AS l_shipdate,
         round(avg(CASE WHEN l_returnflag IS NULL THEN 1.0 ELSE 0.0 END) * 100, 6) AS l_returnflag,
         round(avg(CASE WHEN l_quantity IS NULL OR isnan(l_quantity) THEN 1.0 ELSE 0.0 END) * 100, 6) AS l_quantity,
         round(avg(CASE WHEN l_extendedprice IS NULL OR isnan(l_extendedprice) THEN 1.0 ELSE 0.0 END) * 100, 6)
           AS l_extendedprice,
         round(avg(CASE WHEN l_discount IS NULL OR isnan(l_discount) THEN 1.0 ELSE 0.0 END) * 100, 6) AS l_discount,
         round(avg(CASE WHEN l_tax IS NULL OR isnan(l_tax) THEN 1.0 ELSE 0.0 END) * 100, 6) AS l_tax
  FROM gaps)
ON COLUMNS(*) INTO NAME "column" VALUE null_pct
""")
def null_percentage_lineitem(spark, sf_dir):
    """Percentage of missing values per column (NaN counts as missing)."""
    return rounded(profile.null_percentage(domain.lineitem_with_gaps(spark, sf_dir)))


@register("central_values_lineitem", f"""
WITH {SQL_LONG},
nn AS (SELECT * FROM long WHERE value IS NOT NULL),
cnt AS (SELECT "column", value, count(*) AS n FROM nn GROUP BY 1, 2),
md AS (SELECT "column", arg_max(value, row(n, -value)) AS mode FROM cnt GROUP BY 1)
SELECT s."column", round(s.mean, 6) AS mean, round(s.median, 6) AS median, round(md.mode, 6) AS mode
FROM (SELECT "column", avg(value) AS mean, quantile_cont(value, 0.5) AS median FROM nn GROUP BY 1) s
JOIN md ON s."column" = md."column"
""")
def central_values_lineitem(spark, sf_dir):
    """Mean, exact median and smallest mode per numeric column."""
    return rounded(profile.central_values(domain.lineitem_with_gaps(spark, sf_dir), list(NUM)))


@register("quantiles_totalprice_by_status", """
SELECT o_orderstatus, round(quantile_cont(o_totalprice, 0.25), 6) AS q25,
       round(quantile_cont(o_totalprice, 0.75), 6) AS q75, round(quantile_cont(o_totalprice, 0.9), 6) AS q90
FROM orders GROUP BY o_orderstatus
""")
def quantiles_totalprice_by_status(spark, sf_dir):
    """Exact linear quantiles per group through the bucketed ordered plan."""
    o = table(spark, sf_dir, "orders")
    return rounded(profile.quantiles(o, "o_totalprice", {"q25": 0.25, "q75": 0.75, "q90": 0.9}, ["o_orderstatus"]))


@register("spread_lineitem", f"""
WITH {SQL_LONG}
SELECT "column", round(avg(value), 6) AS mean, round(stddev_pop(value), 6) AS std_pop FROM long GROUP BY 1
""")
def spread_lineitem(spark, sf_dir):
    """Population std (ddof 0) and mean, nulls skipped."""
    return rounded(profile.spread(domain.lineitem_with_gaps(spark, sf_dir), list(NUM)))


@register("order_date_range_by_priority", """
SELECT o_orderpriority, min(o_orderdate) AS min_date, max(o_orderdate) AS max_date
FROM orders WHERE o_orderpriority IS NOT NULL GROUP BY 1
""")
def order_date_range_by_priority(spark, sf_dir):
    """First and last date per group."""
    return profile.date_range(table(spark, sf_dir, "orders"), "o_orderdate", "o_orderpriority")


@register("correlation_lineitem", f"""
WITH {SQL_GAPS},
t AS (SELECT l_quantity, l_extendedprice, l_discount, CASE WHEN NOT isnan(l_tax) THEN l_tax END AS l_tax FROM gaps),
c AS (SELECT corr(l_quantity, l_extendedprice) AS qe, corr(l_quantity, l_discount) AS qd,
             corr(l_extendedprice, l_discount) AS ed, corr(l_quantity, l_tax) AS qt,
             corr(l_extendedprice, l_tax) AS et, corr(l_discount, l_tax) AS dt FROM t),
pairs AS (
  SELECT 'l_quantity' AS col_a, 'l_extendedprice' AS col_b, qe AS corr FROM c UNION ALL
  SELECT 'l_quantity', 'l_discount', qd FROM c UNION ALL
  SELECT 'l_extendedprice', 'l_discount', ed FROM c UNION ALL
  SELECT 'l_quantity', 'l_tax', qt FROM c UNION ALL
  SELECT 'l_extendedprice', 'l_tax', et FROM c UNION ALL
  SELECT 'l_discount', 'l_tax', dt FROM c)
SELECT col_a, col_b, round(corr, 6) AS corr FROM pairs
UNION ALL SELECT col_b, col_a, round(corr, 6) FROM pairs
UNION ALL SELECT x, x, 1.0 FROM (VALUES ('l_quantity'), ('l_extendedprice'), ('l_discount'), ('l_tax')) v(x)
""")
def correlation_lineitem(spark, sf_dir):
    """Pairwise-complete Pearson matrix, long form."""
    return rounded(profile.correlation_matrix(domain.lineitem_with_gaps(spark, sf_dir),
                                              ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]))


@register("value_counts_segment", """
SELECT c_mktsegment, count(*) AS count FROM customer GROUP BY 1
""")
def value_counts_segment(spark, sf_dir):
    """Value counts."""
    return profile.value_counts(table(spark, sf_dir, "customer"), "c_mktsegment")


@register("histogram_event_value", """
WITH s AS (SELECT min(value) AS lo, max(value) AS hi FROM events),
b AS (SELECT least(floor((value - lo) / ((hi - lo) / 10.0)), 9) AS bin, lo, (hi - lo) / 10.0 AS w FROM events, s)
SELECT CAST(bin AS INTEGER) AS bin, round(lo + bin * w, 6) AS bin_start, round(lo + (bin + 1) * w, 6) AS bin_end,
       count(*) AS count
FROM b GROUP BY bin, lo, w
""")
def histogram_event_value(spark, sf_dir):
    """10 equal-width bins over [min, max], last bin closed."""
    return rounded(profile.histogram(table(spark, sf_dir, "events"), "value", 10))


@register("box_stats_quantity_by_flag", """
WITH q AS (SELECT l_returnflag, quantile_cont(l_quantity, 0.25) AS q1, quantile_cont(l_quantity, 0.5) AS median,
                  quantile_cont(l_quantity, 0.75) AS q3 FROM lineitem GROUP BY 1),
j AS (SELECT l.l_returnflag, l.l_quantity AS v, q1, median, q3,
             l.l_quantity BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1) AS inside
      FROM lineitem l JOIN q ON l.l_returnflag = q.l_returnflag)
SELECT l_returnflag, round(any_value(q1), 6) AS q1, round(any_value(median), 6) AS median, round(any_value(q3), 6) AS q3,
       round(min(CASE WHEN inside THEN v END), 6) AS whisker_low, round(max(CASE WHEN inside THEN v END), 6) AS whisker_high,
       count(CASE WHEN NOT inside THEN 1 END) AS outliers
FROM j GROUP BY 1
""")
def box_stats_quantity_by_flag(spark, sf_dir):
    """Box-plot statistics per group."""
    return rounded(profile.box_stats(table(spark, sf_dir, "lineitem"), "l_quantity", "l_returnflag"))


@register("box_stats_event_value", """
WITH q AS (SELECT quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.5) AS median,
                  quantile_cont(value, 0.75) AS q3 FROM events),
j AS (SELECT e.value AS v, q1, median, q3, e.value BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1) AS inside
      FROM events e, q)
SELECT round(any_value(q1), 6) AS q1, round(any_value(median), 6) AS median, round(any_value(q3), 6) AS q3,
       round(min(CASE WHEN inside THEN v END), 6) AS whisker_low, round(max(CASE WHEN inside THEN v END), 6) AS whisker_high,
       count(CASE WHEN NOT inside THEN 1 END) AS outliers
FROM j
""")
def box_stats_event_value(spark, sf_dir):
    """D12 whole-table: quartiles enter as scalar subqueries."""
    return rounded(profile.box_stats(table(spark, sf_dir, "events"), "value"))


@register("numeric_columns_orders", """
SELECT o_orderkey, o_custkey, o_totalprice FROM orders
""")
def numeric_columns_orders(spark, sf_dir):
    """Numeric columns only."""
    return profile.select_numeric(table(spark, sf_dir, "orders"))


@register("preview_orders", """
SELECT * FROM orders ORDER BY o_orderkey LIMIT 10
""")
def preview_orders(spark, sf_dir):
    """Ten-row preview (ordered by key so it is deterministic)."""
    return profile.preview(table(spark, sf_dir, "orders"), 10, "o_orderkey")


@register("info_lineitem", f"""
WITH {SQL_GAPS}
SELECT * FROM (VALUES
  (0, 'l_orderkey', 'bigint'), (1, 'l_linenumber', 'int'), (2, 'l_shipdate', 'timestamp_ntz'),
  (3, 'l_returnflag', 'string'), (4, 'l_quantity', 'double'), (5, 'l_extendedprice', 'double'),
  (6, 'l_discount', 'double'), (7, 'l_tax', 'double')) t(position, "column", dtype)
JOIN (UNPIVOT (SELECT count(l_orderkey) AS l_orderkey, count(l_linenumber) AS l_linenumber,
                      count(l_shipdate) AS l_shipdate, count(l_returnflag) AS l_returnflag,
                      count(l_quantity) AS l_quantity, count(l_extendedprice) AS l_extendedprice,
                      count(l_discount) AS l_discount, count(l_tax) AS l_tax, count(*) AS "rows" FROM gaps)
      ON COLUMNS(* EXCLUDE ("rows")) INTO NAME "column" VALUE non_null) c USING ("column")
""")
def info_lineitem(spark, sf_dir):
    """Shape and dtypes with non-null counts (NaN is not null here, as in ``info()``)."""
    return profile.info(domain.lineitem_with_gaps(spark, sf_dir))


@register("duplicate_line_keys", """
SELECT l_orderkey, l_linenumber, count(*) AS count FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1
""")
def duplicate_line_keys(spark, sf_dir):
    """Keys occurring more than once."""
    return profile.duplicate_keys(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


@register("scatter_sample_lineitem", """
SELECT l_quantity, l_extendedprice FROM lineitem
""")
def scatter_sample_lineitem(spark, sf_dir):
    """Two-column scatter data of every row."""
    return table(spark, sf_dir, "lineitem").select("l_quantity", "l_extendedprice")


@register("category_quality_lineitem", """
WITH l AS (SELECT CASE WHEN l_shipdate < TIMESTAMP '1998-04-01' THEN 'reference' ELSE 'current' END AS side,
                  l_returnflag, l_linestatus FROM lineitem),
c AS (SELECT side, 'l_returnflag' AS "column", l_returnflag AS value, count(*) AS count FROM l GROUP BY ALL
      UNION ALL SELECT side, 'l_linestatus', l_linestatus, count(*) FROM l GROUP BY ALL)
SELECT side, "column", value, count, CAST(sum(count) OVER w AS BIGINT) AS "rows", count(value) OVER w AS "distinct"
FROM c WINDOW w AS (PARTITION BY side, "column")
""")
def category_quality_lineitem(spark, sf_dir):
    """J7 for categorical columns: value counts, rows and distinct values of both sides."""
    li = table(spark, sf_dir, "lineitem")
    cut = F.lit("1998-04-01 00:00:00").cast("timestamp_ntz")
    return profile.category_quality(li.where(F.col("l_shipdate") < cut), li.where(F.col("l_shipdate") >= cut),
                                    ["l_returnflag", "l_linestatus"])


@register("data_quality_profile_lineitem", f"""
WITH {SQL_GAPS},
wide AS (SELECT CAST(l_quantity AS DOUBLE) AS l_quantity, CAST(l_discount AS DOUBLE) AS l_discount,
                CASE WHEN isnan(l_tax) THEN NULL ELSE CAST(l_tax AS DOUBLE) END AS l_tax,
                CASE WHEN l_shipdate < TIMESTAMP '1998-04-01' THEN 'reference' ELSE 'current' END AS side FROM gaps),
long AS (SELECT * FROM wide UNPIVOT INCLUDE NULLS (value FOR "column" IN (l_quantity, l_discount, l_tax)))
SELECT side, "column", count(*) AS "rows", count(*) FILTER (WHERE value IS NULL) AS missing,
       count(DISTINCT value) AS "distinct", round(avg(value), 6) AS mean, round(stddev_samp(value), 6) AS std,
       round(min(value), 6) AS min, round(quantile_cont(value, 0.25), 6) AS p25, round(quantile_cont(value, 0.5), 6) AS p50,
       round(quantile_cont(value, 0.75), 6) AS p75, round(max(value), 6) AS max
FROM long GROUP BY 1, 2
""")
def data_quality_profile_lineitem(spark, sf_dir):
    """Data-quality profile of reference (shipped before 1998-04-01) and current side by side."""
    g = domain.lineitem_with_gaps(spark, sf_dir)
    cut = F.lit("1998-04-01 00:00:00").cast("timestamp_ntz")
    cols = ["l_quantity", "l_discount", "l_tax"]
    return rounded(profile.data_quality(g.where(F.col("l_shipdate") < cut), g.where(F.col("l_shipdate") >= cut), cols))
