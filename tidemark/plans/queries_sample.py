"""Registered queries: projections, predicates, sampling, splits, set operations
(inventory B1-B13, B17, C2, C3, F1-F6, G1)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import projection, sample
from ..sources.testdata import table
from . import domain
from .queries import SQL_HISTORY, register, rounded


def _h(seed, key_sql):
    return f"('0x' || substr(md5('{seed}' || CAST({key_sql} AS VARCHAR)), 1, 15))::BIGINT"


SQL_SPLIT = f"""
r AS (SELECT *, row_number() OVER (ORDER BY {_h(42, 'o_orderkey')}, o_orderkey) AS rk FROM orders),
split_orders AS (SELECT * EXCLUDE (rk), CASE WHEN rk <= ceil((SELECT count(*) FROM orders) * 0.2) THEN 'TEST'
                 ELSE 'TRAIN' END AS split FROM r)"""


def _split_orders(spark, sf_dir):
    return sample.exact_split(table(spark, sf_dir, "orders"), "o_orderkey", 0.2, 42)


@register("train_test_split_orders", f"""
WITH {SQL_SPLIT} SELECT * FROM split_orders
""")
def train_test_split_orders(spark, sf_dir):
    """exact seeded split, test = ceil(0.2 n), stored as one table with a split tag."""
    return _split_orders(spark, sf_dir)


@register("split_sizes_orders", f"""
WITH {SQL_SPLIT} SELECT split, count(*) AS n FROM split_orders GROUP BY 1
""")
def split_sizes_orders(spark, sf_dir):
    """F3 sizes: 80 / 20 with the test side rounded up."""
    return _split_orders(spark, sf_dir).groupBy("split").agg(F.count(F.lit(1)).alias("n"))


@register("train_rows_without_split", f"""
WITH {SQL_SPLIT} SELECT * EXCLUDE (split) FROM split_orders WHERE split = 'TRAIN'
""")
def train_rows_without_split(spark, sf_dir):
    """B1 + B2: ``SELECT * EXCEPT (split) ... WHERE split = 'TRAIN'``."""
    return projection.split_rows(_split_orders(spark, sf_dir), "TRAIN")


@register("train_test_concat", f"""
WITH {SQL_SPLIT}
SELECT * FROM split_orders WHERE split = 'TRAIN' UNION ALL SELECT * FROM split_orders WHERE split = 'TEST'
""")
def train_test_concat(spark, sf_dir):
    """G1: train and test rows concatenated by column name."""
    s = _split_orders(spark, sf_dir)
    return sample.concat_rows(projection.split_rows(s, "TRAIN", drop_tag=False),
                              projection.split_rows(s, "TEST", drop_tag=False).select(*reversed(s.columns)))


@register("fraction_sample_customers", f"""
WITH r AS (SELECT *, row_number() OVER (ORDER BY {_h(5, 'c_custkey')}, c_custkey) AS rk FROM customer)
SELECT * EXCLUDE (rk), rk <= round((SELECT count(*) FROM customer) * 0.8) AS in_sample FROM r
""")
def fraction_sample_customers(spark, sf_dir):
    """exactly round(0.8 n) rows flagged (seed 5); the complement is the unflagged rest."""
    return sample.fraction_sample(table(spark, sf_dir, "customer"), "c_custkey", 0.8, 5)


@register("sample_complement_customers", f"""
WITH r AS (SELECT *, row_number() OVER (ORDER BY {_h(5, 'c_custkey')}, c_custkey) AS rk FROM customer)
SELECT * EXCLUDE (rk) FROM r WHERE rk > round((SELECT count(*) FROM customer) * 0.8)
""")
def sample_complement_customers(spark, sf_dir):
    """Complement of the sample, the filter of its side negated."""
    return sample.sample_and_rest(table(spark, sf_dir, "customer"), "c_custkey", 0.8, 5)[1]


@register("sample_n_orders", f"""
SELECT * FROM orders ORDER BY {_h(7, 'o_orderkey')}, o_orderkey LIMIT 300
""")
def sample_n_orders(spark, sf_dir):
    """300 rows without replacement, seeded top-k by hash (no full sort)."""
    return sample.sample_n(table(spark, sf_dir, "orders"), 300, "o_orderkey", 7)


@register("sorted_by_key_limit", """
SELECT * FROM orders ORDER BY o_orderkey LIMIT 100
""")
def sorted_by_key_limit(spark, sf_dir):
    """F1 + F6: LIMIT with a key order so the rows are reproducible."""
    return sample.limit_rows(table(spark, sf_dir, "orders"), 100, "o_orderkey")


@register("sorted_orders", """
SELECT * FROM orders ORDER BY o_orderkey
""")
def sorted_orders(spark, sf_dir):
    """every row in key order (a range-partitioned sort)."""
    return table(spark, sf_dir, "orders").orderBy("o_orderkey")


@register("blank_first_rows_orders", """
WITH r AS (SELECT *, row_number() OVER (ORDER BY o_orderkey) AS rk FROM orders)
SELECT o_orderkey, o_custkey, o_orderstatus,
       CASE WHEN rk <= 2000 THEN NULL ELSE o_totalprice END AS o_totalprice,
       CASE WHEN rk <= 2000 THEN NULL ELSE o_orderdate END AS o_orderdate, o_orderpriority
FROM r
""")
def blank_first_rows_orders(spark, sf_dir):
    """First 2000 rows (key order), columns 3-4 set to null."""
    o = table(spark, sf_dir, "orders")
    return sample.blank_first_rows(o, 2000, o.columns[3:5], "o_orderkey")


@register("noisy_truth_orders", f"""
SELECT o_orderkey, round(o_totalprice + 3.0 * sqrt(-2.0 * ln(
         (CAST({_h('0a', 'o_orderkey')} AS DOUBLE) + 1.0) / (CAST(1152921504606846976 AS DOUBLE) + 1.0)))
       * cos(2 * pi() * CAST({_h('0b', 'o_orderkey')} AS DOUBLE) / CAST(1152921504606846976 AS DOUBLE)), 6) AS prediction,
       o_totalprice AS target
FROM orders
""")
def noisy_truth_orders(spark, sf_dir):
    """Target plus N(0, 3) noise as a mock prediction (reproducible per key)."""
    o = table(spark, sf_dir, "orders")
    return rounded(o.select("o_orderkey", (F.col("o_totalprice") + sample.gaussian_noise(F.col("o_orderkey"), 0, 3.0))
                            .alias("prediction"), F.col("o_totalprice").alias("target")))


@register("history_shape_cast", f"""
WITH {SQL_HISTORY}
SELECT TIMESTAMP '2024-02-01 09:00:00' AS inserted_at, CAST(event_id AS VARCHAR) AS series_id,
       CAST(CAST(ts AS DATE) AS TIMESTAMP) AS "timestamp", CAST(value > 50 AS INTEGER) AS prediction,
       2 AS model_version
FROM events
""")
def history_shape_cast(spark, sf_dir):
    """B3 + B4: cast and rename a scored batch into history shape with constant insert time and version."""
    from ..operators.history import to_history_rows

    ev = table(spark, sf_dir, "events")
    rows = to_history_rows(ev, F.col("event_id"), F.to_date("ts"), F.col("value") > 50, 2,
                           F.lit("2024-02-01 09:00:00").cast("timestamp_ntz"))
    return rows.withColumn("inserted_at", F.col("inserted_at").cast("timestamp_ntz")) \
        .withColumn("timestamp", F.col("timestamp").cast("timestamp_ntz")) \
        .withColumn("model_version", F.col("model_version").cast("int"))


@register("lookback_version_rows", f"""
WITH {SQL_HISTORY}
SELECT * FROM hist WHERE "timestamp" > TIMESTAMP '2024-02-01 00:00:00' - INTERVAL 20 DAY AND model_version = 1
""")
def lookback_version_rows(spark, sf_dir):
    """B5 + B6: strict look-back of 20 days and one model version."""
    h = domain.inference_history(spark, sf_dir)
    return projection.version_rows(projection.lookback(h, "timestamp", domain.AS_OF, 20), 1)


@register("membership_filters", """
SELECT c_custkey, c_mktsegment, c_nationkey FROM customer
WHERE c_mktsegment NOT IN ('BUILDING', 'MACHINERY') AND c_nationkey IN (1, 2, 3, 5, 8, 13, 21)
""")
def membership_filters(spark, sf_dir):
    """Membership and non-membership (negation keeps nulls)."""
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment", "c_nationkey")
    c = projection.is_in(c, "c_mktsegment", ["BUILDING", "MACHINERY"], negate=True)
    return projection.is_in(c, "c_nationkey", [1, 2, 3, 5, 8, 13, 21])


@register("strict_casts_rename", """
SELECT CAST(c_custkey AS VARCHAR) AS series_id, CAST(trunc(c_acctbal) AS INTEGER) AS acctbal_int,
       CAST(c_nationkey AS DOUBLE) AS nation FROM customer
""")
def strict_casts_rename(spark, sf_dir):
    """B8 + B9: strict casts (double to int truncates toward zero) and renames."""
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_acctbal", "c_nationkey")
    c = projection.strict_cast(c, {"c_custkey": "string", "c_acctbal": "int", "c_nationkey": "double"},
                               not_null=["c_acctbal"])
    return projection.rename(c, {"c_custkey": "series_id", "c_acctbal": "acctbal_int", "c_nationkey": "nation"})


@register("features_sorted_attached", """
SELECT c_acctbal, c_custkey, c_nationkey, round(c_acctbal / 1000.0, 6) AS f_acctbal_k,
       CAST(length(c_name) AS INTEGER) AS f_name_len FROM customer
""")
def features_sorted_attached(spark, sf_dir):
    """B12 + B13 + B7: features (label dropped) in sorted column order, generated features attached."""
    c = table(spark, sf_dir, "customer").select("c_nationkey", "c_custkey", "c_acctbal", "c_mktsegment", "c_name")
    x, _y, _names = projection.features_and_label(c, "c_mktsegment")
    x = projection.sorted_columns(x)
    x = projection.attach_features(x, {"f_acctbal_k": F.col("c_acctbal") / 1000.0, "f_name_len": F.length("c_name")})
    return rounded(x.drop("c_name").select(*sorted(c for c in x.columns if c != "c_name")))


@register("missing_days_anti_join", """
WITH b AS (SELECT min(CAST(o_orderdate AS DATE)) AS lo, max(CAST(o_orderdate AS DATE)) AS hi FROM orders),
d AS (SELECT CAST(unnest(generate_series(CAST(lo AS TIMESTAMP), CAST(hi AS TIMESTAMP), INTERVAL 1 DAY)) AS DATE) AS day
      FROM b)
SELECT day FROM d WHERE day NOT IN (SELECT CAST(o_orderdate AS DATE) FROM orders WHERE o_orderpriority = '1-URGENT')
""")
def missing_days_anti_join(spark, sf_dir):
    """Calendar days of the order history without an urgent order, by anti join."""
    o = table(spark, sf_dir, "orders")
    bounds = o.agg(F.min(F.to_date("o_orderdate")).alias("lo"), F.max(F.to_date("o_orderdate")).alias("hi"))
    days = bounds.select(F.explode(F.sequence("lo", "hi")).alias("day"))
    have = o.where(F.col("o_orderpriority") == "1-URGENT").select(F.to_date("o_orderdate").alias("day")).distinct()
    return days.join(have, "day", "left_anti")


@register("scalar_functions_orders", """
SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS order_day,
       strftime(o_orderdate, '%Y_%m_%dT%H_%M_%S') || '_' || lpad(CAST(CAST(floor(microsecond(o_orderdate) / 1000) AS INTEGER) AS VARCHAR), 3, '0') || 'Z' AS snapshot_suffix,
       split_part('models/classifier/' || o_orderstatus || '@' || CAST(o_custkey AS VARCHAR), '@', 1) AS model_uri,
       CAST(o_orderdate AS DATE) BETWEEN DATE '1998-08-01' - INTERVAL 1 DAY - INTERVAL 30 DAY
                                     AND DATE '1998-08-01' - INTERVAL 1 DAY AS in_training_window,
       round(CASE WHEN o_custkey % 5 = 0 THEN NULL ELSE o_totalprice / (o_custkey % 5) END, 6) AS price_ratio,
       CAST(o_orderstatus = 'F' AS DOUBLE) AS is_final
FROM orders
""")
def scalar_functions_orders(spark, sf_dir):
    """Day text, snapshot-style timestamp text, model URI without version,
    training window (yesterday and 30 days before it), zero-safe division, bool metric as double."""
    from ..functions import scalar as S

    o = table(spark, sf_dir, "orders")
    earlier, yesterday = S.training_window("1998-08-01", 30)
    d = F.to_date("o_orderdate")
    return rounded(o.select(
        "o_orderkey",
        S.day_string("o_orderdate").alias("order_day"),
        S.millis_string("o_orderdate").alias("snapshot_suffix"),
        S.uri_without_version(F.concat(F.lit("models/classifier/"), "o_orderstatus", F.lit("@"), F.col("o_custkey").cast("string")))
        .alias("model_uri"),
        ((d >= earlier) & (d <= yesterday)).alias("in_training_window"),
        S.safe_ratio(F.col("o_totalprice"), F.col("o_custkey") % 5).alias("price_ratio"),
        S.metric_as_double(F.col("o_orderstatus") == "F").alias("is_final"),
    ))
