"""Registered queries: SQL sources, training table, model training / evaluation / scoring
(inventory A1-A4, K1-K5, K10)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import model, profile, quality, sample
from ..session import pin
from ..sources import catalog
from ..sources.testdata import register_views
from . import domain
from .domain import SQL_DOC_FEATURES
from .queries import register, rounded


@register("sql_query_with_casts", """
SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, CAST(trunc(o_totalprice) AS INTEGER) AS o_totalprice, o_orderstatus
FROM orders WHERE o_orderpriority = '1-URGENT'
""")
def sql_query_with_casts(spark, sf_dir):
    """A1: SQL to frame with per-column casts; values pass as parameter markers."""
    register_views(spark, sf_dir, ["orders"])
    return catalog.run_sql(spark, "SELECT o_orderkey, o_totalprice, o_orderstatus FROM orders WHERE o_orderpriority = :p",
                           {"o_orderkey": "string", "o_totalprice": "int"}, {"p": "1-URGENT"})


@register("sql_file_query", """
SELECT CAST(o_orderstatus AS VARCHAR) AS column_1, count(*) AS n_orders FROM orders GROUP BY o_orderstatus
""")
def sql_file_query(spark, sf_dir):
    """A2: a query kept in a .sql resource file (byte-order mark dropped), fixed dtypes."""
    register_views(spark, sf_dir, ["orders"])
    return catalog.run_sql_file(spark, "sample_query.sql")


@register("flagged_scan_labels", """
SELECT * FROM labels WHERE quality = 1
""")
def flagged_scan_labels(spark, sf_dir):
    """A3: filtered scan template ``SELECT * FROM t WHERE col == 1``."""
    register_views(spark, sf_dir, ["labels"])
    return catalog.flagged_rows(spark, "labels", "quality")


@register("full_scan_supplier", """
SELECT * FROM supplier
""")
def full_scan_supplier(spark, sf_dir):
    """A4: full scan template."""
    register_views(spark, sf_dir, ["supplier"])
    return catalog.full_scan(spark, "supplier")


@register("document_features", f"""
WITH {SQL_DOC_FEATURES}
SELECT doc_id, n_chars, n_lines, n_words, round(digit_share, 6) AS digit_share, is_en, label FROM docf
""")
def document_features(spark, sf_dir):
    """K1: feature frame over whole document texts, columns in sorted order."""
    f = model.featurize(domain.document_features(spark, sf_dir))
    return rounded(f)


def _training_table(spark, sf_dir):
    f = domain.document_features(spark, sf_dir).where(F.col("label").isNotNull())
    return sample.exact_split(profile.require_rows(f, "training data"), "doc_id", 0.2, 42)


@register("training_table_documents", f"""
WITH {SQL_DOC_FEATURES},
r AS (SELECT *, row_number() OVER (ORDER BY ('0x' || substr(md5('42' || CAST(doc_id AS VARCHAR)), 1, 15))::BIGINT, doc_id)
          AS rk FROM docf WHERE label IS NOT NULL)
SELECT doc_id, n_chars, n_lines, n_words, round(digit_share, 6) AS digit_share, is_en, label,
       CASE WHEN rk <= ceil((SELECT count(*) FROM r) * 0.2) THEN 'TEST' ELSE 'TRAIN' END AS split FROM r
""")
def training_table_documents(spark, sf_dir):
    """Read, guard against empty input, exact 80/20 split, tagged as one table."""
    return rounded(_training_table(spark, sf_dir))


@register("train_evaluate_documents", """
WITH l AS (SELECT count(*) AS n FROM documents d JOIN labels l ON d.doc_id = l.doc_id WHERE l.quality IS NOT NULL)
SELECT CAST(n - ceil(n * 0.2) AS BIGINT) AS train_rows, CAST(ceil(n * 0.2) AS BIGINT) AS test_rows,
       true AS metrics_in_range, true AS recall_is_accuracy FROM l
""")
def train_evaluate_documents(spark, sf_dir):
    """K2 + K3: random forest on TRAIN rows, weighted report on TEST rows. The metrics themselves depend on the
    trees; what must hold for any: sizes, ranges, and that the weighted recall is the accuracy."""
    t = pin(_training_table(spark, sf_dir), "training")
    m = model.train_classifier(t.where("split = 'TRAIN'"), "label", domain.DOC_FEATURES)
    scored = model.score(m, t.where("split = 'TEST'")).withColumn("prediction", F.col("prediction").cast("int"))
    report = quality.weighted_report(scored, "label")
    inside = lambda c: F.col(c).between(0.0, 1.0)
    sizes = t.agg(F.struct(F.count(F.when(F.col("split") == "TRAIN", 1)).alias("train"),
                           F.count(F.when(F.col("split") == "TEST", 1)).alias("test"))).scalar()
    return report.withColumn("s", sizes).select(
        F.col("s.train").alias("train_rows"), F.col("s.test").alias("test_rows"),
        (inside("accuracy") & inside("precision") & inside("recall") & inside("f1score")).alias("metrics_in_range"),
        (F.abs(F.col("recall") - F.col("accuracy")) < 1e-9).alias("recall_is_accuracy"))


@register("batch_scores_documents", """
SELECT doc_id, CAST(doc_id AS VARCHAR) AS series_id, '2024-02-01' AS prediction_timestamp, 3 AS model_version,
       true AS label_follows_probability, true AS probability_in_range FROM documents
""")
def batch_scores_documents(spark, sf_dir):
    """K4 + K5: score every document (labelled or not) in one transform: date text, series id, version, and the
    label (1 from a class-1 probability of one half) against the probability."""
    t = _training_table(spark, sf_dir)
    m = model.train_classifier(t.where("split = 'TRAIN'"), "label", domain.DOC_FEATURES)
    out = model.batch_predictions(m, domain.document_features(spark, sf_dir), "doc_id", "2024-02-01", 3, with_probability=True)
    # at one half exactly the forest may take either class
    follows = (F.col("proba") == 0.5) | (F.col("prediction_value") == (F.col("proba") > 0.5).cast("int"))
    return out.select("doc_id", "series_id", "prediction_timestamp", "model_version",
                      follows.alias("label_follows_probability"), F.col("proba").between(0.0, 1.0).alias("probability_in_range"))
