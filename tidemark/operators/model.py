"""Model jobs: features, training, evaluation, batch scoring, class-1 probability, persistence.

Spark ML pipelines (``VectorAssembler`` + ``RandomForestClassifier``) train and score on the
cluster; the fitted ``PipelineModel`` is saved as a directory.
"""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalar import day_string
from .projection import sorted_columns


def generate_features(df: DataFrame) -> dict[str, Column]:
    """Feature hook: no generated features by default."""
    return {}


def featurize(df: DataFrame, feature_hook=generate_features) -> DataFrame:
    """Order columns, attach generated features, order again (``fit`` learns nothing)."""
    ordered = sorted_columns(df)
    extra = feature_hook(ordered)
    return sorted_columns(ordered.withColumns(extra)) if extra else ordered


def train_classifier(train: DataFrame, label: str, feature_cols, num_trees: int = 20, max_depth: int = 5,
                     seed: int = 42) -> PipelineModel:
    """Features + random forest pipeline fitted on the training rows."""
    assembler = VectorAssembler(inputCols=list(feature_cols), outputCol="features", handleInvalid="keep")
    rf = RandomForestClassifier(labelCol=label, featuresCol="features", numTrees=num_trees, maxDepth=max_depth,
                                seed=seed)
    return Pipeline(stages=[assembler, rf]).fit(train.withColumn(label, F.col(label).cast("double")))


def score(model: PipelineModel, df: DataFrame) -> DataFrame:
    return model.transform(df)


def positive_probability(scored: DataFrame, out: str = "proba") -> DataFrame:
    """Class-1 probability from the probability vector."""
    return scored.withColumn(out, vector_to_array("probability")[1])


def batch_predictions(model: PipelineModel, df: DataFrame, series_id, as_of_date, model_version: int,
                      with_probability: bool = False) -> DataFrame:
    """Score a batch: prediction as int, date text, series id as text, model version; optionally the class-1
    probability of the same transform."""
    s = positive_probability(model.transform(df))
    sid = F.col(series_id) if isinstance(series_id, str) else series_id
    keep = [c for c in df.columns]
    return s.select(
        *keep,
        F.col("prediction").cast("int").alias("prediction_value"),
        day_string(F.lit(as_of_date).cast("date")).alias("prediction_timestamp"),
        sid.cast("string").alias("series_id"),
        F.lit(int(model_version)).alias("model_version"),
        *(["proba"] if with_probability else []),
    )


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def load_default_model(registry: DataFrame, model_name: str) -> tuple[PipelineModel, int]:
    """Load the default version of ``model_name`` from the registry table; returns (model, version)."""
    row = registry.where((F.col("model") == model_name) & F.col("is_default")).select("version", "path").first()
    if row is None:
        raise LookupError(f"no default version of {model_name}")
    return load_model(row["path"]), int(row["version"])
