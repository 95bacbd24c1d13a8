"""Projections and predicates: column drops, split filters, history-shape casts, constants, look-back,
strict casts, renames, membership, column order, feature attachment."""

from __future__ import annotations

from typing import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalar import days_before


def all_but(df: DataFrame, *cols: str) -> DataFrame:
    """``SELECT * EXCEPT (cols)``."""
    return df.drop(*cols)


def split_rows(df: DataFrame, tag: str, split_col: str = "split", drop_tag: bool = True) -> DataFrame:
    """Rows of one split (``WHERE split = 'TRAIN'``), optionally without the split column."""
    out = df.where(F.col(split_col) == F.lit(tag))
    return out.drop(split_col) if drop_tag else out


def with_constants(df: DataFrame, values: dict) -> DataFrame:
    """Constant columns (insert time, model version, split tag); values are passed in, no wall clock."""
    return df.withColumns({k: (v if isinstance(v, Column) else F.lit(v)) for k, v in values.items()})


def lookback(df: DataFrame, ts_col: str, as_of, days: int) -> DataFrame:
    """Strict look-back: ``ts > as_of - INTERVAL days DAY``."""
    t = df.schema[ts_col].dataType
    return df.where(F.col(ts_col) > days_before(F.lit(as_of).cast(t), days))


def version_rows(df: DataFrame, version, col: str = "model_version") -> DataFrame:
    return df.where(F.col(col) == F.lit(int(version)))


def features_and_label(df: DataFrame, label: str) -> tuple[DataFrame, DataFrame, list[str]]:
    """(features frame, label frame, feature names)."""
    feats = [c for c in df.columns if c != label]
    return df.drop(label), df.select(label), feats


def strict_cast(df: DataFrame, types: dict, not_null: Iterable[str] = ()) -> DataFrame:
    """Casts under ANSI (a malformed string raises; doubles truncate toward zero to int). Columns in
    ``not_null`` raise on a null, as a pandas ``astype(int)`` would."""
    out = df.withColumns({c: F.col(c).cast(t) for c, t in types.items()})
    for c in not_null:
        out = out.withColumn(c, F.when(F.assert_true(F.col(c).isNotNull(), F.lit(f"null in {c}")).isNull(), F.col(c)))
    return out


def rename(df: DataFrame, mapping: dict) -> DataFrame:
    return df.withColumnsRenamed(mapping)


def is_in(df: DataFrame, col: str, values, negate: bool = False) -> DataFrame:
    """Membership; the negated form keeps nulls, as pandas ``~isin`` does."""
    m = F.col(col).isin(list(values))
    return df.where((~m) | F.col(col).isNull()) if negate else df.where(m)


def sorted_columns(df: DataFrame) -> DataFrame:
    """Deterministic column order (``sort_index(axis=1)``)."""
    return df.select(*sorted(df.columns))


def attach_features(df: DataFrame, features: dict) -> DataFrame:
    """Generated features side by side with the inputs."""
    return df.withColumns(features)
