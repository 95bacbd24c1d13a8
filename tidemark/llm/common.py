"""Helpers shared by the text operators: pinned tables in the shared folder, word rules, free names."""

from __future__ import annotations

import sys
import types
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import ensure_checkpoint_dir

# White space that separates words, as a regular expression class and as characters.
SPACE_CLASS = r"[\x20\x09-\x0D]"
WORD_CLASS = r"[^\x20\x09-\x0D]"
SPACE_CHARS = " \t\n\x0b\x0c\r"


def shared_path(spark: SparkSession, name: str) -> str:
    """A new path under the cluster's shared checkpoint folder."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def pin(df: DataFrame, name: str, codec: str = "zstd") -> DataFrame:
    """Write ``df`` to the shared folder and read it back: later stages see fixed rows, and a lost
    executor costs a reread, not a recomputation."""
    return pin_at(df, name, codec)[0]


def pin_at(df: DataFrame, name: str, codec: str = "zstd") -> tuple[DataFrame, str]:
    spark = df.sparkSession
    path = shared_path(spark, name)
    df.write.option("compression", codec).parquet(path)
    return spark.read.schema(df.schema).parquet(path), path


def unpin(spark: SparkSession, path: str) -> None:
    """Delete a pinned table that nothing reads any more."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def free_names(df: DataFrame, *stems: str) -> list[str]:
    """Column names that ``df`` doesn't have (compared without case, as Spark does)."""
    have = {c.lower() for c in df.columns}
    out = []
    for stem in stems:
        name, n = f"__{stem}", 0
        while name.lower() in have:
            n += 1
            name = f"__{stem}_{n}"
        have.add(name.lower())
        out.append(name)
    return out


def col(df: DataFrame, name: str) -> Column:
    """A column by its exact name, dots included."""
    return df["`" + name.replace("`", "``") + "`"]


def text_or_empty(c: Column) -> Column:
    return F.coalesce(c.cast("string"), F.lit(""))


def id_remainder(c: Column, modulus: int) -> Column:
    """crc32 of the id written as text, modulo ``modulus``; null ids give null."""
    return F.crc32(c.cast("string").cast("binary")) % F.lit(modulus)


def worker_cache() -> dict:
    """A dictionary that lives as long as the Python worker (functions travel by value, so their
    module globals don't)."""
    mod = sys.modules.get("_tidemark_worker_cache")
    if mod is None:
        mod = types.ModuleType("_tidemark_worker_cache")
        mod.cache = {}
        sys.modules["_tidemark_worker_cache"] = mod
    return mod.cache


def small_enough(df: DataFrame, max_rows: int) -> bool:
    """Whether ``df`` has at most ``max_rows`` rows (reads no more than that)."""
    return df.limit(max_rows + 1).count() <= max_rows
