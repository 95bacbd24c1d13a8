"""Catalog sources and sinks: SQL to frame, query files, scan templates, CSV, appends, metric
tables with additive schema evolution, snapshot names, namespaces, renames, table expiry.

Identifiers go through the API (quoted), values through parameter markers; nothing is pasted into
SQL text from data.
"""

from __future__ import annotations

import datetime as dt
import importlib.resources
import pathlib
from typing import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

EXPIRY_PROPERTY = "expires_at"

# The default per-column type override of the sample query runner.
SAMPLE_QUERY_DTYPES = {"column_1": "string"}


def quote(name: str) -> str:
    """Quote a possibly qualified identifier ``db.table``."""
    return ".".join(f"`{p.replace('`', '``')}`" for p in name.split("."))


def run_sql(spark: SparkSession, sql: str, dtypes: dict | None = None, args: dict | None = None) -> DataFrame:
    """Run SQL and apply per-column casts (ANSI: a bad value raises)."""
    df = spark.sql(sql, args=args) if args else spark.sql(sql)
    if dtypes:
        df = df.withColumns({c: F.col(c).cast(t) for c, t in dtypes.items()})
    return df


def query_text(name: str) -> str:
    """The text of a query: a file by its absolute path, else one shipped with the package. Editors that mark UTF-8
    with a byte-order mark don't disturb it."""
    place = pathlib.Path(name)
    if not place.is_absolute():
        place = importlib.resources.files("tidemark.resources").joinpath(name)
    return place.read_bytes().decode("utf-8").removeprefix("\ufeff")


def run_sql_file(spark: SparkSession, file_name: str, dtypes: dict | None = None, args: dict | None = None) -> DataFrame:
    """Run a query kept in a ``.sql`` resource file."""
    return run_sql(spark, query_text(file_name), SAMPLE_QUERY_DTYPES if dtypes is None else dtypes, args)


def flagged_rows(spark: SparkSession, table_name: str, flag_col: str) -> DataFrame:
    """``SELECT * FROM table WHERE flag = 1``."""
    return spark.table(table_name).where(F.col(flag_col) == 1)


def train_test_sources(spark: SparkSession, p1: str, p2: str, p3: str) -> tuple[DataFrame, DataFrame]:
    """The two-table variant: ``(p1, p2)`` and ``(p2, p3)`` as (table, flag column) pairs."""
    return flagged_rows(spark, p1, p2), flagged_rows(spark, p2, p3)


def full_scan(spark: SparkSession, table_name: str) -> DataFrame:
    return spark.table(table_name)


def read_csv(spark: SparkSession, path: str, schema: str | T.StructType | None = None) -> DataFrame:
    """CSV with header; an explicit schema avoids an inference pass."""
    r = spark.read.option("header", True)
    return r.schema(schema).csv(path) if schema is not None else r.option("inferSchema", True).csv(path)


def append_table(df: DataFrame, table_name: str, dtypes: dict | None = None, partition_by: Iterable[str] = ()) -> None:
    """Append (creating the table when absent), with optional explicit column types. Columns that the table doesn't
    have, or lacks here, are an error: nothing is dropped or filled silently."""
    if dtypes:
        df = df.withColumns({c: F.col(c).cast(t) for c, t in dtypes.items()})
    spark = df.sparkSession
    if spark.catalog.tableExists(table_name):
        existing = spark.table(table_name).columns
        if sorted(existing) != sorted(df.columns):
            raise ValueError(f"{table_name} has columns {sorted(existing)}, the rows have {sorted(df.columns)}")
        df.select(*existing).write.mode("append").insertInto(table_name)
    else:
        w = df.write.mode("append").format("parquet")
        if partition_by:
            w = w.partitionBy(*partition_by)
        w.saveAsTable(table_name)


def replace_table(df: DataFrame, table_name: str) -> None:
    """Write a whole table in place of the one that has the name. ``df`` mustn't read it."""
    df.write.mode("overwrite").format("parquet").saveAsTable(table_name)
    df.sparkSession.catalog.refreshTable(table_name)


def overwrite_partitions(df: DataFrame, table_name: str) -> None:
    """Replace the partitions of a table that ``df`` has rows of; the others stay. ``df`` mustn't read the table."""
    spark, key = df.sparkSession, "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(key)
    spark.conf.set(key, "dynamic")  # insertInto knows no option for it
    try:
        df.select(*spark.table(table_name).columns).write.mode("overwrite").insertInto(table_name)
    finally:
        spark.conf.set(key, before)
    spark.catalog.refreshTable(table_name)


def python_type_to_spark(value, default: T.DataType | None = None) -> T.DataType:
    """bool -> boolean, int -> bigint, float -> double, str -> string, datetime -> timestamp."""
    if isinstance(value, bool):
        return T.BooleanType()
    if isinstance(value, int):
        return T.LongType()
    if isinstance(value, float):
        return T.DoubleType()
    if isinstance(value, str):
        return T.StringType()
    if isinstance(value, dt.datetime):
        return T.TimestampType()
    if default is not None:
        return default
    raise TypeError(f"unsupported metric type {type(value).__name__}")


def metrics_row(spark: SparkSession, model_name: str, model_version, timestamp: dt.datetime, metrics: dict) -> DataFrame:
    """A one-row metrics frame ``(model_name, model_version, timestamp, <metric>...)``."""
    fields = [T.StructField("model_name", T.StringType()), T.StructField("model_version", T.StringType()),
              T.StructField("timestamp", T.TimestampType())]
    fields += [T.StructField(k, python_type_to_spark(v)) for k, v in metrics.items()]
    return spark.createDataFrame([(model_name, str(model_version), timestamp, *metrics.values())], T.StructType(fields))


def write_metrics(df: DataFrame, table_name: str) -> None:
    """Append metrics rows; create the table, add new metric columns, reject a changed type."""
    spark = df.sparkSession
    if not spark.catalog.tableExists(table_name):
        df.write.mode("append").format("parquet").saveAsTable(table_name)
        return
    current = {f.name: f.dataType for f in spark.table(table_name).schema.fields}
    new_cols = []
    for f in df.schema.fields:
        if f.name in current:
            if current[f.name] != f.dataType:
                raise TypeError(f"metric {f.name} changes type {current[f.name].simpleString()} -> "
                                f"{f.dataType.simpleString()}")
        else:
            new_cols.append(f)
    if new_cols:
        cols = ", ".join(f"{quote(f.name)} {f.dataType.simpleString()}" for f in new_cols)
        spark.sql(f"ALTER TABLE {quote(table_name)} ADD COLUMNS ({cols})")
    target = spark.table(table_name).schema
    out = df.select(*[(F.col(f.name) if f.name in df.columns else F.lit(None).cast(f.dataType)).alias(f.name)
                      for f in target.fields])
    out.write.mode("append").insertInto(table_name)


def unique_table_name(prefix: str, as_of: dt.datetime, dataset: str | None = None) -> str:
    """``prefix + %Y_%m_%dT%H_%M_%S_mmmZ`` in UTC, milliseconds truncated."""
    t = as_of.astimezone(dt.timezone.utc) if as_of.tzinfo else as_of
    name = f"{prefix}{t.strftime('%Y_%m_%dT%H_%M_%S')}_{t.microsecond // 1000:03d}Z"
    return f"{dataset}.{name}" if dataset else name


def create_namespace(spark: SparkSession, name: str) -> None:
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {quote(name)}")


def rename_table(spark: SparkSession, old: str, new: str) -> None:
    spark.sql(f"ALTER TABLE {quote(old)} RENAME TO {quote(new)}")
    spark.catalog.refreshTable(new)  # drop file listings cached under the old location


def set_expiry(spark: SparkSession, table_name: str, as_of: dt.datetime, days: int) -> str:
    """Record an expiry time ``as_of + days`` as a table property (Spark has no table expiry)."""
    at = (as_of + dt.timedelta(days=days)).strftime("%Y-%m-%d %H:%M:%S")
    spark.sql(f"ALTER TABLE {quote(table_name)} SET TBLPROPERTIES ('{EXPIRY_PROPERTY}' = '{at}')")
    return at


def purge_expired(spark: SparkSession, database: str, as_of: dt.datetime) -> list[str]:
    """Drop tables of ``database`` whose expiry time has passed; returns their names."""
    dropped = []
    for t in spark.catalog.listTables(database):
        if t.isTemporary:
            continue
        name = f"{database}.{t.name}"
        props = {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {quote(name)}").collect()}
        at = props.get(EXPIRY_PROPERTY)
        if at and dt.datetime.strptime(at, "%Y-%m-%d %H:%M:%S") <= as_of.replace(tzinfo=None):
            spark.sql(f"DROP TABLE {quote(name)}")
            dropped.append(name)
    return dropped
