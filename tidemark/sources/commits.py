"""Appends that can be repeated: every run of a job is a commit, and a commit's rows replace themselves.

A commit is named ``job@as_of``. Tables written this way are partitioned by ``commit_id``; writing a commit overwrites its own
partition and no other, so a run that is repeated, or broken between two tables and started again, ends with the
same rows. When all tables of a run are written, one row in a commit table says so; ``committed`` reads only
commits that are finished, so the tables of a broken run agree.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .catalog import overwrite_partitions, quote

COMMIT = "commit_id"


def commit_name(job: str, as_of) -> str:
    return f"{job}@{as_of}"


def write_commit(df: DataFrame, table_name: str, commit: str) -> None:
    """The rows of a commit, in place of those it wrote before. Columns that the table doesn't have are added to it, those
    that the rows lack are null; another type is an error. ``df`` mustn't read the table."""
    spark = df.sparkSession
    rows = df.withColumn(COMMIT, F.lit(commit))
    if not spark.catalog.tableExists(table_name):
        rows.limit(0).write.format("parquet").partitionBy(COMMIT).saveAsTable(table_name)
    current = {f.name: f.dataType for f in spark.table(table_name).schema.fields}
    for f in df.schema.fields:
        if f.name in current and current[f.name] != f.dataType:
            raise TypeError(f"{f.name} changes type {current[f.name].simpleString()} -> {f.dataType.simpleString()}")
    new = [f"{quote(f.name)} {f.dataType.simpleString()}" for f in df.schema.fields if f.name not in current]
    if new:
        spark.sql(f"ALTER TABLE {quote(table_name)} ADD COLUMNS ({', '.join(new)})")
    rows = rows.withColumns({c: F.lit(None).cast(t) for c, t in current.items() if c not in rows.columns})
    if rows.isEmpty():  # an overwrite without rows would leave the old ones
        spark.sql(f"ALTER TABLE {quote(table_name)} DROP IF EXISTS PARTITION ({COMMIT} = {_text(commit)})")
        spark.catalog.refreshTable(table_name)
    else:
        overwrite_partitions(rows, table_name)


def _text(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def finish(spark: SparkSession, commits_table: str, commit: str, tables) -> None:
    """Say that all tables of a commit are written."""
    rows = spark.range(1).select(F.explode(F.array(*[F.lit(t) for t in tables])).alias("table_name"))
    write_commit(rows, commits_table, commit)


def committed(spark: SparkSession, table_name: str, commits_table: str) -> DataFrame:
    """Rows of finished commits of one table, ``commit_id`` included."""
    done = spark.table(commits_table).where(F.col("table_name") == table_name).select(COMMIT).distinct()
    return spark.table(table_name).join(F.broadcast(done), COMMIT, "left_semi")  # one row a run of the job


def run_commit(spark: SparkSession, commits_table: str, commit: str, outputs: dict[str, DataFrame]) -> None:
    """Write every table of a run, then finish its commit."""
    for name, rows in outputs.items():
        write_commit(rows, name, commit)
    finish(spark, commits_table, commit, outputs)
