"""Exact deduplication with keyed streaming state.

The rows are written once to the shared folder (the content table) with the digest of their normalised
text. A Structured Streaming query reads the content table in micro-batches and keeps, per digest, in a
RocksDB state store without expiry: the number of rows, and the best row so far with its stable id and
its locator in the content table. Equal rows meet as partial aggregates before the shuffle, so a text
that holds a third of all rows is a few state updates. On hits (a digest seen more than once) the whole
normalised texts are fetched by locator and compared; rows whose bytes differ from their keeper's are
regrouped by their full text. The fetch of a large group is salted.

Defined cases: null texts are empty; equal means equal after deleting white space; the row with the most
code points in its original text stays, then the smallest id (null ids last), then the first row; repeated
rows are copies of each other; an empty table gives an empty result; other columns pass through.
"""

from __future__ import annotations

import contextlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import SPACE_CLASS, col, free_names, pin, pin_at, shared_path, text_or_empty, unpin

STATE_CONF = {
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    # many partitions mean many small stores: no disk space reserved ahead in each
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
    # an executor holds the stores of its running tasks only, not those of all its partitions until later stages
    "spark.sql.streaming.stateStore.unloadOnCommit": "true",
    "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB": "128",  # of an executor (500 by default)
}
ROWS_PER_SALT = 1000  # members of a group that compare their bytes with one copy of the keeper's text


def normalised(text: Column) -> Column:
    return F.regexp_replace(text_or_empty(text), SPACE_CLASS + "+", "")


@contextlib.contextmanager
def _conf(spark: SparkSession, values: dict):
    old = {k: spark.conf.get(k, None) for k in values}
    for k, v in values.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def keyed_state(content_path: str, schema, spark: SparkSession, files_per_batch: int) -> DataFrame:
    """Runs the stream over the content table to its end; returns digest, n, best (pinned)."""
    where = shared_path(spark, "dedup-state")
    with _conf(spark, STATE_CONF):
        state = (spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(content_path)
                 .groupBy("digest")
                 .agg(F.count(F.lit(1)).alias("n"),
                      F.min(F.struct((-F.col("chars")).alias("less"), F.col("id").isNull().alias("no_id"), "id", "row"))
                      .alias("best")))
        query = (state.writeStream.outputMode("update").format("noop")
                 .option("checkpointLocation", where).trigger(availableNow=True).start())
        query.awaitTermination()
        stored = spark.read.format("statestore").load(where)
        count, best = [f.name for f in stored.schema["value"].dataType.fields]
        out = pin(stored.select(F.col("key.digest").alias("digest"), F.col(f"value.{count}").alias("n"),
                                F.col(f"value.{best}").alias("best")), "dedup-groups")
    unpin(spark, where)
    return out


def mark_copies(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", digest=None,
                files_per_batch: int = 1000) -> tuple[DataFrame, DataFrame, str]:
    """Returns (content, marks, row column): ``content`` is ``df`` pinned with a row locator, ``marks`` has
    per row: row, id, keep_id, keep_row, n (rows of the group), sha (of the normalised text).

    ``digest`` maps the hexadecimal sha256 column to the state key (tests pass a short one)."""
    spark = df.sparkSession
    row, sha = free_names(df, "row", "sha")
    content, path = pin_at(df.withColumns({row: F.monotonically_increasing_id(),
                                           sha: F.sha2(normalised(col(df, text_col)), 256)}), "dedup-content")
    key = (digest or (lambda c: c))(F.col(sha))
    light = content.select(F.col(row).alias("row"), col(content, id_col).alias("id"),
                           F.char_length(text_or_empty(col(content, text_col))).alias("chars"),
                           F.col(sha).alias("sha"), key.alias("digest"))
    light, light_path = pin_at(light, "dedup-keys")
    groups = keyed_state(light_path, light.schema, spark, files_per_batch)
    marks = light.join(groups, "digest").select("row", "id", "digest", "sha", "n", F.col("best.id").alias("keep_id"),
                                                F.col("best.row").alias("keep_row"))
    wrong = _collisions(content, marks, groups, row, sha, text_col, key)
    if wrong is not None:
        marks = (marks.join(wrong, "row", "left")
                 .select("row", "id", "digest", "sha", F.coalesce("x_n", "n").alias("n"),
                         F.when(F.col("x_n").isNull(), F.col("keep_id")).otherwise(F.col("x_best.id")).alias("keep_id"),
                         F.coalesce("x_best.row", "keep_row").alias("keep_row")))
    return content, marks, row


def _collisions(content, marks, groups, row, sha, text_col, key) -> DataFrame | None:
    """Compares the whole normalised texts of every group of two or more with the keeper's; for digests that
    join different texts, returns each row's true group (row, x_n, x_best), else None."""
    repeated = groups.filter("n > 1").select("digest", "n", F.col("best.row").alias("keep_row"))
    texts = content.select(F.col(row).alias("row"), key.alias("digest"), text_or_empty(col(content, text_col)).alias("text"))
    hits = pin(texts.join(repeated, "digest"), "dedup-hits")
    salts = F.ceil(F.col("n") / F.lit(ROWS_PER_SALT))
    keepers = (hits.filter("row = keep_row")
               .select("keep_row", F.col("text").alias("keep_text"), F.explode(F.sequence(F.lit(0).cast("long"), salts - 1)).alias("salt")))
    members = hits.filter("row <> keep_row").withColumn("salt", F.pmod(F.xxhash64("row"), salts))
    differ = (members.join(keepers, ["keep_row", "salt"])
              .filter(normalised(F.col("text")) != normalised(F.col("keep_text"))).select("digest").distinct())
    if differ.isEmpty():
        return None
    bad = hits.join(differ, "digest", "left_semi").select("row", "digest", normalised(F.col("text")).alias("norm"))
    bad = bad.join(content.select(F.col(row).alias("row"), F.char_length(text_or_empty(col(content, text_col))).alias("chars")), "row")
    bad = bad.join(marks.select("row", "id"), "row")
    best = F.min(F.struct((-F.col("chars")).alias("less"), F.col("id").isNull().alias("no_id"), "id", "row"))
    true = bad.groupBy("digest", "norm").agg(F.count(F.lit(1)).alias("x_n"), best.alias("x_best"))
    return pin(bad.join(true, ["digest", "norm"]).select("row", "x_n", "x_best"), "dedup-collisions")


def copies_report(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", digest=None) -> DataFrame:
    """One row per input row: id, keep_id, group_size, kept, text_sha256."""
    _, marks, _ = mark_copies(df.select(col(df, id_col), col(df, text_col)), id_col, text_col, digest)
    return marks.select(F.col("id").alias(id_col), "keep_id", F.col("n").alias("group_size"),
                        (F.col("row") == F.col("keep_row")).alias("kept"), F.col("sha").alias("text_sha256"))


def drop_copies(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``df`` without the rows that are copies of a row that stays; all columns unchanged."""
    content, marks, row = mark_copies(df, id_col, text_col)
    dropped = marks.filter("row <> keep_row").select(F.col("row").alias(row))
    return content.join(dropped, row, "left_anti").select(*[col(content, c) for c in df.columns])
