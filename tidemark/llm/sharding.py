"""Sharding by sampled splitters.

Records are ordered by (hash of the text, hash of the id): equal texts lie together, and a text that holds
a third of all bytes is still divided between its ids. A size-weighted sample of these keys (a record enters
once for every sampling step that its size covers) gives quantile boundaries, and records are
range-partitioned by them. Exact sizes per range follow; ranges over twice their share are subdivided by a
finer sample of their own. Prefix sums over the ranges and a window inside each give every record its exact
position in bytes and rows, and thereby its shard and slot. Everything is DataFrame operations; the work
tables hold keys and sizes, never texts.

The law is ``bytes``: a record belongs to the shard in whose byte interval its middle lies, so shards differ
by at most the largest record on either side.

Defined cases: a null text has size 8; null ids are one hash value like any other; rows that agree in text
and id are neighbours in some order and get different slots; an empty table gives an empty result; extra
columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import col, pin

ROWS_PER_RANGE = 200_000   # so many records a range, as long as there are
MAX_RANGES = 16_384        # no more ranges than this (they grow instead): bounds the table of boundaries
SAMPLES_PER_RANGE = 64
OVERFULL = 2.0             # times the even share


def key_struct(h: Column, g: Column) -> Column:
    return F.struct(h.alias("h"), g.alias("g"))


def bisect(bounds: Column, key: Column, steps: int = 24) -> Column:
    """How many entries of the ascending array ``bounds`` are at most ``key``; ``2 ** steps`` bounds its size."""
    start = F.struct(F.lit(0).alias("lo"), F.size(bounds).alias("hi"))

    def halve(s, _):
        mid = F.floor((s["lo"] + s["hi"]) / 2).cast("int")
        low = F.get(bounds, mid) <= key
        open_ = s["lo"] < s["hi"]
        return F.struct(F.when(open_ & low, mid + 1).otherwise(s["lo"]).alias("lo"),
                        F.when(open_ & ~low, mid).otherwise(s["hi"]).alias("hi"))

    return F.aggregate(F.sequence(F.lit(1), F.lit(steps)), start, halve, lambda s: s["lo"])


def sample_points(size: Column, key_hash: Column, step: Column) -> Column:
    """How often a record is drawn: multiples of ``step`` in an interval of its size whose start depends on
    its hash alone (so the expected number is size / step, and reruns agree)."""
    start = F.pmod(key_hash, F.greatest(step, F.lit(1)).cast("long"))
    return F.floor((start + size) / F.greatest(step, F.lit(1))).cast("int")


def quantile_bounds(points: Column, n_ranges: Column) -> Column:
    """Boundaries that cut the sorted array ``points`` into ``n_ranges`` parts of equal number."""
    ordered = F.array_sort(points)
    picks = F.transform(F.sequence(F.lit(1), F.greatest(n_ranges - 1, F.lit(1))),
                        lambda i: F.get(ordered, F.floor(i * F.size(ordered) / n_ranges).cast("int")))
    return F.when((n_ranges > 1) & (F.size(ordered) > 0), F.array_distinct(F.filter(picks, lambda x: x.isNotNull()))) \
            .otherwise(F.slice(ordered, 1, 0))


def shard_records(df: DataFrame, n_shards: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id, size, text_crc32, shard (0 to ``n_shards`` - 1), slot (from 0, gapless)."""
    text = col(df, text_col).cast("string")
    # codes of both: fixed rows for the sample, the counts and the result
    rec = pin(df.select(
        col(df, id_col).alias(id_col),
        (F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + 8).alias("size"),
        F.crc32(F.coalesce(text, F.lit("")).cast("binary")).alias("text_crc32"),
        F.xxhash64(F.coalesce(text, F.lit(""))).alias("h"),
        F.xxhash64(col(df, id_col).cast("string"), F.lit(1)).alias("g")), "shard-keys")
    total = rec.agg(F.sum("size").alias("b"), F.count(F.lit(1)).alias("n")).first()
    if not total.n:
        return rec.select(id_col, "size", "text_crc32", F.lit(0).alias("shard"), F.lit(0).cast("long").alias("slot"))
    n_ranges = int(min(MAX_RANGES, max(4 * n_shards, total.n // ROWS_PER_RANGE)))
    step = max(1, total.b // (n_ranges * SAMPLES_PER_RANGE))

    drawn = rec.withColumn("times", sample_points(F.col("size"), F.xxhash64("g", "h"), F.lit(step))).filter("times > 0")
    # a record larger than a step enters as often as it is drawn; the sample has a bounded number of entries
    points = drawn.select(F.explode(F.array_repeat(key_struct(F.col("h"), F.col("g")), F.col("times"))).alias("k"))
    bounds = points.agg(quantile_bounds(F.collect_list("k"), F.lit(n_ranges)).alias("b"))
    ranged = (rec.withColumn("cuts", bounds.scalar())
              .withColumn("rng", bisect(F.col("cuts"), key_struct(F.col("h"), F.col("g")))).drop("cuts"))

    share_b, share_n = total.b / n_ranges, total.n / n_ranges
    full = ranged.groupBy("rng").agg(F.sum("size").alias("rb"), F.count(F.lit(1)).alias("rn"))
    full = full.filter((F.col("rb") > OVERFULL * share_b) | (F.col("rn") > OVERFULL * share_n)).select(
        "rng", F.ceil(F.greatest(F.col("rb") / share_b, F.col("rn") / share_n)).cast("int").alias("parts"), "rb", "rn")
    full = full.filter("rn > 1")
    # second round: inside an overfull range, records are drawn by number (a range overfull in bytes with few
    # records, and one with many small records, both get boundaries)
    again = ranged.join(full, "rng").withColumn(
        "take", F.pmod(F.xxhash64("h", "g", F.lit(2)), F.greatest(F.col("rn"), F.lit(1))) < F.col("parts") * SAMPLES_PER_RANGE)
    finer = again.filter("take").groupBy("rng").agg(
        quantile_bounds(F.collect_list(key_struct(F.col("h"), F.col("g"))), F.max("parts")).alias("cuts"))
    ranged = ranged.join(finer, "rng", "left").withColumn(
        "sub", F.when(F.col("cuts").isNull(), F.lit(0)).otherwise(bisect(F.col("cuts"), key_struct(F.col("h"), F.col("g"))))
    ).drop("cuts")

    ranged = pin(ranged, "shard-ranges")
    sums = ranged.groupBy("rng", "sub").agg(F.sum("size").alias("rb"))
    order = Window.orderBy("rng", "sub").rowsBetween(Window.unboundedPreceding, -1)
    before = sums.select("rng", "sub", F.coalesce(F.sum("rb").over(order), F.lit(0)).alias("b0"))
    inside = Window.partitionBy("rng", "sub").orderBy("h", "g", id_col, "size")
    placed = ranged.join(before, ["rng", "sub"]).withColumn(
        "end", F.col("b0") + F.sum("size").over(inside.rowsBetween(Window.unboundedPreceding, 0)))
    # whole numbers only: twice the middle times the shards, over twice the total
    placed = placed.withColumn("shard", F.least(F.lit(n_shards - 1), F.floor(
        ((2 * F.col("end") - F.col("size")) * n_shards).cast("decimal(38,0)") / F.lit(2 * total.b).cast("decimal(38,0)"))
        .cast("int")))
    placed = pin(placed.withColumn("rk", F.row_number().over(Window.partitionBy("rng", "sub", "shard").orderBy("end", "h", "g"))),
                 "shard-placed")
    parts = placed.groupBy("shard", "rng", "sub").agg(F.count(F.lit(1)).alias("rn"))
    earlier = Window.partitionBy("shard").orderBy("rng", "sub").rowsBetween(Window.unboundedPreceding, -1)
    offsets = parts.select("shard", "rng", "sub", F.coalesce(F.sum("rn").over(earlier), F.lit(0)).alias("n0"))
    return placed.join(offsets, ["shard", "rng", "sub"]).select(
        id_col, "size", "text_crc32", "shard", (F.col("n0") + F.col("rk") - 1).cast("long").alias("slot"))
