"""Mixing sources to target weights with a multivariate-hypergeometric splitting tree.

1. Sizes (words) are summed per source; targets share the total by weight, capped at ``max_repeat`` times the
   source's size, the excess reshared by weight (water filling).
2. A source's stream is its documents in a seeded permutation, a new one for each repeat. The first
   ``round(target)`` words of the stream are taken, cut into blocks of ``block_words``: the source's exact block
   quota. Stream positions come from prefix sums over hash buckets, so no source is one task.
3. The quotas of all sources are split among the output shards by a binary tree: each node hands its left
   half a multivariate-hypergeometric draw of its blocks (exact inverse-transform draws, source by source) and
   the rest to the right. The leaves hold each shard's exact quota per source.
4. A keyed permutation (swap-or-not rounds) deals each source's blocks to the shards by these quotas, so every
   block is in one shard, and a seeded hash orders the blocks inside a shard.

Everything is DataFrame expressions. The tree works on one row per node; it grows with sources and shards, not
with the data.

Defined cases: a null text has size 0 and takes nothing; a null source is a source of its own, ordered last;
sources of size 0 have target 0; repeated rows are separate documents; an empty table gives an empty result;
other columns pass through.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import SPACE_CLASS, WORD_CLASS, col, free_names, pin, small_enough, text_or_empty

WEIGHTS = (5, 2, 1)        # fixed values: repeat over the sources in code-point order
BUCKETS = 1024             # hash buckets per source and repeat for the prefix sums
ROUNDS = 24                # swap-or-not rounds of the block permutation
MAX_BROADCAST_SOURCES = 10_000
MAX_BLOCKS = 1 << 20       # blocks grow beyond the least size when there would be more of them than this
SPREADS = 10               # standard deviations on both sides that a hypergeometric draw covers


def word_count(text: Column) -> Column:
    return F.regexp_count(text_or_empty(text), F.lit(WORD_CLASS + "+")).cast("long")


def source_targets(sizes: DataFrame, max_repeat: int = 3, weights=WEIGHTS) -> DataFrame:
    """From (source, source_size): rank, weight, and target. One row per source; the unpartitioned windows
    see these rows only."""
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    ranked = sizes.withColumn("rank", F.row_number().over(by_name) - 1)
    w = F.get(F.array(*[F.lit(float(x)) for x in weights]), F.col("rank") % len(weights))
    ranked = ranked.withColumn("weight", w).withColumn("cap", F.col("source_size") * float(max_repeat))
    # capped sources are those with the least cap per weight: water level from prefix sums in that order
    order = Window.orderBy(F.col("cap") / F.col("weight"), "rank")
    every = Window.partitionBy(F.lit(1))
    ranked = (ranked.withColumn("total", F.sum("source_size").over(every).cast("double"))
              .withColumn("caps", F.coalesce(F.sum("cap").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)))
              .withColumn("rest", F.sum("weight").over(order.rowsBetween(Window.currentRow, Window.unboundedFollowing)))
              .withColumn("level", (F.col("total") - F.col("caps")) / F.col("rest"))
              .withColumn("bound", F.col("level") * F.col("weight") >= F.col("cap")))
    # the level of the first source that isn't bound holds for all after it
    ranked = ranked.withColumn("water", F.min(F.when(~F.col("bound"), F.struct(F.col("cap") / F.col("weight"), "rank", "level"))).over(every))
    target = F.when(F.col("bound"), F.col("cap")).otherwise(F.least(F.col("cap"), F.col("water.level") * F.col("weight")))
    return ranked.select("source", "source_size", "rank", "weight", target.alias("target"))


def _uniform(*parts: Column) -> Column:
    """A number in (0, 1) that depends on the parts alone."""
    return (F.shiftrightunsigned(F.xxhash64(*parts), 11).cast("double") + 0.5) / float(1 << 53)


def _let(value: Column, body) -> Column:
    """``body`` of a value that is computed once (an element of a one-element array)."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def hypergeometric(total: Column, good: Column, draws: Column, u: Column) -> Column:
    """Number of good blocks among ``draws`` from ``total`` of which ``good`` are: inverse transform of ``u``
    over the support around the mode, by ratios of neighbouring probabilities."""
    d = lambda c: c.cast("double")
    steps = lambda a, b: F.when(a <= b, F.sequence(a, b)).otherwise(F.array().cast("array<long>"))

    def ends(v):
        lo, hi = F.greatest(F.lit(0).cast("long"), v["m"] + v["g"] - v["n"]), F.least(v["m"], v["g"])
        mode = F.least(hi, F.greatest(lo, F.floor(d(v["m"] + 1) * d(v["g"] + 1) / d(v["n"] + 2))))
        sd = F.sqrt(d(v["m"]) * d(v["g"]) * d(v["n"] - v["g"]) * d(v["n"] - v["m"])
                    / (d(F.greatest(v["n"], F.lit(1))) ** 2 * d(F.greatest(v["n"] - 1, F.lit(1)))))
        return F.struct(v["n"].alias("n"), v["g"].alias("g"), v["m"].alias("m"), v["u"].alias("u"), lo.alias("lo"), hi.alias("hi"),
                        mode.alias("mode"), F.ceil(sd * SPREADS + 10).alias("reach"))

    def sums(v):
        first, last = F.greatest(v["lo"], v["mode"] - v["reach"]), F.least(v["hi"], v["mode"] + v["reach"])
        zero = F.struct(F.lit(1.0).alias("p"), F.lit(0.0).alias("s"))
        add = lambda a, q: F.struct((a["p"] * q).alias("p"), (a["s"] + a["p"] * q).alias("s"))
        # p(k) / p(mode), summed above the mode and, with the last ratio kept, below it
        above = F.aggregate(steps(v["mode"], last - 1), zero, lambda a, k: add(a, _ratio(v, k)))
        below = F.aggregate(F.reverse(steps(first, v["mode"] - 1)), zero, lambda a, k: add(a, 1.0 / _ratio(v, k)))
        return F.struct(v["n"].alias("n"), v["g"].alias("g"), v["m"].alias("m"), v["u"].alias("u"), first.alias("first"),
                        last.alias("last"), above.alias("above"), below.alias("below"))

    def walk(v):
        # from the least value upwards until the share u of the sum is reached
        goal = v["u"] * (v["above"]["s"] + v["below"]["s"] + 1.0)
        start = F.struct(v["below"]["p"].alias("p"), F.lit(0.0).alias("s"), F.lit(None).cast("long").alias("k"), goal.alias("goal"))

        def step(a, k):
            s = a["s"] + a["p"]
            return F.struct((a["p"] * F.when(k < v["last"], _ratio(v, k)).otherwise(F.lit(0.0))).alias("p"), s.alias("s"),
                            F.coalesce(a["k"], F.when(s >= a["goal"], k)).alias("k"), a["goal"].alias("goal"))

        return F.coalesce(F.aggregate(F.sequence(v["first"], v["last"]), start, step)["k"], v["last"])

    given = F.struct(total.alias("n"), good.alias("g"), draws.alias("m"), u.alias("u"))
    return _let(given, lambda g: _let(ends(g), lambda e: F.when(e["lo"] >= e["hi"], e["lo"]).otherwise(_let(sums(e), walk))))


def _ratio(v: Column, k: Column) -> Column:
    """p(k + 1) / p(k) of the hypergeometric distribution with n blocks, g good, m drawn."""
    d = lambda c: c.cast("double")
    return d(v["g"] - k) * d(v["m"] - k) / (d(k + 1) * d(v["n"] - v["g"] - v["m"] + k + 1))


def splitting_tree(quotas: DataFrame, n_shards: int, seed: int) -> DataFrame:
    """From (rank, quota): (rank, ends), the running sums of the source's blocks over the shards 0 to n - 1."""
    levels = math.ceil(math.log2(n_shards)) if n_shards > 1 else 0
    nodes = quotas.agg(F.array_sort(F.collect_list(F.struct("rank", "quota"))).alias("urn"))
    nodes = nodes.select(F.transform("urn", lambda x: x["quota"]).alias("urn"), F.transform("urn", lambda x: x["rank"]).alias("ranks"),
                         F.lit(0).alias("first"), F.lit(n_shards).alias("width"))
    total = lambda a: F.aggregate(a, F.lit(0).cast("long"), lambda s, x: s + x)
    nodes = nodes.withColumn("all", total(F.col("urn")))
    share = lambda i: F.floor(F.col("all") * i / n_shards)  # noqa: E731  blocks before shard i
    for level in range(levels):
        left_width = F.ceil(F.col("width") / 2).cast("int")
        nodes = nodes.withColumn("lw", left_width).withColumn("want", share(F.col("first") + F.col("lw")) - share(F.col("first")))

        luck = _uniform(F.lit(seed), F.lit(level), F.col("first"), F.lit(0))  # of the node; hashed again per source

        def draw(a, i):
            good = F.get(F.col("urn"), i)
            k = hypergeometric(a["n"], good, a["m"], _uniform(a["luck"], i))
            return _let(k, lambda x: F.struct((a["n"] - good).alias("n"), (a["m"] - x).alias("m"),
                                              F.concat(a["out"], F.array(x)).alias("out"), a["luck"].alias("luck")))

        begin = F.struct(total(F.col("urn")).alias("n"), F.col("want").alias("m"), F.array().cast("array<long>").alias("out"),
                         luck.alias("luck"))

        # one source at a time, from what the earlier ones left
        left = F.aggregate(F.sequence(F.lit(0), F.size("urn") - 1), begin, draw)["out"]
        nodes = nodes.withColumn("left", F.when(F.size("urn") > 0, left).otherwise(F.col("urn")))
        right = F.zip_with("urn", "left", lambda a, b: a - b)
        both = F.array(
            F.struct(F.col("left").alias("urn"), F.col("first").alias("first"), F.col("lw").alias("width")),
            F.struct(right.alias("urn"), (F.col("first") + F.col("lw")).alias("first"), (F.col("width") - F.col("lw")).alias("width")))
        nodes = nodes.select("ranks", "all", F.explode(F.filter(both, lambda x: x["width"] > 0)).alias("c")).select(
            "c.urn", "ranks", "c.first", "c.width", "all")
    leaves = nodes.select("first", F.posexplode("urn").alias("i", "blocks"), "ranks").select(
        F.get("ranks", F.col("i")).alias("rank"), F.col("first").alias("shard"), "blocks")
    lists = leaves.groupBy("rank").agg(F.array_sort(F.collect_list(F.struct("shard", "blocks"))).alias("l"))
    running = F.aggregate("l", F.struct(F.lit(0).cast("long").alias("s"), F.array().cast("array<long>").alias("ends")),
                          lambda a, x: F.struct((a["s"] + x["blocks"]).alias("s"), F.concat(a["ends"], F.array(a["s"] + x["blocks"])).alias("ends")))
    return lists.select("rank", running["ends"].alias("ends"))


def permuted(block: Column, quota: Column, rank: Column, seed: int) -> Column:
    """A seeded permutation of 0 to quota - 1 (swap-or-not: every round is its own inverse)."""
    def swap(x, r):
        key = F.pmod(F.xxhash64(F.lit(seed), rank, r), quota)
        partner = F.pmod(key - x, quota)
        return F.when(F.xxhash64(F.lit(seed + 1), rank, r, F.greatest(x, partner)) % 2 == 0, partner).otherwise(x)

    return F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), block, swap)


def mix_documents(df: DataFrame, source_col: str = "source", id_col: str = "doc_id", text_col: str = "text", *,
                  n_shards: int = 64, block_words: int = 4096, max_repeat: int = 3, weights=WEIGHTS, seed: int = 17,
                  keep_columns: bool = False) -> tuple[DataFrame, DataFrame]:
    """Returns (content, decisions), to be joined on ``unit``. ``content`` is ``df`` (without its columns unless
    ``keep_columns``) pinned with unit; ``decisions`` has per document: unit, id, size, source_size, target, taken
    (words), and pieces: an array of (repeat, start, words, shard, key, pos). ``start`` counts words of the document,
    ``key`` orders the blocks inside the shard and ``pos`` (words of the source's stream) the pieces inside the block; pieces of
    a block share shard and key."""
    unit, size, src, h = free_names(df, "unit", "size", "src", "hash")
    docs = df.withColumns({unit: F.monotonically_increasing_id(), size: word_count(col(df, text_col)),
                           src: col(df, source_col).cast("string")})
    docs = docs.withColumn(h, F.xxhash64(F.lit(seed), col(df, id_col).cast("string"), F.col(size)))
    if not keep_columns:
        docs = docs.select(col(docs, id_col), unit, size, src, h)
    content = pin(docs, "mix-docs")
    keys = content.select(F.col(unit).alias("unit"), col(content, id_col).alias("id"), F.col(size).alias("size"),
                          F.col(src).alias("source"), F.col(h).alias("h"),
                          F.pmod(F.shiftright(F.col(h), 20), F.lit(BUCKETS)).cast("int").alias("bucket"))

    # words per source and bucket: everything about sources derives from this small table
    cells = pin(keys.groupBy("source", "bucket").agg(F.sum("size").alias("words")), "mix-cells")
    sources = source_targets(cells.groupBy("source").agg(F.sum("words").alias("source_size")), max_repeat, weights)
    total = F.sum("source_size").over(Window.partitionBy(F.lit(1)))
    sources = sources.withColumn("take", F.least(F.round("target").cast("long"), F.col("source_size") * max_repeat))
    sources = sources.withColumn("block", F.greatest(F.lit(block_words).cast("long"), F.ceil(total / MAX_BLOCKS)))
    sources = pin(sources.withColumn("quota", F.ceil(F.col("take") / F.col("block"))), "mix-sources")
    plan = pin(sources.join(splitting_tree(sources.select("rank", "quota"), n_shards, seed), "rank"), "mix-plan")
    if small_enough(plan, MAX_BROADCAST_SOURCES):
        plan = F.broadcast(plan)

    # position of every document in its source's permutation: bucket start plus words before it in the bucket
    before = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = pin(cells.select("source", "bucket", F.coalesce(F.sum("words").over(before), F.lit(0)).alias("b0")), "mix-starts")
    inside = Window.partitionBy("source", "bucket").orderBy("h", "id", "size", "unit").rowsBetween(Window.unboundedPreceding, -1)
    keys = keys.withColumn("w0", F.coalesce(F.sum("size").over(inside), F.lit(0)))
    keys = keys.join(starts, keys["source"].eqNullSafe(starts["source"]) & (keys["bucket"] == starts["bucket"])).select(
        "unit", "id", keys["source"].alias("of"), "size", (F.col("b0") + F.col("w0")).alias("at"))
    keys = keys.join(plan, F.col("of").eqNullSafe(F.col("source"))).drop("of", "source")

    # the runs (repeat, first word, stream position, words) that the mix takes; a repeat reads the permutation in
    # a circle from a point of its own, so a document may lie across that point in two parts
    zero = F.lit(0).cast("long")
    around = F.greatest(F.col("source_size"), F.lit(1))

    def runs(r):
        left = F.col("take") - r * F.col("source_size")
        at = F.pmod(F.col("at") - F.pmod(F.xxhash64(F.lit(seed + 2), F.col("rank"), r), around), around)
        n = F.least(F.col("size"), F.col("source_size") - at)
        parts = F.array(F.struct(at.alias("at"), zero.alias("from"), n.alias("n")),
                        F.struct(zero.alias("at"), n.alias("from"), (F.col("size") - n).alias("n")))
        return F.transform(parts, lambda x: F.struct(
            r.alias("repeat"), x["from"].alias("from"), (r * F.col("source_size") + x["at"]).alias("pos"),
            F.greatest(zero, F.least(x["n"], left - x["at"])).alias("n")))

    def cut(x):
        b = F.col("block")
        return F.transform(F.sequence(F.floor(x["pos"] / b), F.floor((x["pos"] + x["n"] - 1) / b)), lambda k: F.struct(
            x["repeat"].cast("int").alias("repeat"), (x["from"] + F.greatest(zero, k * b - x["pos"])).alias("start"),
            (F.least(x["pos"] + x["n"], (k + 1) * b) - F.greatest(x["pos"], k * b)).alias("words"), k.alias("block"),
            F.greatest(x["pos"], k * b).alias("pos"), permuted(k, F.col("quota"), F.col("rank"), seed).alias("turn")))

    def deal(p):
        return F.struct(p["repeat"].alias("repeat"), p["start"].alias("start"), p["words"].alias("words"),
                        F.aggregate("ends", F.lit(0), lambda s, e: s + (e <= p["turn"]).cast("int")).alias("shard"),
                        F.xxhash64(F.lit(seed + 3), F.col("rank"), p["block"]).alias("key"),
                        p["pos"].alias("pos"))

    every = F.flatten(F.transform(F.sequence(zero, F.lit(max_repeat - 1).cast("long")), runs))
    keys = keys.withColumn("cuts", F.flatten(F.transform(F.filter(every, lambda x: x["n"] > 0), cut)))
    decisions = keys.select("unit", "id", "size", "source_size", "target",
                            F.aggregate("cuts", zero, lambda s, x: s + x["words"]).alias("taken"),
                            F.transform("cuts", deal).alias("pieces"))
    return content, decisions


def draw_documents(df: DataFrame, source_col: str = "source", id_col: str = "doc_id", text_col: str = "text",
                   length_col: str | None = "n_chars", *, n_shards: int = 64, **options) -> DataFrame:
    """The mixed rows, with the columns of ``df``: a row per piece. Partition k holds shard k, its blocks in the order
    of their keys, the pieces of a block in stream order. A document inside one block is a row with its own text; one
    that lies across blocks is a row for each, their texts cut before a word with all white space kept."""
    unit, size, piece = free_names(df, "unit", "size", "piece")
    content, decisions = mix_documents(df, source_col, id_col, text_col, keep_columns=True, n_shards=n_shards, **options)
    taken = decisions.filter("taken > 0").select(F.col("unit").alias(unit), F.col("size").alias(size), F.col("pieces").alias(piece))
    out = content.select(*[col(content, c) for c in df.columns], unit).join(taken, unit)
    text = col(out, text_col)
    # a word with the white space after it; white space before the first word is an element of its own
    cells = F.split(text, f"(?<={SPACE_CLASS})(?={WORD_CLASS})")
    lead = F.when(text.rlike("^" + SPACE_CLASS), 1).otherwise(0)

    def part(v, p):
        first = p["start"] == 0
        return F.array_join(F.slice(v["cells"], F.when(first, 1).otherwise(p["start"] + v["lead"] + 1).cast("int"),
                                    (p["words"] + F.when(first, v["lead"]).otherwise(0)).cast("int")), "")

    whole = lambda p: p["words"] == F.col(size)
    row = lambda p, t: F.struct(p["shard"].alias("shard"), p["key"].alias("key"), p["pos"].alias("pos"), whole(p).alias("whole"), t.alias("text"))
    cut = _let(F.struct(cells.alias("cells"), lead.alias("lead")), lambda v: F.transform(
        piece, lambda p: row(p, F.when(whole(p), text).otherwise(part(v, p)))))
    uncut = F.transform(piece, lambda p: row(p, text))
    rows = F.when(F.forall(piece, whole), uncut).otherwise(cut)
    out = out.withColumn(piece, F.explode(rows)).repartitionById(n_shards, F.col(f"{piece}.shard"))
    out = out.sortWithinPartitions(f"{piece}.key", f"{piece}.pos", unit)
    picks = {c: col(out, c) for c in df.columns}
    picks[text_col] = F.col(f"{piece}.text")
    if length_col in picks:
        kind = df.schema[length_col].dataType
        picks[length_col] = F.when(F.col(f"{piece}.whole"), picks[length_col]).otherwise(F.char_length(picks[text_col]).cast(kind))
    return out.select(*[v.alias(k) for k, v in picks.items()])
