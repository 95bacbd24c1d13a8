import math

from pyspark.sql import functions as F

from tests.llm.conftest import words
from tidemark.llm import mixing


def targets(sizes, max_repeat=3, weights=(5, 2, 1)):
    """Resharing round by round, until no source is above its cap."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    w = {s: weights[k % len(weights)] for k, s in enumerate(names)}
    total, capped = sum(sizes.values()), {}
    while True:
        left = [s for s in names if s not in capped]
        rest = total - sum(capped.values())
        t = {s: rest * w[s] / sum(w[x] for x in left) for s in left} if left else {}
        over = [s for s in left if t[s] >= max_repeat * sizes[s]]
        if not over:
            return capped | t
        capped |= {s: max_repeat * sizes[s] for s in over}


def check(df):
    source = {}
    size = {}
    for r in df.collect():
        n = len(words(r.text))
        size[r.source] = size.get(r.source, 0) + n
        source.setdefault(r.doc_id, []).append((n, r.source))
    _, dec = mixing.mix_documents(df, n_shards=8, block_words=64)
    rows = dec.collect()
    assert len(rows) == df.count()
    want = targets(size)
    for r in rows:
        n, s = next(x for x in source[r.id] if x[0] == r["size"])
        assert r.taken <= 3 * r["size"] and r.taken == sum(p.words for p in r.pieces)
        assert r.source_size in size.values()
        assert all(0 <= p.shard < 8 and 0 <= p.start and p.start + p.words <= r["size"] for p in r.pieces)
    total = sum(round(t) for t in want.values())
    assert abs(sum(r.taken for r in rows) - total) <= len(size)
    assert {round(r.target, 6) for r in rows} <= {round(t, 6) for t in want.values()}
    return rows


def test_targets_and_quotas(docs):
    rows = check(docs)
    assert sorted(map(str, rows)) == sorted(map(str, mixing.mix_documents(docs, n_shards=8, block_words=64)[1].collect()))
    per = {}
    for r in rows:
        for p in r.pieces:
            per[p.shard] = per.get(p.shard, 0) + p.words
    assert max(per.values()) - min(per.values()) <= 64 * (len({r.target for r in rows}) + 20)


def test_each_source_comes_near_its_target(docs):
    _, dec = mixing.mix_documents(docs)
    got = dec.join(docs.withColumnRenamed("doc_id", "id"), "id").groupBy("source").agg(
        F.sum("taken").alias("taken"), F.max("target").alias("target")).collect()
    assert all(abs(r.taken - r.target) <= 1 for r in got)


def test_edge_cases(edge, empty):
    check(edge)
    assert mixing.mix_documents(empty)[1].collect() == []
    assert mixing.draw_documents(empty).collect() == []


def test_drawn_texts(edge):
    out = mixing.draw_documents(edge, n_shards=4, block_words=64)
    assert out.columns == edge.columns
    _, dec = mixing.mix_documents(edge, n_shards=4, block_words=64)
    assert sum(len(words(r.text)) for r in out.collect()) == dec.agg(F.sum("taken")).first()[0]


def test_capped_source(spark):
    df = spark.createDataFrame([(i, "w " * (5 if i < 3 else 200), "a" if i < 3 else "b") for i in range(10)], "doc_id long, text string, source string")
    rows = check(df)
    assert {r.taken for r in rows if r["size"] == 5} == {15}


def test_hypergeometric_draws(spark):
    n, good, m = 40, 15, 22
    df = spark.range(4000).select(mixing.hypergeometric(
        F.lit(n).cast("long"), F.lit(good).cast("long"), F.lit(m).cast("long"), mixing._uniform("id")).alias("k"))
    count = {r.k: r["count"] for r in df.groupBy("k").count().collect()}
    for k in range(max(0, m + good - n), min(m, good) + 1):
        p = math.comb(good, k) * math.comb(n - good, m - k) / math.comb(n, m)
        assert abs(count.get(k, 0) / 4000 - p) < 5 * math.sqrt(p * (1 - p) / 4000) + 1e-3
    assert set(count) <= set(range(max(0, m + good - n), min(m, good) + 1))


def test_tree_keeps_quotas_and_shard_sizes(spark):
    quotas = {0: 100, 1: 7, 2: 0, 3: 501}
    q = spark.createDataFrame(list(quotas.items()), "rank int, quota long")
    rows = {r["rank"]: r.ends for r in mixing.splitting_tree(q, 5, 3).collect()}
    assert {k: v[-1] for k, v in rows.items()} == quotas
    sizes = [sum(v[j] - (v[j - 1] if j else 0) for v in rows.values()) for j in range(5)]
    assert max(sizes) - min(sizes) <= 1 and all(a <= b for v in rows.values() for a, b in zip(v, v[1:]))


def test_permutation_is_one(spark):
    for q in (1, 2, 17, 64):
        got = spark.range(q).select(mixing.permuted(F.col("id"), F.lit(q).cast("long"), F.lit(3), 9).alias("x")).collect()
        assert sorted(r.x for r in got) == list(range(q))


def quotas(rows, n_shards):
    """Words of every shard and source, from the pieces."""
    out = {}
    for r in rows:
        for p in r.pieces:
            out[p.shard, r.source] = out.get((p.shard, r.source), 0) + p.words
    return out


def test_blocks_make_the_drawn_rows(spark, docs):
    from tidemark.llm.queries import op5_mixing

    registered = op5_mixing(spark, "/root/testdata/sf0.001").collect()
    assert all(r.taken == sum(p.words for p in r.pieces) for r in registered)
    assert len({p.shard for r in registered for p in r.pieces}) > 1

    some = docs.select("doc_id", "source", "text", "n_chars")
    _, dec = mixing.mix_documents(some, n_shards=5, block_words=256)
    rows = dec.join(docs.select(F.col("doc_id").alias("id"), "source", "text"), "id").collect()
    out = mixing.draw_documents(some, n_shards=5, block_words=256)
    assert out.rdd.getNumPartitions() == 5
    got = out.withColumn("shard", F.spark_partition_id()).collect()
    have = {}
    for g in got:
        have[g.shard, g.source] = have.get((g.shard, g.source), 0) + len(words(g.text))
    assert have == quotas(rows, 5)
    for shard in range(5):  # blocks by key, pieces in stream order
        want = [(p.key, p.pos, r.id, p.words) for r in rows for p in r.pieces if p.shard == shard]
        assert [(g.doc_id, len(words(g.text))) for g in got if g.shard == shard] == [w[2:] for w in sorted(want)]


def test_pieces_hold_all_words_in_order(spark):
    """Also of documents across the start of the circle, whose last repeat takes both ends."""
    texts = {i: " \n" * (i % 2) + "".join(f"d{i}w{k}" + (" ", "\n\n", "\t ")[k % 3] for k in range(90 + i)) for i in range(4)}
    df = spark.createDataFrame([(i, t, "a" if i < 2 else "b") for i, t in texts.items()], "doc_id long, text string, source string")
    _, dec = mixing.mix_documents(df, n_shards=3, block_words=16)
    out = mixing.draw_documents(df, n_shards=3, block_words=16).collect()
    want = sorted((r.id, words(texts[r.id])[p.start:p.start + p.words]) for r in dec.collect() for p in r.pieces)
    assert sorted((g.doc_id, words(g.text)) for g in out) == want
    assert all(g.text in texts[g.doc_id] for g in out)
