import zlib

import pytest

from tidemark.llm import sharding


def check(df, n):
    rows = sharding.shard_records(df, n).collect()
    assert len(rows) == df.count()
    shards = {}
    for r in rows:
        shards.setdefault(r.shard, []).append(r)
    total, largest = sum(r["size"] for r in rows), max((r["size"] for r in rows), default=0)
    for s, members in shards.items():
        assert 0 <= s < n
        assert sorted(r.slot for r in members) == list(range(len(members)))
        assert abs(sum(r["size"] for r in members) - total / n) <= largest + 1
    return rows


def test_documents(docs, texts):
    rows = check(docs, 24)
    for r in rows:
        raw = (texts[r.doc_id] or "").encode()
        assert r["size"] == len(raw) + 8 and r.text_crc32 == zlib.crc32(raw)
    assert sorted(map(tuple, rows)) == sorted(map(tuple, sharding.shard_records(docs, 24).collect()))


def test_edge_cases(edge, empty):
    check(edge, 4)
    assert sharding.shard_records(empty, 4).collect() == []


def test_hot_text_is_divided_and_overfull_ranges_are_subdivided(spark, monkeypatch):
    monkeypatch.setattr(sharding, "ROWS_PER_RANGE", 50)
    monkeypatch.setattr(sharding, "SAMPLES_PER_RANGE", 2)  # a poor sample: ranges come out overfull
    df = spark.range(3000).selectExpr("id as doc_id", "if(id % 3 = 0, 'hot text', concat('text ', id)) as text")
    check(df, 6)


@pytest.mark.parametrize("n", [1, 2, 7])
def test_numbers_of_shards(docs, n):
    check(docs, n)
