"""Scoring of requests in micro-batches of bytes."""

import json

import pytest
from pyspark.sql import types as T

from tidemark.operators import model
from tidemark.streaming import scoring

INSTANCE = T.StructType([T.StructField("id", T.LongType()), T.StructField("x", T.DoubleType())])


@pytest.mark.parametrize("batch_bytes, batches", [(scoring.BATCH_BYTES, 1), (1, 4)])
def test_micro_batches_follow_bytes(spark, tmp_path, batch_bytes, batches):
    fitted = model.train_classifier(spark.createDataFrame([(0, 0.0), (1, 1.0)] * 5, "y int, x double"), "y", ["x"], num_trees=2)
    (tmp_path / "in").mkdir()
    for i, name in enumerate("abca"):  # the last one comes again
        r = {"request_id": name, "sent_at": "2024-02-01T00:00:00Z", "instances": [{"id": ord(name), "x": 1.0}]}
        (tmp_path / "in" / f"{i}.txt").write_text(json.dumps(r) + "\n" + json.dumps(r)[:30] + "\n")
    sink, bad, ckpt = (str(tmp_path / n) for n in ("scores", "broken", "ckpt"))
    queries = scoring.start_scoring_once(spark, str(tmp_path / "in"), INSTANCE, fitted, "id", sink, bad, ckpt, batch_bytes=batch_bytes)
    for q in queries:
        q.awaitTermination()
        assert len([p for p in q.recentProgress if p.numInputRows]) == batches
    assert sorted(r.request_id for r in spark.read.parquet(sink).collect()) == ["a", "b", "c"]
    assert spark.read.parquet(bad).count() == 4
