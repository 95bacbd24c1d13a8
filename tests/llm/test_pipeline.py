"""The pipeline's stages, each against its own input."""

import re

import corpus_pipeline
from tests.llm.conftest import words
from tests.llm.test_jaccard import expected as jaccard_groups
from tests.llm.test_mixing import targets
from tidemark.llm.common import pin


def test_stages(spark, docs, sf_small):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "exact dedup", "n-gram Jaccard join", "mixing", "packing"]
    now = docs
    for name, stage in corpus_pipeline.STAGES:
        before = [r.asDict() for r in now.collect()]
        now = pin(stage(spark, now, sf_small), "test-stage")
        after = [r.asDict() for r in now.collect()]
        if name != "packing":
            assert now.columns == docs.columns
        if name == "toxicity":
            assert {r["doc_id"] for r in after} <= {r["doc_id"] for r in before} and len(after) > 0.8 * len(before)
        elif name == "exact dedup":
            norm = lambda r: re.sub(r"[\x20\x09-\x0D]", "", r["text"] or "")
            best = {}
            for r in before:
                best.setdefault(norm(r), []).append((-len(r["text"] or ""), r["doc_id"]))
            assert {r["doc_id"] for r in after} == {min(v)[1] for v in best.values()}
        elif name == "n-gram Jaccard join":
            groups = jaccard_groups([(r["doc_id"], r["text"]) for r in before])
            assert {r["doc_id"] for r in after} == {i for i, _, c in groups if i == c}
        elif name == "mixing":
            size, got = {}, {}
            for rows, into in ((before, size), (after, got)):
                for r in rows:
                    into[r["source"]] = into.get(r["source"], 0) + len(words(r["text"]))
            want = targets(size)
            assert all(abs(got.get(s, 0) - want[s]) <= 1 for s in size)
        else:
            assert {r["doc_id"] for r in after} == {r["doc_id"] for r in before}
    assert sorted(map(str, corpus_pipeline.run(spark, sf_small).drop("sequence_id", "offset").groupBy("doc_id").count().collect())) \
        == sorted(map(str, now.groupBy("doc_id").count().collect()))
