import collections

import numpy as np
import pytest

from tidemark.llm import repeats, suffix


def expected(rows, length):
    raw = [(i, (t or "").encode()) for i, t in rows]
    count = collections.Counter(b[k:k + length] for _, b in raw for k in range(len(b) - length + 1))
    out = []
    for i, b in raw:
        cover = np.zeros(len(b), bool)
        for k in range(len(b) - length + 1):
            if count[b[k:k + length]] > 1:
                cover[k:k + length] = True
        out.append((i, len(b), int(cover.sum()), len(repeats.runs_of(cover)[0]), np.frombuffer(b, np.uint8)[~cover].tobytes()))
    return sorted(out, key=str)


def got(df, length):
    return sorted(((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in repeats.remove_repeats(df, length=length).collect()), key=str)


@pytest.mark.parametrize("key_bytes,scan", [(repeats.KEY_BYTES, repeats.SCAN_BYTES), (0, 500), (3000, repeats.SCAN_BYTES)])
def test_against_brute_force(spark, edge, empty, monkeypatch, key_bytes, scan):
    monkeypatch.setattr(repeats, "KEY_BYTES", key_bytes)
    monkeypatch.setattr(repeats, "SCAN_BYTES", scan)
    monkeypatch.setattr(repeats, "SHARD_BYTES", 4000)
    rng = np.random.default_rng(4)
    passages = ["".join(rng.choice(list("abcdé \0"), 90)) for _ in range(6)]
    rows = []
    for i in range(60):
        parts = ["".join(rng.choice(list("abcdefgh "), int(rng.integers(0, 120))))]
        parts += [passages[int(rng.integers(0, 6))][int(rng.integers(0, 30)):] for _ in range(int(rng.integers(0, 3)))]
        rows.append((i, "".join(parts)))
    rows += [(100, "ab" * 300), (101, "z" * 700), (102, None), (103, ""), (104, "q" * 44), (None, passages[0]), (105, rows[0][1])]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert got(df, 45) == expected(rows, 45)
    assert got(empty, 45) == []


def test_edge_cases(edge):
    some = edge.filter("length(text) < 10000 or text is null")
    assert got(some, 400) == expected([(r.doc_id, r.text) for r in some.collect()], 400)
    long = [r for r in got(edge, 400) if r[1] > 10000]
    assert long[0][1:4] == (120001, 120001, 1)  # "w w w ...": every window occurs again two bytes on


def test_documents(docs):
    assert got(docs, 400) == expected([(r.doc_id, r.text) for r in docs.collect()], 400)


@pytest.mark.parametrize("few", [1024, 0])
def test_suffix_array(monkeypatch, few):
    monkeypatch.setattr(suffix, "FEW", few)
    rng = np.random.default_rng(few)
    for case in range(300):
        s = rng.integers(1, rng.integers(2, 5), int(rng.integers(1, 40)))
        s = np.append(np.tile(s, 3) if case % 3 == 0 else s, 0)
        sa = suffix.suffix_array(s, int(s.max()) + 1)
        assert sa.tolist() == sorted(range(len(s)), key=lambda i: s[i:].tolist())
        before, prefix = suffix.permuted_prefixes(s, sa)
        for a, b in zip(sa, sa[1:]):
            n = next(k for k in range(len(s)) if s[a + k] != s[b + k])
            assert before[b] == a and prefix[b] == n


def test_windows_of_hot_keys_are_united(spark, monkeypatch):
    monkeypatch.setattr(repeats, "KEY_BYTES", 0)  # every key is counted window by window
    rng = np.random.default_rng(6)
    letters = lambda n: "".join(rng.choice(list("abcdefgh"), n))
    passage = letters(200)
    rows = [(i, letters(60) + passage + letters(60)) for i in range(40)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    spans = repeats.repeated_spans(df.withColumnRenamed("doc_id", "row"), 45).collect()
    assert len(spans) == 40 and {len(r.spans) for r in spans} == {1}
    for sent in (repeats.MAX_SENT, 0):  # 0: lists are joined by a shuffle
        monkeypatch.setattr(repeats, "MAX_SENT", sent)
        assert got(df, 45) == expected(rows, 45)
