import collections
import itertools
import math
import zlib

import numpy as np
import pyarrow as pa

from tests.llm.conftest import words
from tidemark.llm import hmm
from tidemark.llm.bytescan import batch_bytes, word_hashes, word_spans


def expected(rows):
    held = lambda i: i is not None and zlib.crc32(str(i).encode()) % 7 == 2
    count = collections.Counter()
    for i, t in rows:
        if not held(i):
            count.update(words(t) + [None])
    n, v = sum(count.values()), len(count)
    out = []
    for i, t in rows:
        tokens = words(t) + [None]
        out.append((i, held(i), len(tokens), sum(count[w] > 0 for w in tokens), n,
                    math.fsum(math.log10((count[w] + 1) / (n + v + 1)) for w in tokens)))
    return sorted(out, key=str)


def check(scored, rows):
    got = sorted(((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, r.base_score) for r in scored), key=str)
    want = expected(rows)
    assert [g[:5] for g in got] == [w[:5] for w in want]
    assert np.allclose([g[5] for g in got], [w[5] for w in want], rtol=1e-9, atol=1e-9)


def test_counts_and_base(docs, edge, empty, monkeypatch):
    for known in (hmm.KNOWN, 50):  # the second: most words are looked up in the count table
        monkeypatch.setattr(hmm, "KNOWN", known)
        monkeypatch.setattr(hmm, "FREQUENT", min(hmm.FREQUENT, known))
        scored = hmm.score_texts(docs).collect()
        check(scored, [(r.doc_id, r.text) for r in docs.collect()])
        assert sum(r.score for r in scored if r.held_out) > sum(r.base_score for r in scored if r.held_out)
    check(hmm.score_texts(edge).collect(), [(r.doc_id, r.text) for r in edge.collect()])
    assert hmm.score_texts(empty).collect() == []


def small_model(n_classes=5):
    rng = np.random.default_rng(3)
    return hmm.Params(rng.dirichlet(np.ones(hmm.STATES)), rng.dirichlet(np.ones(hmm.STATES), hmm.STATES),
                      rng.dirichlet(np.ones(n_classes), hmm.STATES).T)


def test_forward_is_the_sum_over_paths():
    p, text = small_model(), np.array([0, 3, 1, 4], np.uint16)
    total = 0.0
    for path in itertools.product(range(hmm.STATES), repeat=len(text)):
        q = p.start[path[0]] * p.emit[text[0], path[0]]
        for t in range(1, len(text)):
            q *= p.move[path[t - 1], path[t]] * p.emit[text[t], path[t]]
        total += q
    log, _, _ = hmm.forward(p, text, np.array([0]), np.array([4]), False)
    assert abs(log[0] - math.log10(total)) < 1e-9


def test_baum_welch_raises_the_likelihood_and_adds_up():
    rng = np.random.default_rng(1)
    sizes = np.array([9, 7, 7, 3, 1])
    text = rng.integers(0, 5, sizes.sum()).astype(np.uint16)
    begin = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    p, last = small_model(), -np.inf
    for _ in range(6):
        log, _, _ = hmm.forward(p, text, begin, sizes, False)
        assert log.sum() > last
        last = log.sum()
        e, parts = hmm.Expected(5), hmm.Expected(5)
        e.add(p, text, begin, sizes)
        for i in range(len(sizes)):  # counts of the texts one by one: what partitions would add
            parts.add(p, text, begin[i:i + 1], sizes[i:i + 1])
        assert np.allclose(e.emit, parts.emit) and np.allclose(e.move, parts.move) and np.allclose(e.start, parts.start)
        assert np.isclose(e.emit.sum(), sizes.sum()) and np.isclose(e.start.sum(), len(sizes))
        p = hmm.Params(e.start / e.start.sum(), e.move / e.move.sum(1, keepdims=True), e.emit / e.emit.sum(0))


def test_words_of_bytes():
    texts = ["", "Ab aB\x0b\tab ", "x" * 1000 + " " + "x" * 999 + "y", " é É é", "a"]
    data, offsets = batch_bytes(pa.array(texts))
    starts, ends, first = word_spans(data, offsets)
    h = word_hashes(data, starts, ends)
    flat = [w for t in texts for w in words(t)]
    assert np.diff(first).tolist() == [len(words(t)) for t in texts]
    assert [data[a:b].tobytes().decode().translate({c: c + 32 for c in range(65, 91)}) for a, b in zip(starts, ends)] == flat
    assert len(set(h.tolist())) == len(set(flat))
    assert all((h[i] == h[j]) == (flat[i] == flat[j]) for i in range(len(flat)) for j in range(len(flat)))


def test_all_documents_train_whatever_their_partitions(spark):
    """More documents than any start sample would hold; every pass reads all of them."""
    rng = np.random.default_rng(8)
    texts = [" ".join(rng.choice(["ab", "cd", "ef", "gh"], int(rng.integers(1, 6)))) for _ in range(1900)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    one, many = ({r.doc_id: r.score for r in hmm.score_texts(df.repartition(n)).collect()} for n in (1, 5))
    assert all(abs(one[i] - many[i]) < 1e-6 for i in one)


def test_a_very_long_text_in_pieces(monkeypatch):
    """Counts and likelihood of a text in pieces are those of the whole; so are those of scaling at other steps."""
    text = np.random.default_rng(2).integers(0, 5, 1000).astype(np.uint16)
    p, begin, size = small_model(), np.array([0]), np.array([1000])
    whole, log = hmm.Expected(5), hmm.forward(p, text, begin, size)[0]
    whole.add(p, text, begin, size)
    for tokens, rescale in ((16, 16), (17, 16), (333, 1), (1, 7), (999, 16)):
        monkeypatch.setattr(hmm, "GROUP_TOKENS", tokens)
        monkeypatch.setattr(hmm, "RESCALE", rescale)
        parts = hmm.Expected(5)
        parts.add(p, text, begin, size)
        assert np.allclose(whole.emit, parts.emit) and np.allclose(whole.move, parts.move) and np.allclose(whole.start, parts.start)
        assert np.allclose(log, hmm.forward(p, text, begin, size)[0])
