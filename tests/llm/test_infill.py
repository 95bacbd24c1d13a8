import hashlib
import re

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from tidemark.llm import infill

TOKEN = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")


def expected(doc_id, text, seed=42, rate=50, spm=80):
    """The rules on lists of tokens, without bytes or rotations."""
    text = text or ""
    h = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[i:i + 8], 16) for i in (0, 8, 16, 24))
    tokens = TOKEN.findall(text)
    n = len(tokens)
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    pre, mid, suf = "".join(tokens[:a]), "".join(tokens[a:b]), "".join(tokens[b:])
    if not text or any(s in text for s in ("<P>", "<S>", "<M>")) or h3 % 100 >= rate:
        return (doc_id, n, "plain", None, None, text)
    if h4 % 100 < spm:
        return (doc_id, n, "spm", len(pre), len(mid), f"<S>{suf}<P>{pre}<M>{mid}")
    return (doc_id, n, "psm", len(pre), len(mid), f"<P>{pre}<S>{suf}<M>{mid}")


def check(df, **rules):
    made = infill.infill_documents(df, **rules)
    rows = [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]
    want = sorted((expected(*r, **rules) for r in rows), key=str)
    assert sorted(map(tuple, made.collect()), key=str) == want
    back = infill.restore_documents(made).select("doc_id", "restored").collect()
    assert sorted(map(tuple, back), key=str) == sorted(((i, t or "") for i, t in rows), key=str)
    return want


def test_documents(docs):
    forms = {r[2] for r in check(docs)}
    assert forms == {"plain", "psm", "spm"}


def test_edge_cases(edge, empty, spark):
    for spm in (0, 100):
        check(edge, rate=100, spm=spm)
    check(empty)
    odd = [(i, t) for i in range(12) for t in ("a <P> b", "a<S>", "<M>", "<", "<P", " \t", "x", " x ", "é😀 <漢 \x85  b\x0b")]
    check(spark.createDataFrame(odd, "doc_id long, text string"), rate=100)


def test_query(spark, sf_small, texts):
    from tidemark.llm import queries

    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    got = sorted(map(tuple, queries.op12_infill(spark, sf_small).collect()))
    assert got == sorted((*expected(i, t)[:5], sha(expected(i, t)[5]), sha(t or "")) for i, t in texts.items())


@settings(max_examples=300, deadline=None)
@given(st.binary(max_size=60), st.data())
def test_rotation_and_its_inverse(raw, data):
    mid = data.draw(st.integers(0, len(raw)))
    buf = np.frombuffer(bytearray(raw), np.uint8)
    infill.rotate(buf, 0, mid, len(raw))
    assert bytes(buf) == raw[mid:] + raw[:mid]


def test_rotation_of_many_blocks():
    raw = np.random.default_rng(1).integers(0, 256, 5 * infill.SWAP + 17, np.uint8)
    for mid in (0, 1, infill.SWAP, 3 * infill.SWAP + 5, len(raw)):
        buf = raw.copy()
        infill.rotate(buf, 0, mid, len(raw))
        assert (buf == np.concatenate([raw[mid:], raw[:mid]])).all()
