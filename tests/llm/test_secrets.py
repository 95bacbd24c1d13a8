import hashlib
import re

from tidemark.llm.secrets import Scanner, link_credentials, span_digest


def brute(text):
    text, out = text or "", []
    for m in re.finditer(r"""(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text, re.I | re.A):
        if len(m.group(1)) >= 12:
            out.append((m.start(), 0, m.end(), "assign"))
    out += [(m.start(), 1, m.end(), "access") for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m.group()) >= 18]
    out += [(m.start(), 2, m.end(), "hex") for m in re.finditer("[0-9a-f]+", text) if len(m.group()) >= 16]
    return sorted(out)


def test_base_spans_of_all_documents(spark, docs, texts, edge):
    for df, of in ((docs, texts), (edge.dropDuplicates(["doc_id"]), None)):
        of = of or {r.doc_id: r.text for r in df.collect()}
        got = span_digest(link_credentials(df)).collect()
        assert len(got) == df.count()
        for r in got:
            want = brute(of[r.doc_id])
            joined = ",".join(f"{k}:{s}:{e}" for s, _, e, k in want)
            assert r.base_sha256 == hashlib.sha256(joined.encode()).hexdigest()
            assert (r.n_assign, r.n_access, r.n_hex) == tuple(sum(k == x for *_, k in want) for x in ("assign", "access", "hex"))


def kinds(text, reach=60):
    from tidemark.llm.secrets import KINDS

    return [KINDS[k] for _, k, _ in Scanner(reach).spans(text)]


def test_weak_parts_need_their_complement():
    secret = "aB3" * 8
    assert kinds(f"user=bob123 {secret}") == ["weak_access", "weak_secret"]
    assert kinds("user=bob123 and nothing else") == []
    assert kinds(secret) == []
    assert kinds(f"https://x.example/a {secret}") == ["weak_secret"]
    assert kinds(f"https://x.example/a user=bob123 {secret}") == ["endpoint", "weak_access", "weak_secret"]
    assert kinds(f"user=bob123{' ' * 80}{secret}") == []          # out of reach
    assert kinds(f"user=bob123\n\n{secret}") == []                # another block
    assert kinds("user=bob123 password=abcdefghijklmno") == ["weak_access", "assign"]
    assert kinds("short password=abc1234 host=db.example:99 login=root") == ["weak_secret", "endpoint", "weak_access"]


def test_case_folding_is_ascii_only():
    assert kinds("PassWord = 'abcdefghijkl'") == ["assign"]
    assert kinds("paſſword = abcdefghijkl") == [] and kinds("toKen=abcdefghijkl") == []


def test_empty_table(empty):
    assert span_digest(link_credentials(empty)).collect() == []
