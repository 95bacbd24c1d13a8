import hashlib
import re

from pyspark.sql import functions as F

from tidemark.llm.exact_dedup import copies_report, drop_copies


def expected(rows):
    groups = {}
    for i, t in rows:
        groups.setdefault(re.sub(r"[\x20\x09-\x0D]", "", t or ""), []).append((-len(t or ""), i is None, i or 0, i))
    out = []
    for norm, members in groups.items():
        keep = min(members, key=lambda m: m[:3])[3]
        out += [(i, keep, len(members), hashlib.sha256(norm.encode()).hexdigest()) for *_, i in members]
    return sorted(out, key=str)


def result(df, **kw):
    got = copies_report(df, **kw).collect()
    return sorted(((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got), key=str), sum(r.kept for r in got)


def test_documents_and_edge_cases(docs, edge):
    for df in (docs, edge):
        rows = [(r.doc_id, r.text) for r in df.collect()]
        got, kept = result(df)
        assert got == expected(rows)
        assert kept == len({x[3] for x in got})


def test_full_bytes_separate_texts_of_one_digest(docs, edge):
    for df in (docs, edge):
        assert result(df, digest=lambda c: F.substring(c, 1, 1)) == result(df)


def test_kept_rows_keep_their_columns(edge, empty):
    out = drop_copies(edge)
    assert out.columns == edge.columns
    assert out.count() == len({x[3] for x in expected([(r.doc_id, r.text) for r in edge.collect()])})
    assert drop_copies(empty).collect() == [] and copies_report(empty).collect() == []
