import hashlib
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tidemark.llm import chat

MESSAGE = "tree long, id long, parent long, role string, text string, score double, t string, node int, leaf long"


def sha(s):
    return hashlib.sha256(s.encode()).hexdigest()


def escaped(s):
    controls = "|".join(re.escape(c) for c in chat.CONTROL)
    return re.sub(f"({controls})", lambda m: m[0][0] + "\\" + m[0][1:], s.replace("\\", "\\\\"))


def formatted(turns):
    """The template, written a second time."""
    out = "<s>"
    for role, text in turns:
        text = escaped(text)
        out += {"system": f"<<SYS>>\n{text}\n<</SYS>>\n\n", "user": f"[INST] {text} [/INST]", "assistant": f" {text} </s>"}.get(
            role, f"<<ROLE>>{escaped(role)}<<TEXT>>{text}<</ROLE>>")
    return out


def digest(turns):
    loss = "".join(t for r, t in turns if r == "assistant")
    return (len(turns), sha("".join(f"{r}\n{t}\n" for r, t in turns)), len(loss), sha(loss), len(formatted(turns)))


def paths(rows):
    """Brute force: {(tree, leaf): (score, turns)} of messages (tree, id, parent, role, text, score)."""
    by_tree, out = {}, {}
    for tree, i, parent, role, text, score in rows:
        by_tree.setdefault(tree, {})[i] = (parent, role or "", text or "", score or 0.0)
    for tree, known in by_tree.items():
        parents = {p for p, *_ in known.values()}
        for leaf in known:
            if leaf in parents:
                continue
            line, at = [], leaf
            while at in known and len(line) <= len(known):
                line.append(known[at])
                at = known[at][0]
            if len(line) <= len(known):
                out[tree, leaf] = (sum(m[3] for m in line) / len(line), [(m[1], m[2]) for m in reversed(line)])
    return out


def check(spark, rows, branches=None):
    df = spark.createDataFrame([(*r, "x", 1, 2) for r in rows], MESSAGE).repartition(3)
    blocks = chat.format_trees(df, branches)
    want = paths(rows)
    best = {}
    for (tree, leaf), (score, _) in want.items():
        best.setdefault(tree, []).append((-score, leaf))
    chosen = {(t, leaf): rank for t, all_ in best.items() for rank, (_, leaf) in enumerate(sorted(all_)[:branches], 1)}
    texts = {}
    for b in sorted(blocks.collect(), key=lambda b: b.block):
        key = (b.tree, b.leaf)
        assert b["rank"] == chosen[key] and b.start == len(texts.get(key, ""))
        texts[key] = texts.get(key, "") + b.text
    assert texts == {k: formatted(want[k][1]) for k in chosen}
    got = {(r[0], r[1]): tuple(r)[2:] for r in chat.read_back(blocks).collect()}
    assert got == {k: digest(want[k][1]) for k in chosen}


TREE = [(1, 1, None, "user", "hello", 0.1), (1, 2, 1, "assistant", "hi </s>", 0.9), (1, 3, 1, "assistant", "", None),
        (1, 4, 2, "user", "[INST] \\ [/INST]\\", 0.5), (1, 5, 4, "assistant", "<s\\><s><", 0.2), (1, 6, 2, "tool<<TEXT>>", None, 0.9),
        (1, 7, 99, "system", "orphan", 0.3), (None, 1, None, "user", "no tree", 1.0), (None, 2, 1, None, "漢字😀", 1.0),
        (2, 1, None, "assistant", "alone", float("nan"))]


def test_paths_ranks_and_template(spark):
    rows = [r if r[5] == r[5] else (*r[:5], None) for r in TREE]
    check(spark, rows)
    check(spark, rows, branches=1)
    nan = chat.format_trees(spark.createDataFrame([(*TREE[-1], "x", 1, 2)], MESSAGE)).collect()
    assert [(r.tree, r.score) for r in nan] == [(2, 0.0)]


def test_long_chains_and_stars_in_small_blocks(spark, monkeypatch):
    monkeypatch.setattr(chat, "BLOCK", 300)
    chain = [(1, i, i - 1 if i else None, "user" if i % 2 else "assistant", f"turn {i} </s>", 0.0) for i in range(70)]
    star = [(2, i, 0 if i else None, "assistant", f"answer {i}", i / 7) for i in range(40)]
    check(spark, chain + star)
    check(spark, chain + star, branches=3)


def test_circles_repeated_rows_and_rows_without_an_id(spark):
    rows = [(1, 1, 2, "user", "a", 0.0), (1, 2, 1, "user", "b", 0.0), (1, 3, 2, "user", "hangs on the circle", 0.0),
            (2, 1, None, "user", "x", 0.0), (2, 1, None, "user", "x", 0.0), (2, None, 1, "assistant", "lone", 0.0),
            (2, None, 1, "assistant", "lone", 0.0)]
    blocks = chat.format_trees(spark.createDataFrame([(*r, "x", 1, 2) for r in rows], MESSAGE))
    assert sorted((r.tree, str(r.leaf), r.text) for r in blocks.collect()) == [
        (2, "1", "<s>[INST] x [/INST]"), (2, "None", "<s> lone </s>"), (2, "None", "<s> lone </s>")]


def test_turns_in_order_and_empty_table(spark):
    schema = "conv_id long, turn long, role string, text string, t string, id int"
    rows = [(1, 2, "assistant", "c"), (1, None, "system", None), (1, 2, "assistant", "b"), (1, 2, "assistant", "b"),
            (None, 0, "user", "</s>[INST] ok [/INST]"), (None, 5, None, ""), (3, 0, "assistant", "w " * 100_000)]
    df = spark.createDataFrame([(*r, "x", 7) for r in rows], schema)
    got = {r.tree: tuple(r)[2:] for r in chat.read_back(chat.format_trees(chat.from_turns(df))).collect()}
    assert got == {1: digest([("system", ""), ("assistant", "b"), ("assistant", "b"), ("assistant", "c")]),
                   None: digest([("user", "</s>[INST] ok [/INST]"), ("", "")]), 3: digest([("assistant", "w " * 100_000)])}
    empty = chat.format_trees(chat.from_turns(spark.createDataFrame([], schema)))
    assert empty.collect() == [] and chat.read_back(empty).collect() == []


pieces = st.sampled_from([*chat.CONTROL, "\\", "<", "[", "/", ">", "a", " ", "\n", "é", "s>", "INST]"])


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(st.one_of(st.sampled_from(["system", "user", "assistant"]), st.lists(pieces, max_size=4).map("".join)),
                          st.lists(pieces, max_size=12).map("".join)), max_size=5))
def test_parser_inverts_the_template(turns):
    text = formatted(turns)
    assert [(r, t) for r, t, _, _ in chat.parse_block(text)] == turns
    for _, body in turns:  # no control string is left inside a text
        assert not any(c in escaped(body) for c in chat.CONTROL)


def test_query(spark, sf_small):
    from tidemark.llm import queries

    got = {r.conv_id: tuple(r)[1:] for r in queries.op11_chat(spark, sf_small).collect()}
    turns = {-7: [("user", "</s>[INST] ok [/INST]"), ("assistant", "</s>[INST] ok [/INST]")]}
    for r in spark.read.parquet(f"{sf_small}/conversations.parquet").orderBy("conv_id", "turn").collect():
        turns.setdefault(r.conv_id, []).append((r.role, r.text))
    assert got == {k: digest(v) for k, v in turns.items()}


def test_parser_refuses_what_no_template_made():
    with pytest.raises(ValueError):
        list(chat.parse_block("<s>no turn"))
