"""Chat formatting of reply trees.

Messages name their parents. Self-joins of the messages with their ancestors, each doubling the distance (so their
number is the logarithm of the depth), give every message its depth, and the score sum and the formatted length of its
path from the root.
Branches (leaves) are ranked by mean score; self-joins from the chosen leaves upwards, again doubling, enumerate the
messages of their root-to-leaf paths, and each path is formatted as one conversation.

A formatted conversation is a sequence of blocks of whole turns. A turn's place in it follows from the length of its path, so
a conversation of any length is formatted by many tasks, each holding one block of about ``BLOCK`` code points (or one
longer turn). The loss mask is the spans of the assistant's texts, as places in the conversation.

Template: ``<s>`` before the first turn; then for each turn by role
    system      ``<<SYS>>`` newline text newline ``<</SYS>>`` newline newline
    user        ``[INST] `` text `` [/INST]``
    assistant   space text `` </s>``
    other       ``<<ROLE>>`` role ``<<TEXT>>`` text ``<</ROLE>>``
Inside texts and roles a backslash is doubled, and a control string gets a backslash after its first character, so no
control string occurs there; the reader removes one backslash of each run's pairs and every single one.

Defined cases: null texts and roles count as empty; a null tree is a tree of its own; a message whose parent is null
or not in its tree is a root (so is one without an id, which can have no replies); rows that repeat an id of their tree
stand for one message (the least role, text, score, parent); messages that reply to each other in a circle have no root and
lie on no path; null and NaN scores count as 0; branches of equal score go by leaf id; an empty table gives an empty result; extra columns are ignored.
``from_turns`` keeps every row: rows of one conversation are ordered by turn (nulls first), then role, then text.
"""

from __future__ import annotations

import hashlib
import re

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.plans.ordered import global_rank

from .common import col, pin, pin_at, text_or_empty, unpin

# The control strings of the template.
CONTROL = ("<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "<<ROLE>>", "<<TEXT>>", "<</ROLE>>")
BEGIN = "<s>"
SYSTEM = ("<<SYS>>\n", "\n<</SYS>>\n\n")
USER = ("[INST] ", " [/INST]")
ASSISTANT = (" ", " </s>")
OTHER = ("<<ROLE>>", "<<TEXT>>", "<</ROLE>>")

BLOCK = 1 << 20


def escape(c: Column) -> Column:
    heads = "|".join(f"{re.escape(s[0])}(?={re.escape(s[1:])})" for s in CONTROL)
    return F.regexp_replace(F.regexp_replace(c, r"\\", r"\\\\"), f"({heads})", r"$1\\")


def opening(role: Column) -> Column:
    """What stands before a turn's text."""
    return (F.when(role == "system", SYSTEM[0]).when(role == "user", USER[0]).when(role == "assistant", ASSISTANT[0])
            .otherwise(F.concat(F.lit(OTHER[0]), escape(role), F.lit(OTHER[1]))))


def closing(role: Column) -> Column:
    return (F.when(role == "system", SYSTEM[1]).when(role == "user", USER[1]).when(role == "assistant", ASSISTANT[1])
            .otherwise(OTHER[2]))


def from_turns(df: DataFrame, tree_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
               text_col: str = "text") -> DataFrame:
    """A table of turns as reply trees without branches: (tree, id, parent, role, text, score)."""
    rows = df.select(col(df, tree_col).alias("tree"), col(df, turn_col).alias("turn"),
                     text_or_empty(col(df, role_col)).alias("role"), text_or_empty(col(df, text_col)).alias("text"))
    ranked = global_rank(rows, ["turn", "role", "text"], group_cols="tree", rank_col="id")
    return ranked.select("tree", "id", F.when(F.col("id") > 1, F.col("id") - 1).alias("parent"), "role", "text",
                         F.lit(None).cast("double").alias("score"))


def messages(df: DataFrame, unique: bool = False) -> DataFrame:
    """One row per message of (tree, id, parent, role, text, score): keys that join (also null trees), the turn as
    formatted, and its length. ``unique`` promises that no tree repeats an id and no id is null."""
    score = F.coalesce(F.nanvl(F.col("score").cast("double"), F.lit(0.0)), F.lit(0.0))
    row = F.struct(text_or_empty(F.col("role")).alias("role"), text_or_empty(F.col("text")).alias("text"), score.alias("score"),
                   F.col("parent"))
    key = lambda c: F.concat(F.lit("+"), c.cast("string"))
    if unique:
        both = df.select("tree", "id", row.alias("m"), key(F.col("id")).alias("node"))
    else:
        named = df.where(F.col("id").isNotNull()).groupBy("tree", "id").agg(F.min_by(row, row).alias("m"))
        lone = df.where(F.col("id").isNull()).select(
            "tree", "id", row.withField("parent", F.lit(None).cast(df.schema["parent"].dataType)).alias("m"))
        row_id = F.concat(F.lit("-"), F.monotonically_increasing_id().cast("string"))  # pinned before it is used
        both = named.withColumn("node", key(F.col("id"))).unionByName(lone.withColumn("node", row_id))
    tree = F.coalesce(key(F.col("tree")), F.lit(""))
    text, role = F.col("m.text"), F.col("m.role")
    return both.select(tree.alias("t"), "node", F.when(F.col("m.parent").isNotNull(), key(F.col("m.parent"))).alias("parent"),
                       "tree", "id", role.alias("role"), F.col("m.score").alias("score"), opening(role).alias("before"),
                       escape(text).alias("body"), closing(role).alias("after"))


def format_trees(df: DataFrame, branches: int | None = None, unique: bool = False) -> DataFrame:
    """Blocks of formatted conversations from reply trees (tree, id, parent, role, text, score).

    One conversation for each leaf, or for the ``branches`` leaves of a tree with the best mean score. Columns:
    tree, leaf (id of the path's last message), rank, score, block (from 0), start (place of its first code point),
    text, mask (spans of the assistant's texts, start and end in the conversation). ``unique``: see :func:`messages`.
    """
    spark = df.sparkSession
    turns = pin(messages(df, unique), "chat-turns")
    keys = ["t", "node"]
    length = (F.char_length("before") + F.char_length("body") + F.char_length("after")).cast("long")
    known = turns.select("t", F.col("node").alias("up"))
    light = turns.select("t", "node", F.col("parent").alias("up"), "score", length.alias("chars"))
    state = light.join(known.withColumn("there", F.lit(True)), ["t", "up"], "left").select(
        "t", "node", F.when(F.col("there"), F.col("up")).alias("up"), "score", "chars", F.lit(1).cast("long").alias("depth"))

    # every round each message adds what its ancestor knows, and takes that one's ancestor
    steps, rows = [], None
    while True:
        state, path = pin_at(state, "chat-up")
        open_ = state.where(F.col("up").isNotNull())
        count = state.agg(F.count(F.lit(1)).alias("n"), F.count("up").alias("open"), F.max("depth").alias("depth")).first()
        rows = count.n if rows is None else rows
        if not count.open or count.depth > rows:  # a path longer than the table goes round in a circle
            break
        steps.append((open_.select("t", "node", "up"), path))
        up = state.select("t", F.col("node").alias("up"), F.col("up").alias("next"), F.col("score").alias("s"),
                          F.col("chars").alias("c"), F.col("depth").alias("d"))
        state = open_.join(up, ["t", "up"], "inner").select(
            "t", "node", F.col("next").alias("up"), (F.col("score") + F.col("s")).alias("score"),
            (F.col("chars") + F.col("c")).alias("chars"), (F.col("depth") + F.col("d")).alias("depth")).unionByName(
            state.where(F.col("up").isNull()))
    rooted = state.where(F.col("up").isNull()).drop("up")

    replied = light.where(F.col("up").isNotNull()).select("t", F.col("up").alias("node")).distinct()
    leaves = rooted.join(replied, keys, "left_anti").withColumn("score", F.col("score") / F.col("depth"))
    named = leaves.join(turns.select(*keys, "id"), keys, "inner").withColumn("worst", -F.col("score"))
    ranked = global_rank(named.select("t", "node", "depth", "score", "worst", "id"), ["worst", "id", "node"], group_cols="t",
                         rank_col="rank")
    if branches is not None:
        ranked = ranked.where(F.col("rank") <= branches)
    chosen = pin(ranked.select("t", F.col("node").alias("leaf"), "depth", "rank", "score", F.col("id").alias("leaf_id")), "chat-leaves")

    # members of the chosen paths: those at distance d are known, their ancestors at 2^k lie at d + 2^k
    members = chosen.select("t", "leaf", F.col("leaf").alias("node"))
    passed = []
    for ups, _ in steps:
        members, path = pin_at(members, "chat-paths")
        passed.append(path)
        members = members.unionByName(members.join(ups, keys, "inner").select("t", "leaf", F.col("up").alias("node")))

    # a turn's text starts where its path so far ends, less its own length
    placed = members.join(turns.join(rooted.select(*keys, F.col("chars").alias("upto")), keys, "inner"), keys, "inner") \
        .withColumn("start", F.lit(len(BEGIN)) + F.col("upto") - length)
    opened = F.col("start") + F.char_length("before")
    turn = F.struct("start", F.concat("before", "body", "after").alias("text"),
                    F.when(F.col("role") == "assistant", F.struct(
                        opened.cast("long").alias("start"), (opened + F.char_length("body")).cast("long").alias("end"))).alias("span"))
    grouped = placed.groupBy("t", "leaf", F.floor(F.col("start") / BLOCK).alias("block")).agg(
        F.first("tree").alias("tree"), F.array_sort(F.collect_list(turn)).alias("turns"))
    first = F.col("block") == 0
    blocks = grouped.join(chosen.drop("depth"), ["t", "leaf"], "inner").select(
        "tree", F.col("leaf_id").alias("leaf"), "t", F.col("leaf").alias("node"), "rank", "score", "block",
        F.when(first, F.lit(0)).otherwise(F.col("turns")[0]["start"]).cast("long").alias("start"),
        F.concat(F.when(first, F.lit(BEGIN)).otherwise(F.lit("")), F.array_join(F.transform("turns", lambda x: x["text"]), "")).alias("text"),
        F.filter(F.transform("turns", lambda x: x["span"]), lambda s: s.isNotNull()).alias("mask"))
    out = pin(blocks, "chat")
    for path in [p for _, p in steps] + passed:
        unpin(spark, path)
    return out


UNESCAPE = r"\\(\\?)"


def parse_block(text: str, at: int = 0):
    """(role, text, start, end) of every turn in a block of a formatted conversation; start and end of its body as written."""
    plain = lambda s: re.sub(UNESCAPE, r"\1", s) if "\\" in s else s
    if text.startswith(BEGIN, at):
        at += len(BEGIN)
    while at < len(text):
        for role, (before, after) in (("system", SYSTEM), ("user", USER), ("assistant", ASSISTANT), (None, OTHER[1:])):
            head = before if role else OTHER[0]
            if text.startswith(head, at):
                break
        else:
            raise ValueError(f"no turn begins at {at}")
        start = at + len(head)
        if role is None:
            mark = text.index(OTHER[1], start)
            role, start, after = plain(text[start:mark]), mark + len(OTHER[1]), OTHER[2]
        # the mark ends in the first control string behind the text
        end = text.index(after.strip(), start) - (len(after) - len(after.lstrip()))
        yield role, plain(text[start:end]), start, end
        at = end + len(after)


def read_back(blocks: DataFrame) -> DataFrame:
    """One row per conversation, parsed back from its blocks: tree, leaf, ``n_turns``, ``turns_sha256`` (role, newline, text,
    newline of each turn), ``loss_chars`` and ``loss_sha256`` (unescaped text under the mask), ``formatted_chars``.

    The blocks of a conversation come in order to one task, which holds one of them at a time.
    """
    src = blocks.select("t", "node", "block", "tree", "leaf", "start", "text", "mask")
    src = src.repartition("t", "node").sortWithinPartitions("t", "node", "block").select(
        "t", "node", "tree", "leaf", "start", "text",
        F.transform("mask", lambda s: s["start"]).alias("begins"), F.transform("mask", lambda s: s["end"]).alias("ends"))
    tree, leaf = (src.schema[c].dataType.simpleString() for c in ("tree", "leaf"))
    schema = (f"tree {tree}, leaf {leaf}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, "
              "formatted_chars long")

    def work(batches):
        key, held, done = None, None, []

        def close():
            names = ["tree", "leaf", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
            fields = [pa.concat_arrays([d[i] for d in done]) if i < 2 else pa.array([d[i] for d in done], k)
                      for i, k in enumerate([None, None, pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()])]
            done.clear()
            return pa.RecordBatch.from_arrays(fields, names)

        def finish():
            ids, n, turns, chars, loss, length = held
            done.append((*ids, n, turns.hexdigest(), chars, loss.hexdigest(), length))

        for b in batches:
            for i in range(b.num_rows):
                now = (b.column(0)[i].as_py(), b.column(1)[i].as_py())
                if now != key:
                    if held:
                        finish()
                        if len(done) >= 10_000:
                            yield close()
                    key, held = now, [(b.column(2).slice(i, 1), b.column(3).slice(i, 1)), 0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                start, text = b.column(4)[i].as_py(), b.column(5)[i].as_py()
                for role, body, _, _ in parse_block(text):
                    held[1] += 1
                    held[2].update(f"{role}\n{body}\n".encode())
                for lo, hi in zip(b.column(6)[i].as_py(), b.column(7)[i].as_py()):
                    masked = re.sub(UNESCAPE, r"\1", text[lo - start:hi - start])
                    held[3] += len(masked)
                    held[4].update(masked.encode())
                held[5] += len(text)
        if held:
            finish()
        if done:
            yield close()

    return src.mapInArrow(work, schema)
