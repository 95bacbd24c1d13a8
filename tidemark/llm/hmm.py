"""Language-model scoring with a hidden Markov model.

Every token belongs to a class: the ``frequent`` most frequent words and the end have one of their own, other words
share classes by their last two bytes. Latent states emit classes; a class emits its words by their smoothed
counts. So the probability of a text is

    sum over state paths of prod p(state | state before) p(class | state) * prod p(word | class)

and the scaled forward recursion computes it exactly. Baum-Welch expected counts of the states are computed in
every partition, aggregated by class, and re-estimate the model. Every pass reads all training rows; the first starts
from the classes' counts in the corpus.

Word counts cover all training tokens. Counts of the ``known`` most frequent words travel with the tasks (a bound
on what is broadcast); the rest of a document's words are joined with the count table, without the skew of
frequent words.

Defined cases: a null or empty text is the end token alone; null ids are training rows; without training rows
every word is unknown and the states are uniform; unknown words have count 0 and the probability of one word more;
repeated rows are learned and scored each; a very long text is gone through in pieces, with the same result; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bytescan import batch_bytes, blocks, word_hashes, word_spans
from .common import col, id_remainder, pin, text_or_empty

FREQUENT, KNOWN, SHARED = 8192, 65_536, 1024  # own classes; counts sent to tasks; shared classes
END_HASH = 1                                  # stands for the end token among the word hashes
SCAN_BYTES = 4 << 20
GROUP_TOKENS = 400_000                        # tokens whose variables are held at a time, 128 bytes each
RESCALE = 16                                  # steps between two scalings
STATES, PASSES = 8, 14
PRIOR = 5.0                                   # pseudo-counts, spread as the classes occur


def shared_class(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Class number 0 to SHARED - 1 by the last two bytes of a word, letters in lower case."""
    last, prior = data[ends - 1].astype(np.uint32), data[np.maximum(ends - 2, starts)].astype(np.uint32)
    lower = lambda b: b + 32 * ((b >= 65) & (b <= 90))
    return ((lower(last) * 263 + lower(prior)) * 40503 >> 3) % SHARED


@dataclass
class Counts:
    """What coding needs: the known words by hash, with counts and class, and totals of the classes."""
    hashes: np.ndarray      # sorted
    counts: np.ndarray
    own: np.ndarray         # class of a frequent word, 0 for others
    log_total: np.ndarray   # log10 of the denominator of a shared class
    tokens: int
    distinct: int
    end_count: int
    n_own: int


def count_words(src: DataFrame) -> DataFrame:
    """(h, shared, c) over the rows of src(row, id, held_out, text): occurrences of every word."""
    def count(batches):
        for b in batches:
            data, offsets = batch_bytes(b.column(0))
            for x, y in blocks(offsets, 4 * SCAN_BYTES):
                part = data[offsets[x]:offsets[y]]
                starts, ends, _ = word_spans(part, offsets[x:y + 1] - offsets[x])
                h = word_hashes(part, starts, ends)
                words, first, n = np.unique(h, return_index=True, return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(words.view(np.int64)), pa.array(shared_class(part, starts[first], ends[first]).astype(np.int32)), pa.array(n)],
                    ["h", "shared", "c"])

    found = src.select("text").mapInArrow(count, "h long, shared int, c long")
    return found.groupBy("h").agg(F.max("shared").alias("shared"), F.sum("c").alias("c"))


def collect_counts(words: DataFrame, n_docs: int) -> Counts:
    """The bounded summary of the count table (KNOWN words and SHARED classes)."""
    totals = words.agg(F.sum("c"), F.count(F.lit(1))).first()
    # the count that at most KNOWN words reach: from the numbers of words by count
    steps = words.groupBy("c").count().orderBy(F.desc("c")).limit(KNOWN).collect()
    least, held = 1, 0
    for s in steps:
        held += s["count"]
        if held > KNOWN:
            least = s.c + 1
            break
    known = words.filter(F.col("c") >= least).toArrow()
    h, c, shared = (known.column(x).to_numpy() for x in ("h", "c", "shared"))
    rank = np.lexsort((h, -c))[:FREQUENT]
    own = np.zeros(len(h), np.int64)
    own[rank] = np.arange(1, len(rank) + 1)
    all_c, all_n = np.zeros(SHARED), np.zeros(SHARED)
    for r in words.groupBy("shared").agg(F.sum("c").alias("c"), F.count(F.lit(1)).alias("n")).collect():
        all_c[r.shared], all_n[r.shared] = r.c, r.n
    np.subtract.at(all_c, shared[rank], c[rank])
    np.subtract.at(all_n, shared[rank], 1)
    order = np.argsort(h.view(np.uint64))
    return Counts(h.view(np.uint64)[order], c[order], own[order], np.log10(all_c + all_n + 1.0),
                  int(totals[0] or 0) + n_docs, int(totals[1]) + (n_docs > 0), n_docs, len(rank))


def code(counts: Counts, data: np.ndarray, offsets: np.ndarray):
    """Per text: class sequence, tokens, known tokens, and the local sums; and the words left to look up."""
    starts, ends, first = word_spans(data, offsets)
    h = word_hashes(data, starts, ends)
    at = np.minimum(np.searchsorted(counts.hashes, h), max(0, len(counts.hashes) - 1))
    local = counts.hashes[at] == h if len(counts.hashes) else np.zeros(len(h), bool)
    own = np.where(local, counts.own[at] if len(counts.own) else 0, 0)
    shared = shared_class(data, starts, ends)
    cls = np.where(own > 0, own, 1 + counts.n_own + shared).astype(np.uint16)
    log_c = np.where(local, np.log10((counts.counts[at] if len(counts.counts) else 0) + 1.0), 0.0)
    # summed text by text (a running total of the block would lose the small sums' digits), quotients before the sum
    empty = first[1:] == first[:-1]
    per = lambda v: np.where(empty, 0.0, np.add.reduceat(np.append(v, 0.0), first[:-1]))
    rare = np.where(own > 0, 0.0, log_c - counts.log_total[shared])
    return h, cls, ~local, first, per(log_c - log_all(counts)), per(rare), per(local.astype(float))


def log_all(counts: Counts) -> float:
    """log10 of what every smoothed count is divided by."""
    return float(np.log10(counts.tokens + counts.distinct + 1.0))


@dataclass
class Params:
    start: np.ndarray   # states
    move: np.ndarray    # states x states
    emit: np.ndarray    # classes x states


def random_params(n_classes: int, prior: np.ndarray, seed: int = 5) -> Params:
    rng = np.random.default_rng(seed)
    emit = prior[:, None] * (0.5 + rng.random((n_classes, STATES)))
    return Params(np.full(STATES, 1.0 / STATES), 0.4 * np.eye(STATES) + 0.6 / STATES, emit / emit.sum(0))


def groups(sizes: np.ndarray):
    """Row numbers by falling length, in groups of at most GROUP_TOKENS tokens (one text at least)."""
    order = np.argsort(-sizes, kind="stable")
    total = np.cumsum(sizes[order])
    a = 0
    while a < len(order):
        b = int(np.searchsorted(total, (total[a - 1] if a else 0) + GROUP_TOKENS, side="right"))
        b = max(a + 1, b)
        yield order[a:b]
        a = b


def step_offsets(size: np.ndarray) -> np.ndarray:
    """Where the tokens of step t begin, of texts ordered by falling length that lie step by step."""
    alive = np.searchsorted(-size, -np.arange(int(size[0])), side="left")  # texts with more than t tokens
    return np.concatenate([[0], np.cumsum(alive)])


def by_step(cls: np.ndarray, begin: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Classes of texts ordered by falling length, all first tokens, then all second ones, and so on."""
    offsets, before = step_offsets(size), np.concatenate([[0], np.cumsum(size)])
    step = np.arange(before[-1]) - np.repeat(before[:-1], size)
    out = np.empty(before[-1], cls.dtype)
    out[offsets[step] + np.repeat(np.arange(len(size)), size)] = cls[np.repeat(begin, size) + step]
    return out


class Lattice:
    """Forward and backward variables of a group of texts that lie step by step. Emissions are divided by their
    class's mean over the states, which cancels out of the expected counts and is added to the likelihoods;
    variables are scaled every RESCALE steps. The arrays are kept from group to group."""

    def __init__(self, p: Params):
        mean = p.emit.mean(1)
        self.p, self.ratio, self.log_mean = p, p.emit / mean[:, None], np.log10(mean)
        self.move_back = np.ascontiguousarray(p.move.T)
        self.ones = np.ones(STATES)
        self.a = self.e = np.empty((0, STATES))

    def forward(self, tokens: np.ndarray, size: np.ndarray, before: np.ndarray | None = None) -> np.ndarray:
        """log10 likelihoods, without the classes' means. ``before``: the variables of the step before (else the
        texts begin here). Variables of all steps stay in ``a``, emissions in ``e``."""
        n = len(tokens)
        if n > len(self.a):
            self.a, self.e = np.empty((n, STATES)), np.empty((n, STATES))
        a, e, move, ones = self.a, self.e, self.p.move, self.ones
        np.take(self.ratio, tokens, axis=0, out=e[:n], mode="clip")
        self.offsets, self.scales = step_offsets(size), {}
        log = np.zeros(len(size))
        x, last = 0, None
        for t, y in enumerate(self.offsets[1:].tolist()):
            now = a[x:y]
            if t:
                np.dot(last[:y - x], move, out=now)
            else:
                now[:] = self.p.start if before is None else before @ move
            now *= e[x:y]
            if t % RESCALE == RESCALE - 1:
                c = now @ ones
                now /= c[:, None]
                log[:y - x] += np.log10(c)
                self.scales[t] = c
            x, last = y, now
        self.ends = a[self.offsets[size - 1] + np.arange(len(size))]
        return log + np.log10(self.ends @ ones)

    def backward(self, size: np.ndarray, move_counts: np.ndarray, after: np.ndarray | None = None) -> np.ndarray:
        """After ``forward``: ``a`` becomes the states' probabilities, transitions are added to ``move_counts``
        (without the factor ``move``). ``after``: backward variables of the last step, up to a factor, if texts go on.
        Returns emissions times backward variables of the first step."""
        a, e, back, offsets = self.a, self.e, self.move_back, self.offsets.tolist()
        end = np.ones((len(size), STATES)) if after is None else after
        end = end / np.einsum("ij,ij->i", self.ends, end)[:, None]
        spare = np.empty((2, len(size), STATES))
        b, m = spare[0, :0], 0
        for t in range(len(offsets) - 2, -1, -1):
            x, y = offsets[t], offsets[t + 1]
            n, here = y - x, a[x:y]
            now = spare[t & 1, :n]
            if n > m:
                now[m:] = end[m:n]
            if m:
                onward = e[y:y + m]
                onward *= b
                if t + 1 in self.scales:
                    onward /= self.scales[t + 1][:, None]
                np.dot(onward, back, out=now[:m])
                move_counts += here[:m].T @ onward
            here *= now
            b, m = now, n
        return e[:m] * b / (self.scales[0][:, None] if 0 in self.scales else 1.0)


def pieces(tokens: np.ndarray, size: np.ndarray) -> list[np.ndarray]:
    """The group's tokens; those of one very long text in pieces of GROUP_TOKENS steps."""
    if len(size) > 1 or len(tokens) <= GROUP_TOKENS:
        return [tokens]
    return [tokens[i:i + GROUP_TOKENS] for i in range(0, len(tokens), GROUP_TOKENS)]


def group_likelihood(lattice: Lattice, tokens: np.ndarray, size: np.ndarray) -> np.ndarray:
    parts = pieces(tokens, size)
    if len(parts) == 1:
        return lattice.forward(tokens, size)
    log, before = np.zeros(1), None
    for part in parts:
        log += lattice.forward(part, np.array([len(part)]), before)
        before = lattice.ends / lattice.ends.sum()
    return log


def forward(p: Params | Lattice, cls: np.ndarray, begin: np.ndarray, size: np.ndarray, keep: bool = False):
    """Scaled forward recursion of texts ordered by falling length: log10 likelihoods, and with ``keep`` the scaled
    variables of the last group of steps and their offsets."""
    lattice = p if isinstance(p, Lattice) else Lattice(p)
    flat = np.concatenate([cls[x:x + n] for x, n in zip(begin, size)])
    mean = np.add.reduceat(lattice.log_mean[flat], np.concatenate([[0], np.cumsum(size)[:-1]]))
    log = group_likelihood(lattice, by_step(cls, begin, size), size) + mean
    return log, lattice.a if keep else None, lattice.offsets if keep else None


class Expected:
    """Baum-Welch counts, added up over texts."""

    def __init__(self, n_classes: int):
        self.start, self.move, self.emit = np.zeros(STATES), np.zeros((STATES, STATES)), np.zeros((n_classes, STATES))

    def add(self, p: Params | Lattice, cls: np.ndarray, begin: np.ndarray, size: np.ndarray) -> None:
        self.add_group(p if isinstance(p, Lattice) else Lattice(p), by_step(cls, begin, size), size)

    def add_group(self, lattice: Lattice, tokens: np.ndarray, size: np.ndarray) -> None:
        """Texts that lie step by step. The pieces of a very long text are gone through from its end, each from the
        forward variables kept before it."""
        parts = pieces(tokens, size)
        before: list = [None]
        for part in parts[:-1]:
            lattice.forward(part, np.array([len(part)]), before[-1])
            before.append(lattice.ends / lattice.ends.sum())
        after, moves = None, np.zeros((STATES, STATES))
        for part, first in zip(reversed(parts), reversed(before)):
            sizes = size if len(parts) == 1 else np.array([len(part)])
            lattice.forward(part, sizes, first)
            onward = lattice.backward(sizes, moves, after)
            g = np.ascontiguousarray(lattice.a[:len(part)].T)
            where = part.astype(np.int64)
            for k in range(STATES):
                self.emit[:, k] += np.bincount(where, weights=g[k], minlength=len(self.emit))
            if first is None:
                self.start += g[:, :lattice.offsets[1]].sum(1)
            else:
                moves += first.T @ onward
                after = onward @ lattice.move_back
        self.move += moves * lattice.p.move

    def params(self, prior: np.ndarray) -> Params:
        start, move = self.start + 1.0 / STATES, self.move + 1.0 / STATES
        emit = self.emit + PRIOR * prior[:, None]
        return Params(start / start.sum(), move / move.sum(1, keepdims=True), emit / emit.sum(0))


def sequences(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Classes of all texts behind one another, first token and number of tokens of each."""
    data, offsets = batch_bytes(column)
    return np.frombuffer(data.tobytes(), np.uint16), offsets[:-1] // 2, np.diff(offsets) // 2


def training_groups(coded: DataFrame) -> DataFrame:
    """(size, tokens): all training texts in groups that lie step by step, as every pass reads them."""
    def lay(batches):
        for b in batches:
            cls, begin, size = sequences(b.column(0))
            for rows in groups(size):
                yield pa.RecordBatch.from_arrays(
                    [pa.array([size[rows].astype(np.int64).tobytes()], pa.binary()), pa.array([by_step(cls, begin[rows], size[rows]).tobytes()], pa.binary())],
                    ["size", "tokens"])

    return coded.filter("not held_out").select("seq").mapInArrow(lay, "size binary, tokens binary")


def baum_welch(coded: DataFrame, n_classes: int, prior: np.ndarray) -> Params:
    """PASSES passes over all training documents."""
    train = pin(training_groups(coded), "lm-groups")
    p = random_params(n_classes, prior)
    names = [f"s{k}" for k in range(STATES)]
    schema = "i int, " + ", ".join(f"{x} double" for x in names)
    for _ in range(PASSES):
        def expect(batches, p=p):
            e, lattice = Expected(n_classes), Lattice(p)
            for b in batches:
                for size, tokens in zip(b.column(0), b.column(1)):
                    e.add_group(lattice, np.frombuffer(tokens.as_buffer(), np.uint16), np.frombuffer(size.as_buffer(), np.int64))
            rows = np.concatenate([e.emit, e.move, e.start[None, :]])
            at = np.flatnonzero(rows.any(1))
            yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32))] + [pa.array(rows[at, k]) for k in range(STATES)], ["i"] + names)

        got = train.mapInArrow(expect, schema).groupBy("i").agg(*[F.sum(x).alias(x) for x in names]).toArrow()
        if not got.num_rows:  # no training rows
            return p
        rows = np.zeros((n_classes + STATES + 1, STATES))  # classes and states: bounded by parameters
        rows[got.column("i").to_numpy()] = np.stack([got.column(x).to_numpy() for x in names], 1)
        e = Expected(n_classes)
        e.emit, e.move, e.start = rows[:n_classes], rows[n_classes:-1], rows[-1]
        p = e.params(prior)
    return p


def score_texts(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", modulus: int = 7, held_out: int = 2) -> DataFrame:
    """Per row: id, held_out, n_tokens, n_known, train_tokens, base_score, score."""
    src = df.select(F.monotonically_increasing_id().alias("row"), col(df, id_col).alias("id"),
                    F.coalesce(id_remainder(col(df, id_col), modulus) == held_out, F.lit(False)).alias("held_out"),
                    text_or_empty(col(df, text_col)).alias("text"))
    id_type = src.schema["id"].dataType.simpleString()
    train = src.filter("not held_out")
    words = pin(count_words(train), "lm-words")
    counts = collect_counts(words, train.count())
    n_classes = 1 + counts.n_own + SHARED

    def encode(batches):
        for b in batches:
            data, offsets = batch_bytes(b.column(3))
            for x, y in blocks(offsets, SCAN_BYTES):
                part = b.slice(x, y - x)
                h, cls, look, first, base, rare, known = code(counts, data[offsets[x]:offsets[y]], offsets[x:y + 1] - offsets[x])
                ends = first[1:]
                seq = np.insert(cls, ends, 0).astype(np.uint16)  # class 0: the end
                n = np.diff(first)
                seq_offsets = np.concatenate([[0], np.cumsum(n + 1)]) * 2
                rare_words = h[look].view(np.int64)
                rare_offsets = np.concatenate([[0], np.cumsum(look)])[first]
                end = counts.end_count
                yield pa.RecordBatch.from_arrays([
                    part.column(0), part.column(1), part.column(2), pa.array(n + 1), pa.array((known + (end > 0)).astype(np.int64)),
                    pa.array(base + np.log10(end + 1.0) - log_all(counts)), pa.array(rare),
                    pa.Array.from_buffers(pa.binary(), len(n), [None, pa.py_buffer(seq_offsets.astype(np.int32).tobytes()), pa.py_buffer(seq.tobytes())]),
                    pa.ListArray.from_arrays(pa.array(rare_offsets.astype(np.int32)), pa.array(rare_words))],
                    ["row", "id", "held_out", "n", "known", "base", "rare", "seq", "look"])

    coded = pin(src.mapInArrow(encode, f"row long, id {id_type}, held_out boolean, n long, known long, base double, rare double, "
                                       f"seq binary, look array<long>"), "lm-coded")
    looked = coded.select("row", F.explode("look").alias("h")).join(words.select("h", "c"), "h").groupBy("row").agg(
        F.sum(F.log10(F.col("c") + 1.0)).alias("l_sum"), F.count(F.lit(1)).alias("l_known"))

    # how often the classes occur in training: what the states start from and are smoothed to
    prior = np.ones(n_classes)
    prior[0] += counts.end_count
    prior[counts.own[counts.own > 0]] += counts.counts[counts.own > 0]
    prior[1 + counts.n_own:] += 10.0 ** counts.log_total - 1.0
    prior /= prior.sum()
    p = baum_welch(coded, n_classes, prior)

    def likelihood(batches):
        lattice = Lattice(p)
        for b in batches:
            cls, begin, size = sequences(b.column(7))
            log = np.zeros(len(size))
            for rows in groups(size):
                log[rows] = forward(lattice, cls, begin[rows], size[rows])[0]
            yield pa.RecordBatch.from_arrays([*(b.column(i) for i in range(7)), pa.array(log)], [*b.schema.names[:7], "path"])

    scored = coded.drop("look").mapInArrow(likelihood, f"row long, id {id_type}, held_out boolean, n long, known long, base double, "
                                                       f"rare double, path double")
    extra = lambda c: F.coalesce(F.col(c), F.lit(0))
    return scored.join(looked, "row", "left").select(
        F.col("id").alias(id_col), "held_out", F.col("n").alias("n_tokens"), (F.col("known") + extra("l_known")).alias("n_known"),
        F.lit(counts.tokens).cast("long").alias("train_tokens"),
        (F.col("base") + extra("l_sum")).alias("base_score"),
        (F.col("path") + F.col("rare") + extra("l_sum")).alias("score"))
