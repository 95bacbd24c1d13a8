"""Packing documents into token windows by minimum bin slack.

A document's ids are cut into full windows and one remainder. The remainders of a partition are counted by
length; a window starts with the longest one, and a bitset subset-sum over the others (every bit a reachable
sum, lengths halved into powers of two) finds the multiset that comes closest to the capacity. Backtracking
gives its counts, and the same pattern is used as often as the counts allow. If no multiset fills the window,
the gap is filled by cutting a remainder; the last ids of a partition go into windows of a power of two, which
need no padding. Every partition packs its own rows: no shuffle, and the state is at most ``POOL`` remainders.

Defined cases: a null text is empty, so its document is the end id alone; rows are independent, so repeated ids
are packed as separate documents; texts of any length are cut into windows; extra columns are ignored; an empty
table gives an empty result.
"""

from __future__ import annotations

import os
import re
import zlib

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from .common import col, text_or_empty, worker_cache

POOL = 8192          # remainders held before they are packed
CACHE_ENTRIES = 600_000  # chunks whose ids a worker remembers
# Ids of a text are those of its chunks. No token reaches from a character into white space after it, nor from a
# letter into a character that is none; the second cut is made in texts of plain letters only, where both are clear.
LETTER = "A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f"
CHUNK = r"\s*\S+|\s+"
PLAIN_CHUNK = rf"\s*[^\s{LETTER}]*[{LETTER}]+|\s*[^\s{LETTER}]+|\s+"
SPECIAL = "<|"  # texts that may hold the text of a special token keep their words whole
UNPLAIN = rf"[^\x00-\x7f{LETTER}]"


class ChunkEncoder:
    """Ids of a text as little-endian 32-bit bytes; remembers the ids of chunks (white space and a word)."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs a task per core already
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.find, self.find_plain = re.compile(CHUNK).findall, re.compile(PLAIN_CHUNK).findall
        self.unplain = re.compile(UNPLAIN).search
        self.known: dict[str, bytes] = {}

    def __call__(self, text: str) -> bytes:
        chunks = self.find(text) if SPECIAL in text or self.unplain(text) else self.find_plain(text)
        ids = list(map(self.known.get, chunks))
        if None in ids:
            new = list({c for c, i in zip(chunks, ids) if i is None})
            coded = self.tokenizer.encode_batch_fast(new, add_special_tokens=False)
            fresh = {c: b"".join([i.to_bytes(4, "little") for i in e.ids]) for c, e in zip(new, coded)}
            ids = [fresh[c] if i is None else i for c, i in zip(chunks, ids)]
            if len(self.known) < CACHE_ENTRIES:
                self.known.update(fresh)
        return b"".join(ids)


def closest_fill(counts: list[int], capacity: int) -> tuple[int, list[tuple[int, int]]]:
    """The sum nearest below or at ``capacity`` of a multiset of lengths, and its (length, count) pairs."""
    mask = (1 << (capacity + 1)) - 1
    reach, steps = 1, []
    for length in range(min(capacity, len(counts) - 1), 0, -1):
        left = min(counts[length], capacity // length)
        part = 1
        while left:
            part = min(part, left)
            steps.append((length, part, reach))
            reach |= (reach << (length * part)) & mask
            left -= part
            part *= 2
        if reach >> capacity & 1:
            break
    total = reach.bit_length() - 1
    used, at = {}, total
    for length, part, before in reversed(steps):
        if not before >> at & 1:  # this sum needs the step
            used[length] = used.get(length, 0) + part
            at -= length * part
    return total, list(used.items())


class Packer:
    """Collects remainders (document row, start, ids) and yields pieces of closed windows."""

    def __init__(self, capacity: int, first_id: int):
        self.capacity, self.sequence = capacity, first_id
        self.by_length: list[list] = [[] for _ in range(capacity)]
        self.counts = [0] * capacity
        self.size = self.held = 0
        self.out: list[tuple] = []

    def emit(self, doc, start, ids, offset):
        self.out.append((doc, start, ids, self.sequence, offset))

    def window(self, doc, start, ids):
        self.emit(doc, start, ids, 0)
        self.sequence += 1

    def hold(self, doc, start, ids):
        n = len(ids) // 4
        self.by_length[n].append((doc, start, ids))
        self.counts[n] += 1
        self.size += 1
        self.held += n

    def take(self, length):
        self.counts[length] -= 1
        self.size -= 1
        self.held -= length
        return self.by_length[length].pop()

    def longest(self):
        n = self.capacity - 1
        while n and not self.counts[n]:
            n -= 1
        return n

    def pack(self, final: bool):
        keep = 0 if final else 64 * self.capacity  # what stays for a later, richer choice
        while self.held >= max(keep, self.capacity):
            seed = self.longest()
            self.counts[seed] -= 1
            total, picks = closest_fill(self.counts, self.capacity - seed)
            self.counts[seed] += 1
            picks = [(seed, 1)] + picks
            need = {}
            for length, count in picks:
                need[length] = need.get(length, 0) + count
            times = min(self.counts[length] // count for length, count in need.items())
            slack = self.capacity - seed - total
            for _ in range(1 if slack else times):
                offset = 0
                for length, count in need.items():
                    for _ in range(count):
                        doc, start, ids = self.take(length)
                        self.emit(doc, start, ids, offset)
                        offset += length
                if slack:
                    doc, start, ids = self.take(self.longest())  # longer than the gap, or it would have been picked
                    self.emit(doc, start, ids[:4 * slack], offset)
                    self.hold(doc, start + slack, ids[4 * slack:])
                self.sequence += 1
        if final:
            self.tail()

    def tail(self):
        """Fewer ids than a window: sequences of falling powers of two."""
        rest = [p for group in self.by_length for p in group]
        room, offset = 0, 0
        left = self.held
        for doc, start, ids in rest:
            while ids:
                if not room:
                    room, offset = 1 << (left.bit_length() - 1), 0
                    left -= room
                n = min(room, len(ids) // 4)
                self.emit(doc, start, ids[:4 * n], offset)
                start, ids, room, offset = start + n, ids[4 * n:], room - n, offset + n
                if not room:
                    self.sequence += 1

    def drain(self):
        out, self.out = self.out, []
        return out


def pack_documents(df: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text",
                   capacity: int = 1024, end_id: int = 0) -> DataFrame:
    """One row per piece: id, start, length, ids_crc32, doc_tokens, sequence_id, offset, and the ids themselves
    (binary, little-endian 32-bit)."""
    src = df.select(col(df, id_col).alias(id_col), text_or_empty(col(df, text_col)).alias("__text"))
    id_type = src.schema[0].dataType.simpleString()

    def run(batches):
        cache = worker_cache()
        if ("encoder", tokenizer_path) not in cache:
            cache["encoder", tokenizer_path] = ChunkEncoder(tokenizer_path)
        encode = cache["encoder", tokenizer_path]
        end = end_id.to_bytes(4, "little")
        packer = Packer(capacity, TaskContext.get().partitionId() << 33)
        kind = None

        def rows():
            pieces = packer.drain()
            return pa.RecordBatch.from_arrays([
                pa.array([p[0][0] for p in pieces], kind), pa.array([p[1] for p in pieces], pa.int64()),
                pa.array([len(p[2]) // 4 for p in pieces], pa.int64()), pa.array([zlib.crc32(p[2]) for p in pieces], pa.int64()),
                pa.array([p[0][1] for p in pieces], pa.int64()), pa.array([p[3] for p in pieces], pa.int64()),
                pa.array([p[4] for p in pieces], pa.int64()), pa.array([p[2] for p in pieces], pa.binary())],
                [id_col, "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "ids"])

        for b in batches:
            kind = b.schema.field(0).type
            for i, t in zip(b.column(0).to_pylist(), b.column(1)):
                ids = encode(t.as_py()) + end
                n = len(ids) // 4
                doc = (i, n)
                cut = n - n % capacity
                for start in range(0, cut, capacity):
                    packer.window(doc, start, ids[4 * start:4 * (start + capacity)])
                if cut < n:
                    packer.hold(doc, cut, ids[4 * cut:])
                if packer.size >= POOL:
                    packer.pack(False)
                if len(packer.out) >= 4 * POOL:
                    yield rows()
        if kind is not None:
            packer.pack(True)
            yield rows()

    return src.mapInArrow(run, f"`{id_col}` {id_type}, start long, length long, ids_crc32 long, doc_tokens long, "
                               f"sequence_id long, offset long, ids binary")
