"""Words of whole Arrow batches at once: positions in the UTF-8 bytes, and 64-bit hashes of the words in lower
case (A-Z). Words are told apart by this hash alone; two different words of a corpus of a billion words share it
with a probability of about 3 in 100."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

SHORT = 256  # bytes of a word that are hashed for all words together; longer words are hashed one by one
STEP = np.uint64(0x9E3779B97F4A7C15)


def _tables():
    space = np.zeros(256, bool)
    space[[0x20, *range(0x09, 0x0E)]] = True
    lower = np.arange(256)
    lower[65:91] += 32
    value = np.random.default_rng(2024).integers(1, 1 << 63, 256, dtype=np.uint64)[lower]
    return space, value


SPACE, VALUE = _tables()


def mixed(h: np.ndarray) -> np.ndarray:
    """Final mixing of 64-bit hashes (a bijection)."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> np.uint64(27))
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def batch_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all strings behind one another, and their n + 1 offsets."""
    kind = np.int64 if pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type) else np.int32
    n = len(column)
    if not n:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(column.buffers()[1], kind)[column.offset:column.offset + n + 1].astype(np.int64)
    data = np.frombuffer(column.buffers()[2], np.uint8)[offsets[0]:offsets[-1]] if column.buffers()[2] is not None else np.zeros(0, np.uint8)
    return data, offsets - offsets[0]


def word_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of every word, and per string the number of the first (n + 1 entries)."""
    gap = SPACE[data]
    before = np.concatenate([[True], gap[:-1]]) if len(gap) else gap
    after = np.concatenate([gap[1:], [True]]) if len(gap) else gap
    inner = offsets[(offsets > 0) & (offsets < len(data))]
    if len(gap):
        before[inner] = True
        after[inner - 1] = True
    starts, ends = np.flatnonzero(~gap & before), np.flatnonzero(~gap & after) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    size = ends - starts
    out = np.zeros(len(starts), np.uint64)
    short = np.minimum(size, SHORT).astype(np.uint16)
    order = np.argsort(short, kind="stable")[::-1]
    at, left = starts[order], short[order]
    h = np.zeros(len(starts), np.uint64)
    reach = np.searchsorted(-left.astype(np.int32), -np.arange(1, (int(left[0]) if len(left) else 0) + 1), side="right")
    for j, n in enumerate(reach):  # the n words with more than j bytes
        h[:n] = h[:n] * STEP + VALUE[data[at[:n] + j]]
    out[order] = h
    for i in np.flatnonzero(size > SHORT):
        rest = VALUE[data[starts[i] + SHORT:ends[i]]]
        power = np.full(len(rest), STEP)
        power[0] = 1
        power = np.multiply.accumulate(power)
        out[i:i + 1] = out[i:i + 1] * (power[-1:] * STEP) + (rest * power[::-1]).sum(dtype=np.uint64, keepdims=True)
    return mixed(out ^ (size.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)))


def blocks(offsets: np.ndarray, most: int):
    """Ranges of strings of at most ``most`` bytes each (one string at least)."""
    n, a = len(offsets) - 1, 0
    while a < n:
        b = int(np.searchsorted(offsets, offsets[a] + most, side="right")) - 1
        b = min(n, max(a + 1, b))
        yield a, b
        a = b
