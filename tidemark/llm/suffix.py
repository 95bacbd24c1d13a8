"""Suffix arrays by induced sorting, and permuted common prefixes.

Suffixes are classified as S (smaller than the next) or L; the leftmost S of a run (LMS) starts an LMS substring.
Sorting the LMS substrings, naming them and sorting the string of names recursively gives the order of the LMS
suffixes, from which one pass upwards induces all L suffixes and one pass downwards all S suffixes.

Texts of bytes have few characters, so there a whole bucket is induced at once with numpy; the strings of names
have many, so there the passes go element by element.
"""

from __future__ import annotations

import numpy as np

FEW = 1024  # characters up to which buckets are induced as arrays


def _types(s: np.ndarray) -> np.ndarray:
    """True for S suffixes; the last character is the unique smallest."""
    n = len(s)
    step = np.sign(s[1:].astype(np.int64) - s[:-1])
    at = np.where(step != 0, np.arange(n - 1), n)
    after = np.minimum.accumulate(at[::-1])[::-1]  # the next place where the text rises or falls
    out = np.ones(n, bool)
    out[:-1] = step[np.minimum(after, n - 2)] > 0
    return out


def _append(lists: list, chars: np.ndarray, where: np.ndarray) -> None:
    """Adds positions to the buckets of their characters, keeping their order."""
    if not len(where):
        return
    order = np.argsort(chars, kind="stable")
    chars, where = chars[order], where[order]
    cuts = np.flatnonzero(chars[1:] != chars[:-1]) + 1
    for first, part in zip(chars[np.concatenate([[0], cuts])].tolist(), np.split(where, cuts)):
        lists[first].append(part)


def _induce_arrays(s: np.ndarray, is_s: np.ndarray, lms: np.ndarray, k: int) -> np.ndarray:
    """Suffix array from the LMS positions in order, a bucket at a time."""
    seeds: list = [[] for _ in range(k)]
    _append(seeds, s[lms], lms)
    up: list = [[] for _ in range(k)]
    left: list = [None] * k
    none = np.zeros(0, np.int64)
    for c in range(k):
        parts, i = up[c], 0
        while i < len(parts):  # grows by what the bucket induces in itself
            p = parts[i] - 1
            p = p[p >= 0]
            p = p[~is_s[p]]
            same = s[p] == c
            if same.any():
                parts.append(p[same])
            _append(up, s[p[~same]], p[~same])
            i += 1
        left[c] = np.concatenate(parts) if parts else none
        up[c] = None
        for part in seeds[c]:
            p = part - 1
            p = p[p >= 0]
            _append(up, s[p], p)
    down: list = [[] for _ in range(k)]
    down[int(s[-1])].append(np.array([len(s) - 1]))
    out: list = [None] * k
    for c in range(k - 1, -1, -1):
        parts, i = down[c], 0
        while i < len(parts):
            p = parts[i] - 1
            p = p[p >= 0]
            p = p[is_s[p]]
            same = s[p] == c
            if same.any():
                parts.append(p[same])
            _append(down, s[p[~same]], p[~same])
            i += 1
        p = left[c][::-1] - 1
        p = p[p >= 0]
        p = p[is_s[p]]
        _append(down, s[p], p)
        out[c] = np.concatenate([left[c]] + [x[::-1] for x in parts[::-1]])
        down[c] = left[c] = None
    return np.concatenate(out)


def _induce_elements(s: np.ndarray, is_s: np.ndarray, lms: np.ndarray, k: int) -> np.ndarray:
    """The same, an element at a time."""
    n = len(s)
    text, small = s.tolist(), is_s.tolist()
    sizes = np.bincount(s, minlength=k)
    ends = np.cumsum(sizes)
    sa = [-1] * n
    tail = ends.tolist()
    for p in reversed(lms.tolist()):
        c = text[p]
        tail[c] -= 1
        sa[tail[c]] = p
    head = (ends - sizes).tolist()
    for i in range(n):
        p = sa[i] - 1
        if p >= 0 and not small[p]:
            c = text[p]
            sa[head[c]] = p
            head[c] += 1
    tail = ends.tolist()
    for i in range(n - 1, -1, -1):
        p = sa[i] - 1
        if p >= 0 and small[p]:
            c = text[p]
            tail[c] -= 1
            sa[tail[c]] = p
    sa[0] = n - 1
    return np.array(sa, np.int64)


def _names(s: np.ndarray, lms: np.ndarray, ordered: np.ndarray) -> np.ndarray:
    """Ranks of the LMS substrings given in order; equal substrings have equal ranks."""
    size = np.empty(len(s), np.int64)
    size[lms[:-1]] = np.diff(lms) + 1
    size[lms[-1]] = 1
    a, b = ordered[:-1], ordered[1:]
    new = size[a] != size[b]
    left = np.flatnonzero(~new)
    j = 0
    while len(left):
        same = s[a[left] + j] == s[b[left] + j]
        new[left[~same]] = True
        j += 1
        left = left[same]
        left = left[size[a[left]] > j]
    return np.concatenate([[0], np.cumsum(new)])


def suffix_array(s: np.ndarray, k: int) -> np.ndarray:
    """Order of the suffixes of ``s`` (characters below ``k``; the last is 0 and the only 0)."""
    n = len(s)
    if n == 1:
        return np.zeros(1, np.int64)
    induce = _induce_arrays if k <= FEW else _induce_elements
    is_s = _types(s)
    lms = np.flatnonzero(is_s[1:] & ~is_s[:-1]) + 1
    sa = induce(s, is_s, lms, k)
    mark = np.zeros(n, bool)
    mark[lms] = True
    ordered = sa[mark[sa]]
    names = _names(s, lms, ordered)
    if names[-1] + 1 < len(lms):
        place = np.empty(n, np.int64)
        place[ordered] = names
        ordered = lms[suffix_array(place[lms], int(names[-1]) + 1)]
        sa = induce(s, is_s, ordered, k)
    elif len(lms) > 1:
        sa = induce(s, is_s, ordered, k)
    return sa


def permuted_prefixes(s: np.ndarray, sa: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Per position: the suffix before it in the order (-1 for the first), and their common prefix.

    Where both suffixes are preceded by the same character, the value is one less than the position's before; the
    others are compared, and their lengths add up to little."""
    n = len(s)
    before = np.empty(n, np.int64)
    before[sa[0]] = -1
    before[sa[1:]] = sa[:-1]
    here = np.arange(n)
    free = np.ones(n, bool)
    inner = (here > 0) & (before > 0)
    free[inner] = s[here[inner] - 1] != s[before[inner] - 1]
    start = np.flatnonzero(free & (before >= 0))
    length = np.zeros(n, np.int64)
    padded = np.concatenate([s, np.zeros(128, s.dtype)])
    left, done, step = start, 0, 8
    while len(left):
        over = np.arange(done, done + step)
        rest = []
        for a in range(0, len(left), 1 << 16):
            some = left[a:a + (1 << 16)]
            i, j = np.minimum(some[:, None] + over, n + 127), np.minimum(before[some][:, None] + over, n + 127)
            differ = padded[i] != padded[j]
            any_ = differ.any(1)
            length[some] = done + np.where(any_, differ.argmax(1), step)
            rest.append(some[~any_])
        left, done, step = np.concatenate(rest), done + step, 64
    base = np.maximum.accumulate(np.where(free, here, 0))
    return before, np.maximum(length[base] - (here - base), 0)
