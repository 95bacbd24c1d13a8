"""Fill-in-middle transformation by block rotation in place.

A text's two cuts are scanned off its tokens (a word with the white space before it, or the white space at the
end). Each text lies in one bytearray as prefix, middle, suffix; the sentinels are inserted at the cuts, and the
segments change places by rotations of three reversals, with no second copy of the text. Restoring applies the
inverse rotation and deletes the sentinels, so it gives back the very bytes.

Which texts are transformed, the order of the segments and the cuts depend on the seed and the id alone (digest of
``seed:id``), so reruns, partitionings and retries agree. Rows stay in their partitions: nothing is shuffled.

Defined cases: a null text counts as empty; an empty text, and one that holds a sentinel, stays plain (cuts null);
a null id draws like the empty id; equal ids draw equal numbers, each row is transformed by itself; a text of any
length is handled whole (its bytes, once); an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import itertools
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import col, free_names, text_or_empty

# The sentinels and the token rule (on bytes: white space is ASCII, so no character is cut).
PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
TOKEN = rb"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+"
SWAP = 1 << 16  # bytes exchanged at a time


def reverse(buf: np.ndarray, lo: int, hi: int) -> None:
    """Reverse ``buf[lo:hi]`` in place, a block from each end at a time."""
    while hi - lo > 1:
        n = min(SWAP, (hi - lo) // 2)
        left = buf[lo:lo + n][::-1].copy()
        buf[lo:lo + n] = buf[hi - n:hi][::-1]
        buf[hi - n:hi] = left
        lo, hi = lo + n, hi - n


def rotate(buf: np.ndarray, lo: int, mid: int, hi: int) -> None:
    """Exchange the neighbouring blocks ``[lo, mid)`` and ``[mid, hi)`` by three reversals."""
    reverse(buf, lo, mid)
    reverse(buf, mid, hi)
    reverse(buf, lo, hi)


def scan(text: bytes, h1: int, h2: int, token: re.Pattern) -> tuple[int, int, int]:
    """Number of tokens, and the byte positions after the smaller and the larger cut."""
    n = sum(1 for _ in token.finditer(text))
    ends, at = [], 0
    tokens = token.finditer(text)
    for cut in sorted((h1 % (n + 1), h2 % (n + 1))):
        if cut > at:
            ends.append(next(itertools.islice(tokens, cut - at - 1, None)).end())
            at = cut
        else:
            ends.append(ends[-1] if ends else 0)
    return n, ends[0], ends[1]


def transform(text: bytes, a: int, b: int, form: str) -> bytearray:
    """Sentinels at the cuts ``a`` and ``b``, then the segments in the order of ``form``."""
    buf = bytearray(text)
    buf[b:b] = SUFFIX
    buf[a:a] = MIDDLE
    buf[0:0] = PREFIX
    middle, suffix = len(PREFIX) + a, len(PREFIX) + len(MIDDLE) + b
    view = np.frombuffer(buf, np.uint8)
    # spm: suffix before all the rest; psm: suffix before the middle
    rotate(view, 0 if form == "spm" else middle, suffix, len(view))
    return buf


def restore(output: bytes, form: str) -> bytes | bytearray:
    """The text that ``transform`` was given."""
    if form == "plain":
        return output
    buf = bytearray(output)
    first = buf.find(SUFFIX)
    second = buf.find(PREFIX if form == "spm" else MIDDLE, first)
    view = np.frombuffer(buf, np.uint8)
    rotate(view, first, second, len(view))  # back to prefix, middle, suffix
    del view
    middle = buf.find(MIDDLE)
    suffix = buf.find(SUFFIX, middle)
    del buf[suffix:suffix + len(SUFFIX)]
    del buf[middle:middle + len(MIDDLE)]
    del buf[:len(PREFIX)]
    return buf


def characters(part) -> int:
    """Code points of UTF-8 bytes: those that don't continue one."""
    raw = np.frombuffer(part, np.uint8)
    return int(np.count_nonzero((raw & 0xC0) != 0x80)) if len(raw) else 0


def infill_documents(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", seed: int = 42, rate: int = 50,
                     spm: int = 80) -> DataFrame:
    """One row per input row: the id, ``n`` (tokens), ``form`` (plain, psm or spm), ``prefix_chars`` and
    ``middle_chars`` (code points, null if plain) and ``output`` (the transformed text). ``rate`` % of the texts are
    transformed, ``spm`` % of these with the suffix first."""
    key = F.concat(F.lit(f"{seed}:"), F.coalesce(col(df, id_col).cast("string"), F.lit("")))
    t, digest = free_names(df, "text", "digest")
    src = df.select(col(df, id_col).alias(id_col), text_or_empty(col(df, text_col)).cast("binary").alias(t),
                    F.sha2(key, 256).alias(digest))
    id_type = src.schema[0].dataType.simpleString()
    schema = f"`{id_col}` {id_type}, n long, form string, prefix_chars long, middle_chars long, output string"

    def work(batches):
        token = re.compile(TOKEN)
        types = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string()]
        for whole in batches:
            for b in bounded(whole, 1):
                rows = []
                for text, digest in zip(b.column(1), b.column(2)):
                    text, digest = text.as_py(), digest.as_py()
                    h1, h2, h3, h4 = (int(digest[i:i + 8], 16) for i in (0, 8, 16, 24))
                    n, start, end = scan(text, h1, h2, token)
                    if not text or h3 % 100 >= rate or any(s in text for s in (PREFIX, SUFFIX, MIDDLE)):
                        rows.append((n, "plain", None, None, text))
                        continue
                    form = "spm" if h4 % 100 < spm else "psm"
                    rows.append((n, form, characters(text[:start]), characters(text[start:end]),
                                 bytes(transform(text, start, end, form))))
                fields = [pa.array([r[i] for r in rows], k if i < 4 else pa.binary()) for i, k in enumerate(types)]
                yield pa.RecordBatch.from_arrays([b.column(0), *fields[:4], fields[4].cast(pa.string(), safe=False)],
                                                 [b.schema.names[0], "n", "form", "prefix_chars", "middle_chars", "output"])

    return src.mapInArrow(work, schema)


def restore_documents(df: DataFrame, output_col: str = "output", form_col: str = "form") -> DataFrame:
    """``df`` with ``restored``: the exact text, rebuilt from output and form alone."""
    names = df.columns
    out_at, form_at = names.index(output_col), names.index(form_col)
    schema = T.StructType([*df.schema.fields, T.StructField("restored", T.StringType())])

    def work(batches):
        for whole in batches:
            for b in bounded(whole, out_at):
                texts = b.column(out_at).cast(pa.binary(), safe=False)
                rows = [None if x.as_py() is None else bytes(restore(x.as_py(), f.as_py()))
                        for x, f in zip(texts, b.column(form_at))]
                yield pa.RecordBatch.from_arrays([*b.columns, pa.array(rows, pa.binary()).cast(pa.string(), safe=False)],
                                                 [*names, "restored"])

    return df.mapInArrow(work, schema)


def bounded(batch: pa.RecordBatch, at: int, limit: int = 16 << 20):
    """Slices of a batch of at most ``limit`` bytes of column ``at``, or single rows."""
    import pyarrow.compute as pc

    sizes = pc.fill_null(pc.binary_length(batch.column(at)), 0).to_numpy(zero_copy_only=False)
    start, total = 0, 0
    for i, s in enumerate(sizes.tolist()):
        if i > start and total + s > limit:
            yield batch.slice(start, i - start)
            start, total = i, 0
        total += s
    if batch.num_rows > start:
        yield batch.slice(start)
