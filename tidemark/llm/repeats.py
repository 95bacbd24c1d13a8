"""Removal of repeated byte strings with sharded suffix arrays.

A byte goes if a string of ``length`` bytes that covers it starts anywhere else too, in the same text or another.

1. Scan: a window is a start with ``length`` bytes. Its key is the least hash of the short strings in it (128 bytes for
   windows of 400), so equal windows have equal keys. Consecutive windows with one key are a region (about 140 windows
   in ordinary text).
2. Regions whose key occurs once in the corpus hold no repeated window; most end here. Regions that occur with the
   same bytes more than once are repeated as a whole.
3. The different regions of the other keys are dealt to shards by key. A shard joins its regions to one string,
   sorts its suffixes by induced sorting and computes permuted common prefixes: a window is repeated if it
   shares ``length`` bytes with a neighbour in the order. Equal windows have one key and so one shard.
4. Keys with more bytes than a shard may hold are settled window by window: windows of one key are counted by a
   128-bit hash of their bytes, with partial counts before the shuffle.
5. The repeated windows of a text are united, and the bytes they cover are cut out.

Regions are told apart by a 64-bit hash of their key string and a 64-bit digest of their bytes.

Defined cases: null texts are empty; texts shorter than ``length`` keep everything; overlapping repeats count; repeated
rows are copies of each other and lose all windows; null and repeated ids are kept as they are; an empty table
gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bytescan import batch_bytes, mixed
from .common import col, pin, small_enough, text_or_empty
from .suffix import permuted_prefixes, suffix_array

SCAN_BYTES = 1 << 20          # bytes hashed together; longer texts are scanned in pieces that overlap
SHARD_BYTES = 1 << 20         # bytes a shard is meant to hold
KEY_BYTES = 1 << 20           # bytes of one key beyond which its windows are counted instead
MAX_BROADCAST = 1_000_000     # rows of keys (8 bytes each) that are sent to the scan; beyond it a join is used
MAX_SENT = 32 << 20           # bytes of places or spans, whose rows have no fixed size, that are sent to the texts
GRAM_VALUE = np.random.default_rng(77).integers(1, 1 << 63, 256, dtype=np.uint64)
ODD = [np.uint64(x) for x in np.random.default_rng(78).integers(1, 1 << 62, 24, dtype=np.uint64) * 2 + 1]


def gram_of(length: int) -> int:
    """Bytes of the key strings: the power of two next below a third of the window. Longer ones repeat less by
    chance, shorter ones make larger regions."""
    return 1 << max(0, (length // 3).bit_length() - 1)


def gram_hashes(data: np.ndarray, gram: int) -> np.ndarray:
    """Hash of the ``gram`` bytes from every position that has them."""
    g, n = GRAM_VALUE[data], 1
    for odd in ODD:
        if n == gram:
            break
        g = g[:-n] * odd + g[n:] if len(g) > n else g[:0]
        n *= 2
    return mixed(g)


def sliding_least(h: np.ndarray, width: int) -> np.ndarray:
    n = 1
    while 2 * n <= width:
        h = np.minimum(h[:-n], h[n:])
        n *= 2
    rest = width - n
    return np.minimum(h[:-rest], h[rest:]) if rest else h


def text_regions(data: np.ndarray, offsets: np.ndarray, length: int):
    """Regions of texts lying behind one another: text number, start in the text, windows, key, whether the key's
    string occurs twice in the region."""
    gram = gram_of(length)
    width = length - gram + 1
    h = gram_hashes(data, gram)
    if len(h) < width:
        return tuple(np.zeros(0, np.int64) for _ in range(5))
    m = sliding_least(h, width)
    sizes = np.diff(offsets)
    count = np.maximum(sizes - length + 1, 0)  # windows of each text
    inside = np.zeros(len(m) + 1, np.int64)
    has = count > 0
    np.add.at(inside, offsets[:-1][has], 1)
    np.add.at(inside, (offsets[:-1] + count)[has], -1)
    inside = np.cumsum(inside[:-1]) > 0
    new = np.ones(len(m), bool)
    new[1:] = m[1:] != m[:-1]
    new[offsets[:-1][has]] = True
    starts = np.flatnonzero(new & inside)
    stop = ~inside | new
    ends = np.append(np.flatnonzero(stop), len(m))
    ends = ends[np.searchsorted(ends, starts, side="right")]
    key = m[starts]
    twice = np.zeros(len(starts), bool)
    over = np.arange(width)
    for a in range(0, len(starts), 4096):
        s, e, v = starts[a:a + 4096], ends[a:a + 4096] - 1, key[a:a + 4096, None]
        first = s + (h[s[:, None] + over] == v).argmax(1)
        last = e + width - 1 - (h[(e + width - 1)[:, None] - over] == v).argmax(1)
        twice[a:a + 4096] = first != last
    text = np.searchsorted(offsets, starts, side="right") - 1
    return text, starts - offsets[text], ends - starts, key, twice


def pieces(offsets: np.ndarray, length: int):
    """(first text, last text + 1, skip, bytes) of scans: groups of short texts, or parts of one long text."""
    n, a = len(offsets) - 1, 0
    while a < n:
        size = int(offsets[a + 1] - offsets[a])
        if size > SCAN_BYTES:
            for skip in range(0, size - length + 1, SCAN_BYTES):  # windows that start in [skip, skip + SCAN_BYTES)
                yield a, a + 1, skip, min(size - skip, SCAN_BYTES + length - 1)
            a += 1
            continue
        b = int(np.searchsorted(offsets, offsets[a] + SCAN_BYTES, side="right")) - 1
        b = min(n, max(a + 1, b))
        yield a, b, 0, int(offsets[b] - offsets[a])
        a = b


def regions_of(src: DataFrame, length: int) -> DataFrame:
    """From (row, text): (row, start, n, key, digest, twice), a row per region."""
    def run(batches):
        for b in batches:
            rows = b.column(0).to_numpy(zero_copy_only=False)
            data, offsets = batch_bytes(b.column(1))
            for x, y, skip, size in pieces(offsets, length):
                at = int(offsets[x]) + skip
                part = data[at:at + size]
                local = offsets[x:y + 1] - offsets[x] if not skip and size == offsets[y] - offsets[x] else np.array([0, size])
                text, start, n, key, twice = text_regions(part, local, length)
                raw = part.tobytes()
                begin = (local[text] + start).tolist() if len(text) else []
                digest = [int.from_bytes(hashlib.blake2b(raw[s:s + k + length - 1], digest_size=8).digest(), "little", signed=True)
                          for s, k in zip(begin, n.tolist())]
                yield pa.RecordBatch.from_arrays([
                    pa.array(rows[x + text]), pa.array(start + skip, pa.int64()), pa.array(n, pa.int64()),
                    pa.array(key.astype(np.uint64).view(np.int64)), pa.array(digest, pa.int64()), pa.array(twice.astype(bool))],
                    ["row", "start", "n", "key", "digest", "twice"])

    return src.mapInArrow(run, "row long, start long, n long, key long, digest long, twice boolean")


def runs_of(mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    edge = np.diff(np.concatenate([[0], mask.astype(np.int8), [0]]))
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)


def repeated_windows(regions: list[bytes], length: int) -> np.ndarray:
    """Mask over the joined string (regions with a separator after each) of windows that occur elsewhere in it."""
    sizes = np.array([len(r) for r in regions])
    s = np.frombuffer(b"\0".join(regions) + b"\0", np.uint8).astype(np.uint16) + 2
    ends = np.cumsum(sizes + 1) - 1
    s[ends] = 1
    s = np.append(s, np.uint16(0))
    before, prefix = permuted_prefixes(s, suffix_array(s, 258))
    long = prefix >= length
    mask = long.copy()
    mask[before[long]] = True  # its neighbour in the order shares the window
    mask = mask[:-1]
    for e in ends.tolist():  # windows that reach over the end of their region are none
        mask[max(0, e - length + 1):e + 1] = False
    return mask


def _shard_job(length: int):
    def run(t: pa.Table) -> pa.Table:
        regions = t.column("bytes").to_pylist()
        sizes = np.array([len(r) for r in regions])
        first = np.concatenate([[0], np.cumsum(sizes + 1)])[:-1]
        a, b = runs_of(repeated_windows(regions, length))
        at = np.searchsorted(first, a, side="right") - 1
        key, digest = t.column("key").to_numpy(), t.column("digest").to_numpy()
        return pa.table({"key": pa.array(key[at]), "digest": pa.array(digest[at]), "a": pa.array(a - first[at]), "n": pa.array(b - a)})

    return run


def window_hashes(hot: DataFrame, length: int) -> DataFrame:
    """From (key, digest, copies, bytes): (h1, h2, key, digest, w, copies), a row per window."""
    def run(batches):
        for b in batches:
            for key, digest, copies, raw in zip(*(c.to_pylist() for c in b.columns)):
                n = len(raw) - length + 1
                found = [hashlib.blake2b(raw[w:w + length], digest_size=16).digest() for w in range(n)]
                h = np.frombuffer(b"".join(found), np.int64).reshape(n, 2)
                yield pa.RecordBatch.from_arrays([
                    pa.array(h[:, 0].copy()), pa.array(h[:, 1].copy()), pa.array(np.full(n, key)), pa.array(np.full(n, digest)),
                    pa.array(np.arange(n)), pa.array(np.full(n, copies))], ["h1", "h2", "key", "digest", "w", "copies"])

    return hot.select("key", "digest", "copies", "bytes").mapInArrow(run, "h1 long, h2 long, key long, digest long, w long, copies long")


def _sent(df: DataFrame) -> DataFrame:
    return F.broadcast(df) if small_enough(df, MAX_BROADCAST) else df


def _sent_lists(df: DataFrame, items: str, item_bytes: int) -> DataFrame:
    """Broadcast if the rows with their lists measure at most MAX_SENT bytes, else to be joined by a shuffle."""
    total = df.agg(F.sum(F.size(items).cast("long") * item_bytes + 64)).first()[0] or 0
    return F.broadcast(df) if total <= MAX_SENT else df.hint("shuffle_merge")


def united(lists: DataFrame, reach: int) -> DataFrame:
    """The last column, a list of (a, end) or (a, n) pairs, sorted with overlapping and touching ranges united. ``reach`` 0
    for ends; for n windows the bytes that the last one adds."""
    def run(batches):
        for b in batches:
            out = []
            for v in b.column(b.num_columns - 1):
                x = v.values
                a, e = (x.field(i).to_numpy(zero_copy_only=False) for i in (0, 1))
                e = a + e + reach if reach else e
                order = np.argsort(a, kind="stable")
                a, e = a[order], np.maximum.accumulate(e[order])
                first = np.flatnonzero(np.append(True, a[1:] > e[:-1]))
                last = e[np.append(first[1:], len(a)) - 1]
                out.append((a[first], last - a[first] - reach if reach else last))
            offsets = np.concatenate([[0], np.cumsum([len(a) for a, _ in out])]).astype(np.int32)
            flat = [pa.array(np.concatenate([o[i] for o in out] or [np.zeros(0, np.int64)]), pa.int64()) for i in (0, 1)]
            names = [f.name for f in kind.value_type]
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.ListArray.from_arrays(pa.array(offsets), pa.StructArray.from_arrays(flat, names))],
                                             b.schema.names)

    fields = [f.name for f in lists.schema[-1].dataType.elementType]
    kind = pa.list_(pa.struct([(n, pa.int64()) for n in fields]))
    return lists.mapInArrow(run, lists.schema)


def repeated_spans(content: DataFrame, length: int) -> DataFrame:
    """From content (row, text): (row, spans), the united byte ranges (a, b) covered by repeated windows."""
    regions = pin(regions_of(content, length), "repeat-regions")
    keys = regions.groupBy("key").agg(F.sum(F.when(F.col("twice"), 2).otherwise(1)).alias("c")).filter("c > 1").select("key")
    keys = pin(keys, "repeat-keys")
    found = pin(regions.join(_sent(keys), "key"), "repeat-candidates")
    kinds = found.groupBy("key", "digest").agg(F.count(F.lit(1)).alias("copies"), F.max("twice").alias("twice"),
                                               F.min(F.struct("row", "start", "n")).alias("at"))
    of_key = kinds.groupBy("key").agg(F.count(F.lit(1)).alias("kinds"), F.sum(F.col("at.n") + (length - 1)).alias("size"))
    kinds = pin(kinds.join(of_key, "key"), "repeat-kinds")

    # different regions of one key, and regions that may repeat themselves
    open_ = kinds.filter("kinds > 1 or twice")
    places = pin(open_.groupBy("at.row").agg(F.collect_list(F.struct("at.start", "at.n", "key", "digest", "copies", "size")).alias("p")), "repeat-places")

    def cut(batches):
        names = ["key", "digest", "copies", "size", "bytes"]
        for b in batches:
            for text, p in zip(b.column(0), b.column(1).to_pylist()):
                raw = text.as_py().encode("utf-8", "surrogatepass")
                yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in p], pa.int64()) for k in names[:4]]
                                                 + [pa.array([raw[x["start"]:x["start"] + x["n"] + length - 1] for x in p], pa.binary())], names)

    texts = content.join(_sent_lists(places, "p", 48), "row").select("text", "p")
    cuts = pin(texts.mapInArrow(cut, "key long, digest long, copies long, size long, bytes binary"), "repeat-bytes")
    total = cuts.agg(F.sum(F.octet_length("bytes"))).first()[0] or 0
    shards = max(1, total // SHARD_BYTES)
    dealt = cuts.filter(F.col("size") <= KEY_BYTES).withColumn("shard", F.pmod(F.xxhash64("key"), F.lit(shards)))
    sorted_ = dealt.groupBy("shard").applyInArrow(_shard_job(length), "key long, digest long, a long, n long")
    hot = window_hashes(cuts.filter(F.col("size") > KEY_BYTES), length)
    again = hot.groupBy("h1", "h2").agg(F.sum("copies").alias("c"), F.count(F.lit(1)).alias("m")).filter("c > 1").select("h1", "h2")
    counted = hot.join(again, ["h1", "h2"]).select("key", "digest", F.col("w").alias("a"), F.lit(1).cast("long").alias("n"))
    settled = sorted_.unionByName(counted).groupBy("key", "digest").agg(F.collect_list(F.struct("a", "n")).alias("runs"))
    settled = pin(united(settled, length - 1), "repeat-settled")  # of counted windows: runs of those whose bytes touch

    known = kinds.select("key", "digest", "copies").join(settled, ["key", "digest"], "left").filter("copies > 1 or runs is not null")
    marked = found.join(known, ["key", "digest"])
    whole = F.array(F.struct(F.col("start").alias("a"), (F.col("start") + F.col("n") + (length - 1)).alias("b")))
    part = F.transform("runs", lambda x: F.struct((F.col("start") + x["a"]).alias("a"), (F.col("start") + x["a"] + x["n"] + (length - 1)).alias("b")))
    spans = marked.select("row", F.when(F.col("copies") > 1, whole).otherwise(part).alias("s"))
    return united(spans.groupBy("row").agg(F.flatten(F.collect_list("s")).alias("spans")), 0)


def remove_repeats(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = 400) -> DataFrame:
    """Per input row: id, n_bytes, n_removed, n_spans, kept (the remaining bytes), removed (united byte ranges)."""
    content = pin(df.select(F.monotonically_increasing_id().alias("row"), col(df, id_col).alias("id"),
                            text_or_empty(col(df, text_col)).alias("text")), "repeat-content")
    id_type = content.schema["id"].dataType.simpleString()
    spans = pin(repeated_spans(content.select("row", "text"), length), "repeat-spans")
    both = content.join(_sent_lists(spans, "spans", 16), "row", "left").select("id", "text", "spans")
    pair = pa.struct([("a", pa.int64()), ("b", pa.int64())])

    def cut(batches):
        for b in batches:
            out = []
            for text, s in zip(b.column(1), b.column(2)):
                raw = text.as_py().encode("utf-8", "surrogatepass")
                ranges = []
                if s.is_valid:
                    for x, y in sorted((v["a"], v["b"]) for v in s.as_py()):
                        if ranges and x <= ranges[-1][1]:
                            ranges[-1][1] = max(y, ranges[-1][1])
                        else:
                            ranges.append([x, y])
                at, left = 0, []
                for x, y in ranges:
                    left.append(raw[at:x])
                    at = y
                left.append(raw[at:])
                out.append((len(raw), sum(y - x for x, y in ranges), len(ranges), b"".join(left), [{"a": x, "b": y} for x, y in ranges]))
            cols = list(zip(*out)) if out else [[]] * 5
            yield pa.RecordBatch.from_arrays([b.column(0), *(pa.array(c, k) for c, k in zip(cols, (pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.list_(pair))))],
                                             [id_col, "n_bytes", "n_removed", "n_spans", "kept", "removed"])

    return both.mapInArrow(cut, f"`{id_col}` {id_type}, n_bytes long, n_removed long, n_spans long, kept binary, removed array<struct<a:long,b:long>>")
