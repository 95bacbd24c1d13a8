"""Toxicity by compression distance.

Two dictionaries are trained by zstandard: one on windows of ordinary text, one on the parts of toxic windows that
toxic documents say more often. Both codings of a window share the ordinary background (the toxic one has its own part in front of it), so
the difference of the two compressed lengths is the bytes that the toxic dictionary alone explains; it is 0 for
most windows of ordinary text. Windows are eight words in lower case.

* Toxic samples: words, and phrases of up to a window's words, that recur in several toxic training documents and are
  over-represented there (standard score of the document count against the share of toxic documents); a phrase only if
  it scores above all that it is made of. Every stretch of a toxic text that such samples cover is a training text of
  the toxic dictionary, as often as it occurs, whatever its length; zstandard's trainer chooses what the dictionary
  holds.
* Thresholds: the toxic dictionary (least standard score of a sample, with phrases or without), and the least
  difference for a window to count as a hit, are chosen by likelihood on training documents that didn't go into the
  dictionaries; a logistic curve over the document's hits and mean difference turns them into a calibrated score.

The fit reads at most ``max_toxic`` + ``max_ordinary`` labelled documents (those with the smallest hash of the
id among those that have a document) and at most ``max_bytes`` of text: a text that doesn't fit any more is left out of
the fit, the next ones are tried. Scoring reads every whole text.

Defined cases: a null or empty text has no windows and gets the score of a document without hits; labels that
are null or without a document are not used; without toxic or without ordinary training rows the score is the
smoothed share of toxic rows; repeated rows and ids are scored each on its own (the fit takes one text of an id, the
one with the smallest hash); extra columns are ignored.
"""

from __future__ import annotations

import collections
import re
import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import col, id_remainder, pin_at, text_or_empty, unpin, worker_cache

WORD = re.compile(r"[^\W_]+")
SPAN = 8                                    # words of a window
ORDINARY_BYTES = 32768                      # size of a trained dictionary
MIN_DOCS = 3                                # toxic documents that a sample must recur in
SEGMENT, MATCH = 24, 6                      # bytes of the trainer's segments of toxic samples, and of what it counts in them
SCORES = (3.0, 5.0, 8.0, 12.0)              # least standard scores to choose from
MARGINS = (1, 2, 3, 4)                      # least differences of a hit to choose from
SAMPLES = 40_000                            # ordinary windows that train the ordinary dictionary
LEVEL = 15
PAD = b"\n" * 24                            # ends a window: the coder looks for no matches in its last bytes
LONGEST = 4096                              # bytes of a window at most; longer ones are cut into several


def words(text: str) -> list[str]:
    return WORD.findall(text.lower())


def windows(text: str) -> list[bytes]:
    found = words(text)
    out = []
    for i in range(0, len(found), SPAN):
        raw = f" {' '.join(found[i:i + SPAN])} ".encode("utf-8", "surrogatepass")
        out.extend(raw[j:j + LONGEST] + PAD for j in range(0, len(raw), LONGEST))
    return out


class Distance:
    """Bytes that the toxic part saves on a window over the ordinary dictionary alone."""

    def __init__(self, toxic: bytes, ordinary: bytes):
        import zstandard as z

        p = z.ZstdCompressionParameters.from_level(LEVEL, format=z.FORMAT_ZSTD1_MAGICLESS, write_content_size=False,
                                                   write_checksum=False, write_dict_id=False)
        self.coders = []
        for content in (toxic + ordinary, ordinary):
            d = z.ZstdCompressionDict(content, dict_type=z.DICT_TYPE_RAWCONTENT)
            d.precompute_compress(compression_params=p)
            self.coders.append(z.ZstdCompressor(dict_data=d, compression_params=p).compress)

    def __call__(self, text: str) -> list[int]:
        both, plain = self.coders
        return [len(plain(w)) - len(both(w)) for w in windows(text)]


@dataclass
class Model:
    base: float                       # score where nothing can be learned
    toxic: bytes = b""
    ordinary: bytes = b""
    margin: int = 1                   # least difference of a hit
    weights: tuple[float, ...] = ()

    def features(self, saved: list[int]) -> list[float]:
        hits, n = sum(v >= self.margin for v in saved), max(1, len(saved))
        return [1.0, float(hits > 0), np.log1p(hits), hits / n, sum(saved) / n]

    def score(self, saved: list[int]) -> float:
        if not self.weights:
            return self.base
        return float(1.0 / (1.0 + np.exp(-np.clip(np.dot(self.weights, self.features(saved)), -30, 30))))


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 0.5, steps: int = 30) -> np.ndarray:
    """Ridge logistic regression by Newton steps (the constant isn't penalised)."""
    w = np.zeros(x.shape[1])
    pull = ridge * np.eye(x.shape[1])
    pull[0, 0] = 1e-6
    for _ in range(steps):
        p = 1.0 / (1.0 + np.exp(-np.clip(x @ w, -30, 30)))
        g = x.T @ (p - y) + pull @ w
        h = (x * (p * (1 - p))[:, None]).T @ x + pull
        step = np.linalg.solve(h, g)
        w -= step
        if np.abs(step).max() < 1e-9:
            break
    return w


def train(texts: list[str]) -> bytes:
    """A trained dictionary of the texts' windows (those with the smallest checksum); windows too few for the
    trainer are the dictionary themselves."""
    import zstandard as z

    samples = sorted((w for t in texts for w in windows(t)), key=zlib.crc32)[:SAMPLES]
    try:
        return z.train_dictionary(ORDINARY_BYTES, samples, level=3).as_bytes()
    except z.ZstdError:
        return b"".join(samples)[-ORDINARY_BYTES:]


def train_toxic(toxic: list[str], ordinary: list[str]) -> list[tuple[float, bytes, int]]:
    """Recurring words and phrases of toxic documents by falling standard score."""
    n, share = len(toxic) + len(ordinary), len(toxic) / (len(toxic) + len(ordinary))
    least = min(MIN_DOCS, len(toxic))
    split = [[words(t) for t in texts] for texts in (ordinary, toxic)]
    found, best, recur = [], {}, None
    for size in range(1, SPAN + 1):
        def phrases(t, size=size, recur=recur):
            out = set(zip(*(t[i:] for i in range(size))))
            return out if recur is None else {p for p in out if p[1:] in recur and p[:-1] in recur}

        df = collections.Counter(p for t in split[1] for p in phrases(t))
        recur = {p for p, c in df.items() if c >= least}  # a longer phrase recurs only if its parts do
        if not recur:
            break
        plain = collections.Counter(p for t in split[0] for p in phrases(t) if p in recur)
        of = {}
        for p in recur:
            c, both = df[p], df[p] + plain[p]
            expected = both * share
            score = float((c - expected) / np.sqrt(expected * (1 - both / n) + 0.5))
            parts = max(best[p[1:]], best[p[:-1]]) if size > 1 else -np.inf
            of[p] = max(score, parts)
            if score >= SCORES[0] and score > parts:
                found.append((score, f" {' '.join(p)} ".encode("utf-8", "surrogatepass"), size))
        best = of
    return sorted(found, key=lambda p: (-p[0], p[1]))


def toxic_parts(texts: list[str], samples: list[bytes]) -> list[bytes]:
    """The maximal stretches of words that the samples cover, text by text."""
    known = {tuple(s.decode("utf-8", "surrogatepass").split(" ")[1:-1]) for s in samples}
    sizes, out = sorted({len(p) for p in known}), []
    for text in texts:
        found = words(text)
        covered = np.zeros(len(found) + 2, bool)
        for n in sizes:
            for i, phrase in enumerate(zip(*(found[j:] for j in range(n)))):
                if phrase in known:
                    covered[i + 1:i + n + 1] = True
        edges = np.flatnonzero(covered[1:] != covered[:-1])
        out.extend(f" {' '.join(found[a:b])} ".encode("utf-8", "surrogatepass") for a, b in zip(edges[::2], edges[1::2]))
    return out


def train_parts(parts: list[bytes]) -> bytes:
    """A trained dictionary of the parts; parts too few for the trainer are the dictionary themselves. The trainer
    stops after a run of ``10 * SEGMENT`` long stretches with nothing new, so a part is given to it in pieces of
    that length, and pieces that a part repeats once."""
    import zstandard as z

    cut = 10 * SEGMENT
    pieces = [w for p in parts for w in dict.fromkeys(p[i:i + cut] for i in range(0, len(p), cut))]
    try:
        return z.train_dictionary(ORDINARY_BYTES, pieces, k=SEGMENT, d=MATCH, level=3).as_bytes()
    except z.ZstdError:
        return b"".join(dict.fromkeys(parts))


def fit(rows: list[tuple[object, str, int]]) -> Model:
    """Learns from (id, text, label) rows: two thirds train the dictionaries, one third the thresholds."""
    rows = sorted(((zlib.crc32(f"fold {i}".encode()), t, y) for i, t, y in rows))
    total = collections.Counter(y for _, _, y in rows)
    model = Model(base=(total[1] + 1.0) / (total[0] + total[1] + 2.0))
    if not total[0] or not total[1]:
        return model
    learn, tune, turn = ([], []), [], collections.Counter()
    for _, t, y in rows:  # thirds within each class, so that both parts have both
        if turn[y] % 3 == 2:
            tune.append((t, y))
        else:
            learn[y].append(t)
        turn[y] += 1
    tune = tune or [(t, y) for y in (0, 1) for t in learn[y]]
    ordinary, toxic = train(learn[0]), train_toxic(learn[1], learn[0])
    y = np.array([v for _, v in tune], float)
    best = None
    chosen = dict.fromkeys(tuple(w for score, w, size in toxic if score >= least and size <= most) for most in (1, SPAN) for least in SCORES)
    for content in [train_parts(toxic_parts(learn[1], samples)) for samples in chosen if samples]:
        if not content or not ordinary:
            continue
        saved = list(map(Distance(content, ordinary), (t for t, _ in tune)))
        for margin in MARGINS:
            trial = Model(model.base, content, ordinary, margin)
            x = np.array([trial.features(v) for v in saved])
            w = _logistic(x, y)
            p = np.clip(1.0 / (1.0 + np.exp(-np.clip(x @ w, -30, 30))), 1e-9, 1 - 1e-9)
            loss = -float(np.mean(y * np.log(p) + (1 - y) * np.log(1 - p)))
            if best is None or loss < best[0] - 1e-12:
                trial.weights = tuple(float(v) for v in w)
                best = (loss, trial)
    return best[1] if best else model


def training_rows(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str, *, modulus: int,
                  held_out: int, max_toxic: int, max_ordinary: int, max_bytes: int) -> list[tuple[object, str, int]]:
    """The labelled sample: of each class the rows with the smallest hash of the id, at most so many and so long."""
    known = labels.select(col(labels, id_col).alias("id"), col(labels, label_col).cast("int").alias("y")).filter("y in (0, 1) and id is not null")
    known = known.filter(id_remainder(F.col("id"), modulus) != held_out).groupBy("id").agg(F.max("y").alias("y"))
    known = known.join(docs.select(col(docs, id_col).alias("id")).distinct(), "id", "left_semi")
    picked = None
    for y, most in ((1, max_toxic), (0, max_ordinary)):
        some = known.filter(F.col("y") == y).orderBy(F.xxhash64("id"), "id").limit(most)
        picked = some if picked is None else picked.unionByName(some)
    texts = docs.select(col(docs, id_col).alias("id"), text_or_empty(col(docs, text_col)).alias("text"))
    # a fixed bound of ids may be broadcast; equal ids are united before the shuffle
    one = texts.join(F.broadcast(picked), "id").groupBy("id", "y").agg(F.min(F.struct(F.xxhash64("text"), "text"))["text"].alias("text"))
    sample, path = pin_at(one, "toxic-sample")
    sizes = sample.select("id", F.octet_length("text").alias("n"), F.xxhash64("id").alias("h")).toArrow().to_pylist()
    kept, left = [], max_bytes
    for r in sorted(sizes, key=lambda r: (r["h"], r["id"])):
        if r["n"] <= left:
            left -= r["n"]
            kept.append(r["id"])
    if len(kept) < len(sizes):
        sample = sample.filter(F.col("id").isin(kept))
    rows = sample.select("id", "text", "y").toArrow()
    unpin(docs.sparkSession, path)
    return list(zip(*(rows.column(i).to_pylist() for i in range(3))))


def score_documents(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    label_col: str = "toxic", *, modulus: int = 5, held_out: int = 0, max_toxic: int = 2000,
                    max_ordinary: int = 4000, max_bytes: int = 64 << 20, keep: bool = False) -> DataFrame:
    """Per document: id, score, hits, n_windows. With ``keep``: all columns of ``docs``, for its rows that score
    below one half."""
    model = fit(training_rows(docs, labels, id_col, text_col, label_col, modulus=modulus, held_out=held_out,
                              max_toxic=max_toxic, max_ordinary=max_ordinary, max_bytes=max_bytes))

    def distance():
        if not model.weights:
            return lambda text: [0] * len(windows(text))
        cache, key = worker_cache(), ("toxicity", model.toxic, model.ordinary)
        if key not in cache:
            cache[key] = Distance(model.toxic, model.ordinary)
        return cache[key]

    def scored(batches):
        measure = distance()
        for b in batches:
            saved = [measure(t.as_py()) for t in b.column(1)]
            yield pa.RecordBatch.from_arrays([
                b.column(0), pa.array([model.score(v) for v in saved], pa.float64()),
                pa.array([sum(x >= model.margin for x in v) for v in saved], pa.int64()),
                pa.array([len(v) for v in saved], pa.int64())], [b.schema.names[0], "score", "hits", "n_windows"])

    def clean(batches):
        measure = distance()
        for b in batches:
            yield b.filter(pa.array([model.score(measure(t.as_py() or "")) < 0.5 for t in b.column(at)], pa.bool_()))

    if keep:
        at = docs.columns.index(text_col)
        return docs.mapInArrow(clean, docs.schema)
    src = docs.select(col(docs, id_col).alias(id_col), text_or_empty(col(docs, text_col)).alias("__text"))
    kind = src.schema[0].dataType.simpleString()
    return src.mapInArrow(scored, f"`{id_col}` {kind}, score double, hits long, n_windows long")
