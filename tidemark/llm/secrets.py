"""Secret scans by multipart credential linking.

Strong candidates (assignments, access identifiers, long hex runs) stand alone. Weak ones (short
identifiers, bare random-looking tokens, short assigned values, endpoints) are common in ordinary text,
so they are reported only when a complementary part lies in the same scope: the interval of a candidate,
widened by ``reach`` code points on both sides and cut at blank lines, must overlap another one's.

Defined cases: a null text is empty and has no spans; rows are independent, so repeated rows and ids
give repeated results; texts of any length are scanned whole; extra columns are ignored.
"""

from __future__ import annotations

import bisect
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import col, text_or_empty

# The base patterns and their least lengths.
ASSIGN = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]{16,}"
ASSIGN_MIN, ACCESS_MIN = 12, 18

BASE_KINDS = ("assign", "access", "hex")
KINDS = BASE_KINDS + ("weak_access", "weak_secret", "endpoint")
ROLE = {"access": 0, "weak_access": 0, "assign": 1, "hex": 1, "weak_secret": 1, "endpoint": 2}

WEAK_ID = (r"""(?i:access_?key_?id|key_?id|client_?id|user(?:_?name)?|login|account)["']?\x20*[:=]\x20*["']?"""
           r"""([A-Za-z0-9@._+-]{3,64})""")
WEAK_TOKEN = r"[A-Za-z0-9+/_-]{20,}={0,2}"
ENDPOINT = r"""https?://[^\s"'<>]+|(?i:host|server|endpoint)["']?\x20*[:=]\x20*["']?[A-Za-z0-9.-]+(?::[0-9]+)?"""
WEAK_ASSIGN_MIN, WEAK_ACCESS_MIN = 6, 10
BLANK_LINE = r"\n[\x20\x09\x0B-\x0D]*\n"

SPANS_TYPE = "array<struct<kind:string,start:long,end:long>>"


class Scanner:
    """Compiled patterns; ``spans(text)`` gives (start, kind index, end) in order."""

    def __init__(self, reach: int):
        c = lambda p: re.compile(p, re.ASCII)
        self.reach = reach
        self.assign, self.access, self.hex = c(ASSIGN), c(ACCESS), c(HEX)
        self.weak_id, self.weak_token, self.endpoint, self.blank = c(WEAK_ID), c(WEAK_TOKEN), c(ENDPOINT), c(BLANK_LINE)

    def candidates(self, text: str):
        base, weak = [], []
        pairs = ":" in text or "=" in text
        if pairs:
            for m in self.assign.finditer(text):
                n = m.end(1) - m.start(1)
                if n >= ASSIGN_MIN:
                    base.append((m.start(), 0, m.end()))
                elif n >= WEAK_ASSIGN_MIN:
                    weak.append((m.start(), 4, m.end()))
            for m in self.weak_id.finditer(text):
                weak.append((m.start(), 3, m.end()))
            for m in self.endpoint.finditer(text):
                weak.append((m.start(), 5, m.end()))
        if "AKIA" in text:
            for m in self.access.finditer(text):
                n = m.end() - m.start()
                if n >= ACCESS_MIN:
                    base.append((m.start(), 1, m.end()))
                elif n >= WEAK_ACCESS_MIN:
                    weak.append((m.start(), 3, m.end()))
        base.extend((m.start(), 2, m.end()) for m in self.hex.finditer(text))
        for m in self.weak_token.finditer(text):
            s = m.group()
            if any(x.isdigit() for x in s) and any(x.islower() for x in s) and any(x.isupper() for x in s):
                weak.append((m.start(), 4, m.end()))
        return base, weak

    def spans(self, text: str):
        base, weak = self.candidates(text)
        if not weak:
            return sorted(base)
        base.sort()
        ends, most = [], 0  # base spans of different kinds may overlap: running maximum of the ends
        for _, _, e in base:
            most = max(most, e)
            ends.append(most)
        starts = [s for s, _, _ in base]
        free = []
        for s, k, e in sorted(set(weak)):
            i = bisect.bisect_left(starts, e)  # base spans that start before e
            if not (i and ends[i - 1] > s):
                free.append((s, k, e))
        return sorted(base + self._linked(text, base, free))

    def _linked(self, text, base, weak):
        """Interval join of the parts by role; a weak part stays if its complement overlaps its scope."""
        cuts = [0]
        for m in self.blank.finditer(text):
            cuts.append(m.end())
        block = lambda p: bisect.bisect_right(cuts, p)
        parts = sorted(base + weak)
        by_role = [[], [], []]
        for s, k, e in parts:
            by_role[ROLE[KINDS[k]]].append((s, e))
        points, tops = [], []
        for role in by_role:
            points.append([s for s, _ in role])
            top, run = [], 0
            for _, e in role:
                run = max(run, e)
                top.append(run)
            tops.append(top)

        def near(role, s, e):
            # a part of this role in the block whose interval meets [s - reach, e + reach]
            b = block(s)
            low = max(s - self.reach, cuts[b - 1])
            high = min(e + self.reach, cuts[b] if b < len(cuts) else len(text))
            i = bisect.bisect_left(points[role], high)
            return i > 0 and tops[role][i - 1] > low

        out = []
        for s, k, e in weak:
            role = ROLE[KINDS[k]]
            if role == 0:
                ok = near(1, s, e)
            elif role == 1:
                ok = near(0, s, e) or near(2, s, e)
            else:
                ok = near(0, s, e) and near(1, s, e)
            if ok:
                out.append((s, k, e))
        return out


def link_credentials(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", reach: int = 200) -> DataFrame:
    """One row per input row: the id and ``spans``, an array of (kind, start, end) in code points, ordered
    by start and kind. Base kinds are always there; weak kinds only when linked within ``reach``."""
    src = df.select(col(df, id_col).alias(id_col), text_or_empty(col(df, text_col)).alias("__t"))
    id_type = src.schema[0].dataType.simpleString()

    def scan(batches):
        scanner = Scanner(reach)
        span = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])
        for b in batches:
            rows = [[{"kind": KINDS[k], "start": s, "end": e} for s, k, e in scanner.spans(t.as_py())]
                    for t in b.column(1)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(rows, pa.list_(span))], [b.schema.names[0], "spans"])

    return src.mapInArrow(scan, f"`{id_col}` {id_type}, spans {SPANS_TYPE}")


def span_digest(found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Counts by base kind, the digest of the base spans, and all spans written as text."""
    written = lambda spans: F.array_join(F.transform(
        spans, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")
    of = lambda k: F.size(F.filter("spans", lambda x: x["kind"] == k)).cast("long")
    base = F.filter("spans", lambda x: x["kind"].isin(*BASE_KINDS))
    return found.select(id_col, of("assign").alias("n_assign"), of("access").alias("n_access"), of("hex").alias("n_hex"),
                        F.sha2(written(base), 256).alias("base_sha256"), written(F.col("spans")).alias("spans"))
