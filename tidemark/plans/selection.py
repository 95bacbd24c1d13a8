"""The first n rows of an order, found as a filter: no sort and no exchange of data rows.

``cut`` finds the key of the n-th row. Rows are counted per interval of the order, the interval that holds the n-th row
is counted again, and so on until it holds few distinct keys; these come to the driver, and the n-th row's key is
read off. The result is a condition on the key columns, so the selection is one filter over the table, and its
complement is the negated filter.

Two ways to cut an interval into smaller ones:

* ``hash_cut`` for a random order: the hash is uniform, so intervals are prefixes of its bits (4096 at a time);
* ``key_cut`` for any sortable keys: a sample of about 4096 keys of the interval gives two keys close around the
  n-th row, and the rows up to them are counted.

Every pass reads the key columns only and brings a bounded number of rows to the driver. Nulls come first. Rows that
are equal on the whole key are told apart by a hash of all their columns when the n-th row falls among them; rows equal in
every column stay together.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

PREFIX_BITS = 12    # counted at a time: 4096 intervals
SAMPLE = 4096
FEW = 10_000        # distinct keys that come to the driver


@dataclass
class Cut:
    """``rows`` of the table, and whether a row is among the first ones."""
    rows: int
    taken: Column


def literal(value, dtype: T.DataType) -> Column:
    return F.lit(value).cast(dtype)


def _struct(exprs) -> Column:
    return F.struct(*[e.alias(f"c{i}") for i, e in enumerate(exprs)])


def _bound(values, types) -> Column:
    return _struct([literal(v, t) for v, t in zip(values, types)])


def _finish(df: DataFrame, exprs, types, inside: Column, k: int):
    """Key of the k-th row of an interval of few distinct keys, the rows before that key, and the rows that have it."""
    names = [f"c{i}" for i in range(len(exprs))]
    counts = df.where(inside).groupBy(*[e.alias(n) for e, n in zip(exprs, names)]).agg(F.count(F.lit(1)).alias("n"))
    before = 0
    for r in counts.orderBy(*[F.col(n).asc_nulls_first() for n in names]).limit(FEW + 1).collect():
        if before + r.n >= k:
            return [r[n] for n in names], before, r.n
        before += r.n
    raise AssertionError("the interval holds fewer rows than were counted")


def _with_ties(df: DataFrame, exprs, types, key, k: int, before: int, ties: int) -> Column:
    """Rows up to ``key``; when only some of the rows with that key belong, those first by a hash of the whole row."""
    me, at = _struct(exprs), _bound(key, types)
    if before + ties == k:
        return me <= at
    # structs compare nulls as equal and first
    whole = F.xxhash64(*[F.col("`" + f.name.replace("`", "``") + "`") for f in df.schema.fields
                         if not isinstance(f.dataType, T.MapType)])
    some = hash_cut(df.where(me == at), [F.shiftrightunsigned(whole, 4)], k - before, split_ties=False)
    return (me < at) | ((me == at) & some.taken)


def hash_cut(df: DataFrame, exprs, n: int | float, bits: int = 60, split_ties: bool = True, rounding=None) -> Cut:
    """The first ``n`` rows by ``exprs``, the first of which is a uniform hash from 0 below 2 ** ``bits`` (or null).

    With ``rounding``, ``n`` is a fraction and ``rounding(fraction * rows)`` the number of rows.
    """
    types = [f.dataType for f in df.select(*[e.alias(f"c{i}") for i, e in enumerate(exprs)]).schema.fields]
    h, inside, shift, total, k = exprs[0], F.lit(True), bits, None, None
    while True:
        step = min(PREFIX_BITS, shift)
        shift -= step
        prefix = F.shiftrightunsigned(h, shift) if shift else h
        rows = df.where(inside).groupBy(prefix.alias("p")).agg(F.count(F.lit(1)).alias("n")).collect()  # at most 4097 rows
        rows.sort(key=lambda r: (r.p is not None, r.p))
        if total is None:
            total = sum(r.n for r in rows)
            k = int(rounding(total * float(n))) if rounding else int(n)
            if k <= 0 or not total:
                return Cut(total, F.lit(False))
            if k >= total:
                return Cut(total, F.lit(True))
        before = 0
        for r in rows:
            if before + r.n >= k:
                break
            before += r.n
        k -= before
        inside = inside & prefix.eqNullSafe(F.lit(r.p).cast("long"))
        if r.n <= FEW or r.p is None or not shift:
            break
    if r.n > FEW:  # one hash value: few keys, or one
        distinct = df.where(inside).select(*exprs).distinct().limit(FEW + 1).count()
        if distinct > FEW:
            return Cut(total, _below(h, r.p) | (inside & key_cut(df.where(inside), exprs, k, split_ties).taken))
    key, before, ties = _finish(df, exprs, types, inside, k)
    if not split_ties:
        return Cut(total, _struct(exprs) <= _bound(key, types))
    return Cut(total, _with_ties(df, exprs, types, key, k, before, ties))


def _below(h: Column, value) -> Column:
    return F.lit(False) if value is None else (h.isNull() | (h < F.lit(value)))


def key_cut(df: DataFrame, exprs, n: int, split_ties: bool = True, seed: int = 1) -> Cut:
    """The first ``n`` rows by ``exprs`` in ascending order, nulls first."""
    types = [f.dataType for f in df.select(*[e.alias(f"c{i}") for i, e in enumerate(exprs)]).schema.fields]
    me = _struct(exprs)
    total = rows = df.count()
    k = int(n)
    if k <= 0 or not total:
        return Cut(total, F.lit(False))
    if k >= total:
        return Cut(total, F.lit(True))
    inside = F.lit(True)
    while rows > FEW:
        seed += 1
        drawn = df.where(inside).select(me.alias("s")).where(F.rand(seed) < min(1.0, SAMPLE / rows))
        drawn = [r.s for r in drawn.orderBy("s").limit(4 * SAMPLE).collect()]
        if not drawn:
            continue
        at, reach = k / rows * len(drawn), 4 * max(1.0, (k / rows * (1 - k / rows) * len(drawn)) ** 0.5)
        a, b = drawn[max(0, int(at - reach))], drawn[min(len(drawn) - 1, int(at + reach))]
        below, upto_a, upto_b = df.where(inside).agg(
            F.count(F.when(me < _bound(a, types), 1)), F.count(F.when(me <= _bound(a, types), 1)),
            F.count(F.when(me <= _bound(b, types), 1))).first()
        # the n-th row lies below a, at a, between a and b, or above b
        if below < k <= upto_a:
            k -= below
            inside = me == _bound(a, types)
            break
        if k <= below:
            rows = below
            inside = inside & (me < _bound(a, types))
        elif k <= upto_b:
            rows, k = upto_b - upto_a, k - upto_a
            inside = (me > _bound(a, types)) & (me <= _bound(b, types))
        else:
            rows, k = rows - upto_b, k - upto_b
            inside = inside & (me > _bound(b, types))
    key, before, ties = _finish(df, exprs, types, inside, k)
    if not split_ties:
        return Cut(total, me <= _bound(key, types))
    return Cut(total, _with_ties(df, exprs, types, key, k, before, ties))
