"""Sampling and splitting with a seeded hash order: reproducible, exact in size, distributed.

Random order = ``seeded_hash(seed, key)`` (60 bits of md5). Fixed-size samples are a top-k by that
order (``TakeOrderedAndProject``: each task keeps k rows, no full sort). Exact-size splits find the (hash, key) of
the last row of the first side by counting rows per hash prefix (plans/selection.py) and are then one filter: no row is
sorted or exchanged, and the other side is the same filter negated.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalar import seeded_hash
from ..plans.selection import Cut, hash_cut, key_cut


def _key(key_cols) -> list[str]:
    return [key_cols] if isinstance(key_cols, str) else list(key_cols)


def random_order(df: DataFrame, key_cols, seed: int = 42, out: str = "_h") -> DataFrame:
    keys = _key(key_cols)
    k = F.col(keys[0]) if len(keys) == 1 else F.concat_ws("|", *[F.col(c).cast("string") for c in keys])
    return df.withColumn(out, seeded_hash(seed, k))


def sample_n(df: DataFrame, n: int, key_cols, seed: int = 42) -> DataFrame:
    """n rows without replacement, uniformly at random (all rows if fewer)."""
    keys = _key(key_cols)
    return random_order(df, keys, seed).orderBy("_h", *keys).limit(int(n)).drop("_h")


def limit_rows(df: DataFrame, n: int, order_by=None) -> DataFrame:
    """LIMIT n; ordered by a key when given so that the rows are reproducible."""
    if order_by:
        df = df.orderBy(*_key(order_by))
    return df.limit(int(n))


def _hash_cut(df: DataFrame, key_cols, seed: int, fraction: float, rounding) -> Cut:
    keys = _key(key_cols)
    k = F.col(keys[0]) if len(keys) == 1 else F.concat_ws("|", *[F.col(c).cast("string") for c in keys])
    return hash_cut(df, [seeded_hash(seed, k), *[F.col(c) for c in keys]], fraction, rounding=rounding)


def exact_split(df: DataFrame, key_cols, test_fraction: float = 0.2, seed: int = 42,
                split_col: str = "split", train_tag: str = "TRAIN", test_tag: str = "TEST") -> DataFrame:
    """One table tagged TRAIN / TEST: test gets ceil(fraction * n) rows, train the rest.

    The order is hash of ``key_cols``, then the keys. Rows that share a key are told apart by their other columns where
    the cut falls among them; rows equal in every column stay on one side.
    """
    cut = _hash_cut(df, key_cols, seed, test_fraction, math.ceil)
    return df.withColumn(split_col, F.when(cut.taken, F.lit(test_tag)).otherwise(F.lit(train_tag)))


def fraction_sample(df: DataFrame, key_cols, fraction: float, seed: int = 5, flag_col: str = "in_sample") -> DataFrame:
    """Flag exactly round(fraction * n) rows (pandas ``sample(frac=)`` size); the rest is the complement."""
    cut = _hash_cut(df, key_cols, seed, fraction, lambda n: math.floor(n + 0.5))
    return df.withColumn(flag_col, cut.taken)


def sample_and_rest(df: DataFrame, key_cols, fraction: float, seed: int = 5) -> tuple[DataFrame, DataFrame]:
    """The flagged rows of :func:`fraction_sample` and its complement: two filters of one scan each, no join."""
    cut = _hash_cut(df, key_cols, seed, fraction, lambda n: math.floor(n + 0.5))
    return df.where(cut.taken), df.where(~cut.taken)


def complement(df: DataFrame, taken: DataFrame, key_cols) -> DataFrame:
    """Rows of ``df`` whose key is not in ``taken``."""
    return df.join(taken.select(*_key(key_cols)), _key(key_cols), "left_anti")


def concat_rows(*frames: DataFrame) -> DataFrame:
    """Concatenate by column name."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def blank_first_rows(df: DataFrame, n: int, cols, order_cols) -> DataFrame:
    """Set ``cols`` to null on the first ``n`` rows in key order (a row rank needs an explicit key)."""
    first = key_cut(df, [F.col(c) for c in _key(order_cols)], n).taken
    blank = set(_key(cols))
    return df.select(*[F.when(first, F.lit(None).cast(df.schema[c].dataType)).otherwise(F.col(c)).alias(c) if c in blank
                       else F.col(c) for c in df.columns])


def gaussian_noise(key: Column, seed: int = 0, sd: float = 1.0) -> Column:
    """Reproducible N(0, sd) per row by Box-Muller on two seeded hashes of the key."""
    u1 = (seeded_hash(f"{seed}a", key).cast("double") + 1.0) / F.lit(float(2 ** 60) + 1.0)
    u2 = seeded_hash(f"{seed}b", key).cast("double") / F.lit(float(2 ** 60))
    return F.lit(float(sd)) * F.sqrt(-2.0 * F.log(u1)) * F.cos(F.lit(2 * math.pi) * u2)
