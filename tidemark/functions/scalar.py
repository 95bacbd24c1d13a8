"""Column functions (JVM-side expressions only; no Python UDF)."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# Control characters 0..30 become a space; character 31 is kept.
CONTROL_CHAR_CLASS = "[\\x00-\\x1e]"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def blank_control_chars(c) -> Column:
    """Replace characters 0-30 with a space (31 is not included)."""
    return F.regexp_replace(_c(c), CONTROL_CHAR_CLASS, " ")


def day_string(c) -> Column:
    """``%Y-%m-%d`` text of a date or timestamp."""
    return F.date_format(_c(c), "yyyy-MM-dd")


def millis_string(c) -> Column:
    """Timestamp text with milliseconds, ``%Y_%m_%dT%H_%M_%S_mmmZ`` style used in snapshot names."""
    return F.concat(F.date_format(_c(c), "yyyy_MM_dd'T'HH_mm_ss_SSS"), F.lit("Z"))


def training_window(as_of, days: int) -> tuple[Column, Column]:
    """(earlier, yesterday): yesterday and yesterday minus ``days`` relative to ``as_of``."""
    d = F.to_date(_c(as_of) if not isinstance(as_of, str) else F.lit(as_of))
    yesterday = F.date_sub(d, 1)
    return F.date_sub(yesterday, days), yesterday


def days_before(ts, days: int) -> Column:
    """``ts - INTERVAL days DAY``."""
    return _c(ts) - F.make_interval(days=F.lit(days))


def days_after(ts, days: int) -> Column:
    return _c(ts) + F.make_interval(days=F.lit(days))


def log1p_safe(c) -> Column:
    """``log1p``; -1 gives -inf and below -1 NaN, as numpy does (Spark alone gives NULL)."""
    x = _c(c).cast("double")
    return (
        F.when(x.isNull(), F.lit(None).cast("double"))
        .when(x == -1.0, F.lit(float("-inf")))
        .when(x < -1.0, F.lit(float("nan")))
        .otherwise(F.log1p(x))
    )


def sqrt_safe(c) -> Column:
    """``sqrt``; negative input gives NaN in both numpy and Spark."""
    return F.sqrt(_c(c).cast("double"))


def safe_ratio(num, den) -> Column:
    """Division that yields NULL for a zero denominator instead of raising under ANSI."""
    return F.try_divide(_c(num).cast("double"), _c(den).cast("double"))


def to_timestamp_if_text(c, dtype) -> Column:
    """Parse strings to timestamps; leave date/timestamp columns alone."""
    from pyspark.sql.types import StringType

    return F.to_timestamp(_c(c)) if isinstance(dtype, StringType) else _c(c)


def uri_without_version(c) -> Column:
    """``uri.split('@')[0]``."""
    return F.split_part(_c(c), F.lit("@"), F.lit(1))


def metric_as_double(c) -> Column:
    """Bool metrics become 1.0/0.0, numbers become double."""
    return _c(c).cast("double")


def seeded_hash(seed, *cols) -> Column:
    """Reproducible 60-bit random order: first 15 hex digits of md5(seed || key...).

    The same text expression exists in SQL engines (md5, substr, hex parse), which gives an exact
    oracle for every sampling and split operator.
    """
    parts = [F.lit(str(seed))] + [_c(c).cast("string") for c in cols]
    return F.conv(F.substring(F.md5(F.concat(*parts)), 1, 15), 16, 10).cast("bigint")


def std_normal_cdf(z) -> Column:
    """Standard normal CDF, Abramowitz-Stegun 26.2.17 (abs error < 7.5e-8)."""
    x = _c(z).cast("double")
    ax = F.abs(x)
    t = 1.0 / (1.0 + 0.2316419 * ax)
    poly = t * (0.319381530 + t * (-0.356563782 + t * (1.781477937 + t * (-1.821255978 + t * 1.330274429))))
    upper = F.exp(-ax * ax / 2.0) / F.lit(2.5066282746310002) * poly
    return F.when(x >= 0, 1.0 - upper).otherwise(upper)


def ks_pvalue(d, n, m, terms: int = 10) -> Column:
    """Asymptotic two-sample Kolmogorov-Smirnov p-value.

    lambda = D * sqrt(nm / (n + m)). For lambda < 1.18 the small-lambda series
    1 - sqrt(2 pi)/lambda * sum_k exp(-(2k-1)^2 pi^2 / (8 lambda^2)) is used, otherwise the
    alternating series 2 * sum_k (-1)^(k-1) exp(-2 k^2 lambda^2); both converge within ``terms``.
    """
    nd, md = _c(n).cast("double"), _c(m).cast("double")
    lam = _c(d).cast("double") * F.sqrt(nd * md / (nd + md))
    small = F.lit(0.0)
    large = F.lit(0.0)
    for k in range(1, terms + 1):
        small = small + F.exp(F.lit(-((2 * k - 1) ** 2) * math.pi ** 2 / 8.0) / (lam * lam))
        large = large + F.lit(float((-1) ** (k - 1))) * F.exp(F.lit(-2.0 * k * k) * lam * lam)
    p_small = F.lit(1.0) - F.lit(math.sqrt(2 * math.pi)) / lam * small
    p_large = F.lit(2.0) * large
    p = F.when(lam < 1.18, p_small).otherwise(p_large)
    return F.when(lam <= 0, F.lit(1.0)).otherwise(F.least(F.greatest(p, F.lit(0.0)), F.lit(1.0)))
