"""Column expressions shared by the operators. All stay inside built-in functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

HOUR_US = 3_600_000_000


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def micros(ts) -> Column:
    """Microseconds since the epoch of a wall-clock timestamp (the session runs in UTC)."""
    return F.unix_micros(col(ts).cast("timestamp"))


def from_micros(us) -> Column:
    return F.timestamp_micros(col(us)).cast("timestamp_ntz")


def block_of(us: Column, size: int) -> Column:
    """Number of the time block that holds `us` (floor division, also below zero)."""
    return ((us - F.pmod(us, F.lit(size))) / F.lit(size)).cast("bigint")


def parse_timestamp(c) -> Column:
    """Text to wall-clock time in the formats seen in plant files; anything else becomes null."""
    text = col(c).cast("string")
    return F.coalesce(
        text.try_cast("timestamp_ntz"),
        *[F.try_to_timestamp(text, F.lit(p)).cast("timestamp_ntz")
          for p in ("M/d/yyyy H:mm:ss", "M/d/yyyy H:mm", "M/d/yyyy")],
    )


def coerce(c) -> Column:
    """Number or null: text that is no number, and NaN, count as missing."""
    number = col(c).try_cast("double")
    return F.when(~F.isnan(number), number)


def fill_midrange(c, lo: float, hi: float) -> Column:
    return F.coalesce(col(c), F.lit((lo + hi) / 2))


def clip(c, lo: float | None = None, hi: float | None = None) -> Column:
    """Limit to [lo, hi]; null stays null."""
    x = col(c)
    out = x if lo is None else F.greatest(x, F.lit(lo))
    out = out if hi is None else F.least(out, F.lit(hi))
    return F.when(x.isNotNull(), out)


def is_finite(c) -> Column:
    x = col(c)
    return x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf")))


def finite_or_zero(c) -> Column:
    return F.when(is_finite(c), col(c)).otherwise(F.lit(0.0))


def decide(probability, threshold) -> Column:
    """Alarm flag from the unrounded probability."""
    limit = F.lit(threshold) if isinstance(threshold, (int, float)) else col(threshold)
    return (col(probability) >= limit).cast("int")


def ratio(a, b) -> Column:
    """a / b, or 0.0 where b is zero."""
    return F.coalesce(F.try_divide(col(a).cast("double"), col(b).cast("double")), F.lit(0.0))


def minmax_score(c, lo, hi) -> Column:
    """Scale [lo, hi] to [0, 1] and limit to that range."""
    lo, hi = (F.lit(v) if isinstance(v, (int, float)) else v for v in (lo, hi))
    return clip((col(c) - lo) / F.greatest(hi - lo, F.lit(1e-9)), 0.0, 1.0)
