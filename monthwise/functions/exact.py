"""Division of exact numbers, rounded half away from zero without a detour over DOUBLE.

A quotient in DOUBLE loses what is beyond 53 bits: sums above 2^53 change, and a tie
such as 2.5 may come out on either side.  Quotient and remainder of integers decide it.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DecimalType, IntegralType

INTEGER = "decimal(38,0)"


def scale_of(kind: DataType) -> int | None:
    """Decimal places of an exact type, None for one that is not exact."""
    if isinstance(kind, DecimalType):
        return kind.scale
    return 0 if isinstance(kind, IntegralType) else None


def scaled(c: Column, scale: int, to: int) -> Column:
    """``c * 10^to`` as an integer, for a column of ``scale`` decimal places, ``scale <= to``.
    Values of up to 32 digits fit; larger ones raise an overflow error, as sums do."""
    whole = (c.cast(f"decimal(38,{scale})") * F.lit(10 ** scale).cast("decimal(38,0)") if scale else c).cast(INTEGER)
    return (whole * F.lit(10 ** (to - scale)).cast("decimal(38,0)")).cast(INTEGER) if to > scale else whole


def round_half_away(n: Column, d: Column) -> Column:
    """``ROUND(n / d)`` of integers (decimal(38,0)), ties away from zero; NULL if d is 0."""
    d = F.nullif(d, F.lit(0).cast(INTEGER))
    r = n % d                                              # has the sign of n
    quotient = ((n - r).cast(INTEGER) / d).cast(INTEGER)   # divides evenly
    up = F.abs(r) >= F.abs(d) - F.abs(r)
    away = F.when((n < 0) == (d < 0), F.lit(1)).otherwise(F.lit(-1))
    return (quotient + F.when(up, away).otherwise(F.lit(0))).cast(INTEGER)


def exact_ratio(num: Column, den: Column, num_scale: int, den_scale: int, digits: int = 0) -> Column:
    """``ROUND(num / den, digits)`` as a decimal; NULL if den is 0."""
    to = max(num_scale, den_scale)
    n = scaled(num, num_scale, to)
    if digits > 0:
        n = (n * F.lit(10 ** digits).cast("decimal(38,0)")).cast(INTEGER)
    q = round_half_away(n, scaled(den, den_scale, to))
    return (q / F.lit(10 ** digits).cast("decimal(38,0)")).cast(f"decimal(38,{min(digits, 6)})") if digits > 0 else q
