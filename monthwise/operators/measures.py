"""Sums by type / label / period and transaction-weighted means.

Every measure here is built from two additive parts, ``SUM(q)`` and
``SUM(q * m)``, so one partial+final aggregation over the fact table serves all
report sections: coarser keys (period-only means, top-n totals) re-aggregate the
small parts instead of re-scanning the facts.  A hot key costs nothing extra:
the partial aggregate collapses it map-side before the shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from monthwise.functions.exact import exact_ratio, scale_of

Q_SUM = "q_sum"
QM_SUM = "qm_sum"


def _list(x) -> list:
    return [x] if isinstance(x, (str, Column)) else list(x)


def sum_by_type(df: DataFrame, period: str = "PERIODO", type_col: str = "TIPO",
                qty: str = "Q_LINEAS_SUSCRITAS", types: Sequence[str] = ("SMSP", "SVA"),
                names: Sequence[str] = ("SMS", "SVA")) -> DataFrame:
    """One row per period with one conditional SUM per type.

    Rows of other types still create their period (with 0 for every listed type).
    """
    aggs = [F.sum(F.when(F.col(type_col) == F.lit(t), F.col(qty)).otherwise(F.lit(0))).alias(n)
            for t, n in zip(types, names)]
    return df.groupBy(period).agg(*aggs)


def sum_by_label(df: DataFrame, type_value: str | None = None, label: str = "SVA_SMS",
                 period: str = "PERIODO", qty: str = "Q_LINEAS_SUSCRITAS",
                 type_col: str = "TIPO", out: str = "Q") -> DataFrame:
    """Filter one type, ``SUM(qty)`` per (label, period)."""
    if type_value is not None:
        df = df.where(F.col(type_col) == F.lit(type_value))
    return df.groupBy(label, period).agg(F.sum(qty).alias(out))


def mean_parts(df: DataFrame, keys, qty: str = "Q_TRANSACCIONES",
               amount: str | None = "MONTO_NETO", amount_total: str | None = None) -> DataFrame:
    """Additive parts of a weighted mean: ``SUM(q)`` and ``SUM(q*m)`` per key.

    Pass ``amount`` for per-transaction amounts or ``amount_total`` for an
    already multiplied ``q*m`` column (pre-aggregated inputs).  A NULL amount
    leaves the numerator but its quantity stays in the denominator.
    """
    prod = F.col(amount_total) if amount_total else F.col(qty) * F.col(amount)
    return df.groupBy(*_list(keys)).agg(F.sum(qty).alias(Q_SUM), F.sum(prod).alias(QM_SUM))


def ratio(num: Column, den: Column, zero: str = "error", digits: int = 0,
          scales: tuple[int, int] | None = None) -> Column:
    """``ROUND(num / den, digits)``, ties away from zero.

    With ``scales``, the decimal places of both (``exact_scales``), integers and decimals are
    divided exactly and the result is a decimal; without, it is computed in DOUBLE.
    ``zero="error"`` raises on a zero denominator (even with ANSI off);
    ``zero="null"`` yields NULL, the ``NULLIF(den, 0)`` form.
    """
    if zero not in ("error", "null"):
        raise ValueError("zero must be 'error' or 'null'")
    if scales is not None:
        q = exact_ratio(num, den, *scales, digits)
    else:
        q = F.round(num.cast("double") / F.nullif(den.cast("double"), F.lit(0.0)), digits)
    if zero == "error":
        failed = F.raise_error(F.lit("DIVIDE_BY_ZERO: weighted mean over a zero quantity"))
        q = F.when(den == 0, failed.cast("double" if scales is None else "decimal(38,0)")).otherwise(q)
    return q


def exact_scales(parts: DataFrame) -> tuple[int, int] | None:
    """Decimal places of the parts of a mean; None if one is a floating-point number."""
    scales = scale_of(parts.schema[QM_SUM].dataType), scale_of(parts.schema[Q_SUM].dataType)
    return None if None in scales else scales


def divided(parts: DataFrame, keys: Sequence, zero: str = "error", out: str = "ARPU", digits: int = 0,
            out_type: str = "double") -> DataFrame:
    """``keys`` and the rounded quotient of the additive parts.  Integers and decimals are
    divided exactly; ``out_type`` says how the result is given (``bigint`` keeps sums
    beyond 2^53 that DOUBLE cannot hold)."""
    q = ratio(F.col(QM_SUM), F.col(Q_SUM), zero, digits, exact_scales(parts))
    return parts.select(*keys, q.cast(out_type).alias(out))


def mean_from_parts(parts: DataFrame, keys, zero: str = "error", out: str = "ARPU",
                    digits: int = 0, out_type: str = "double") -> DataFrame:
    """Re-aggregate additive parts to ``keys`` and divide."""
    keys = _list(keys)
    agg = parts.groupBy(*keys).agg(F.sum(Q_SUM).alias(Q_SUM), F.sum(QM_SUM).alias(QM_SUM))
    return divided(agg, keys, zero, out, digits, out_type)


def weighted_mean(df: DataFrame, keys=("SVA_SMS", "PERIODO"), qty: str = "Q_TRANSACCIONES",
                  amount: str | None = "MONTO_NETO", zero: str = "error", out: str = "ARPU",
                  amount_total: str | None = None, digits: int = 0, out_type: str = "double") -> DataFrame:
    """``ROUND(SUM(q*m) / SUM(q), 0)`` per key (transaction-weighted mean)."""
    keys = _list(keys)
    return divided(mean_parts(df, keys, qty, amount, amount_total), keys, zero, out, digits, out_type)


def weighted_mean_by_period(df: DataFrame, type_value: str | None, period: str = "PERIODO",
                            type_col: str = "TIPO", zero: str = "error", **kw) -> DataFrame:
    """Period-level weighted mean over every label of one type."""
    if type_value is not None:
        df = df.where(F.col(type_col) == F.lit(type_value))
    return weighted_mean(df, [period], zero=zero, **kw)
