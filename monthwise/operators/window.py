"""Trailing-month window filter."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from monthwise.functions.periods import bound_month_start, period_bound


def trailing_months(df: DataFrame, period: str = "PERIODO", as_of=None, n_back: int = 7,
                    date_col: str | None = None) -> DataFrame:
    """Keep ``period >= yyyymm(as_of - n_back months)``; no upper bound.

    When the period is derived from a raw date column, pass ``date_col``: the
    equivalent ``date >= first day of the bound month`` is added so Parquet
    row-group pruning and ``PushedFilters`` apply (a filter on a derived period
    alone only pushes ``IsNotNull``).
    """
    cond = F.col(period) >= period_bound(as_of, n_back)
    if date_col is not None:
        cond = (F.col(date_col) >= bound_month_start(as_of, n_back)) & cond
    return df.where(cond)
