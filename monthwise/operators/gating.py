"""Run gates: data present in the window, and a business-calendar weekday."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from monthwise.functions.periods import (DEFAULT_RUN_DAYS, as_of_col, period_bound, period_key,
                                         weekday_name)
from monthwise.operators.window import trailing_months


def recent_row_count(df: DataFrame, period: str = "PERIODO", as_of=None, n_back: int = 7,
                     date_col: str | None = None) -> DataFrame:
    """One row: ``as_of``, ``num_rows`` in the trailing window, ``has_data``."""
    w = trailing_months(df, period, as_of, n_back, date_col)
    return w.agg(F.count(F.lit(1)).alias("num_rows")).select(
        as_of_col(as_of).alias("as_of"), "num_rows", (F.col("num_rows") > 0).alias("has_data"))


def has_recent_data(df: DataFrame, period: str = "PERIODO", as_of=None, n_back: int = 7,
                    date_col: str | None = None) -> bool:
    """Driver-side gate: is there any row in the window?  Reads at most one row."""
    return not trailing_months(df, period, as_of, n_back, date_col).isEmpty()


def calendar_from_dates(df: DataFrame, date_col: str) -> DataFrame:
    """Distinct days of a date/timestamp column with their Spanish weekday name."""
    days = df.select(F.to_date(date_col).alias("DIA_FECHA")).distinct()
    return days.select("DIA_FECHA", weekday_name("DIA_FECHA").alias("DAYNAMELONG"))


def calendar_gate(calendar: DataFrame, as_of=None, days: Sequence[str] = DEFAULT_RUN_DAYS,
                  date_col: str = "DIA_FECHA", name_col: str = "DAYNAMELONG") -> DataFrame:
    """One row: the calendar's weekday name for ``as_of`` and whether it is a run day.

    The lookup is a scalar subquery: no calendar row gives a NULL name and a
    closed gate (``gate_open`` false); two rows for the day raise an error.
    """
    name = calendar.where(F.col(date_col) == as_of_col(as_of)).select(name_col).scalar()
    one = calendar.sparkSession.range(1).select(as_of_col(as_of).alias("as_of"),
                                                name.alias(name_col))
    return one.select("as_of", name_col,
                      F.coalesce(F.col(name_col).isin(list(days)), F.lit(False)).alias("gate_open"))


def gate_schedule(calendar: DataFrame, facts: DataFrame | None = None, period: str = "PERIODO",
                  n_back: int = 7, days: Sequence[str] = DEFAULT_RUN_DAYS,
                  date_col: str = "DIA_FECHA", name_col: str = "DAYNAMELONG") -> DataFrame:
    """The trigger's decision for every calendar day.

    ``COUNT(*) > 0`` over ``period >= bound(day)`` with no upper bound is the same
    as ``MAX(period) >= bound(day)``, so one global max (a scalar subquery)
    decides the data gate for all days at once.  Without ``facts`` the calendar holds
    the days that have facts, and the maximum is taken over its rows (one for a
    day), so the facts behind it are scanned once.
    """
    if facts is None:
        max_period = F.max(period_key(date_col)).over(Window.partitionBy())
    else:
        max_period = facts.select(F.max(period)).scalar()
    bound = period_key(F.add_months(F.col(date_col), -n_back))
    with_max = calendar.select(date_col, name_col, max_period.alias("_max"))
    has_data = F.coalesce(F.col("_max") >= bound, F.lit(False))
    return with_max.select(
        date_col, name_col, has_data.alias("has_data"),
        (has_data & F.coalesce(F.col(name_col).isin(list(days)), F.lit(False))).alias("gate_open"))


__all__ = ["calendar_from_dates", "calendar_gate", "gate_schedule", "has_recent_data",
           "period_bound", "recent_row_count"]
