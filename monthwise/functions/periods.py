"""Month keys, trailing-window bounds and calendar names (Column -> Column).

A period is a month key ``yyyymm`` held as an integer.  The trailing window of the
reports is ``period >= yyyymm(as_of - n_back months)`` with no upper bound.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

# Spanish month abbreviations used in the export file label
# (month number 1..12 in calendar order).
MONTH_ABBREV_ES = ["Ene", "Feb", "Mar", "Abr", "May", "Jun",
                   "Jul", "Ago", "Sep", "Oct", "Nov", "Dic"]

# Spanish weekday names of the business calendar, Monday first,
# upper case without accents.  The report gate runs on LUNES and VIERNES.
WEEKDAY_NAMES_ES = ["LUNES", "MARTES", "MIERCOLES", "JUEVES", "VIERNES", "SABADO", "DOMINGO"]
DEFAULT_RUN_DAYS = ("LUNES", "VIERNES")


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def as_date(as_of) -> dt.date | None:
    """Normalise an ``as_of`` argument (date, datetime, ISO string or None)."""
    if as_of is None or isinstance(as_of, Column):
        return None
    if isinstance(as_of, dt.datetime):
        return as_of.date()
    if isinstance(as_of, dt.date):
        return as_of
    return dt.date.fromisoformat(str(as_of))


def as_of_col(as_of) -> Column:
    """``as_of`` as a DATE column; ``None`` means the query's current date."""
    if isinstance(as_of, Column):
        return as_of
    d = as_date(as_of)
    return F.current_date() if d is None else F.lit(d)


def period_key(date_col) -> Column:
    """DATE/TIMESTAMP -> ``yyyymm`` INT."""
    c = _col(date_col)
    return (F.year(c) * 100 + F.month(c)).cast("int")


def shift_months(year: int, month: int, delta: int) -> tuple[int, int]:
    idx = year * 12 + (month - 1) + delta
    return idx // 12, idx % 12 + 1


def period_bound_value(as_of, n_back: int = 7) -> int | None:
    """The window's first period as a Python int (None when as_of is dynamic)."""
    d = as_date(as_of)
    if d is None:
        return None
    y, m = shift_months(d.year, d.month, -n_back)
    return y * 100 + m


def period_bound(as_of, n_back: int = 7) -> Column:
    """First period of the trailing window as a foldable INT column."""
    v = period_bound_value(as_of, n_back)
    if v is not None:
        return F.lit(v).cast("int")
    return period_key(F.add_months(as_of_col(as_of), -n_back))


def bound_month_start(as_of, n_back: int = 7) -> Column:
    """First day of the window's first month; used as a raw-date companion
    predicate so the window filter reaches the Parquet scan."""
    d = as_date(as_of)
    if d is not None:
        y, m = shift_months(d.year, d.month, -n_back)
        return F.lit(dt.date(y, m, 1))
    return F.trunc(F.add_months(as_of_col(as_of), -n_back), "MM")


def period_of_date_value(d) -> int:
    d = as_date(d)
    return d.year * 100 + d.month


def weekday_name(date_col) -> Column:
    """Spanish weekday name of a date (Monday = LUNES)."""
    # dayofweek: 1 = Sunday ... 7 = Saturday; (dow + 5) % 7 gives Monday = 0.
    idx = (F.dayofweek(_col(date_col)) + 5) % 7
    names = F.array(*[F.lit(n) for n in WEEKDAY_NAMES_ES])
    return F.get(names, idx)


def previous_month_label(date_col) -> Column:
    """``Abr_25`` style label of the month before ``date_col``."""
    prev = F.add_months(_col(date_col), -1)
    months = F.array(*[F.lit(m) for m in MONTH_ABBREV_ES])
    return F.concat(F.get(months, F.month(prev) - 1), F.lit("_"), F.date_format(prev, "yy"))


def local_date(ts_col, offset: str = "-03:00") -> Column:
    """Calendar date of a UTC timestamp seen at a fixed UTC offset."""
    return F.to_date(F.from_utc_timestamp(_col(ts_col), offset))


def yyyymmdd(date_col) -> Column:
    return F.date_format(_col(date_col), "yyyyMMdd")


def dd_mm_yyyy(date_col) -> Column:
    return F.date_format(_col(date_col), "dd-MM-yyyy")
