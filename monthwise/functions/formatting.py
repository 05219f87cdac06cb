"""Number formatting for report cells (Column -> Column, all JVM-side)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def round_int(c) -> Column:
    """Round half away from zero, then BIGINT (the cast alone would truncate)."""
    return F.round(_col(c), 0).cast("bigint")


def group_digits(c, sep: str = ".", prefix: str = "", legacy: bool = False) -> Column:
    """``1234567`` -> ``1.234.567`` (optionally ``$ 1.234.567``).

    The value is rounded to an integer first.  The default form keeps the sign
    (``-1234567`` -> ``-1.234.567``); ``legacy=True`` groups the absolute value, since
    the original report shows no minus sign.  NULL in, NULL out.
    """
    whole = round_int(c)
    text = (F.abs(whole) if legacy else whole).cast("string")
    grouped = F.regexp_replace(text, r"\B(?=(\d{3})+$)", sep)
    return F.concat(F.lit(prefix), grouped) if prefix else grouped


def kilo_label(c, scale: int = 1000, suffix: str = "k") -> Column:
    """``ROUND(x / scale)`` as an integer followed by ``k``."""
    return F.concat(round_int(_col(c) / F.lit(scale)).cast("string"), F.lit(suffix))


def bar_height(c, scale: int = 2000) -> Column:
    """Pixel height of a bar: ``ROUND(x / scale)`` as BIGINT."""
    return round_int(_col(c) / F.lit(scale))


def zebra(rn, even: str = "#eeeeee", odd: str = "#ffffff") -> Column:
    """Alternate a row attribute on the parity of a 1-based row number."""
    return F.when(_col(rn) % 2 == 0, F.lit(even)).otherwise(F.lit(odd))


# -- the same formatting as SQL expression text ---------------------------------------
# Used where many cells are built at once: one parsed expression per column
# instead of one driver round trip per function call.

def sql_str(text: str) -> str:
    """A Spark SQL string literal."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def round_int_sql(expr: str) -> str:
    return f"CAST(ROUND({expr}, 0) AS BIGINT)"


def group_digits_sql(expr: str, sep: str = ".", prefix: str = "") -> str:
    text = f"CAST({round_int_sql(expr)} AS STRING)"
    grouped = f"regexp_replace({text}, '\\\\B(?=(\\\\d{{3}})+$)', {sql_str(sep)})"
    return f"concat({sql_str(prefix)}, {grouped})" if prefix else grouped


def zebra_sql(rn: str, even: str = "#eeeeee", odd: str = "#ffffff") -> str:
    return f"CASE WHEN {rn} % 2 = 0 THEN {sql_str(even)} ELSE {sql_str(odd)} END"
