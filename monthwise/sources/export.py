"""Exports: whole tables to CSV (parallel part files) and several tables at once.

Each export is a distributed write from the executors; nothing passes through
the driver.  ``export_tables`` submits the table writes as concurrent Spark jobs.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from monthwise.functions.periods import MONTH_ABBREV_ES, shift_months


# One form for writer and reader: quotes are doubled, white space is kept, NULL is an
# empty field and the empty text a quoted one.
CSV_FORMAT = {"quote": '"', "escape": '"', "lineSep": "\n",
           "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
# What the reader takes an unquoted empty field for; no text holds it.
_NULL_IN = "\0NULL\0"


def export_csv(df: DataFrame, path: str, sep: str = ",", header: bool = True,
               mode: str = "overwrite", compression: str | None = None,
               partition_by: Sequence[str] = ()) -> str:
    """Write ``df`` as CSV part files under ``path`` (header line in each part), in folders
    of ``partition_by`` if given; ``read_csv`` gives back every value."""
    w = df.write.mode(mode).option("header", header).option("sep", sep).options(**CSV_FORMAT) \
        .option("nullValue", "").option("emptyValue", '""')
    if compression:
        w = w.option("compression", compression)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.csv(path)
    return path


def read_csv(spark: SparkSession, path: str, schema: StructType, sep: str = ",",
             header: bool = True, multi_line: bool = True) -> DataFrame:
    """Read an export back with a known schema (no inference pass).  By default a
    value may hold line breaks, and each file is read whole; ``multi_line=False``
    splits files and is right only without such values."""
    return spark.read.schema(schema).option("header", header).option("sep", sep).options(**CSV_FORMAT) \
        .option("nullValue", _NULL_IN).option("emptyValue", "").option("multiLine", multi_line).csv(path)


def export_name(label: str, as_of: dt.date) -> str:
    """``<label>_<previous month>``, such as ``Parque_Abr_25`` for a day in May 2025."""
    y, m = shift_months(as_of.year, as_of.month, -1)
    return f"{label}_{MONTH_ABBREV_ES[m - 1]}_{y % 100:02d}"


def export_tables(spark: SparkSession, tables: Sequence[tuple[DataFrame | str, str]], out_dir: str,
                  fmt: str = "csv", max_parallel: int = 4, name: str | None = None,
                  as_of: dt.date | None = None, **opts) -> list[tuple[str, str]]:
    """Export ``(table, sheet)`` pairs, each under ``out_dir/<sheet>``, or with ``name``
    and ``as_of`` under ``out_dir/<name>_<previous month>/<sheet>``.

    ``table`` is a DataFrame or a catalog table name.  Returns (sheet, path)
    pairs in input order.  The workbook of the original is replaced by one
    folder per sheet; the writes run as concurrent jobs.
    """
    base = out_dir.rstrip("/")
    if name is not None and as_of is not None:
        base = f"{base}/{export_name(name, as_of)}"

    def one(item):
        table, sheet = item
        df = spark.table(table) if isinstance(table, str) else table
        path = f"{base}/{sheet}"
        if fmt == "csv":
            export_csv(df, path, **opts)
        else:
            df.write.mode("overwrite").format(fmt).save(path)
        return sheet, path

    with ThreadPoolExecutor(max_workers=max(1, min(max_parallel, len(tables)))) as pool:
        return list(pool.map(one, tables))
