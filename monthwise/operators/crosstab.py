"""Zero-filled label x period grids with row, column and grand totals.

No cross join and no join back to the facts.  ``dense_grid`` gathers each label's
cells into a map (one entry per period, so the group is bounded by the number of
months) and explodes the period list, which gives exactly labels x periods rows.
The report tables pivot one ``groupBy(label)`` on the period list.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from monthwise.operators.ranking import rank_labels, top_n_by_mean, top_n_by_total
from monthwise.operators.render import pivot_periods
from monthwise.session import materialize


def period_values(df: DataFrame, period: str = "PERIODO") -> list[int]:
    """Sorted distinct periods of ``df``: one value for a month, fetched to the driver."""
    return sorted(r[0] for r in df.select(period).where(F.col(period).isNotNull()).distinct().collect())


def dense_grid(facts: DataFrame, label: str = "SVA_SMS", period: str = "PERIODO",
               value: str = "Q", fill=0, periods: list[int] | None = None,
               labels: DataFrame | None = None, null_label_matches: bool = False) -> DataFrame:
    """Every label x every period, the fact value where present, ``fill`` elsewhere.

    ``facts`` holds at most one row per (label, period); rows without a period
    belong to no cell.  Without ``periods`` the facts are written once and both the
    periods and the cells are read from that table.  ``labels`` (default: the
    labels of ``facts``) may carry extra columns such as a rank; they are kept.
    As with an ``=`` join, a NULL label matches no fact, so its cells are filled
    unless ``null_label_matches``.  Output adds ``is_missing``.
    """
    if periods is None:
        facts = materialize(facts.select(label, period, value), "grid-facts")
        periods = period_values(facts, period)
    entry = F.when(F.col(period).isNotNull(), F.struct(F.col(period), F.col(value)))
    cells = facts.groupBy(label).agg(F.map_from_entries(F.collect_list(entry)).alias("_cells"))
    # Label-level join (one row per label on each side); AQE picks broadcast or
    # sort-merge from the measured sizes.
    rows = cells if labels is None else labels.join(cells, on=label, how="left")
    lookup = F.col("_cells")[F.col(period)]
    if not null_label_matches:
        lookup = F.when(F.col(label).isNotNull(), lookup)
    listed = F.array(*[F.lit(int(p)) for p in periods]).cast(f"array<{facts.schema[period].dataType.simpleString()}>")
    out = (rows.select("*", F.explode(listed).alias(period))
           .withColumn("_v", lookup)
           .withColumn("is_missing", F.col("_v").isNull())
           .withColumn(value, F.coalesce(F.col("_v"), F.lit(fill).cast(facts.schema[value].dataType)))
           .drop("_cells", "_v"))
    return out


def row_totals(grid: DataFrame, label="SVA_SMS", value: str = "Q",
               out: str = "total_fila") -> DataFrame:
    """Sum of a label's cells across the period grid (missing cells count 0).
    ``label`` may be a list of columns (e.g. label and rank)."""
    keys = [label] if isinstance(label, str) else list(label)
    return grid.groupBy(*keys).agg(F.sum(F.coalesce(F.col(value), F.lit(0))).alias(out))


def column_totals(df: DataFrame, period: str = "PERIODO", value: str = "Q",
                  out: str = "total_periodo", grand: str = "gran_total") -> DataFrame:
    """Per-period ``SUM(value)`` plus the grand total on every row.  The window runs
    over one row for a month, so the input is read once."""
    per = df.groupBy(period).agg(F.sum(value).alias(out))
    return per.withColumn(grand, F.sum(out).over(Window.partitionBy()))


def column_totals_of_top(df: DataFrame, top: DataFrame, label: str = "SVA_SMS",
                         period: str = "PERIODO", value: str = "Q", **kw) -> DataFrame:
    """Column totals restricted to the labels of a top-n table (``IN (SELECT label FROM top)``)."""
    kept = df.join(top.select(label), on=label, how="left_semi")
    return column_totals(kept, period, value, **kw)


# -- crosstab variants ----------------------------------------------------------

@dataclass
class Crosstab:
    """The parts of one report table.

    grid       label, rn, period, value, is_missing (labels x periods)
    row_totals label, rn, total (None for mean tables)
    col_totals period, total_periodo, is_missing on the table's period grid (a
               period without rows shows 0 rather than dropping its cell);
               the grand total is their sum
    """
    grid: DataFrame
    row_totals: DataFrame | None
    col_totals: DataFrame
    label: str
    period: str
    value: str
    row_total_col: str | None
    col_total_col: str
    grand_col: str | None
    periods: list[int]


def _unpivot(df: DataFrame, keep: list, periods: list, prefix: str, period: str, value: str,
             dtype) -> DataFrame:
    """Wide period columns back to rows (one per listed period), 0-filled."""
    if not periods:
        return df.select(*keep, F.lit(None).cast("int").alias(period),
                         F.lit(0).cast(dtype).alias(value), F.lit(True).alias("is_missing")) \
            .where(F.lit(False))
    entries = [F.struct(F.lit(int(p)).alias(period),
                        F.coalesce(F.col(f"{prefix}{i}"), F.lit(0).cast(dtype)).alias(value),
                        F.col(f"{prefix}{i}").isNull().alias("is_missing"))
               for i, p in enumerate(periods)]
    return df.select(*keep, F.inline(F.array(*entries)))


def pivot_crosstab(facts: DataFrame, labels: DataFrame, totals_src: DataFrame, periods: list,
                   label: str, period: str, value: str, totals_value: str, totals_how: str,
                   row_total: str | None) -> tuple[DataFrame, DataFrame | None, DataFrame]:
    """Grid, row totals and column totals from one ``groupBy(label)`` pivot on a
    known period list plus one global pivot for the totals line.

    ``row_total="cells"`` sums the label's grid cells; another name takes that
    column from ``labels``; None gives no row totals.
    """
    dtype = facts.schema[value].dataType
    wide = pivot_periods(facts, label, period, value, periods, "max", "_c")
    rows = labels.join(wide, on=label, how="left")
    keep = [c for c in labels.columns]
    grid = _unpivot(rows, keep, periods, "_c", period, value, dtype)
    rt = None
    if row_total == "cells":
        total = F.lit(0).cast(dtype)
        for i in range(len(periods)):
            total = total + F.coalesce(F.col(f"_c{i}"), F.lit(0).cast(dtype))
        rt = rows.select(label, "rn", total.alias("total_fila"))
    elif row_total is not None:
        rt = labels.select(label, "rn", row_total)
    tdtype = totals_src.schema[totals_value].dataType
    tot = pivot_periods(totals_src, [], period, totals_value, periods, totals_how, "_t")
    ct = _unpivot(tot, [], periods, "_t", period, "total_periodo", tdtype)
    return grid, rt, ct


def quantity_crosstab(facts: DataFrame, label: str = "SVA_SMS", period: str = "PERIODO",
                      value: str = "Q", top_n: int | None = None, periods=None) -> Crosstab:
    """Quantity table.

    ``top_n=None``: every label, ranked alphabetically (NULL first); row totals
    over the grid; column totals over every fact row (a NULL label counts there
    but has no matching cells).  ``top_n=k``: the k labels with the largest sums
    (label order breaks ties), ranked by sum; row totals are those sums and the
    column totals cover only those k labels.  ``periods``: the table's period
    list if already known (else a subquery finds it).
    """
    periods = period_values(facts, period) if periods is None else list(periods)
    if top_n is None:
        labels = rank_labels(facts.select(label).distinct(), [F.col(label).asc_nulls_first()])
        kept, rt_col, row_total = facts, "total_fila", "cells"
    else:
        labels = top_n_by_total(facts, label, value, top_n)
        kept = facts.join(labels.select(label), label, "left_semi")
        rt_col = row_total = "total_general"
    grid, rt, ct = pivot_crosstab(kept, labels, kept, periods, label, period, value, value, "sum", row_total)
    return Crosstab(grid, rt, ct, label, period, value, rt_col, "total_periodo", "gran_total", periods)


def mean_crosstab(cells: DataFrame, period_means: DataFrame, label: str = "SVA_SMS",
                  period: str = "PERIODO", value: str = "ARPU", top_n: int | None = None,
                  period_value: str = "ARPU", periods=None) -> Crosstab:
    """Mean table: label cells plus a per-period mean row.

    ``cells``: one mean per (label, period); ``period_means``: the weighted mean
    of each period over *all* labels of the type (also when only the top n are
    shown).  ``top_n=k`` ranks labels by the rounded average of their monthly
    means.  The totals row sits on the table's period grid, 0-filled.
    """
    periods = period_values(cells, period) if periods is None else list(periods)
    if top_n is None:
        labels = rank_labels(cells.select(label).distinct(), [F.col(label).asc_nulls_first()])
        kept = cells
    else:
        labels = top_n_by_mean(cells, label, value, top_n).select(label, "rn")
        kept = cells.join(labels.select(label), label, "left_semi")
    grid, _, ct = pivot_crosstab(kept, labels, period_means, periods, label, period, value, period_value, "max", None)
    return Crosstab(grid, None, ct, label, period, value, None, "total_periodo", None, periods)


def _long(kind: str, df: DataFrame, rn, label, period, value) -> DataFrame:
    def c(x, t):
        if x is None:
            return F.lit(None).cast(t)
        return (F.col(x) if isinstance(x, str) else x).cast(t)
    return df.select(F.lit(kind).alias("kind"), c(rn, "bigint").alias("rn"),
                     c(label, "string").alias("label"), c(period, "int").alias("period"),
                     c(value, "double").alias("value"))


def to_long(ct: Crosstab) -> DataFrame:
    """Long rows ``(kind, rn, label, period, value)``; kind is cell, row_total,
    col_total or grand_total."""
    out = _long("cell", ct.grid, "rn", ct.label, ct.period, ct.value)
    if ct.row_totals is not None:
        out = out.unionByName(_long("row_total", ct.row_totals, "rn", ct.label, None,
                                    ct.row_total_col))
    out = out.unionByName(_long("col_total", ct.col_totals, None, None, ct.period,
                                ct.col_total_col))
    if ct.grand_col is not None:
        grand = ct.col_totals.select(F.sum(ct.col_total_col).alias("g"))
        out = out.unionByName(_long("grand_total", grand, None, None, None, "g"))
    return out
