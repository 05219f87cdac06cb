"""Ordered text aggregation and report fragments.

Fragments are produced where their inputs are bounded: a label's cells (one per
period), a header (one per period), a chart (one bar per period).  Joining the
rows of a section, whose count grows with the labels, uses ``tree_concat``:
rows are concatenated in fixed-size chunks in parallel, then the chunks, so no
task ever concatenates more than ``fanout`` pieces.

Markup is a parameter (``Theme``); the defaults are plain tags.  NULL rules
follow SQL ``CONCAT`` / ``STRING_AGG``: a NULL piece makes its fragment NULL and
an ordered aggregate skips NULL fragments.  Section assembly coalesces each
section so one empty section does not blank the whole body.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from monthwise.functions.formatting import (bar_height, group_digits, group_digits_sql, kilo_label,
                                           sql_str, zebra_sql)


@dataclass(frozen=True)
class Theme:
    th: str = "<th>"
    th_end: str = "</th>"
    td: str = '<td align="right">'
    td_label: str = "<td>"
    td_end: str = "</td>"
    tr_end: str = "</tr>"
    header_open: str = '<tr class="head">'
    total_open: str = '<tr class="total">'
    table_open: str = '<table border="1" cellspacing="0" cellpadding="4">'
    table_end: str = "</table>"
    title_open: str = "<p><b>"
    title_end: str = "</b></p>"
    even: str = "#eeeeee"
    odd: str = "#ffffff"
    bar_sva: str = "#88aacc"
    bar_sms: str = "#446688"
    missing: str | None = None   # shown for missing cells; None shows the 0 fill


DEFAULT_THEME = Theme()


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _q(name: str) -> str:
    return f"`{name}`"


def ordered_concat(df: DataFrame, keys, order: str, piece: str, out: str = "html",
                   sep: str = "") -> DataFrame:
    """``STRING_AGG(piece, sep ORDER BY order)`` per key (NULL pieces skipped).

    For bounded groups (a label's cells, a header, a top-n).  Unbounded groups
    go through ``tree_concat``.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    sep_sql = sep.replace("'", "''")
    agg = F.expr(f"listagg({_q(piece)}, '{sep_sql}') WITHIN GROUP (ORDER BY {_q(order)})")
    return df.groupBy(*keys).agg(agg.alias(out))


def tree_concat(df: DataFrame, pos: str, piece: str, keys=(), out: str = "html",
                fanout: int = 1024, levels: int = 2) -> DataFrame:
    """Ordered concatenation of any number of pieces by integer position ``pos``.

    Level k groups pieces by ``pos div fanout^k``; each group holds at most
    ``fanout`` pieces; with two levels of 1024 the last step joins at most 1024
    chunks while covering 2^30 pieces per key.
    """
    keys = list(keys)
    cur = df.select(*keys, F.col(pos).cast("bigint").alias("_pos"), F.col(piece).alias("_p"))
    for _ in range(levels):
        cur = cur.withColumn("_grp", F.expr(f"`_pos` div {int(fanout)}"))
        cur = ordered_concat(cur, keys + ["_grp"], "_pos", "_p", out="_p") \
            .withColumnRenamed("_grp", "_pos")
    return ordered_concat(cur, keys, "_pos", "_p", out=out)


# -- cell formatting -----------------------------------------------------------

def cell_text(value: str, is_missing: str | None = None, money: bool = False,
              theme: Theme = DEFAULT_THEME) -> Column:
    """Digit-grouped cell text, ``$ `` prefixed for money; missing cells show
    the 0 fill unless the theme sets a marker."""
    text = group_digits(F.coalesce(_col(value), F.lit(0)), ".", "$ " if money else "")
    if theme.missing is not None and is_missing is not None:
        text = F.when(F.col(is_missing), F.lit(theme.missing)).otherwise(text)
    return text


def td(text: Column, theme: Theme = DEFAULT_THEME, label: bool = False) -> Column:
    return F.concat(F.lit(theme.td_label if label else theme.td), text, F.lit(theme.td_end))


def header_row(periods: DataFrame, period: str = "PERIODO", first: tuple[str, ...] = ("SVA",),
               total: bool = True, theme: Theme = DEFAULT_THEME) -> DataFrame:
    """One-row header: leading titles, one ``<th>`` per period ascending, optional Total."""
    piece = periods.select(period, F.concat(F.lit(theme.th), F.col(period).cast("string"),
                                            F.lit(theme.th_end)).alias("_th"))
    agg = ordered_concat(piece, [], period, "_th", out="_ths")
    lead = "".join(f"{theme.th}{t}{theme.th_end}" for t in first)
    tail = f"{theme.th}Total{theme.th_end}" if total else ""
    return agg.select(F.concat(F.lit(theme.header_open + lead), F.col("_ths"),
                               F.lit(tail + theme.tr_end)).alias("html"))


def cells_row(grid: DataFrame, keys, period: str = "PERIODO", value: str = "Q",
              money: bool = False, theme: Theme = DEFAULT_THEME) -> DataFrame:
    """Per label: its cells as ``<td>`` fragments ordered by period (``celdas``)."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    miss = "is_missing" if "is_missing" in grid.columns else None
    piece = grid.select(*keys, period, td(cell_text(value, miss, money, theme), theme).alias("_td"))
    return ordered_concat(piece, keys, period, "_td", out="celdas")


# -- stacked bar chart --------------------------------------------------------

def stacked_bar_geometry(by_type: DataFrame, period: str = "PERIODO", sms: str = "SMS",
                         sva: str = "SVA", bar_scale: int = 2000, label_scale: int = 1000) -> DataFrame:
    """Per period: bar heights ``ROUND(x / 2000)`` px and ``ROUND(x / 1000)k`` labels."""
    total = F.col(sms) + F.col(sva)
    return by_type.select(
        F.col(period),
        F.col(sms), F.col(sva), total.alias("total"),
        bar_height(sva, bar_scale).alias("sva_px"), bar_height(sms, bar_scale).alias("sms_px"),
        kilo_label(total, label_scale).alias("total_label"),
        kilo_label(sva, label_scale).alias("sva_label"),
        kilo_label(sms, label_scale).alias("sms_label"))


def chart_html(geometry: DataFrame, period: str = "PERIODO", title: str = "Evolution",
               theme: Theme = DEFAULT_THEME) -> DataFrame:
    """One ``<td>`` bar per period, ascending, inside a one-row table."""
    bar = F.concat(
        F.lit('<td valign="bottom" align="center"><div>'), F.col("total_label"), F.lit("</div>"),
        F.lit(f'<div style="background:{theme.bar_sva};height:'), F.col("sva_px").cast("string"),
        F.lit('px;">'), F.col("sva_label"), F.lit("</div>"),
        F.lit(f'<div style="background:{theme.bar_sms};height:'), F.col("sms_px").cast("string"),
        F.lit('px;">'), F.col("sms_label"), F.lit("</div>"),
        F.lit("<div>"), F.col(period).cast("string"), F.lit("</div></td>"))
    bars = ordered_concat(geometry.select(period, bar.alias("_bar")), [], period, "_bar", out="_bars")
    return bars.select(F.concat(F.lit(f"<table><tr><td colspan=\"99\">{title}</td></tr><tr>"),
                                F.coalesce(F.col("_bars"), F.lit("")),
                                F.lit("</tr></table>")).alias("html"))


# -- body and template ---------------------------------------------------------

def default_template(title: Column, date: Column, body: Column, button: Column) -> Column:
    """Template hook (title, date, body, button) -> html; callers pass their own."""
    return F.concat(F.lit("<html><body><h2>"), title, F.lit("</h2><p>"), date, F.lit("</p>"),
                    body, button, F.lit("</body></html>"))


def assemble_body(sections: DataFrame, ord_col: str = "ord", html: str = "html",
                  intro: str = "", outro: str = "") -> DataFrame:
    """Sections in ``ord`` order between an intro and an outro, each section
    coalesced to '' so an empty one does not blank the body."""
    pieces = sections.select(ord_col, F.coalesce(F.col(html), F.lit("")).alias("_s"))
    joined = ordered_concat(pieces, [], ord_col, "_s", out="_b")
    return joined.select(F.concat(F.lit(intro), F.coalesce(F.col("_b"), F.lit("")),
                                  F.lit(outro)).alias("body"))


def register_template_function(spark, name: str = "mail_template") -> None:
    """Register the default template as a SQL function (title, date, body, button)."""
    spark.sql(
        f"CREATE OR REPLACE TEMPORARY FUNCTION {name}(title STRING, d STRING, body STRING, "
        "button STRING) RETURNS STRING RETURN concat('<html><body><h2>', title, '</h2><p>', d, "
        "'</p>', body, button, '</body></html>')")


# -- tables from a pivot on a known period list ------------------------------------

def header_html(periods: list, first: tuple[str, ...], total: bool,
                theme: Theme = DEFAULT_THEME) -> str:
    ths = "".join(f"{theme.th}{t}{theme.th_end}" for t in (*first, *map(str, periods)))
    tail = f"{theme.th}Total{theme.th_end}" if total else ""
    return f"{theme.header_open}{ths}{tail}{theme.tr_end}"


def pivot_periods(df: DataFrame, keys, period: str, value: str, periods: list,
                  how: str = "max", prefix: str = "_c") -> DataFrame:
    """One row per key, one column per listed period (NULL where absent).

    A single hash aggregation (partial before the shuffle); ``how`` is ``max``
    for one value per cell or ``sum`` for additive cells.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    fn = "max" if how == "max" else "sum"
    cols = [F.expr(f"{fn}(CASE WHEN `{period}` = {int(p)} THEN `{value}` END)").alias(f"{prefix}{i}")
            for i, p in enumerate(periods)]
    if not cols:
        cols = [F.lit(None).alias(f"{prefix}none")]
    return df.groupBy(*keys).agg(*cols) if keys else df.agg(*cols)


def _td_sql(text_sql: str, theme: Theme, label: bool = False) -> str:
    return f"concat({sql_str(theme.td_label if label else theme.td)}, {text_sql}, {sql_str(theme.td_end)})"


def _cell_sql(col: str, money: bool, theme: Theme = DEFAULT_THEME) -> str:
    text = group_digits_sql(f"coalesce(`{col}`, 0)", ".", "$ " if money else "")
    if theme.missing is not None:
        text = f"CASE WHEN `{col}` IS NULL THEN {sql_str(theme.missing)} ELSE {text} END"
    return text


def table_section(cells: DataFrame, labels: DataFrame, totals: DataFrame, periods: list,
                  title: str, first: tuple[str, ...], show_rank: bool, money: bool,
                  caption: str, row_total: str | None, grand: bool, label: str = "SVA_SMS",
                  period: str = "PERIODO", value: str = "Q", total_value: str = "total",
                  totals_how: str = "max", theme: Theme = DEFAULT_THEME) -> DataFrame:
    """One report table as a one-row ``html`` frame.

    cells:  one row per (label, period) with ``value``
    labels: the labels to show with ``rn`` (and the ``row_total`` column when
            given; ``row_total="cells"`` sums the label's shown cells instead)
    totals: rows with ``period`` and ``total_value``, reduced per period with
            ``totals_how`` (``sum`` of fact rows or ``max`` of one row per period)
    A NULL label matches no cells (``=`` join) and its row renders NULL, which
    the row concatenation skips.  Each row and the totals line are single SQL
    expressions (one parse each), evaluated in whole-stage codegen.
    """
    n = len(periods)
    wide = pivot_periods(cells, label, period, value, periods)
    rows = labels.join(wide, on=label, how="left")
    parts = [sql_str('<tr style="background:'), zebra_sql("rn", theme.even, theme.odd), sql_str(';">')]
    if show_rank:
        parts.append(_td_sql("CAST(rn AS STRING)", theme, label=True))
    parts.append(_td_sql(f"`{label}`", theme, label=True))
    parts += [_td_sql(_cell_sql(f"_c{i}", money, theme), theme) for i in range(n)]
    if row_total == "cells":
        total = " + ".join([f"coalesce(_c{i}, 0)" for i in range(n)] or ["0"])
        parts.append(_td_sql(group_digits_sql(f"({total})"), theme))
    elif row_total is not None:
        parts.append(_td_sql(group_digits_sql(f"`{row_total}`"), theme))
    parts.append(sql_str(theme.tr_end))
    row_html = rows.select(F.col("rn").cast("bigint").alias("pos"),
                           F.expr(f"concat({', '.join(parts)})").alias("h"))

    tot = pivot_periods(totals, [], period, total_value, periods, how=totals_how, prefix="_t")
    span = ' colspan="2"' if show_rank else ""
    tparts = [sql_str(f"{theme.total_open}<td{span}>{caption}{theme.td_end}")]
    tparts += [_td_sql(_cell_sql(f"_t{i}", money, theme), theme) for i in range(n)]
    if grand:
        g = " + ".join([f"coalesce(_t{i}, 0)" for i in range(n)] or ["0"])
        tparts.append(_td_sql(group_digits_sql(f"({g})"), theme))
    tparts.append(sql_str(theme.tr_end))
    tot_html = tot.select(F.lit(1 << 62).cast("bigint").alias("pos"),
                          F.expr(f"concat({', '.join(tparts)})").alias("h"))

    body = tree_concat(row_html.unionByName(tot_html), "pos", "h", out="_b")
    head = f"{theme.title_open}{title}{theme.title_end}{theme.table_open}" + \
        header_html(periods, first, row_total is not None, theme)
    return body.select(F.concat(F.lit(head), F.coalesce(F.col("_b"), F.lit("")),
                                F.lit(theme.table_end)).alias("html"))
