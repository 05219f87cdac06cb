"""Equivalent DuckDB SQL for each registered query (the correctness oracle).

Written independently of the Spark plans, as plain SQL over the same Parquet
tables.  Markup and captions are the library's constants, so the rendered
sections must match byte for byte.
"""

from __future__ import annotations

from monthwise.operators.render import DEFAULT_THEME as TH
from monthwise.plans import report as RP
from monthwise.plans.catalog import AS_OF, N_BACK, OUTBOX_TO, TOP_N
from monthwise.functions.periods import MONTH_ABBREV_ES, WEEKDAY_NAMES_ES

AS_OF_SQL = f"DATE '{AS_OF.isoformat()}'"
BOUND = f"CAST(strftime({AS_OF_SQL} - INTERVAL {N_BACK} MONTH, '%Y%m') AS INTEGER)"
P = "CAST(year(l_shipdate) * 100 + month(l_shipdate) AS INTEGER)"
TIPO = "CASE l_returnflag WHEN 'A' THEN 'SVA' WHEN 'R' THEN 'SMSP' ELSE 'OTHER' END"
AMT = "CAST(l_extendedprice AS DECIMAL(18,2)) * (1 - CAST(l_discount AS DECIMAL(18,2)))"


def facts(label: str = "supplier") -> str:
    dim, fk, dk, col = {"supplier": ("supplier", "l_suppkey", "s_suppkey", "s_name"),
                        "part_type": ("part", "l_partkey", "p_partkey", "p_type")}[label]
    return f"""facts AS (
  SELECT {P} AS PERIODO, {TIPO} AS TIPO, dim.{col} AS SVA_SMS,
         CAST(l_quantity AS BIGINT) AS Q, {AMT} AS MONTO_NETO, l_orderkey, l_linenumber
  FROM lineitem LEFT JOIN {dim} dim ON lineitem.{fk} = dim.{dk}
  WHERE {P} >= {BOUND})"""


def qty(tipo: str, name: str = "f") -> str:
    return (f"{name} AS (SELECT SVA_SMS, PERIODO, CAST(SUM(Q) AS BIGINT) AS Q FROM facts "
            f"WHERE TIPO = '{tipo}' GROUP BY SVA_SMS, PERIODO)")


def mean_expr(zero: str) -> str:
    den = "CAST(SUM(Q) AS DOUBLE)"
    if zero == "null":
        den = f"NULLIF({den}, 0)"
    return f"ROUND(CAST(SUM(Q * MONTO_NETO) AS DOUBLE) / {den}, 0)"


def means(tipo: str, zero: str, name: str = "m") -> str:
    return (f"{name} AS (SELECT SVA_SMS, PERIODO, {mean_expr(zero)} AS ARPU FROM facts "
            f"WHERE TIPO = '{tipo}' GROUP BY SVA_SMS, PERIODO)")


def period_means(tipo: str, zero: str, name: str = "pm") -> str:
    return (f"{name} AS (SELECT PERIODO, {mean_expr(zero)} AS ARPU FROM facts "
            f"WHERE TIPO = '{tipo}' GROUP BY PERIODO)")


def gd(v: str, prefix: str = "", legacy: bool = False) -> str:
    """Digit grouping of an integer expression (sign kept unless legacy)."""
    body = f"replace(format('{{:,}}', CAST({'abs(' + v + ')' if legacy else v} AS BIGINT)), ',', '.')"
    return f"'{prefix}' || {body}" if prefix else f"({body})"


def rint(v: str) -> str:
    return f"CAST(ROUND({v}) AS BIGINT)"


def rank_alpha(src: str, name: str = "l") -> str:
    return (f"{name} AS (SELECT SVA_SMS, row_number() OVER (ORDER BY SVA_SMS ASC NULLS FIRST) "
            f"AS rn FROM (SELECT DISTINCT SVA_SMS FROM {src}))")


def top_total(src: str, name: str = "top") -> str:
    return (f"{name} AS (SELECT SVA_SMS, total_general, row_number() OVER (ORDER BY total_general "
            f"DESC NULLS LAST, SVA_SMS ASC NULLS FIRST) AS rn FROM (SELECT SVA_SMS, "
            f"CAST(SUM(Q) AS BIGINT) AS total_general FROM {src} GROUP BY SVA_SMS) "
            f"ORDER BY rn LIMIT {TOP_N})")


def top_mean(src: str, name: str = "top") -> str:
    return (f"{name} AS (SELECT SVA_SMS, arpu_promedio, row_number() OVER (ORDER BY arpu_promedio "
            f"DESC NULLS LAST, SVA_SMS ASC NULLS FIRST) AS rn FROM (SELECT SVA_SMS, "
            f"ROUND(AVG(ARPU), 0) AS arpu_promedio FROM {src} GROUP BY SVA_SMS) "
            f"ORDER BY rn LIMIT {TOP_N})")


def grid(labels: str, src: str, value: str, name: str = "g") -> str:
    return (f"{name} AS (SELECT {labels}.rn, {labels}.SVA_SMS, p.PERIODO, "
            f"COALESCE({src}.{value}, 0) AS {value}, ({src}.{value} IS NULL) AS is_missing "
            f"FROM {labels} CROSS JOIN (SELECT DISTINCT PERIODO FROM {src}) p "
            f"LEFT JOIN {src} ON {src}.SVA_SMS = {labels}.SVA_SMS AND {src}.PERIODO = p.PERIODO)")


def on_grid(src_periods: str, totals_sql: str, name: str = "ct") -> str:
    """Period totals placed on the table's period grid, 0-filled."""
    return (f"{name} AS (SELECT p.PERIODO, COALESCE(t.v, 0) AS total_periodo FROM "
            f"(SELECT DISTINCT PERIODO FROM {src_periods}) p LEFT JOIN ({totals_sql}) t "
            f"ON t.PERIODO = p.PERIODO)")


def qty_crosstab_ctes(tipo: str, top: bool, label: str = "supplier") -> str:
    if top:
        return ",\n".join([
            facts(label), qty(tipo), top_total("f", "lab"), grid("lab", "f", "Q"),
            on_grid("f", "SELECT PERIODO, SUM(Q) AS v FROM f WHERE SVA_SMS IN "
                         "(SELECT SVA_SMS FROM lab) GROUP BY PERIODO"),
            "rt AS (SELECT rn, SVA_SMS, total_general AS v FROM lab)"])
    return ",\n".join([
        facts(label), qty(tipo), rank_alpha("f", "lab"), grid("lab", "f", "Q"),
        on_grid("f", "SELECT PERIODO, SUM(Q) AS v FROM f GROUP BY PERIODO"),
        "rt AS (SELECT rn, SVA_SMS, SUM(Q) AS v FROM g GROUP BY rn, SVA_SMS)"])


def mean_crosstab_ctes(tipo: str, zero: str, top: bool, label: str = "supplier") -> str:
    lab = top_mean("m", "lab") if top else rank_alpha("m", "lab")
    return ",\n".join([
        facts(label), means(tipo, zero), period_means(tipo, zero), lab, grid("lab", "m", "ARPU"),
        on_grid("m", "SELECT PERIODO, ARPU AS v FROM pm")])


def qty_crosstab_long(tipo: str, top: bool, label: str = "supplier") -> str:
    return f"""WITH {qty_crosstab_ctes(tipo, top, label)}
SELECT 'cell' AS kind, CAST(rn AS BIGINT) AS rn, SVA_SMS AS label, PERIODO AS period,
       CAST(Q AS DOUBLE) AS value FROM g
UNION ALL SELECT 'row_total', CAST(rn AS BIGINT), SVA_SMS, NULL, CAST(v AS DOUBLE) FROM rt
UNION ALL SELECT 'col_total', NULL, NULL, PERIODO, CAST(total_periodo AS DOUBLE) FROM ct
UNION ALL SELECT 'grand_total', NULL, NULL, NULL, CAST(SUM(total_periodo) AS DOUBLE) FROM ct"""


def mean_crosstab_long(tipo: str, zero: str, top: bool) -> str:
    return f"""WITH {mean_crosstab_ctes(tipo, zero, top)}
SELECT 'cell' AS kind, CAST(rn AS BIGINT) AS rn, SVA_SMS AS label, PERIODO AS period,
       CAST(ARPU AS DOUBLE) AS value FROM g
UNION ALL SELECT 'col_total', NULL, NULL, PERIODO, CAST(total_periodo AS DOUBLE) FROM ct"""


# -- rendering -------------------------------------------------------------------

def sq(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def td(expr: str, label: bool = False) -> str:
    return f"{sq(TH.td_label if label else TH.td)} || {expr} || {sq(TH.td_end)}"


def header_sql(src: str, first: tuple[str, ...], total: bool) -> str:
    lead = "".join(f"{TH.th}{t}{TH.th_end}" for t in first)
    tail = f"{TH.th}Total{TH.th_end}" if total else ""
    return (f"(SELECT {sq(TH.header_open + lead)} || string_agg({sq(TH.th)} || "
            f"CAST(PERIODO AS VARCHAR) || {sq(TH.th_end)}, '' ORDER BY PERIODO) || "
            f"{sq(tail + TH.tr_end)} FROM (SELECT DISTINCT PERIODO FROM {src}))")


def section_sql(title: str, ctes: str, value: str, first: tuple[str, ...], show_rank: bool,
                money: bool, caption: str, row_total: bool, grand: bool) -> str:
    prefix = "$ " if money else ""
    cell = td(gd(rint(f"COALESCE({value}, 0)"), prefix))
    zebra = f"CASE WHEN rn % 2 = 0 THEN {sq(TH.even)} ELSE {sq(TH.odd)} END"
    row = f"'<tr style=\"background:' || {zebra} || ';\">'"
    if show_rank:
        row += f" || {td('CAST(rn AS VARCHAR)', True)}"
    row += f" || {td('SVA_SMS', True)} || celdas"
    if row_total:
        row += f" || {td(gd('v'))}"
    row += f" || {sq(TH.tr_end)}"
    span = ' colspan="2"' if show_rank else ""
    tot_head = f"{TH.total_open}<td{span}>{caption}{TH.td_end}"
    tot_cell = td(gd(rint("COALESCE(total_periodo, 0)"), prefix))
    totals = (f"(SELECT {sq(tot_head)} || string_agg({tot_cell}, '' ORDER BY PERIODO)"
              + (f" || {td(gd('CAST(SUM(total_periodo) AS BIGINT)'))}" if grand else "")
              + f" || {sq(TH.tr_end)} FROM ct)")
    rows_src = ("(SELECT c.*, rt.v FROM cells c JOIN rt ON rt.rn = c.rn)" if row_total
                else "cells")
    return f"""(WITH {ctes},
cells AS (SELECT rn, SVA_SMS, string_agg({cell}, '' ORDER BY PERIODO) AS celdas
          FROM g GROUP BY rn, SVA_SMS)
SELECT {sq(TH.title_open + title + TH.title_end + TH.table_open)}
  || COALESCE({header_sql('g', first, row_total)}, '')
  || COALESCE((SELECT string_agg({row}, '' ORDER BY rn) FROM {rows_src}), '')
  || COALESCE({totals}, '')
  || {sq(TH.table_end)})"""


def chart_sql() -> str:
    bt = (f"bt AS (SELECT PERIODO, CAST(SUM(CASE WHEN TIPO = 'SMSP' THEN Q ELSE 0 END) AS BIGINT) "
          f"AS SMS, CAST(SUM(CASE WHEN TIPO = 'SVA' THEN Q ELSE 0 END) AS BIGINT) AS SVA "
          f"FROM facts GROUP BY PERIODO)")
    k = lambda e: f"CAST({rint(e + ' / 1000')} AS VARCHAR) || 'k'"
    px = lambda e: f"CAST({rint(e + ' / 2000')} AS VARCHAR)"
    bar = (f"'<td valign=\"bottom\" align=\"center\"><div>' || {k('(SMS + SVA)')} || '</div>'"
           f" || '<div style=\"background:{TH.bar_sva};height:' || {px('SVA')} || 'px;\">' || {k('SVA')}"
           f" || '</div>' || '<div style=\"background:{TH.bar_sms};height:' || {px('SMS')} || 'px;\">'"
           f" || {k('SMS')} || '</div>' || '<div>' || CAST(PERIODO AS VARCHAR) || '</div></td>'")
    title = ReportCfg.chart_title
    return (f"(WITH {facts()}, {bt} SELECT '<table><tr><td colspan=\"99\">{title}</td></tr><tr>' "
            f"|| COALESCE(string_agg({bar}, '' ORDER BY PERIODO), '') || '</tr></table>' FROM bt)")


ReportCfg = RP.ReportConfig()


def sections_sql(label: str = "supplier") -> list[tuple[int, str, str]]:
    return [
        (0, "chart", chart_sql()),
        (1, "sva_qty", section_sql(RP.TITLE_SVA_QTY, qty_crosstab_ctes("SVA", False, label), "Q",
                                   ("SVA",), False, False, RP.CAPTION_TOTAL, True, True)),
        (2, "smsp_qty", section_sql(RP.TITLE_SMSP_QTY, qty_crosstab_ctes("SMSP", True, label), "Q",
                                    ("#", "SMSP"), True, False, RP.CAPTION_TOTAL_TOP, True, True)),
        (3, "sva_mean", section_sql(RP.TITLE_SVA_MEAN,
                                    mean_crosstab_ctes("SVA", "error", False, label),
                                    "ARPU", ("SVA",), False, True, RP.CAPTION_MEAN, False, False)),
        (4, "smsp_mean", section_sql(RP.TITLE_SMSP_MEAN,
                                     mean_crosstab_ctes("SMSP", "null", True, label),
                                     "ARPU", ("#", "SMSP"), True, True, RP.CAPTION_MEAN, False,
                                     False)),
    ]


def report_sections_sql(label: str = "supplier") -> str:
    return "\nUNION ALL\n".join(f"SELECT {o} AS ord, '{n}' AS name, {s} AS html"
                                for o, n, s in sections_sql(label))


def mail_sql() -> str:
    body = (f"{sq(ReportCfg.intro)} || (SELECT string_agg(COALESCE(html, ''), '' ORDER BY ord) "
            f"FROM ({report_sections_sql()})) || {sq(ReportCfg.outro)}")
    subject = f"{sq(RP.SUBJECT_PREFIX)} || strftime({AS_OF_SQL}, '%Y%m%d') || {sq(RP.SUBJECT_SUFFIX)}"
    html = (f"'<html><body><h2>' || {sq(RP.REPORT_TITLE)} || '</h2><p>' || "
            f"strftime({AS_OF_SQL}, '%d-%m-%Y') || '</p>' || {body} || {sq(ReportCfg.button)} "
            f"|| '</body></html>'")
    return f"SELECT {subject} AS SUBJECT, {html} AS BODY"


# -- gates, outbox, exports --------------------------------------------------------------

def calendar_cte() -> str:
    names = " ".join(f"WHEN {i + 1} THEN '{n}'" for i, n in enumerate(WEEKDAY_NAMES_ES))
    return (f"cal AS (SELECT DIA_FECHA, CASE isodow(DIA_FECHA) {names} END AS DAYNAMELONG FROM "
            f"(SELECT DISTINCT CAST(l_shipdate AS DATE) AS DIA_FECHA FROM lineitem))")


OUTBOX_CTE = """ob AS (
  SELECT CAST(ts AS DATE) AS FECHA, 'u' || CAST(user_id AS VARCHAR) AS PARA,
         CAST(NULL AS VARCHAR) AS CC, event_type || ' ' || strftime(ts, '%Y%m%d') AS SUBJECT,
         props AS BODY, CASE WHEN value >= 5 THEN 'N' ELSE 'S' END AS PROCESADO
  FROM events)"""


def oracle_sql() -> dict[str, str]:
    run_days = "('LUNES', 'VIERNES')"
    month_case = " ".join(f"WHEN {i + 1} THEN '{m}'" for i, m in enumerate(MONTH_ABBREV_ES))
    q: dict[str, str] = {}
    q["trailing_months"] = (f"WITH {facts()} SELECT PERIODO, TIPO, SVA_SMS, Q AS "
                            f"Q_LINEAS_SUSCRITAS FROM facts")
    q["period_key"] = (f"SELECT {P} AS PERIODO, CAST(COUNT(*) AS BIGINT) AS n_rows "
                       f"FROM lineitem GROUP BY 1")
    q["sum_by_type"] = (f"WITH {facts()} SELECT PERIODO, "
                        f"CAST(SUM(CASE WHEN TIPO = 'SMSP' THEN Q ELSE 0 END) AS BIGINT) AS SMS, "
                        f"CAST(SUM(CASE WHEN TIPO = 'SVA' THEN Q ELSE 0 END) AS BIGINT) AS SVA "
                        f"FROM facts GROUP BY PERIODO")
    q["sum_by_label_sva"] = f"WITH {facts()}, {qty('SVA')} SELECT * FROM f"
    q["sum_by_label_smsp"] = f"WITH {facts()}, {qty('SMSP')} SELECT * FROM f"
    q["weighted_mean_label"] = f"WITH {facts()}, {means('SVA', 'error')} SELECT * FROM m"
    q["weighted_mean_period"] = f"WITH {facts()}, {period_means('SVA', 'error')} SELECT * FROM pm"
    q["weighted_mean_zero_null"] = f"WITH {facts()}, {means('SMSP', 'null')} SELECT * FROM m"
    q["weighted_mean_rows"] = q["weighted_mean_zero_null"]
    edge = facts().replace("dim.s_name AS SVA_SMS", "CASE WHEN l_suppkey % 5 <> 0 THEN dim.s_name END AS SVA_SMS") \
        .replace("CAST(l_quantity AS BIGINT) AS Q", "CASE WHEN l_suppkey % 7 = 0 THEN 0 ELSE CAST(l_quantity AS BIGINT) END AS Q") \
        .replace(f"{AMT} AS MONTO_NETO", f"CASE WHEN l_suppkey % 11 <> 0 THEN {AMT} END AS MONTO_NETO")
    q["weighted_mean_edges"] = f"WITH {edge}, {means('SMSP', 'null')} SELECT * FROM m"
    q["crosstab_edges"] = qty_crosstab_long("SMSP", False).replace(facts(), edge)
    q["rank_orders"] = ("SELECT o_totalprice, o_orderkey, o_orderpriority, row_number() OVER (ORDER BY o_totalprice "
                        "DESC NULLS LAST, o_orderkey) AS rn FROM orders")
    q["first_per_key"] = (f"WITH {facts()} SELECT SVA_SMS, PERIODO, TIPO, Q AS Q_TRANSACCIONES, "
                          f"l_orderkey, l_linenumber FROM facts QUALIFY row_number() OVER "
                          f"(PARTITION BY SVA_SMS, PERIODO ORDER BY MONTO_NETO DESC, "
                          f"l_orderkey DESC, l_linenumber DESC) = 1")
    q["top_n_by_total"] = (f"WITH {facts()}, {qty('SMSP')}, {top_total('f')} "
                           f"SELECT SVA_SMS, total_general, CAST(rn AS BIGINT) AS rn FROM top")
    q["top_n_by_mean"] = (f"WITH {facts()}, {means('SMSP', 'null')}, {top_mean('m')} "
                          f"SELECT SVA_SMS, arpu_promedio, CAST(rn AS BIGINT) AS rn FROM top")
    q["rank_labels"] = (f"WITH {facts()}, {qty('SVA')}, {rank_alpha('f')} "
                        f"SELECT SVA_SMS, CAST(rn AS BIGINT) AS rn FROM l")
    grid_ctes = f"{facts()}, {qty('SMSP')}, lab AS (SELECT DISTINCT SVA_SMS, 0 AS rn FROM f), {grid('lab', 'f', 'Q')}"
    q["dense_grid"] = f"WITH {grid_ctes} SELECT SVA_SMS, PERIODO, Q, is_missing FROM g"
    q["row_totals"] = (f"WITH {grid_ctes} SELECT SVA_SMS, CAST(SUM(Q) AS BIGINT) AS total_fila "
                       f"FROM g GROUP BY SVA_SMS")
    q["column_totals"] = (f"WITH {facts()}, {qty('SVA')}, t AS (SELECT PERIODO, CAST(SUM(Q) AS "
                          f"BIGINT) AS total_periodo FROM f GROUP BY PERIODO) SELECT PERIODO, "
                          f"total_periodo, CAST(SUM(total_periodo) OVER () AS BIGINT) AS "
                          f"gran_total FROM t")
    q["column_totals_of_top"] = (f"WITH {facts()}, {qty('SMSP')}, {top_total('f')}, t AS (SELECT "
                                 f"PERIODO, CAST(SUM(Q) AS BIGINT) AS total_periodo FROM f WHERE "
                                 f"SVA_SMS IN (SELECT SVA_SMS FROM top) GROUP BY PERIODO) SELECT "
                                 f"PERIODO, total_periodo, CAST(SUM(total_periodo) OVER () AS "
                                 f"BIGINT) AS gran_total FROM t")
    q["crosstab_sva_qty"] = qty_crosstab_long("SVA", False)
    q["crosstab_smsp_qty_top10"] = qty_crosstab_long("SMSP", True)
    q["crosstab_sva_mean"] = mean_crosstab_long("SVA", "error", False)
    q["crosstab_smsp_mean_top10"] = mean_crosstab_long("SMSP", "null", True)
    q["crosstab_narrow_qty"] = qty_crosstab_long("SVA", False, "part_type")
    cents = rint("c_acctbal * 100")
    q["group_digits"] = (f"SELECT c_custkey, {cents} AS cents, {gd(cents)} AS grouped, "
                         f"{gd(cents, '$ ')} AS money FROM customer")
    q["group_digits_legacy"] = f"SELECT c_custkey, {gd(cents, legacy=True)} AS grouped FROM customer"
    q["stacked_bar_geometry"] = (
        f"WITH {facts()}, bt AS (SELECT PERIODO, CAST(SUM(CASE WHEN TIPO = 'SMSP' THEN Q ELSE 0 END)"
        f" AS BIGINT) AS SMS, CAST(SUM(CASE WHEN TIPO = 'SVA' THEN Q ELSE 0 END) AS BIGINT) AS SVA "
        f"FROM facts GROUP BY PERIODO) SELECT PERIODO, SMS, SVA, SMS + SVA AS total, "
        f"{rint('SVA / 2000')} AS sva_px, {rint('SMS / 2000')} AS sms_px, "
        f"CAST({rint('(SMS + SVA) / 1000')} AS VARCHAR) || 'k' AS total_label, "
        f"CAST({rint('SVA / 1000')} AS VARCHAR) || 'k' AS sva_label, "
        f"CAST({rint('SMS / 1000')} AS VARCHAR) || 'k' AS sms_label FROM bt")
    q["kilo_label"] = (f"SELECT o_orderkey, CAST({rint('o_totalprice / 1000')} AS VARCHAR) || 'k' "
                       f"AS kilo, {rint('o_totalprice / 2000')} AS px FROM orders")
    q["zebra_rows"] = (f"WITH {facts()}, {qty('SVA')}, {rank_alpha('f')} SELECT SVA_SMS, "
                       f"CAST(rn AS BIGINT) AS rn, CASE WHEN rn % 2 = 0 THEN {sq(TH.even)} "
                       f"ELSE {sq(TH.odd)} END AS background FROM l")
    q["ordered_concat_cells"] = (
        f"WITH {qty_crosstab_ctes('SMSP', True)} SELECT SVA_SMS, CAST(rn AS BIGINT) AS rn, "
        f"string_agg({td(gd(rint('COALESCE(Q, 0)')))}, '' ORDER BY PERIODO) AS celdas "
        f"FROM g GROUP BY SVA_SMS, rn")
    q["ordered_concat_header"] = (f"WITH {facts()}, {qty('SVA')} SELECT "
                                  f"{header_sql('f', ('SVA',), True)} AS html")
    q["report_sections"] = report_sections_sql()
    q["report_sections_narrow"] = report_sections_sql("part_type")
    q["template_hook"] = mail_sql()
    q["has_recent_data"] = (f"SELECT {AS_OF_SQL} AS as_of, CAST(COUNT(*) AS BIGINT) AS num_rows, "
                            f"COUNT(*) > 0 AS has_data FROM lineitem WHERE {P} >= {BOUND}")
    lookup = f"(SELECT DAYNAMELONG FROM cal WHERE DIA_FECHA = {AS_OF_SQL})"
    q["calendar_gate"] = (f"WITH {calendar_cte()} SELECT {AS_OF_SQL} AS as_of, {lookup} AS "
                          f"DAYNAMELONG, COALESCE({lookup} IN {run_days}, false) AS gate_open")
    one_day = (f"SELECT d AS as_of, (SELECT DAYNAMELONG FROM cal WHERE DIA_FECHA = d) AS DAYNAMELONG, COALESCE((SELECT "
               f"DAYNAMELONG FROM cal WHERE DIA_FECHA = d) IN {run_days}, false) AS gate_open FROM days")
    q["calendar_gate_days"] = (
        f"WITH {calendar_cte()}, days AS (SELECT MAX(DIA_FECHA) AS d FROM cal WHERE DAYNAMELONG IN {run_days} UNION ALL "
        f"SELECT MAX(DIA_FECHA) FROM cal WHERE DAYNAMELONG NOT IN {run_days} UNION ALL "
        f"SELECT MAX(DIA_FECHA) + 1 FROM cal) {one_day}")
    bound_of = ("CAST(year(DIA_FECHA - INTERVAL 7 MONTH) * 100 + month(DIA_FECHA - INTERVAL 7 MONTH)"
                " AS INTEGER)")
    q["gate_schedule"] = (
        f"WITH {calendar_cte()}, mx AS (SELECT MAX({P}) AS mp FROM lineitem), "
        f"d AS (SELECT DIA_FECHA, DAYNAMELONG, COALESCE((SELECT mp FROM mx) >= {bound_of}, false) "
        f"AS has_data FROM cal) SELECT DIA_FECHA, DAYNAMELONG, has_data, has_data AND "
        f"COALESCE(DAYNAMELONG IN {run_days}, false) AS gate_open FROM d")
    q["local_date_offset"] = ("SELECT CAST(ts AS DATE) AS utc_date, "
                              "CAST(ts - INTERVAL 3 HOUR AS DATE) AS local_date, "
                              "CAST(COUNT(*) AS BIGINT) AS n_events FROM events GROUP BY 1, 2")
    q["outbox_row"] = (f"SELECT {AS_OF_SQL} AS FECHA, {sq(OUTBOX_TO)} AS PARA, CAST(NULL AS VARCHAR)"
                       f" AS CC, SUBJECT, BODY, 'N' AS PROCESADO FROM ({mail_sql()})")
    inc = (f"inc AS (SELECT MAX(FECHA) AS FECHA, {sq(OUTBOX_TO)} AS PARA, CAST(NULL AS VARCHAR) AS CC,"
           f" SUBJECT, 'resend ' || SUBJECT AS BODY, 'N' AS PROCESADO FROM ob WHERE "
           f"FECHA = (SELECT MAX(FECHA) FROM ob) GROUP BY SUBJECT)")
    q["replace_by_key"] = (f"WITH {OUTBOX_CTE}, {inc} SELECT * FROM ob WHERE NOT EXISTS (SELECT 1 "
                           f"FROM inc WHERE inc.SUBJECT = ob.SUBJECT) UNION ALL SELECT FECHA, PARA, "
                           f"CC, SUBJECT, BODY, PROCESADO FROM inc")
    q["pending"] = f"WITH {OUTBOX_CTE} SELECT * FROM ob WHERE PROCESADO = 'N'"
    q["mark_processed"] = (f"WITH {OUTBOX_CTE}, sent AS (SELECT DISTINCT SUBJECT FROM ob WHERE "
                           f"PROCESADO = 'N' AND FECHA < (SELECT MAX(FECHA) FROM ob)) SELECT FECHA, PARA, "
                           f"CC, SUBJECT, BODY, CASE WHEN PROCESADO = 'N' AND SUBJECT IN (SELECT "
                           f"SUBJECT FROM sent) THEN 'S' ELSE PROCESADO END AS PROCESADO FROM ob")
    q["outbox_drain"] = q["mark_processed"]
    q["outbox_store_null_dates"] = (
        f"WITH {OUTBOX_CTE}, nd AS (SELECT CASE WHEN length(BODY) % 4 <> 0 THEN FECHA END AS FECHA, PARA, CC, SUBJECT, "
        f"BODY, PROCESADO FROM ob), inc AS (SELECT CASE WHEN substr(SUBJECT, -2, 1) <> '1' THEN MAX(FECHA) END AS FECHA, "
        f"{sq(OUTBOX_TO)} AS PARA, CAST(NULL AS VARCHAR) AS CC, SUBJECT, 'resend ' || SUBJECT AS BODY, 'N' AS PROCESADO "
        f"FROM nd WHERE right(SUBJECT, 1) = '3' GROUP BY SUBJECT), after AS (SELECT * FROM nd WHERE SUBJECT NOT IN "
        f"(SELECT SUBJECT FROM inc) UNION ALL SELECT * FROM inc) SELECT FECHA, PARA, CC, SUBJECT, BODY, CASE WHEN "
        f"PROCESADO = 'N' AND right(SUBJECT, 1) IN ('3', '5', '8') THEN 'S' ELSE PROCESADO END AS PROCESADO FROM after")
    q["export_csv_roundtrip"] = "SELECT * FROM orders"
    q["export_documents_roundtrip"] = "SELECT * FROM documents"
    month = f"strftime({AS_OF_SQL} - INTERVAL 1 MONTH, '%y')"
    q["export_tables_contents"] = " UNION ALL ".join(
        f"SELECT 'Parque_' || (CASE month({AS_OF_SQL} - INTERVAL 1 MONTH) {month_case} END) || '_' || {month} AS folder, "
        f"'{n.upper()}' AS sheet, CAST({k} AS BIGINT) AS key, {v} AS name, CAST({r} AS BIGINT) AS ref FROM {n}"
        for n, k, v, r in (("region", "r_regionkey", "r_name", "NULL"), ("nation", "n_nationkey", "n_name", "n_regionkey"),
                           ("supplier", "s_suppkey", "s_name", "s_nationkey")))
    q["export_tables_counts"] = " UNION ALL ".join(
        f"SELECT '{n.upper()}' AS sheet, '{n}' AS table_name, CAST(COUNT(*) AS BIGINT) AS n_rows "
        f"FROM {n}" for n in ("region", "nation", "supplier"))
    q["previous_month_label"] = (
        f"SELECT d, (CASE month(d - INTERVAL 1 MONTH) {month_case} END) || '_' || "
        f"strftime(d - INTERVAL 1 MONTH, '%y') AS label FROM (SELECT DISTINCT "
        f"CAST(o_orderdate AS DATE) AS d FROM orders)")
    from monthwise.plans import oracle_stores
    return q | oracle_stores.oracle_sql()
