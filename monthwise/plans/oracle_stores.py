"""DuckDB SQL for the queries of ``catalog_stores``."""

from __future__ import annotations

from monthwise.functions.periods import WEEKDAY_NAMES_ES
from monthwise.plans import oracle as OR
from monthwise.plans.catalog import OUTBOX_TO

ALL_FACTS = f"""facts AS (
  SELECT {OR.P} AS PERIODO, {OR.TIPO} AS TIPO, s_name AS SVA_SMS, CAST(l_quantity AS BIGINT) AS Q, {OR.AMT} AS MONTO_NETO
  FROM lineitem LEFT JOIN supplier ON l_suppkey = s_suppkey)"""
EDGE_ROWS = f"""edge AS (
  SELECT {OR.P} AS PERIODO, {OR.TIPO} AS TIPO, CASE WHEN l_suppkey % 5 <> 0 THEN s_name END AS SVA_SMS,
         CASE WHEN l_suppkey % 7 = 0 THEN 0 ELSE CAST(l_quantity AS BIGINT) END AS Q,
         CASE WHEN l_suppkey % 11 <> 0 THEN {OR.AMT} END AS M
  FROM lineitem LEFT JOIN supplier ON l_suppkey = s_suppkey WHERE {OR.P} >= {OR.BOUND})"""
KIND = "CASE GROUPING(SVA_SMS, PERIODO) WHEN 0 THEN 'cell' WHEN 1 THEN 'row_total' WHEN 2 THEN 'col_total' ELSE 'grand_total' END"
NULL_LABEL = "(GROUPING(SVA_SMS) = 0 AND SVA_SMS IS NULL)"


def _half_away(n: str, d: str) -> str:
    """ROUND(n / d) of HUGEINT expressions by quotient and remainder."""
    return f"(sign({n}) * sign({d}) * (abs({n}) // abs({d}) + CASE WHEN 2 * (abs({n}) % abs({d})) >= abs({d}) THEN 1 ELSE 0 END))"


def _layout_days(cond: str) -> str:
    names = "['" + "', '".join(WEEKDAY_NAMES_ES) + "']"
    return f"""cal AS (SELECT DISTINCT CAST(l_shipdate AS DATE) AS d FROM lineitem),
named AS (SELECT d, {names}[isodow(d)] AS w FROM cal),
picked AS (SELECT {cond} FROM named)"""


def oracle_sql() -> dict[str, str]:
    num, den = "CAST(10000 * SUM(Q * M) AS HUGEINT)", "CAST(10000 * SUM(Q) AS HUGEINT)"
    return {
        "month_parts": f"""WITH {ALL_FACTS}
SELECT PERIODO, TIPO, SVA_SMS, CAST(SUM(Q) AS BIGINT) AS Q, CAST(SUM(Q * MONTO_NETO) AS DECIMAL(38,4)) AS QM
FROM facts GROUP BY ALL""",
        "crosstab_sva_qty_from_parts": OR.qty_crosstab_long("SVA", False),
        "crosstab_smsp_mean_from_parts": OR.mean_crosstab_long("SMSP", "null", True),
        "cube_quantities": f"""WITH {EDGE_ROWS}
SELECT {KIND} AS kind, SVA_SMS, {NULL_LABEL} AS label_is_null, PERIODO,
       CASE WHEN {NULL_LABEL} THEN 0 ELSE CAST(SUM(Q) AS BIGINT) END AS Q_TRANSACCIONES
FROM edge WHERE TIPO = 'SMSP' GROUP BY CUBE (SVA_SMS, PERIODO)""",
        "cube_means": f"""WITH {EDGE_ROWS}
SELECT {KIND} AS kind, SVA_SMS, {NULL_LABEL} AS label_is_null, PERIODO,
       CASE WHEN SUM(Q) <> 0 THEN CAST({_half_away(num, den)} AS DOUBLE) END AS ARPU
FROM edge WHERE TIPO = 'SMSP' GROUP BY CUBE (SVA_SMS, PERIODO)""",
        "weighted_mean_exact": f"""WITH r AS (
  SELECT l_orderkey, CASE WHEN l_linenumber % 3 = 0 THEN 3 ELSE 1 END AS q,
         CAST(l_linenumber - 4 AS HUGEINT) * 10000000000000000 + l_linenumber * 2 + 1 AS m FROM lineitem),
s AS (SELECT l_orderkey, CAST(SUM(q * m) AS HUGEINT) AS n, CAST(SUM(q) AS HUGEINT) AS d FROM r GROUP BY l_orderkey)
SELECT l_orderkey, CAST({_half_away('n', 'd')} AS BIGINT) AS mean FROM s""",
        "layout_gated_window": f"""WITH {_layout_days("max(d) FILTER (WHERE w IN ('LUNES', 'VIERNES')) AS day")}
SELECT 'open' AS gate, {OR.P} AS PERIODO, {OR.TIPO} AS TIPO, CAST(SUM(CAST(l_quantity AS BIGINT)) AS BIGINT) AS Q, count(*) AS n_rows
FROM lineitem, picked WHERE {OR.P} >= CAST(strftime(day - INTERVAL 7 MONTH, '%Y%m') AS INTEGER) GROUP BY ALL""",
        "layout_run_months": f"""WITH {_layout_days("CAST(year(d) * 100 + month(d) AS INTEGER) AS m")}
SELECT {OR.P} AS PERIODO, CAST(SUM(CAST(l_quantity AS BIGINT)) AS BIGINT) AS Q, count(*) AS n_rows
FROM lineitem WHERE {OR.P} IN (SELECT m FROM (
  SELECT CAST(year(d) * 100 + month(d) AS INTEGER) AS m FROM named WHERE w = 'LUNES' AND day(d) = 31)) GROUP BY ALL""",
        "outbox_store_by_sketch": f"""WITH {OR.OUTBOX_CTE},
again AS (SELECT SUBJECT, max(FECHA) AS last FROM ob WHERE right(SUBJECT, 1) IN ('4', '7') GROUP BY SUBJECT),
placed AS (
  SELECT FECHA, PARA, CC, SUBJECT, BODY, PROCESADO FROM ob WHERE SUBJECT NOT IN (SELECT SUBJECT FROM again)
  UNION ALL
  SELECT CAST(last + INTERVAL 1 DAY AS DATE), '{OUTBOX_TO}', NULL, SUBJECT, 'moved ' || SUBJECT, 'N' FROM again)
SELECT FECHA, PARA, CC, SUBJECT, BODY,
       CASE WHEN PROCESADO = 'N' AND right(SUBJECT, 1) IN ('2', '7') THEN 'S' ELSE PROCESADO END AS PROCESADO FROM placed""",
        "salted_label_join": f"""SELECT s_name AS SVA_SMS, PERIODO, CAST(SUM(Q) AS BIGINT) AS Q, count(*) AS n_rows FROM (
  SELECT {OR.P} AS PERIODO, CAST(l_quantity AS BIGINT) AS Q, CASE l_orderkey % 3 WHEN 0 THEN 1 WHEN 1 THEN l_suppkey END AS k FROM lineitem)
LEFT JOIN supplier ON k = s_suppkey GROUP BY ALL""",
        "bucketed_label_join": f"""SELECT s_name AS SVA_SMS, {OR.P} AS PERIODO, CAST(SUM(CAST(l_quantity AS BIGINT)) AS BIGINT) AS Q,
       CAST(SUM(CAST(l_quantity AS BIGINT) * {OR.AMT}) AS DECIMAL(38,4)) AS QM
FROM lineitem LEFT JOIN supplier ON l_suppkey = s_suppkey GROUP BY l_suppkey, s_name, 2""",
        "ordered_text_parts": """WITH r AS (
  SELECT row_number() OVER (ORDER BY o_totalprice DESC NULLS LAST, o_orderkey) AS rn,
         '<tr><td>' || CAST(o_orderkey AS VARCHAR) || '</td><td>' || o_orderpriority || '</td></tr>' AS x FROM orders),
p AS (SELECT CAST((rn - 1) // 100 AS BIGINT) AS part, string_agg(x, '' ORDER BY rn) AS t FROM r WHERE x IS NOT NULL GROUP BY 1)
SELECT part, CAST(coalesce(SUM(length(t)) OVER (ORDER BY part ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS offset,
       CAST(length(t) AS BIGINT) AS n_chars, md5(t) AS text_md5 FROM p""",
        "export_manifest_check": """SELECT 'ok' AS status, CAST(count(*) AS BIGINT) AS n_rows, CAST(count(*) AS BIGINT) AS found_rows,
       1 AS bounded FROM documents""",
        "sql_crosstab": f"""WITH {OR.facts()}
SELECT {KIND} AS kind, PERIODO, SVA_SMS, CAST(SUM(Q) AS BIGINT) AS Q FROM facts WHERE TIPO = 'SVA' GROUP BY CUBE (SVA_SMS, PERIODO)""",
        "sql_grid": f"""WITH {OR.facts()}, {OR.qty('SMSP')}
SELECT p.PERIODO, l.SVA_SMS, CAST(coalesce(f.Q, 0) AS BIGINT) AS Q, f.Q IS NULL AS is_missing
FROM (SELECT DISTINCT SVA_SMS FROM f) l CROSS JOIN (SELECT DISTINCT PERIODO FROM f) p
LEFT JOIN f ON f.SVA_SMS = l.SVA_SMS AND f.PERIODO = p.PERIODO""",
        "sql_sum_by_type": f"""WITH {OR.facts()}
SELECT PERIODO, CAST(SUM(CASE WHEN TIPO = 'SMSP' THEN Q ELSE 0 END) AS BIGINT) AS SMS,
       CAST(SUM(CASE WHEN TIPO = 'SVA' THEN Q ELSE 0 END) AS BIGINT) AS SVA FROM facts GROUP BY PERIODO""",
    }
