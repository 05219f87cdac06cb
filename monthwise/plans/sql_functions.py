"""The report's steps as SQL table functions, for callers that write only SQL.

``register`` defines temporary functions over a view of subscriber rows (PERIODO, TIPO,
SVA_SMS, Q_LINEAS_SUSCRITAS).  They are SQL bodies that Spark inlines, so a call plans
like the DataFrame form: the window's bound is a constant that reaches the scan, and one
partial aggregation serves cells and totals.

    SELECT * FROM monthwise_window(DATE'2001-11-15', 7)
    SELECT * FROM monthwise_sum_by_label('SVA', DATE'2001-11-15', 7)
    SELECT * FROM monthwise_grid('SVA', DATE'2001-11-15', 7)
    SELECT * FROM monthwise_crosstab('SVA', DATE'2001-11-15', 7)
"""

from __future__ import annotations

from pyspark.sql import SparkSession

_BOUND = "CAST(date_format(add_months(as_of, -n_back), 'yyyyMM') AS INT)"
_ROW = "PERIODO INT, SVA_SMS STRING, Q BIGINT"


def _bodies(view: str, prefix: str) -> dict[str, tuple[str, str, str]]:
    """Function name -> (arguments, result columns, body)."""
    day = "as_of DATE, n_back INT"
    return {
        "window": (day, "PERIODO INT, TIPO STRING, SVA_SMS STRING, Q_LINEAS_SUSCRITAS BIGINT",
                   f"SELECT PERIODO, TIPO, SVA_SMS, Q_LINEAS_SUSCRITAS FROM {view} WHERE PERIODO >= {_BOUND}"),
        "sum_by_type": (day, "PERIODO INT, SMS BIGINT, SVA BIGINT",
                        "SELECT PERIODO, SUM(CASE WHEN TIPO = 'SMSP' THEN Q_LINEAS_SUSCRITAS ELSE 0 END), "
                        "SUM(CASE WHEN TIPO = 'SVA' THEN Q_LINEAS_SUSCRITAS ELSE 0 END) "
                        f"FROM {prefix}window(as_of, n_back) GROUP BY PERIODO"),
        "sum_by_label": (f"type STRING, {day}", _ROW,
                         "SELECT PERIODO, SVA_SMS, SUM(Q_LINEAS_SUSCRITAS) "
                         f"FROM {prefix}window(as_of, n_back) WHERE TIPO = type GROUP BY PERIODO, SVA_SMS"),
        # every label x every period: a label's cells are a map, so the facts are not joined again;
        # the list of months is one row
        "grid": (f"type STRING, {day}", f"{_ROW}, is_missing BOOLEAN",
                 "SELECT p, SVA_SMS, coalesce(cells[p], 0), cells[p] IS NULL FROM ("
                 "SELECT SVA_SMS, cells, explode(months) AS p FROM ("
                 "SELECT SVA_SMS, CASE WHEN SVA_SMS IS NOT NULL THEN map_from_entries(collect_list(struct(PERIODO, Q))) END AS cells "
                 f"FROM {prefix}sum_by_label(type, as_of, n_back) GROUP BY SVA_SMS) CROSS JOIN ("
                 f"SELECT collect_set(PERIODO) AS months FROM {prefix}window(as_of, n_back) WHERE TIPO = type))"),
        "crosstab": (f"type STRING, {day}", f"kind STRING, {_ROW}",
                     "SELECT element_at(array('cell', 'row_total', 'col_total', 'grand_total'), CAST(grouping_id(SVA_SMS, PERIODO) AS INT) + 1), "
                     "PERIODO, SVA_SMS, SUM(Q_LINEAS_SUSCRITAS) "
                     f"FROM {prefix}window(as_of, n_back) WHERE TIPO = type GROUP BY CUBE (SVA_SMS, PERIODO)"),
    }


def register(spark: SparkSession, view: str, prefix: str = "monthwise_") -> list[str]:
    """Define the functions over ``view`` (a temporary view or a table); their names."""
    names = []
    for name, (args, columns, body) in _bodies(view, prefix).items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {prefix}{name}({args}) RETURNS TABLE ({columns}) RETURN {body}")
        names.append(f"{prefix}{name}")
    return names
