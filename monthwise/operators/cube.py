"""All totals of a label x period table from one grouping: cells, row, column and grand totals.

``GROUP BY CUBE (label, period)`` expands each row once for each kind of total in the
task that reads it, reduces there, and shuffles partial sums: one scan and one shuffle for
what ``dense_grid``, ``row_totals`` and ``column_totals`` take from three passes over the
label parts.  ``grouping_id`` tells a total from a label or period that is NULL.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from monthwise.operators import measures as M

KINDS = ("cell", "row_total", "col_total", "grand_total")     # by grouping_id(label, period)


def cube_sums(facts: DataFrame, sums: dict[str, Column | str], label: str = "SVA_SMS", period: str = "PERIODO",
              null_label_matches: bool = False) -> DataFrame:
    """Rows (kind, label, label_is_null, period, *sums): the present cells of a table and its totals.

    As in the tables: rows without a period stand in no cell and no row total, and count in the
    column totals (as a NULL period) and the grand total.  A NULL label counts in both too;
    its own cells and row total are 0, because NULL matches no label, unless ``null_label_matches``.
    ``label_is_null`` marks its rows; in column and grand totals it is false and ``label`` NULL.
    """
    dated = F.col(period).isNotNull()
    aggs = [F.sum(c).alias(f"_all_{name}") for name, c in sums.items()] + \
        [F.sum(F.when(dated, F.col(c) if isinstance(c, str) else c)).alias(f"_dated_{name}") for name, c in sums.items()]
    out = facts.cube(label, period).agg(F.grouping_id().alias("_g"), F.count_if(dated).alias("_n"), *aggs)
    own = F.col("_g") < 2                                      # the label is one, not all labels
    in_table = ((F.col("_g") == 0) & dated) | ((F.col("_g") == 1) & (F.col("_n") > 0)) | (F.col("_g") >= 2)

    def value(name: str) -> Column:
        v = F.when(own, F.col(f"_dated_{name}")).otherwise(F.col(f"_all_{name}"))
        if null_label_matches:
            return v.alias(name)
        return F.when(own & F.col(label).isNull(), F.lit(0).cast(out.schema[f"_all_{name}"].dataType)).otherwise(v).alias(name)
    return out.where(in_table).select(
        F.element_at(F.array(*[F.lit(k) for k in KINDS]), F.col("_g").cast("int") + 1).alias("kind"), F.col(label),
        (own & F.col(label).isNull()).alias("label_is_null"), F.col(period), *[value(name) for name in sums])


def cube_quantities(facts: DataFrame, label: str = "SVA_SMS", period: str = "PERIODO", value: str = "Q",
                    null_label_matches: bool = False) -> DataFrame:
    """Cells, row totals, column totals and grand total of a quantity table."""
    return cube_sums(facts, {value: value}, label, period, null_label_matches)


def cube_means(facts: DataFrame, label: str = "SVA_SMS", period: str = "PERIODO", qty: str = "Q_TRANSACCIONES",
               amount: str = "MONTO_NETO", zero: str = "error", out: str = "ARPU") -> DataFrame:
    """Weighted means of a table's cells, labels, periods (over all labels) and of the whole, from
    the same grouping: both parts of a mean are sums.  A NULL label has means of its own."""
    parts = cube_sums(facts, {M.Q_SUM: qty, M.QM_SUM: F.col(qty) * F.col(amount)}, label, period, True)
    return M.divided(parts, ["kind", label, "label_is_null", period], zero, out)
