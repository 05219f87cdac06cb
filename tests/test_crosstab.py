from pyspark.sql import functions as F

from monthwise.operators import crosstab as X
from tests.conftest import rows

QSCHEMA = "SVA_SMS string, PERIODO int, Q long"


def test_dense_grid_fills_missing_cell(spark):
    df = spark.createDataFrame([("a", 202401, 5), ("a", 202402, 6), ("b", 202402, 7)], QSCHEMA)
    g = X.dense_grid(df)
    got = rows(g.select("SVA_SMS", "PERIODO", "Q", "is_missing"))
    assert got == [("a", 202401, 5, False), ("a", 202402, 6, False),
                   ("b", 202401, 0, True), ("b", 202402, 7, False)]


def test_null_label_cells_unmatched_but_in_column_totals(spark):
    df = spark.createDataFrame([(None, 202401, 3), ("a", 202401, 5)], QSCHEMA)
    ct = X.quantity_crosstab(df)
    cells = rows(ct.grid.select("SVA_SMS", "rn", "Q"))
    assert cells == [("a", 2, 5), (None, 1, 0)]
    assert rows(ct.col_totals.select("PERIODO", "total_periodo")) == [(202401, 8)]
    long = {(r.kind, r.label): r.value for r in X.to_long(ct).collect()}
    assert long[("grand_total", None)] == 8.0


def test_crosstab_invariants(spark):
    data = [(f"l{i % 7}", 202401 + (i % 5), i) for i in range(40)]
    df = spark.createDataFrame(data, QSCHEMA).groupBy("SVA_SMS", "PERIODO").agg(F.sum("Q").alias("Q"))
    ct = X.quantity_crosstab(df)
    grid = ct.grid.collect()
    assert len(grid) == 7 * 5                                   # labels x periods
    cell_sum = sum(r.Q for r in grid)
    row_sum = sum(r.total_fila for r in ct.row_totals.collect())
    col = ct.col_totals.collect()
    assert cell_sum == row_sum == sum(r.total_periodo for r in col) == sum(x[2] for x in data)
    assert sorted(r.rn for r in ct.row_totals.collect()) == list(range(1, 8))


def test_top_n_column_totals_cover_only_top(spark):
    data = [(f"l{i}", 202401, 100 - i) for i in range(12)] + [("l0", 202402, 1)]
    df = spark.createDataFrame(data, QSCHEMA)
    ct = X.quantity_crosstab(df, top_n=10)
    tot = dict((r.PERIODO, r.total_periodo) for r in ct.col_totals.collect())
    assert tot == {202401: sum(100 - i for i in range(10)), 202402: 1}
    assert ct.grid.count() == 10 * 2


def test_top_n_period_without_top_rows_is_zero_filled(spark):
    data = [(f"l{i}", 202401, 100 + i) for i in range(10)] + [("small", 202402, 1)]
    ct = X.quantity_crosstab(spark.createDataFrame(data, QSCHEMA), top_n=10)
    tot = {r.PERIODO: (r.total_periodo, r.is_missing) for r in ct.col_totals.collect()}
    assert tot[202402] == (0, True)


def test_mean_crosstab_totals_use_all_labels(spark):
    cells = spark.createDataFrame([("a", 202401, 10.0), ("b", 202401, None)],
                                  "SVA_SMS string, PERIODO int, ARPU double")
    pm = spark.createDataFrame([(202401, 9.0)], "PERIODO int, ARPU double")
    ct = X.mean_crosstab(cells, pm, top_n=1)
    assert rows(ct.grid.select("SVA_SMS", "ARPU")) == [("a", 10.0)]
    assert rows(ct.col_totals.select("PERIODO", "total_periodo")) == [(202401, 9.0)]


def test_column_totals_grand(spark):
    df = spark.createDataFrame([("a", 202401, 5), ("b", 202402, 7)], QSCHEMA)
    assert rows(X.column_totals(df)) == [(202401, 5, 12), (202402, 7, 12)]


def test_given_and_found_periods_agree(spark):
    data = [(None, 202401, 3), ("a", 202401, 5), ("a", 202402, 6), ("b", 202402, 7),
            ("c", 202403, 1)] + [(f"l{i}", 202401, 100 + i) for i in range(10)]
    df = spark.createDataFrame(data, QSCHEMA)
    for top in (None, 3):
        assert rows(X.to_long(X.quantity_crosstab(df, top_n=top))) == rows(
            X.to_long(X.quantity_crosstab(df, top_n=top, periods=[202401, 202402, 202403]))), top
    # the same cells as the long grid
    grid = X.dense_grid(df)
    assert rows(X.quantity_crosstab(df).grid.select("SVA_SMS", "PERIODO", "Q")) == rows(grid.select("SVA_SMS", "PERIODO", "Q"))


def test_null_period_belongs_to_no_cell(spark):
    df = spark.createDataFrame([("a", None, 4), ("a", 202401, 5), ("b", None, 6)], QSCHEMA)
    assert rows(X.dense_grid(df).select("SVA_SMS", "PERIODO", "Q")) == [("a", 202401, 5), ("b", 202401, 0)]
    assert X.dense_grid(df.where("PERIODO = 1")).count() == 0
