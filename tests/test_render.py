from pyspark.sql import functions as F

from monthwise.operators import render as R
from tests.conftest import rows


def test_tree_concat_matches_python_join(spark):
    n = 2500
    df = spark.createDataFrame([(i, f"<{i}>") for i in range(n)], "pos long, piece string") \
        .repartition(5)
    got = R.tree_concat(df, "pos", "piece", fanout=16, levels=2).first().html
    assert got == "".join(f"<{i}>" for i in range(n))


def test_tree_concat_skips_null_and_keys(spark):
    df = spark.createDataFrame([("a", 2, "y"), ("a", 1, "x"), ("a", 3, None), ("b", 1, "z")],
                               "k string, pos long, piece string")
    assert rows(R.tree_concat(df, "pos", "piece", keys=["k"], fanout=2)) == [("a", "xy"), ("b", "z")]


def test_ordered_concat_orders_and_empty_group_is_null(spark):
    df = spark.createDataFrame([(2, "b"), (1, "a")], "o int, p string")
    assert R.ordered_concat(df, [], "o", "p").first().html == "ab"
    empty = spark.createDataFrame([], "o int, p string")
    assert R.ordered_concat(empty, [], "o", "p").first().html is None


def test_table_section_null_label_row_skipped_and_totals(spark):
    cells = spark.createDataFrame([(None, 202401, 3), ("a", 202401, 1234), ("a", 202402, 5)],
                                  "SVA_SMS string, PERIODO int, Q long")
    labels = spark.createDataFrame([(None, 1), ("a", 2)], "SVA_SMS string, rn long")
    html = R.table_section(cells, labels, cells, [202401, 202402], "T", ("SVA",), False, False,
                           "Total", "cells", True, total_value="Q", totals_how="sum").first().html
    th = R.DEFAULT_THEME
    assert html.startswith(f"{th.title_open}T{th.title_end}{th.table_open}{th.header_open}")
    assert "<th>202401</th><th>202402</th><th>Total</th>" in html
    # the NULL-label row renders NULL and is skipped; label a is row 2 (even -> grey)
    assert html.count("<tr style=") == 1 and "#eeeeee" in html
    assert '<td>a</td><td align="right">1.234</td><td align="right">5</td>' \
           '<td align="right">1.239</td></tr>' in html
    # totals include the NULL label's 3: 1237 and 5, grand 1242
    assert html.endswith('<td align="right">1.237</td><td align="right">5</td>'
                         '<td align="right">1.242</td></tr></table>')


def test_section_with_no_rows_is_not_null(spark):
    cells = spark.createDataFrame([], "SVA_SMS string, PERIODO int, Q long")
    labels = spark.createDataFrame([], "SVA_SMS string, rn long")
    html = R.table_section(cells, labels, cells, [], "Empty", ("SVA",), False, False, "Total",
                           None, False, total_value="Q", totals_how="sum").first().html
    assert html is not None and html.endswith("</table>")


def test_assemble_body_coalesces_empty_section(spark):
    secs = spark.createDataFrame([(0, "a"), (1, None), (2, "c")], "ord int, html string")
    assert R.assemble_body(secs, intro="<", outro=">").first().body == "<ac>"


def test_template_function_sql(spark):
    R.register_template_function(spark, "mail_tpl_test")
    got = spark.sql("SELECT mail_tpl_test('T', '01-01-2024', 'B', '') AS h").first().h
    assert got == spark.range(1).select(R.default_template(
        F.lit("T"), F.lit("01-01-2024"), F.lit("B"), F.lit(""))).first()[0]


def test_missing_marker_in_table_section(spark):
    th = R.Theme(missing="-")
    cells = spark.createDataFrame([("a", 202401, 5), ("b", 202402, 7)],
                                  "SVA_SMS string, PERIODO int, Q long")
    labels = spark.createDataFrame([("a", 1), ("b", 2)], "SVA_SMS string, rn long")
    html = R.table_section(cells, labels, cells, [202401, 202402], "T", ("SVA",), False, False,
                           "Total", None, False, total_value="Q", totals_how="sum",
                           theme=th).first().html
    assert '<td>a</td><td align="right">5</td><td align="right">-</td></tr>' in html
    assert '<td>b</td><td align="right">-</td><td align="right">7</td></tr>' in html
