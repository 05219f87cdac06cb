"""Plan shape: pushdown, pruning, top-k, no cartesian products, one fact scan."""

import re

from monthwise.plans import catalog as C
from monthwise.plans.report import ReportBase
from tests.conftest import SF_SMALL


def plan(df):
    jvm = df.sparkSession.sparkContext._jvm
    return jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")


def test_window_filter_reaches_parquet_scan(spark):
    p = plan(C.QUERIES["trailing_months_q"](spark, SF_SMALL))
    assert "GreaterThanOrEqual(l_shipdate,2001-04-01" in p
    assert "PushedFilters: [IsNotNull(l_shipdate), GreaterThanOrEqual(l_shipdate" in p


def test_base_prunes_columns_and_aggregates_before_label_join(spark):
    b = ReportBase.from_tables(spark, SF_SMALL, C.cfg(), materialize=False)
    p = plan(b.trx)
    assert "ReadSchema: struct<l_suppkey:bigint,l_quantity:double,l_extendedprice:double," \
           "l_discount:double,l_returnflag:string,l_shipdate:timestamp_ntz>" in p
    scans = [ln for ln in p.splitlines() if re.match(r"^\(\d+\) Scan parquet", ln)]
    assert len(scans) == 2                          # lineitem + supplier, once each
    assert "partial_sum" in p


def test_top_n_uses_take_ordered(spark):
    assert "TakeOrderedAndProject" in plan(C.QUERIES["top_n_by_total"](spark, SF_SMALL))


def test_no_cartesian_products(spark):
    for name in ["dense_grid", "crosstab_sva_qty", "crosstab_smsp_mean_top10", "report_sections_q"]:
        df = C.QUERIES[name](spark, SF_SMALL)
        df.collect()
        p = plan(df)
        assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p, name


def scans(p):
    return [ln for ln in p.splitlines() if re.match(r"^\(\d+\) Scan parquet", ln)]


def test_period_totals_need_no_label(spark):
    for name in ("sum_by_type", "weighted_mean_period", "stacked_bar_geometry"):
        p = plan(C.QUERIES[name](spark, SF_SMALL))
        assert len(scans(p)) == 1 and "Join" not in p, name
        assert p.count("hashpartitioning") == 1 and p.count("\n(") and "supplier" not in p, name


def test_totals_grid_and_gates_read_the_facts_once(spark):
    from monthwise.operators import crosstab as X
    from monthwise.operators import ranking as RK
    facts = C.base(spark, SF_SMALL).qty_by_label("SVA")          # not materialized
    one = len(scans(plan(facts)))
    assert len(scans(plan(X.column_totals(facts)))) == one
    assert len(scans(plan(C.QUERIES["gate_schedule"](spark, SF_SMALL)))) == 1
    grid = scans(plan(X.dense_grid(facts)))                      # its own written table, nothing else
    assert len(grid) == 1
    ranked = plan(RK.rank_labels(facts.select("SVA_SMS").distinct(), ["SVA_SMS"]))
    assert "lineitem" not in ranked and "rangepartitioning" not in ranked
