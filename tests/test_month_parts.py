"""Maintained month parts against a full run, and the facts' layout."""

import datetime as dt
import decimal
import glob

import pytest
from pyspark.sql import functions as F

from monthwise.operators import crosstab as X
from monthwise.plans.report import ReportBase, ReportConfig
from monthwise.sources.fact_layout import FactLayout
from monthwise.sources.month_parts import MonthParts
from tests.conftest import rows, scanned_files

SCHEMA = "PERIODO int, TIPO string, SVA_SMS string, Q bigint, MONTO_NETO decimal(18,2)"
CAL = "DIA_FECHA date, DAYNAMELONG string"


def facts(spark, data):
    return spark.createDataFrame([(p, t, s, q, None if m is None else decimal.Decimal(m)) for p, t, s, q, m in data], SCHEMA)


DATA = [(p, t, s, q + p % 7, m) for p in (202401, 202402, 202403, 202404) for t in ("SVA", "SMSP") for s in ("a", "b", None)
        for q, m in ((1, "2.50"), (3, "0.10"), (2, None))] + [(None, "SVA", "a", 5, "1.00")]


def full(df):
    return rows(df.groupBy("PERIODO", "TIPO", "SVA_SMS").agg(
        F.sum("Q").alias("Q"), F.sum(F.col("Q") * F.col("MONTO_NETO")).cast("decimal(38,4)").alias("QM")))


def made(spark, base):
    layout = FactLayout(spark, f"{base}/facts", SCHEMA)
    layout.append(facts(spark, DATA))
    return layout, MonthParts(spark, f"{base}/parts", layout)


def test_a_late_row_changes_one_month_and_reads_its_files_only(spark, tmp_shared):
    layout, parts = made(spark, tmp_shared)
    assert parts.refresh() == {202401, 202402, 202403, 202404, None}
    assert rows(parts.read()) == full(facts(spark, DATA))
    assert parts.refresh() == set()
    before = {f: open(f, "rb").read() for f in glob.glob(f"{tmp_shared}/parts/PERIODO=*/*.parquet")}
    late = [(202402, "SVA", "late", 9, "4.00")]
    layout.append(facts(spark, late))
    assert scanned_files(parts.summed({202402})) == len(glob.glob(f"{tmp_shared}/facts/PERIODO=202402/*.parquet"))
    assert parts.refresh() == {202402}
    assert rows(parts.read()) == full(facts(spark, DATA + late))
    for f, body in before.items():                       # the other months' files are untouched
        assert "PERIODO=202402" in f or open(f, "rb").read() == body


def test_months_that_go_and_months_without_a_period(spark, tmp_shared):
    layout, parts = made(spark, tmp_shared)
    parts.refresh()
    parts._delete(f"{tmp_shared}/facts/PERIODO=202403")
    layout.append(facts(spark, [(None, "SVA", "a", 1, "1.00")]))
    assert parts.refresh() == {202403, None}
    left = [r for r in DATA if r[0] != 202403] + [(None, "SVA", "a", 1, "1.00")]
    assert rows(parts.read()) == full(facts(spark, left))
    assert 202403 not in {r[0] for r in parts.side("ledger").collect()}


def test_a_lost_refresh_is_done_again(spark, tmp_shared, monkeypatch):
    layout, parts = made(spark, tmp_shared)
    for step in ("_record", "_apply", "_finish"):
        layout.append(facts(spark, [(202401, "SVA", step, 1, "1.00")]))
        with monkeypatch.context() as m:
            m.setattr(parts, step, lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
            with pytest.raises(RuntimeError):
                parts.refresh()
        again = MonthParts(spark, parts.path, layout)
        again.refresh()
        assert rows(again.read()) == full(layout.read()), step


def test_the_report_from_parts_equals_the_report_from_rows(spark, tmp_shared):
    layout, parts = made(spark, tmp_shared)
    parts.refresh()
    cfg = ReportConfig(as_of="2024-04-20", n_back=2, top_n=2)
    raw = layout.read()
    from_rows = ReportBase.from_rows(raw.withColumnRenamed("Q", "Q_LINEAS_SUSCRITAS"), raw.withColumnRenamed("Q", "Q_TRANSACCIONES"), cfg)
    from_parts = ReportBase.from_parts(parts.read(), cfg)
    for table in ("sva_qty", "smsp_qty", "sva_mean", "smsp_mean"):
        assert rows(X.to_long(getattr(from_parts, table)())) == rows(X.to_long(getattr(from_rows, table)())), table
    # the window opens the kept months' folders only
    assert scanned_files(from_parts.subs) == sum(len(glob.glob(f"{tmp_shared}/parts/PERIODO={m}/*.parquet")) for m in (202402, 202403, 202404))


# -- the layout -------------------------------------------------------------------------

def calendar(spark):
    return spark.createDataFrame([(dt.date(2024, 4, 15), "LUNES"), (dt.date(2024, 4, 16), "MARTES"), (dt.date(2024, 2, 5), "LUNES"),
                                  (dt.date(2024, 4, 19), "VIERNES"), (dt.date(2024, 4, 19), "VIERNES")], CAL)


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_the_gate_prunes_folders_at_run_time(spark, tmp_shared):
    layout, _ = made(spark, tmp_shared)
    cal = calendar(spark)
    monday = layout.gated_window(cal, "2024-04-15", 1)
    assert "PartitionFilters" in plan_of(monday) and "Subquery" in plan_of(monday).split("PartitionFilters")[1].split("]")[0] + "]"
    assert scanned_files(monday) == sum(len(glob.glob(f"{tmp_shared}/facts/PERIODO={m}/*")) for m in (202403, 202404))
    assert rows(monday) == rows(facts(spark, [r for r in DATA if r[0] in (202403, 202404)]))
    shut = layout.gated_window(cal, "2024-04-16", 1)
    assert shut.count() == 0 and scanned_files(shut) == 0
    absent = layout.gated_window(cal, "2024-04-17", 1)
    assert absent.count() == 0 and scanned_files(absent) == 0
    with pytest.raises(Exception, match="(?i)more than one row"):
        layout.gated_window(cal, "2024-04-19", 1).collect()


def test_the_months_of_days_prune_folders_by_a_join(spark, tmp_shared):
    layout, _ = made(spark, tmp_shared)
    path = f"{tmp_shared}/calendar"
    calendar(spark).write.parquet(path)                  # of a known size, so that it is sent to the scan
    days = spark.read.parquet(path).where(F.col("DAYNAMELONG") == "LUNES")
    got = layout.months_of(days)
    assert "dynamicpruning" in plan_of(got)
    assert rows(got) == rows(facts(spark, [r for r in DATA if r[0] in (202402, 202404)]))
    assert scanned_files(got, layout.path) == sum(len(glob.glob(f"{tmp_shared}/facts/PERIODO={m}/*")) for m in (202402, 202404))


def test_rows_of_a_month_are_clustered_and_a_hot_month_is_split(spark, tmp_shared):
    layout = FactLayout(spark, f"{tmp_shared}/hot", SCHEMA)
    hot = spark.range(9000).select(
        F.when(F.col("id") % 3 != 0, 202401).otherwise(202401 + F.col("id") % 6 + 1).cast("int").alias("PERIODO"), F.lit("SVA").alias("TIPO"),
        F.when(F.col("id") % 2 == 0, F.lit("hot")).otherwise((F.col("id") % 50).cast("string")).alias("SVA_SMS"),
        F.col("id").alias("Q"), F.lit(1).cast("decimal(18,2)").alias("MONTO_NETO"))
    layout.append(hot, partitions=12)
    assert rows(layout.read()) == rows(hot.select("PERIODO", "TIPO", "SVA_SMS", "Q", "MONTO_NETO"))
    per_file = {}
    for f in glob.glob(f"{tmp_shared}/hot/PERIODO=*/*.parquet"):
        labels = [r[0] for r in spark.read.parquet(f).select("SVA_SMS").collect()]
        assert labels == sorted(labels)
        per_file[f] = len(labels)
    assert max(per_file.values()) <= 2 * 9000 / 12


def test_fingerprints_follow_the_files(spark, tmp_shared):
    layout, _ = made(spark, tmp_shared)
    one = rows(layout.fingerprints())
    assert rows(layout.fingerprints()) == one and {r[0] for r in one} == {202401, 202402, 202403, 202404, None}
    assert {r[0]: r[1] for r in one}[202401] == len(glob.glob(f"{tmp_shared}/facts/PERIODO=202401/*.parquet"))
