import decimal

import pytest

from monthwise.plans.report import ReportBase, ReportConfig, report_mail, report_sections

SUBS = "PERIODO int, TIPO string, SVA_SMS string, Q_LINEAS_SUSCRITAS long"
TRX = "PERIODO int, TIPO string, SVA_SMS string, Q_TRANSACCIONES long, MONTO_NETO decimal(18,2)"


def d(x):
    return decimal.Decimal(str(x))


@pytest.fixture
def edge_base(spark):
    subs = spark.createDataFrame([
        (202401, "SVA", "alpha", 1500), (202402, "SVA", "alpha", 2500),
        (202402, "SVA", "beta", 7), (202401, "SVA", None, 3),         # NULL label
        (202402, "OTHER", "x", 5),                                     # other type only
        (202312, "SVA", "alpha", 999999),                              # before the window
        (202406, "SVA", "beta", 1),                                    # future period
    ], SUBS)
    trx = spark.createDataFrame([
        (202401, "SVA", "alpha", 2, d(10)), (202401, "SVA", "alpha", 1, d(11.5)),
        (202402, "SVA", "beta", 4, d(3)),
    ], TRX)                                                            # no SMSP at all
    cfg = ReportConfig(as_of="2024-02-20", n_back=1)                   # window 202401..
    return ReportBase.from_rows(subs, trx, cfg)


def test_report_with_absent_type_and_null_label(spark, edge_base):
    secs = {r.name: r.html for r in report_sections(edge_base).collect()}
    assert set(secs) == {"chart", "sva_qty", "smsp_qty", "sva_mean", "smsp_mean"}
    assert all(v is not None for v in secs.values())
    sva = secs["sva_qty"]
    # periods 202401, 202402 and the future 202406; nothing before the window
    assert "<th>202401</th><th>202402</th><th>202406</th><th>Total</th>" in sva
    assert "999.999" not in sva and "1.000.002" not in sva
    # the NULL label row is skipped, alpha and beta remain (ranked after NULL: 2, 3)
    assert sva.count('<tr style="background:') == 2
    assert '<td>alpha</td><td align="right">1.500</td><td align="right">2.500</td>' \
           '<td align="right">0</td><td align="right">4.000</td></tr>' in sva
    # column totals include the NULL label's 3
    assert '<td>Total</td><td align="right">1.503</td><td align="right">2.507</td>' \
           '<td align="right">1</td><td align="right">4.011</td></tr>' in sva
    # the SMSP tables are empty but present
    assert secs["smsp_qty"].endswith("</table>") and "<tr style=" not in secs["smsp_qty"]
    # means: (2*10 + 1*11.5) / 3 = 10.5 -> 11 ; beta 3
    assert '<td>alpha</td><td align="right">$ 11</td><td align="right">$ 0</td></tr>' \
           in secs["sva_mean"]


def test_report_mail_subject_and_body(spark, edge_base):
    r = report_mail(edge_base).first()
    assert r.SUBJECT == "[BA] Reporte Parque Suscriptores [20240220]"
    assert r.BODY.startswith("<html><body><h2>Reporte Parque Suscriptores</h2><p>20-02-2024</p>")
    assert r.BODY.count("</table>") >= 5


def test_sva_zero_denominator_raises(spark):
    subs = spark.createDataFrame([(202401, "SVA", "a", 1)], SUBS)
    trx = spark.createDataFrame([(202401, "SVA", "a", 0, d(10))], TRX)
    base = ReportBase.from_rows(subs, trx, ReportConfig(as_of="2024-01-20"), materialize=False)
    with pytest.raises(Exception, match="DIVIDE_BY_ZERO"):
        base.mean_by_label("SVA", "error").collect()
    assert base.mean_by_label("SVA", "null").first().ARPU is None


def test_hot_label_matches_brute_force(spark):
    """One label holds a third of all rows: results equal a plain Python sum."""
    data = [(202401 + (i % 3), "SVA", "hot" if i % 3 == 0 else f"l{i % 50}", i % 7)
            for i in range(3000)]
    subs = spark.createDataFrame(data, SUBS).repartition(16)
    trx = spark.createDataFrame([(p, t, lab, q, d(1)) for p, t, lab, q in data], TRX)
    base = ReportBase.from_rows(subs, trx, ReportConfig(as_of="2024-03-15", n_back=2))
    got = {(r.SVA_SMS, r.PERIODO): r.Q for r in base.qty_by_label("SVA").collect()}
    expect = {}
    for p, _, lab, q in data:
        expect[(lab, p)] = expect.get((lab, p), 0) + q
    assert got == expect


def test_release_deletes_materialized_folders(spark):
    import os
    subs = spark.createDataFrame([(202401, "SVA", "a", 1)], SUBS)
    trx = spark.createDataFrame([(202401, "SVA", "a", 1, d(2))], TRX)
    base = ReportBase.from_rows(subs, trx, ReportConfig(as_of="2024-01-20"))
    paths = [base.subs._monthwise_path, base.trx._monthwise_path]
    local = [p.replace("file:", "") for p in paths]
    assert all(os.path.isdir(p) for p in local)
    assert base.qty_by_label("SVA").count() == 1
    base.release()
    assert not any(os.path.exists(p) for p in local)


def test_report_with_current_date_window(spark):
    """as_of=None: the window is computed from the query's current date."""
    import datetime as dt
    today = dt.datetime.now(dt.timezone.utc).date()
    this_month = today.year * 100 + today.month
    subs = spark.createDataFrame([(this_month, "SVA", "a", 1), (200001, "SVA", "old", 9)], SUBS)
    trx = spark.createDataFrame([(this_month, "SVA", "a", 1, d(2))], TRX)
    base = ReportBase.from_rows(subs, trx, ReportConfig(as_of=None), materialize=False)
    assert [(r.SVA_SMS, r.Q) for r in base.qty_by_label("SVA").collect()] == [("a", 1)]
    secs = {r.name: r.html for r in report_sections(base, concurrent=False).collect()}
    assert f"<th>{this_month}</th>" in secs["sva_qty"] and "old" not in secs["sva_qty"]
