import datetime as dt
import decimal

import pytest

from monthwise import session as S
from monthwise.plans.report import ReportConfig
from monthwise.plans.trigger import run_report_from_parts, run_report_trigger
from monthwise.sources.fact_layout import FactLayout
from monthwise.sources.month_parts import MonthParts
from monthwise.sources.outbox_store import OutboxStore

SUBS = "PERIODO int, TIPO string, SVA_SMS string, Q_LINEAS_SUSCRITAS long"
TRX = "PERIODO int, TIPO string, SVA_SMS string, Q_TRANSACCIONES long, MONTO_NETO decimal(18,2)"
CAL = "DIA_FECHA date, DAYNAMELONG string"


def inputs(spark):
    subs = spark.createDataFrame([(202401, "SVA", "a", 5), (202401, "SMSP", "b", 7)], SUBS)
    trx = spark.createDataFrame([(202401, "SVA", "a", 1, decimal.Decimal("3")),
                                 (202401, "SMSP", "b", 2, decimal.Decimal("4"))], TRX)
    cal = spark.createDataFrame([(dt.date(2024, 1, 15), "LUNES"), (dt.date(2024, 1, 18), "JUEVES")],
                                CAL)
    return subs, trx, cal


def test_trigger_gates_and_queues_once_per_subject(spark, tmp_shared):
    subs, trx, cal = inputs(spark)
    store = OutboxStore(spark, f"{tmp_shared}/outbox")

    thursday = ReportConfig(as_of="2024-01-18")
    assert not run_report_trigger(subs, trx, cal, store, thursday, "to@x")
    no_day = ReportConfig(as_of="2024-01-16")                  # no calendar row: closed
    assert not run_report_trigger(subs, trx, cal, store, no_day, "to@x")
    no_data = ReportConfig(as_of="2025-01-13")                 # window after the data
    assert not run_report_trigger(subs, trx, cal, store, no_data, "to@x")

    monday = ReportConfig(as_of="2024-01-15")
    now = dt.datetime(2024, 1, 15, 12, tzinfo=dt.timezone.utc)
    before = S.written(spark)
    assert run_report_trigger(subs, trx, cal, store, monday, "to@x", "cc@x", now=now)
    assert run_report_trigger(subs, trx, cal, store, monday, "to@x", "cc@x", now=now)
    assert S.written(spark) == before                          # nothing is left behind
    assert spark.sparkContext._jsc.getPersistentRDDs().size() == 0
    rows = store.read().collect()
    assert len(rows) == 1                                       # replaced by subject, not added
    r = rows[0]
    assert (r.FECHA, r.PARA, r.CC, r.PROCESADO) == (dt.date(2024, 1, 15), "to@x", "cc@x", "N")
    assert r.SUBJECT == "[BA] Reporte Parque Suscriptores [20240115]"
    assert "<td>a</td>" in r.BODY and "<td>b</td>" in r.BODY


def test_one_clock_between_midnight_and_three_utc(spark, tmp_shared):
    """Gates, window and subject take the UTC day, the record its day at -03:00."""
    subs, trx, cal = inputs(spark)
    store = OutboxStore(spark, f"{tmp_shared}/outbox")
    now = dt.datetime(2024, 1, 15, 1, 30, tzinfo=dt.timezone.utc)
    assert run_report_trigger(subs, trx, cal, store, ReportConfig(), "to@x", now=now)
    r = store.read().first()
    assert r.FECHA == dt.date(2024, 1, 14) and r.SUBJECT.endswith("[20240115]") and "15-01-2024" in r.BODY
    same = dt.datetime(2024, 1, 14, 22, 30, tzinfo=dt.timezone(dt.timedelta(hours=-3)))
    assert run_report_trigger(subs, trx, cal, store, ReportConfig(), "to@x", now=same)
    assert store.read().count() == 1


def test_the_job_on_month_parts_queues_the_same_mail(spark, tmp_shared):
    subs, trx, cal = inputs(spark)
    layouts = {}
    for name, df, qty, amount in (("subs", subs, "Q_LINEAS_SUSCRITAS", None), ("trx", trx, "Q_TRANSACCIONES", "MONTO_NETO")):
        layout = FactLayout(spark, f"{tmp_shared}/{name}", SUBS if name == "subs" else TRX)
        layout.append(df)
        layouts[name] = (layout, MonthParts(spark, f"{tmp_shared}/{name}-parts", layout, qty, amount))
    monday = ReportConfig(as_of="2024-01-15")
    now = dt.datetime(2024, 1, 15, 12, tzinfo=dt.timezone.utc)
    one, two = OutboxStore(spark, f"{tmp_shared}/one"), OutboxStore(spark, f"{tmp_shared}/two")
    parts = [layouts["subs"][1], layouts["trx"][1]]
    assert not run_report_from_parts(*parts, cal, two, ReportConfig(as_of="2024-01-18"), "to@x", now=now)       # shut
    assert not parts[0].partitions()                                                                          # nothing was summed for it
    assert not run_report_from_parts(*parts, cal, two, ReportConfig(as_of="2025-01-13"), "to@x", now=now)
    for _ in range(2):
        assert run_report_trigger(layouts["subs"][0].read(), layouts["trx"][0].read(), cal, one, monday, "to@x", now=now)
        assert run_report_from_parts(*parts, cal, two, monday, "to@x", now=now)
        assert two.read().collect() == one.read().collect() and two.read().count() == 1
        layouts["trx"][0].append(spark.createDataFrame([(202401, "SMSP", "late", 9, decimal.Decimal("1"))], TRX))


def test_no_machine_local_folder_on_a_cluster(monkeypatch):
    assert S.is_one_machine("local[4]") and S.is_one_machine("local")
    assert not S.is_one_machine("local-cluster[2,1,1024]") and not S.is_one_machine("spark://h:7077")

    class Context:
        master = "spark://h:7077"

        def getCheckpointDir(self):
            return None

        def getConf(self):
            return {}

    class Session:
        sparkContext = Context()

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        S.ensure_checkpoint_dir(Session())


def test_release_all(spark):
    df = S.materialize(spark.range(3), "kept")
    assert df._monthwise_path in S.written(spark)
    assert S.release(df) and df._monthwise_path not in S.written(spark)
