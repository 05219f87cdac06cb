import datetime as dt

import pytest

from monthwise.operators import gating as G

CAL = "DIA_FECHA date, DAYNAMELONG string"


def test_calendar_gate_run_day_no_row_and_duplicate(spark):
    cal = spark.createDataFrame([(dt.date(2024, 1, 1), "LUNES"), (dt.date(2024, 1, 2), "MARTES"),
                                 (dt.date(2024, 1, 3), "MIERCOLES"), (dt.date(2024, 1, 3), "X")], CAL)
    assert G.calendar_gate(cal, "2024-01-01").first().gate_open is True
    assert G.calendar_gate(cal, "2024-01-02").first().gate_open is False
    none = G.calendar_gate(cal, "2024-01-09").first()
    assert none.DAYNAMELONG is None and none.gate_open is False
    with pytest.raises(Exception):
        G.calendar_gate(cal, "2024-01-03").collect()


def test_recent_row_count_and_has_data(spark):
    df = spark.createDataFrame([(202303,), (202401,)], "PERIODO int")
    r = G.recent_row_count(df, "PERIODO", "2024-01-15", 7).first()
    assert (r.num_rows, r.has_data) == (1, True)
    assert G.has_recent_data(df, "PERIODO", "2024-01-15", 7)
    assert not G.has_recent_data(df, "PERIODO", "2026-01-15", 7)


def test_gate_schedule_matches_brute_force(spark):
    days = [dt.date(2023, 1, 1) + dt.timedelta(days=i) for i in range(0, 700, 3)]
    cal = G.calendar_from_dates(spark.createDataFrame([(d,) for d in days], "d date"), "d")
    facts = spark.createDataFrame([(202301,), (202305,), (202311,)], "PERIODO int")
    got = {r.DIA_FECHA: (r.has_data, r.gate_open) for r in G.gate_schedule(cal, facts).collect()}
    names = ["LUNES", "MARTES", "MIERCOLES", "JUEVES", "VIERNES", "SABADO", "DOMINGO"]
    for d in days:
        y, m = divmod(d.year * 12 + d.month - 1 - 7, 12)
        bound = y * 100 + m + 1
        has = any(p >= bound for p in (202301, 202305, 202311))
        assert got[d] == (has, has and names[d.weekday()] in ("LUNES", "VIERNES")), d
