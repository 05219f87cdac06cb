import datetime as dt

from pyspark.sql import functions as F

from monthwise.functions import formatting as FM
from monthwise.functions import periods as P


def test_period_key_and_bound(spark):
    df = spark.createDataFrame([(dt.date(2001, 11, 15),), (dt.date(2024, 1, 31),)], "d date")
    got = [r[0] for r in df.select(P.period_key("d")).collect()]
    assert got == [200111, 202401]
    assert P.period_bound_value("2001-11-15", 7) == 200104
    assert P.period_bound_value("2024-03-31", 7) == 202308
    assert P.period_bound_value("2024-01-10", 0) == 202401
    one = spark.range(1).select(P.period_bound(None, 7).alias("b")).first().b
    today = dt.date.today()
    y, m = P.shift_months(today.year, today.month, -7)
    assert one == y * 100 + m


def test_previous_month_label_and_weekday(spark):
    df = spark.createDataFrame([(dt.date(2025, 5, 3),), (dt.date(2025, 1, 15),),
                                (dt.date(2001, 11, 15),), (dt.date(2001, 11, 12),)], "d date")
    got = df.select(P.previous_month_label("d").alias("l"), P.weekday_name("d").alias("w")).collect()
    assert [r.l for r in got] == ["Abr_25", "Dic_24", "Oct_01", "Oct_01"]
    assert [r.w for r in got] == ["SABADO", "MIERCOLES", "JUEVES", "LUNES"]


def test_local_date_offset(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 3, 2, 1, 0),)], "ts timestamp")
    assert df.select(P.local_date("ts")).first()[0] == dt.date(2024, 3, 1)


DIGITS = [(0.0, "0", "0"), (12.0, "12", "12"), (999.0, "999", "999"), (1000.0, "1.000", "1.000"),
          (1234567.0, "1.234.567", "1.234.567"), (-1234567.0, "-1.234.567", "1.234.567"),
          (0.5, "1", "1"), (1.5, "2", "2"), (2.5, "3", "3"), (-2.5, "-3", "3")]


def test_group_digits_sign_safe_and_legacy(spark):
    df = spark.createDataFrame([(v,) for v, _, _ in DIGITS], "v double")
    got = df.select(FM.group_digits("v").alias("a"), FM.group_digits("v", legacy=True).alias("b"),
                    F.expr(FM.group_digits_sql("v")).alias("c"),
                    FM.group_digits("v", prefix="$ ").alias("e")).collect()
    for (v, sign_safe, legacy), r in zip(DIGITS, got):
        assert r.a == sign_safe == r.c, v
        assert r.b == legacy, v
        assert r.e == "$ " + sign_safe
        # invariant: removing separators gives back the rounded integer
        assert int(r.a.replace(".", "")) == int(FM_round(v))


def FM_round(v):
    import decimal
    return decimal.Decimal(v).quantize(decimal.Decimal(1), rounding=decimal.ROUND_HALF_UP)


def test_group_digits_null(spark):
    df = spark.createDataFrame([(None,)], "v double")
    assert df.select(FM.group_digits("v")).first()[0] is None


def test_kilo_bar_zebra(spark):
    df = spark.createDataFrame([(1, 2500.0), (2, 1499.0), (3, 0.0)], "rn int, v double")
    got = df.select(FM.kilo_label("v").alias("k"), FM.bar_height("v").alias("h"),
                    FM.zebra("rn").alias("z"), F.expr(FM.zebra_sql("rn")).alias("z2")).collect()
    assert [r.k for r in got] == ["3k", "1k", "0k"]
    assert [r.h for r in got] == [1, 1, 0]
    assert [r.z for r in got] == ["#ffffff", "#eeeeee", "#ffffff"] == [r.z2 for r in got]
