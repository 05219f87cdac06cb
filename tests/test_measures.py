import decimal

import pytest

from monthwise.operators import measures as M
from monthwise.operators.window import trailing_months
from tests.conftest import rows

SCHEMA = "PERIODO int, TIPO string, SVA_SMS string, Q_LINEAS_SUSCRITAS long"


def test_window_keeps_future_drops_before_bound(spark):
    df = spark.createDataFrame([(202303, "SVA", "a", 1), (202304, "SVA", "a", 2),
                                (202411, "SVA", "a", 3), (203001, "SVA", "a", 4)], SCHEMA)
    got = rows(trailing_months(df, "PERIODO", "2023-11-15", 7).select("PERIODO"))
    assert got == [(202304,), (202411,), (203001,)]


def test_sum_by_type_other_types_and_absent_type(spark):
    df = spark.createDataFrame([(202401, "SVA", "a", 3), (202401, "SVA", None, 3),
                                (202402, "OTHER", "x", 5)], SCHEMA)
    got = rows(M.sum_by_type(df))
    # the period with only other types appears with zeros; SMSP is absent everywhere -> 0
    assert got == [(202401, 0, 6), (202402, 0, 0)]


def test_sum_by_label_null_label_kept(spark):
    df = spark.createDataFrame([(202401, "SVA", None, 3), (202401, "SVA", None, 4),
                                (202401, "SMSP", "b", 1)], SCHEMA)
    assert rows(M.sum_by_label(df, "SVA")) == [(None, 202401, 7)]


TRX = "PERIODO int, TIPO string, SVA_SMS string, Q_TRANSACCIONES long, MONTO_NETO decimal(18,2)"


def d(x):
    return None if x is None else decimal.Decimal(str(x))


def test_weighted_mean_rounding_and_null_amount(spark):
    df = spark.createDataFrame([(202401, "SVA", "a", 2, d(10)), (202401, "SVA", "a", 1, d(11.5)),
                                (202401, "SVA", "b", 2, d(7)), (202401, "SVA", "b", 2, None)], TRX)
    got = dict((r.SVA_SMS, r.ARPU) for r in M.weighted_mean(df).collect())
    assert got["a"] == 11.0          # (20 + 11.5) / 3 = 10.5 -> 11 (half away from zero)
    assert got["b"] == 4.0           # NULL amount leaves the numerator, stays in the denominator


def test_weighted_mean_zero_denominator(spark):
    df = spark.createDataFrame([(202401, "SMSP", "z", 0, d(10))], TRX)
    assert M.weighted_mean(df, zero="null").first().ARPU is None
    with pytest.raises(Exception, match="DIVIDE_BY_ZERO"):
        M.weighted_mean(df, zero="error").collect()


def test_mean_from_parts_equals_direct(spark):
    data = [(202401 + (i % 3), "SVA", f"l{i % 4}", i % 5, d(i * 1.25)) for i in range(60)]
    df = spark.createDataFrame(data, TRX)
    direct = rows(M.weighted_mean(df, ["PERIODO"], zero="null"))
    parts = M.mean_parts(df, ["PERIODO", "SVA_SMS"])
    via = rows(M.mean_from_parts(parts, ["PERIODO"], zero="null"))
    assert direct == via


def test_weighted_mean_by_period_filters_type(spark):
    df = spark.createDataFrame([(202401, "SVA", "a", 1, d(10)), (202401, "SMSP", "a", 1, d(30))], TRX)
    assert rows(M.weighted_mean_by_period(df, "SMSP", zero="null")) == [(202401, 30.0)]
