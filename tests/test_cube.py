"""The cube against the four operators that it replaces, and exact division."""

import decimal
import math
import random
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from monthwise.functions import exact as E
from monthwise.operators import crosstab as X
from monthwise.operators import cube as C
from monthwise.operators import measures as M
from tests.conftest import rows

SCHEMA = "PERIODO int, SVA_SMS string, Q bigint"
DATA = [(202401, "a", 3), (202401, "a", 4), (202402, "a", 1), (202401, None, 10), (202403, None, 20), (202402, "b", None),
        (202403, "c", -5), (202403, "c", 0), (None, "a", 100), (None, "only undated", 7), (202402, "", 6)]


@pytest.fixture
def facts(spark, tmp_shared):
    path = f"{tmp_shared}/facts"
    spark.createDataFrame(DATA, SCHEMA).write.parquet(path)
    return spark.read.parquet(path)


def kind(df, name, *cols):
    return rows(df.where(F.col("kind") == name).select(*cols))


def test_equal_to_the_four_operators_with_null_labels(facts):
    cube = C.cube_quantities(facts)
    cells = facts.groupBy("SVA_SMS", "PERIODO").agg(F.sum("Q").alias("Q"))
    months = [202401, 202402, 202403]
    grid = X.dense_grid(cells, periods=months)
    # the grid's filled cells are those that the cube lacks
    assert kind(cube.where("not label_is_null"), "cell", "SVA_SMS", "PERIODO", F.coalesce("Q", F.lit(0))) == \
        rows(grid.join(cells.select("SVA_SMS", "PERIODO"), ["SVA_SMS", "PERIODO"], "left_semi").select("SVA_SMS", "PERIODO", "Q"))
    assert {r[1] for r in kind(cube.where("label_is_null"), "cell", "PERIODO", "Q")} == {0}
    totals = X.row_totals(grid)
    assert kind(cube, "row_total", "SVA_SMS", F.coalesce("Q", F.lit(0))) == rows(totals.where("SVA_SMS is distinct from 'only undated'"))
    cols = X.column_totals(cells)
    assert kind(cube, "col_total", "PERIODO", "Q") == rows(cols.select("PERIODO", "total_periodo"))
    assert kind(cube, "grand_total", "Q") == [(cols.first()["gran_total"],)]


def test_null_labels_as_a_label_of_their_own(facts):
    cube = C.cube_quantities(facts, null_label_matches=True)
    assert kind(cube.where("label_is_null"), "row_total", "Q") == [(30,)]
    assert kind(cube.where("label_is_null"), "cell", "PERIODO", "Q") == [(202401, 10), (202403, 20)]


def test_one_scan_one_expand_one_shuffle(facts):
    plan = C.cube_quantities(facts)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and plan.count("Expand ") == 1 and plan.count("Exchange ") == 1 and "Join" not in plan


def test_means_of_every_kind(spark):
    data = [(202401, "a", 2, "1.00"), (202401, "a", 1, "4.00"), (202402, "a", 4, "0.25"), (202401, "b", 0, "9.00"), (202402, None, 2, "2.50"),
            (202402, "b", 3, None)]
    df = spark.createDataFrame([(p, s, q, m and decimal.Decimal(m)) for p, s, q, m in data], "PERIODO int, SVA_SMS string, Q_TRANSACCIONES long, MONTO_NETO decimal(18,2)")
    got = C.cube_means(df, zero="null")
    cells = M.weighted_mean(df, ["SVA_SMS", "PERIODO"], zero="null")
    assert kind(got, "cell", "SVA_SMS", "PERIODO", "ARPU") == rows(cells)
    assert kind(got, "col_total", "PERIODO", "ARPU") == rows(M.weighted_mean(df, ["PERIODO"], zero="null"))
    assert kind(got, "row_total", "SVA_SMS", "ARPU") == rows(M.weighted_mean(df, ["SVA_SMS"], zero="null"))
    assert kind(got, "grand_total", "ARPU") == rows(M.weighted_mean(df.withColumn("k", F.lit(1)), ["k"], zero="null").select("ARPU"))


def test_empty_facts(spark):
    got = rows(C.cube_quantities(spark.createDataFrame([], SCHEMA)))
    assert [r[0] for r in got] in ([], ["grand_total"])


# -- exact division -----------------------------------------------------------------------

def half_away(n, d, digits=0):
    q = Fraction(n) / Fraction(d) * 10 ** digits
    r = math.floor(abs(q) + Fraction(1, 2))
    return Fraction(r if q >= 0 else -r, 10 ** digits)


@pytest.mark.parametrize("digits", [0, 2])
def test_exact_ratio(spark, digits):
    rng = random.Random(digits)
    pairs = [(5, 2), (-5, 2), (5, -2), (-5, -2), (1, 2), (-1, 2), (0, 7), (1, 3), (2, 3), (2**62 + 1, 2), (10**17 + 1, 2), (10**18 - 1, 10**18)]
    pairs += [(rng.randint(-10**rng.randint(1, 18), 10**rng.randint(1, 18)), rng.choice([-1, 1]) * rng.randint(1, 10**rng.randint(1, 9))) for _ in range(200)]
    df = spark.createDataFrame([(n, d, decimal.Decimal(n).scaleb(-2)) for n, d in pairs], "n long, d long, m decimal(24,2)")
    got = df.select("n", "d", E.exact_ratio(F.col("n"), F.col("d"), 0, 0, digits).alias("a"), E.exact_ratio(F.col("m"), F.col("d"), 2, 0, digits).alias("b")).collect()
    for r in got:
        assert Fraction(r["a"]) == half_away(r["n"], r["d"], digits)
        assert Fraction(r["b"]) == half_away(Fraction(r["n"], 100), r["d"], digits)


def test_means_beyond_double(spark):
    big = 2**53
    data = [("tie", 1, big), ("tie", 1, big + 1), ("odd", 1, big + 1), ("down", 3, -big), ("down", 1, -big - 2)]
    df = spark.createDataFrame(data, "k string, q long, m long").withColumn("m", F.col("m").cast("decimal(20,0)"))
    got = dict(rows(M.weighted_mean(df, ["k"], "q", "m", out_type="bigint")))
    assert got == {"tie": big + 1, "odd": big + 1, "down": -big - 1}


def test_zero_denominators(spark):
    df = spark.createDataFrame([("a", 0, 5)], "k string, q long, m long")
    assert rows(M.weighted_mean(df, ["k"], "q", "m", zero="null")) == [("a", None)]
    with pytest.raises(Exception, match="DIVIDE_BY_ZERO"):
        M.weighted_mean(df, ["k"], "q", "m").collect()
    floats = spark.createDataFrame([("a", 2.0, 1.25), ("b", 0.0, 1.0)], "k string, q double, m double")
    assert rows(M.weighted_mean(floats, ["k"], "q", "m", zero="null", digits=1)) == [("a", 1.3), ("b", None)]
