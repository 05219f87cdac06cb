import random

import pytest
from pyspark.sql import functions as F

from monthwise.operators import ranking as RK
from tests.conftest import rows

QSCHEMA = "SVA_SMS string, PERIODO int, Q long"


def test_top_n_tie_at_rank_ten_breaks_by_label(spark):
    data = [(f"l{i:02d}", 202401, 100 - i) for i in range(9)]
    data += [("zz", 202401, 50), ("aa", 202401, 50)]       # tie for the 10th slot
    got = RK.top_n_by_total(spark.createDataFrame(data, QSCHEMA), n=10).orderBy("rn").collect()
    assert len(got) == 10
    assert got[-1].SVA_SMS == "aa" and got[-1].rn == 10
    assert [r.rn for r in got] == list(range(1, 11))


def test_top_n_fewer_labels(spark):
    df = spark.createDataFrame([("a", 202401, 1), ("b", 202401, 3), ("c", 202402, 2)], QSCHEMA)
    got = [(r.SVA_SMS, r.total_general, r.rn) for r in RK.top_n_by_total(df).orderBy("rn").collect()]
    assert got == [("b", 3, 1), ("c", 2, 2), ("a", 1, 3)]


def test_top_n_by_mean_skips_null_months(spark):
    df = spark.createDataFrame([("a", 202401, 10.0), ("a", 202402, None), ("b", 202401, 4.0),
                                ("b", 202402, 7.0)], "SVA_SMS string, PERIODO int, ARPU double")
    got = [(r.SVA_SMS, r.arpu_promedio) for r in RK.top_n_by_mean(df).orderBy("rn").collect()]
    assert got == [("a", 10.0), ("b", 6.0)]   # b: avg(4, 7) = 5.5 -> 6


def test_first_per_key_matches_row_number(spark):
    rnd = random.Random(7)
    data = [(rnd.choice(["a", "b", None]), rnd.randint(1, 3), rnd.randint(0, 50), i)
            for i in range(300)]
    df = spark.createDataFrame(data, "k string, p int, amount int, id int")
    got = rows(RK.first_per_key(df, ["k", "p"], ["amount", "id"], descending=True)
               .select("k", "p", "id"))
    best = {}
    for k, p, a, i in data:
        if (k, p) not in best or (a, i) > best[(k, p)][0]:
            best[(k, p)] = ((a, i), i)
    expect = rows(spark.createDataFrame([(k, p, v[1]) for (k, p), v in best.items()],
                                        "k string, p int, id int"))
    assert got == expect


def test_rank_labels_matches_sorted_order(spark):
    names = [f"n{random.Random(3).random():.6f}{i}" for i in range(500)] + [None]
    df = spark.createDataFrame([(x,) for x in names], "SVA_SMS string").repartition(7)
    got = RK.rank_labels(df, [F.col("SVA_SMS").asc_nulls_first()], partitions=5) \
        .orderBy("rn").collect()
    expect = [None] + sorted(x for x in names if x is not None)
    assert [r.SVA_SMS for r in got] == expect
    assert [r.rn for r in got] == list(range(1, len(names) + 1))


def test_rank_labels_empty(spark):
    df = spark.createDataFrame([], "SVA_SMS string")
    assert RK.rank_labels(df, ["SVA_SMS"]).count() == 0


@pytest.mark.parametrize("reuse", ["true", "false"])
def test_rank_labels_with_payload_over_many_ranges(spark, reuse):
    n = 2_000_000
    df = spark.range(0, n, 1, 12).select(F.xxhash64("id").alias("k"), "id", F.concat(F.lit("pay"), F.col("id")).alias("p"))
    old = spark.conf.get("spark.sql.exchange.reuse")
    spark.conf.set("spark.sql.exchange.reuse", reuse)
    try:
        ranked = RK.rank_labels(df, ["k", "id"], partitions=8)
        r = ranked.agg(F.count_distinct("rn").alias("d"), F.min("rn").alias("lo"), F.max("rn").alias("hi"),
                       F.count("p").alias("n")).first()
        assert tuple(r) == (n, 1, n, n)
        some = [x.k for x in ranked.where("rn between 999000 and 1001000").orderBy("rn").collect()]
        assert some == sorted(some)
    finally:
        spark.conf.set("spark.sql.exchange.reuse", old)


def test_first_per_key_with_column_keys(spark):
    df = spark.createDataFrame([("a", 1, 5), ("A", 2, 7), ("b", 1, 1)], "k string, o int, v int")
    got = RK.first_per_key(df, [F.lower("k").alias("lk")], ["o"], descending=True)
    assert rows(got.select("lk", "v")) == [("a", 7), ("b", 1)]
