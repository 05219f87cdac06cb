"""Salted joins, bucketed tables, ordered text of any size, and SQL table functions."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from monthwise.operators import crosstab as X
from monthwise.operators import cube as C
from monthwise.operators import measures as M
from monthwise.operators.render import tree_concat
from monthwise.operators.skew_join import heavy_keys, salted_join
from monthwise.operators.window import trailing_months
from monthwise.plans import sql_functions
from monthwise.sources.bucketed import join_stored, store_bucketed
from monthwise.sources.text_sink import read_text, text_parts, write_text
from tests.conftest import rows


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def no_aqe(spark):
    """Sort-merge joins over 32 partitions, without adaptive execution."""
    own = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.shuffle.partitions": "32"}
    before = {k: spark.conf.get(k) for k in own}
    for k, v in own.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


# -- salted join ------------------------------------------------------------------------

def skewed(spark, n=30_000):
    key = F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 6 == 1, None).otherwise(F.col("id") % 500 + 100)
    return spark.range(0, n, 1, 8).select(key.cast("long").alias("k"), (F.col("id") % 11).alias("q"))


def dimension(spark):
    return spark.createDataFrame([(7, "hot"), (7, "hot again"), (None, "null")] + [(i, f"l{i}") for i in range(100, 550)], "k long, label string")


@pytest.mark.parametrize("how", ["left", "inner"])
def test_salted_join_equals_the_plain_join(spark, how):
    facts, dim = skewed(spark, 6000), dimension(spark)
    assert rows(salted_join(facts, dim, "k", how, parts=16)) == rows(facts.join(dim, "k", how))


def per_partition(df):
    return [r["n"] for r in df.groupBy(F.spark_partition_id().alias("p")).agg(F.count("*").alias("n")).collect()]


def test_a_third_of_the_rows_spreads_without_adaptive_execution(spark, no_aqe):
    facts, dim = skewed(spark), dimension(spark).where("label != 'hot again'")
    joined = salted_join(facts, dim, "k")
    assert "SortMergeJoin" in plan_of(joined)
    sizes, plain = per_partition(joined), per_partition(facts.join(dim, "k", "left"))
    assert sum(sizes) == 30_000 and max(sizes) < 5 * 30_000 / 32 < max(plain)


def test_heavy_keys_are_those_above_the_share(spark):
    found = heavy_keys(skewed(spark), "k")
    assert [k for k, _ in found.keys] == [7] and found.total == 30_000 and found.nulls == 5000
    assert heavy_keys(spark.range(1000).select(F.col("id").alias("k")), "k").keys == ()
    assert heavy_keys(spark.createDataFrame([], "k long"), "k").keys == ()


def test_only_heavy_dimension_rows_are_repeated(spark):
    found = heavy_keys(skewed(spark), "k")
    n = salted_join(spark.createDataFrame([], "k long, q long"), dimension(spark), "k", "inner", 16, found)
    assert n.count() == 0
    assert found.salts(10_000, 16) == 6 and found.salts(1, 16) == 1


def test_equal_rows_of_a_hot_key_spread(spark, no_aqe):
    same = spark.range(0, 8000, 1, 4).select(F.substring(F.concat(F.lit("x"), F.col("id").cast("string")), 1, 1).alias("k"), F.lit(1).alias("q"))
    dim = spark.createDataFrame([("x", "label")], "k string, label string")
    sizes = per_partition(salted_join(same, dim, "k"))
    assert sum(sizes) == 8000 and len(sizes) >= 16 and max(sizes) <= 1500


def test_a_small_dimension_is_joined_without_a_shuffle(spark, tmp_shared):
    dimension(spark).write.parquet(f"{tmp_shared}/dim")
    plan = plan_of(salted_join(skewed(spark, 3000), spark.read.parquet(f"{tmp_shared}/dim"), "k"))
    assert "BroadcastHashJoin" in plan and "hashpartitioning" not in plan


# -- buckets ------------------------------------------------------------------------------

def test_bucketed_join_has_no_exchange(spark):
    facts, dim = skewed(spark, 3000), dimension(spark)
    left = store_bucketed(facts, "k", 4, "t_facts")
    right = store_bucketed(dim, "k", 4, "t_dim")
    try:
        joined = join_stored(left, right)
        plan = plan_of(joined)
        assert "SortMergeJoin" in plan and "Exchange" not in plan and "Broadcast" not in plan
        assert rows(joined.select("k", "q", "label")) == rows(facts.join(dim, "k", "left").select("k", "q", "label"))
    finally:
        left.drop()
        right.drop()
    assert not spark.catalog.tableExists(left.name)


# -- ordered text ---------------------------------------------------------------------------

def test_parts_concatenate_to_the_text(spark, tmp_shared):
    df = spark.range(1000).select(F.col("id"), F.when(F.col("id") % 7 != 3, F.concat(F.lit("é<"), F.col("id").cast("string"), F.lit(">"))).alias("p"))
    want = tree_concat(df.where("p is not null"), "id", "p").first()["html"]
    parts = sorted(text_parts(df, "p", ["id"], fanout=50, partitions=4).collect(), key=lambda r: r["part"])
    assert "".join(r["text"] for r in parts) == want
    at = 0
    for i, r in enumerate(parts):
        assert (r["part"], r["offset"], r["n_chars"]) == (i, at, len(r["text"]))
        at += len(r["text"])
    path = write_text(df, "p", ["id"], f"{tmp_shared}/text", fanout=50, partitions=4)
    for start, length in ((0, None), (10, 5), (123, 2000), (len(want) - 3, 100), (len(want), 5), (500, 0)):
        got = sorted(read_text(spark, path, start, length).collect(), key=lambda r: r["part"])
        assert "".join(r["text"] for r in got) == want[start:None if length is None else start + length], (start, length)


def test_no_fragments_no_parts(spark):
    assert text_parts(spark.createDataFrame([], "id long, p string"), "p", ["id"]).count() == 0


def test_two_million_labels(spark, tmp_shared):
    n = 2_000_000
    df = spark.range(n).select(F.col("id"), F.format_string("<td>%07d</td>", "id").alias("p"))
    path = write_text(df, "p", ["id"], f"{tmp_shared}/large", fanout=4096)
    parts = read_text(spark, path)
    assert parts.count() == -(-n // 4096)
    assert parts.agg(F.max("n_chars")).first()[0] == 4096 * 16 and parts.agg(F.sum("n_chars")).first()[0] == 16 * n
    one = read_text(spark, path, 16 * 1_234_567, 16).collect()
    assert "".join(r["text"] for r in one) == "<td>1234567</td>"


# -- SQL table functions -----------------------------------------------------------------------

SUBS = "PERIODO int, TIPO string, SVA_SMS string, Q_LINEAS_SUSCRITAS long"
DAY = "DATE'2024-04-20', 2"
DATA = [(p, t, s, p % 10 + q) for p in (202401, 202402, 202403, 202405) for t in ("SVA", "SMSP", "OTHER") for s, q in (("a", 1), ("a", 2), (None, 5))] + \
    [(202402, "SVA", "once", 9), (202402, "SVA", "none", None)]


@pytest.fixture
def subs(spark, tmp_shared):
    path = f"{tmp_shared}/subs"
    spark.createDataFrame(DATA, SUBS).write.parquet(path)
    df = spark.read.parquet(path)
    df.createOrReplaceTempView("test_subs")
    assert "monthwise_crosstab" in sql_functions.register(spark, "test_subs")
    return df


def test_functions_equal_the_dataframe_form(spark, subs):
    w = trailing_months(subs, "PERIODO", dt.date(2024, 4, 20), 2)
    sql = lambda q: rows(spark.sql(q))
    assert sql(f"SELECT * FROM monthwise_window({DAY})") == rows(w)
    assert sql(f"SELECT * FROM monthwise_sum_by_type({DAY})") == rows(M.sum_by_type(w).select("PERIODO", "SMS", "SVA"))
    cells = M.sum_by_label(w, "SVA")
    assert sql(f"SELECT PERIODO, SVA_SMS, Q FROM monthwise_sum_by_label('SVA', {DAY})") == rows(cells.select("PERIODO", "SVA_SMS", "Q"))
    grid = X.dense_grid(cells).select("PERIODO", "SVA_SMS", "Q", "is_missing")
    assert sql(f"SELECT PERIODO, SVA_SMS, Q, is_missing FROM monthwise_grid('SVA', {DAY})") == rows(grid)
    cube = C.cube_quantities(w.where("TIPO = 'SVA'"), value="Q_LINEAS_SUSCRITAS", null_label_matches=True)
    assert sql(f"SELECT kind, PERIODO, SVA_SMS, Q FROM monthwise_crosstab('SVA', {DAY})") == rows(cube.select("kind", "PERIODO", "SVA_SMS", "Q_LINEAS_SUSCRITAS"))


def test_a_call_plans_like_the_dataframe_form(spark, subs):
    w = trailing_months(subs, "PERIODO", dt.date(2024, 4, 20), 2).where("TIPO = 'SVA'")
    for call, df in ((f"monthwise_crosstab('SVA', {DAY})", C.cube_quantities(w, value="Q_LINEAS_SUSCRITAS")),
                     (f"monthwise_sum_by_label('SVA', {DAY})", M.sum_by_label(w))):
        a, b = plan_of(spark.sql(f"SELECT * FROM {call}")), plan_of(df)
        for node in ("FileScan", "Expand ", "Exchange ", "HashAggregate", "Join"):
            assert a.count(node) == b.count(node), node
        assert "GreaterThanOrEqual(PERIODO,202402)" in a and "EqualTo(TIPO,SVA)" in a


def test_functions_join_with_other_sql(spark, subs):
    got = spark.sql(f"SELECT c.SVA_SMS, c.Q FROM monthwise_crosstab('SVA', {DAY}) c WHERE c.kind = 'row_total' AND c.SVA_SMS = 'once'")
    assert rows(got) == [("once", 9)]
