"""Quality rules against a plain count; the query against its SQL is in test_queries."""

import re

from pyspark.sql import functions as F

from monthwise.llm import quality as q

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain(text):
    text = text or ""
    w = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    at: dict = {}
    for i in range(len(w) - 4):
        at.setdefault(tuple(w[i:i + 5]), []).append(i)
    repeated = {i + j for p in at.values() if len(p) > 1 for i in p for j in range(5)}
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(repeated))


TEXTS = [
    None, "", " \n ", "one two", "a b c d e a b c d e", "a a a a a a a", "x y z " * 30, "l1 is\nl1 is\n\n \nl1 is",
    "# a $ b | c < d > & %", "\x0bé 日本 über\tß\r\n" * 4, "a b c d e f g h i j k l m n a b c d e",
    " ".join(f"w{i}" for i in range(40)), "w " * 20000 + "end", "SHOUTING ALL THE TIME IN THIS TEXT HERE NOW OK YES",
    "col | col2 | col3 | " * 2 + "some words in here follow",
]


def test_measures_equal_a_plain_count(spark):
    df = spark.createDataFrame([(i, t, 1) for i, t in enumerate(TEXTS)], "doc_id long, text string, n_words int")
    got = df.select("doc_id", q.measures(F.col("text"), list(q.RULES)).alias("q")).select("doc_id", "q.*").collect()
    for r in got:
        n, chars, symbols, dup, rep = plain(TEXTS[r["doc_id"]])
        assert tuple(r)[1:6] == (n, chars, symbols, dup, rep), TEXTS[r["doc_id"]]
        assert r["base_failed"] == (n < 10 or 100 * rep > 20 * n)
        assert not (r["base_failed"] and r["kept"])


def test_cascade_order_never_changes_the_verdict(spark):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(TEXTS)], "doc_id long, text string")
    order = [r for r, _, _ in q.plan_cascade(df)]
    assert sorted(r.name for r in order) == sorted(r.name for r in q.RULES + q.BASE_RULES)
    kept = {tuple(sorted(r["doc_id"] for r in df.where(q.passes("text", rules)).collect()))
            for rules in (order, order[::-1], list(q.RULES + q.BASE_RULES))}
    assert len(kept) == 1
    assert sorted(r["doc_id"] for r in q.quality_filter(df).collect()) == list(kept.pop())


def test_cheap_selective_rules_come_first(spark):
    df = spark.createDataFrame([(i, "one two") for i in range(20)], "doc_id long, text string")
    assert q.plan_cascade(df)[0][0].name == "few_words"


def test_empty_table_and_columns(spark):
    df = spark.createDataFrame([], "doc_id long, text string, w string, t int")
    out = q.quality_filter(df)
    assert out.columns == df.columns and out.count() == 0


def test_no_python_in_the_plan(spark):
    df = spark.createDataFrame([(1, "a")], "doc_id long, text string").repartition(2)
    plan = df.where(q.passes("text", q.RULES))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
