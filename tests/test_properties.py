"""Property tests: digit grouping and ordered chunked concatenation."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from monthwise.functions import formatting as FM
from monthwise.operators import render as R

SETTINGS = settings(max_examples=15, deadline=None,
                    suppress_health_check=[HealthCheck.function_scoped_fixture])


@SETTINGS
@given(st.lists(st.integers(min_value=-10**15, max_value=10**15), min_size=1, max_size=40))
def test_group_digits_roundtrip(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "v long")
    got = df.select("v", FM.group_digits("v").alias("g"),
                    FM.group_digits("v", legacy=True).alias("l")).collect()
    for r in got:
        assert int(r.g.replace(".", "")) == r.v
        groups = r.g.lstrip("-").split(".")
        assert all(len(x) == 3 for x in groups[1:]) and 1 <= len(groups[0]) <= 3
        assert r.l == r.g.lstrip("-")


@SETTINGS
@given(st.lists(st.text(alphabet="ab<>/", min_size=0, max_size=4), min_size=0, max_size=300),
       st.integers(min_value=2, max_value=9), st.integers(min_value=0, max_value=3))
def test_tree_concat_equals_join(spark, pieces, fanout, levels):
    df = spark.createDataFrame([(i, p) for i, p in enumerate(pieces)], "pos long, p string")
    got = R.tree_concat(df.repartition(3), "pos", "p", fanout=fanout, levels=levels).first().html
    assert (got or "") == "".join(pieces)
