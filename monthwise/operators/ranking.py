"""First-row-per-key, top-n and global row numbering.

None of these sends an unbounded group to one task:
* ``first_per_key`` is an aggregate (``min``/``max`` over a struct), so each key
  is reduced map-side before the shuffle, however hot it is;
* top-n uses ``orderBy().limit(n)`` (TakeOrderedAndProject: n rows per partition,
  then n rows merged) and ranks only those n rows;
* ``rank_labels`` numbers any number of rows with a range-partitioned sort, written
  once, and per-range offsets instead of a single-partition window.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from monthwise.session import materialize


def _list(x) -> list:
    return [x] if isinstance(x, (str, Column)) else list(x)


def first_per_key(df: DataFrame, keys, order, descending: bool = False) -> DataFrame:
    """Row with the smallest (or largest) ``order`` tuple per key.

    Same result as ``QUALIFY ROW_NUMBER() OVER (PARTITION BY keys ORDER BY order) = 1``
    when ``order`` is unique within a key (NULLs first ascending, last descending),
    but computed as a partial aggregate rather than a per-key sort.
    """
    keys = _list(keys)
    order = _list(order)
    key_names = [k for k in keys if isinstance(k, str)]
    rest = [c for c in df.columns if c not in key_names]
    best = F.struct(*[F.col(o) if isinstance(o, str) else o for o in order],
                    F.struct(*rest).alias("row"))
    pick = F.max(best) if descending else F.min(best)
    out = df.groupBy(*keys).agg(pick.alias("_best"))
    return out.select(*[F.col(f"`{c}`") for c in out.columns[:len(keys)]], "_best.row.*")


def label_order(total: str, label: str, descending: bool = True) -> list[Column]:
    """Measure order with the label as tie-break (NULL measures last, NULL label first)."""
    m = F.col(total).desc_nulls_last() if descending else F.col(total).asc_nulls_first()
    return [m, F.col(label).asc_nulls_first()]


def _rank_top(top: DataFrame, order: list[Column], rank_col: str) -> DataFrame:
    # The input holds at most n rows, so a global window is a bounded, single-task step.
    return top.withColumn(rank_col, F.row_number().over(Window.orderBy(*order)).cast("bigint"))


def top_n_by_total(df: DataFrame, label: str = "SVA_SMS", qty: str = "Q", n: int = 10,
                   out: str = "total_general", rank_col: str = "rn") -> DataFrame:
    """Labels by ``SUM(qty)`` descending (label ascending on ties), first ``n``, ranked 1..n."""
    totals = df.groupBy(label).agg(F.sum(qty).alias(out))
    order = label_order(out, label)
    return _rank_top(totals.orderBy(*order).limit(n), order, rank_col)


def top_n_by_mean(df: DataFrame, label: str = "SVA_SMS", value: str = "ARPU", n: int = 10,
                  out: str = "arpu_promedio", rank_col: str = "rn", digits: int = 0) -> DataFrame:
    """Labels by ``ROUND(AVG(value), 0)`` descending (NULL values skipped), first ``n``, ranked."""
    means = df.groupBy(label).agg(F.round(F.avg(value), digits).alias(out))
    order = label_order(out, label)
    return _rank_top(means.orderBy(*order).limit(n), order, rank_col)


def rank_labels(df: DataFrame, order: Sequence, rank_col: str = "rn",
                partitions: int | None = None) -> DataFrame:
    """Global 1..k row number over ``order`` without a single-partition window.

    Rows are range-partitioned on ``order`` (``partitions``, default the session's
    shuffle partitions), sorted, and written once with their range and their
    position in it.  Ranges, positions and the offsets (rows in the ranges before,
    one row per range) are all read from that table, so no later step can see other
    bounds: neither exchange reuse nor column pruning nor a lost executor changes a
    number.  ``order`` should be unique per row.
    """
    order = [F.col(o) if isinstance(o, str) else o for o in _list(order)]
    n = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    mask = (1 << 33) - 1
    placed = df.repartitionByRange(n, *order).sortWithinPartitions(*order) \
        .withColumn("_mid", F.monotonically_increasing_id()) \
        .withColumns({"_range": F.spark_partition_id(), "_pos": F.col("_mid").bitwiseAND(F.lit(mask))}).drop("_mid")
    placed = materialize(placed, "ranked")
    counts = placed.groupBy("_range").agg(F.count(F.lit(1)).alias("_cnt"))
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_range", F.coalesce(F.sum("_cnt").over(before), F.lit(0)).alias("_off"))
    return placed.join(offsets, "_range") \
        .withColumn(rank_col, (F.col("_off") + F.col("_pos") + 1).cast("bigint")).drop("_range", "_pos", "_off")
