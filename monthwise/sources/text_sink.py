"""Ordered text of any size, stored as consecutive parts.

``STRING_AGG`` makes one value, which one task must hold.  Here fragments are range-sorted
and numbered, every ``fanout`` of them become one part, and each part knows its offset in the
whole text, from sums over the parts before.  The text is the parts in order; no value
is larger than ``fanout`` fragments.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from monthwise.operators.ranking import rank_labels
from monthwise.operators.render import ordered_concat
from monthwise.session import materialize, release

GROUP = 4096                   # parts whose offsets are summed in one window partition


def text_parts(fragments: DataFrame, piece: str, order: Sequence, fanout: int = 1024,
               partitions: int | None = None) -> DataFrame:
    """Rows (part, offset, n_chars, text): the fragments in ``order`` (unique), NULLs skipped as
    ``STRING_AGG`` does, ``offset`` counting characters from 0.  No rows, no parts."""
    kept = fragments.where(F.col(piece).isNotNull())
    ranked = rank_labels(kept, order, "_rn", partitions).select(F.expr(f"(_rn - 1) div {int(fanout)}").alias("part"),
                                                                F.col("_rn"), F.col(piece).alias("_p"))
    parts = ordered_concat(ranked, ["part"], "_rn", "_p", out="text") \
        .withColumns({"n_chars": F.char_length("text").cast("bigint"), "_g": F.expr(f"part div {GROUP}")})
    parts = materialize(parts, "text-parts")
    groups = parts.groupBy("_g").agg(F.sum("n_chars").alias("_n"))
    before = Window.orderBy("_g").rowsBetween(Window.unboundedPreceding, -1)          # a row for GROUP parts
    starts = groups.select("_g", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    inside = Window.partitionBy("_g").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    own = F.coalesce(F.sum("n_chars").over(inside), F.lit(0))
    return parts.withColumn("_own", own).join(starts, "_g") \
        .select("part", (F.col("_start") + F.col("_own")).cast("bigint").alias("offset"), "n_chars", "text")


def write_text(fragments: DataFrame, piece: str, order: Sequence, path: str, fanout: int = 1024,
               partitions: int | None = None) -> str:
    """Store the parts at ``path`` as Parquet, consecutive parts in consecutive files."""
    parts = materialize(text_parts(fragments, piece, order, fanout, partitions), "text-offsets")
    try:
        parts.repartitionByRange("part").sortWithinPartitions("part").write.mode("overwrite").parquet(path)
    finally:
        release(parts)
    return path


def read_text(spark: SparkSession, path: str, start: int = 0, length: int | None = None) -> DataFrame:
    """The parts that hold ``length`` characters from ``start`` on, cut to them; the
    filter reaches the scan, so only row groups with such parts are read."""
    parts = spark.read.parquet(path)
    end = F.lit(None).cast("bigint") if length is None else F.lit(start + length).cast("bigint")
    if start or length is not None:
        parts = parts.where(F.col("offset") + F.col("n_chars") > start)
    if length is not None:
        parts = parts.where(F.col("offset") < start + length)
    first = F.greatest(F.lit(start).cast("bigint") - F.col("offset"), F.lit(0).cast("bigint"))
    last = F.least(F.coalesce(end - F.col("offset"), F.col("n_chars")), F.col("n_chars"))
    return parts.select("part", (F.col("offset") + first).alias("offset"), (last - first).alias("n_chars"),
                        F.substr("text", (first + 1).cast("int"), (last - first).cast("int")).alias("text"))
