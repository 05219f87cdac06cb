"""Operator 7: proportional stratified interleaving into shards.

Rows of one source are shuffled by a seeded hash of their id and ranked; rank r of
n becomes the fractional rank (2r + 1) / 2n.  Sorted by it, the sources interleave
in proportion, so every contiguous cut of the sorted rows holds the mixture.  The
law is ``rows``: shard sizes differ by one row at most.

Neither sort runs in one task: hashes and fractional ranks are spread evenly, so
rows are dealt to BUCKETS equal ranges of them (of a hot source too), numbered
within a range, and shifted by the counts of the ranges before.  Only ids, sources,
sizes and checksums move; texts do not.

Defined results: null text: size 8 and checksum 0; a null source is a stratum of
its own; rows without an id are spread by their text and their number in the input, so that
many of them are no hot range (their places, and with them those of others, then depend on
how the input is cut); repeated ids are ranked like others (equal rows in any
order, their places are interchangeable); fewer rows than shards leave shards empty; an
empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from monthwise.llm.common import materialize, release, table

N_SHARDS = 24
SEED = 17
BUCKETS = 4096


def _numbered(rows: DataFrame, strata: list[str], bucket: str, order: list[str], out: str) -> DataFrame:
    """``rows`` with the 0-based position ``out`` and the size ``out_n`` of its stratum.
    Positions follow ``bucket`` and, inside it, ``order``."""
    counts = rows.groupBy(*strata, bucket).agg(F.count("*").alias("_c"))
    before = Window.partitionBy(*strata).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(*strata, bucket, F.coalesce(F.sum("_c").over(before), F.lit(0)).alias("_off"),
                            F.sum("_c").over(Window.partitionBy(*strata)).alias(f"{out}_n"))
    inside = Window.partitionBy(*strata, bucket).orderBy(*order)
    return rows.withColumn("_i", F.row_number().over(inside)).join(offsets, [*strata, bucket]) \
        .withColumn(out, F.col("_off") + F.col("_i") - 1).drop("_i", "_off")


def assign_shards(docs: DataFrame, n_shards: int = N_SHARDS, id_col: str = "doc_id", text_col: str = "text",
                  source_col: str = "source", seed: int = SEED) -> DataFrame:
    """Per row: id, size, text_crc32, shard and slot (gapless from 0 in its shard)."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    small = materialize(docs.select(
        F.col(id_col).alias("id"), (F.octet_length(text) + 8).cast("long").alias("size"), F.crc32(text).alias("crc"),
        F.col(source_col).isNull().alias("s_null"), F.coalesce(F.col(source_col).cast("string"), F.lit("")).alias("s"),
        F.when(F.col(id_col).isNotNull(), F.xxhash64(F.lit(seed), F.col(id_col)))
        .otherwise(F.xxhash64(F.lit(seed), F.crc32(text), F.monotonically_increasing_id())).alias("h"))
        .withColumn("b", F.shiftrightunsigned("h", 64 - (BUCKETS.bit_length() - 1))), "shard-rows")
    ranked = _numbered(small, ["s_null", "s"], "b", ["h", "id", "crc", "size"], "r")
    spread = materialize(ranked.select("id", "size", "crc", "h", "s_null", "s",
                                       ((2 * F.col("r") + 1) / (2 * F.col("r_n"))).alias("f"),
                                       F.expr(f"((2 * r + 1) * {BUCKETS}) div (2 * r_n)").alias("fb"))
                         .withColumn("all", F.lit(0)), "shard-ranks")
    release(small)
    placed = _numbered(spread, ["all"], "fb", ["f", "h", "id", "s_null", "s", "crc", "size"], "p")
    n = F.lit(n_shards)
    return placed.withColumn("shard", F.expr(f"int((p * {n_shards}) div p_n)")) \
        .select(F.col("id").alias(id_col), "size", F.col("crc").alias("text_crc32"), "shard",
                (F.col("p") - F.expr(f"(shard * p_n + {n_shards} - 1) div {n_shards}")).alias("slot"))


def write_shards(docs: DataFrame, assigned: DataFrame, path: str, files: int, id_col: str = "doc_id") -> None:
    """Write the rows as ``path/shard=<n>/`` in slot order, about ``files`` files in all;
    a shard spans as many range partitions as its rows fill.  Ids are unique."""
    docs.join(assigned.select(id_col, "shard", "slot"), id_col) \
        .repartitionByRange(files, "shard", "slot").sortWithinPartitions("shard", "slot") \
        .write.mode("overwrite").partitionBy("shard").parquet(path)


def op7_sharding(spark, sf_dir: str) -> DataFrame:
    return assign_shards(table(spark, sf_dir, "documents")) \
        .select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
                F.lit(None).cast("int").alias("grown_shard"))
