"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

from contextlib import contextmanager

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from monthwise.session import materialize, release, shared_path  # noqa: F401

BLOOM_BITS = 1 << 24
BATCH_ROWS = 512               # rows in one Arrow batch: bounds a Python worker's memory


def bounded_batches(spark: SparkSession, rows: int = BATCH_ROWS) -> None:
    """Texts can be long, so Arrow batches hold few rows."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))


@contextmanager
def small_batches(spark: SparkSession, rows: int = BATCH_ROWS):
    """Arrow batches of few rows for the jobs that run inside; the session's own setting is
    back afterwards, so results that are read later must be written inside."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, str(rows))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def few(df: DataFrame, rows: int, per_task: int = 50_000) -> DataFrame:
    """``df`` of about ``rows`` rows in as many tasks as these fill, never more than it has."""
    return df.coalesce(rows // per_task + 1)


def bloom_bits(n: int) -> int:
    """Size of a filter of ``n`` hashes: 16 bits for each, a power of two, 32 MB at most.
    Beyond, more rows pass the filter than need to; which ones are right is decided later."""
    return min(1 << 28, max(1 << 20, 1 << (16 * n).bit_length()))


def bloom(hashes: DataFrame, n_bits: int = BLOOM_BITS) -> np.ndarray:
    """Bytes of a Bloom filter of ``n_bits`` over the column ``h`` (64-bit hashes), two
    bits for each: a given size, however many hashes there are."""
    bits = F.explode(F.array("h", F.shiftrightunsigned("h", 32))).alias("h")
    words = hashes.select(bits).select(F.shiftright("h", 6).bitwiseAND(n_bits // 64 - 1).alias("w"),
                                       F.expr("shiftleft(1L, int(h & 63))").alias("bit")) \
        .groupBy("w").agg(F.bit_or("bit").alias("bits")).toArrow()
    out = np.zeros(n_bits // 64, dtype=np.int64)
    out[words["w"].to_numpy()] = words["bits"].to_numpy()
    return out.view(np.uint8)


def in_bloom(bits: np.ndarray, h: np.ndarray) -> np.ndarray:
    """Which of the hashes may be among those of the filter."""
    h = h.view(np.uint64)
    ok = np.ones(len(h), dtype=bool)
    for x in (h, h >> np.uint64(32)):
        at = (x & np.uint64(8 * len(bits) - 1)).astype(np.int64)
        ok &= (bits[at >> 3] >> (at & 7)) & 1 == 1
    return ok


def numbers_of(pairs: DataFrame, keep) -> DataFrame | None:
    """For rows (id, what): None if every id has one ``what``.  Else a number for each pair with
    an id, in the order of the ids: the smallest number is that of the smallest id."""
    known = pairs.where("id is not null")
    if known.groupBy("id").agg(F.min("what").alias("a"), F.max("what").alias("b")).where("a != b").isEmpty():
        return None
    return keep(known.distinct().repartitionByRange("id", "what").sortWithinPartitions("id", "what")
                .withColumn("number", F.monotonically_increasing_id()), "numbers")


def named(rows: DataFrame, numbers: DataFrame, columns: list[str]) -> DataFrame:
    """``rows`` with the numbers in ``columns`` replaced by their ids."""
    for c in columns:
        ids = numbers.select(F.col("number").alias(c), F.col("id").alias("_id"))
        rows = rows.join(ids, c, "left").withColumn(c, F.col("_id")).drop("_id")
    return rows


class Keeper:
    """Writes intermediates to the checkpoint folder and remembers them."""

    def __init__(self):
        self.made: list[DataFrame] = []

    def __call__(self, df: DataFrame, name: str) -> DataFrame:
        out = materialize(df, name)
        self.made.append(out)
        return out

    def last(self, df: DataFrame, name: str) -> DataFrame:
        """Written like the others, but it outlives the block."""
        return materialize(df, name)

    def drop(self, df: DataFrame) -> None:
        self.made.append(df)


@contextmanager
def scratch():
    """Materialised intermediates that are deleted when the block ends."""
    keep = Keeper()
    try:
        yield keep
    finally:
        for df in keep.made:
            release(df)
