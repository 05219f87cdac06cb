"""Fact tables stored by period and clustered by label.

A period is a folder, so the trailing window reads no other month; inside, rows are sorted
by label, so that a label's rows lie in few row groups.  Files come from ranges of
(period, label, a spread of equal keys): a month or a label with a third of all rows is
cut into as many files as others of its size.

The reads below decide at run time which folders are opened: the calendar gate is a scalar
subquery or a small joined table in the scan's partition filters, so that a shut gate reads
no fact at all.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType

from monthwise.functions.periods import DEFAULT_RUN_DAYS, as_of_col, period_bound, period_key
from monthwise.sources.staged import NULL_PARTITION


class FactLayout:
    """``schema`` (DDL) holds the period column, an integer ``yyyymm``; ``cluster`` are the
    columns that rows of a period are sorted by.  Rows without a period have a folder of
    their own and belong to no window."""

    def __init__(self, spark: SparkSession, path: str, schema: str, period: str = "PERIODO",
                 cluster: Sequence[str] = ("SVA_SMS",)):
        self.spark, self.path, self.schema = spark, path.rstrip("/"), schema
        self.period, self.cluster = period, list(cluster)

    def append(self, rows: DataFrame, partitions: int | None = None) -> None:
        """Add rows in new files of their periods; ``partitions`` bounds the files of a period
        (default: as many as their size asks for)."""
        keys = [self.period, *self.cluster]
        rows = rows.select(*DataType.fromDDL(self.schema).fieldNames()).withColumn("_spread", F.rand(5))
        ranged = rows.repartitionByRange(*([partitions] if partitions else []), *keys, "_spread")
        ranged.sortWithinPartitions(*keys).drop("_spread") \
            .write.mode("append").partitionBy(self.period).parquet(self.path)

    def read(self) -> DataFrame:
        return self.spark.read.schema(self.schema).parquet(self.path) \
            .select(*DataType.fromDDL(self.schema).fieldNames())

    def gated_window(self, calendar: DataFrame, as_of=None, n_back: int = 7,
                     days: Sequence[str] = DEFAULT_RUN_DAYS, date_col: str = "DIA_FECHA",
                     name_col: str = "DAYNAMELONG") -> DataFrame:
        """The trailing window if the calendar's weekday of ``as_of`` is a run day, else no rows.

        The bound is a scalar subquery on the calendar: NULL without a run day, and then no
        folder passes; two calendar rows for the day raise an error, as in ``calendar_gate``.
        """
        one = calendar.where(F.col(date_col) == as_of_col(as_of))
        bound = one.select(F.when(F.col(name_col).isin(list(days)), period_bound(as_of, n_back)).alias("bound")).scalar()
        return self.read().where(F.col(self.period) >= bound)

    def months_of(self, days: DataFrame, date_col: str = "DIA_FECHA") -> DataFrame:
        """Facts of the months that hold one of ``days`` (for example the run days of a quarter).
        The months, one row each, prune the folders when the join starts."""
        months = days.select(period_key(date_col).alias(self.period)).distinct()
        return self.read().join(months, self.period, "left_semi")

    def fingerprints(self) -> DataFrame:
        """Per period: number of files, their bytes, and an order-free digest of their names,
        sizes and times.  File statuses are read, no rows."""
        files = self.spark.read.format("binaryFile").option("recursiveFileLookup", True) \
            .option("pathGlobFilter", "*.parquet").load(self.path).select("path", "length", "modificationTime")
        folder = F.regexp_extract("path", rf"/{self.period}=([^/]+)/[^/]+$", 1)
        return files.select(F.when(folder != NULL_PARTITION, folder).cast("int").alias(self.period),
                            F.col("length").alias("n"),
                            F.xxhash64(F.element_at(F.split("path", "/"), -1), "length", F.unix_micros("modificationTime")).alias("h")) \
            .groupBy(self.period).agg(F.count("*").alias("n_files"), F.sum("n").alias("n_bytes"), F.bit_xor("h").alias("digest"))
