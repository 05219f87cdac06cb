"""Parts and dimensions stored in buckets of their join key.

A join of two tables that are bucketed by the key into equally many buckets needs no
exchange: bucket i meets bucket i.  Worth it for sides that are joined again and again,
as the month parts with their labels' dimension.  The files lie below the shared checkpoint
folder; the table is a name in the session's catalog.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from monthwise.session import delete_path, shared_path


class BucketedTable:
    def __init__(self, spark: SparkSession, name: str, path: str, key: str):
        self.spark, self.name, self.path, self.key = spark, name, path, key

    def read(self) -> DataFrame:
        return self.spark.table(self.name)

    def drop(self) -> None:
        """Remove the table and its files (an external table keeps them otherwise)."""
        self.spark.sql(f"DROP TABLE IF EXISTS {self.name}")
        delete_path(self.spark, self.path)


def store_bucketed(df: DataFrame, key: str, buckets: int, name: str = "bucketed") -> BucketedTable:
    """Write ``df`` bucketed and sorted by ``key``, one file a bucket.  A key that holds a large
    part of the rows makes a large bucket: store parts (a row for a key and month), not rows."""
    spark = df.sparkSession
    table, path = f"monthwise_{name}_{uuid.uuid4().hex[:12]}", shared_path(spark, name)
    df.repartition(buckets, key).write.format("parquet").bucketBy(buckets, key).sortBy(key) \
        .option("path", path).saveAsTable(table)
    return BucketedTable(spark, table, path, key)


def join_stored(left: BucketedTable, right: BucketedTable, how: str = "left") -> DataFrame:
    """Sort-merge join bucket by bucket: no exchange on either side."""
    if left.key != right.key:
        raise ValueError("both sides must be bucketed by the join key")
    return left.read().join(right.read().hint("merge"), left.key, how)
