"""CSV exports in parts of bounded size with a manifest that tells whether they are whole.

The table is evaluated once, into a written stage with each row's size as CSV.  Running sizes
within what one task wrote cut it into parts, none larger than ``max_part_bytes`` unless a single row
is: a file with quoted line breaks is read whole by one task, so its size must be bounded.  The
manifest holds, for each part, its rows, bytes and the sum of its rows' hashes, which does not depend
on their order and changes with a changed, lost or doubled row.  It is written last: an
export without one is not complete.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from monthwise.session import materialize, release
from monthwise.sources.export import CSV_FORMAT, export_csv, read_csv

MAX_PART_BYTES = 128 << 20


def _line(columns: list[str]) -> Column:
    """The row as the CSV writer prints it."""
    options = {k: str(v) for k, v in CSV_FORMAT.items() if k != "lineSep"} | {"nullValue": "", "emptyValue": '""'}
    return F.to_csv(F.struct(*columns), options)


def _sums(rows: DataFrame) -> DataFrame:
    """Per part, of rows (part, _bytes, _hash): rows, bytes and the sum of row hashes."""
    return rows.groupBy("part").agg(F.count("*").alias("n_rows"), F.sum("_bytes").cast("bigint").alias("n_bytes"),
                                    F.sum(F.col("_hash").cast("decimal(38,0)")).alias("hash_sum"))


def _measured(df: DataFrame, columns: list[str]) -> DataFrame:
    """``df`` with each row's bytes and hash as a CSV line of ``columns``."""
    line = _line(columns)
    return df.withColumns({"_bytes": F.octet_length(line) + 1, "_hash": F.xxhash64(line)})


def _cut(staged: DataFrame, max_part_bytes: int) -> DataFrame:
    """The stage's rows with their ``part``.  Rows of at most half the bound go to the part in whose half
    bound they start, so that none exceeds the bound; larger rows are a part each.  A stage task's
    rows are numbered by that task (the upper bits of ``_n``) and cut apart from the others'."""
    before = Window.partitionBy("_task").orderBy("_n").rowsBetween(Window.unboundedPreceding, -1)
    small = F.col("_bytes") * 2 <= max_part_bytes
    start = F.coalesce(F.sum(F.when(small, F.col("_bytes")).otherwise(0)).over(before), F.lit(0))
    large = F.coalesce(F.sum(F.when(small, 0).otherwise(1)).over(before), F.lit(0))
    piece = F.when(small, F.floor(start * 2 / max_part_bytes)).otherwise(large + (1 << 31))
    return staged.withColumn("_task", F.shiftrightunsigned("_n", 33)) \
        .withColumn("part", F.shiftleft("_task", 32) + piece.cast("bigint"))


def export_parts(df: DataFrame, path: str, max_part_bytes: int = MAX_PART_BYTES, **options) -> DataFrame:
    """Export ``df`` as CSV under ``path/part=<n>/`` and its manifest at ``path/_manifest``; the
    manifest.  A column named ``part`` must be renamed before."""
    columns = df.columns
    staged = materialize(_measured(df, columns).withColumn("_n", F.monotonically_increasing_id()), "export-stage")
    try:
        # a stage task's rows are in one task here, so each part is one file
        export_csv(_cut(staged, max_part_bytes).select(*columns, "part").sortWithinPartitions("part"), path,
                   partition_by=["part"], **options)
        sizes = staged.select("_n", "_bytes", "_hash")                  # the manifest takes no second look at the rows
        _sums(_cut(sizes, max_part_bytes)).coalesce(1).write.mode("overwrite").parquet(f"{path}/_manifest")
    finally:
        release(staged)
    return read_manifest(df.sparkSession, path)


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("part bigint, n_rows bigint, n_bytes bigint, hash_sum decimal(38,0)").parquet(f"{path}/_manifest")


def read_parts(spark: SparkSession, path: str, schema: StructType, **options) -> DataFrame:
    """The exported rows and their part."""
    return read_csv(spark, path, StructType([*schema.fields]).add("part", "long"), **options)


def verify_parts(spark: SparkSession, path: str, schema: StructType, **options) -> DataFrame:
    """Per part of the manifest or the files: part, n_rows and found_rows, and the status ``ok``,
    ``changed`` (other rows, more or fewer), ``lost`` (no file) or ``extra`` (not in the manifest)."""
    want = read_manifest(spark, path)
    rows = read_parts(spark, path, schema, **options)
    found = _sums(_measured(rows, [f.name for f in schema.fields]).select("part", "_bytes", "_hash")) \
        .select("part", F.col("n_rows").alias("found_rows"), F.col("hash_sum").alias("found_sum"))
    status = F.when(F.col("n_rows").isNull(), "extra").when(F.col("found_rows").isNull(), "lost") \
        .when((F.col("n_rows") == F.col("found_rows")) & (F.col("hash_sum") == F.col("found_sum")), "ok").otherwise("changed")
    return want.join(found, "part", "full").select("part", "n_rows", "found_rows", status.alias("status"))
