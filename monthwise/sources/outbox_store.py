"""A Parquet outbox table partitioned by ``FECHA``, rewritten safely.

Row-level DELETE/UPDATE are not available on plain Parquet, so a change is a
``StagedTable`` rewrite of the date partitions it touches: an interrupted one is finished or
undone by the next use.  The target is never overwritten while it is being read.
NULL is a date like others: it has its own partition, and dates are compared null-safely.

Which dates a key touches is answered by a sketch kept beside the table, not by reading it.
For each date it is a Bloom filter of the subjects in blocks of 64 bits: a subject's hash
names a block and BITS bits in it.  Only blocks with a bit are rows, so a date costs at most
CELLS small rows, however many subjects it has.  A false hit costs reading a date more.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from monthwise.operators import outbox as O
from monthwise.session import materialize, release
from monthwise.sources.staged import StagedTable

CELLS = 1 << 20                # blocks of a date's sketch
BITS = 5                       # bits that a subject sets in its block
SKETCH_SCHEMA = "FECHA date, cell int, mask bigint"


def _block(key: str) -> tuple[Column, Column]:
    """(block, bits in it) of a key's hash."""
    h = F.xxhash64(F.col(key))
    bits = [F.expr(f"shiftleft(1L, int(shiftrightunsigned(xxhash64(`{key}`), {20 + 6 * k}) & 63))") for k in range(BITS)]
    return h.bitwiseAND(CELLS - 1).cast("int").alias("cell"), reduce(lambda a, b: a.bitwiseOR(b), bits).alias("mask")


class OutboxStore(StagedTable):
    def __init__(self, spark: SparkSession, path: str, partition_col: str = "FECHA"):
        super().__init__(spark, path, O.OUTBOX_SCHEMA, partition_col, {"keys": SKETCH_SCHEMA})

    def _sketches(self, rows: DataFrame) -> dict[str, DataFrame]:
        """The sketch of whole dates; rows without a subject are in no block."""
        blocks = rows.where(F.col("SUBJECT").isNotNull()).select(self.partition_col, *_block("SUBJECT"))
        return {"keys": blocks.groupBy(self.partition_col, "cell").agg(F.bit_or("mask").alias("mask"))}

    def _has_sketch(self) -> bool:
        """Tables written by this class have one; a date whose rows all lack a subject has no block."""
        fs, jpath = self._fs_path(self._side_path("keys"))
        return not self.partitions() or fs.exists(jpath)

    def _dates(self, df: DataFrame) -> set:
        """Distinct dates: one value for a day, NULL included."""
        return {r[0] for r in df.select(self.partition_col).distinct().collect()}

    def dates_of(self, keys: DataFrame, key: str = "SUBJECT") -> set:
        """Dates that may hold one of ``keys`` (distinct), from the sketch; every date that
        does is among them.  A table without a sketch is read instead."""
        if key != "SUBJECT" or not self._has_sketch():
            return self._dates(self._read(self.path, self.schema).join(keys, key, "left_semi"))
        wanted = keys.where(F.col(key).isNotNull()).select(_block(key)[0], _block(key)[1].alias("bits")).distinct()
        hit = self.side("keys").join(wanted, "cell").where(F.col("mask").bitwiseAND(F.col("bits")) == F.col("bits"))
        return self._dates(hit)

    def current(self, dates: set) -> DataFrame:
        """The table's rows of some dates; the other partitions are not read."""
        return self._read(self.path, self.schema).where(self.only(dates))

    def _folders_of(self, dates: set) -> set[str]:
        return {self.folder_of(d) for d in dates}

    def write_all(self, df: DataFrame) -> None:
        """``df`` becomes the whole table."""
        self.recover()
        self.rewrite(df, self.partitions(), self._sketches)

    def replace(self, incoming: DataFrame, key: str = "SUBJECT", keep_sent: bool = False) -> None:
        """Replace-by-key.  Partitions that may hold a replaced key or get an incoming row are rewritten."""
        self.recover()
        incoming = materialize(incoming.select(*O.OUTBOX_COLUMNS), "outbox-incoming")     # evaluated once
        try:
            touched = self.dates_of(incoming.select(key).distinct(), key) | self._dates(incoming)
            new_rows = O.replace_by_key(self.current(touched), incoming, key, keep_sent)
            self.rewrite(new_rows, self._folders_of(touched), self._sketches)
        finally:
            release(incoming)

    def mark_processed(self, sent: DataFrame, key: str = "SUBJECT") -> None:
        """Flip pending rows of the sent keys; only partitions with such rows are rewritten."""
        self.recover()
        keys = materialize(sent.select(key).distinct(), "outbox-sent")
        try:
            rows = self.current(self.dates_of(keys, key))
            touched = self._dates(O.pending(rows).join(keys, key, "left_semi"))
            if touched:
                self.rewrite(O.mark_processed(self.current(touched), keys, key), self._folders_of(touched), self._sketches)
        finally:
            release(keys)

    def pending(self) -> DataFrame:
        return O.pending(self.read())

    def count_by_status(self) -> DataFrame:
        return self.read().groupBy("PROCESADO").agg(F.count(F.lit(1)).alias("n"))
