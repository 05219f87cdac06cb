"""A Parquet table changed by whole partitions, with a redo record.

Plain Parquet has no row-level DELETE or UPDATE, and Spark's dynamic partition
overwrite replaces one partition after the other: a driver lost in between leaves
a mixture.  Here a change is

1. staged: the new rows of the touched partitions, in a folder of the table;
2. recorded: one small file names the touched partitions; from here on the change counts;
3. applied: touched partitions are overwritten from the stage, emptied ones removed, and
   likewise in the side tables that describe them;
4. finished: the record goes, then the stage.

``recover`` (called before every use) deletes stages without a record and applies
those with one again.  Each step gives the same result when it is repeated, so the
table is the old or the new one, never a mixture.  One writer at a time.

Everything lies below the table's path in folders whose names start with ``_``, which
Spark does not read as data, so the table is recovered by whoever opens it next.
"""

from __future__ import annotations

import datetime as dt
import json
import uuid
from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType

NULL_PARTITION = "__HIVE_DEFAULT_PARTITION__"


class StagedTable:
    """``schema`` is a DDL string with the partition column (a date or an integer;
    NULL is a partition of its own).  ``sides``: name -> DDL of side tables, which are
    partitioned by the same column and change with the partitions they describe."""

    def __init__(self, spark: SparkSession, path: str, schema: str, partition_col: str,
                 sides: dict[str, str] | None = None):
        self.spark = spark
        self.path = path.rstrip("/")
        self.schema = schema
        self.partition_col = partition_col
        self.side_schemas = sides or {}

    # -- files ------------------------------------------------------------------
    def _fs_path(self, path: str):
        jpath = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        return jpath.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()), jpath

    def _folders(self, path: str) -> list[str]:
        """Names of the folders in ``path`` (partitions or stages: never rows)."""
        fs, jpath = self._fs_path(path)
        if not fs.exists(jpath):
            return []
        return [s.getPath().getName() for s in fs.listStatus(jpath) if s.isDirectory()]

    def _delete(self, path: str) -> None:
        fs, jpath = self._fs_path(path)
        if fs.exists(jpath):
            fs.delete(jpath, True)

    # -- partitions --------------------------------------------------------------
    def folder_of(self, value) -> str:
        text = NULL_PARTITION if value is None else (value.isoformat() if isinstance(value, dt.date) else str(value))
        return f"{self.partition_col}={text}"

    def partitions(self, path: str | None = None) -> set[str]:
        """Folder names of the partitions present."""
        return {n for n in self._folders(path or self.path) if n.startswith(f"{self.partition_col}=")}

    def only(self, values: Iterable) -> Column:
        """Literal filter on the partition column, which prunes the other partitions."""
        some = sorted(v for v in values if v is not None)
        out = F.col(self.partition_col).isin(some) if some else F.lit(False)
        return out | F.col(self.partition_col).isNull() if None in values else out

    # -- reading -----------------------------------------------------------------
    def _read(self, path: str, schema: str) -> DataFrame:
        # the schema is given: a table may hold no partition to infer it from
        spark = self.spark
        fs, jpath = self._fs_path(path)
        if not fs.exists(jpath):
            return spark.createDataFrame([], schema)
        return spark.read.schema(schema).parquet(path).select(*DataType.fromDDL(schema).fieldNames())

    def read(self) -> DataFrame:
        self.recover()
        return self._read(self.path, self.schema)

    def side(self, name: str) -> DataFrame:
        return self._read(self._side_path(name), self.side_schemas[name])

    def _side_path(self, name: str) -> str:
        return f"{self.path}/_side/{name}"

    # -- the four steps ------------------------------------------------------------
    def rewrite(self, new_rows: DataFrame, touched: Iterable[str],
                sides: Callable[[DataFrame], dict[str, DataFrame]] | None = None) -> None:
        """Replace the partitions in ``touched`` (folder names) and those of ``new_rows``
        by ``new_rows``; partitions left without rows go.  ``new_rows`` may read the table.
        ``sides`` gives the side tables' rows of these partitions from the staged rows."""
        token = uuid.uuid4().hex
        self._stage(new_rows, token, sides)
        self._record(token, set(touched))
        self._carry_out(token)

    def _redo(self, token: str) -> str:
        return f"{self.path}/_redo/{token}"

    def _write(self, df: DataFrame, path: str, mode: str, schema: str) -> None:
        # rows of a partition go together, and a partition too large for one task is split
        df.select(*DataType.fromDDL(schema).fieldNames()).hint("rebalance", self.partition_col) \
            .write.mode("overwrite").option("partitionOverwriteMode", mode) \
            .partitionBy(self.partition_col).parquet(path)

    def _tables(self) -> list[tuple[str, str, str]]:
        """(folder in a stage, path, schema) of the table and its sides."""
        return [("rows", self.path, self.schema)] + \
            [(f"side-{name}", self._side_path(name), schema) for name, schema in self.side_schemas.items()]

    def _stage(self, new_rows: DataFrame, token: str, sides) -> None:
        self._write(new_rows, f"{self._redo(token)}/rows", "static", self.schema)
        staged = self._read(f"{self._redo(token)}/rows", self.schema)
        for name, rows in (sides(staged) if sides else {}).items():
            self._write(rows, f"{self._redo(token)}/side-{name}", "static", self.side_schemas[name])

    def _record(self, token: str, touched: set[str]) -> None:
        for folder, _, _ in self._tables():
            touched = touched | self.partitions(f"{self._redo(token)}/{folder}")
        body = json.dumps({"touched": sorted(touched)})
        fs, tmp = self._fs_path(f"{self._redo(token)}/record.tmp")
        out = fs.create(tmp, True)
        out.write(bytearray(body.encode()))
        out.close()
        fs.rename(tmp, self._fs_path(f"{self._redo(token)}/record")[1])

    def _recorded(self, token: str) -> set[str] | None:
        fs, jpath = self._fs_path(f"{self._redo(token)}/record")
        if not fs.exists(jpath):
            return None
        stream = fs.open(jpath)
        try:
            return set(json.loads(bytes(stream.readAllBytes()).decode())["touched"])
        finally:
            stream.close()

    def _apply(self, token: str, touched: set[str]) -> None:
        for folder, path, schema in self._tables():
            stage = f"{self._redo(token)}/{folder}"
            present = self.partitions(stage)
            if present:
                self._write(self._read(stage, schema), path, "dynamic", schema)
            for name in touched - present:
                self._delete(f"{path}/{name}")

    def _finish(self, token: str) -> None:
        self._delete(f"{self._redo(token)}/record")
        self._delete(self._redo(token))

    def _carry_out(self, token: str) -> None:
        touched = self._recorded(token)
        if touched is not None:
            self._apply(token, touched)
        self._finish(token)

    def recover(self) -> int:
        """Finish or undo what an interrupted change left; how many there were."""
        left = self._folders(f"{self.path}/_redo")
        for token in left:
            self._carry_out(token)
        return len(left)
