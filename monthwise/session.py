"""Session settings and shared-storage helpers.

The library never creates machine-local scratch space on a cluster: anything it
must persist (lineage cuts, staged outbox rewrites, export read-backs) goes under
the shared folder named by ``spark.checkpoint.dir``.  Without that setting a
folder is chosen only when the master is local; on a cluster it is an error.
"""

from __future__ import annotations

import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Settings every job of the library assumes: one clock (UTC), ANSI arithmetic
# (division by zero raises), adaptive execution with skew-join splitting.
SESSION_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


# application id -> folders that were made for it
_written: dict[str, set[str]] = {}


def get_session(master: str = "local[*]", shuffle_partitions: int = 8,
                app_name: str = "monthwise", extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.master(master).appName(app_name)
    conf = dict(SESSION_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def apply_session_conf(spark: SparkSession) -> None:
    """Pin the runtime-settable options on an existing session (driver-made sessions)."""
    for k, v in SESSION_CONF.items():
        if k.startswith("spark.sql."):
            spark.conf.set(k, v)


def is_one_machine(master: str) -> bool:
    """Driver and tasks run in one process: a folder of this machine is shared by all of them."""
    return master == "local" or master.startswith("local[")


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the session's shared checkpoint folder, setting one only when unset."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        if not is_one_machine(sc.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        configured = tempfile.mkdtemp(prefix="monthwise-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir()


def shared_path(spark: SparkSession, *parts: str, unique: bool = True) -> str:
    """A path under the shared checkpoint folder (never a machine-local temp dir).  A
    unique one is scratch space of this application: ``release_all`` deletes it."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    leaf = "/".join(p.strip("/") for p in parts if p)
    if unique:
        leaf = f"{leaf}-{uuid.uuid4().hex[:12]}" if leaf else uuid.uuid4().hex[:12]
        _written.setdefault(spark.sparkContext.applicationId, set()).add(f"{base}/monthwise/{leaf}")
    return f"{base}/monthwise/{leaf}"


def materialize(df: DataFrame, name: str = "materialized") -> DataFrame:
    """Write ``df`` as a Parquet table under the shared checkpoint folder and read it back.

    One write job; the result's lineage starts at durable files (a lost
    executor re-reads them instead of re-scanning the sources), reads prune
    columns, and Spark knows the exact size of the data for broadcast choices.
    """
    spark = df.sparkSession
    path = shared_path(spark, name)
    df.write.mode("overwrite").parquet(path)
    out = spark.read.parquet(path)
    out._monthwise_path = path
    return out


def release(df: DataFrame) -> bool:
    """Delete the folder behind a ``materialize``d frame (after its last use)."""
    path = getattr(df, "_monthwise_path", None)
    return path is not None and delete_path(df.sparkSession, path)


def delete_path(spark: SparkSession, path: str) -> bool:
    """Delete a folder in any file system that Spark reaches."""
    sc = spark.sparkContext
    _written.get(sc.applicationId, set()).discard(path)
    jpath = sc._jvm.org.apache.hadoop.fs.Path(path)
    return bool(jpath.getFileSystem(sc._jsc.hadoopConfiguration()).delete(jpath, True))


def written(spark: SparkSession) -> set[str]:
    """Scratch folders (materialized frames, stores and exports of queries) not released yet."""
    return set(_written.get(spark.sparkContext.applicationId, ()))


@contextmanager
def released(spark: SparkSession):
    """Deletes on exit every frame materialized inside the block (one block at a time
    in an application): for jobs whose result is written before they end."""
    before = written(spark)
    try:
        yield
    finally:
        for path in written(spark) - before:
            delete_path(spark, path)


def release_all(spark: SparkSession) -> int:
    """Delete every scratch folder of this application.  A query's result may read
    such a folder, so call it when the results are written."""
    paths = written(spark)
    for path in paths:
        delete_path(spark, path)
    return len(paths)
