"""Outbox (work queue) operators: build, replace by key, pending, mark processed.

All are set-based DataFrame transforms; persistence (staged rewrite of the
touched date partitions) lives in ``monthwise.sources.outbox_store``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

OUTBOX_SCHEMA = "FECHA date, PARA string, CC string, SUBJECT string, BODY string, PROCESADO string"
OUTBOX_COLUMNS = ("FECHA", "PARA", "CC", "SUBJECT", "BODY", "PROCESADO")
PENDING = "N"
PROCESSED = "S"


def _lit(v) -> Column:
    return v if isinstance(v, Column) else F.lit(v)


def outbox_row(mail: DataFrame, to, cc, fecha, subject: str = "SUBJECT",
               body: str = "BODY") -> DataFrame:
    """The 6-column outbox record(s) for mail rows, status pending."""
    return mail.select(
        _lit(fecha).cast("date").alias("FECHA"),
        _lit(to).cast("string").alias("PARA"),
        _lit(cc).cast("string").alias("CC"),
        F.col(subject).alias("SUBJECT"),
        F.col(body).alias("BODY"),
        F.lit(PENDING).alias("PROCESADO"))


def replace_by_key(target: DataFrame, incoming: DataFrame, key: str = "SUBJECT",
                   keep_sent: bool = False, status: str = "PROCESADO") -> DataFrame:
    """Delete the target rows whose key appears in ``incoming``, then add ``incoming``.

    ``=`` semantics: a NULL key neither deletes nor is deleted.  With
    ``keep_sent`` an incoming key that already has a processed row is not
    re-queued and that key's rows are left as they are.
    """
    if keep_sent:
        sent = target.where(F.col(status) == PROCESSED).select(key)
        incoming = incoming.join(sent, on=key, how="left_anti")
    keys = incoming.select(key).where(F.col(key).isNotNull()).distinct()
    kept = target.join(keys, on=key, how="left_anti")
    return kept.unionByName(incoming.select(*target.columns))


def pending(outbox: DataFrame, status: str = "PROCESADO") -> DataFrame:
    return outbox.where(F.col(status) == PENDING)


def mark_processed(outbox: DataFrame, sent: DataFrame, key: str = "SUBJECT",
                   status: str = "PROCESADO") -> DataFrame:
    """Set pending rows to processed for every key in ``sent`` (one set-based update).

    All pending rows that share a sent key flip together, as the per-mail
    ``UPDATE ... WHERE status = 'N' AND key = ?`` did.  ``sent`` may be large:
    it is de-duplicated and joined (AQE broadcasts it only when its measured
    size allows, and splits a hot key's partition).
    """
    flags = sent.select(key).where(F.col(key).isNotNull()).distinct() \
        .withColumn("_sent", F.lit(True))
    joined = outbox.join(flags, on=key, how="left")
    new_status = F.when((F.col(status) == PENDING) & F.col("_sent").isNotNull(),
                        F.lit(PROCESSED)).otherwise(F.col(status))
    return joined.select(*[new_status.alias(status) if c == status else F.col(c)
                           for c in outbox.columns])
