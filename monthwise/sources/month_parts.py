"""Maintained month parts: the report's sums, kept per closed month.

The sums of a month do not change while its fact files do not.  ``MonthParts`` keeps
``SUM(q)`` and ``SUM(q * m)`` by (period, type, label) in a table of its own, and for each
month the fingerprint of the files it was summed from.  ``refresh`` compares fingerprints,
sums the changed months again (reading only their folders), and replaces them and their
fingerprints in one recorded rewrite.  A late row thus costs one month; the report's
window reads the kept parts and no facts.

The fingerprint is taken before the rows are read.  A file that arrives in between is summed
or not; either way the next refresh sees another fingerprint and sums the month again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from monthwise.session import materialize, release
from monthwise.sources.fact_layout import FactLayout
from monthwise.sources.staged import StagedTable

PARTS_SCHEMA = "PERIODO int, TIPO string, SVA_SMS string, Q bigint, QM decimal(38,4)"
LEDGER_SCHEMA = "PERIODO int, n_files bigint, n_bytes bigint, digest bigint"


class MonthParts(StagedTable):
    """``facts``: a ``FactLayout`` by PERIODO with TIPO, SVA_SMS, ``qty`` and ``amount`` columns;
    without an amount (subscribers) QM is NULL."""

    def __init__(self, spark: SparkSession, path: str, facts: FactLayout, qty: str = "Q", amount: str | None = "MONTO_NETO"):
        super().__init__(spark, path, PARTS_SCHEMA, "PERIODO", {"ledger": LEDGER_SCHEMA})
        self.facts, self.qty, self.amount = facts, qty, amount

    def summed(self, months: set) -> DataFrame:
        """The parts of some months, from their facts; other folders are not read."""
        rows = self.facts.read().where(self.only(months))
        return rows.groupBy("PERIODO", "TIPO", "SVA_SMS").agg(
            F.sum(self.qty).cast("bigint").alias("Q"),
            (F.sum(F.col(self.qty) * F.col(self.amount)) if self.amount else F.lit(None)).cast("decimal(38,4)").alias("QM"))

    def stale(self, now: DataFrame) -> set:
        """Months whose files differ from those they were summed from, came or went: one
        value for a month, fetched to the driver."""
        old = self.side("ledger").select("PERIODO", F.struct("n_files", "n_bytes", "digest").alias("was"))
        new = now.select(F.col("PERIODO").alias("p"), F.struct("n_files", "n_bytes", "digest").alias("is"))
        both = new.join(old, new.p.eqNullSafe(old.PERIODO), "full")
        differ = both.where(~F.col("was").eqNullSafe(F.col("is")))
        return {r[0] for r in differ.select(F.when(F.col("is").isNull(), F.col("PERIODO")).otherwise(F.col("p"))).collect()}

    def refresh(self) -> set:
        """Bring the parts up to date; the months that were summed again."""
        self.recover()
        now = materialize(self.facts.fingerprints(), "month-files")
        try:
            months = self.stale(now)
            if months:
                self.rewrite(self.summed(months), {self.folder_of(m) for m in months},
                             lambda _: {"ledger": now.where(self.only(months))})
            return months
        finally:
            release(now)
